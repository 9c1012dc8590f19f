"""Queries over the column functions and the column-shape operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsledger.catalog import domain as D
from opsledger.catalog.registry import Tables, query, sql_money, with_money
from opsledger.functions import scalars as X
from opsledger.operators import schema as S
from opsledger.operators.joins import dates_in_touched_weeks

# ---- scalar functions -----------------------------------------------------------------------------


@query("x1_numeric", "SELECT line_id, TRY_CAST(amount AS DOUBLE) AS amount FROM (" + D.with_tables(D.SHEET_ROWS) + "SELECT * FROM raw)")
def x1(t: Tables) -> DataFrame:
    return D.sheet_rows(t).select("line_id", X.numeric("amount").alias("amount"))


@query("x2_rounded_long", "SELECT event_id, CAST(round_even(value * 2.5, 0) AS BIGINT) AS rounded FROM events")
def x2(t: Tables) -> DataFrame:
    return t.events.select("event_id", X.rounded_long(F.col("value") * F.lit(2.5)).alias("rounded"))


@query("x3_default", D.with_tables(D.SHEET_ROWS) + """
SELECT line_id, coalesce(payment_id, 0) AS payment_id, coalesce(manual_distrib, sheetname) AS facility,
  coalesce(debit, 'none') AS debit FROM raw""")
def x3(t: Tables) -> DataFrame:
    return D.sheet_rows(t).select("line_id", X.default("payment_id", 0).alias("payment_id"),
                                  X.default("manual_distrib", F.col("sheetname")).alias("facility"),
                                  X.default("debit", "none").alias("debit"))


@query("x4_tagged_id", D.with_tables(D.SHEET_ROWS) + """
SELECT line_id, coalesce(nullif(regexp_extract(description, 'IND ID:(\\d+)', 1), ''), 'No ID') AS merchant_id FROM raw""")
def x4(t: Tables) -> DataFrame:
    return D.sheet_rows(t).select("line_id", X.tagged_id("description").alias("merchant_id"))


@query("x5_leading_digits", D.with_tables(D.REGISTER) + """
SELECT document_id, patient_id_name, TRY_CAST(nullif(regexp_extract(patient_id_name, '^(\\d+)', 1), '') AS BIGINT) AS patient_id FROM reg""")
def x5(t: Tables) -> DataFrame:
    return D.register_export(t).select(F.col("Document ID").alias("document_id"), F.col("Patient Acct No + Name").alias("patient_id_name"),
                                       X.leading_digits("Patient Acct No + Name").alias("patient_id"))


@query("x6_first_digits", """SELECT conv_id, turn, TRY_CAST(nullif(regexp_extract(text, '(\\d+)', 1), '') AS INT) AS n FROM conversations
UNION ALL SELECT event_id, 0, CAST(json_extract_string(props, '$.k') AS INT) FROM events""")
def x6(t: Tables) -> DataFrame:
    talk = t.conversations.select("conv_id", "turn", X.first_digits("text").alias("n"))
    log = t.events.select(F.col("event_id").alias("conv_id"), F.lit(0).cast("bigint").alias("turn"),
                          X.first_digits(F.concat(F.get_json_object("props", "$.k"), F.lit(" minutes"))).alias("n"))
    return talk.unionByName(log)


@query("x7_relabel", D.with_tables(D.SHEET_ROWS) + """
SELECT line_id, CASE sheetname WHEN 'P15' THEN 'S15' WHEN 'P14' THEN 'S14' ELSE sheetname END AS sheetname FROM raw""")
def x7(t: Tables) -> DataFrame:
    return D.sheet_rows(t).select("line_id", X.relabel("sheetname", D.ALIASES).alias("sheetname"))


_CLEAN = r"trim(regexp_replace({}, '[\x{{FEFF}}\x{{200B}}\x{{200C}}\x{{200D}}\x{{2060}}\x00-\x1F\x7F]', '', 'g'))"


@query("x8_clean_text", f"""SELECT doc_id AS id, {_CLEAN.format("chr(65279) || ' ' || text || chr(8203)")} AS text FROM documents
UNION ALL SELECT conv_id * 1000 + turn, {_CLEAN.format("text || chr(8288) || ' '")} FROM conversations""")
def x8(t: Tables) -> DataFrame:
    docs = t.documents.select(F.col("doc_id").alias("id"), X.clean_text(
        F.concat(F.lit("\uFEFF "), F.col("text"), F.lit("\u200B"))).alias("text"))
    talk = t.conversations.select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), X.clean_text(
        F.concat(F.col("text"), F.lit("\u2060 "))).alias("text"))
    return docs.unionByName(talk)


@query("x9_yes_no", """SELECT doc_id, CASE WHEN lower(source) LIKE 'y%' THEN 'Yes' WHEN lower(source) LIKE 'n%' THEN 'No' ELSE source END AS source,
  CASE WHEN lower(substr(text, 1, 1)) = 'y' THEN 'Yes' WHEN lower(substr(text, 1, 1)) = 'n' THEN 'No' ELSE text END AS answer FROM documents""")
def x9(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", X.yes_no("source").alias("source"), X.yes_no("text").alias("answer"))


_DATE_TEXT_SQL = """CASE WHEN o_orderkey % 7 = 0 THEN 'bad' WHEN o_orderkey % 11 = 0 THEN '1996-02-30'
  ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END"""


@query("x10_lenient_dates", f"""SELECT o_orderkey, TRY_CAST(s AS DATE) AS plain, CAST(try_strptime(s, '%Y-%m-%d') AS DATE) AS formatted,
  CAST(try_strptime(s || ' 10:30:00', '%Y-%m-%d %H:%M:%S') AS TIMESTAMP) AS at FROM (SELECT o_orderkey, {_DATE_TEXT_SQL} AS s FROM orders)""")
def x10(t: Tables) -> DataFrame:
    text = F.when(F.col("o_orderkey") % 7 == 0, "bad").when(F.col("o_orderkey") % 11 == 0, "1996-02-30") \
        .otherwise(F.col("o_orderdate").cast("date").cast("string"))
    return t.orders.withColumn("s", text).select(
        "o_orderkey", X.lenient_date("s").alias("plain"), X.lenient_date("s", "yyyy-MM-dd").alias("formatted"),
        X.lenient_timestamp(F.concat(F.col("s"), F.lit(" 10:30:00")), "yyyy-MM-dd HH:mm:ss").alias("at"))


@query("x11_key_parts", """SELECT event_id, concat_ws('', user_id, strftime(CAST(ts AS DATE), '%Y-%m-%d'), substr(event_type, 1, 3),
  CASE WHEN event_type <> 'error' THEN event_type END) AS visit_key FROM events""")
def x11(t: Tables) -> DataFrame:
    return t.events.select("event_id", X.key_parts(
        "user_id", X.iso_date(F.col("ts").cast("date")), X.prefix("event_type"),
        F.when(F.col("event_type") != "error", F.col("event_type"))).alias("visit_key"))


_MIDNIGHT_SQL = "CAST(CAST(ts AS DATE) + 1 AS TIMESTAMP)"


@query("x12_minutes_between", f"""SELECT event_id, CAST(round(date_diff('second', date_trunc('second', ts), {_MIDNIGHT_SQL}) / 60.0::DOUBLE) AS INT)
  AS minutes FROM events""")
def x12(t: Tables) -> DataFrame:
    midnight = F.date_add(F.col("ts").cast("date"), 1).cast("timestamp_ntz")
    return t.events.select("event_id", X.minutes_between("ts", midnight).alias("minutes"))


@query("x13_wait_time", """SELECT user_id, round(date_diff('second', date_trunc('second', min(ts)), date_trunc('second', max(ts))) / 60.0::DOUBLE
  + CAST(arg_max(CAST(json_extract_string(props, '$.k') AS INT), ts) AS DOUBLE), 4) AS pwt FROM events GROUP BY user_id""")
def x13(t: Tables) -> DataFrame:
    minutes = F.get_json_object("props", "$.k").cast("int")
    spans = t.events.groupBy("user_id").agg(F.min("ts").alias("lo"), F.max("ts").alias("hi"), F.max_by(minutes, F.col("ts")).alias("m"))
    return spans.select("user_id", F.round(X.seconds_between("lo", "hi") / F.lit(60.0) + F.col("m").cast("double"), 4).alias("pwt"))


@query("x14_business_days", D.with_tables(D.REGISTER) + """
SELECT document_id, scan_dt, reviewed_dt, CASE WHEN reviewed_dt IS NOT NULL THEN CAST(len(list_filter(generate_series(
  least(scan_dt, reviewed_dt), greatest(scan_dt, reviewed_dt), INTERVAL 1 DAY), lambda d: isodow(d) < 6)) AS INT) END AS days FROM reg""")
def x14(t: Tables) -> DataFrame:
    scan, reviewed = F.col("Scan Date").cast("date"), F.col("Reviewed Date").cast("date")
    return D.register_export(t).select(F.col("Document ID").alias("document_id"), scan.alias("scan_dt"), reviewed.alias("reviewed_dt"),
                                       X.business_days(scan, reviewed).alias("days"))


@query("x15_sla_flag", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_returnflag <> 'R' AND
  l_quantity <= CASE WHEN l_linestatus = 'O' THEN 1 ELSE 3 END THEN 1 ELSE 0 END AS sla FROM lineitem""")
def x15(t: Tables) -> DataFrame:
    reviewed, fast = X.flag(F.col("l_returnflag") != "R"), X.flag(F.col("l_linestatus") == "O")
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", X.sla_flag(F.col("l_quantity"), reviewed, fast).alias("sla"))


@query("x16_weekday", """SELECT o_orderkey, CAST(isodow(o_orderdate) - 1 AS INT) AS weekday, CAST(dayofweek(o_orderdate) + 1 AS INT) AS day_of_week FROM orders""")
def x16(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", X.weekday("o_orderdate").alias("weekday"), F.dayofweek("o_orderdate").alias("day_of_week"))


@query("x17_shares", """SELECT o_orderkey, o_totalprice * 0.86::DOUBLE AS target_86, o_totalprice * 1.0::DOUBLE AS target_100,
  o_totalprice * 1.12::DOUBLE AS target_112 FROM orders""")
def x17(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", *[X.share_of("o_totalprice", s).alias(f"target{b}") for b, s in X.TARGET_BANDS.items()])


@query("x18_net", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice - l_discount AS net FROM lineitem")
def x18(t: Tables) -> DataFrame:
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", (F.col("l_extendedprice") - F.col("l_discount")).alias("net"))


@query("x19_as_of", f"""SELECT o_orderkey, DATE '{D.AS_OF}' AS process_date, CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '{D.AS_OF}') AS INT) AS age FROM orders""")
def x19(t: Tables) -> DataFrame:
    return S.tag(t.orders, process_date=D.AS_OF).select(
        "o_orderkey", "process_date", F.date_diff("process_date", F.col("o_orderdate").cast("date")).alias("age"))


@query("x20_string_key", """SELECT CAST(p_partkey AS VARCHAR) AS cpt_code, CASE WHEN p_size <> 5 THEN CAST(p_size AS VARCHAR) END AS maybe FROM part""")
def x20(t: Tables) -> DataFrame:
    return t.part.select(F.col("p_partkey").cast("string").alias("cpt_code"),
                         F.when(F.col("p_size") != 5, F.col("p_size")).cast("string").alias("maybe"))


@query("x21_membership", D.with_tables(D.LINES) + """
SELECT line_id, CASE WHEN payment_id IN (3, 4) THEN 1 ELSE 0 END AS posted_elsewhere,
  CASE WHEN merch_facility_group_id IN (4, 5, 11, 12, 13, 14, 15, 18) THEN 1 ELSE 0 END AS listed FROM lines""")
def x21(t: Tables) -> DataFrame:
    from opsledger.plans.policy import POSTED_ELSEWHERE_CODES
    from opsledger.plans.receipts import DEBIT_CREDIT_FACILITIES
    return S.with_flags(D.bank_lines(t), posted_elsewhere=F.col("payment_id").isin(*POSTED_ELSEWHERE_CODES),
                        listed=F.col("merch_facility_group_id").isin(*DEBIT_CREDIT_FACILITIES)).select("line_id", "posted_elsewhere", "listed")


@query("x22_blank_to_null", """SELECT doc_id, i - 1 AS line_no, nullif(trim(l[i]), '') AS line FROM (
SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents))""")
def x22(t: Tables) -> DataFrame:
    lines = t.documents.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return lines.select("doc_id", F.col("line_no").cast("bigint").alias("line_no"), X.blank_to_null(F.trim("line")).alias("line"))


@query("x24_record_bytes", """SELECT c_custkey, CAST(strlen(CAST(to_json({'c_custkey': c_custkey, 'c_name': c_name, 'c_nationkey': c_nationkey,
  'c_mktsegment': c_mktsegment}) AS VARCHAR)) AS INT) AS bytes FROM customer""")
def x24(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", X.record_bytes("c_custkey", "c_name", "c_nationkey", "c_mktsegment").alias("bytes"))


# ---- schema operators -----------------------------------------------------------------------------

@query("f1_rename_map", "SELECT o_orderkey AS line_id, o_orderstatus AS sheetname, o_custkey FROM orders")
def f1(t: Tables) -> DataFrame:
    return S.rename_map(t.orders.select("o_orderkey", "o_orderstatus", "o_custkey"),
                        {"o_orderkey": "line_id", "o_orderstatus": "sheetname", "not_there": "x"})


@query("f2_conform_schema", f"""SELECT o_orderkey AS id, TRY_CAST({_DATE_TEXT_SQL} AS DATE) AS day,
  CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_custkey AS INT) END AS age, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS price,
  CAST(NULL AS VARCHAR) AS absent FROM orders""")
def f2(t: Tables) -> DataFrame:
    key = F.col("o_orderkey")
    raw = t.orders.select(
        F.when(key % 3 == 0, F.concat(F.lit("\u200B"), key.cast("string"))).otherwise(key.cast("string")).alias("id"),
        F.when(key % 7 == 0, "bad").when(key % 11 == 0, "1996-02-30").otherwise(F.col("o_orderdate").cast("date").cast("string")).alias("day"),
        F.when(key % 5 == 0, "n/a").otherwise(F.col("o_custkey").cast("string")).alias("age"),
        F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("price"), F.lit(1).alias("undeclared"))
    schema = T.StructType.fromDDL("id bigint, day date, age int, price decimal(18,2), absent string")
    return S.conform_schema(raw, schema, "yyyy-MM-dd", clean=["id"]).withColumn("price", F.col("price").cast("double"))


@query("f3_select_existing", "SELECT o_orderkey, o_custkey FROM orders")
def f3(t: Tables) -> DataFrame:
    return S.select_existing(t.orders, ["o_orderkey", "missing", "o_custkey"])


@query("f4_require_columns", "SELECT o_orderkey AS date, o_custkey AS target FROM orders")
def f4(t: Tables) -> DataFrame:
    padded = t.orders.select(F.col("o_orderkey").alias(" date "), F.col("o_custkey").alias("target"), F.lit(1).alias("Unnamed: 3"))
    return S.require_columns(padded, ["date", "target"])


@query("f5_strict_cast_and_order", """SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date, o_orderpriority AS facility,
  CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS target, o_custkey AS facility_group_id FROM orders""")
def f5(t: Tables) -> DataFrame:
    from opsledger.plans.maintenance import TARGET_SCHEMA
    text = t.orders.select(
        F.col("o_custkey").cast("string").alias("facility_group_id"), F.concat(F.lit("  "), "o_orderpriority", F.lit(" ")).alias("facility"),
        F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("target"), F.col("o_orderdate").cast("date").cast("string").alias("date"))
    return S.strict_cast_and_order(text, TARGET_SCHEMA)


@query("f6_arrange", "SELECT o_orderstatus, o_orderkey FROM orders")
def f6(t: Tables) -> DataFrame:
    return S.arrange(t.orders, ["o_orderstatus", "o_custkey", "o_orderkey"], drop=["o_custkey"])


@query("f7_tag", "SELECT o_orderkey, 'S04' AS sheet_name, CAST(4 AS INT) AS dist_facility_group_id FROM orders")
def f7(t: Tables) -> DataFrame:
    return S.tag(t.orders.select("o_orderkey"), sheet_name="S04", dist_facility_group_id=4)


@query("f8_filters", """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber FROM lineitem WHERE l_linestatus = 'O' AND l_quantity >= 10
  AND l_linenumber NOT IN (1, 3, 4) AND CAST(l_shipdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'
  AND nullif(l_returnflag, 'R') IS NULL""")
def f8(t: Tables) -> DataFrame:
    return t.lineitem.where(
        (F.col("l_linestatus") == "O") & (F.col("l_quantity") >= 10) & ~F.col("l_linenumber").isin(1, 3, 4)
        & (F.col("l_shipdate") >= F.lit("1996-01-01").cast("timestamp_ntz"))
        & (F.col("l_shipdate") < F.lit("2000-01-01").cast("timestamp_ntz")) & F.nullif(F.col("l_returnflag"), F.lit("R")).isNull()
    ).select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")


@query("f9_weekday_only", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date FROM orders WHERE isodow(o_orderdate) < 6")
def f9(t: Tables) -> DataFrame:
    return S.weekday_only(t.orders.select("o_orderkey", F.col("o_orderdate").cast("date").alias("date")), "date")


@query("f10_dates_in_touched_weeks", D.with_tables(D.CALENDAR, D.LINES) + """
SELECT date FROM cal WHERE calendar_week_id IN (SELECT calendar_week_id FROM cal WHERE date BETWEEN
  (SELECT min(sheet_date) + 400 FROM lines) AND (SELECT max(sheet_date) - 400 FROM lines))""")
def f10(t: Tables) -> DataFrame:
    span = D.bank_lines(t).agg(F.min("sheet_date").alias("lo"), F.max("sheet_date").alias("hi"))
    fact = span.select(F.explode(F.array(F.date_add("lo", 400), F.date_sub("hi", 400))).alias("sheet_date"))
    return dates_in_touched_weeks(D.order_calendar(t), fact, "sheet_date")


@query("f11_masked_update", D.with_tables(D.SHEET_ROWS) + f"""
SELECT line_id, {sql_money('''CASE WHEN TRY_CAST(amount AS DECIMAL(18,2)) IS NULL AND sheet_facility_group_id IN (4, 5, 11, 12, 13, 14, 15, 18)
  THEN coalesce(TRY_CAST(debit AS DECIMAL(18,2)), 0) + coalesce(TRY_CAST(credit AS DECIMAL(18,2)), 0) ELSE TRY_CAST(amount AS DECIMAL(18,2)) END''')} AS amount,
  CASE WHEN payment_id = 4 AND manual_distrib IS NOT NULL THEN manual_distrib ELSE sheetname END AS sheetname FROM raw""")
def f11(t: Tables) -> DataFrame:
    from opsledger.plans.receipts import fill_missing_amount
    filled = fill_missing_amount(D.sheet_rows(t))
    manual = (F.col("payment_id") == 4) & F.col("manual_distrib").isNotNull()
    return with_money(S.masked_update(filled, "sheetname", manual, F.col("manual_distrib")), "amount").select("line_id", "amount", "sheetname")


@query("f12_flag_case", """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CASE WHEN nullif(l_returnflag, 'R') = 'A' THEN 1 ELSE 0 END AS is_a,
  CASE WHEN l_discount > 0.05 THEN 1 ELSE 0 END AS high_discount FROM lineitem""")
def f12(t: Tables) -> DataFrame:
    return S.with_flags(t.lineitem, is_a=F.nullif(F.col("l_returnflag"), F.lit("R")) == "A", high_discount=F.col("l_discount") > 0.05) \
        .select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "is_a", "high_discount")


@query("f13_partition_by_class", D.with_tables(D.LINES, D.DETAIL, D.CLASSES) + f"""
SELECT sheetname, receipt_class, count(*) AS n_rows, {sql_money('SUM(amount)')} AS amount FROM cls GROUP BY ALL""")
def f13(t: Tables) -> DataFrame:
    from opsledger.plans.policy import default_policies
    from opsledger.plans.receipts import classify_receipts, posting_detail
    rows = classify_receipts(posting_detail(D.bank_lines(t), D.payment_details(t)), default_policies(t.spark))
    return with_money(rows.groupBy("sheetname", "receipt_class").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("amount").alias("amount")), "amount")

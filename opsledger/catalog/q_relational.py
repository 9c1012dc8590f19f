"""Queries over joins, aggregates, ranking, ordering and set operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsledger.catalog import domain as D
from opsledger.catalog.registry import Tables, query, sql_money, with_money
from opsledger.operators import aggregates as A
from opsledger.operators import joins as J
from opsledger.operators import windows as W
from opsledger.operators.lasting_ids import lasting_ids
from opsledger.plans.policy import default_policies
from opsledger.session import run_folder
from opsledger.sources.versions import VersionedTable

LINE_KEYS = "l_orderkey, l_partkey, l_suppkey, l_linenumber"
LINE_KEY_LIST = LINE_KEYS.split(", ")

# ---- joins ----------------------------------------------------------------------------------------


@query("j1_lookup_left_raise", """SELECT o_orderkey, c_mktsegment, c_nationkey FROM orders
LEFT JOIN customer ON c_custkey = o_custkey + CASE WHEN o_orderpriority = '5-LOW' THEN 100000000 ELSE 0 END""")
def j1_raise(t: Tables) -> DataFrame:
    """Orders of one priority name customers that are not there."""
    dim = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment", "c_nationkey")
    missing = F.when(F.col("o_orderpriority") == "5-LOW", 100_000_000).otherwise(0)
    return J.lookup_left(t.orders.withColumn("o_custkey", F.col("o_custkey") + missing), dim, ["o_custkey"], ["c_mktsegment", "c_nationkey"]).select("o_orderkey", "c_mktsegment", "c_nationkey")


# Every merchant with an even number is registered twice, so the lookup key repeats.
DOUBLE_SQL = """dbl AS (SELECT s_suppkey AS l_suppkey, s_name AS merchant, unnest(CASE WHEN s_suppkey % 2 = 0
  THEN [s_nationkey, s_nationkey + 100] ELSE [s_nationkey] END) AS facility FROM supplier)"""


def _double(t: Tables) -> DataFrame:
    nation = F.col("s_nationkey")
    return t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_name").alias("merchant"), F.explode(
        F.when(F.col("s_suppkey") % 2 == 0, F.array(nation, nation + 100)).otherwise(F.array(nation))).alias("facility"))


@query("j1_lookup_left_fanout", D.with_tables(DOUBLE_SQL) + f"SELECT {LINE_KEYS}, merchant, facility FROM lineitem LEFT JOIN dbl USING (l_suppkey)")
def j1_fanout(t: Tables) -> DataFrame:
    return J.lookup_left(t.lineitem, _double(t), ["l_suppkey"], ["merchant", "facility"], "fanout").select(*LINE_KEY_LIST, "merchant", "facility")


@query("j1_lookup_left_first", D.with_tables(DOUBLE_SQL) + f"""SELECT {LINE_KEYS}, merchant, facility FROM lineitem
LEFT JOIN (SELECT l_suppkey, merchant, min(facility) AS facility FROM dbl GROUP BY ALL) USING (l_suppkey)""")
def j1_first(t: Tables) -> DataFrame:
    return J.lookup_left(t.lineitem, _double(t), ["l_suppkey"], ["merchant", "facility"], "first").select(*LINE_KEY_LIST, "merchant", "facility")


@query("j1_lookup_left_null_safe", """SELECT event_id, label FROM (SELECT event_id, nullif(event_type, 'error') AS k FROM events) e
LEFT JOIN (SELECT nullif(event_type, 'error') AS k, 'T' || count(*) AS label FROM events GROUP BY ALL) d ON e.k IS NOT DISTINCT FROM d.k""")
def j1_null_safe(t: Tables) -> DataFrame:
    typed = t.events.select("event_id", F.nullif(F.col("event_type"), F.lit("error")).alias("k"))
    labels = typed.groupBy("k").agg(F.concat(F.lit("T"), F.count(F.lit(1)).cast("string")).alias("label"))
    return J.lookup_left(typed, labels, ["k"], ["label"], null_safe=True).select("event_id", "label")


@query("j2_lookup_inner", D.with_tables(D.VISITS, D.CLINICS) + "SELECT patient_id, log_time, facility_name, facility_group_id, facility_group_name FROM vis JOIN clin USING (facility_name)")
def j2(t: Tables) -> DataFrame:
    from opsledger.plans.visits import normalise_visits
    visits = normalise_visits(D.visit_export(t)).select("patient_id", "log_time", "facility_name")
    return J.lookup_inner(visits, D.clinics(t), ["facility_name"], ["facility_group_id", "facility_group_name"])


@query("j3_expand_detail_left", "SELECT o_orderkey, o_orderstatus, l_linenumber, l_partkey, l_quantity FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey")
def j3(t: Tables) -> DataFrame:
    detail = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey", "l_quantity")
    return J.expand_detail_left(t.orders.select("o_orderkey", "o_orderstatus"), detail, "o_orderkey")


@query("j3_expand_detail_left_hot_keys", """SELECT u.user_id, u.n_events, l.l_orderkey, l.l_partkey FROM
(SELECT user_id, count(*) AS n_events FROM events GROUP BY ALL) u
LEFT JOIN (SELECT CASE WHEN l_linenumber IN (1, 2) THEN 5 ELSE l_orderkey * 3 + 40 END AS user_id, l_orderkey, l_partkey FROM lineitem) l
ON l.user_id = u.user_id""")
def j3_hot(t: Tables) -> DataFrame:
    """About a third of the details share one key."""
    key = F.when(F.col("l_linenumber").isin(1, 2), F.lit(5).cast("bigint")).otherwise(F.col("l_orderkey") * 3 + 40)
    detail = t.lineitem.select(key.alias("user_id"), "l_orderkey", "l_partkey")
    users = t.events.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_events"))
    return J.expand_detail_left(users, detail, "user_id")


@query("j4_outer_merge_fill0", """SELECT coalesce(a.d, b.d) AS d, coalesce(a.amount, 0) AS amount, coalesce(b.posted, 0) AS posted FROM
(SELECT CAST(o_orderdate AS DATE) + 40 AS d, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS amount FROM orders GROUP BY ALL) a
FULL JOIN (SELECT CAST(l_shipdate AS DATE) AS d, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS posted FROM lineitem GROUP BY ALL) b ON a.d = b.d""")
def j4(t: Tables) -> DataFrame:
    a = t.orders.groupBy(F.date_add(F.col("o_orderdate").cast("date"), 40).alias("d")).agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("amount"))
    b = t.lineitem.groupBy(F.col("l_shipdate").cast("date").alias("d")).agg(
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("posted"))
    out = J.outer_merge_fill0(a, b, ["d"])
    return out.select("d", F.col("amount").cast("double").alias("amount"), F.col("posted").cast("double").alias("posted"))


@query("j5_left_agg_subquery", D.with_tables(D.DEDUCTS) + f"""
SELECT b.date, b.facility_group_id, {sql_money('coalesce(r.amount, 0)')} AS amount, coalesce(ded.deduct, 0) AS deduct
FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS date, l_suppkey % 27 AS facility_group_id FROM lineitem) b
LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS d, o_custkey % 27 AS f, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS amount FROM orders GROUP BY ALL) r
  ON r.d = b.date AND r.f = b.facility_group_id LEFT JOIN ded ON ded.facility_group_id = r.f""")
def j5(t: Tables) -> DataFrame:
    base = t.lineitem.select(F.col("l_shipdate").cast("date").alias("date"), (F.col("l_suppkey") % 27).alias("facility_group_id")).distinct()
    receipts = t.orders.select(F.col("o_orderdate").cast("date").alias("sheet_date"), (F.col("o_custkey") % 27).alias("dist_facility_group_id"),
                               F.col("o_totalprice").cast("decimal(18,2)").alias("amount"))
    return with_money(J.left_agg_chain(base, receipts, D.deductions(t)), "amount")


@query("j6_cross_fill", D.with_tables(D.CALENDAR, D.FACILITIES) + "SELECT date, calendar_week_id, facility_group_id, facility_group_name FROM cal, fac")
def j6(t: Tables) -> DataFrame:
    return J.cross_fill(D.order_calendar(t).select("date", "calendar_week_id"), D.facilities(t))


@query("j7_expand_missing_keys", D.with_tables(D.LINES, """has AS (SELECT sheetname AS sheet, sheet_date, payment_id AS facility_id FROM lines WHERE payment_id = 3),
want AS (SELECT DISTINCT sheetname AS sheet, sheet_date FROM lines)""") + """
SELECT * FROM has UNION ALL SELECT w.sheet, w.sheet_date, m.f FROM want w JOIN (VALUES ('W', 1), ('W', 2), ('G', 5), ('C', 1), ('C', 2), ('C', 4),
  ('C', 5), ('C', 9), ('C', 13)) m(sheet, f) ON m.sheet = w.sheet
WHERE NOT EXISTS (SELECT 1 FROM has h WHERE h.sheet = w.sheet AND h.sheet_date = w.sheet_date)""")
def j7(t: Tables) -> DataFrame:
    lines = D.bank_lines(t).withColumnRenamed("sheetname", "sheet")
    has = lines.where(F.col("payment_id") == 3).select("sheet", "sheet_date", F.col("payment_id").alias("facility_id"))
    members = default_policies(t.spark).split.select("sheet", "facility_id")
    return J.expand_missing_keys(has, lines, "sheet_date", members, "sheet")


@query("j8_policy_join", D.with_tables(D.LINES) + f"""
SELECT line_id, CAST(fac AS BIGINT) AS facility_id, {sql_money('amount * share')} AS part FROM lines JOIN (VALUES ('W', 1, 0.80::DECIMAL(6,4)), ('W', 2, 0.20),
  ('G', 5, 1.00), ('C', 1, 0.43), ('C', 2, 0.21), ('C', 4, 0.08), ('C', 5, 0.19), ('C', 9, 0.09), ('C', 13, 0.00)) s(sheet, fac, share) ON sheet = sheetname""")
def j8(t: Tables) -> DataFrame:
    split = default_policies(t.spark).split.withColumnRenamed("sheet", "sheetname")
    shared = J.policy_join(D.bank_lines(t), split, ["sheetname"], "inner")
    return with_money(shared.select("line_id", F.col("facility_id"), (F.col("amount") * F.col("residual_share")).alias("part")), "part")


@query("j9_semi", "SELECT o_orderkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def j9(t: Tables) -> DataFrame:
    returned = t.lineitem.where(F.col("l_returnflag") == "R").select(F.col("l_orderkey").alias("o_orderkey"))
    return J.keep_if_in(t.orders, returned, ["o_orderkey"]).select("o_orderkey")


@query("j10_anti", "SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')")
def j10(t: Tables) -> DataFrame:
    returned = t.lineitem.where(F.col("l_returnflag") == "R").select(F.col("l_orderkey").alias("o_orderkey"))
    return J.drop_if_in(t.orders, returned, ["o_orderkey"]).select("o_orderkey")


@query("j11_presence_join", """SELECT p_partkey, CASE WHEN p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 49) THEN 1 ELSE 0 END AS read FROM part""")
def j11(t: Tables) -> DataFrame:
    big = t.lineitem.where(F.col("l_quantity") > 49)
    return J.presence_join(t.part.select("p_partkey"), big, "p_partkey", "l_partkey", "read")


# ---- aggregates -----------------------------------------------------------------------------------


@query("a1_sum_by_date", D.with_tables(D.LINES) + f"SELECT sheet_date, {sql_money('SUM(amount)')} AS amount FROM lines GROUP BY ALL")
def a1(t: Tables) -> DataFrame:
    return with_money(A.sum_by(D.bank_lines(t), ["sheet_date"], ["amount"]), "amount")


@query("a2_sum_by_date_facility", D.with_tables(D.LINES) + f"""
SELECT sheet_date, merch_facility_group_id, {sql_money('SUM(amount)')} AS amount FROM lines WHERE merch_facility_group_id IS NOT NULL GROUP BY ALL""")
def a2(t: Tables) -> DataFrame:
    return with_money(A.sum_by(D.bank_lines(t), ["sheet_date", "merch_facility_group_id"], ["amount"]), "amount")


@query("a3_sum_by_date_type", D.with_tables(D.LINES) + f"""
SELECT sheet_date, CASE WHEN payment_id = 1 THEN 'unposted_workload' ELSE 'unposted_lag' END AS type, {sql_money('SUM(amount)')} AS amount
FROM lines GROUP BY ALL""")
def a3(t: Tables) -> DataFrame:
    typed = D.bank_lines(t).withColumn("type", F.when(F.col("payment_id") == 1, "unposted_workload").otherwise("unposted_lag"))
    return with_money(A.sum_by(typed, ["sheet_date", "type"], ["amount"]), "amount")


@query("a4_sum_by_six_keys", """SELECT l_returnflag, l_linestatus, l_linenumber, l_suppkey, l_discount, l_tax, CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
FROM lineitem GROUP BY ALL""")
def a4(t: Tables) -> DataFrame:
    rows = t.lineitem.withColumn("quantity", F.col("l_quantity").cast("bigint"))
    return A.sum_by(rows, ["l_returnflag", "l_linestatus", "l_linenumber", "l_suppkey", "l_discount", "l_tax"], ["quantity"])


@query("a5_two_level_sum", D.with_tables(D.LINES) + f"""
SELECT sheet_date, {sql_money('SUM(a)')} AS amount FROM (SELECT sheet_date, merch_facility_group_id, SUM(amount) AS a FROM lines
WHERE merch_facility_group_id IS NOT NULL GROUP BY ALL) GROUP BY ALL""")
def a5(t: Tables) -> DataFrame:
    return with_money(A.two_level_sum(D.bank_lines(t), ["sheet_date", "merch_facility_group_id"], ["sheet_date"], "amount"), "amount")


@query("a6_extent", D.with_tables(D.LINES) + "SELECT min(sheet_date) AS lo, max(sheet_date) AS hi FROM lines")
def a6(t: Tables) -> DataFrame:
    return A.extent(D.bank_lines(t), "sheet_date")


@query("a7_count_in_range", D.with_tables(D.LINES) + """
SELECT count(*) AS n_rows, count(*) FILTER (WHERE sheet_date BETWEEN DATE '1997-01-01' AND DATE '1997-12-31') AS n_in_range FROM lines""")
def a7(t: Tables) -> DataFrame:
    return A.count_in_range(D.bank_lines(t), "sheet_date", "1997-01-01", "1997-12-31")


@query("a8_distinct_keys", "SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem")
def a8(t: Tables) -> DataFrame:
    return A.distinct_keys(t.lineitem, "l_suppkey", "l_returnflag")


@query("a9_one_per_key", """SELECT l_orderkey, l_linestatus, l_partkey, l_shipdate FROM (SELECT *, row_number() OVER (
PARTITION BY l_orderkey ORDER BY l_linestatus, l_partkey, l_shipdate) AS r FROM lineitem) WHERE r = 1""")
def a9(t: Tables) -> DataFrame:
    return A.one_per_key(t.lineitem, ["l_orderkey"], ["l_linestatus", "l_partkey", "l_shipdate"])


@query("a10_first_last_by", """SELECT f.*, l.event_type, l.value FROM (SELECT user_id, CAST(ts AS DATE) AS day, min(ts) AS first_ts, max(ts) AS last_ts FROM events GROUP BY ALL) f
JOIN (SELECT user_id, CAST(ts AS DATE) AS day, event_type, value, row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE)
  ORDER BY ts DESC, event_type DESC, value DESC) AS r FROM events) l ON l.user_id = f.user_id AND l.day = f.day AND l.r = 1""")
def a10(t: Tables) -> DataFrame:
    days = t.events.withColumn("day", F.col("ts").cast("date"))
    latest = A.latest_by(days, ["user_id", "day"], "ts", ["event_type", "value"]).drop("ts")
    return A.first_last_by(days, ["user_id", "day"], "ts").join(latest, ["user_id", "day"])


@query("a11_value_at_top", """SELECT l_orderkey, max(l_extendedprice) FILTER (WHERE r = 1) AS price FROM (SELECT l_orderkey, l_extendedprice,
row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_extendedprice DESC) AS r FROM lineitem) GROUP BY ALL""")
def a11(t: Tables) -> DataFrame:
    return A.value_at_top(t.lineitem, ["l_orderkey"], "l_shipdate", "l_extendedprice", "price")


MEASURE_VALUES = ["amount", "posted_nodb_pmt", "unposted_workload", "unposted_lag", "never_seen"]
LONG_SQL = """long AS (SELECT sheet_date, CASE payment_id WHEN 1 THEN 'unposted_workload' WHEN 3 THEN 'posted_nodb_pmt' WHEN 4 THEN 'posted_nodb_pmt'
  ELSE 'unposted_lag' END AS type, amount FROM lines UNION ALL SELECT sheet_date, 'amount', amount FROM lines)"""


def _long(t: Tables) -> DataFrame:
    code = F.col("payment_id")
    kind = F.when(code == 1, "unposted_workload").when(code.isin(3, 4), "posted_nodb_pmt").otherwise("unposted_lag")
    both = F.array(kind, F.lit("amount"))
    return D.bank_lines(t).select("sheet_date", F.explode(both).alias("type"), "amount")


def _cell(value: str) -> str:
    total = f"coalesce(SUM(amount) FILTER (WHERE type = '{value}'), 0)"
    return f"{sql_money(total)} AS {value}"


@query("a12_pivot_fixed", D.with_tables(D.LINES, LONG_SQL)
       + f"SELECT sheet_date, {', '.join(map(_cell, MEASURE_VALUES))} FROM long GROUP BY ALL")
def a12(t: Tables) -> DataFrame:
    return with_money(A.pivot_fixed(_long(t), ["sheet_date"], "type", MEASURE_VALUES, "amount"), *MEASURE_VALUES)


@query("a13_absent_category_rows", D.with_tables(D.LINES, LONG_SQL) + f"""
SELECT d.sheet_date, v.type, {sql_money('coalesce(SUM(l.amount), 0)')} AS amount FROM (SELECT DISTINCT sheet_date FROM long) d
CROSS JOIN (VALUES ('amount'), ('posted_nodb_pmt'), ('unposted_workload'), ('unposted_lag'), ('never_seen')) v(type)
LEFT JOIN long l ON l.sheet_date = d.sheet_date AND l.type = v.type GROUP BY ALL""")
def a13(t: Tables) -> DataFrame:
    wide = A.pivot_fixed(_long(t), ["sheet_date"], "type", MEASURE_VALUES, "amount")
    return with_money(A.unpivot_plans(wide, ["sheet_date"], "type", "amount"), "amount")


@query("a14_unpivot", D.with_tables(D.FEE_SHEET) + """
SELECT cpt_code, 'plan_a' AS fee_plan, plan_a AS fee FROM sheet UNION ALL SELECT cpt_code, 'plan_b', plan_b FROM sheet
UNION ALL SELECT cpt_code, 'plan_c', plan_c FROM sheet""")
def a14(t: Tables) -> DataFrame:
    sheet = D.fee_sheet(t).withColumn("cpt_code", F.col("cpt_code").cast("string")).select("cpt_code", "plan_a", "plan_b", "plan_c")
    return A.unpivot_plans(sheet, ["cpt_code"], "fee_plan", "fee")


@query("a15_coverage_counts", """SELECT count(*) AS registered, CAST(SUM(seen) AS BIGINT) AS present, count(*) - CAST(SUM(seen) AS BIGINT) AS missing FROM (
SELECT CASE WHEN o_orderkey IN (SELECT l_orderkey FROM lineitem) THEN 1 ELSE 0 END AS seen FROM orders)""")
def a15(t: Tables) -> DataFrame:
    return A.coverage_counts(J.presence_join(t.orders, t.lineitem, "o_orderkey", "l_orderkey", "read"), "read")


# ---- ranking and numbering ------------------------------------------------------------------------


@query("w1_category_rank", "SELECT o_orderkey, CAST(dense_rank() OVER (ORDER BY o_orderdate) - 1 AS INT) AS day_rank FROM orders")
def w1(t: Tables) -> DataFrame:
    return W.category_rank(t.orders.select("o_orderkey", "o_orderdate"), "o_orderdate", "day_rank").select("o_orderkey", "day_rank")


@query("w2_first_value", """SELECT event_id, first_value(value) OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, value) AS first_value,
first_value(value) OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, value DESC) AS last_value FROM events""")
def w2(t: Tables) -> DataFrame:
    days = t.events.withColumn("day", F.col("ts").cast("date"))
    return W.attach_first_last(days, ["user_id", "day"], "ts", "value", "first_value", "last_value") \
        .select("event_id", "first_value", "last_value")


@query("w3_group_min_max", f"""SELECT {LINE_KEYS}, min(l_shipdate) OVER (PARTITION BY l_orderkey) AS lo, max(l_shipdate) OVER (PARTITION BY l_orderkey) AS hi FROM lineitem""")
def w3(t: Tables) -> DataFrame:
    return W.attach_group_values(t.lineitem, ["l_orderkey"], lo=F.min("l_shipdate"), hi=F.max("l_shipdate")).select(*LINE_KEY_LIST, "lo", "hi")


TOP_SQL = """SELECT l_orderkey, l_shipdate, l_extendedprice, l_partkey FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey
ORDER BY l_shipdate DESC, l_extendedprice DESC, l_partkey DESC) AS r FROM lineitem) WHERE r = 1"""


@query("w4_top_row", TOP_SQL)
def w4(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", "l_shipdate", "l_extendedprice", "l_partkey")
    return W.top_row(rows, ["l_orderkey"], [F.col("l_shipdate").desc(), F.col("l_extendedprice").desc(), F.col("l_partkey").desc()])


@query("w5_dense_row_id", "SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS row_id, o_orderkey FROM orders")
def w5(t: Tables) -> DataFrame:
    return W.dense_row_id(t.orders.select("o_orderdate", "o_orderkey"), ["o_orderdate", "o_orderkey"], "row_id").select("row_id", "o_orderkey")


@query("w5_lasting_ids", """WITH k AS (SELECT o_custkey AS k, bool_or(o_orderstatus = 'F') AS early FROM orders GROUP BY ALL),
ids AS (SELECT k, row_number() OVER (ORDER BY NOT early, k) AS customer_id FROM k)
SELECT o_orderkey, customer_id FROM orders JOIN ids ON k = o_custkey""")
def w5_lasting(t: Tables) -> DataFrame:
    """Customers of one class of orders come first; the load of all orders keeps their ids, and a third one changes none."""
    table, rows = VersionedTable(t.spark, run_folder(t.spark, "customer_ids")), t.orders.select("o_orderkey", "o_custkey", "o_orderstatus")
    for load in (rows.where(F.col("o_orderstatus") == "F"), rows, rows):
        found = lasting_ids(load, ["o_custkey"], table, "customer_id")
    return found.select("o_orderkey", "customer_id")


# ---- order and limit ------------------------------------------------------------------------------


@query("o1_order_by_facility", D.with_tables(D.DETAIL) + "SELECT DISTINCT posted_facility_group_id AS facility_group_id FROM detail ORDER BY 1")
def o1(t: Tables) -> DataFrame:
    ids = D.payment_details(t).select(F.col("posted_facility_group_id").alias("facility_group_id")).distinct()
    return W.ordered(ids, "facility_group_id")


@query("o2_order_by_date_facility", D.with_tables(D.LINES) + f"""
SELECT sheet_date, merch_facility_group_id, {sql_money('SUM(amount)')} AS amount FROM lines WHERE merch_facility_group_id IS NOT NULL
GROUP BY ALL ORDER BY sheet_date, merch_facility_group_id""")
def o2(t: Tables) -> DataFrame:
    return W.ordered(a2(t), "sheet_date", "merch_facility_group_id")


@query("o3_top_per_group", """SELECT user_id, date_trunc('month', ts) AS ts, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id
ORDER BY date_trunc('month', ts) DESC, event_type DESC, value DESC) AS r FROM events) WHERE r = 1""")
def o3(t: Tables) -> DataFrame:
    months = t.events.withColumn("ts", F.date_trunc("month", "ts"))  # many ties
    return A.latest_by(months, ["user_id"], "ts", ["event_type", "value"])


@query("o5_hash_sample", f"""SELECT {LINE_KEYS} FROM lineitem
WHERE substr(md5(concat_ws(',', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR))), 1, 4) < '028f'""")
def o5(t: Tables) -> DataFrame:
    return W.hash_sample(t.lineitem.select(*LINE_KEY_LIST), ["l_orderkey", "l_linenumber"], 0.01)


# ---- set operators --------------------------------------------------------------------------------


@query("u1_union_by_name", """SELECT o_orderkey AS id, o_orderstatus AS status, CAST(NULL AS VARCHAR) AS kind FROM orders
UNION ALL SELECT event_id, NULL, event_type FROM events UNION ALL SELECT doc_id, lang, source FROM documents""")
def u1(t: Tables) -> DataFrame:
    return J.union_by_name(t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status")),
                           t.events.select(F.col("event_id").alias("id"), F.col("event_type").alias("kind")),
                           t.documents.select(F.col("source").alias("kind"), F.col("lang").alias("status"), F.col("doc_id").alias("id")))


@query("u2_union_same_shape", """SELECT l_orderkey AS k, l_quantity AS v FROM lineitem UNION ALL SELECT o_orderkey, o_totalprice FROM orders
UNION ALL SELECT p_partkey, p_retailprice FROM part""")
def u2(t: Tables) -> DataFrame:
    return J.union_by_name(t.lineitem.select(F.col("l_orderkey").alias("k"), F.col("l_quantity").alias("v")),
                           t.orders.select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("v")),
                           t.part.select(F.col("p_partkey").alias("k"), F.col("p_retailprice").alias("v")))


@query("u3_difference_by_key", "SELECT p_partkey, p_name FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_discount = 0.1)")
def u3(t: Tables) -> DataFrame:
    used = t.lineitem.where(F.col("l_discount") == 0.1).select(F.col("l_partkey").alias("p_partkey"))
    return J.drop_if_in(t.part.select("p_partkey", "p_name"), used, ["p_partkey"])

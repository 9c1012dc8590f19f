"""Queries over sources and sinks. A sink query returns the state read back after the write."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsledger.catalog import domain as D
from opsledger.catalog.registry import Tables, query, sql_money, with_money
from opsledger.operators.mutations import in_range, purge_audit, upsert_by_key
from opsledger.session import literal_table, run_folder
from opsledger.sources import readers, sheets, writers
from opsledger.sources.versions import VersionedTable
from opsledger.streaming.ingest import ingest_available_now

# ---- sources --------------------------------------------------------------------------------------


@query("s1_read_delimited", """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_mktsegment, CAST(c_nationkey AS VARCHAR) AS c_nationkey FROM customer""")
def s1(t: Tables) -> DataFrame:
    path = run_folder(t.spark, "customer_text")
    t.customer.select("c_custkey", "c_name", "c_mktsegment", "c_nationkey").write \
        .options(header=True, sep="\t", encoding="UTF-16LE", lineSep="\n").csv(path)
    return readers.read_delimited(t.spark, path, encoding="UTF-16LE")


def _sheet_config(t: Tables) -> DataFrame:
    """Three layouts: W and the single sheets, G, and C; S11 is registered but not active, S99 is never delivered."""
    layouts = literal_table(t.spark, {"layout": "string", "date_name": "string", "text_name": "string", "amount_name": "string"}, [
        ("plain", "sheet_date", "description", "amount"), ("posted", "Post Date", "Memo", "Net"), ("check", "Post Date", "description", "amount")])
    names = [("W", 1, 0, "plain", 1), ("G", 5, 0, "posted", 1), ("C", 9, 1, "check", 1), ("S99", 99, 0, "plain", 1), ("S11", 11, 0, "plain", 0)]
    names += [(f"S{f:02d}", f, 0, "plain", 1) for f in (4, 12, 13, 15, 14, 18)]
    registered = literal_table(t.spark, {"sheetname": "string", "facility_group_id": "bigint", "check_account": "int",
                                         "layout": "string", "is_active": "int"}, names)
    reads = F.array("date_name", "text_name", "amount_name")
    renames = F.map_from_arrays(reads, F.array(F.lit("sheet_date"), F.lit("description"), F.lit("amount")))
    return registered.join(layouts, "layout").select(
        "sheetname", "facility_group_id", "check_account",
        F.struct(reads.alias("read_columns"), renames.alias("rename_columns")).alias("lecture_parameters"), "is_active")


def _workbook_rows(t: Tables) -> DataFrame:
    """All sheets as one table of raw text columns; each sheet fills only its own."""
    rows = D.bank_lines(t)
    sheet = F.col("sheetname")
    date, memo, amount = F.col("sheet_date").cast("string"), F.concat(F.lit("memo "), F.col("line_id").cast("string")), F.col("amount").cast("string")
    return rows.select(
        "sheetname", F.when(~sheet.isin("G", "C"), date).alias("sheet_date"), F.when(sheet.isin("G", "C"), date).alias("Post Date"),
        F.when(sheet != "G", memo).alias("description"), F.when(sheet == "G", memo).alias("Memo"),
        F.when(sheet != "G", amount).otherwise("0.00").alias("amount"), F.when(sheet == "G", amount).alias("Net"))


@query("s2_read_workbook_sheets", D.with_tables(D.LINES) + """
SELECT CAST(sheet_date AS VARCHAR) AS sheet_date, 'memo ' || line_id AS description, CAST(amount AS VARCHAR) AS amount, sheetname,
  CASE sheetname WHEN 'W' THEN 1 WHEN 'G' THEN 5 WHEN 'C' THEN 9 ELSE CAST(substr(sheetname, 2) AS BIGINT) END AS sheet_facility_group_id,
  CASE WHEN sheetname = 'C' THEN 1 ELSE 0 END AS check_account FROM lines WHERE sheetname <> 'S11'""")
def s2(t: Tables) -> DataFrame:
    return sheets.read_sheets(_workbook_rows(t), _sheet_config(t), ["sheet_date", "description", "amount"])


@query("s3_sheet_coverage", D.with_tables(D.LINES) + """
SELECT r.s AS sheetname, CASE WHEN r.s IN (SELECT sheetname FROM lines) THEN 1 ELSE 0 END AS read FROM (VALUES ('W'), ('G'), ('C'), ('S99'), ('S11'),
  ('S04'), ('S12'), ('S13'), ('S15'), ('S14'), ('S18')) r(s)""")
def s3(t: Tables) -> DataFrame:
    return sheets.sheet_coverage(_sheet_config(t), D.bank_lines(t)).select("sheetname", "read")


@query("s4_read_with_provenance", """SELECT o_orderkey, 'orders.parquet' AS source_file FROM orders UNION ALL SELECT p_partkey, 'part.parquet' FROM part""")
def s4(t: Tables) -> DataFrame:
    orders = readers.read_many_with_provenance(t.spark, t.path("orders"), "parquet").select("o_orderkey", "source_file")
    part = readers.read_many_with_provenance(t.spark, t.path("part"), "parquet").select(F.col("p_partkey").alias("o_orderkey"), "source_file")
    return orders.unionByName(part)


@query("s5_pick_sheet", D.with_tables(D.LINES) + """
SELECT 'named' AS rule, line_id, sheetname FROM lines WHERE sheetname = 'G'
UNION ALL SELECT 'first', line_id, sheetname FROM lines WHERE sheetname = (SELECT min(sheetname) FROM lines)""")
def s5(t: Tables) -> DataFrame:
    rows = D.bank_lines(t).select("line_id", "sheetname", F.col("sheetname").alias("position"))
    named = sheets.pick_sheet(rows, "G").select(F.lit("named").alias("rule"), "line_id", "sheetname")
    first = sheets.pick_sheet(rows, "Sheet1").select(F.lit("first").alias("rule"), "line_id", "sheetname")
    return named.unionByName(first)


@query("s6_read_single_csv", "SELECT n_name, count(c_custkey) AS customers FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY ALL")
def s6(t: Tables) -> DataFrame:
    path = run_folder(t.spark, "nation_csv")
    t.nation.coalesce(1).write.option("header", True).csv(path)  # one file is what this source asks for
    nation = readers.read_single_csv(t.spark, path).select(F.col("n_nationkey").cast("int").alias("c_nationkey"), "n_name")
    counts = t.customer.groupBy("c_nationkey").agg(F.count("c_custkey").alias("customers"))
    return nation.join(counts, "c_nationkey", "left").select("n_name", F.coalesce("customers", F.lit(0)).alias("customers"))


@query("s7_read_parquet_checked", "SELECT l_orderkey, l_partkey, l_suppkey, l_quantity FROM lineitem")
def s7(t: Tables) -> DataFrame:
    names = ["l_orderkey", "l_partkey", "l_suppkey", "l_quantity"]
    return readers.read_parquet_checked(t.spark, t.path("lineitem"), names).select(*names)


@query("s8_read_partition", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderstatus = 'P'")
def s8(t: Tables) -> DataFrame:
    path = run_folder(t.spark, "orders_by_status")
    writers.write_partitioned(t.orders.select("o_orderkey", "o_custkey", "o_orderstatus"), path, "o_orderstatus")
    return readers.read_partition(t.spark, path, "o_orderstatus", "P")


@query("s10_require_single_input", "SELECT CAST(1 AS BIGINT) AS n_files, 1 AS single_input FROM (SELECT count(*) FROM lineitem)")
def s10(t: Tables) -> DataFrame:
    return readers.input_audit(t.lineitem)


@query("s11_table_scan", "SELECT s_suppkey, s_nationkey FROM supplier UNION ALL SELECT c_custkey, c_nationkey FROM customer")
def s11(t: Tables) -> DataFrame:
    t.supplier.createOrReplaceTempView("opsledger_supplier")
    t.customer.createOrReplaceTempView("opsledger_customer")
    customer = readers.table_scan(t.spark, "opsledger_customer", ["c_custkey", "c_nationkey"]).toDF("s_suppkey", "s_nationkey")
    return readers.table_scan(t.spark, "opsledger_supplier", ["s_suppkey", "s_nationkey"]).unionByName(customer)


# ---- sinks ----------------------------------------------------------------------------------------


@query("k1_replace_table", "SELECT o_orderkey, o_orderstatus FROM orders")
def k1(t: Tables) -> DataFrame:
    path, rows = run_folder(t.spark, "replaced"), t.orders.select("o_orderkey", "o_orderstatus")
    writers.replace_table(rows.where(F.col("o_orderstatus") == "F"), path)
    writers.replace_table(rows, path, refuse_empty=True)
    return writers.read_table(t.spark, path)


@query("k2_append_table", "SELECT o_orderkey, o_orderstatus FROM orders UNION ALL SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'")
def k2(t: Tables) -> DataFrame:
    path, rows = run_folder(t.spark, "appended"), t.orders.select("o_orderkey", "o_orderstatus")
    writers.replace_table(rows, path)
    writers.append_table(rows.where(F.col("o_orderstatus") == "F"), path)
    return writers.read_table(t.spark, path)


# Lines of one class have no date; one sheet is delivered again with new amounts.
UPSERT_SQL = """old AS (SELECT line_id, CASE WHEN payment_id <> 3 THEN sheet_date END AS sheet_date, amount FROM lines),
new AS (SELECT line_id, CASE WHEN payment_id <> 3 THEN sheet_date END AS sheet_date, amount + 1 AS amount FROM lines WHERE sheetname = 'G')"""


def _upsert_sides(t: Tables) -> tuple[DataFrame, DataFrame]:
    rows = D.bank_lines(t).withColumn("sheet_date", F.when(F.col("payment_id") != 3, F.col("sheet_date")))
    old = rows.select("line_id", "sheet_date", "amount")
    new = rows.where(F.col("sheetname") == "G").select("line_id", "sheet_date", (F.col("amount") + 1).cast("decimal(18,2)").alias("amount"))
    return old, new


@query("k5_upsert_by_key", D.with_tables(D.LINES, UPSERT_SQL) + f"""
SELECT line_id, sheet_date, {sql_money('amount')} AS amount FROM old o WHERE NOT EXISTS (SELECT 1 FROM new n WHERE n.sheet_date = o.sheet_date)
UNION ALL SELECT line_id, sheet_date, {sql_money('amount')} FROM new""")
def k5(t: Tables) -> DataFrame:
    old, new = _upsert_sides(t)
    return with_money(upsert_by_key(old, new, ["sheet_date"]), "amount")


KEYED_SQL = """old AS (SELECT line_id, CASE WHEN payment_id <> 3 THEN year(sheet_date) * 100 + month(sheet_date) END AS period, amount
  FROM lines),
new AS (SELECT line_id, CASE WHEN payment_id <> 3 THEN year(sheet_date) * 100 + month(sheet_date) END AS period, amount + 1 AS amount
  FROM lines WHERE sheetname = 'G')"""


@query("k5_upsert_stored_partitions", D.with_tables(D.LINES, KEYED_SQL) + f"""
SELECT line_id, CAST(period AS INT) AS period, {sql_money('amount')} AS amount FROM old o WHERE NOT EXISTS (SELECT 1 FROM new n WHERE n.period = o.period)
UNION ALL SELECT line_id, CAST(period AS INT), {sql_money('amount')} FROM new""")
def k5_stored(t: Tables) -> DataFrame:
    path = run_folder(t.spark, "upserted")
    period = F.when(F.col("payment_id") != 3, F.year("sheet_date") * 100 + F.month("sheet_date"))
    rows = D.bank_lines(t).withColumn("period", period)
    old = rows.select("line_id", "period", "amount")
    new = rows.where(F.col("sheetname") == "G").select(
        "line_id", "period", (F.col("amount") + 1).cast("decimal(18,2)").alias("amount"))
    for load_id, load in ((0, old), (1, new), (1, new)):  # the second load is run again
        writers.load_by_key(load, load_id, path, "period")
    return with_money(writers.read_table(t.spark, path), "amount")


@query("k6_purge_range", D.with_tables(D.LINES, UPSERT_SQL) + f"""
SELECT line_id, sheet_date FROM old WHERE sheet_date IS NULL OR NOT sheet_date BETWEEN DATE '{D.PURGE_START}' AND DATE '{D.PURGE_END}'""")
def k6(t: Tables) -> DataFrame:
    path = run_folder(t.spark, "purged")
    writers.replace_table(_upsert_sides(t)[0].select("line_id", "sheet_date"), path)
    VersionedTable(t.spark, path).remove(in_range("sheet_date", D.PURGE_START, D.PURGE_END))
    return writers.read_table(t.spark, path)


AUDITED = {"orders": "o_orderdate", "lineitem": "l_shipdate", "events": "ts"}


@query("k7_purge_audit", "\nUNION ALL ".join(f"""SELECT '{n}' AS table_name, count(*) AS rows_before,
  count(*) FILTER (WHERE CAST({c} AS DATE) BETWEEN DATE '1997-02-01' AND DATE '2024-01-10') AS rows_purged,
  count(*) FILTER (WHERE NOT CAST({c} AS DATE) BETWEEN DATE '1997-02-01' AND DATE '2024-01-10') AS rows_after FROM {n}""" for n, c in AUDITED.items()))
def k7(t: Tables) -> DataFrame:
    dated = {n: (getattr(t, n).select(F.col(c).cast("date").alias("day")), "day") for n, c in AUDITED.items()}
    return purge_audit(dated, "1997-02-01", "2024-01-10")


@query("k8_write_partitioned", """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN -1.0 ELSE o_totalprice END AS price, o_orderstatus AS process_part FROM orders""")
def k8(t: Tables) -> DataFrame:
    path = run_folder(t.spark, "by_part")
    rows = t.orders.select("o_orderkey", F.col("o_totalprice").alias("price"), F.col("o_orderstatus").alias("process_part"))
    writers.write_partitioned(rows, path, "process_part")
    again = rows.where(F.col("process_part") == "F").withColumn("price", F.lit(-1.0))
    writers.write_partitioned(again, path, "process_part")
    return t.spark.read.parquet(path)


@query("k9_size_based_partitions", """SELECT n_rows, avg_row_bytes, round(n_rows * avg_row_bytes / (1024 * 1024), 2) AS size_mb,
  CAST(greatest(ceil(round(n_rows * avg_row_bytes / (1024 * 1024), 2) / 0.01), 1) AS INT) AS n_partitions FROM (
  SELECT count(*) AS n_rows, CAST(sum(strlen(CAST(to_json({'l_orderkey': l_orderkey, 'l_linenumber': l_linenumber, 'l_returnflag': l_returnflag}) AS VARCHAR))) AS DOUBLE)
    / count(*) AS avg_row_bytes FROM lineitem)""")
def k9(t: Tables) -> DataFrame:
    return writers.size_report(t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag"), target_mb=0.01)


INGEST_SQL = """drops AS (SELECT o_orderkey AS line_id, CASE WHEN o_orderpriority <> '5-LOW' THEN year(o_orderdate) * 100 + month(o_orderdate) END AS period,
  o_orderstatus AS s FROM orders), first AS (SELECT line_id, period, 1 AS delivery FROM drops WHERE s <> 'P'),
second AS (SELECT line_id, period, 2 AS delivery FROM drops WHERE s = 'P')"""


@query("k10_incremental_batch_ingest", D.with_tables(INGEST_SQL) + """
SELECT line_id, CAST(period AS INT) AS period, delivery FROM first WHERE period IS NULL OR period NOT IN (SELECT period FROM second WHERE period IS NOT NULL)
UNION ALL SELECT line_id, CAST(period AS INT), delivery FROM second""")
def k10(t: Tables) -> DataFrame:
    """Two deliveries, each followed by a run, then a run without anything new."""
    source, target, checkpoint = (run_folder(t.spark, n) for n in ("drops", "ingested", "stream_state"))
    period = F.when(F.col("o_orderpriority") != "5-LOW", F.year("o_orderdate") * 100 + F.month("o_orderdate"))
    rows = t.orders.select(F.col("o_orderkey").alias("line_id"), period.alias("period"), F.col("o_orderstatus").alias("s"))
    first = rows.where(F.col("s") != "P").withColumn("delivery", F.lit(1))
    second = rows.where(F.col("s") == "P").withColumn("delivery", F.lit(2))
    schema = T.StructType.fromDDL("line_id bigint, period int, delivery int")
    for delivery in (first, second, None):
        if delivery is not None:
            delivery.drop("s").write.mode("append").parquet(source)
        ingest_available_now(t.spark, source, target, checkpoint, "period", schema)
    return writers.read_table(t.spark, target)


@query("k10_ingest_contents_once", D.with_tables(INGEST_SQL) + """
SELECT line_id, CAST(period AS INT) AS period, delivery FROM first WHERE period IS NULL OR period NOT IN (SELECT period FROM second WHERE period IS NOT NULL)
UNION ALL SELECT line_id, CAST(period AS INT), delivery FROM second""")
def k10_contents(t: Tables) -> DataFrame:
    """The first delivery comes twice under different names, then the second one with the first once more."""
    source, target, checkpoint, ledger = (run_folder(t.spark, n) for n in ("drops", "ingested", "stream_state", "contents"))
    period = F.when(F.col("o_orderpriority") != "5-LOW", F.year("o_orderdate") * 100 + F.month("o_orderdate"))
    rows = t.orders.select(F.col("o_orderkey").alias("line_id"), period.alias("period"), F.when(F.col("o_orderstatus") == "P", 2).otherwise(1)
                           .alias("delivery"))
    first, second = rows.where("delivery = 1"), rows.where("delivery = 2")
    for delivery in ((first, first), (second, first)):
        for part in delivery:
            part.write.mode("append").parquet(source)
        ingest_available_now(t.spark, source, target, checkpoint, "period", T.StructType.fromDDL("line_id bigint, period int, delivery int"),
                             contents=ledger)
    return writers.read_table(t.spark, target)

"""Sources, sinks, keyed replacement, purges and incremental ingest."""

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsledger import session as S
from opsledger.operators import mutations as M
from opsledger.plans import documents, maintenance
from opsledger.sources import readers, sheets, writers
from opsledger.streaming.ingest import ingest_available_now

D = dt.date


def rows(df):
    return Counter(tuple(r) for r in df.collect())


# ---- readers --------------------------------------------------------------------------------------

@pytest.mark.parametrize("encoding, data", [("UTF-16", "utf-16"), ("UTF-16LE", "utf-16-le"), ("UTF-8", "utf-8")])
def test_delimited_encodings(spark, tmp_path, encoding, data):
    text = "id\tname\n1\tJosé\n2\tZoë\n"
    (tmp_path / "a.tsv").write_bytes(text.encode(data))
    df = readers.read_delimited(spark, str(tmp_path), encoding=encoding)
    assert df.columns == ["id", "name"] and rows(df) == Counter([("1", "José"), ("2", "Zoë")])
    assert {f.dataType for f in df.schema.fields} == {T.StringType()}


def test_delimited_byte_order_mark_in_split_mode(spark, tmp_path):
    (tmp_path / "a.tsv").write_bytes("\uFEFFid\tname\n1\tx\n".encode("utf-16-le"))
    assert readers.read_delimited(spark, str(tmp_path), encoding="UTF-16LE").columns == ["id", "name"]


def test_provenance_and_single_input(spark, tmp_path):
    for name in ("a.csv", "b.csv"):
        (tmp_path / name).write_text("v\n1\n")
    df = readers.read_many_with_provenance(spark, str(tmp_path), "csv", header=True)
    assert sorted(r.source_file for r in df.collect()) == ["a.csv", "b.csv"]
    with pytest.raises(ValueError, match="one input file"):
        readers.read_single_csv(spark, str(tmp_path))
    assert readers.read_single_csv(spark, str(tmp_path / "a.csv")).count() == 1
    assert readers.input_audit(spark.read.csv(str(tmp_path))).first() == (2, 0)


def test_single_input_wants_the_suffix(spark, tmp_path):
    (tmp_path / "a.txt").write_text("v\n1\n")
    with pytest.raises(ValueError, match="expected a .csv"):
        readers.read_single_csv(spark, str(tmp_path))


def test_checked_parquet_and_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.write_partitioned(spark.range(4).withColumn("process_date", F.when(F.col("id") < 2, F.lit(D(2024, 1, 1))).otherwise(F.lit(D(2024, 1, 2)))),
                              path, "process_date")
    with pytest.raises(ValueError, match="nope"):
        readers.read_parquet_checked(spark, path, ["id", "nope"])
    part = readers.read_partition(spark, path, "process_date", D(2024, 1, 2))
    assert rows(part) == Counter([(2, D(2024, 1, 2)), (3, D(2024, 1, 2))])
    assert "PartitionFilters: [isnotnull(process_date" in part._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(FileNotFoundError):
        readers.read_partition(spark, path, "process_date", D(2024, 1, 3))


def test_jdbc_options():
    plain = readers.jdbc_read_options("u", "a", "b", query="SELECT 1;")
    assert plain["query"] == "SELECT 1" and plain["fetchsize"] == "10000" and "numPartitions" not in plain
    split = readers.jdbc_read_options("u", "a", "b", query="SELECT * FROM t ;", partition_column="id", partitions=8)
    assert split["dbtable"] == "(SELECT * FROM t) AS q" and split["numPartitions"] == "8" and "query" not in split
    assert readers.jdbc_read_options("u", "a", "b", table="t")["dbtable"] == "t"
    with pytest.raises(ValueError):
        readers.jdbc_read_options("u", "a", "b")
    assert readers.jdbc_url("h", 1, "d") == "jdbc:postgresql://h:1/d"
    written = writers.jdbc_write_options("u", "t", "a", "b", partitions=4)
    assert written["truncate"] == "true" and written["batchsize"] == "10000" and written["numPartitions"] == "4"
    assert not {"partitionColumn", "lowerBound", "upperBound"} & set(written)


def test_pick_sheet(spark):
    data = spark.createDataFrame([("B", 2, "b"), ("A", 3, "a"), ("C", 1, "c")], "sheetname string, position int, v string")
    assert [r.v for r in sheets.pick_sheet(data, "A").collect()] == ["a"]
    assert [r.v for r in sheets.pick_sheet(data, "Sheet1").collect()] == ["c"]


def test_sheets_follow_their_layout(spark):
    config = spark.createDataFrame([
        ("A", 1, 0, (["d", "x"], {"d": "sheet_date", "x": "amount"}), 1), ("B", 2, 1, (["amount"], {}), 1),
        ("OFF", 3, 0, (["amount"], {}), 0), ("GONE", 4, 0, (["amount"], {}), 1)], sheets.CONFIG_SCHEMA)
    data = spark.createDataFrame([("A", "2024", "5", "6"), ("B", "2025", "7", "8"), ("OFF", "1", "1", "1"), ("NEW", "1", "1", "1")],
                                 "sheetname string, d string, x string, amount string")
    out = sheets.read_sheets(data, config, ["sheet_date", "amount"])
    assert rows(out) == Counter([("2024", "5", "A", 1, 0), (None, "8", "B", 2, 1)])
    assert {(r.sheetname, r.read) for r in sheets.sheet_coverage(config, data).collect()} == {("A", 1), ("B", 1), ("OFF", 1), ("GONE", 0)}


# ---- writers --------------------------------------------------------------------------------------

def test_replace_refuses_empty(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.replace_table(spark.range(3), path)
    with pytest.raises(ValueError, match="empty"):
        writers.replace_table(spark.range(0), path, refuse_empty=True)
    assert writers.read_table(spark, path).count() == 3
    writers.append_table(spark.range(2), path)
    assert writers.read_table(spark, path).count() == 5


def test_partition_write_keeps_other_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    for day, n in ((1, 3), (2, 4), (1, 1)):
        writers.write_partitioned(spark.range(n).withColumn("process_date", F.lit(day)), path, "process_date", files_per_partition=2)
    assert {r.process_date: r["count"] for r in spark.read.parquet(path).groupBy("process_date").count().collect()} == {1: 1, 2: 4}


@pytest.mark.parametrize("n, wide, wanted", [(0, 1, 1), (5, 1, 1), (2000, 1000, 2)])
def test_partition_sizes(spark, n, wide, wanted):
    df = spark.range(n).withColumn("s", F.repeat(F.lit("x"), wide))
    assert writers.size_based_partitions(df, target_mb=1, fraction=None) == wanted


def test_sampled_size_counts_exactly(spark):
    report = writers.size_report(spark.range(50_000), fraction=0.05).first()
    assert report.n_rows == 50_000 and 5 < report.avg_row_bytes < 15


def test_document_store_is_split_by_size(spark, tmp_path):
    path = str(tmp_path / "t")
    docs = spark.range(1000).select(F.col("id").cast("string").alias("Document ID"))
    documents.store_documents(documents.document_feed(docs, D(2024, 1, 5)), path)
    assert rows(readers.read_partition(spark, path, "process_date", D(2024, 1, 5)).select("document_id")) == Counter((str(i),) for i in range(1000))


def test_shared_folder_comes_from_the_session(spark):
    assert S.run_folder(spark, "x").startswith(S.shared_folder(spark))
    assert S.run_folder(spark, "x") != S.run_folder(spark, "x")


# ---- keyed replacement and purge ------------------------------------------------------------------

def test_upsert_null_keys(spark):
    target = spark.createDataFrame([(1, "t1"), (2, "t2"), (None, "t0")], "k int, v string")
    source = spark.createDataFrame([(2, "s2"), (2, "s2b"), (3, "s3"), (None, "s0")], "k int, v string")
    wanted = Counter([(1, "t1"), (None, "t0"), (2, "s2"), (2, "s2b"), (3, "s3"), (None, "s0")])
    once = M.upsert_by_key(target, source, ["k"])
    assert rows(once) == wanted
    keyed = source.where("k is not null")
    assert rows(M.upsert_by_key(M.upsert_by_key(target, keyed, ["k"]), keyed, ["k"])) == rows(M.upsert_by_key(target, keyed, ["k"]))


def test_purge_edges_and_audit(spark):
    df = spark.createDataFrame([(D(2024, 1, d),) for d in (1, 2, 3, 4)] + [(None,)], "d date")
    assert rows(M.purge_range(df, "d", "2024-01-02", "2024-01-03")) == Counter([(D(2024, 1, 1),), (D(2024, 1, 4),), (None,)])
    assert M.purge_range(df, "d", "2024-01-03", "2024-01-02").count() == 5
    assert M.purge_audit({"t": (df, "d")}, "2024-01-02", "2024-01-03").first() == ("t", 5, 2, 3)
    assert M.purge_audit({"t": (df, "d")}, "", None).first() == ("t", 5, 0, 5)
    with pytest.raises(ValueError, match="YYYY-MM-DD"):
        M.purge_range(df, "d", "02/01/2024", "2024-01-03")


def test_stored_purge_checks_dates_before_any_write(spark, tmp_path):
    paths = {n: (str(tmp_path / n), "d") for n in ("a", "b")}
    for path, _ in paths.values():
        writers.replace_table(spark.createDataFrame([(D(2024, 1, d),) for d in (1, 2, 3)], "d date"), path)
    with pytest.raises(ValueError):
        maintenance.purge_stored(spark, paths, "2024-01-02", "soon")
    assert all(writers.read_table(spark, p).count() == 3 for p, _ in paths.values())
    audit = maintenance.purge_stored(spark, paths, "2024-01-02", "2024-01-02")
    assert [(r.table_name, r.rows_before, r.rows_purged, r.rows_after) for r in audit] == [("a", 3, 1, 2), ("b", 3, 1, 2)]
    assert all(writers.read_table(spark, p).count() == 2 for p, _ in paths.values())
    again = maintenance.purge_stored(spark, paths, "2024-01-02", "2024-01-02")
    assert [r.rows_purged for r in again] == [0, 0]


def test_target_load_modes(spark):
    text = spark.createDataFrame([("2024-01-02", " F1 ", "10.5", "1")], "` date` string, facility string, target string, facility_group_id string")
    once = maintenance.target_load(text)
    assert once.first() == ("2024-01-02", "F1", 10.5, 1)
    assert maintenance.target_load(text, once).count() == 1
    assert maintenance.target_load(text, once, replace_keys=False).count() == 2
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        maintenance.target_load(text.withColumn("target", F.lit("ten"))).collect()


# ---- incremental ingest ---------------------------------------------------------------------------

def test_ingest_once_replaces_keys_and_keeps_null_rows(spark, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("v", T.StringType())])

    def deliver(*data):
        spark.createDataFrame(list(data), schema).write.mode("append").parquet(source)
        ingest_available_now(spark, source, target, state, "k", schema)

    deliver((1, "a"), (2, "b"), (None, "n1"))
    deliver((2, "c"), (None, "n2"))
    wanted = Counter([("a", 1), ("c", 2), ("n1", None), ("n2", None)])
    assert rows(writers.read_table(spark, target).select("v", "k")) == wanted
    ingest_available_now(spark, source, target, state, "k", schema)  # nothing new
    assert rows(writers.read_table(spark, target).select("v", "k")) == wanted


def test_replayed_batch_changes_nothing(spark, tmp_path):
    target = str(tmp_path / "out")
    batch = spark.createDataFrame([(1, "a"), (None, "n")], "k int, v string")
    for _ in range(2):
        writers.load_by_key(batch, 0, target, "k")
    assert rows(writers.read_table(spark, target).select("v", "k")) == Counter([("a", 1), ("n", None)])


def test_bank_line_load_replaces_days(spark, tmp_path):
    from opsledger.plans import collections
    path = str(tmp_path / "lines")
    first = spark.createDataFrame([(D(2024, 1, 1), "a"), (D(2024, 1, 2), "b"), (None, "n")], "sheet_date date, v string")
    second = spark.createDataFrame([(D(2024, 1, 2), "c"), (D(2024, 1, 2), "d")], "sheet_date date, v string")
    collections.load_bank_lines(first, 1, path)
    out = collections.load_bank_lines(second, 2, path)
    assert rows(out.select("v", "sheet_date")) == Counter([("a", D(2024, 1, 1)), ("c", D(2024, 1, 2)), ("d", D(2024, 1, 2)), ("n", None)])


def test_contacts_go_to_every_place(spark, tmp_path):
    from opsledger.plans import contacts
    paths = [str(tmp_path / "raw"), str(tmp_path / "mart")]
    contacts.store_contacts(spark.createDataFrame([("1",)], "`Patient ID` string"), paths)
    assert [writers.read_table(spark, p).select("patient_id").first()[0] for p in paths] == [1, 1]

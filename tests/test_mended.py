"""Cases in which stored tables, whole records, hot keys and lookups once gave wrong rows."""

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsledger import session as S
from opsledger.operators import aggregates as A
from opsledger.operators import joins as J
from opsledger.operators import windows as W
from opsledger.plans import collections, maintenance
from opsledger.sources import readers, writers
from opsledger.streaming.ingest import ingest_available_now

D = dt.date


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_purge_between_two_loads_keeps_the_other_days(spark, tmp_path):
    path = str(tmp_path / "lines")

    def load(number, *days):
        data = [(D(2024, 1, d) if d else None, f"{number}:{d}") for d in days]
        collections.load_bank_lines(spark.createDataFrame(data, "sheet_date date, v string"), number, path)

    load(1, 1, 2, 3, None)
    audit = maintenance.purge_stored(spark, {"lines": (path, "sheet_date")}, "2024-01-02", "2024-01-02")
    assert tuple(audit[0]) == ("lines", 4, 1, 3)
    load(2, 3, None)
    assert {r.v for r in writers.read_table(spark, path).collect()} == {"1:1", "2:3", "1:None", "2:None"}


def test_purge_rewrites_a_partition_it_cuts(spark, tmp_path):
    path = str(tmp_path / "t")
    data = [("a", D(2024, 1, 1)), ("a", D(2024, 1, 2)), ("b", D(2024, 1, 2)), ("c", D(2024, 1, 3))]
    writers.load_by_key(spark.createDataFrame(data, "k string, d date"), 1, path, "k")
    maintenance.purge_stored(spark, {"t": (path, "d")}, "2024-01-02", "2024-01-02")
    assert rows(writers.read_table(spark, path)) == Counter([data[0], data[3]])


def test_text_keys_come_back_as_they_were(spark, tmp_path):
    path = str(tmp_path / "t")
    data = [("007", 1), ("7", 2), ("", 3), (None, 4)]
    writers.load_by_key(spark.createDataFrame(data, "k string, v int"), "x", path, "k")
    writers.load_by_key(spark.createDataFrame([("7", 5)], "k string, v int"), "y", path, "k")
    assert rows(writers.read_table(spark, path)) == Counter([("007", 1), ("7", 5), ("", 3), (None, 4)])


def test_one_text_partition_is_read_by_its_text(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.write_partitioned(spark.createDataFrame([("007", 1), ("7", 2)], "p string, v int"), path, "p")
    assert rows(readers.read_partition(spark, path, "p", "007").select("p", "v")) == Counter([("007", 1)])


def test_small_batches_are_one_delivery(spark, tmp_path):
    schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("v", T.StringType())])
    target = str(tmp_path / "out")
    for source in ("one", "two"):
        place = str(tmp_path / source)
        for part in range(3):
            spark.createDataFrame([(1, f"{source}{part}"), (None, f"n{source}{part}")], schema).coalesce(1).write.mode("append").parquet(place)
        ingest_available_now(spark, place, target, str(tmp_path / f"state_{source}"), "k", schema, files_per_batch=1)
    found = {r.v for r in writers.read_table(spark, target).collect()}
    assert found == {f"two{i}" for i in range(3)} | {f"n{s}{i}" for s in ("one", "two") for i in range(3)}


def test_records_are_whole(spark):
    df = spark.createDataFrame([(1, 5, "a", 9), (1, 5, "b", 1), (1, 4, "z", 7), (2, None, None, 3)], "k int, t int, x string, y int")
    assert rows(A.latest_by(df, ["k"], "t", ["x", "y"])) == Counter([(1, 5, "b", 1), (2, None, None, 3)])
    assert rows(A.one_per_key(df, ["k"], ["x", "y"])) == Counter([(1, "a", 9), (2, None, 3)])


def test_first_and_last_value_sort_no_aggregate(spark):
    df = spark.createDataFrame([(1, 1, 10), (1, 3, 30), (1, 3, 31), (None, 1, 7)], "k int, t int, v int")
    out = W.attach_first_last(df, ["k"], "t", "v", "f", "l")
    assert rows(out.select("v", "f", "l")) == Counter([(10, 10, 31), (30, 10, 31), (31, 10, 31), (7, 7, 7)])
    for frame in (out, A.latest_by(df, ["k"], "t", ["v"]), A.value_at_top(df, ["k"], "t", "v", "top")):
        assert "SortAggregate" not in frame._jdf.queryExecution().executedPlan().toString()


def test_many_medium_keys_are_all_cut(no_broadcast):
    spark = no_broadcast
    detail = spark.range(300 * 40).select((F.col("id") % 300 + 10).cast("int").alias("k"), F.col("id").alias("v"))
    assert {r.chunks for r in J.hot_keys(detail, "k", rows_per_task=10).collect()} == {4} and J.hot_keys(detail, "k", 10).count() == 300
    left = spark.range(310).select(F.col("id").cast("int").alias("k"))
    out = J.expand_detail_left(left, detail, "k", rows_per_task=10)
    assert out.count() == 300 * 40 + 10


def test_two_deductions_of_a_facility_are_an_error(spark):
    base = spark.createDataFrame([(D(2024, 1, 1), 1)], "date date, facility_group_id int")
    receipts = spark.createDataFrame([(D(2024, 1, 1), 1, 5.0)], "sheet_date date, dist_facility_group_id int, amount double")
    twice = spark.createDataFrame([(1, 2.0), (1, 3.0)], "facility_group_id int, deduct double")
    with pytest.raises(Exception, match="lookup key repeats"):
        J.left_agg_chain(base, receipts, twice).collect()
    assert J.left_agg_chain(base, receipts, twice.limit(1)).count() == 1


def test_outer_merge_fills_numbers_only(spark):
    a = spark.createDataFrame([(1, [1], True)], "k int, items array<int>, flag boolean")
    b = spark.createDataFrame([(2, 3)], "k int, n int")
    assert {tuple(r) for r in J.outer_merge_fill0(a, b, ["k"]).selectExpr("k", "items is null", "flag", "n").collect()} == \
        {(1, False, True, 0), (2, True, None, 3)}


def test_target_rerun_replaces_rows_without_a_facility(spark):
    text = spark.createDataFrame([("2024-01-02", "F", "1", None)], "date string, facility string, target string, facility_group_id string")
    once = maintenance.target_load(text)
    assert maintenance.target_load(text, once).count() == 1


def test_hash_sample_repeats(spark):
    df = spark.range(5000)
    first = rows(W.hash_sample(df, ["id"], 0.1))
    assert first == rows(W.hash_sample(df.repartition(3), ["id"], 0.1)) and 400 < len(first) < 600


def test_run_folders_can_be_removed(spark, tmp_path):
    path = S.run_folder(spark, "x")
    writers.replace_table(spark.range(3), path)
    S.remove_run_folders(spark)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_folder_without_a_setting(spark):
    class Without:
        """A local session in which spark.checkpoint.dir is unset."""
        conf = type("C", (), {"get": staticmethod(lambda *_: None)})
        sparkContext = type("X", (), {"master": "local[2]", "applicationId": "test-app", "setCheckpointDir": staticmethod(lambda p: None)})
    assert S.shared_folder(Without) == S.shared_folder(Without)

    class Cluster(Without):
        conf = type("C", (), {"get": staticmethod(lambda *_: "file:/tmp/x")})
        sparkContext = type("X", (), {"master": "yarn"})
    with pytest.raises(RuntimeError, match="shared folder"):
        S.shared_folder(Cluster)

"""Stored tables in versions: readers during writes, killed writes, keyed loads, purges by file."""

import datetime as dt
import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsledger.operators.lasting_ids import lasting_ids
from opsledger.operators.mutations import in_range, upsert_by_key
from opsledger.plans import maintenance
from opsledger.sources import versions, writers
from opsledger.sources.versions import Part, TableChanged, VersionedTable
from opsledger.streaming import ingest

D = dt.date


def rows(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture
def table(spark, tmp_path):
    return VersionedTable(spark, str(tmp_path / "table"))


def test_a_reader_stays_on_its_version(spark, table):
    table.replace(spark.range(3))
    old = table.read()
    table.replace(spark.range(10, 15))
    table.append(spark.range(2))
    assert rows(old) == Counter([(0,), (1,), (2,)])  # read after the replacement
    assert rows(table.read()) == Counter([(i,) for i in (0, 1, *range(10, 15))])
    assert rows(table.read(1)) == rows(old) and table.read(2).count() == 5 and table.numbers() == [1, 2, 3]


def test_a_change_may_read_the_table_it_changes(spark, table):
    table.replace(spark.range(4))
    table.rewrite(lambda old: old.withColumn("id", F.col("id") * 2).union(old))
    assert rows(table.read()) == Counter({(0,): 2, (2,): 2, (4,): 1, (6,): 1, (1,): 1, (3,): 1})


@pytest.mark.parametrize("step", ["write", "publish"])
def test_a_killed_write_changes_nothing(spark, table, monkeypatch, step):
    table.replace(spark.range(3))

    def killed(*_, **__):
        raise KeyboardInterrupt

    if step == "write":
        bad = spark.range(100).withColumn("id", F.when(F.col("id") > 90, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("bigint"))
        with pytest.raises(Exception, match="lost"):
            table.replace(bad)
    else:
        monkeypatch.setattr(versions, "publish_small_file", killed)
        with pytest.raises(KeyboardInterrupt):
            table.replace(spark.range(100))
        monkeypatch.undo()
    assert table.read().count() == 3 and table.numbers() == [1]
    table.append(spark.range(1))
    assert table.read().count() == 4
    assert table.vacuum(keep=1) and table.read().count() == 4


def test_two_writers_of_one_version(spark, table):
    table.replace(spark.range(3))
    before = table.version()
    table.append(spark.range(1))
    with pytest.raises(TableChanged):
        table._publish(versions.replace(before, number=before.number + 1, rows=[Part("data/other")]))
    assert table.read().count() == 4


def test_empty_and_odd_tables(spark, table):
    with pytest.raises(FileNotFoundError):
        table.read()
    with pytest.raises(ValueError, match="empty"):
        table.replace(spark.range(0), refuse_empty=True)
    assert not table.exists()
    table.replace(spark.createDataFrame([], "`odd.name` int, k string"))
    assert table.read().columns == ["odd.name", "k"] and table.read().count() == 0
    table.append(spark.createDataFrame([("x", 1), (None, None)], "k string, `odd.name` int"))
    assert rows(table.read()) == Counter([(1, "x"), (None, None)])
    with pytest.raises(ValueError, match="columns"):
        table.append(spark.range(1))


def test_loads_by_key_equal_the_definition(spark, table):
    rng, wanted = random.Random(1), None
    for load in range(9):
        data = [(rng.choice([None, *range(40)]), f"{load}:{i}") for i in range(rng.choice([0, 5, 60]))]
        frame = spark.createDataFrame(data, "k int, v string")
        wanted = frame if wanted is None else upsert_by_key(wanted, frame, ["k"])
        for _ in range(2):  # each load is run again
            table.load(frame, f"load {load}", "k", most_loads=4)
        assert rows(table.read()) == rows(wanted)
    assert len(table.version().keys) < 4
    assert rows(table.read(2)) != rows(table.read())


def test_a_million_keys_in_few_files(spark, table):
    table.load(spark.range(1_000_000).withColumn("v", F.lit(0)), "a", "id")
    table.load(spark.range(500_000, 1_200_000).withColumn("v", F.lit(1)), "b", "id")
    files = [f for _, _, names in os.walk(table.path) for f in names if f.endswith(".parquet")]
    assert len(files) <= 3 * 16
    assert rows(table.read().groupBy("v").count()) == Counter([(0, 500_000), (1, 700_000)])
    table.compact()
    assert rows(table.read().groupBy("v").count()) == Counter([(0, 500_000), (1, 700_000)])
    with pytest.raises(ValueError, match="key"):
        table.load(spark.range(1).withColumn("v", F.lit(0)), "c", "v")


def _state(table):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(f"{table.path}/data") for f in names
            if f.endswith(".parquet")}


@pytest.mark.parametrize("keyed", [False, True])
def test_a_purge_rewrites_only_files_with_its_days(spark, table, keyed):
    days = spark.range(300).select(F.expr("date_add(date'2024-01-01', cast(id as int))").alias("d"), F.col("id").alias("v"))
    frame = days.repartitionByRange(6, "d").sortWithinPartitions("d")
    frame = frame.union(spark.createDataFrame([(None, -1)], "d date, v bigint").coalesce(1))
    if keyed:
        table.load(frame, "a", "v")
    else:
        table.replace(frame)
    old = _state(table)
    audit = table.remove(in_range("d", "2024-02-10", "2024-02-20"))
    assert audit == {"rows_before": 301, "rows_purged": 11, "rows_after": 290}
    assert rows(table.read()) == rows(frame.where("d is null or d not between date'2024-02-10' and date'2024-02-20'"))
    new = _state(table)
    assert all(new[f] == t for f, t in old.items())
    version = table.version()
    named = [f"{table.path}/{p.folder}/{n}" for p in version.rows if p.files is not None for n in p.files]
    assert len(named) >= len(old) - 2 and set(named) <= set(old)  # all others are still the same files
    assert table.remove(in_range("d", "2024-02-10", "2024-02-20"))["rows_purged"] == 0 and table.version().number == version.number
    assert table.remove(in_range("d", "", None)) == {"rows_before": 290, "rows_purged": 0, "rows_after": 290}
    table.remove(in_range("d", "2024-03-01", "2024-03-01"))  # again, on a version that names single files
    assert table.read().count() == 289


def test_a_purge_counts_what_is_seen(spark, table):
    first = spark.createDataFrame([(1, D(2024, 1, 1)), (2, D(2024, 1, 2)), (None, D(2024, 1, 2))], "k int, d date")
    table.load(first, "a", "k")
    table.load(spark.createDataFrame([(2, D(2024, 1, 3))], "k int, d date"), "b", "k")
    assert table.remove(in_range("d", "2024-01-02", "2024-01-02")) == {"rows_before": 3, "rows_purged": 1, "rows_after": 2}
    assert rows(table.read()) == Counter([(1, D(2024, 1, 1)), (2, D(2024, 1, 3))])


def test_counts_come_from_the_writing_pass(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.createDataFrame([(D(2024, 1, d),) for d in (1, 2, 3)] + [(None,)], "d date").write.parquet(source)
    seen = spark.sparkContext.accumulator(0)

    def passing(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    frame = spark.read.parquet(source).mapInArrow(passing, "d date")
    audit, left = maintenance.purge_into({"t": (frame, "d")}, "2024-01-02", "2024-01-05", str(tmp_path / "out"))
    assert tuple(audit[0]) == ("t", 4, 2, 2) and left["t"].read().count() == 2
    assert seen.value == 4  # one pass
    with pytest.raises(ValueError):
        maintenance.purge_into({"t": (frame, "d")}, "2024-01-02", "soon", str(tmp_path / "out2"))
    assert seen.value == 4


@pytest.mark.parametrize("step", ["stage", "adopt", "publish"])
def test_ingest_goes_on_after_a_crash(spark, tmp_path, monkeypatch, step):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("v", T.StringType())])

    def deliver(*data):
        spark.createDataFrame(list(data), schema).coalesce(1).write.mode("append").parquet(source)

    def run():
        ingest.ingest_available_now(spark, source, target, state, "k", schema, files_per_batch=1)

    deliver((1, "a"), (2, "b"), (None, "n"))
    run()
    deliver((1, "c"), (None, "m"))
    deliver((1, "d"))
    calls = []

    def crash(*args, **kwargs):
        calls.append(args)
        raise RuntimeError("killed")

    if step == "stage":
        monkeypatch.setattr(ingest, "remove_folder", crash)
        monkeypatch.setattr(ingest, "_waiting", lambda *_: {"x": ("s", 2, 2)})  # fails in the second batch of the run
    else:
        monkeypatch.setattr(*((VersionedTable, "adopt") if step == "adopt" else (versions, "publish_small_file")), crash)
    with pytest.raises(Exception, match="killed"):
        run()
    monkeypatch.undo()
    assert calls and rows(writers.read_table(spark, target)) == Counter([(1, "a"), (2, "b"), (None, "n")])
    VersionedTable(spark, target).load(spark.createDataFrame([(7, "other")], schema), "another writer", "k")
    run()
    wanted = Counter([(1, "c"), (1, "d"), (2, "b"), (None, "n"), (None, "m"), (7, "other")])
    assert rows(writers.read_table(spark, target)) == wanted
    run()
    assert rows(writers.read_table(spark, target)) == wanted


def test_ids_last(spark, table):
    """A second load with more rows keeps all earlier ids; new keys follow without gaps; nulls are keys."""
    def load(*keys):
        frame = spark.createDataFrame([(k, f"v{i}") for i, k in enumerate(keys)], "`odd.key` string, v string")
        out = lasting_ids(frame, ["odd.key"], table, "id")
        assert out.columns == ["odd.key", "v", "id"] and out.count() == len(keys)
        return {r["odd.key"]: r.id for r in out.collect()}

    first = load("m", "c", None, "c")
    assert sorted(first.values()) == [1, 2, 3]
    second = load("a", "m", "z", "c", None, "b")
    assert {k: second[k] for k in first} == first and sorted(second.values()) == [1, 2, 3, 4, 5, 6]
    assert second["a"] < second["b"] < second["z"]
    versions_before = table.numbers()
    assert load("z", "a") == {k: second[k] for k in ("z", "a")} and table.numbers() == versions_before


def test_ids_of_an_empty_load(spark, table):
    assert lasting_ids(spark.createDataFrame([], "k int"), ["k"], table, "id").count() == 0
    assert [r.id for r in lasting_ids(spark.createDataFrame([(5,)], "k int"), ["k"], table, "id").collect()] == [1]


@pytest.mark.parametrize("step", [None, "ledger", "adopt", "publish"])
def test_the_same_contents_under_two_names_count_once(spark, tmp_path, monkeypatch, step):
    source, target, state, ledger = (str(tmp_path / n) for n in ("in", "out", "state", "ledger"))
    schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("v", T.StringType())])

    def deliver(*data):
        spark.createDataFrame(list(data), schema).coalesce(1).write.mode("append").parquet(source)

    def run(**options):
        ingest.ingest_available_now(spark, source, target, state, "k", schema, files_per_batch=1, contents=ledger, **options)

    first = [(None, "a"), (None, "b"), (1, None)]
    deliver(*first)
    deliver(*first[::-1])  # the same rows in another order and file
    deliver((None, None), (2, "x"))
    if step:
        def crash(*_, **__):
            raise RuntimeError("killed")
        place = {"ledger": (ingest, "_remember_contents"), "adopt": (VersionedTable, "adopt"), "publish": (VersionedTable, "_publish")}[step]
        monkeypatch.setattr(*place, crash)
        with pytest.raises(Exception, match="killed"):
            run()
        monkeypatch.undo()
    run()
    wanted = Counter([*first, (None, None), (2, "x")])
    assert rows(writers.read_table(spark, target)) == wanted
    deliver(*first)  # and again in a later delivery
    deliver((None, "c"))
    run()
    assert rows(writers.read_table(spark, target)) == wanted + Counter([(None, "c")])
    assert not ingest.names_in(spark, f"{target}/contents") and VersionedTable(spark, ledger).read().count() == 3
    for i in range(3):
        deliver((None, f"new {i}"))
        run(remember=1)
    deliver((None, "c"))  # forgotten by now
    run(remember=1)
    assert rows(writers.read_table(spark, target))[(None, "c")] == 2

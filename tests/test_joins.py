import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from opsledger.operators import joins as J


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_lookup_duplicate_rules(spark):
    fact = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    dim = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c"), (None, "n")], "k int, v string")
    assert rows(J.lookup_left(fact, dim, ["k"], ["v"], "fanout")) == Counter({(1, "a"): 1, (1, "b"): 1, (2, "c"): 1, (None, None): 1})
    assert rows(J.lookup_left(fact, dim, ["k"], ["v"], "first")) == Counter({(1, "a"): 1, (2, "c"): 1, (None, None): 1})
    assert rows(J.lookup_left(fact, dim, ["k"], ["v"], "first", null_safe=True))[(None, "n")] == 1
    with pytest.raises(Exception, match="lookup key repeats"):
        J.lookup_left(fact, dim, ["k"], ["v"]).collect()
    with pytest.raises(ValueError):
        J.lookup_left(fact, dim, ["k"], ["v"], "whatever")


def test_lookup_inner_drops_unmatched(spark):
    fact = spark.createDataFrame([(2,), (9,), (None,)], "k int")
    dim = spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string")
    assert rows(J.lookup_inner(fact, dim, ["k"], ["v"])) == Counter({(2, "c"): 1})


@pytest.mark.parametrize("seed", [1, 2])
def test_expand_detail_equals_nested_loop(no_broadcast, seed):
    spark, rng = no_broadcast, random.Random(seed)
    left = [(i, rng.choice([None, 1, 3, 5, 6, 7, 8, 900])) for i in range(60)]
    # key 5 holds most details, many of them equal; 3 is a type code
    right = [(rng.choice([5] * 8 + [3, 6, 7, None]), rng.randrange(3)) for _ in range(3000)]
    wanted = Counter()
    for i, k in left:
        hits = [d for kk, d in right if k is not None and kk == k and k not in (1, 3)]
        wanted.update((i, k, d) for d in hits) if hits else wanted.update([(i, k, None)])
    a = spark.createDataFrame(left, "i int, k bigint").repartition(3)
    b = spark.createDataFrame(right, "k bigint, d int").repartition(4)
    assert rows(J.expand_detail_left(a, b, "k", [1, 3]).select("i", "k", "d")) == wanted


@pytest.fixture(params=[8, 200])
def partitions(no_broadcast, request):
    spark = no_broadcast
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", request.param)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield request.param
    spark.conf.set("spark.sql.shuffle.partitions", old)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_expand_detail_cuts_the_hot_key(spark, partitions):
    """Details of one very frequent key do not make one task much larger than the mean."""
    detail = spark.range(200_000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).cast("bigint").alias("k"),
                                         F.col("id").alias("d"))
    left = detail.select("k").distinct().union(spark.createDataFrame([(200_001,)], "k bigint"))
    out = J.expand_detail_left(left, detail, "k")
    tasks = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert sum(tasks) == 200_001 and max(tasks) < 2.5 * 200_001 / partitions
    assert out.where("k = 200001 and d is null").count() == 1 and out.where("k = 7").count() == detail.where("k = 7").count()


def test_expand_detail_with_many_hot_keys(spark, partitions):
    """Ten thousand keys above a unit are all found, and the rows are those of a plain join."""
    detail = spark.range(300_000).select((F.col("id") % 10_000).alias("k"), F.col("id").alias("d"))
    detail = detail.union(spark.range(20_000).select((F.col("id") + 10_000).alias("k"), F.col("id").alias("d")))
    hot = {r.hot_key: r.chunks for r in J.hot_keys(detail, "k", rows_per_task=10).collect()}
    assert set(hot) == set(range(10_000)) and set(hot.values()) == {3}
    left = spark.range(0, 40_000, 3).select(F.col("id").alias("k"))
    out = J.expand_detail_left(left, detail, "k", rows_per_task=10)
    plain = left.join(detail, "k", "left")
    assert out.exceptAll(plain).count() == 0 == plain.exceptAll(out).count()
    assert J.hot_keys(detail, "k").count() == 0


def test_hot_keys_have_a_bound(spark):
    detail = spark.range(50_000).select((F.col("id") % 500).alias("k"))
    assert J.hot_keys(detail, "k", rows_per_task=1, most=100).count() == 100


def test_expand_detail_empty_sides(spark):
    left = spark.createDataFrame([(1,), (None,)], "k bigint")
    none = spark.createDataFrame([], "k bigint, d int")
    assert rows(J.expand_detail_left(left, none, "k").select("k", "d")) == Counter({(1, None): 1, (None, None): 1})
    assert J.expand_detail_left(none.select("k"), none, "k").count() == 0


def test_outer_merge_fills_numbers_only(spark):
    a = spark.createDataFrame([(1, 2.5, "x")], "k int, a double, s string")
    b = spark.createDataFrame([(2, 4)], "k int, b bigint")
    assert rows(J.outer_merge_fill0(a, b, ["k"])) == Counter({(1, 2.5, "x", 0): 1, (2, 0.0, None, 4): 1})


def test_cross_fill_has_every_pair_and_no_cartesian_plan(spark):
    days = spark.createDataFrame([(dt.date(2024, 1, 1), 1), (dt.date(2024, 1, 2), 1), (dt.date(2024, 1, 9), 2)], "date date, w int")
    members = spark.createDataFrame([(1,), (2,)], "f int")
    out = J.cross_fill(days, members)
    assert rows(out.select("date", "w", "f")) == Counter((d, w, f) for d, w in [(r.date, r.w) for r in days.collect()] for f in (1, 2))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert J.cross_fill(days.limit(0), members).count() == 0


def test_touched_weeks_take_whole_weeks(spark):
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(28)]
    calendar = spark.createDataFrame([(d, i // 7) for i, d in enumerate(days)], "date date, calendar_week_id int")
    fact = spark.createDataFrame([(days[9],), (days[14],)], "sheet_date date")
    got = sorted(r.date for r in J.dates_in_touched_weeks(calendar, fact, "sheet_date").collect())
    assert got == days[7:21]


def test_expand_missing_keys(spark):
    present = spark.createDataFrame([("C", 1, 9)], "g string, d int, f int")
    wanted = spark.createDataFrame([("C", 1), ("C", 2), ("Z", 3)], "g string, d int")
    members = spark.createDataFrame([("C", 4), ("C", 5)], "g string, f int")
    assert rows(J.expand_missing_keys(present, wanted, "d", members, "g").select("g", "d", "f")) == \
        Counter([("C", 1, 9), ("C", 2, 4), ("C", 2, 5)])


def test_presence_join(spark):
    out = J.presence_join(spark.createDataFrame([("a",), ("b",)], "s string"), spark.createDataFrame([("b",), ("b",)], "x string"), "s", "x", "read")
    assert rows(out) == Counter([("a", 0), ("b", 1)])

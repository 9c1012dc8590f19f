"""Join operators.

No join here carries a broadcast hint for data. Catalyst broadcasts a side when its
known size is below ``spark.sql.autoBroadcastJoinThreshold``, AQE re-checks
with measured sizes, and larger sides fall back to shuffled joins in which AQE
splits skewed partitions of the outer side.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A key with more detail rows than this is spread over several tasks, however large the table is.
ROWS_PER_TASK = 1_000_000
# So many hot keys are cut at most; below the limits of the summary that finds them.
MOST_HOT_KEYS = 20_000


def _unique(dim: DataFrame, keys: list[str], columns: list[str], on_duplicate: str) -> DataFrame:
    """``dim`` reduced to keys + columns, with repeated keys treated as asked."""
    dim = dim.select(*keys, *columns)
    if on_duplicate == "fanout":
        return dim
    if on_duplicate == "first":
        # smallest whole record, so that the choice is repeatable
        record = F.struct(*columns)
        picked = dim.groupBy(*keys).agg(F.min(record).alias("_r"))
        return picked.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in columns])
    if on_duplicate != "raise":
        raise ValueError(f"on_duplicate must be raise, first or fanout, not {on_duplicate!r}")
    grouped = dim.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *[F.any_value(c).alias(c) for c in columns])
    complain = F.raise_error(F.concat(F.lit("lookup key repeats: "), F.to_json(F.struct(*keys))))

    def checked(c: str) -> Column:
        return F.when(F.col("_n") == 1, F.col(c)).otherwise(complain.cast(dim.schema[c].dataType)).alias(c)

    return grouped.select(*keys, *[checked(c) for c in columns])


def _equi(left: DataFrame, right: DataFrame, keys: list[str], how: str, null_safe: bool) -> DataFrame:
    if not null_safe:
        return left.join(right, keys, how)
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(renamed, on, how).drop(*[f"_r_{k}" for k in keys])


def lookup_left(df: DataFrame, dim: DataFrame, keys: list[str], columns: list[str],
                on_duplicate: str = "raise", null_safe: bool = False) -> DataFrame:
    """Attach dimension columns; rows without a match keep nulls.

    A dimension that repeats a key is an error unless ``on_duplicate`` says to
    take one record (``first``) or to multiply rows (``fanout``).
    """
    return _equi(df, _unique(dim, keys, columns, on_duplicate), keys, "left", null_safe)


def lookup_inner(df: DataFrame, dim: DataFrame, keys: list[str], columns: list[str],
                 on_duplicate: str = "raise", null_safe: bool = False) -> DataFrame:
    """Attach dimension columns and drop rows without a match."""
    return _equi(df, _unique(dim, keys, columns, on_duplicate), keys, "inner", null_safe)


def hot_keys(df: DataFrame, key: str, rows_per_task: int = ROWS_PER_TASK, most: int = MOST_HOT_KEYS) -> DataFrame:
    """``hot_key`` and ``chunks``: frequent keys and the number of chunks each should be cut into, at most ``most`` rows.

    One pass over the key column with a mergeable summary of frequent items, which holds a bounded number of counters
    in each task. A key is hot when it has more rows than a unit: ``rows_per_task``, or a quarter of the mean of a
    shuffle partition where that is less, so that a key's chunks spread over all tasks. The counts are estimates; they
    only decide how rows are spread.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = df.where(F.col(key).isNotNull()).agg(
        F.expr(f"approx_top_k(`{key}`, {most}, {10 * most})").alias("top"), F.count(F.lit(1)).alias("total"))
    unit = F.least(F.lit(rows_per_task).cast("double"), F.greatest(F.col("total") / (4 * partitions), F.lit(1.0)))
    return found.select(F.explode("top").alias("t"), unit.alias("unit")).where("t.count > unit") \
        .select(F.col("t.item").alias("hot_key"), F.ceil(F.col("t.count") / F.col("unit")).cast("int").alias("chunks"))


def expand_detail_left(df: DataFrame, detail: DataFrame, key: str, never_match: list[int] = (),
                       rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """One-to-many left join of ``df`` with its details.

    Rows whose key is null or in ``never_match`` cannot find a detail; they go
    past the join without being shuffled. Detail keys with more rows than a task
    should get are cut into chunks, and only the few rows of ``df`` with such a
    key are repeated once per chunk. The table of hot keys has a fixed bound of
    rows, so it is the one side here that is broadcast by a hint.
    """
    joinable = F.col(key).isNotNull()
    if never_match:
        joinable = joinable & ~F.col(key).isin(*never_match)
    detail = detail.where(joinable)
    extra = [c for c in detail.columns if c != key]
    hot = F.broadcast(hot_keys(detail, key, rows_per_task))

    def with_chunks(rows: DataFrame) -> DataFrame:
        return rows.join(hot, F.col(key) == F.col("hot_key"), "left") \
            .withColumn("_chunks", F.coalesce("chunks", F.lit(1))).drop("hot_key", "chunks")

    # The chunk of a detail depends on its values and its input partition only: a task that is
    # run again puts every row where it was, and equal copies from different splits are spread.
    cut = with_chunks(detail).withColumn(
        "_chunk", F.when(F.col("_chunks") == 1, F.lit(0)).otherwise(
            F.pmod(F.xxhash64(F.spark_partition_id(), *[F.col(c) for c in detail.columns]),
                   F.col("_chunks")).cast("int"))
    ).select(key, "_chunk", *extra, F.lit(True).alias("_found"))

    outer = with_chunks(df.where(joinable)).withColumn("_chunk", F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1)))
    matched = outer.join(cut, [key, "_chunk"], "left") \
        .where(F.col("_found") | (F.col("_chunks") == 1)) \
        .select(*df.columns, *extra)

    fields = {f.name: f.dataType for f in detail.schema.fields}
    past = df.where(F.coalesce(~joinable, F.lit(True))) \
        .withColumns({c: F.lit(None).cast(fields[c]) for c in extra})
    return matched.unionByName(past.select(*df.columns, *extra))


def outer_merge_fill0(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer join on ``keys``; gaps of numeric columns become 0, those of other columns stay null."""
    merged = a.join(b, keys, "full")
    numeric = [f.name for f in merged.schema.fields if f.name not in keys and isinstance(f.dataType, T.NumericType)]
    return merged.withColumns({n: F.coalesce(F.col(n), F.lit(0).cast(merged.schema[n].dataType)) for n in numeric})


def left_agg_chain(base: DataFrame, receipts: DataFrame, deducts: DataFrame) -> DataFrame:
    """Base dates ⟕ summed receipts ⟕ deduction, the second keyed on the receipts' facility.

    A day without receipts therefore has no deduction either. Two deductions of a facility are an error.
    """
    summed = receipts.groupBy("sheet_date", "dist_facility_group_id").agg(F.sum("amount").alias("amount"))
    with_receipts = base.join(
        summed, (F.col("sheet_date") == F.col("date"))
        & (F.col("dist_facility_group_id") == F.col("facility_group_id")), "left")
    per_facility = deducts.select(F.col("facility_group_id").alias("dist_facility_group_id"), "deduct")
    return lookup_left(with_receipts, per_facility, ["dist_facility_group_id"], ["deduct"]).select(
        "date", "facility_group_id",
        F.coalesce(F.col("amount"), F.lit(0)).alias("amount"),
        F.coalesce(F.col("deduct"), F.lit(0)).alias("deduct"))


def cross_fill(dates: DataFrame, members: DataFrame, date: str = "date") -> DataFrame:
    """Every date with every member, without a cartesian join.

    Each member writes out the span of dates itself, and an equi-join with the
    date table brings in its columns (and takes out days it does not have).
    Members are spread first: few bytes of members become many rows.
    """
    lo = dates.select(F.min(date)).scalar()
    hi = dates.select(F.max(date)).scalar()
    spread = members.repartition(int(members.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    spans = spread.withColumns({"_lo": lo, "_hi": hi}).where(F.col("_lo").isNotNull())
    grid = spans.withColumn(date, F.explode(F.sequence("_lo", "_hi"))).drop("_lo", "_hi")
    return grid.join(dates, date)


def expand_missing_keys(present: DataFrame, wanted: DataFrame, key: str, members: DataFrame,
                        group: str) -> DataFrame:
    """Rows of ``present`` plus, for wanted (group, key) pairs without any row, one row per member of the group."""
    missing = wanted.select(group, key).distinct().join(present.select(group, key).distinct(), [group, key], "left_anti")
    return present.unionByName(missing.join(members, group), allowMissingColumns=True)


def policy_join(df: DataFrame, policy: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Attach policy shares. Policies are ``VALUES`` relations of known size."""
    return df.join(policy, keys, how)


def keep_if_in(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    return df.join(other.select(*keys), keys, "left_semi")


def drop_if_in(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Null keys never match, so their rows stay."""
    return df.join(other.select(*keys), keys, "left_anti")


def presence_join(df: DataFrame, other: DataFrame, left_name: str, right_name: str, out: str) -> DataFrame:
    """Left join on differently named columns; ``out`` is 1 where ``other`` has the name, else 0."""
    seen = other.select(F.col(right_name).alias("_seen")).distinct()
    return df.join(seen, F.col(left_name) == F.col("_seen"), "left") \
        .withColumn(out, F.when(F.col("_seen").isNotNull(), 1).otherwise(0)).drop("_seen")


def dates_in_touched_weeks(calendar: DataFrame, fact: DataFrame, column: str) -> DataFrame:
    """Calendar days of every week that has a day inside the fact's date span."""
    lo = fact.select(F.min(column)).scalar()
    hi = fact.select(F.max(column)).scalar()
    weeks = calendar.where(F.col("date").between(lo, hi)).select("calendar_week_id").distinct()
    return calendar.join(weeks, "calendar_week_id", "left_semi").select("date")


def union_by_name(*frames: DataFrame) -> DataFrame:
    """Union all by column name; a column missing in one part is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)

"""Ranking and numbering that never sort a whole table in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opsledger.session import reliable_checkpoint

# monotonically_increasing_id keeps the partition number above these bits.
_ROW_BITS = 33


def dense_row_id(df: DataFrame, order: list[Column | str], out: str, partitions: int | None = None) -> DataFrame:
    """Number rows 1..n in a declared total order.

    Rows are range-partitioned and sorted within partitions, and kept in the
    shared folder so that both later reads see the same placement. The window
    below runs over one row per partition, not over the data.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = reliable_checkpoint(
        df.repartitionByRange(n, *order).sortWithinPartitions(*order)
        .withColumn("_m", F.monotonically_increasing_id()))
    placed = placed.withColumns({
        "_part": F.shiftright("_m", _ROW_BITS),
        "_pos": F.col("_m").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))})
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    # at most `n` rows by construction
    return placed.join(F.broadcast(offsets), "_part") \
        .withColumn(out, F.col("_offset") + F.col("_pos") + 1) \
        .drop("_m", "_part", "_pos", "_offset")


def category_rank(df: DataFrame, column: str, out: str) -> DataFrame:
    """Dense rank minus one of a category over the whole table: only the distinct values are ranked."""
    ids = dense_row_id(df.select(F.col(column).alias("_category")).distinct(), ["_category"], "_rank")
    return df.join(ids, F.col(column).eqNullSafe(F.col("_category")), "left") \
        .withColumn(out, (F.col("_rank") - 1).cast("int")).drop("_category", "_rank")


def top_row(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row per key in ``order``. Spark cuts each task to one row per key before the shuffle."""
    ranked = df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("_rn") == 1).drop("_rn")


def attach_group_values(df: DataFrame, keys: list[str], **aggregates: Column) -> DataFrame:
    """Group aggregates on every row, by aggregation and join back rather than by a window.

    The aggregate combines before its shuffle and the join may split the outer
    side, so one very large group does not end up in one task.
    """
    groups = df.groupBy(*[F.col(k).alias(f"_g_{k}") for k in keys]).agg(
        *[c.alias(name) for name, c in aggregates.items()])
    on = None
    for k in keys:
        match = F.col(k).eqNullSafe(F.col(f"_g_{k}"))
        on = match if on is None else on & match
    return df.join(groups, on, "left").drop(*[f"_g_{k}" for k in keys])


def attach_first_last(df: DataFrame, keys: list[str], order: str, value: str, first: str, last: str) -> DataFrame:
    """The ``value`` of each group's earliest and latest row on every row (ties: the smaller, the larger value).

    Tasks cut their rows to one per group and end before a shuffle; the rows themselves meet only those.
    """
    out = df
    for name, columns in ((first, [F.col(order).asc_nulls_last(), F.col(value).asc_nulls_last()]),
                          (last, [F.col(order).desc_nulls_last(), F.col(value).desc_nulls_last()])):
        ends = top_row(df.select(*keys, order, value), keys, columns) \
            .select(*[F.col(k).alias(f"_g_{k}") for k in keys], F.col(value).alias(name))
        on = F.lit(True)
        for k in keys:
            on = on & F.col(k).eqNullSafe(F.col(f"_g_{k}"))
        out = out.join(ends, on, "left").drop(*[f"_g_{k}" for k in keys])
    return out


def ordered(df: DataFrame, *keys: str) -> DataFrame:
    return df.orderBy(*keys)


def hash_sample(df: DataFrame, keys: list[str], fraction: float = 0.01) -> DataFrame:
    """The rows whose keys hash into ``fraction`` of the hash range: the same rows at each run and in any engine.

    The hash is the first four digits of the md5 of the keys as text, joined by commas (a null key: empty text).
    """
    text = F.concat_ws(",", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    return df.where(F.substring(F.md5(text), 1, 4) < F.lit(f"{round(fraction * 65536):04x}"))

"""Grouping operators. All of them combine on the map side, so a hot key costs one row per task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsledger.operators.windows import top_row


def sum_by(df: DataFrame, keys: list[str], measures: list[str], drop_null_keys: bool = True) -> DataFrame:
    """Sums that are 0 for nothing; rows with a null key are left out unless asked for."""
    if drop_null_keys:
        df = df.na.drop(subset=list(keys))
    return df.groupBy(*keys).agg(*[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in measures])


def two_level_sum(df: DataFrame, fine: list[str], coarse: list[str], measure: str) -> DataFrame:
    """Sum to the fine keys, then to the coarse ones (null fine keys are lost on the way)."""
    return sum_by(sum_by(df, fine, [measure]), coarse, [measure])


def extent(df: DataFrame, column: str) -> DataFrame:
    """One row: smallest and largest value."""
    return df.agg(F.min(column).alias("lo"), F.max(column).alias("hi"))


def count_in_range(df: DataFrame, column: str, start, end) -> DataFrame:
    """One row: all rows, and those inside the range (both ends included)."""
    inside = F.col(column).between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(inside).alias("n_in_range"))


def distinct_keys(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(*keys).distinct()


def one_per_key(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """One whole row per key, the smallest by ``columns`` in their order: repeatable, unlike keep-any."""
    return top_row(df.select(*keys, *columns), keys, [F.col(c).asc_nulls_last() for c in columns])


def first_last_by(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.min(order).alias(f"first_{order}"), F.max(order).alias(f"last_{order}"))


def latest_by(df: DataFrame, keys: list[str], order: str, columns: list[str]) -> DataFrame:
    """The whole row latest by ``order``; equal orders are settled by the larger ``columns``, in their order."""
    return top_row(df.select(*keys, order, *columns), keys, [F.col(c).desc_nulls_last() for c in (order, *columns)])


def value_at_top(df: DataFrame, keys: list[str], order: str, value: str, out: str) -> DataFrame:
    """The ``value`` of the row with the largest ``order`` (ties: the larger value)."""
    return latest_by(df, keys, order, [value]).select(*keys, F.col(value).alias(out))


def pivot_fixed(df: DataFrame, index: list[str], column: str, values: list[str], measure: str,
                fill=0) -> DataFrame:
    """Long to wide over a declared value list, so a category without rows still has its column."""
    def cell(value: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col(column) == value, F.col(measure))), F.lit(fill)).alias(value)

    return df.groupBy(*index).agg(*[cell(v) for v in values])


def unpivot_plans(df: DataFrame, ids: list[str], variable: str, value: str) -> DataFrame:
    """Every column outside ``ids`` becomes a row; empty cells are kept."""
    wide = [c for c in df.columns if c not in set(ids)]
    return df.unpivot(ids, wide, variable, value)


def coverage_counts(df: DataFrame, flag: str) -> DataFrame:
    """One row: registered, present and missing."""
    return df.agg(F.count(F.lit(1)).alias("registered"),
                  F.coalesce(F.sum(flag), F.lit(0)).cast("bigint").alias("present")) \
        .withColumn("missing", F.col("registered") - F.col("present"))

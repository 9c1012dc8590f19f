"""Keyed replacement and audited removal, as plans from old state to new state."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def upsert_by_key(target: DataFrame, source: DataFrame, keys: list[str], null_safe: bool = False) -> DataFrame:
    """Target rows whose key occurs in the source are replaced by all source rows.

    Null keys match nothing, so old null rows stay and new ones are added; with ``null_safe`` a null is a key value
    like others and is replaced.
    """
    incoming = source.select(*keys).distinct()
    if null_safe:
        renamed = incoming.withColumnsRenamed({k: f"_new_{k}" for k in keys})
        on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_new_{k}")) for k in keys])
        return target.join(renamed, on, "left_anti").unionByName(source)
    return target.join(incoming, keys, "left_anti").select(*target.columns).unionByName(source)


def _as_date(text: str, name: str) -> date:
    try:
        return date.fromisoformat(text)
    except ValueError as error:
        raise ValueError(f"{name} must be YYYY-MM-DD, got {text!r}") from error


def in_range(column: str, start: str | None, end: str | None) -> Column:
    """Whether a date lies in [start, end]: a plain comparison that reaches the scan, null where there is no date."""
    if not start or not end:  # without both dates nothing is purged
        return F.lit(False)
    lo, hi = _as_date(start, "start"), _as_date(end, "end")
    return F.col(column).between(F.lit(lo), F.lit(hi))


def _inside(column: str, start: str | None, end: str | None) -> Column:
    return F.coalesce(in_range(column, start, end), F.lit(False))


def purge_range(df: DataFrame, column: str, start: str, end: str) -> DataFrame:
    """Rows outside [start, end]; rows without a date stay."""
    return df.where(~_inside(column, start, end))


def purge_audit(tables: dict[str, tuple[DataFrame, str]], start: str, end: str) -> DataFrame:
    """Per table: rows before, rows the purge takes, rows left. ``tables`` maps name to (table, date column)."""
    def counted(name: str, df: DataFrame, column: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("rows_before"),
                      F.count_if(_inside(column, start, end)).alias("rows_purged")).select(
            F.lit(name).alias("table_name"), "rows_before", "rows_purged",
            (F.col("rows_before") - F.col("rows_purged")).alias("rows_after"))

    parts = [counted(name, df, column) for name, (df, column) in tables.items()]
    return reduce(DataFrame.unionAll, parts)

"""Target loads and audited removal of a date range."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsledger.operators.mutations import in_range, upsert_by_key
from opsledger.operators.schema import require_columns, strict_cast_and_order
from opsledger.sources.sheets import pick_sheet
from opsledger.sources.versions import VersionedTable, store_counted

TARGET_SCHEMA = T.StructType([
    T.StructField("date", T.DateType()), T.StructField("facility", T.StringType()),
    T.StructField("target", T.DoubleType()), T.StructField("facility_group_id", T.LongType())])


def clean_targets(rows: DataFrame) -> DataFrame:
    """Checked, trimmed, typed target rows; a bad value fails the load."""
    names = TARGET_SCHEMA.fieldNames()
    return strict_cast_and_order(require_columns(rows, names), TARGET_SCHEMA)


def target_load(rows: DataFrame, existing: DataFrame | None = None, replace_keys: bool = True) -> DataFrame:
    """Target table after the load. With ``replace_keys`` a rerun does not repeat rows, not even those
    without a facility or date; without, rows are appended."""
    new = clean_targets(rows)
    if existing is None:
        return new
    if replace_keys:
        return upsert_by_key(existing, new, ["date", "facility_group_id"], null_safe=True)
    return existing.unionByName(new)


def store_targets(rows: DataFrame, path: str, sheet: str | None = None) -> None:
    """Replace the keys of a delivery in the stored target table, or start the table with it.

    ``rows`` come from one workbook: with ``sheet`` that sheet is taken, or else the first one.
    """
    if sheet is not None:
        rows = pick_sheet(rows, sheet).drop("sheetname", "position")
    table = VersionedTable(rows.sparkSession, path)
    if table.exists():
        table.rewrite(lambda old: target_load(rows, old))
    else:
        table.replace(target_load(rows), refuse_empty=True)


def purge_into(tables: dict[str, tuple[DataFrame, str]], start: str, end: str, root: str) -> tuple[list[Row], dict[str, VersionedTable]]:
    """Store each table below ``root`` without the rows of the range; returns one audit row per table, and the tables.

    The counts are taken in the pass that writes. Both ends of the range go; blank dates purge nothing. All dates are
    checked before the first write.
    """
    inside = {name: F.coalesce(in_range(column, start, end), F.lit(False)) for name, (_, column) in tables.items()}
    audit, stored = [], {}
    for name, (df, _) in tables.items():
        stored[name] = VersionedTable(df.sparkSession, f"{root}/{name}")
        counts = store_counted(stored[name], df, ~inside[name], rows_before=F.count(F.lit(1)), rows_purged=F.count_if(inside[name]))
        audit.append(Row(table_name=name, **counts, rows_after=counts["rows_before"] - counts["rows_purged"]))
    return audit, stored


def purge_stored(spark: SparkSession, paths: dict[str, tuple[str, str]], start: str, end: str) -> list[Row]:
    """Purge stored tables; returns one audit row per table.

    All dates are checked, all rows counted and all new data written before the first table shows its new version.
    Files without a row in the range stay as they are, in keyed tables as well.
    """
    inside = {name: in_range(column, start, end) for name, (_, column) in paths.items()}
    audit, prepared = [], []
    for name, (path, _) in paths.items():
        table = VersionedTable(spark, path)
        counts, version = table.removal(inside[name])
        audit.append(Row(table_name=name, **counts))
        prepared.append((table, version))
    for table, version in prepared:
        if version is not None:
            table.publish(version)
    return audit

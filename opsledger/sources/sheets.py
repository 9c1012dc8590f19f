"""Sheet-shaped inputs.

A workbook arrives as one long table: a ``sheetname`` column, the position of
the sheet, and the union of the raw columns of all sheets (as text). A config
table says, per sheet, which raw columns to read and what to call them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsledger.operators.joins import lookup_inner

CONFIG_SCHEMA = (
    "sheetname string, facility_group_id bigint, check_account int, "
    "lecture_parameters struct<read_columns: array<string>, rename_columns: map<string,string>>, is_active int")


def sheet_coverage(config: DataFrame, present: DataFrame) -> DataFrame:
    """Registered sheets with ``read`` = 1 where the delivery has the sheet, else 0."""
    seen = present.select(F.col("sheetname").alias("_seen")).distinct()
    return config.join(seen, F.col("sheetname") == F.col("_seen"), "left") \
        .withColumn("read", F.when(F.col("_seen").isNotNull(), 1).otherwise(0)).drop("_seen")


def read_sheets(rows: DataFrame, config: DataFrame, outputs: list[str]) -> DataFrame:
    """Each active sheet's rows under its own layout, as one table of ``outputs``.

    A sheet that is registered twice is an error. The layout is applied as data: an output column takes the raw column that
    the sheet's config renames to it (or reads under that name). All sheets are
    handled in one scan, however many layouts there are.
    """
    raw = [c for c in rows.columns if c != "sheetname"]
    active = config.where(F.col("is_active") == 1).select(
        "sheetname", F.col("facility_group_id").alias("sheet_facility_group_id"), "check_account",
        F.col("lecture_parameters.read_columns").alias("_read"),
        F.col("lecture_parameters.rename_columns").alias("_rename"))
    joined = lookup_inner(rows, active, ["sheetname"], [c for c in active.columns if c != "sheetname"])

    def value_of(output: str):
        # first raw column of the layout whose new name is the output
        candidates = [
            F.when(F.array_contains("_read", name)
                   & (F.coalesce(F.try_element_at("_rename", F.lit(name)), F.lit(name)) == output),
                   F.col(f"`{name}`")) for name in raw]
        return F.coalesce(*candidates).alias(output)

    return joined.select(*[value_of(o) for o in outputs], "sheetname", "sheet_facility_group_id", "check_account")


def pick_sheet(rows: DataFrame, preferred: str, position: str = "position") -> DataFrame:
    """Rows of the preferred sheet when the delivery has it, else of the first sheet."""
    name = rows.agg(
        F.coalesce(F.max(F.when(F.col("sheetname") == preferred, F.col("sheetname"))),
                   F.min_by("sheetname", position)).alias("n")).select("n").scalar()
    return rows.where(F.col("sheetname") == name)

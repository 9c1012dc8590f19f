"""The collections chain: bank lines and postings in, product tables out.

Each product is written once and read back, so the large inputs are scanned
once however many products and reports follow from them.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsledger.plans import receipts, report
from opsledger.plans.policy import Policies
from opsledger.session import stored
from opsledger.sources.writers import load_by_key, read_table


def load_bank_lines(lines: DataFrame, load_id: int, path: str) -> DataFrame:
    """Bank line table after a delivery: delivered days replace the days already there."""
    load_by_key(lines, load_id, path, "sheet_date")
    return read_table(lines.sparkSession, path)


def receipt_tables(lines: DataFrame, detail: DataFrame, policies: Policies, root: str) -> dict[str, DataFrame]:
    """Measures, facility receipts, sheet receipts and what is left over.

    The measures hold one row per sheet, day and facility. Lines of unregistered sheets and lines without a date are in
    ``leftover_receipts``, so no money goes unseen.
    """
    measures = stored(receipts.receipt_measures(lines, detail, policies), f"{root}/receipt_measures") \
        .repartition(*receipts.DAY_KEYS)
    return {
        "receipt_measures": measures,
        "facility_receipts": stored(receipts.facility_from_measures(measures, policies), f"{root}/facility_receipts"),
        "sheet_receipts": stored(receipts.sheet_from_measures(measures), f"{root}/sheet_receipts"),
        "leftover_receipts": stored(receipts.leftover_receipts(lines, policies), f"{root}/leftover_receipts")}


def report_tables(products: dict[str, DataFrame], lines: DataFrame, calendar: DataFrame, deducts: DataFrame,
                  facility_names: DataFrame, targets: DataFrame, as_of: date, root: str,
                  start: date, include_weekends: bool = False) -> dict[str, DataFrame]:
    """Day x facility base, collections report and sheet report from the receipt tables."""
    facility = products["facility_receipts"]
    ids = facility.select(F.col("dist_facility_group_id").alias("facility_group_id"))
    base = stored(report.date_facility_base(calendar, lines, ids, include_weekends), f"{root}/date_facility_base")
    collections = report.collections_report(base, facility, deducts, calendar, facility_names, targets, as_of, start)
    return {"date_facility_base": base, "collections_report": collections,
            "sheet_report": report.sheet_report(products["sheet_receipts"], calendar)}

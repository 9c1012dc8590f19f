"""Scanned documents: register feed and business-day review SLA."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsledger.functions import scalars as X
from opsledger.operators.joins import lookup_left
from opsledger.operators.schema import rename_map
from opsledger.sources.readers import read_partition
from opsledger.sources.writers import replace_table, write_partitioned

# Column names of the register export.
REGISTER_NAMES = {
    "Assigned To": "assigned_to",
    "Scanned By": "scanned_by",
    "Scan Date": "scan_dt",
    "Document ID": "document_id",
    "Patient Acct No + Name": "patient_id_name",
    "Document Type": "document_type",
    "Custom Name": "custom_name",
    "Document Facility Name": "document_facility_name",
    "Appointment Practice Name": "appointment_facility_name",
    "Reviewed": "reviewed",
    "Reviewer Name": "reviewer_name",
    "Reviewed Date": "reviewed_dt",
    "High Priority": "high_priority",
    "Publish To EHX": "publish_to_ehx",
    "Migrated": "migrated",
}

# Fixed value: the assignee whose documents are due within the fast SLA.
FAST_ASSIGNEE = "Incoming, Referrals"


def document_feed(raw: DataFrame, as_of: date) -> DataFrame:
    """Renamed register rows stamped with their process date."""
    return rename_map(raw, REGISTER_NAMES).withColumn("process_date", F.lit(as_of).cast("date"))


def store_documents(documents: DataFrame, path: str) -> None:
    """Parquet by process date in one pass; other dates stay.

    A feed has one process date, so its rows are written by the tasks that read them, one file of a date per split of the
    input. A shuffle would hold the whole feed on disk once more, and only to bring rows of this one date together. Numbers
    and names that hardly repeat fill most of a register, so its files are packed with zstd.
    """
    write_partitioned(documents, path, "process_date", in_place=True, compression="zstd")


def store_document_sla(spark: SparkSession, documents_path: str, as_of: date, table_path: str,
                       calendar: DataFrame | None = None) -> None:
    """The SLA table of one process date: its partition is read, judged and replaces the stored table."""
    documents = read_partition(spark, documents_path, "process_date", as_of).drop("process_date")
    replace_table(document_sla(documents, calendar), table_path, refuse_empty=True)


def document_sla(documents: DataFrame, calendar: DataFrame | None = None,
                 fast_assignee: str = FAST_ASSIGNEE) -> DataFrame:
    """Business days from scan to review and whether the review was in time; unreviewed is 0 and not in time.

    With a calendar the scan date's week comes along.
    """
    dated = documents.withColumns({"scan_dt": X.lenient_date("scan_dt"), "reviewed_dt": X.lenient_date("reviewed_dt")})
    flagged = dated.withColumns({
        "review_flag": X.flag(F.col("reviewed_dt").isNotNull()),
        "incref": X.flag(F.col("assigned_to") == fast_assignee)})
    counted = flagged.withColumn(
        "reviewed_days", F.when(F.col("review_flag") == 1, X.business_days("scan_dt", "reviewed_dt")).otherwise(0))
    out = counted.withColumns({
        "sla": X.sla_flag("reviewed_days", "review_flag", "incref"),
        "patient_id": X.leading_digits("patient_id_name")}).drop("patient_id_name")
    if calendar is None:
        return out
    weeks = calendar.select(F.col("date").alias("scan_dt"), F.col("calendar_week_id").alias("scan_calendar_week_id"))
    return lookup_left(out, weeks, ["scan_dt"], ["scan_calendar_week_id"])

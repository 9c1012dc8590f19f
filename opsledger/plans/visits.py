"""Patient wait time from the status log of visits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opsledger.functions import scalars as X
from opsledger.operators.joins import lookup_inner, lookup_left
from opsledger.operators.schema import rename_map, select_existing
from opsledger.operators.windows import category_rank
from opsledger.session import reliable_checkpoint, stored
from opsledger.sources.writers import replace_table

# Column names of the log export.
LOG_NAMES = {
    "Appointment Facility Name": "facility_name",
    "Appointment Provider Name": "appointment_provider_name",
    "Resource Provider Name": "resource_provider_name",
    "Appointment Date": "appointment_date",
    "Appointment Start Time": "appointment_start_time",
    "Patient Acct No": "patient_id",
    "Visit Type": "visit_type",
    "Log Time": "log_time",
    "Status": "status",
    "Time in Status": "time_in_status",
}

RAW_COLUMNS = [*LOG_NAMES.values(), "minutes_in_status", "source_file"]

VISIT_COLUMNS = ["patient_id", "start_time", "appointment_date", "facility_group_id", "facility_group_name", "visit_id",
                 "visit_type", "end_time", "patient_time", "appointment_date_calendar_week_id", "pwt"]

SPAN_KEYS = ["patient_id", "appointment_date", "facility_group_id", "facility_group_name", "visit_type"]

STATUS_KEYS = ["facility_name", "resource_provider_name", "patient_id", "visit_type", "appointment_date", "status"]


def normalise_visits(raw: DataFrame) -> DataFrame:
    """Names, types, minutes as int, and ``notype`` for a missing visit type."""
    df = rename_map(raw, LOG_NAMES)
    return df.withColumns({
        "appointment_date": X.lenient_date("appointment_date"),
        "log_time": X.lenient_timestamp("log_time"),
        "patient_id": F.col("patient_id").try_cast("bigint"),
        "minutes_in_status": X.first_digits("time_in_status"),
        "visit_type": F.coalesce(F.col("visit_type"), F.lit("notype"))})


def raw_visits(visits: DataFrame) -> DataFrame:
    return select_existing(visits, RAW_COLUMNS)


def attach_visit_keys(visits: DataFrame) -> DataFrame:
    """Visit key (patient, day, clinic prefix, visit type number) and its group key without the type."""
    parts = [F.col("patient_id"), X.iso_date("appointment_date"), X.prefix("facility_group_name")]
    return visits.withColumns({
        "visit_id": X.key_parts(*parts, "visit_type_id"),
        "visit_id_group": X.key_parts(*parts)})


def _time_then_minutes() -> Column:
    """Order of log rows as one number: microseconds, then minutes.

    A number is kept in place by the hash aggregation; a struct would turn it
    into a sort of all log rows.
    """
    micros = X.wall_micros("log_time")
    minutes = F.coalesce(F.col("minutes_in_status"), F.lit(-1)) + F.lit(1)
    return (micros.cast("decimal(20,0)") * F.lit(10_000_000_000).cast("decimal(11,0)") + minutes).cast("decimal(38,0)")


def log_spans(visits: DataFrame) -> DataFrame:
    """First and last log time and last minutes per patient, day, clinic and visit type.

    Only numbers and times are aggregated, in place and before the shuffle: a
    visit or clinic with very many log rows does not fill one task.
    """
    return visits.groupBy(*SPAN_KEYS).agg(
        F.min("log_time").alias("start_time"), F.max("log_time").alias("end_time"),
        F.max_by("minutes_in_status", _time_then_minutes()).alias("last_minutes"))


def visit_times(spans: DataFrame) -> DataFrame:
    """One row per visit key. Clinics that share a prefix share the visit; the smaller group id names it."""
    return spans.groupBy("visit_id", "visit_id_group").agg(
        F.min("start_time").alias("start_time"), F.max("end_time").alias("end_time"),
        F.max_by("last_minutes", F.struct("end_time", "last_minutes")).alias("last_minutes"),
        F.min("patient_id").alias("patient_id"), F.min("appointment_date").alias("appointment_date"),
        F.min("facility_group_id").alias("facility_group_id"),
        F.min_by("facility_group_name", F.struct("facility_group_id", "facility_group_name")).alias("facility_group_name"),
        F.min("visit_type").alias("visit_type"))


def group_wait(visits: DataFrame) -> DataFrame:
    """Wait of a visit group on each of its visits: span of the group plus minutes of its last status, 4 decimals.

    A group holds at most one row per visit type, so the window is small.
    """
    group = Window.partitionBy("visit_id_group")
    last = F.row_number().over(group.orderBy(
        F.col("end_time").desc(), F.col("last_minutes").desc_nulls_last(), F.col("visit_id")))
    marked = visits.withColumn("_rn", last)
    extra = F.max(F.when(F.col("_rn") == 1, F.col("last_minutes"))).over(group)
    span = X.seconds_between(F.min("start_time").over(group), F.max("end_time").over(group)) / F.lit(60.0)
    return marked.withColumn("pwt", F.round(span + extra.cast("double"), 4)).drop("_rn")


def visit_wait_time(visits: DataFrame, clinics: DataFrame, calendar: DataFrame,
                    on_duplicate: str = "raise") -> DataFrame:
    """Minutes per visit and per visit group. ``clinics``: facility_name, facility_group_id, facility_group_name."""
    at_clinics = lookup_inner(visits, clinics, ["facility_name"], ["facility_group_id", "facility_group_name"], on_duplicate)
    # the log is read once; ranking and the rest start from one row per visit
    spans = reliable_checkpoint(log_spans(at_clinics))
    keyed = attach_visit_keys(category_rank(spans, "visit_type", "visit_type_id"))
    timed = group_wait(visit_times(keyed)).withColumn("patient_time", X.minutes_between("start_time", "end_time"))
    return lookup_left(timed, _weeks(calendar), ["appointment_date"], ["appointment_date_calendar_week_id"],
                       on_duplicate).select(*VISIT_COLUMNS)


def status_time_summary(visits: DataFrame, clinics: DataFrame, calendar: DataFrame,
                        on_duplicate: str = "raise") -> DataFrame:
    """Minutes per status of each patient's day, with clinic and week."""
    summed = visits.groupBy(*STATUS_KEYS).agg(F.sum("minutes_in_status").alias("minutes_in_status"))
    at_clinics = lookup_inner(summed, clinics, ["facility_name"], ["facility_group_id", "facility_group_name"], on_duplicate)
    return lookup_left(at_clinics, _weeks(calendar), ["appointment_date"], ["appointment_date_calendar_week_id"], on_duplicate)


def store_visits(raw: DataFrame, clinics: DataFrame, calendar: DataFrame, root: str) -> dict[str, str]:
    """The raw, wait time and status tables of an export of any number of files; returns their places.

    The raw table is written first and the other two start from it, so the export is read once.
    """
    places = {n: f"{root}/{n}" for n in ("raw_visits", "visit_wait_time", "status_time_summary")}
    visits = stored(normalise_visits(raw), f"{root}/normalised")
    replace_table(raw_visits(visits), places["raw_visits"], refuse_empty=True)
    replace_table(visit_wait_time(visits, clinics, calendar), places["visit_wait_time"])
    replace_table(status_time_summary(visits, clinics, calendar), places["status_time_summary"])
    return places


def _weeks(calendar: DataFrame) -> DataFrame:
    return calendar.select(F.col("date").alias("appointment_date"),
                           F.col("calendar_week_id").alias("appointment_date_calendar_week_id"))

"""Collections reports: dense day x facility against target, and per sheet."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opsledger.functions import scalars as X
from opsledger.operators.joins import cross_fill, dates_in_touched_weeks, left_agg_chain, lookup_left
from opsledger.operators.schema import weekday_only

def calendar_between(spark: SparkSession, lo: Column, hi: Column) -> DataFrame:
    """Calendar days from ``lo`` to ``hi``: date, calendar_week_id, year, period (month), week."""
    days = spark.range(1).select(lo.alias("lo"), hi.alias("hi")) \
        .select(F.explode(F.sequence("lo", "hi")).alias("date"))
    return days.select(
        "date", X.week_number("date").alias("calendar_week_id"), F.year("date").alias("year"),
        F.month("date").alias("period"), F.weekofyear("date").alias("week"))


def date_facility_base(calendar: DataFrame, fact: DataFrame, facilities: DataFrame,
                       include_weekends: bool = False) -> DataFrame:
    """Days of the weeks touched by the fact x facilities, weekdays only unless asked."""
    days = dates_in_touched_weeks(calendar, fact, "sheet_date")
    if not include_weekends:
        days = weekday_only(days, "date")
    return cross_fill(days, facilities.select("facility_group_id").distinct()).select("date", "facility_group_id")


def collections_report_base(base: DataFrame, receipts: DataFrame, deducts: DataFrame) -> DataFrame:
    """Receipts and deduction per base day and facility; nothing found is 0."""
    return left_agg_chain(base, receipts, deducts)


def densify_report(calendar: DataFrame, report: DataFrame, facility_names: DataFrame,
                   start: date, on_duplicate: str = "raise") -> DataFrame:
    """Every calendar day from ``start`` x every facility of the report, gaps 0, net amount, facility name."""
    days = calendar.where(F.col("date") >= F.lit(start)).select(
        F.col("date").alias("bank_dept_dt"), F.col("calendar_week_id").alias("bank_dept_calendar_week_id"),
        F.col("year").alias("bank_dept_year"), F.col("period").alias("bank_dept_period"),
        F.col("week").alias("bank_dept_week"))
    grid = cross_fill(days, report.select("facility_group_id").distinct(), "bank_dept_dt")
    filled = grid.join(report.withColumnRenamed("date", "bank_dept_dt"), ["bank_dept_dt", "facility_group_id"], "left") \
        .withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in ("amount", "deduct")}) \
        .withColumn("net_amount", F.col("amount") - F.col("deduct"))
    return lookup_left(filled, facility_names, ["facility_group_id"], ["facility_group_name"], on_duplicate)


def period_flags(report: DataFrame, calendar: DataFrame, as_of: date, start: date) -> DataFrame:
    """Closed-week and current year / period / week flags at ``as_of``; all 0 when the calendar lacks that day."""
    today = calendar.where((F.col("date") == F.lit(as_of)) & (F.col("date") >= F.lit(start)))

    def at_today(column: str) -> Column:
        return today.select(F.max(column)).scalar()

    return report.withColumns({
        "week_closed": X.flag(F.col("bank_dept_calendar_week_id") < at_today("calendar_week_id")),
        "current_year": X.flag(F.col("bank_dept_year") == at_today("year")),
        "current_period": X.flag(F.col("bank_dept_period") == at_today("period")),
        "current_week": X.flag(F.col("bank_dept_calendar_week_id") == at_today("calendar_week_id"))})


def target_bands(report: DataFrame, targets: DataFrame, on_duplicate: str = "raise") -> DataFrame:
    """Daily target (0 without one) and its bands. ``targets``: date, facility_group_id, target."""
    daily = targets.select(F.col("date").cast("date").alias("bank_dept_dt"), "facility_group_id",
                           F.col("target").alias("daily_coll_target"))
    joined = lookup_left(report, daily, ["bank_dept_dt", "facility_group_id"], ["daily_coll_target"], on_duplicate) \
        .withColumn("daily_coll_target", F.coalesce(F.col("daily_coll_target"), F.lit(0.0)))
    return joined.withColumns({f"daily_coll_target{band}": X.share_of("daily_coll_target", share)
                               for band, share in X.TARGET_BANDS.items()})


def collections_report(base: DataFrame, receipts: DataFrame, deducts: DataFrame, calendar: DataFrame,
                       facility_names: DataFrame, targets: DataFrame, as_of: date,
                       start: date, on_duplicate: str = "raise") -> DataFrame:
    """The dense facility x day report with targets and period flags."""
    report = collections_report_base(base, receipts, deducts)
    dense = densify_report(calendar, report, facility_names, start, on_duplicate)
    return target_bands(period_flags(dense, calendar, as_of, start), targets, on_duplicate)


def sheet_report(sheet: DataFrame, calendar: DataFrame, on_duplicate: str = "raise") -> DataFrame:
    """Sheet receipts with their calendar week, period and year."""
    days = calendar.select(F.col("date").alias("sheet_date"), F.col("week").alias("sheet_week"),
                           F.col("period").alias("sheet_period"), F.col("year").alias("sheet_year"))
    return lookup_left(sheet, days, ["sheet_date"], ["sheet_week", "sheet_period", "sheet_year"], on_duplicate)

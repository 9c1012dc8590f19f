"""Queries over the jobs: receipts, reports, visits, contacts, documents, fees, targets and purges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsledger.catalog import domain as D
from opsledger.catalog.registry import Tables, query, sql_money, with_money
from opsledger.operators.aggregates import sum_by
from opsledger.operators.joins import union_by_name
from opsledger.plans import collections, contacts, documents, fees, maintenance, receipts, report, visits
from opsledger.plans.policy import default_policies
from opsledger.session import literal_table, run_folder, stored
from opsledger.sources.readers import read_delimited, read_partition
from opsledger.sources.writers import read_table, replace_table

FACILITY_MONEY = ("allocated_pmt", "dist_payment", "amount")
SHEET_MONEY = ("amount", "dist_payment", "posted_nodb_pmt", "unposted_lag", "unposted_workload", "allocated_pmt",
               "posted_pmt", "unposted_pmt")

FACILITY_SELECT = ("SELECT sheet_name, sheet_date, dist_facility_group_id, "
                   + ", ".join(f"{sql_money(c)} AS {c}" for c in FACILITY_MONEY) + " FROM facility")

SHEET_SELECT = f"""SELECT sheet_name, sheet_date, {sql_money('amount')} AS amount, {sql_money('dist_payment')} AS dist_payment,
    {sql_money('posted_nodb_pmt')} AS posted_nodb_pmt, {sql_money('unposted_lag')} AS unposted_lag,
    {sql_money('unposted_workload')} AS unposted_workload, {sql_money('amount - dist_payment')} AS allocated_pmt,
    {sql_money('dist_payment + posted_nodb_pmt')} AS posted_pmt,
    {sql_money('unposted_workload + unposted_lag')} AS unposted_pmt FROM sheet"""


# ---- bank lines -----------------------------------------------------------------------------------

NORMALISED = """step1 AS (SELECT r.*, TRY_CAST(r.amount AS DECIMAL(18,2)) AS a, TRY_CAST(r.debit AS DECIMAL(18,2)) AS d,
      TRY_CAST(r.credit AS DECIMAL(18,2)) AS c,
      coalesce(nullif(regexp_extract(r.description, 'IND ID:(\\d+)', 1), ''), 'No ID') AS tag FROM raw r),
step2 AS (SELECT s.*, CASE WHEN check_account = 1 THEN coalesce(m.merch_facility_group_id, 0) END AS mf
    FROM step1 s LEFT JOIN mer m ON m.merchant_id = s.tag),
step3 AS (SELECT s.*, coalesce(mf, sheet_facility_group_id) AS lf,
      CASE sheetname WHEN 'P15' THEN 'S15' WHEN 'P14' THEN 'S14' ELSE sheetname END AS sheet FROM step2 s),
step4 AS (SELECT s.*, CASE WHEN coalesce(payment_id, 0) = 4 AND manual_distrib IS NOT NULL THEN manual_distrib
      ELSE coalesce(m.facility, s.sheet) END AS fname FROM step3 s LEFT JOIN mer m ON m.merch_facility_group_id = s.lf),
step5 AS (SELECT s.sheet_date, s.description,
      CASE WHEN a IS NULL AND sheet_facility_group_id IN (4, 5, 11, 12, 13, 14, 15, 18) THEN coalesce(d, 0) + coalesce(c, 0) ELSE a END AS amount,
      coalesce(payment_id, 0) AS payment_id, sheet AS sheetname, sheet_facility_group_id, check_account, m.merchant_id,
      fname AS facility, m.merch_facility_group_id, coalesce(f.facility_group_id, 0) AS facility_group_id
    FROM step4 s LEFT JOIN fac f ON f.facility_group_name = s.fname LEFT JOIN mer m ON m.facility = s.fname)"""


@query("d1_normalise_bank_lines", D.with_tables(D.SHEET_ROWS, D.MERCHANTS, D.FACILITIES, NORMALISED) + f"""
SELECT sheet_date, description, {sql_money('amount')} AS amount, payment_id, sheetname, sheet_facility_group_id, check_account,
  merchant_id, facility, merch_facility_group_id, facility_group_id FROM step5""")
def d1(t: Tables) -> DataFrame:
    lines = receipts.normalise_bank_lines(D.sheet_rows(t), D.merchants(t), D.facilities(t), D.ALIASES)
    return with_money(lines, "amount")


@query("d2_account_rule", D.with_tables(D.SHEET_ROWS, D.MERCHANTS) + """
SELECT line_id, CASE WHEN check_account = 1 THEN coalesce(m.merch_facility_group_id, 0) END AS merchant_facility,
  coalesce(CASE WHEN check_account = 1 THEN coalesce(m.merch_facility_group_id, 0) END, sheet_facility_group_id) AS line_facility
FROM raw LEFT JOIN mer m ON m.merchant_id = coalesce(nullif(regexp_extract(description, 'IND ID:(\\d+)', 1), ''), 'No ID')""")
def d2(t: Tables) -> DataFrame:
    from opsledger.functions import scalars as X
    from opsledger.operators.joins import lookup_left
    rows = lookup_left(D.sheet_rows(t).withColumn("merchant_id", X.tagged_id("description")), D.merchants(t),
                       ["merchant_id"], ["merch_facility_group_id"])
    merchant, line = receipts.account_facility("check_account", "merch_facility_group_id", "sheet_facility_group_id")
    return rows.select("line_id", merchant.cast("bigint").alias("merchant_facility"), line.cast("bigint").alias("line_facility"))


# ---- postings and allocation ----------------------------------------------------------------------

@query("d3_posting_detail", D.with_tables(D.LINES, D.DETAIL) + f"""
SELECT l.line_id, l.sheet_date, {sql_money('l.amount')} AS amount, l.payment_id, l.sheetname, l.merch_facility_group_id,
  d.payment_detail_id, d.posted_facility_group_id, {sql_money('d.posted_payment')} AS posted_payment
FROM lines l LEFT JOIN (SELECT * FROM detail WHERE payment_id NOT IN (1, 3, 4)) d ON d.payment_id = l.payment_id""")
def d3(t: Tables) -> DataFrame:
    return with_money(receipts.posting_detail(D.bank_lines(t), D.payment_details(t)), "amount", "posted_payment")


def _classified(t: Tables) -> DataFrame:
    detail = receipts.posting_detail(D.bank_lines(t), D.payment_details(t))
    return receipts.classify_receipts(detail, default_policies(t.spark))


@query("d4_classify_receipts", D.with_tables(D.LINES, D.DETAIL, D.CLASSES) + f"""
SELECT line_id, payment_detail_id, sheetname, payment_id, receipt_class, {sql_money('amount')} AS amount FROM cls""")
def d4(t: Tables) -> DataFrame:
    return with_money(_classified(t).select("line_id", "payment_detail_id", "sheetname", "payment_id", "receipt_class", "amount"),
                      "amount")


@query("d5_dist_source", D.with_tables(D.LINES, D.DETAIL, D.CLASSES) + f"""
SELECT line_id, payment_detail_id, sheetname, {sql_money('dist')} AS dist_payment, fac AS dist_facility_group_id, pooled
FROM cls WHERE receipt_class = 'distributed' AND sheetname = 'C'""")
def d5(t: Tables) -> DataFrame:
    rows = _classified(t).where((F.col("receipt_class") == "distributed") & (F.col("sheetname") == "C"))
    return with_money(rows.select("line_id", "payment_detail_id", "sheetname", "dist_payment", "dist_facility_group_id", "pooled"),
                      "dist_payment")


def _measures(t: Tables, *sheets: str):
    policies = default_policies(t.spark)
    if sheets:
        policies = policies.only(*sheets)
    return receipts.receipt_measures(D.bank_lines(t), D.payment_details(t), policies), policies


@query("d6_split_pool_facility", D.with_tables(*D.RECEIPTS) + f"""
SELECT sheetname AS sheet, sheet_date, fac AS facility_id, {sql_money('dist_payment')} AS dist_payment
FROM distfac WHERE sheetname IN ('W', 'C')""")
def d6(t: Tables) -> DataFrame:
    measures, policies = _measures(t, "W", "C")
    return with_money(receipts.split_pool_facility(measures, policies), "dist_payment")


def _allocated(t: Tables, sheet: str) -> DataFrame:
    measures, policies = _measures(t, sheet)
    return with_money(receipts.allocate_residual(measures, policies),
                      "allocated_pmt")


for _name, _sheet in (("d7_allocate_residual_w", "W"), ("d8_allocate_residual_g", "G"), ("d9_allocate_residual_c", "C")):
    query(_name, D.with_tables(*D.RECEIPTS) + f"""
SELECT sheetname AS sheet, sheet_date, CAST(fac AS BIGINT) AS facility_id, {sql_money('allocated')} AS allocated_pmt
FROM alloc WHERE sheetname = '{_sheet}'""")(lambda t, s=_sheet: _allocated(t, s))


@query("d10_single_facility_policy", D.with_tables(D.LINES) + f"""
SELECT sheetname AS sheet_name, sheet_date, CAST(substr(sheetname, 2) AS INT) AS dist_facility_group_id,
  CAST(0 AS DOUBLE) AS allocated_pmt, {sql_money('SUM(amount)')} AS dist_payment, {sql_money('SUM(amount)')} AS amount
FROM lines WHERE sheetname LIKE 'S%' GROUP BY ALL""")
def d10(t: Tables) -> DataFrame:
    measures, policies = _measures(t, "S04", "S12", "S13", "S15", "S14", "S18", "S11")
    return with_money(receipts.facility_from_measures(measures, policies), *FACILITY_MONEY)


@query("d11_facility_collections", D.with_tables(*D.RECEIPTS) + FACILITY_SELECT + " WHERE sheet_name IN ('W', 'G', 'C')")
def d11(t: Tables) -> DataFrame:
    measures, policies = _measures(t, "W", "G", "C")
    return with_money(receipts.facility_from_measures(measures, policies), *FACILITY_MONEY)


@query("d12_sheet_collections", D.with_tables(*D.RECEIPTS, D.SHEETS) + SHEET_SELECT + " WHERE sheet_name IN ('W', 'G', 'C')")
def d12(t: Tables) -> DataFrame:
    measures, _ = _measures(t, "W", "G", "C")
    return with_money(receipts.sheet_from_measures(measures), *SHEET_MONEY)


@query("d13_combine_policies_facility", D.with_tables(*D.RECEIPTS) + FACILITY_SELECT)
def d13_facility(t: Tables) -> DataFrame:
    return with_money(receipts.facility_collections(D.bank_lines(t), D.payment_details(t), default_policies(t.spark)),
                      *FACILITY_MONEY)


@query("d13_combine_policies_sheet", D.with_tables(*D.RECEIPTS, D.SHEETS) + SHEET_SELECT)
def d13_sheet(t: Tables) -> DataFrame:
    return with_money(receipts.sheet_collections(D.bank_lines(t), D.payment_details(t), default_policies(t.spark)), *SHEET_MONEY)


@query("d13_leftover_receipts", D.with_tables(D.LINES, """odd AS (SELECT *, CASE WHEN payment_id <> 3 THEN sheet_date END AS day,
  CASE WHEN sheetname NOT IN ('W', 'G', 'C') THEN 'no policy' WHEN payment_id = 3 THEN 'no date' END AS reason FROM lines)""") + f"""
SELECT sheetname, day AS sheet_date, reason, {sql_money('sum(amount)')} AS amount, count(*) AS n_lines FROM odd WHERE reason IS NOT NULL GROUP BY ALL""")
def d13_leftover(t: Tables) -> DataFrame:
    """Single sheets are not registered here, and lines of one class have no date."""
    lines = D.bank_lines(t).withColumn("sheet_date", F.when(F.col("payment_id") != 3, F.col("sheet_date")))
    return with_money(receipts.leftover_receipts(lines, default_policies(t.spark).only("W", "G", "C")), "amount")


# ---- reports --------------------------------------------------------------------------------------

BASE = """wk AS (SELECT DISTINCT calendar_week_id FROM cal WHERE date BETWEEN (SELECT min(sheet_date) FROM lines)
      AND (SELECT max(sheet_date) FROM lines)),
base AS (SELECT c.date, f.facility_group_id FROM cal c, (SELECT DISTINCT dist_facility_group_id AS facility_group_id FROM facility) f
    WHERE c.calendar_week_id IN (SELECT calendar_week_id FROM wk) AND isodow(c.date) < 6)"""

REPORT = f"""rep AS (SELECT b.date, b.facility_group_id, coalesce(r.amount, 0) AS amount, coalesce(d.deduct, 0) AS deduct
    FROM base b LEFT JOIN (SELECT sheet_date, dist_facility_group_id, SUM(amount) AS amount FROM facility GROUP BY ALL) r
      ON r.sheet_date = b.date AND r.dist_facility_group_id = b.facility_group_id
    LEFT JOIN ded d ON d.facility_group_id = r.dist_facility_group_id),
dense AS (SELECT c.date AS bank_dept_dt, c.calendar_week_id AS bank_dept_calendar_week_id, c.year AS bank_dept_year,
      c.period AS bank_dept_period, c.week AS bank_dept_week, CAST(f.facility_group_id AS INT) AS facility_group_id,
      {sql_money('coalesce(r.amount, 0)')} AS amount, CAST(coalesce(r.deduct, 0) AS DOUBLE) AS deduct, fac.facility_group_name
    FROM cal c CROSS JOIN (SELECT DISTINCT facility_group_id FROM rep) f
    LEFT JOIN rep r ON r.date = c.date AND r.facility_group_id = f.facility_group_id
    LEFT JOIN fac ON fac.facility_group_id = f.facility_group_id WHERE c.date >= DATE '{D.REPORT_START}')"""

NOW = f"now AS (SELECT max(calendar_week_id) AS w, max(year) AS y, max(period) AS p FROM cal WHERE date = DATE '{D.AS_OF}')"

REPORT_TABLES = (*D.RECEIPTS, D.CALENDAR, D.FACILITIES, D.DEDUCTS, D.TARGETS, BASE, REPORT, NOW)


def _products(t: Tables) -> dict[str, DataFrame]:
    return collections.receipt_tables(D.bank_lines(t), D.payment_details(t), default_policies(t.spark),
                                      run_folder(t.spark, "collections"))


def _facility_receipts(t: Tables) -> DataFrame:
    return _products(t)["facility_receipts"]


def _base(t: Tables, calendar: DataFrame, facility_receipts: DataFrame) -> DataFrame:
    ids = facility_receipts.select(F.col("dist_facility_group_id").alias("facility_group_id"))
    return report.date_facility_base(calendar, D.bank_lines(t), ids)


@query("d14_date_facility_base", D.with_tables(*D.RECEIPTS, D.CALENDAR, BASE) + "SELECT * FROM base")
def d14(t: Tables) -> DataFrame:
    return _base(t, D.order_calendar(t), _facility_receipts(t))


def _report_base(t: Tables, calendar: DataFrame) -> DataFrame:
    facility = _facility_receipts(t)
    base = report.collections_report_base(_base(t, calendar, facility), facility, D.deductions(t))
    return with_money(stored(base, run_folder(t.spark, "report_base")), "amount")


@query("d15_collections_report_base", D.with_tables(*REPORT_TABLES) + f"""
SELECT date, facility_group_id, {sql_money('amount')} AS amount, CAST(deduct AS DOUBLE) AS deduct FROM rep""")
def d15(t: Tables) -> DataFrame:
    return _report_base(t, D.order_calendar(t))


DENSE_COLUMNS = """bank_dept_dt, bank_dept_calendar_week_id, bank_dept_year, bank_dept_period, bank_dept_week, facility_group_id,
  amount, deduct, amount - deduct AS net_amount, facility_group_name"""


@query("d16_densify_report", D.with_tables(*REPORT_TABLES) + f"SELECT {DENSE_COLUMNS} FROM dense")
def d16(t: Tables) -> DataFrame:
    calendar = D.order_calendar(t)
    return report.densify_report(calendar, _report_base(t, calendar), D.facilities(t), D.REPORT_START)


FLAGS = """CASE WHEN bank_dept_calendar_week_id < now.w THEN 1 ELSE 0 END AS week_closed,
  CASE WHEN bank_dept_year = now.y THEN 1 ELSE 0 END AS current_year, CASE WHEN bank_dept_period = now.p THEN 1 ELSE 0 END AS current_period,
  CASE WHEN bank_dept_calendar_week_id = now.w THEN 1 ELSE 0 END AS current_week"""


@query("d17_period_flags", D.with_tables(D.CALENDAR, NOW) + f"""
SELECT date AS bank_dept_dt, {FLAGS} FROM (SELECT date, calendar_week_id AS bank_dept_calendar_week_id, year AS bank_dept_year,
  period AS bank_dept_period FROM cal) CROSS JOIN now""")
def d17(t: Tables) -> DataFrame:
    calendar = D.order_calendar(t)
    days = calendar.select(F.col("date").alias("bank_dept_dt"), F.col("calendar_week_id").alias("bank_dept_calendar_week_id"),
                           F.col("year").alias("bank_dept_year"), F.col("period").alias("bank_dept_period"))
    return report.period_flags(days, calendar, D.AS_OF, D.REPORT_START).select(
        "bank_dept_dt", "week_closed", "current_year", "current_period", "current_week")


BANDS = """coalesce(tgt.target, 0) AS daily_coll_target, coalesce(tgt.target, 0) * 0.86::DOUBLE AS daily_coll_target_86,
  coalesce(tgt.target, 0) * 1.0::DOUBLE AS daily_coll_target_100, coalesce(tgt.target, 0) * 1.12::DOUBLE AS daily_coll_target_112"""


@query("d18_target_bands", D.with_tables(D.CALENDAR, D.FACILITIES, D.TARGETS) + f"""
SELECT c.date AS bank_dept_dt, f.facility_group_id, {BANDS} FROM cal c CROSS JOIN fac f
LEFT JOIN tgt ON tgt.date = c.date AND tgt.facility_group_id = f.facility_group_id""")
def d18(t: Tables) -> DataFrame:
    from opsledger.operators.joins import cross_fill
    grid = cross_fill(D.order_calendar(t).select("date"), D.facilities(t).select("facility_group_id"))
    return report.target_bands(grid.withColumnRenamed("date", "bank_dept_dt"), D.targets(t))


@query("d16_d18_collections_report", D.with_tables(*REPORT_TABLES) + f"""
SELECT {DENSE_COLUMNS}, {FLAGS}, {BANDS} FROM dense CROSS JOIN now
LEFT JOIN tgt ON tgt.date = bank_dept_dt AND tgt.facility_group_id = dense.facility_group_id""".replace(
    "deduct, facility_group_id", "deduct, dense.facility_group_id").replace("bank_dept_week, facility_group_id", "bank_dept_week, dense.facility_group_id"))
def collections_report(t: Tables) -> DataFrame:
    reports = collections.report_tables(
        _products(t), D.bank_lines(t), D.order_calendar(t), D.deductions(t), D.facilities(t), D.targets(t), D.AS_OF,
        run_folder(t.spark, "reports"), D.REPORT_START)
    return with_money(reports["collections_report"], "amount").withColumn("net_amount", F.col("amount") - F.col("deduct"))


# An amount that is no number, of a sheet without debit and credit, adds nothing to its day.
CHAIN_LINES = """lines AS (SELECT sheet_date, coalesce(amount, 0) AS amount, payment_id, sheetname, merch_facility_group_id FROM step5)"""


@query("chain_collections_report", D.with_tables(
    D.SHEET_ROWS, D.MERCHANTS, D.FACILITIES, NORMALISED, CHAIN_LINES, D.DETAIL, D.CLASSES, D.ALLOCATION, D.CALENDAR, D.DEDUCTS, D.TARGETS,
    BASE, REPORT, NOW) + f"""
SELECT {DENSE_COLUMNS}, {FLAGS}, {BANDS} FROM dense CROSS JOIN now
LEFT JOIN tgt ON tgt.date = bank_dept_dt AND tgt.facility_group_id = dense.facility_group_id""".replace(
    "deduct, facility_group_id", "deduct, dense.facility_group_id").replace("bank_dept_week, facility_group_id", "bank_dept_week, dense.facility_group_id"))
def chain(t: Tables) -> DataFrame:
    """From sheet rows to the report: lines are made, stored by day, delivered again for some days, matched, shared out, reported."""
    rows, bank = D.sheet_rows(t), run_folder(t.spark, "bank_lines")
    lines = receipts.normalise_bank_lines(rows, D.merchants(t), D.facilities(t), D.ALIASES)
    collections.load_bank_lines(lines, "first delivery", bank)
    stored_lines = collections.load_bank_lines(lines.where(F.dayofmonth("sheet_date") <= 3), "corrections", bank)
    products = collections.receipt_tables(stored_lines, D.payment_details(t), default_policies(t.spark), run_folder(t.spark, "chain"))
    reports = collections.report_tables(products, stored_lines, D.order_calendar(t), D.deductions(t), D.facilities(t), D.targets(t), D.AS_OF,
                                        run_folder(t.spark, "chain_reports"), D.REPORT_START)
    return with_money(reports["collections_report"], "amount").withColumn("net_amount", F.col("amount") - F.col("deduct"))


@query("d19_sheet_report", D.with_tables(*D.RECEIPTS, D.SHEETS, D.CALENDAR) + f"""
SELECT s.*, c.week AS sheet_week, c.period AS sheet_period, c.year AS sheet_year FROM ({SHEET_SELECT}) s
LEFT JOIN cal c ON c.date = s.sheet_date""")
def d19(t: Tables) -> DataFrame:
    sheets = receipts.sheet_collections(D.bank_lines(t), D.payment_details(t), default_policies(t.spark))
    return with_money(report.sheet_report(sheets, D.order_calendar(t)), *SHEET_MONEY)


# ---- visits ---------------------------------------------------------------------------------------

@query("d20_normalise_visits", D.with_tables(D.VISITS) + "SELECT * FROM vis")
def d20(t: Tables) -> DataFrame:
    return visits.normalise_visits(D.visit_export(t)).select(
        "facility_name", "resource_provider_name", "patient_id", "appointment_date", "visit_type", "log_time", "status",
        "minutes_in_status")


@query("d20_visit_tables", D.with_tables(D.VISITS, D.CLINICS) + """
SELECT 'raw_visits' AS table_name, count(*) AS n FROM vis UNION ALL
SELECT 'status_time_summary', count(*) FROM (SELECT DISTINCT facility_name, resource_provider_name, patient_id, visit_type, appointment_date,
  status FROM vis JOIN clin USING (facility_name)) UNION ALL
SELECT 'visit_wait_time', count(*) FROM (SELECT DISTINCT patient_id, appointment_date, substr(facility_group_name, 1, 3), visit_type
  FROM vis JOIN clin USING (facility_name))""")
def d20_tables(t: Tables) -> DataFrame:
    """The visit job from an export to its three stored tables."""
    places = visits.store_visits(D.visit_export(t), D.clinics(t), D.event_calendar(t), run_folder(t.spark, "visits"))
    return union_by_name(*[read_table(t.spark, p).agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("table_name"), "n")
                           for n, p in places.items()])


WAIT = """ranked AS (SELECT *, dense_rank() OVER (ORDER BY visit_type) - 1 AS visit_type_id FROM vis JOIN clin USING (facility_name)),
keyed AS (SELECT *, patient_id || strftime(appointment_date, '%Y-%m-%d') || substr(facility_group_name, 1, 3) AS visit_id_group,
      patient_id || strftime(appointment_date, '%Y-%m-%d') || substr(facility_group_name, 1, 3) || visit_type_id AS visit_id FROM ranked),
ends AS (SELECT *, first_value(log_time) OVER (PARTITION BY visit_id ORDER BY log_time) AS start_time,
      first_value(log_time) OVER (PARTITION BY visit_id ORDER BY log_time DESC, minutes_in_status DESC) AS end_time,
      first_value(minutes_in_status) OVER (PARTITION BY visit_id ORDER BY log_time DESC, minutes_in_status DESC) AS last_minutes FROM keyed),
one AS (SELECT DISTINCT visit_id, visit_id_group, patient_id, appointment_date, facility_group_id, facility_group_name, visit_type,
      start_time, end_time, last_minutes FROM ends),
grp AS (SELECT visit_id_group, min(start_time) AS lo, max(end_time) AS hi, arg_max(last_minutes, end_time) AS extra FROM one GROUP BY ALL)"""


@query("d21_visit_wait_time", D.with_tables(D.VISITS, D.CLINICS, D.EVENT_CALENDAR, WAIT) + """
SELECT patient_id, start_time, appointment_date, facility_group_id, facility_group_name, visit_id, visit_type, end_time,
  CAST(round(date_diff('second', date_trunc('second', start_time), date_trunc('second', end_time)) / 60.0::DOUBLE) AS INT) AS patient_time,
  appointment_date_calendar_week_id,
  round(date_diff('second', date_trunc('second', lo), date_trunc('second', hi)) / 60.0::DOUBLE + CAST(extra AS DOUBLE), 4) AS pwt
FROM one JOIN grp USING (visit_id_group) LEFT JOIN ecal USING (appointment_date)""")
def d21(t: Tables) -> DataFrame:
    return visits.visit_wait_time(visits.normalise_visits(D.visit_export(t)), D.clinics(t), D.event_calendar(t))


@query("d22_status_time_summary", D.with_tables(D.VISITS, D.CLINICS, D.EVENT_CALENDAR) + """
SELECT facility_name, resource_provider_name, patient_id, visit_type, appointment_date, status,
  CAST(SUM(minutes_in_status) AS BIGINT) AS minutes_in_status, facility_group_id, facility_group_name, appointment_date_calendar_week_id
FROM vis JOIN clin USING (facility_name) LEFT JOIN ecal USING (appointment_date) GROUP BY ALL""")
def d22(t: Tables) -> DataFrame:
    return visits.status_time_summary(visits.normalise_visits(D.visit_export(t)), D.clinics(t), D.event_calendar(t))


# ---- contacts -------------------------------------------------------------------------------------

def contact_export(t: Tables) -> DataFrame:
    """Customers as a text export: some names missing, invisible characters, words for yes and no, bad dates."""
    key = F.col("c_custkey")
    text = key.cast("string")
    born = F.date_add(F.lit("1950-01-01").cast("date"), (key % 20000).cast("int")).cast("string")
    words = F.array(*[F.lit(w) for w in ("yes", "No", "Y", "n/a", "maybe", "yellow")])
    return t.customer.select(
        F.when(key % 11 == 0, F.concat(F.lit("\u200B"), text)).otherwise(text).alias("Patient ID"),
        F.concat(F.lit("\uFEFF "), F.col("c_name"), F.lit(" ")).alias("Patient Name"),
        F.when(key % 9 == 0, "31/12/1999").otherwise(born).alias("Patient DOB"),
        F.when(key % 10 == 0, "old").otherwise((key % 90).cast("string")).alias("Patient Age"),
        F.concat(F.col("c_mktsegment"), F.lit("@"), text).alias("Patient E-mail"),
        F.col("c_acctbal").cast("decimal(18,2)").cast("string").alias("Patient Imm Registry Notification"),
        F.element_at(words, (key % 6 + 1).cast("int")).alias("Patient Web Enabled"),
        F.element_at(words, (key % 5 + 1).cast("int")).alias("Patient Text Enabled"),
        F.lit("x").alias("Undeclared Column"))


_GIVEN = {
    "patient_id": "c_custkey",
    "patient_name": "c_name",
    "patient_dob": "CASE WHEN c_custkey % 9 <> 0 THEN DATE '1950-01-01' + CAST(c_custkey % 20000 AS INT) END",
    "patient_age": "CASE WHEN c_custkey % 10 <> 0 THEN CAST(c_custkey % 90 AS INT) END",
    "patient_e_mail": "c_mktsegment || '@' || c_custkey",
    "patient_imm_registry_notification": "CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DOUBLE)",
    "patient_web_enabled": "CASE c_custkey % 6 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' WHEN 2 THEN 'Yes' WHEN 3 THEN 'No' WHEN 4 THEN 'maybe' ELSE 'Yes' END",
    "patient_text_enabled": "CASE c_custkey % 5 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' WHEN 2 THEN 'Yes' WHEN 3 THEN 'No' ELSE 'maybe' END",
}
_SQL_TYPES = {"string": "VARCHAR", "date": "DATE"}
CONTACT_SELECT = "SELECT " + ", ".join(
    f"{_GIVEN.get(n) or 'CAST(NULL AS ' + _SQL_TYPES.get(k, k.upper()) + ')'} AS {n}"
    for n, k in ((contacts.NAMES[e], k) for e, k in contacts.EXPORT_COLUMNS.items())) + " FROM customer"


def _contacts_out(df: DataFrame) -> DataFrame:
    return df.withColumn("patient_imm_registry_notification", F.col("patient_imm_registry_notification").cast("double"))


@query("d23_contact_feed", CONTACT_SELECT)
def d23(t: Tables) -> DataFrame:
    path = run_folder(t.spark, "contact_export")
    _text_export(contact_export(t), path)
    raw_table, mart_table = run_folder(t.spark, "contacts_raw"), run_folder(t.spark, "contacts_mart")
    contacts.store_contacts(read_delimited(t.spark, path, encoding="UTF-16LE"), [raw_table, mart_table])
    return _contacts_out(read_table(t.spark, mart_table))


# ---- documents ------------------------------------------------------------------------------------

def _text_export(df: DataFrame, path: str) -> None:
    """Tab-separated text in the byte order of the exports, quotes doubled, lines ended as on Windows.

    It is many times as large as the columnar table that it comes from, so its files are compressed, and of bounded length:
    each is read by one task.
    """
    df.write.options(header=True, sep="\t", encoding="UTF-16LE", lineSep="\r\n", escape='"', compression="gzip",
                     maxRecordsPerFile=500_000).csv(path)


REGISTER_COLUMNS = ", ".join(f"CAST({n} AS VARCHAR) AS {n}" for n in documents.REGISTER_NAMES.values())


@query("d24_document_feed", D.with_tables(D.REGISTER) + f"SELECT {REGISTER_COLUMNS}, DATE '{D.AS_OF}' AS process_date FROM reg")
def d24(t: Tables) -> DataFrame:
    export, path = run_folder(t.spark, "register_export"), run_folder(t.spark, "document_register")
    _text_export(D.register_export(t), export)
    documents.store_documents(documents.document_feed(read_delimited(t.spark, export, encoding="UTF-16LE"), D.AS_OF), path)
    return read_partition(t.spark, path, "process_date", D.AS_OF)


SLA_SQL = """days AS (SELECT *, CASE WHEN reviewed_dt IS NULL THEN 0 ELSE CAST(len(list_filter(
      generate_series(least(scan_dt, reviewed_dt), greatest(scan_dt, reviewed_dt), INTERVAL 1 DAY), lambda d: isodow(d) < 6)) AS INT)
      END AS reviewed_days, CASE WHEN reviewed_dt IS NULL THEN 0 ELSE 1 END AS review_flag,
      CASE WHEN assigned_to = 'Incoming, Referrals' THEN 1 ELSE 0 END AS incref FROM reg)"""


@query("d25_document_sla", D.with_tables(D.REGISTER, SLA_SQL) + """
SELECT assigned_to, scan_dt, document_id, reviewed_dt, review_flag, incref, reviewed_days,
  CASE WHEN review_flag = 1 AND reviewed_days <= CASE WHEN incref = 1 THEN 1 ELSE 3 END THEN 1 ELSE 0 END AS sla,
  TRY_CAST(nullif(regexp_extract(patient_id_name, '^(\\d+)', 1), '') AS BIGINT) AS patient_id,
  CAST(date_diff('day', DATE '1969-12-29', CAST(date_trunc('week', scan_dt) AS DATE)) // 7 AS BIGINT) AS scan_calendar_week_id FROM days""")
def d25(t: Tables) -> DataFrame:
    register, table = run_folder(t.spark, "documents"), run_folder(t.spark, "document_sla")
    feed = documents.document_feed(D.register_export(t), D.AS_OF).select(
        "assigned_to", "scan_dt", "document_id", "patient_id_name", "reviewed_dt", "process_date")
    documents.store_documents(feed, register)
    documents.store_document_sla(t.spark, register, D.AS_OF, table, D.ship_calendar(t))
    return read_table(t.spark, table)


# ---- fees -----------------------------------------------------------------------------------------

FEES_LONG = """long AS (SELECT *, 'plan_a' AS fee_plan, plan_a AS fee, 0 AS place FROM sheet
  UNION ALL SELECT *, 'plan_b', plan_b, 1 FROM sheet UNION ALL SELECT *, 'plan_c', plan_c, 2 FROM sheet),
fees AS (SELECT row_number() OVER (ORDER BY place, cpt_code) AS id_cpt_fee, cpt_description, cpt_code, cpt_group, mod_1, mod_2,
    resource_provider_type, long.fee_plan, fee, CAST(round_even(id_fee_plan, 0) AS BIGINT) AS id_fee_plan
  FROM long LEFT JOIN plans ON plans.fee_plan = long.fee_plan)"""


@query("d26_fee_schedule_long", D.with_tables(D.FEE_SHEET, D.FEE_PLANS, FEES_LONG) + "SELECT * FROM fees")
def d26(t: Tables) -> DataFrame:
    return fees.fee_schedule_long(D.fee_sheet(t), D.fee_plans(t))


@query("d27_fee_dimension", D.with_tables(D.FEE_SHEET, D.FEE_PLANS, D.PROCEDURES, FEES_LONG) + """
SELECT cpt_description, fees.cpt_code, cpt_group, fee_plan, fee, id_fee_plan, proc.cpt_id, mod_1, mod_2, resource_provider_type
FROM fees LEFT JOIN proc ON CAST(proc.cpt_code AS VARCHAR) = fees.cpt_code""")
def d27(t: Tables) -> DataFrame:
    return fees.fee_dimension(d26(t), D.procedures(t))


# ---- targets and purges ---------------------------------------------------------------------------

def target_rows(t: Tables) -> DataFrame:
    """Target sheet as text, with a padded header and an unnamed column."""
    return D.targets(t).select(
        F.col("date").cast("string").alias(" date"), F.concat(F.lit(" F"), F.col("facility_group_id").cast("string"), F.lit(" ")).alias("facility"),
        F.col("target").cast("string").alias("target "), F.col("facility_group_id").cast("string").alias("facility_group_id"),
        F.lit("x").alias("Unnamed: 4"))


TARGET_SELECT = """SELECT CAST(date AS VARCHAR) AS date, 'F' || facility_group_id AS facility, target, facility_group_id FROM tgt"""


@query("d28_target_load", D.with_tables(D.TARGETS) + f"""{TARGET_SELECT}
UNION ALL SELECT '1990-01-01', n_name, 1.5, n_nationkey FROM nation""")
def d28(t: Tables) -> DataFrame:
    old = t.nation.select(F.lit("1990-01-01").alias("date"), F.col("n_name").alias("facility"), F.lit(1.5).alias("target"),
                          F.col("n_nationkey").cast("bigint").alias("facility_group_id"))
    table = run_folder(t.spark, "targets")
    replace_table(old, table)
    sheet = target_rows(t).withColumns({"sheetname": F.lit("Targets"), "position": F.lit(2)})
    notes = sheet.limit(1).withColumns({"sheetname": F.lit("Notes"), "position": F.lit(1)})
    for _ in ("first", "again"):  # a rerun changes nothing
        maintenance.store_targets(sheet.unionByName(notes), table, "Targets")
    return read_table(t.spark, table)


PURGED_TABLES = {"bank_lines": ("lines", "sheet_date"), "posting_detail": ("det", "sheet_date"),
                 "facility_receipts": ("facility", "sheet_date"), "sheet_receipts": ("sheet", "sheet_date"),
                 "calendar": ("cal", "date"), "targets": ("tgt", "date")}
_IN_RANGE = f"BETWEEN DATE '{D.PURGE_START}' AND DATE '{D.PURGE_END}'"


@query("d29_range_purge", D.with_tables(*D.RECEIPTS, D.SHEETS, D.CALENDAR, D.TARGETS) + "\nUNION ALL ".join(f"""
SELECT '{n}' AS table_name, count(*) AS rows_before, count(*) FILTER (WHERE {c} {_IN_RANGE}) AS rows_purged,
  count(*) FILTER (WHERE NOT ({c} {_IN_RANGE})) AS rows_after, count(*) FILTER (WHERE NOT ({c} {_IN_RANGE})) AS rows_left
FROM {src}""" for n, (src, c) in PURGED_TABLES.items()))
def d29(t: Tables) -> DataFrame:
    lines, detail = D.bank_lines(t), D.payment_details(t)
    products = _products(t)
    tables = {"bank_lines": (lines, "sheet_date"), "posting_detail": (receipts.posting_detail(lines, detail), "sheet_date"),
              "facility_receipts": (products["facility_receipts"], "sheet_date"), "sheet_receipts": (products["sheet_receipts"], "sheet_date"),
              "calendar": (D.order_calendar(t), "date"), "targets": (D.targets(t), "date")}
    audit, left = maintenance.purge_into(tables, D.PURGE_START, D.PURGE_END, run_folder(t.spark, "purged"))
    remaining = union_by_name(*[table.read().agg(F.count(F.lit(1)).alias("rows_left")).select(F.lit(n).alias("table_name"), "rows_left")
                                for n, table in left.items()])
    kinds = {"table_name": "string", "rows_before": "bigint", "rows_purged": "bigint", "rows_after": "bigint"}
    return literal_table(t.spark, kinds, [tuple(r) for r in audit]).join(remaining, "table_name")

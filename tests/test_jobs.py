"""Ranking, reports, visits, contacts, documents and fees on hand-made rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from opsledger.catalog import all_queries, q_domain
from opsledger.operators import aggregates as A
from opsledger.operators import windows as W
from opsledger.plans import contacts, documents, fees, report, visits

D, TS = dt.date, dt.datetime


# ---- ranking --------------------------------------------------------------------------------------

def test_dense_row_id_is_dense_and_ordered(spark):
    values = list(range(1000)) + [5, 5, 5]
    random.Random(1).shuffle(values)
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v int").repartition(5)
    out = [(r.n, r.v) for r in W.dense_row_id(df, ["v"], "n", partitions=7).collect()]
    assert sorted(n for n, _ in out) == list(range(1, 1005))
    ordered = [v for _, v in sorted(out)]
    assert ordered[0] is None and ordered[1:] == sorted(values)


def test_category_rank_with_null(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",)], "c string")
    assert sorted(((r.c or "", r.n) for r in W.category_rank(df, "c", "n").collect())) == [("", 0), ("a", 1), ("b", 2), ("b", 2)]


def test_top_row_cuts_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    out = W.top_row(df, ["k"], [F.col("id").desc()])
    assert out._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") == 2
    assert {r.k: r.id for r in out.collect()} == {0: 999, 1: 997, 2: 998}


def test_attach_group_values_null_key(spark):
    df = spark.createDataFrame([(None, 1), (None, 3), (1, 5)], "k int, v int")
    out = W.attach_group_values(df, ["k"], lo=F.min("v"), hi=F.max("v"))
    assert sorted((r.v, r.lo, r.hi) for r in out.collect()) == [(1, 1, 3), (3, 1, 3), (5, 5, 5)]


def test_latest_by_settles_ties(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (1, 4, "z")], "k int, t int, v string")
    assert A.latest_by(df, ["k"], "t", ["v"]).first() == (1, 5, "b")
    assert A.value_at_top(df, ["k"], "t", "v", "top").first() == (1, "b")


def test_sum_by_nothing_and_null_keys(spark):
    df = spark.createDataFrame([(None, 1), (1, None)], "k int, v int")
    assert [tuple(r) for r in A.sum_by(df, ["k"], ["v"]).collect()] == [(1, 0)]
    assert A.sum_by(df, ["k"], ["v"], drop_null_keys=False).count() == 2


def test_pivot_keeps_absent_category(spark):
    df = spark.createDataFrame([(1, "a", 2)], "i int, c string, v int")
    assert A.pivot_fixed(df, ["i"], "c", ["a", "b"], "v").first() == (1, 2, 0)


def test_unpivot_keeps_empty_cells(spark):
    df = spark.createDataFrame([(1, 2.0, None)], "i int, p double, q double")
    assert [tuple(r) for r in A.unpivot_plans(df, ["i"], "plan", "fee").collect()] == [(1, "p", 2.0), (1, "q", None)]


# ---- report ---------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def calendar(spark):
    return report.calendar_between(spark, F.lit(D(2024, 1, 1)), F.lit(D(2024, 1, 31)))


def collections_report(spark, calendar, as_of, weekends=False):
    receipts = spark.createDataFrame([(D(2024, 1, 2), 1, 10.0), (D(2024, 1, 2), 1, 5.0), (D(2024, 1, 6), 1, 7.0), (D(2024, 1, 9), 2, 3.0)],
                                     "sheet_date date, dist_facility_group_id int, amount double")
    ids = receipts.select(F.col("dist_facility_group_id").alias("facility_group_id"))
    base = report.date_facility_base(calendar, receipts, ids, include_weekends=weekends)
    names = spark.createDataFrame([(1, "One")], "facility_group_id int, facility_group_name string")
    deducts = spark.createDataFrame([(1, 2.0)], "facility_group_id int, deduct double")
    targets = spark.createDataFrame([("2024-01-02", 1, 100.0)], "date string, facility_group_id int, target double")
    out = report.collections_report(base, receipts, deducts, calendar, names, targets, as_of, D(2023, 1, 1))
    return {(r.bank_dept_dt, r.facility_group_id): r for r in out.collect()}


def test_report_is_dense_and_filled(spark, calendar):
    rows = collections_report(spark, calendar, D(2024, 1, 10))
    assert len(rows) == 31 * 2
    hit = rows[D(2024, 1, 2), 1]
    assert (hit.amount, hit.deduct, hit.net_amount, hit.facility_group_name) == (15.0, 2.0, 13.0, "One")
    assert (hit.daily_coll_target, hit.daily_coll_target_86, hit.daily_coll_target_112) == (100.0, 86.0, pytest.approx(112.0))
    empty = rows[D(2024, 1, 3), 1]
    assert (empty.amount, empty.deduct, empty.daily_coll_target) == (0, 0, 0)  # no receipts, so no deduction
    assert rows[D(2024, 1, 9), 2].facility_group_name is None
    assert rows[D(2024, 1, 6), 1].amount == 0  # a weekend receipt is not in the weekday base


def test_report_weekend_option(spark, calendar):
    assert collections_report(spark, calendar, D(2024, 1, 10), weekends=True)[D(2024, 1, 6), 1].amount == 7.0


def test_period_flags(spark, calendar):
    rows = collections_report(spark, calendar, D(2024, 1, 10))
    assert [rows[D(2024, 1, d), 1].week_closed for d in (7, 8, 14)] == [1, 0, 0]
    assert [rows[D(2024, 1, d), 1].current_week for d in (7, 8, 14, 15)] == [0, 1, 1, 0]
    assert rows[D(2024, 1, 31), 1].current_year == rows[D(2024, 1, 31), 1].current_period == 1
    missing = collections_report(spark, calendar, D(2030, 1, 1))
    assert {(r.week_closed, r.current_year, r.current_period, r.current_week) for r in missing.values()} == {(0, 0, 0, 0)}


def test_base_covers_whole_touched_weeks(spark, calendar):
    fact = spark.createDataFrame([(D(2024, 1, 10),)], "sheet_date date")
    base = report.date_facility_base(calendar, fact, spark.createDataFrame([(1,)], "facility_group_id int"))
    assert sorted(r.date.day for r in base.collect()) == [8, 9, 10, 11, 12]


# ---- visits ---------------------------------------------------------------------------------------

def at(hour, minute=0, second=0):
    return TS(2024, 1, 2, hour, minute, second)


VISIT = "facility_name string, patient_id bigint, appointment_date date, visit_type string, log_time timestamp_ntz, time_in_status string, status string"


@pytest.fixture(scope="module")
def wait(spark):
    log = [
        ("A", 1, "new", at(8), "5 minutes"), ("A", 1, "new", at(8, 30), "9 minutes"), ("A", 1, "new", at(8, 30), "7 minutes"),
        ("A", 1, "lab", at(10, 0, 20), "11 minutes"),           # second type on the same day, ends later
        ("A", 2, None, at(9), "3 minutes"),                     # one row, no type
        ("A", 3, "new", None, "3 minutes"), ("A", 3, "new", at(7), "no number"),
        ("B", 1, "new", at(12), "1 minutes"),                   # another clinic with the same prefix
        ("GONE", 9, "new", at(8), "1 minutes")]
    raw = spark.createDataFrame([(f, p, D(2024, 1, 2), v, t, m, "s") for f, p, v, t, m in log], VISIT)
    clinics = spark.createDataFrame([("A", 1, "North 1"), ("B", 2, "North 2")], "facility_name string, facility_group_id bigint, facility_group_name string")
    calendar = spark.createDataFrame([(D(2024, 1, 2), 77)], "date date, calendar_week_id bigint")
    normal = visits.normalise_visits(raw.withColumn("resource_provider_name", F.lit("p")))
    out = visits.visit_wait_time(normal, clinics, calendar)
    return {r.visit_id: r for r in out.collect()}, visits.status_time_summary(normal, clinics, calendar).collect()


def test_visit_keys_share_a_clinic_prefix(wait):
    assert set(wait[0]) == {"12024-01-02Nor1", "12024-01-02Nor0", "22024-01-02Nor2", "32024-01-02Nor1"}


def test_visit_span_and_group_wait(wait):
    new, lab = wait[0]["12024-01-02Nor1"], wait[0]["12024-01-02Nor0"]
    assert (new.start_time, new.end_time, new.patient_time) == (at(8), at(12), 240)
    assert new.pwt == lab.pwt == 241.0 and lab.patient_time == 0
    assert new.appointment_date_calendar_week_id == 77 and new.facility_group_id == 1


def test_visit_with_one_row_and_null_times(wait):
    one, null_time = wait[0]["22024-01-02Nor2"], wait[0]["32024-01-02Nor1"]
    assert (one.visit_type, one.patient_time, one.pwt) == ("notype", 0, 3.0)
    assert (null_time.start_time, null_time.end_time, null_time.pwt) == (at(7), at(7), None)


def test_tied_log_rows_take_the_larger_value(spark):
    log = spark.createDataFrame([(1, at(8), 7), (1, at(8), 9), (1, at(8), None), (1, at(7), 30)],
                                "patient_id bigint, log_time timestamp_ntz, minutes_in_status int")
    log = log.withColumns({"appointment_date": F.lit(D(2024, 1, 2)), "facility_group_id": F.lit(1), "facility_group_name": F.lit("n"), "visit_type": F.lit("t")})
    out = visits.log_spans(log)
    assert out.first().last_minutes == 9
    assert "SortAggregate" not in out._jdf.queryExecution().executedPlan().toString()


def test_status_summary(wait):
    assert {(r.facility_name, r.patient_id, r.visit_type, r.minutes_in_status) for r in wait[1]} == {
        ("A", 1, "new", 21), ("A", 1, "lab", 11), ("A", 2, "notype", 3), ("A", 3, "new", 3), ("B", 1, "new", 1)}


def test_raw_output_keeps_known_columns(spark):
    assert visits.raw_visits(spark.createDataFrame([("x", 1, 2)], "status string, patient_id int, other int")).columns == ["patient_id", "status"]


# ---- contacts -------------------------------------------------------------------------------------

def test_contact_feed(spark):
    raw = spark.createDataFrame(
        [("\u200B12", "\uFEFF José ", "1980-02-30", "41", "yellow", "1.239", "extra"), (None, None, "1980-02-28", "x", None, "n/a", None)],
        "`Patient ID` string, `Patient Name` string, `Patient DOB` string, `Patient Age` string, `Patient Web Enabled` string, "
        "`Patient Imm Registry Notification` string, Other string")
    out = contacts.contact_feed(raw)
    assert out.columns == list(contacts.NAMES.values()) and len(out.columns) == 25
    first, second = out.collect()
    assert (first.patient_id, first.patient_name, first.patient_dob, first.patient_age, first.patient_web_enabled) == (12, "José", None, 41, "Yes")
    assert (second.patient_id, second.patient_dob, second.patient_age, second.patient_web_enabled) == (None, D(1980, 2, 28), None, None)
    assert str(first.patient_imm_registry_notification) == "1.24" and first.patient_voice_enabled_time_1 is None


def test_contact_names():
    assert contacts.column_name("Patient E-mail") == "patient_e_mail"
    assert contacts.column_name("Patient Voice Enabled Time23") == "patient_voice_enabled_time_1"


# ---- documents ------------------------------------------------------------------------------------

@pytest.mark.parametrize("assignee, scan, reviewed, days, sla", [
    ("Desk", "2024-01-03", "2024-01-03", 1, 1), ("Desk", "2024-01-06", "2024-01-06", 0, 1), ("Desk", "2024-01-05", "2024-01-08", 2, 1),
    ("Desk", "2024-01-08", "2024-01-05", 2, 1), ("Desk", "2024-01-03", None, 0, 0), ("Desk", None, "2024-01-03", None, 0),
    (documents.FAST_ASSIGNEE, "2024-01-03", "2024-01-03", 1, 1), (documents.FAST_ASSIGNEE, "2024-01-03", "2024-01-04", 2, 0),
    ("Desk", "2024-01-01", "2024-01-03", 3, 1), ("Desk", "2024-01-01", "2024-01-04", 4, 0), (None, "2024-01-01", "2024-01-04", 4, 0)])
def test_document_sla(spark, assignee, scan, reviewed, days, sla):
    df = spark.createDataFrame([(assignee, scan, reviewed, "12 Name")], "assigned_to string, scan_dt string, reviewed_dt string, patient_id_name string")
    row = documents.document_sla(df).first()
    assert (row.reviewed_days, row.sla, row.patient_id) == (days, sla, 12)


def test_document_register_names(spark):
    df = spark.createDataFrame([("a", "b")], "`Patient Acct No + Name` string, `Scan Date` string")
    assert documents.document_feed(df, D(2024, 1, 5)).columns == ["patient_id_name", "scan_dt", "process_date"]
    assert len(documents.REGISTER_NAMES) == 15


# ---- fees -----------------------------------------------------------------------------------------

def test_fees(spark):
    sheet = spark.createDataFrame([("d", 2, "g", None, None, "MD", 5.0, None), ("d", 1, "g", None, None, "MD", 6.0, 7.0)],
                                  "cpt_description string, cpt_code int, cpt_group string, mod_1 string, mod_2 string, resource_provider_type string, "
                                  "zeta double, alpha double")
    plans = spark.createDataFrame([("zeta", 1.0)], "fee_plan string, id_fee_plan double")
    out = fees.fee_schedule_long(sheet, plans)
    got = [(r.id_cpt_fee, r.cpt_code, r.fee_plan, r.fee, r.id_fee_plan) for r in out.orderBy("id_cpt_fee").collect()]
    assert got == [(1, "1", "zeta", 6.0, 1), (2, "2", "zeta", 5.0, 1), (3, "1", "alpha", 7.0, None), (4, "2", "alpha", None, None)]
    procedures = spark.createDataFrame([(9, "1"), (8, None)], "cpt_id int, cpt_code string")
    keyed = fees.fee_dimension(out, procedures)
    assert {(r.cpt_code, r.cpt_id) for r in keyed.collect()} == {("1", 9), ("2", None)}
    twice = plans.unionAll(plans)
    with pytest.raises(Exception, match="lookup key repeats"):
        fees.fee_schedule_long(sheet, twice).collect()
    assert fees.fee_schedule_long(sheet, twice, "fanout").count() == 6


def test_document_feed_holds_little_disk(spark, tmp_path, monkeypatch):
    """Export and register together take no more than four times the table they come from, and nothing is shuffled between."""
    made = [tmp_path / "export", tmp_path / "register"]
    places = iter(made)
    monkeypatch.setattr(q_domain, "run_folder", lambda s, name: str(next(places)))
    source = tmp_path / "tables"
    rows = spark.range(40_000, numPartitions=4)
    rows.selectExpr("id div 4 as l_orderkey", "id * 7919 % 20000 as l_partkey", "id * 104729 % 1000 as l_suppkey",
                    "cast(id % 4 + 1 as int) as l_linenumber", "cast(id * 31 % 50 as double) as l_quantity",
                    "cast(id * 7919 % 1000003 as double) / 7 as l_extendedprice", "cast(id * 13 % 11 as double) / 100 as l_discount",
                    "cast(id * 17 % 9 as double) / 100 as l_tax", "element_at(array('R', 'A', 'N'), cast(id % 3 + 1 as int)) as l_returnflag",
                    "if(id % 2 = 0, 'O', 'F') as l_linestatus",
                    "timestamp'1995-01-01' + make_interval(0, 0, 0, cast(id * 37 % 2500 as int)) as l_shipdate") \
        .write.parquet(str(source / "lineitem.parquet"))
    assert all_queries()["d24_document_feed"](spark, str(source)).count() == 40_000

    def size(folder):
        return sum(p.stat().st_size for p in folder.rglob("part-*"))
    assert sum(map(size, made)) <= 4 * size(source)


def test_documents_are_stored_without_a_shuffle(spark, tmp_path):
    path = str(tmp_path / "register")
    frame = documents.document_feed(spark.range(30, numPartitions=3).withColumnRenamed("id", "Document ID"), D(2024, 1, 5))
    documents.store_documents(frame, path)
    documents.store_documents(frame, path)
    stored = spark.read.parquet(path)
    assert stored.count() == 30 and len(stored.inputFiles()) == 3

"""The given tables seen as this library's domain tables.

Each table is defined twice, once as a DataFrame and once as a SQL common table
expression, so that a query and its SQL twin start from the same rows.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsledger.catalog.registry import Tables
from opsledger.plans.policy import SINGLE_FACILITIES
from opsledger.plans.report import calendar_between
from opsledger.session import run_folder, stored

REPORT_START = date(1996, 6, 1)
AS_OF = date(1999, 6, 16)
PURGE_START, PURGE_END = "1997-02-01", "1998-03-31"


def with_tables(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _case(value: Column, pairs: list[tuple]) -> Column:
    expression = F
    for key, result in pairs:
        expression = expression.when(value == key, F.lit(result))
    return expression


# ---- bank lines -------------------------------------------------------------------------------

SHEET_SQL = """CASE WHEN o_custkey % 4 = 3 THEN
        CASE (o_custkey // 4) % 7 WHEN 0 THEN 'S04' WHEN 1 THEN 'S12' WHEN 2 THEN 'S13' WHEN 3 THEN 'S15'
             WHEN 4 THEN 'S14' WHEN 5 THEN 'S18' ELSE 'S11' END
        WHEN o_orderstatus = 'F' THEN 'W' WHEN o_orderstatus = 'O' THEN 'G' ELSE 'C' END"""

PAYMENT_SQL = """CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 3 WHEN '3-MEDIUM' THEN 4
        ELSE o_orderkey + 10 END"""

LINES = f"""lines AS (SELECT o_orderkey AS line_id, CAST(o_orderdate AS DATE) AS sheet_date,
    CAST(o_totalprice AS DECIMAL(18,2)) AS amount, {PAYMENT_SQL} AS payment_id, {SHEET_SQL} AS sheetname,
    CASE WHEN o_custkey % 5 = 0 THEN (o_custkey // 5) % 25 END AS merch_facility_group_id FROM orders)"""


def sheet_name() -> Column:
    single = _case(F.floor(F.col("o_custkey") / 4) % 7, [(i, f"S{f:02d}") for i, f in enumerate(SINGLE_FACILITIES)])
    return F.when(F.col("o_custkey") % 4 == 3, single).when(F.col("o_orderstatus") == "F", "W") \
        .when(F.col("o_orderstatus") == "O", "G").otherwise("C")


def payment_id() -> Column:
    codes = _case(F.col("o_orderpriority"), [("1-URGENT", 1), ("2-HIGH", 3), ("3-MEDIUM", 4)])
    return F.coalesce(codes.cast("bigint"), F.col("o_orderkey") + 10)


def bank_lines(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_orderkey").alias("line_id"), F.col("o_orderdate").cast("date").alias("sheet_date"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("amount"), payment_id().alias("payment_id"),
        sheet_name().alias("sheetname"),
        F.when(F.col("o_custkey") % 5 == 0, F.floor(F.col("o_custkey") / 5) % 25).alias("merch_facility_group_id"))


# ---- postings ---------------------------------------------------------------------------------

DETAIL = """detail AS (SELECT CASE WHEN l_linenumber = 7 THEN 3 ELSE l_orderkey + 10 END AS payment_id,
    l_orderkey * 10 + l_linenumber AS payment_detail_id,
    CASE WHEN l_suppkey % 10 = 9 THEN NULL ELSE l_suppkey % 25 END AS posted_facility_group_id,
    CASE WHEN l_returnflag = 'R' THEN NULL ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END AS posted_payment
    FROM lineitem)"""


def payment_details(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.when(F.col("l_linenumber") == 7, F.lit(3).cast("bigint")).otherwise(F.col("l_orderkey") + 10).alias("payment_id"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("payment_detail_id"),
        F.when(F.col("l_suppkey") % 10 != 9, F.col("l_suppkey") % 25).alias("posted_facility_group_id"),
        F.when(F.col("l_returnflag") != "R", F.col("l_extendedprice").cast("decimal(18,2)")).alias("posted_payment"))


# Row-level classes, written out as a person would check them by hand.
CLASSES = """det AS (SELECT l.*, d.payment_detail_id, d.posted_facility_group_id, d.posted_payment
    FROM lines l LEFT JOIN detail d ON d.payment_id = l.payment_id AND d.payment_id NOT IN (1, 3, 4)),
cls AS (SELECT *, CASE
      WHEN posted_payment IS NOT NULL OR (sheetname = 'C' AND coalesce(merch_facility_group_id, 0) > 0) THEN 'distributed'
      WHEN payment_id IN (3, 4) THEN 'posted_elsewhere' WHEN payment_id = 1 THEN 'workload' ELSE 'lag' END AS receipt_class,
    coalesce(posted_payment, amount) AS dist,
    CASE WHEN sheetname = 'G' THEN 5 WHEN posted_payment IS NOT NULL THEN posted_facility_group_id
      ELSE merch_facility_group_id END AS fac,
    coalesce(posted_facility_group_id = 7, false) AND sheetname IN ('W', 'C') AS pooled
    FROM det WHERE sheetname IN ('W', 'G', 'C'))"""

ALLOCATION = """pool(sheet, fac, share) AS (VALUES ('W', 1, 0.35::DECIMAL(6,4)), ('W', 2, 0.65), ('C', 1, 0.60), ('C', 2, 0.40)),
resid(sheet, fac, share) AS (VALUES ('W', 1, 0.80::DECIMAL(6,4)), ('W', 2, 0.20), ('G', 5, 1.00), ('C', 1, 0.43),
    ('C', 2, 0.21), ('C', 4, 0.08), ('C', 5, 0.19), ('C', 9, 0.09), ('C', 13, 0.00)),
elsew(sheet, fac, share) AS (VALUES ('C', 1, 0.31::DECIMAL(6,4)), ('C', 2, 0.15), ('C', 4, 0.30), ('C', 5, 0.17),
    ('C', 9, 0.03), ('C', 13, 0.04)),
distfac AS (SELECT sheetname, sheet_date, fac, SUM(p) AS dist_payment FROM (
      SELECT sheetname, sheet_date, fac, CAST(dist AS DECIMAL(24,6)) AS p FROM cls
        WHERE receipt_class = 'distributed' AND NOT pooled AND fac IS NOT NULL
      UNION ALL SELECT c.sheetname, c.sheet_date, p.fac, CAST(c.dist * p.share AS DECIMAL(24,6)) FROM cls c
        JOIN pool p ON p.sheet = c.sheetname WHERE receipt_class = 'distributed' AND pooled
      UNION ALL SELECT sheetname, sheet_date, CAST(substr(sheetname, 2) AS BIGINT), CAST(amount AS DECIMAL(24,6))
        FROM lines WHERE sheetname LIKE 'S%') GROUP BY ALL),
amt AS (SELECT sheetname, sheet_date, SUM(amount) AS amount FROM lines GROUP BY ALL),
nodb AS (SELECT sheetname, sheet_date, SUM(amount) AS nodb FROM cls WHERE receipt_class = 'posted_elsewhere' GROUP BY ALL),
booked AS (SELECT sheetname, sheet_date, SUM(dist_payment) AS booked FROM distfac GROUP BY ALL),
rest AS (SELECT a.sheetname, a.sheet_date, CAST(a.amount - coalesce(b.booked, 0) AS DECIMAL(24,6)) AS residual,
      CAST(n.nodb AS DECIMAL(24,6)) AS nodb
    FROM amt a LEFT JOIN booked b USING (sheetname, sheet_date) LEFT JOIN nodb n USING (sheetname, sheet_date)),
alloc AS (SELECT r.sheetname, r.sheet_date, s.fac, r.residual * s.share AS allocated FROM rest r
      JOIN resid s ON s.sheet = r.sheetname WHERE r.sheetname IN ('W', 'G') OR r.nodb IS NULL
    UNION ALL SELECT r.sheetname, r.sheet_date, s.fac,
      CAST(r.residual - r.nodb AS DECIMAL(24,6)) * s.share + r.nodb * e.share FROM rest r
      JOIN resid s ON s.sheet = r.sheetname JOIN elsew e ON e.sheet = s.sheet AND e.fac = s.fac
      WHERE r.sheetname = 'C' AND r.nodb IS NOT NULL),
facility AS (SELECT coalesce(a.sheetname, d.sheetname) AS sheet_name, coalesce(a.sheet_date, d.sheet_date) AS sheet_date,
      CAST(coalesce(a.fac, d.fac) AS INT) AS dist_facility_group_id, coalesce(a.allocated, 0) AS allocated_pmt,
      coalesce(d.dist_payment, 0) AS dist_payment, coalesce(a.allocated, 0) + coalesce(d.dist_payment, 0) AS amount
    FROM alloc a FULL JOIN distfac d ON a.sheetname = d.sheetname AND a.sheet_date = d.sheet_date AND a.fac = d.fac)"""

SHEETS = """sheet AS (SELECT a.sheetname AS sheet_name, a.sheet_date, a.amount,
      CASE WHEN a.sheetname LIKE 'S%' THEN a.amount ELSE coalesce(c.dist, 0) END AS dist_payment,
      coalesce(c.nodb, 0) AS posted_nodb_pmt, coalesce(c.lag, 0) AS unposted_lag, coalesce(c.workload, 0) AS unposted_workload
    FROM amt a LEFT JOIN (SELECT sheetname, sheet_date,
        SUM(dist) FILTER (WHERE receipt_class = 'distributed') AS dist,
        SUM(amount) FILTER (WHERE receipt_class = 'posted_elsewhere') AS nodb,
        SUM(amount) FILTER (WHERE receipt_class = 'lag') AS lag,
        SUM(amount) FILTER (WHERE receipt_class = 'workload') AS workload
      FROM cls GROUP BY ALL) c USING (sheetname, sheet_date))"""

RECEIPTS = (LINES, DETAIL, CLASSES, ALLOCATION)

# ---- calendar, facilities, deductions, targets --------------------------------------------------

CALENDAR = """cal AS (SELECT d AS date, CAST(date_diff('day', DATE '1969-12-29', CAST(date_trunc('week', d) AS DATE)) // 7 AS BIGINT)
      AS calendar_week_id, CAST(year(d) AS INT) AS year, CAST(month(d) AS INT) AS period, CAST(weekofyear(d) AS INT) AS week
    FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM (
      SELECT min(CAST(o_orderdate AS DATE)) AS lo, max(CAST(o_orderdate AS DATE)) AS hi FROM orders)))"""

FACILITIES = "fac AS (SELECT CAST(n_nationkey AS BIGINT) AS facility_group_id, n_name AS facility_group_name FROM nation)"

DEDUCTS = """ded AS (SELECT CAST(n_nationkey AS BIGINT) AS facility_group_id, n_nationkey * 10.5::DOUBLE AS deduct
    FROM nation)"""

TARGETS = """tgt AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date, o_custkey % 25 AS facility_group_id,
    CAST(1000 + 10 * (o_custkey % 25) + day(o_orderdate) AS DOUBLE) AS target FROM orders)"""


def _calendar(t: Tables, fact: DataFrame, day: Column) -> DataFrame:
    """A stored calendar dimension over the days of a fact table."""
    days = calendar_between(t.spark, fact.select(F.min(day)).scalar(), fact.select(F.max(day)).scalar())
    return stored(days, run_folder(t.spark, "calendar"))


def ship_calendar(t: Tables) -> DataFrame:
    return _calendar(t, t.lineitem, F.col("l_shipdate").cast("date"))


def order_calendar(t: Tables) -> DataFrame:
    return _calendar(t, t.orders, F.col("o_orderdate").cast("date"))


def facilities(t: Tables) -> DataFrame:
    return t.nation.select(F.col("n_nationkey").cast("bigint").alias("facility_group_id"),
                           F.col("n_name").alias("facility_group_name"))


def deductions(t: Tables) -> DataFrame:
    return t.nation.select(
        F.col("n_nationkey").cast("bigint").alias("facility_group_id"), (F.col("n_nationkey") * F.lit(10.5)).alias("deduct"))


def targets(t: Tables) -> DataFrame:
    facility = F.col("o_custkey") % 25
    return t.orders.select(
        F.col("o_orderdate").cast("date").alias("date"), facility.alias("facility_group_id"),
        (F.lit(1000) + facility * 10 + F.dayofmonth("o_orderdate")).cast("double").alias("target")).distinct()


# ---- sheet rows (raw bank file) -----------------------------------------------------------------

SHEET_ROWS = f"""raw AS (SELECT o_orderkey AS line_id, CAST(o_orderdate AS DATE) AS sheet_date,
    CASE WHEN o_custkey % 3 = 0 THEN 'CREDIT WITHOUT TAG' ELSE 'CREDIT IND ID:' || (o_custkey % 50) || ' TRN 7' END AS description,
    CASE WHEN o_orderkey % 6 = 0 THEN NULL WHEN o_orderkey % 97 = 0 THEN 'n.a.'
      ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS amount,
    CASE WHEN o_orderkey % 12 = 0 THEN '-12.50' END AS debit,
    CASE WHEN o_orderkey % 18 = 0 THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS credit,
    CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE {PAYMENT_SQL} END AS payment_id,
    CASE WHEN o_orderkey % 8 = 0 THEN 'NATION_' || (o_orderkey % 30) END AS manual_distrib,
    replace(replace({SHEET_SQL}, 'S15', 'P15'), 'S14', 'P14') AS sheetname,
    CASE {SHEET_SQL} WHEN 'W' THEN 1 WHEN 'G' THEN 5 WHEN 'C' THEN 9 ELSE CAST(substr({SHEET_SQL}, 2) AS BIGINT) END
      AS sheet_facility_group_id,
    CASE WHEN {SHEET_SQL} = 'C' THEN 1 ELSE 0 END AS check_account FROM orders)"""

ALIASES = {"P15": "S15", "P14": "S14"}

MERCHANTS = """mer AS (SELECT CAST(n_nationkey AS VARCHAR) AS merchant_id, CAST(n_nationkey AS BIGINT) AS merch_facility_group_id,
    n_name AS facility FROM nation)"""


def merchants(t: Tables) -> DataFrame:
    return t.nation.select(F.col("n_nationkey").cast("string").alias("merchant_id"),
                           F.col("n_nationkey").cast("bigint").alias("merch_facility_group_id"), F.col("n_name").alias("facility"))


def sheet_rows(t: Tables) -> DataFrame:
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    price = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    sheet = F.col("_sheet")
    home = _case(sheet, [("W", 1), ("G", 5), ("C", 9), *[(f"S{f:02d}", f) for f in SINGLE_FACILITIES]]).cast("bigint")
    return t.orders.withColumn("_sheet", sheet_name()).select(
        key.alias("line_id"), F.col("o_orderdate").cast("date").alias("sheet_date"),
        F.when(customer % 3 == 0, "CREDIT WITHOUT TAG").otherwise(
            F.concat(F.lit("CREDIT IND ID:"), (customer % 50).cast("string"), F.lit(" TRN 7"))).alias("description"),
        F.when(key % 6 == 0, None).when(key % 97 == 0, "n.a.").otherwise(price).alias("amount"),
        F.when(key % 12 == 0, "-12.50").alias("debit"), F.when(key % 18 == 0, price).alias("credit"),
        F.when(key % 50 != 0, payment_id()).alias("payment_id"),
        F.when(key % 8 == 0, F.concat(F.lit("NATION_"), (key % 30).cast("string"))).alias("manual_distrib"),
        F.coalesce(_case(sheet, [("S15", "P15"), ("S14", "P14")]), sheet).alias("sheetname"),
        home.alias("sheet_facility_group_id"), F.when(sheet == "C", 1).otherwise(0).alias("check_account"))


# ---- visit log: clinics 25 to 29 are not registered ---------------------------------------------

VISITS = """vis AS (SELECT 'Clinic ' || (user_id % 30) AS facility_name, 'Provider ' || (event_id % 7) AS resource_provider_name,
    user_id AS patient_id, CAST(ts AS DATE) AS appointment_date,
    CASE WHEN event_type = 'error' THEN 'notype' ELSE event_type END AS visit_type, ts AS log_time,
    'ST' || (CAST(json_extract_string(props, '$.k') AS BIGINT) % 4) AS status,
    CAST(json_extract_string(props, '$.k') AS INT) AS minutes_in_status FROM events)"""

CLINICS = """clin AS (SELECT 'Clinic ' || n_nationkey AS facility_name, CAST(n_nationkey AS BIGINT) AS facility_group_id,
    n_name AS facility_group_name FROM nation)"""

EVENT_CALENDAR = """ecal AS (SELECT d AS appointment_date,
      CAST(date_diff('day', DATE '1969-12-29', CAST(date_trunc('week', d) AS DATE)) // 7 AS BIGINT) AS appointment_date_calendar_week_id
    FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM (
      SELECT min(CAST(ts AS DATE)) AS lo, max(CAST(ts AS DATE)) AS hi FROM events)))"""


def visit_export(t: Tables) -> DataFrame:
    """The status log as exported: long names, text minutes, a missing type as null."""
    k = F.get_json_object("props", "$.k")
    return t.events.select(
        F.concat(F.lit("Clinic "), (F.col("user_id") % 30).cast("string")).alias("Appointment Facility Name"),
        F.concat(F.lit("Provider "), (F.col("event_id") % 7).cast("string")).alias("Resource Provider Name"),
        F.col("user_id").alias("Patient Acct No"), F.col("ts").alias("Appointment Date"),
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("Visit Type"), F.col("ts").alias("Log Time"),
        F.concat(F.lit("ST"), (k.cast("bigint") % 4).cast("string")).alias("Status"),
        F.concat(k, F.lit(" minutes")).alias("Time in Status"))


def clinics(t: Tables) -> DataFrame:
    return t.nation.select(
        F.concat(F.lit("Clinic "), F.col("n_nationkey").cast("string")).alias("facility_name"),
        F.col("n_nationkey").cast("bigint").alias("facility_group_id"), F.col("n_name").alias("facility_group_name"))


def event_calendar(t: Tables) -> DataFrame:
    return _calendar(t, t.events, F.col("ts").cast("date"))


# ---- documents register -------------------------------------------------------------------------

REGISTER = """reg AS (SELECT CASE WHEN l_linenumber = 1 THEN 'Incoming, Referrals' ELSE 'Desk ' || l_linenumber END AS assigned_to,
    CAST(l_shipdate AS DATE) AS scan_dt, l_orderkey * 10 + l_linenumber AS document_id,
    CASE WHEN l_linestatus = 'O' THEN l_partkey || ' Name' ELSE 'Name ' || l_partkey END AS patient_id_name,
    CASE WHEN l_returnflag = 'R' THEN NULL
      ELSE CAST(l_shipdate AS DATE) + CAST((l_partkey * 7919 + l_suppkey * 104729) % 4001 - 2000 AS INT) END AS reviewed_dt,
    'Scanner ' || (l_suppkey % 9) AS scanned_by, CASE l_linenumber % 3 WHEN 0 THEN 'Lab "final"' WHEN 1 THEN 'Referral' END AS document_type,
    'order ' || l_orderkey || chr(13) || chr(10) || 'part ' || l_partkey AS custom_name, 'Clinic ' || (l_suppkey % 25) AS document_facility_name,
    'Practice ' || (l_partkey % 4) AS appointment_facility_name, CASE WHEN l_returnflag = 'R' THEN 'No' ELSE 'Yes' END AS reviewed,
    CASE WHEN l_returnflag <> 'R' THEN 'Dr ' || (l_suppkey % 11) END AS reviewer_name,
    CASE WHEN l_quantity > 40 THEN 'Yes' ELSE 'No' END AS high_priority, 'No' AS publish_to_ehx, 'Yes' AS migrated
    FROM lineitem)"""


def register_export(t: Tables) -> DataFrame:
    """The register with all columns of the export; a custom name has a line break, which text files of
    the export hold as a carriage return and a line feed, and a type has quotes."""
    shift = ((F.col("l_partkey") * 7919 + F.col("l_suppkey") * 104729) % 4001 - 2000).cast("int")
    scan = F.col("l_shipdate").cast("date")
    number, reviewed = F.col("l_partkey").cast("string"), F.col("l_returnflag") != "R"

    def numbered(word: str, value: Column) -> Column:
        return F.concat(F.lit(word), value.cast("string"))

    return t.lineitem.select(
        F.when(F.col("l_linenumber") == 1, "Incoming, Referrals").otherwise(numbered("Desk ", F.col("l_linenumber"))).alias("Assigned To"),
        numbered("Scanner ", F.col("l_suppkey") % 9).alias("Scanned By"), scan.cast("string").alias("Scan Date"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("Document ID"),
        F.when(F.col("l_linestatus") == "O", F.concat(number, F.lit(" Name"))).otherwise(
            F.concat(F.lit("Name "), number)).alias("Patient Acct No + Name"),
        F.when(F.col("l_linenumber") % 3 == 0, 'Lab "final"').when(F.col("l_linenumber") % 3 == 1, "Referral").alias("Document Type"),
        F.concat(numbered("order ", F.col("l_orderkey")), numbered("\npart ", F.col("l_partkey"))).alias("Custom Name"),
        numbered("Clinic ", F.col("l_suppkey") % 25).alias("Document Facility Name"),
        numbered("Practice ", F.col("l_partkey") % 4).alias("Appointment Practice Name"),
        F.when(reviewed, "Yes").otherwise("No").alias("Reviewed"),
        F.when(reviewed, numbered("Dr ", F.col("l_suppkey") % 11)).alias("Reviewer Name"),
        F.when(reviewed, F.date_add(scan, shift)).cast("string").alias("Reviewed Date"),
        F.when(F.col("l_quantity") > 40, "Yes").otherwise("No").alias("High Priority"),
        F.lit("No").alias("Publish To EHX"), F.lit("Yes").alias("Migrated"))


# ---- fee sheet: the codes of some sizes are not procedures --------------------------------------

FEE_SHEET = """sheet AS (SELECT p_name AS cpt_description,
    CAST(p_partkey + CASE WHEN p_size = 5 THEN 100000000 ELSE 0 END AS VARCHAR) AS cpt_code, p_brand AS cpt_group,
    p_type AS mod_1, CAST(NULL AS VARCHAR) AS mod_2, CASE WHEN p_size % 2 = 0 THEN 'MD' ELSE 'NP' END AS resource_provider_type,
    p_retailprice AS plan_a, CASE WHEN p_size % 3 <> 0 THEN p_retailprice * 0.5 END AS plan_b, p_retailprice + p_size AS plan_c
    FROM part)"""

FEE_PLANS = """plans AS (SELECT CASE r_regionkey WHEN 0 THEN 'plan_a' WHEN 1 THEN 'plan_b' ELSE 'plan_x' || r_regionkey END AS fee_plan,
    r_regionkey + 100.0::DOUBLE AS id_fee_plan FROM region)"""

PROCEDURES = """proc AS (SELECT p_partkey + 1000 AS cpt_id, p_partkey AS cpt_code FROM part)"""


def fee_sheet(t: Tables) -> DataFrame:
    price = F.col("p_retailprice")
    return t.part.select(
        F.col("p_name").alias("cpt_description"),
        (F.col("p_partkey") + F.when(F.col("p_size") == 5, 100_000_000).otherwise(0)).alias("cpt_code"), F.col("p_brand").alias("cpt_group"),
        F.col("p_type").alias("mod_1"), F.lit(None).cast("string").alias("mod_2"),
        F.when(F.col("p_size") % 2 == 0, "MD").otherwise("NP").alias("resource_provider_type"),
        price.alias("plan_a"), F.when(F.col("p_size") % 3 != 0, price * 0.5).alias("plan_b"),
        (price + F.col("p_size")).alias("plan_c"))


def fee_plans(t: Tables) -> DataFrame:
    other = F.concat(F.lit("plan_x"), F.col("r_regionkey").cast("string"))
    return t.region.select(F.coalesce(_case(F.col("r_regionkey"), [(0, "plan_a"), (1, "plan_b")]), other).alias("fee_plan"),
                           (F.col("r_regionkey") + F.lit(100.0)).alias("id_fee_plan"))


def procedures(t: Tables) -> DataFrame:
    return t.part.select((F.col("p_partkey") + 1000).alias("cpt_id"), F.col("p_partkey").alias("cpt_code"))

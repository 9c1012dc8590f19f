"""Normalisation, classes and allocation on hand-made rows and by invariants."""

import datetime as dt
import random
from collections import defaultdict
from decimal import Decimal as Dec

import pytest
from pyspark.sql import functions as F

from opsledger.plans import policy as P
from opsledger.plans import receipts as R

DAY = dt.date(2024, 1, 2)
LINES = "sheetname string, sheet_date date, amount decimal(18,2), payment_id bigint, merch_facility_group_id bigint"
DETAIL = "payment_id bigint, posted_facility_group_id bigint, posted_payment decimal(18,2)"


def tables(spark, lines, detail):
    return (spark.createDataFrame([(s, d, None if a is None else Dec(str(a)), p, m) for s, d, a, p, m in lines], LINES),
            spark.createDataFrame([(p, f, None if a is None else Dec(str(a))) for p, f, a in detail], DETAIL))


def facility(spark, lines, detail):
    out = R.facility_collections(*tables(spark, lines, detail), P.default_policies(spark))
    return {(r.sheet_name, r.sheet_date, r.dist_facility_group_id): (float(r.allocated_pmt), float(r.dist_payment), float(r.amount))
            for r in out.collect()}


def sheet(spark, lines, detail):
    out = R.sheet_collections(*tables(spark, lines, detail), P.default_policies(spark))
    return {(r.sheet_name, r.sheet_date): {k: float(v) for k, v in r.asDict().items() if k not in ("sheet_name", "sheet_date")}
            for r in out.collect()}


def test_shares_sum_to_one():
    for shares in (P.POOL_SPLIT, P.RESIDUAL_SPLIT, P.POSTED_ELSEWHERE_SPLIT):
        for by_facility in shares.values():
            assert sum(map(Dec, by_facility.values())) == 1


def test_pool_facility_and_residual_of_w(spark):
    lines = [("W", DAY, 100, 20, None), ("W", DAY, 50, 1, None)]
    detail = [(20, 7, 60), (20, 3, 10)]
    assert facility(spark, lines, detail) == {
        ("W", DAY, 1): (64.0, 21.0, 85.0), ("W", DAY, 2): (16.0, 39.0, 55.0), ("W", DAY, 3): (0.0, 10.0, 10.0)}


def test_forced_facility_of_g_takes_postings_without_facility(spark):
    lines, detail = [("G", DAY, 100, 20, None)], [(20, None, 30), (20, 7, 20)]
    assert facility(spark, lines, detail) == {("G", DAY, 5): (50.0, 50.0, 100.0)}


def test_c_day_with_and_without_posted_elsewhere(spark):
    other = dt.date(2024, 1, 3)
    lines = [("C", DAY, 100, 3, None), ("C", DAY, 200, 1, None), ("C", other, 100, 0, None)]
    got = facility(spark, lines, [])
    elsewhere = {1: .31, 2: .15, 4: .30, 5: .17, 9: .03, 13: .04}
    residual = {1: .43, 2: .21, 4: .08, 5: .19, 9: .09, 13: 0}
    for f in residual:
        assert got["C", DAY, f][0] == pytest.approx(200 * residual[f] + 100 * elsewhere[f])
        assert got["C", other, f][0] == pytest.approx(100 * residual[f])


def test_c_merchant_attribution(spark):
    """Merchant facility above 0 books the line; 0 and null do not. A merchant at the pool facility is not split."""
    lines = [("C", DAY, 10, 1, 4), ("C", DAY, 20, 3, 0), ("C", DAY, 40, 4, None), ("C", DAY, 80, 0, 7)]
    by_class = sheet(spark, lines, [])["C", DAY]
    assert (by_class["dist_payment"], by_class["posted_nodb_pmt"], by_class["unposted_workload"], by_class["unposted_lag"]) == (90, 60, 0, 0)
    got = facility(spark, lines, [])
    assert got["C", DAY, 4][1] == 10 and got["C", DAY, 7][1] == 80


def test_posting_without_payment_under_merchant_rule(spark):
    """A null posting at the pool facility books the merchant's amount and is split there."""
    got = facility(spark, [("C", DAY, 100, 20, 4)], [(20, 7, None)])
    assert (got["C", DAY, 1][1], got["C", DAY, 2][1]) == (60.0, 40.0)


def test_null_postings_repeat_the_line_amount_in_classes_only(spark):
    lines, detail = [("W", DAY, 100, 20, None)], [(20, 3, None), (20, 4, None), (20, 5, 30)]
    day = sheet(spark, lines, detail)["W", DAY]
    assert (day["amount"], day["unposted_lag"], day["dist_payment"]) == (100, 200, 30)


def test_unattributed_posting_counts_for_the_sheet_only(spark):
    lines, detail = [("W", DAY, 100, 20, None)], [(20, None, 30)]
    assert sheet(spark, lines, detail)["W", DAY]["dist_payment"] == 30
    assert facility(spark, lines, detail) == {("W", DAY, 1): (80.0, 0.0, 80.0), ("W", DAY, 2): (20.0, 0.0, 20.0)}


def test_single_facility_ignores_postings(spark):
    lines, detail = [("S04", DAY, 100, 20, None), ("S04", DAY, 5, 1, 9)], [(20, 7, 60), (20, 3, 10)]
    assert facility(spark, lines, detail) == {("S04", DAY, 4): (0.0, 105.0, 105.0)}
    day = sheet(spark, lines, detail)["S04", DAY]
    assert day["posted_pmt"] == 105 and day["unposted_pmt"] == 0 and day["allocated_pmt"] == 0


def test_type_codes_match_no_posting_and_missing_classes_are_zero(spark):
    day = sheet(spark, [("G", DAY, 100, 3, None)], [(3, 5, 999)])["G", DAY]
    assert (day["dist_payment"], day["posted_nodb_pmt"], day["unposted_lag"], day["unposted_workload"]) == (0, 100, 0, 0)


def test_unknown_sheet_null_date_and_null_amount(spark):
    lines = [("X", DAY, 1, 20, None), ("W", None, 2, 20, None), ("W", DAY, None, 20, None), ("W", DAY, 3, None, None)]
    got = sheet(spark, lines, [])
    assert list(got) == [("W", DAY)] and got["W", DAY]["amount"] == 3 and got["W", DAY]["unposted_lag"] == 3


def by_hand(lines, detail):
    """The rules row by row, for one day's tables of the matched sheets."""
    dist, amount, nodb = defaultdict(Dec), defaultdict(Dec), defaultdict(Dec)
    has_nodb = set()
    for s, d, a, p, m in lines:
        a = Dec(str(a))
        amount[s, d] += a
        hits = [(f, x) for q, f, x in detail if q == p and p not in (1, 3, 4)] or [(None, None)]
        for f, x in hits:
            if x is not None or (s == "C" and (m or 0) > 0):
                paid, place = (Dec(str(x)), f) if x is not None else (a, m)
                if s == "G":
                    dist[s, d, 5] += paid
                elif f == 7:
                    for member, share in P.POOL_SPLIT[s].items():
                        dist[s, d, member] += paid * Dec(share)
                elif place is not None:
                    dist[s, d, place] += paid
            elif p in (3, 4):
                nodb[s, d] += a
                has_nodb.add((s, d))
    out = defaultdict(Dec)
    for (s, d, f), x in dist.items():
        out[s, d, f] += x
    for (s, d), a in amount.items():
        rest = a - sum(x for (s2, d2, _), x in dist.items() if (s2, d2) == (s, d))
        shared = nodb[s, d] if s == "C" else Dec(0)
        for f, share in P.RESIDUAL_SPLIT[s].items():
            out[s, d, f] += (rest - shared) * Dec(share) + shared * Dec(P.POSTED_ELSEWHERE_SPLIT.get(s, {}).get(f, "0"))
    return dict(out)


@pytest.mark.parametrize("seed", [11, 12])
def test_random_tables_by_hand_and_conservation(no_broadcast, seed):
    spark, rng = no_broadcast, random.Random(seed)
    days = [DAY + dt.timedelta(days=i) for i in range(3)]
    lines = [(rng.choice("WGC"), rng.choice(days), rng.randrange(1, 99999) / 100, rng.choice([0, 1, 3, 4, 20, 21, 22, 23, 99]),
              rng.choice([None, 0, 4, 7])) for _ in range(120)]
    detail = [(rng.choice([1, 3, 20, 20, 20, 21, 22, 0]), rng.choice([1, 3, 7, 7, 9]),
               rng.choice([None, rng.randrange(1, 99999) / 100])) for _ in range(60)]
    wanted = by_hand(lines, detail)
    out = R.facility_collections(*tables(spark, lines, detail), P.default_policies(spark)).collect()
    got = {(r.sheet_name, r.sheet_date, r.dist_facility_group_id): r.amount for r in out}
    assert set(got) == set(wanted) and all(got[k] == wanted[k] for k in wanted)
    # every facility is known, so nothing of a day's amount is lost
    for s in "WGC":
        for d in days:
            total = sum((v for (s2, d2, _), v in got.items() if (s2, d2) == (s, d)), Dec(0))
            assert total == sum((Dec(str(a)) for s2, d2, a, _, _ in lines if (s2, d2) == (s, d)), Dec(0))


def test_sheet_measures_add_up(spark):
    lines = [("C", DAY, 10, 1, None), ("C", DAY, 20, 3, None), ("C", DAY, 40, 20, None), ("C", DAY, 80, 21, None)]
    day = sheet(spark, lines, [(20, 3, 15)])["C", DAY]
    assert day["posted_pmt"] == day["dist_payment"] + day["posted_nodb_pmt"] == 35
    assert day["unposted_pmt"] == day["unposted_workload"] + day["unposted_lag"] == 90
    assert day["allocated_pmt"] == day["amount"] - day["dist_payment"] == 135


# ---- normalisation --------------------------------------------------------------------------------

RAW = ("sheet_date date, description string, amount string, debit string, credit string, payment_id bigint, manual_distrib string, "
       "sheetname string, sheet_facility_group_id bigint, check_account int")


def normalised(spark, rows, aliases=None, **kwargs):
    raw = spark.createDataFrame([(DAY, *r) for r in rows], RAW)
    merchants = spark.createDataFrame([("11", 1, "North"), ("12", 2, "South")], "merchant_id string, merch_facility_group_id bigint, facility string")
    groups = spark.createDataFrame([(1, "North"), (2, "South"), (8, "Hand")], "facility_group_id bigint, facility_group_name string")
    return R.normalise_bank_lines(raw, merchants, groups, aliases or {}, **kwargs)


@pytest.mark.parametrize("amount, debit, credit, home, wanted", [
    (None, "-5", None, 4, Dec("-5.00")), (None, None, "7.5", 4, Dec("7.50")), (None, None, None, 4, Dec("0.00")),
    (None, "-5", "7", 4, Dec("2.00")), (None, "-5", "7", 3, None), ("n.a.", None, "7", 4, Dec("7.00")), ("1.25", "-5", "7", 4, Dec("1.25"))])
def test_debit_credit_fallback(spark, amount, debit, credit, home, wanted):
    assert normalised(spark, [("d", amount, debit, credit, 9, None, "S", home, 0)]).first().amount == wanted


@pytest.mark.parametrize("text, check, wanted", [
    ("IND ID:12 x", 1, ("South", 2, "12", 2)),      # checked, known merchant
    ("IND ID:99 x", 1, ("S", 0, None, None)),       # checked, unknown: facility 0 has no name, so the sheet's name
    ("IND ID:12 x", 0, ("North", 1, "11", 1)),      # not checked: the sheet's facility
    (None, 1, ("S", 0, None, None))])
def test_account_rule(spark, text, check, wanted):
    row = normalised(spark, [(text, "1", None, None, 9, None, "S", 1, check)]).first()
    assert (row.facility, row.facility_group_id, row.merchant_id, row.merch_facility_group_id) == wanted


@pytest.mark.parametrize("code, manual, wanted", [(4, "Hand", ("Hand", 8)), (4, None, ("North", 1)), (3, "Hand", ("North", 1)), (None, "Hand", ("North", 1))])
def test_manual_override(spark, code, manual, wanted):
    row = normalised(spark, [("d", "1", None, None, code, manual, "S", 1, 0)]).first()
    assert (row.facility, row.facility_group_id) == wanted and row.payment_id == (code or 0)


def test_manual_column_may_be_missing_and_aliases_apply(spark):
    raw = spark.createDataFrame([(DAY, "d", "1", None, None, 4, None, "OLD", 77, 0)], RAW).drop("manual_distrib")
    merchants = spark.createDataFrame([("11", 1, "North")], "merchant_id string, merch_facility_group_id bigint, facility string")
    groups = spark.createDataFrame([(1, "North")], "facility_group_id bigint, facility_group_name string")
    row = R.normalise_bank_lines(raw, merchants, groups, {"OLD": "NEW"}).first()
    assert (row.sheetname, row.facility, row.facility_group_id) == ("NEW", "NEW", 0)


def test_class_table(spark):
    rows = [("W", 1, 20, None, Dec(5), 3), ("W", 2, 3, None, None, None), ("W", 3, 4, 9, None, None), ("W", 4, 1, None, None, None),
            ("W", 5, 0, None, None, None), ("W", 6, 3, None, Dec(5), 3), ("C", 7, 3, 9, None, None), ("C", 8, 3, 0, None, None)]
    detail = spark.createDataFrame(rows, "sheetname string, id int, payment_id bigint, merch_facility_group_id bigint, "
                                         "posted_payment decimal(18,2), posted_facility_group_id bigint").withColumn("amount", F.lit(1).cast("decimal(18,2)"))
    out = R.classify_receipts(detail, P.default_policies(spark))
    assert {r.id: r.receipt_class for r in out.collect()} == {
        1: "distributed", 2: "posted_elsewhere", 3: "posted_elsewhere", 4: "workload", 5: "lag", 6: "distributed",
        7: "distributed", 8: "posted_elsewhere"}

"""Allocation policies as tables.

Sheets are named by policy: ``W``, ``G`` and ``C`` are matched against postings
and share out what was not posted; ``S`` + facility id books everything to that
facility. Facilities are plain ids.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from opsledger.session import literal_table

# Payment type codes. They stand for a kind of receipt, not for a payment.
WORKLOAD_CODE = 1
POSTED_ELSEWHERE_CODES = (3, 4)
MANUAL_CODE = 4
TYPE_CODES = (1, 3, 4)

# Facility of each single-facility sheet.
SINGLE_FACILITIES = (4, 12, 13, 15, 14, 18, 11)

# Payments posted to the pool facility are split again.
POOL_FACILITY = 7
POOL_SPLIT = {"W": {1: "0.35", 2: "0.65"}, "C": {1: "0.60", 2: "0.40"}}

# Shares of the receipts that no posting explains.
RESIDUAL_SPLIT = {
    "W": {1: "0.80", 2: "0.20"},
    "G": {5: "1.00"},
    "C": {1: "0.43", 2: "0.21", 4: "0.08", 5: "0.19", 9: "0.09", 13: "0.00"},
}

# Shares of receipts posted elsewhere.
POSTED_ELSEWHERE_SPLIT = {"C": {1: "0.31", 2: "0.15", 4: "0.30", 5: "0.17", 9: "0.03", 13: "0.04"}}

# Fixed value: all postings of this sheet count for one facility.
FORCED_FACILITY = {"G": 5}


@dataclass(frozen=True)
class Policies:
    """``sheets``: one row per sheet; ``pool``: (sheet, facility, share); ``split``: (sheet, facility, two shares)."""

    sheets: DataFrame
    pool: DataFrame
    split: DataFrame

    def only(self, *names: str) -> "Policies":
        return Policies(*[d.where(d["sheet"].isin(*names)) for d in (self.sheets, self.pool, self.split)])


def sheet_rows() -> list[tuple]:
    """(sheet, single facility, merchant counts as posted, forced facility, pool facility, has elsewhere split)."""
    rows = [(s, None, s == "C", FORCED_FACILITY.get(s), POOL_FACILITY if s in POOL_SPLIT else None,
             s in POSTED_ELSEWHERE_SPLIT) for s in ("W", "G", "C")]
    return rows + [(f"S{f:02d}", f, False, None, None, False) for f in SINGLE_FACILITIES]


def pool_rows() -> list[tuple]:
    return [(s, f, share) for s, shares in POOL_SPLIT.items() for f, share in shares.items()]


def split_rows() -> list[tuple]:
    return [(s, f, share, POSTED_ELSEWHERE_SPLIT.get(s, {}).get(f, "0"))
            for s, shares in RESIDUAL_SPLIT.items() for f, share in shares.items()]


def default_policies(spark: SparkSession) -> Policies:
    return Policies(
        sheets=literal_table(spark, {
            "sheet": "string", "single_facility": "bigint", "merchant_counts": "boolean",
            "forced_facility": "bigint", "pool_facility": "bigint", "shares_elsewhere": "boolean"}, sheet_rows()),
        pool=literal_table(spark, {
            "sheet": "string", "pool_member": "bigint", "pool_share": "decimal(6,4)"}, pool_rows()),
        split=literal_table(spark, {
            "sheet": "string", "facility_id": "bigint", "residual_share": "decimal(6,4)",
            "elsewhere_share": "decimal(6,4)"}, split_rows()))

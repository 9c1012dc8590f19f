"""Bank receipts: normalise lines, match postings, allocate by policy.

All sheets go through one plan. A sheet's behaviour is a row in the policy
tables, so the lines are scanned once and not once per sheet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opsledger.functions import scalars as X
from opsledger.operators.joins import expand_detail_left, lookup_left
from opsledger.operators.schema import with_class
from opsledger.plans.policy import (MANUAL_CODE, POSTED_ELSEWHERE_CODES, TYPE_CODES, WORKLOAD_CODE, Policies)

# Sheets (by facility) whose missing amount is debit + credit.
DEBIT_CREDIT_FACILITIES = (4, 5, 11, 12, 13, 14, 15, 18)

# Exact money: two decimals of cents, two split steps of up to four decimals each.
EXACT = "decimal(28,10)"
CENTS = "decimal(18,2)"

MEASURES = ("amount", "dist", "elsewhere", "workload", "lag")

DAY_KEYS = ("sheet", "sheet_date")

LINE_COLUMNS = ["sheet_date", "description", "amount", "payment_id", "sheetname", "sheet_facility_group_id",
                "check_account", "merchant_id", "facility", "merch_facility_group_id", "facility_group_id"]


def account_facility(check_account, merchant_facility, sheet_facility) -> tuple[Column, Column]:
    """(merchant facility, line facility) under the account rule.

    A checked account takes the merchant's facility, 0 when the merchant is
    unknown; an unchecked one has no merchant facility and keeps the sheet's.
    """
    merchant = F.when(F.col(check_account) == 1, F.coalesce(F.col(merchant_facility), F.lit(0)))
    return merchant, F.coalesce(merchant, F.col(sheet_facility))


def fill_missing_amount(df: DataFrame, facilities=DEBIT_CREDIT_FACILITIES) -> DataFrame:
    """Parse the three amount columns; a missing amount of the listed sheets is debit + credit."""
    parsed = df.withColumns({c: X.money(c) for c in ("amount", "debit", "credit")})
    both = (F.coalesce(F.col("debit"), F.lit(0)) + F.coalesce(F.col("credit"), F.lit(0))).cast(CENTS)
    use = F.col("amount").isNull() & F.col("sheet_facility_group_id").isin(*facilities)
    return parsed.withColumn("amount", F.when(use, both).otherwise(F.col("amount"))).drop("debit", "credit")


def normalise_bank_lines(lines: DataFrame, merchants: DataFrame, facilities: DataFrame,
                         aliases: dict[str, str], fallback_ids=DEBIT_CREDIT_FACILITIES,
                         on_duplicate: str = "raise") -> DataFrame:
    """Clean, facility-attributed bank lines from stacked sheet rows.

    ``lines``: sheet_date, description, amount, debit, credit, payment_id,
    manual_distrib (optional), sheetname, sheet_facility_group_id, check_account.
    ``merchants``: merchant_id, merch_facility_group_id, facility.
    ``facilities``: facility_group_id, facility_group_name.
    """
    if "manual_distrib" not in lines.columns:
        lines = lines.withColumn("manual_distrib", F.lit(None).cast("string"))
    df = fill_missing_amount(lines, fallback_ids)
    df = df.withColumn("merchant_id", X.tagged_id("description"))
    df = lookup_left(df, merchants, ["merchant_id"], ["merch_facility_group_id"], on_duplicate)
    merchant_facility, line_facility = account_facility(
        "check_account", "merch_facility_group_id", "sheet_facility_group_id")
    df = df.select(
        F.col("sheet_date").cast("date").alias("sheet_date"), "description", "amount",
        F.coalesce(F.col("payment_id").cast("bigint"), F.lit(0)).alias("payment_id"), "manual_distrib",
        X.relabel("sheetname", aliases).alias("sheetname"), "sheet_facility_group_id", "check_account",
        line_facility.cast("bigint").alias("line_facility"))

    by_facility = merchants.select(F.col("merch_facility_group_id").alias("line_facility"),
                                   F.col("facility").alias("_facility"))
    df = lookup_left(df, by_facility, ["line_facility"], ["_facility"], on_duplicate)
    manual = (F.col("payment_id") == MANUAL_CODE) & F.col("manual_distrib").isNotNull()
    df = df.withColumn("facility", F.when(manual, F.col("manual_distrib"))
                       .otherwise(F.coalesce(F.col("_facility"), F.col("sheetname"))))

    groups = facilities.select(F.col("facility_group_name").alias("facility"), "facility_group_id")
    df = lookup_left(df, groups, ["facility"], ["facility_group_id"], on_duplicate)
    df = df.withColumn("facility_group_id", F.coalesce(F.col("facility_group_id"), F.lit(0)).cast("bigint"))
    df = lookup_left(df, merchants, ["facility"], ["merchant_id", "merch_facility_group_id"], on_duplicate)
    return df.select(*LINE_COLUMNS)


def posting_detail(lines: DataFrame, detail: DataFrame, excluded=TYPE_CODES) -> DataFrame:
    """Every line with each of its postings; type codes are kinds of receipts and match nothing."""
    return expand_detail_left(
        lines, detail.select("payment_id", "payment_detail_id", "posted_facility_group_id", "posted_payment"),
        "payment_id", list(excluded))


def _is_posted_elsewhere() -> Column:
    return F.coalesce(F.col("payment_id").isin(*POSTED_ELSEWHERE_CODES), F.lit(False))


def _merchant_books() -> Column:
    return F.col("merchant_counts") & F.coalesce(F.col("merch_facility_group_id") > 0, F.lit(False))


def classify_receipts(detail_rows: DataFrame, policies: Policies) -> DataFrame:
    """Posting detail of the matched sheets with its class and, where distributed, payment and facility.

    Classes: distributed, posted_elsewhere, workload, lag. Single-facility
    sheets have no classes; their lines never meet the postings.
    """
    rules = policies.sheets.where(F.col("single_facility").isNull()).withColumnRenamed("sheet", "sheetname")
    df = detail_rows.join(rules, "sheetname")
    posted = F.col("posted_payment").isNotNull()
    df = with_class(df, "receipt_class", [
        ("distributed", posted | _merchant_books()),
        ("posted_elsewhere", _is_posted_elsewhere()),
        ("workload", F.col("payment_id") == WORKLOAD_CODE)], otherwise="lag")
    distributed = F.col("receipt_class") == "distributed"
    facility = F.coalesce(F.col("forced_facility"), F.when(posted, F.col("posted_facility_group_id"))
                          .otherwise(F.col("merch_facility_group_id")))
    pooled = F.coalesce(F.col("posted_facility_group_id") == F.col("pool_facility"), F.lit(False))
    return df.withColumns({
        "dist_payment": F.when(distributed, F.coalesce(F.col("posted_payment"), F.col("amount"))),
        "dist_facility_group_id": F.when(distributed, facility),
        "pooled": distributed & pooled,
    }).drop(*[c for c in policies.sheets.columns if c != "sheet"])


def _payment_parts(detail: DataFrame, excluded) -> DataFrame:
    """Postings summed per payment and facility.

    The sum combines before the shuffle, so a payment with very many postings
    arrives at the join as at most one row per facility.
    """
    return detail.where(F.col("payment_id").isNotNull() & ~F.col("payment_id").isin(*excluded)) \
        .groupBy("payment_id", "posted_facility_group_id").agg(
            F.sum("posted_payment").alias("posted"),
            F.count("posted_payment").alias("n_posted"),
            F.count_if(F.col("posted_payment").isNull()).alias("n_open"))


def leftover_receipts(lines: DataFrame, policies: Policies) -> DataFrame:
    """Money that is in no receipt table: lines of a sheet without a policy, and lines without a date.

    One row per sheet, day and ``reason``, with the amount and the number of lines. Every line is either here or in the
    receipts, so the two together add up to the bank.
    """
    known = policies.sheets.select(F.col("sheet").alias("sheetname"), F.lit(True).alias("_known"))
    reason = F.when(F.col("_known").isNull(), "no policy").when(F.col("sheet_date").isNull(), "no date")
    return lines.select("sheetname", "sheet_date", F.col("amount").cast(CENTS).alias("amount")).join(known, "sheetname", "left") \
        .withColumn("reason", reason).where("reason is not null").groupBy("sheetname", "sheet_date", "reason") \
        .agg(F.sum("amount").alias("amount"), F.count(F.lit(1)).alias("n_lines"))


def receipt_measures(lines: DataFrame, detail: DataFrame, policies: Policies, excluded=TYPE_CODES) -> DataFrame:
    """Per sheet, day, facility: amount, dist, elsewhere, workload and lag, all exact.

    The facility is null for what belongs to the sheet's day as a whole and for
    postings without a facility. ``pooled`` marks sums that the pool split takes.
    """
    tagged = lines.where(F.col("sheet_date").isNotNull()).select(
        F.col("sheetname").alias("sheet"), "sheet_date", F.col("amount").cast(CENTS).alias("amount"),
        "payment_id", "merch_facility_group_id").join(policies.sheets, "sheet")
    can_match = F.col("single_facility").isNull() & F.col("payment_id").isNotNull() \
        & ~F.col("payment_id").isin(*excluded)
    parts = _payment_parts(detail, excluded)
    matched = tagged.where(can_match).join(parts, "payment_id", "left") \
        .withColumn("own", F.lit(None).cast(CENTS)).withColumn("n_open", F.coalesce(F.col("n_open"), F.lit(1)))
    # each line once for its own amount; lines that cannot match a posting end here, unshuffled
    alone = tagged.withColumn("own", F.col("amount")).withColumn("n_open", F.when(can_match, 0).otherwise(1).cast("bigint"))
    zero = F.lit(0).cast(CENTS)
    # one narrow row per line and part, with nothing but plain columns up to the first aggregate
    narrow = matched.unionByName(alone, allowMissingColumns=True).select(
        "sheet", "sheet_date", "payment_id", "posted", "n_posted", "n_open",
        F.coalesce(F.col("forced_facility"), F.col("posted_facility_group_id")).alias("posted_facility"),
        F.coalesce(F.col("single_facility"), F.col("forced_facility"), F.col("merch_facility_group_id")).alias("book_facility"),
        F.coalesce(F.col("posted_facility_group_id") == F.col("pool_facility"), F.lit(False)).alias("pooled"),
        F.coalesce(F.col("own"), zero).alias("amount"),
        (F.coalesce(F.col("amount"), zero) * F.col("n_open")).cast(CENTS).alias("open_amount"),
        (F.col("single_facility").isNotNull() | _merchant_books()).alias("booked"))
    classed = with_class(narrow, "open_class", [
        ("booked", F.col("booked")), ("elsewhere", _is_posted_elsewhere()),
        ("workload", F.col("payment_id") == WORKLOAD_CODE)], otherwise="lag") \
        .withColumn("book_facility", F.when(F.col("booked"), F.col("book_facility")))

    def open_sum(name: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("open_class") == name, F.col("open_amount"))), zero).alias(name)

    sums = classed.groupBy("sheet", "sheet_date", "posted_facility", "book_facility", "pooled").agg(
        F.sum("amount").alias("amount"), F.coalesce(F.sum("posted"), zero).alias("posted"),
        F.coalesce(F.sum("n_posted"), F.lit(0)).alias("n_posted"),
        F.coalesce(F.sum(F.when(F.col("booked"), F.col("n_open"))), F.lit(0)).alias("n_booked"),
        *[open_sum(c) for c in ("booked", "elsewhere", "workload", "lag")])

    def contribution(facility: Column, is_pooled: Column, **given: Column) -> Column:
        measures = [given.get(m, zero).cast("decimal(28,2)").alias(m) for m in MEASURES]
        return F.struct(facility.cast("bigint").alias("facility_id"), is_pooled.alias("pooled"), *measures)

    day = contribution(F.lit(None), F.lit(False), **{m: F.col(m) for m in MEASURES if m != "dist"})
    posted = contribution(F.col("posted_facility"), F.col("pooled"), dist=F.col("posted"))
    booked = contribution(F.col("book_facility"), F.col("pooled"), dist=F.col("booked"))
    contributions = F.array(day, F.when(F.col("n_posted") > 0, posted), F.when(F.col("n_booked") > 0, booked))
    # few rows by now; with a sheet's day in one place, no later grouping by more keys is shuffled again
    return sums.repartition(*DAY_KEYS).select(*DAY_KEYS, F.explode(contributions).alias("c")).where(F.col("c").isNotNull()) \
        .select(*DAY_KEYS, "c.*").groupBy(*DAY_KEYS, "facility_id", "pooled").agg(
        *[F.sum(m).alias(m) for m in MEASURES])


def share_pool(measures: DataFrame, policies: Policies) -> DataFrame:
    """Measures per sheet, day and facility after the pool split.

    The row without a facility stays: it carries what belongs to the day as a
    whole, so one frame holds all that the allocation needs.
    """
    pool = policies.pool.withColumn("pooled", F.lit(True))
    share = F.coalesce(F.col("pool_share"), F.lit(1).cast("decimal(6,4)"))
    shared = measures.join(pool, ["sheet", "pooled"], "left").select(
        "sheet", "sheet_date", F.coalesce(F.col("pool_member"), F.col("facility_id")).alias("facility_id"),
        (F.col("dist").cast("decimal(24,2)") * share).cast(EXACT).alias("dist"), "amount", "elsewhere")
    return shared.groupBy("sheet", "sheet_date", "facility_id").agg(
        F.sum("dist").cast(EXACT).alias("dist_payment"), F.sum("amount").alias("amount"), F.sum("elsewhere").alias("elsewhere"))


def split_pool_facility(measures: DataFrame, policies: Policies) -> DataFrame:
    """Distributed payments per sheet, day and facility after the pool split; no facility, no row."""
    return share_pool(measures, policies).where(F.col("facility_id").isNotNull()) \
        .select("sheet", "sheet_date", "facility_id", "dist_payment")


def _day_totals(shared: DataFrame, policies: Policies) -> DataFrame:
    """``shared`` with residual and posted-elsewhere of the sheet's day on every row.

    residual = amount - distributed (- posted elsewhere, where the sheet shares
    that out by its own list). A day has at most one row per facility.
    """
    day = Window.partitionBy("sheet", "sheet_date")
    booked = F.coalesce(F.sum(F.when(F.col("facility_id").isNotNull(), F.col("dist_payment"))).over(day), F.lit(0))
    own = policies.sheets.select("sheet", "shares_elsewhere")
    elsewhere = F.when(F.col("shares_elsewhere"), F.sum("elsewhere").over(day)).otherwise(F.lit(0))
    return shared.join(own, "sheet").withColumns({
        "_elsewhere": elsewhere.cast("decimal(24,6)"), "_amount": F.sum("amount").over(day).cast("decimal(24,6)"),
        "_booked": booked.cast("decimal(24,6)")}).withColumn(
        "_residual", (F.col("_amount") - F.col("_booked") - F.col("_elsewhere")).cast("decimal(24,6)"))


def _allocated() -> Column:
    return (F.col("_residual") * F.col("residual_share") + F.col("_elsewhere") * F.col("elsewhere_share")).cast(EXACT)


def allocate_residual(measures: DataFrame, policies: Policies) -> DataFrame:
    """What no posting explains, shared out per sheet and day.

    A facility gets residual x residual share + posted elsewhere x elsewhere share.
    """
    totals = _day_totals(share_pool(measures, policies), policies).where(F.col("facility_id").isNull())
    return totals.drop("facility_id").join(policies.split, "sheet").select(
        "sheet", "sheet_date", "facility_id", _allocated().alias("allocated_pmt"))


def facility_from_measures(measures: DataFrame, policies: Policies) -> DataFrame:
    """Allocated and distributed receipts together, from one pass over the measures.

    Each day's row without a facility turns into one row per facility of the
    sheet's split; the other rows keep their distributed payment.
    """
    is_day = F.col("facility_id").isNull()
    split = policies.split.select(F.col("sheet").alias("_split_sheet"), F.col("facility_id").alias("_member"),
                                  "residual_share", "elsewhere_share")
    rows = _day_totals(share_pool(measures, policies), policies).withColumn("_day_sheet", F.when(is_day, F.col("sheet"))) \
        .join(split, F.col("_day_sheet") == F.col("_split_sheet"), "left")
    zero = F.lit(0).cast(EXACT)
    summed = rows.select(
        "sheet", "sheet_date", F.coalesce(F.col("_member"), F.col("facility_id")).alias("facility_id"),
        F.when(is_day, _allocated()).otherwise(zero).alias("allocated_pmt"),
        F.when(is_day, zero).otherwise(F.col("dist_payment")).alias("dist_payment")) \
        .where(F.col("facility_id").isNotNull()).groupBy("sheet", "sheet_date", "facility_id").agg(
        F.sum("allocated_pmt").cast(EXACT).alias("allocated_pmt"), F.sum("dist_payment").cast(EXACT).alias("dist_payment"))
    return summed.select(
        "sheet_date", "allocated_pmt", F.col("facility_id").cast("int").alias("dist_facility_group_id"), "dist_payment",
        (F.col("allocated_pmt") + F.col("dist_payment")).cast(EXACT).alias("amount"),
        F.col("sheet").alias("sheet_name"))


def sheet_from_measures(measures: DataFrame) -> DataFrame:
    days = measures.groupBy("sheet", "sheet_date").agg(
        F.sum("amount").cast(EXACT).alias("amount"), F.sum("dist").cast(EXACT).alias("dist_payment"),
        F.sum("elsewhere").cast(EXACT).alias("posted_nodb_pmt"), F.sum("lag").cast(EXACT).alias("unposted_lag"),
        F.sum("workload").cast(EXACT).alias("unposted_workload"))
    return days.select(
        "sheet_date", "amount", "dist_payment", "posted_nodb_pmt", "unposted_lag", "unposted_workload",
        (F.col("amount") - F.col("dist_payment")).cast(EXACT).alias("allocated_pmt"),
        (F.col("dist_payment") + F.col("posted_nodb_pmt")).cast(EXACT).alias("posted_pmt"),
        (F.col("unposted_workload") + F.col("unposted_lag")).cast(EXACT).alias("unposted_pmt"),
        F.col("sheet").alias("sheet_name"))


def facility_collections(lines: DataFrame, detail: DataFrame, policies: Policies) -> DataFrame:
    """Allocated and distributed receipts per sheet, day and facility."""
    return facility_from_measures(receipt_measures(lines, detail, policies), policies)


def sheet_collections(lines: DataFrame, detail: DataFrame, policies: Policies) -> DataFrame:
    """Posted, posted elsewhere, unposted and allocated receipts per sheet and day."""
    return sheet_from_measures(receipt_measures(lines, detail, policies))

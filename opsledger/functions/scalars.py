"""Column functions. All are built-in expressions; there is no UDF here."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Invisible characters removed by ``clean_text`` (byte order mark,
# zero-width space, non-joiner, joiner, word joiner) and the ASCII control range.
INVISIBLE_CHARACTERS = "\uFEFF\u200B\u200C\u200D\u2060"
CONTROL_CHARACTERS = r"\x00-\x1F\x7F"

# Business days allowed per assignee class.
FAST_SLA_DAYS = 1
SLOW_SLA_DAYS = 3

# Target bands.
TARGET_BANDS = {"_86": 0.86, "_100": 1.0, "_112": 1.12}


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def money(col) -> Column:
    """Exact cents. Sums of decimals do not depend on task order."""
    return _c(col).try_cast("decimal(18,2)")


def numeric(col) -> Column:
    """Number, or null when the text is not one."""
    return _c(col).try_cast("double")


def rounded_long(col) -> Column:
    """Number rounded half to even, as a nullable long."""
    return F.bround(numeric(col)).cast("bigint")


def default(col, *fallbacks) -> Column:
    return F.coalesce(_c(col), *[f if isinstance(f, Column) else F.lit(f) for f in fallbacks])


def default_zero(*names: str) -> dict[str, Column]:
    return {name: F.coalesce(F.col(name), F.lit(0)) for name in names}


def tagged_id(col, tag: str = "IND ID:", missing: str = "No ID") -> Column:
    """Digits after the first ``tag`` followed by digits; ``missing`` when there are none."""
    found = F.regexp_extract(_c(col), f"{tag}(\\d+)", 1)
    return F.coalesce(F.nullif(found, F.lit("")), F.lit(missing))


def _digits(col, pattern: str, dtype: str) -> Column:
    # blank to null first: a failing try_cast costs an exception per row
    return F.nullif(F.regexp_extract(_c(col), pattern, 1), F.lit("")).try_cast(dtype)


def leading_digits(col) -> Column:
    return _digits(col, r"^(\d+)", "bigint")


def first_digits(col) -> Column:
    """First run of digits as int: ``'49 minutes'`` gives 49."""
    return _digits(col, r"(\d+)", "int")


def relabel(col, labels: dict[str, str]) -> Column:
    """Replace known labels and keep all others."""
    c = _c(col)
    if not labels:
        return c
    pairs = [F.lit(x) for pair in labels.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), c), c)


def clean_text(col) -> Column:
    return F.trim(F.regexp_replace(_c(col), f"[{INVISIBLE_CHARACTERS}{CONTROL_CHARACTERS}]", ""))


def yes_no(col) -> Column:
    """Yes/No by first letter; anything else (null too) stays as it is."""
    c = _c(col)
    first = F.lower(F.substring(c, 1, 1))
    return F.when(first == "y", F.lit("Yes")).when(first == "n", F.lit("No")).otherwise(c)


def lenient_date(col, fmt: str | None = None) -> Column:
    return F.try_to_date(_c(col), fmt) if fmt else _c(col).try_cast("date")


def lenient_timestamp(col, fmt: str | None = None) -> Column:
    """Timestamp without zone, null when it does not parse."""
    if fmt:
        return F.try_to_timestamp(_c(col), F.lit(fmt)).cast("timestamp_ntz")
    return _c(col).try_cast("timestamp_ntz")


def key_parts(*cols) -> Column:
    """Parts written one after another, nulls left out."""
    return F.concat_ws("", *[_c(c).cast("string") for c in cols])


def iso_date(col) -> Column:
    return F.date_format(_c(col), "yyyy-MM-dd")


def prefix(col, length: int = 3) -> Column:
    return F.substring(_c(col), 1, length)


def wall_seconds(col) -> Column:
    """Whole seconds since year 1 of the wall-clock time.

    Differences of zoneless timestamps are taken as intervals, because
    ``timestampdiff`` reads them in the session's zone and its clock changes.
    """
    return (_c(col).cast("timestamp_ntz") - F.lit("0001-01-01").cast("timestamp_ntz")).cast("bigint")


def wall_micros(col) -> Column:
    """Microseconds since year 1 of the wall-clock time."""
    in_minute = (F.extract(F.lit("SECOND"), _c(col).cast("timestamp_ntz")) * F.lit(1_000_000)).cast("bigint")
    return wall_seconds(col) * F.lit(1_000_000) + F.pmod(in_minute, F.lit(1_000_000))


def seconds_between(start, end) -> Column:
    """Whole seconds between two timestamps, each truncated to its second first."""
    return wall_seconds(end) - wall_seconds(start)


def minutes_between(start, end) -> Column:
    return F.round(seconds_between(start, end) / F.lit(60.0)).cast("int")


def weekday(col) -> Column:
    """Monday is 0, Sunday is 6."""
    return F.weekday(_c(col))


def is_weekday(col) -> Column:
    return F.weekday(_c(col)) < 5


def week_number(col) -> Column:
    """Number of the Monday-based week since the week of 1970-01-01 (which is 0)."""
    return F.floor((F.unix_date(_c(col)) + 3) / 7).cast("bigint")


def _weekdays_before(day: Column) -> Column:
    """Weekdays in the days [Monday 1969-12-29, day)."""
    n = F.unix_date(day) + F.lit(3)
    into_week = F.pmod(n, F.lit(7))
    weeks = ((n - into_week) / F.lit(7)).cast("int")
    return weeks * 5 + F.least(into_week, F.lit(5))


def business_days(start, end) -> Column:
    """Weekdays from ``start`` to ``end``, both included; a reversed pair counts the same span.

    Whole weeks are counted by arithmetic, so the cost per row does not grow
    with the length of the span and no array of dates is built.
    """
    lo, hi = F.least(_c(start), _c(end)), F.greatest(_c(start), _c(end))
    count = _weekdays_before(F.date_add(hi, 1)) - _weekdays_before(lo)
    return F.when(_c(start).isNotNull() & _c(end).isNotNull(), count)


def sla_flag(days, reviewed, is_fast, fast: int = FAST_SLA_DAYS, slow: int = SLOW_SLA_DAYS) -> Column:
    """1 when reviewed within the days allowed for the assignee class, else 0."""
    limit = F.when(_c(is_fast) == 1, F.lit(fast)).otherwise(F.lit(slow))
    return F.when((_c(reviewed) == 1) & (_c(days) <= limit), 1).otherwise(0)


def share_of(col, share: float) -> Column:
    return _c(col) * F.lit(share)


def blank_to_null(col) -> Column:
    return F.nullif(_c(col), F.lit(""))


def record_bytes(*cols) -> Column:
    """Size of a record written as JSON, in bytes."""
    return F.octet_length(F.to_json(F.struct(*[_c(c) for c in cols]), {"ignoreNullFields": "false"}))


def flag(condition: Column) -> Column:
    """0/1; a null condition gives 0."""
    return F.when(condition, 1).otherwise(0)

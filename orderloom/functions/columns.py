"""Scalar expressions: labels, calendar buckets, number formats, exact time arithmetic."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values.
MISSING_CELL = "—"
EPOCH_DAY = date(2024, 1, 1)
SERVICE_PREFIX = r"^(Amazon|AWS)\s+"
TIER_PREFIX = r"^PREMIUM_"
REGION_SUFFIX = r"_(US|EU|AP|CA|SA|AF|ME)_[A-Z0-9_]+$"


def short_service(name: Column) -> Column:
    """Service name without its vendor prefix, to fit a column header."""
    return F.regexp_replace(name, SERVICE_PREFIX, "")


def short_sku(name: Column) -> Column:
    """SKU without tier prefix and trailing region."""
    return F.regexp_replace(F.regexp_replace(name, TIER_PREFIX, ""), REGION_SUFFIX, "")


def clipped(text: Column, longest: int = 38, keep: int = 35) -> Column:
    """Text cut to ``keep`` characters plus an ellipsis when longer than ``longest``."""
    return F.when(F.length(text) > longest, F.concat(F.substring(text, 1, keep), F.lit("..."))).otherwise(text)


def label_or(text: Column, default: str) -> Column:
    """``text``, or ``default`` where it is NULL or empty."""
    return F.when(text.isNull() | (text == ""), F.lit(default)).otherwise(text)


def money(amount: Column) -> Column:
    """Four-decimal text; NULL stays NULL."""
    return F.format_string("%.4f", amount.cast("double"))


def cell(column: Column, kind: T.DataType) -> Column:
    """Report cell: fractional numbers with four decimals, anything missing as a dash."""
    fractional = isinstance(kind, (T.FloatType, T.DoubleType, T.DecimalType))
    text = F.when(column.isNotNull(), money(column)) if fractional else column.cast("string")
    return F.coalesce(text, F.lit(MISSING_CELL))


def starred(text: Column, flag: Column) -> Column:
    return F.concat(text, F.when(flag, F.lit("*")).otherwise(F.lit("")))


def week_of(day: Column) -> Column:
    """Monday of the week, as text."""
    start = day.cast("date")
    return F.date_sub(start, F.weekday(start)).cast("string")


def as_day(value: str | date | None) -> date:
    """A calendar day from text or a date; an empty value means today."""
    if isinstance(value, datetime):
        return value.date()
    if isinstance(value, date):
        return value
    return date.fromisoformat(value.strip()) if value and value.strip() else date.today()


def day_offset(day: Column) -> Column:
    """Days since the first seeding day. Earlier days have no slot and raise."""
    offset = F.datediff(day.cast("date"), F.lit(EPOCH_DAY))
    return F.when(offset < 0, F.raise_error(F.lit(f"seed dates start at {EPOCH_DAY}")).cast("int")).otherwise(offset)


def from_epoch_ms(ms: Column) -> Column:
    """UTC wall-clock time of an epoch-millisecond value, whatever the session time zone."""
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    days = F.floor(ms / 86_400_000).cast("int")
    rest = F.pmod(ms, F.lit(86_400_000)).cast("decimal(18,6)") / 1000
    zero = F.lit(0)
    return start + F.make_dt_interval(days, zero, zero, rest.cast("decimal(18,6)"))


def day_start_ms(day: str | date) -> int:
    """Epoch milliseconds of UTC midnight."""
    return (as_day(day) - date(1970, 1, 1)).days * 86_400_000


def epoch_second(moment: Column, kind: T.DataType) -> Column:
    """Whole seconds since 1970, monotone in ``moment`` for both timestamp types."""
    if isinstance(kind, T.TimestampNTZType):
        days = F.datediff(F.to_date(moment), F.lit(date(1970, 1, 1))).cast("bigint")
        return days * 86_400 + F.hour(moment) * 3_600 + F.minute(moment) * 60 + F.second(moment)
    return F.unix_seconds(moment)

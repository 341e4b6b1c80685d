"""Column helpers for the arithmetic the models share."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


# All rounding first settles a value to this many decimals, half away from zero, so that
# binary noise cannot flip a half. Both forms below agree; the integer one is much faster.
SETTLED = 6


def round_total(value: Column, places: int) -> Column:
    """Round a value of any size and sign, through a decimal; what no decimal holds (NaN, infinity) gives NULL."""
    return F.round(value.try_cast(f"decimal(38,{SETTLED})"), places).cast("double")


def round_positive(value: Column, places: int) -> Column:
    """Round a value that is rarely negative: through whole numbers from 0 to 9e12, else through a decimal."""
    step = 10 ** (SETTLED - places)
    settled = (value * float(10**SETTLED) + 0.5).try_cast("bigint")
    units = F.call_function("div", settled + step // 2, F.lit(step).cast("bigint"))
    whole = F.when((value >= 0) & (value < 9e12), units.cast("double") / float(10**places))
    return F.coalesce(whole, round_total(value, places))


def round_half_up(value: Column, places: int) -> Column:
    """Round a value of either sign, alike on both sides; adding zero avoids a negative zero."""
    return F.signum(value) * round_positive(F.abs(value), places) + 0.0


def all_present(*columns: Column) -> Column:
    return reduce(lambda a, b: a & b, [c.isNotNull() for c in columns])


def greatest_strict(*columns: Column) -> Column:
    """Greatest value, or NULL as soon as one input is NULL."""
    return F.when(all_present(*columns), F.greatest(*columns))


def least_strict(*columns: Column) -> Column:
    """Least value, or NULL as soon as one input is NULL."""
    return F.when(all_present(*columns), F.least(*columns))


def clamp(value: Column, low: float, high: float) -> Column:
    """Keep a value within [low, high]. NULL gives ``low``: guard where it may occur.

    The value is named once, so that stacked formulas stay small in generated code.
    """
    return F.least(F.lit(high), F.greatest(F.lit(low), value))


def whole_text(value: Column) -> Column:
    """Text of a number without decimals, never in scientific notation."""
    return value.cast("decimal(18,0)").cast("string")


def short_text(value: Column) -> Column:
    """Text of a one-decimal number, written as 2 rather than 2.0 when whole."""
    return F.regexp_replace(value.cast("decimal(18,1)").cast("string"), r"\.0$", "")


def float_text(value: Column) -> Column:
    """Text of a sensor value with one to three decimals, e.g. 12.0 or 0.132."""
    return F.regexp_replace(value.cast("decimal(18,3)").cast("string"), "0{1,2}$", "")


def epoch_seconds(ts: Column) -> Column:
    """Seconds since 1970 of a wall-clock timestamp, independent of the session zone."""
    days = F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("bigint")
    return days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0 (also for NULL)."""
    return F.when(condition, 1).otherwise(0)

"""Column builders for naive times.

Everything stays ``TIMESTAMP_NTZ``: ``date_trunc`` would return a zoned timestamp, so hours are
handled as a count since 1970-01-01 (``hour_index``), which is also the key of the rolling windows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = "1970-01-01"


def ntz(c) -> Column:
    return F.col(c).cast("timestamp_ntz") if isinstance(c, str) else c.cast("timestamp_ntz")


def ntz_lit(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def hours(n) -> Column:
    """Interval of n hours; n is a number or a Column."""
    n = n if isinstance(n, Column) else F.lit(n)
    return F.make_dt_interval(F.lit(0), n.cast("int"), F.lit(0), F.lit(0))


def minutes(n) -> Column:
    n = n if isinstance(n, Column) else F.lit(n)
    return F.make_dt_interval(F.lit(0), F.lit(0), n.cast("int"), F.lit(0))


def day_floor(c: Column) -> Column:
    return c.cast("date").cast("timestamp_ntz")


def day_ceil(c: Column) -> Column:
    return F.when(day_floor(c) == c, c).otherwise(F.date_add(c.cast("date"), 1).cast("timestamp_ntz"))


def hour_floor(c: Column) -> Column:
    return day_floor(c) + hours(F.hour(c))


def hour_ceil(c: Column) -> Column:
    return F.when(hour_floor(c) == c, c).otherwise(hour_floor(c) + hours(1))


def minute_floor(c: Column) -> Column:
    return hour_floor(c) + minutes(F.minute(c))


def second_floor(c: Column) -> Column:
    return minute_floor(c) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.second(c).cast("decimal(18,6)"))


def hour_index(c: Column) -> Column:
    """Whole hours since 1970-01-01 00:00, independent of the session time zone."""
    days = F.datediff(c.cast("date"), F.lit(_EPOCH).cast("date")).cast("bigint")
    return days * 24 + F.hour(c)


def from_hour_index(i: Column) -> Column:
    day = F.floor(i / 24).cast("int")
    return F.date_add(F.lit(_EPOCH).cast("date"), day).cast("timestamp_ntz") + hours(F.pmod(i, F.lit(24)))


def micros_between(a: Column, b: Column) -> Column:
    """b - a in microseconds for naive times, exact."""
    return _micros(b) - _micros(a)


def _micros(c: Column) -> Column:
    days = F.datediff(c.cast("date"), F.lit(_EPOCH).cast("date")).cast("bigint")
    seconds = F.extract(F.lit("SECOND"), c)  # decimal(8,6)
    return (
        (days * 86400 + F.hour(c) * 3600 + F.minute(c) * 60).cast("bigint") * 1000000
        + (seconds * 1000000).cast("bigint")
    )


def seconds_between(a: Column, b: Column) -> Column:
    return micros_between(a, b) / F.lit(1000000.0)


# --- P19 -----------------------------------------------------------------------------------------
def calendar_parts(c: Column) -> dict[str, Column]:
    return {
        "year": F.year(c), "month": F.month(c), "day": F.dayofmonth(c),
        "day_of_the_year": F.dayofyear(c),
    }


# --- P20 -----------------------------------------------------------------------------------------
def parse_dmy(text: Column) -> Column:
    """``dd/MM/yyyy`` to ISO text; unparsable becomes NULL."""
    return F.date_format(F.try_to_date(text, "dd/MM/yyyy"), "yyyy-MM-dd")


# --- P21 -----------------------------------------------------------------------------------------
def period_seconds(text: Column) -> Column:
    """``3H`` -> 10800. M is minutes; an unknown unit gives 0; number 0 or no unit is an error."""
    number = F.regexp_replace(text, r"[^0-9]", "").try_cast("bigint")
    unit = F.upper(F.regexp_replace(text, r"[^A-Za-z]", ""))
    factor = F.when(unit == "M", 60).when(unit == "H", 3600).when(unit == "D", 86400).otherwise(0)
    bad = F.coalesce(number, F.lit(0)) == 0
    return (
        F.when(text.isNull(), F.lit(None).cast("bigint"))
        .when(bad | (unit == ""), F.raise_error(F.concat(F.lit("invalid period text: "), text)).cast("bigint"))
        .otherwise(number * factor)
    )


def window_hours(text: Column) -> Column:
    """``24h``/``2d``/``h`` -> hours; a missing number counts as 1; other units are an error."""
    t = F.lower(F.trim(text))
    number = F.coalesce(F.nullif(F.regexp_extract(t, r"^(\d+)", 1), F.lit("")).cast("bigint"), F.lit(1))
    unit = F.regexp_extract(t, r"^\d*(.*)$", 1)
    return (
        F.when(text.isNull(), F.lit(None).cast("bigint"))
        .when(unit == "h", number)
        .when(unit == "d", number * 24)
        .otherwise(F.raise_error(F.concat(F.lit("unsupported time window: "), text)).cast("bigint"))
    )


# --- P24 -----------------------------------------------------------------------------------------
def shift_zone(c: Column, source: str, target: str) -> Column:
    """Wall-clock time in one zone to wall-clock time in another."""
    return F.convert_timezone(F.lit(source), F.lit(target), c)


def compact_minute(c: Column) -> Column:
    """``yyyy-MM-dd HH:mm`` without a detour through the session zone."""
    return F.substring(minute_floor(c).cast("string"), 1, 16)

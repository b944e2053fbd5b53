"""Date and time expressions that Spark has under another name or with another meaning."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day_name(d: Column | str) -> Column:
    return F.date_format(_col(d), "EEEE")


def month_name(d: Column | str) -> Column:
    return F.date_format(_col(d), "MMMM")


def week(d: Column | str) -> Column:
    """Week number 0-53 where weeks start on Sunday and week 1 is the first that has one."""
    c = _col(d)
    return F.floor((F.dayofyear(c) + 7 - F.dayofweek(c)) / 7).cast("int")


def _week_monday(c: Column) -> Column:
    """Week number 0-53 where weeks start on Monday and week 1 has at least four days in the year."""
    iso = F.weekofyear(c)
    return (
        F.when((F.month(c) == 1) & (iso >= 52), F.lit(0))
        .when((F.month(c) == 12) & (iso == 1), F.lit(53))
        .otherwise(iso)
    )


def _new_year(c: Column) -> Column:
    return F.trunc(c, "year")


def _week_full(c: Column) -> Column:
    """As ``week``, but days before the first Sunday belong to the last week of the year before."""
    return F.when(week(c) == 0, week(F.date_sub(_new_year(c), 1))).otherwise(week(c))


def period_add(period: Column | str, months: int) -> Column:
    """Add months to a period such as 202401 or, with a two-digit year, 2401; the result has four digits of year."""
    n = _months(period) + months
    return (F.floor(n / 12) * 100 + n % 12 + 1).cast("int")


def period_diff(a: Column | str, b: Column | str) -> Column:
    """Number of months between two periods."""
    return (_months(a) - _months(b)).cast("int")


def _months(period: Column | str) -> Column:
    """Months since year 0. Of two-digit years those below 70 are in this century, the others in the last."""
    p = _col(period).cast("int")
    year, month = F.floor(p / 100), p % 100
    full = F.when(year < 70, year + 2000).when(year < 100, year + 1900).otherwise(year)
    return full * 12 + month - 1


_DAYS_TO_YEAR_1 = 366  # day number of 0001-01-01 when counting from year 0


def to_days(d: Column | str) -> Column:
    return F.datediff(_col(d), F.lit("0001-01-01").cast("date")) + _DAYS_TO_YEAR_1


def from_days(n: Column | str) -> Column:
    return F.date_add(F.lit("0001-01-01").cast("date"), (_col(n) - _DAYS_TO_YEAR_1).cast("int"))


def sec_to_time(s: Column | str) -> Column:
    """Seconds as ``HH:mm:ss`` text; hours may exceed 23."""
    c = _col(s).cast("bigint")
    a = F.abs(c)
    body = F.format_string(
        "%02d:%02d:%02d", F.floor(a / 3600).cast("bigint"), F.floor(a % 3600 / 60).cast("bigint"), a % 60
    )
    return F.when(c < 0, F.concat(F.lit("-"), body)).when(c.isNotNull(), body)


def time_to_sec(t: Column | str) -> Column:
    """Seconds since midnight of a timestamp or a ``HH:mm:ss`` text; NULL for other text."""
    c = _col(t).try_cast("timestamp_ntz")
    return F.coalesce(clock_seconds(_col(t)), F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)).cast("int")


_CLOCK = r"^\s*(-?)([0-9]{1,3}):([0-5]?[0-9])(?::([0-5]?[0-9])(?:\.[0-9]*)?)?\s*$"


def clock_seconds(t: Column) -> Column:
    """Seconds of a ``HH:mm:ss`` or ``HH:mm`` text, whose hours may exceed 23; NULL for anything else."""
    text = t.cast("string")
    part = lambda i: F.coalesce(F.regexp_extract(text, _CLOCK, i).try_cast("bigint"), F.lit(0))
    seconds = part(2) * 3600 + part(3) * 60 + part(4)
    return F.when(text.rlike(_CLOCK), F.when(F.regexp_extract(text, _CLOCK, 1) == "-", -seconds).otherwise(seconds))


def current_time() -> Column:
    return F.date_format(F.current_timestamp(), "HH:mm:ss")


# Fixed values: %-codes of date formats with the equivalent Spark pattern.
_PATTERNS = {
    "a": "EEE", "b": "MMM", "c": "M", "d": "dd", "e": "d", "f": "SSSSSS", "H": "HH", "h": "hh", "I": "hh",
    "i": "mm", "j": "DDD", "k": "H", "l": "h", "M": "MMMM", "m": "MM", "p": "a", "r": "hh:mm:ss a", "S": "ss",
    "s": "ss", "T": "HH:mm:ss", "W": "EEEE", "Y": "yyyy", "y": "yy",
}


def _two(n: Column) -> Column:
    return F.lpad(n.cast("string"), 2, "0")


def _day_with_suffix(c: Column) -> Column:
    d = F.dayofmonth(c)
    suffix = (
        F.when(d.isin(11, 12, 13), "th").when(d % 10 == 1, "st").when(d % 10 == 2, "nd").when(d % 10 == 3, "rd")
        .otherwise("th")
    )
    return F.concat(d.cast("string"), suffix)


# Codes that have no Spark pattern.
_EXPRESSIONS = {
    "D": _day_with_suffix,
    "U": lambda c: _two(week(c)),
    "u": lambda c: _two(_week_monday(c)),
    "V": lambda c: _two(_week_full(c)),
    "v": lambda c: _two(F.weekofyear(c)),
    "w": lambda c: (F.dayofweek(c) - 1).cast("string"),
    "X": lambda c: (F.year(c) - F.when(week(c) == 0, 1).otherwise(0)).cast("string"),
    "x": lambda c: F.extract(F.lit("YEAROFWEEK"), c).cast("string"),
}


def date_format(d: Column | str, fmt: str) -> Column:
    """Format by %-codes, such as ``%Y-%m-%d``. A code without a meaning stands for its own letter."""
    c = _col(d)
    pieces = []
    for code, text in re.findall(r"%(.)|([^%]+)", fmt):
        if text:
            pieces.append(F.lit(text))
        elif code in _PATTERNS:
            pieces.append(F.date_format(c, _PATTERNS[code]))
        elif code in _EXPRESSIONS:
            pieces.append(_EXPRESSIONS[code](c))
        else:
            pieces.append(F.lit(code))
    return F.concat(*pieces)


# -- intervals ------------------------------------------------------------------------------------------------------

# Composite units and the fields their text holds, from the coarsest to the finest.
_COMPOSITE = {
    "SECOND_MICROSECOND": ("second", "microsecond"),
    "MINUTE_MICROSECOND": ("minute", "second", "microsecond"),
    "MINUTE_SECOND": ("minute", "second"),
    "HOUR_MICROSECOND": ("hour", "minute", "second", "microsecond"),
    "HOUR_SECOND": ("hour", "minute", "second"),
    "HOUR_MINUTE": ("hour", "minute"),
    "DAY_MICROSECOND": ("day", "hour", "minute", "second", "microsecond"),
    "DAY_SECOND": ("day", "hour", "minute", "second"),
    "DAY_MINUTE": ("day", "hour", "minute"),
    "DAY_HOUR": ("day", "hour"),
    "YEAR_MONTH": ("year", "month"),
}
_SIMPLE = ("MICROSECOND", "SECOND", "MINUTE", "HOUR", "DAY", "WEEK", "MONTH", "QUARTER", "YEAR")
UNITS = (*_SIMPLE, *_COMPOSITE)


def add_interval(ts: Column | str, amount: Column | int | str, unit: str, sign: int = 1) -> Column:
    """``ts`` plus (``sign`` = 1) or minus (-1) an interval.

    A composite unit takes its amount as text, such as ``'1:30'`` with ``MINUTE_SECOND``; missing leading fields
    are zero.
    """
    unit = unit.upper()
    if unit not in UNITS:
        raise ValueError(f"unknown interval unit {unit}")
    if unit in _COMPOSITE:
        names = _COMPOSITE[unit]
        digits = re.findall(r"\d+", str(amount))
        if names[-1] == "microsecond" and digits:
            digits[-1] = digits[-1].ljust(6, "0")  # the last field is a fraction of a second
        numbers = [int(n) for n in digits]
        if len(numbers) > len(names):
            raise ValueError(f"too many fields for {unit}: {amount!r}")
        sign = -sign if str(amount).strip().startswith("-") else sign
        amounts = {n: F.lit(v) for n, v in zip(names[len(names) - len(numbers):], numbers)}
    else:
        amounts = {unit.lower(): amount if isinstance(amount, Column) else F.lit(int(amount))}
    if "quarter" in amounts:
        amounts = {"month": amounts["quarter"] * 3}
    if "week" in amounts:
        amounts = {"day": amounts["week"] * 7}
    zero = F.lit(0)
    if set(amounts) & {"year", "month"}:
        step = F.make_ym_interval(*[amounts.get(n, zero).cast("int") for n in ("year", "month")])
    else:
        seconds = amounts.get("second", zero).cast("decimal(18,6)") + (
            amounts.get("microsecond", zero).cast("decimal(18,0)") / F.lit(1_000_000)
        ).cast("decimal(18,6)")
        step = F.make_dt_interval(
            *[amounts.get(n, zero).cast("int") for n in ("day", "hour", "minute")], seconds.cast("decimal(18,6)")
        )
    base = _col(ts).cast("timestamp_ntz")
    return base + step if sign > 0 else base - step

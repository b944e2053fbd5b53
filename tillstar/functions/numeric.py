"""Numeric expressions whose meaning differs from Spark's own function of the same name."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillstar.functions.dates import clock_seconds, sec_to_time
from tillstar.operators.dates import time_text

UNSIGNED = "decimal(20,0)"
TWO_64 = Decimal(1 << 64)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def percent_change(current: Column | str, previous: Column | str, digits: int = 2) -> Column:
    """Growth from ``previous`` to ``current`` in percent; NULL without a previous value or when it is zero.

    Both inputs must be decimal, so that the rounding is exact.
    """
    cur, prev = _col(current), _col(previous)
    return F.round(F.try_divide(cur - prev, prev) * 100, digits)


def divide(a: Column, b: Column) -> Column:
    """Division where a zero divisor gives NULL."""
    return F.try_divide(a, b)


def modulo(a: Column, b: Column) -> Column:
    """Remainder where a zero divisor gives NULL."""
    return F.try_mod(a, b)


def int_divide(a: Column | str, b: Column | str) -> Column:
    """Integer division, truncated towards zero; a zero divisor gives NULL."""
    num, den = (_col(c).cast("decimal(38,10)") for c in (a, b))
    return F.when(den != 0, F.call_function("div", num, den))


def truncate(x: Column | str, digits: int = 0) -> Column:
    """Cut (not round) ``x`` after ``digits`` decimals; exact for decimals, which stay decimal."""
    c = _col(x)
    scale = F.lit(10 ** abs(digits))
    scaled = c * scale if digits >= 0 else c / scale
    whole = F.when(c < 0, F.ceil(scaled)).otherwise(F.floor(scaled))
    return whole / scale if digits >= 0 else whole * scale


def log(x: Column | str) -> Column:
    """Natural logarithm; NULL outside its domain."""
    c = _col(x).cast("double")
    return F.when(c > 0, F.ln(c))


def sqrt(x: Column | str) -> Column:
    c = _col(x).cast("double")
    return F.when(c >= 0, F.sqrt(c))


def acos(x: Column | str) -> Column:
    c = _col(x).cast("double")
    return F.when(F.abs(c) <= 1, F.acos(c))


def asin(x: Column | str) -> Column:
    c = _col(x).cast("double")
    return F.when(F.abs(c) <= 1, F.asin(c))


# -- unsigned 64-bit arithmetic -------------------------------------------------------------------------------------


def unsigned(x: Column | str) -> Column:
    """A 64-bit pattern read as an unsigned number: negative values gain 2^64."""
    c = _col(x).cast("bigint")
    wide = c.cast(UNSIGNED)
    return F.when(c < 0, (wide + F.lit(TWO_64).cast(UNSIGNED)).cast(UNSIGNED)).otherwise(wide)


def _bits(x: Column | str) -> Column:
    """The 64-bit pattern of a whole number; an unsigned one from 2^63 on is the pattern of a negative one."""
    wide = _col(x).cast(UNSIGNED)
    two_63, two_64 = (F.lit(n).cast(UNSIGNED) for n in (TWO_64 / 2, TWO_64))
    return F.when(wide >= two_63, (wide - two_64).cast("bigint")).otherwise(wide.cast("bigint"))


def bit_and(a: Column | str, b: Column | str) -> Column:
    return unsigned(_bits(a).bitwiseAND(_bits(b)))


def bit_or(a: Column | str, b: Column | str) -> Column:
    return unsigned(_bits(a).bitwiseOR(_bits(b)))


def bit_xor(a: Column | str, b: Column | str) -> Column:
    return unsigned(_bits(a).bitwiseXOR(_bits(b)))


def bit_not(a: Column | str) -> Column:
    return unsigned(F.bitwise_not(_bits(a)))


def shift_left(a: Column | str, n: int) -> Column:
    """Left shift; a shift by 64 bits or more gives 0."""
    return unsigned(F.shiftleft(_bits(a), n)) if 0 <= n < 64 else unsigned(_bits(a).bitwiseAND(F.lit(0)))


def shift_right(a: Column | str, n: int) -> Column:
    """Unsigned right shift; a shift by 64 bits or more gives 0."""
    return unsigned(F.shiftrightunsigned(_bits(a), n)) if 0 <= n < 64 else unsigned(_bits(a).bitwiseAND(F.lit(0)))


# -- casts: text that does not parse gives NULL ---------------------------------------------------------------------


def _whole(x: Column | str) -> Column:
    """The nearest whole number of a number (halves away from zero), the leading whole number of a text."""
    c = _col(x)
    leading = F.nullif(F.regexp_extract(c.cast("string"), r"^\s*([+-]?[0-9]+)", 1), F.lit(""))
    number = F.round(c.cast("string").try_cast("decimal(38,10)"), 0)
    return F.when(F.typeof(c) == "string", leading.try_cast("decimal(38,0)")).otherwise(number.cast("decimal(38,0)"))


def cast_signed(x: Column | str) -> Column:
    """Signed integer: 1.7 gives 2, ``'12abc'`` 12, text without leading digits NULL."""
    return _whole(x).try_cast("bigint")


def cast_unsigned(x: Column | str) -> Column:
    """Unsigned integer, read as ``cast_signed`` does; a negative number wraps around at 2^64."""
    wide = _whole(x).try_cast(UNSIGNED)
    return F.when(wide < 0, unsigned(wide.try_cast("bigint"))).otherwise(wide)


def cast_decimal(x: Column | str, precision: int, scale: int) -> Column:
    return _col(x).try_cast(f"decimal({precision},{scale})")


def cast_char(x: Column | str, n: int | None = None) -> Column:
    text = _col(x).cast("string")
    return text if n is None else F.left(text, F.lit(n))


def cast_binary(x: Column | str) -> Column:
    return F.encode(_col(x).cast("string"), "UTF-8")


def cast_date(x: Column | str) -> Column:
    return _col(x).try_cast("date")


def cast_datetime(x: Column | str) -> Column:
    return _col(x).try_cast("timestamp_ntz")


def cast_time(x: Column | str) -> Column:
    """Time as ``HH:mm:ss`` text, from a timestamp or from such text, whose hours may exceed 23."""
    return F.coalesce(sec_to_time(clock_seconds(_col(x))), time_text(_col(x).try_cast("timestamp_ntz")))


def cast_json(x: Column | str) -> Column:
    return F.try_parse_json(_col(x))

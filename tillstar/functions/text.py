"""Text expressions that Spark has under another name or with another meaning."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def byte_length(s: Column | str) -> Column:
    return F.octet_length(_col(s))


def mid(s: Column | str, pos: int, length: int) -> Column:
    """Substring; a negative position counts from the end. Position 0, or one before the start, gives the empty text."""
    c = _col(s)
    if not pos or length <= 0:
        return F.left(c, F.lit(0))
    found = F.substring(c, pos, length)
    return found if pos > 0 else F.when(F.char_length(c) < -pos, F.left(c, F.lit(0))).otherwise(found)


def insert(s: Column | str, pos: int, length: int, new: Column) -> Column:
    """Replace ``length`` characters from ``pos``; unchanged when ``pos`` lies outside the text."""
    c = _col(s)
    n = F.char_length(c)
    rest = F.when(F.lit(length) < 0, n).otherwise(F.lit(length))
    return F.when((F.lit(pos) >= 1) & (F.lit(pos) <= n), F.overlay(c, new, F.lit(pos), rest)).otherwise(c)


def elt(n: Column | str, *options: Column) -> Column:
    """The n-th option; NULL when there is none."""
    i = _col(n)
    return F.when((i >= 1) & (i <= len(options)), F.get(F.array(*options), i.cast("int") - 1))


def field(x: Column | str, *options: Column) -> Column:
    """Position of ``x`` among the options, 0 when it is not there or NULL."""
    return F.coalesce(F.array_position(F.array(*options), _col(x)), F.lit(0)).cast("int")


def octal(n: Column | str) -> Column:
    return F.conv(_col(n).cast("string"), 10, 8)


def char_code(s: Column | str) -> Column:
    """Code of the first character: its UTF-8 bytes read as one number, 0 for the empty text."""
    first = F.left(_col(s), F.lit(1))
    return F.when(first == "", F.lit(0)).otherwise(
        F.conv(F.hex(F.encode(first, "UTF-8")), 16, 10).cast("bigint")
    ).cast("bigint")


def strcmp(a: Column | str, b: Column | str) -> Column:
    x, y = _col(a), _col(b)
    return F.when(x < y, -1).when(x > y, 1).when(x == y, 0)


def quote(s: Column | str) -> Column:
    """Text as a quoted literal; NULL becomes the bare word NULL."""
    escaped = F.replace(F.replace(_col(s), F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'"))
    return F.coalesce(F.concat(F.lit("'"), escaped, F.lit("'")), F.lit("NULL"))


def _bit(bits: Column, i: Column | int) -> Column:
    shifted = F.shiftright(bits, i) if isinstance(i, int) else F.call_function("shiftright", bits, i)
    return shifted.bitwiseAND(F.lit(1)) == 1


def make_set(bits: Column | str, *options: Column) -> Column:
    """The options whose bit is set, joined by commas; NULL options are left out."""
    b = _col(bits).cast("bigint")
    chosen = F.array(*[F.when(_bit(b, i), o) for i, o in enumerate(options)])
    return F.when(b.isNotNull(), F.array_join(chosen, ","))


def export_set(bits: Column | str, on: str, off: str, sep: str = ",", n: int = 64) -> Column:
    """The lowest ``n`` bits as ``on`` and ``off`` words, lowest bit first."""
    b = _col(bits).cast("bigint")
    words = F.transform(
        F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.when(_bit(b, i), F.lit(on)).otherwise(F.lit(off))
    )
    return F.when(b.isNotNull(), F.array_join(words, sep))


def any_of(*parts: Column) -> Column:
    """Logical OR of conditions; in Spark SQL two bars concatenate text instead."""
    return reduce(lambda a, b: a | b, parts)


def like_any_case(s: Column | str, pattern: str) -> Column:
    return _col(s).ilike(pattern)


def regexp_any_case(s: Column | str, pattern: str) -> Column:
    return _col(s).rlike(f"(?i){pattern}")


def equal_any_case(a: Column | str, b: Column | str) -> Column:
    """Equality that ignores case, through a collation."""
    return F.collate(_col(a), "UTF8_LCASE") == F.collate(_col(b), "UTF8_LCASE")


# The sound class of each letter; class 0 is silent.
_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_SOUNDS = "01230120022455012623010202"


def soundex(s: Column | str) -> Column:
    """Sound code of any length: silent letters are dropped before repeats are merged, short codes are padded to 4.

    Spark's own ``soundex`` cuts the code at four characters.
    """
    letters = F.upper(F.regexp_replace(_col(s), "[^A-Za-z]", ""))
    sounds = F.translate(letters, _LETTERS, _SOUNDS)
    spoken = F.concat(F.left(sounds, F.lit(1)), F.replace(F.substr(sounds, F.lit(2)), F.lit("0"), F.lit("")))
    merged = F.regexp_replace(spoken, r"(.)\1+", "$1")
    code = F.concat(F.left(letters, F.lit(1)), F.substr(merged, F.lit(2)))
    return F.when((letters == "") | (F.char_length(code) >= 4), code).otherwise(F.rpad(code, 4, "0"))

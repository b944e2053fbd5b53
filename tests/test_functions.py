from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tillstar.functions import dates as D
from tillstar.functions import numeric as N
from tillstar.functions import text as X


@pytest.fixture(scope="module")
def value(spark):
    def get(*columns):
        return tuple(spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first())

    return get


def test_numeric(value):
    d = F.lit("1.999").cast("decimal(10,3)")
    assert [float(x) for x in value(N.truncate(d, 1), N.truncate(-d, 1), N.truncate(F.lit(199), -1))] == [1.9, -1.9, 190]
    assert value(N.log(F.lit(0)), N.sqrt(F.lit(-1)), N.acos(F.lit(2)), N.asin(F.lit(2))) == (None,) * 4
    assert value(N.divide(F.lit(1), F.lit(0)), N.modulo(F.lit(1), F.lit(0)), N.int_divide(F.lit(1), F.lit(0))) == (None,) * 3
    assert value(N.int_divide(F.lit(-7), F.lit(2))) == (-3,)
    dec = [F.lit(v).cast("decimal(25,2)") for v in ("150.00", "100.00", "0.00")]
    got = value(N.percent_change(dec[0], dec[1]), N.percent_change(dec[0], dec[2]),
                N.percent_change(dec[0], F.lit(None).cast("decimal(25,2)")))
    assert (float(got[0]), got[1], got[2]) == (50.0, None, None)


def test_bits(value):
    got = value(N.bit_not(F.lit(1)), N.bit_and(F.lit(29), F.lit(15)), N.bit_or(F.lit(29), F.lit(15)),
                N.bit_xor(F.lit(1), F.lit(1)), N.shift_left(F.lit(1), 63), N.shift_left(F.lit(1), 64),
                N.shift_right(F.lit(-1), 1))
    assert [int(v) for v in got] == [18446744073709551614, 13, 31, 0, 1 << 63, 0, (1 << 63) - 1]


def test_casts(value):
    s = F.lit
    assert value(N.cast_signed(s("12")), N.cast_signed(s("x")), N.cast_date(s("2024-02-30")),
                 N.cast_date(s("2024-02-29")), N.cast_char(s("abcdef"), 3), N.cast_time(s("2024-01-01 10:11:12"))) == (
        12, None, None, date(2024, 2, 29), "abc", "10:11:12",
    )
    got = value(N.cast_unsigned(s(-1)), N.cast_unsigned(s("18446744073709551615")), N.cast_decimal(s("1.256"), 5, 2))
    assert [str(v) for v in got] == ["18446744073709551615", "18446744073709551615", "1.26"]
    assert value(N.cast_datetime(s("2024-01-01 10:11:12")), N.cast_binary(s("a"))) == (
        datetime(2024, 1, 1, 10, 11, 12), bytearray(b"a"),
    )
    assert value(F.to_json(N.cast_json(s('{"a": 1}'))), N.cast_json(s("{bad"))) == ('{"a":1}', None)


def test_text(value):
    s = F.lit
    assert value(X.byte_length(s("é")), X.mid(s("abcdef"), 2, 3), X.mid(s("abcdef"), -2, 2), X.mid(s("abc"), 0, 2)) == (
        2, "bcd", "ef", "",
    )
    assert value(X.insert(s("Quadratic"), 3, 4, s("What")), X.insert(s("Quadratic"), -1, 4, s("What")),
                 X.insert(s("Quadratic"), 3, 100, s("What"))) == ("QuWhattic", "Quadratic", "QuWhat")
    opts = [s("Aa"), s("Bb"), s("Cc")]
    assert value(X.elt(s(1), *opts), X.elt(s(4), *opts), X.elt(s(0), *opts)) == ("Aa", None, None)
    assert value(X.field(s("Bb"), *opts), X.field(s("Gf"), *opts), X.field(s(None).cast("string"), *opts)) == (2, 0, 0)
    assert value(X.octal(s(12)), X.char_code(s("2")), X.char_code(s("é")), X.char_code(s(""))) == ("14", 50, 0xC3A9, 0)
    assert value(X.strcmp(s("a"), s("b")), X.strcmp(s("b"), s("a")), X.strcmp(s("a"), s("a"))) == (-1, 1, 0)
    assert value(X.quote(s("Don't!")), X.quote(s("a\\b")), X.quote(s(None).cast("string"))) == (
        "'Don\\'t!'", "'a\\\\b'", "NULL",
    )
    abc = [s("a"), s("b"), s("c")]
    assert value(X.make_set(s(5), *abc), X.make_set(s(0), *abc), X.make_set(s(3), s(None).cast("string"), s("b"))) == (
        "a,c", "", "b",
    )
    assert value(X.export_set(s(5), "Y", "N", ",", 4), X.export_set(s(6), "1", "0", ",", 10)) == (
        "Y,N,Y,N", "0,1,1,0,0,0,0,0,0,0",
    )
    assert value(X.like_any_case(s("ABC"), "a%"), X.regexp_any_case(s("ABC"), "^ab"), X.equal_any_case(s("a"), s("A")),
                 X.any_of(s(False), s(True))) == (True,) * 4


def test_soundex(value):
    words = {"Hello": "H400", "Quadratically": "Q36324", "": "", "Pfister": "P236", "a-B c": "A120", "Tymczak": "T520"}
    assert value(*[X.soundex(F.lit(w)) for w in words]) == tuple(words.values())
    assert value(X.soundex(F.lit(None).cast("string"))) == (None,)


def test_dates(value):
    def d(t):
        return F.lit(t).cast("date")

    assert value(D.day_name(d("2007-02-03")), D.month_name(d("2008-02-03"))) == ("Saturday", "February")
    assert value(D.week(d("2008-02-20")), D.week(d("2000-12-31")), D.week(d("2008-01-01"))) == (7, 53, 0)
    assert value(D.period_add(F.lit(200801), 2), D.period_add(F.lit(202411), 3), D.period_diff(F.lit(200802), F.lit(200703))) == (
        200803, 202502, 11,
    )
    assert value(D.to_days(d("2007-10-07")), D.from_days(F.lit(730669))) == (733321, date(2000, 7, 3))
    assert value(D.sec_to_time(F.lit(2378)), D.sec_to_time(F.lit(-100000)), D.time_to_sec(F.lit("2024-01-01 22:23:00"))) == (
        "00:39:38", "-27:46:40", 80580,
    )
    assert value(D.current_time())[0].count(":") == 2


def test_date_format(value):
    ts = F.lit("2009-10-04 22:23:00").cast("timestamp_ntz")
    assert value(D.date_format(ts, "%W %M %Y"), D.date_format(ts, "%H:%i:%s"),
                 D.date_format(ts, "%D %y %a %d %m %b %j"), D.date_format(ts, "%H %k %I %r %T %S %w")) == (
        "Sunday October 2009", "22:23:00", "4th 09 Sun 04 10 Oct 277", "22 22 10 10:23:00 PM 22:23:00 00 0",
    )
    day = F.lit("1999-01-01").cast("date")
    assert value(D.date_format(day, "%X %V"), D.date_format(day, "%x %v %u %U"), D.date_format(day, "%% %z it's")) == (
        "1998 52", "1998 53 00 00", "% z it's",
    )


@pytest.mark.parametrize("amount, unit, want", [
    (1, "MICROSECOND", "2000-02-29 23:59:59.000001"),
    (1, "SECOND", "2000-03-01 00:00:00"),
    (-1, "MINUTE", "2000-02-29 23:58:59"),
    (1, "HOUR", "2000-03-01 00:59:59"),
    (1, "DAY", "2000-03-01 23:59:59"),
    (1, "WEEK", "2000-03-07 23:59:59"),
    (1, "MONTH", "2000-03-29 23:59:59"),
    (1, "QUARTER", "2000-05-29 23:59:59"),
    (1, "YEAR", "2001-02-28 23:59:59"),
    ("1.000001", "SECOND_MICROSECOND", "2000-03-01 00:00:00.000001"),
    ("1:0.5", "MINUTE_MICROSECOND", "2000-03-01 00:00:59.500000"),
    ("1:1", "MINUTE_SECOND", "2000-03-01 00:01:00"),
    ("0:0:1.0", "HOUR_MICROSECOND", "2000-03-01 00:00:00"),
    ("1:0:1", "HOUR_SECOND", "2000-03-01 01:00:00"),
    ("1:30", "HOUR_MINUTE", "2000-03-01 01:29:59"),
    ("1 0:0:0.1", "DAY_MICROSECOND", "2000-03-01 23:59:59.100000"),
    ("1 1:1:1", "DAY_SECOND", "2000-03-02 01:01:00"),
    ("-1 0:30", "DAY_MINUTE", "2000-02-28 23:29:59"),
    ("1 1", "DAY_HOUR", "2000-03-02 00:59:59"),
    ("1-2", "YEAR_MONTH", "2001-04-29 23:59:59"),
])
def test_intervals(value, amount, unit, want):
    ts = F.lit("2000-02-29 23:59:59")
    assert str(value(D.add_interval(ts, amount, unit))[0]) == want
    assert len(D.UNITS) == 20


def test_interval_errors():
    with pytest.raises(ValueError):
        D.add_interval("t", 1, "FORTNIGHT")
    with pytest.raises(ValueError):
        D.add_interval("t", "1:2:3", "MINUTE_SECOND")

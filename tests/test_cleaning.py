import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tillstar.operators import cleaning as C
from tillstar.operators.dates import add_date_parts, season
from tillstar.sources import files


def values(spark, texts, fn, kind="string"):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], f"i int, t {kind}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("t"))).collect()]


def test_integer(spark):
    assert values(spark, [" 12 ", "x", "", None, "3.5", "-4", "99999999999"], C.integer) == [
        12, None, None, None, None, -4, None,
    ]


def test_money(spark):
    got = values(spark, ["1299.99$", "$ 5", "-3.00$", "n/a", "1.2.3", None, "1,000.50"], C.money)
    assert [None if v is None else str(v) for v in got] == ["1299.99", "5.00", None, None, None, None, "1000.50"]


def test_timestamp_is_strict(spark):
    got = values(spark, ["2019-02-03 04:05:06", "2019-13-01 00:00:00", "2019-02-30 00:00:00", "junk", None], C.timestamp)
    assert [None if v is None else str(v) for v in got] == ["2019-02-03 04:05:06", None, None, None, None]


def test_zero_dates(spark):
    zero = ["0000-00-00 00:00:00"]
    assert values(spark, zero, lambda t: C.timestamp(t, zero_date="null")) == [None]
    assert str(values(spark, zero, lambda t: C.timestamp(t, zero_date="round"))[0]) == "0001-01-01 00:00:00"
    with pytest.raises(PySparkException):
        values(spark, zero, lambda t: C.timestamp(t, zero_date="error"))
    with pytest.raises(ValueError):
        C.timestamp("t", zero_date="other")


def test_repair_fields(spark):
    got = values(spark, ["1,a, b ,c", "1,a,b,x,c", "1,a,b,x,y,c", "1,a"], lambda t: C.repair_fields(t, 4, 2))
    assert got == [["1", "a", "b", "c"], ["1", "a", "b,x", "c"], ["1", "a", "b,x,y", "c"], None]


def test_products_file(spark, tmp_path):
    (tmp_path / "p.csv").write_text(
        "id,name,price,sid,sname,stid,stname\n"
        '1,Lamp,10.50$,3,"Glow, Inc.",7,North\n'
        "2, Desk ,99$,4,Wood, Ltd,7,North\n"
        "3,Chair,-5$,4,Wood,7,North\n"
        "x,Sofa,5$,4,Wood,7,North\n"
        "5,Short\n"
    )
    good, bad = C.split_rejects(C.clean_products(files.read_products(spark, str(tmp_path))))
    assert sorted((r.product_id, r.product_name, str(r.price), r.supplier_name) for r in good.collect()) == [
        (1, "Lamp", "10.50", "Glow, Inc."),
        (2, "Desk", "99.00", "Wood, Ltd"),
    ]
    assert sorted(r.reject_reason for r in bad.collect()) == ["bad price", "bad product_id", "malformed row"]


def test_customers_file(spark, tmp_path):
    (tmp_path / "c.csv").write_text("a,b,c\n 1 , Ann ,Female\n2,Bob,\nq,Cy,Male\n")
    good, bad = C.split_rejects(C.clean_customers(files.read_customers(spark, str(tmp_path))))
    assert sorted(map(tuple, good.collect())) == [(1, "Ann", "Female"), (2, "Bob", None)]
    assert bad.count() == 1


def test_date_parts(spark):
    days = ["2024-06-30", "2024-07-01", "2024-12-31", "2024-06-01", "2024-06-02", "2024-06-03"]
    df = spark.createDataFrame([(d,) for d in days], "d string").select(F.to_date("d").alias("date_t"))
    got = {str(r.date_t): r for r in add_date_parts(df).collect()}
    assert [got[d].half_of_year for d in days[:3]] == [1, 2, 2]
    assert [got[d].quarter_t for d in days[:3]] == [2, 3, 4]
    assert [got[d].weekend for d in days] == [True, False, False, True, True, False]


def test_season(spark):
    months = spark.range(1, 13).select("id", season(F.col("id")).alias("s"))
    got = {r.id: r.s for r in months.collect()}
    assert [got[m] for m in (12, 1, 2, 3, 5, 6, 8, 9, 11)] == [
        "Winter", "Winter", "Winter", "Spring", "Spring", "Summer", "Summer", "Fall", "Fall",
    ]


def test_bulk_load(spark, tmp_path):
    (tmp_path / "c.csv").write_text("a,b,c\n1,Ann,Female\n")
    out = files.load_file(spark, str(tmp_path / "c.csv"), files.schema.RAW_CUSTOMERS, str(tmp_path / "t"))
    assert [tuple(r) for r in out.collect()] == [("1", "Ann", "Female")]

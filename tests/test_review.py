"""Inputs that once gave a wrong answer or ended a job."""

from concurrent.futures import ThreadPoolExecutor
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillstar.functions import dates, json as J, numeric, text
from tillstar.operators import cleaning, documents, loads, tables
from tillstar.plans import queries, reports
from tillstar.plans.star import SourceStar
from tillstar.session import SETTINGS, configure
from tillstar.streaming import transactions as stream

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def value(spark):
    one = spark.range(1)
    return lambda column: one.select(column.alias("v")).first().v


def test_unsigned(value):
    big = F.lit(Decimal(1 << 63)).cast("decimal(20,0)")
    assert value(numeric.bit_not(numeric.bit_not(F.lit(1)))) == 1
    assert value(numeric.bit_and(numeric.bit_not(F.lit(0)), F.lit(1))) == 1
    assert value(numeric.shift_right(big, 63)) == 1 and value(numeric.shift_left(F.lit(1), 63)) == 1 << 63
    assert value(numeric.bit_or(big, F.lit(1))) == (1 << 63) + 1 and value(numeric.shift_left(big, 64)) == 0


@pytest.mark.parametrize("doc, candidate, expected", [
    ("[1e2]", 100, True), ("[100.0]", 100, True), ("[[1,2],3]", 1, True), ("[[[1]],3]", 1, True), ("[[1,2],3]", 4, False),
    ('[{"a":1,"b":2}]', {"a": 1}, True), ('[[{"a":1,"b":2}]]', {"a": 1.0}, True), ('[{"a":1}]', {"a": 2}, False),
    ("[[1,2],3]", [3, [1]], True), ("[1,2]", [[1]], False), ('["100"]', 100, False), ("null", None, True),
    ("[12345678901234567890123456789012345]", 1, False), ('{"a":[1,{"b":2}]}', {"a": [{"b": 2}]}, True),
])
def test_contains(value, doc, candidate, expected):
    assert value(J.contains(F.parse_json(F.lit(doc)), candidate)) is expected


@pytest.mark.parametrize("a, b, expected", [("[1e2,3]", "[100]", True), ("[1.50]", "[1.5]", True), ("[1]", "[2]", False),
                                            ('{"k":1.0}', '{"k":1}', True), ("5", "[4,5.0]", True)])
def test_overlaps(value, a, b, expected):
    assert value(J.overlaps(F.parse_json(F.lit(a)), F.parse_json(F.lit(b)))) is expected


def test_paths(value):
    doc = F.lit('{"a.b": 1, "a": {"b": 2}, "é d": [5]}')
    assert value(J.get(doc, '$."a.b"')) == "1" and value(J.get(doc, "$.a.b")) == "2" and value(J.get(doc, '$."é d"[0]')) == "5"
    deep = "".join('{"x":[' for _ in range(30)) + '{"k":7}' + "]}" * 30
    assert value(F.size(J.find_all(F.parse_json(F.lit(deep)), "$**.k"))) == 1
    assert value(F.size(J.find_all(F.parse_json(F.lit("3")), "$**.k"))) == 0


def test_malformed_documents(spark):
    docs = spark.createDataFrame([("1", '{"a":1}'), ("2", "{"), ("3", '{"a":1,"a":2}'), ("4", None)], "_id string, doc string")
    good, bad = documents.split_malformed(docs)
    assert [r["_id"] for r in good.collect()] == ["1"] and sorted(r["_id"] for r in bad.collect()) == ["2", "3", "4"]
    assert docs.select(J.get("doc", "$.a").alias("a")).collect()[1].a is None


@pytest.mark.parametrize("doc, path, expected", [('{"x":1}', "$.x[0]", '{"_id":"1","x":9}'), ('{"x":1}', "$.x[1]", '{"_id":"1","x":[1,9]}'),
                                                 ('{"x":{"y":1}}', "$.x[0].y", '{"_id":"1","x":{"y":9}}')])
def test_cell_of_a_scalar(spark, doc, path, expected):
    docs = documents.documents(spark, ['{"_id":"1",' + doc[1:]])
    assert documents.modify(docs, "true", documents.set_(path, 9)).first().doc == expected


def test_numbers(value):
    assert str(value(numeric.truncate(F.lit(Decimal("12345678901234567.89")), 1)).normalize()) == "12345678901234567.8"
    assert value(numeric.truncate(F.lit(Decimal("-1.99")), 1)) == Decimal("-1.9")
    assert value(numeric.truncate(F.lit(Decimal("-199")), -2)) == -100
    assert value(numeric.int_divide(F.lit(7.5), F.lit(2.0))) == 3 and value(numeric.int_divide(F.lit(-7.5), F.lit(2.0))) == -3
    assert value(numeric.cast_signed(F.lit(Decimal("1.7")))) == 2 and value(numeric.cast_signed(F.lit(-1.5))) == -2
    assert value(numeric.cast_signed(F.lit("12abc"))) == 12 and value(numeric.cast_signed(F.lit("abc"))) is None
    assert value(numeric.cast_unsigned(F.lit(-1))) == (1 << 64) - 1


def test_times(value):
    assert value(numeric.cast_time(F.lit("10:11:12"))) == "10:11:12" and value(numeric.cast_time(F.lit("30:00:05"))) == "30:00:05"
    assert value(numeric.cast_time(F.lit("2020-01-02 03:04:05"))) == "03:04:05" and value(numeric.cast_time(F.lit("x"))) is None
    assert value(dates.time_to_sec(F.lit("22:23:00"))) == 80580 and value(dates.time_to_sec(F.lit("-01:00:00"))) == -3600
    assert value(dates.time_to_sec(F.lit("x"))) is None
    assert value(dates.period_add(F.lit(9801), 2)) == 199803 and value(dates.period_add(F.lit(202411), 3)) == 202502
    assert value(dates.period_diff(F.lit(9802), F.lit(199703))) == 11


def test_missing_hour(spark, value):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    configure(spark)
    assert SETTINGS["spark.sql.session.timeZone"] == "UTC"
    assert value(dates.date_format(F.lit("2024-03-10 02:30:00").cast("timestamp_ntz"), "%H:%i")) == "02:30"


def test_text(value):
    assert [value(text.mid(F.lit("abc"), p, 8)) for p in (-10, -3, -1, 0, 2, 9)] == ["", "abc", "c", "", "bc", ""]


@pytest.mark.parametrize("raw, expected", [("(12.00)", None), ("\u22125.00", None), ("-5", None), ("12 x 3", None), ("", None),
                                           ("1299.99$", "1299.99"), ("$ 1,299.5", "1299.50"), ("€7", "7.00"), ("1,2", None)])
def test_prices(value, raw, expected):
    found = value(cleaning.money(F.lit(raw)))
    assert (None if found is None else str(found)) == expected


def test_many_inserted_rows(spark):
    df = spark.createDataFrame([(1, "a")], "n bigint, t string")
    out = tables.insert(df, ["n", "t"], [(i, F.concat(F.lit("x"), F.lit(str(i)))) for i in range(300)])
    assert out.count() == 301 and out._jdf.queryExecution().analyzed().toString().count("Range") == 1


def test_loads_at_the_same_time(spark, tmp_path):
    star = SourceStar.read(spark, FOLDER)
    products, customers = queries.staged_products(star), queries.checked_customers(star)
    rows = [queries.transactions(star).filter(f"order_id % 2 = {i}") for i in range(2)]
    root = str(tmp_path / "dw")
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(lambda r: loads.load_transactions(r, products, customers, root), rows))
    star = loads.read_warehouse(spark, root)
    assert star.sales.count() == sum(r.count() for r in rows)  # neither load is lost
    assert star.sales.groupBy("order_id").count().count() == sum(r.select("order_id").distinct().count() for r in rows)
    for name in loads.DIMENSIONS:  # and what both need is there once
        table = getattr(star, name)
        assert table.count() == table.select(table.columns[0]).distinct().count(), name


def test_ids_are_summed_below_the_names(spark):
    star = SourceStar.read(spark, FOLDER)
    for report in (reports.supplier_contribution, reports.monthly_volatility, reports.yearly_rollup):
        df = report(star, 1997) if report is reports.yearly_rollup else report(star)
        plan = df._jdf.queryExecution().executedPlan().toString()
        below = plan.split("partial_sum(quantity", 1)[1]
        assert "Expand" not in plan and "part.parquet" not in below[: below.index("orders.parquet")]


def test_unusable_rows_spread(spark):
    """Rows without keys do not meet in one task, and match nothing."""
    rows = spark.range(1000).selectExpr(
        "id AS order_id", "cast(null AS timestamp_ntz) AS order_ts", "cast(if(id < 900, null, id) AS bigint) AS product_id",
        "1 AS quantity", "id AS customer_id")
    products = spark.createDataFrame([(950, Decimal("1.50"))], "product_id bigint, price decimal(10,2)")
    customers = spark.range(1000).selectExpr("id AS customer_id", "'c' AS customer_name")
    from tillstar.operators.enrich import lookup
    found = lookup(rows, products, customers)
    assert found.where("reject_reason is null").select("order_id").collect()[0].order_id == 950
    assert found.where("reject_reason = 'unknown product'").count() == 999 and found.count() == 1000

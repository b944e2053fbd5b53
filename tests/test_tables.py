import datetime

import pytest
from pyspark.sql import functions as F

from tillstar.operators import joins, ranks
from tillstar.operators import tables as T
from tillstar.plans.reports import create_view
from tillstar.sources import jdbc


@pytest.fixture(scope="module")
def people(spark):
    ages = [11, 11, 12, 12, 13, 14, 14, 15, 15, 16, 17, 17]
    return spark.createDataFrame([(f"n{i}", a, 0) for i, a in enumerate(ages)], "name string, age int, something int")


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_full_select(people):
    got = T.select(
        people, "count(*) AS n", where="age > 11", group_by=["something", "age"], having="n > 1",
        order_by=[F.desc("age")], limit=2, offset=1,
    )
    assert [(r.age, r.n) for r in got.collect()] == [(15, 2), (14, 2)]


def test_order_by_two_keys(spark):
    df = spark.createDataFrame([(2, 20, 21), (1, 20, 22), (4, 10, 40), (3, 10, 50)], "id int, x int, y int")
    assert rows(T.select(df, "id", "x", "y", order_by=[F.desc("x"), F.desc("y")]).select("id")) == [(1,), (2,), (3,), (4,)]


def test_offset_without_limit(spark):
    df = spark.range(6).toDF("id")
    assert rows(T.select(df, order_by=[F.desc("id")], offset=4, keys=["id"])) == [(1,), (0,)]
    with pytest.raises(ValueError):
        T.select(df, offset=1)


def test_view(spark):
    a = spark.createDataFrame([(1, "Lena 1"), (2, "Lena 2"), (3, "Other")], "id int, name string")
    b = spark.createDataFrame([(1, 19), (2, 20), (3, 5)], "id int, age int")
    view = create_view(a.join(b, "id"), "people_view")
    got = spark.sql("SELECT id FROM {v} WHERE name LIKE :p AND age < :n", args={"p": "Lena%", "n": 20}, v=view)
    assert rows(got) == [(1,)]


def test_insert_update_delete(spark):
    df = spark.createDataFrame([], "id int, name string, born date, age int")
    df = T.insert(df, ["id", "name", "born", "age"], [
        (1, "Marina", datetime.date(2001, 3, 4), 14),
        (2, "Sabrina", datetime.date(2002, 4, 5), F.lit(10) + 3),
    ])
    df = T.insert(df, ["id"], [(3,)])
    df = T.update(df, {"name": F.concat("name", F.lit("-updated")), "age": F.col("age") + 1}, "name LIKE '%rina'")
    assert sorted(rows(df.select("id", "name", "age"))) == [
        (1, "Marina-updated", 15), (2, "Sabrina-updated", 14), (3, None, None),
    ]
    assert T.delete(df, "age = 15").count() == 2
    assert T.delete(df, "age > 0").count() == 1  # a NULL condition keeps its row
    assert T.delete(df).count() == 0
    assert rows(T.row_count(df)) == [(3,)]
    with pytest.raises(ValueError):
        T.insert(df, ["id"], [(1, 2)])


def test_update_and_delete_with_limit(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(9)], "id int, g int")
    got = T.update(df, {"g": 100}, "g = 0", order_by=[F.desc("id")], limit=2, keys=["id"])
    assert sorted(r.id for r in got.collect() if r.g == 100) == [3, 6]
    assert got.count() == 9
    left = T.delete(df, "g <> 0", order_by=["g"], limit=4, keys=["id"])
    assert sorted(r.id for r in left.collect()) == [0, 3, 5, 6, 8]
    with pytest.raises(ValueError):
        T.delete(df, limit=1)


def test_update_swaps_use_old_values(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert rows(T.update(df, {"a": F.col("b"), "b": F.col("a")})) == [(2, 1)]


def test_jdbc_options():
    opts = jdbc.read_options("jdbc:x", "t", partition=("id", 0, 100, 4), fetch_size=50)
    assert opts["numPartitions"] == "4" and opts["fetchsize"] == "50" and opts["dbtable"] == "t"
    assert jdbc.read_options("jdbc:x", query="SELECT 1")["dbtable"] == "(SELECT 1) q"
    assert jdbc.write_options("jdbc:x", "t", batch_size=7)["batchsize"] == "7"
    with pytest.raises(ValueError):
        jdbc.read_options("jdbc:x")


def test_deep_pages(spark, monkeypatch):
    """Beyond the bound of a top-n, rows are numbered by ranges: the same rows, and no task with all of them."""
    df = spark.range(2_000_000).selectExpr("id", "id % 7 AS g", "pmod(xxhash64(id), 1000) AS h")
    page = T.select(df, order_by=[F.desc("h"), "g"], limit=5, offset=1_000_000, keys=["id"])
    whole = df.orderBy(F.desc("h"), "g", "id").offset(1_000_000).limit(5)
    assert rows(page) == rows(whole)
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "Limit" not in plan and "TakeOrdered" not in plan and "SinglePartition" not in plan
    rest = T.select(df, order_by=["id"], offset=1_999_998, keys=["id"])
    assert [r.id for r in rest.collect()] == [1_999_998, 1_999_999]
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 3)
    few = spark.createDataFrame([(i, i % 3, None if i % 4 else "x") for i in range(20)], "id int, g int, t string")
    assert [r.id for r in T.select(few, order_by=[F.desc("g")], limit=6, offset=2, keys=["id"]).collect()] == [8, 11, 14, 17, 1, 4]
    kept = T.delete(few, "g > 0", order_by=["g"], limit=5, keys=["id"])
    assert sorted(r.id for r in kept.collect()) == [i for i in range(20) if i not in (1, 4, 7, 10, 13)] and kept.columns == few.columns
    changed = T.update(few, {"t": "hit"}, "t IS NULL", order_by=[F.desc("id")], limit=4, keys=["id"])
    assert sorted(r.id for r in changed.filter("t = 'hit'").collect()) == [15, 17, 18, 19]


def test_numbers_of_equal_rows(spark):
    """Ties, nulls and repeated rows: every number once, in the order's sense; an empty table has none."""
    df = spark.createDataFrame([(None,)] * 50 + [(1,)] * 500 + [(i,) for i in range(50)], "x int").repartition(7)
    got = sorted((r.position, r.x) for r in ranks.numbered(df, [F.desc_nulls_last("x")]).collect())
    assert [p for p, _ in got] == list(range(600))
    want = sorted([1] * 500 + list(range(50)), reverse=True) + [None] * 50
    assert [x for _, x in got] == want
    assert ranks.numbered(df.filter("x > 99"), ["x"]).collect() == []

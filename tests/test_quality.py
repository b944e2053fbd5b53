from pyspark.sql import functions as F

from tillstar.operators import dedupe
from tillstar.operators import quality as Q


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_unique(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    assert rows(Q.unique(df, ["k"])) == [("unique(k)", 1, 2), ("unique(k)", None, 1)]
    assert Q.unique(df.filter("k = 2"), ["k"]).count() == 0


def test_row_rules(spark):
    df = spark.createDataFrame(
        [(1, "ok", "Male", 1.0), (2, None, None, 2.0), (3, "x" * 20, "Other", 123456.0)],
        "id int, name string, gender string, price double",
    )
    rules = (
        Q.not_null(["id", "name"])
        | Q.check("gender", F.col("gender").isin("Male", "Female"))
        | Q.text_length({"name": 10})
        | Q.decimal_range({"price": (5, 2)})
    )
    assert rows(Q.row_violations(df, rules, ["id"])) == [
        ("check(gender)", 3), ("decimal(price)", 3), ("length(name)", 3), ("not_null(name)", 2),
    ]


def test_foreign_key(spark):
    child = spark.createDataFrame([(1,), (1,), (9,), (9,), (9,), (None,)], "k int")
    parent = spark.createDataFrame([(1,), (2,)], "k int")
    assert rows(Q.foreign_key(child, parent, "k")) == [("foreign_key(k)", 9, 3)]


def test_conflicts(spark):
    df = spark.createDataFrame([(19, "A"), (19, "B"), (19, "A"), (5, "C"), (5, "C")], "k int, n string")
    assert rows(Q.conflicts(df, ["k"], ["n"])) == [("conflict(k)", 19, 2, 3)]


def test_keep_last_does_not_depend_on_partitioning(spark):
    data = [(i % 7, i % 3, i * 37 % 101) for i in range(200)]
    df = spark.createDataFrame(data, "k int, seq int, v int")
    want = sorted(((k, *max((s, v) for kk, s, v in data if kk == k)) for k in range(7)), key=str)
    for n in (1, 7):
        assert rows(dedupe.keep_last(df.repartition(n), ["k"], ["seq"])) == want
        assert rows(dedupe.keep_last(df.repartition(n, "v"), ["k"], ["seq"])) == want


def test_keep_one_shrinks_rows_before_it_sorts(spark):
    df = spark.range(10).selectExpr("id % 3 AS k", "cast(id % 2 AS string) AS n")
    text = dedupe.keep_one(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert text.count("HashAggregate") > text.count("SortAggregate") - 1
    below = text[text.rindex("SortAggregate") :]
    assert "HashAggregate" in below


def test_keep_one_takes_the_smallest(spark):
    df = spark.createDataFrame([(1, "b", 1), (1, "a", 9), (1, "a", 2), (2, "z", 0)], "k int, n string, m int")
    for n in (1, 5):
        assert rows(dedupe.keep_one(df.repartition(n), ["k"])) == [(1, "a", 2), (2, "z", 0)]
    assert rows(dedupe.keep_one(df.select("k"), ["k"])) == [(1,), (2,)]

"""The physical plans the operators rely on."""

import re

import pytest
from compare import TESTDATA

from tillstar.operators import dedupe, enrich, loads, tables
from tillstar.plans import queries, reports
from tillstar.plans.star import SourceStar
from tillstar.sources.tables import read_table

FOLDER = f"{TESTDATA}/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def star(spark):
    return SourceStar.read(spark, FOLDER)


def test_year_reaches_the_scan(star):
    text = plan(reports.top_products(star, 1997))
    assert "GreaterThanOrEqual(o_orderdate,1997-01-01" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in text


def test_top_k_is_cut_before_the_shuffle(star):
    assert plan(reports.top_products(star, 1997)).count("WindowGroupLimit") >= 2
    assert plan(reports.product_affinity(star)).count("TakeOrderedAndProject") >= 2


def test_quantities_are_summed_before_the_price_is_joined(star):
    text = plan(reports.half_year_split(star))
    below = text.split("partial_sum(quantity", 1)[1]
    assert "part.parquet" not in below[: below.index("orders.parquet")]


def test_joins_only_what_is_asked_for(star):
    def tables_read(df):
        return set(re.findall(r"/(\w+)\.parquet", plan(df)))

    assert tables_read(reports.product_affinity(star)) == {"lineitem", "part"}
    assert tables_read(reports.half_year_split(star)) == {"lineitem", "orders", "part"}
    assert tables_read(star.fact(["order_id", "quantity"])) == {"lineitem"}


def test_no_python_and_no_cross_joins(spark):
    for name, query in queries.QUERIES.items():
        if name.startswith(("m", "o1", "o2", "s6", "s7")):
            continue  # these write tables
        text = plan(query(spark, FOLDER))
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "BatchEvalPython",
                    "MapInPandas"):
            assert bad not in text, (name, bad)


def test_written_fact_is_pruned_by_year(spark, star, tmp_path):
    root = str(tmp_path / "dw")
    loads.load_transactions(
        queries.transactions(star), queries.product_master(star), queries.customer_master(star), root, check=False
    )
    text = plan(reports.store_growth(loads.read_warehouse(spark, root), 1997))
    assert re.search(r"PartitionFilters: \[[^\]]*year_t#\d+ = 1997", text)
    assert "date.parquet" not in text and "/date" not in text


def test_few_picked_rows_leave_the_table_in_place(spark):
    orders = read_table(spark, FOLDER, "orders")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        few = plan(tables.delete(orders, "o_orderstatus = 'F'", ["o_totalprice"], 10, ["o_orderkey"]))
        many = plan(tables.delete(orders, "o_orderstatus = 'F'", ["o_totalprice"], 10**7, ["o_orderkey"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # few rows are broadcast; many are numbered by ranges, so that no key is joined and no task has them all
    assert "BroadcastHashJoin" in few and "SortMergeJoin" not in many
    assert "Limit" not in many and "TakeOrdered" not in many and "SinglePartition" not in many


def test_hot_keys_are_split(spark, tmp_path):
    """A third of the rows in one product and one order: joins on either are split, even before a group by order."""
    n = 60_000
    rows = spark.range(n).selectExpr(
        "if(id % 3 = 0, 1, id) AS order_id",
        "cast('2019-01-01 00:00:00' AS timestamp_ntz) + make_dt_interval(0, 0, cast(id % 1000 AS int)) AS order_ts",
        "if(id % 3 = 1, 7, id % 5000) AS product_id",
        "cast(id % 9 + 1 AS int) AS quantity",
        "id % 4000 AS customer_id",
    )
    heads = spark.range(n).selectExpr("id AS order_id", "'x' AS channel")
    products = spark.range(5000).selectExpr(
        "id AS product_id", "concat('p', id) AS product_name", "cast(1.5 AS decimal(10,2)) AS price",
        "id % 10 AS supplier_id", "'s' AS supplier_name", "id % 3 AS store_id", "'t' AS store_name",
    )
    customers = spark.range(4000).selectExpr("id AS customer_id", "'c' AS customer_name", "'Male' AS gender")
    for name, df in {"rows": rows, "heads": heads, "products": products, "customers": customers}.items():
        df.repartition(8).write.parquet(str(tmp_path / name))
    rows, heads, products, customers = (
        spark.read.parquet(str(tmp_path / t)) for t in ("rows", "heads", "products", "customers")
    )
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "20",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40KB",
    }
    before = {k: spark.conf.get(k, None) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        good, _ = enrich.enrich(rows, products, customers)
        assert good.count() == n
        executed = good.select("order_id", "sales_revenue", "gender")
        executed.collect()
        assert "skew=true" in plan(executed)
        last = dedupe.keep_last(rows.join(heads, "order_id"), ["order_id"], ["order_ts"])
        assert len(last.collect()) == rows.select("order_id").distinct().count()
        assert "skew=true" in plan(last)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)

import datetime

import pytest
from compare import TESTDATA
from pyspark.sql import functions as F

from tillstar.operators import cleaning, enrich, loads, normalise, quality
from tillstar.plans import reports
from tillstar.plans.star import SourceStar
from tillstar.schema import PRICE, RAW_TRANSACTIONS
from tillstar.sources import files
from tillstar.streaming import transactions as stream


def masters(spark):
    products = spark.createDataFrame(
        [(1, "Lamp", 10.5, 3, "Glow", 7, "North"), (2, "Desk", 99.0, 4, "Wood", 8, "South")],
        "product_id bigint, product_name string, price double, supplier_id bigint, supplier_name string, "
        "store_id bigint, store_name string",
    ).withColumn("price", F.col("price").cast(PRICE))
    customers = spark.createDataFrame(
        [(1, "Ann", "Female"), (2, "Bob", None)], "customer_id bigint, customer_name string, gender string"
    )
    return products, customers


RAW = [
    ("1", "2019-01-05 10:00:00", "1", "2", "1", "77"),
    ("1", "2019-01-05 11:00:00", "2", "1", "1", "78"),  # same order, later
    ("2", "2019-02-04 09:30:00", "2", "3", "2", "79"),
    ("3", "2019-02-04 09:30:00", "9", "1", "1", "80"),  # unknown product
    ("4", "2019-02-04 09:30:00", "1", "1", "8", "81"),  # unknown customer
    ("5", "2019-13-04 09:30:00", "1", "1", "1", "82"),  # month 13
    ("6", "2019-02-04 09:30:00", "1", "two", "1", "83"),  # no number
    ("7", "2019-02-04 09:30:00", "9", "1", "9", "84"),  # both unknown
]


def raw(spark):
    return spark.createDataFrame(RAW, RAW_TRANSACTIONS)


def good(spark):
    return cleaning.split_rejects(cleaning.clean_transactions(raw(spark)))[0]


def enriched(spark):
    return enrich.enrich(good(spark), *masters(spark))


def test_both_ways_to_a_star_agree(spark, tmp_path):
    rows, _ = enriched(spark)
    for grain in ("line", "order"):
        star = normalise.to_star(rows, grain)
        loads.load_transactions(good(spark), *masters(spark), str(tmp_path / grain), grain, check=False)
        written = loads.read_warehouse(spark, str(tmp_path / grain))
        for name, df in star.items():
            got = getattr(written, name)
            assert sorted(map(str, got.select(df.columns).collect())) == sorted(map(str, df.collect())), (grain, name)


def test_enrich_and_rejects(spark):
    rows, rejects = enriched(spark)
    assert sorted((r.order_id, r.product_id, str(r.sales_revenue)) for r in rows.collect()) == [
        (1, 1, "21.00"), (1, 2, "99.00"), (2, 2, "297.00"),
    ]
    assert {r.order_id: r.reject_reason for r in rejects.collect()} == {
        3: "unknown product", 4: "unknown customer", 7: "unknown product and customer",
    }


def test_order_grain_and_report(spark, tmp_path):
    root = str(tmp_path / "dw")
    assert loads.load_transactions(good(spark), *masters(spark), root, "order") == 1
    star = loads.read_warehouse(spark, root)
    assert sorted((r.order_id, r.product_id, r.time_id) for r in star.sales.collect()) == [(1, 2, 1), (2, 2, 2)]
    dates = {r.time_id: r for r in star.date.collect()}
    assert dates[2].date_t == datetime.date(2019, 2, 4) and dates[2].time_t == "09:30:00"
    top = [tuple(r)[:3] for r in reports.top_products(star, 2019).collect()]
    assert top == [(1, "Weekend", 2), (2, "Weekday", 2)]
    assert sorted(r.product_id for r in star.product.collect()) == [2]  # only what the sales use
    assert sorted(r.supplier_id for r in star.supplier.collect()) == [4]
    assert loads.load_transactions(good(spark), *masters(spark), root, "order") == 2  # full rebuild


def test_reports_agree_with_and_without_dates_on_the_fact(spark, tmp_path):
    rows, _ = enriched(spark)
    root = str(tmp_path / "dw")
    loads.load_warehouse(normalise.to_star(rows, "order"), root)
    star = loads.read_warehouse(spark, root)
    bare = loads.LoadedStar(
        star.sales.drop("order_ts", "year_t"), star.date, star.product, star.customer, star.store, star.supplier
    )
    for report in (reports.top_products, reports.store_growth, reports.yearly_rollup, reports.half_year_split):
        assert report(star, year=2019).collect() == report(bare, year=2019).collect()
    for report in (reports.monthly_volatility, reports.sales_spikes, reports.store_quarterly_sales,
                   reports.supplier_contribution, reports.seasonal_sales):
        assert report(star).collect() == report(bare).collect()


def test_refused_load_leaves_the_previous_run(spark, tmp_path):
    rows, _ = enriched(spark)
    root = str(tmp_path / "dw")
    loads.load_warehouse(normalise.to_star(rows, "order"), root)
    with pytest.raises(quality.ConstraintError) as e:
        # two lines of one order break the key
        loads.load_transactions(good(spark), *masters(spark), root, "line", sales_key=["order_id"])
    assert e.value.report == {"sales.key": 1}
    assert loads.read_warehouse(spark, root).sales.count() == 2
    star = normalise.to_star(rows, "order")
    star["supplier"] = star["supplier"].filter("supplier_id = 0")
    with pytest.raises(quality.ConstraintError) as e:
        loads.load_warehouse(star, root)
    assert e.value.report == {"sales.supplier_id": 1}


def test_no_commit_no_warehouse(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        loads.read_warehouse(spark, str(tmp_path / "none"))


def test_staging(spark, tmp_path):
    _, customers = masters(spark)
    path = str(tmp_path / "staging")
    with pytest.raises(quality.ConstraintError):
        loads.load_staging(customers.union(customers), path, ["customer_id"], ["customer_id"])
    loads.load_staging(customers, path, ["customer_id"], ["customer_id"])
    assert spark.read.parquet(path).count() == 2
    with pytest.raises(Exception):
        loads.load_staging(customers, path, ["customer_id"], ["customer_id"])


def test_insert_ignore(spark):
    old = spark.createDataFrame([(1, "a")], "k int, v string")
    new = spark.createDataFrame([(1, "x"), (2, "c"), (2, "b")], "k int, v string")
    assert sorted(map(tuple, loads.insert_ignore(old, new, ["k"]).collect())) == [(1, "a"), (2, "b")]


def test_normalise_conflicting_names(spark):
    products, _ = masters(spark)
    twin = products.withColumn("supplier_name", F.lit("Aaa")).filter("product_id = 1")
    dims = normalise.split_master(products.unionByName(twin))
    assert {r.supplier_id: r.supplier_name for r in dims["supplier"].collect()} == {3: "Aaa", 4: "Wood"}


# -- streaming ---------------------------------------------------------------------------------------------------------------


def write_files(folder, groups):
    folder.mkdir(exist_ok=True)
    for name, rows in groups.items():
        lines = ["order_id,order_date,product_id,quantity,customer_id,time_id", *[",".join(r) for r in rows]]
        (folder / name).write_text("\n".join(lines) + "\n")


def run_stream(spark, tmp_path):
    source = files.stream_transactions(spark, str(tmp_path / "in"))
    q = stream.start(source, lambda: masters(spark), str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination()


def test_stream_equals_batch_and_resumes(spark, tmp_path):
    write_files(tmp_path / "in", {"a.csv": RAW[:3], "b.csv": RAW[3:6]})
    run_stream(spark, tmp_path)
    write_files(tmp_path / "in", {"c.csv": RAW[6:]})
    run_stream(spark, tmp_path)  # picks up the new file only
    out = str(tmp_path / "out")
    cols = ["order_id", "product_id", "quantity", "sales_revenue", "store_id"]
    batch = files.read_transactions(spark, str(tmp_path / "in"))
    want = stream.process(batch, *masters(spark))
    got = stream.accepted(spark, out)
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(
        map(tuple, want.filter("reject_reason IS NULL").select(cols).collect())
    )
    assert sorted(r.reject_reason for r in stream.rejects(spark, out).collect()) == sorted(
        r.reject_reason for r in want.filter("reject_reason IS NOT NULL").collect()
    )
    assert sorted(r.reject_reason for r in stream.rejects(spark, out).collect()) == [
        "bad order_date", "bad quantity", "unknown customer", "unknown product", "unknown product and customer",
    ]
    assert got.select("batch_id").distinct().count() >= 1
    assert sorted((r.order_id, r.product_id) for r in stream.latest_orders(spark, out).collect()) == [(1, 2), (2, 2)]


def test_rerun_of_a_batch_changes_nothing(spark, tmp_path):
    rows = stream.process(raw(spark), *masters(spark)).withColumn("matched", F.col("reject_reason").isNull().cast("string"))
    out = str(tmp_path / "out")
    loads.write_batch(rows, out, 0, ["matched"])
    loads.write_batch(rows.filter("order_id = 2"), out, 1, ["matched"])
    before = sorted(map(str, loads.read_batches(spark, out).collect()))
    loads.write_batch(rows, out, 0, ["matched"])
    assert sorted(map(str, loads.read_batches(spark, out).collect())) == before


def test_stream_into_the_warehouse(spark, tmp_path):
    write_files(tmp_path / "in", {"a.csv": RAW[:2], "b.csv": RAW[2:]})
    run_stream(spark, tmp_path)
    root = str(tmp_path / "dw")
    assert stream.load(spark, [str(tmp_path / "out")], root, "order") == 1
    batch = str(tmp_path / "batch")
    loads.load_transactions(good(spark), *masters(spark), batch, "order")
    for table in ("sales", "product", "customer", "store", "supplier", "date"):
        one, two = (getattr(loads.read_warehouse(spark, r), table) for r in (root, batch))
        assert sorted(map(str, one.collect())) == sorted(map(str, two.collect())), table


def test_names_in_any_case(spark):
    sales = spark.createDataFrame(
        [(1, 1, 1, 1, 1, 1, 1, 10.0), (2, 2, 1, 2, 2, 2, 1, 5.0)],
        "order_id bigint, product_id bigint, customer_id bigint, supplier_id bigint, time_id bigint, store_id bigint, "
        "quantity int, sales_revenue double",
    ).withColumn("sales_revenue", F.col("sales_revenue").cast("decimal(15,2)"))

    def names(kind, *values):
        return spark.createDataFrame(list(enumerate(values, 1)), f"{kind}_id bigint, {kind}_name string")

    star = loads.LoadedStar(
        sales, spark.createDataFrame([], "time_id bigint, date_t date"), names("product", "Lamp", "LAMP"),
        names("customer", "x"), names("store", "North", "north"), names("supplier", "Glow", "Glow"),
    )
    exact = reports.supplier_contribution(star).collect()
    folded = reports.supplier_contribution(star.any_case()).collect()
    assert len(exact) == 2
    assert [(r.store_name, r.supplier_name, r.product_name, float(r.total_sales)) for r in folded] == [
        ("North", "Glow", "LAMP", 15.0)
    ]


def test_replay_of_rejects(spark, tmp_path):
    write_files(tmp_path / "in", {"a.csv": RAW})
    run_stream(spark, tmp_path)
    out, again = str(tmp_path / "out"), str(tmp_path / "again")
    products, customers = masters(spark)
    late = products.filter("product_id = 1").withColumn("product_id", F.lit(9).cast("bigint"))

    def grown():
        return products.unionByName(late), customers

    for _ in range(2):  # a second replay replaces the first
        stream.replay(spark, out, grown, again)
        assert sorted(r.order_id for r in stream.accepted(spark, again).collect()) == [3]
        assert sorted(r.reject_reason for r in stream.rejects(spark, again).collect()) == [
            "bad order_date", "bad quantity", "unknown customer", "unknown customer",
        ]
    assert sorted(r.order_id for r in stream.latest_orders(spark, out, again).collect()) == [1, 2, 3]
    root = str(tmp_path / "dw")
    assert stream.load(spark, [out, again], root, "line", sales_key=()) == 1
    assert loads.read_warehouse(spark, root).sales.count() == 4


def test_only_rejects_keep_their_text(spark):
    rows = stream.process(raw(spark), *masters(spark)).collect()
    assert all((r.raw is None) == (r.reject_reason is None) for r in rows)


def test_loaded_star_reports_like_its_source(spark, tmp_path):
    """All ten reports over a written warehouse equal those over the source tables it was filled from."""
    source = SourceStar.read(spark, f"{TESTDATA}/sf0.001")
    columns = ["order_id", "product_id", "customer_id", "supplier_id", "store_id", "quantity", "sales_revenue", "order_ts"]
    sales = source.fact(columns).withColumns({"time_id": F.col("order_id"), "year_t": F.year("order_ts")})
    star = {
        "sales": sales,
        "date": normalise.dates_of(sales),
        "product": source.product,
        "customer": source.customer.withColumn("gender", F.lit(None).cast("string")),
        "store": source.store,
        "supplier": source.supplier,
    }
    loads.load_warehouse(star, str(tmp_path / "dw"), sales_key=())
    written = loads.read_warehouse(spark, str(tmp_path / "dw"))
    for report, params in [
        (reports.top_products, {"year": 1997}), (reports.store_growth, {"year": 1997}),
        (reports.supplier_contribution, {}), (reports.seasonal_sales, {}), (reports.monthly_volatility, {}),
        (reports.product_affinity, {"k": 20}), (reports.yearly_rollup, {"year": 1997, "with_level": True}),
        (reports.half_year_split, {}), (reports.half_year_split, {"year": 1998}), (reports.sales_spikes, {"factor": 3}),
        (reports.store_quarterly_sales, {}), (reports.store_quarterly_sales, {"year": 1999}),
    ]:
        one, two = report(source, **params), report(written, **params)
        assert one.columns == two.columns
        assert sorted(map(tuple, one.collect()), key=str) == sorted(map(tuple, two.collect()), key=str), report


def test_ties_do_not_depend_on_partitioning(spark):
    products = spark.createDataFrame([(i, f"p{i}") for i in range(6)], "product_id bigint, product_name string")
    rows = [(o, o % 6, 1, 1, o, 1, 1, datetime.datetime(2019, 1, 7), 2019) for o in range(60)]
    sales = spark.createDataFrame(
        rows, "order_id bigint, product_id bigint, customer_id bigint, supplier_id bigint, time_id bigint, "
        "store_id bigint, quantity int, order_ts timestamp_ntz, year_t int",
    ).withColumn("sales_revenue", F.lit("3.00").cast("decimal(15,2)"))
    for n in (1, 7):
        star = loads.LoadedStar(sales.repartition(n), None, products, None, None, None)
        assert [r.product_id for r in reports.top_products(star, 2019, 3).collect()] == [0, 1, 2]


def test_the_same_function_runs_inside_a_stream(spark, tmp_path):
    write_files(tmp_path / "in", {"a.csv": RAW[:4], "b.csv": RAW[4:]})
    source = files.stream_transactions(spark, str(tmp_path / "in"))
    out = stream.process(source, *masters(spark))
    assert out.isStreaming
    query = (
        out.writeStream.format("parquet").option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    want = stream.process(files.read_transactions(spark, str(tmp_path / "in")), *masters(spark))
    got = spark.read.parquet(str(tmp_path / "out")).select(want.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))

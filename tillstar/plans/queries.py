"""Named queries over the driver's tables: one per report and operator. Each takes (spark, folder)."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstar.functions import dates as D
from tillstar.functions import json as J
from tillstar.functions import numeric as N
from tillstar.functions import text as X
from tillstar.operators import cleaning, dedupe, documents, enrich, loads, normalise, quality, ranks, schemas, tables
from tillstar.operators.dates import date_dimension
from tillstar.operators.dedupe import keep_last
from tillstar.operators.normalise import to_star
from tillstar.plans import reports
from tillstar.plans.star import SourceStar
from tillstar.schema import PRICE, PRIMARY_KEYS, RAW_TRANSACTIONS
from tillstar.session import cleaned, configure, materialised, remove, scratch_path
from tillstar.sources import files
from tillstar.sources.tables import read_table
from tillstar.streaming import transactions as stream

YEAR = 1997
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles and dates as text, so that any client compares the values alike."""

    def cast(f: T.StructField):
        if isinstance(f.dataType, T.DecimalType):
            return F.col(f.name).cast("double").alias(f.name)
        if isinstance(f.dataType, (T.DateType, T.TimestampNTZType, T.TimestampType)):
            return F.col(f.name).cast("string").alias(f.name)
        return F.col(f.name)

    return df.select(*[cast(f) for f in df.schema.fields])


def query(name: str):
    def register(fn: Query) -> Query:
        QUERIES[name] = lambda spark, folder: plain(fn(configure(spark), folder))
        return fn

    return register


def report(name: str, fn, **params) -> None:
    QUERIES[name] = lambda spark, folder: plain(fn(SourceStar.read(configure(spark), folder), **params))


report("r1_top_products", reports.top_products, year=YEAR, k=5)
report("r2_store_growth", reports.store_growth, year=YEAR)
report("r3_supplier_contribution", reports.supplier_contribution)
report("r4_seasonal_sales", reports.seasonal_sales)



@query("r4_seasonal_sales_any_case")
def r4_any_case(spark, folder):
    """Product names spelled in two ways, reported as one."""
    star = SourceStar.read(spark, folder)
    mixed = F.when(F.col("p_size") > 25, F.upper("p_name")).otherwise(F.col("p_name"))
    tables_ = {n: star.tables[n] for n in ("lineitem", "orders", "customer", "nation", "supplier", "part")}
    tables_["part"] = tables_["part"].withColumn("p_name", mixed)
    return reports.seasonal_sales(SourceStar(tables_).any_case())


report("r5_monthly_volatility", reports.monthly_volatility)
report("r6_product_affinity", reports.product_affinity, k=5)
report("r7_yearly_rollup", reports.yearly_rollup, year=YEAR)
report("r7_yearly_rollup_levels", reports.yearly_rollup, year=YEAR, with_level=True)
report("r8_half_year_split", reports.half_year_split)
report("r8_half_year_split_one_year", reports.half_year_split, year=YEAR)
report("r9_sales_spikes", reports.sales_spikes, factor=2)


report("r10_store_quarterly_one_year", reports.store_quarterly_sales, year=YEAR)


@query("r10_store_quarterly")
def r10(spark, folder):
    view = reports.store_quarterly_sales(SourceStar.read(spark, folder))
    return reports.create_view(view, "store_quarterly_sales").orderBy("store_name", "quarter")


# -- master data and transactions out of the driver's tables ------------------------------------------------------------


def product_master(star: SourceStar) -> DataFrame:
    """The denormalised product master: each product with one of its suppliers, and that supplier's nation as store."""
    supplied = dedupe.keep_one(star.lines().select("product_id", "supplier_id"), ["product_id"])
    at = star.tables["supplier"].select(F.col("s_suppkey").alias("supplier_id"), F.col("s_nationkey").alias("store_id"))
    return (
        star.product.join(supplied, "product_id").join(star.supplier, "supplier_id").join(at, "supplier_id")
        .join(star.store, "store_id")
        .select("product_id", "product_name", "price", "supplier_id", "supplier_name", "store_id", "store_name")
    )


def staged_products(star: SourceStar) -> DataFrame:
    """The product master as a staged table."""
    return materialised(product_master(star), "staging")


def transactions(star: SourceStar) -> DataFrame:
    return star.fact(["order_id", "order_ts", "product_id", "quantity", "customer_id"])


def customer_master(star: SourceStar) -> DataFrame:
    return star.customer.select("customer_id", "customer_name", F.col("segment").alias("gender"))


def checked_customers(star: SourceStar) -> DataFrame:
    """Customers whose segments, which stand in for the checked column, are mapped into its domain."""
    return customer_master(star).withColumn("gender", F.when(F.col("gender") == "BUILDING", "Male").otherwise("Female"))


def as_text(rows: DataFrame) -> DataFrame:
    """Transactions as the text fields of a CSV file."""
    return rows.select(
        F.col("order_id").cast("string").alias("order_id"),
        F.substring(F.col("order_ts").cast("string"), 1, 19).alias("order_date"),
        F.col("product_id").cast("string").alias("product_id"),
        F.col("quantity").cast("string").alias("quantity"),
        F.col("customer_id").cast("string").alias("customer_id"),
        F.col("order_id").cast("string").alias("time_id"),
    )


def raw_transactions(star: SourceStar) -> DataFrame:
    return as_text(transactions(star))


ENRICHED = ["order_id", "product_id", "customer_id", "supplier_id", "store_id", "quantity", "sales_revenue"]


@query("j1_enrich")
def j1(spark, folder):
    star = SourceStar.read(spark, folder)
    rows, _ = enrich.enrich(transactions(star), staged_products(star), customer_master(star))
    return rows.select(*ENRICHED, F.to_date("order_ts").alias("date_t"))


def _partial_masters(star: SourceStar) -> tuple[DataFrame, DataFrame]:
    """Masters that lack some rows: large parts and one customer segment are unknown."""
    small = star.tables["part"].filter("p_size <= 40")
    return SourceStar({"part": small}).product, star.customer.filter("segment <> 'BUILDING'")


@query("j3_rejects")
def j3(spark, folder):
    star = SourceStar.read(spark, folder)
    _, rejects = enrich.enrich(transactions(star), *_partial_masters(star))
    return rejects.select("order_id", "product_id", "customer_id", "quantity", cleaning.REASON)


@query("j3_matched")
def j3_matched(spark, folder):
    star = SourceStar.read(spark, folder)
    rows, _ = enrich.enrich(transactions(star), *_partial_masters(star))
    return rows.select("order_id", "product_id", "customer_id", "quantity", "sales_revenue")


@query("g1_keep_last")
def g1(spark, folder):
    lines = read_table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"
    )
    return dedupe.keep_last(lines, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey"])


@query("g2_dimension")
def g2(spark, folder):
    star = SourceStar.read(spark, folder)
    supplied = star.lines().select("product_id", "supplier_id").distinct().join(star.supplier, "supplier_id")
    return dedupe.keep_one(supplied, ["product_id"], ["supplier_name", "supplier_id"])


@query("p5_date_dim")
def p5(spark, folder):
    return date_dimension(SourceStar.read(spark, folder).orders(["order_ts"]))


@query("p5_event_dates")
def p5_events(spark, folder):
    return date_dimension(read_table(spark, folder, "events"), "event_id", "ts")


def _master_part(name):
    def run(spark, folder):
        return normalise.split_master(product_master(SourceStar.read(spark, folder)))[name]

    return run


for _name in ("product", "supplier", "store"):
    query(f"p12_normalise_{_name}")(_master_part(_name))


# -- cleaning -------------------------------------------------------------------------------------------------------------


def _raw_products(spark, folder) -> DataFrame:
    """The product master as dirty text: padded names, currency signs, negative and missing prices, bad ids."""
    star = SourceStar.read(spark, folder)
    kind = star.tables["part"].select(F.col("p_partkey").alias("product_id"), "p_type", "p_brand")
    price = F.concat(F.col("price").cast("string"), F.lit("$"))
    return product_master(star).join(kind, "product_id").select(
        F.when(F.col("p_brand") == "Brand#3", F.concat(F.lit("P"), "product_id"))
        .otherwise(F.concat(F.lit(" "), "product_id")).alias("product_id"),
        F.concat(F.lit("  "), "product_name", F.lit(" ")).alias("product_name"),
        F.when(F.col("p_brand") == "Brand#7", F.concat(F.lit("-"), price))
        .when(F.col("p_brand") == "Brand#9", F.lit("n/a"))
        .otherwise(price).alias("price"),
        F.col("supplier_id").cast("string").alias("supplier_id"),
        F.when(F.col("p_type") == "ECONOMY", F.concat("supplier_name", F.lit(", Inc."))).otherwise(
            F.col("supplier_name")
        ).alias("supplier_name"),
        F.col("store_id").cast("string").alias("store_id"),
        "store_name",
    )


@query("s2_clean_products")
def s2(spark, folder):
    return cleaning.clean_products(_raw_products(spark, folder)).drop("raw")


@query("s1_clean_customers")
def s1(spark, folder):
    raw = read_table(spark, folder, "customer").select(
        F.concat(F.lit(" "), "c_custkey", F.lit(" ")).alias("customer_id"),
        F.concat(F.col("c_name"), F.lit("  ")).alias("customer_name"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit(" ")).otherwise(F.col("c_mktsegment")).alias("gender"),
    )
    return cleaning.clean_customers(raw).drop("raw")


@query("s3_clean_transactions")
def s3(spark, folder):
    star = SourceStar.read(spark, folder)
    status = star.tables["orders"].select(F.col("o_orderkey").cast("string").alias("order_id"), "o_orderstatus")
    raw = raw_transactions(star).join(status, "order_id").withColumn(
        "order_date",
        F.when(F.col("o_orderstatus") == "P", F.lit("0000-00-00 00:00:00"))
        .when(F.col("o_orderstatus") == "F", F.regexp_replace("order_date", "-0[1-9]-", "-13-"))
        .otherwise(F.col("order_date")),
    ).withColumn("quantity", F.when(F.col("quantity") == "7", F.lit("seven")).otherwise(F.col("quantity")))
    return cleaning.clean_transactions(raw.drop("o_orderstatus")).drop("raw")


@query("p3_field_repair")
def p3(spark, folder):
    raw = _raw_products(spark, folder)
    names = raw.columns
    line = raw.select(F.concat_ws(",", *names).alias("line"))
    fixed = cleaning.repair_fields("line", len(names), names.index("supplier_name"))
    return line.select(fixed.alias("f")).select(*[F.get("f", F.lit(i)).alias(n) for i, n in enumerate(names)])


@query("p14_zero_dates")
def p14(spark, folder):
    text = F.when(F.col("o_orderstatus") == "P", F.lit("0000-00-00 00:00:00")).otherwise(
        F.substring(F.col("o_orderdate").cast("string"), 1, 19)
    )
    return read_table(spark, folder, "orders").select("o_orderkey", text.alias("t")).select(
        "o_orderkey",
        F.to_date(cleaning.timestamp("t", zero_date="null")).alias("as_null"),
        F.to_date(cleaning.timestamp("t", zero_date="round")).alias("as_first_day"),
    )


@query("s6_bulk_load")
def s6(spark, folder):
    """Bulk-load a file, some of whose lines are malformed, twice into a table and read the table."""
    loaded, _ = _bulk_loaded(spark, folder)
    return loaded.select("order_id", "order_date", "product_id", "quantity", "customer_id")


@query("s6_bulk_load_rejects")
def s6_rejects(spark, folder):
    """The malformed lines of that load."""
    _, lines = _bulk_loaded(spark, folder)
    return lines.select("line")


def _bulk_loaded(spark, folder):
    source, table = _malformed_lines(spark, folder), scratch_path(spark, "bulk")
    for _ in range(2):
        loaded = files.load_file(spark, source, RAW_TRANSACTIONS, table, header="false")
    return loaded, files.rejected_lines(spark, RAW_TRANSACTIONS, table)


def _malformed_lines(spark, folder) -> str:
    """A text file of transactions in which some lines have a field too many and some too few."""
    star = SourceStar.read(spark, folder)
    raw = raw_transactions(star).select(*RAW_TRANSACTIONS.fieldNames())
    line = F.concat_ws(",", *raw.columns)
    broken = (
        F.when(F.col("quantity") == "7", F.concat(line, F.lit(",extra")))
        .when(F.col("quantity") == "8", F.concat_ws(",", "order_id", "order_date"))
        .otherwise(line)
    )
    base = scratch_path(spark, "malformed")
    raw.select(broken.alias("value")).write.text(base)
    return base


@query("s7_malformed_rows")
def s7(spark, folder):
    read = files.read_csv(spark, _malformed_lines(spark, folder), RAW_TRANSACTIONS, header="false")
    _, bad = cleaning.split_rejects(cleaning.clean_transactions(read))
    return bad.select(F.get_json_object("raw", "$._corrupt_record").alias("line"), cleaning.REASON)


@query("o1_staging")
def o1(spark, folder):
    """Load the cleaned product master into staging and read it back."""
    usable, _ = cleaning.split_rejects(cleaning.clean_products(_raw_products(spark, folder)))
    path = scratch_path(spark, "staging")
    loads.load_staging(usable, path, ["product_id"])
    return loads.read_staging(spark, path)


# -- constraints ----------------------------------------------------------------------------------------------------------


@query("k1_unique")
def k1(spark, folder):
    return quality.unique(read_table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("k2_not_null")
def k2(spark, folder):
    orders = read_table(spark, folder, "orders").select(
        "o_orderkey",
        F.nullif("o_orderstatus", F.lit("P")).alias("status"),
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"),
    )
    return quality.row_violations(orders, quality.not_null(["o_orderkey", "status", "priority"]), ["o_orderkey"])


@query("k3_check")
def k3(spark, folder):
    rows = read_table(spark, folder, "customer").select(
        "c_custkey", F.nullif("c_mktsegment", F.lit("HOUSEHOLD")).alias("segment")
    )
    rule = quality.check("segment", F.col("segment").isin("BUILDING", "MACHINERY"))
    return quality.row_violations(rows, rule, ["c_custkey", "segment"])


@query("k4_foreign_key")
def k4(spark, folder):
    parts = read_table(spark, folder, "part").filter("p_size <= 40")
    return quality.foreign_key(read_table(spark, folder, "lineitem"), parts, "l_partkey", "p_partkey")


@query("k5_bounds")
def k5(spark, folder):
    rules = quality.text_length({"o_orderpriority": 6}) | quality.decimal_range({"o_totalprice": (7, 2)})
    return quality.row_violations(read_table(spark, folder, "orders"), rules, ["o_orderkey"])


@query("k6_conflicts")
def k6(spark, folder):
    return quality.conflicts(read_table(spark, folder, "lineitem"), ["l_partkey"], ["l_suppkey"])


# -- loads and streams ------------------------------------------------------------------------------------------------------


@query("o2_loaded_top_products")
def o2(spark, folder):
    star = SourceStar.read(spark, folder)
    customers = checked_customers(star)
    root = scratch_path(spark, "warehouse")
    loads.load_transactions(
        transactions(star), staged_products(star), customers, root, "order", ("order_ts", "product_id", "quantity")
    )
    return reports.top_products(loads.read_warehouse(spark, root), YEAR, 5)


@query("o2_load_rejects")
def o2_rejects(spark, folder):
    """A load whose masters miss some products and customers: every transaction is a sale or a reject with its reason."""
    star = SourceStar.read(spark, folder)
    customers = checked_customers(star).filter("customer_id % 7 <> 0")
    products = materialised(staged_products(star).filter("product_id % 5 <> 0"), "staging")
    root = scratch_path(spark, "warehouse")
    loads.load_transactions(transactions(star), products, customers, root)
    columns = ["order_id", "product_id", "customer_id", "quantity"]
    sales = loads.read_warehouse(spark, root).sales.select(*columns, F.lit("sale").alias("outcome"))
    return sales.unionByName(loads.read_rejects(spark, root).select(*columns, F.col(cleaning.REASON).alias("outcome")))


@query("o3_insert_ignore")
def o3(spark, folder):
    parts = read_table(spark, folder, "part").select("p_partkey", "p_name", "p_size")
    new = parts.withColumn("p_name", F.upper("p_name"))
    return loads.insert_ignore(parts.filter("p_size <= 25"), new, ["p_partkey"])


FILES, FILES_PER_BATCH = 24, 6
STATE_BATCHES = 4


def _streamed(spark, folder, masters=None) -> tuple[SourceStar, str]:
    """Write the transactions as CSV files, stream them through the enrichment and return the output path.

    Lines are dealt to files at random, so that an order's lines arrive in several micro-batches. ``masters`` changes
    the masters (products, customers) that the stream sees. The files are deleted when the stream has read them all.
    """
    star = SourceStar.read(spark, folder)
    base = scratch_path(spark, "stream")
    rows = transactions(star)
    dealt = rows.repartition(FILES, F.xxhash64(*rows.columns))  # texts would be shuffled at about twice the bytes
    with cleaned(spark):
        as_text(dealt).select(*RAW_TRANSACTIONS.fieldNames()).write.option("header", True).csv(f"{base}/in")
    paths = scratch_path(spark, "masters")
    product_master(star).write.parquet(f"{paths}/product")
    checked_customers(star).write.parquet(f"{paths}/customer")

    def read_masters():
        found = spark.read.parquet(f"{paths}/product"), spark.read.parquet(f"{paths}/customer")
        return masters(*found) if masters else found

    source = files.stream_transactions(spark, f"{base}/in", files_per_batch=FILES_PER_BATCH)
    stream.start(source, read_masters, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    remove(spark, f"{base}/in")
    return star, f"{base}/out"


def _batches(spark, out) -> list[int]:
    found = sorted(r[0] for r in stream.accepted(spark, out).select("batch_id").distinct().collect())
    if len(found) < 3:
        raise AssertionError(f"the stream ran in batches {found}; these queries need at least three")
    return found


@query("m1_stream_enrich")
def m1(spark, folder):
    _, out = _streamed(spark, folder)
    return stream.accepted(spark, out).select(*ENRICHED, F.to_date("order_ts").alias("date_t"))


def _shown_sales(star):
    return star.sales.select("order_id", "product_id", "customer_id", "supplier_id", "store_id", "quantity", "sales_revenue",
                             F.to_date("order_ts").alias("date_t"))


@query("o6_incremental")
def o6(spark, folder):
    """The stream's batches loaded one by one, each load adding only what the ones before have not."""
    _, out = _streamed(spark, folder)
    root = scratch_path(spark, "warehouse")
    for batch in _batches(spark, out):
        stream.load_new(spark, out, root, upto=batch)
    return _shown_sales(loads.read_warehouse(spark, root))


@query("o6_dimensions")
def o6_dimensions(spark, folder):
    """Rows and distinct keys of every table after loading batch by batch: no key comes twice, none is missing."""
    _, out = _streamed(spark, folder)
    root = scratch_path(spark, "warehouse")
    for batch in _batches(spark, out):
        stream.load_new(spark, out, root, upto=batch)
    star = loads.read_warehouse(spark, root)
    counts = [
        getattr(star, name).select(F.lit(name).alias("table_name"), F.col(PRIMARY_KEYS[name][0]).alias("id"))
        for name in loads.DIMENSIONS
    ]
    return reduce(DataFrame.unionByName, counts).groupBy("table_name").agg(
        F.count("*").alias("n_rows"), F.countDistinct("id").alias("n_keys"), F.sum("id").alias("sum_ids"))


@query("o6_replayed")
def o6_replayed(spark, folder):
    """Masters that come late: the stream's output and the replay of its rejects are two sources of one warehouse."""
    _, out = _streamed(spark, folder, lambda p, c: (p.filter("product_id % 5 <> 0"), c.filter("customer_id % 7 <> 0")))
    masters = SourceStar.read(spark, folder)
    root, again = scratch_path(spark, "warehouse"), f"{out}-replayed"
    first, *rest = _batches(spark, out)
    stream.load_new(spark, out, root, upto=first)
    late = materialised(product_master(masters), "masters"), materialised(checked_customers(masters), "masters")
    stream.replay(spark, out, lambda: late, again)
    stream.load_new(spark, again, root)  # a second source, whose only batch has a number that the first source has too
    for batch in rest:
        stream.load_new(spark, out, root, upto=batch)
    for path in (out, again):
        stream.load_new(spark, path, root)  # nothing is left
    return _shown_sales(loads.read_warehouse(spark, root))


@query("o6_compacted")
def o6_compacted(spark, folder):
    """Increments rewritten as one run, and an increment that finds nothing new."""
    _, out = _streamed(spark, folder)
    root = scratch_path(spark, "warehouse")
    first, second, *_ = _batches(spark, out)
    stream.load_new(spark, out, root, upto=first)
    stream.load_new(spark, out, root, upto=second)
    stream.load(spark, [out], root, "line", sales_key=())
    stream.load_new(spark, out, root)
    return _shown_sales(loads.read_warehouse(spark, root))


@query("o6_refused")
def o6_refused(spark, folder):
    """An increment that repeats stored lines is refused whole; the warehouse stays as it was."""
    star = SourceStar.read(spark, folder)
    rows = materialised(transactions(star).join(staged_products(star), "product_id").join(
        checked_customers(star), "customer_id").withColumn("sales_revenue", F.col("quantity") * F.col("price")), "rows")
    # two loads read them, for six tables each
    orders = materialised(keep_last(rows, ["order_id"], ("order_ts", "product_id", "quantity")), "orders")
    root = scratch_path(spark, "warehouse")
    loads.load_warehouse(to_star(orders.filter("order_id % 3 <> 0")), root)
    try:
        loads.load_increment(to_star(orders.filter("order_id % 3 <> 1")), root, ("order_id",))
    except quality.ConstraintError as e:
        refused = e.report
    star = loads.read_warehouse(spark, root)
    return star.sales.groupBy((F.col("order_id") % 3).alias("third")).agg(F.count("*").alias("n_sales")).withColumn(
        "n_repeated", F.lit(refused["sales.key_there"]).cast("bigint"))


@query("m3_latest_orders")
def m3(spark, folder):
    _, out = _streamed(spark, folder)
    rows = stream.latest_orders(spark, out, sequence=("order_ts", "product_id", "quantity"))
    return rows.select("order_id", "product_id", "quantity", "sales_revenue")


@query("m3_latest_orders_state")
def m3_state(spark, folder):
    """The same from streaming state, filled by several batches whose orders overwrite each other."""
    _, out = _streamed(spark, folder)
    checkpoint = f"{out}-state"
    _batches(spark, out)
    files_per_batch = stream.share_of_files(spark, out, STATE_BATCHES)
    stream.follow(spark, out, f"{out}-changes", checkpoint, ("order_ts", "product_id", "quantity"),
                  files_per_batch).awaitTermination()
    return stream.state_of(spark, checkpoint).select("order_id", "product_id", "quantity", "sales_revenue")


# -- table statements ---------------------------------------------------------------------------------------------------------


@query("c1_select")
def c1(spark, folder):
    return tables.select(
        read_table(spark, folder, "lineitem"),
        "count(*) AS n_lines",
        "max(l_extendedprice) AS max_price",
        where="l_quantity > 10",
        group_by=["l_partkey", "l_returnflag"],
        having="n_lines > 1",
        order_by=[F.desc("n_lines"), F.col("l_partkey"), F.col("l_returnflag")],
        limit=100,
        offset=10,
    )


@query("c2_insert")
def c2(spark, folder):
    parts = read_table(spark, folder, "part").select("p_partkey", "p_name", "p_size", "p_retailprice")
    copies = parts.filter("p_size > 45").select((-F.col("p_partkey") - 1).alias("k"), F.upper("p_name").alias("n"))
    grown = tables.insert(parts, ["p_partkey", "p_name"], copies)
    return tables.insert(
        grown,
        ["p_partkey", "p_size", "p_retailprice"],
        [(-1_000_000_001, 3, 9.5), (-1_000_000_002, F.lit(40) + 2, F.round(F.lit(10.0) / 4, 2))],
    )


@query("c3_update")
def c3(spark, folder):
    return tables.update(
        read_table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice"),
        {"o_orderstatus": "X", "o_totalprice": F.col("o_totalprice") + 1},
        where="o_orderstatus = 'P'",
        order_by=[F.desc("o_totalprice")],
        limit=100,
        keys=["o_orderkey"],
    )


@query("c3_update_all")
def c3_all(spark, folder):
    return tables.update(
        read_table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice"),
        {"o_orderpriority": F.concat_ws("/", "o_orderstatus", "o_orderpriority"), "o_orderstatus": "Z"},
        where=F.col("o_totalprice") > 100000,
    )


@query("c4_delete")
def c4(spark, folder):
    return tables.delete(
        read_table(spark, folder, "orders").select("o_orderkey", "o_orderpriority"),
        where="nullif(o_orderpriority, '5-LOW') <> '1-URGENT'",
    )


@query("c4_delete_limit")
def c4_limit(spark, folder):
    return tables.delete(
        read_table(spark, folder, "orders").select("o_orderkey", "o_totalprice"),
        where="o_orderstatus = 'F'",
        order_by=["o_totalprice"],
        limit=250,
        keys=["o_orderkey"],
    )


@query("t4_offset")
def t4(spark, folder):
    return tables.select(
        read_table(spark, folder, "part"),
        "p_partkey",
        "p_retailprice",
        order_by=[F.desc("p_retailprice")],
        offset=300,
        keys=["p_partkey"],
    )


@query("t4_deep_page")
def t4_deep(spark, folder):
    """A page from the middle of a large ordering, found through numbered ranges."""
    lines = read_table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice")
    order = [F.desc("l_extendedprice"), "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    return ranks.between(lines, order, 2500, 4000)


@query("a6_row_count")
def a6(spark, folder):
    return tables.row_count(read_table(spark, folder, "lineitem"))


# -- documents ----------------------------------------------------------------------------------------------------------------


def event_documents(spark, folder, where: str = "true") -> DataFrame:
    events = read_table(spark, folder, "events").filter(where)
    k = F.get_json_object("props", "$.k").cast("int")
    body = F.struct(
        "event_type", "value", F.struct(k.alias("k")).alias("props"), F.array(F.col("user_id"), k).alias("tags")
    )
    return events.select(F.col("event_id").cast("string").alias("_id"), F.to_json(body).alias("doc"))


def shown(docs: DataFrame, *extra) -> DataFrame:
    """The members of event documents as columns; arrays and objects as text."""
    return documents.fields(
        docs,
        _id=F.col("_id"),
        event_type="$.event_type",
        value=("$.value", "double"),
        k=("$.props.k", "int"),
        tags="$.tags",
        **dict(extra),
    )


CLICK = "get_json_object(doc, '$.event_type') = 'click'"


@query("x1_add")
def x1(spark, folder):
    events = read_table(spark, folder, "events")
    new = events.filter("event_type = 'error'").select(
        F.to_json(F.struct("event_type", "user_id")).alias("doc"), F.col("event_id").alias("n")
    )
    kept = event_documents(spark, folder, "event_type <> 'error'")
    fresh = new.select(documents.generated_id(F.col("doc"), F.col("n")).alias("_id"), "doc")
    return shown(documents.add(kept, fresh), ("user_id", "$.user_id"))


@query("x1_duplicate_ids")
def x1_duplicates(spark, folder):
    docs = event_documents(spark, folder)
    return documents.duplicate_ids(documents.add(docs, event_documents(spark, folder, "event_type = 'view'")))


def _upsert_sides(spark, folder):
    """All events: signups are only new, views on both sides, everything else only old."""
    old = event_documents(spark, folder, "event_type <> 'signup'")
    new = read_table(spark, folder, "events").filter("event_type IN ('view', 'signup')").select(
        F.col("event_id").cast("string").alias("_id"),
        F.to_json(F.struct(F.upper("event_type").alias("event_type"), "value")).alias("doc"),
    )
    return old, new


@query("x2_upsert")
def x2(spark, folder):
    return shown(documents.upsert(*_upsert_sides(spark, folder)))


@query("x2_upsert_effect")
def x2_effect(spark, folder):
    return documents.upsert_effect(*_upsert_sides(spark, folder))


@query("x3_replace")
def x3(spark, folder):
    return shown(documents.replace_matching(*_upsert_sides(spark, folder)))


@query("x4_remove_one")
def x4(spark, folder):
    return shown(documents.remove_one(event_documents(spark, folder), "7"))


@query("x4_get_one")
def x4_get(spark, folder):
    return shown(documents.get_one(event_documents(spark, folder), "7"))


@query("x5_find")
def x5(spark, folder):
    docs = event_documents(spark, folder)
    k, value = documents.field("$.props.k", "int"), documents.field("$.value", "double")
    return shown(documents.find(docs, (k >= 50) & (value > 100)))


@query("x6_fields")
def x6(spark, folder):
    return documents.fields(
        event_documents(spark, folder),
        id=F.col("_id"),
        kind="$.event_type",
        first_tag=("$.tags[0]", "bigint"),
        doubled=documents.field("$.props.k", "int") * 2,
    )


@query("x6_project")
def x6_project(spark, folder):
    docs = documents.project_document(
        event_documents(spark, folder),
        q=F.lit(1) + 1,
        g2=documents.field("$.props.k", "int") * -20,
        gone=documents.field("$.missing"),
    )
    return docs.select("_id", "doc")


@query("x7_find_grouped")
def x7(spark, folder):
    kind, k = documents.field("$.event_type"), documents.field("$.props.k", "int")
    return documents.find(
        event_documents(spark, folder),
        documents.field("$.value", "double") > 5,
        group_by=[kind.alias("event_type"), (k % 10).alias("bucket")],
        columns=["count(*) AS n", F.sum(k).alias("sum_k")],
        having="n > 1",
        order_by=["event_type", "bucket"],
        limit=40,
        offset=2,
    )


@query("x8_set")
def x8(spark, folder):
    docs = documents.modify(
        event_documents(spark, folder),
        CLICK,
        documents.set_("$.props.k", -1),
        documents.set_("$.props.extra", "new"),
        documents.set_("$.flag", True),
        documents.set_("$.nowhere.deep", 1),
        documents.set_("$.tags[0]", 5),
        documents.set_("$.whole", {"x": 1}),
        documents.set_("$.whole[0]", "cell"),  # cell 0 of what is no array is the value itself
        documents.set_("$.whole[1]", "no cell"),
    )
    return shown(docs, ("extra", "$.props.extra"), ("flag", "$.flag"), ("nowhere", "$.nowhere"), ("whole", "$.whole"))


@query("x9_change")
def x9(spark, folder):
    docs = documents.modify(
        event_documents(spark, folder), CLICK, documents.change("$.event_type", "tap"), documents.change("$.absent", 1)
    )
    return shown(docs, ("absent", "$.absent"))


@query("x10_unset")
def x10(spark, folder):
    docs = documents.modify(
        event_documents(spark, folder), CLICK, documents.unset("$.value", "$.props.k", "$.tags[0]", "$.absent")
    )
    return shown(docs)


@query("x11_array_append")
def x11(spark, folder):
    return shown(documents.modify(event_documents(spark, folder), CLICK, documents.array_append("$.tags", "64")))


@query("x12_array_insert")
def x12(spark, folder):
    docs = documents.modify(
        event_documents(spark, folder),
        CLICK,
        documents.array_insert("$.tags[1]", 43),
        documents.array_insert("$.tags[9]", 44),
    )
    return shown(docs)


@query("x13_patch")
def x13(spark, folder):
    docs = documents.modify(
        event_documents(spark, folder),
        CLICK,
        documents.patch({"value": None, "props": {"j": 7}, "added": {"deep": {"x": 1}}}),
    )
    return shown(docs, ("j", "$.props.j"), ("x", "$.added.deep.x"))


@query("x14_modify_limit")
def x14(spark, folder):
    docs = documents.modify(
        event_documents(spark, folder),
        CLICK,
        documents.set_("$.event_type", "top"),
        order_by=[documents.field("$.value", "double").desc()],
        limit=50,
    )
    return shown(docs)


@query("x15_remove")
def x15(spark, folder):
    return shown(documents.remove(event_documents(spark, folder), documents.field("$.props.k", "int") < 30))


@query("x15_remove_limit")
def x15_limit(spark, folder):
    docs = event_documents(spark, folder)
    return shown(documents.remove(docs, CLICK, [documents.field("$.value", "double")], 75))


@query("x16_as_table")
def x16(spark, folder):
    docs = documents.from_table(read_table(spark, folder, "customer"), "c_custkey")
    return documents.as_table(docs, "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_mktsegment STRING")


@query("x17_validate")
def x17(spark, folder):
    docs = documents.modify(
        event_documents(spark, folder),
        CLICK,
        documents.unset("$.props"),
        documents.set_("$.value", "text"),
    )
    return documents.validate(
        docs, ["event_type", "props"], {"value": "number", "tags": "array", "props": "object", "event_type": "string"}
    ).select("rule", "_id")


EVENT_SCHEMA = """{
"$schema": "http://json-schema.org/draft-06/schema#", "type": "object", "required": ["event_type", "tags", "flag"],
"properties": {
  "event_type": {"type": "string", "enum": ["click", "view", "purchase", "signup"], "minLength": 5, "pattern": "^[a-z]+$"},
  "value": {"type": "number", "minimum": 1, "exclusiveMaximum": 200.5},
  "props": {"type": "object", "properties": {"k": {"type": "integer", "maximum": 80, "multipleOf": 2}}, "additionalProperties": false},
  "tags": {"type": "array", "minItems": 2, "items": {"type": "integer", "minimum": 4}, "uniqueItems": true},
  "flag": {"type": "boolean"}},
"anyOf": [{"properties": {"event_type": {"const": "view"}}}, {"properties": {"value": {"maximum": 100}}}]}"""


@query("x17_schema")
def x17_schema(spark, folder):
    """Events against a schema document with nested members, cells, ranges, enumerations, patterns and alternatives."""
    docs = documents.modify(event_documents(spark, folder), "get_json_object(doc, '$.event_type') <> 'signup'",
                            documents.set_("$.flag", True))
    docs = documents.modify(docs, CLICK, documents.set_("$.props.extra", 1))
    return schemas.violations(docs, EVENT_SCHEMA, keep=["_id"])


@query("e6_contains")
def e6(spark, folder):
    v = J.parsed("doc")
    return event_documents(spark, folder).select(
        "_id",
        J.contains(F.try_variant_get(v, "$.tags", "variant"), 42).alias("tag_42"),
        J.contains(v, {"event_type": "click", "props": {"k": 7}}).alias("click_7"),
    )


@query("e7_overlaps")
def e7(spark, folder):
    v = J.parsed("doc")
    return event_documents(spark, folder).select(
        "_id",
        J.overlaps(F.try_variant_get(v, "$.tags", "variant"), J.literal([1, 2, 3, 50])).alias("shares_tag"),
        J.overlaps(F.try_variant_get(v, "$.props", "variant"), J.literal({"k": 5, "z": 0})).alias("shares_member"),
    )


@query("e11_wildcards")
def e11(spark, folder):
    v = J.parsed("doc")
    return event_documents(spark, folder).select(
        "_id",
        F.get(J.find_all(v, "$.tags[*]"), F.lit(1)).cast("bigint").alias("second_tag"),
        F.get(J.find_all(v, "$.props.*"), F.lit(0)).cast("bigint").alias("first_member"),
        F.get(J.find_all(v, "$**.k"), F.lit(0)).cast("bigint").alias("any_k"),
        F.size(J.find_all(v, "$.*")).alias("n_members"),
    )


@query("e11_deep_wildcards")
def e11_deep(spark, folder):
    """A member eight levels down, below objects and arrays."""
    doc = F.concat(F.lit('{"a":[{"b":{"c":[[{"d":{"k":'), F.col("event_id"), F.lit('}}]]}},{"k":'), F.col("user_id"), F.lit("}]}"))
    found = J.find_all(J.parsed(doc), "$**.k")
    return read_table(spark, folder, "events").select(
        "event_id", F.array_join(F.array_sort(F.transform(found, lambda x: x.cast("bigint"))), ",").alias("found"))


# -- expressions ----------------------------------------------------------------------------------------------------------------


@query("e1_arithmetic")
def e1(spark, folder):
    k = F.get_json_object("props", "$.k").cast("int")
    return read_table(spark, folder, "events").select(
        "event_id",
        N.divide(F.col("user_id").cast("double"), (k - 50).cast("double")).alias("ratio"),
        N.modulo(F.col("user_id"), (k - 50).cast("bigint")).alias("rest"),
        N.int_divide(F.col("user_id"), (k - 50).cast("bigint")).alias("whole"),
    )


@query("e3_logic")
def e3(spark, folder):
    status, price = F.nullif("o_orderstatus", F.lit("P")), F.col("o_totalprice")
    return read_table(spark, folder, "orders").select(
        "o_orderkey",
        ((status == "F") & (price > 100000)).alias("both"),
        X.any_of(status == "F", price > 400000, F.col("o_orderpriority") == "1-URGENT").alias("any"),
        (~(status == "O")).alias("not_open"),
        status.isNull().alias("unknown"),
        (status != "F").alias("differs"),
        ((price >= 1000) & (price <= 200000)).alias("in_range"),
    )


@query("e4_bits")
def e4(spark, folder):
    a, b = F.col("event_id"), F.col("user_id")
    return read_table(spark, folder, "events").select(
        "event_id",
        N.bit_and(a, b).cast("string").alias("both"),
        N.bit_or(a, b).cast("string").alias("either"),
        N.bit_xor(a, b).cast("string").alias("one"),
        N.bit_not(a).cast("string").alias("inverse"),
        N.shift_left(a, 3).cast("string").alias("left3"),
        N.shift_right(F.bitwise_not(a), 2).cast("string").alias("right2"),
    )


@query("e5_matching")
def e5(spark, folder):
    return read_table(spark, folder, "part").select(
        "p_partkey",
        X.like_any_case("p_name", "%RING").alias("is_ring"),
        X.regexp_any_case("p_name", "^RED|bolt$").alias("red_or_bolt"),
        X.equal_any_case("p_type", F.lit("economy")).alias("is_economy"),
        F.col("p_size").between(10, 20).alias("mid_size"),
        F.col("p_brand").isin("Brand#1", "Brand#2").alias("first_brands"),
    )


@query("e8_intervals")
def e8(spark, folder):
    d = F.col("o_orderdate")
    return read_table(spark, folder, "orders").select(
        "o_orderkey",
        D.add_interval(d, 1, "MONTH").alias("next_month"),
        D.add_interval(d, 1, "QUARTER", -1).alias("last_quarter"),
        D.add_interval(d, "1-2", "YEAR_MONTH").alias("year_month"),
        D.add_interval(d, 2, "WEEK").alias("fortnight"),
        D.add_interval(d, "1:30", "MINUTE_SECOND").alias("soon"),
        D.add_interval(d, "1 02:03:04", "DAY_SECOND", -1).alias("before"),
        D.add_interval(d, 1500000, "MICROSECOND").alias("micro"),
    )


@query("e9_casts")
def e9(spark, folder):
    name = F.col("p_name")
    return read_table(spark, folder, "part").select(
        "p_partkey",
        N.cast_signed(F.substring("p_brand", 7, 3)).alias("brand_number"),
        N.cast_signed(name).alias("not_a_number"),
        N.cast_unsigned(-F.col("p_size").cast("bigint")).cast("string").alias("wrapped"),
        N.cast_decimal(F.col("p_retailprice").cast("string"), 8, 1).alias("price_1"),
        N.cast_char(name, 4).alias("name_4"),
    )


@query("e9_casts_other")
def e9_other(spark, folder):
    """Casts to bytes, dates, times and documents; every seventh text is none of them."""
    rows = read_table(spark, folder, "events").withColumn(
        "text", F.when(F.col("event_id") % 7 == 0, "no value").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")))
    clock = F.when(F.col("event_id") % 7 == 0, "no value").otherwise(F.date_format("ts", "HH:mm:ss"))
    doc = F.when(F.col("event_id") % 7 == 0, "{").otherwise(F.col("props"))
    return rows.select(
        "event_id",
        F.hex(N.cast_binary("event_type")).alias("bytes"),
        N.cast_date("text").cast("string").alias("as_date"),
        F.date_format(N.cast_datetime("text"), "yyyy-MM-dd HH:mm:ss").alias("as_datetime"),
        N.cast_time(clock).alias("as_time"),
        F.try_variant_get(N.cast_json(doc), "$.k", "int").alias("k"),
    )


@query("f_week_codes")
def f_week_codes(spark, folder):
    """Codes that Spark has no pattern for: weeks from Sunday and from Monday, their years, and days with a suffix."""
    days = read_table(spark, folder, "orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    return days.select(F.col("day").cast("string").alias("day"), *[
        D.date_format("day", f"%{code}").alias(name) for code, name in (
            ("U", "week_sunday"), ("u", "week_monday"), ("V", "week_sunday_full"), ("X", "year_sunday"),
            ("v", "week_iso"), ("x", "year_iso"), ("w", "weekday"), ("D", "day_suffix"))])


@query("e12_json_path")
def e12(spark, folder):
    return read_table(spark, folder, "events").select(
        "event_id", F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.get_json_object("props", "$.none").alias("none"),
    )


@query("e14_parameters")
def e14(spark, folder):
    orders = read_table(spark, folder, "orders")
    return spark.sql(
        "SELECT o_orderkey, o_totalprice FROM {orders} WHERE o_orderstatus = :status AND o_totalprice > :floor",
        args={"status": "F", "floor": 200000.0},
        orders=orders,
    )


@query("fn_same_numeric")
def fn_same_numeric(spark, folder):
    """Functions that mean the same in Spark under the same name."""
    part = read_table(spark, folder, "part").selectExpr("p_partkey", "p_size", "p_size / 51.0D AS x")
    real = "acos asin atan cos cot degrees exp log10 radians sin sqrt tan".split()
    return part.selectExpr(
        "p_partkey",
        *[f"round({f}(x), 9) AS {f}_x" for f in real],
        "round(atan2(x, 2), 9) AS atan2_x",
        "round(pow(x, 3), 9) AS pow_x",
        "round(power(x, 0.5D), 9) AS power_x",
        "round(x * pi(), 9) AS pi_x",
        "abs(p_size - 25) AS abs_size",
        "ceiling(x * 10) AS ceiling_x",
        "floor(x * 10) AS floor_x",
        "mod(p_size, 7) AS mod_size",
    )


@query("fn_same_string")
def fn_same_string(spark, folder):
    return read_table(spark, folder, "part").selectExpr(
        "p_partkey",
        "ascii(p_name) AS f_ascii",
        "bin(p_size) AS f_bin",
        "bit_length(p_name) AS f_bit_length",
        "char(p_size + 64) AS f_char",
        "char_length(p_name) AS f_char_length",
        "character_length(p_type) AS f_character_length",
        "concat(p_name, '/', p_type) AS f_concat",
        "concat_ws('-', p_name, nullif(p_type, 'PROMO'), p_brand) AS f_concat_ws",
        "find_in_set(p_type, 'PROMO,ECONOMY,STANDARD') AS f_find_in_set",
        "hex(p_size) AS f_hex",
        "instr(p_name, 'o') AS f_instr",
        "lcase(p_type) AS f_lcase",
        "left(p_name, 3) AS f_left",
        "locate('e', p_name) AS f_locate",
        "lower(p_brand) AS f_lower",
        "ltrim(concat('  ', p_name)) AS f_ltrim",
        "octet_length(p_name) AS f_octet_length",
        "position('l' IN p_name) AS f_position",
        "repeat(p_type, 2) AS f_repeat",
        "replace(p_name, 'e', 'E') AS f_replace",
        "reverse(p_name) AS f_reverse",
        "right(p_name, 3) AS f_right",
        "rpad(p_name, 14, '.') AS f_rpad",
        "rtrim(concat(p_name, '  ')) AS f_rtrim",
        "concat('[', space(3), ']') AS f_space",
        "substring(p_name, 2, 4) AS f_substring",
        "trim(concat(' ', p_name, ' ')) AS f_trim",
        "ucase(p_name) AS f_ucase",
        "upper(p_name) AS f_upper",
    )


@query("fn_same_date")
def fn_same_date(spark, folder):
    return read_table(spark, folder, "events").selectExpr(
        "event_id",
        "dayofmonth(ts) AS f_dayofmonth",
        "dayofweek(ts) AS f_dayofweek",
        "dayofyear(ts) AS f_dayofyear",
        "hour(ts) AS f_hour",
        "minute(ts) AS f_minute",
        "month(ts) AS f_month",
        "quarter(ts) AS f_quarter",
        "second(ts) AS f_second",
        "weekday(ts) AS f_weekday",
        "year(ts) AS f_year",
        "curdate() = current_date AND now() = current_timestamp AS f_now",
    )


@query("fn_numeric")
def fn_numeric(spark, folder):
    p = F.col("p_retailprice").cast(PRICE)
    return read_table(spark, folder, "part").select(
        "p_partkey",
        N.truncate(p, 1).alias("cut_1"),
        N.truncate(-p, 0).alias("cut_0"),
        F.round(N.log(F.col("p_size") - 10), 6).alias("log_size"),
        F.round(N.sqrt(F.col("p_size") - 10), 6).alias("root"),
        F.round(N.acos((F.col("p_size") - 10) / 20), 6).alias("arc"),
        F.bit_count("p_partkey").cast("int").alias("ones"),
        F.conv(F.col("p_size").cast("string"), 10, 16).alias("hex_size"),
    )


@query("fn_string")
def fn_string(spark, folder):
    n = F.col("p_name")
    return read_table(spark, folder, "part").select(
        "p_partkey",
        X.byte_length(n).alias("n_bytes"),
        X.mid(n, 2, 3).alias("middle"),
        X.insert(n, 3, 2, F.lit("##")).alias("patched"),
        X.elt(F.col("p_size"), F.lit("one"), F.lit("two"), F.lit("three")).alias("word"),
        X.field("p_type", F.lit("PROMO"), F.lit("ECONOMY")).alias("spot"),
        X.octal("p_size").alias("oct_size"),
        X.char_code(n).alias("code"),
        X.strcmp(n, F.lit("m")).alias("cmp"),
        X.quote(F.concat(n, F.lit("'s"))).alias("quoted"),
        X.make_set(F.col("p_size"), F.lit("a"), F.lit("b"), F.lit("c")).alias("flags"),
        X.export_set(F.col("p_size"), "Y", "N", "", 4).alias("low_bits"),
        F.substring_index(n, " ", 1).alias("first_word"),
        F.lpad(n, 14, "*").alias("padded"),
    )


@query("fn_date")
def fn_date(spark, folder):
    d = F.col("o_orderdate")
    period = F.date_format(d, "yyyyMM").cast("int")
    return read_table(spark, folder, "orders").select(
        "o_orderkey",
        D.day_name(d).alias("day_name"),
        D.month_name(d).alias("month_name"),
        D.week(d).alias("week"),
        D.period_add(period, 5).alias("later_period"),
        D.period_diff(period, F.lit(199501)).alias("periods"),
        D.to_days(d).alias("day_number"),
        D.from_days(D.to_days(d) + 1).alias("next_day"),
        D.sec_to_time(F.col("o_orderkey")).alias("as_time"),
        D.date_format(d, "%W %d.%m.%Y, day %j, %% %y").alias("formatted"),
    )


@query("fn_time")
def fn_time(spark, folder):
    return read_table(spark, folder, "events").select(
        "event_id",
        D.time_to_sec("ts").alias("seconds"),
        D.date_format("ts", "%H:%i:%s").alias("clock"),
        F.hour("ts").alias("hour"),
        F.dayofyear("ts").alias("day_of_year"),
    )


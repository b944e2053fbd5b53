"""The ten reports. Each takes a ``Star`` and parameters and returns a DataFrame.

The fact is summed by ids before prices and names are joined, so the joins see groups instead of lines and a product with
a third of all lines is combined on the map side. Several ids may carry one name; named groups are summed once more.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillstar.functions.numeric import percent_change
from tillstar.operators.affinity import top_pairs
from tillstar.operators.dates import sale_type
from tillstar.operators.joins import few
from tillstar.plans.star import Star
from tillstar.schema import TOTAL

DEFAULT_YEAR = 2019


def top_products(star: Star, year: int = DEFAULT_YEAR, k: int = 5) -> DataFrame:
    """The k products of highest revenue per month and weekday/weekend. Ties go to the lower product id."""
    totals = star.totals(["month_t", "weekend", "product_id"], year).withColumn("sale_type", sale_type())
    best_first = Window.partitionBy("month_t", "sale_type").orderBy(F.desc("total_revenue"), "product_id")
    return (
        totals.withColumn("rank", F.row_number().over(best_first))
        .filter(F.col("rank") <= k)
        .orderBy("month_t", "sale_type", "rank")
        .select("month_t", "sale_type", "product_id", "product_name", "total_revenue")
    )


def store_growth(star: Star, year: int = DEFAULT_YEAR) -> DataFrame:
    """Revenue of each store per quarter and its growth over the store's previous quarter with sales."""
    totals = star.totals(["store_id", "quarter_t"], year)
    earlier = Window.partitionBy("store_id").orderBy("quarter_t")
    return (
        totals.withColumn("prev_quarter_revenue", F.lag("total_revenue").over(earlier))
        .join(star.store, "store_id")
        .withColumn("growth_rate", percent_change("total_revenue", "prev_quarter_revenue"))
        .select("store_id", "store_name", "quarter_t", "total_revenue", "prev_quarter_revenue", "growth_rate")
        .orderBy("store_id", "quarter_t")
    )


def supplier_contribution(star: Star) -> DataFrame:
    """Revenue by store, supplier and product name."""
    names = ("store_name", "supplier_name", "product_name")
    totals = star.named_totals(names)
    return totals.select(*names, F.col("total_revenue").alias("total_sales")).orderBy(*names)


def seasonal_sales(star: Star) -> DataFrame:
    """Revenue by product name and season."""
    keys = ("product_name", "season")
    totals = star.totals(["product_id", "season"])
    return totals.groupBy(*keys).agg(F.sum("total_revenue").cast(TOTAL).alias("total_sales")).orderBy(*keys)


def monthly_volatility(star: Star) -> DataFrame:
    """Change of revenue from month to month per store and supplier name; each year starts anew."""
    keys = ("store_name", "supplier_name", "year_t", "month_t")
    earlier = Window.partitionBy("store_name", "supplier_name", "year_t").orderBy("month_t")
    return (
        star.named_totals(keys)
        .drop("total_quantity")
        .withColumn("prev_month_revenue", F.lag("total_revenue").over(earlier))
        .withColumn("revenue_volatility", percent_change("total_revenue", "prev_month_revenue"))
        .orderBy(*keys)
    )


def product_affinity(star: Star, k: int = 5, wide_basket: int = 200) -> DataFrame:
    """The k product pairs most often bought in one order. Ties go to the lower product ids."""
    pairs = top_pairs(star.fact(["order_id", "product_id"]), "order_id", "product_id", k, wide_basket)
    names = star.product.select("product_id", "product_name")
    # At most k pairs look up their names, so the pairs are broadcast and the product table stays in place.
    half = names.toDF("item_1", "product_name_1").join(few(pairs, k), "item_1")
    return (
        names.toDF("item_2", "product_name_2").join(few(half, k), "item_2")
        .orderBy(F.desc("pair_count"), "item_1", "item_2")
        .limit(k)
        .select("product_name_1", "product_name_2", "pair_count")
    )


def yearly_rollup(star: Star, year: int = DEFAULT_YEAR, with_level: bool = False) -> DataFrame:
    """Revenue rolled up over store, supplier, product and year.

    ``with_level`` adds ``level`` = grouping id, which tells a subtotal's NULL from a missing name.
    """
    names = ("store_name", "supplier_name", "product_name")
    # Each level is summed from the one below. The year is one value, so the two finest levels have the same rows; the
    # finished groups are shuffled once, and Spark reuses that exchange for every level.
    detail = star.named_totals(names, year).select(*names, "total_revenue", F.lit(year).alias("year_t"), F.lit(0).alias("level"))
    levels, below = [detail, detail.withColumns({"year_t": F.lit(None).cast("int"), "level": F.lit(1)})], detail
    for kept, level in ((2, 3), (1, 7), (0, 15)):
        below = below.groupBy(*names[:kept]).agg(F.sum("total_revenue").cast(TOTAL).alias("total_revenue"))
        coarse = below if kept else below.filter(F.col("total_revenue").isNotNull())  # no rows: no total either
        missing = [F.lit(None).cast("string").alias(n) for n in names[kept:]]
        levels.append(coarse.select(*names[:kept], *missing, "total_revenue", F.lit(None).cast("int").alias("year_t"),
                                    F.lit(level).alias("level")))
    rolled = reduce(DataFrame.unionByName, levels)
    columns = [*names, "total_revenue", "year_t"] + (["level"] if with_level else [])
    return rolled.select(*columns).orderBy(*names)


def half_year_split(star: Star, year: int | None = None) -> DataFrame:
    """Revenue and quantity of each product in the first and second half of the year(s), with totals."""
    totals = star.totals(["product_id", "half_of_year"], year)

    def part(half: int, measure: str):
        return F.sum(F.when(F.col("half_of_year") == half, F.col(measure)).otherwise(F.lit(0)))

    return (
        totals.groupBy("product_id", "product_name")
        .agg(
            part(1, "total_revenue").cast(TOTAL).alias("H1_revenue"),
            part(1, "total_quantity").alias("H1_quantity"),
            part(2, "total_revenue").cast(TOTAL).alias("H2_revenue"),
            part(2, "total_quantity").alias("H2_quantity"),
            F.sum("total_revenue").cast(TOTAL).alias("total_revenue"),
            F.sum("total_quantity").alias("total_quantity"),
        )
        .orderBy("product_name", "product_id")
    )


def sales_spikes(star: Star, factor: int = 2) -> DataFrame:
    """Days on which a product sold for more than ``factor`` times its average over its days with sales."""
    daily = star.totals(["product_id", "date_t"]).withColumnRenamed("total_revenue", "daily_sales")
    # One window over the daily sums (at most one row per product and calendar day) replaces the average and the
    # join back to the days.
    average = F.avg("daily_sales").over(Window.partitionBy("product_id"))
    return (
        daily.withColumn("avg_daily_sales", average)
        .withColumn(
            "sales_status",
            F.when(F.col("daily_sales") > F.lit(factor) * F.col("avg_daily_sales"), "Outlier").otherwise("Normal"),
        )
        .filter(F.col("sales_status") == "Outlier")
        .select("product_id", "product_name", "date_t", "daily_sales", "avg_daily_sales", "sales_status")
        .orderBy("product_id", "date_t")
    )


def store_quarterly_sales(star: Star, year: int | None = None) -> DataFrame:
    """Revenue per store and quarter number; all years together unless one is named."""
    totals = star.totals(["store_id", "quarter_t"], year)
    return totals.join(star.store, "store_id").select(
        "store_id",
        "store_name",
        F.col("quarter_t").alias("quarter"),
        F.col("total_revenue").alias("total_quarterly_sales"),
    ).orderBy("store_name", "quarter")


def create_view(df: DataFrame, name: str) -> DataFrame:
    """Register ``df`` as a session view and return a scan of it. Readers order the rows themselves."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)

"""The star as the reports see it: dimensions, and a fact that is asked for exactly the columns it must carry.

Two implementations share the reports:

* ``LoadedStar`` reads a warehouse written by ``tillstar.operators.loads``.
* ``SourceStar`` maps the source tables onto the star on the fly and joins only the tables whose columns are asked
  for. The joins it leaves out cannot change a result as long as the foreign-key checks are clean.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from copy import copy
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.operators.dates import PARTS, add_date_parts, in_year
from tillstar.operators.dedupe import one_spelling
from tillstar.schema import PRICE, REVENUE, TOTAL
from tillstar.sources.tables import Folder


NAMES = {"product_name": "product", "store_name": "store", "supplier_name": "supplier"}


class Star:
    product: DataFrame
    customer: DataFrame
    store: DataFrame
    supplier: DataFrame

    def fact(self, columns: Sequence[str], year: int | None = None) -> DataFrame:
        """The sales lines with the given columns, optionally of one year."""
        raise NotImplementedError

    def totals(self, by: Sequence[str], year: int | None = None) -> DataFrame:
        """``by`` + ``total_revenue`` + ``total_quantity``, plus ``product_name`` when grouped by product id."""
        raise NotImplementedError

    def named_totals(self, by: Sequence[str], year: int | None = None) -> DataFrame:
        """``totals`` where ``by`` has names: summed by ids first, so that the names join groups and not lines.

        Several ids may carry one name, so the named groups are summed once more.
        """
        ids = self._ids([f"{NAMES[c]}_id" if c in NAMES else c for c in by])
        out = self.totals(ids, year)
        for name, table in NAMES.items():
            if name in by and name not in out.columns:
                out = out.join(getattr(self, table).select(f"{table}_id", name), f"{table}_id")
        return out.groupBy(*by).agg(
            F.sum("total_revenue").cast(TOTAL).alias("total_revenue"), F.sum("total_quantity").alias("total_quantity"))

    def _ids(self, ids: list[str]) -> list[str]:
        """The columns by which ``named_totals`` sums first."""
        return ids

    def any_case(self) -> "Star":
        """The same star with names that differ only in case made equal, for reports that group by names."""
        other = copy(self)
        for name, table in NAMES.items():
            setattr(other, table, one_spelling(getattr(self, table), name))
        return other

    def _sums(self, by: Sequence[str], year: int | None) -> DataFrame:
        return (
            self.fact([*by, "sales_revenue", "quantity"], year)
            .groupBy(*by)
            .agg(
                F.sum("sales_revenue").cast(TOTAL).alias("total_revenue"),
                F.sum("quantity").alias("total_quantity"),
            )
        )


class LoadedStar(Star):
    """A written warehouse: six tables; the sales may carry ``order_ts`` and be partitioned by ``year_t``."""

    def __init__(self, sales, date, product, customer, store, supplier):
        self.sales, self.date = sales, date
        self.product, self.customer, self.store, self.supplier = product, customer, store, supplier

    def fact(self, columns, year=None):
        sales = self.sales
        if year is not None and "year_t" in sales.columns:
            sales = sales.filter(F.col("year_t") == year)  # the partition column of the written fact
            year = None
        parts = [c for c in columns if c in PARTS]
        if "order_ts" in sales.columns:
            sales = sales.withColumn("date_t", F.to_date("order_ts"))
        if (parts or "date_t" in columns or year is not None) and "date_t" not in sales.columns:
            dates = self.date.select("time_id", "date_t")
            sales = sales.join(dates if year is None else dates.filter(in_year("date_t", year)), "time_id")
        elif year is not None:
            sales = sales.filter(in_year("date_t", year))
        if parts:
            sales = add_date_parts(sales, "date_t", parts)
        for name, table in NAMES.items():
            if name in columns:
                key = f"{table}_id"
                sales = sales.join(getattr(self, table).select(key, name), key)
        return sales.select(*columns)

    def totals(self, by, year=None):
        out = self._sums(by, year)
        if "product_id" in by:
            out = out.join(self.product.select("product_id", "product_name"), "product_id")
        return out


class SourceStar(Star):
    """The star over ``part customer supplier nation orders lineitem`` tables."""

    def __init__(self, tables: Mapping[str, DataFrame]):
        self.tables = tables

    @classmethod
    def read(cls, spark: SparkSession, folder: str) -> "SourceStar":
        return cls(Folder(spark, folder))

    @cached_property
    def product(self) -> DataFrame:
        return self.tables["part"].select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_retailprice").cast(PRICE).alias("price"),
        )

    @cached_property
    def customer(self) -> DataFrame:
        return self.tables["customer"].select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("customer_name"),
            F.col("c_mktsegment").alias("segment"),
        )

    @cached_property
    def store(self) -> DataFrame:
        return self.tables["nation"].select(
            F.col("n_nationkey").alias("store_id"), F.col("n_name").alias("store_name")
        )

    @cached_property
    def supplier(self) -> DataFrame:
        return self.tables["supplier"].select(
            F.col("s_suppkey").alias("supplier_id"), F.col("s_name").alias("supplier_name")
        )

    def orders(self, columns: Sequence[str], year: int | None = None) -> DataFrame:
        """Order heads: ``order_id`` + the asked-for part of ``customer_id store_id store_name order_ts date_t``."""
        heads = self.tables["orders"].select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").alias("order_ts"),
            F.to_date("o_orderdate").alias("date_t"),
        )
        if year is not None:
            heads = heads.filter(in_year("date_t", year))
        if "store_id" in columns or "store_name" in columns:
            at = self.tables["customer"].select(
                F.col("c_custkey").alias("customer_id"), F.col("c_nationkey").alias("store_id")
            )
            if "store_name" in columns:
                at = at.join(self.store, "store_id")
            heads = heads.join(at, "customer_id")
        return heads.select("order_id", *columns)

    def lines(self) -> DataFrame:
        return self.tables["lineitem"].select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_orderkey").alias("time_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("supplier_id"),
            F.col("l_quantity").cast("int").alias("quantity"),
        )

    def fact(self, columns, year=None):
        parts = [c for c in columns if c in PARTS]
        heads = [c for c in ("customer_id", "store_id", "store_name", "order_ts") if c in columns]
        if parts or "date_t" in columns:
            heads.append("date_t")
        lines = self.lines()
        if heads or year is not None:
            lines = lines.join(self.orders(heads, year), "order_id")
        if "sales_revenue" in columns or "product_name" in columns:
            lines = lines.join(self.product, "product_id").withColumn(
                "sales_revenue", (F.col("quantity") * F.col("price")).cast(REVENUE)
            )
        if "supplier_name" in columns:
            lines = lines.join(self.supplier, "supplier_id")
        if parts:
            lines = add_date_parts(lines, "date_t", parts)
        return lines.select(*columns)

    def _ids(self, ids):
        # lines have quantities; the price is the product's, so it joins groups of one product
        return ids if "product_id" in ids else [*ids, "product_id"]

    def totals(self, by, year=None):
        if "product_id" not in by:
            return self._sums(by, year)
        # The price depends on the product alone, so quantities are summed first and priced afterwards: the product
        # join sees one row per group, and a product that holds a third of all lines is combined on the map side.
        amounts = self.fact([*by, "quantity"], year).groupBy(*by).agg(F.sum("quantity").alias("total_quantity"))
        return amounts.join(self.product, "product_id").select(
            *by,
            "product_name",
            (F.col("total_quantity") * F.col("price")).cast(TOTAL).alias("total_revenue"),
            "total_quantity",
        )

"""From denormalised rows to the tables of the star."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.operators.dates import date_dimension
from tillstar.operators.dedupe import keep_last, keep_one
from tillstar.schema import star_schema

_DIMENSIONS = {
    "product": ("product_id", ["product_name", "price"]),
    "supplier": ("supplier_id", ["supplier_name"]),
    "store": ("store_id", ["store_name"]),
    "customer": ("customer_id", ["customer_name", "gender"]),
}


def dimension(df: DataFrame, name: str) -> DataFrame:
    """One dimension out of rows that carry its columns; conflicting attributes resolve to the smallest."""
    key, attributes = _DIMENSIONS[name]
    return keep_one(df, [key], attributes)


def split_master(products: DataFrame) -> dict[str, DataFrame]:
    """The product master, which carries supplier and store, as three dimensions."""
    return {name: dimension(products, name) for name in ("product", "supplier", "store")}


def sales_rows(enriched: DataFrame, grain: str = "line", sequence: Sequence[str] = ("order_ts",),
               also: Sequence[str] = ()) -> DataFrame:
    """The fact out of enriched transactions.

    ``grain`` is ``line`` (every line is a sale) or ``order`` (a later line of an order replaces the earlier one, by
    ``sequence``). The columns are cut to the narrow fact, and ``also``, before rows of an order are brought together.
    """
    if grain not in ("line", "order"):
        raise ValueError(f"grain must be line or order, not {grain!r}")
    columns = [f.name for f in star_schema("sales").fields if f.name not in ("time_id", "year_t")]
    rows = enriched.select(*columns, *also, *[s for s in sequence if s not in columns])
    if grain == "order":
        rows = keep_last(rows, ["order_id"], sequence)
    return conform(rows.withColumns({"time_id": F.col("order_id"), "year_t": F.year("order_ts")}), "sales", also)


def dates_of(sales: DataFrame) -> DataFrame:
    """The date dimension of a fact: one row per order."""
    return conform(date_dimension(keep_one(sales.select("order_id", "order_ts"), ["order_id"])), "date")


def dimensions_of(sales: DataFrame, products: DataFrame, customers: DataFrame) -> dict[str, DataFrame]:
    """The dimensions of a fact: the master rows its ids use. Only distinct ids of the fact are moved."""

    def used(master: DataFrame, key: str) -> DataFrame:
        return master.join(sales.select(key).distinct(), key, "left_semi")

    star = split_master(used(products, "product_id"))
    star["customer"] = dimension(used(customers, "customer_id"), "customer")
    star = {name: conform(df, name) for name, df in star.items()}
    star["date"] = dates_of(sales)
    return star


def to_star(enriched: DataFrame, grain: str = "line", sequence: Sequence[str] = ("order_ts",)) -> dict[str, DataFrame]:
    """The six tables of the star from enriched transactions that carry the master columns themselves."""
    sales = sales_rows(enriched, grain, sequence)
    kept = sales.select("order_id", "product_id", "customer_id").distinct()
    rows = enriched.join(kept, kept.columns, "left_semi") if grain == "order" else enriched
    star = {name: conform(dimension(rows, name), name) for name in _DIMENSIONS}
    return star | {"date": dates_of(sales), "sales": sales}


def conform(df: DataFrame, table: str, also: Sequence[str] = ()) -> DataFrame:
    """The declared columns of a star table, in order and type, and ``also``."""
    return df.select(*[F.col(f.name).cast(f.dataType) for f in star_schema(table).fields], *also)

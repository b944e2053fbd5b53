"""Transactions joined to product and customer master data; the same code for batch frames and streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.operators.cleaning import REASON
from tillstar.schema import REVENUE


def lookup(transactions: DataFrame, products: DataFrame, customers: DataFrame) -> DataFrame:
    """Left-join both masters once and add ``reject_reason`` (NULL when both were found) and ``sales_revenue``.

    The master keys are unique (checked at staging), so the joins never multiply rows. Neither side carries a
    broadcast hint: Spark broadcasts a master whose size it knows or measures to be small and otherwise joins by
    shuffle, splitting skewed partitions of the transactions. It can only split them when both sides of the join come
    straight from a shuffle, so pass masters that are scans of staged tables: one that is computed on the fly by joins
    or aggregates on its key needs no shuffle of its own, and a hot product would then stay in one task.
    """
    joined = _left(_left(transactions, products, "product_id", "_product"), customers, "customer_id", "_customer")
    reason = (
        F.when(F.col("_product").isNull() & F.col("_customer").isNull(), "unknown product and customer")
        .when(F.col("_product").isNull(), "unknown product")
        .when(F.col("_customer").isNull(), "unknown customer")
    )
    if REASON in transactions.columns:  # a row that failed cleaning keeps its first reason
        reason = F.coalesce(F.col(REASON), reason)
    return joined.withColumns({
        REASON: reason,
        "sales_revenue": (F.col("quantity") * F.col("price")).cast(REVENUE),
    }).drop("_product", "_customer")


def _left(rows: DataFrame, master: DataFrame, key: str, found: str) -> DataFrame:
    """Left join on ``key``; ``found`` tells whether there was a master row.

    A row without a key, or one that failed cleaning, can match nothing. It joins on a hash of itself instead, so that
    such rows, however many, spread over all tasks; the second condition keeps a hash from meeting a real key.
    """
    usable = F.col(key).isNotNull()
    if REASON in rows.columns:
        usable = usable & F.col(REASON).isNull()
    left = rows.withColumns({"_usable": usable, "_key": F.when(usable, F.col(key).cast("bigint")).otherwise(F.xxhash64(*rows.columns))})
    right = master.withColumn(found, F.lit(True)).withColumnRenamed(key, "_master_key")
    return left.join(right, (F.col("_key") == F.col("_master_key")) & F.col("_usable"), "left").drop(
        "_key", "_usable", "_master_key")


def matched(joined: DataFrame) -> DataFrame:
    return joined.filter(F.col(REASON).isNull()).drop(REASON)


def rejected(joined: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The transactions (their own ``columns``) that found no master row, with the reason; they can be replayed."""
    return joined.filter(F.col(REASON).isNotNull()).select(*columns, REASON)


def enrich(transactions: DataFrame, products: DataFrame, customers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(matched rows, rejects) of one batch.

    Both are filters on the same join. A caller that stores both should write ``lookup`` once instead, partitioned by
    whether the row was matched, as the stream does.
    """
    joined = lookup(transactions, products, customers)
    return matched(joined), rejected(joined, transactions.columns)

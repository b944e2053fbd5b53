"""JDBC tables, read and written in parallel by ranges of a numeric column."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def read_options(
    url: str,
    table: str | None = None,
    query: str | None = None,
    *,
    fetch_size: int = 10_000,
    partition: tuple[str, int, int, int] | None = None,
    properties: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Reader options; ``partition`` = (column, lower bound, upper bound, number of ranges).

    The bounds only place the range borders: rows outside of them are read by the first and last range.
    """
    if (table is None) == (query is None):
        raise ValueError("name either a table or a query")
    options = {"url": url, "fetchsize": str(fetch_size), "preferTimestampNTZ": "true", **(properties or {})}
    options["dbtable"] = table if table is not None else f"({query}) q"
    if partition is not None:
        column, lower, upper, ranges = partition
        options |= {
            "partitionColumn": column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(ranges),
        }
    return options


def read_jdbc(spark: SparkSession, url: str, table: str | None = None, query: str | None = None, *,
              max_rows: int | None = None, **kwargs) -> DataFrame:
    df = spark.read.format("jdbc").options(**read_options(url, table, query, **kwargs)).load()
    return df if max_rows is None else df.limit(max_rows)


def write_options(
    url: str,
    table: str,
    *,
    batch_size: int = 1_000,
    connections: int = 8,
    properties: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Writer options: rows per insert batch, and at most ``connections`` tasks writing at a time."""
    return {
        "url": url,
        "dbtable": table,
        "batchsize": str(batch_size),
        "numPartitions": str(connections),
        **(properties or {}),
    }


def write_jdbc(df: DataFrame, url: str, table: str, *, mode: str = "append", **kwargs) -> None:
    df.write.format("jdbc").options(**write_options(url, table, **kwargs)).mode(mode).save()

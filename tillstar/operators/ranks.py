"""Row numbers over a whole table without a task that sees all of it."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.session import materialised

_PART, _AT, _BEFORE = "_part", "_at", "_before"
_TIE = "_tie"


def numbered(df: DataFrame, order: Sequence[Column | str], name: str = "position") -> DataFrame:
    """``df`` with the place of each row, from 0, in the given order.

    The rows are dealt to tasks by ranges of the order, a hash of the row breaking ties, so that a value which many rows
    share does not meet in one task. Each task sorts and counts its own range; a row's place is its place there plus the
    rows of the ranges before. Only one count a task goes through the driver. The table is written once, as its ranges
    must not be drawn anew between counting and adding.
    """
    spark = df.sparkSession
    keys = [F.col(c) if isinstance(c, str) else c for c in order]
    rows = df.withColumn(_TIE, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
    rows = rows.repartitionByRange(*keys, _TIE).sortWithinPartitions(*keys, _TIE)
    rows = rows.withColumn(_PART, F.spark_partition_id()).withColumn(
        _AT, F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1))  # its lower bits count the rows of a task
    rows = materialised(rows.drop(_TIE), "ranges")
    sizes = sorted(tuple(r) for r in rows.groupBy(_PART).agg(F.count("*")).collect())
    before = [0, *accumulate(n for _, n in sizes)]
    starts = spark.createDataFrame([(part, b) for (part, _), b in zip(sizes, before)], f"{_PART} int, {_BEFORE} bigint")
    out = rows.join(F.broadcast(starts), _PART)  # one row a task
    return out.select(*[F.col(f"`{c}`") for c in df.columns], (F.col(_AT) + F.col(_BEFORE)).alias(name))


def between(df: DataFrame, order: Sequence[Column | str], first: int, last: int | None = None) -> DataFrame:
    """Rows ``first`` (from 0) up to, not including, ``last`` of an ordering, in that order."""
    rows = numbered(df, order, "_position").filter(F.col("_position") >= first)
    if last is not None:
        rows = rows.filter(F.col("_position") < last)
    return rows.orderBy("_position").drop("_position")

"""Insert, update, delete and select on tables, as transforms from DataFrame to DataFrame.

Predicates and values are Spark columns or SQL text. Order and limit pick the first rows of an ordering; they need
the unique key columns of the table, which complete the ordering and tie the picked rows back to it. Limits and offsets
of up to ``joins.BROADCAST_ROWS`` rows are Spark's own top-n; beyond that rows get their numbers from sorted ranges of the
ordering (``ranks``), so that no task sees all that is skipped or taken.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.operators import joins, ranks
from tillstar.operators.joins import few

Predicate = Column | str


def predicate(where: Predicate | None, required: bool = False) -> Column:
    """A condition column; NULL counts as false. An empty condition means all rows, or is an error if required."""
    if where is None or (isinstance(where, str) and not where.strip()):
        if required:
            raise ValueError("the condition must not be empty")
        return F.lit(True)
    return F.coalesce(F.expr(where) if isinstance(where, str) else where, F.lit(False))


def value(v: Any) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def mark(df: DataFrame, where: Predicate | None, order_by: Sequence | None, limit: int | None,
          keys: Sequence[str] | None, required: bool = False) -> tuple[DataFrame, Column]:
    """``df`` and a column that tells which rows the statement hits."""
    hit = predicate(where, required)
    if limit is None:
        return df, hit
    if not keys:
        raise ValueError("a limit needs the key columns of the table")
    if limit > joins.BROADCAST_ROWS:  # hits come first, in their order; the other rows follow
        rows = ranks.numbered(df.withColumn("_hit", hit), [F.desc("_hit"), *(order_by or []), *keys], "_place")
        return rows, F.col("_hit") & (F.col("_place") < limit)
    picked = df.filter(hit).orderBy(*(order_by or []), *keys).limit(limit).select(*keys)
    picked = few(picked.withColumn("_hit", F.lit(True)), limit)
    return df.join(picked, list(keys), "left"), F.coalesce("_hit", F.lit(False))


def select(df: DataFrame, *columns: Column | str, where: Predicate | None = None, group_by: Sequence = (),
           having: Predicate | None = None, order_by: Sequence = (), limit: int | None = None,
           offset: int = 0, keys: Sequence[str] | None = None) -> DataFrame:
    """Filter, group, order and cut in one call. ``columns`` of a grouped select are aggregates.

    An offset without a limit is honoured: the first rows are found as a top-n and removed by key, so the remainder
    is never moved into one task. ``keys``, where given, break ties of the ordering.
    """
    out = df.filter(predicate(where))
    if group_by:
        out = out.groupBy(*group_by).agg(*[F.expr(c) if isinstance(c, str) else c for c in columns])
    elif columns:
        out = out.select(*[F.expr(c) if isinstance(c, str) else c for c in columns])
    out = out.filter(predicate(having))
    if offset and limit is None and not keys:
        raise ValueError("an offset without a limit needs the key columns")
    if offset + (limit or 0) > joins.BROADCAST_ROWS:
        return ranks.between(out, [*order_by, *(keys or [])], offset, None if limit is None else offset + limit)
    if offset and limit is None:
        skipped = out.orderBy(*order_by, *keys).limit(offset).select(*keys)
        out = out.join(few(skipped, offset), list(keys), "left_anti").select(*out.columns)
        return out.orderBy(*order_by) if order_by else out
    if order_by:
        out = out.orderBy(*order_by)
    if offset:
        out = out.offset(offset)
    return out if limit is None else out.limit(limit)


def insert(df: DataFrame, columns: Sequence[str], rows: Sequence[Sequence[Any]] | DataFrame) -> DataFrame:
    """``df`` plus new rows; values may be expressions, columns left out become NULL."""
    spark = df.sparkSession
    types = {f.name: f.dataType for f in df.schema.fields}
    if isinstance(rows, DataFrame):
        new = rows.toDF(*columns)
    else:
        for row in rows:
            if len(row) != len(columns):
                raise ValueError(f"{len(columns)} columns but {len(row)} values")
        if not rows:
            return df
        # one array of row literals instead of one plan branch per row
        literals = [F.struct(*[value(v).cast(types[c]).alias(c) for c, v in zip(columns, row)]) for row in rows]
        new = spark.range(1).select(F.inline(F.array(*literals)))
    filled = new.select(*[
        (F.col(c) if c in columns else F.lit(None)).cast(t).alias(c) for c, t in types.items()
    ])
    return df.unionByName(filled)


def update(df: DataFrame, assign: Mapping[str, Any], where: Predicate | None = None, order_by: Sequence | None = None,
           limit: int | None = None, keys: Sequence[str] | None = None) -> DataFrame:
    """Set columns on the rows that meet the condition. Every new value sees the old row."""
    types = {f.name: f.dataType for f in df.schema.fields}
    marked, hit = mark(df, where, order_by, limit, keys)
    return marked.select(*[
        F.when(hit, value(assign[c]).cast(types[c])).otherwise(F.col(c)).alias(c) if c in assign else F.col(c)
        for c in df.columns
    ])


def delete(df: DataFrame, where: Predicate | None = None, order_by: Sequence | None = None,
           limit: int | None = None, keys: Sequence[str] | None = None) -> DataFrame:
    """The rows that the statement leaves. A condition that is NULL keeps its row."""
    marked, hit = mark(df, where, order_by, limit, keys)
    return marked.filter(~hit).select(*df.columns)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows"))

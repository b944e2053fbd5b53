"""One row per key: the last by sequence, or the smallest by attributes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Types whose minimum Spark keeps in place in a hash aggregate.
_FIXED = (T.IntegerType, T.LongType, T.DateType, T.TimestampType, T.TimestampNTZType)


def keep_last(df: DataFrame, keys: Sequence[str], sequence: Sequence[str]) -> DataFrame:
    """The row with the greatest ``sequence`` per key.

    The remaining columns follow the named ones as tie-breakers, so the result never depends on how rows are
    distributed. An aggregate, not a window: it combines on the map side, so a hot key is a few rows a task before the
    shuffle. Spark aggregates structs by sorting, within each task before the shuffle and after it.
    """
    rest = [c for c in df.columns if c not in keys]
    order = [*sequence, *[c for c in rest if c not in sequence]]
    best = F.max(F.struct(*order))
    return df.groupBy(*keys).agg(best.alias("_row")).select(*[
        F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns
    ])


def one_spelling(df: DataFrame, column: str) -> DataFrame:
    """Give texts that differ only in case the same spelling: the smallest one that occurs."""
    folded = F.lower(column)
    spellings = df.select(column).distinct().groupBy(folded.alias("_folded")).agg(F.min(column).alias("_spelling"))
    return (
        df.join(spellings, folded == F.col("_folded"), "left")
        .withColumn(column, F.coalesce("_spelling", column))
        .select(*df.columns)
    )


def keep_one(df: DataFrame, keys: Sequence[str], attributes: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the one with the smallest attributes. Deterministic, unlike ``dropDuplicates``.

    Only the distinct attribute sets of a key matter, so they are found first: a hash aggregate that shrinks the
    rows on the map side. The minimum over structs, which Spark aggregates by sorting, then sees few rows. The
    condition on the number of sets is always true; without it Catalyst would fold the two aggregates into one and
    sort all rows. The minimum of one column of fixed width needs neither structs nor sorting: one hash aggregate.
    """
    attributes = list(attributes or [c for c in df.columns if c not in keys])
    if len(attributes) == 1 and isinstance(df.schema[attributes[0]].dataType, _FIXED):
        one = F.col(attributes[0])
        least = F.when(F.count(one) == F.count(F.lit(1)), F.min(one))  # NULL is the smallest, which min() alone skips
        return df.groupBy(*keys).agg(least.alias(attributes[0]))
    variants = df.select(*keys, *attributes).distinct()
    if not attributes:
        return variants
    return (
        variants.groupBy(*keys)
        .agg(F.min(F.struct(*attributes)).alias("_row"), F.count("*").alias("_sets"))
        .filter(F.col("_sets") > 0)
        .select(*keys, *[F.col(f"_row.{a}").alias(a) for a in attributes])
    )

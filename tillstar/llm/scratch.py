"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tillstar.session import CLEANUP, cleaned, scratch_path, set_while  # noqa: F401 (CLEANUP: for the callers)

#: Where no partition of a side is larger, adaptive execution then joins by a hash table of it.
HASHED = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"


def small_batches(spark: SparkSession, rows: int = 2000) -> None:
    """Hand texts to Python in small Arrow batches: long documents make Spark's usual 10,000 rows a lot of memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def hash_joins(spark: SparkSession):
    """Executions in the block sort less: each sort, however small, takes a page of its own, often 32 MB, from the heap."""
    return set_while(spark, HASHED, "16m")


def _write(df: DataFrame, path: str) -> DataFrame:
    spark = df.sparkSession
    with cleaned(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def written(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read back: lineage ends there, and a lost executor costs a re-read."""
    return _write(df, scratch_path(df.sparkSession, f"llm-{name}"))


@contextmanager
def temporary(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """``written`` for tables that nothing reads after the block; they are deleted at its end."""
    paths: list[str] = []

    def write(df: DataFrame, name: str) -> DataFrame:
        paths.append(scratch_path(spark, f"llm-{name}"))
        return _write(df, paths[-1])

    try:
        yield write
    finally:
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for path in paths:
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(conf).delete(target, True)

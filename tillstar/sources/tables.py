"""Table scans."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tillstar.schema import SOURCES

def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    reader = spark.read.schema(SOURCES[name]) if name in SOURCES else spark.read
    return reader.parquet(f"{folder.rstrip('/')}/{name}.parquet")


class Folder(Mapping):
    """The Parquet tables of a folder by name. A table is opened when it is first asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark, self._folder, self._open = spark, folder, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._open:
            self._open[name] = read_table(self._spark, self._folder, name)
        return self._open[name]

    def __iter__(self):
        return iter(self._open)

    def __len__(self) -> int:
        return len(self._open)

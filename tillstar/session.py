"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession

# Run-time settings every job here relies on. AQE measures shuffle sizes while a query runs: it turns a join into a
# broadcast join only when the side it measured is small, splits skewed join partitions and merges tiny ones. A skewed
# join is split even if an aggregation on the same key then needs a shuffle of its own: without that a hot key that
# reaches "join, then group by the same key" would stay in one task.
# The work of a task stays the same when the tables grow: input is split and shuffles are merged into pieces far smaller
# than Spark's defaults, so that more rows make more tasks and not wider sorts and hash tables. A join whose smaller side
# fits such a piece builds a hash table of it and need not sort the larger side. Up to a few folders, such as rejects
# beside usable rows, are written through writers that are open together, again without a sort.
# Times here have no zone; Spark formats them through the session's, where an hour may be missing in spring.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "16m",
    "spark.sql.files.maxPartitionBytes": "32m",
    "spark.sql.maxConcurrentOutputFileWriters": "8",
}

#: Spark then deletes an execution's shuffle files when it ends, not whenever the driver collects its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session that was made elsewhere, such as by spark-submit."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = 8, app: str = "tillstar", **extra: str) -> SparkSession:
    """A local session for tests and the bench. On a cluster the session comes from spark-submit."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    settings = {
        **SETTINGS,
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
        # Files are compressed: a table of 1 MB on disk is several MB as a hash table. Larger sides join by shuffle,
        # which keeps all local cores busy; Spark's default would broadcast even the fact of the small test tables.
        "spark.sql.autoBroadcastJoinThreshold": "1MB",
        "spark.driver.memory": "12g",
        "spark.python.sql.dataFrameDebugging.enabled": "false",  # records a stack trace per column otherwise
        "spark.ui.showConsoleProgress": "false",
        **extra,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``.

    Only a session whose executors are threads of this very process (``local``, ``local[n]``) gets a folder of its own
    where that setting is missing. On other masters the setting is required, and a ``file:`` folder is refused unless
    the executors run on this machine (``local-cluster``).
    """
    folder, master = spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext.master
    if not folder:
        if master == "local" or master.startswith("local["):
            return _own_dir()
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    if folder.startswith("file:") and not master.startswith("local"):
        raise RuntimeError(f"spark.checkpoint.dir is {folder}, which executors on other machines cannot see")
    return folder


@cache
def _own_dir() -> str:
    return tempfile.mkdtemp(prefix="tillstar-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def set_while(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def cleaned(spark: SparkSession):
    """Executions in the block run once: their shuffle files go when they end."""
    return set_while(spark, CLEANUP, "true")


def materialised(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` to the shared folder and return a scan of what was written.

    This cuts the lineage: a lost executor costs a re-read, not a recomputation. Unlike ``checkpoint()`` it computes
    the frame once, and later readers prune columns.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path as it names it."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def remove(spark: SparkSession, path: str) -> bool:
    """Delete a file or folder; False when there was none."""
    fs, target = file_system(spark, path)
    return fs.delete(target, True)

"""The transaction stream: files in, enriched rows and rejects out, one folder per micro-batch.

What came out is added to a warehouse batch by batch (``load_new``), and the last line of every order is kept as streaming
state (``follow``): a batch costs what it brings, not what was there before.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tillstar.operators.cleaning import REASON, clean_transactions
from tillstar.operators.dedupe import keep_last
from tillstar.operators.enrich import lookup
from tillstar.operators.loads import (ConcurrentLoad, load_increment, load_warehouse, loaded_upto, read_batches,
                                      write_batch)
from tillstar.operators.normalise import to_star
from tillstar.schema import CORRUPT, RAW_TRANSACTIONS
from tillstar.session import cleaned

MATCHED = "matched"


def process(raw: DataFrame, products: DataFrame, customers: DataFrame) -> DataFrame:
    """Clean and enrich raw transactions, batch or stream. ``reject_reason`` and ``raw`` are NULL on usable rows.

    A row that failed cleaning keeps its text through the joins. The text of one that found no master row is built from
    its typed fields afterwards, so usable rows carry none.
    """
    rows = lookup(clean_transactions(raw), products, customers)
    fields = [F.col("order_id").cast("string").alias("order_id"),
              F.date_format("order_ts", "yyyy-MM-dd HH:mm:ss").alias("order_date")]
    fields += [F.col(c).cast("string").alias(c) for c in ("product_id", "quantity", "customer_id")]
    text = F.coalesce(F.col("raw"), F.to_json(F.struct(*fields)))
    return rows.withColumn("raw", F.when(F.col(REASON).isNotNull(), text))


def _store(rows: DataFrame, path: str, batch_id: int) -> None:
    write_batch(rows.withColumn(MATCHED, F.col(REASON).isNull().cast("string")), path, batch_id, [MATCHED])


def start(
    raw: DataFrame,
    masters: Callable[[], tuple[DataFrame, DataFrame]],
    path: str,
    checkpoint: str,
) -> StreamingQuery:
    """Process all files present, batch by batch, and stop.

    ``masters`` returns (products, customers) and is called per batch, so late master rows are seen by later
    batches. Each batch is written once, split into accepted rows and rejects by a partition column, under its batch
    number; a batch that runs again after a failure replaces what it wrote before.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        _store(process(batch, *masters()), path, batch_id)

    with cleaned(raw.sparkSession):
        return (
            raw.writeStream.foreachBatch(handle)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )


def accepted(spark: SparkSession, *paths: str) -> DataFrame:
    """The accepted rows of one or more outputs, numbered by ``generation`` in the order given."""
    out = None
    for generation, path in enumerate(paths):
        rows = read_batches(spark, path).filter(F.col(MATCHED) == "true").drop(MATCHED, REASON, "raw")
        rows = rows.withColumn("generation", F.lit(generation))
        out = rows if out is None else out.unionByName(rows)
    return out


def rejects(spark: SparkSession, path: str) -> DataFrame:
    """Rejected transactions with their raw text, to be corrected or replayed."""
    return read_batches(spark, path).filter(F.col(MATCHED) == "false").select("batch_id", "raw", REASON)


def replay(spark: SparkSession, path: str, masters: Callable[[], tuple[DataFrame, DataFrame]], target: str) -> None:
    """Process the rejects of an output once more, after late master rows came in, into an output of its own.

    Read both together with ``accepted(spark, path, target)``; what is still rejected are the rejects of ``target``.
    Running a replay again replaces its result.
    """
    fields = T.StructType([*RAW_TRANSACTIONS.fields, T.StructField(CORRUPT, T.StringType())])
    raw = rejects(spark, path).select(F.from_json("raw", fields).alias("r")).select("r.*")
    _store(process(raw, *masters()), target, 0)


ARRIVAL = ("generation", "batch_id", "order_ts")


def latest_orders(spark: SparkSession, *paths: str, sequence=ARRIVAL) -> DataFrame:
    """State by order: the last row of each order over all batches."""
    return keep_last(accepted(spark, *paths), ["order_id"], sequence)


def source_name(path: str) -> str:
    return path.rstrip("/")


def load_new(spark: SparkSession, path: str, root: str, upto: int | None = None, sales_key: Sequence[str] = (),
             check: bool = True, source: str | None = None) -> int | None:
    """Add the batches of an output that no load has seen, up to number ``upto``; returns the run number.

    Every output has an offset of its own in the warehouse, under ``source`` (default: its path), so the stream's output
    and the replays of its rejects each arrive once. Lines of the new batches are appended and only keys that the
    dimensions lack are added; nothing that was loaded is written again, and a line whose ``sales_key`` is stored is
    refused. ``load`` rewrites the whole as one run, which compacts what these loads added. Without new batches nothing
    happens, also when another load brings them in meanwhile.
    """
    source = source or source_name(path)
    while True:
        seen = loaded_upto(spark, root, source)
        rows = accepted(spark, path).filter(F.col("batch_id") > (-1 if seen is None else seen))
        if upto is not None:
            rows = rows.filter(F.col("batch_id") <= upto)
        newest = rows.agg(F.max("batch_id")).first()[0]
        if newest is None:
            return None
        rows = rows.filter(F.col("batch_id") <= newest)  # a batch may arrive between the two reads
        try:
            return load_increment(to_star(rows, "line", ARRIVAL), root, sales_key, check, {source: newest}, {source: seen})
        except ConcurrentLoad:
            continue


def load(spark: SparkSession, paths: Sequence[str], root: str, grain: str = "line", sequence=ARRIVAL,
         sales_key=("order_id",), check: bool = True) -> int:
    """Load the rows accepted so far into the warehouse as a new run.

    The batches stay as they are, so a later load sees them again together with new ones; keep-last makes the result
    the same however often a batch was written. ``load_new`` adds new batches only.
    """
    rows = accepted(spark, *paths)
    newest = rows.groupBy("generation").agg(F.max("batch_id").alias("upto")).collect()  # one row an output
    upto = {source_name(paths[r["generation"]]): r["upto"] for r in newest}
    for r in newest:
        later = (F.col("generation") == r["generation"]) & (F.col("batch_id") > r["upto"])
        rows = rows.filter(~later)
    return load_warehouse(to_star(rows, grain, sequence), root, sales_key, check, upto)


# -- the last line of every order, as streaming state -----------------------------------------------------------------------

#: Keeps state on the executors' disks and uploads changes, so that neither memory nor a batch follows all orders. What
#: executors hold and what they upload is compressed alike.
STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
    "spark.sql.streaming.stateStore.compression.codec": "zstd",
}


def share_of_files(spark: SparkSession, path: str, batches: int) -> int:
    """Files per batch with which ``follow`` reads an output in that many batches, or fewer, however many files it has.

    Every batch opens and saves all partitions of the state, so batches that follow the files cost more than the rows.
    """
    return max(1, -(-len(read_batches(spark, path).inputFiles()) // batches))


def follow(spark: SparkSession, path: str, changes: str, checkpoint: str, sequence=("order_ts", "batch_id"),
           files_per_batch: int | None = None) -> StreamingQuery:
    """Read what a stream's output gained since the last call into the state of last lines per order, and stop.

    Each batch reads new files only, updates the state of the orders in them, and writes those orders' last lines to a
    folder of its own under ``changes``, for readers that follow along. ``state_of`` reads the state itself. Ties of
    ``sequence`` are broken by the other columns, and a line that comes again changes nothing, so a batch may run twice.
    ``files_per_batch`` bounds the files of a batch.
    """
    for key, value in STATE.items():
        spark.conf.set(key, value)
    written = read_batches(spark, path)
    fields = T.StructType([f for f in written.schema.fields if f.name not in ("batch_id", MATCHED)])
    fields = fields.add("batch_id", T.LongType()).add(MATCHED, T.StringType())  # the folders' names
    reader = spark.readStream.schema(fields).option("basePath", path)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    rows = reader.parquet(path).filter(F.col(MATCHED) == "true").drop(MATCHED, REASON, "raw")
    rest = [c for c in rows.columns if c != "order_id" and c not in sequence]
    last = rows.groupBy("order_id").agg(F.max(F.struct(*sequence, *rest)).alias("last"))

    def handle(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch.select("order_id", "last.*"), changes, batch_id)

    with cleaned(spark):
        return (
            last.writeStream.outputMode("update").foreachBatch(handle).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start()
        )


def state_of(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The last line of every order, from the state that ``follow`` keeps: a read of the orders, not of their history."""
    state = spark.read.format("statestore").load(checkpoint)
    value = state.schema["value"].dataType.fieldNames()[0]
    return state.select("key.order_id", F.col(f"value.{value}").alias("last")).select("order_id", "last.*")

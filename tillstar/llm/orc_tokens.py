"""Token ids in ORC: run-length encoded integers, row indexes and Bloom filters on document ids.

Documents are dealt to files by ranges of their ids and sorted in each, so that the files in order hold ascending ids,
and a reader prunes files and stripes by the ids' minima and maxima, row groups by the index, and single ids by the
Bloom filters. Each row holds where its ids start within its file; file totals, a handful of numbers a file, give the
place in the whole corpus. Stripes are read in parallel.

Rules: a null text is empty and becomes its end id alone. Null ids come first. Rows with the same id are ordered by a hash of their text.
An empty table gives files without rows; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillstar.llm import passages
from tillstar.llm.tokens import END, word_encoder

OPTIONS = {
    "compression": "zstd", "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01",
    "orc.create.index": "true", "orc.row.index.stride": "1000", "orc.stripe.size": str(32 << 20),
}
SCHEMA = "doc_id long, file int, place long, start_in_file long, n_tokens long, ids array<int>"
FIELDS = ["doc_id", "file", "place", "start_in_file", "n_tokens", "ids"]


def write(docs: DataFrame, path: str, tokenizer: str, files: int | None = None) -> None:
    """Encode every text and write it. ``files``: how many; by default as many as the session has shuffle partitions."""
    spark = docs.sparkSession
    files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = passages.source(docs)
    # texts are dealt before they are encoded, so finding the ranges reads no more than texts
    dealt = (rows.repartitionByRange(files, F.col("doc_id").asc_nulls_first(), "row")
             .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "row").select("doc_id", "text")
             .withColumn("file", F.spark_partition_id()))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, start, place = word_encoder(tokenizer), 0, 0
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                ids = [x + END for x in encoder.encode(part.column(1).to_pylist())]
                sizes = np.array([len(x) // 4 for x in ids], np.int64)
                ends = np.cumsum(sizes)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)), pa.int32()),
                                                 pa.array(np.frombuffer(b"".join(ids), np.int32)))
                yield pa.record_batch([part.column(0), part.column(2), pa.array(place + np.arange(len(ids))),
                                       pa.array(start + ends - sizes), pa.array(sizes), lists], FIELDS)
                start += int(ends[-1])
                place += len(ids)

    writer = dealt.mapInArrow(encode, SCHEMA).write.mode("overwrite")
    for key, value in OPTIONS.items():
        writer = writer.option(key, value)
    writer.orc(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """What was written, with ``start``: how many ids all documents before hold."""
    rows = spark.read.schema(SCHEMA).orc(path)
    totals = rows.groupBy("file").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    bases = totals.select("file", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    return rows.join(F.broadcast(bases), "file").withColumn("start", F.col("base") + F.col("start_in_file"))


def digests(rows: DataFrame) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens`` and the CRC-32 of the ids read back."""
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            values = np.ascontiguousarray(lists.flatten().to_numpy(zero_copy_only=False), np.uint32).view(np.uint8)
            ends = lists.offsets.to_numpy().astype(np.int64) - lists.offsets[0].as_py() if batch.num_rows else np.zeros(1, int)
            sums = [zlib.crc32(values[4 * a: 4 * z]) for a, z in zip(ends[:-1].tolist(), ends[1:].tolist())]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(np.diff(ends), pa.int64()),
                                   pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return rows.select("doc_id", "start", "ids").mapInArrow(check, "doc_id long, start long, n_tokens long, ids_crc32 long")

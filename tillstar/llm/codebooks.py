"""Vector code compression: integer codebooks per part of a vector, with distances from per-dimension value dictionaries.

A component x becomes the integer floor(1024 x). Vectors are cut into equal consecutive parts, each with a codebook of 256
entries that begins as the parts of the vectors with the smallest ids. A round gives each part to its nearest entry and
moves the entry to the floored mean of its parts. All arithmetic is in integers, so every run gives the same codes.

The first pass writes the vectors in blocks. A block has for each dimension a dictionary of its distinct integers, and
each vector's place in it. A round then tabulates, per dimension, the squared differences of the dictionary to all
entries; the distances of a block's parts to all entries are gathers of table rows by dictionary codes, and additions.
Tasks send one count and one sum a component for each entry; Spark adds them, and the driver holds the codebooks, whose
size does not depend on the rows.

Rules: vectors that are null, empty, or hold a null or non-finite component take no part; nor do vectors whose length the
number of parts does not divide, or differs from that of the first vector left (by id, null ids last, then by vector).
Components so large that a vector's error might not fit into 64 bits (with 64 of them, from about 131,000 on, either way)
count as non-finite. Repeated rows count each; of equal ids the smaller vector comes first. Equal distances go to the lower entry. With fewer vectors than
entries the codebook has as many entries as vectors. Labels may be null and of any type; other columns are not read. An
empty table, or one without usable vectors, gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.llm.scratch import temporary, written

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Vectors of a block: large enough for dictionaries to repeat, small enough for distances to all entries in memory.
BLOCK = 2048
_BLOCK = "ids array<long>, labels array<string>, sizes binary, values binary, codes binary"


def usable(vector: Column, parts: int = PARTS) -> Column:
    most = F.sqrt(F.lit(2.0 ** 62) / F.size(vector)) / (2 * SCALE)  # two such differ by an error below 2^62
    fits = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < most))  # NaN is above all numbers
    return F.coalesce(fits & (F.size(vector) > 0) & (F.size(vector) % parts == 0), F.lit(False))


def scaled(vectors: np.ndarray) -> np.ndarray:
    return np.floor(vectors.astype(np.float64) * SCALE).astype(np.int64)


def blocks(rows: DataFrame, width: int) -> DataFrame:
    """``rows`` (id, label, vector) as dictionaries and codes: one row of ``_BLOCK`` for up to BLOCK vectors."""
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def sent(table: pa.Table) -> pa.RecordBatch:
            table = table.combine_chunks()
            flat = table.column("vector").combine_chunks().flatten() if table.num_rows else pa.array([], pa.float64())
            numbers = scaled(flat.to_numpy(zero_copy_only=False)).reshape(-1, width)
            values, codes = zip(*(np.unique(column, return_inverse=True) for column in numbers.T))
            sizes = np.array([len(v) for v in values], np.int32)
            lists = [pa.ListArray.from_arrays(pa.array([0, table.num_rows], pa.int32()), table.column(i).combine_chunks())
                     for i in (0, 1)]
            raw = [sizes, np.concatenate(values), np.concatenate(codes).astype(np.uint16)]
            return pa.record_batch([*lists, *(pa.array([a.tobytes()], pa.binary()) for a in raw)], BLOCK_NAMES)

        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= BLOCK:
                table = pa.Table.from_batches(held)
                for a in range(0, size - BLOCK + 1, BLOCK):
                    yield sent(table.slice(a, BLOCK))
                rest = table.slice(size - size % BLOCK)
                held, size = rest.to_batches(), rest.num_rows
        if size:
            yield sent(pa.Table.from_batches(held))

    return rows.select("id", "label", "vector").mapInArrow(encode, _BLOCK)


BLOCK_NAMES = ["ids", "labels", "sizes", "values", "codes"]


def nearest(batch: pa.RecordBatch, row: int, books: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """For one block: every part's entry and its squared distance, both (parts, vectors), and each dimension's integers.

    ``books`` is (parts, entries, dimensions of a part).
    """
    parts, entries, width = books.shape
    sizes, values, codes = (np.frombuffer(batch.column(name)[row].as_buffer(), kind)
                            for name, kind in (("sizes", np.int32), ("values", np.int64), ("codes", np.uint16)))
    codes = codes.reshape(parts * width, -1)
    starts = np.concatenate(([0], np.cumsum(sizes)))
    dictionaries = [values[a:z] for a, z in zip(starts[:-1], starts[1:])]
    furthest = int(max(values.max(), books.max()) - min(values.min(), books.min()))
    kind = np.int32 if furthest * furthest * width < 1 << 31 else np.int64
    n = codes.shape[1]
    chosen, errors = np.empty((parts, n), np.int64), np.empty((parts, n), np.int64)
    total, gathered = np.empty((n, entries), kind), np.empty((n, entries), kind)
    for part in range(parts):
        total[:] = 0
        for j in range(width):
            d = part * width + j
            table = ((dictionaries[d][:, None] - books[part, :, j]) ** 2).astype(kind)
            total += np.take(table, codes[d], axis=0, out=gathered, mode="clip")
        chosen[part] = total.argmin(axis=1)  # the first of equals
        errors[part] = total[np.arange(n), chosen[part]]
    return chosen, errors, [dictionary[code] for dictionary, code in zip(dictionaries, codes)]


def moved(table: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round over all blocks."""
    parts, entries, width = books.shape
    shared = table.sparkSession.sparkContext.broadcast(books)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared.value
        counts, added = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, width), np.int64)
        for batch in batches:
            for row in range(batch.num_rows):
                chosen, _, numbers = nearest(batch, row, books)
                for part in range(parts):
                    counts[part] += np.bincount(chosen[part], minlength=entries)
                    order = np.argsort(chosen[part], kind="stable")
                    here, first = np.unique(chosen[part][order], return_index=True)
                    for j in range(width):
                        added[part, here, j] += np.add.reduceat(numbers[part * width + j][order], first)
        part, entry = np.nonzero(counts)
        yield pa.record_batch([
            pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(counts[part, entry]),
            pa.array(list(added[part, entry]), pa.list_(pa.int64()))], ["part", "entry", "n", "sums"])

    rows = table.mapInArrow(sums, "part int, entry int, n long, sums array<long>")
    rows = rows.groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(F.col("sums")[j]) for j in range(width)])
    out = books.copy()
    for part, entry, n, *total in rows.collect():  # at most one row an entry
        out[part, entry] = [t // n for t in total]  # floors
    shared.unpersist()
    return out


def first_vectors(rows: DataFrame, entries: int) -> tuple[int, list]:
    """The length of the vectors that take part and the ``entries`` first of them, by id."""
    order = [F.asc_nulls_last("id"), "vector"]
    found = [r[0] for r in rows.orderBy(*order).limit(entries).select("vector").collect()]
    if not found:
        return 0, []
    length = len(found[0])
    if any(len(v) != length for v in found):
        rows = rows.filter(F.size("vector") == length)
        found = [r[0] for r in rows.orderBy(*order).limit(entries).select("vector").collect()]
    return length, found


def compressed(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
               parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """``id``, ``label``, ``code`` (a place in each part's codebook) and ``error`` of every usable vector; the codebooks."""
    spark = rows.sparkSession
    rows = rows.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("string").alias("label"),
                       F.col(f"`{vector_col}`").alias("vector")).filter(usable(F.col("vector"), parts))
    length, first = first_vectors(rows, entries)
    schema = "id long, label string, code array<int>, error long"
    if not length:
        return spark.createDataFrame([], schema), np.zeros((parts, 0, 0), np.int64)
    books = scaled(np.array(first)).reshape(len(first), parts, -1).transpose(1, 0, 2)
    with temporary(spark) as write:
        table = write(blocks(rows.filter(F.size("vector") == length), length), "blocks")
        for _ in range(rounds):
            books = moved(table, books)
        shared = spark.sparkContext.broadcast(books)

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in range(batch.num_rows):
                    chosen, errors, _ = nearest(batch, row, shared.value)
                    yield pa.record_batch([
                        batch.column("ids")[row].values, batch.column("labels")[row].values,
                        pa.array(list(chosen.T.astype(np.int32)), pa.list_(pa.int32())), pa.array(errors.sum(axis=0))],
                        ["id", "label", "code", "error"])

        return written(table.mapInArrow(assign, schema), "codes"), books


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def code_digests(rows: DataFrame) -> DataFrame:
    """``vec_id``, ``code`` in hexadecimal, ``error``, ``label_error`` and ``codebooks_sha256`` of every usable vector."""
    codes, books = compressed(rows)
    totals = codes.groupBy("label").agg(F.sum("error").alias("label_error")).alias("t")
    out = codes.alias("c").join(totals, F.col("c.label").eqNullSafe(F.col("t.label")))
    text = F.array_join(F.transform("c.code", lambda x: F.lower(F.lpad(F.hex(x), 2, "0"))), "")
    return out.select(F.col("c.id").alias("vec_id"), text.alias("code"), "c.error", "t.label_error",
                      F.lit(digest(books)).alias("codebooks_sha256"))

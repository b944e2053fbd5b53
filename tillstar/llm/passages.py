"""Where the same window of symbols stands twice: the parts that both substring operators share.

Two scans of the documents and one shuffle of what repeats, never of whole texts:

1. Every window of ``window`` symbols is stood for by its ``filter_gram`` symbols with the least hash. Their hashes are
   counted (combined in each task, then by Spark). Those seen twice go into a bit table of bounded size.
2. The second scan keeps the windows whose gram is in the table. The rest cannot occur twice. Kept windows are cut into
   regions by a shorter least gram, ``key_gram``: equal windows have the same key wherever they stand, so one key's
   regions hold all occurrences. Equal regions become one row with a count and the smallest document id, however many
   copies there are; their places are rows of their own, joined back by Spark, which splits hot ones.

The bit table only saves work: a false hit is found out by the exact index that follows. It takes 16 bits a repeated
gram up to ``MOST_BITS``; beyond that it lets more windows through, with the same results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstar.llm import windows
from tillstar.llm.scratch import small_batches, temporary, written

MOST_BITS = 1 << 30
SLICE = 1 << 19  # bits
#: Rows a task remembers to send a region's text once.
REMEMBERED = 100_000


def source(docs: DataFrame) -> DataFrame:
    """Only id and text, null text as empty; ``row`` tells rows with the same id but different texts apart."""
    small_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return docs.withColumn("row", F.xxhash64("doc_id", "text"))


def symbols_of(data: np.ndarray, offsets: np.ndarray, by_word: bool):
    """Symbols, their document offsets, and each symbol's first and last byte (None for bytes)."""
    if not by_word:
        return data, offsets, None, None
    starts, ends, offsets = windows.words(data, offsets)
    return windows.word_hashes(data, starts, ends), offsets, starts, ends


def parts(data: np.ndarray, offsets: np.ndarray, window: int, by_word: bool) -> Iterator[tuple]:
    """The symbols of a few documents, or of a piece of a long one, with what ``symbols_of`` gives for them.

    Comes with the number of the first document, the symbols before the piece, and the bytes. Pieces of a document overlap
    by a window less one symbol, so each window stands in one of them.
    """
    for a, z in windows.chunks(offsets):
        raw, bounds = data[offsets[a]: offsets[z]], offsets[a: z + 1] - offsets[a]
        if len(raw) <= windows.CHUNK:
            yield a, 0, raw, *symbols_of(raw, bounds, by_word)
            continue
        starts, ends, _ = windows.words(raw, bounds) if by_word else (None, None, None)
        n = len(starts) if by_word else len(raw)
        for base in range(0, n - window + 1, windows.CHUNK):
            last = min(n, base + windows.CHUNK + window - 1)
            size = np.array([0, last - base])
            if by_word:
                piece = raw[starts[base]: ends[last - 1]]
                first_byte, last_byte = starts[base: last] - starts[base], ends[base: last] - starts[base]
                yield a, base, piece, windows.word_hashes(piece, first_byte, last_byte), size, first_byte, last_byte
            else:
                yield a, base, raw[base: last], raw[base: last], size, None, None


def repeated_grams(docs: DataFrame, window: int, gram: int, by_word: bool) -> DataFrame:
    """Hashes of the least grams that stand at two places or more."""
    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            data, offsets = windows.flat(batch.column(0))
            for _, _, _, part, ends, *_ in parts(data, offsets, window, by_word):
                if len(part) >= window:
                    hashes = windows.gram_hashes(part, gram)
                    at = windows.least_gram(hashes, window, gram)[windows.inside(ends, window)]
                    found.append(hashes[at[windows.runs(at)[:-1]]] if len(at) else hashes[:0])
            if found:
                hashes, counts = np.unique(np.concatenate(found), return_counts=True)
                yield pa.record_batch([pa.array(hashes.view(np.int64)), pa.array(counts.astype(np.int64))], ["h", "n"])

    return (docs.select("text").mapInArrow(least, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
            .where("n > 1").select("h"))


def bit_table(hashes: DataFrame) -> np.ndarray:
    """A bit for each hash in a table of bounded size, built in slices by Spark; at most MOST_BITS / 8 bytes."""
    count = hashes.count()
    bits = min(MOST_BITS, 1 << max(20, (16 * count).bit_length()))
    table = np.zeros(bits // 8, np.uint8)
    place = F.col("h").bitwiseAND(bits - 1)

    def one_slice(key, rows):
        marks = np.zeros(SLICE, bool)
        marks[rows.column("p").to_numpy() % SLICE] = True
        packed = np.packbits(marks, bitorder="little").tobytes()
        return pa.table({"slice": pa.array([key[0].as_py()], pa.int64()), "marks": pa.array([packed], pa.binary())})

    slices = (hashes.select(place.alias("p"), F.floor(place / SLICE).alias("slice")).distinct().groupBy("slice")
              .applyInArrow(one_slice, "slice long, marks binary"))
    for slice_, marks in slices.collect():
        start = slice_ * (SLICE // 8)
        table[start: start + len(marks)] = np.frombuffer(marks, np.uint8)
    return table


def marked(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = (hashes & np.uint64(len(table) * 8 - 1)).astype(np.int64)
    return (table[place >> 3] >> (place & 7).astype(np.uint8)) & 1 > 0


def regions(docs: DataFrame, table, window: int, gram: int, key_gram: int, by_word: bool) -> DataFrame:
    """Places of regions: ``key``, ``region`` (a 128-bit hash), ``size``, ``doc_id``, ``row``, ``start``, ``task``.

    ``body`` is there once a task.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, seen, task = table.value, set(), TaskContext.get().partitionId()
        for batch in batches:
            data, offsets = windows.flat(batch.column(2))
            keys, names, docs_, starts, sizes, bodies = [], [], [], [], [], []
            for a, base, raw, part, ends, first_byte, last_byte in parts(data, offsets, window, by_word):
                if len(part) < window:
                    continue
                hashes = windows.gram_hashes(part, gram)
                hit = marked(bits, hashes)[windows.least_gram(hashes, window, gram)]
                at = np.flatnonzero(hit & windows.inside(ends, window))
                if not len(at):
                    continue
                hashes = windows.gram_hashes(part, key_gram)
                least = windows.least_gram(hashes, window, key_gram)[at]
                breaks = np.flatnonzero((np.diff(at) != 1) | (np.diff(least) != 0)) + 1
                first = at[np.concatenate(([0], breaks))]
                last = at[np.concatenate((breaks, [len(at)])) - 1] + window
                doc = np.searchsorted(ends, first, "right") - 1
                keys.append(hashes[least[np.concatenate(([0], breaks))]])
                docs_.append(doc + a)
                starts.append(first - ends[doc] + base)
                sizes.append(last - first)
                body = raw.tobytes()
                if by_word:
                    for x, y in zip(first_byte[first].tolist(), last_byte[last - 1].tolist()):
                        text = b" ".join(body[x:y].split())
                        names.append(hashlib.blake2b(text, digest_size=16).digest())
                        bodies.append(text)
                else:
                    for x, y in zip(first.tolist(), last.tolist()):
                        text = body[x:y]
                        names.append(hashlib.blake2b(text, digest_size=16).digest())
                        bodies.append(text)
            if not names:
                continue
            if len(seen) > REMEMBERED:
                seen.clear()
            for i, name in enumerate(names):
                if name in seen:
                    bodies[i] = None
                else:
                    seen.add(name)
            owner = pa.array(np.concatenate(docs_))
            yield pa.record_batch([
                pa.array(np.concatenate(keys).view(np.int64)), pa.array(names, pa.binary()), batch.column(0).take(owner),
                batch.column(1).take(owner), pa.array(np.concatenate(starts), pa.int32()),
                pa.array(np.concatenate(sizes), pa.int32()), pa.array([task] * len(names), pa.int32()),
                pa.array(bodies, pa.binary()),
            ], ["key", "region", "doc_id", "row", "start", "size", "task", "body"])

    return docs.select("doc_id", "row", "text").mapInArrow(
        cut, "key long, region binary, doc_id long, row long, start int, size int, task int, body binary")


def spans(docs: DataFrame, index: Callable, alone: Column, fields: str, window: int, gram: int, key_gram: int,
          by_word: bool, wanted) -> DataFrame:
    """For each document row with repeated windows: ``doc_id``, ``row`` and its ``spans`` as [start, end) of symbols.

    ``index(rows)`` gets (region, key, count, smallest id, body) of whole keys and gives for each region a list of
    (start, end, ...) with ``fields``. A key with one region needs no index: ``alone`` is its list, from ``n``,
    ``least`` and ``size``. ``wanted`` is the condition under which a place takes such a span.
    """
    spark = docs.sparkSession
    with temporary(spark) as write:
        grams = write(repeated_grams(docs, window, gram, by_word), "grams")
        table = spark.sparkContext.broadcast(bit_table(grams))
        places = write(regions(docs, table, window, gram, key_gram, by_word), "regions")
        distinct = write(places.groupBy("region").agg(
            F.max("key").alias("key"), F.count("*").alias("n"), F.min("doc_id").alias("least"), F.max("size").alias("size"),
            F.min("task").alias("task")), "distinct")
        several = distinct.groupBy("key").agg(F.count("*").alias("of_key"))
        distinct = write(distinct.join(several, "key"), "distinct")
        several = distinct.where("of_key > 1")
        # one task's copy of each body that is compared, found by a bit table before anything is shuffled
        chosen = spark.sparkContext.broadcast(bit_table(several.select(F.xxhash64("region", "task").alias("h"))))

        def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                hit = marked(chosen.value, batch.column(2).to_numpy().view(np.uint64))
                yield batch.select([0, 1]).filter(pa.array(hit))

        bodies = (places.where("body is not null").select("region", "body", F.xxhash64("region", "task").alias("h"))
                  .mapInArrow(pick, "region binary, body binary"))
        rows = several.join(bodies.dropDuplicates(["region"]), "region").select("region", "key", "n", "least", "body")

        def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rows in whole_keys(batches):
                found = index(rows)
                yield pa.record_batch([pa.array([r[0] for r in rows], pa.binary()),
                                       pa.array(found, ARROW_FIELDS[fields])], ["region", "found"])

        kind = f"array<struct<{fields}>>"
        found = rows.repartition("key").sortWithinPartitions("key").mapInArrow(indexed, f"region binary, found {kind}")
        single = distinct.where("of_key = 1").select("region", alone.cast(kind).alias("found"))
        found = found.unionByName(single).where("size(found) > 0")
        return written(places.select("region", "doc_id", "row", "start").join(found, "region")
                .select("doc_id", "row", "start", F.explode("found").alias("f")).where(wanted)
                .select("doc_id", "row", F.struct((F.col("start") + F.col("f.s")).alias("s"),
                                                  (F.col("start") + F.col("f.e")).alias("e")).alias("span"))
                .groupBy("doc_id", "row").agg(F.collect_set("span").alias("spans")), "spans")


_int, _long = pa.int32(), pa.int64()
ARROW_FIELDS = {
    "s: int, e: int": pa.list_(pa.struct([("s", _int), ("e", _int)])),
    "s: int, e: int, m: long": pa.list_(pa.struct([("s", _int), ("e", _int), ("m", _long)])),
}


def whole_keys(batches: Iterator[pa.RecordBatch], most: int = 1 << 20) -> Iterator[list[tuple]]:
    """Rows (region, key, n, least, body) in lists of about ``most`` bytes; a key's rows, sorted by key, stay together."""
    held, size = [], 0
    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(5))):
            if size >= most and row[1] != held[-1][1]:
                yield held
                held, size = [], 0
            held.append(row)
            size += len(row[4])
    if held:
        yield held


def joined_spans(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each row its maximal spans: starts and ends of the union."""
    out = []
    empty = np.zeros(0, np.int64)
    for spans_ in column:
        if not spans_.is_valid:
            out.append((empty, empty))
            continue
        values = spans_.values
        starts, ends = (values.field(i).to_numpy().astype(np.int64) for i in range(2))
        order = np.argsort(starts, kind="stable")
        starts, ends = starts[order], np.maximum.accumulate(ends[order])
        new = np.concatenate(([True], starts[1:] > ends[:-1]))
        last = np.concatenate((np.flatnonzero(new)[1:] - 1, [len(ends) - 1]))
        out.append((starts[new], ends[last]))
    return out


def refined(members: list[tuple[int, int, np.ndarray]], window: int, gram: int, most: int) -> Iterator[list]:
    """Split one key's regions (id, start, symbols) while they hold over ``most`` symbols, by a longer least gram.

    Equal windows share that gram too. A group that no gram up to the window splits is one window, handled as it is.
    """
    if gram > window or len(members) < 2 or sum(len(m[2]) for m in members) <= most:
        yield members
        return
    groups: dict[int, list] = {}
    for owner, start, symbols in members:
        hashes = windows.gram_hashes(symbols, gram)
        at = windows.least_gram(hashes, window, gram)
        cuts = windows.runs(at)
        for a, z in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            groups.setdefault(int(hashes[at[a]]), []).append((owner, start + a, symbols[a: z - 1 + window]))
    for group in groups.values():
        yield from refined(group, window, gram * 2, most)


def split_by_spans(docs: DataFrame, found: DataFrame, columns: tuple[str, ...], hint: str | None = None
                   ) -> tuple[DataFrame, DataFrame]:
    """``columns`` of the rows that have no spans, and ``columns`` and ``spans`` (null: none) of those that may have some.

    ``docs`` has ``doc_id``, ``row`` and ``columns``. Rows are told apart by a bit table over the hashes of the rows with
    spans, of bounded size as above; only rows that may have spans are shuffled. ``hint`` is for their join.
    """
    spark = docs.sparkSession
    table = spark.sparkContext.broadcast(bit_table(found.select(F.col("row").alias("h")).distinct()))

    def flagged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = batch.column(0).to_numpy().view(np.uint64)
            hit = marked(table.value, hashes) if len(hashes) else np.zeros(0, bool)
            yield pa.record_batch([*batch.columns, pa.array(hit)], [*batch.schema.names, "may"])

    rows = docs.select("row", *dict.fromkeys(("doc_id", *columns)))
    rows = rows.mapInArrow(flagged, T.StructType([*rows.schema.fields, T.StructField("may", T.BooleanType())]))
    left, right = rows.where("may").alias("l"), (found.hint(hint) if hint else found).alias("r")
    joined = left.join(right, (F.col("l.row") == F.col("r.row")) & F.col("l.doc_id").eqNullSafe(F.col("r.doc_id")), "left")
    return rows.where("not may").select(*columns), joined.select(*(F.col(f"l.{c}") for c in columns), "r.spans")


def with_spans(docs: DataFrame, found: DataFrame, columns: tuple[str, ...] = ("doc_id", "text")) -> DataFrame:
    """``columns`` and ``spans`` (null: none) of every row, as ``split_by_spans`` tells them apart."""
    without, some = split_by_spans(docs, found, columns)
    return without.withColumn("spans", F.lit(None).cast(found.schema["spans"].dataType)).unionByName(some)


def whole_rows(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` and ``row`` as in ``source``, and ``doc``, a struct of all columns whatever their names."""
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"))
    parts = whole.select("doc", F.col("doc.doc_id").cast("long").alias("doc_id"),
                         F.coalesce("doc.text", F.lit("")).alias("text"))
    return parts.withColumn("row", F.xxhash64("doc_id", "text"))

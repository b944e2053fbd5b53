"""Packing documents into sequences of a fixed number of tokens by best-fit decreasing.

Every document becomes token ids and an end id; only longer ones are cut, into full pieces and a rest. Pieces are dealt
to shards of bounded size by hash; a shard puts the longest piece first, each into the open sequence that it fills best.
A segment tree over the remaining capacities finds it: its leaves are the capacities from 0 to the sequence length, and
a node knows whether an open sequence is below it, so the smallest sufficient capacity takes a walk of its depth.
A shard leaves at most one sequence less than half full, and shards hold many sequences.

Rules: a null text is empty and becomes its end id alone. Equal lengths go in order of id, then text. Repeated rows are
packed each. An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm import passages
from tillstar.llm.scratch import written
from tillstar.llm.tokens import END, word_encoder

LENGTH = 4096
#: Pieces packed by one task; its state is a few numbers a piece.
SHARD = 20_000


class OpenSequences:
    """Open sequences by remaining capacity."""

    def __init__(self, most: int) -> None:
        self.size = 1 << max(1, most.bit_length())
        self.any = bytearray(2 * self.size)
        self.at: dict[int, list[int]] = {}

    def put(self, room: int, sequence: int) -> None:
        self.at.setdefault(room, []).append(sequence)
        node = room + self.size
        while node and not self.any[node]:
            self.any[node] = 1
            node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """Remove and return the sequence with the least room of at least ``need``, and its room."""
        marks, node = self.any, need + self.size
        while not marks[node]:
            while node & 1:  # the last of its branch: go up to one that has a right neighbour
                node >>= 1
                if node <= 1:
                    return None
            node += 1
        while node < self.size:
            node *= 2
            if not marks[node]:
                node += 1
        room = node - self.size
        sequences = self.at[room]
        out = sequences.pop()
        if not sequences:
            while node:
                marks[node] = 0
                node >>= 1
                if node and (marks[2 * node] or marks[2 * node + 1]):
                    break
        return out, room


def best_fit(lengths: list[int], most: int) -> tuple[list[int], list[int], int]:
    """Sequence and offset of each piece, in the order given, and how many sequences there are."""
    open_, used = OpenSequences(most), 0
    sequences, offsets = [], []
    for n in lengths:
        found = open_.take(n) if n < most else None
        if found is None:
            sequence, room = used, most
            used += 1
        else:
            sequence, room = found
        sequences.append(sequence)
        offsets.append(most - room)
        if room > n:
            open_.put(room - n, sequence)
    return sequences, offsets, used


def pieces(docs: DataFrame, tokenizer: str, length: int = LENGTH) -> DataFrame:
    """``doc_id``, ``row``, ``piece``, ``start``, ``length``, ``ids_crc32`` of every document's pieces."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(tokenizer)
        for batch in batches:
            owner, number, sizes, sums = [], [], [], []
            for a in range(0, batch.num_rows, 256):
                for i, ids in enumerate(encoder.encode(batch.column(2).slice(a, 256).to_pylist()), a):
                    ids += END
                    for k, x in enumerate(range(0, len(ids), 4 * length)):
                        part = ids[x: x + 4 * length]
                        owner.append(i)
                        number.append(k)
                        sizes.append(len(part) // 4)
                        sums.append(zlib.crc32(part))
            owner, number = pa.array(owner, pa.int64()), np.array(number, np.int32)
            yield pa.record_batch([
                batch.column(0).take(owner), batch.column(1).take(owner), pa.array(number),
                pa.array(number.astype(np.int64) * length), pa.array(sizes, pa.int64()), pa.array(sums, pa.int64()),
            ], ["doc_id", "row", "piece", "start", "length", "ids_crc32"])

    return passages.source(docs).select("doc_id", "row", "text").mapInArrow(
        cut, "doc_id long, row long, piece int, start long, length long, ids_crc32 long")


def packed(docs: DataFrame, tokenizer: str, length: int = LENGTH, shard: int = SHARD) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``."""
    parts = written(pieces(docs, tokenizer, length), "pieces")
    shards = -(-parts.count() // shard) or 1
    dealt = parts.withColumn("shard", F.pmod(F.xxhash64("doc_id", "row", "piece"), F.lit(shards)))

    def pack(key, rows):
        sequences, offsets, _ = best_fit(rows.column("length").to_pylist(), length)
        first = key[0].as_py() << 32
        return rows.append_column("sequence_id", pa.array([first + s for s in sequences], pa.int64())).append_column(
            "offset", pa.array(offsets, pa.int64()))

    def ordered(key, rows):
        return pack(key, rows.sort_by([("length", "descending"), ("doc_id", "ascending"), ("row", "ascending"),
                                       ("piece", "ascending")]))

    columns = "doc_id long, row long, piece int, start long, length long, ids_crc32 long, shard long"
    return (dealt.groupBy("shard").applyInArrow(ordered, f"{columns}, sequence_id long, offset long")
            .select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"))

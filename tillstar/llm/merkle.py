"""Document fingerprints as Merkle trees over sections, paragraphs and sentences.

A text is its lines; a line is a paragraph of sentences, cut at ". ". The leaves are a few words of a sentence: they end
after a space whose letter before says so, once they have 16 characters, and at the latest after 40, so that a leaf does
not depend on what stands far before it and a kept half of 50 characters holds one. A section ends before a blank line or before a paragraph whose own hash says so (one in eight), so that an
edit moves no distant border. A node's hash covers its children's; the root is the fingerprint and equal roots mean
equal texts. Comparing two trees goes down only into branches whose hashes differ: what remains locates the edit.

The likeness of two trees is twice the characters in shared branches over the characters of both (1 for empty texts).

Rules: a null text is empty. The next document is the one with the next smaller id, then text hash; null ids come last;
after the last comes the first, so a single document is its own next. Repeated rows follow each other. An empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillstar.llm import passages
from tillstar.llm.scratch import written

#: Leaves of 16 to 40 characters: the letters are those whose code point divides by four.
LEAF = re.compile(r".{14,38}?[dhlptx] |.{1,40}", re.DOTALL)
NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next",
         "edit_found_at"]
SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double, edit_found_at long")


class Node(NamedTuple):
    hash: bytes
    size: int
    children: tuple = ()
    level: int = 0


def _digest(kind: bytes, body: bytes) -> bytes:
    return hashlib.blake2b(body, digest_size=16, person=kind).digest()


#: A node's kind goes into its hash; its place in this list is its height.
LEVELS = [b"leaf", b"sent", b"para", b"sect", b"root"]


def _parent(kind: bytes, children: list[Node], extra: int = 0) -> Node:
    return Node(_digest(kind, b"".join([c.hash for c in children])), sum([c.size for c in children]) + extra,
                tuple(children), LEVELS.index(kind))


def tree(text: str) -> Node:
    """The root over sections of paragraphs of sentences. A separator counts to the sentence or line it ends."""
    sections: list[Node] = []
    open_: list[Node] = []
    lines = text.split("\n")
    for i, line in enumerate(lines):
        sentences = []
        parts = line.split(". ")
        for j, part in enumerate(parts):
            leaves = [Node(_digest(b"leaf", leaf.encode()), len(leaf)) for leaf in LEAF.findall(part)]
            sentences.append(_parent(b"sent", leaves, 2 * (j < len(parts) - 1)))
        paragraph = _parent(b"para", sentences, int(i < len(lines) - 1))
        if open_ and (not line or paragraph.hash[0] < 32):
            sections.append(_parent(b"sect", open_))
            open_ = []
        open_.append(paragraph)
    sections.append(_parent(b"sect", open_))
    return _parent(b"root", sections)


def shared(a: Node, b: Node) -> int:
    """Characters of both trees that stand in branches with equal hashes, from the top down."""
    if a.hash == b.hash:
        return a.size + b.size
    left, right, total = list(a.children), list(b.children), 0
    while left and right:
        there = Counter([n.hash for n in right])
        both = Counter([n.hash for n in left]) & there
        if both:
            for nodes in (left, right):
                rest, quota, keep = nodes, both.copy(), []
                for n in rest:
                    if quota.get(n.hash, 0):
                        quota[n.hash] -= 1
                        total += n.size
                    else:
                        keep.append(n)
                nodes[:] = keep
        if not any(n.children for n in left) and not any(n.children for n in right):
            break
        left = [c for n in left for c in (n.children or (n,))]
        right = [c for n in right for c in (n.children or (n,))]
    return total


def likeness(a: Node, b: Node) -> float:
    size = a.size + b.size
    return min(1.0, shared(a, b) / size) if size else 1.0


def first_difference(a: Node, b: Node) -> int | None:
    """Where the first leaf of ``a`` that differs begins; None for equal trees."""
    if a.hash == b.hash:
        return None
    at, left, right = 0, [a], [b]  # what is still ahead, the next node last
    while left and right:
        x, y = left[-1], right[-1]
        if x.hash == y.hash:
            at += x.size
            left.pop()
            right.pop()
            continue
        level = max(x.level, y.level)
        if not level:
            break
        for side, node in ((left, x), (right, y)):
            if node.level == level:
                side.pop()
                side += reversed(node.children)
    return at


def compare(doc_id, text: str, own: Node, next_text: str, next_tree: Node) -> tuple:
    half = len(text) // 2
    edited = text[: len(text) - half] + next_text[:half]
    other = tree(edited)
    return (doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), own.hash.hex(), other.hash.hex(),
            likeness(own, other), likeness(own, next_tree), first_difference(own, other))


def _columns(rows: list[tuple]) -> list[pa.Array]:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64()]
    return [pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)] if rows else [pa.array([], k) for k in kinds]


def fingerprints(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint beside that of an edited copy; see ``compare`` for the edit.

    Documents are dealt by ranges of falling ids and sorted, so neighbours meet in one task. Only the first and last of
    each range, two rows a task, are written with their texts and joined across ranges.
    """
    order = [F.col("doc_id").desc_nulls_last(), F.col("row").asc()]
    rows = passages.source(docs)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = (rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("doc_id", "text")
             .withColumn("part", F.spark_partition_id()))

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, part = None, None
        for batch in batches:
            out, ends = [], []
            for doc_id, text, part in zip(*(batch.column(i).to_pylist() for i in range(3))):
                own = tree(text)
                if last is None:
                    ends.append((doc_id, text))
                else:
                    out.append(compare(*last, text, own))
                last = (doc_id, text, own)
            yield _mixed(out, ends, "first", part)
        if last is not None:
            yield _mixed([], [last[:2]], "last", part)

    def _mixed(out, ends, kind, part) -> pa.RecordBatch:
        done = _columns(out + [(d, *[None] * 7) for d, _ in ends])
        n, m = len(out), len(ends)
        return pa.record_batch([*done, pa.array([None] * n + [kind] * m, pa.string()),
                                pa.array([None] * n + [part] * m, pa.int32()),
                                pa.array([None] * n + [t for _, t in ends], pa.string())],
                               [*NAMES, "kind", "part", "text"])

    found = written(dealt.mapInArrow(pair, f"{SCHEMA}, kind string, part int, text string"), "trees")
    first = found.where("kind = 'first'").select("part", F.col("text").alias("next_text"))
    last = found.where("kind = 'last'").select("part", "doc_id", "text")
    line = Window.orderBy("part")  # one number a task
    ahead = first.select("part", F.lead("part").over(line).alias("next"),
                         F.min("part").over(Window.partitionBy(F.lit(0))).alias("least"))
    ahead = ahead.select("part", F.coalesce("next", "least").alias("next"))
    borders = last.join(ahead, "part").join(first.withColumnRenamed("part", "next"), "next").select(
        "doc_id", "text", "next_text")

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(i).to_pylist() for i in range(3)))
            yield pa.record_batch(_columns([compare(d, t, tree(t), u, tree(u)) for d, t, u in rows]), NAMES)

    return found.where("kind is null").select(NAMES).unionByName(borders.mapInArrow(across, SCHEMA))

"""Phrase collocations from mergeable Misra-Gries summaries, counted exactly in a second pass.

A phrase is two to ``LONGEST`` words that stand next to each other in one piece of a text; pieces end at punctuation and
line ends. Phrases are hashed together with their language and dealt to hash partitions.

1. *Summaries.* Every task counts the hashes of its n-grams and sends each hash partition what it found: a summary that
   lost nothing. A partition's summaries are merged as they arrive. It keeps more counters than its mass divided by the
   threshold; the tasks' masses arrive before their summaries. When there are more hashes than counters, all counters are
   lowered by the greatest that does not fit; each such step takes away at least its size times the number of counters
   plus one, so that all steps together take less than the threshold from any counter, and every n-gram that occurs often
   enough survives. In the mass an entry of a summary weighs the threshold at most: it then has a counter for itself, and
   the others' argument holds without it, so one n-gram with a third of all occurrences costs one counter a summary.
   Words and pairs come first; longer n-grams are summarised only where all their pairs survived, since none of them can
   be frequent without.
2. *Exact counts.* The second pass over the texts counts the survivors, words included, by their text.
3. *Scores.* Each candidate meets the counts of its parts, cut by cut, in joins; whether one word more on either side
   leaves the count as it is decides whether it is dropped; the best of each language are chosen in two levels.

Survivors are looked up in a broadcast bit table of bounded size (two places a hash); hashes it lets through by mistake
are counted and then fail the threshold. Hashes have 64 bits: only within what one task counts at a time are n-grams
told apart by them, across tasks by their text.

Rules: a null text is empty, a null language is ``und``. Repeated rows count each. Ties go to the smallest cut and to the
phrase first in byte order. No word is too long and no text: a text is tokenised with its batch and its n-grams are
formed group by group. Without candidates, or in an empty table, there are no rows. Only ``text`` and ``lang`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillstar.llm import passages, windows
from tillstar.llm.scratch import small_batches, temporary, written

LEAST, LONGEST, BEST = 100, 5, 2000
#: Words whose n-grams are formed at once, and hashes a task counts before it sends them off.
GROUP, HELD = 1 << 18, 1 << 20
#: Counters of a hash partition: its share of the corpus is chosen so that about as many are needed.
COUNTERS = 1 << 20
#: Hashes a row of a summary holds, so that rows stay small.
ROW = 1 << 11
#: Phrases that are held with their texts at once.
PHRASES = 1 << 17
#: The least number of hash partitions.
FEW = 1 << 8
#: Groups among which each language's best are first chosen.
SPREAD = 64
_BREAK, _GAP = np.zeros(256, bool), np.zeros(256, bool)
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_GAP[[0x20, 0x09]] = True


def prepared(docs: DataFrame) -> DataFrame:
    small_batches(docs.sparkSession)
    return docs.select(F.coalesce("lang", F.lit("und")).cast("string").alias("lang"),
                       F.coalesce("text", F.lit("")).alias("text"))


class Group:
    """Words of consecutive texts: where they are in ``data``, their hashes, pieces, and the seeds of their languages."""

    def __init__(self, data, starts, ends, pieces, seeds, new):
        self.data, self.starts, self.ends, self.pieces, self.seeds = data, starts, ends, pieces, seeds
        self.hashes = windows.word_hashes(data, starts, ends)
        self.new = new  # the first word that no group before had: n-grams that end before it are counted already
        self.good = None

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The first words of the n-grams that end in new words, and the n-grams' hashes."""
        if len(self.starts) < n:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        at = np.flatnonzero(self.pieces[: len(self.pieces) - n + 1] == self.pieces[n - 1:])
        at = at[at + n > self.new]
        return at, windows.mix(windows.gram_hashes(self.hashes, n)[at] ^ self.seeds[at] ^ np.uint64(n))


def seed(lang: str) -> np.uint64:
    raw = np.frombuffer(lang.encode(), np.uint8)
    return windows.word_hashes(raw, np.array([0]), np.array([len(raw)]))[0]


def groups(batch: pa.RecordBatch) -> Iterator[Group]:
    """The words of a batch (lang, text) in groups; a group begins with the last words of the one before."""
    data, offsets = windows.flat(batch.column(1))
    data = windows.lower(data)
    solid = ~(_BREAK | _GAP)[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(solid & (~np.concatenate(([False], solid[:-1])) | edge[:-1])) if len(data) else offsets[:0]
    ends = np.flatnonzero(solid & (~np.concatenate((solid[1:], [False])) | edge[1:])) + 1 if len(data) else offsets[:0]
    cuts = _BREAK[data]  # a piece begins after each break and with each text
    cuts[offsets[:-1][np.diff(offsets) > 0]] = True
    pieces = np.cumsum(cuts)[starts] if len(starts) else starts
    known = {}
    per = [known.setdefault(lang, seed(lang)) for lang in batch.column(0).to_pylist()]
    seeds = np.array(per, np.uint64)[np.searchsorted(offsets, starts, "right") - 1] if len(starts) else np.zeros(0, np.uint64)
    for a in range(0, len(starts), GROUP):
        first, last = max(0, a - LONGEST + 1), min(len(starts), a + GROUP)
        low = starts[first]
        some = slice(first, last)
        yield Group(data[low: ends[last - 1]], starts[some] - low, ends[some] - low, pieces[some], seeds[some], a - first)


def counted(hashes: list[np.ndarray], counts: list[np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes in order, and how often each is there, or the sums of their counts."""
    hashes = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    if counts is None:
        hashes.sort()
        runs = windows.runs(hashes)
        return hashes[runs[:-1]], np.diff(runs)
    order = np.argsort(hashes)
    hashes, runs = hashes[order], windows.runs(hashes[order])
    return hashes[runs[:-1]], np.add.reduceat(np.concatenate(counts)[order], runs[:-1]) if len(hashes) else hashes.view(np.int64)


class Summary:
    """Misra-Gries counters of one hash partition, for at most ``room`` hashes; ``lost`` is what each may lack."""

    def __init__(self, mass: int, least: int):
        self.room, self.lost = mass // least + 1, 0
        self.hashes, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.waiting, self.held = [], 0

    def add(self, hashes: np.ndarray, counts: np.ndarray) -> None:
        self.waiting.append((hashes, counts))
        self.held += len(hashes)
        if self.held > max(self.room, ROW):
            self.merge()

    def merge(self) -> None:
        parts = [(self.hashes, self.counts), *self.waiting]
        self.hashes, self.counts = counted([p[0] for p in parts], [p[1] for p in parts])
        self.waiting, self.held = [], 0
        if len(self.counts) > self.room:
            out = int(np.partition(self.counts, len(self.counts) - self.room - 1)[len(self.counts) - self.room - 1])
            left = self.counts > out
            self.hashes, self.counts, self.lost = self.hashes[left], self.counts[left] - out, self.lost + out

    def frequent(self, least: int) -> np.ndarray:
        self.merge()
        return self.hashes[self.counts + self.lost >= least]


def partitions_for(docs: DataFrame, least: int) -> int:
    """How many hash partitions, a power of two, keep about COUNTERS counters each for two n-grams a word."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(FEW, 1 << (size // (least * COUNTERS)).bit_length())


def survivors(docs: DataFrame, lengths: tuple[int, ...], least: int, parts: int, pairs=None) -> DataFrame:
    """Hashes ``h`` of all n-grams of these lengths that occur ``least`` times or more, and of few others.

    ``pairs`` is the bit table of the pairs that survived; n-grams with any other pair are left out.
    """
    shift = np.uint64(65 - parts.bit_length())

    def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mass, held, size = np.zeros(parts, np.int64), [], 0

        def sent():
            hashes, counts = counted([h for h, _ in held], [c for _, c in held])
            cuts = np.searchsorted(hashes >> shift, np.arange(parts + 1, dtype=np.uint64))
            np.add.at(mass, (hashes >> shift).astype(np.int64), np.minimum(counts, least))
            rows = [(p, a, min(a + ROW, z)) for p, (a, z) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist()))
                    for a in range(a, z, ROW)]
            for i in range(0, len(rows), 64):
                some = rows[i: i + 64]
                yield pa.record_batch([
                    pa.array([r[0] for r in some], pa.int32()), pa.array([None] * len(some), pa.int64()),
                    pa.array([hashes[a:z].tobytes() for _, a, z in some], pa.binary()),
                    pa.array([counts[a:z].tobytes() for _, a, z in some], pa.binary())], SUMMARY)

        for batch in batches:
            for group in groups(batch):
                found = []
                for n in lengths:
                    at, hashes = group.grams(n)
                    found.append(hashes if pairs is None else hashes[pairs_survive(group, n, at, pairs.value)])
                held.append(counted(found))
                size += len(held[-1][0])
                if size > HELD:
                    yield from sent()
                    held, size = [], 0
        if size:
            yield from sent()
        there = np.flatnonzero(mass)
        yield pa.record_batch([
            pa.array(there, pa.int32()), pa.array(mass[there], pa.int64()),
            pa.array([None] * len(there), pa.binary()), pa.array([None] * len(there), pa.binary())], SUMMARY)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summary, part, mass = None, None, 0

        def result():
            hashes = summary.frequent(least) if summary else np.zeros(0, np.uint64)
            second = windows.mix(hashes ^ _SECOND)
            return pa.record_batch([pa.array(hashes.view(np.int64)), pa.array(second.view(np.int64))], ["h", "g"])

        for batch in batches:
            for p, m, h, c in zip(*(batch.column(i) for i in range(4))):
                if p.as_py() != part:
                    if part is not None:
                        yield result()
                    summary, part, mass = None, p.as_py(), 0
                if m.is_valid:  # the partition's masses stand before its summaries
                    mass += m.as_py()
                    continue
                summary = summary or Summary(mass, least)
                summary.add(np.frombuffer(h.as_buffer(), np.uint64), np.frombuffer(c.as_buffer(), np.int64))
        if part is not None:
            yield result()

    rows = docs.mapInArrow(summaries, "part int, mass long, hashes binary, counts binary")
    rows = dealt(rows, parts).sortWithinPartitions("part", F.col("mass").isNull())
    return rows.mapInArrow(merged, "h long, g long")


SUMMARY, COUNTS = ["part", "mass", "hashes", "counts"], ["lang", "phrase", "words", "n"]
_SECOND = np.uint64(0x9E3779B97F4A7C15)


def bit_table(found: DataFrame) -> np.ndarray:
    return passages.bit_table(found.select(F.explode(F.array("h", "g")).alias("h")))


def marked(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    out = passages.marked(table, hashes)
    out[out] = passages.marked(table, windows.mix(hashes[out] ^ _SECOND))
    return out


def pairs_survive(group: Group, n: int, at: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Of the n-grams at ``at``, those whose pairs of neighbours are all in the table."""
    if group.good is None:  # how many pairs before each word survived
        pairs = windows.mix(windows.gram_hashes(group.hashes, 2) ^ group.seeds[:-1] ^ np.uint64(2))
        group.good = np.concatenate(([0], np.cumsum(marked(table, pairs))))
    return group.good[at + n - 1] - group.good[at] == n - 1


def exact_counts(docs: DataFrame, table, least: int, parts: int) -> DataFrame:
    """``lang``, ``phrase``, ``words`` (its length) and ``n`` of every n-gram that occurs ``least`` times or more.

    The row of a language with length 0 has the number of all its words. A task adds up what it finds and sends each hash
    partition lists of phrases and counts, which are added up there by text.
    """
    shift = np.uint64(65 - parts.bit_length())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list] = {}  # by hash: lang, phrase, words, n
        for batch in batches:
            names = {int(seed(lang)): lang for lang in set(batch.column(0).to_pylist())}
            for group in groups(batch):
                for s, n in zip(*(x.tolist() for x in np.unique(group.seeds[group.new:], return_counts=True))):
                    found.setdefault(s, [names[s], "", 0, 0])[3] += n
                for n in range(1, LONGEST + 1):
                    at, hashes = group.grams(n)
                    hit = marked(table.value, hashes)
                    if n > 2:  # as in the summaries: without surviving pairs nothing longer is frequent
                        hit[hit] = pairs_survive(group, n, at[hit], table.value)
                    at, hashes = at[hit], hashes[hit]
                    order = np.argsort(hashes, kind="stable")
                    runs = windows.runs(hashes[order])
                    first = at[order[runs[:-1]]]
                    for h, i, more in zip(hashes[order[runs[:-1]]].tolist(), first.tolist(), np.diff(runs).tolist()):
                        if h in found:
                            found[h][3] += more
                        else:
                            text = group.data[group.starts[i]: group.ends[i + n - 1]].tobytes()
                            text = b" ".join(text.split()) if n > 1 else text
                            found[h] = [names[int(group.seeds[i])], text.decode(), n, more]
                if len(found) > PHRASES:
                    yield from lists(found)
                    found = {}
        yield from lists(found)

    def lists(found: dict[int, list]) -> Iterator[pa.RecordBatch]:
        hashes = np.array(sorted(found), np.uint64)
        ends = np.searchsorted(hashes >> shift, np.arange(1, parts + 1, dtype=np.uint64))
        starts = np.concatenate(([0], ends[:-1]))
        some = np.flatnonzero(ends > starts)
        if not len(some):
            return
        columns = list(zip(*(found[h] for h in hashes.tolist())))
        offsets = pa.array(np.concatenate((starts[some], ends[-1:])), pa.int32())
        kinds = (pa.string(), pa.string(), pa.int32(), pa.int64())
        yield pa.record_batch([pa.array(some, pa.int32()), *(
            pa.ListArray.from_arrays(offsets, pa.array(c, k)) for c, k in zip(columns, kinds))], ["part", *COUNTS])

    def added(held: list[pa.Table]) -> pa.Table:
        total = pa.concat_tables(held).group_by(COUNTS[:3]).aggregate([("n", "sum")])
        return total.select([*COUNTS[:3], "n_sum"]).rename_columns(COUNTS)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, size, limit = None, [], 0, PHRASES
        for batch in batches:
            for row, p in enumerate(batch.column("part").to_pylist()):
                if p != part and held:
                    yield from added(held).to_batches()
                    held, size, limit = [], 0, PHRASES
                part = p
                held.append(pa.table([batch.column(c)[row].values for c in COUNTS], COUNTS))
                size += held[-1].num_rows
                if size > limit:
                    held = [added(held)]
                    size, limit = held[0].num_rows, held[0].num_rows + PHRASES
        if held:
            yield from added(held).to_batches()

    rows = docs.mapInArrow(count, "part int, lang array<string>, phrase array<string>, words array<int>, n array<long>")
    return (dealt(rows, parts).sortWithinPartitions("part").mapInArrow(merged, "lang string, phrase string, words int, n long")
            .filter((F.col("n") >= least) | (F.col("words") == 0)))


def dealt(rows: DataFrame, parts: int) -> DataFrame:
    """Rows by hash partition: a task each, unless there are so few that Spark may put several into one task."""
    return rows.repartition("part") if parts <= FEW else rows.repartition(parts, "part")


def frequent_phrases(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """Exact counts of all n-grams up to LONGEST words that occur ``least`` times or more in a language, and its words."""
    spark = docs.sparkSession
    docs = prepared(docs)
    parts = partitions_for(docs, least)
    with temporary(spark) as write:
        short = write(survivors(docs, (1, 2), least, parts), "short")
        pairs = spark.sparkContext.broadcast(bit_table(short))
        longer = write(survivors(docs, tuple(range(3, LONGEST + 1)), least, parts, pairs), "long")
        table = spark.sparkContext.broadcast(bit_table(short.unionByName(longer)))
        return written(exact_counts(docs, table, least, parts), "phrases")


def scored(phrases: DataFrame) -> DataFrame:
    """Every candidate ``phrase`` with ``a``, and ``l``, ``r``, ``n`` and ``score`` of its cut with the lowest score."""
    totals = written(phrases.filter("words = 0").select("lang", F.col("n").alias("total")), "totals")
    counts = phrases.filter("words > 0").select("lang", "phrase", "n")
    tokens = F.split("phrase", " ")
    cuts = phrases.filter("words > 1").select(
        "lang", "phrase", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"), tokens.alias("t"))
    cuts = cuts.select("lang", "phrase", "a", "k", F.array_join(F.slice("t", F.lit(1), F.col("k")), " ").alias("first"),
                       F.array_join(F.slice("t", F.col("k") + 1, F.size("t") - F.col("k")), " ").alias("rest"))
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l")), ["lang", "first"])
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r")), ["lang", "rest"])
    cuts = cuts.join(totals, "lang")
    wide = {c: F.col(c).cast("decimal(38,0)") for c in ("a", "total", "l", "r")}
    score = F.call_function("div", F.lit(1000).cast("decimal(4,0)") * wide["a"] * wide["total"], wide["l"] * wide["r"])
    least = F.min(F.struct(score.alias("score"), "k", "l", "r", F.col("total").alias("n"))).alias("cut")
    return cuts.groupBy("lang", "phrase", "a").agg(least).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.n", "cut.score")


def longer_counts(phrases: DataFrame) -> DataFrame:
    """``lang``, ``phrase`` and ``longer``, the greatest count of a phrase with one word more.

    That is enough: whatever holds a phrase also holds it with one more word, which occurs at least as often.
    """
    parts = phrases.filter("words > 2").select("lang", "n", F.split("phrase", " ").alias("t"), (F.col("words") - 1).alias("w"))
    inner = F.array(F.array_join(F.slice("t", F.lit(1), F.col("w")), " "), F.array_join(F.slice("t", F.lit(2), F.col("w")), " "))
    return (parts.select("lang", "n", F.explode(inner).alias("phrase")).groupBy("lang", "phrase")
            .agg(F.max("n").alias("longer")))


def collocations(docs: DataFrame, least: int = LEAST, share: int = 100, best: int = BEST) -> DataFrame:
    """The ``best`` phrases of each language: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n`` and ``score``.

    A phrase inside a longer one that has ``share`` percent of its count or more is dropped.
    """
    phrases = frequent_phrases(docs, least)
    rows = scored(phrases).join(longer_counts(phrases), ["lang", "phrase"], "left")
    rows = rows.filter(F.col("longer").isNull() | (100 * F.col("longer") < share * F.col("a")))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    rows = rows.withColumn("spread", F.pmod(F.xxhash64("phrase"), F.lit(SPREAD)))
    for keys in (["lang", "spread"], ["lang"]):
        rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
        rows = rows.filter(F.col("rank") <= best)
    return rows.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")

"""Mixing sources to target weights by capped water-filling, with seeded whole and fractional repetitions.

Sources, in code point order and null last, get weights in turn and share a budget of words by them. A source whose share
passes ``epochs`` times its own words stops there, and what it leaves is shared again by weight among the others until
none is above: the level of words a unit of weight rises from round to round, and each round is one sum over the table of
sources. A source's documents are then all taken as often as its target holds them whole; the rest of the target is one
more repetition of a part of them: the documents with the least seeded hashes of their ids that fit into it, and as many
words of the next one as fill it. The taken words of a source are thus its target, rounded down.

Everything is DataFrame functions. A source is summed before it is shuffled, and the place where its last repetition ends
is found by sums over 4,096 ranges of the hash, then over 4,096 parts of the range in question, then over the hashes in
that part, so that no source's documents meet in one task.

Rules: a null text has no words; a null source is a source; a null id hashes like an empty text. Rows with one id (repeated
rows) share the words left for it by their sizes, each rounded down. A source without words has target 0. Where the
budget passes what all sources may give, each gives its cap. Other columns are not read by ``plan`` and kept by
``sample``, whatever their names. An empty table gives an empty result. Arithmetic is exact up to 10^17 words in all.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstar.llm.scratch import written
from tillstar.operators.ranks import numbered

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
PERCENT, EPOCHS, SEED = 150, 2, 0
#: Bits of a hash, and of the ranges and the parts of ranges by which the end of a repetition is found.
HASH, RANGE = 60, 12
_WIDE = "decimal(38,0)"


def order_hash(doc_id: Column, seed: int) -> Column:
    """60 bits of the MD5 of seed and id: the order in which a source's documents get one more repetition."""
    text = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))))
    return F.conv(F.substring(text, 1, HASH // 4), 16, 10).cast("long")


def sized(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """``doc_id``, ``source``, ``size`` and ``hash`` of every row; the only step that reads the texts."""
    words = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                       words.cast("long").alias("size"), order_hash(F.col("doc_id").cast("long"), seed).alias("hash"))


def level(sources: DataFrame, percent: int, epochs: int) -> tuple[int, int]:
    """The water level in words a unit of weight, as a fraction: the share that sources below their cap have.

    Each round clamps the sources that the level of the round before puts at or above their cap.
    """
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    cap = (F.col("source_size") * epochs).cast(_WIDE)
    words, weight = 0, None
    while True:
        if weight is None:
            clamped = F.lit(False)
        else:
            clamped = F.col("weight") * wide(percent * total - 100 * words) >= cap * wide(100 * weight)
        sums = sources.groupBy(clamped.alias("clamped")).agg(F.sum(cap).alias("words"), F.sum("weight").alias("weight"))
        found = {row["clamped"]: row for row in sums.collect()}
        above, below = found.get(True), found.get(False)
        step = int(above["words"]) if above else 0, int(below["weight"]) if below else 0
        if step == (words, weight):
            return percent * total - 100 * words, 100 * weight
        words, weight = step


def wide(number: int) -> Column:
    return F.lit(Decimal(number)).cast(_WIDE)


def targets(rows: DataFrame, weights: Sequence[int], percent: int, epochs: int) -> DataFrame:
    """Of every source: its size, weight and target, the words to take, whole repetitions and what the last one holds."""
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = written(numbered(sources, [F.col("source").asc_nulls_last()], "place"), "sources")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    sources = sources.withColumn("weight", weight.cast(_WIDE))
    words, unit = level(sources, percent, epochs)
    share, cap = F.col("weight") * wide(words), F.col("source_size") * epochs
    clamped = F.lit(True) if unit == 0 else share >= cap.cast(_WIDE) * wide(unit)
    # a clamped share may not fit a long, nor need a unit that is not 0: only open sources divide
    out = sources.select(
        "source", "source_size",
        F.when(clamped, cap.cast("double")).otherwise(share.cast("double") / wide(unit or 1).cast("double")).alias("target"),
        F.when(clamped, cap).otherwise(F.call_function("div", share, wide(unit or 1))).alias("wanted"))
    whole = F.when(F.col("source_size") > 0, F.call_function("div", F.col("wanted"), F.col("source_size"))).otherwise(0)
    out = out.withColumn("whole", whole)
    return out.withColumn("extra", F.col("wanted") - F.col("whole") * F.col("source_size"))


def _cut(sums: DataFrame, left: str, by: str) -> DataFrame:
    """The first ``by`` of each source whose words, with those before it, pass ``left``; what is left when it begins."""
    running = Window.partitionBy("source").orderBy(by).rowsBetween(Window.unboundedPreceding, 0)
    rows = sums.withColumn("after", F.sum("words").over(running))
    rows = rows.withColumn("rest_", F.col(left) - (F.col("after") - F.col("words")))
    rows = rows.filter((F.col("after") > F.col(left)) & (F.col("rest_") >= 0))
    return rows.select("source", by, F.col("rest_").alias("rest"), "words")


def ends(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """``sources`` with the hash at which the last repetition ends, the words left for it and the words it has."""
    first, second = F.shiftright("hash", HASH - RANGE), F.shiftright("hash", HASH - 2 * RANGE)
    open_ = sources.filter("extra > 0").select("source", "extra")
    sums = rows.groupBy("source", first.alias("range")).agg(F.sum("size").alias("words"))
    found = _cut(_of(sums, open_), "extra", "range")
    inner = rows.select("source", "size", "hash", first.alias("range"))
    sums = _of(inner, found.drop("words"), "range").groupBy("source", "rest", second.alias("part")).agg(
        F.sum("size").alias("words"))
    found = _cut(sums, "rest", "part")
    inner = rows.select("source", "size", "hash", second.alias("part"))
    sums = _of(inner, found.drop("words"), "part").groupBy("source", "rest", "hash").agg(F.sum("size").alias("words"))
    found = _cut(sums, "rest", "hash").withColumnRenamed("hash", "end").withColumnRenamed("words", "end_words")
    return _of(sources, found, how="left")


def _of(rows: DataFrame, few: DataFrame, *more: str, how: str = "inner") -> DataFrame:
    """A join on ``source``, null matching null, and on ``more``; the columns of both without repeats."""
    left, right = rows.alias("l"), few.alias("r")
    on = F.col("l.source").eqNullSafe(F.col("r.source"))
    for name in more:
        on = on & (F.col(f"l.{name}") == F.col(f"r.{name}"))
    added = [F.col(f"r.{c}") for c in few.columns if c not in ("source", *more)]
    return left.join(right, on, how).select("l.*", *added)


def extra_words(size: Column, hash_: Column) -> Column:
    """The words that the last repetition takes of a document: all, none, or at its end its part of what is left."""
    at_end = F.call_function("div", F.col("rest").cast(_WIDE) * size, F.col("end_words").cast(_WIDE))
    return (F.when(F.col("end").isNull() | (hash_ > F.col("end")), F.lit(0))
            .when(hash_ < F.col("end"), size).otherwise(at_end).cast("long"))


def _planned(docs: DataFrame, weights: Sequence[int], percent: int, epochs: int, seed: int) -> tuple[DataFrame, DataFrame]:
    rows = written(sized(docs, seed), "sizes")
    return rows, written(ends(rows, written(targets(rows, weights, percent, epochs), "targets")), "targets")


def plan(docs: DataFrame, weights: Sequence[int] = WEIGHTS, percent: int = PERCENT, epochs: int = EPOCHS,
         seed: int = SEED) -> DataFrame:
    """``doc_id``, ``size``, ``source_size``, ``target`` and ``taken`` of every row of ``docs`` (doc_id, source, text).

    ``percent`` of all words are shared; no document is taken more than ``epochs`` times.
    """
    rows, sources = _planned(docs, weights, percent, epochs, seed)
    taken = F.col("whole") * F.col("size") + extra_words(F.col("size"), F.col("hash"))
    return _of(rows, sources).select("doc_id", "size", "source_size", "target", taken.alias("taken"))


def sample(docs: DataFrame, weights: Sequence[int] = WEIGHTS, percent: int = PERCENT, epochs: int = EPOCHS,
           seed: int = SEED) -> DataFrame:
    """The mix itself: ``doc``, a struct of a row's columns, once for each ``copy`` (from 0), with the ``text`` it gives.

    The copy at the end of a source's last repetition has only the document's first words, joined by spaces.
    """
    _, sources = _planned(docs, weights, percent, epochs, seed)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    rows = rows.select("doc", F.col("doc.source").cast("string").alias("source"), F.col("doc.text").alias("text"),
                       order_hash(F.col("doc.doc_id").cast("long"), seed).alias("hash"))
    rows = rows.withColumn("size", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long"))
    rows = _of(rows, sources).withColumn("last", extra_words(F.col("size"), F.col("hash")))
    copies = F.col("whole") + F.when(F.col("last") > 0, 1).otherwise(0)
    rows = rows.filter(copies > 0).withColumn("copy", F.explode(F.sequence(F.lit(0), (copies - 1).cast("int"))))
    cut = (F.col("copy") == F.col("whole")) & (F.col("last") < F.col("size"))
    head = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), 1, F.col("last").cast("int")), " ")
    return rows.select("doc", "copy", F.when(cut, head).otherwise(F.col("text")).alias("text"))

"""Documents whose sets of word n-grams are alike, with several global orders of the n-grams as filters.

Under any one order, two sets with a Jaccard similarity of ``t`` must share one of the first ``n - ceil(t * n) + 1``
n-grams of each. All orders put frequent n-grams last (counted over all documents in a sketch of fixed size) and differ
in how they permute the rest, so a pair must share a prefix n-gram under each of them.

1. One scan writes, for each document, its set's hash, size, prefix under the first order, short codes of the prefixes
   under the other orders, and counts by class of n-gram. Equal sets are one node from here on.
2. Nodes that share a prefix n-gram are paired with one node of it only, another one in each of a few rounds. In the last
   one, where many share it, that is the nearest node of another component by the counts: a node that few of a dense
   group link with meets one of those. Pairs that pass the filters are verified on the texts; links give components.
3. N-grams whose nodes are still in several components are looked at again: there, and only there, all pairs across
   components are filtered, in blocks of bounded size, and verified. In a dense group of near copies nearly all nodes
   are in one component by then, so its pairs are never listed; no link between components is lost.

Rules: texts are lower-cased in A-Z only; words are ``[^\\x20\\x09-\\x0D]+``. A text with fewer words than ``n`` has
one n-gram, all its words; a null, empty or blank text has none and links with nothing. Rows are told apart by id and
text; repeated ids are documents of their own, equal texts link. A null id is never a component's smallest one unless
there is no other. An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm import passages, windows
from tillstar.llm.components import components
from tillstar.llm.scratch import cleaned, hash_joins, small_batches, temporary, written
from tillstar.llm.sums import added

GRAM, PERCENT = 4, 85
SKETCH = 1 << 20
SKETCH_SLICE = 1 << 14
#: Classes of n-grams whose counts bound how much two sets differ.
CLASSES = 256
#: Rounds of comparing nodes with one node of each n-gram, another each time, before pairs are formed.
ROUNDS = 3
#: Seeds of the orders; the first one finds the pairs, the others filter them.
ORDERS = (0x1B873593, 0x5BD1E995, 0x27D4EB2F)
#: Rows of an Arrow batch: a pair that is verified brings two whole texts.
ROWS = 256
#: Nodes of an n-gram above which each is paired with its nearest one; up to it all pairs are few.
FEW = 32
#: N-grams with the same smallest label in which a node looks for its nearest one.
ASKS = 4
#: Nodes of an n-gram that are compared in one block.
BLOCK = 2000
#: Pairs a task holds to pass repeats on once; where over half are distinct they go on at once.
PASSED = 1 << 18


def gram_sets(texts: pa.Array, gram: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its n-grams."""
    data, offsets = windows.flat(texts)
    data = windows.lower(data)
    for a, z in windows.chunks(offsets):
        part = data[offsets[a]: offsets[z]]
        starts, ends, per = windows.words(part, offsets[a: z + 1] - offsets[a])
        symbols = windows.word_hashes(part, starts, ends)
        hashes = windows.gram_hashes(symbols, gram)
        for x, y in zip(per[:-1].tolist(), per[1:].tolist()):
            if y - x >= gram:
                found = hashes[x: y - gram + 1]
                yield np.unique(found)
            elif y > x:  # fewer words: all of them, salted by their number
                yield windows.mix(windows.gram_hashes(symbols[x:y], y - x) + np.uint64(y - x))
            else:
                yield hashes[:0]


def sketch(docs: DataFrame, gram: int) -> np.ndarray:
    """In how many documents the n-grams of each cell occur, as a power of two; 1 MB whatever the input."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(SKETCH, np.int64)
        for batch in batches:
            for found in gram_sets(batch.column(0), gram):
                np.add.at(cells, (found & np.uint64(SKETCH - 1)).astype(np.int64), 1)
        if cells.any():
            parts = [x.tobytes() for x in cells.reshape(-1, SKETCH_SLICE)]
            yield pa.record_batch([pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.binary())], ["slice", "sums"])

    levels = np.zeros(SKETCH, np.uint8)
    with cleaned(docs.sparkSession):  # a table of counts a task, twice: they would lie on disk until the join ends
        totals = added(docs.select("text").mapInArrow(count, "slice int, sums binary"), np.int64)
    for slice_, total in totals.items():
        part = np.log2(np.maximum(total, 1)).astype(np.uint8)
        levels[slice_ * SKETCH_SLICE: (slice_ + 1) * SKETCH_SLICE] = part
    return levels


def prefix_length(n: int, percent: int) -> int:
    return n - (percent * n + 99) // 100 + 1


def prefixes(found: np.ndarray, levels: np.ndarray, percent: int) -> list[np.ndarray]:
    """The first n-grams of a set under each order."""
    n = prefix_length(len(found), percent)
    rarity = levels[(found & np.uint64(SKETCH - 1)).astype(np.int64)].astype(np.uint64) << np.uint64(56)
    out = []
    for seed in ORDERS:
        rank = (windows.mix(found ^ np.uint64(seed)) >> np.uint64(8)) | rarity
        out.append(found[np.argpartition(rank, n - 1)[:n]] if n < len(found) else found)
    return out


def described(docs: DataFrame, levels, gram: int, percent: int) -> DataFrame:
    """One row a document: ``doc_id``, ``row``, ``node``, ``n``, ``prefix``, ``codes``, ``counts``."""
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            nodes, sizes, prefix, codes, counts = [], [], [], [], []
            for found in gram_sets(batch.column(2), gram):
                sizes.append(len(found))
                if not len(found):
                    for column in (nodes, prefix, codes, counts):
                        column.append(None)
                    continue
                node = int.from_bytes(hashlib.blake2b(found.tobytes(), digest_size=8).digest(), "little", signed=True)
                nodes.append(node)
                if node in seen:  # a copy: its node is described already
                    for column in (prefix, codes, counts):
                        column.append(None)
                    continue
                if len(seen) > passages.REMEMBERED:
                    seen.clear()
                seen.add(node)
                first, *others = prefixes(found, levels.value, percent)
                prefix.append(first.view(np.int64))
                codes.append(np.concatenate([np.unique(o & np.uint64(0x3FFF)).astype(np.int16) + (i << 14)
                                             for i, o in enumerate(others)]))
                per = np.bincount((found >> np.uint64(40)).astype(np.int64) % CLASSES, minlength=CLASSES)
                counts.append(np.minimum(per, 255).astype(np.uint8).tobytes())
            yield pa.record_batch([
                batch.column(0), batch.column(1), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()),
                pa.array(prefix, pa.list_(pa.int64())), pa.array(codes, pa.list_(pa.int16())), pa.array(counts, pa.binary()),
            ], ["doc_id", "row", "node", "n", "prefix", "codes", "counts"])

    return docs.select("doc_id", "row", "text").mapInArrow(
        describe, "doc_id long, row long, node long, n long, prefix array<long>, codes array<short>, counts binary")


def _orders_agree(x: str, y: str):
    """Whether two nodes' codes meet under every other order: codes of an order lie in a range of their own."""
    shared = F.array_intersect(x, y)
    return F.exists(shared, lambda c: c < 1 << 14) & F.exists(shared, lambda c: c >= 1 << 14)


def sized(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sizes leave them a chance, with ``na`` and ``nb``: a pair that goes on takes half a kilobyte a node."""
    x, y = (nodes.select(F.col("node").alias(side), F.col("n").alias(f"n{side}")) for side in "ab")
    return pairs.join(x, "a").join(y, "b").where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")).select(
        "a", "b", "na", "nb")


def verified(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, gram: int, percent: int) -> DataFrame:
    """Of the pairs (``a``, ``b``, ``na``, ``nb``) those that pass every filter and then, on the texts, the similarity itself."""
    def chance(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = (batch.column(i).to_numpy() for i in (2, 3))
            keep = may_link(unpacked(batch.column(4)), unpacked(batch.column(5)), n, m, percent)
            yield batch.select([0, 1, 6, 7]).filter(pa.array(keep))

    spark = docs.sparkSession
    x = nodes.select(F.col("node").alias("a"), F.col("codes").alias("ca"), F.col("counts").alias("xa"))
    y = nodes.select(F.col("node").alias("b"), F.col("codes").alias("cb"), F.col("counts").alias("xb"))
    with temporary(spark) as write:
        pairs = write(pairs.join(x, "a").join(y, "b").select("a", "b", "na", "nb", "xa", "xb", "ca", "cb")
                      .mapInArrow(chance, "a long, b long, ca array<short>, cb array<short>")
                      .where(_orders_agree("ca", "cb")).select("a", "b"), "pairs")
        wanted = pairs.select("a").unionByName(pairs.select(F.col("b").alias("a"))).distinct().withColumnRenamed("a", "node")
        # the text of one document of each wanted node; only documents that may be wanted are shuffled
        places = write(nodes.join(wanted, "node").select("node", "doc_id", "row"), "places")
        table = spark.sparkContext.broadcast(passages.bit_table(places.select(F.col("row").alias("h")).distinct()))

        def may(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                hit = passages.marked(table.value, batch.column(1).to_numpy().view(np.uint64))
                yield batch.filter(pa.array(hit))

        texts = (docs.select("doc_id", "row", "text").mapInArrow(may, "doc_id long, row long, text string").alias("t")
                 .join(places.alias("p"), (F.col("t.row") == F.col("p.row")) & F.col("t.doc_id").eqNullSafe(F.col("p.doc_id")))
                 .select("p.node", "t.text").dropDuplicates(["node"]))
        texts = write(texts, "texts")

        def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                left, right = (list(gram_sets(batch.column(i), gram)) for i in (2, 3))
                keep = []
                for u, v in zip(left, right):
                    common = len(np.intersect1d(u, v, assume_unique=True))
                    keep.append(100 * common >= percent * (len(u) + len(v) - common))
                yield pa.record_batch(batch.columns[:2], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

        both = (pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a")
                .join(texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b"))
        return written(both.select("a", "b", "ta", "tb").mapInArrow(check, "a long, b long"), "links")


def unpacked(counts) -> np.ndarray:
    return np.frombuffer(b"".join(counts.to_pylist()), np.uint8).reshape(-1, CLASSES).astype(np.int16)


def may_link(x: np.ndarray, y: np.ndarray, n, m, percent: int) -> np.ndarray:
    """Whether the sizes and counts by class leave two sets a chance.

    Sets with similarity t differ in at most (1 - t) / (1 + t) of their sizes' sum, and at least by their counts.
    """
    near = 100 * np.minimum(n, m) >= percent * np.maximum(n, m)
    near[near] = (100 + percent) * np.abs(y[near] - (x[near] if x.ndim > 1 else x)).sum(1) <= (
        100 - percent) * (n + m)[near]
    return near


def across(members: DataFrame, percent: int, nearest: bool = False) -> DataFrame:
    """Pairs of nodes of one n-gram in different components whose sizes and counts leave them a chance.

    ``members``: ``gram``, ``node``, ``label``, ``n``, ``counts``, ``total`` (nodes of the n-gram) and ``x`` (the smallest
    label among them). An n-gram with over BLOCK nodes is dealt to tasks as pairs of blocks. N-grams with the same ``x``
    mostly have the same nodes, so they are looked at one after another and a pair is mostly passed on once. With
    ``nearest``, of each node's pairs in its own block only the one whose counts differ least, in ASKS of those n-grams.
    """
    blocks = F.ceil(F.col("total") / BLOCK)
    own = F.pmod(F.xxhash64("node"), blocks)
    others = F.array("own") if nearest else F.sequence(F.lit(0).cast("long"), blocks - 1)
    dealt = (members.withColumn("own", own)
             .withColumn("other", F.explode(others))
             .select("gram", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "x", "own",
                     "node", "label", "n", "counts"))

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        asked, least = Counter() if nearest else None, None
        for group in _groups(batches):
            if nearest and (least != group.column("x")[0] or len(asked) > passages.REMEMBERED):
                asked.clear()
                least = group.column("x")[0]
            a, b = _chances(group, percent, asked)
            if len(a):
                held.append(np.stack([np.minimum(a, b), np.maximum(a, b)]))
                size += len(a)
            if size > PASSED:
                held = [_distinct(held)]
                size = held[0].shape[1]
                if size > PASSED // 2:
                    yield pa.record_batch([pa.array(held[0][0]), pa.array(held[0][1])], ["a", "b"])
                    held, size = [], 0
        if held:
            a, b = _distinct(held)
            yield pa.record_batch([pa.array(a), pa.array(b)], ["a", "b"])

    return (dealt.repartition("x", "i", "j").sortWithinPartitions("x", "i", "j", "gram")
            .mapInArrow(pairs, "a long, b long").distinct())


def _distinct(pairs: list[np.ndarray]) -> np.ndarray:
    """Pairs, a column each, without repeats."""
    found = np.concatenate(pairs, 1)
    found = found[:, np.lexsort(found)]
    new = np.ones(found.shape[1], bool)
    new[1:] = (found[:, 1:] != found[:, :-1]).any(0)
    return found[:, new]


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each (gram, i, j), which come one after another."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        keys = np.stack([batch.column(k).to_numpy() for k in range(3)])
        cuts = np.concatenate(([0], np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1, [batch.num_rows]))
        for a, z in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            part = batch.slice(a, z - a)
            if held and any(held[0].column(k)[0] != part.column(k)[0] for k in range(3)):
                yield pa.Table.from_batches(held)
                held = []
            held.append(part)
    if held:
        yield pa.Table.from_batches(held)


def _chances(group: pa.Table, percent: int, asked: Counter | None) -> tuple[np.ndarray, np.ndarray]:
    i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
    own, node, label, n = (group.column(c).to_numpy() for c in ("own", "node", "label", "n"))
    found_a, found_b = [node[:0]], [node[:0]]
    left, right = (np.flatnonzero(own == k) for k in (i, j))
    nearest = asked is not None
    if nearest:
        asked.update(node.tolist())
        left = np.array([x for x in left.tolist() if asked[int(node[x])] <= ASKS], np.int64)
        if not len(left):
            return node[:0], node[:0]
    counts = unpacked(group.column("counts"))
    for x in left.tolist():
        y = right[right > x] if i == j and not nearest else right
        y = y[label[y] != label[x]]
        y = y[may_link(counts[x], counts[y], n[x], n[y], percent)]
        if nearest and len(y):  # ties: the smallest node, the same one for every n-gram
            differ = np.abs(counts[y] - counts[x]).sum(1)
            y = y[[np.lexsort((node[y], differ))[0]]]
        found_a.append(np.full(len(y), node[x]))
        found_b.append(node[y])
    return np.concatenate(found_a), np.concatenate(found_b)


def linked(docs: DataFrame, gram: int = GRAM, percent: int = PERCENT) -> DataFrame:
    """``doc_id``, ``row``, ``n_shingles``, ``label`` (its component; null: no words), ``component_id``."""
    docs = passages.source(docs)
    spark = docs.sparkSession
    small_batches(spark, ROWS)
    levels = spark.sparkContext.broadcast(sketch(docs, gram))
    with hash_joins(spark), temporary(spark) as write:
        sets = write(described(docs, levels, gram, percent), "sets")
        rows = written(sets.select("doc_id", "row", "node", "n"), "rows")
        described_ = sets.where("prefix is not null")
        # tasks describe a node once each; one of their rows is enough, and they agree but for the place
        nodes = write(described_.select("node", "n", "codes", "counts", "doc_id", "row").dropDuplicates(["node"]), "nodes")
        labels = _labels(docs, described_, nodes, gram, percent, write)
    out = rows.join(labels, "node", "left").select(
        "doc_id", "row", F.col("n").alias("n_shingles"), F.coalesce("label", "node").alias("label"))
    least = out.where("label is not null").groupBy("label").agg(F.min("doc_id").alias("component_id"))
    whole = out.where("label is not null").join(least, "label")
    none = out.where("label is null").withColumn("component_id", F.col("doc_id"))
    columns = ["doc_id", "row", "n_shingles", "label", "component_id"]
    return whole.select(columns).unionByName(none.select(columns))


def _labels(docs: DataFrame, described_: DataFrame, nodes: DataFrame, gram: int, percent: int, write) -> DataFrame:
    """The components of all linked nodes."""
    tokens = described_.select("node", F.explode("prefix").alias("gram"))
    shared = write(tokens.groupBy("gram").agg(F.count("*").alias("total"), F.min("node").alias("first"),
                                              F.max("node").alias("last")).where("first <> last").drop("first", "last"), "grams")
    table = docs.sparkSession.sparkContext.broadcast(passages.bit_table(shared.select(F.col("gram").alias("h"))))

    def may(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prefix = batch.column(1)
            hit = passages.marked(table.value, prefix.flatten().to_numpy().view(np.uint64))
            owner = np.repeat(np.arange(batch.num_rows), np.diff(prefix.offsets.to_numpy()))
            node, n = (batch.column(k).take(pa.array(owner[hit])) for k in (0, 2))
            yield pa.record_batch([node, n, prefix.flatten().filter(pa.array(hit))], ["node", "n", "gram"])

    tokens = write(described_.select("node", "prefix", "n").mapInArrow(may, "node long, n long, gram long")
                   .join(shared, "gram").distinct(), "members")
    labels = links = tested = None  # no pairs yet
    for number in range(ROUNDS + 1):
        named = tokens if labels is None else tokens.join(labels, "node", "left")
        named = named.withColumn("label", F.lit(None).cast("long") if labels is None else F.col("label"))
        named = named.withColumn("label", F.coalesce("label", "node"))
        turn = F.lit(int(windows.mix(np.array([number], np.uint64))[0] >> np.uint64(1)))
        mixed = (named.groupBy("gram").agg(F.min("label").alias("x"), F.max("label").alias("y"),
                                           F.min(F.struct(F.col("node").bitwiseXOR(turn).alias("at"), "n", "label")).alias("c"))
                 .where("x <> y").select("gram", "x", F.col("c.at").bitwiseXOR(turn).alias("center"),
                                         F.col("c.n").alias("center_n"), F.col("c.label").alias("center_label")))
        named = named.join(mixed, "gram")
        counted = lambda rows: rows.join(nodes.select("node", "counts"), "node")
        if number < ROUNDS:  # each node with one node of each n-gram it shares with other components
            last = number == ROUNDS - 1
            one, two = F.struct("node", "n"), F.struct(F.col("center").alias("node"), F.col("center_n").alias("n"))
            pairs = (named.where(F.col("total") <= FEW) if last else named).where("label <> center_label").where(
                100 * F.least("n", "center_n") >= percent * F.greatest("n", "center_n")).select(
                F.least(one, two).alias("a"), F.greatest(one, two).alias("b")).select(
                F.col("a.node").alias("a"), F.col("b.node").alias("b"), F.col("a.n").alias("na"), F.col("b.n").alias("nb"))
            if last:
                many = across(counted(named.where(F.col("total") > FEW)), percent, nearest=True)
                pairs = pairs.unionByName(sized(many, nodes, percent))
            pairs = pairs.distinct()
        else:
            pairs = sized(across(counted(named), percent), nodes, percent)
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = write(pairs, "candidates")
        if pairs.isEmpty():  # rounds of stars may have nothing new while pairs across components remain
            continue
        found = verified(docs, nodes, pairs, gram, percent)
        pairs = pairs.select("a", "b")
        tested = pairs if tested is None else tested.unionByName(pairs)
        links = found if links is None else links.unionByName(found)
        labels = components(links)
    return labels if labels is not None else nodes.select("node", F.col("node").alias("label")).where("false")


def one_each(docs: DataFrame, gram: int = GRAM, percent: int = PERCENT) -> DataFrame:
    """The documents with all columns, of each component only the one with the smallest id (ties: the smallest hash).

    Documents without words have no component and all stay.
    """
    found = linked(docs, gram, percent)
    with hash_joins(docs.sparkSession):
        found = written(found, "linked")
    at = F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "row")
    kept = (found.where("label is not null").groupBy("label").agg(F.min(at).alias("k"))
            .select("label", F.col("k.doc_id").alias("doc_id"), F.col("k.row").alias("row")))
    kept = kept.unionByName(found.where("label is null").select("label", "doc_id", "row").distinct())
    times = found.where("label is not null").groupBy("doc_id", "row").agg(F.count("*").alias("times"))
    kept = kept.alias("k").join(times.alias("t"), (F.col("k.row") == F.col("t.row"))
                                & F.col("k.doc_id").eqNullSafe(F.col("t.doc_id")), "left").select("k.doc_id", "k.row", "times")
    rows = passages.whole_rows(docs).select("doc", "doc_id", "row").alias("d")
    joined = rows.join(kept.alias("k"), (F.col("d.row") == F.col("k.row")) & F.col("d.doc_id").eqNullSafe(F.col("k.doc_id")))
    once = joined.where("coalesce(times, 1) = 1").select("d.doc")
    repeated = joined.where("times > 1").select("d.doc", "d.doc_id", "d.row").dropDuplicates(["doc_id", "row"])
    return once.unionByName(repeated.select("doc")).select("doc.*")

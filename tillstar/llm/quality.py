"""Document quality by co-training: a classifier of the content and one of the page's metadata teach each other.

Both are logistic regressions. They start from ``LABELLED`` labelled documents, those with the smallest hashes of their
ids. Over some rounds each view is calibrated on held-out labelled documents and hands every unlabelled document of which
it is confident, as a pseudo-label, to the other view; Spark sums the gradients over them. A view is confident of what it
gives a probability of ``CONFIDENT``, and of the documents that rank first in each class: a share ``FIRST`` of all
unlabelled ones, divided as the labelled are, ties left out where they would pass it. So a view whose probabilities never
reach ``CONFIDENT`` teaches too. Pseudo-labels weigh as much in total as the labelled documents, whatever their numbers,
times how far their teacher ranks held-out documents better than chance does; a view that does no better hands on none.
At last the calibrated views are combined by a regression on the held-out documents, and one scan scores every document
on its whole text.

Rules: null texts are empty, a null ``lang``, ``source`` or ``n_chars`` is a value of its own. Of a document's labels the
smallest counts; null labels do not. Without labels of both kinds every document scores the share of good ones (1.0
without any label). Repeated rows score alike. Documents are kept from ``KEEP`` on. Other columns pass through.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Generator, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm import passages, windows
from tillstar.llm.scratch import cleaned, small_batches, temporary
from tillstar.llm.sums import added

LABELLED = 8000
ROUNDS, CONFIDENT, FIRST = 3, 0.95, 0.05
#: Ranges of probability in which a view's unlabelled documents are counted to rank them.
BINS = 4096
#: A fit on all documents ends with the step that lowers the loss by less than this share of it.
SETTLED = 1e-3
KEEP = 0.5
PAIRS, WORDS, SHAPE = 1024, 2048, 12
LANGS, SOURCES, SIZES = 16, 2048, 24
SLICES = 4
CONTENT, META = PAIRS + WORDS + SHAPE, LANGS + SOURCES + SIZES
_PAIR = (windows.mix(np.arange(65536, dtype=np.uint64)) % np.uint64(PAIRS)).astype(np.int64)
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def content(texts: pa.Array) -> np.ndarray:
    """Features of whole texts: roots of the shares of byte pairs and hashed words, and the shape of the text."""
    data, offsets = windows.flat(texts)
    out = np.zeros((len(texts), CONTENT), np.float32)
    row = 0
    for a, z in windows.chunks(offsets):
        part = data[offsets[a]: offsets[z]]
        bounds = offsets[a: z + 1] - offsets[a]
        starts, ends, per = windows.words(part, bounds)
        hashes = windows.word_hashes(part, starts, ends)
        pairs = _PAIR[part[:-1].astype(np.int64) << 8 | part[1:]] if len(part) else np.zeros(0, np.int64)
        for x, y, u, v in zip(bounds[:-1].tolist(), bounds[1:].tolist(), per[:-1].tolist(), per[1:].tolist()):
            if v > u:
                own, body = hashes[u:v], part[x:y]
                n, size = v - u, y - x
                out[row, :PAIRS] = np.sqrt(np.bincount(pairs[x: y - 1], minlength=PAIRS) / size)
                out[row, PAIRS: PAIRS + WORDS] = np.sqrt(
                    np.bincount((own % np.uint64(WORDS)).astype(np.int64), minlength=WORDS) / n)
                _, counts = np.unique(own, return_counts=True)
                letters = _LETTER[body].mean()
                lines = int((body == 10).sum()) + 1
                out[row, PAIRS + WORDS:] = (
                    1, letters, len(counts) / n, counts.max() / n, (own[1:] == own[:-1]).mean() if n > 1 else 0,
                    size / n / 10, np.log1p(n) / 10, lines / n, ((body >= 48) & (body <= 57)).mean(),
                    ((body >= 65) & (body <= 90)).mean(), (body == 46).sum() / n, 1 - letters - n / size)
            else:
                out[row, -SHAPE] = 1
            row += 1
    return out


def slots(langs: pa.Array, sources: pa.Array, sizes: pa.Array) -> np.ndarray:
    """The columns of the hashed language, the hashed source and the power of two of the length."""
    slot = lambda x, n: 0 if x is None else 1 + zlib.crc32(str(x).encode()) % (n - 1)
    return np.array([[slot(x, LANGS) for x in langs.to_pylist()], [LANGS + slot(x, SOURCES) for x in sources.to_pylist()],
                     [LANGS + SOURCES + (0 if x is None else min(SIZES - 1, 1 + max(0, int(x)).bit_length()))
                      for x in sizes.to_pylist()]], np.uint16).reshape(3, -1).T


def metadata(found: np.ndarray) -> np.ndarray:
    """One column for each slot."""
    out = np.zeros((len(found), META), np.float32)
    out[np.arange(len(found))[:, None], found] = 1
    return out


def fit(x: np.ndarray, y: np.ndarray, steps: int = 150, penalty: float = 1e-4) -> np.ndarray:
    """Weights of a logistic regression, by accelerated gradient descent on classes of equal weight."""
    share = y.mean()
    weight = np.where(y > 0.5, 0.5 / max(share, 1e-9), 0.5 / max(1 - share, 1e-9)).astype(np.float32) / len(y)
    step = 4 / max(float(weight @ np.einsum("ij,ij->i", x, x)), 1e-9)
    w, seen = np.zeros(x.shape[1], np.float32), np.zeros(x.shape[1], np.float32)
    for i in range(steps):
        ahead = w + (w - seen) * (i / (i + 3))
        error = weight * (1 / (1 + np.exp(-np.clip(x @ ahead, -30, 30))) - y)
        seen, w = w, ahead - step * (error @ x + penalty * ahead)
    return w


def calibrate(scores: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Slopes and offset that turn raw scores (one column a view) into probabilities, by Newton steps."""
    x = np.column_stack([scores, np.ones(len(y))]).astype(np.float64)
    b = np.zeros(x.shape[1])
    ridge = np.diag([1e-3] * x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        b -= np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (p - y) + ridge @ b)
    return b


def probability(scores: np.ndarray, b: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(scores @ b[:-1] + b[-1], -30, 30)))


def loss_of(x: np.ndarray, y: np.ndarray, weight: np.ndarray, w: np.ndarray) -> np.ndarray:
    """A weighted logistic loss, and its gradient after it."""
    raw = x @ w
    error = weight * (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - y)
    return np.concatenate(([weight @ (np.logaddexp(0, raw) - y * raw)], error @ x)).astype(np.float64)


def descent(w: np.ndarray, kept: int = 10) -> Generator[np.ndarray, tuple[float, np.ndarray], np.ndarray]:
    """L-BFGS until the loss settles: yields weights, is sent their loss and gradient, and returns the last weights."""
    loss, slope = yield w
    past: list[tuple[np.ndarray, np.ndarray]] = []
    while True:
        d, used = slope.copy(), []
        for s, y in reversed(past):
            used.append((s @ d) / (s @ y))
            d -= used[-1] * y
        if past:
            s, y = past[-1]
            d *= (s @ y) / (y @ y)
        for (s, y), a in zip(past, reversed(used)):
            d += (a - (y @ d) / (s @ y)) * s
        size = 1.0
        while True:
            new_loss, new_slope = yield w - size * d
            if new_loss <= loss - 1e-4 * size * (d @ slope):
                break
            size /= 2
            if size < 1e-6:
                return w
        moved, change = -size * d, new_slope - slope
        settled = loss - new_loss < SETTLED * loss
        w, loss, slope = w + moved, new_loss, new_slope
        if settled:
            return w
        if moved @ change > 0:
            past = [*past[1 - kept:], (moved, change)]


def bins(x: np.ndarray, w: np.ndarray, own: np.ndarray) -> np.ndarray:
    """The range that a view's probability of each document falls into."""
    return np.minimum((probability((x @ w)[:, None], own) * BINS).astype(np.int64), BINS - 1)


def trust(scores: np.ndarray, y: np.ndarray) -> float:
    """How far scores rank good documents over bad ones: 1 always, 0 no more often than chance."""
    good, bad = np.sort(scores[y > 0.5]), scores[y <= 0.5]
    if not len(good) or not len(bad):
        return 0.0
    below = np.searchsorted(good, bad, "left") + np.searchsorted(good, bad, "right")
    return max(0.0, float(1 - below.sum() / (len(good) * len(bad))))


def limits(found: np.ndarray, share: float, confident: float, first: float) -> tuple[int, int]:
    """The last range a view holds bad and the first it holds good, from its counts of unlabelled documents by range."""
    up = np.cumsum(found)
    low = int(np.searchsorted(up, first * (1 - share) * up[-1], "right")) - 1
    down = np.cumsum(found[::-1])
    high = BINS - int(np.searchsorted(down, first * share * up[-1], "right"))
    bad, good = int((1 - confident) * BINS), int(np.ceil(confident * BINS))
    return max(min(low, good - 1), bad - 1), min(max(high, bad), good)  # rank does not overrule a probability


def co_train(views: tuple[np.ndarray, np.ndarray], y: np.ndarray, pools, rounds: int = ROUNDS,
             confident: float = CONFIDENT, first: float = FIRST, penalty: float = 1e-4) -> dict:
    """The two views' weights and calibrations and the combination; ``log`` has the pseudo-labels given each round.

    The first quarter of the documents, which must come in no order, is held out. ``pools`` is a pair of arrays as
    ``views``, or a function that sums what its argument gives for parts of the pool.
    """
    total: Callable = pools if callable(pools) else lambda work: work(pools)
    test, rest = slice(0, -(-len(y) // 4)), slice(-(-len(y) // 4), None)  # parts of the arrays, not copies
    if len(set(y[test])) < 2 or len(set(y[rest])) < 2:
        test = rest = slice(None)
    taught, known = [v[rest] for v in views], y[rest]
    weight = (0.5 / np.where(known > 0.5, known.sum(), (1 - known).sum())).astype(np.float32)
    weights = [fit(x, known) for x in taught]
    own = [calibrate((views[v][test] @ weights[v])[:, None], y[test]) for v in range(2)]
    log = []
    for _ in range(rounds):
        teachers = list(zip(weights, own))
        trusted = [trust(views[v][test] @ weights[v], y[test]) for v in range(2)]

        def count(part) -> np.ndarray:
            return np.array([np.bincount(bins(part[v], *teachers[v]), minlength=BINS) for v in range(2)], np.float64)

        found = total(count)
        edges = [limits(found[v], float(known.mean()), confident, first) for v in range(2)]
        given = np.array([[found[v][: low + 1].sum(), found[v][high:].sum()] if trusted[v] else [0, 0]
                          for v, (low, high) in enumerate(edges)])
        log.append(given.sum(1).astype(int).tolist())
        if not given.any():
            break
        learners = [descent(w.astype(np.float64)) for w in weights]
        asked = {v: next(learners[v]) for v in range(2) if given[1 - v].any()}
        while asked:
            now = {v: w.astype(np.float32) for v, w in asked.items()}

            def learn(part) -> np.ndarray:
                out = []
                for v, w in now.items():
                    place, (low, high) = bins(part[1 - v], *teachers[1 - v]), edges[1 - v]
                    sure = (place <= low) | (place >= high)
                    good = (place >= high).astype(np.float32)
                    kinds = 0.5 / np.maximum(given[1 - v], 1)
                    out.append(loss_of(part[v][sure], good[sure], kinds[good[sure].astype(int)].astype(np.float32), w))
                return np.concatenate(out)

            found = np.split(total(learn), np.cumsum([1 + len(w) for w in now.values()])[:-1])
            for (v, w), sums in zip(now.items(), found):
                sums = (trusted[1 - v] * sums + loss_of(taught[v], known, weight, w)) / (1 + trusted[1 - v])
                wide = w.astype(np.float64)
                try:
                    asked[v] = learners[v].send((sums[0] + penalty / 2 * wide @ wide, sums[1:] + penalty * wide))
                except StopIteration as done:
                    weights[v] = done.value.astype(np.float32)
                    del asked[v]
        own = [calibrate((views[v][test] @ weights[v])[:, None], y[test]) for v in range(2)]
    both = np.column_stack([views[v][test] @ weights[v] for v in range(2)])
    return {"weights": weights, "own": own, "both": calibrate(both, y[test]), "log": log}


def packed(docs: DataFrame, *columns: str, keep: Callable | None = None) -> DataFrame:
    """``columns`` and each document's features: ``m``, slots of the metadata, and the content that is not zero.

    ``keep`` gives the rows of a batch to pack, and for each whether it is in ``doubt``, a column after the others.
    """
    n = len(columns)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch, doubt = keep(batch) if keep else (batch, None)
            for a in range(0, batch.num_rows, 512):  # a few MB of features at a time
                part = batch.slice(a, 512)
                x = content(part.column(n)).astype(np.float16)
                m = slots(*(part.column(n + i) for i in (1, 2, 3)))
                at = [np.flatnonzero(r).astype(np.uint16) for r in x]
                yield pa.record_batch([*part.columns[:n], pa.array([r.tobytes() for r in m], pa.binary()),
                                       pa.array([i.tobytes() for i in at], pa.binary()),
                                       pa.array([r[i].tobytes() for r, i in zip(x, at)], pa.binary()),
                                       *([] if doubt is None else [pa.array(doubt[a: a + 512])])],
                                      [*columns, "m", "at", "x", *([] if doubt is None else ["doubt"])])

    rows = docs.select(*columns, "text", "lang", "source", "n_chars")
    kinds = "".join(f"{c} {rows.schema[c].dataType.simpleString()}, " for c in columns)
    return rows.mapInArrow(features, f"{kinds}m binary, at binary, x binary" + (", doubt boolean" if keep else ""))


def unpacked(m: pa.Array, at: pa.Array, x: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Both views of packed documents."""
    bodies = at.to_pylist()
    out = np.zeros((len(bodies), CONTENT), np.float32)
    rows = np.repeat(np.arange(len(bodies)), [len(b) // 2 for b in bodies])
    out[rows, np.frombuffer(b"".join(bodies), np.uint16)] = np.frombuffer(b"".join(x.to_pylist()), np.float16)
    return out, metadata(np.frombuffer(b"".join(m.to_pylist()), np.uint16).reshape(-1, 3))


def summed(rows: DataFrame, work: Callable, tasks: int | None = None) -> np.ndarray:
    """The sum over all packed documents, in ``tasks`` tasks, of the arrays that ``work(views)`` gives for some of them."""
    shape = work((np.zeros((0, CONTENT), np.float32), np.zeros((0, META), np.float32))).shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(shape)
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                sums += work(unpacked(*batch.slice(a, 512).columns))
        parts = np.array_split(sums.ravel(), SLICES)
        yield pa.record_batch([pa.array(range(SLICES), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())],
                              ["slice", "sums"])

    with cleaned(rows.sparkSession):
        parts = added(rows.mapInArrow(run, "slice int, sums binary"), np.float64, tasks)
    return np.concatenate([parts[i] for i in sorted(parts)]).reshape(shape) if parts else np.zeros(shape)


def unlabelled(docs: DataFrame, known: DataFrame, write: Callable) -> DataFrame:
    """The packed documents whose id is not in ``known`` (distinct ids), a null id included.

    No text is shuffled to find them. A bit table of the known ids tells most documents apart; of those it may hold, only
    the ids are compared, and what it holds by mistake goes into a second table. Documents that only the first has are
    known; the few that both have are packed and compared exactly.
    """
    spark = docs.sparkSession
    hashed = docs.withColumn("h", F.xxhash64("doc_id"))
    first = spark.sparkContext.broadcast(passages.bit_table(known.select(F.xxhash64("doc_id").alias("h"))))

    def may(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(passages.marked(first.value, batch.column(0).to_numpy().view(np.uint64))))

    ids = hashed.select("h", "doc_id").mapInArrow(may, "h long, doc_id long")
    ids = write(ids.join(known, "doc_id", "left_anti").distinct(), "unlabelled")
    second = spark.sparkContext.broadcast(passages.bit_table(ids.select("h")))

    def keep(batch: pa.RecordBatch) -> tuple[pa.RecordBatch, np.ndarray]:
        hashes = batch.column(0).to_numpy().view(np.uint64)
        doubt = passages.marked(first.value, hashes)
        left = ~doubt | passages.marked(second.value, hashes)
        return batch.filter(pa.array(left)), doubt[left]

    pool = write(packed(hashed, "h", "doc_id", keep=keep), "pool")
    doubtful = pool.where("doubt").alias("p").join(ids.alias("i"), F.col("p.doc_id").eqNullSafe(F.col("i.doc_id")), "left_semi")
    return pool.where("not doubt").select("m", "at", "x").unionByName(write(doubtful.select("m", "at", "x"), "doubtful"))


def train(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> dict:
    """The model, a few numpy arrays of fixed size."""
    small_batches(docs.sparkSession)
    known = (labels.where("quality is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.min("quality").cast("double").alias("good")))
    known = known.select("doc_id", F.when(F.col("good") > 0, 1.0).otherwise(0.0).alias("good"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(labelled)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang", "source", "n_chars")
    rows = docs.join(F.broadcast(chosen), "doc_id").withColumn("h", F.xxhash64("doc_id"))
    rows = packed(rows, "h", "doc_id", "good").dropDuplicates(["doc_id"]).toArrow()
    rows = rows.sort_by([("h", "ascending"), ("doc_id", "ascending")])
    y = rows["good"].to_numpy().astype(np.float32)
    if len(set(y)) < 2:
        return {"share": float(y.mean()) if len(y) else 1.0}
    views = np.zeros((len(y), CONTENT), np.float32), np.zeros((len(y), META), np.float32)
    for a in range(0, len(y), 512):  # a few MB of lists at a time
        for view, part in zip(views, unpacked(*(rows[c].slice(a, 512) for c in ("m", "at", "x")))):
            view[a: a + 512] = part
    del rows
    pa.default_memory_pool().release_unused()
    with temporary(docs.sparkSession) as write:
        pool = unlabelled(docs, known.select("doc_id"), write)
        tasks = pool.rdd.getNumPartitions()  # of written tables: nothing runs for it
        return co_train(views, y, lambda work: summed(pool, work, tasks))


def score(model: dict, batch: pa.RecordBatch) -> np.ndarray:
    """Columns: both views' probabilities and the combined one."""
    if "share" in model:
        return np.full((batch.num_rows, 3), model["share"])
    column = lambda name: batch.column(batch.schema.get_field_index(name))
    out = np.zeros((batch.num_rows, 3))
    for a in range(0, batch.num_rows, 512):  # a few MB of features at a time
        part = slice(a, a + 512)
        texts, rest = column("text").slice(a, 512), [column(c).slice(a, 512) for c in ("lang", "source", "n_chars")]
        raw = np.column_stack([content(texts) @ model["weights"][0], metadata(slots(*rest)) @ model["weights"][1]])
        out[part] = np.column_stack([*(probability(raw[:, [v]], model["own"][v]) for v in range(2)),
                                     probability(raw, model["both"])])
    return out


def scored(docs: DataFrame, labels: DataFrame, keep: float = KEEP, **sizes: int) -> DataFrame:
    """``doc_id``, ``p_content``, ``p_metadata``, ``score`` (probability of good quality) and ``kept``."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, **sizes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = score(model.value, batch)
            yield pa.record_batch([batch.column(0), *(pa.array(p[:, i]) for i in range(3)), pa.array(p[:, 2] >= keep)],
                                  ["doc_id", "p_content", "p_metadata", "score", "kept"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang", "source", "n_chars").mapInArrow(
        run, "doc_id long, p_content double, p_metadata double, score double, kept boolean")


def kept(docs: DataFrame, labels: DataFrame, keep: float = KEEP, **sizes: int) -> DataFrame:
    """The documents, all columns, that the classifier does not reject."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, **sizes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(score(model.value, batch)[:, 2] >= keep))

    return docs.mapInArrow(run, docs.schema)

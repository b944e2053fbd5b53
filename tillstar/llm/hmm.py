"""A hidden Markov language model, trained by Baum-Welch over all training documents, scored by the forward recursion.

Words are counted over the training documents. The OWN most frequent words are letters of the model's alphabet; all
others, and unseen words, share CLASSES letters by their length and last byte, and a class hands its probability on to
its words by their counts. Latent states start from groups of all training documents' sequences, split again and again
along the direction in which their hashed word shares vary most, and are then trained on every training document until
the likelihood settles: tasks compute sums and expected counts, Spark adds them up, the driver keeps one table of states
by letters. Scores and expected counts are exact over a document's whole length: the recursions are scaled at every token,
and pieces of SEQUENCE tokens, side by side, take the states they are entered in and what follows them from the products
of each piece's transfer matrix. What words beyond the KNOWN most frequent add is joined by Spark from the counts of all.

Rules: a null text is empty and has the end token only. A null id is held out, like an id whose CRC-32 is divisible by
ten. Repeated rows are scored and counted each. Without training documents the score is the base score. Words are told
apart by 64-bit hashes. An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm import passages, windows
from tillstar.llm.scratch import cleaned, written
from tillstar.llm.sums import added

STATES, OWN, CLASSES, KNOWN = 6, 1 << 16, 512, 1 << 19
#: Training ends with the pass that raises the likelihood's logarithm by less than this share of it.
SETTLED = 1e-4
SEQUENCE = 1024
#: Steps after which a piece's transfer matrix is scaled; an emission is at most 1 there.
SCALED = 8
#: Hashed word shares by which sequences are grouped for the first model.
SHARES = 256
#: Tokens handled at once.
GROUP = 1 << 19
END = np.uint64(0x454E44)  # stands for the end token; no word hash is special, so it is as likely as any to collide
SLICES = 16


class Words(NamedTuple):
    """The most frequent words, KNOWN at most and all of a count or none, sorted by hash, and what concerns all words."""

    hashes: np.ndarray
    counts: np.ndarray
    letters: np.ndarray  # own letter, or -1
    total: int  # N
    distinct: int  # V
    class_total: np.ndarray
    class_distinct: np.ndarray
    own: int


def tokens(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For groups of texts: word hashes with the end tokens, classes, and offsets of the documents."""
    data, offsets = windows.flat(texts)
    data = windows.lower(data)
    for a, z in windows.chunks(offsets):
        part = data[offsets[a]: offsets[z]]
        starts, ends, per = windows.words(part, offsets[a: z + 1] - offsets[a])
        n = z - a
        place = np.arange(len(starts)) + np.repeat(np.arange(n), np.diff(per))  # one end token for each text before
        offset = per + np.arange(n + 1)
        hashes = np.full(len(starts) + n, END, np.uint64)
        hashes[place] = windows.word_hashes(part, starts, ends)
        kinds = np.zeros(len(hashes), np.int64)
        kinds[place] = (np.minimum(ends - starts, 16) * 32 + part[ends - 1] % 32) % CLASSES if len(starts) else 0
        yield hashes, kinds, offset


def source(docs: DataFrame) -> DataFrame:
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return passages.source(docs).withColumn("held_out", F.crc32(name.cast("binary")) % 10 == 0)


def count_words(docs: DataFrame) -> DataFrame:
    """``h``, ``kind`` and ``n`` of every token of the training documents."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = list(tokens(batch.column(0)))
            if not parts:
                continue
            hashes = np.concatenate([p[0] for p in parts])
            found, at, n = np.unique(hashes, return_index=True, return_counts=True)
            kinds = np.concatenate([p[1] for p in parts])[at]
            yield pa.record_batch([pa.array(found.view(np.int64)), pa.array(kinds.astype(np.int32)), pa.array(n)],
                                  ["h", "kind", "n"])

    return (docs.where("not held_out").select("text").mapInArrow(count, "h long, kind int, n long")
            .groupBy("h").agg(F.max("kind").alias("kind"), F.sum("n").alias("n")))


def common_words(counts: DataFrame, own: int = OWN, known: int = KNOWN) -> Words:
    """The bounded tables that tasks need, from the counts of all words."""
    # how many words have each count: one row a count, from which the least count of a known word follows
    found = counts.groupBy("n").agg(F.count("*").alias("words")).toPandas().sort_values("n", ascending=False)
    total, distinct = int((found.n * found.words).sum()), int(found.words.sum())
    least = found.n[found.words.cumsum() <= known].min() if len(found) else 0
    top = counts.where(F.col("n") >= (int(least) if least == least else 1 << 62)).toArrow().to_pandas()
    top = top.sort_values(["n", "h"], ascending=[False, True], ignore_index=True)
    letters = np.where(np.arange(len(top)) < own, np.arange(len(top)), -1)
    end = np.flatnonzero(top.h.to_numpy(np.int64) == END.view(np.int64))
    if len(end) and letters[end[0]] < 0:
        letters[end[0]] = own - 1  # the end token always has its own letter
        letters[own - 1] = -1
    mine = top.loc[letters >= 0].groupby("kind").n.agg(["sum", "size"])
    class_total, class_distinct = np.zeros(CLASSES), np.zeros(CLASSES)
    for kind, n, size in counts.groupBy("kind").agg(F.sum("n"), F.count("*")).collect():
        class_total[kind], class_distinct[kind] = n, size
    for kind, (n, size) in mine.iterrows():
        class_total[kind] -= n
        class_distinct[kind] -= size
    hashes = top.h.to_numpy(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return Words(hashes[order], top.n.to_numpy(np.int64)[order], letters[order], total, distinct,
                 class_total, class_distinct, own)


def encode(words: Words, hashes: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The letter of every token, and its count (-1: not among the known words)."""
    if not len(words.hashes):
        return words.own + kinds, np.full(len(hashes), -1, np.int64)
    at = np.minimum(np.searchsorted(words.hashes, hashes), len(words.hashes) - 1)
    hit = words.hashes[at] == hashes
    letters = np.where(hit, words.letters[at], -1)
    return np.where(letters >= 0, letters, words.own + kinds), np.where(hit, words.counts[at], -1)


def encoded(docs: DataFrame, words) -> DataFrame:
    """Each document's letters, and sums over its tokens; ``tail`` holds the hashes of tokens beyond the known words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table: Words = words.value
        spread = np.log10(table.class_total + 0.1 * (table.class_distinct + 1))
        for batch in batches:
            letters, tail, sizes, known, logs, own_logs = [], [], [], [], [], []
            for hashes, kinds, offsets in tokens(batch.column(3)):
                letter, counts = encode(table, hashes, kinds)
                log = np.where(counts >= 0, np.log10(np.maximum(counts, 0) + 0.1), 0.0)
                shared = letter >= table.own  # a class hands its probability to its words
                own_log = np.where(shared, log - spread[kinds], 0.0)
                first = offsets[:-1]
                sizes.append(np.diff(offsets))
                known.append(np.add.reduceat((counts > 0).astype(np.int64), first))
                logs.append(np.add.reduceat(log, first))
                own_logs.append(np.add.reduceat(own_log, first))
                far = counts < 0
                ends = np.concatenate(([0], np.cumsum(far)))[offsets]
                rest = hashes[far]
                letter = letter.astype(np.int32)
                for a, z, x, y in zip(offsets[:-1].tolist(), offsets[1:].tolist(), ends[:-1].tolist(), ends[1:].tolist()):
                    letters.append(letter[a:z].tobytes())
                    tail.append(rest[x:y].tobytes())
            join = lambda parts, kind: pa.array(np.concatenate(parts) if parts else np.zeros(0), kind)
            yield pa.record_batch([
                *batch.columns[:3], pa.array(letters, pa.binary()), pa.array(tail, pa.binary()), join(sizes, pa.int64()),
                join(known, pa.int64()), join(logs, pa.float64()), join(own_logs, pa.float64()),
            ], ["doc_id", "row", "held_out", "letters", "tail", "n", "known", "logs", "own_logs"])

    return docs.select("doc_id", "row", "held_out", "text").mapInArrow(
        run, "doc_id long, row long, held_out boolean, letters binary, tail binary, n long, known long, logs double, "
             "own_logs double")


class Model(NamedTuple):
    start: np.ndarray  # states
    move: np.ndarray  # states x states
    emit: np.ndarray  # letters x states


def lockstep(sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequences side by side, longest first: their order, all letters step by step, and how many take part in a step."""
    sizes = np.array([len(s) for s in sequences])
    order = np.argsort(-sizes, kind="stable")
    flat = np.concatenate([sequences[i] for i in order.tolist()])
    first = np.cumsum(sizes[order]) - sizes[order]
    step = np.arange(len(flat)) - np.repeat(first, sizes[order])
    active = np.bincount(step)
    return order, flat[np.argsort(step, kind="stable")], active


def cut(sequences: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """Pieces of SEQUENCE letters at most, in order, and which of them begin a sequence."""
    pieces = [s[a: a + SEQUENCE] for s in sequences for a in range(0, len(s), SEQUENCE)]
    begins = np.zeros(len(pieces), bool)
    counts = np.array([-(-len(s) // SEQUENCE) for s in sequences])
    begins[np.cumsum(counts) - counts] = True
    return pieces, begins


def blocks(pieces: list[np.ndarray]) -> Iterator[tuple[int, int]]:
    """Ranges of pieces with about GROUP letters, twice as many at most."""
    a, size = 0, 0
    for i, piece in enumerate(pieces):
        if size and size + len(piece) > 2 * GROUP:
            yield a, i
            a, size = i, 0
        size += len(piece)
    if size:
        yield a, len(pieces)


def transfers(model: Model, pieces: list[np.ndarray]) -> np.ndarray:
    """For each piece, up to a factor: how likely it is if entered in one state, and to be followed by another."""
    order, letters, active = lockstep(pieces)
    k = len(model.start)
    emit = model.emit / model.emit.max(1, keepdims=True)
    found = np.repeat(np.eye(k, dtype=emit.dtype)[:, None], len(pieces), 1)  # first state, piece, last state
    place = 0
    for step, n in enumerate(active.tolist(), 1):
        found[:, :n] = (found[:, :n] * emit[letters[place: place + n]]) @ model.move
        if step % SCALED == 0:
            found /= found.max((0, 2), keepdims=True)
        place += n
    out = np.empty((len(pieces), k, k))
    out[order] = found.transpose(1, 0, 2)
    return out


def joints(model: Model, pieces: list[np.ndarray], begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The shares of the states each piece is entered in, and, up to a factor, how likely what follows it is by its last state."""
    enter = np.tile(model.start.astype(np.float64), (len(pieces), 1))
    leave = np.ones_like(enter)
    inner = ~begins
    at = np.flatnonzero(inner | np.append(inner[1:], False))  # pieces of sequences that have several
    found: dict[int, np.ndarray] = {}
    own = [pieces[i] for i in at.tolist()]
    for a, z in blocks(own):
        found.update(zip(at[a:z].tolist(), transfers(model, own[a:z])))
    for i in at[inner[at]].tolist():
        enter[i] = enter[i - 1] @ found[i - 1]
        enter[i] /= enter[i].sum()
    behind = np.ones(len(model.start))
    for i in at[::-1].tolist():
        if i + 1 < len(pieces) and inner[i + 1]:
            leave[i] = model.move @ behind
        else:
            behind = np.ones(len(model.start))
        behind = found[i] @ behind
        behind /= behind.sum()
    return enter.astype(model.emit.dtype), leave.astype(model.emit.dtype)


def forward(model: Model, sequences: list[np.ndarray]) -> np.ndarray:
    """The log10 probability of each sequence of letters."""
    pieces, begins = cut(sequences)
    enter, _ = joints(model, pieces, begins)
    out = np.zeros(len(pieces))
    for a, z in blocks(pieces):
        order, letters, active = lockstep(pieces[a:z])
        place, alpha = 0, enter[a:z][order]
        for step, n in enumerate(active.tolist()):
            seen = model.emit[letters[place: place + n]]
            alpha = (alpha[:n] @ model.move if step else alpha) * seen
            scale = alpha.sum(1)
            alpha /= scale[:, None]
            out[a + order[:n]] += np.log10(scale)
            place += n
    return np.add.reduceat(out, np.flatnonzero(begins))


def expected(model: Model, sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Baum-Welch's expected counts of starts, moves and emissions, and the sequences' log10 probability."""
    pieces, begins = cut(sequences)
    enter, leave = joints(model, pieces, begins)
    firsts, lasts = np.empty_like(enter), np.empty_like(enter)
    moves, emits, total = np.zeros(model.move.shape), np.zeros(model.emit.shape), 0.0
    for a, z in blocks(pieces):
        order, letters, active = lockstep(pieces[a:z])
        places = np.concatenate(([0], np.cumsum(active)))
        seen = model.emit[letters]
        alphas, scales = np.empty_like(seen), np.empty(len(letters), seen.dtype)
        alpha = enter[a:z][order]
        for step, (x, y) in enumerate(zip(places[:-1].tolist(), places[1:].tolist())):
            alpha = (alpha[: y - x] @ model.move if step else alpha) * seen[x:y]
            scale = alpha.sum(1)
            alpha = alpha / scale[:, None]
            alphas[x:y], scales[x:y] = alpha, scale
        ends, after = leave[a:z][order], None
        for x, y in zip(places[-2::-1].tolist(), places[:0:-1].tolist()):
            m = 0 if after is None else len(after)
            beta = np.empty((y - x, seen.shape[1]), seen.dtype)
            if m:
                moves += alphas[x: x + m].T @ after
                beta[:m] = after @ model.move.T
            if x + m < y:  # pieces that end here
                last = alphas[x + m: y]
                lasts[a + order[m: y - x]] = last
                beta[m:] = ends[m: y - x] / (last * ends[m: y - x]).sum(1, keepdims=True)
            after = seen[x:y] * beta / scales[x:y, None]
            alphas[x:y] *= beta  # now the states' probabilities
        firsts[a + order] = after
        for k in range(seen.shape[1]):
            emits[:, k] += np.bincount(letters, alphas[:, k], len(model.emit))
        total += float(np.log10(scales.astype(np.float64)).sum())
    inner = np.flatnonzero(~begins)
    moves += lasts[inner - 1].T @ firsts[inner]
    return model.start * firsts[begins].sum(0), moves * model.move, emits, total


def renewed(starts: np.ndarray, moves: np.ndarray, emits: np.ndarray) -> Model:
    """The model of expected counts, a little smoothed so that every letter can occur in every state."""
    base = emits.sum(1) + 0.5
    emits = emits + 2.0 * emits.shape[1] * (base / base.sum())[:, None]
    return Model(((starts + 1) / (starts + 1).sum()).astype(np.float32),
                 ((moves + 1) / (moves + 1).sum(1, keepdims=True)).astype(np.float32),
                 (emits / emits.sum(0)).astype(np.float32))


def summed(rows: DataFrame, work) -> np.ndarray:
    """The sum of ``work(sequences)``, an array, over all training documents: tasks add up theirs, Spark adds the tasks'."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = None
        held: list[np.ndarray] = []
        size = 0
        def add():
            nonlocal sums
            found = work(held)
            sums = found if sums is None else sums + found
        for batch in batches:
            for body in batch.column(0).to_pylist():
                held.append(np.frombuffer(body, np.int32))
                size += len(body) // 4
                if size >= GROUP:
                    add()
                    held, size = [], 0
        if held:
            add()
        if sums is not None:
            parts = np.array_split(sums.astype(np.float32), SLICES)
            yield pa.record_batch([pa.array(range(SLICES), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())],
                                  ["slice", "sums"])

    with cleaned(rows.sparkSession):
        parts = added(rows.where("not held_out").select("letters").mapInArrow(run, "slice int, sums binary"), np.float32)
    return np.concatenate([parts[i] for i in sorted(parts)]).astype(np.float64)


class Split(NamedTuple):
    """Sequences of ``group`` whose shares lie beyond ``place`` along ``direction`` go to a group of their own."""

    group: int
    direction: np.ndarray
    place: float


def shares(sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Roots of the shares of hashed letters in each sequence, and the sequences' sizes."""
    sizes = np.array([len(s) for s in sequences])
    slot = (windows.mix(np.concatenate(sequences).astype(np.uint64)) % np.uint64(SHARES)).astype(np.int64)
    slot += np.repeat(np.arange(len(sizes)) * SHARES, sizes)
    found = np.bincount(slot, minlength=len(sizes) * SHARES).reshape(-1, SHARES)
    return np.sqrt(found / sizes[:, None]), sizes


def grouped(x: np.ndarray, splits: list[Split]) -> np.ndarray:
    group = np.zeros(len(x), np.int64)
    for new, split in enumerate(splits, 1):
        group[(group == split.group) & (x @ split.direction > split.place)] = new
    return group


def groups(rows: DataFrame, most: int) -> list[Split]:
    """Splits of all training sequences into ``most`` groups, fewer where they do not vary."""
    splits: list[Split] = []
    while len(splits) + 1 < most:
        n, made = len(splits) + 1, list(splits)

        def moments(sequences: list[np.ndarray]) -> np.ndarray:
            x, sizes = shares(cut(sequences)[0])
            group, out = grouped(x, made), np.zeros((n, SHARES + 1, SHARES + 1))
            x = np.column_stack([x, np.ones(len(x))])
            for g in range(n):
                mine = x[group == g]
                out[g] = (mine * sizes[group == g, None]).T @ mine
            return out.ravel()

        found = []
        for g, m in enumerate(summed(rows, moments).reshape(n, SHARES + 1, SHARES + 1)):
            weight = m[-1, -1]
            if weight > 0:
                mean = m[-1, :-1] / weight
                spread, directions = np.linalg.eigh(m[:-1, :-1] / weight - np.outer(mean, mean))
                if spread[-1] > 1e-6:
                    found.append((weight * spread[-1], Split(g, directions[:, -1], float(mean @ directions[:, -1]))))
        if not found:
            break
        found.sort(key=lambda f: -f[0])
        splits += [split for _, split in found[: most - n]]
    return splits


def beginning(rows: DataFrame, letters: int, states: int = STATES) -> Model:
    """A first model from all training documents: each state starts as the letters of one group of sequences."""
    splits = groups(rows, states)

    def count(sequences: list[np.ndarray]) -> np.ndarray:
        x, sizes = shares(cut(sequences)[0])
        group = np.repeat(grouped(x, splits), sizes)
        return np.bincount(group * letters + np.concatenate(sequences), minlength=states * letters).astype(np.float64)

    own = summed(rows, count).reshape(states, letters)
    whole = own.sum(0) + 0.1
    own = own + 20 * whole / whole.sum()
    emit = (own * np.random.default_rng(7).uniform(0.9, 1.1, own.shape)).T
    move = np.full((states, states), 0.02 / max(1, states - 1)) + np.eye(states) * 0.98
    return Model(np.full(states, 1 / states, np.float32), (move / move.sum(1, keepdims=True)).astype(np.float32),
                 (emit / emit.sum(0)).astype(np.float32))


def one_pass(rows: DataFrame, model: Model) -> tuple[Model, float]:
    """Baum-Welch once over all training documents, and their log10 probability before it."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    states = model.move.shape[0]

    def count(sequences: list[np.ndarray]) -> np.ndarray:
        *sums, likelihood = expected(shared.value, sequences)
        return np.concatenate([*(x.ravel() for x in sums), [likelihood]])

    flat = summed(rows, count)
    starts, moves, emits = np.split(flat[:-1], [states, states + states * states])
    return renewed(starts, moves.reshape(states, states), emits.reshape(-1, states)), float(flat[-1])


def trained(rows: DataFrame, model: Model, passes: int | None = None) -> Model:
    """The model after so many passes; without a number, when the likelihood has settled."""
    before = -np.inf
    while passes is None or passes > 0:
        model, likelihood = one_pass(rows, model)
        if passes is not None:
            passes -= 1
        elif likelihood - before < SETTLED * abs(likelihood):
            break
        before = likelihood
    return model


def scores(docs: DataFrame, states: int = STATES, own: int = OWN, known: int = KNOWN,
           passes: int | None = None) -> DataFrame:
    """``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score``."""
    docs = source(docs)
    sc = docs.sparkSession.sparkContext
    counts = written(count_words(docs), "counts")
    words = common_words(counts, own, known)
    rows = written(encoded(docs, sc.broadcast(words)), "letters")
    every = np.log10(words.total + 0.1 * (words.distinct + 1))
    letters = own + CLASSES
    model = None
    if words.total:
        model = trained(rows, beginning(rows, letters, states), passes)
    shared = sc.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.zeros(batch.num_rows)
            bodies = batch.column(6).to_pylist()
            if shared.value is not None:
                a, size = 0, 0
                for i, body in enumerate(bodies):
                    size += len(body) // 4
                    if size >= GROUP * 2 or i == len(bodies) - 1:
                        found[a: i + 1] = forward(shared.value, [np.frombuffer(b, np.int32) for b in bodies[a: i + 1]])
                        a, size = i + 1, 0
            yield pa.record_batch([*batch.columns[:6], batch.column(7), batch.column(8), pa.array(found)],
                                  ["doc_id", "row", "held_out", "n", "known", "logs", "own_logs", "beyond", "hidden"])

    scored = rows.select("doc_id", "row", "held_out", "n", "known", "logs", "letters", "own_logs",
                         (F.length("tail") / 8).cast("long").alias("beyond")).mapInArrow(
        run, "doc_id long, row long, held_out boolean, n long, known long, logs double, own_logs double, beyond long, "
             "hidden double")

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [len(b) // 8 for b in batch.column(2).to_pylist()]
            owner = pa.array(np.repeat(np.arange(batch.num_rows), sizes))
            hashes = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.int64)
            yield pa.record_batch([batch.column(0).take(owner), batch.column(1).take(owner), pa.array(hashes)],
                                  ["doc_id", "row", "h"])

    # a repeated row is one document here: its copies have the same tail
    tails = rows.select("doc_id", "row", "tail").where("length(tail) > 0").dropDuplicates(["doc_id", "row"])
    far = (tails.mapInArrow(spread, "doc_id long, row long, h long").join(counts.select("h", F.col("n").alias("c")), "h")
           .groupBy("doc_id", "row").agg(F.count("*").alias("far_known"), F.sum(F.log10(F.col("c") + 0.1)).alias("far_logs")))
    s, f = scored.alias("s"), far.alias("f")
    joined = s.join(f, (F.col("s.row") == F.col("f.row")) & F.col("s.doc_id").eqNullSafe(F.col("f.doc_id")), "left")
    # tokens beyond the known words: their logs, and log10(0.1) for each that training never saw
    seen = F.coalesce("far_known", F.lit(0))
    rest = F.coalesce("far_logs", F.lit(0.0)) - (F.col("beyond") - seen)
    base = F.col("logs") + rest - F.col("n") * F.lit(float(every))
    return joined.select(
        F.col("s.doc_id").alias("doc_id"), "held_out", F.col("n").alias("n_tokens"), (F.col("known") + seen).alias("n_known"),
        F.lit(words.total).cast("long").alias("train_tokens"), base.alias("base_score"),
        (F.col("hidden") + F.col("own_logs") + rest if model is not None else base).alias("score"))

"""Fingerprints, the hidden Markov model and the neighbour graphs."""

import hashlib
import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from tillstar.llm import hmm, hnsw, merkle

DOCS = "doc_id long, text string, row string, part long, n long, h string"
DATA = "/root/testdata/sf0.01"


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "r", 5, 6, "h") for d, t in rows], DOCS).repartition(4)


def texts(seed, n):
    rng = random.Random(seed)
    sentence = lambda: " ".join(rng.choice("one two three four fivé six".split()) for _ in range(rng.randint(3, 12)))
    return ["\n".join(". ".join(sentence() for _ in range(rng.randint(1, 5))) + "." for _ in range(rng.randint(1, 20)))
            for _ in range(n)]


def test_fingerprints(spark):
    rows = list(enumerate(texts(1, 40))) + [(50, ""), (51, None), (52, "x" * 3000), (53, "\n\n\n"), (60, "same"), (61, "same")]
    found = {r.doc_id: r for r in merkle.fingerprints(frame(spark, rows)).collect()}
    assert len(found) == len(rows)
    down = sorted(rows, reverse=True)
    for (doc, text), (_, after) in zip(down, [*down[1:], down[0]]):
        text, after, r = text or "", after or "", found[doc]
        edited = text[: len(text) - len(text) // 2] + after[: len(text) // 2]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (r.fingerprint == r.edited_fingerprint) == (text == edited) == (r.edit_found_at is None)
        assert 0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1 and (r.near_edited == 1) == (text == edited)
        if r.edit_found_at is not None:
            changed = next((i for i, (a, b) in enumerate(zip(text, edited)) if a != b), min(len(text), len(edited)))
            assert r.edit_found_at <= changed
    assert found[60].fingerprint == found[61].fingerprint
    assert len({r.fingerprint for r in found.values()}) == len({t or "" for _, t in rows})
    long = [r for r in found.values() if r.n_chars > 500 and r.doc_id < 50]
    assert np.mean([r.near_edited for r in long]) > 0.4 and all(r.near_edited > r.near_next for r in long)


def test_fingerprints_of_repeats_and_little(spark):
    rows = [(1, "a"), (1, "a"), (1, "b"), (None, "c"), (None, None)]
    assert len(merkle.fingerprints(frame(spark, rows)).collect()) == 5
    one = merkle.fingerprints(frame(spark, [(7, "abcd")])).collect()
    assert [(r.doc_id, r.edited_sha256) for r in one] == [(7, hashlib.sha256(b"abab").hexdigest())]
    assert merkle.fingerprints(spark.createDataFrame([], DOCS)).collect() == []


def content_tree(text):
    """The tree by content instead of hashes: (level, what the node spells, children)."""
    at = 0

    def walk(node):
        nonlocal at
        start = at
        if node.children:
            children = [walk(c) for c in node.children]
            at = start + node.size
        else:
            children, at = [], start + node.size
        return node.level, text[start:at], children

    return walk(merkle.tree(text))


def plain_likeness(a, b):
    """Branches that spell the same, level by level from the top, taken once each; their length in both."""
    total = 0
    left, right = [content_tree(a)], [content_tree(b)]
    for level in range(len(merkle.LEVELS) - 1, -1, -1):
        x, y = [n for n in left if n[0] == level], [n for n in right if n[0] == level]
        # a separator belongs to its parent: what a node spells without it decides
        key = lambda n: tuple(leaf_texts(n))
        both = Counter(map(key, x)) & Counter(map(key, y))
        for nodes, side in ((x, left), (y, right)):
            quota = both.copy()
            for n in nodes:
                side.remove(n)
                if quota[key(n)]:
                    quota[key(n)] -= 1
                    total += len(n[1])
                else:
                    side += n[2]
    return total / (len(a) + len(b)) if a or b else 1.0


def leaf_texts(node):
    if not node[2]:
        yield node[0], node[1].rstrip(". \n") if node[0] else node[1]
    for c in node[2]:
        yield node[0], len(node[2])
        yield from leaf_texts(c)


def test_likeness_by_content():
    """Hashes find the branches that a comparison of the texts themselves finds."""
    some = texts(8, 12)
    for a, b in zip(some, some[1:]):
        half = len(a) // 2
        for other in (b, a[: len(a) - half] + b[:half], a, a.replace("three", "3", 1), a + "\n" + b):
            assert merkle.likeness(merkle.tree(a), merkle.tree(other)) == pytest.approx(plain_likeness(a, other))


def test_leaves_spell_the_text():
    for text in ["", "x" * 3000, "\n\n", "a. b. . c", "é\r\x0b ü" * 30, *texts(9, 5)]:
        def leaves(node):
            return [node] if not node.level else [x for c in node.children for x in leaves(c)]
        root = merkle.tree(text)
        assert root.size == len(text) and all(1 <= n.size <= 40 for n in leaves(root))


def test_a_kept_half_is_found(spark):
    """On all documents: what keeps 50 characters or more has some likeness to what it was."""
    found = merkle.fingerprints(spark.read.parquet(f"{DATA}/documents.parquet"))
    assert found.where("n_chars >= 100 and near_edited = 0").count() == 0
    assert found.where("n_chars >= 2000").agg({"near_edited": "avg"}).first()[0] > 0.45


def test_edit_is_located():
    text = "\n".join(texts(3, 30))
    place = text.index(". ", len(text) // 2) + 2
    a, b = merkle.tree(text), merkle.tree(text[:place] + "Other " + text[place:])
    assert merkle.first_difference(a, b) == place
    assert merkle.likeness(a, b) > 0.95 and merkle.likeness(a, a) == 1.0


def brute_score(model, letters):
    total = 0.0
    for path in itertools.product(range(len(model.start)), repeat=len(letters)):
        p = model.start[path[0]] * model.emit[letters[0], path[0]]
        for (s, t), x in zip(zip(path, path[1:]), letters[1:]):
            p *= model.move[s, t] * model.emit[x, t]
        total += p
    return math.log10(total)


def small_model(rng, states=3, letters=5):
    start, move, emit = rng.random(states), rng.random((states, states)), rng.random((letters, states))
    return hmm.Model(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0))


@pytest.mark.parametrize("piece, group", [(1024, 1 << 19), (2, 1 << 19), (1, 2), (3, 4)])
def test_forward_and_counts(monkeypatch, piece, group):
    """Also where sequences are cut: the chain is carried over the cuts."""
    monkeypatch.setattr(hmm, "SEQUENCE", piece)
    monkeypatch.setattr(hmm, "GROUP", group)
    rng = np.random.default_rng(2)
    model = small_model(rng)
    sequences = [rng.integers(0, 5, n).astype(np.int32) for n in (4, 1, 6, 2, 4)]
    scores = hmm.forward(model, sequences)
    for s, x in zip(sequences, scores):
        assert x == pytest.approx(brute_score(model, s.tolist()), abs=1e-9)
    starts, moves, emits, total = hmm.expected(model, sequences)
    assert total == pytest.approx(scores.sum())
    e_start, e_move, e_emit = np.zeros(3), np.zeros((3, 3)), np.zeros((5, 3))
    for s in sequences:
        every = []
        for path in itertools.product(range(3), repeat=len(s)):
            p = model.start[path[0]] * np.prod([model.emit[x, t] for x, t in zip(s, path)])
            every.append((p * np.prod([model.move[a, b] for a, b in zip(path, path[1:])]), path))
        whole = sum(p for p, _ in every)
        for p, path in every:
            e_start[path[0]] += p / whole
            for a, b in zip(path, path[1:]):
                e_move[a, b] += p / whole
            for x, t in zip(s, path):
                e_emit[x, t] += p / whole
    assert np.allclose(starts, e_start) and np.allclose(moves, e_move) and np.allclose(emits, e_emit)


def test_cuts_change_nothing_in_long_sequences(monkeypatch):
    rng = np.random.default_rng(4)
    model = small_model(rng, 6, 40)
    model = hmm.Model(model.start, *hmm.renewed(model.start, np.eye(6) * 1e6, model.emit * 1e-3)[1:])
    sequences = [rng.integers(0, 40, n).astype(np.int32) for n in (5000, 1, 1024, 1025, 2048, 300)]
    found = [hmm.forward(model, sequences), *hmm.expected(model, sequences)]
    monkeypatch.setattr(hmm, "SEQUENCE", 10_000)
    for x, y in zip(found, [hmm.forward(model, sequences), *hmm.expected(model, sequences)]):
        assert np.allclose(x, y, rtol=1e-3, atol=1e-3)


def held(doc):
    return zlib.crc32(str(doc).encode() if doc is not None else b"") % 10 == 0


def words_of(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return lowered.encode().split() + ["end"]


@pytest.mark.parametrize("own, known", [(20, 30), (1 << 10, 1 << 12)])
def test_scores(spark, own, known):
    rows = list(enumerate(texts(5, 60))) + [(i, f"Only{i} HERE") for i in range(100, 130)] + [(200, None), (200, None), (None, "x")]
    found = hmm.scores(frame(spark, rows), 2, own, known, 1).collect()
    counts = Counter(w for d, t in rows if not held(d) for w in words_of(t))
    total, distinct = sum(counts.values()), len(counts)
    expected = []
    for d, t in rows:
        w = words_of(t)
        base = sum(math.log10((counts[x] + 0.1) / (total + 0.1 * (distinct + 1))) for x in w)
        expected.append((d, held(d), len(w), sum(counts[x] > 0 for x in w), total, round(base, 6)))
    assert sorted(map(repr, expected)) == sorted(repr((*tuple(r)[:5], round(r.base_score, 6))) for r in found)
    assert all(r.score < 0 for r in found)


def test_scores_sum_to_one(spark):
    """Over all single tokens, an unseen one for each class included, the model's probabilities sum to one."""
    rows = list(enumerate(texts(6, 30))) + [(i, f"rare{i} words{i}x") for i in range(100, 140)]
    docs = hmm.source(frame(spark, rows))
    counts = hmm.count_words(docs)
    words = hmm.common_words(counts, 6, 12)
    seen = counts.collect()
    letters = [hmm.encode(words, np.array([r.h]).view(np.uint64), np.array([r.kind]))[0][0] for r in seen]
    shares = np.zeros(6 + hmm.CLASSES)
    for r, x in zip(seen, letters):
        if x >= 6:
            shares[x] += (r.n + 0.1) / (words.class_total[r.kind] + 0.1 * (words.class_distinct[r.kind] + 1))
    for kind in range(hmm.CLASSES):
        shares[6 + kind] += 0.1 / (words.class_total[kind] + 0.1 * (words.class_distinct[kind] + 1))
    assert np.allclose(shares[6:], 1)


def test_better_than_the_base(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = hmm.scores(docs).where("held_out").toPandas()
    assert len(rows) > 50
    assert (rows.score - rows.base_score).sum() / rows.n_tokens.sum() > 0.1
    assert ((rows.score > rows.base_score).mean()) > 0.9


def test_states_see_all_documents(spark):
    """Words that stand only late in long texts get a state of their own, and one pass keeps it."""
    rng = random.Random(4)
    some = lambda kind, n: " ".join(f"{kind}{rng.randrange(30)}" for _ in range(n))
    long = [d for d in range(40) if not held(d)][:16]
    rows = [(d, some("a", 8 * 1024) + " " + some("b", 1024)) for d in long]
    only = next(d for d in range(100, 200) if held(d))
    found = hmm.scores(frame(spark, [*rows, (only, some("b", 200))]), 2, 1 << 10, 1 << 12, 1).where(f"doc_id = {only}")
    score = found.collect()[0].score / 200
    assert score > math.log10(1 / 30) - 0.1


def test_training_settles(spark):
    """Without a number of passes, training goes on until one more pass hardly raises the likelihood."""
    rows = hmm.encoded(hmm.source(frame(spark, list(enumerate(texts(8, 40))))), spark.sparkContext.broadcast(
        hmm.common_words(hmm.count_words(hmm.source(frame(spark, list(enumerate(texts(8, 40)))))), 20, 30)))
    start = hmm.beginning(rows, 20 + hmm.CLASSES, 2)
    settled = hmm.trained(rows, start)
    after, likelihood = hmm.one_pass(rows, settled)
    assert hmm.one_pass(rows, after)[1] - likelihood < 2 * hmm.SETTLED * abs(likelihood)
    assert likelihood > hmm.one_pass(rows, start)[1]


def test_no_training(spark):
    rows = [(d, "a b") for d in range(200) if held(d)]
    assert {(r.train_tokens, r.score) for r in hmm.scores(frame(spark, rows)).collect()} == {(0, 0.0)}
    assert hmm.scores(spark.createDataFrame([], DOCS)).collect() == []


def brute_nearest(rows, queries, k):
    out = []
    for q, x in queries:
        far = sorted((math.dist(x, y), i) for i, y in {(i, tuple(y)) for i, y in rows} if i != q and len(y) == len(x))
        out += [(q, r + 1, i, d) for r, (d, i) in enumerate(far[:k])]
    return out


def test_recall(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in vectors.collect()]
    found = hnsw.nearest(vectors, vectors.where("vec_id % 100 = 0"), shard=600).collect()
    expected = brute_nearest(rows, [r for r in rows if r[0] % 100 == 0], 10)
    assert len(found) == len(expected)
    recall = len({(r.query_id, r.id) for r in found} & {(q, i) for q, _, i, _ in expected}) / len(expected)
    assert recall >= 0.97
    exact = {(q, i): d for q, _, i, d in expected}
    assert all(math.isclose(r.score, exact[r.query_id, r.id], rel_tol=1e-12) for r in found if (r.query_id, r.id) in exact)


def test_copies_and_odd_vectors(spark):
    rng = random.Random(8)
    rows = [(i, [rng.random(), rng.random(), 1.0]) for i in range(60)]
    rows += [(100 + i, rows[3][1]) for i in range(40)] + [rows[5], rows[5], (5, [0.0, 2.0, 1.0]), (300, [1.0, 2.0])]
    odd = [(200, None), (201, []), (202, [0.0, 0.0, 0.0]), (203, [float("nan"), 1.0, 1.0]), (204, [float("inf"), 1.0, 1.0]),
           (205, [None, 1.0, 1.0]), (None, [1.0, 1.0, 1.0])]
    vectors = spark.createDataFrame([(i, v, 1.0, 2) for i, v in rows + odd],
                                    "vec_id long, embedding array<double>, score double, rank int").repartition(3)
    wanted = [(i, v) for i, v in rows if i in (0, 3, 100, 120, 300)]
    found = hnsw.nearest(vectors, vectors.where("vec_id in (0, 3, 100, 120, 300, 200, 202)"), shard=20).collect()
    assert sorted((r.query_id, r.rank, r.id, round(r.score, 9)) for r in found) == sorted(
        (q, r, i, round(d, 9)) for q, r, i, d in brute_nearest(rows, wanted, 10))
    none = spark.createDataFrame([], "vec_id long, embedding array<double>")
    assert hnsw.nearest(none, none).collect() == []
    assert len(hnsw.nearest(vectors, vectors, k=200).collect()) > 0


def test_queries_and_graphs_are_not_copied_for_each_other(spark, monkeypatch):
    """Several shards, blocks and broadcasts; no table holds a block of queries or a graph more than once."""
    plans, sizes, write = {}, {}, hnsw.written

    def look(df, name):
        out = write(df, name)
        plans.setdefault(name, []).append(df._jdf.queryExecution().executedPlan().toString())
        sizes[name] = out.count()
        return out

    monkeypatch.setattr(hnsw, "written", look)
    monkeypatch.setattr(hnsw, "BLOCK", 4)
    monkeypatch.setattr(hnsw, "SENT", 256, raising=False)
    rng = random.Random(9)
    rows = [(i, [rng.random(), rng.random(), 1.0]) for i in range(90)] + [(7, [0.5, 0.5, 1.0]), (91, [0.5, 0.5, 1.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    found = hnsw.nearest(vectors, vectors.where("vec_id < 30"), shard=20).collect()
    expected = brute_nearest(rows, [(q, [x for i, x in rows if i == q][0]) for q in range(30) if q != 7], 10)
    assert sorted((r.query_id, r.rank, r.id, round(r.score, 9)) for r in found if r.query_id != 7) == sorted(
        (q, r, i, round(d, 9)) for q, r, i, d in expected)
    assert sorted(r.rank for r in found if r.query_id == 7) == list(range(1, 11))
    assert len(plans["nearest"]) > 1 and sizes["blocks"] <= 8
    assert not any("SortMergeJoin" in x or "Generate" in x for x in plans["nearest"])

"""The n-gram join against all pairs."""

import random

import numpy as np
import pytest

from tillstar.llm import ngram_join, sums
from tillstar.llm.components import components
from tillstar.llm.scratch import CLEANUP, HASHED

DOCS = "doc_id long, text string, n long, label string"


def test_tables_of_counts_are_deleted_when_added(spark, monkeypatch):
    seen, add = [], ngram_join.added

    def watched(parts, kind):
        seen.append(spark.conf.get(CLEANUP, "false"))
        return add(parts, kind)

    monkeypatch.setattr(ngram_join, "added", watched)
    levels = ngram_join.sketch(spark.createDataFrame([(1, "a b c d e"), (2, "a b c d"), (3, None)], "doc_id long, text string"), 4)
    assert seen == ["true"] and spark.conf.get(CLEANUP, "false") == "false"
    assert sorted(levels[levels > 0].tolist()) == [1]  # one gram in two documents


def test_rounds_join_small_sides_by_hash(spark, monkeypatch):
    seen, group = [], ngram_join.components

    def watched(links):
        seen.append(spark.conf.get(HASHED))
        return group(links)

    monkeypatch.setattr(ngram_join, "components", watched)
    before = spark.conf.get(HASHED)
    spark.conf.set(HASHED, "3m")
    try:
        docs = spark.createDataFrame([(1, "a b c d e"), (2, "a b c d e "), (3, "a b c d e f"), (4, None)], "doc_id long, text string")
        kept = ngram_join.one_each(docs, 2, 80)
        assert seen and set(seen) == {"16m"} and spark.conf.get(HASHED) == "3m"
    finally:
        spark.conf.set(HASHED, before)
    assert sorted(r.doc_id for r in kept.collect()) == [1, 4]


def test_sums_of_few_tasks_take_one_level(spark, monkeypatch):
    rows = [(i % 2, np.array([i, 1], np.int64).tobytes()) for i in range(9)]
    parts = spark.createDataFrame(rows, "slice int, sums binary")
    two = {k: v.tolist() for k, v in sums.added(parts, np.int64).items()}
    monkeypatch.setattr(sums, "SPREAD", 4)
    assert {k: v.tolist() for k, v in sums.added(parts, np.int64, 5).items()} == two == {0: [20, 5], 1: [16, 4]}
    monkeypatch.setattr(sums.F, "spark_partition_id", None)  # of the first level only
    assert {k: v.tolist() for k, v in sums.added(parts, np.int64, 4).items()} == two


def test_pairs_of_stars_come_sized(spark, monkeypatch):
    """They carry their sizes and are of different components, without joins for either."""
    seen, check = [], ngram_join.verified

    def watched(docs, nodes, pairs, *rest):
        seen.append([r.asDict() for r in pairs.collect()])
        return check(docs, nodes, pairs, *rest)

    monkeypatch.setattr(ngram_join, "verified", watched)
    words = [f"w{i}" for i in range(120)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:118])), (3, " ".join(words[:60]))]
    found = ngram_join.linked(frame(spark, rows)).select("doc_id", "n_shingles", "component_id").collect()
    assert key(found) == key(brute(rows))
    assert [sorted((p["na"], p["nb"])) for pairs in seen for p in pairs] == [[115, 117]]


def test_pairs_of_unlike_sizes_go_before_wide_columns(spark):
    nodes = spark.createDataFrame([(1, 100), (2, 85), (3, 84), (4, 117), (5, 118)], "node long, n long")
    pairs = spark.createDataFrame([(1, n) for n in (2, 3, 4, 5)], "a long, b long")
    assert sorted(map(tuple, ngram_join.sized(pairs, nodes, 85).collect())) == [(1, 2, 100, 85), (1, 4, 100, 117)]


def brute(rows, gram=4, percent=85):
    sets = []
    for _, text in rows:
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        w = lowered.encode().split()
        sets.append({tuple(w[i:i + gram]) for i in range(len(w) - gram + 1)} if len(w) >= gram else {tuple(w)} - {()})
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((doc, len(sets[i]), min(ids) if sets[i] and ids else doc))
    return out


def made_rows(seed, n=120):
    rng = random.Random(seed)
    word = lambda: rng.choice("the of to Alpha beta gamma delta é ü zeta".split()) + str(rng.randint(0, 30))
    common = [word() for _ in range(25)]
    originals = [[word() for _ in range(rng.randint(1, 90))] for _ in range(12)]
    rows = []
    for i in range(n):
        w = list(rng.choice(originals))
        for _ in range(rng.choice((0, 0, 1, 1, 2, 3, 5))):
            w[rng.randrange(len(w))] = word()
        if rng.random() < 0.4:
            w = common + w
        rows.append((i * 2, " ".join(w).upper() if rng.random() < 0.1 else " \n".join(w)))
    return rows + [(900, rows[0][1]), (900, rows[0][1]), (900, "one"), (901, "One"), (902, "one two"), (903, None),
                   (904, ""), (905, " \t"), (None, rows[3][1]), (None, None), (906, "a b c d " * 900)]


def frame(spark, rows):
    return spark.createDataFrame([(d, t, 7, "x") for d, t in rows], DOCS).repartition(3)


def key(rows):
    return sorted(map(repr, map(tuple, rows)))


@pytest.mark.parametrize("seed", [1])
def test_all_pairs(spark, seed):
    rows = made_rows(seed)
    found = ngram_join.linked(frame(spark, rows)).select("doc_id", "n_shingles", "component_id").collect()
    assert key(found) == key(brute(rows))


def test_blocks(spark, monkeypatch):
    """One n-gram with many nodes in different components is compared block by block."""
    monkeypatch.setattr(ngram_join, "BLOCK", 7)
    rng = random.Random(5)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(40):
        w = list(base)
        for _ in range(rng.randint(0, 5)):
            w[rng.randrange(60)] = f"x{rng.randint(0, 5)}"
        rows.append((i, " ".join(w)))
    monkeypatch.setattr(ngram_join, "ROUNDS", 1)
    found = ngram_join.linked(frame(spark, rows), 2, 80).select("doc_id", "n_shingles", "component_id").collect()
    assert key(found) == key(brute(rows, 2, 80))


def test_pairs_grow_with_a_dense_group_not_its_square(spark, monkeypatch):
    """Nodes that link with a part of a group are joined to it by their nearest ones before all pairs are formed."""
    counted, check = [], ngram_join.verified

    def watched(docs, nodes, pairs, *rest):
        counted.append(pairs.count())
        return check(docs, nodes, pairs, *rest)

    monkeypatch.setattr(ngram_join, "verified", watched)
    rng = random.Random(9)
    rows = []
    for i in range(240):
        w = [f"w{k}" for k in range(120)]
        for _ in range(rng.choice((0, 1, 2, 3, 4, 4, 4))):
            w[rng.randrange(120)] = f"x{rng.randint(0, 999)}"
        rows.append((i, " ".join(w)))
    found = ngram_join.linked(frame(spark, rows)).select("doc_id", "n_shingles", "component_id").collect()
    assert key(found) == key(brute(rows))
    assert sum(counted) <= 6 * len(rows), counted


def test_one_each(spark):
    rows = made_rows(3)
    found = ngram_join.one_each(frame(spark, rows))
    assert found.columns == ["doc_id", "text", "n", "label"]
    expected = [(r, c) for r, (_, _, c) in zip(rows, brute(rows)) if c == r[0]]
    ids = sorted(repr(r.doc_id) for r in found.collect())
    by_doc = {}
    for (doc, text), c in expected:
        by_doc.setdefault((repr(doc), "" if not (text or "").split() else text and text.lower() if doc == 900 else ""), 0)
    assert set(ids) == {repr(r[0]) for r, _ in expected}
    assert ids.count("900") == 1  # "one"; the copies of the first document go
    assert ids.count("903") == ids.count("904") == ids.count("905") == 1


def test_components(spark):
    chain = [(i, i + 1) for i in range(50)] + [(100, 90), (90, 100), (7, 7), (200, 201), (202, 201)]
    found = {r.node: r.label for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(51)}, 100: 90, 90: 90, 200: 200, 201: 200, 202: 200}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_empty(spark):
    none = spark.createDataFrame([], DOCS)
    assert ngram_join.linked(none).collect() == [] and ngram_join.one_each(none).collect() == []


def test_distinct_pairs():
    rng = random.Random(3)
    parts = [np.array([[rng.randint(-3, 3) for _ in range(n)] for _ in range(2)], np.int64) for n in (1, 40, 0, 25)]
    found = ngram_join._distinct(parts).T.tolist()
    assert sorted(map(tuple, found)) == sorted({tuple(p) for part in parts for p in part.T.tolist()})

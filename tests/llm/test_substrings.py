"""Both substring operators against brute force."""

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tillstar.llm import passages, substring_dedup, suffix_arrays, windows

DOCS = "doc_id long, text string, lang string, row string"


def spread(covered):
    return sum(a and not b for a, b in zip(covered, [False, *covered]))


def brute_bytes(rows, window):
    bodies = [(t or "").encode() for _, t in rows]
    seen = {}
    for b in bodies:
        for i in range(len(b) - window + 1):
            seen[b[i:i + window]] = seen.get(b[i:i + window], 0) + 1
    out = []
    for (doc, _), b in zip(rows, bodies):
        gone = [False] * len(b)
        for i in range(len(b) - window + 1):
            if seen[b[i:i + window]] > 1:
                gone[i:i + window] = [True] * window
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((doc, len(b), sum(gone), spread(gone), hashlib.sha256(kept).hexdigest()))
    return out


def brute_words(rows, window):
    lists = [(t or "").encode().split() for _, t in rows]
    first = {}
    for (doc, _), w in zip(rows, lists):
        doc = float("inf") if doc is None else doc
        for i in range(len(w) - window + 1):
            k = tuple(w[i:i + window])
            first[k] = min(first.get(k, doc), doc)
    out = []
    for (doc, _), w in zip(rows, lists):
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i:i + window])] < (float("inf") if doc is None else doc):
                gone[i:i + window] = [True] * window
        kept = b" ".join(c for c, g in zip(w, gone) if not g)
        out.append((doc, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


def made_rows(seed=1, n=60):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcé ") for _ in range(rng.randint(1, 4)))
    shared = [" ".join(word() for _ in range(rng.randint(8, 120))) for _ in range(6)]
    rows = []
    for i in range(n):
        parts = [" ".join(word() for _ in range(rng.randint(0, 60)))]
        for _ in range(rng.randint(0, 2)):
            cut = rng.choice(shared)
            parts.insert(rng.randint(0, len(parts)), cut[rng.randint(0, 40):])
        rows.append((i * 3, "\n".join(parts)))
    rows += [(1000, rows[0][1]), (1001, rows[0][1]), (1001, rows[0][1]), (1001, "x y"), (None, rows[1][1]),
             (None, rows[1][1]), (1002, None), (1003, ""), (1004, "a " * 3000), (1005, "ab" * 400), (1006, "\x0b\x0c\r\t ")]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "en", "clash") for d, t in rows], DOCS).repartition(3)


def as_set(rows):
    return sorted(map(repr, map(tuple, rows)))


def test_bytes(spark):
    rows = made_rows()
    for window in (200, 40):
        assert as_set(suffix_arrays.repeat_digests(frame(spark, rows), window).collect()) == as_set(brute_bytes(rows, window))


def test_words(spark):
    rows = made_rows(2)
    for window in (13, 6):
        assert as_set(substring_dedup.repeat_digests(frame(spark, rows), window).collect()) == as_set(brute_words(rows, window))


def test_texts_are_kept(spark):
    rows = [(1, "a b c d"), (2, "x a b c y")]
    found = substring_dedup.without_repeats(frame(spark, rows), 3).collect()
    assert sorted((r.doc_id, r.kept) for r in found) == [(1, "a b c d"), (2, "x y")]
    found = suffix_arrays.without_repeats(frame(spark, rows), 5).collect()
    assert sorted((r.doc_id, bytes(r.kept)) for r in found) == [(1, b"d"), (2, b"x y")]  # the space after c is shared


def test_empty(spark):
    none = spark.createDataFrame([], DOCS)
    assert suffix_arrays.repeat_digests(none).collect() == []
    assert substring_dedup.repeat_digests(none).collect() == []


def test_hot_key_is_refined():
    rng = np.random.default_rng(3)
    middle = rng.integers(0, 4, 150).astype(np.uint8)
    members = [(i, 0, np.concatenate((rng.integers(0, 4, 60), middle, rng.integers(0, 4, 60))).astype(np.uint8)) for i in range(40)]
    members += [(40 + i, 0, members[i][2].copy()) for i in range(10)]
    seen = {}
    for i, _, b in members:
        for j in range(len(b) - 200 + 1):
            seen.setdefault(b[j:j + 200].tobytes(), []).append((i, j))
    expected = {p for places in seen.values() if len(places) > 1 for p in places}
    parts = list(passages.refined(members, 200, 32, 1000))
    found = {(i, start + int(j)) for part in parts
             for (i, start, _), hits in zip(part, suffix_arrays.repeated_starts([b for *_, b in part], 200)) for j in hits}
    assert len(parts) > 1 and found == expected


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=200), st.booleans())
def test_suffix_array(symbols, wide):
    text = np.array([*symbols, 0], np.int64)
    expected = sorted(range(len(text)), key=lambda i: text[i:].tolist())
    found = suffix_arrays.suffix_array(text, 5 if wide else 2000)
    assert found.tolist() == expected
    before, length = suffix_arrays.permuted_prefixes(text, found)
    for a, b in zip(expected, expected[1:]):
        common = next(k for k in range(len(text)) if max(a, b) + k >= len(text) or text[a + k] != text[b + k])
        assert before[b] == a and length[b] == common


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), min_size=1, max_size=30), min_size=1, max_size=8), st.integers(1, 5))
def test_automaton(sequences, window):
    automaton = substring_dedup.Automaton()
    for owner, s in enumerate(sequences):
        automaton.add(s, owner)
    automaton.close()
    for s in sequences:
        expected = [min(o for o, t in enumerate(sequences) for j in range(len(t) - window + 1)
                        if t[j:j + window] == s[i:i + window]) for i in range(len(s) - window + 1)]
        assert automaton.first_owner(s, window) == expected


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab \t\x0bé\x1c", max_size=20), min_size=1, max_size=6))
def test_words_of_bytes(texts):
    bodies = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(bodies), np.uint8)
    offsets = np.cumsum([0, *map(len, bodies)])
    starts, ends, per = windows.words(data, offsets)
    found = [[data[x:y].tobytes() for x, y in zip(starts[a:z], ends[a:z])] for a, z in zip(per, per[1:])]
    assert found == [b.split() for b in bodies]
    hashes = windows.word_hashes(data, starts, ends)
    flat = [w for f in found for w in f]
    assert len(set(hashes.tolist())) == len(set(flat))
    assert len({(w, h) for w, h in zip(flat, hashes.tolist())}) == len(set(flat))


@pytest.mark.parametrize("by_word", [False, True])
def test_long_documents_in_pieces(monkeypatch, by_word):
    """Windows of a text with more symbols than positions fit: each stands once, with a gram that its equals share."""
    monkeypatch.setattr(windows, "POSITION_BITS", 18)
    rng, window, gram = np.random.default_rng(3), 13, 8
    words = rng.integers(97, 123, 350_000).astype(np.uint8)
    words[300_000: 300_400] = words[200: 600]
    body = bytes(words) if not by_word else b" ".join(bytes([c, c]) for c in words)
    text = body if not by_word else body + b" "
    data = np.frombuffer(text + b"next", np.uint8)
    seen = {}
    for a, base, raw, part, ends, first, last in passages.parts(data, np.array([0, len(text), len(data)]), window, by_word):
        if a or len(part) < window:
            continue
        hashes = windows.gram_hashes(part, gram)
        at = windows.least_gram(hashes, window, gram)
        assert np.all((at >= np.arange(len(at))) & (at <= np.arange(len(at)) + window - gram))
        for i in np.flatnonzero(windows.inside(ends, window)).tolist():
            assert base + i not in seen
            seen[base + i] = int(hashes[at[i]])
    assert sorted(seen) == list(range(350_000 - window + 1))
    assert all(seen[200 + i] == seen[300_000 + i] for i in range(400 - window + 1))


def workers(node, most):
    """Python functions that a task of this node's stage runs at once; the largest such number goes to ``most``."""
    children = node.children()
    below = [workers(children.apply(i), most) for i in range(children.size())]
    if "Adaptive" in node.nodeName():
        return workers(node.initialPlan(), most)
    if "Exchange" in node.nodeName():
        return 0
    here = max(below, default=0) if "Union" in node.nodeName() else sum(below)  # a task has a part of one of a union's sides
    here += "Arrow" in node.nodeName()
    most.append(here)
    return here


def test_rewritten_runs_one_python_function_a_task(spark):
    window = "a b c d e f g h i j k l m"
    rows = [(1, f"x  {window} y", "en", "r"), (2, f"u {window}\n v", "de", None), (3, None, None, "r"), (4, "", "en", "r"),
            (None, f"{window} w", "en", "r"), (5, "other words", "en", "r")]
    out = substring_dedup.rewritten(spark.createDataFrame(rows, DOCS))
    most = []
    workers(out._jdf.queryExecution().executedPlan(), most)
    assert max(most) == 1
    assert sorted((r.doc_id or 0, r.text, r.lang, r.row) for r in out.collect()) == [
        (0, " w", "en", "r"), (1, f"x  {window} y", "en", "r"), (2, "u \n v", "de", None), (3, None, None, "r"),
        (4, "", "en", "r"), (5, "other words", "en", "r")]


def test_repeat_late_in_a_very_long_text(spark):
    passage = "".join(random.Random(9).choice("abcdefghij") for _ in range(400))
    numbers = F.transform(F.sequence(F.lit(0), F.lit(2_100_000)), lambda i: F.hex(F.xxhash64(i)))
    long = spark.range(1).select(F.lit(1).cast("long").alias("doc_id"), F.concat(
        F.array_join(numbers, "-"), F.lit("|" + passage)).alias("text"))
    docs = long.unionByName(spark.createDataFrame([(2, passage + "!")], "doc_id long, text string"))
    found = {r.doc_id: r for r in suffix_arrays.repeat_digests(docs).collect()}
    assert found[1].n_bytes > 1 << windows.POSITION_BITS
    assert found[2].n_removed == 400 and found[1].n_removed >= 400

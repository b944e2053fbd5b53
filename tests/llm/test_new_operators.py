"""Value dictionaries, collocations and mixing against plain Python, on small and on unfriendly tables."""

import hashlib
import itertools
import math
import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tillstar.llm import codebooks, collocations, mixing

# -- 11: codebooks ------------------------------------------------------------------------------------------------------------


def brute_codes(rows, parts, entries, rounds):
    """Rows (id, label, vector) that take part, by plain integers."""
    rows = [(i, label, [math.floor(1024 * x) for x in v]) for i, label, v in rows]
    first = sorted(rows, key=lambda r: (r[0] is None, r[0], r[2]))[:entries]
    width = len(first[0][2]) // parts
    cut = lambda v, p: v[p * width: (p + 1) * width]
    books = [[cut(v, p) for *_, v in first] for p in range(parts)]

    def nearest(part, p):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            members = {}
            for *_, v in rows:
                members.setdefault(nearest(cut(v, p), p)[1], []).append(cut(v, p))
            for k, found in members.items():
                books[p][k] = [sum(c) // len(found) for c in zip(*found)]
    out = []
    for i, label, v in rows:
        best = [nearest(cut(v, p), p) for p in range(parts)]
        out.append((i, label, [k for _, k in best], sum(d for d, _ in best)))
    return out, books


def vectors(seed, n, width):
    rng = random.Random(seed)
    near = [[rng.uniform(-1, 1) for _ in range(width)] for _ in range(5)]
    out = []
    for i in range(n):
        v = [x + rng.gauss(0, 0.05) for x in rng.choice(near)]
        out.append((rng.choice([i, i, i // 2]), rng.choice([None, 1, 2]), v))
    return out + out[:3]


@pytest.mark.parametrize("n, width, entries", [(40, 8, 6), (3, 4, 256), (200, 12, 256)])
def test_codes(spark, n, width, entries):
    rows = vectors(n, n, width)
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").repartition(3)
    found, books = codebooks.compressed(df, entries=entries, rounds=3)
    want, want_books = brute_codes(rows, 4, entries, 3)
    key = lambda r: (r[0], str(r[1]), r[2], r[3])
    got = sorted(((r.id, r.label and int(r.label), list(r.code), r.error) for r in found.collect()), key=key)
    assert got == sorted(want, key=key) and books.tolist() == want_books


def test_code_digests_match_plain_ones(spark):
    rows = vectors(5, 60, 8)
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").withColumn("error", F.lit(9))
    want, books = brute_codes(rows, 4, 256, 4)
    by_label = Counter()
    for _, label, _, error in want:
        by_label[label] += error
    sha = hashlib.sha256(",".join(str(x) for p in books for e in p for x in e).encode()).hexdigest()
    got = sorted(tuple(r) for r in codebooks.code_digests(df).collect())
    assert got == sorted((i, "".join(f"{k:02x}" for k in code), error, by_label[label], sha) for i, label, code, error in want)


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, i % 2, [i / 7, -i / 9, i * 3.0, 0.5]) for i in range(9)]
    bad = [(100, 1, None), (101, 1, [1.0, None, 2.0, 3.0]), (102, 1, [1.0, nan, 2.0, 3.0]), (103, 1, [1.0, inf, 2.0, 3.0]),
           (104, 1, [1.0] * 5), (105, 1, [1.0] * 8), (106, 1, []), (107, 1, [1e300, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame(bad + good + [(None, None, [0.0] * 4)], "vec_id long, label int, embedding array<double>")
    found, _ = codebooks.compressed(df)
    assert sorted(r.id is None or r.id for r in found.collect()) == sorted([True, *range(9)], key=int)
    assert all(r.error == 0 for r in found.collect())  # every vector is an entry
    large = spark.createDataFrame([(0, 1, [100000.0, 0.0, 0.0, 0.0]), (1, 1, [-100000.0, 0.5, 0.0, 0.0])], df.schema)
    found, books = codebooks.compressed(large, entries=1, rounds=1)
    want, want_books = brute_codes([tuple(r) for r in large.collect()], 4, 1, 1)
    assert sorted((r.id, r.error) for r in found.collect()) == [(w[0], w[3]) for w in want] and books.tolist() == want_books


def test_codes_of_nothing(spark):
    for rows in ([], [(1, 1, None), (2, 1, [1.0])]):
        df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
        assert codebooks.code_digests(df).collect() == []
        assert codebooks.code_digests(df).columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


def test_blocks_of_many_vectors(spark):
    """More vectors than a block holds, from one task, in the order they came."""
    n = 2 * codebooks.BLOCK + 5
    df = spark.range(n).coalesce(1).selectExpr("id", "cast(null AS string) label", "array(id / 1000, id % 7, 0D, 1D) vector")
    table = codebooks.blocks(df, 4).collect()
    assert [len(r.ids) for r in table] == [codebooks.BLOCK, codebooks.BLOCK, 5]
    assert [i for r in table for i in r.ids] == list(range(n))


# -- 12: collocations ---------------------------------------------------------------------------------------------------------


def plain_counts(rows):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for n in range(1, 6):
                for i in range(len(words) - n + 1):
                    counts[lang, tuple(words[i: i + n])] += 1
    return counts, totals


def plain_collocations(rows, least, share, best):
    counts, totals = plain_counts(rows)
    found = {}
    candidates = {k: a for k, a in counts.items() if a >= least and len(k[1]) >= 2}
    for (lang, words), a in candidates.items():
        dropped = any(
            other == lang and len(longer) > len(words) and 100 * f >= share * a
            and any(longer[i: i + len(words)] == words for i in range(len(longer) - len(words) + 1))
            for (other, longer), f in candidates.items())
        if not dropped:
            cuts = []
            for k in range(1, len(words)):
                l, r = counts[lang, words[:k]], counts[lang, words[k:]]
                cuts.append((1000 * a * totals[lang] // (l * r), k, l, r))
            score, _, l, r = min(cuts)
            found.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), l, r))
    out = []
    for lang, rows in found.items():
        for rank, (score, a, phrase, l, r) in enumerate(sorted(rows)[:best], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return sorted(out)


def word_texts(seed, n):
    rng = random.Random(seed)
    words = ["a", "B", "c", "dé", "é", "x\x0b", "zz", "\x1c", "a.", "b,", "C"]
    phrases = ["new York city", "of the  year", "one\ttwo three four five", "a a a a"]
    rows = []
    for _ in range(n):
        parts = rng.choices(words, k=rng.randint(0, 30)) + rng.choices(phrases, k=rng.randint(0, 3))
        rng.shuffle(parts)
        rows.append((rng.choice(["en", "en", "fr", None, "und", ""]), rng.choice([" ", "  ", "\t"]).join(parts)))
    return rows + [("en", None), (None, ""), ("fr", " \t. ,"), ("x", "a")] + rows[:3]


@pytest.mark.parametrize("seed, least, share, best", [(1, 4, 100, 2000), (2, 3, 60, 5), (3, 8, 100, 1)])
def test_collocations(spark, seed, least, share, best, monkeypatch):
    monkeypatch.setattr(collocations, "GROUP", 64)
    monkeypatch.setattr(collocations, "PHRASES", 40)
    rows = word_texts(seed, 60)
    df = spark.createDataFrame(rows, "lang string, text string").withColumn("n", F.lit(1)).withColumn("phrase", F.lit("p"))
    got = sorted(tuple(r) for r in collocations.collocations(df.repartition(4), least, share, best).collect())
    assert got == plain_collocations(rows, least, share, best) and got


def test_collocations_of_nothing(spark):
    for rows in ([], [("en", None)], [("en", "a b c")]):
        df = spark.createDataFrame(rows, "lang string, text string")
        assert collocations.collocations(df).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.dictionaries(st.integers(0, 40), st.integers(1, 9), max_size=30), min_size=1, max_size=12),
       st.integers(2, 30))
def test_summaries_lose_no_frequent_hash(parts, least):
    """Merged in any pieces, a summary keeps all hashes with the threshold's count, within its counters."""
    mass = sum(min(c, least) for part in parts for c in part.values())
    summary = collocations.Summary(mass, least)
    total = Counter()
    for part in parts:
        keys = sorted(part)
        summary.add(np.array(keys, np.uint64), np.array([part[k] for k in keys], np.int64))
        summary.merge()
        assert len(summary.hashes) <= summary.room
        total.update(part)
    kept = set(summary.frequent(least).tolist())
    assert {k for k, n in total.items() if n >= least} <= kept
    assert summary.lost < least


def test_survivors_are_all_frequent_hashes(spark, monkeypatch):
    """With summaries that must drop hashes, what is left still has all frequent n-grams."""
    monkeypatch.setattr(collocations, "HELD", 50)
    monkeypatch.setattr(collocations, "ROW", 4)
    rng = random.Random(4)
    rows = [("en", " ".join(rng.choice(["hot", "pot", f"w{rng.randint(0, 3000)}"]) for _ in range(40))) for _ in range(80)]
    df = collocations.prepared(spark.createDataFrame(rows, "lang string, text string").repartition(3))
    found = {r.h for r in collocations.survivors(df, (1, 2), 30, 4).collect()}
    counts, _ = plain_counts(rows)
    wanted = [" ".join(k[1]) for k, n in counts.items() if n >= 30 and len(k[1]) <= 2]
    assert len(wanted) >= 6
    import pyarrow as pa
    for phrase in wanted:
        group = next(collocations.groups(pa.record_batch([pa.array(["en"]), pa.array([phrase])], ["lang", "text"])))
        assert group.grams(phrase.count(" ") + 1)[1].view(np.int64)[0] in found
    assert len(found) < len({k for k in counts if len(k[1]) <= 2}) / 4


# -- 13: mixing ---------------------------------------------------------------------------------------------------------------


def plain_targets(sizes, weights, percent, epochs):
    """Water-filling by rounds, in fractions: ``sizes`` by source, null last."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    budget, open_, out = Fraction(percent, 100) * sum(sizes.values()), set(order), {}
    while open_:
        total = sum(weight[s] for s in open_)
        above = {s for s in open_ if budget * weight[s] / total > epochs * sizes[s]}
        if not above:
            out |= {s: budget * weight[s] / total for s in open_}
            break
        out |= {s: Fraction(epochs * sizes[s]) for s in above}
        budget, open_ = budget - sum(epochs * sizes[s] for s in above), open_ - above
    return out


def documents(seed, n, sources=("a", "b", "é", "Z", None, "", "hot", "hot", "hot")):
    rng = random.Random(seed)
    rows = [(rng.choice([i, i // 3, None]) if i % 5 == 0 else i, rng.choice(sources),
             rng.choice([None, "", " \t"]) if rng.random() < 0.1 else " \x0b".join(["w"] * int(rng.paretovariate(0.8) + 1)))
            for i in range(n)]
    return [(i, s, t if t is None else t[:6000]) for i, s, t in rows] + rows[:2]


@pytest.mark.parametrize("seed, n, percent, epochs, weights", [
    (1, 300, 150, 2, (5, 2, 1)), (2, 40, 150, 2, (5, 2, 1)), (3, 200, 30, 3, (1, 7)), (4, 100, 400, 2, (1, 1, 50)), (5, 60, 199, 2, (9, 1))])
def test_mix(spark, seed, n, percent, epochs, weights):
    rows = documents(seed, n)
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumn("size", F.lit(7)).repartition(3)
    got = mixing.plan(df, weights, percent, epochs).collect()
    size = lambda t: len(re.findall(mixing.WORD, t or ""))
    sizes = Counter()
    for _, source, text in rows:
        sizes[source] += size(text)
    want = plain_targets(sizes, weights, percent, epochs)
    source_of = {}
    for doc, source, text in rows:
        source_of.setdefault((doc, size(text)), set()).add(source)
    assert sorted((str(r.doc_id), r.size) for r in got) == sorted((str(i), size(t)) for i, _, t in rows)
    taken = Counter()
    for r in got:
        assert 0 <= r.taken <= epochs * r.size
        fits = [s for s in source_of[r.doc_id, r.size] if sizes[s] == r.source_size and math.isclose(float(want[s]), r.target)]
        assert fits
        taken[r.source_size, r.target] += r.taken
    for s, target in want.items():
        same = [o for o in want if sizes[o] == sizes[s] and math.isclose(float(want[o]), float(target))]
        if sizes[s]:
            # words shared among rows of one id are rounded down in each
            near = next(v for (z, t), v in taken.items() if z == sizes[s] and math.isclose(t, float(target)))
            assert 0 <= sum(math.floor(want[o]) for o in same) - near <= 12 * len(same)
    again = mixing.plan(df.repartition(5), weights, percent, epochs).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_sample_gives_the_words_that_the_plan_takes(spark):
    rows = documents(7, 120)
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumn("copy", F.lit("x"))
    plan = Counter()
    for r in mixing.plan(df).collect():
        plan[r.doc_id, r.size] += r.taken
    words = Counter()
    for r in mixing.sample(df).collect():
        found = re.findall(mixing.WORD, r.text or "")
        assert found == re.findall(mixing.WORD, r.doc.text or "")[: len(found)] and r.doc.copy == "x"
        words[r.doc.doc_id, len(re.findall(mixing.WORD, r.doc.text or ""))] += len(found)
    assert +words == +plan


def test_another_seed_takes_other_documents(spark):
    df = spark.createDataFrame([(i, "a" if i % 4 else "b", "w " * (i % 9 + 1)) for i in range(400)], "doc_id long, source string, text string")
    a, b = ({(r.doc_id, r.taken) for r in mixing.plan(df, seed=s).collect()} for s in (0, 1))
    assert a != b and abs(sum(t for _, t in a) - sum(t for _, t in b)) <= 1


def test_mix_of_nothing(spark):
    schema = "doc_id long, source string, text string"
    assert mixing.plan(spark.createDataFrame([], schema)).collect() == []
    got = mixing.plan(spark.createDataFrame([(1, None, None), (2, "a", " ")], schema)).collect()
    assert sorted(tuple(r) for r in got) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]


def test_mixing_runs_in_the_jvm(spark):
    df = mixing.plan(spark.createDataFrame([(1, "a", "b c")], "doc_id long, source string, text string"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
    assert not list(itertools.chain(re.findall("import (?:numpy|pandas|pyarrow)", open(mixing.__file__).read())))

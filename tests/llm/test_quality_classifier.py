"""The quality classifier: held-out accuracy, the exchange of pseudo-labels, and the defined edge cases."""

import numpy as np
import pyarrow as pa
import pytest

from tillstar.llm import quality

DATA = "/root/testdata/sf0.1"
LABELS = "doc_id long, quality int, toxic int"


def test_held_out(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    train, test = labels.where("doc_id % 4 <> 0"), labels.where("doc_id % 4 = 0")
    rows = quality.scored(docs, train).join(test, "doc_id").toPandas()
    bad, good = rows[rows.quality == 0], rows[rows.quality == 1]
    assert len(rows) > 500 and (~bad.kept).mean() > 0.9 and good.kept.mean() > 0.97
    found = quality.kept(docs, train)
    assert found.columns == docs.columns and 0.7 < found.count() / docs.count() < 1


def test_views_teach_each_other():
    rng = np.random.default_rng(1)
    y = (rng.random(400) < 0.5).astype(np.float32)
    make = lambda y: tuple(np.column_stack([np.ones(len(y)), 6 * y - 3 + rng.normal(size=len(y))]).astype(np.float32)
                           for _ in range(2))
    pool_y = (rng.random(300) < 0.5).astype(np.float32)
    model = quality.co_train(make(y), y, make(pool_y))
    assert all(sum(given[v] for given in model["log"]) > 100 for v in range(2))
    new = make(pool_y)
    p = quality.probability(np.column_stack([new[v] @ model["weights"][v] for v in range(2)]), model["both"])
    assert ((p > 0.5) == (pool_y > 0.5)).mean() > 0.98


def test_a_weak_view_teaches_by_rank():
    """A view that is right more often than not, but never sure, hands on the first of each class; a useless one none."""
    rng = np.random.default_rng(2)

    def make(y, use):
        strong = np.column_stack([np.ones(len(y)), 6 * y - 3 + rng.normal(size=len(y))])
        weak = np.column_stack([np.ones(len(y)), use * (y - 0.5) + rng.normal(size=len(y))])
        return strong.astype(np.float32), weak.astype(np.float32)

    y, pool_y = (rng.random(2000) < 0.8).astype(np.float32), (rng.random(3000) < 0.8).astype(np.float32)
    model = quality.co_train(make(y, 0.6), y, make(pool_y, 0.6), first=0.1)
    assert all(given[0] > 2500 and 150 < given[1] <= 300 for given in model["log"])
    new = make(pool_y, 0.6)
    p = quality.probability(np.column_stack([new[v] @ model["weights"][v] for v in range(2)]), model["both"])
    assert ((p > 0.5) == (pool_y > 0.5)).mean() > 0.98
    same = tuple(np.ones((len(x), 1), np.float32) for x in (y, pool_y))
    model = quality.co_train((make(y, 1)[0], same[0]), y, (make(pool_y, 1)[0], same[1]))
    assert all(given[0] > 2500 and given[1] == 0 for given in model["log"])


def test_limits_and_trust():
    found = np.zeros(quality.BINS)
    found[[10, 3000, 3001, 3002, 3900]] = [2, 5, 80, 9, 4]
    low, high = quality.limits(found, 0.5, 0.99, 0.2)  # ten of a hundred for each class, ties left out
    assert found[: low + 1].sum() == 7 and found[high:].sum() == 4
    for share in (0.0, 0.3, 1.0):
        for one in (found, np.eye(quality.BINS)[-1], np.eye(quality.BINS)[0], np.eye(quality.BINS)[2000]):
            low, high = quality.limits(one, share, 0.95, 0.05)
            assert low < high
    y = np.array([0, 0, 1, 1, 1])
    assert quality.trust(np.array([1, 2, 3, 4, 5]), y) == 1 and quality.trust(np.array([5, 4, 3, 2, 1]), y) == 0
    assert quality.trust(np.ones(5), y) == 0 and quality.trust(np.ones(3), np.ones(3)) == 0


def test_every_unlabelled_document_teaches(spark):
    """Far more unlabelled documents than any sample would hold: all that a view is confident of are handed on."""
    bad, clean = "| # | # " * 4, "word other thing " * 3
    docs = spark.range(12_000).selectExpr("id as doc_id", f"if(id % 2 = 0, '{bad}', '{clean}') as text", "'en' as lang",
                                          "if(id % 2 = 0, 'bad', 'clean') as source", "30L as n_chars")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(600)], LABELS)
    model = quality.train(docs, labels)
    assert model["log"][0] == [11_400, 11_400]


def test_many_sources():
    names = pa.array([f"source {i}" for i in range(200)])
    found = quality.slots(names, names, pa.array([1] * 200))
    assert len(set(found[:, 1].tolist())) > 180


@pytest.mark.parametrize("labels, share", [([], 1.0), ([(1, 0, 0), (1, None, 0), (2, 0, 1)], 0.0), ([(None, 0, 0)], 1.0)])
def test_too_few_labels(spark, labels, share):
    docs = spark.createDataFrame([(1, "a b", "en", "s", 3, 0.5), (None, None, None, None, None, None), (1, "", "en", "s", 0, 0.1)],
                                 "doc_id long, text string, lang string, source string, n_chars long, score double")
    labels = spark.createDataFrame(labels, LABELS)
    assert [r.score for r in quality.scored(docs, labels).collect()] == [share] * 3
    assert quality.kept(docs, labels).count() == (3 if share else 0)


def test_nulls_repeats_and_empty(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, x string, score double"
    rows = [(i, "word other thing " * (i % 5) if i % 2 else "| # | # " * 9, "en", "s", 9, "k", 0.0) for i in range(80)]
    docs = spark.createDataFrame([*rows, rows[3], (None, None, None, None, None, None, None)], schema)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)] + [(3, None, None), (None, 1, 0)], LABELS)
    found = quality.scored(docs, labels).collect()
    assert len(found) == 82 and len({r.score for r in found if r.doc_id == 3}) == 1
    assert quality.kept(docs, labels).columns == docs.columns
    assert quality.scored(docs.where("false"), labels).collect() == []


def test_unlabelled_documents_are_found_without_their_texts(spark, monkeypatch):
    """Exactly the documents whose id has no label, null ids included, also where the bit tables err for most ids."""
    import numpy as np
    from tillstar.llm import passages
    from tillstar.llm.scratch import temporary

    rows = [(i if i % 50 else None, f"text {i}", None, "s", i) for i in range(1, 600)] + [(7, "again", "en", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    known = spark.createDataFrame([(i,) for i in range(0, 600, 3)], "doc_id long")
    want = sorted(map(str, quality.packed(docs.join(known, "doc_id", "left_anti")).collect()))
    assert len(want) == sum(r[0] is None or r[0] % 3 > 0 for r in rows)
    exact = passages.bit_table
    half = np.where(np.arange(1 << 17) % 2, 255, 0).astype(np.uint8)
    for table in (exact, lambda hashes: half | exact(hashes)):
        monkeypatch.setattr(quality.passages, "bit_table", table)
        with temporary(spark) as write:
            assert sorted(map(str, quality.unlabelled(docs, known, write).collect())) == want
        monkeypatch.undo()

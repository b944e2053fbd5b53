"""The pipeline's stages against brute force on a small table."""

import hashlib

import corpus_pipeline
from test_ngram_join import brute as near_groups
from test_substrings import brute_words

from tillstar.llm import quality

DATA = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    kept = stages["quality_classifier"](spark, docs, DATA)
    good = {r.doc_id for r in quality.scored(docs, labels).where("kept").collect()}
    assert kept.columns == columns and {r.doc_id for r in kept.collect()} == good
    clean = {r.doc_id for r in labels.where("quality = 1 and toxic = 0").collect()}
    assert len(good & clean) >= 0.97 * len(clean)
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    one = stages["ngram_jaccard_join"](spark, kept, DATA)
    found = one.collect()
    assert one.columns == columns
    assert sorted(r.doc_id for r in found) == sorted(d for d, _, c in near_groups(rows, 5, 80) if c == d)
    rest = stages["substring_dedup"](spark, one, DATA)
    assert rest.columns == columns and rest.schema == docs.schema
    texts = {r.doc_id: r for r in rest.collect()}
    expected = brute_words([(r.doc_id, r.text) for r in found], 13)
    for doc, n, removed, kept_hash in expected:
        r = texts[doc]
        assert hashlib.sha256(b" ".join(r.text.encode().split())).hexdigest() == kept_hash
        assert r.n_chars == len(r.text)
    packed = stages["best_fit_packing"](spark, rest, DATA).collect()
    assert {r.doc_id for r in packed} == set(texts)
    assert len(corpus_pipeline.run(spark, DATA).collect()) == len(packed)


def test_odd_rows_pass(spark):
    rows = [(1, "a b c d e f g", None, "s", 13, 0.5, 1, True, "x")] * 2 + [
        (None, None, "en", None, None, None, None, None, None), (2, "", "en", "s", 0, 1.0, 2, False, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, "
                                       "score double, row int, may boolean, spans string")
    stages = dict(corpus_pipeline.STAGES)
    for name in ("quality_classifier", "ngram_jaccard_join", "substring_dedup"):
        out = stages[name](spark, docs, DATA)
        assert out.columns == docs.columns, name
        assert out.count() == (3 if name == "ngram_jaccard_join" else 4), name
    assert stages["best_fit_packing"](spark, docs, DATA).count() == 4
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.where("false"), DATA).count() == 0, name

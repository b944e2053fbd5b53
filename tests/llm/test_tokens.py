"""Token output, packing and the lexicon against the library itself."""

import glob
import hashlib
import random
import zlib

import numpy as np
import pyarrow.orc as orc
import pytest
from hypothesis import given, settings, strategies as st
from public_tokenizers import path
from tokenizers import Tokenizer

from tillstar.llm import lexicon, orc_tokens, packing, tokens
from tillstar.llm.tokens import WordEncoder

WORD, BYTE = path("word_bpe_49k.json"), path("byte_bpe_50k.json")
DOCS = "doc_id long, text string, start long, piece string, ids int"
ODD = ["", None, " ", "\n\n a  b \x0b\x0c", "It's we're I'LL 'd", "x\x01y \x01 z", "á e ́ ẛ̣", "ΑΣ İ ŉ ß",
       "a b c\u0085d\x1ce", "<|endoftext|> b<|endoftext|>c <|startoftext|>", "日本語 text 😀😀 ٣٤", "a" * 5000,
       "word " * 3000, "\t \t\n  \n", " lead", "trail ", "two  spaces   three \n line", "def f(x):\n    return x  # ok\n\n\n"]


def library(file):
    t = Tokenizer.from_file(file)
    t.no_padding()
    t.no_truncation()
    return t


@pytest.fixture(scope="module")
def sample(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    rows = [(r.doc_id, r.text) for r in rows] + [(10_000 + i, t) for i, t in enumerate(ODD)]
    return [*rows, rows[5], (rows[5][0], "another"), (None, "no id")]


def frame(spark, rows):
    return spark.createDataFrame([(d, t, 1, "x", 2) for d, t in rows], DOCS).repartition(4)


def le(ids):
    return np.array(ids, "<u4").tobytes()


def key(rows):
    return sorted(map(repr, map(tuple, rows)))


def test_word_pieces(sample):
    own, other = WordEncoder(WORD), library(WORD)
    texts = [t for _, t in sample]
    assert own.encode(texts) == [le(other.encode(t or "", add_special_tokens=False).ids) for t in texts]


def test_more_pieces_than_remembered(monkeypatch):
    """A part may hold more new pieces than are remembered, with an empty memory or a full one."""
    monkeypatch.setattr(tokens, "REMEMBERED", 20)
    own, other = WordEncoder(WORD), library(WORD)
    texts = [" ".join(f"{kind}{i} word{i}." for i in range(40)) for kind in "abc"] + ["a1 b2 word3."] * 70
    expected = [le(other.encode(t, add_special_tokens=False).ids) for t in texts]
    assert own.encode(texts) == expected and own.encode(texts[::-1]) == expected[::-1]


def test_pieces_of_one_text_pass_the_limit(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 20)
    own, other = WordEncoder(WORD), library(WORD)
    text = " ".join(f"{a}{b}{c}.," for a in "aÉz" for b in "Abc" for c in "xyZßé")
    for t in (text, text.upper(), "<|STARTOFTEXT|> A<|EndOfText|>B <|endoftext|>C", "Ⱥb ǅ Ÿ, ŉ! ªº¿"):
        assert own.encode([t]) == [le(other.encode(t, add_special_tokens=False).ids)]
        assert len(own.known) <= 21
    assert len(own.known.words) <= 21


def test_orc(spark, sample, tmp_path):
    other = library(WORD)
    out = str(tmp_path / "tokens")
    orc_tokens.write(frame(spark, sample), out, WORD, files=3)
    found = {}
    rows = orc_tokens.digests(orc_tokens.read(spark, out)).collect()
    ids = {(d, t): le(other.encode(t or "", add_special_tokens=False).ids + [1]) for d, t in sample}
    expected = [(d, len(ids[d, t]) // 4, zlib.crc32(ids[d, t])) for d, t in sample]
    assert key((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == key(expected)
    at = 0
    for r in sorted(rows, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
        found.setdefault(r.doc_id, r.start)
    assert found.pop(None) == 0 and list(found) == sorted(found)
    files = sorted(glob.glob(out + "/*.orc"))
    assert len(files) > 1
    written = [i for f in files for i in orc.ORCFile(f).read(["doc_id"]).column(0).to_pylist()]
    assert written[1:] == sorted(written[1:]) and written[0] is None
    body = b"".join(open(f, "rb").read() for f in files)
    assert body.count(b"ORC") >= len(files)
    one = spark.read.schema(orc_tokens.SCHEMA).orc(out).where("doc_id = 7")
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,7)]" in one._jdf.queryExecution().toString()
    assert [r.doc_id for r in one.collect()] == [7]


def test_orc_of_nothing(spark, tmp_path):
    out = str(tmp_path / "none")
    orc_tokens.write(spark.createDataFrame([], DOCS), out, WORD)
    assert orc_tokens.digests(orc_tokens.read(spark, out)).collect() == []


@pytest.mark.parametrize("length, shard", [(4096, 20_000), (64, 40)])
def test_packing(spark, sample, length, shard):
    other = library(WORD)
    rows = packing.packed(frame(spark, sample), WORD, length, shard).collect()
    expected = []
    for d, t in sample:
        ids = le(other.encode(t or "", add_special_tokens=False).ids + [1])
        for k in range(0, len(ids), 4 * length):
            part = ids[k: k + 4 * length]
            expected.append((d, k // 4 // length, k // 4, len(part) // 4, zlib.crc32(part)))
    assert key((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == key(expected)
    used = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert used.get(r.sequence_id, 0) == r.offset
        used[r.sequence_id] = r.offset + r.length
    assert max(used.values()) <= length
    if shard == 20_000:
        assert len(used) <= -(-sum(used.values()) // length) + 1
    assert packing.packed(spark.createDataFrame([], DOCS), WORD).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=60), st.integers(1, 40))
def test_best_fit(lengths, most):
    lengths = sorted((min(n, most) for n in lengths), reverse=True)
    rooms, expected = [], []
    for n in lengths:
        fits = [r for r in rooms if r >= n]
        expected.append(min(fits) if fits else None)
        if fits:
            rooms.remove(min(fits))
        rest = (min(fits) if fits else most) - n
        if rest:
            rooms.append(rest)
    sequences, offsets, used = packing.best_fit(lengths, most)
    seen = set()
    for n, s, o, e in zip(lengths, sequences, offsets, expected):
        assert (s in seen and most - o == e) if e is not None else (s not in seen and o == 0)
        seen.add(s)
    assert used == len(seen)


def test_lexicon(spark, sample):
    other = library(BYTE)
    rows = lexicon.round_trip(frame(spark, sample), BYTE, 300).collect()
    expected = []
    for d, t in sample:
        ids = other.encode(t or "", add_special_tokens=False).ids
        text = other.decode(ids, skip_special_tokens=False)
        expected.append((d, len(ids), hashlib.sha256(le(ids)).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert key(rows) == key(expected)
    first = lexicon.encoded(frame(spark, [(1, "some words"), (2, None)]), BYTE).orderBy("doc_id").collect()
    assert first[0].ids == other.encode("some words").ids and first[1].ids == []
    assert lexicon.round_trip(spark.createDataFrame([], DOCS), BYTE).collect() == []


@settings(max_examples=100, deadline=None)
@given(st.sets(st.text("abé", min_size=1, max_size=6), max_size=40), st.lists(st.text("abé", max_size=7), max_size=10))
def test_automaton_holds_its_words(words, others):
    words = sorted(w.encode() for w in words)
    ids = [[len(w), i] for i, w in enumerate(words)]
    block = lexicon.compile_words(words, ids)
    held = lexicon.Lexicon(block)
    for w, i in zip(words, ids):
        assert held.get(w) == le(i)
    for w in others:
        assert (held.get(w.encode()) is not None) == (w.encode() in words)


def test_lexicon_pieces_of_one_text_pass_the_limit(monkeypatch):
    monkeypatch.setattr(lexicon, "REMEMBERED", 20)
    words = [b" word1", b" a", b"."]
    own = lexicon.Encoder(BYTE, lexicon.Lexicon(lexicon.compile_words(sorted(words), [
        lexicon.merger(BYTE).ids(w) for w in sorted(words)])))
    text = "head " + " ".join(f"{a}{b}{c}{d}" for a in "aéZ" for b in "word" for c in "日1'x" for d in (".", ",", "", "?!"))
    for t in (text, "word1 word1. a.", ""):
        assert own.encode(t) == le(library(BYTE).encode(t, add_special_tokens=False).ids)
        assert len(own.spaced) <= 21 and len(own.unseen) <= 20


def test_automaton_is_minimal():
    """Words over two letters of one length: a state a length, not a state a prefix."""
    words = sorted(bytes(random.Random(0).choice([97, 98]) for _ in range(0)) or f"{i:010b}".encode() for i in range(1024))
    block = lexicon.compile_words(words, [[i] for i in range(1024)])
    held = lexicon.Lexicon(block)
    assert len(held.final) == 11 and all(held.get(w) == le([i]) for i, w in enumerate(words))


def test_merging_of_any_length():
    merger, other = lexicon.merger(BYTE), library(BYTE)
    rng = random.Random(4)
    for n in (1, 50, 99, 100, 101, 400):
        word = "".join(rng.choice("abcdeth") for _ in range(n))
        ids = other.encode(word).ids
        assert merger.ids(word.encode()) == ids
        assert merger._long([merger.first[b] for b in word.encode()]) == ids


def test_the_most_frequent_words_with_ties(spark):
    """Counts decide, then byte order; no more words than asked for, and fewer only where there are no more."""
    texts = ["a a a b b c c d", "d e f é", None, ""]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(2)
    counts = {}
    for text in texts:
        for word in _pieces(text or ""):
            counts[word] = counts.get(word, 0) + 1
    order = [w for w, _ in sorted(counts.items(), key=lambda c: (-c[1], c[0]))]
    for most in (1, 3, 4, 6, 100):
        assert lexicon.frequent_words(docs, most) == sorted(order[:most])
    assert lexicon.frequent_words(docs.where("false"), 5) == []


def _pieces(text):
    import regex
    return [w.encode() for w in regex.findall(lexicon.PATTERN, text)]

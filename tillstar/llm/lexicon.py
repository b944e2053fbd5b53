"""Byte-level BPE with a minimal acyclic transducer of frequent words.

Words are counted over the whole corpus. The most frequent ones are encoded once, by exact merging, and compiled into an
automaton that shares prefixes and suffixes; numbers on its arcs add up to a word's place in the table of id lists. Its
arrays are one file in the shared folder, which Spark hands to the executors and workers map into memory. A word that
the automaton does not hold is merged exactly, lowest rank first. Decoding joins the bytes of the ids.

Rules: a null text is empty. The vocabulary's special strings in a text become their ids, as in the library. Repeated
rows are encoded each. An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import mmap
import struct
from collections import Counter
from collections.abc import Iterator
from functools import cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.llm.scratch import temporary
from tillstar.operators.ranks import between
from tillstar.session import scratch_path

#: Words in the automaton: at most a few MB, whatever the corpus.
WORDS = 100_000
#: Pieces that a worker remembers or counts before it passes them on.
REMEMBERED = 500_000
POINTS = (".", ",", ";", ":", "!", "?")
#: The pattern by which the vocabulary's words are cut.
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
           r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")


def byte_letters() -> dict[str, int]:
    """The vocabulary's letter for each byte: printable Latin-1 stands for itself, the rest follow from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Merger:
    """Exact merging by the vocabulary's ranks."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            saved = json.load(file)
        letters = byte_letters()
        vocabulary = saved["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in saved.get("added_tokens", [])}
        size = 1 + max([*vocabulary.values(), *self.special.values()])
        self.bytes: list[bytes] = [b""] * size
        for token, i in vocabulary.items():
            self.bytes[i] = token.encode() if token in self.special else bytes(letters[c] for c in token)
        for token, i in self.special.items():
            self.bytes[i] = token.encode()
        self.first = [vocabulary[c] for c, _ in sorted(letters.items(), key=lambda x: x[1])]
        self.merges: dict[tuple[int, int], int] = {}  # a pair's rank
        self.merged: list[int] = []  # by rank: the id that the pair becomes
        for rank, pair in enumerate(saved["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[vocabulary[a], vocabulary[b]] = rank
            self.merged.append(vocabulary[a + b])

    def ids(self, word: bytes) -> list[int]:
        first = self.first
        ids = [first[b] for b in word]
        if len(ids) > 100:
            return self._long(ids)
        rank, none, merged = self.merges.get, len(self.merged), self.merged
        ranks = [*map(rank, zip(ids, ids[1:]), repeat(none)), none]  # the last id has no pair
        while (best := min(ranks)) < none:
            at = ranks.index(best)
            new = ids[at] = merged[best]
            del ids[at + 1], ranks[at]  # the pairs on both sides are new ones
            if at + 1 < len(ids):
                ranks[at] = rank((new, ids[at + 1]), none)
            if at:
                ranks[at - 1] = rank((ids[at - 1], new), none)
        return ids

    def _long(self, ids: list[int]) -> list[int]:
        """The same with a heap of pairs, for words of any length."""
        n, rank = len(ids), self.merges.get
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        heap = [(m, i, *pair) for i, pair in enumerate(zip(ids, ids[1:])) if (m := rank(pair)) is not None]
        heapq.heapify(heap)
        while heap:
            m, i, a, b = heapq.heappop(heap)
            j, new = after[i], self.merged[m]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j] = new, -1
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for x in (before[i], i):
                if x >= 0 and after[x] >= 0 and (m := rank((ids[x], ids[after[x]]))) is not None:
                    heapq.heappush(heap, (m, x, ids[x], ids[after[x]]))
        return [x for x in ids if x >= 0]


@cache
def merger(path: str) -> Merger:
    return Merger(path)


def compile_words(words: list[bytes], ids: list[list[int]]) -> bytes:
    """A minimal acyclic automaton of the sorted distinct ``words`` and their ids, as one block of arrays.

    Words are added in order; a state is replaced by an equal one as soon as no later word can pass through it.
    """
    registry: dict[tuple, int] = {}
    frozen: list[tuple[bool, list[tuple[int, int]], int]] = []  # final, arcs, words below

    def freeze(node: list) -> int:
        arcs = [(b, child) for b, child in node[1]]
        key = (node[0], tuple(arcs))
        if key not in registry:
            registry[key] = len(frozen)
            frozen.append((node[0], arcs, node[0] + sum(frozen[c][2] for _, c in arcs)))
        return registry[key]

    path: list[list] = [[False, []]]
    previous = b""
    for word in words:
        common = 0
        while common < min(len(word), len(previous)) and word[common] == previous[common]:
            common += 1
        while len(path) > common + 1:
            node = path.pop()
            path[-1][1].append((previous[len(path) - 1], freeze(node)))
        for _ in word[common:]:
            path.append([False, []])
        path[-1][0] = True
        previous = word
    while len(path) > 1:
        node = path.pop()
        path[-1][1].append((previous[len(path) - 1], freeze(node)))
    root = freeze(path[0])
    first = np.cumsum([0, *(len(arcs) for _, arcs, _ in frozen)]).astype(np.int32)
    labels = bytes(b for _, arcs, _ in frozen for b, _ in arcs)
    target = np.array([c for _, arcs, _ in frozen for _, c in arcs], np.int32)
    skip = []
    for final, arcs, _ in frozen:
        n = int(final)
        for _, child in arcs:
            skip.append(n)
            n += frozen[child][2]
    offsets = np.cumsum([0, *map(len, ids)]).astype(np.int32)
    parts = [first.tobytes(), target.tobytes(), np.array(skip, np.int32).tobytes(), offsets.tobytes(),
             np.array([i for x in ids for i in x], np.uint32).tobytes(),
             bytes(final for final, _, _ in frozen), labels]
    return struct.pack("<8i", root, *map(len, parts)) + b"".join(parts)


class Lexicon:
    """The automaton over a block of memory, such as a mapped file."""

    def __init__(self, block) -> None:
        root, *sizes = struct.unpack_from("<8i", block)
        at, views = 32, []
        for size in sizes:
            views.append((at, size))
            at += size
        view = lambda i: memoryview(block)[views[i][0]: sum(views[i])]
        self.root, self.block, self.labels = root, block, views[6][0]
        self.first, self.target, self.skip, self.offsets = (view(i).cast("i") for i in range(4))
        self.ids, self.final = view(4), view(5)

    def get(self, word: bytes) -> bytes | None:
        """The word's ids as bytes, None if it is not held."""
        state, place = self.root, 0
        first, find, labels = self.first, self.block.find, self.labels
        for i in range(len(word)):
            arc = find(word[i: i + 1], labels + first[state], labels + first[state + 1]) - labels
            if arc < 0:
                return None
            place += self.skip[arc]
            state = self.target[arc]
        if not self.final[state]:
            return None
        return bytes(self.ids[4 * self.offsets[place]: 4 * self.offsets[place + 1]])


def spaced_words(piece: str, find) -> list[str]:
    """The words of a space and what follows it up to the next one; most are letters, maybe with a point at the end."""
    if piece.isalpha():
        return [" " + piece]
    if piece[-1:] in POINTS and piece[:-1].isalpha():
        return [" " + piece[:-1], piece[-1]]
    return find(" " + piece)


class Spaced(dict):
    """The ids of a space and what follows it up to the next one, by what follows; KeyError: white space at its ends."""

    def __init__(self, word, find) -> None:
        super().__init__()
        self.word, self.find = word, find

    def __missing__(self, piece: str) -> bytes:
        if not piece or piece != piece.strip():
            raise KeyError(piece)
        if len(self) > REMEMBERED:
            self.clear()
        ids = self[piece] = b"".join(map(self.word, spaced_words(piece, self.find)))
        return ids


class Encoder:
    """Ids of whole texts: special strings, then pieces at single spaces, then words, through the lexicon or merging."""

    def __init__(self, path: str, lexicon: Lexicon | None) -> None:
        import regex

        self.words = regex.compile(PATTERN).findall
        self.merger, self.lexicon = merger(path), lexicon
        self.special = self.merger.special
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")").split if self.special else None
        self.unseen: dict[str, bytes] = {}
        self.spaced = Spaced(self.word, self.words)

    def word(self, word: str) -> bytes:
        known = self.unseen.get(word)
        if known is not None:
            return known
        body = word.encode()
        found = self.lexicon.get(body) if self.lexicon else None
        if found is None:
            ids = self.merger.ids(body)
            found = struct.pack(f"<{len(ids)}I", *ids)
            if len(self.unseen) >= REMEMBERED:
                self.unseen.clear()
            if len(word) < 100:
                self.unseen[word] = found
        return found

    def plain(self, text: str) -> bytes:
        """Ids of a text without special strings."""
        head, *pieces = text.split(" ")
        try:  # white space beside a space belongs to no single piece
            if not pieces or head[-1:].isspace() or pieces[-1][:1].isspace():
                raise KeyError(head)
            last = self.words(" " + pieces.pop())  # nothing follows it, so it may end with white space
            return b"".join([*map(self.word, self.words(head)), *map(self.spaced.__getitem__, pieces), *map(self.word, last)])
        except KeyError:
            return b"".join(map(self.word, self.words(text)))

    def encode(self, text: str) -> bytes:
        if self.cut and any(s in text for s in self.special):
            return b"".join(np.uint32(self.special[x]).tobytes() if x in self.special else self.plain(x) if x else b""
                            for x in self.cut(text))
        return self.plain(text) if text else b""


class Decoder:
    """The texts of id lists."""

    def __init__(self, path: str) -> None:
        tokens = merger(path).bytes
        self.sizes = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.letters = np.frombuffer(b"".join(tokens), np.uint8)

    def decode(self, ids: bytes) -> bytes:
        """UTF-8; what the ids' bytes do not encode becomes U+FFFD."""
        out = []
        every = np.frombuffer(ids, np.uint32)
        for a in range(0, len(every), 1 << 16):
            part = every[a: a + (1 << 16)]
            sizes = self.sizes[part]
            ends = np.cumsum(sizes)
            at = np.arange(int(ends[-1])) + np.repeat(self.starts[part] - (ends - sizes), sizes)
            out.append(self.letters[at].tobytes())
        return b"".join(out).decode("utf-8", "replace").encode()


def frequent_words(docs: DataFrame, most: int = WORDS) -> list[bytes]:
    """The most frequent words of all texts (ties: in byte order), sorted."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        find, seen, words = regex.compile(PATTERN).findall, Counter(), Counter()

        def flush():
            for piece, n in seen.items():
                for word in spaced_words(piece, find):
                    words[word] += n
            out = pa.record_batch([pa.array([w.encode() for w in words], pa.binary()), pa.array(words.values(), pa.int64())],
                                  ["word", "n"])
            seen.clear()
            words.clear()
            return out

        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text:
                    head, *pieces = text.split(" ")
                    seen.update(pieces)
                    words.update(find(head))
                if len(seen) > REMEMBERED:
                    yield flush()
        if seen or words:
            yield flush()

    with temporary(docs.sparkSession) as write:
        counts = write(docs.select("text").mapInArrow(count, "word binary, n long").groupBy("word").agg(
            F.sum("n").alias("n")), "words")
        # how many words have each count: one row a count, from which follows the least count that all fit with
        found = sorted(((r.n, r.words) for r in counts.groupBy("n").agg(F.count("*").alias("words")).collect()), reverse=True)
        sure, last = 0, None
        for n, words in found:
            if sure + words > most:
                last = n
                break
            sure += words
        top = counts if last is None else counts.where(F.col("n") > last)
        words = [bytes(r.word) for r in top.select("word").collect()]  # at most ``most``
        if last is not None and sure < most:  # words of one count more than fit: the first in byte order
            ties = between(counts.where(F.col("n") == last).select("word"), ["word"], 0, most - sure)
            words += [bytes(r.word) for r in ties.collect()]
    return sorted(words)


def publish(spark: SparkSession, block: bytes) -> str:
    """Put the block into the shared folder and have Spark hand it to every executor; its file name."""
    path = scratch_path(spark, "llm-lexicon") + ".bin"
    jvm, sc = spark.sparkContext._jvm, spark.sparkContext
    target = jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(sc._jsc.hadoopConfiguration()).create(target)
    try:
        for a in range(0, len(block), 1 << 20):
            stream.write(bytearray(block[a: a + (1 << 20)]))
    finally:
        stream.close()
    sc.addFile(path)
    return path.rsplit("/", 1)[1]


def build(docs: DataFrame, path: str, most: int = WORDS) -> str:
    """Compile the corpus' frequent words and publish them."""
    words = frequent_words(docs, most)
    return publish(docs.sparkSession, compile_words(words, [merger(path).ids(w) for w in words]))


@cache
def mapped_encoder(path: str, name: str) -> Encoder:
    """One for each worker process."""
    with open(SparkFiles.get(name), "rb") as file:
        return Encoder(path, Lexicon(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)))


def encoded(docs: DataFrame, path: str, most: int = WORDS) -> DataFrame:
    """``doc_id`` and ``ids`` (array of int) of every text."""
    return _run(docs, path, most, "doc_id long, ids array<int>", lambda ids, _: np.frombuffer(ids, np.int32).tolist())


def round_trip(docs: DataFrame, path: str, most: int = WORDS) -> DataFrame:
    """``doc_id``, ``n_tokens`` and the SHA-256 of the ids and of the text decoded from them."""
    return _run(docs, path, most, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
                lambda ids, decode: (len(ids) // 4, hashlib.sha256(ids).hexdigest(),
                                     hashlib.sha256(decode(ids)).hexdigest()))


def _run(docs: DataFrame, path: str, most: int, schema: str, finish) -> DataFrame:
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    name = build(docs, path, most)
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, decode = mapped_encoder(path, name).encode, Decoder(path).decode
        for batch in batches:
            rows = [finish(encode(t), decode) for t in batch.column(1).to_pylist()]
            columns = [list(c) for c in zip(*rows)] if rows and isinstance(rows[0], tuple) else [rows]
            if not rows:
                continue
            yield pa.record_batch([batch.column(0), *(pa.array(c) if len(names) > 2 else pa.array(c, pa.list_(pa.int32()))
                                                      for c in columns)], names)

    return docs.mapInArrow(run, schema)

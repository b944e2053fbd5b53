"""Substring dedup with suffix arrays built by induced sorting.

The windows that may repeat (see ``passages``) are dealt to shards by content, so that a shard holds every occurrence
of its windows. A shard's suffix array is built by induced sorting: suffixes are classed as smaller or larger than
their right neighbour, the leftmost-smaller substrings are sorted (recursively, where names repeat), and all others are
induced from them bucket by bucket. Permuted common prefixes then tell which suffixes share a whole window.

Rules: null texts are empty. Matches are on UTF-8 bytes and never cross documents. Rows that repeat an id, or a whole
row, are documents of their own. An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm import passages, windows

WINDOW, GRAM, KEY_GRAM = 200, 120, 16
#: Symbols of one key's regions sorted together.
SHARD = 1 << 20


def suffix_array(text: np.ndarray, letters: int) -> np.ndarray:
    """The suffix array of ``text``, whose last symbol is 0 and stands nowhere else; symbols are below ``letters``."""
    n = len(text)
    if n == 1:
        return np.zeros(1, np.int64)
    differs = text[:-1] != text[1:]
    nearest = np.where(differs, np.arange(n - 1), n - 1)
    nearest = np.minimum.accumulate(nearest[::-1])[::-1]
    small = np.empty(n, bool)
    small[:-1] = (text[:-1] < text[1:])[nearest]
    small[-1] = True
    leftmost = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    induce = _induce_wide if letters <= 1024 else _induce_narrow
    ranked = induce(text, small, leftmost[np.argsort(text[leftmost], kind="stable")], letters)
    is_leftmost = np.zeros(n, bool)
    is_leftmost[leftmost] = True
    ranked = ranked[is_leftmost[ranked]]
    # names: equal neighbours are substrings of the same symbols up to and with the next leftmost-smaller one
    width = np.empty(n, np.int64)
    width[leftmost[:-1]] = np.diff(leftmost)
    width[leftmost[-1]] = 0
    a, b = ranked[:-1], ranked[1:]
    same = width[a] == width[b]
    for step in range(int(width[a[same]].max(initial=0)) + 1):
        open_ = np.flatnonzero(same & (width[a] >= step))
        if not len(open_):
            break
        same[open_] = text[a[open_] + step] == text[b[open_] + step]
    names = np.concatenate(([0], np.cumsum(~same)))
    if names[-1] + 1 < len(ranked):
        by_place = np.empty(n, np.int64)
        by_place[ranked] = names
        ranked = leftmost[suffix_array(by_place[leftmost], int(names[-1]) + 1)]
    return induce(text, small, ranked, letters)


def _induce_wide(text, small, leftmost, letters: int) -> np.ndarray:
    """Few letters: a bucket's suffixes induce their left neighbours all at once."""
    counts = np.bincount(text, minlength=letters)
    starts = np.cumsum(counts) - counts
    larger = np.bincount(text[~small], minlength=letters)
    seeds = np.concatenate(([0], np.cumsum(np.bincount(text[leftmost], minlength=letters))))
    out = np.empty(len(text), np.int64)
    order = np.arange(len(text))
    present = np.flatnonzero(counts).tolist()
    head = starts.copy()

    def push(chunk, want, edge, sign):
        left = chunk[chunk > 0] - 1
        left = left[small[left] == want]
        if not len(left):
            return
        by = text[left]
        if len(left) > 1:
            sort = np.argsort(by, kind="stable")
            left, by = left[sort], by[sort]
        n = np.bincount(by, minlength=letters)
        rank = order[:len(by)] - (np.cumsum(n) - n)[by]
        if sign > 0:
            out[edge[by] + rank] = left
            edge += n
        else:
            out[edge[by] - 1 - rank] = left
            edge -= n

    for c in present:
        done = int(starts[c])
        while done < head[c]:
            chunk = out[done: head[c]]
            done = int(head[c])
            push(chunk, False, head, 1)
        if seeds[c + 1] > seeds[c]:
            push(leftmost[seeds[c]: seeds[c + 1]], False, head, 1)
    tail = starts + counts
    for c in reversed(present):
        done = int(starts[c] + counts[c])
        while tail[c] < done:
            chunk = out[tail[c]: done][::-1]
            done = int(tail[c])
            push(chunk, True, tail, -1)
        if larger[c]:
            push(out[starts[c]: starts[c] + larger[c]][::-1], True, tail, -1)
    out[0] = len(text) - 1
    return out


def _induce_narrow(text, small, leftmost, letters: int) -> np.ndarray:
    """Many letters with a few suffixes each: one suffix after the other."""
    counts = np.bincount(text, minlength=letters)
    ends = np.cumsum(counts)
    tail = ends.tolist()
    head = (ends - counts).tolist()
    n = len(text)
    symbols, smaller = text.tolist(), small.tolist()
    out = [-1] * n
    edge = tail.copy()
    for j in reversed(leftmost.tolist()):
        c = symbols[j]
        edge[c] -= 1
        out[edge[c]] = j
    for i in range(n):
        j = out[i]
        if j > 0:
            j -= 1
            if not smaller[j]:
                c = symbols[j]
                out[head[c]] = j
                head[c] += 1
    for i in range(n - 1, -1, -1):
        j = out[i]
        if j > 0:
            j -= 1
            if smaller[j]:
                c = symbols[j]
                tail[c] -= 1
                out[tail[c]] = j
    out[0] = n - 1
    return np.array(out, np.int64)


def permuted_prefixes(text: np.ndarray, suffixes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every place the suffix ranked just before it (-1: none) and the length of their common prefix.

    Where the symbols to the left agree, the length is one less than the left neighbour's; only the others are compared.
    """
    n = len(text)
    before = np.empty(n, np.int64)
    before[suffixes[0]] = -1
    before[suffixes[1:]] = suffixes[:-1]
    own = np.ones(n, bool)
    i = np.arange(1, n)
    ok = (before[1:] > 0) & (before[:-1] >= 0)
    own[1:] = ~(ok & (text[i - 1] == text[np.maximum(before[1:] - 1, 0)]))
    place = np.flatnonzero(own)
    length = np.zeros(len(place), np.int64)
    active = np.flatnonzero(before[place] >= 0)
    padded = np.concatenate((text, np.zeros(16, text.dtype)))
    step = np.arange(16)
    while len(active):
        a, b = place[active] + length[active], before[place[active]] + length[active]
        same = padded[a[:, None] + step] == padded[b[:, None] + step]
        whole = same.all(1)
        length[active] += np.where(whole, 16, same.argmin(1))
        active = active[whole]
    last = np.cumsum(own) - 1
    return before, length[last] - (np.arange(n) - place[last])


def repeated_starts(bodies: list[np.ndarray], window: int) -> list[np.ndarray]:
    """For each body the starts whose window stands at another place of the bodies too."""
    lengths = np.array([len(b) for b in bodies])
    offsets = np.concatenate(([0], np.cumsum(lengths + 1)))
    text = np.ones(int(offsets[-1]) + 1, np.uint16)  # 1 stands between bodies, 0 at the end
    for b, o in zip(bodies, offsets.tolist()):
        text[o: o + len(b)] = b
        text[o: o + len(b)] += 2
    text[-1] = 0
    before, length = permuted_prefixes(text, suffix_array(text, 258))
    shared = np.flatnonzero(length >= window)
    hit = np.zeros(len(text), bool)
    hit[shared] = True
    hit[before[shared]] = True
    return [np.flatnonzero(hit[o: o + max(0, n - window + 1)]) for o, n in zip(offsets.tolist(), lengths.tolist())]


def to_spans(starts: np.ndarray, window: int) -> list[tuple[int, int]]:
    if not len(starts):
        return []
    breaks = np.flatnonzero(np.diff(starts) > 1) + 1
    first = starts[np.concatenate(([0], breaks))]
    last = starts[np.concatenate((breaks, [len(starts)])) - 1]
    return list(zip(first.tolist(), (last + window).tolist()))


def _index(window: int):
    def index(rows: list[tuple]) -> list[list[tuple[int, int]]]:
        # a region that stands at two places repeats whole; its body still serves the others of its key
        out = [[(0, len(body))] if n > 1 else [] for _, _, n, _, body in rows]
        by_key: dict[int, list[int]] = {}
        for i, row in enumerate(rows):
            by_key.setdefault(row[1], []).append(i)
        groups = [g for g in by_key.values() if len(g) > 1 and any(rows[i][2] == 1 for i in g)]
        batch: list[tuple[int, int, np.ndarray]] = []
        size = 0
        for group in groups:
            members = [(i, 0, np.frombuffer(rows[i][4], np.uint8)) for i in group]
            for part in passages.refined(members, window, KEY_GRAM * 2, SHARD):
                batch += part
                size += sum(len(m[2]) for m in part)
                if size >= 1 << 20:
                    _mark(batch, rows, out, window)
                    batch, size = [], 0
        _mark(batch, rows, out, window)
        return out

    return index


def _mark(batch, rows, out, window) -> None:
    if not batch:
        return
    for (i, start, _), hits in zip(batch, repeated_starts([b for _, _, b in batch], window)):
        if rows[i][2] == 1 and len(hits):
            out[i] = out[i] + [(start + s, start + e) for s, e in to_spans(hits, window)]


def repeated_bytes(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id``, ``row``, ``spans``: the byte ranges covered by a window that stands elsewhere too."""
    gram = max(1, window * 3 // 5)
    alone = F.when(F.col("n") > 1, F.array(F.struct(F.lit(0), "size"))).otherwise(F.array())
    return passages.spans(docs, _index(window), alone, "s: int, e: int", window, gram,
                          min(KEY_GRAM, gram), False, F.lit(True))


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Each row's kept bytes: ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept`` (binary)."""
    return _cut(docs, window, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary",
                lambda kept: kept, pa.binary())


def repeat_digests(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """As ``without_repeats`` with the SHA-256 of the kept bytes in place of them."""
    return _cut(docs, window, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string",
                lambda kept: hashlib.sha256(kept).hexdigest(), pa.string())


def _cut(docs: DataFrame, window: int, schema: str, finish, kind) -> DataFrame:
    docs = passages.source(docs)
    name = schema.rsplit(", ", 1)[1].split()[0]
    found = repeated_bytes(docs, window)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = windows.flat(batch.column(1))
            body = data.tobytes()
            removed, count, kept = [], [], []
            for a, z, (starts, ends) in zip(offsets[:-1].tolist(), offsets[1:].tolist(),
                                            passages.joined_spans(batch.column(2))):
                removed.append(int((ends - starts).sum()))
                count.append(len(starts))
                if len(starts):
                    from_ = [0, *ends.tolist()]
                    text = b"".join(body[a + x: a + y] for x, y in zip(from_, [*starts.tolist(), z - a]))
                else:
                    text = body[a:z]
                kept.append(finish(text))
            yield pa.record_batch([batch.column(0), pa.array(np.diff(offsets)), pa.array(removed, pa.int64()),
                                   pa.array(count, pa.int64()), pa.array(kept, kind)],
                                  ["doc_id", "n_bytes", "n_removed", "n_spans", name])

    return passages.with_spans(docs, found).mapInArrow(cut, schema)

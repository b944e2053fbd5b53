"""Fixed-length windows over long sequences, in numpy: hashes, sliding minima and the splits they give.

Used inside tasks on one Arrow batch at a time. A sequence is an array of symbols (bytes or word hashes) that holds many
documents one after another; ``ends`` gives for every position where its document ends, so that no window crosses two.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

POSITION_BITS = 25
#: Symbols handled at once; with a window more, positions must fit in POSITION_BITS.
CHUNK = 1 << 17
_ODD = np.uint64(0xD6E8FEB86659FD93)
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its offsets; null counts as empty."""
    if pa.types.is_string(column.type):
        column = column.cast(pa.large_string())
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset: column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]: offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, most: int = CHUNK):
    """Ranges of documents whose symbols together are about ``most``; a longer document is a range by itself."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1)
        yield first, last
        first = last


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def gram_hashes(symbols: np.ndarray, k: int) -> np.ndarray:
    """A hash of every ``k`` consecutive symbols, by joining halves of doubling length."""
    if len(symbols) < k:
        return np.zeros(0, np.uint64)
    x = symbols.astype(np.uint64) + np.uint64(1)
    power, length, out, out_length = _ODD, 1, None, 0
    while True:
        if k & length:
            if out is None:
                out, out_length = x, length
            else:  # out covers the first out_length symbols, x the next length
                m = len(symbols) - out_length - length + 1
                out = out[:m] * power + x[out_length: out_length + m]
                out_length += length
        if length * 2 > k:
            return mix(out)
        x = x[:-length] * power + x[length:]
        power = np.uint64(int(power) * int(power) & 0xFFFFFFFFFFFFFFFF)
        length *= 2


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` consecutive values."""
    if len(x) < width:
        return x[:0]
    length = 1
    while length * 2 <= width:
        x = np.minimum(x[:-length], x[length:])
        length *= 2
    rest = width - length
    return np.minimum(x[:-rest], x[rest:]) if rest else x


def least_gram(hashes: np.ndarray, window: int, k: int) -> np.ndarray:
    """For every window of ``window`` symbols the position of its k-gram with the least hash (the first of equals).

    Equal windows have this gram at the same place inside them, so it can stand for the window wherever it occurs.
    """
    if len(hashes) > 1 << POSITION_BITS:
        raise ValueError(f"{len(hashes)} positions do not fit in {POSITION_BITS} bits")
    low = np.uint64((1 << POSITION_BITS) - 1)
    ranked = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
    return (sliding_min(ranked, window - k + 1) & low).astype(np.int64)


def inside(offsets: np.ndarray, window: int) -> np.ndarray:
    """Starts of windows that lie within one document."""
    total = int(offsets[-1])
    ends = np.repeat(offsets[1:], np.diff(offsets))
    return (np.arange(total) + window <= ends)[: max(0, total - window + 1)]


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+``, and for each document the number of its first word."""
    solid = ~_WHITE[data]
    before = np.empty_like(solid)
    before[:1] = False
    before[1:] = solid[:-1]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets[:-1]] = True  # a word never runs from one document into the next
    starts = np.flatnonzero(solid & (~before | cut[:-1]))
    after = np.empty_like(solid)
    after[-1:] = False
    after[:-1] = solid[1:]
    ends = np.flatnonzero(solid & (~after | cut[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each word's bytes: differences of a running sum, scaled back to the word's start.

    The running sum is taken modulo 2^64 over bytes times powers of an odd number, whose inverse exists.
    """
    if not len(starts):
        return np.zeros(0, np.uint64)
    n = len(data)
    up, down = _powers(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((_SPREAD[data]) * up[:n], out=sums[1:])
    raw = (sums[ends] - sums[starts]) * down[starts]
    return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


_SPREAD = mix(np.arange(1, 257, dtype=np.uint64))
_table: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _table or len(_table[0]) < n:
        size = max(n, CHUNK + 1)
        inverse = np.uint64(pow(int(_ODD), -1, 1 << 64))
        both = []
        for base in (_ODD, inverse):
            x = np.full(size, base, np.uint64)
            x[0] = 1
            both.append(np.cumprod(x, dtype=np.uint64))
        _table[:] = both
    return _table[0], _table[1]


def lower(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, all other bytes as they are."""
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


def runs(flags_or_values: np.ndarray) -> np.ndarray:
    """Starts of runs of equal values, with the length at the end."""
    if not len(flags_or_values):
        return np.zeros(1, np.int64)
    return np.concatenate(([0], np.flatnonzero(flags_or_values[1:] != flags_or_values[:-1]) + 1, [len(flags_or_values)]))

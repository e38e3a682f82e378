"""Vectorised reading of words and windows from Arrow text columns, inside tasks.

Texts are taken as UTF-8 bytes. Work goes over slices of at most ``SLICE`` bytes (a longer text is a slice of
its own), so memory follows the slice and not the Arrow batch. Words are runs of bytes other than
``\\x20 \\x09-\\x0D``. Hashes are 64-bit: a sum of per-byte values times powers of an odd base, taken from prefix
sums, then mixed; the same bytes give the same hash in every task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)
ONE = np.uint64(1)
FACTOR = np.uint64(0xD6E8FEB86659FD93)

WHITE = np.zeros(256, bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(32))) * FACTOR
        x = (x ^ (x >> np.uint64(32))) * FACTOR
        return x ^ (x >> np.uint64(32))


BYTE = mix(np.arange(1, 257, dtype=np.uint64))
LOWER = BYTE.copy()
LOWER[65:91] = BYTE[97:123]

class Own(dict):
    """What each process makes for itself: pickled empty, so that a task function, which is pickled with all that it names, does not carry it."""

    def __reduce__(self):
        return type(self), ()


_powers: dict[str, np.ndarray] = Own()


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE ** i and BASE ** -i modulo 2 ** 64 for i up to n."""
    have = _powers.get("up")
    if have is None or len(have) <= n:
        size = max(n + 1, 2 * SLICE)
        inverse = pow(int(BASE), -1, 1 << 64)
        for name, base in (("up", BASE), ("down", np.uint64(inverse))):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            with np.errstate(over="ignore"):
                _powers[name] = np.multiply.accumulate(p)
    return _powers["up"], _powers["down"]


def prefix(values: np.ndarray) -> np.ndarray:
    """Prefix sums of values[i] * BASE ** i, one longer than values."""
    out = np.zeros(len(values) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(values * powers(len(values))[0][: len(values)], out=out[1:])
    return out


def ranges(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of values[start:end] from their prefix sums; equal sequences have equal hashes wherever they start."""
    with np.errstate(over="ignore"):
        return mix((sums[end] - sums[start]) * powers(len(sums))[1][start])


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    col = batch.column(batch.schema.get_field_index(name))
    return col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col


class Slice:
    """Some rows of a batch: ``data`` holds the bytes of their texts, ``at`` the first byte of each and the end."""

    def __init__(self, first: int, data: np.ndarray, at: np.ndarray):
        self.first, self.data, self.at = first, data, at
        self.rows = len(at) - 1

    def text(self, i: int) -> bytes:
        return self.data[self.at[i]:self.at[i + 1]].tobytes()

    def words(self, table: np.ndarray = BYTE, hashed: bool = True, white: np.ndarray = WHITE) -> "Words":
        data, at = self.data, self.at
        inside = ~white[data]
        opens = np.zeros(len(data) + 1, bool)
        opens[at[:-1]] = True
        begin = inside.copy()
        begin[1:] &= ~inside[:-1] | opens[1:-1]
        stop = inside.copy()
        stop[:-1] &= ~inside[1:] | opens[1:-1]
        start, end = np.flatnonzero(begin), np.flatnonzero(stop) + 1
        hashes = ranges(prefix(table[data]), start, end) if hashed else None
        return Words(start, end, np.searchsorted(start, at), hashes)


class Words:
    """Words of a slice: byte ranges, hashes, and ``at``: the first word of each row and the end."""

    def __init__(self, start, end, at, hashes):
        self.start, self.end, self.at, self.hashes = start, end, at, hashes

    def rows(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.at) - 1), np.diff(self.at))


def slices(batch: pa.RecordBatch, name: str = "text", limit: int = SLICE) -> Iterator[Slice]:
    """The texts of a batch; null counts as empty."""
    col = column(batch, name)
    if col.null_count:
        col = col.fill_null(b"" if pa.types.is_binary(col.type) or pa.types.is_large_binary(col.type) else "")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, places, body = col.buffers()
    at = np.frombuffer(places, np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    i = 0
    while i < len(col):
        j = max(i + 1, int(np.searchsorted(at, at[i] + limit, "right")) - 1)
        yield Slice(i, data[at[i]:at[j]], at[i:j + 1] - at[i])
        i = j


def minimisers(grams: np.ndarray, reach: int) -> np.ndarray:
    """For every run of ``reach`` grams, the place of its least one (the leftmost of equals): one place per run start."""
    n = len(grams) - reach + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    best, place, width = grams, np.arange(len(grams)), 1
    while width * 2 <= reach:  # doubling: the least of 2w grams from the least of two halves
        a, b = best[:-width], best[width:]
        right = b < a
        best, place = np.where(right, b, a), np.where(right, place[width:], place[:-width])
        width *= 2
    if width < reach:
        gap = reach - width
        a, b = best[:n], best[gap:gap + n]
        place = np.where(b < a, place[gap:gap + n], place[:n])
    return place[:n]


def anchor_runs(sums: np.ndarray, at: np.ndarray, window: int, gram: int):
    """Windows of ``window`` values by the least of their grams, the anchor: runs of window starts with one anchor.

    ``sums`` are prefix sums over a slice, ``at`` the first value of each row. Returns row, anchor hash, first start and
    end of the starts, counted from the row's first value. Equal windows have equal anchors at equal distances.
    """
    n = len(sums) - 1
    empty = np.zeros(0, np.int64)
    if n < window:
        return empty, np.zeros(0, np.uint64), empty, empty
    grams = ranges(sums, np.arange(n - gram + 1), np.arange(gram, n + 1))
    place = minimisers(grams, window - gram + 1)
    row = np.repeat(np.arange(len(at) - 1), np.diff(at))
    starts = np.flatnonzero(row[:n - window + 1] == row[window - 1:])
    if not len(starts):
        return empty, np.zeros(0, np.uint64), empty, empty
    place = place[starts]
    first = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (starts[1:] != starts[:-1] + 1)])
    last = np.r_[first[1:], len(starts)] - 1
    owner = row[starts[first]]
    return owner, grams[place[first]], starts[first] - at[owner], starts[last] + 1 - at[owner]

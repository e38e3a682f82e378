"""Benchmark decontamination: CGK embedding, bit-sampling LSH over item-sized windows, exact edit verification.

Texts and items are words (runs of letters, digits and non-ASCII characters; case and punctuation do not count). A
document is contaminated by an item of n words if one of its n-word windows, or the whole text if it has fewer words, is
within ``(100 - percent) * n / 100`` word edits of the item. The CGK walk reads a sequence with random stays, so that few edits become few differing places of
its output; each of ``REPEATS`` walks samples ``SAMPLES`` places, and a window that agrees with an item in all places of a
walk is compared exactly, best agreement first. Windows are taken where one can match at all: of the item's
``edits + 1`` rarest words at least one must be in the window, and enough of its words must be words of the benchmark
(both follow from the edit limit, so no match is lost there).

Scale: no shuffle of texts; one pass over the documents per ``ITEMS`` benchmark items, whose tables are broadcast (their
size is bounded by ``ITEMS``). Word frequencies, which choose the rarest words, are counted over all documents, one row per task and word of the block.
Defined cases: null and empty texts match nothing; items without words are skipped; equal items are found each; rows without doc_id give rows without doc_id; extra columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from siftgate.llm.spans import LOWER, column, mix, slices

ITEMS = 5_000
REPEATS = 14
SAMPLES = 2

FOLD = LOWER.copy()  # also the second bytes of Latin-1 capitals; in other scripts some letters fold that should not
FOLD[0x80:0x9F] = LOWER[0xA0:0xBF]
BREAK = np.ones(256, bool)
BREAK[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def cgk_samples(words: np.ndarray, walk: int, sizes: np.ndarray | None = None) -> np.ndarray:
    """Samples of one CGK walk over each row of ``words`` (m sequences of n hashes, or of ``sizes`` of them): one key per row.

    At every step the walk writes the current word and moves on or stays, by a random bit of (step, word).
    """
    m, n = words.shape
    rng = np.random.default_rng(1_000 * n + walk)
    takes = set(rng.choice(2 * n, min(SAMPLES, 2 * n), replace=False).tolist())
    at, key = np.zeros(m, np.int64), np.full(m, np.uint64(walk + 1))
    rows = np.arange(m)
    with np.errstate(over="ignore"):
        for step in range(max(takes) + 1):
            inside = at < (n if sizes is None else sizes)
            word = np.where(inside, words[rows, np.minimum(at, n - 1)], np.uint64(0))
            if step in takes:
                key = mix(key * np.uint64(0x100000001B3) + word)
            salt = mix(np.array([1_000_003 * walk + step], np.uint64))[0]
            at = at + (inside & ((mix(word ^ salt) >> np.uint64(40)) & np.uint64(1)).astype(bool))
    return key


def edit_distance(a: list, b: list, most: int) -> int:
    """Levenshtein distance of two sequences, or most + 1 if it is more."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        lo, hi = max(1, i - most), min(len(b), i + most)
        last, row[lo - 1] = row[lo - 1], i if lo == 1 else most + 1
        for j in range(lo, hi + 1):
            step = min(last + (x != b[j - 1]), row[j - 1] + 1, (row[j] if j < i + most else most + 1) + 1)
            last, row[j] = row[j], step
        if min(row[lo - 1:hi + 1]) > most:
            return most + 1
    return min(row[-1], most + 1)


class Items:
    """The tables of a block of items."""

    def __init__(self, ids: list, texts: list, percent: int):
        batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])
        self.ids, self.words = [], []
        for piece in slices(batch):
            w = piece.words(FOLD, white=BREAK)
            for i in range(piece.rows):
                if w.at[i + 1] > w.at[i]:
                    self.ids.append(ids[piece.first + i])
                    self.words.append(w.hashes[w.at[i]:w.at[i + 1]])
        self.edits = [(100 - percent) * len(w) // 100 for w in self.words]
        self.vocabulary = np.unique(np.concatenate(self.words)) if self.words else np.zeros(0, np.uint64)

    def prepare(self, counts: dict[int, int]) -> None:
        """Rarest words of each item with their places, and the sampled keys of each length and walk."""
        rare = defaultdict(list)
        for k, (words, edits) in enumerate(zip(self.words, self.edits)):
            order = sorted(range(len(words)), key=lambda p: (counts.get(int(words[p]), 0), p))
            for p in order[:edits + 1]:
                rare[int(words[p])].append((k, p))
        self.rare = np.array(sorted(rare), np.uint64)
        each = [rare[int(w)] for w in self.rare]
        self.first = np.r_[0, np.cumsum([len(x) for x in each])].astype(np.int64)  # of each rare word's (item, place)
        self.item, self.place = np.array([y for x in each for y in x], np.int64).reshape(-1, 2).T
        self.length, self.most = np.array([len(w) for w in self.words]), np.array(self.edits)
        self.keys = {}
        for n in set(self.length.tolist()):
            chosen = np.flatnonzero(self.length == n)
            block = np.stack([self.words[k] for k in chosen])
            for walk in range(REPEATS):
                keys = cgk_samples(block, walk)
                order = np.argsort(keys, kind="stable")
                self.keys[n, walk] = keys[order], chosen[order]


def known(table: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Place of each word in a sorted table, -1 where it is not there."""
    at = np.minimum(np.searchsorted(table, words), len(table) - 1)
    return np.where(table[at] == words, at, -1)


def spread(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """first[i], first[i] + 1, .. count[i] values for each i, and their i."""
    owner = np.repeat(np.arange(len(count)), count)
    return first[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count), owner


def windows(items: Items, words: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, item length, own length) of the windows of a slice that may match; ``at``: first word of each text and the end.

    A text with fewer words than the item is one window of its own length.
    """
    hit = known(items.rare, words)
    seen = np.flatnonzero(hit >= 0)
    entry, of = spread(items.first[hit[seen]], np.diff(items.first)[hit[seen]])
    item, place = items.item[entry], seen[of] - items.place[entry]
    row = np.searchsorted(at, seen[of], "right") - 1
    n, most = items.length[item], items.most[item]
    own = np.minimum(n, at[row + 1] - at[row])
    short = own < n
    lo, hi = np.maximum(place - most, at[row]), np.minimum(place + most, at[row + 1] - own)
    lo, hi = np.where(short, at[row], lo), np.where(short, at[row], hi)
    start, of = spread(lo, np.maximum(hi - lo + 1, 0))
    n, own, most = n[of], own[of], most[of]
    inside = np.r_[0, np.cumsum(known(items.vocabulary, words) >= 0)]
    both = np.stack([start, n, own])[:, inside[start + own] - inside[start] >= n - most]
    return tuple(np.unique(both, axis=1)) if both.size else (start[:0], n[:0], own[:0])


def matches(items: Items, found: dict[int, list]) -> list[tuple]:
    """(row, item, start, n, distance) from windows (rows, starts, words, sizes) by item length: for each row and item the
    first window of the best agreement that verifies."""
    agreed, body = defaultdict(int), {}
    for n, parts in found.items():
        rows, starts, sizes = (np.concatenate([p[i] for p in parts]) for i in (0, 1, 3))
        blocks = np.concatenate([p[2] for p in parts])
        for x in range(0, len(starts), 1 << 15):
            block = blocks[x:x + (1 << 15)]
            for walk in range(REPEATS):
                table, owner = items.keys[n, walk]
                keys = cgk_samples(block, walk, sizes[x:x + (1 << 15)])
                lo, hi = np.searchsorted(table, keys), np.searchsorted(table, keys, "right")
                for i in np.flatnonzero(hi > lo).tolist():
                    for k in owner[lo[i]:hi[i]].tolist():
                        name = int(rows[x + i]), k, int(starts[x + i])
                        agreed[name] += 1
                        body[name] = block[i, :sizes[x + i]]
    out, done = [], set()
    for name, _ in sorted(agreed.items(), key=lambda x: (-x[1], x[0])):
        row, k, start = name
        if (row, k) in done:
            continue
        most = items.edits[k]
        distance = edit_distance(items.words[k].tolist(), body[name].tolist(), most)
        if distance <= most:
            done.add((row, k))
            out.append((row, items.ids[k], start, len(body[name]), distance))
    return out


def contaminated(docs: DataFrame, benchmark: DataFrame, percent: int = 80) -> DataFrame:
    """(doc_id, item_id, start, n_words, distance): every item that a document holds, with the words of the window."""
    spark = docs.sparkSession
    total = benchmark.count()
    out = spark.createDataFrame([], "doc_id long, item_id long, start int, n_words int, distance int")
    blocks = max(1, -(-total // ITEMS))
    numbered = benchmark.select("item_id", "text").filter("text is not null")
    for b in range(blocks):
        part = numbered if blocks == 1 else numbered.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b)
        rows = part.toLocalIterator()
        pairs = sorted((tuple(r) for r in rows), key=lambda r: (r[0] is None, r))
        items = Items([r[0] for r in pairs], [r[1] for r in pairs], percent)
        if items.words:
            out = out.unionByName(search(docs, items))
    return out


def search(docs: DataFrame, items: Items) -> DataFrame:
    context = docs.sparkSession.sparkContext
    table = context.broadcast(items.vocabulary)

    def count(batches):
        sums = np.zeros(len(table.value), np.int64)
        for batch in batches:
            for piece in slices(batch):
                at = known(table.value, piece.words(FOLD, white=BREAK).hashes)
                sums += np.bincount(at[at >= 0], minlength=len(sums))
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(sums)), pa.array(sums[sums > 0])], names=["word", "n"])

    every = docs.select("text").mapInArrow(count, "word long, n long")
    counts = {int(items.vocabulary[r["word"]]): r["n"] for r in every.groupBy("word").agg(F.sum("n").alias("n")).collect()}
    items.prepare(counts)
    shared = context.broadcast(items)

    def run(batches):
        for batch in batches:
            ids, found = column(batch, "doc_id"), defaultdict(list)
            for piece in slices(batch):
                w = piece.words(FOLD, white=BREAK)
                start, n, own = windows(shared.value, w.hashes, w.at)
                row = np.searchsorted(w.at, start, "right") - 1
                for size in np.unique(n).tolist():
                    some = n == size
                    place = np.minimum(start[some][:, None] + np.arange(size), len(w.hashes) - 1)  # words after a short text are not read
                    found[size].append((row[some] + piece.first, start[some] - w.at[row[some]], w.hashes[place], own[some]))
            out = matches(shared.value, found)
            at, item, start, n, distance = zip(*out) if out else ((),) * 5
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(at, pa.int64())), pa.array(item, pa.int64()), *(pa.array(x, pa.int32()) for x in (start, n, distance))],
                                             names=["doc_id", "item_id", "start", "n_words", "distance"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, item_id long, start int, n_words int, distance int")

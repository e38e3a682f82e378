"""Bigram language model in Elias-Fano tries.

Every text is lower-cased (A-Z) and cut into words, then one end token. Counts come from the training documents
(``crc32(doc_id) mod 7 <> 2``). P(v | u) = (c(u, v) + MU * P(v)) / (c(u) + MU); P(v) is the add-one unigram of every word, however
rare; words that training does not hold count 0, as one class.

Word pairs meet in shards by context; frequent contexts, whose totals are known, are spread by the pair. Each shard builds
a trie of its training pairs: contexts and their successors as Elias-Fano sequences (low
parts of whole bytes, high parts as a bucket directory), probabilities quantised to 16 bits. Successors are stored
relative to their context (rising within it, offset by its number), in place of pointers, so a pair is one successor search. Levels are flat
buffers, as they would be mapped from a file. Then the shard scores all its pairs and sums them per document; the sums go
back in the blocks that the pairs came in.

Scale: three passes over the texts; pairs are shuffled once as packed, sorted and compressed blocks (about 8 bytes a
pair), some shards at a time where they are written, and their sums per document once, as one row per block; a block holds what one slice of texts sends to one shard. The table of common words, which every task has, holds at most ``COMMON`` entries; the counts of
rarer words come from a join, for the base score by document, for the pairs by shard (only those that a shard's pairs
hold). The shares of common words are quantised and those of rarer words exact, so ``COMMON`` changes scores in the second
decimal where there are more words than it holds. Contexts and words meet by 32 bits of their hashes: some thousand pairs of
words share their counts at ten million distinct words. Defined cases: null and empty texts are one end token; rows without doc_id are left out of the
result and of training; rows that repeat a doc_id with its text get the same scores; extra columns are ignored.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from siftgate.llm.spans import LOWER, Slice, column, mix, slices
from siftgate.sources.storage import materialise, release

COMMON = 400_000
MU = 4.0
STEP = 1 / 4096            #: of the quantised log10 probabilities
RARE = 65535               #: in place of a quantised probability: the pair's word is in the block's list of rare words
PASSES = 4                 #: shuffles that the shards of written blocks are dealt to
PACKED = 4 << 20           #: bytes of text whose pairs are packed together
BEGIN, END = np.uint64(1), np.uint64(2)
LOW32 = np.uint64(0xFFFFFFFF)


class EliasFano:
    """A strictly rising sequence of unsigned 64-bit integers, searched by value."""

    def __init__(self, values: np.ndarray):
        n = max(len(values), 1)
        top = int(values[-1]) + 1 if len(values) else 1
        bits = max(0, (top // n).bit_length() - 1)
        self.bits = next(b for b in (0, 8, 16, 32, 48) if b >= bits)
        kind = {0: np.uint8, 8: np.uint8, 16: np.uint16, 32: np.uint32, 48: np.uint64}[self.bits]
        high = (values >> np.uint64(self.bits)).astype(np.int64)
        self.low = (values & np.uint64((1 << self.bits) - 1)).astype(kind)
        self.first = np.searchsorted(high, np.arange((top >> self.bits) + 2)).astype(np.int32)
        self.widest = int(np.diff(self.first).max(initial=0))

    def find(self, x: np.ndarray) -> np.ndarray:
        """Place of each value, -1 where the sequence does not hold it."""
        high = np.minimum(x >> np.uint64(self.bits), np.uint64(len(self.first) - 2)).astype(np.int64)
        inside = (x >> np.uint64(self.bits)) <= np.uint64(len(self.first) - 2)
        lo, hi = self.first[high].astype(np.int64), self.first[high + 1].astype(np.int64)
        low = (x & np.uint64((1 << self.bits) - 1)).astype(self.low.dtype)
        out = np.full(len(x), -1, np.int64)
        steps = max(self.widest, 1).bit_length()
        for _ in range(steps):  # successor search inside the bucket
            open_ = lo < hi
            mid = np.minimum((lo + hi) >> 1, max(len(self.low) - 1, 0))
            less = open_ & (self.low[mid] < low) if len(self.low) else open_
            lo, hi = np.where(less, mid + 1, lo), np.where(open_ & ~less, mid, hi)
        if len(self.low):
            at = np.minimum(lo, len(self.low) - 1)
            hit = inside & (lo < self.first[high + 1]) & (self.low[at] == low)
            out[hit] = at[hit]
        return out


class Trie:
    """Training pairs of a shard with quantised probabilities. Pairs: u and v (32 bits), sorted and distinct."""

    def __init__(self, u: np.ndarray, v: np.ndarray, logs: np.ndarray):
        new = np.r_[True, u[1:] != u[:-1]] if len(u) else np.zeros(0, bool)
        self.contexts = EliasFano(u[new])
        self.successors = EliasFano(((np.cumsum(new) - 1).astype(np.uint64) << np.uint64(32)) | v if len(u) else u)
        self.logs = np.clip(np.round(-logs / STEP), 0, 65535).astype(np.uint16)

    def find(self, u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(whether the pair is held, its log10 probability)."""
        context = self.contexts.find(u)
        place = self.successors.find((np.maximum(context, 0).astype(np.uint64) << np.uint64(32)) | v)
        held = (context >= 0) & (place >= 0)
        return held, self.logs[np.maximum(place, 0)] * -STEP if len(self.logs) else np.zeros(len(u))


def tokens(piece: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, token, token before) of a slice; each row ends with END and starts after BEGIN."""
    w = piece.words(LOWER)
    row = np.concatenate([w.rows(), np.arange(piece.rows)])
    order = np.argsort(row, kind="stable")
    word = np.concatenate([np.where(w.hashes < 16, w.hashes + np.uint64(16), w.hashes), np.full(piece.rows, END)])[order]
    row = row[order]
    before = np.r_[BEGIN, word[:-1]]
    before[np.r_[True, row[1:] != row[:-1]]] = BEGIN
    return row, word, before


def training() -> "F.Column":
    return F.crc32(F.col("doc_id").cast("string")) % 7 != 2


def unigrams(docs: DataFrame) -> DataFrame:
    """(word, c): counts of the training tokens."""
    def run(batches):
        for batch in batches:
            for piece in slices(batch, limit=4 << 20):
                word, c = np.unique(tokens(piece)[1], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(c)], names=["word", "c"])

    return docs.filter(training()).select("text").mapInArrow(run, "word long, c long").groupBy("word").agg(F.sum("c").alias("c"))


class Common:
    """Counts of the frequent words, and the numbers of all."""

    def __init__(self, words: DataFrame):
        # counts by size class; the last class of words that fits COMMON sets the limit
        sizes = words.groupBy(F.least("c", F.lit(100_000)).alias("c0")).agg(F.count("*").alias("n"), F.sum("c").alias("sum")).orderBy("c0").collect()
        self.types, self.total = sum(r["n"] for r in sizes), sum(r["sum"] for r in sizes)
        held, self.least = 0, 100_001
        for r in reversed(sizes):
            if held + r["n"] > COMMON:
                break
            held, self.least = held + r["n"], r["c0"]
        rows = words.filter(F.col("c") >= self.least).toPandas()
        keys = rows["word"].to_numpy(np.int64).view(np.uint64)
        order = np.argsort(keys)
        self.keys, self.counts = keys[order], rows["c"].to_numpy(np.int64)[order]
        self.whole = len(self.keys) == self.types

    def count(self, word: np.ndarray) -> np.ndarray:
        """Count of each word, -1 if it is not common."""
        if not len(self.keys):
            return np.full(len(word), -1)
        at = np.minimum(np.searchsorted(self.keys, word), len(self.keys) - 1)
        return np.where(self.keys[at] == word, self.counts[at], -1)

    def short(self, word: np.ndarray) -> np.ndarray:
        """The same for the low 32 bits of words."""
        low = self.keys & LOW32
        order = np.argsort(low, kind="stable")
        low = low[order]
        at = np.minimum(np.searchsorted(low, word), max(len(low) - 1, 0))
        return np.where(low[at] == word, self.counts[order][at], -1) if len(low) else np.full(len(word), -1)

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + 1) / (self.total + self.types + 1))


def base_scores(docs: DataFrame, words: DataFrame, common: Common) -> DataFrame:
    """(doc_id, n_tokens, n_known, base_score)."""
    shared = docs.sparkSession.sparkContext.broadcast(common)

    def run(batches):
        for batch in batches:
            for piece in slices(batch):
                row, word, _ = tokens(piece)
                c = shared.value.count(word)
                often = c >= 0
                known = np.bincount(row[often & (c > 0)], minlength=piece.rows)
                sums = np.bincount(row[often], shared.value.base(c[often]), minlength=piece.rows).astype(float)  # integers where there is none
                offsets = pa.array(np.searchsorted(row[~often], np.arange(piece.rows + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [column(batch, "doc_id").slice(piece.first, piece.rows), pa.array(np.bincount(row, minlength=piece.rows)), pa.array(known), pa.array(sums),
                     pa.ListArray.from_arrays(offsets, pa.array(word[~often].view(np.int64)))], names=["doc_id", "n_tokens", "n_known", "sums", "rare"])

    rows = materialise(docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, n_known long, sums double, rare array<long>")
                       .groupBy("doc_id").agg(*[F.first(c).alias(c) for c in ("n_tokens", "n_known", "sums", "rare")]))
    rare = rows.select("doc_id", F.explode("rare").alias("word")).join(words, "word", "left").select("doc_id", F.coalesce("c", F.lit(0)).alias("c"))
    rest = rare.groupBy("doc_id").agg(F.sum((F.col("c") > 0).cast("long")).alias("k"), F.sum(F.log10((F.col("c") + 1) / (common.total + common.types + 1))).alias("s"))
    return rows.join(rest, "doc_id", "left").select("doc_id", "n_tokens", (F.col("n_known") + F.coalesce("k", F.lit(0))).alias("n_known"),
                                                    (F.col("sums") + F.coalesce("s", F.lit(0.0))).alias("base_score"))


def pair_scores(docs: DataFrame, words: DataFrame, common: Common, train_docs: int) -> DataFrame:
    """(doc_id, score): log10 probability of each text."""
    spark = docs.sparkSession
    shared, shards = spark.sparkContext.broadcast(common), max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def pack(batches):
        known, place = shared.value, TaskContext.get().partitionId() << 32
        for batch in batches:
            ids, train = column(batch, "doc_id").to_numpy(zero_copy_only=False), column(batch, "train").to_numpy(zero_copy_only=False).astype(bool)
            held, size = [], 0
            for piece in slices(batch):
                row, v, u = tokens(piece)
                cv, often = known.count(v), (known.count(u) >= 0) | (u == BEGIN)
                logs = np.clip(np.round(-known.base(np.maximum(cv, 0)) / STEP), 0, RARE - 1).astype(np.uint16)  # a word that is in no count has 0
                logs[(cv < 0) & (not known.whole)] = RARE
                spread = mix(np.where(often, u ^ mix(v), u))
                held.append(((row + piece.first).astype(np.int32), v, (u & LOW32).astype(np.uint32), logs, ((spread >> np.uint64(20)) % np.uint64(shards)).astype(np.int32)))
                size += len(piece.data)
                if size >= PACKED:
                    place += 1
                    yield blocks_of(held, ids, train, place)
                    held, size = [], 0
            if held:
                place += 1
                yield blocks_of(held, ids, train, place)

    def blocks_of(held, ids, train, place):
        """One row for each shard of some slices' pairs; only what is kept of a pair is held for all slices."""
        row, v, u, logs, shard = (np.concatenate(x) for x in zip(*held))
        held.clear()
        order = np.lexsort((v.astype(np.uint32), u, shard))
        edges = np.searchsorted(shard[order], np.arange(shards + 1))
        out = [[], [], [], [], [], []]
        for s in range(shards):
            part = order[edges[s]:edges[s + 1]]
            if not len(part):
                continue
            docs_, at = np.unique(row[part], return_inverse=True)
            blob = np.concatenate([np.diff(u[part].astype(np.int64), prepend=0).astype(np.uint32).view(np.uint8), v[part].astype(np.uint32).view(np.uint8),
                                   at.astype(np.uint32).view(np.uint8), logs[part].view(np.uint8)])
            body = pa.compress(blob.tobytes(), codec="zstd", asbytes=True)
            rare = v[part][logs[part] == RARE].view(np.int64)
            for to, x in zip(out, (s, len(part), body, ids[docs_].astype(np.int64).tobytes(), train[docs_].tobytes(), rare)):
                to.append(x)
        return pa.RecordBatch.from_arrays([pa.array([place] * len(out[0]), pa.int64()), pa.array(out[0], pa.int32()), pa.array(out[1], pa.int64()),
                                           *(pa.array(x, pa.binary()) for x in out[2:5]), pa.array(out[5], pa.list_(pa.int64()))],
                                          names=["place", "shard", "n", "body", "docs", "train", "rare"])

    def counted(batches):
        """Counts of rare words as rows of their shards, at place 0."""
        for batch in batches:
            shard, word, c = (column(batch, x).to_numpy() for x in ("shard", "word", "c"))
            order = np.argsort(shard, kind="stable")
            names, first = np.unique(shard[order], return_index=True)
            parts = np.split(order, first[1:])
            none = pa.array([b""] * len(names), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([0] * len(names), pa.int64()), pa.array(names, pa.int32()), pa.array([len(x) for x in parts], pa.int64()),
                                              pa.array([c[x].astype(np.int64).tobytes() for x in parts] if len(c) else [], pa.binary()), none, none,
                                              pa.array([word[x] for x in parts] if len(c) else [], pa.list_(pa.int64()))],
                                             names=["place", "shard", "n", "body", "docs", "train", "rare"])

    def grouped(batches, key):
        """Rows of sorted batches, a list for each value of the key."""
        held = []
        for batch in batches:
            lists = batch.column("rare") if "rare" in batch.schema.names else None
            for i, r in enumerate(batch.drop_columns(["rare"]).to_pylist() if lists is not None else batch.to_pylist()):
                if lists is not None:
                    r["rare"] = lists[i].values.to_numpy()
                if held and r[key] != held[0][key]:
                    yield held
                    held = []
                held.append(r)
        if held:
            yield held

    def score(batches):
        for rows in grouped(batches, "shard"):
            yield shard_scores(rows)

    def add(batches):
        for rows in grouped(batches, "place"):
            ids, at = np.unique(np.frombuffer(b"".join(r["docs"] for r in rows), np.int64), return_inverse=True)
            sums = np.bincount(at, np.frombuffer(b"".join(r["sums"] for r in rows), np.float64))
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(sums)], names=["doc_id", "score"])

    def shard_scores(rows):
        known, ids, train, base, begin = shared.value, [], [], 0, 0
        counts, rows = [r for r in rows if not r["place"]], [r for r in rows if r["place"]]
        total_n = sum(r["n"] for r in rows)
        u, v, doc, logs = (np.empty(total_n, t) for t in (np.uint32, np.uint32, np.int32, np.uint16))
        for r in rows:
            n, blob = r["n"], np.frombuffer(pa.decompress(r["body"], decompressed_size=14 * r["n"], codec="zstd", asbytes=True), np.uint8)
            r["body"], to = None, slice(begin, begin + n)
            u[to] = np.cumsum(blob[:4 * n].view(np.uint32), dtype=np.uint32)
            v[to], doc[to], logs[to] = blob[4 * n:8 * n].view(np.uint32), blob[8 * n:12 * n].view(np.uint32).astype(np.int32) + base, blob[12 * n:].view(np.uint16)
            ids.append(np.frombuffer(r["docs"], np.int64))
            train.append(np.frombuffer(r["train"], bool))
            base, begin = base + len(ids[-1]), begin + n
        ids, train = np.concatenate(ids), np.concatenate(train)
        lower = logs * -STEP
        if not known.whole:
            rare = np.concatenate([np.array(r["rare"], np.int64) for r in rows])
            words_, times = np.zeros(0, np.int64), np.zeros(0, np.int64)
            if counts:
                words_ = np.concatenate([np.array(r["rare"], np.int64) for r in counts])
                times = np.concatenate([np.frombuffer(r["body"], np.int64) for r in counts])
            order = np.argsort(words_)
            words_, times = np.r_[words_[order], 0], np.r_[times[order], 0]
            at = np.searchsorted(words_[:-1], rare)
            lower[logs == RARE] = known.base(np.where(words_[at] == rare, times[at], 0))
        learning = train[doc]
        key, sample, inverse = np.unique(u.astype(np.uint64) << np.uint64(32) | v, return_index=True, return_inverse=True)  # each pair once
        del u, v, logs
        times, lower = np.bincount(inverse[learning], minlength=len(key)), lower[sample]
        u, v = key >> np.uint64(32), key & LOW32
        contexts, context = np.unique(u, return_inverse=True)
        totals = np.bincount(context, times, minlength=len(contexts))  # right where a context is whole in its shard
        often = known.short(contexts)
        totals = np.where(often >= 0, often, totals)
        totals[contexts == (BEGIN & LOW32)] = train_docs
        total, mass, learnt = totals[context], 10 ** lower, times > 0
        logs_ = np.log10((times[learnt] + MU * mass[learnt]) / (total[learnt] + MU))
        held, value = Trie(u[learnt], v[learnt], logs_).find(u, v)
        scores = np.where(held, value, np.log10(MU * mass / (total + MU)))[inverse]
        sums, edges = np.bincount(doc, scores, minlength=len(ids)), np.cumsum([0, *(len(r["docs"]) // 8 for r in rows)])
        return pa.RecordBatch.from_arrays([pa.array([r["place"] for r in rows], pa.int64()), pa.array([r["docs"] for r in rows], pa.binary()),
                                           pa.array([sums[a:b].tobytes() for a, b in zip(edges, edges[1:])], pa.binary())], names=["place", "docs", "sums"])

    layout = "place long, shard int, n long, body binary, docs binary, train binary, rare array<long>"
    blocks = docs.select("doc_id", "text", F.coalesce(training(), F.lit(True)).alias("train")).mapInArrow(pack, layout)
    if not common.whole:
        packed = materialise(blocks)
        wanted = packed.select("shard", F.explode(F.array_distinct("rare")).alias("word")).distinct()
        counts = materialise(wanted.join(words, "word").select("shard", "word", "c").mapInArrow(counted, layout))
        blocks = packed.unionByName(counts)
    def scored(rows):
        return rows.repartition("shard").sortWithinPartitions("shard").mapInArrow(score, "place long, docs binary, sums binary")

    if common.whole:
        sums = scored(blocks)
    else:  # the blocks are written; some shards' at a time are shuffled
        sums = reduce(DataFrame.unionByName, [materialise(scored(blocks.filter(F.col("shard") % PASSES == p))) for p in range(PASSES)])
        release(packed)
    # a document's blocks share a place unless a lost task was done again over rows in another order; the last sum covers that
    return (sums.repartition("place").sortWithinPartitions("place").mapInArrow(add, "doc_id long, score double")
            .groupBy("doc_id").agg(F.sum("score").alias("score")))


def language_model(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    rows = docs.select("doc_id", "text").filter("doc_id is not null")
    words = materialise(unigrams(rows))
    common = Common(words)
    texts = rows.groupBy("doc_id").agg(F.count("*").alias("copies"))
    ends = words.filter(F.col("word") == int(END)).select("c").first()
    scores = pair_scores(rows, words, common, ends["c"] if ends else 0)
    return (base_scores(rows, words, common).join(scores, "doc_id").join(texts, "doc_id")
            .withColumn("_n", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
            .select("doc_id", (~training()).alias("held_out"), "n_tokens", "n_known", F.lit(int(common.total)).cast("long").alias("train_tokens"), "base_score",
                    (F.col("score") / F.col("copies")).alias("score")))

"""Quality classifier from weak labels: EM over heuristic labellers, then a hashed linear scorer.

Labellers look at one property of a text each and vote bad (0), good (1) or nothing (2). Expectation-maximisation over
the counts of vote patterns of all documents estimates each labeller's accuracy for both classes and the share of
good documents, without any given label. The posteriors label a sample on which a logistic scorer of hashed word
and word-shape features is trained; it scores every document, and documents below the threshold are rejected.

Scale: two passes over the texts, no shuffle of them. What reaches the driver: one count per vote pattern (at most
3 ** labellers) and ``WEIGHTS`` weights. The sample are the documents whose hash of (doc_id, text) is below a bound chosen
so that ``SAMPLE`` of them are expected; one task trains on it.
Defined cases: null and empty texts vote bad and score 0; equal texts get equal scores; an empty table gives an empty
table; rows without doc_id are scored as others; extra columns are kept (``weak``, ``score``, ``kept`` are replaced).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from siftgate.llm.spans import LOWER, Slice, Words, mix, slices

WEIGHTS = 1 << 16       #: hashed features
SAMPLE = 6_000          #: expected number of documents that train the scorer
THRESHOLD = 0.5
LABELLERS = 8
NONE = 2


def table(*codes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[b for c in codes for b in (c if isinstance(c, range) else [c])]] = True
    return out


SYMBOL = table(*b"#*$%&|<>{}[]~^=_\\")
LETTER = table(range(65, 91), range(97, 123), range(0xC3, 0x100))
CAPITAL, SMALL = table(range(65, 91)), table(range(97, 123), range(0xC3, 0x100))
CHAR = ~table(range(0x80, 0xC0))
END, SHOUT = table(*b".,!?;:"), table(*b"!")


def repeats(w: Words, row: np.ndarray) -> np.ndarray:
    """Whether each word equals the one before it."""
    out = np.zeros(len(row), bool)
    out[1:] = (w.hashes[1:] == w.hashes[:-1]) & (row[1:] == row[:-1])
    return out


def votes(piece: Slice, w: Words) -> np.ndarray:
    """Votes of the labellers on each text."""
    per_byte = lambda t: np.diff(np.r_[0, np.cumsum(t[piece.data])][piece.at])
    per_word = lambda x: np.diff(np.r_[0, np.cumsum(x)][w.at])
    n, row = np.diff(w.at), w.rows()
    some, chars, letters = np.maximum(n, 1), np.maximum(per_byte(CHAR), 1), np.maximum(per_byte(LETTER), 1)
    order = np.lexsort((w.hashes, row))
    h, r = w.hashes[order], row[order]
    new = np.r_[True, (h[1:] != h[:-1]) | (r[1:] != r[:-1])] if len(h) else np.zeros(0, bool)
    kinds = np.bincount(r[new], minlength=piece.rows) / some
    letter = np.r_[0, np.cumsum(LETTER[piece.data])]
    bare = letter[w.end] == letter[w.start]  # words without letters
    last = piece.data[w.end - 1] if len(w.end) else piece.data[:0]
    ends = per_word(END[last]) / some
    symbols, capitals = per_byte(SYMBOL) / chars, per_byte(CAPITAL) / letters
    bad = [symbols > 0.015, capitals > 0.3, per_byte(LETTER) / chars < 0.66, (n < 2) | (kinds < 0.2),
           per_word(repeats(w, row)) / some > 0.2, per_word(SHOUT[last]) / some > 0.2, (ends > 0.6) & (n >= 5), per_word(bare) / some > 0.15]
    out = np.where(np.stack(bad, 1), 0, NONE)
    out[:, 6][(out[:, 6] == NONE) & (ends > 0.01) & (ends < 0.35) & (n >= 5)] = 1
    return out


def features(piece: Slice, w: Words) -> np.ndarray:
    """Two hashed features of each word: the word in lower case; its last two bytes, whether it is all capitals, and whether it repeats."""
    half = np.uint64(WEIGHTS // 2)
    small = np.r_[0, np.cumsum(SMALL[piece.data])]
    shape = (piece.data[w.end - 1].astype(np.uint64) << np.uint64(10)) | (repeats(w, w.rows()).astype(np.uint64) << np.uint64(9)) | (piece.data[np.maximum(w.end - 2, w.start)].astype(np.uint64) << np.uint64(1))
    shape |= (small[w.end] == small[w.start]).astype(np.uint64)
    return np.stack([w.hashes % half, half + mix(shape) % half]).astype(np.int64)


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 60) -> tuple[np.ndarray, float, np.ndarray]:
    """EM over vote patterns: P(vote | class) of each labeller, share of good, posterior of each pattern."""
    n, each = counts.astype(float), np.arange(patterns.shape[1])
    ballots = (patterns == 1).sum(1) + 1 - (patterns == 0).sum(1) * 3.0  # start: one bad vote outweighs the good ones
    post = 1 / (1 + np.exp(-ballots))
    for _ in range(rounds):
        share = np.clip((post * n).sum() / n.sum(), 1e-3, 1 - 1e-3)
        odds = np.zeros((2, len(each), 3))
        for c, weight in ((0, (1 - post) * n), (1, post * n)):
            for k in each:
                odds[c, k] = np.bincount(patterns[:, k], weight, 3) + 1
        odds /= odds.sum(2, keepdims=True)
        logs = np.log(odds[:, each, patterns]).sum(2) + np.log([[1 - share], [share]])
        post = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -50, 50)))
    return odds, float(share), post


def train(sample: pd.DataFrame, posteriors: np.ndarray, epochs: int = 10) -> np.ndarray:
    """Logistic scorer of mean feature weights; the last weight is the bias."""
    rows, target = [], []
    for piece in slices(pa.RecordBatch.from_pandas(sample[["text"]].astype(object), preserve_index=False)):
        w = piece.words(LOWER)
        found, labels = features(piece, w), posteriors[votes(piece, w) @ CODE]
        for i in range(piece.rows):
            if w.at[i + 1] > w.at[i]:
                rows.append(np.unique(found[:, w.at[i]:w.at[i + 1]], return_counts=True))
                target.append(labels[i])
    weights, bias, grads, rng = np.zeros(WEIGHTS), 0.0, np.full(WEIGHTS, 1e-2), np.random.default_rng(7)
    good = float(np.clip(np.mean(target) if target else 0.5, 0.01, 0.99))
    for _ in range(epochs):
        for i in rng.permutation(len(rows)).tolist():
            at, count = rows[i]
            x = count * (40 / count.sum())
            p = 1 / (1 + np.exp(-np.clip(weights[at] @ x + bias, -30, 30)))
            g = (p - target[i]) * (0.5 / good * target[i] + 0.5 / (1 - good) * (1 - target[i]))
            grads[at] += (g * x) ** 2
            weights[at] -= 0.2 * g * x / np.sqrt(grads[at])
            bias -= 0.02 * g
    return np.append(weights, bias)


CODE = 3 ** np.arange(LABELLERS)


def quality(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Adds weak (posterior of the votes), score (of the linear scorer, 0 to 1) and kept."""
    context = docs.sparkSession.sparkContext

    def count(batches):
        sums = np.zeros(3 ** LABELLERS, np.int64)
        for batch in batches:
            for piece in slices(batch):
                sums += np.bincount(votes(piece, piece.words(LOWER)) @ CODE, minlength=len(sums))
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(sums)), pa.array(sums[sums > 0])], names=["code", "n"])

    counts = docs.select("text").mapInArrow(count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).orderBy("code").toPandas()
    posteriors = np.full(3 ** LABELLERS, 0.5)
    if len(counts):
        codes = counts["code"].to_numpy()
        posteriors[codes] = estimate(codes[:, None] // CODE % 3, counts["n"].to_numpy())[2]
    total = max(int(counts["n"].sum()), 1)
    share = int(min(1.0, SAMPLE / total) * (1 << 40))
    sample = docs.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 40)) < share).select("text")
    fit = sample.groupBy().applyInPandas(lambda rows: pd.DataFrame({"w": [train(rows, posteriors).tolist()]}), "w array<double>").first()
    model = context.broadcast((posteriors, np.array(fit["w"]) if fit else np.zeros(WEIGHTS + 1)))  # WEIGHTS + 3 ** LABELLERS numbers
    kept = [f for f in docs.schema if f.name not in ("weak", "score", "kept")]

    def run(batches):
        known, weights = model.value
        for batch in batches:
            for piece in slices(batch):
                w = piece.words(LOWER)
                n = np.diff(w.at)
                sums = np.diff(np.r_[0, np.cumsum(weights[features(piece, w)].sum(0))][w.at]) * 20 / np.maximum(n, 1)
                score = np.where(n > 0, 1 / (1 + np.exp(-np.clip(sums + weights[-1], -30, 30))), 0.0)
                part = batch.slice(piece.first, piece.rows)
                yield pa.RecordBatch.from_arrays([*(part.column(part.schema.get_field_index(f.name)) for f in kept), pa.array(known[votes(piece, w) @ CODE]),
                                                  pa.array(score), pa.array(score >= threshold)], names=[*(f.name for f in kept), "weak", "score", "kept"])

    return docs.mapInArrow(run, T.StructType([*kept, T.StructField("weak", T.DoubleType()), T.StructField("score", T.DoubleType()), T.StructField("kept", T.BooleanType())]))

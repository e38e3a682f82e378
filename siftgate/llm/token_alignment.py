"""Cross-tokenizer alignment: where two tokenizers cut a text at the same bytes, and which ids meet there.

``align`` encodes each text by tokenizer A (byte-level BPE, ``tokenizers``) with a space before it and by tokenizer B
(``sentencepiece``, which adds that space itself). Offsets at which a token of each ends cut the tokens into groups; the
two tokens that end there are a link. A pair of ids counts how many links hold it.

Identity-map fast path: most groups are one token of A and one of B with the same bytes. An array leads from each id of A
to the id of B with its bytes, so such a group is known by the A id alone; its links are counted in vectors as long as the
vocabulary, one a task. Only links of other groups become pairs, once for each document, are counted by pair, and meet
their counts in a join that AQE can split. The vectors and the highest count of each B id have at most one entry per id:
these, and the tokenizer files, are all that is broadcast.

Each text is encoded once; what the second pass needs is written to the shared folder. If the merges of A follow its ids
and every entry is what the merges make of its bytes (``by_ranks``, checked once), two neighbours that join to an entry
are always its own merge: between cuts that no merge crosses, merging goes as it does in the entry alone. Then merging by the
ids of joined neighbours gives the same tokens, and ``tiktoken`` does that several times faster than ``tokenizers``.

Defined results: null and empty texts, and texts of which either tokenizer's bytes are not the text with a space before
it (B may normalise), have no tokens: zeros and an empty string. Every row is a document of its own, so repeated rows
count again. Ties for a B id's highest count all are highest. An empty table gives an empty result. Texts are encoded
whole, one text by one task. Columns other than doc_id and text are not read, so extra columns never clash.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, functions as F, types as T

from siftgate.sources.storage import materialise

BLOCK = 1_000_000  # characters of text that are aligned at a time
# fixed value: the pattern of byte-level tokenizers without one of their own
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
PAIRS = "pairs array<long>, times array<long>"


class Files(NamedTuple):
    """Contents of the tokenizer files (a few MB, bounded by the vocabularies), and whether A may be merged by ids."""
    a: str
    b: bytes
    ranked: bool


def read_files(a_path: str, b_path: str) -> Files:
    with open(a_path, encoding="utf-8") as a, open(b_path, "rb") as b:
        text = a.read()
        return Files(text, b.read(), by_ranks(json.loads(text)))


def by_ranks(a: dict) -> bool:
    """Whether merging neighbours by the id of what they join to is what this tokenizer does."""
    cutter, model = a.get("pre_tokenizer") or {}, a["model"]
    plain = {k: cutter.get(k) for k in BYTE_LEVEL} == BYTE_LEVEL and not a.get("normalizer") and model["type"] == "BPE"
    if not plain or any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")):
        return False
    merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    rank = {pair: i for i, pair in enumerate(merges)}
    ids = [model["vocab"].get(x + y, -1) for x, y in merges]
    others = model["vocab"].keys() - {x + y for x, y in merges} - {t["content"] for t in a.get("added_tokens", [])}
    if any(x >= y for x, y in zip(ids, ids[1:])) or others != byte_letters().keys() or any(model["vocab"][x] > ids[0] for x in others):
        return False
    return all(merged(x + y, rank) == [x + y] for x, y in merges)


def merged(entry: str, rank: dict[tuple[str, str], int]) -> list[str]:
    """What ranked merges make of an entry's letters."""
    parts = list(entry)
    while len(parts) > 1:
        best, at = min((rank.get(pair, len(rank)), i) for i, pair in enumerate(zip(parts, parts[1:])))
        if best == len(rank):
            break
        parts[at:at + 2] = ["".join(parts[at:at + 2])]
    return parts


def byte_letters() -> dict[str, int]:
    """The letter by which byte-level vocabularies write each byte: itself if printable, else the next free one from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Tokenizers:
    """Both tokenizers, the bytes and lengths of their ids, and ``same``: for each A id the B id with its bytes, or -1."""

    def __init__(self, files: Files):
        import sentencepiece
        import tiktoken
        import tokenizers

        self.a = tokenizers.Tokenizer.from_str(files.a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=files.b)
        letters = byte_letters()
        entries = self.a.get_vocab()
        self.a_bytes = [b""] * (max(entries.values()) + 1)
        for entry, i in entries.items():
            self.a_bytes[i] = bytes(letters[c] for c in entry) if all(c in letters for c in entry) else entry.encode()
        self.b_bytes = [bytes([int(self.b.id_to_piece(i)[1:-1], 16)]) if self.b.is_byte(i) else
                        self.b.id_to_piece(i).replace("▁", " ").encode() for i in range(self.b.get_piece_size())]
        self.a_size, self.b_size = len(self.a_bytes), len(self.b_bytes)
        self.a_length, self.b_length = (np.array([len(x) for x in tokens], np.int64) for tokens in (self.a_bytes, self.b_bytes))
        by_bytes: dict[bytes, int] = {}
        for i in sorted(range(self.b_size), key=lambda i: (self.b.is_byte(i) or self.b.is_control(i) or self.b.is_unknown(i), i)):
            by_bytes.setdefault(self.b_bytes[i], i)
        self.same = np.array([by_bytes.get(x, -1) for x in self.a_bytes], np.int64)
        self.words = [f"{i},".encode() for i in range(self.a_size)] + [f"{i}|".encode() for i in range(self.a_size)] + [
            f"{i},".encode() for i in range(self.b_size)] + [f"{i};".encode() for i in range(self.b_size)]
        special = {t["content"] for t in json.loads(files.a).get("added_tokens", [])}
        ranks = {self.a_bytes[i]: i for entry, i in entries.items() if entry not in special}
        self.fast_a = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}) if files.ranked else None

    def encode_a(self, texts: list[str]) -> list[list[int]]:
        if self.fast_a:
            return [self.fast_a.encode_ordinary(t) for t in texts]
        return [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]

    def encode_b(self, texts: list[str]) -> list[list[int]]:
        return self.b.encode(texts, num_threads=1)


@lru_cache(maxsize=1)
def loaded(files: Files) -> Tokenizers:
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on every core
    return Tokenizers(files)


def flat(lists: list[list[int]]) -> np.ndarray:
    return np.fromiter(chain.from_iterable(lists), np.int64, sum(map(len, lists)))


def listed(values: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def aligned(tools: Tokenizers, texts: list[str | None], groups: bool) -> dict[str, pa.Array]:
    """Columns of one block of documents."""
    used = [i for i, t in enumerate(texts) if t]
    raw = [" " + texts[i] for i in used]
    a_ids, b_ids = tools.encode_a(raw), tools.encode_b([texts[i] for i in used])
    same = lambda t, tokens, ids: t == b"".join(map(tokens.__getitem__, ids))
    right = [k for k, t in enumerate(x.encode() for x in raw)
             if same(t, tools.b_bytes, b_ids[k]) and (tools.fast_a or same(t, tools.a_bytes, a_ids[k]))]  # merging by ids keeps every byte
    rows = np.array([used[k] for k in right], np.int64)
    a_ids, b_ids = [a_ids[k] for k in right], [b_ids[k] for k in right]
    spread = lambda x: np.bincount(rows, x, len(texts)).astype(np.int64) if len(rows) else np.zeros(len(texts), np.int64)

    a, b = flat(a_ids), flat(b_ids)
    n_a, n_b = (np.array([len(x) for x in ids], np.int64) for ids in (a_ids, b_ids))
    a_end, b_end = np.cumsum(tools.a_length[a]), np.cumsum(tools.b_length[b])
    ends = np.zeros((2, (a_end[-1] if len(a) else 0) + 1), bool)
    ends[0, a_end], ends[1, b_end] = True, True
    a_last, b_last = np.flatnonzero(ends[1, a_end]), np.flatnonzero(ends[0, b_end])
    a_many, b_many = np.diff(a_last, prepend=-1), np.diff(b_last, prepend=-1)
    last_a, last_b = a[a_last], b[b_last]
    fast = (a_many == 1) & (b_many == 1) & (tools.same[last_a] == last_b)
    of = np.searchsorted(np.cumsum(n_a), a_last, side="right")
    of_row = rows[of] if len(rows) else of
    key, times = np.unique((of_row * tools.a_size + last_a)[~fast] * tools.b_size + last_b[~fast], return_counts=True)
    size = tools.a_size * tools.b_size

    code = np.empty(len(a) + len(b), np.int64)
    code[np.arange(len(a)) + np.repeat(np.cumsum(b_many) - b_many, a_many)] = a + tools.a_size * np.isin(np.arange(len(a)), a_last)
    code[np.arange(len(b)) + np.repeat(np.cumsum(a_many), b_many)] = b + 2 * tools.a_size + tools.b_size * np.isin(np.arange(len(b)), b_last)
    cut = [b""] * len(texts)
    at = 0
    for row, n in zip(rows.tolist(), (n_a + n_b).tolist()):
        cut[row] = b"".join(map(tools.words.__getitem__, code[at:at + n].tolist()))[:-1]
        at += n
    n_groups = np.bincount(of_row, minlength=len(texts))
    out = {"n_a": pa.array(spread(n_a)), "n_b": pa.array(spread(n_b)), "n_groups": pa.array(n_groups.astype(np.int64)),
           "groups_sha256": pa.array([hashlib.sha256(x).hexdigest() if x else "" for x in cut]),
           "regular": listed(last_a[fast].astype(np.int32), np.bincount(of_row[fast], minlength=len(texts))),
           "pairs": listed(key % size, np.bincount(key // size, minlength=len(texts))),
           "times": listed(times.astype(np.int64), np.bincount(key // size, minlength=len(texts)))}
    return out | ({"groups": pa.array([x.decode() for x in cut])} if groups else {})


def blocks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in parts of ``BLOCK`` characters, or one longer text each."""
    start = held = 0
    for i, n in enumerate(pa.compute.utf8_length(batch["text"]).to_pylist()):
        if held and held + (n or 0) > BLOCK:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n or 0
    if start < batch.num_rows:
        yield batch.slice(start)


def encoded(docs: DataFrame, files: Files, groups: bool) -> DataFrame:
    """One row per document with its groups, the A ids of its fast links and its other links as pairs with their number."""
    shared = docs.sparkSession.sparkContext.broadcast(files)

    def run(batches):
        tools = loaded(shared.value)
        for batch in batches:
            for part in blocks(batch):
                columns = {"doc_id": part["doc_id"], **aligned(tools, part["text"].to_pylist(), groups)}
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    schema = T.StructType([docs.schema["doc_id"], *T.StructType.fromDDL(
        f"n_a long, n_b long, n_groups long, groups_sha256 string, regular array<int>, {PAIRS}{', groups string' if groups else ''}")])
    return docs.select("doc_id", "text").mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id())


def fast_counts(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """How often a task's fast links hold each A id."""
    total = np.zeros(size, np.int64)
    for batch in batches:
        total += np.bincount(batch["regular"].flatten().to_numpy(zero_copy_only=False), minlength=size)
    met = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(total[met])], ["a", "n"])


def align(docs: DataFrame, files: Files, groups: bool = False) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256; with ``groups`` also the groups as text.

    A document's ``n_best`` counts its links whose pair has the highest count of all pairs with that B id, ``count_sum``
    sums the counts of its links' pairs. Groups read ``a1,a2|b1;a3|b2,b3``.
    """
    spark = docs.sparkSession
    tools = loaded(files)
    a_size, b_size, same = tools.a_size, tools.b_size, tools.same
    held = materialise(encoded(docs, files, groups))

    fast = held.select("regular").mapInArrow(lambda batches: fast_counts(batches, a_size), "a long, n long").groupBy("a").agg(F.sum("n").alias("n"))
    fast = {r["a"]: r["n"] for r in fast.collect()}  # at most one entry per id of A
    vector = np.zeros(a_size, np.int64)
    vector[list(fast)] = list(fast.values())
    pairs = materialise(held.select(F.inline(F.arrays_zip(F.col("pairs").alias("pair"), F.col("times").alias("times"))))
                        .groupBy("pair").agg(F.sum("times").alias("n")).withColumn("b", F.col("pair") % b_size))
    top = np.zeros(b_size, np.int64)
    np.maximum.at(top, same[same >= 0], vector[same >= 0])
    for r in pairs.groupBy("b").agg(F.max("n").alias("n")).collect():  # at most one entry per id of B
        top[r["b"]] = max(top[r["b"]], r["n"])
    best = (vector > 0) & (vector == top[same])
    shared = spark.sparkContext.broadcast((vector, best, top))

    def with_fast(batches):
        counts, is_best, _ = shared.value
        for batch in batches:
            ids = batch["regular"].flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(batch["regular"].value_lengths().to_numpy(zero_copy_only=False))
            summed = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[np.concatenate([[0], ends])])
            names = [c for c in batch.schema.names if c != "regular"]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in names), pa.array(summed(counts[ids])), pa.array(summed(is_best[ids].astype(np.int64)))],
                                             [*names, "fast_sum", "fast_best"])

    def with_best(batches):
        highest = shared.value[2]
        for batch in batches:
            is_best = batch["n"].to_numpy() == highest[batch["b"].to_numpy()]
            yield pa.RecordBatch.from_arrays([batch["pair"], batch["n"], pa.array(is_best)], ["pair", "n", "best"])

    scored = pairs.mapInArrow(with_best, "pair long, n long, best boolean")
    links = (held.select("row", F.inline(F.arrays_zip(F.col("pairs").alias("pair"), F.col("times").alias("times")))).join(scored, "pair")
             .groupBy("row").agg(F.sum(F.col("times") * F.col("n")).alias("pair_sum"), F.sum(F.when(F.col("best"), F.col("times"))).alias("pair_best")))
    counted = held.drop("pairs", "times")
    schema = T.StructType([f for f in counted.schema if f.name != "regular"]).add("fast_sum", "long").add("fast_best", "long")
    out = counted.mapInArrow(with_fast, schema).join(links, "row", "left")
    total = lambda x, y: (F.col(x) + F.coalesce(y, F.lit(0))).alias(y.replace("pair_sum", "count_sum").replace("pair_best", "n_best"))
    return out.select("doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), total("fast_best", "pair_best"),
                      total("fast_sum", "pair_sum"), "groups_sha256", *(["groups"] if groups else []))

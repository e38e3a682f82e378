"""Passages that repeat across documents: what the exact substring operators share.

Equal windows have the same anchor (least gram hash) at the same distance, so a window can only equal windows of
its anchor. ``marks`` holds each document's anchors; the context of an anchor (all windows of one run) is known by its
anchor and a 64-bit hash. Equal contexts are one class: all windows of a later member start earlier in the class's
head, so members go whole without a look at their text, and only heads are cut from the texts and dealt by anchor,
where an anchor has more than one class. Documents with the same sequence are one text, represented by their smallest
doc_id.

A row is known by its doc_id and a hash of its text (``tag``). Rows of one doc_id with different texts are each judged by
themselves; where order inside a doc_id matters, the one with the smaller hash comes first.

Scale: per text about two anchors a window length are shuffled, without text; texts are shuffled twice (cutting
heads, applying removals). Anchors of more than ``HOT`` classes are not gathered in one task: their windows are
counted one by one with partial sums.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from siftgate.llm.spans import anchor_runs, column, prefix, ranges, slices
from siftgate.sources.storage import materialise, release

HOT = 5_000


def sequence(piece, unit: str):
    """(prefix sums, first value of each row, values) of a slice, in words or bytes."""
    if unit == "words":
        w = piece.words()
        return prefix(w.hashes), w.at
    return prefix(piece.data.astype(np.uint64) + np.uint64(1)), piece.at


def tagged(docs: DataFrame) -> DataFrame:
    """doc_id as long, text, and the hash of the text that tells rows of one doc_id apart."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tag"), "text")


def text_marks(docs: DataFrame, unit: str, window: int, gram: int) -> DataFrame:
    """Per document: size, a hash of the whole sequence, anchors, the starts of their windows and hashes of their contexts."""
    def run(batches):
        for batch in batches:
            ids, tags = column(batch, "doc_id"), column(batch, "tag")
            for piece in slices(batch):
                sums, at = sequence(piece, unit)
                row, anchor, start, end = anchor_runs(sums, at, window, gram)
                context = ranges(sums, at[row] + start, at[row] + end + window - 1) if len(row) else anchor
                offsets = pa.array(np.searchsorted(row, np.arange(piece.rows + 1)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in
                         (anchor.view(np.int64), context.view(np.int64), start.astype(np.int32), end.astype(np.int32))]
                size = np.diff(at)
                one = ranges(sums, at[:-1], at[1:]) ^ size.astype(np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(piece.first, piece.rows), tags.slice(piece.first, piece.rows), pa.array(size), pa.array(one.view(np.int64)), *lists],
                    names=["doc_id", "tag", "size", "one", "anchors", "contexts", "starts", "ends"])

    return docs.mapInArrow(run, "doc_id long, tag long, size long, one long, anchors array<long>, contexts array<long>, starts array<int>, ends array<int>")


def shared_contexts(docs: DataFrame, unit: str, window: int, gram: int, within: bool):
    """(copies, contexts): spans of later copies of a whole text or of a whole context; contexts that have windows to compare.

    ``docs`` as from ``tagged``. ``within``: a repeat inside one document counts too. Contexts: anchor, hot, doc_id, tag, at
    (first value), body (bytes; words are joined by one blank).
    """
    marks = materialise(text_marks(docs.filter(F.col("doc_id").isNotNull()), unit, window, gram))
    texts = materialise(marks.select("doc_id", "tag", "size", "one"))
    named = texts.join(texts.groupBy("one", "size").agg(F.min("doc_id").alias("rep")), ["one", "size"])
    copies = named.filter((F.col("doc_id") != F.col("rep")) & (F.col("size") >= window)).select(
        "doc_id", "tag", F.lit(0).alias("start"), F.col("size").cast("int").alias("end"))
    alone = marks.join(named.filter(F.col("doc_id") == F.col("rep")).select("doc_id", "tag").distinct(), ["doc_id", "tag"], "left_semi")
    lists = ("anchors", "contexts", "starts", "ends")
    alone = alone.groupBy("doc_id", "tag").agg(*[F.first(x).alias(x) for x in lists])  # equal rows once; already together by the join
    every = materialise(alone.select("doc_id", "tag", F.explode(F.arrays_zip(*lists)).alias("r")).select(
        "doc_id", "tag", F.col("r.anchors").alias("anchor"), F.col("r.contexts").alias("context"), F.col("r.starts").alias("start"), F.col("r.ends").alias("end")))
    release(marks)
    again = every.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1").select("anchor")  # most anchors are of one run
    runs = materialise(every.join(again, "anchor"))
    release(every)
    classes = runs.groupBy("anchor", "context").agg(F.min(F.struct("doc_id", "tag", "start")).alias("head"), F.max("doc_id").alias("last"), F.count("*").alias("n"))
    seen = F.sum("n") > 1 if within else F.min("head.doc_id") != F.max("last")
    repeated = classes.groupBy("anchor").agg(F.count("*").alias("classes"), seen.alias("seen")).filter("seen").select("anchor", "classes")
    known = runs.join(classes.join(repeated, "anchor").select("anchor", "context", "head", "classes"), ["anchor", "context"])
    later = F.struct("doc_id", "tag", "start") > F.col("head") if within else F.col("doc_id") > F.col("head.doc_id")
    known = materialise(known.filter(later | (F.col("classes") > 1)).select("anchor", "doc_id", "tag", "start", "end", later.alias("later"), (F.col("classes") > HOT).alias("hot")))
    release(runs)
    copies = copies.unionByName(known.filter("later").select("doc_id", "tag", "start", (F.col("end") + (window - 1)).alias("end")))
    hits = known.filter("not later").groupBy("doc_id", "tag").agg(F.sort_array(F.collect_list(F.struct("start", "end", "anchor", "hot"))).alias("hits"))

    def cut(batches):
        for batch in batches:
            out = [[], [], [], [], [], []]
            for d, tag, text, hits_ in zip(*(column(batch, n) for n in ("doc_id", "tag", "text", "hits"))):
                d, tag, body = d.as_py(), tag.as_py(), (text.as_py() or "").encode()
                values = body.split() if unit == "words" else body
                for h in hits_.as_py():
                    part = values[h["start"]:h["end"] + window - 1]
                    for to, v in zip(out, (h["anchor"], h["hot"], d, tag, h["start"], b" ".join(part) if unit == "words" else part)):
                        to.append(v)
            types = pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.binary()
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, types)], names=["anchor", "hot", "doc_id", "tag", "at", "body"])

    contexts = docs.join(hits, ["doc_id", "tag"]).mapInArrow(cut, "anchor long, hot boolean, doc_id long, tag long, at int, body binary")
    return copies, materialise(contexts)


def hot_spans(contexts: DataFrame, unit: str, window: int, within: bool) -> DataFrame:
    """Spans of hot anchors: every window by its own hash, the earliest start of each with partial sums, no group gathered."""
    def windows(batches):
        for batch in batches:
            keys, docs, tags, places = [], [], [], []
            for d, tag, at, body in zip(*(column(batch, n).to_pylist() for n in ("doc_id", "tag", "at", "body"))):
                values = body.split() if unit == "words" else body
                for i in range(len(values) - window + 1):
                    part = values[i:i + window]
                    keys.append(hashlib.md5(b" ".join(part) if unit == "words" else part).digest())
                    docs.append(d)
                    tags.append(tag)
                    places.append(at + i)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(docs, pa.int64()), pa.array(tags, pa.int64()), pa.array(places, pa.int32())],
                                             names=["key", "doc_id", "tag", "start"])

    every = contexts.filter("hot").select("doc_id", "tag", "at", "body").mapInArrow(windows, "key binary, doc_id long, tag long, start int")
    place = F.struct("doc_id", "tag", "start")
    first = every.groupBy("key").agg(F.min(place).alias("first"))
    later = place > F.col("first") if within else F.col("doc_id") > F.col("first.doc_id")
    return every.join(first, "key").filter(later).select("doc_id", "tag", "start", (F.col("start") + window).alias("end"))


def by_anchor(contexts: DataFrame) -> DataFrame:
    """Contexts of anchors that are not hot, the groups of one anchor next to each other, in document order."""
    keys = ["anchor", "doc_id", "tag", "at"]
    return contexts.filter("not hot").select(*keys, "body").repartition("anchor").sortWithinPartitions(*keys)


def groups(batches):
    """Contexts ((doc_id, tag), first value, body) of consecutive equal anchors from sorted batches, each once."""
    key, rows = None, []
    for batch in batches:
        for anchor, d, tag, at, body in zip(*(column(batch, n).to_pylist() for n in ("anchor", "doc_id", "tag", "at", "body"))):
            if anchor != key:
                if rows:
                    yield rows
                key, rows = anchor, []
            if not rows or rows[-1][:2] != ((d, tag), at):  # rows of a repeated doc_id and text
                rows.append(((d, tag), at, body))
    if rows:
        yield rows


SPANS = "doc_id long, tag long, start int, end int"


def span_batch(spans: list) -> pa.RecordBatch:
    """Rows of SPANS from ((doc_id, tag), start, end)."""
    rows, s, e = zip(*spans) if spans else ((), (), ())
    d, tag = zip(*rows) if rows else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(d, pa.int64()), pa.array(tag, pa.int64()), pa.array(s, pa.int32()), pa.array(e, pa.int32())],
                                      names=["doc_id", "tag", "start", "end"])


def with_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """Adds ``spans`` to rows as from ``tagged``: the spans of each document (null where it has none)."""
    return docs.join(spans.groupBy("doc_id", "tag").agg(F.collect_list(F.struct("start", "end")).alias("spans")), ["doc_id", "tag"], "left")


def mask(size: int, spans) -> np.ndarray:
    """True where a value is in a span."""
    edge = np.zeros(size + 1, np.int64)
    for s in spans or ():
        edge[s["start"]] += 1
        edge[s["end"]] -= 1
    return np.cumsum(edge)[:size] > 0

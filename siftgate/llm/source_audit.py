"""Source divergence audit: how far each source's term shares lie from those of its peers and of its language.

A share is p = 1 + floor(10**9 * (count + 1) / (N + V)), a difference floor((p - q)**2 / q). A pair of sources sums
it over all V terms that its language keeps, also those that one or both lack.

Method: row accumulation over a sparse matrix (Gustavson). Rows are groups, columns are terms. A task holds whole terms of
the term-major index (a term's list has one entry per source at most); for each group it walks the lists of the group's
terms and adds to a dense accumulator with one place per peer, so no pair of postings is ever a row: a task emits one sum
per pair of groups and block. What it adds is corrected for the sums that every group starts with as if it shared no term:

    sum over terms of s of f(p, t0) + sum over terms of t of f(s0, q) + (V - |s| - |t|) * f(s0, t0)

with s0, t0 the shares of absent terms. Terms with equal counts have equal shares, so these start sums need the
histogram of a group's counts only; histograms and peers meet in blocks. All sums are whole numbers of 64 bits.

Defined results: null text, lang and source count as empty strings; every row is a document of its own, so repeated rows
count again; a group without terms has peers, and its language's terms at count 0; a language that keeps no term has pairs of
value 0; ties go to the item that sorts first by UTF-8 bytes; an empty table gives an empty result. Whole texts are read,
long ones in slices. Columns other than lang, source and text are not read, so extra columns never clash.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from siftgate.sources.storage import materialise

TERM = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
BREAK = re.compile(rb"[\x00-\x40\x5B-\x60\x7B-\x7F]")
SCALE = 1_000_000_000
SLICE = 1 << 20  # bytes of a text that are cut into terms at a time
HELD = 200_000  # distinct (group, term) that a task holds before it hands its counts on
POSTINGS = 500_000  # of the index that a task works on at a time
REACH = 1_000_000  # places of lists walked at a time
PACK = 4096  # counts or peers of a block of the start sums
TALLY = "lang string, source string, term string, n long, docs long"
PARTS = "a long, b long, value long"


def slices(text: bytes) -> Iterator[bytes]:
    """The text in parts that end between terms."""
    at = 0
    while at < len(text):
        end = at + SLICE
        if end < len(text):
            found = BREAK.search(text, end)
            end = found.start() if found else len(text)
        yield text[at:end]
        at = end


def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each (lang, source, term) of a task."""
    groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    held = 0

    def handed() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in groups.items():
            k = len(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * k, pa.string()), pa.array([source] * k, pa.string()), pa.array(n.keys(), pa.binary()).cast(pa.string()),
                 pa.array(n.values(), pa.int64()), pa.array([docs[t] for t in n], pa.int64())], ["lang", "source", "term", "n", "docs"])
        groups.clear()

    for batch in batches:
        for lang, source, text in zip(batch["lang"].to_pylist(), batch["source"].to_pylist(), batch["text"]):
            n, docs = groups.setdefault((lang, source), (Counter(), Counter()))
            before, seen = len(n), set()
            for part in slices(text.as_py().lower()):  # of bytes: A-Z only
                found = TERM.findall(part)
                n.update(found)
                seen.update(found)
            docs.update(seen)
            held += len(n) - before
            if held > HELD:
                yield from handed()
                held = 0
    yield from handed()


def f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def sums(a: np.ndarray, b: np.ndarray, value: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (a, b, value)], ["a", "b", "value"])


def accumulate(no: np.ndarray, p: np.ndarray, zero: np.ndarray, first: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Sums of one block of the index, a row of the matrix at a time."""
    starts = np.flatnonzero(first)
    lengths = np.diff(np.append(starts, len(no)))
    term = np.cumsum(first) - 1
    peers, local = np.unique(no, return_inverse=True)
    order = np.argsort(local, kind="stable")
    for s, rows in enumerate(np.split(order, np.cumsum(np.bincount(local))[:-1])):
        sum_, met = np.zeros(len(peers), np.int64), np.zeros(len(peers), bool)
        for part in np.split(rows, np.flatnonzero(np.diff(np.cumsum(lengths[term[rows]]) // REACH)) + 1):
            lists = lengths[term[part]]
            ends = np.cumsum(lists)
            at = np.arange(ends[-1]) + np.repeat(starts[term[part]] - ends + lists, lists)
            mine, own, q, absent = np.repeat(p[part], lists), zero[part[0]], p[at], zero[at]
            np.add.at(sum_, local[at], f(mine, q) - f(mine, absent) - f(own, q) + f(own, absent))
            met[local[at]] = True
        met[s] = False
        with_ = np.flatnonzero(met)
        if len(with_):
            yield sums(np.full(len(with_), peers[s]), peers[with_], sum_[with_])


def shared_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``accumulate`` over a task's part of the index, in blocks of whole terms. ``first`` marks where a term begins."""
    held: list[tuple[np.ndarray, ...]] = []
    rows = 0
    for batch in batches:
        columns = tuple(batch[c].to_numpy(zero_copy_only=False) for c in ("no", "p", "zero", "first"))
        begin = np.flatnonzero(columns[3])
        if rows >= POSTINGS and len(begin):
            yield from accumulate(*(np.concatenate(x) for x in zip(*held, tuple(c[:begin[0]] for c in columns))))
            held, rows, columns = [], 0, tuple(c[begin[0]:] for c in columns)
        held.append(columns)
        rows += len(columns[0])
    if rows:
        yield from accumulate(*(np.concatenate(x) for x in zip(*held)))


def start_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A block of one group's counts against a block of its peers, both ways; the first block adds the terms that both lack."""
    for batch in batches:
        for row in batch.to_pylist():
            t, t0, held = (np.array([x[k] for x in row["peers"]], np.int64) for k in ("no", "zero", "held"))
            p, n = (np.array([x[k] for x in row["counts"] or []], np.int64) for k in ("p", "n"))
            s0 = np.int64(row["zero"])
            there, back = np.zeros(len(t), np.int64), np.zeros(len(t), np.int64)
            for at in range(0, len(t), 256):
                q = t0[at:at + 256, None]
                there[at:at + 256] = (n * f(p, q)).sum(axis=1)
                back[at:at + 256] = (n * f(q, p)).sum(axis=1)
            if row["lead"]:
                there += (row["v"] - row["held"] - held) * f(s0, t0)
            other = t != row["no"]
            s = np.full(other.sum(), row["no"])
            yield sums(np.concatenate([s, t[other]]), np.concatenate([t[other], s]), np.concatenate([there[other], back[other]]))


def share(n: Column, all_: Column) -> Column:
    """1 + floor(10**9 * (n + 1) / all), exactly; 1 where there is nothing."""
    return F.when(all_ == 0, F.lit(1)).otherwise(
        1 + F.call_function("div", F.lit(SCALE).cast("decimal(10,0)") * (n + 1).cast("decimal(20,0)"), all_.cast("decimal(20,0)"))).cast("long")


def ranked(df: DataFrame, top: int | None = None) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    out = df.withColumn("rank", place)
    return out.filter(F.col("rank") <= top) if top else out


def divergence(docs: DataFrame, min_docs: int = 3, top: int = 200) -> DataFrame:
    """lang, source, part, item, value, rank: ``pair`` rows for all other sources of a language, ``term`` rows for the ``top``
    terms that a source has more of than its language. Terms occur in ``min_docs`` documents of the language or more."""
    texts = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")])
    of_term = Window.partitionBy("lang", "term")
    counts = (texts.withColumn("text", F.col("text").cast("binary")).mapInArrow(tally, TALLY)
              .repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
              .withColumns({"in_docs": F.sum("docs").over(of_term), "in_lang": F.sum("n").over(of_term),
                            "first": F.row_number().over(of_term.orderBy("source")) == 1})
              .filter(F.col("in_docs") >= min_docs).drop("docs", "in_docs"))
    counts = materialise(counts)

    held = counts.groupBy("lang", "source").agg(F.sum("n").alias("n"), F.count("*").alias("held"), F.count_if("first").alias("new"))
    groups = (texts.select("lang", "source").distinct().join(held, ["lang", "source"], "left").na.fill(0, ["n", "held", "new"])
              .withColumns({"v": F.sum("new").over(Window.partitionBy("lang")), "lang_n": F.sum("n").over(Window.partitionBy("lang")),
                            "no": F.row_number().over(Window.orderBy("lang", "source")).cast("long")})
              .withColumn("zero", share(F.lit(0), F.col("n") + F.col("v"))).drop("new"))
    groups = materialise(groups)  # one row per group; the result has one per pair of them
    terms = (counts.join(groups.withColumnRenamed("n", "all"), ["lang", "source"])
             .withColumn("p", share(F.col("n"), F.col("all") + F.col("v"))))

    index = terms.repartition("lang", "term").sortWithinPartitions("lang", "term", "source").select("no", "p", "zero", "first")
    in_pack = lambda by, order: F.floor((F.row_number().over(Window.partitionBy(by).orderBy(order)) - 1) / PACK)
    packed = (terms.groupBy("no", "p").agg(F.count("*").alias("n")).withColumn("pack", in_pack("no", "p"))
              .groupBy("no", "pack").agg(F.collect_list(F.struct("p", "n")).alias("counts")))
    peers = (groups.withColumn("pack", in_pack("lang", "no")).groupBy("lang", "pack")
             .agg(F.collect_list(F.struct("no", "zero", "held")).alias("peers")).drop("pack"))
    starts = (groups.join(packed, "no", "left").join(peers, "lang")
              .select("no", "zero", "held", "v", "counts", "peers", (F.coalesce("pack", F.lit(0)) == 0).alias("lead")))
    values = (index.mapInArrow(shared_terms, PARTS).unionByName(starts.mapInArrow(start_sums, PARTS))
              .groupBy("a", "b").agg(F.sum("value").alias("value")))
    pair = (values.join(groups.select(F.col("no").alias("a"), "lang", "source"), "a")
            .join(groups.select(F.col("no").alias("b"), F.col("source").alias("item")), "b").select("lang", "source", "item", "value"))

    more = terms.withColumn("q", share(F.col("in_lang"), F.col("lang_n") + F.col("v"))).filter("p > q")
    term = more.select("lang", "source", F.col("term").alias("item"), F.expr("(p - q) * (p - q) div q").alias("value"))
    out = ranked(pair).withColumn("part", F.lit("pair")).unionByName(ranked(term, top).withColumn("part", F.lit("term")))
    return out.select("lang", "source", "part", "item", "value", "rank")

"""Exact Jaccard join of shingle sets, by relations between sets.

Two texts link when their sets of ``size``-word shingles have a Jaccard similarity of ``percent`` or more. Equal sets
are one class. Each class posts the first shingles of its set (rarest first) that any partner must share; the lists are
sorted by set size and read in blocks: a block whose sizes leave too small an overlap is skipped whole, positions are
tested pair by pair.

Components are derived from those of a similar set (partners and their number are not returned): in a first round each class of a list is only compared with the
list's leading class (the one that is in most lists). Classes that link to it share its component, so what remains are pairs of different
components, which a second round compares one by one. No link between components is lost, and a group of n near copies
costs about n comparisons, not n * n.

Before a pair's texts are read, ``64 * WORDS`` bits of each set bound how many shingles differ: a long list of sets that are
alike, but less than ``percent``, gives few candidates.

Scale: sets are never shuffled, only their prefixes (``100 - percent`` percent of the shingles); texts move only for
candidate pairs. Frequent shingles come last in the order: hash classes of shingles are counted over all documents in
a table of fixed size, which affects speed alone (any order is exact). Hashes have 64 bits.

Defined cases: null or blank text has an empty set and links with nothing; fewer words than ``size`` are one
shingle; rows that repeat a doc_id are one document; rows without doc_id link with nothing; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from siftgate.llm.components import stars
from siftgate.llm.spans import LOWER, Slice, column, mix, prefix, ranges, slices
from siftgate.sources.storage import materialise

COUNTERS = 16
SHIFT = np.uint64(64 - COUNTERS)
BLOCK = 256
WORDS = 16  #: of 64 bits each, in the bits of a set


def shingles(piece: Slice, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct shingles of each row, in order of row and hash."""
    w = piece.words(LOWER)
    n, sums = len(w.start), prefix(w.hashes)
    row = w.rows()
    start = np.flatnonzero(row[:n - size + 1] == row[size - 1:]) if n >= size else np.zeros(0, np.int64)
    count = np.diff(w.at)
    short = np.flatnonzero((count > 0) & (count < size))
    rows = np.concatenate([row[start], short])
    hashes = np.concatenate([ranges(sums, start, start + size), ranges(sums, w.at[short], w.at[short + 1])])
    order = np.lexsort((hashes, rows))
    rows, hashes = rows[order], hashes[order]
    new = np.r_[True, (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])] if len(rows) else np.zeros(0, bool)
    return rows[new], hashes[new]


def frequent(docs: DataFrame, size: int) -> np.ndarray:
    """How many documents have a shingle of each of ``2 ** COUNTERS`` hash classes, over all documents."""
    def run(batches):
        total = np.zeros(1 << COUNTERS, np.int64)
        for batch in batches:
            for piece in slices(batch):
                total += np.bincount((shingles(piece, size)[1] >> SHIFT).astype(np.int64), minlength=1 << COUNTERS)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["place", "n"])

    sums = docs.select("text").mapInArrow(run, "place long, n long").groupBy("place").agg(F.sum("n").alias("n"))
    out = np.zeros(1 << COUNTERS, np.int64)
    rows = sums.toPandas()  # at most 2 ** COUNTERS rows
    out[rows["place"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    return out


def set_prefixes(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Per document: n (set size), two hashes of the set, its bits (see ``apart``), and the shingles of its prefix in order."""
    keys = docs.sparkSession.sparkContext.broadcast(frequent(docs, size))  # 2 ** COUNTERS counts

    def run(batches):
        counts = keys.value
        for batch in batches:
            ids = column(batch, "doc_id")
            for piece in slices(batch):
                rows, hashes = shingles(piece, size)
                n = np.bincount(rows, minlength=piece.rows)
                one, two = np.zeros(piece.rows, np.uint64), np.zeros(piece.rows, np.uint64)
                with np.errstate(over="ignore"):
                    np.add.at(one, rows, mix(hashes))
                np.bitwise_xor.at(two, rows, mix(hashes ^ np.uint64(0xABCDEF)))
                bits = np.zeros(piece.rows * WORDS, np.uint64)
                np.bitwise_xor.at(bits, rows * WORDS + (hashes & np.uint64(WORDS - 1)).astype(np.int64), np.uint64(1) << (hashes >> np.uint64(8) & np.uint64(63)))
                often = counts[(hashes >> SHIFT).astype(np.int64)]
                order = np.lexsort((hashes, often, rows))
                rows, hashes = rows[order], hashes[order]
                place = np.arange(len(rows)) - np.repeat(np.cumsum(n) - n, n)
                length = n - (-(-percent * n // 100)) + 1
                keep = place < length[rows] if len(rows) else np.zeros(0, bool)
                offsets = pa.array(np.searchsorted(rows[keep], np.arange(piece.rows + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(piece.first, piece.rows), pa.array(n.astype(np.int64)), pa.array(one.view(np.int64)), pa.array(two.view(np.int64)),
                     pa.ListArray.from_arrays(pa.array(np.arange(piece.rows + 1, dtype=np.int32) * WORDS), pa.array(bits.view(np.int64))),
                     pa.ListArray.from_arrays(offsets, pa.array(hashes[keep].view(np.int64)))], names=["doc_id", "n", "one", "two", "bits", "prefix"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n long, one long, two long, bits array<long>, prefix array<long>")


def apart(na, nb, differing, percent: int):
    """Whether sets of these sizes are too different, by how many of their bits differ. Each shingle flips one of a set's bits, so
    the sets differ in at least as many shingles: no similar pair is apart."""
    return differing * (100 + percent) > (na + nb) * (100 - percent)


def not_apart(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that the bits of their sets leave."""
    sides = [sets.select(F.col("rep").alias(x), F.col("n").alias(f"n_{x}"), F.col("bits").alias(f"bits_{x}")) for x in "ab"]
    differing = F.expr("aggregate(zip_with(bits_a, bits_b, (x, y) -> bit_count(x ^ y)), 0, (x, y) -> x + y)")
    return pairs.join(sides[0], "a").join(sides[1], "b").filter(~apart(F.col("n_a"), F.col("n_b"), differing, percent)).select("a", "b")


def enough(na: np.ndarray, nb: np.ndarray, pa_: np.ndarray, pb: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of these sizes, sharing the shingle at these places, may still be similar enough."""
    least = -(-percent * (na + nb) // (100 + percent))
    return (100 * np.minimum(na, nb) >= percent * np.maximum(na, nb)) & (1 + np.minimum(pa_, pb) + np.minimum(na - pa_, nb - pb) - 1 >= least)


def list_pairs(postings: DataFrame, percent: int, leading: bool) -> DataFrame:
    """Candidate pairs (a, b) of the lists. leading: each class with the leading class of its list and size range only;
    else all pairs of different components whose bits are not apart. Postings: shingle, rep, n, place and weight or comp and bits."""
    def run(batches):
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
            key = table.column("shingle").to_numpy()
            cut = int(np.searchsorted(key, key[-1])) if len(key) else 0
            rest = table.slice(cut)
            if cut:
                yield emit(table.slice(0, cut))
        if rest is not None and len(rest):
            yield emit(rest)

    def emit(table):
        key, rep, n, place = (table.column(c).to_numpy() for c in ("shingle", "rep", "n", "place"))
        comp = table.column("comp").to_numpy() if not leading else rep
        bits = table.column("bits").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(-1, WORDS) if not leading else rep
        weight = table.column("weight").to_numpy() if leading else rep
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        last = np.r_[first[1:], len(key)]
        many = last - first > 1
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i, j in zip(first[many].tolist(), last[many].tolist()):
            if leading:  # the heaviest class leads those of similar size, then the heaviest of the others
                left = np.lexsort((rep[i:j], -weight[i:j])) + i
                while len(left) > 1:
                    near = percent * np.maximum(n[left], n[left[0]]) <= 100 * np.minimum(n[left], n[left[0]])
                    a.append(np.full(near.sum() - 1, rep[left[0]]))
                    b.append(rep[left[near][1:]])
                    left = left[~near]
                continue
            if (comp[i:j] == comp[i]).all():
                continue
            for x in range(i, j, BLOCK):
                y = min(x + BLOCK, j)
                for u in range(x, j, BLOCK):
                    v = min(u + BLOCK, j)
                    if percent * n[u] > 100 * n[y - 1]:
                        break  # this block and all later ones are too large
                    ok = enough(n[x:y, None], n[None, u:v], place[x:y, None], place[None, u:v], percent) & (comp[x:y, None] != comp[None, u:v])
                    p, q = np.nonzero(ok)
                    p, q = p + x, q + u
                    p, q = p[q > p], q[q > p]
                    for k in range(0, len(p), BLOCK * BLOCK // WORDS):
                        i_, j_ = p[k:k + BLOCK * BLOCK // WORDS], q[k:k + BLOCK * BLOCK // WORDS]
                        left = ~apart(n[i_], n[j_], np.bitwise_count(bits[i_] ^ bits[j_]).sum(1, dtype=np.int64), percent)
                        a.append(rep[i_[left]])
                        b.append(rep[j_[left]])
        a, b = np.concatenate(a), np.concatenate(b)
        lo, hi = np.minimum(a, b), np.maximum(a, b)
        pairs = np.unique(np.stack([lo, hi]), axis=1) if len(lo) else np.zeros((2, 0), np.int64)
        return pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])

    cols = ["shingle", "rep", "n", "place", *(["weight"] if leading else ["comp", "bits"])]
    return (postings.select(cols).repartition("shingle").sortWithinPartitions("shingle", "n", "rep")
            .mapInArrow(run, "a long, b long").distinct())


def linked(pairs: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs whose texts are similar enough, by their whole sets."""
    def run(batches):
        for batch in batches:
            keep = []
            parts = [{}, {}]
            for side, name in zip(parts, ("text_a", "text_b")):
                for piece in slices(batch, name):
                    rows, hashes = shingles(piece, size)
                    at = np.searchsorted(rows, np.arange(piece.rows + 1))
                    for i in range(piece.rows):
                        side[piece.first + i] = hashes[at[i]:at[i + 1]]
            for i in range(len(batch)):
                x, y = parts[0][i], parts[1][i]
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both > 0 and 100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    texts = docs.select("doc_id", "text")
    left = pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
    both = left.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def similar_sets(docs: DataFrame, size: int = 4, percent: int = 85) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (the smallest doc_id that links reach)."""
    sets = materialise(set_prefixes(docs, size, percent))
    keyed = sets.filter("doc_id is not null and n > 0")
    classes = keyed.groupBy("one", "two", "n").agg(F.min("doc_id").alias("rep"))
    member = keyed.select("doc_id", "one", "two", "n").join(classes, ["one", "two", "n"]).select("doc_id", "rep")
    reps = keyed.join(member.filter("doc_id = rep").select("doc_id").distinct(), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    posted = reps.select(F.col("doc_id").alias("rep"), "n", F.posexplode("prefix").alias("place", "shingle"))
    shared = posted.groupBy("shingle").count().filter("count > 1").select("shingle")
    postings = materialise(posted.join(shared, "shingle").select("shingle", "rep", "n", F.col("place").cast("long").alias("place")))
    weights = postings.groupBy("rep").agg(F.count("*").alias("weight"))  # in how many lists a class is: an original is in most
    tested = materialise(list_pairs(postings.join(weights, "rep"), percent, leading=True))
    bits = reps.select(F.col("doc_id").alias("rep"), "n", "bits")
    links = materialise(linked(not_apart(tested, bits, percent), docs, size, percent))
    comp = stars(links)
    named = postings.join(comp.select(F.col("node").alias("rep"), "root"), "rep", "left").select(
        "shingle", "rep", "n", "place", F.coalesce("root", "rep").alias("comp"))
    mixed = named.groupBy("shingle").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).filter("x <> y").select("shingle")
    more = list_pairs(named.join(mixed, "shingle").join(bits.select("rep", "bits"), "rep"), percent, leading=False).join(tested, ["a", "b"], "left_anti")
    found = linked(more, docs, size, percent)
    # the texts of a repeated doc_id are one document: their classes are linked by it
    least = member.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("_last")).filter("a <> _last").drop("_last")
    own = member.join(least, "doc_id").filter("rep <> a").select("a", F.col("rep").alias("b")).distinct()
    groups = stars(links.unionByName(found).unionByName(own))
    named_members = member.join(groups.withColumnRenamed("node", "rep"), "rep", "left").groupBy("doc_id").agg(
        F.min(F.coalesce("root", "rep")).alias("component_id"))
    return sets.select("doc_id", F.col("n").alias("n_shingles")).join(named_members, "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))

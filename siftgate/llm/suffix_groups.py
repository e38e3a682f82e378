"""Suffix-array dedup over bytes, suffix arrays by linear grouping.

A byte is removed if a ``window``-byte string that covers it also starts earlier (smaller doc_id, or the same document
further left). The contexts of one anchor (see ``repeats``) hold all windows that can be equal; they are cut to the windows
whose hash comes again in the shard. The distinct parts of a shard are joined by separators and their suffix array is built
without renaming: suffixes are grouped by their Lyndon prefixes, groups being refined in descending order through pointers
to the previous smaller group, and then each group's order is emitted along the same pointers. Neighbours with an equal
window form a class, whose earliest start stays.

Scale: shards hold at most ``HOT`` contexts, all different; hot anchors are counted window by window (``repeats.hot_spans``).
Defined cases: null text is empty; rows without doc_id are kept whole and refer to nothing; overlaps count; rows that
repeat a doc_id with its text get the same result; of rows that repeat it with another text the one with the smaller hash
of its text is the earlier document; doc_id may be any integer type; extra columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from siftgate.llm import repeats
from siftgate.llm.spans import SLICE, column, mix, prefix, ranges

GRAM = 24


def lyndon_groups(text: list) -> tuple[list[int], list[int]]:
    """First place in suffix order of the group of each suffix, and its previous smaller suffix (-1: none).

    ``text`` ends with its one least value. Suffixes of a group share their Lyndon prefix.
    """
    n = len(text)
    order = sorted(range(n), key=text.__getitem__)
    place, group, size = [0] * n, [0] * n, [0] * n
    first = 0
    for i, s in enumerate(order):
        if text[s] != text[order[first]]:
            first = i
        place[s], group[s] = i, first
        size[first] += 1
    smaller = [-1] * n
    end = n
    while end:
        start = group[order[end - 1]]
        counts: dict[int, int] = defaultdict(int)
        for s in sorted(order[start:end]):
            p = s - 1
            while p >= 0 and group[p] >= start:
                p = smaller[p]
            smaller[s] = p
            if p >= 0:
                counts[p] += 1
        levels = defaultdict(list)
        for p, k in counts.items():
            levels[k].append(p)
        for k in sorted(levels, reverse=True):  # more repeats of the group's prefix sort after fewer
            moved = defaultdict(list)
            for p in levels[k]:
                moved[group[p]].append(p)
            for g, members in moved.items():
                for p in members:
                    last = g + size[g] - 1
                    other = order[last]
                    order[place[p]], place[other] = other, place[p]
                    order[last], place[p] = p, last
                    size[g] -= 1
                new = g + size[g]
                size[new] = len(members)
                for p in members:
                    group[p] = new
        end = start
    return group, smaller


def suffix_array(text: list) -> list[int]:
    """Suffixes in order; ``text`` ends with its one least value."""
    group, smaller = lyndon_groups(text)
    n = len(text)
    out, free, set_ = [0] * n, list(range(n)), bytearray(n)
    out[0] = n - 1
    set_[n - 1] = 1
    for i in range(n):
        s = out[i] - 1
        while s >= 0 and not set_[s]:
            at = free[group[s]]
            free[group[s]] = at + 1
            out[at] = s
            set_[s] = 1
            s = smaller[s]
    return out


def shard_spans(rows: list, window: int) -> list:
    """Spans of one shard; rows ((doc_id, tag), first byte, bytes) in order."""
    first, out = {}, []
    for doc, at, body in rows:
        if body in first:  # every window of it starts earlier
            out.append((doc, at, at + len(body)))
        else:
            first[body] = (doc, at)
    if len(first) == 1:
        return out
    bodies = list(first)
    text, owner, where = [], [], []
    for k, body in enumerate(bodies):
        text += [b + len(bodies) + 1 for b in body]
        text.append(k + 1)  # a separator of its own
        owner += [k] * (len(body) + 1)
        where += range(len(body) + 1)
    text.append(0)
    later = defaultdict(list)

    def close(members):
        if len(members) > 1:
            starts = [(*first[bodies[owner[s]]], where[s]) for s in members]
            least = min((d, at + o) for d, at, o in starts)
            for s, (d, at, o) in zip(members, starts):
                if (d, at + o) != least:
                    later[owner[s]].append(o)

    members, shown = [], None
    for s in suffix_array(text)[1:]:
        o = where[s]
        body = bodies[owner[s]]
        if o + window > len(body):
            continue
        part = body[o:o + window]
        if part != shown:
            close(members)
            members, shown = [], part
        members.append(s)
    close(members)
    for k, offsets in later.items():
        doc, at = first[bodies[k]]
        run = None
        for o in sorted(offsets):
            if run and o <= run[1]:
                run[1] = o + window
            else:
                if run:
                    out.append((doc, at + run[0], at + run[1]))
                run = [o, o + window]
        out.append((doc, at + run[0], at + run[1]))
    return out


def recurring(groups, window: int):
    """Groups with the parts of their contexts that hold windows whose hash comes again in the group; others repeat nothing.

    Hashes are taken over many groups at once; parts of a context keep its order. Groups without such parts are left out.
    """
    def parts(held):
        rows, group = [r for g in held for r in g], np.repeat(np.arange(len(held), dtype=np.uint64), [len(g) for g in held])
        at = np.r_[0, np.cumsum([len(body) for _, _, body in rows])]
        sums = prefix(np.frombuffer(b"".join(body for _, _, body in rows), np.uint8).astype(np.uint64) + np.uint64(1))
        n = np.maximum(np.diff(at) - window + 1, 0)
        row = np.repeat(np.arange(len(rows)), n)
        start = np.arange(n.sum()) + np.repeat(at[:-1] - (np.cumsum(n) - n), n)
        key = mix(ranges(sums, start, start + window) + mix(group + np.uint64(1))[row])
        order = np.argsort(key)
        same = np.diff(key[order]) == 0
        again = np.zeros(len(key), bool)
        again[order[1:][same]] = again[order[:-1][same]] = True
        place = np.flatnonzero(again)
        opens = np.flatnonzero(np.diff(place, prepend=-2) + np.diff(row[place], prepend=-1) != 1)
        out = [[] for _ in held]
        for first, last in zip(place[opens].tolist(), place[np.r_[opens[1:], len(place)] - 1].tolist() if len(place) else ()):
            r = int(row[first])
            doc, begin, body = rows[r]
            i, j = int(start[first] - at[r]), int(start[last] - at[r]) + window
            out[int(group[r])].append((doc, begin + i, body[i:j]))
        return [g for g in out if g]

    held, size = [], 0
    for g in groups:
        held.append(g)
        size += sum(len(body) for _, _, body in g)
        if size > SLICE:
            yield from parts(held)
            held, size = [], 0
    if held:
        yield from parts(held)


def removal_spans(docs: DataFrame, window: int = 100) -> DataFrame:
    """(doc_id, tag, start, end) of rows as from ``repeats.tagged``: bytes to remove; spans may overlap."""
    copies, contexts = repeats.shared_contexts(docs, "bytes", window, min(GRAM, window), within=True)

    def run(batches):
        out = []
        for rows in recurring(repeats.groups(batches), window):
            out += shard_spans(rows, window)
            if len(out) > 50_000:
                yield repeats.span_batch(out)
                out = []
        yield repeats.span_batch(out)

    spans = repeats.by_anchor(contexts).mapInArrow(run, repeats.SPANS)
    return copies.unionByName(spans).unionByName(repeats.hot_spans(contexts, "bytes", window, within=True))


def remove_repeats(docs: DataFrame, window: int = 100) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept (remaining bytes)."""
    def run(batches):
        for batch in batches:
            sizes, gone, runs, kept = [], [], [], []
            for text, spans in zip(column(batch, "text").to_pylist(), column(batch, "spans").to_pylist()):
                body, parts, last, n, cut = (text or "").encode(), [], 0, 0, 0
                for start, end in sorted((s["start"], s["end"]) for s in spans or ()):
                    if end <= last:
                        continue
                    if start > last or not n:
                        parts.append(body[last:start])
                        n += 1
                    cut += end - max(start, last)
                    last = end
                parts.append(body[last:])
                sizes.append(len(body))
                gone.append(cut)
                runs.append(n)
                kept.append(b"".join(parts))
            yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), *(pa.array(x, pa.int64()) for x in (sizes, gone, runs)), pa.array(kept, pa.binary())],
                                             names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    rows = repeats.tagged(docs)
    return repeats.with_spans(rows, removal_spans(rows, window)).mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")

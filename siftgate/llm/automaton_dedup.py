"""Substring dedup with suffix automata of reference shards.

A passage of ``window`` words that also starts in a document with a smaller doc_id is removed. Reference shards are
the contexts of one anchor (see ``repeats``): all windows that can be equal to each other, at most ``HOT`` of them
that differ.
Per shard documents stream in order of doc_id through the suffix automaton of the contexts before them; the matching
statistics give the maximal spans of ``window`` words or more. A context that is matched whole adds nothing to the
automaton. The automata are built where the contexts meet instead of being sent to every task: all shards together
are as large as the repeated part of the corpus, so a broadcast of them would have no bound.

Defined cases: null and empty texts have no words; rows without doc_id are kept whole and refer to nothing; windows of
one document alone are kept; rows that repeat a doc_id with its text get the same result, rows that repeat it with another text are judged each by
itself, and neither removes from the other; doc_id may be any integer type; extra columns are ignored.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame

from siftgate.llm import repeats
from siftgate.llm.spans import column

GRAM = 12


class Automaton:
    """Suffix automaton of several word sequences."""

    def __init__(self):
        self.next, self.link, self.length = [{}], [-1], [0]

    def state(self, length: int, edges: dict, link: int) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        return len(self.length) - 1

    def split(self, before: int, word, at: int) -> int:
        """The state for the shorter half of ``at``, reached from ``before``."""
        clone = self.state(self.length[before] + 1, dict(self.next[at]), self.link[at])
        self.link[at] = clone
        while before >= 0 and self.next[before].get(word) == at:
            self.next[before][word] = clone
            before = self.link[before]
        return clone

    def add(self, words: list) -> None:
        last = 0
        for word in words:
            at = self.next[last].get(word)
            if at is not None:
                last = at if self.length[at] == self.length[last] + 1 else self.split(last, word, at)
                continue
            new = self.state(self.length[last] + 1, {}, 0)
            p = last
            while p >= 0 and word not in self.next[p]:
                self.next[p][word] = new
                p = self.link[p]
            if p >= 0:
                q = self.next[p][word]
                self.link[new] = q if self.length[q] == self.length[p] + 1 else self.split(p, word, q)
            last = new

    def matches(self, words: list, least: int) -> tuple[list[tuple[int, int]], bool]:
        """Maximal spans of at least ``least`` words that end a match, and whether all words are one match."""
        spans, state, size = [], 0, 0
        for i, word in enumerate(words):
            while state and word not in self.next[state]:
                state = self.link[state]
                size = self.length[state]
            if word in self.next[state]:
                state = self.next[state][word]
                size += 1
            if size >= least:
                start = i + 1 - size
                if spans and start <= spans[-1][1]:
                    spans[-1] = (min(start, spans[-1][0]), i + 1)
                else:
                    spans.append((start, i + 1))
        return spans, size == len(words)


def shard_spans(rows: list, window: int) -> list:
    """Spans of one shard; rows ((doc_id, tag), first word, text) in order."""
    automaton, out, waiting, current = Automaton(), [], [], rows[0][0][0]
    for doc, at, body in rows:
        if doc[0] != current:
            for words in waiting:
                automaton.add(words)
            waiting, current = [], doc[0]
        words = body.split()
        spans, known = automaton.matches(words, window)
        out += [(doc, at + s, at + e) for s, e in spans]
        if not known:
            waiting.append(words)
    return out


def removal_spans(docs: DataFrame, window: int = 50) -> DataFrame:
    """(doc_id, tag, start, end) of rows as from ``repeats.tagged``: words to remove; spans may overlap."""
    copies, contexts = repeats.shared_contexts(docs, "words", window, min(GRAM, window), within=False)

    def run(batches):
        out = []
        for rows in repeats.groups(batches):
            out += shard_spans(rows, window)
            if len(out) > 50_000:
                yield repeats.span_batch(out)
                out = []
        yield repeats.span_batch(out)

    spans = repeats.by_anchor(contexts).mapInArrow(run, repeats.SPANS)
    return copies.unionByName(spans).unionByName(repeats.hot_spans(contexts, "words", window, within=False))


def remove_passages(docs: DataFrame, window: int = 50) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_text (kept words joined by one blank)."""
    def run(batches):
        for batch in batches:
            sizes, gone, texts = [], [], []
            for text, spans in zip(column(batch, "text").to_pylist(), column(batch, "spans").to_pylist()):
                words = (text or "").encode().split()
                drop = repeats.mask(len(words), spans)
                sizes.append(len(words))
                gone.append(int(drop.sum()))
                texts.append(b" ".join(words if not spans else [w for w, d in zip(words, drop.tolist()) if not d]).decode())
            yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(texts, pa.string())],
                                             names=["doc_id", "n_words", "n_removed", "kept_text"])

    rows = repeats.tagged(docs)
    return repeats.with_spans(rows, removal_spans(rows, window)).mapInArrow(
        run, "doc_id long, n_words long, n_removed long, kept_text string")


"""Quality rules with cross-document line frequency, in DataFrame functions only.

Lines are normalised (white space to one blank, lower case) and hashed. Per host (column ``source``) each line
counts the distinct texts that hold it; copies of one text count once. A line above its host's limit is removed
wherever it stands, and a document that keeps too little of itself is rejected.

Scale: documents are read three times and never shuffled; only line hashes and small rows are. A line of a third
of all documents is spread by (host, line, text) first and then counted with partial sums, so no task gathers it;
the lines above the limit meet their occurrences in an equality join that AQE can split.

Defined cases: null text is empty (no words, ``base_failed``, not kept); null host is the host ``''``; an empty
table gives an empty result; rows with equal doc_id and text give equal rows; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from siftgate.llm.columns import WHITE, let, whole, words

SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Limits:
    min_words: int = 50          #: fewer words fail a document
    repeat_percent: int = 50     #: so many percent of words in repeated windows are allowed
    line_docs: int = 20          #: a line may be in so many distinct texts of a host ...
    line_percent: int = 1        #: ... or in so many percent of them, if that is more
    kept_percent: int = 50       #: at least so many percent of words must be left


def removed(text: Column, chars: str) -> Column:
    """Number of characters of ``text`` that are in ``chars``."""
    return F.char_length(text) - F.char_length(F.translate(text, chars, ""))


def repeat_words(w: Column, size: int = 3) -> Column:
    """Number of words in windows of ``size`` words that are found twice or more in the text."""
    def covered(places: Column) -> Column:  # ascending starts of repeated windows
        steps = F.transform(places, lambda p, k: F.coalesce(F.least(F.lit(size), F.get(places, k + 1) - p), F.lit(size)))
        return F.aggregate(steps, F.lit(0), lambda s, x: s + x)

    def repeated(grams: Column) -> Column:
        same = lambda s, e, k: F.coalesce(F.get(s, k)["h"] == e["h"], F.lit(False))
        twice = let(F.sort_array(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
                    lambda s: F.filter(s, lambda e, k: F.when(k > 0, same(s, e, k - 1)).otherwise(False) | same(s, e, k + 1)))
        return let(F.sort_array(F.transform(twice, lambda e: e["i"])), covered)

    grams = F.transform(F.slice(w, F.lit(1), F.greatest(F.size(w) - (size - 1), F.lit(0))),
                        lambda x, i: F.xxhash64(x, *[F.get(w, i + j) for j in range(1, size)]))
    return let(grams, lambda g: F.when(F.size(F.array_distinct(g)) == F.size(g), 0).otherwise(repeated(g)))


def filled(line: Column) -> Column:
    return F.btrim(line, F.lit(WHITE)) != ""


def base_rules(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Per document: counts of words, characters, symbols, repeated lines and words. No shuffle."""
    text = whole()
    lines = F.filter(F.split(text, "\n"), filled)
    counted = docs.select(
        "doc_id", F.xxhash64(text).alias("text_key"),
        let(words(text), lambda w: F.struct(F.size(w).cast("long").alias("n_words"), repeat_words(w).cast("long").alias("n_repeat_words"))).alias("w"),
        removed(text, WHITE).alias("white"), F.char_length(text).alias("chars"), removed(text, SYMBOLS).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))
    n, again = F.col("w.n_words"), F.col("w.n_repeat_words")
    return counted.select(
        "doc_id", "text_key", n.alias("n_words"), (F.col("chars") - F.col("white")).cast("long").alias("word_chars"),
        "n_symbols", "n_dup_lines", again.alias("n_repeat_words"),
        ((n < limits.min_words) | (100 * again > limits.repeat_percent * n)).alias("base_failed"))


def normal_line(line: Column) -> Column:
    return F.lower(F.btrim(F.regexp_replace(line, r"[\x20\x09-\x0D]+", " ")))


def document_lines(docs: DataFrame) -> DataFrame:
    """Lines with a word: host, hash of the normalised line, place in the document, number of words."""
    text = whole()
    rows = docs.select("doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("host"), F.xxhash64(text).alias("text_key"),
                       F.posexplode(F.filter(F.split(text, "\n"), filled)).alias("place", "line"))
    return rows.select("doc_id", "host", "text_key", "place", F.xxhash64(normal_line(F.col("line"))).alias("line_key"),
                       F.size(words(F.col("line"))).alias("n"))


def frequent_lines(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """(host, line_key, docs) of lines above the limit of their host."""
    counts = (document_lines(docs).select("host", "line_key", "text_key").distinct()
              .groupBy("host", "line_key").agg(F.count("*").alias("docs")).filter(F.col("docs") > limits.line_docs))
    hosts = (docs.select(F.coalesce(F.col("source").cast("string"), F.lit("")).alias("host"), F.xxhash64(whole()).alias("text_key"))
             .distinct().groupBy("host").agg(F.count("*").alias("host_docs")))
    return (counts.join(hosts, "host").filter(100 * F.col("docs") > limits.line_percent * F.col("host_docs"))
            .select("host", "line_key", "docs"))


def line_frequency_rules(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """One row per document: base counts, words in removed lines, and whether it is kept."""
    found = (document_lines(docs).join(frequent_lines(docs, limits), ["host", "line_key"])
             .select("doc_id", "text_key", "place", "n").distinct()
             .groupBy("doc_id", "text_key").agg(F.sum("n").alias("removed_words")))
    base = base_rules(docs, limits)
    all_rows = base.join(found.withColumnRenamed("doc_id", "id").withColumnRenamed("text_key", "key"),
                         base.doc_id.eqNullSafe(F.col("id")) & (base.text_key == F.col("key")), "left")
    gone = F.coalesce(F.col("removed_words"), F.lit(0))
    left = F.col("n_words") - gone
    depleted = (left < limits.min_words) | (100 * left < limits.kept_percent * F.col("n_words"))
    return all_rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                           gone.cast("long").alias("removed_words"), (~F.col("base_failed") & ~depleted).alias("kept"))

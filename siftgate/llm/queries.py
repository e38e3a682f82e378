"""Registered queries of the subpackage: one per operator, over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from siftgate.llm import automaton_dedup, byte_bpe, decontaminate, fuzzy_lines, line_rules, ngram_lm, pii_boost, quality_model, set_join, source_audit, source_mix, suffix_groups, token_alignment

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql.strip()
        return fn
    return keep


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def tokenizer() -> tuple[str, str]:
    """Path of the rank file and the pattern that splits texts."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def coded_digest(docs: DataFrame) -> DataFrame:
    path, pattern = tokenizer()
    coded = byte_bpe.encode_decode(docs.select("doc_id", "text"), path, pattern)
    return coded.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op5_byte_bpe")
def op5(spark, sf_dir):
    return coded_digest(documents(spark, sf_dir))


LINE_RULES_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
grams AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
again AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p
        FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM grams) WHERE c > 1)
  GROUP BY doc_id),
l AS (
  SELECT doc_id, host, text, place, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n,
         lower(trim(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g'))) AS norm
  FROM (SELECT doc_id, host, text, unnest(string_split(text, chr(10))) AS line,
               generate_subscripts(string_split(text, chr(10)), 1) AS place FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM l GROUP BY doc_id),
hosts AS (SELECT host, count(DISTINCT text) AS host_docs FROM d GROUP BY host),
often AS (
  SELECT host, norm FROM l JOIN hosts USING (host) GROUP BY host, norm, host_docs
  HAVING count(DISTINCT text) > 20 AND 100 * count(DISTINCT text) > host_docs),
gone AS (SELECT doc_id, sum(n) AS removed_words FROM l JOIN often USING (host, norm) GROUP BY doc_id),
base AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         coalesce(removed_words, 0)::BIGINT AS removed_words
  FROM d LEFT JOIN again USING (doc_id) LEFT JOIN dup USING (doc_id) LEFT JOIN gone USING (doc_id))
SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
       AND n_words - removed_words >= 50 AND 100 * (n_words - removed_words) >= 50 * n_words AS kept
FROM base
"""


@query("op8_line_frequency_rules", LINE_RULES_SQL)
def op8(spark, sf_dir):
    return line_rules.line_frequency_rules(documents(spark, sf_dir))


@query("op4_automaton_dedup")
def op4(spark, sf_dir):
    out = automaton_dedup.remove_passages(documents(spark, sf_dir))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


@query("op10_suffix_groups")
def op10(spark, sf_dir):
    out = suffix_groups.remove_repeats(documents(spark, sf_dir))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op7_set_relation_join")
def op7(spark, sf_dir):
    return set_join.similar_sets(documents(spark, sf_dir))


@query("op9_fuzzy_lines")
def op9(spark, sf_dir):
    out = fuzzy_lines.remove_fuzzy_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


@query("op2_cgk_decontamination")
def op2(spark, sf_dir):
    return decontaminate.contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@query("op1_weak_label_quality")
def op1(spark, sf_dir):
    return quality_model.quality(documents(spark, sf_dir).select("doc_id", "text")).select("doc_id", "weak", "score", "kept")


@query("op6_boosted_pii")
def op6(spark, sf_dir):
    out = pii_boost.personal_data(documents(spark, sf_dir).select("doc_id", "text"))
    counts = [pii_boost.number(F.col("base"), k).alias(f"n_{kind}") for k, kind in enumerate(pii_boost.KINDS)]
    return out.select("doc_id", *counts, F.sha2(pii_boost.listed(F.col("base")), 256).alias("base_sha256"),
                      pii_boost.listed(F.concat("base", "added")).alias("spans"))


@query("op3_elias_fano_lm")
def op3(spark, sf_dir):
    return ngram_lm.language_model(documents(spark, sf_dir))


SOURCE_MIX_SQL = r"""
WITH s AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         CAST('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 15) AS BIGINT) AS h
  FROM documents),
src AS (
  SELECT *, [3, 1, 2][(source_no - 1) % 3 + 1]::BIGINT AS w, 2 * source_size AS cap
  FROM (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS source_no
        FROM s GROUP BY source)),
fill AS (
  SELECT *, sum(source_size) OVER () * 1.5::DOUBLE AS wanted, sum(w) OVER () AS all_w,
         sum(cap) OVER o - cap AS before, sum(w) OVER o - w AS used
  FROM src WINDOW o AS (ORDER BY cap / w, source_no ROWS UNBOUNDED PRECEDING)),
whole AS (SELECT *, cap * (all_w - used)::DOUBLE <= (wanted - before) * w AS is_full FROM fill),
plan AS (
  SELECT *, greatest(1, least(64, floor(min(CASE WHEN NOT is_full THEN target END) OVER () / 1000)))::BIGINT AS block,
         least(4096, greatest(1, ceil(source_size / 4000000)))::BIGINT AS n_shards
  FROM (SELECT *, CASE WHEN is_full THEN cap::DOUBLE ELSE w * left_over / open_w END AS target
        FROM (SELECT *, wanted - coalesce(sum(CASE WHEN is_full THEN cap END) OVER (), 0) AS left_over,
                     sum(CASE WHEN NOT is_full THEN w END) OVER () AS open_w FROM whole))),
v1 AS (
  SELECT source_no, w::HUGEINT AS v, round(left_over / block)::HUGEINT AS k, sum(w) OVER ()::HUGEINT AS a, count(*) OVER ()::HUGEINT AS m
  FROM plan WHERE NOT is_full),
b1 AS (SELECT *, greatest(0, (v * (2 * k - m) + a) // (2 * a)) AS lo, greatest(0, (v * (2 * k + m) + a) // (2 * a)) AS hi FROM v1),
q1 AS (
  SELECT source_no, min(lo) + count(*) FILTER (seat IS NOT NULL AND r <= rest) AS quota
  FROM (SELECT *, row_number() OVER (ORDER BY v::DOUBLE / (2 * seat - 1) DESC NULLS LAST, source_no, seat) AS r
        FROM (SELECT source_no, v, lo, k - sum(lo) OVER () AS rest, unnest(CASE WHEN hi > lo THEN range((lo + 1)::BIGINT, (hi + 1)::BIGINT) ELSE [NULL] END) AS seat FROM b1))
  GROUP BY source_no),
d AS (
  SELECT s.*, source_no, source_size, target, block, is_full, h % n_shards AS shard
  FROM s JOIN plan ON s.source IS NOT DISTINCT FROM plan.source),
sh AS (
  SELECT source_no, shard, block, is_full, sum(size)::BIGINT AS n, ceil(sum(size) / block)::BIGINT AS blocks FROM d GROUP BY source_no, shard, block, is_full),
v2 AS (
  SELECT source_no, shard, n::HUGEINT AS v, quota::HUGEINT AS k, greatest(1, sum(n) OVER p)::HUGEINT AS a, count(*) OVER p::HUGEINT AS m
  FROM sh JOIN q1 USING (source_no) WHERE NOT is_full WINDOW p AS (PARTITION BY source_no)),
b2 AS (SELECT *, greatest(0, (v * (2 * k - m) + a) // (2 * a)) AS lo, greatest(0, (v * (2 * k + m) + a) // (2 * a)) AS hi FROM v2),
q2 AS (
  SELECT source_no, shard, min(lo) + count(*) FILTER (seat IS NOT NULL AND r <= rest) AS quota
  FROM (SELECT *, row_number() OVER (PARTITION BY source_no ORDER BY v::DOUBLE / (2 * seat - 1) DESC NULLS LAST, shard, seat) AS r
        FROM (SELECT source_no, shard, v, lo, k - sum(lo) OVER (PARTITION BY source_no) AS rest,
                     unnest(CASE WHEN hi > lo THEN range((lo + 1)::BIGINT, (hi + 1)::BIGINT) ELSE [NULL] END) AS seat FROM b2))
  GROUP BY source_no, shard),
z AS (
  SELECT source_no, shard, blocks, q // blocks AS passes, q % blocks AS rest,
         CAST('0x' || substr(md5('mix:' || source_no || ':' || shard), 1, 15) AS BIGINT) % blocks AS start
  FROM (SELECT sh.*, CASE WHEN is_full THEN 2 * blocks ELSE least(quota, 2 * blocks) END::HUGEINT AS q
        FROM sh LEFT JOIN q2 USING (source_no, shard)) WHERE blocks > 0),
placed AS (
  SELECT doc_id, size, source_size, target, block, blocks, passes, rest, start, e, e - size AS b
  FROM (SELECT d.*, blocks, passes, rest, start,
               sum(size) OVER (PARTITION BY source_no, shard ORDER BY h, doc_id, size ROWS UNBOUNDED PRECEDING)::HUGEINT AS e
        FROM d LEFT JOIN z USING (source_no, shard)))
SELECT doc_id, size, source_size, target,
       coalesce(passes * size + CASE WHEN size > 0 AND rest > 0 THEN
         ((e // block) * rest + start) // blocks * block + (e % block) * (((e // block + 1) * rest + start) // blocks - ((e // block) * rest + start) // blocks)
         - ((b // block) * rest + start) // blocks * block - (b % block) * (((b // block + 1) * rest + start) // blocks - ((b // block) * rest + start) // blocks)
       ELSE 0 END, 0)::BIGINT AS taken
FROM placed
"""


@query("op11_source_mix", SOURCE_MIX_SQL)
def op11(spark, sf_dir):
    return source_mix.mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


SOURCE_AUDIT_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
t AS (SELECT r, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS lang_n FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
c AS (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN kept USING (lang, term) GROUP BY ALL),
v AS (SELECT lang, count(*)::HUGEINT AS v, sum(lang_n)::HUGEINT AS all_n FROM kept GROUP BY lang),
g AS (SELECT lang, source, coalesce(sum(n), 0)::HUGEINT AS all_n
      FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN c USING (lang, source) GROUP BY lang, source),
p AS (
  SELECT g.lang, g.source, kept.term, coalesce(n, 0) AS n, 1 + 1000000000 * (coalesce(n, 0) + 1)::HUGEINT // (g.all_n + v) AS p,
         1 + 1000000000 * (lang_n + 1)::HUGEINT // (v.all_n + v) AS q
  FROM g JOIN v USING (lang) JOIN kept USING (lang) LEFT JOIN c USING (lang, source, term)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
rows AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q) // q)::BIGINT FROM p WHERE n > 0 AND p > q)
SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
FROM rows QUALIFY part = 'pair' OR rank <= 200
"""


@query("op12_source_audit", SOURCE_AUDIT_SQL)
def op12(spark, sf_dir):
    return source_audit.divergence(documents(spark, sf_dir))


@query("op13_token_alignment")
def op13(spark, sf_dir):
    import public_tokenizers
    files = token_alignment.read_files(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    return token_alignment.align(documents(spark, sf_dir), files)

"""Cases and latencies kept as partial states that merge (D2, D4, G3 without old partitions).

A state is one row per case (or per group of calls) that holds what its part of the data contributes. Merging adds the parts
up, so a new crawl is judged alone and merged into the stored state: no old partition is read again. Counts are
exact, as long as each crawl is in one part. Crawl labels keep the first few by crawl order, which merges exactly: a label
among the first few of all parts is among the first few of the part where it comes first. The number of different labels
and latency quantiles come from mergeable sketches, and are approximate.

Detail texts are left out: they name the totals of one table ("5 of 100 rows failed") and do not add up.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from siftgate.functions.values import count_where, sort_struct
from siftgate.operators.failures import CASE_KEY, CRAWL_LABELS, RULE_FACTS, case_id, crawl_label, failed_share
from siftgate.operators.row_checks import ENTRY, Entries

COUNTS = ["failed_count", "n_failures", "n_crawls"]
ENTRY_KEY = ["dataset", "platform"]


def case_states(failures: DataFrame, keys: list[str], limit: int = CRAWL_LABELS) -> DataFrame:
    """State of every case of one part, from its failure records: facts of the rule, exact counts, the first labels with their
    places, and a sketch of all labels. A part without failures has no rows."""
    named = failures.withColumns({"_label": F.when(~F.col("run_scope"), crawl_label(keys)), "_at": sort_struct(keys)})
    base = named.groupBy(*CASE_KEY).agg(
        *[F.first(c).alias(c) for c in RULE_FACTS],
        F.sum("failed_count").alias("failed_count"), F.count(F.lit(1)).alias("n_failures"),
        count_where(~F.col("run_scope")).alias("n_crawls"), F.hll_sketch_agg("_label").alias("labels_sketch"))
    return base.join(_first_labels(named.where(~F.col("run_scope")), limit), CASE_KEY, "left")


def merge_case_states(*states: DataFrame, limit: int = CRAWL_LABELS) -> DataFrame:
    """One state of all parts; any order and grouping of merges gives the same."""
    every = reduce(DataFrame.unionByName, states)
    base = every.groupBy(*CASE_KEY).agg(*[F.first(c).alias(c) for c in RULE_FACTS], *[F.sum(c).alias(c) for c in COUNTS],
                                        F.hll_union_agg("labels_sketch").alias("labels_sketch"))
    places = every.select(*CASE_KEY, F.explode("first_labels").alias("_f")).select(*CASE_KEY, F.col("_f.at").alias("_at"), F.col("_f.label").alias("_label"))
    return base.join(_first_labels(places, limit), CASE_KEY, "left")


def _first_labels(rows: DataFrame, limit: int) -> DataFrame:
    """``first_labels``: (place, label) of the first ``limit`` labels of each case, by the first place of each."""
    seen = rows.groupBy(*CASE_KEY, "_label").agg(F.min("_at").alias("_at"))
    rank = Window.partitionBy(*CASE_KEY).orderBy("_at", "_label")
    top = seen.withColumn("_r", F.row_number().over(rank)).where(F.col("_r") <= limit)
    return top.groupBy(*CASE_KEY).agg(F.array_sort(F.collect_list(F.struct(F.col("_at").alias("at"), F.col("_label").alias("label")))).alias("first_labels"))


def entry_sizes(df: DataFrame, rules, platform_column: str | None = None) -> DataFrame:
    """Rows of each (dataset, platform) of one part: what shares are taken of."""
    entries = Entries.of(rules, platform_column)
    return (entries.prepare(df).groupBy(F.col(ENTRY).alias("platform")).agg(F.count(F.lit(1)).alias("entry_rows"))
            .select(F.lit(entries.dataset).alias("dataset"), "platform", "entry_rows"))


def merge_entry_sizes(*sizes: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, sizes).groupBy(*ENTRY_KEY).agg(F.sum("entry_rows").alias("entry_rows"))


def cases_of(states: DataFrame, sizes: DataFrame) -> DataFrame:
    """Cases as ``fingerprint_cases`` gives them, without details, and with an estimate of the number of labels."""
    # one row per configured entry: bounded by the rule files
    out = states.join(F.broadcast(sizes.withColumnRenamed("entry_rows", "total_rows")), ENTRY_KEY, "left")
    labels = F.transform("first_labels", lambda x: x["label"])
    return failed_share(out.select(*CASE_KEY, *RULE_FACTS, *COUNTS, "total_rows", case_id(*[F.col(c) for c in CASE_KEY]).alias("case_id"),
                                   labels.alias("crawl_labels"), F.hll_sketch_estimate("labels_sketch").alias("approx_labels")))


# ------------------------------------------------------------------ latencies

def latency_states(calls: DataFrame, by: list[str], latency: Column) -> DataFrame:
    """State of the latencies of each group: number, longest and a quantile sketch. Calls without latency do not count."""
    value = latency.cast("double")
    return calls.where(value.isNotNull()).groupBy(*by).agg(
        F.count(F.lit(1)).alias("calls"), F.max(value).alias("longest_s"), F.kll_sketch_agg_double(value).alias("sketch"))


def merge_latency_states(*states: DataFrame, by: list[str]) -> DataFrame:
    return reduce(DataFrame.unionByName, states).groupBy(*by).agg(
        F.sum("calls").alias("calls"), F.max("longest_s").alias("longest_s"), F.kll_merge_agg_double("sketch").alias("sketch"))


def latency_quantile(states: DataFrame, by: list[str], share: float = 0.95) -> DataFrame:
    """The approximate quantile of each group; ``call_stats.p95_exclusive`` has the exact one."""
    return states.select(*by, "calls", "longest_s", F.kll_sketch_get_quantile_double("sketch", F.lit(share)).alias("quantile_s"))

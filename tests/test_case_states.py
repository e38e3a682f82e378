"""Merged states equal what one step over all data gives."""

import random

from pyspark.sql import functions as F

from siftgate.operators import case_states as cst, failures as fl
from siftgate.plans.rules import shipped_rules
from siftgate.workload.views import CRAWL, view

KEYS = ["keyword", "time_stamp"]
SHOWN = ["case_id", "severity", "failed_count", "n_crawls", "total_rows", "failed_share_3dp", "crawl_labels"]


def shown(df):
    return sorted(tuple(map(str, r)) for r in df.select(*SHOWN).collect())


def test_merged_cases_equal_one_step(spark, small, tmp_path):
    rules, crawl = shipped_rules("visibility/amazon"), view(spark, small, CRAWL)
    year = F.year("time_stamp")
    parts = [crawl.where(year < 1994), crawl.where((year >= 1994) & (year < 1997)), crawl.where(year >= 1997), crawl.limit(0)]
    for i, p in enumerate(parts):  # states go through files, as between runs
        cst.case_states(fl.failure_records(p, rules), KEYS).write.parquet(f"{tmp_path}/states{i}")
        cst.entry_sizes(p, rules).write.parquet(f"{tmp_path}/sizes{i}")
    s = [spark.read.parquet(f"{tmp_path}/states{i}") for i in range(4)]
    sizes = cst.merge_entry_sizes(*[spark.read.parquet(f"{tmp_path}/sizes{i}") for i in range(4)])
    want = fl.fingerprint_cases(fl.failure_records(crawl, rules), KEYS)
    left = cst.merge_case_states(cst.merge_case_states(s[0], s[1]), cst.merge_case_states(s[2], s[3]))
    right = cst.merge_case_states(s[3], cst.merge_case_states(s[2], cst.merge_case_states(s[1], s[0])))
    assert want.count() > 3
    assert shown(cst.cases_of(left, sizes)) == shown(cst.cases_of(right, sizes)) == shown(want)
    exact = {r["case_id"]: r["n"] for r in fl.case_crawls(fl.failure_records(crawl, rules), KEYS).groupBy("case_id").agg(F.count("*").alias("n")).collect()}
    for r in cst.cases_of(left, sizes).collect():
        assert abs(r["approx_labels"] - exact[r["case_id"]]) <= 0.1 * exact[r["case_id"]]


def test_empty_part_has_no_state(spark, small):
    rules, crawl = shipped_rules("visibility/amazon"), view(spark, small, CRAWL).limit(0)
    states, sizes = cst.case_states(fl.failure_records(crawl, rules), KEYS), cst.entry_sizes(crawl, rules)
    assert cst.cases_of(cst.merge_case_states(states, states), cst.merge_entry_sizes(sizes, sizes)).count() == 0


def test_merged_latencies(spark):
    rng = random.Random(6)
    rows = [("a" if i % 3 else "b", i // 5_000, rng.lognormvariate(0, 1)) for i in range(20_000)] + [("a", 0, None), ("none", 1, None)]
    df = spark.createDataFrame(rows, "model string, part int, latency_s double")
    states = [cst.latency_states(df.where(F.col("part") == p), ["model"], F.col("latency_s")) for p in range(4)]
    got = {r["model"]: r for r in cst.latency_quantile(cst.merge_latency_states(*states, by=["model"]), ["model"]).collect()}
    assert set(got) == {"a", "b"}
    for m, r in got.items():
        all_ = sorted(x for n, _, x in rows if n == m and x is not None)
        assert (r["calls"], r["longest_s"]) == (len(all_), all_[-1])
        rank = sum(x <= r["quantile_s"] for x in all_) / len(all_)
        assert abs(rank - 0.95) <= 0.03

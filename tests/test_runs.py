"""Verdicts, statistics, streams, plans and a whole run."""

import re
import statistics
import random

import pytest
from pyspark.sql import functions as F

from siftgate.operators import call_stats as cs, escalation as esc, failures as fl, reconcile as rc
from siftgate.sources.runs import read_table
from siftgate.plans import investigation
from siftgate.plans.quality_run import Policy, Source, due_sources, run_quality
from siftgate.plans.rules import Rule, RuleSet, shipped_rules
from siftgate.sources import tables
from siftgate.streaming import live
from siftgate.workload.views import MARKET, crawl_view, view


def plan_of(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def final_plan(df):
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text[:text.index("Initial Plan")] if "Initial Plan" in text else text


# ------------------------------------------------------------------ plans

def test_row_rules_share_one_scan_and_one_shuffle_by_crawl(spark, small):
    plan = final_plan(fl.failure_records(crawl_view(spark, small), shipped_rules("visibility/amazon")))
    assert len(re.findall(r"FileScan parquet", plan)) == 2  # lineitem and part, once each
    assert len(re.findall(r"\bExchange hashpartitioning\([^)]*keyword", plan)) - len(
        re.findall(r"ReusedExchange [^\n]*keyword", plan)) <= 1


def test_cases_reuse_the_same_scan(spark, small):
    cases = fl.fingerprint_cases(fl.failure_records(crawl_view(spark, small), shipped_rules("visibility/amazon")),
                                 ["keyword", "time_stamp"])
    assert len(re.findall(r"FileScan parquet", final_plan(cases))) == 2


def test_window_filter_prunes_partitions_and_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    (spark.range(100).select(F.lit("Amazon").alias("platform"), F.expr("date'2024-01-01' + cast(id % 3 as int)").alias("date_stamp"),
                             (F.col("id") % 24).cast("int").alias("hour_stamp"), F.col("id").alias("a"), F.col("id").alias("b"))
     .write.partitionBy("platform", "date_stamp", "hour_stamp").parquet(path))
    scan = tables.table_window_scan(spark.read.parquet(path), "t_osa_hourly", ["Amazon"], "2024-01-02 01:30:00").select("a")
    plan = plan_of(scan)
    filters = re.search(r"PartitionFilters: ([^\n]*)", plan).group(1)
    assert "date_stamp" in filters and "hour_stamp" in filters and "platform" in filters
    assert "ReadSchema: struct<a:bigint>" in plan


def test_tagging_rows_needs_no_shuffle(spark, small):
    from siftgate.operators.row_checks import row_rule_set
    orders = spark.read.parquet(f"{small}/orders.parquet")
    rules = RuleSet("d", "p", (), (Rule("a", "range", "o_totalprice", {"max": 100000}), Rule("b", "not_null", "o_orderstatus")))
    assert "Exchange" not in plan_of(row_rule_set(orders, rules, keep=["o_orderkey"]))


# ------------------------------------------------------------------ windows of time

def test_hour_pairs():
    assert tables.hour_window_pairs("2024-03-01 01:10:00", 4) == [
        ("2024-02-29", 22), ("2024-02-29", 23), ("2024-03-01", 0), ("2024-03-01", 1)]
    assert tables.hour_window_pairs(date="2024-01-05", hours=[7, 6]) == [("2024-01-05", 7), ("2024-01-05", 6)]
    assert len(tables.hour_window_pairs(date="2024-01-05")) == 24


# ------------------------------------------------------------------ verdicts

def test_streak_resets_and_follows_its_own_dataset(spark):
    runs = spark.createDataFrame([("h", n) for n in (1, 2, 4, 5)] + [("d", 3), ("d", 9)], "dataset string, run_seq long")
    seen = spark.createDataFrame([("h", "x", 1), ("h", "x", 2), ("h", "x", 4), ("h", "y", 1), ("h", "y", 4), ("h", "y", 5),
                                  ("d", "x", 3), ("d", "x", 9)], "dataset string, case_id string, run_seq long")
    got = {(r["dataset"], r["case_id"], r["run_seq"]): r["recurrence"] for r in fl.recurrence_streak(seen, runs).collect()}
    assert got == {("h", "x", 1): 1, ("h", "x", 2): 2, ("h", "x", 4): 3, ("h", "y", 1): 1, ("h", "y", 4): 1,
                   ("h", "y", 5): 2, ("d", "x", 3): 1, ("d", "x", 9): 2}


def test_budget_admits_while_below_the_cap(spark):
    queue = spark.createDataFrame([(i,) for i in range(1, 6)], "queue_no int")
    for cap, want in ((5, 3), (4, 2), (0, 0), (None, 5)):
        assert esc.budgeted_queue(queue, cap).where("admitted").count() == want


def test_escalation_defaults(spark):
    cases = spark.createDataFrame([("a", True, 0.7), ("b", True, 0.55), ("c", False, 0.2), ("d", None, None), ("e", True, None)],
                                  "case_id string, true_positive boolean, confidence double")
    cases = cases.withColumn("severity", F.lit("error")).withColumn("on_fail", F.lit("investigate"))
    got = {r["case_id"]: r["escalation_reasons"] for r in esc.escalation_reasons(cases, 0.5).collect()}
    assert got == {"a": ["ai_verdict"], "b": ["ai_verdict", "low_confidence"], "c": ["low_confidence"], "d": [], "e": []}


def test_verdict_tells_absent_values_from_absent_pages(spark):
    stored = spark.createDataFrame([(1, "x", True), (2, "x", False), (3, None, True), (4, "", True), (5, "z", True)],
                                   "row_id int, name string, html_available boolean")
    shown = spark.createDataFrame([(5, "name", "z")], "row_id int, column string, html_value string")
    rules = [Rule("gone", "must_null", "name"), Rule("there", "not_null", "name")]
    got = {(r["rule_id"], r["row_id"]): (r["true_positive"], r["cause"], r["confidence"])
           for r in rc.rule_set_verdicts(stored, shown, ["row_id"], rules).collect()}
    assert got[("gone", 1)] == (True, "genuine_data_issue", 0.5)
    assert got[("gone", 2)] == (True, "unknown", 0.5)
    assert got[("gone", 5)] == (False, "not_applicable", 0.9)
    assert got[("there", 3)] == (True, "genuine_data_issue", 0.5)


def test_run_stats_count_cases_without_verdict(spark):
    verdicts = spark.createDataFrame([("m", 1, "a", 1, True, 0.9, None)], "model string, run int, case_id string, "
                                     "row_seq int, true_positive boolean, confidence double, error string")
    cases = spark.createDataFrame([("m", 1, "a"), ("m", 1, "b"), ("m", 2, "a")], "model string, run int, case_id string")
    got = {r["run"]: (r["cases"], r["escalated_cases"], r["true_positive_rows"], r["investigated_rows"])
           for r in cs.run_stats(verdicts, cases=cases).collect()}
    assert got == {1: (2, 1, 1, 1), 2: (1, 0, 0, 0)}


def test_one_scan_for_all_drilldown_counts_and_verdicts(spark, small):
    from siftgate.workload import catalog
    from siftgate.workload.views import EXTRACTION, STORED
    # d21: the crawl view joins two tables; f3: the stored rows and each part of the extraction view, whatever the number of rules
    for name, scans in (("d21_drilldown_count", 2), ("f3_rule_based_verdict", (STORED + EXTRACTION).count("FROM orders"))):
        plan = catalog.QUERIES[name](spark, small)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan parquet") == scans, (name, plan.count("FileScan parquet"))


def test_majority_cause_ties_are_unknown(spark):
    rows = [("a", True, "x"), ("a", True, "y"), ("b", True, "x"), ("b", True, "x"), ("b", True, "y"), ("c", False, "z")]
    df = spark.createDataFrame(rows, "case_id string, true_positive boolean, cause string")
    got = {r["case_id"]: (r["case_true_positive"], r["majority_cause"]) for r in esc.majority_cause(df).collect()}
    assert got == {"a": (True, "unknown"), "b": (True, "x"), "c": (False, None)}


def test_values_match(spark):
    pairs = [("194.35", " 194.350", True), ("4.0", "4", True), ("1.0E7", "10000000", True), ("In Stock", " In Stock ", True),
             ("1234.5", "₹1,234.50", True), ("1234567", "Rs. 12,34,567/-", True), ("-5", "€ -5", True), ("12.5", "12.5 $", True), ("1,2", "12", False),
             ("1234", "12,34", False), ("1234", "$$1234", False), ("₹ 10", "10.0", True), ("Rs", "INR", False),
             ("a", "b", False), ("a", None, False), (None, "a", False), (None, None, False)]
    df = spark.createDataFrame(pairs, "a string, b string, want boolean")
    assert [tuple(r) for r in df.select(rc.values_match(F.col("a"), F.col("b")), "want").collect()] == [
        (w, w) for *_, w in pairs]


def test_prompt_slots():
    with pytest.raises(KeyError):
        class Frame:
            columns = ["a"]
        rc.prompt_table(Frame(), "no {{ missing }}")


# ------------------------------------------------------------------ statistics

def test_exclusive_quantile_small_groups(spark):
    rng = random.Random(1)
    groups = {n: [round(rng.expovariate(0.02), 2) for _ in range(n)] for n in (1, 2, 3, 10, 19, 20, 21, 500)}
    df = spark.createDataFrame([(k, v) for k, vs in groups.items() for v in vs], "g int, v double")
    got = {r["g"]: r["p95"] for r in cs.quantile_exclusive(df, ["g"], "v").collect()}
    for n, values in groups.items():
        want = statistics.quantiles(values, n=20)[18] if n > 1 else None
        assert got[n] == (pytest.approx(want, rel=1e-12) if want is not None else None)


def test_exclusive_quantile_with_brackets(spark, monkeypatch):
    monkeypatch.setattr(cs, "ACCURACY", 1000)
    monkeypatch.setattr(cs, "BRACKET", 5e-3)
    rng = random.Random(2)
    groups = {"spread": [rng.random() for _ in range(20_000)], "ties": [rng.choice([1.0, 1.0, 2.0]) for _ in range(9_000)],
              "constant": [5.0] * 4_000, "small": [rng.random() for _ in range(100)]}
    df = spark.createDataFrame([(k, v) for k, vs in groups.items() for v in vs], "g string, v double")
    got = {r["g"]: r["p95"] for r in cs.quantile_exclusive(df, ["g"], "v").collect()}
    for k, values in groups.items():
        assert got[k] == pytest.approx(statistics.quantiles(values, n=20)[18], rel=1e-12)


# ------------------------------------------------------------------ streams

EVENTS = RuleSet("t", "p", (), (Rule("high", "range", "v", {"max": 10}), Rule("named", "not_null", "n")))


def test_case_state_over_batches(spark, tmp_path):
    schema, src, state = "v int, n string", tmp_path / "src", str(tmp_path / "state")
    batches = [[(50, "a"), (1, None)], [(60, "a"), (70, "a")], [(1, None)], [(99, "b")]]
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(src))
        stream = spark.readStream.schema(schema).parquet(str(src))
        live.stream_case_state(live.stream_row_checks(stream, EVENTS, ["v"]), state, str(tmp_path / "check")).awaitTermination()
    got = {r["case_id"]: (r["failed_count"], r["recurrence"], r["last_batch"]) for r in live.read_state(spark, state).collect()}
    assert got == {"t|p|high": (4, 1, 3), "t|p|named": (2, 1, 2)}
    # a replayed batch leaves the state as it is
    again = spark.createDataFrame([("t", "p", "high")], "dataset string, platform_entry string, rule_id string")
    live.merge_case_state(again, 3, state)
    live.merge_case_state(again, 3, state)
    assert {r["case_id"]: r["failed_count"] for r in live.read_state(spark, state).collect()} == {"t|p|high": 4, "t|p|named": 2}


def test_stream_equals_batch(spark, small, tmp_path):
    from siftgate.operators.row_checks import row_rule_set
    rules = RuleSet("t", "p", (), (Rule("cheap", "range", "o_totalprice", {"max": 200000}),))
    orders = spark.read.parquet(f"{small}/orders.parquet")
    stream = spark.readStream.schema(orders.schema).option("pathGlobFilter", "orders.parquet").parquet(small)
    out = str(tmp_path / "out")
    live.write_stream(live.stream_row_checks(stream, rules, ["o_orderkey"]), out, str(tmp_path / "c")).awaitTermination()
    batch = row_rule_set(orders, rules, keep=["o_orderkey"])
    assert sorted(map(tuple, spark.read.parquet(out).collect())) == sorted(map(tuple, batch.collect()))


# ------------------------------------------------------------------ a whole run

def test_run_quality(spark, small, tmp_path):
    market = view(spark, small, MARKET).withColumn("date_stamp", F.lit("1997-01-01").cast("date"))
    source = Source(market, (shipped_rules("visibility/amazon"), shipped_rules("visibility/flipkart")))
    out = str(tmp_path / "run")
    verdicts = spark.createDataFrame(
        [("t_visibility_hourly|Amazon|name_present", 1, True, "xpath_drift", 0.9, "seen", None),
         ("t_visibility_hourly|Amazon|sp_positive", 1, None, None, None, None, "timeout")],
        "case_id string, row_seq int, true_positive boolean, cause string, confidence double, explanation string, error string")
    first = run_quality(spark, [source], out, "r1", "1997-01-01 12:00:00", date="1997-01-01", policy=Policy(max_calls=3))
    state = spark.read.parquet(first["state"])
    paths = run_quality(spark, [source], out, "r2", "1997-01-01 16:00:00", verdicts, state, Policy(0.6), date="1997-01-01")
    cases = spark.read.parquet(paths["cases"])
    assert {r[0] for r in cases.select("recurrence").distinct().collect()} == {2}
    assert {r[0] for r in cases.select("platform").distinct().collect()} == {"Amazon", "Flipkart"}
    alerts, digest = spark.read.parquet(paths["alerts"]), spark.read.parquet(paths["digest"])
    assert [(r["rule_id"], r["cause"], r["summary"]) for r in alerts.collect()] == [("name_present", "xpath_drift", "seen")]
    assert alerts.count() + digest.count() == cases.count()
    summary = spark.read.parquet(paths["summary"]).first()
    assert summary["escalations"] == 1 and summary["total_cases"] == cases.count()
    assert spark.read.parquet(first["queue"]).where("admitted").count() == 2
    samples = read_table(spark, out, "samples/t_visibility_hourly", "r2")
    assert samples.groupBy("platform_entry", "rule_id").count().agg(F.max("count")).first()[0] <= 5


def test_windows_prune_partitions_while_running(spark, tmp_path):
    rows = spark.range(240).selectExpr("id", "date_add(DATE '2024-01-01', CAST(id % 5 AS INT)) AS date_stamp", "CAST(id % 24 AS INT) AS hour_stamp")
    rows.write.partitionBy("date_stamp", "hour_stamp").parquet(str(tmp_path / "crawl"))
    moments = spark.createDataFrame([("a", "2024-01-02 01:30:00"), ("b", "2024-01-04 09:00:00")], "dataset string, as_of string").selectExpr("dataset", "CAST(as_of AS TIMESTAMP_NTZ) AS as_of")
    tables.hour_window_table(moments, "as_of", 3).write.parquet(str(tmp_path / "windows"))
    windows = spark.read.parquet(str(tmp_path / "windows")).where("dataset = 'a'")
    scan = tables.windows_scan(spark.read.parquet(str(tmp_path / "crawl")), windows)
    assert "dynamicpruning" in plan_of(scan)
    assert {(str(r[0]), r[1]) for r in scan.select("date_stamp", "hour_stamp").collect()} <= {("2024-01-01", 23), ("2024-01-02", 0), ("2024-01-02", 1)}
    assert scan.count() == sum((i % 5, i % 24) in {(0, 23), (1, 0), (1, 1)} for i in range(240)) > 0


def test_daily_tables_run_at_their_hour():
    hourly, daily = (Source(None, (RuleSet(d, "p"),)) for d in ("t_osa_hourly", "t_osa_daily"))
    assert due_sources([hourly, daily], "2024-01-01 08:10:00") == [daily]
    assert due_sources([hourly, daily], "2024-01-01 09:10:00") == [hourly]
    assert due_sources([hourly, daily], "2024-01-01 09:10:00", force_daily=True) == [daily]


def test_page_values_are_grouped_for_investigated_rows_only(spark):
    found = spark.createDataFrame([(7, 0.0, "o1", "Amazon", "low", "c1", 1), (8, 0.5, None, "Amazon", "low", "c1", 2)],
                                  "row_id long, sp double, object_name string, platform_entry string, rule_id string, case_id string, sample_no int")
    extraction = spark.range(100).select(F.col("id").alias("row_id"), F.lit("sp").alias("column"), F.lit("12.50").alias("html_value"),
                                         F.lit("//b").alias("current_xpath"), F.lit("//i").alias("working_xpath"))
    out = investigation.row_verdicts(found, [Rule("low", "range", "sp", {"min": 1})],
                                     investigation.Evidence(found, "", "row_id", ("row_id",), extraction))
    assert [(r["case_id"], r["row_seq"], r["suggested_xpath"]) for r in out.orderBy("row_seq").collect()] == [("c1", 1, "//i"), ("c1", 2, None)]  # no page for the second
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan

import random

from pyspark.sql import functions as F

from siftgate.operators import group_checks as gc
from siftgate.operators.failures import failure_records, fingerprint_cases
from siftgate.plans.rules import Rule, RuleSet


def one(spark, values, check, params, ddl="string", when=None):
    df = spark.createDataFrame([(v,) for v in values], f"x {ddl}")
    return [r.asDict() for r in gc.single(df, check, "x", params, [], when).collect()]


def test_null_counts_as_a_value(spark):
    r = one(spark, [None, None, None, "a"], "share_max", {"max_share": 0.5})[0]
    assert (r["top_value"], r["top_rows"], r["ok"]) == (None, 3, False)


def test_ties_take_the_smallest_value(spark):
    r = one(spark, ["b", "a", "b", "a", None, None], "share_max", {"max_share": 0.3})[0]
    assert r["top_value"] == "a" and r["top_rows"] == 2 and not r["ok"]
    assert one(spark, ["", "", "a"], "distinct_min", {"min": 2})[0]["ok"]


def test_empty_groups_never_fail(spark):
    assert one(spark, [], "row_count_min", {"min": 10}) == []
    assert one(spark, ["a"], "row_count_min", {"min": 10}, when="x = 'b'") == []


def test_contiguous_edges(spark):
    def ok(values, ddl="string"):
        return one(spark, values, "contiguous", {}, ddl)[0]["ok"]
    assert ok(["2", "1", "3"]) and ok([None, "x"]) and ok([1.0, 2.9, float("nan")], "double")
    assert not ok(["1", "1", "2"]) and not ok(["2", "3"]) and not ok(["0", "1"]) and not ok([1, 3], "int")


def test_contains_all_reports_what_is_missing(spark):
    r = one(spark, ["a", "c", None], "contains_all", {"value": ["c", "b", "a", "z"]})[0]
    assert r["missing"] == ["b", "z"] and not r["ok"]
    assert one(spark, [1, 2], "contains_all", {"value": [1, 2]}, "int")[0]["ok"]


def test_share_of_one_value(spark):
    r = one(spark, ["a", "b", None, "a"], "share_max", {"value": "a", "max_share": 0.5})[0]
    assert r["ok"] and r["value_rows"] == 2
    assert "covers 50% of 4 rows (max allowed 50%)" in r["detail"]


def test_null_crawl_key_is_its_own_group(spark):
    df = spark.createDataFrame([("k", 1), (None, 1), (None, 2)], "k string, v int")
    rows = gc.single(df, "row_count_min", None, {"min": 2}, ["k", "absent"]).select("k", "group_rows", "ok").collect()
    assert sorted(map(tuple, rows), key=str) == [("k", 1, False), (None, 2, True)]


def test_gaps_match_brute_force_across_buckets(spark, monkeypatch):
    monkeypatch.setattr(gc, "GAP_BUCKET", 4)
    rng = random.Random(7)
    groups = {f"g{i}": [rng.randint(-2, 30) for _ in range(rng.randint(1, 25))] for i in range(40)}
    groups["whole"] = list(range(1, 20))
    groups["far"] = [100, 200, 300]
    groups[None] = [2, 2]
    df = spark.createDataFrame([(k, v) for k, vs in groups.items() for v in vs], "k string, v int")
    got = {}
    for r in gc.contiguous_gaps(df, "v", ["k"]).orderBy("gap_no").collect():
        got.setdefault(r["k"], []).append(r["gap"])
    want = {k: sorted(set(range(1, len(vs) + 1)) - set(vs))[:5] for k, vs in groups.items()
            if sorted(vs) != list(range(1, len(vs) + 1))}
    assert got == {k: v for k, v in want.items() if v}


def test_group_failures_become_cases(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "x"), ("b", 1, "y")], "k string, r int, v string")
    rules = RuleSet("d", "p", ("k",), (
        Rule("few", "row_count_min", None, {"min": 2}, "crawl", on_fail="investigate"),
        Rule("all_rows", "row_count_min", None, {"min": 9}, "run"),
        Rule("spread", "share_max", "v", {"max_share": 0.9}, "crawl"),
        Rule("not_z", "allowed_values", "v", {"values": ["x"]})))
    cases = {r["rule_id"]: r for r in fingerprint_cases(failure_records(df, rules), ["k"]).collect()}
    assert {k: (r["failed_count"], r["n_crawls"], r["total_rows"]) for k, r in cases.items()} == {
        "few": (1, 1, 3), "all_rows": (3, 0, 3), "spread": (3, 2, 3), "not_z": (1, 1, 3)}
    assert cases["few"]["case_id"] == "d|p|few" and cases["few"]["on_fail"] == "investigate"
    assert cases["not_z"]["details"] == ["1 of 3 rows failed"] and cases["all_rows"]["crawl_labels"] is None


def test_one_hot_group_with_many_values(spark):
    df = spark.range(200_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"),
                                     F.col("id").cast("string").alias("v"))
    r = gc.single(df, "distinct_min", "v", {"min": 60_000}, ["k"]).where("ok").select("k", "distinct_values").collect()
    assert [tuple(x) for x in r] == [("hot", 66667)]


def test_mixed_rules_read_the_table_once(spark, small):
    """Row rules, conditional-count rules and value rules of both scopes: every row is read once, and failures and samples
    are those of the rules judged apart."""
    from siftgate.operators.failures import case_samples, failure_records, fingerprint_cases, group_failures, row_failures
    from siftgate.plans.rules import Rule, RuleSet
    from siftgate.workload.views import CRAWL, view

    crawl = view(spark, small, CRAWL).select("keyword", "time_stamp", "platform", "sp", "seller", "stock_status", "relative_rank")
    rules = RuleSet("t", "Amazon", ("keyword", "time_stamp"), (
        Rule("sp", "range", "sp", {"min": 1}), Rule("platform", "constant", "platform", {"value": "Amazon"}, when="sp is not null"),
        *[Rule(f"seller{i}", "not_null", "seller", when=f"relative_rank <> {i}") for i in range(40)],  # more flags than one word holds
        Rule("rows", "row_count_min", None, {"min": 9}, "crawl"), Rule("all", "contains_all", "stock_status", {"value": ["In Stock", "Notify me"]}, "crawl"),
        Rule("share", "share_max", "stock_status", {"max_share": 0.4}, "crawl"), Rule("ranks", "contiguous", "relative_rank", {}, "run"),
        Rule("some", "distinct_min", "seller", {"min": 4}, "crawl", when="platform = 'amazon'"), Rule("run", "row_count_min", None, {"min": 10**6}, "run")))
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    counted = crawl.mapInArrow(count, crawl.schema)
    records = failure_records(counted, rules)
    got = sorted(map(str, records.collect()))
    assert seen.value == crawl.count()
    only = lambda keep: rules.with_rules(*[r for r in rules.rules if keep(r)])
    apart = [row_failures(crawl, only(lambda r: r.scope == "row"))]
    apart += [group_failures(crawl, only(lambda r, i=i: r.id == i)) for i in ("rows", "all", "share", "ranks", "some", "run")]
    assert got == sorted(str(r) for df in apart for r in df.collect()) and {r["rule_id"] for r in records.collect()} >= {"sp", "rows", "share", "run"}
    assert fingerprint_cases(records, ["keyword", "time_stamp"]).where("rule_id = 'share'").first()["n_crawls"] > 1
    known, judged = (case_samples(crawl, rules, ["sp", "seller"], records=r) for r in (records, None))
    assert sorted(map(str, known.collect())) == sorted(map(str, judged.collect()))

import pytest

from siftgate.functions.values import null_normalise
from siftgate.operators.row_checks import failing_counts, passes, row_rule_set
from siftgate.plans.rules import Rule, RuleError, RuleSet, guard, load_rules, shipped_rules


def verdicts(spark, values, ddl, rule, as_of=None):
    df = null_normalise(spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {ddl}"))
    return [r[0] for r in df.orderBy("i").select(passes(df.schema, rule, as_of)).collect()]


BLANKS = [None, "", "  ", "\t\n", "\u00a0", "\x1c", "\u3000"]


def test_blank_text_is_missing(spark):
    values = BLANKS + ["x", " x ", "é", " y"]
    assert verdicts(spark, values, "string", Rule("r", "not_null", "x")) == [False] * 7 + [True] * 4
    assert verdicts(spark, values, "string", Rule("r", "must_null", "x")) == [True] * 7 + [False] * 4


def test_nan_is_missing(spark):
    assert verdicts(spark, [None, float("nan"), 0.0], "double", Rule("r", "not_null", "x")) == [False, False, True]
    assert verdicts(spark, [None, float("nan"), 0.0, 7.0], "double", Rule("r", "range", "x", {"min": 1})) == [
        True, True, False, True]


def test_constant_fails_on_null_and_refuses_mixed_types(spark):
    assert verdicts(spark, [None, "a", "A"], "string", Rule("r", "constant", "x", {"value": "A"})) == [
        False, False, True]
    with pytest.raises(RuleError):
        verdicts(spark, ["1"], "string", Rule("r", "constant", "x", {"value": 1}))


def test_regex_is_an_unanchored_search(spark):
    rule = Rule("r", "regex", "x", {"pattern": "^B0[A-Z0-9]{8}$"})
    values = ["B012345678", "B012345678\n", "B012345678\r", "xB012345678", None, " "]
    assert verdicts(spark, values, "string", rule) == [True, True, False, False, True, True]
    assert verdicts(spark, ["a1b", "ab"], "string", Rule("r", "regex", "x", {"pattern": r"(?P<d>\d)"})) == [True, False]


def test_range_over_text(spark):
    values = ["5", " 12 ", "1e3", "1,234", "1.5f", "nan", "inf", "", None, "-1", ".5", "5."]
    assert verdicts(spark, values, "string", Rule("r", "range", "x", {"min": 1})) == [
        True, True, True, False, False, False, True, True, True, False, False, True]
    assert verdicts(spark, ["abc"], "string", Rule("r", "range", "x", {})) == [True]


def test_length_counts_code_points(spark):
    assert verdicts(spark, ["abcd", "ab  é", None, " "], "string", Rule("r", "length", "x", {"min": 5})) == [
        False, True, True, True]
    with pytest.raises(RuleError):
        verdicts(spark, [1.0], "double", Rule("r", "length", "x", {"min": 5}))


def test_allowed_values_do_not_cross_types(spark):
    rule = Rule("r", "allowed_values", "x", {"values": ["1", 2]})
    assert verdicts(spark, ["1", "2", None, " "], "string", rule) == [True, False, True, True]
    assert verdicts(spark, [1, 2], "int", rule) == [False, True]


def test_compare_passes_on_null(spark):
    df = spark.createDataFrame([(1, 2), (2, 1), (None, 1)], "a int, b int")
    ok = passes(df.schema, Rule("r", "compare", None, {"expr": "a <= b"}))
    assert [r[0] for r in df.select(ok).collect()] == [True, False, True]


def test_freshness(spark):
    rule = Rule("r", "freshness", "x", {"max_age_hours": 2})
    values = ["2024-01-01 10:00:00", "2024-01-01 09:59:59", "2024-01-02 00:00:00", "yesterday", None]
    assert verdicts(spark, values, "string", rule, "2024-01-01 12:00:00") == [True, False, True, False, True]
    with pytest.raises(RuleError):
        verdicts(spark, values, "string", rule)


def test_guard_forms(spark):
    df = spark.createDataFrame([("SB",), ("SP",), (None,)], "t string")
    for text, want in (('t in ["SB", "SD"]', [True, False, False]), ("t == 'SP'", [False, True, False]),
                       ("t is null", [False, False, True]), ("t <> 'SP'", [True, False, False]),
                       ("NOT (t <=> 'SP')", [True, False, True])):
        assert [r[0] for r in df.select(guard(Rule("r", "not_null", "t", when=text))).collect()] == want


def test_rules_are_checked_before_the_run(spark):
    df = spark.createDataFrame([(1,)], "a int")
    for rule in (Rule("r", "not_null", "missing"), Rule("r", "no_such_check", "a")):
        with pytest.raises(RuleError):
            row_rule_set(df, RuleSet("d", "p", (), (rule,)))


def test_counts_add_up_and_do_not_depend_on_partitions(spark, small):
    from siftgate.workload.views import crawl_view
    crawl, rules = crawl_view(spark, small), shipped_rules("visibility/amazon")
    one = sorted(map(tuple, failing_counts(crawl, rules).collect()))
    many = sorted(map(tuple, failing_counts(crawl.repartition(13, "sp"), rules).collect()))
    assert one == many
    assert all(g == p + f for *_, g, p, f in one)


def test_inheritance(tmp_path):
    (tmp_path / "shop").mkdir()
    (tmp_path / "shop" / "base.yaml").write_text(
        'dataset: d\ncrawl_key: [k]\nrules:\n'
        '  - {id: a, column: x, check: constant, params: {value: "{{ platform }}"}}\n'
        '  - {id: b, column: x, check: not_null}\n')
    child = tmp_path / "shop" / "child.yaml"
    child.write_text('extends: shop/base.yaml\nplatform: P\nrules:\n'
                     '  - {id: b, column: y, check: not_null}\n  - {id: c, column: z, check: not_null, severity: warn}\n')
    rules = load_rules(child)
    assert [(r.id, r.column) for r in rules.rules] == [("a", "x"), ("b", "y"), ("c", "z")]
    assert rules.get("a").params == {"value": "P"} and rules.dataset == "d" and rules.crawl_key == ("k",)


def test_shipped_pack():
    sizes = {n: len(shipped_rules(n).rules) for n in (
        "visibility/amazon", "visibility/flipkart", "visibility/meesho", "osa/amazon", "osa/myntra", "osa_daily/nykaa")}
    assert sizes == {"visibility/amazon": 12, "visibility/flipkart": 11, "visibility/meesho": 10, "osa/amazon": 10,
                     "osa/myntra": 9, "osa_daily/nykaa": 10}

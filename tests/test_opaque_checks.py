"""Checks and page functions written in Python, by name from a rule file; and the code index against a scan of pages."""

import math
import re

import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from siftgate.operators import code_index, opaque_checks
from siftgate.operators.failures import failure_records
from siftgate.operators.group_checks import GROUP_CHECKS, group_rule_set
from siftgate.operators.opaque_checks import opaque_group_check, opaque_row_check, page_function, page_rows
from siftgate.operators.page_evidence import evidence_scan_fallback
from siftgate.operators.row_checks import ROW_CHECKS, row_rule_set
from siftgate.plans.rules import Rule, RuleError, RuleSet, load_rules

SCHEMA = "g string, h int, v string, x double"


@pytest.fixture(scope="module", autouse=True)
def checks():
    @opaque_row_check("palindrome")
    def palindrome(values, params):
        return pa.array([None if v is None else v[:params.get("chars", 99)] == v[:params.get("chars", 99)][::-1] for v in values.to_pylist()])

    @opaque_group_check("spread_max")
    class SpreadMax:
        """Population standard deviation of a number, from count, sum and sum of squares."""
        def start(self):
            return [0, 0.0, 0.0]

        def add(self, state, values, params):
            v = values.drop_null()
            return [state[0] + len(v), state[1] + (pc.sum(v).as_py() or 0), state[2] + (pc.sum(pc.multiply(v, v)).as_py() or 0)]

        def merge(self, a, b):
            return [x + y for x, y in zip(a, b)]

        def verdict(self, state, params):
            n, s, q = state
            spread = math.sqrt(max(q / n - (s / n) ** 2, 0)) if n else 0.0
            return spread <= params["max"], f"spread {spread:.3f} of {n} values"

    @page_function("links", "place int, target string")
    def links(html, params):
        for i, m in enumerate(re.finditer(r'href="([^"]*)"', html)):
            if m[1].startswith(params.get("start", "")):
                yield i, m[1]

    yield
    for names, name in ((ROW_CHECKS, "palindrome"), (GROUP_CHECKS, "spread_max"), (opaque_checks.PAGE_FUNCTIONS, "links")):
        names.pop(name)


@pytest.fixture(scope="module")
def rows():
    return [("a" if i % 3 else None, i % 2, [None, "", "abba", "abc", "é1é"][i % 5], None if i % 7 == 0 else float(i % 11)) for i in range(300)]


def test_row_check_from_a_rule_file(spark, rows, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d/r.yaml").write_text('{"dataset": "t", "platform": "p", "crawl_key": ["g"], "rules": [{"id": "pal", "column": "v", "check": "palindrome", '
                                       '"when": "h = 1"}, {"id": "two", "column": "v", "check": "palindrome", "params": {"chars": 1}}, {"id": "x", "column": "x", "check": "not_null"}]}')
    rules = load_rules(tmp_path / "d/r.yaml", tmp_path)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = row_rule_set(df, rules).groupBy("rule_id").count().collect()
    assert dict(map(tuple, got)) == {"pal": sum(r[2] == "abc" and r[1] == 1 for r in rows), "x": sum(r[3] is None for r in rows)}
    records = {(r["rule_id"], r["g"]): r["failed_count"] for r in failure_records(df, rules).collect()}
    assert records["pal", None] == sum(r[2] == "abc" and r[1] == 1 and r[0] is None for r in rows)


@pytest.mark.parametrize("keys", [("g", "h"), ()])
def test_group_check(spark, rows, keys):
    rules = RuleSet("t", "p", keys, (Rule("s", "spread_max", "x", {"max": 3.1}, "crawl", "v is not null"), Rule("r", "spread_max", "x", {"max": 9}, "run"),
                                     Rule("n", "row_count_min", None, {"min": 3}, "crawl"), Rule("d", "distinct_min", "v", {"min": 2}, "crawl")))
    out = group_rule_set(spark.createDataFrame(rows, SCHEMA).repartition(6), rules).collect()
    spread = lambda xs: math.sqrt(sum((x - sum(xs) / len(xs)) ** 2 for x in xs) / len(xs))
    groups = {}
    for r in rows:
        if r[2] is not None:
            groups.setdefault((r[0], r[1]) if keys else (), []).append(r)
    got = {tuple(r[k] for k in keys): (r["group_rows"], r["ok"], r["detail"]) for r in out if r["rule_id"] == "s"}
    assert got == {k: (len(g), spread([r[3] for r in g if r[3] is not None]) <= 3.1,
                       f"spread {spread([r[3] for r in g if r[3] is not None]):.3f} of {sum(r[3] is not None for r in g)} values") for k, g in groups.items()}
    run = [r for r in out if r["rule_id"] == "r"]
    assert len(run) == 1 and run[0]["run_scope"] and run[0]["group_rows"] == 300 and run[0]["ok"]
    assert {r["rule_id"] for r in out} == {"s", "r", "n", "d"}
    failed = failure_records(spark.createDataFrame(rows, SCHEMA), rules).where("rule_id = 's'").collect()
    assert sum(r["failed_count"] for r in failed) == sum(n for n, ok, _ in got.values() if not ok)


def test_group_check_on_nothing(spark):
    rules = RuleSet("t", "p", ("g",), (Rule("s", "spread_max", "x", {"max": 1}, "crawl"),))
    assert group_rule_set(spark.createDataFrame([], SCHEMA), rules).collect() == []
    with pytest.raises(RuleError, match="needs a column"):
        group_rule_set(spark.createDataFrame([], SCHEMA), RuleSet("t", "p", ("g",), (Rule("s", "spread_max", None, {"max": 1}, "crawl"),)))


def test_page_functions(spark):
    pages = spark.createDataFrame([(1, '<a href="/x">a</a><a href="/y">'), (2, "none"), (3, None), (4, '<a href="y">')], "id int, html string")
    got = [tuple(r) for r in page_rows(pages, "links", ["id"], {"start": "/"}).orderBy("id", "place").collect()]
    assert got == [(1, 0, "/x"), (1, 1, "/y")]
    rules = RuleSet("t", "p", ("id",), (Rule("few", "page_function", "html", {"function": "links", "max": 1}),))
    assert [r["id"] for r in row_rule_set(pages, rules).orderBy("id").collect()] == [1, 2]
    with pytest.raises(RuleError, match="unknown page function"):
        page_rows(pages, "nothing", ["id"])


# ------------------------------------------------------------------ code index

PAGES = [("c1", "o2", '<div id="ppd">code AB12CD34 and xAB12x, x-ray 55</div>'), ("c1", "o1", "<p>AB12CD34</p>"), ("c1", "o3", '<div id="ppd">AB12CD34 zzAB12CD34zz QQ77</div>'),
         ("c2", "o4", '<div id=ppd>only 12ab34cd56</div>'), ("c2", "o5", None), ("c2", "o6", ""), (None, "o7", '<div id="ppd">AB12CD34')]


@pytest.fixture(scope="module")
def indexed(spark, tmp_path_factory):
    pages = spark.createDataFrame(PAGES, "prefix string, object_name string, html string")
    path = str(tmp_path_factory.mktemp("index"))
    for crawl in ("c1", "c2"):
        code_index.add_to_index(pages.where(F.col("prefix") == crawl), "test_code_index", path, buckets=4)
    code_index.add_to_index(pages.where("prefix = 'c2'"), "test_code_index", path, buckets=4)  # twice
    yield pages, spark.table("test_code_index")
    spark.sql("DROP TABLE test_code_index")


def test_index_finds_what_a_scan_finds(spark, indexed):
    pages, index = indexed
    codes = ["AB12CD34", "AB12", "12ab34cd5", "2CD3", "QQ77", "none9", "55", "x-ray", "", None, "only 12ab", "zzAB12CD34zz", "ppd"]
    rows = spark.createDataFrame([(i, p, c, "o1" if c == "QQ77" and p == "c2" else "?") for i, (p, c) in enumerate((p, c) for p in ("c1", "c2", "c3", None) for c in codes)],
                                 "i int, prefix string, platform_code string, expected string")
    scan = {(r["prefix"], r["platform_code"]): r["object_name"] for r in evidence_scan_fallback(rows, pages).collect()}
    found = {(r["prefix"], r["platform_code"]): r["object_name"] for r in code_index.find_codes(rows, index).collect()}
    assert found == {k: v for k, v in scan.items() if re.fullmatch("[0-9A-Za-z]{4,}", k[1])} and found["c1", "2CD3"] == "o2"
    out = code_index.resolve_rows(rows, index, F.col("expected"), pages=pages).collect()
    assert len(out) == rows.count()
    for r in out:
        by_name = r["platform_code"] == "QQ77" and r["prefix"] == "c2"
        assert (r["object_name"], r["resolved_by"]) == (("o1", "name") if by_name else (scan.get((r["prefix"], r["platform_code"])), "content" if (r["prefix"], r["platform_code"]) in scan else None))


def test_search_reads_no_page_text(spark, indexed):
    _, index = indexed
    rows = spark.createDataFrame([("c1", "AB12CD34", "?")], "prefix string, platform_code string, expected string")
    plan = code_index.resolve_rows(rows, index, F.col("expected"))._jdf.queryExecution().explainString(
        rows.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "html" not in plan and "Bucketed: true" in plan

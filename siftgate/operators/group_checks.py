"""Group checks: conditions on a whole crawl or run.

Checks that count rows (row_count_min, contains_all, share_max of one value) are plain conditional
counts: all of them share one aggregate per crawl, and run-scope rules add up its rows. Checks on the
spread of values (share_max, distinct_min, contiguous) count rows per value first and fold those counts
per group. Either way rows are combined before every shuffle and a group that holds a third of all rows
reaches a task as counts, never as rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any, Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from siftgate.functions.values import Field, count_where
from siftgate.operators.row_checks import ENTRY, RULE_NO, Bound, Entries, rule_ids, same_kind
from siftgate.plans.rules import Rule, RuleError, RuleSet, crawl_columns, field_of
from siftgate.sources.storage import materialise

GROUP_CHECKS: dict[str, "GroupCheck | OpaqueGroup"] = {}

RUN = "_run"          # true for a run-scope group
VALUE = "_value"
ROWS = "_rows"

# Values per bucket in the search for gaps: the rows one task sorts at a time.
GAP_BUCKET = 1 << 20


@dataclass(frozen=True)
class GroupCheck:
    """``tally(field, params)`` says what is counted: a list of (label, condition) for conditional
    counts, or one Column, the value key, for counts per value. ``ok`` and ``detail`` judge the
    folded counts, given (measures, params)."""

    tally: Callable[[Field | None, dict], "list[tuple[str, Column]] | Column"]
    ok: Callable[["Measures", dict], Column]
    detail: Callable[["Measures", dict], Column]


@dataclass(frozen=True)
class OpaqueGroup:
    """A check on mergeable states (``operators.opaque_checks``), which gives its verdict itself. ``fold`` judges the groups
    of all rules of this kind."""

    check: Any
    fold: Callable[[DataFrame, list, list[str]], DataFrame]

    def tally(self, fld: Field | None, params: dict) -> "OpaqueGroup":
        _column(fld)
        return self

    @staticmethod
    def ok(m: "Measures", params: dict) -> Column:
        return F.col("_ok")

    @staticmethod
    def detail(m: "Measures", params: dict) -> Column:
        return F.col("_detail")


class Measures:
    """Columns available to judge a group. ``value_rows`` counts the rows with a value, or those that
    meet the first condition; ``missing`` lists the labels of conditions that no row meets."""

    def __init__(self):
        self.rows = F.col("group_rows")
        self.top_rows = F.col("top_rows")
        self.top_value = F.col("top_value")
        self.distinct = F.col("distinct_values")
        self.value_rows = F.col("value_rows")
        self.low = F.col("low")
        self.high = F.col("high")
        self.missing = F.col("missing")


MEASURES = ["group_rows", "top_value", "top_rows", "distinct_values", "value_rows", "low", "high", "missing"]


def group_check(name: str, **parts):
    """Register a group check under a name usable in rule files."""
    GROUP_CHECKS[name] = GroupCheck(**parts)


def _column(fld: Field | None) -> Field:
    if fld is None:
        raise RuleError("this group check needs a column")
    return fld


def value_text(fld: Field | None, params: dict) -> Column:
    fld = _column(fld)
    # adding 0.0 merges the two zeros, which print differently
    return (fld.col + F.lit(0.0)).cast("string") if fld.is_float else fld.text


def _equals(fld: Field, value: Any) -> Column:
    if value is not None and not same_kind(value, fld):
        return F.lit(False)
    return fld.col.eqNullSafe(F.lit(value))


def _share_tally(fld: Field | None, params: dict):
    if "value" not in params:
        return value_text(fld, params)
    return [(str(params["value"]), _equals(_column(fld), params["value"]))]


def _share_top(m: Measures, params: dict) -> Column:
    return m.value_rows if "value" in params else m.top_rows


def percent(share: Column) -> Column:
    return F.concat(F.bround(share * 100, 0).cast("long").cast("string"), F.lit("%"))


def _share_detail(m: Measures, params: dict) -> Column:
    name = F.lit(str(params["value"])) if "value" in params else F.coalesce(m.top_value, F.lit("nan"))
    return F.concat(F.lit("value '"), F.substring(name, 1, 80), F.lit("' covers "),
                    percent(_share_top(m, params) / m.rows), F.lit(" of "), m.rows.cast("string"),
                    F.lit(" rows (max allowed "), percent(F.lit(float(params["max_share"]))), F.lit(")"))


def _wanted(fld: Field | None, params: dict):
    fld = _column(fld)
    return [(str(v), _equals(fld, v)) for v in sorted(set(params["value"]), key=str)]


group_check(
    "share_max", tally=_share_tally, detail=_share_detail,
    ok=lambda m, p: (_share_top(m, p) / m.rows) <= F.lit(float(p["max_share"])))
group_check(
    "distinct_min", tally=value_text,
    ok=lambda m, p: m.distinct >= F.lit(p["min"]),
    detail=lambda m, p: F.concat(m.distinct.cast("string"), F.lit(f" distinct values (min {p['min']})")))
group_check(
    "contiguous", tally=lambda fld, p: _column(fld).number.cast("long").cast("string"),
    ok=lambda m, p: (m.value_rows == 0) | ((m.value_rows == m.distinct) & (m.low == 1) & (m.high == m.value_rows)),
    detail=lambda m, p: F.concat(m.value_rows.cast("string"), F.lit(" ranks, expected 1.."),
                                 m.value_rows.cast("string"), F.lit(" contiguous")))
group_check(
    "row_count_min", tally=lambda fld, p: [],
    ok=lambda m, p: m.rows >= F.lit(p["min"]),
    detail=lambda m, p: F.concat(m.rows.cast("string"), F.lit(f" rows (min {p['min']})")))
group_check(
    "contains_all", tally=_wanted,
    ok=lambda m, p: F.size(m.missing) == 0,
    detail=lambda m, p: F.when(F.size(m.missing) == 0,
                               F.lit(f"All {len(set(p['value']))} required values are present."))
    .otherwise(F.concat(F.lit("Missing required values: ["), F.array_join(m.missing, ", "), F.lit("]"))))


def _check_of(rule: Rule) -> "GroupCheck | OpaqueGroup":
    if rule.check not in GROUP_CHECKS:
        raise RuleError(f"rule {rule.id!r} names unknown group check {rule.check!r}")
    return GROUP_CHECKS[rule.check]


Numbered = list[tuple[int, Bound, Any]]


# ------------------------------------------------------------------ one scan for all rules

ROW_NO = -1           # number of the tuple that carries a row's flags
WORD = 60             # flags in one long


@dataclass(frozen=True)
class Tally:
    """Counts of one scan, from which row rules and group rules of all kinds are judged.

    Every row gives one tuple with a bit for each condition that it meets and one tuple for each value rule that it is under.
    Equal tuples of a crawl are counted, so a crawl arrives as a row per combination of conditions and per value.
    """

    df: DataFrame
    bits: dict[tuple, int]

    @classmethod
    def of(cls, ready: DataFrame, flags: dict[tuple, Column], valued: Numbered, keys: list[str]) -> "Tally":
        tests = list(flags.values())
        words = [sum((F.when(t, F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long")) for i, t in enumerate(tests[at:at + WORD])), F.lit(0).cast("long"))
                 for at in range(0, len(tests), WORD)]
        names = [f"w{j}" for j in range(len(words))]
        own = F.struct(F.lit(ROW_NO).alias("no"), F.lit(False).alias("run"), F.lit(None).cast("string").alias("value"), *[w.alias(n) for w, n in zip(words, names)])
        each = [F.when(b.applies, F.struct(F.lit(n).alias("no"), F.lit(b.rule.scope != "crawl").alias("run"), value.alias("value"),
                                           *[F.lit(0).cast("long").alias(w) for w in names])) for n, b, value in valued]
        t = ready.select(ENTRY, *keys, F.explode(F.array(own, *each)).alias("t")).where(F.col("t").isNotNull())
        df = (t.select(ENTRY, F.col("t.no").alias(RULE_NO), F.col("t.run").alias(RUN), *[F.when(~F.col("t.run"), F.col(k)).alias(k) for k in keys],
                       F.col("t.value").alias(VALUE), *[F.col(f"t.{n}").alias(n) for n in names])
              .groupBy(ENTRY, RULE_NO, RUN, *keys, VALUE, *names).agg(F.count(F.lit(1)).alias(ROWS)))
        return cls(materialise(df), {key: i for i, key in enumerate(flags)})

    def rows(self) -> DataFrame:
        return self.df.where(F.col(RULE_NO) == ROW_NO)

    def values(self, rules: Numbered, keys: list[str]) -> DataFrame:
        return self.df.where(F.col(RULE_NO).isin([n for n, _, _ in rules])).select(ENTRY, RULE_NO, RUN, *keys, VALUE, ROWS)

    def count(self, key: tuple) -> Column:
        word, bit = divmod(self.bits[key], WORD)
        met = F.col(f"w{word}").bitwiseAND(F.lit(1 << bit).cast("long")) != 0
        return F.coalesce(F.sum(F.when(met, F.col(ROWS))), F.lit(0))


def group_flags(rules: Numbered) -> dict[tuple, Column]:
    """The conditions that conditional-count rules count."""
    out = {}
    for n, b, tests in rules:
        out["g", n] = b.applies
        out |= {("h", n, k): b.applies & test for k, (_, test) in enumerate(tests)}
    return out


def counted_groups(ready: DataFrame, rules: Numbered, keys: list[str], tally: Tally | None = None) -> DataFrame:
    """Groups of the conditional-count rules, all from one aggregate."""
    crawl = [n for n, b, _ in rules if b.rule.scope == "crawl"]
    run = [n for n, b, _ in rules if b.rule.scope != "crawl"]
    by = keys if crawl else []
    width = max(len(tests) for _, _, tests in rules)
    name = lambda key: "_".join(map(str, key)).replace("_", "", 1)
    if tally:
        wide = tally.rows().groupBy(ENTRY, *by).agg(*[tally.count(key).alias(name(key)) for key in group_flags(rules)])
    else:
        wide = ready.groupBy(ENTRY, *by).agg(*[count_where(test).alias(name(key)) for key, test in group_flags(rules).items()])
    tall = wide.select(ENTRY, *by, F.explode(F.array(*[F.struct(
        F.lit(n).alias("no"), F.col(f"g{n}").alias("g"),
        *[(F.col(f"h{n}_{k}") if k < len(tests) else F.lit(0).cast("long")).alias(f"h{k}") for k in range(width)])
        for n, b, tests in rules])).alias("r")).where(F.col("r.g") > 0)
    parts = []
    if crawl:
        parts.append(tall.where(F.col("r.no").isin(crawl)).select(
            ENTRY, F.col("r.no").alias(RULE_NO), F.lit(False).alias(RUN), *keys, F.col("r.g").alias("group_rows"),
            *[F.col(f"r.h{k}").alias(f"h{k}") for k in range(width)]))
    if run:
        nothing = [F.lit(None).cast(ready.schema[k].dataType).alias(k) for k in keys]
        parts.append(tall.where(F.col("r.no").isin(run)).groupBy(ENTRY, F.col("r.no").alias(RULE_NO)).agg(
            F.sum("r.g").alias("group_rows"), *[F.sum(f"r.h{k}").alias(f"h{k}") for k in range(width)])
            .select(ENTRY, RULE_NO, F.lit(True).alias(RUN), *nothing, "group_rows", *[f"h{k}" for k in range(width)]))
    groups = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    missing = F.array().cast("array<string>")
    for n, _, tests in rules:
        if tests:
            absent = F.array_compact(F.array(*[F.when(F.col(f"h{k}") == 0, F.lit(label))
                                               for k, (label, _) in enumerate(tests)]))
            missing = F.when(F.col(RULE_NO) == n, absent).otherwise(missing)
    return groups.select(
        ENTRY, RULE_NO, RUN, *keys, "group_rows", F.lit(None).cast("string").alias("top_value"),
        F.lit(None).cast("long").alias("top_rows"), F.lit(None).cast("long").alias("distinct_values"),
        (F.col("h0") if width else F.lit(None).cast("long")).alias("value_rows"),
        F.lit(None).cast("long").alias("low"), F.lit(None).cast("long").alias("high"), missing.alias("missing"))


def valued_groups(ready: DataFrame, rules: Numbered, keys: list[str], tally: Tally | None = None) -> DataFrame:
    """Groups of the value rules: rows per (rule, group, value), then folded per (rule, group)."""
    ranks = [n for n, b, _ in rules if b.rule.check == "contiguous"]
    tuples = None
    if tally:
        pass
    elif len(rules) == 1:  # a guard of one rule can reach the scan
        n, b, value = rules[0]
        crawl = b.rule.scope == "crawl"
        tuples = ready.where(b.applies).select(
            ENTRY, F.lit(n).alias(RULE_NO), F.lit(not crawl).alias(RUN),
            *[F.col(k) if crawl else F.lit(None).cast(ready.schema[k].dataType).alias(k) for k in keys],
            value.alias(VALUE))
    else:
        each = F.array(*[F.when(b.applies, F.struct(
            F.lit(n).alias("no"), F.lit(b.rule.scope != "crawl").alias("run"), value.alias("value")))
            for n, b, value in rules])
        t = ready.select(ENTRY, *keys, F.explode(each).alias("t")).where(F.col("t").isNotNull())
        tuples = t.select(ENTRY, F.col("t.no").alias(RULE_NO), F.col("t.run").alias(RUN),
                          *[F.when(~F.col("t.run"), F.col(k)).alias(k) for k in keys], F.col("t.value").alias(VALUE))
    value, n = F.col(VALUE), F.col(ROWS)
    # only rank keys are numbers; a failing cast of other keys would cost an exception each
    number = F.when(F.col(RULE_NO).isin(ranks), value.try_cast("long")) if ranks else F.lit(None).cast("long")
    counts = tally.values(rules, keys) if tally else tuples.groupBy(ENTRY, RULE_NO, RUN, *keys, VALUE).agg(F.count(F.lit(1)).alias(ROWS))
    # most frequent value; ties go to the smallest value, null last. Left out where no rule asks for
    # it: without this struct the aggregate hashes instead of sorting.
    top = [F.min(F.struct((-n).alias("n"), value.isNull().alias("z"), value.alias("v"))).alias("top")]
    if all(b.rule.check in ("distinct_min", "contiguous") for _, b, _ in rules):
        top = []
    folded = counts.groupBy(ENTRY, RULE_NO, RUN, *keys).agg(
        F.sum(n).alias("group_rows"), *top, F.count(value).alias("distinct_values"),
        F.coalesce(F.sum(F.when(value.isNotNull(), n)), F.lit(0)).alias("value_rows"),
        F.min(number).alias("low"), F.max(number).alias("high"))
    best = ([F.col("top.v").alias("top_value"), (-F.col("top.n")).alias("top_rows")] if top else
            [F.lit(None).cast("string").alias("top_value"), F.lit(None).cast("long").alias("top_rows")])
    return folded.select(ENTRY, RULE_NO, RUN, *keys, "group_rows", *best, "distinct_values", "value_rows", "low", "high",
                         F.array().cast("array<string>").alias("missing"))


def numbered_rules(schema, bound: list[Bound]) -> tuple[Numbered, Numbered]:
    """Conditional-count rules and value rules, with their numbers and what they count."""
    numbered = [(n, b, _check_of(b.rule).tally(field_of(schema, b.rule), b.rule.params)) for n, b in enumerate(bound)]
    return [x for x in numbered if isinstance(x[2], list)], [x for x in numbered if isinstance(x[2], Column)]


def opaque_groups(ready: DataFrame, rules: Numbered, keys: list[str]) -> DataFrame:
    """Groups of opaque rules in the form of the others, with their own verdicts."""
    judged = rules[0][2].fold(ready, [(n, b, held.check) for n, b, held in rules], keys)
    nothing = {"top_value": "string", "top_rows": "long", "distinct_values": "long", "value_rows": "long", "low": "long", "high": "long"}
    return judged.select(ENTRY, RULE_NO, RUN, *keys, "group_rows", *[F.lit(None).cast(t).alias(c) for c, t in nothing.items()],
                         F.array().cast("array<string>").alias("missing"), "_ok", "_detail")


def group_results(df: DataFrame, rules, as_of=None, platform_column: str | None = None, tally: Tally | None = None):
    """Every judged group with its measures. Returns (results, bound rules, crawl keys, entries).

    Rules of both kinds share one scan by way of a tally, written once; rules of one kind are one lazy aggregate.
    """
    entries = Entries.of(rules, platform_column)
    ready = entries.prepare(df)
    bound = entries.bind(ready.schema, False, as_of)
    if not bound:
        raise RuleError("no group rules")
    keys = crawl_columns(df.columns, entries.crawl_key)
    counted, valued = numbered_rules(ready.schema, bound)
    if counted and valued and tally is None:
        tally = Tally.of(ready, group_flags(counted), valued, keys)
    parts = [make(ready, some, keys, tally) for make, some in ((counted_groups, counted), (valued_groups, valued)) if some]
    opaque = [(n, b, _check_of(b.rule)) for n, b in enumerate(bound) if isinstance(_check_of(b.rule), OpaqueGroup)]
    parts = [p.withColumns({"_ok": F.lit(None).cast("boolean"), "_detail": F.lit(None).cast("string")}) for p in parts]
    if opaque:
        parts.append(opaque_groups(ready, opaque, keys))
    groups = parts[0]
    for p in parts[1:]:
        groups = groups.unionByName(p)
    m = Measures()
    ok, detail = F.lit(None).cast("boolean"), F.lit(None).cast("string")
    for n, b in enumerate(bound):
        check = _check_of(b.rule)
        ok = F.when(F.col(RULE_NO) == n, check.ok(m, b.rule.params)).otherwise(ok)
        detail = F.when(F.col(RULE_NO) == n, check.detail(m, b.rule.params)).otherwise(detail)
    return groups.select("*", ok.alias("ok"), detail.alias("detail")).drop("_ok", "_detail"), bound, keys, entries


def group_rule_set(df: DataFrame, rules, as_of=None, platform_column: str | None = None) -> DataFrame:
    """One row per (rule, group) with the verdict and the measures behind it."""
    res, bound, keys, entries = group_results(df, rules, as_of, platform_column)
    return res.select(F.lit(entries.dataset).alias("dataset"), F.col(ENTRY).alias("platform_entry"),
                      rule_ids(bound, F.col(RULE_NO)).alias("rule_id"), F.col(RUN).alias("run_scope"), *keys,
                      "ok", *MEASURES, "detail")


def single(df: DataFrame, check: str, column: str | None, params: dict, crawl_key: list[str],
           when: str | None = None) -> DataFrame:
    """One group check without a rule file. No crawl key means one group."""
    rule = Rule(check, check, column, params, "crawl", when)
    return group_rule_set(df, RuleSet("t", "t", tuple(crawl_key), (rule,)))


def contiguous_gaps(df: DataFrame, column: str, crawl_key: list[str], first: int = 5) -> DataFrame:
    """The first missing numbers of 1..n per group, n being its count of values.

    Sorted neighbours are compared inside value buckets, then bucket borders are compared, so a
    single group with billions of ranks is never sorted by one task. One output row per gap number.
    """
    keys = crawl_columns(df.columns, crawl_key)
    fld = Field(column, df.schema[column].dataType)
    counted = (df.select(*keys, fld.number.cast("long").alias("v")).where(F.col("v").isNotNull())
               .groupBy(*keys, "v").agg(F.count(F.lit(1)).alias("n")))
    sizes = counted.groupBy(*keys).agg(F.sum("n").alias("upto"), F.count(F.lit(1)).alias("d"),
                                       F.min("v").alias("low"), F.max("v").alias("high"))
    broken = sizes.where(~((F.col("upto") == F.col("d")) & (F.col("low") == 1) & (F.col("high") == F.col("upto"))))
    right = broken.select(*[F.col(k).alias(f"_r_{k}") for k in keys], "upto")
    match = F.lit(True)
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    values = (counted.join(right, match).drop(*[f"_r_{k}" for k in keys])
              .where((F.col("v") >= 1) & (F.col("v") <= F.col("upto")))
              .withColumn("b", F.floor((F.col("v") - 1) / GAP_BUCKET)))
    inside = Window.partitionBy(*keys, "b").orderBy("v")
    steps = values.select(*keys, "upto", "v", F.lead("v").over(inside).alias("nxt"))
    within = steps.where(F.col("nxt") > F.col("v") + 1).select(
        *keys, (F.col("v") + 1).alias("a"), (F.col("nxt") - 1).alias("z"))
    borders = values.groupBy(*keys, "b").agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    per_group = Window.partitionBy(*keys).orderBy("b")
    between = (borders.select(*keys, (F.lag("hi", 1, 0).over(per_group) + 1).alias("a"),
                              (F.col("lo") - 1).alias("z")).where(F.col("z") >= F.col("a")))
    # the tail after the last value, and groups with no value inside 1..n at all
    last = values.groupBy(*keys).agg(F.max("v").alias("last"))
    lk = last.select(*[F.col(k).alias(f"_r_{k}") for k in keys], "last")
    tail = (broken.join(lk, match, "left").select(
        *keys, (F.coalesce(F.col("last"), F.lit(0)) + 1).alias("a"), F.col("upto").alias("z"))
        .where(F.col("z") >= F.col("a")))
    numbers = within.unionByName(between).unionByName(tail).select(
        *keys, F.explode(F.sequence("a", F.least(F.col("z"), F.col("a") + first - 1))).alias("gap"))
    rank = Window.partitionBy(*keys).orderBy("gap")
    return numbers.withColumn("gap_no", F.row_number().over(rank)).where(F.col("gap_no") <= first)

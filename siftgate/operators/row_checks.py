"""Row checks as Column builders, and the one-scan evaluation of a whole rule set.

A builder takes (field, params, as_of) and returns a boolean Column that is never null:
true where the row passes. Missing values pass everything except not_null and constant.
"""

from __future__ import annotations

import datetime as dt
import re
import json
from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame, functions as F, types as T

from siftgate.functions.values import Field, count_where, null_normalise, to_instant
from siftgate.plans.rules import Rule, RuleError, RuleSet, field_of, guard, predicate

ROW_CHECKS: dict[str, Callable[..., Column]] = {}

# Columns the engine adds next to the table's own.
ENTRY = "_entry"
RULE_NO = "_rule_no"


def row_check(name: str):
    """Register a row check under a name usable in rule files."""
    def keep(fn):
        ROW_CHECKS[name] = fn
        return fn
    return keep


def _needs_column(fld: Field | None, name: str) -> Field:
    if fld is None:
        raise RuleError(f"check {name!r} needs a column")
    return fld


def _needs_stable_text(fld: Field, name: str) -> None:
    if fld.is_float:
        raise RuleError(f"check {name!r} on float column {fld.name!r}: number formatting is engine-specific")


def same_kind(value, fld: Field) -> bool:
    """Whether a rule literal is comparable with the column without a hidden cast."""
    if isinstance(value, bool):
        return isinstance(fld.dtype, T.BooleanType)
    if isinstance(value, str):
        return fld.is_string
    if isinstance(value, (int, float)):
        return isinstance(fld.dtype, T.NumericType)
    if isinstance(value, dt.datetime):
        return isinstance(fld.dtype, (T.TimestampType, T.TimestampNTZType))
    if isinstance(value, dt.date):
        return isinstance(fld.dtype, T.DateType)
    return False


def python_pattern(pattern: str) -> str:
    """The same search in Java: newline-only line ends, Unicode classes, named groups, absolute text end."""
    pattern = re.sub(r"\(\?P=(\w+)\)", r"\\k<\1>", pattern.replace("(?P<", "(?<"))
    return "(?dU)" + re.sub(r"\\(.)", lambda m: r"\z" if m[1] == "Z" else m[0], pattern, flags=re.S)


@row_check("not_null")
def not_null(fld, params, as_of=None):
    return _needs_column(fld, "not_null").present


@row_check("must_null")
def must_null(fld, params, as_of=None):
    return ~_needs_column(fld, "must_null").present


@row_check("constant")
def constant(fld, params, as_of=None):
    fld = _needs_column(fld, "constant")
    if not same_kind(params["value"], fld):
        raise RuleError(f"constant {params['value']!r} has another type than column {fld.name!r}")
    return F.coalesce(fld.col == F.lit(params["value"]), F.lit(False))


@row_check("regex")
def regex(fld, params, as_of=None):
    fld = _needs_column(fld, "regex")
    _needs_stable_text(fld, "regex")
    return ~fld.present | F.coalesce(fld.text.rlike(python_pattern(params["pattern"])), F.lit(False))


@row_check("range")
def range_check(fld, params, as_of=None):
    fld = _needs_column(fld, "range")
    inside = F.lit(True)
    if params.get("min") is not None:
        inside = inside & (fld.number >= F.lit(float(params["min"])))
    if params.get("max") is not None:
        inside = inside & (fld.number <= F.lit(float(params["max"])))
    return ~fld.present | F.coalesce(inside, F.lit(False))


@row_check("length")
def length(fld, params, as_of=None):
    fld = _needs_column(fld, "length")
    _needs_stable_text(fld, "length")
    inside = F.lit(True)
    if params.get("min") is not None:
        inside = inside & (F.length(fld.text) >= params["min"])
    if params.get("max") is not None:
        inside = inside & (F.length(fld.text) <= params["max"])
    return ~fld.present | F.coalesce(inside, F.lit(False))


@row_check("allowed_values")
def allowed_values(fld, params, as_of=None):
    fld = _needs_column(fld, "allowed_values")
    values = [v for v in params["values"] if same_kind(v, fld)]
    member = F.coalesce(fld.col.isin(values), F.lit(False)) if values else F.lit(False)
    return ~fld.present | member


@row_check("compare")
def compare(fld, params, as_of=None):
    return F.coalesce(predicate(params["expr"]).cast("boolean"), F.lit(True))


@row_check("freshness")
def freshness(fld, params, as_of=None):
    fld = _needs_column(fld, "freshness")
    if as_of is None:
        raise RuleError("freshness needs as_of: results must not depend on the wall clock")
    now = as_of if isinstance(as_of, Column) else F.lit(str(as_of)).cast("timestamp")
    age_hours = (F.unix_micros(now) - F.unix_micros(to_instant(fld.col, fld.dtype))) / F.lit(3.6e9)
    return ~fld.present | F.coalesce(age_hours <= F.lit(float(params["max_age_hours"])), F.lit(False))


def outside_table(df: DataFrame, column: str, allowed: DataFrame) -> DataFrame:
    """Rows with a present value missing from a table of allowed values.

    For lists too long for a literal. ``allowed`` has one column; Spark picks the join.
    """
    fld = Field(column, df.schema[column].dataType)
    keys = allowed.select(F.col(allowed.columns[0]).alias(column)).where(F.col(column).isNotNull())
    return df.where(fld.present).join(keys, column, "left_anti")


def passes(schema: T.StructType, rule: Rule, as_of=None) -> Column:
    if rule.check not in ROW_CHECKS:
        raise RuleError(f"rule {rule.id!r} names unknown row check {rule.check!r}")
    return ROW_CHECKS[rule.check](field_of(schema, rule), rule.params, as_of)


# ------------------------------------------------------------------ rule sets over one scan

@dataclass(frozen=True)
class Bound:
    """A rule bound to a table: which entries it covers, its guard and its failure condition."""

    rule: Rule
    entries: tuple[str, ...]
    applies: Column
    fails: Column | None


@dataclass(frozen=True)
class Entries:
    """One or more (dataset, platform) rule sets that read the same table.

    With one rule set every row belongs to it. With several, ``platform_column`` says which
    rule set a row belongs to, so the table is scanned once and not once per platform.
    """

    rulesets: tuple[RuleSet, ...]
    platform_column: str | None = None

    @classmethod
    def of(cls, rules: "RuleSet | list[RuleSet] | Entries", platform_column: str | None = None) -> "Entries":
        if isinstance(rules, Entries):
            return rules
        sets = (rules,) if isinstance(rules, RuleSet) else tuple(rules)
        if len({(s.dataset, s.crawl_key) for s in sets}) != 1:
            raise RuleError("rule sets of one scan must share dataset and crawl key")
        if len(sets) > 1 and platform_column is None:
            raise RuleError("several rule sets need a platform column")
        return cls(sets, platform_column)

    @property
    def dataset(self) -> str:
        return self.rulesets[0].dataset

    @property
    def crawl_key(self) -> tuple[str, ...]:
        return self.rulesets[0].crawl_key

    @property
    def platforms(self) -> list[str]:
        return [s.platform for s in self.rulesets]

    def prepare(self, df: DataFrame) -> DataFrame:
        """NaN to null, rows of no entry dropped, and the entry column added."""
        df = null_normalise(df)
        if self.platform_column is None:
            return df.withColumn(ENTRY, F.lit(self.rulesets[0].platform))
        return (df.where(F.col(self.platform_column).isin(self.platforms))
                .withColumn(ENTRY, F.col(self.platform_column)))

    def bind(self, schema: T.StructType, scope_rows: bool, as_of=None) -> list[Bound]:
        shared: dict[tuple, tuple[Rule, list[str]]] = {}
        for s in self.rulesets:
            for r in (s.row_rules() if scope_rows else s.group_rules()):
                shared.setdefault(r.definition, (r, []))[1].append(s.platform)
        bound = []
        for rule, platforms in shared.values():
            applies = guard(rule)
            if len(platforms) < len(self.rulesets):
                applies = F.col(ENTRY).isin(platforms) & applies
            fails = (applies & ~passes(schema, rule, as_of)) if scope_rows else None
            bound.append(Bound(rule, tuple(platforms), applies, fails))
        return bound


FACTS = ("rule_id string, column string, check string, scope string, severity string, on_fail string, "
         "description string, force_escalate_above double")


def rule_facts(bound: list[Bound], number: Column) -> Column:
    """Rule attributes as a struct, looked up by number in a literal table: no join, no broadcast."""
    table = [{**{k: getattr(b.rule, k) for k in ("column", "check", "scope", "severity", "on_fail", "description",
                                                 "force_escalate_above")}, "rule_id": b.rule.id} for b in bound]
    return F.from_json(F.lit(json.dumps(table)), f"array<struct<{FACTS.replace(' ', ':').replace(',:', ', ')}>>")[number]


def rule_ids(bound: list[Bound], number: Column) -> Column:
    quoted = (b.rule.id.replace("\\", "\\\\").replace("'", "\\'") for b in bound)
    return F.expr("array(" + ", ".join(f"'{q}'" for q in quoted) + ")")[number]


def row_rule_set(df: DataFrame, rules, as_of=None, keep: list[str] | None = None,
                 platform_column: str | None = None) -> DataFrame:
    """Failing rows, one output row per (row, failed rule), from a single scan without a shuffle.

    ``keep`` names the columns to carry along (default: all). Works on streams too.
    """
    entries = Entries.of(rules, platform_column)
    ready = entries.prepare(df)
    bound = entries.bind(ready.schema, True, as_of)
    cols = keep if keep is not None else df.columns
    if not bound:
        raise RuleError("no row rules")
    failed = F.array_remove(F.array(*[F.when(b.fails, i).otherwise(-1) for i, b in enumerate(bound)]), -1)
    tagged = ready.select(F.col(ENTRY), *[F.col(c) for c in cols], F.explode(failed).alias(RULE_NO))
    return tagged.select(F.lit(entries.dataset).alias("dataset"), F.col(ENTRY).alias("platform_entry"),
                         rule_ids(bound, F.col(RULE_NO)).alias("rule_id"), *[F.col(c) for c in cols])


def failing_counts(df: DataFrame, rules, as_of=None, platform_column: str | None = None) -> DataFrame:
    """Guarded, passing and failing rows per rule: one scan, one row per task shuffled."""
    entries = Entries.of(rules, platform_column)
    ready = entries.prepare(df)
    bound = entries.bind(ready.schema, True, as_of)
    wide = ready.groupBy(ENTRY).agg(*[
        c for i, b in enumerate(bound)
        for c in (count_where(b.applies).alias(f"g{i}"), count_where(b.fails).alias(f"f{i}"))])
    rows = F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"g{i}").alias("g"), F.col(f"f{i}").alias("f"))
                     for i, _ in enumerate(bound)])
    covered = F.array(*[F.array(*[F.lit(p) for p in b.entries]) for b in bound])
    return (wide.select(ENTRY, F.explode(rows).alias("r"))
            .where(F.array_contains(covered[F.col("r.i")], F.col(ENTRY)))
            .select(F.lit(entries.dataset).alias("dataset"), F.col(ENTRY).alias("platform"),
                    rule_ids(bound, F.col("r.i")).alias("rule_id"), F.col("r.g").alias("guarded"),
                    (F.col("r.g") - F.col("r.f")).alias("passed"), F.col("r.f").alias("failed")))

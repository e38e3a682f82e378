"""Checks and page functions written in Python, reachable by name from rule files like the built-in ones.

Row checks get a column's values as an Arrow array and answer true where a row passes; they run in batches next to the
other rules of the same scan. Group checks are a state that grows by values and merges: each task folds its own rows of a
group, and only states are shuffled, so a group of any size is judged by a few small states. Page functions turn one page
into rows. Built-in checks stay column expressions; these are for logic that expressions cannot state.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from siftgate.functions.values import Field
from siftgate.operators.group_checks import GROUP_CHECKS, RUN, OpaqueGroup
from siftgate.operators.row_checks import ENTRY, ROW_CHECKS, RULE_NO
from siftgate.plans.rules import RuleError

STATES = 50_000  # groups whose state a task holds before it hands them on
PAGE_FUNCTIONS: dict[str, tuple[Callable[..., Iterable[tuple]], str]] = {}


def opaque_row_check(name: str, missing_passes: bool = True):
    """Register ``fn(values: pa.Array, params) -> pa.Array`` of booleans as a row check. A null answer fails; missing values
    pass unless said otherwise. The function sees rows outside the rule's guard too: guards only decide what counts."""
    def keep(fn):
        def build(fld: Field | None, params: dict, as_of=None) -> Column:
            if fld is None:
                raise RuleError(f"check {name!r} needs a column")

            def judge(values: pa.Array) -> pa.Array:
                return fn(values, params)

            passed = F.coalesce(F.arrow_udf(judge, "boolean")(fld.col), F.lit(False))
            return ~fld.present | passed if missing_passes else passed

        ROW_CHECKS[name] = build
        return fn
    return keep


def opaque_group_check(name: str):
    """Register a class as a group check: ``start() -> state``, ``add(state, values: pa.Array, params) -> state``,
    ``merge(state, state) -> state``, ``verdict(state, params) -> (ok, detail)``. States are JSON values; the order in which
    values come and states merge must not matter."""
    def keep(cls):
        GROUP_CHECKS[name] = OpaqueGroup(cls(), state_groups)
        return cls
    return keep


def state_groups(ready: DataFrame, rules: list, keys: list[str]) -> DataFrame:
    """Groups of opaque rules with their verdicts: (entry, rule, run scope, keys, group_rows, _ok, _detail)."""
    names = [f"_c{n}" for n, _, _ in rules]
    key_types = [ready.schema[k] for k in keys]
    plain = [(n, b.rule.scope == "crawl", check, b.rule.params) for n, b, check in rules]
    rows = ready.select(ENTRY, F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}).alias("_key") if keys else F.lit("{}").alias("_key"), *keys,
                        *[b.applies.alias(f"_a{n}") for n, b, _ in rules], *[F.col(b.rule.column).alias(c) for (_, b, _), c in zip(rules, names)])
    schema = T.StructType([rows.schema[ENTRY], T.StructField(RULE_NO, T.IntegerType()), T.StructField(RUN, T.BooleanType()), *key_types,
                           T.StructField("_n", T.LongType()), T.StructField("_state", T.StringType())])

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states: dict[tuple, list] = {}

        def handed() -> pa.RecordBatch:
            out = [(entry, n, not crawl, *(group or [None] * len(keys)), count, json.dumps(state))
                   for (entry, n, crawl, _), (group, count, state) in states.items()]
            states.clear()
            arrow = to_arrow_schema(schema)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)

        from pyspark.sql.pandas.types import to_arrow_schema
        for batch in batches:
            table = pa.Table.from_batches([batch])
            index = pa.array(range(batch.num_rows))
            for n, crawl, check, params in plain:
                under = table.append_column("_i", index).filter(table[f"_a{n}"])
                by = [ENTRY, "_key"] if crawl else [ENTRY]
                for group in under.select([*by, "_i"]).group_by(by).aggregate([("_i", "list")]).to_pylist():
                    part = table.take(pa.array(group["_i_list"]))
                    key = (group[ENTRY], n, crawl, group.get("_key"))
                    if key not in states:
                        states[key] = [[part[k][0].as_py() for k in keys] if crawl else None, 0, check.start()]
                    held = states[key]
                    held[1] += part.num_rows
                    held[2] = check.add(held[2], part[f"_c{n}"].combine_chunks(), params)
            if len(states) > STATES:
                yield handed()
        if states:
            yield handed()

    checks = {n: (check, params) for n, _, check, params in plain}

    def merged(numbers: pa.Array, rows: pa.Array, states: pa.Array) -> pa.Scalar:
        check, params = checks[numbers[0].as_py()]
        parts = [json.loads(s.as_py()) for s in states]
        whole = parts[0]
        for part in parts[1:]:
            whole = check.merge(whole, part)
        ok, detail = check.verdict(whole, params)
        return pa.scalar(json.dumps({"rows": sum(rows.to_pylist()), "ok": bool(ok), "detail": str(detail)}))

    merged.__annotations__ = {"numbers": pa.Array, "rows": pa.Array, "states": pa.Array, "return": pa.Scalar}  # types, not their names
    judged = (rows.mapInArrow(fold, schema).groupBy(ENTRY, RULE_NO, RUN, *keys)
              .agg(F.arrow_udf(merged, "string")(F.col(RULE_NO), F.col("_n"), F.col("_state")).alias("_verdict")))
    verdict = F.from_json("_verdict", "rows long, ok boolean, detail string")
    return judged.select(ENTRY, RULE_NO, RUN, *keys, verdict["rows"].alias("group_rows"), verdict["ok"].alias("_ok"), verdict["detail"].alias("_detail"))


# ------------------------------------------------------------------ page functions

def page_function(name: str, schema: str):
    """Register ``fn(html, params)`` that yields tuples of ``schema`` for one page."""
    def keep(fn):
        PAGE_FUNCTIONS[name] = (fn, schema)
        return fn
    return keep


def _page_function(name: str) -> tuple[Callable[..., Iterable[tuple]], str]:
    if name not in PAGE_FUNCTIONS:
        raise RuleError(f"unknown page function {name!r}")
    return PAGE_FUNCTIONS[name]


def page_rows(pages: DataFrame, name: str, keep: list[str], params: dict | None = None, html: str = "html") -> DataFrame:
    """The rows of a page function for every page, next to the columns ``keep``: a table function joined sideways. Pages
    without text have no rows."""
    fn, schema = _page_function(name)
    given = params or {}

    class Rows:
        def eval(self, source: Any):
            if source is not None:
                yield from fn(source, given)

    rows = F.udtf(Rows, returnType=schema, useArrow=True)
    view = pages.select(*keep, F.col(html).alias("_html")).alias("_p")
    return view.lateralJoin(rows(F.col("_p._html").outer())).drop("_html")


def _page_check(fld: Field | None, params: dict, as_of=None) -> Column:
    """Row check ``page_function``: the named function yields ``min`` to ``max`` rows for the page in the column."""
    if fld is None:
        raise RuleError("check 'page_function' needs a column")
    fn, _ = _page_function(params["function"])
    low, high = params.get("min", 1), params.get("max")

    def count(pages: pa.Array) -> pa.Array:
        return pa.array([None if p is None else sum(1 for _ in fn(p, params)) for p in pages.to_pylist()], pa.int64())

    n = F.arrow_udf(count, "long")(fld.text)
    inside = n >= low if high is None else n.between(low, high)
    return ~fld.present | F.coalesce(inside, F.lit(False))


ROW_CHECKS["page_function"] = _page_check

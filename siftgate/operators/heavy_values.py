"""Values that hold more than a share of their group, without shuffling every (group, value) pair.

Each task keeps a frequent-items summary per group (mergeable counters, a few per unit of share), and only the summaries
are shuffled. A summary estimates no value below its true count and loses none that has the wanted share, so the values whose
estimate is above it are all there can be. These few are counted exactly in a second pass. Where values are nearly
unique, as product codes or image addresses are, the summaries are what is left of a shuffle as large as the table.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from siftgate.functions.values import Field
from siftgate.operators.group_checks import value_text
from siftgate.plans.rules import crawl_columns

COUNTERS = 8  # per 1 / share: the error stays below a third of the share
MARK = "_mark"


def marked(value: Column) -> Column:
    """A text that also stands for null, which is a value here."""
    return F.concat(F.when(value.isNull(), F.lit("n")).otherwise(F.lit("v")), F.coalesce(value, F.lit("")))


def same_keys(left: list[str], right: list[str]) -> Column:
    out = F.lit(True)
    for a, b in zip(left, right):
        out = out & F.col(a).eqNullSafe(F.col(b))
    return out


def candidates(rows: DataFrame, keys: list[str], share: float) -> DataFrame:
    """Groups (``keys``, ``group_rows``, ``found``): the marks that may hold more than ``share`` of a group."""
    top, held = math.ceil(2 / share) + 1, math.ceil(COUNTERS / share)
    sketch = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("group_rows"), F.expr(f"approx_top_k({MARK}, {top}, {held})").alias("_top"))
    likely = F.filter("_top", lambda x: x["count"] > F.col("group_rows") * share)
    return sketch.select(*keys, "group_rows", F.transform(likely, lambda x: x["item"]).alias("found"))


def heavy_values(df: DataFrame, column: str, by: list[str], share: float) -> DataFrame:
    """``by``, ``column`` (as text), occurrences, group_rows and share of the values above ``share`` of their group, exactly.

    Null is a value. The group keys that the table has are used; with none, all rows are one group.
    """
    keys = crawl_columns(df.columns, by)
    rows = df.select(*keys, marked(value_text(Field(column, df.schema[column].dataType), {})).alias(MARK))
    names = [f"_k_{k}" for k in keys]
    likely = (candidates(rows, keys, share).select(*[F.col(k).alias(n) for k, n in zip(keys, names)], "group_rows", F.explode("found").alias("_m")))
    # few rows: AQE broadcasts them where they are, and else filters the table by their hashes before the join
    counted = (rows.join(likely, same_keys(keys, names) & (F.col(MARK) == F.col("_m"))).groupBy(*keys, MARK, "group_rows")
               .agg(F.count(F.lit(1)).alias("occurrences")))
    value = F.when(F.startswith(F.col(MARK), F.lit("v")), F.expr(f"substring({MARK}, 2)"))
    return (counted.select(*keys, value.alias(column), "occurrences", "group_rows", (F.col("occurrences") / F.col("group_rows")).alias("share"))
            .where(F.col("share") > share))


def share_max_failures(df: DataFrame, column: str, max_share: float, by: list[str]) -> DataFrame:
    """Groups that fail share_max, with their top value: what ``group_rule_set`` gives for the same rule where ok is false.

    Ties go to the smallest value, null last. Groups that pass have no row, so nothing is counted for them.
    """
    keys = crawl_columns(df.columns, by)
    found = heavy_values(df, column, by, max_share)
    top = F.min(F.struct((-F.col("occurrences")).alias("n"), F.col(column).isNull().alias("z"), F.col(column).alias("v")))
    return found.groupBy(*keys, "group_rows").agg(top.alias("t")).select(*keys, F.col("t.v").alias("top_value"), (-F.col("t.n")).alias("top_rows"), "group_rows")

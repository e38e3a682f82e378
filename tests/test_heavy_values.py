"""Heavy values against plain counts, and the rows that the plan shuffles."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from siftgate.operators.group_checks import single
from siftgate.operators.heavy_values import candidates, heavy_values, marked, share_max_failures

SCHEMA = "g string, h int, v string, x double"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(1)
    out = []
    for g, n in (("big", 20000), ("small", 7), ("tie", 40), (None, 300), ("nulls", 30)):
        for i in range(n):
            p = rng.random()
            v = (None if g == "nulls" and i % 3 else "t%d" % (i % 2) if g == "tie" else "heavy" if p < 0.3 else "often" if p < 0.42 else
                 "" if p < 0.55 else f"unique {i}")
            out.append((g, i % 2, v, rng.choice([0.0, -0.0, 1.5, None, float("nan")])))
    return out


@pytest.mark.parametrize("share", [0.05, 0.1, 0.3, 0.5, 0.9])
@pytest.mark.parametrize("by", [["g"], ["g", "h"], ["absent"], []])
def test_against_plain_counts(spark, rows, share, by):
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    key = lambda r: tuple(r[SCHEMA.split(", ").index(next(c for c in SCHEMA.split(", ") if c.startswith(k + " ")))] for k in by if k != "absent")
    sizes, counts = Counter(map(key, rows)), Counter((*key(r), r[2]) for r in rows)
    want = {(*k, n, sizes[k[:-1]]) for k, n in counts.items() if n / sizes[k[:-1]] > share}
    got = [tuple(r)[:-1] for r in heavy_values(df, "v", by, share).collect()]
    assert set(got) == want and len(got) == len(want)


@pytest.mark.parametrize("column", ["v", "x"])
def test_failing_groups_are_those_of_the_group_check(spark, rows, column):
    df = spark.createDataFrame(rows, SCHEMA).na.replace(float("nan"), None, "x") if column == "x" else spark.createDataFrame(rows, SCHEMA)
    whole = single(df, "share_max", column, {"max_share": 0.3}, ["g", "h"]).where("NOT ok").select("g", "h", "top_value", "top_rows", "group_rows")
    found = share_max_failures(df, column, 0.3, ["g", "h"])
    assert sorted(map(str, found.collect())) == sorted(map(str, whole.collect())) and found.count() > 2


def test_empty(spark):
    assert heavy_values(spark.createDataFrame([], SCHEMA), "v", ["g"], 0.5).collect() == []


def test_summaries_stay_small(spark):
    """A million unique values: a summary holds so many counters, whatever the rows."""
    df = spark.range(0, 300_000, 1, 6).select((F.col("id") % 2).alias("g"), F.when(F.col("id") % 5 == 0, "same").otherwise(F.col("id").cast("string")).alias("v"))
    found = candidates(df.select("g", marked(F.col("v")).alias("_mark")), ["g"], 0.1).collect()
    assert [r["found"] for r in found] == [["vsame"], ["vsame"]]
    assert [tuple(r) for r in heavy_values(df, "v", ["g"], 0.1).orderBy("g").collect()] == [(0, "same", 30000, 150000, 0.2), (1, "same", 30000, 150000, 0.2)]

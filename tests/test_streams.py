"""Streams in several micro-batches: absent cases, late and re-sent rows, state that goes again."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from siftgate.operators.call_stats import log_window_join, stream_log_window_join, stream_runs_too_long
from siftgate.streaming import live

START = dt.datetime(2024, 1, 1)


def at(hours):
    return START + dt.timedelta(hours=hours)


@pytest.fixture
def batches(spark, tmp_path):
    """Lists of rows as a stream of one micro-batch each."""
    made = []

    def make(schema, *parts):
        path = tmp_path / f"in{len(made)}"
        made.append(path)
        for i, rows in enumerate(parts):
            spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{path}/part={i}")
        return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/part=*")
    return make


@pytest.fixture
def finished(spark, tmp_path):
    def run(df):
        query = live.write_stream(df, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
        query.awaitTermination()
        return query, spark.read.schema(df.schema).parquet(str(tmp_path / "out"))
    return run


CASES = "dataset string, platform_entry string, rule_id string, ts timestamp"


def test_streaks_end_when_a_run_passes_without_the_case(batches, finished):
    row = lambda rule, h: ("t", "p", rule, at(h))
    stream = batches(CASES, [row("a", 0), row("a", 1), row("b", 3.9), row("c", 1)], [row("a", 4), row("c", 5)],
                     [row("a", 13), row("c", 8), row("c", 9.5)], [row("a", 0.5), row("z", 30)])  # a at 0.5 comes too late
    query, out = finished(live.stream_case_streaks(stream, "ts"))
    got = sorted((r["case_id"][-1], (r["run_end"] - START).total_seconds() / 3600, r["failed_count"], r["total_failed"], r["recurrence"]) for r in out.collect())
    assert got == [("a", 4, 2, 2, 1), ("a", 8, 1, 3, 2), ("a", 12, 0, 0, 0), ("a", 16, 1, 1, 1), ("a", 20, 0, 0, 0),
                   ("b", 4, 1, 1, 1), ("b", 8, 0, 0, 0),
                   ("c", 4, 1, 1, 1), ("c", 8, 1, 2, 2), ("c", 12, 2, 4, 3), ("c", 16, 0, 0, 0)]
    left = query.recentProgress[-1].stateOperators
    assert left[0].numRowsTotal == 0 or all(s.numRowsTotal <= 1 for s in left)  # only z's open run


def test_streaks_equal_over_any_batches(batches, spark, tmp_path):
    rows = [("t", "p", f"r{i % 3}", at(i * i % 97)) for i in range(60)] + [("t", "p", "end", at(200))]
    rows.sort(key=lambda r: r[3])
    seen = []
    for n, cuts in enumerate(([61], [20, 41], [5, 11, 20, 25])):
        ends = [0, *cuts, 61] if cuts != [61] else [0, 61]
        stream = batches(CASES, *[rows[a:b] for a, b in zip(ends, ends[1:]) if rows[a:b]])
        live.write_stream(live.stream_case_streaks(stream, "ts"), str(tmp_path / f"o{n}"), str(tmp_path / f"c{n}")).awaitTermination()
        seen.append(sorted(map(tuple, spark.read.parquet(str(tmp_path / f"o{n}")).collect())))
    assert seen[0] == seen[1] == seen[2] and len(seen[0]) > 10


def test_share_max_of_windows(batches, finished):
    row = lambda i, h, g, v: (i, at(h), g, v)
    stream = batches("id int, ts timestamp, g string, v string",
                     [row(1, 0, "a", "x"), row(2, 1, "a", "x"), row(3, 2, "a", None), row(1, 0, "a", "x"), row(4, 1, "b", "y"), row(5, 1, "b", "w")],
                     [row(2, 1, "a", "x"), row(6, 3, None, None), row(7, 6, "a", "q")],
                     [row(8, 0.1, "b", "y"), row(9, 40, "a", "q")])  # 8 comes too late
    _, out = finished(live.stream_share_max(stream, "ts", ["g"], "v", 0.6, once=["id"]))
    got = {(r["window_start"], r["g"]): (r["rows"], r["top_value"], r["top_rows"], r["ok"]) for r in out.collect()}
    assert got == {(at(0), "a"): (3, "x", 2, False), (at(0), "b"): (2, "w", 1, True), (at(0), None): (1, None, 1, False), (at(4), "a"): (1, "q", 1, False)}


def test_calls_and_runs_meet_on_streams(batches, finished, spark):
    calls = [[(i, "m" if i % 2 else "n", at(i)) for i in range(12)], [(i, "m", at(i)) for i in range(12, 40)], [(99, "m", at(1)), (100, "m", at(90))]]
    runs = [[("m", 1, at(1), at(9)), ("n", 2, at(0), at(4)), ("m", 3, at(0), at(60))], [("m", 4, at(30), at(39)), ("q", 5, at(1), at(2))], [("q", 6, at(89), at(90))]]
    c_schema, r_schema = "id int, model string, ts timestamp", "model string, run int, start timestamp, end timestamp"
    query, out = finished(stream_log_window_join(batches(c_schema, *calls), batches(r_schema, *runs), longest="24 hours"))
    assert out.columns == ["id", "model", "ts", "run", "start", "end"]
    short = [r for part in runs for r in part if r[1] != 3]
    want = log_window_join(spark.createDataFrame(sum(calls, []), c_schema).where("id <> 99"), spark.createDataFrame(short, r_schema)).select("id", "run")
    assert sorted(map(tuple, out.select("id", "run").collect())) == sorted(map(tuple, want.collect())) and out.count() > 10
    assert query.recentProgress[-1].stateOperators[0].numRowsTotal <= 4  # what lies behind both watermarks is gone
    assert [r["run"] for r in stream_runs_too_long(spark.createDataFrame(sum(runs, []), r_schema), "24 hours").collect()] == [3]

"""Registered queries: the streaming forms, run to completion over what the tables hold."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from siftgate.operators import call_stats
from siftgate.plans.rules import Rule, RuleSet, shipped_rules
from siftgate.sources.storage import shared_dir
from siftgate.streaming import live
from siftgate.workload.check_queries import CRAWL_SQL, VISIBILITY_SQL, union_of
from siftgate.workload.registry import query
from siftgate.workload.views import CALLS, CRAWL, duck, table, view


def stream(spark: SparkSession, d: str, name: str) -> DataFrame:
    """A given table as a file stream."""
    return (spark.readStream.schema(table(spark, d, name).schema).option("pathGlobFilter", f"{name}.parquet")
            .parquet(d))


def crawl_stream(spark: SparkSession, d: str) -> DataFrame:
    sql = CRAWL.replace("FROM lineitem l JOIN part p", "FROM {lineitem} l JOIN {part} p")
    return spark.sql(sql, lineitem=stream(spark, d, "lineitem"), part=table(spark, d, "part"))


def finished(df: DataFrame, mode: str = "append") -> DataFrame:
    """Run a stream over all data there is and return what it wrote."""
    spark, base = df.sparkSession, shared_dir(df.sparkSession)
    live.write_stream(df, f"{base}/out", f"{base}/checkpoint", mode).awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{base}/out")


@query("h1_stream_row_checks", CRAWL_SQL + f"""
SELECT rule_id, keyword, count(*) AS failing_rows FROM ({union_of(VISIBILITY_SQL, 'keyword')}) t GROUP BY rule_id, keyword""")
def stream_row_checks(spark, d):
    tagged = live.stream_row_checks(crawl_stream(spark, d), shipped_rules("visibility/amazon"), ["keyword"])
    return finished(tagged).groupBy("rule_id", "keyword").agg(F.count(F.lit(1)).alias("failing_rows"))


WINDOW = "time_bucket(INTERVAL 4 HOUR, ts)"
CLOSED = "window_end <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)"


@query("h2_stream_crawl_checks", f"""
SELECT * FROM (SELECT {WINDOW} AS window_start, {WINDOW} + INTERVAL 4 HOUR AS window_end, event_type, count(*) AS rows,
  count(DISTINCT user_id) AS distinct_ranks, count(user_id) = count(DISTINCT user_id) AND min(user_id) = 1 AND max(user_id) = count(*) AS contiguous
FROM events GROUP BY ALL) WHERE {CLOSED}""", text=("window_start", "window_end"))
def stream_crawl_checks(spark, d):
    return finished(live.stream_crawl_checks(stream(spark, d, "events"), "ts", ["event_type"], "user_id"))


@query("h2_stream_value_shares", f"""
SELECT * FROM (SELECT {WINDOW} AS window_start, {WINDOW} + INTERVAL 4 HOUR AS window_end, user_id, event_type, count(*) AS occurrences
FROM events GROUP BY ALL) WHERE {CLOSED}""", text=("window_start", "window_end"))
def stream_value_shares(spark, d):
    return finished(live.stream_value_shares(stream(spark, d, "events"), "ts", ["user_id"], "event_type"))


SHARES = f"""SELECT w.*, row_number() OVER (PARTITION BY window_start, user_id ORDER BY n DESC, event_type) AS k
FROM (SELECT {WINDOW} AS window_start, user_id, event_type, count(*) AS n FROM events GROUP BY ALL) w"""


@query("h2_stream_share_max", f"""
SELECT window_start, window_start + INTERVAL 4 HOUR AS window_end, user_id, CAST(sum(n) AS BIGINT) AS rows, max(event_type) FILTER (WHERE k = 1) AS top_value,
  max(n) AS top_rows, max(n) / sum(n) <= 0.5 AS ok
FROM ({SHARES}) s GROUP BY window_start, user_id
HAVING window_end <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)""", text=("window_start", "window_end"))
def stream_share_max(spark, d):
    """Every row of the stream is sent twice."""
    sent = stream(spark, d, "events").union(stream(spark, d, "events"))
    return finished(live.stream_share_max(sent, "ts", ["user_id"], "event_type", 0.5, once=["event_id"]))


def in_parts(df: DataFrame, parts: int, order: str) -> DataFrame:
    """A table as a stream of so many micro-batches, in the order of a timestamp column (equal spans of time)."""
    spark, path = df.sparkSession, shared_dir(df.sparkSession)
    seconds = F.unix_micros(F.col(order).cast("timestamp")) / 1e6
    low, high = df.agg(F.min(seconds), F.max(seconds)).first()
    part = F.least(F.floor((seconds - low) / ((high - low) / parts)), F.lit(parts - 1))
    for i in range(parts):  # one file each, later files are newer
        df.where(part == i).coalesce(1).write.parquet(f"{path}/part={i}")
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/part=*")


EVENT_RULES = RuleSet("t_events", "web", ("event_type",), (
    Rule("value_bounds", "range", "value", {"max": 100}), Rule("known_type", "allowed_values", "event_type",
                                                               {"values": ["view", "click", "purchase", "signup"]}),
    Rule("purchase_value", "range", "value", {"min": 5}, when="event_type = 'purchase'")))


@query("h3_stream_case_state", """
SELECT case_id, failed_count, CAST(1 AS INT) AS recurrence FROM (
  SELECT 't_events|web|value_bounds' AS case_id, count(*) AS failed_count FROM events WHERE value > 100
  UNION ALL SELECT 't_events|web|known_type', count(*) FROM events WHERE event_type = 'error'
  UNION ALL SELECT 't_events|web|purchase_value', count(*) FROM events WHERE event_type = 'purchase' AND value < 5)
WHERE failed_count > 0""")
def stream_case_state(spark, d):
    base = shared_dir(spark)
    tagged = live.stream_row_checks(stream(spark, d, "events"), EVENT_RULES, ["event_id"])
    live.stream_case_state(tagged, f"{base}/state", f"{base}/checkpoint").awaitTermination()
    return live.read_state(spark, f"{base}/state").select("case_id", "failed_count", "recurrence")


STREAK_RULES = EVENT_RULES.with_rules(
    Rule("value_high", "range", "value", {"max": 85}), Rule("purchase_value", "range", "value", {"min": 1.5}, when="event_type = 'purchase'"),
    Rule("signup_value", "range", "value", {"max": 60}, when="event_type = 'signup'"))


@query("h3_stream_case_streaks", f"""
WITH f AS (
  SELECT 't_events|web|value_high' AS case_id, ts FROM events WHERE value > 85
  UNION ALL SELECT 't_events|web|purchase_value', ts FROM events WHERE event_type = 'purchase' AND value < 1.5
  UNION ALL SELECT 't_events|web|signup_value', ts FROM events WHERE event_type = 'signup' AND value > 60),
r AS (SELECT case_id, {WINDOW} + INTERVAL 4 HOUR AS run_end, count(*) AS failed_count FROM f GROUP BY ALL),
c AS (SELECT *, run_end - row_number() OVER (PARTITION BY case_id ORDER BY run_end) * INTERVAL 4 HOUR AS island FROM r),
s AS (SELECT case_id, run_end, failed_count, CAST(sum(failed_count) OVER w AS BIGINT) AS total_failed, CAST(row_number() OVER w AS INT) AS recurrence
  FROM c WINDOW w AS (PARTITION BY case_id, island ORDER BY run_end)
  UNION ALL SELECT case_id, max(run_end) + INTERVAL 4 HOUR, 0, 0, 0 FROM c GROUP BY case_id, island)
SELECT * FROM s WHERE run_end <= (SELECT max(ts) - INTERVAL 1 HOUR FROM f)""", text=("run_end",))
def stream_case_streaks(spark, d):
    """Three micro-batches of ten days; cases come and go between runs of four hours."""
    tagged = live.stream_row_checks(in_parts(table(spark, d, "events"), 3, "ts"), STREAK_RULES, ["ts"])
    return finished(live.stream_case_streaks(tagged, "ts"))


# Benchmark runs of a model: one per day, from its first to its last call of the day.
DAILY_RUNS = """
SELECT event_type AS model, CAST(date_trunc('day', ts) AS DATE) AS day, min(ts) AS started, max(ts) AS ended
FROM events WHERE user_id % 2 = 0 GROUP BY event_type, date_trunc('day', ts)
"""


@query("g5_stream_log_window", f"""
SELECT w.model, w.day, count(*) AS calls, CAST(sum(c.completion_tokens) AS BIGINT) AS tokens
FROM ({duck(CALLS)}) c JOIN ({duck(DAILY_RUNS)}) w ON c.model = w.model AND c.ts BETWEEN w.started AND w.ended GROUP BY w.model, w.day""", text=("day",))
def stream_log_window(spark, d):
    """Calls and finished runs as two streams of three micro-batches each."""
    calls = in_parts(view(spark, d, CALLS), 3, "ts")
    runs = in_parts(view(spark, d, DAILY_RUNS), 3, "ended")
    hit = finished(call_stats.stream_log_window_join(calls, runs, start="started", end="ended"))
    return hit.groupBy("model", "day").agg(F.count(F.lit(1)).alias("calls"), F.sum("completion_tokens").alias("tokens"))

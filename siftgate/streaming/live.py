"""The same checks on streams, in place of a polling loop."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import StructType

from siftgate.operators.failures import case_id
from siftgate.operators.row_checks import row_rule_set

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_row_checks(stream: DataFrame, rules, keep: list[str], as_of=None,
                      platform_column: str | None = None) -> DataFrame:
    """Row rules on a stream: stateless, the batch operator unchanged."""
    return row_rule_set(stream, rules, as_of, keep, platform_column)


def write_stream(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Run what is there now into parquet files, exactly once across restarts."""
    return (stream.writeStream.format("parquet").outputMode(mode).option("path", path)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def stream_crawl_checks(stream: DataFrame, time: str, by: list[str], rank: str, size: str = "4 hours",
                        slide: str | None = None, watermark: str = "1 hour") -> DataFrame:
    """Row count, distinct values and contiguity of a rank per event-time window (append mode).

    Two chained aggregates: values are counted per window first, so the state of a window is one
    counter per distinct value on many tasks and never one collected set. Rows later than the
    watermark are dropped.
    """
    timed = (stream.select(F.col(time).cast("timestamp").alias(time), *by, F.col(rank).cast("long").alias("_r"))
             .withWatermark(time, watermark))
    frame = F.window(time, size, slide) if slide else F.window(time, size)
    counts = timed.groupBy(frame.alias("w"), *by, "_r").agg(F.count(F.lit(1)).alias("_n"))
    held = F.coalesce(F.sum(F.when(F.col("_r").isNotNull(), F.col("_n"))), F.lit(0))
    out = counts.groupBy("w", *by).agg(
        F.sum("_n").alias("rows"), held.alias("ranks"), F.count("_r").alias("distinct_ranks"),
        F.min("_r").alias("low"), F.max("_r").alias("high"))
    ok = (F.col("ranks") == 0) | ((F.col("ranks") == F.col("distinct_ranks")) & (F.col("low") == 1)
                                  & (F.col("high") == F.col("ranks")))
    return out.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by,
                      "rows", "distinct_ranks", ok.alias("contiguous"))


def stream_value_shares(stream: DataFrame, time: str, by: list[str], value: str, size: str = "4 hours",
                        watermark: str = "1 hour") -> DataFrame:
    """Rows per (window, group, value): the first level of share_max, bounded by distinct values."""
    timed = stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, watermark)
    return (timed.groupBy(F.window(time, size).alias("w"), *by, value).agg(F.count(F.lit(1)).alias("occurrences"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by, value,
                    "occurrences"))


def stream_share_max(stream: DataFrame, time: str, by: list[str], value: str, max_share: float, size: str = "4 hours",
                     watermark: str = "1 hour", once: list[str] | None = None) -> DataFrame:
    """The verdict of share_max per (window, group), as the batch check gives it: null is a value, ties go to the smallest.

    Values are counted per window first, then the counts are folded into the top value and the rows, so the
    state of a group is one row per value on many tasks and then one row. Rows that were sent again, known by the columns
    ``once``, count once if they come within the watermark. Append mode: a window comes out when it is closed.
    """
    timed = stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, watermark)
    if once:
        timed = timed.dropDuplicatesWithinWatermark(once)
    counts = timed.groupBy(F.window(time, size).alias("w"), *by, F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    top = F.min(F.struct((-F.col("_n")).alias("n"), F.col("_v").isNull().alias("z"), F.col("_v").alias("v")))
    out = counts.groupBy("w", *by).agg(F.sum("_n").alias("rows"), top.alias("top"))
    share = -F.col("top.n") / F.col("rows")
    return out.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by, "rows", F.col("top.v").alias("top_value"),
                      (-F.col("top.n")).alias("top_rows"), (share <= F.lit(float(max_share))).alias("ok"))


# ------------------------------------------------------------------ streaks of cases

CASE = ["dataset", "platform_entry", "rule_id"]
STREAK = "run_end timestamp, failed_count long, total_failed long, recurrence int"
STREAK_STATE = "last_end long, total_failed long, recurrence int"


class CaseStreaks(StatefulProcessor):
    """State of one case: when it last failed, for how many runs in a row, and how many rows in that streak."""

    def __init__(self, run_ms: int):
        self.run_ms = run_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("streak", STREAK_STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        runs = pd.concat(list(rows)).sort_values("run_end")  # one row per closed run
        last, total, streak = self.state.get() if self.state.exists() else (None, 0, 0)
        if last is not None:
            self.handle.deleteTimer(last + self.run_ms)
        out = []
        for end, failed in zip(runs["run_end"], runs["failed_count"]):
            at = int(end.timestamp() * 1000)
            if last is not None and at > last + self.run_ms:  # absent in between
                out.append((pd.Timestamp(last + self.run_ms, unit="ms"), 0, 0, 0))
                last, total, streak = None, 0, 0
            last, total, streak = at, total + int(failed), streak + 1
            out.append((end, int(failed), total, streak))
        self.state.update((last, total, streak))
        self.handle.registerTimer(last + self.run_ms)
        yield self.frame(key, out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """The run after the last one is closed and the case was absent: its streak ends and its state goes."""
        self.state.clear()
        yield self.frame(key, [(pd.Timestamp(expiredTimerInfo.getExpiryTimeInMs(), unit="ms"), 0, 0, 0)])

    @staticmethod
    def frame(key: tuple, rows: list[tuple]) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=["run_end", "failed_count", "total_failed", "recurrence"])
        for i, name in enumerate(CASE):
            out.insert(i, name, key[i])
        return out

    def close(self) -> None:
        pass


def stream_case_streaks(failing: DataFrame, time: str, run_hours: int = 4, watermark: str = "1 hour") -> DataFrame:
    """Failing rows (dataset, platform_entry, rule_id, ``time``) as one row per case and closed run: rows that failed, rows of the
    streak, and for how many runs in a row the case has failed. One more row with recurrence 0 ends a streak.

    Runs are event-time windows. Rows are counted per case and run first, combined in each task, so the state of a case
    sees one row per run however many rows fail; it is one small row, removed by a timer once a closed run passes
    without the case. Rows later than the watermark are dropped. Needs the RocksDB state store, which is set here.
    """
    failing.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    runs = (failing.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, watermark)
            .groupBy(F.window(time, f"{run_hours} hours").alias("w"), *CASE).agg(F.count(F.lit(1)).alias("failed_count"))
            .select(*CASE, F.window_time("w").alias("run_time"), F.col("w.end").alias("run_end"), "failed_count"))
    schema = StructType([*[runs.schema[c] for c in CASE], *StructType.fromDDL(STREAK).fields])
    out = runs.groupBy(*CASE).transformWithStateInPandas(CaseStreaks(run_hours * 3_600_000), schema, "Append", "EventTime")
    return out.select(case_id(*[F.col(c) for c in CASE]).alias("case_id"), "run_end", "failed_count", "total_failed", "recurrence")


# ------------------------------------------------------------------ state table of cases, by micro-batch

STATE = "case_id string, failed_count long, recurrence int, last_batch long"


def state_version(path: str, batch: int) -> str:
    return f"{path.rstrip('/')}/version={batch}"


def latest_version(spark: SparkSession, path: str, before: int | None = None) -> int | None:
    """Highest committed version in the state folder (Hadoop file API, works on any file system)."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return None
    done = []
    for status in fs.listStatus(folder):
        name = status.getPath().getName()
        if name.startswith("version=") and fs.exists(jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
            done.append(int(name.partition("=")[2]))
    done = [v for v in done if before is None or v < before]
    return max(done) if done else None


def read_state(spark: SparkSession, path: str) -> DataFrame:
    version = latest_version(spark, path)
    if version is None:
        return spark.createDataFrame([], STATE)
    return spark.read.schema(STATE).parquet(state_version(path, version))


def merge_case_state(failing: DataFrame, batch: int, path: str) -> None:
    """Add one micro-batch of failing rows (dataset, platform_entry, rule_id) to the state table.

    A case seen in this batch and in the one before extends its streak; others restart at 1. Each
    batch writes its own version from the one before it, so a replayed batch gives the same state.
    """
    spark = failing.sparkSession
    before = latest_version(spark, path, before=batch)
    new = (failing.groupBy(case_id(F.col("dataset"), F.col("platform_entry"), F.col("rule_id")).alias("case_id"))
           .agg(F.count(F.lit(1)).alias("_new")))
    old = (spark.createDataFrame([], STATE) if before is None
           else spark.read.schema(STATE).parquet(state_version(path, before)))
    seen = F.col("_new").isNotNull()
    previous = -1 if before is None else before
    merged = old.join(new, "case_id", "full_outer").select(
        "case_id", (F.coalesce("failed_count", F.lit(0)) + F.coalesce("_new", F.lit(0))).alias("failed_count"),
        F.when(seen & (F.col("last_batch") == previous), F.col("recurrence") + 1).when(seen, F.lit(1))
        .otherwise(F.col("recurrence")).cast("int").alias("recurrence"),
        F.when(seen, F.lit(batch)).otherwise(F.col("last_batch")).cast("long").alias("last_batch"))
    merged.write.mode("overwrite").parquet(state_version(path, batch))


def stream_case_state(failing: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Keep the case state table up to date from a stream of failing rows."""
    return (failing.writeStream.foreachBatch(lambda batch_df, batch: merge_case_state(batch_df, batch, path))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())

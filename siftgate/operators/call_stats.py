"""Aggregates over call logs and benchmark runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from siftgate.functions.values import count_where

from siftgate.operators.escalation import case_verdict, escalation_reasons

# Sketch precision for quantile brackets, and the group size below which no bracket is used.
ACCURACY = 100_000
BRACKET = 5e-5


def log_window_join(calls: DataFrame, runs: DataFrame, bucket_seconds: int = 3600, ts: str = "ts",
                    start: str = "start", end: str = "end", key: str = "model") -> DataFrame:
    """Calls of the same key with start <= ts <= end, one row per (call, run).

    Run windows are cut into time buckets, so the join is by equality of (key, bucket) and a busy
    model is spread over its buckets.
    """
    bucket = lambda c: F.floor(F.unix_micros(F.col(c).cast("timestamp")) / (bucket_seconds * 1_000_000))
    spread = runs.withColumn("_b", F.explode(F.sequence(bucket(start), bucket(end))))
    right = spread.select(*[F.col(c).alias(f"_r_{c}") if c in calls.columns else F.col(c) for c in spread.columns])
    left = calls.withColumn("_cb", bucket(ts))
    lo, hi = (f"_r_{c}" if c in calls.columns else c for c in (start, end))
    rkey = f"_r_{key}" if key in calls.columns else key
    hit = ((F.col(key) == F.col(rkey)) & (F.col("_cb") == F.col("_b"))
           & (F.col(ts) >= F.col(lo)) & (F.col(ts) <= F.col(hi)))
    return left.join(right, hit).drop("_cb", "_b", rkey)


def stream_log_window_join(calls: DataFrame, runs: DataFrame, longest: str = "1 day", late: str = "10 minutes", ts: str = "ts",
                           start: str = "start", end: str = "end", key: str = "model") -> DataFrame:
    """``log_window_join`` of two streams: calls of the same key with start <= ts <= end, one row per (call, run).

    A run arrives when it is over and lasts ``longest`` at most; both sides wait ``late`` for stragglers. So a call is
    kept until the watermark of runs has passed ts + longest, a run until that of calls has passed its end, and then
    Spark drops them from the state. Longer runs find no call and are left out (``stream_runs_too_long``).
    """
    left = calls.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)
    names = {c: f"_r_{c}" for c in runs.columns if c in calls.columns}
    right = (runs.withColumns({c: F.col(c).cast("timestamp") for c in (start, end)}).where(F.col(end) <= F.col(start) + F.expr(f"interval {longest}"))
             .withColumnsRenamed(names))
    lo, hi, rkey = (names.get(c, c) for c in (start, end, key))
    right = right.withWatermark(hi, late)
    hit = ((F.col(key) == F.col(rkey)) & (F.col(ts) >= F.col(lo)) & (F.col(ts) <= F.col(hi))
           & (F.col(ts) >= F.col(hi) - F.expr(f"interval {longest}")))
    return left.join(right, hit).drop(rkey)


def stream_runs_too_long(runs: DataFrame, longest: str = "1 day", start: str = "start", end: str = "end") -> DataFrame:
    """Runs that ``stream_log_window_join`` leaves out."""
    return runs.where(F.col(end).cast("timestamp") > F.col(start).cast("timestamp") + F.expr(f"interval {longest}"))


def latency_stats(calls: DataFrame, by: list[str], latency: str = "latency_s",
                  tokens: str = "completion_tokens") -> DataFrame:
    """Calls, mean latency and mean completion tokens; absent or zero token counts do not count."""
    used = F.nullif(F.col(tokens), F.lit(0))
    return calls.groupBy(*by).agg(F.count(F.lit(1)).alias("call_count"),
                                  F.round(F.avg(latency), 2).alias("avg_latency_s"),
                                  F.round(F.avg(used), 1).alias("avg_completion_tokens"))


def quantile_exclusive(df: DataFrame, by: list[str], value: str, part: int = 19, parts: int = 20,
                       name: str = "p95") -> DataFrame:
    """Exact ``part``-th of ``parts`` quantiles, exclusive method; null for fewer than two values.

    A sketch brackets the wanted rank first. Only values inside the bracket (about 1 in 10,000) are
    ordered, everything below it is just counted; both bounds of the sketch are guaranteed, so the
    result is exact and no task sorts a whole group. Small groups are ordered directly.
    """
    v = F.col(value).cast("double")
    rows = df.where(v.isNotNull() & ~F.isnan(v)).select(*by, v.alias("v"))
    p = part / parts
    bounds = rows.groupBy(*by).agg(
        F.count("v").alias("n"),
        F.percentile_approx("v", [max(p - BRACKET, 0.0), min(p + BRACKET, 1.0)], ACCURACY).alias("b"))
    bounds = bounds.select(*[F.col(k).alias(f"_k_{k}") for k in by], "n",
                           F.when(F.col("n") >= ACCURACY, F.col("b")[0]).alias("lo"),
                           F.when(F.col("n") >= ACCURACY, F.col("b")[1]).alias("hi"))
    match = F.lit(True)
    for k in by:
        match = match & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    near = (rows.join(bounds, match).where(F.col("hi").isNull() | (F.col("v") <= F.col("hi")))
            .withColumn("v", F.when(F.col("lo").isNull() | (F.col("v") >= F.col("lo")), F.col("v"))))
    # null v = "somewhere below the bracket"; equal values are counted before the shuffle
    counts = near.groupBy(*by, "n", "v").agg(F.count(F.lit(1)).alias("c"))
    upto = F.sum("c").over(Window.partitionBy(*by).orderBy(F.col("v").asc_nulls_first()))
    # rank arithmetic in whole numbers: position part*(n+1)/parts, kept inside 1..n-1
    j = F.greatest(F.lit(1), F.least(F.expr(f"({part} * (n + 1)) div {parts}"), F.col("n") - 1))
    ranked = counts.withColumn("upto", upto).withColumn("j", j)
    picked = ranked.groupBy(*by).agg(
        F.max("n").alias("n"), F.max("j").alias("j"),
        F.min(F.when(F.col("upto") >= F.col("j"), F.col("v"))).alias("a"),
        F.min(F.when(F.col("upto") >= F.col("j") + 1, F.col("v"))).alias("z"))
    delta = F.col("n") * part + F.lit(part) - F.col("j") * parts
    result = (F.col("a") * (F.lit(parts) - delta) + F.col("z") * delta) / F.lit(float(parts))
    return picked.select(*by, F.col("n").alias("values"), F.when(F.col("n") > 1, result).alias(name))


def run_stats(verdicts: DataFrame, by: list[str] | None = None, min_confidence: float = 0.5,
              cases: DataFrame | None = None) -> DataFrame:
    """Per model and run: cases, escalated cases and row outcomes, from row verdicts in one shuffle
    by case and one of the small per-case table.

    ``cases`` (``by`` and case_id) lists all cases of the runs; those never judged count as cases
    without rows. Without it only cases with a verdict are known.
    """
    by = by or ["model", "run"]
    key = [*by, "case_id"]
    judged = case_verdict(verdicts, key)
    if cases is not None:
        judged = cases.select(*key).distinct().join(judged, key, "left")
    judged = judged.withColumn("severity", F.lit("error")).withColumn("on_fail", F.lit("investigate"))

    def total(rows) -> Column:
        return F.coalesce(F.sum(rows), F.lit(0))

    return escalation_reasons(judged, min_confidence).groupBy(*by).agg(
        F.count(F.lit(1)).alias("cases"),
        count_where(F.size("escalation_reasons") > 0).alias("escalated_cases"),
        total("true_positive_count").alias("true_positive_rows"),
        total("false_positive_count").alias("false_positive_rows"),
        total("failed_investigation_count").alias("failed_llm_rows"),
        total(F.col("row_verdicts") - F.col("failed_investigation_count")).alias("investigated_rows"))


def mean_of_rounded(value: Column, places: int = 2) -> Column:
    """Mean of numbers with so many decimals, rounded half up to as many. Whole numbers throughout: a tie of the
    mean is a tie, however its parts were stored."""
    unit = 10 ** places
    whole, n = F.sum(F.round(value * unit).cast("long")), F.count(value)
    return F.when(n > 0, F.floor((2 * whole + n) / (2 * n)) / unit)


def model_summary(runs: DataFrame, by: str = "model") -> DataFrame:
    """Totals over the runs of a model. Expects run_stats columns, plus avg_latency_s (two decimals, as latency_stats
    gives it) and error. A run without a call has no latency and does not count in the mean."""
    rows = F.sum(F.col("investigated_rows") + F.col("failed_llm_rows"))
    failed = F.sum("failed_llm_rows")
    return runs.groupBy(by).agg(
        F.count(F.lit(1)).alias("runs"),
        count_where(F.col("error").isNotNull()).alias("runs_with_error"),
        rows.alias("total_rows_attempted"), failed.alias("total_llm_call_failures"),
        F.round(F.try_divide(failed, rows), 3).alias("call_failure_rate"),
        F.sum("true_positive_rows").alias("total_true_positive_rows"),
        F.sum("false_positive_rows").alias("total_false_positive_rows"),
        F.sum("escalated_cases").alias("total_escalated_cases"),
        mean_of_rounded(F.col("avg_latency_s")).alias("avg_latency_s"),
        F.array_sort(F.collect_list("error")).alias("run_errors"))  # one entry per run of a model

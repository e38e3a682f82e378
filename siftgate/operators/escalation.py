"""Queueing, verdict roll-up and escalation over the cases table.

Cases are bounded by (entries x rules) of the rule files, not by data, so ordering all of them is
cheap; everything that touches verdict rows is a partial aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from siftgate.functions.values import count_where

LOW_CONFIDENCE = 0.6


def severity_order(cases: DataFrame) -> DataFrame:
    """Cases to investigate, errors first, then by failed rows; ``queue_no`` starts at 1."""
    by = Window.orderBy(F.when(F.col("severity") == "error", 0).otherwise(1),
                        F.col("failed_count").desc(), "case_id")
    return cases.where(F.col("on_fail") == "investigate").withColumn("queue_no", F.row_number().over(by))


def budgeted_queue(queue: DataFrame, cap: int | None, unit_cost: int = 2) -> DataFrame:
    """``admitted`` is true while the calls spent before a unit are still below the cap."""
    cost = F.col("cost") if "cost" in queue.columns else F.lit(unit_cost)
    before = F.coalesce(F.sum(cost).over(
        Window.orderBy("queue_no").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    spent = queue.withColumn("calls_before", before.cast("long"))
    return spent.withColumn("admitted", F.lit(True) if cap is None else F.col("calls_before") < cap)


def resume_queue(queue: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Cases without a verdict yet."""
    return queue.join(verdicts.select("case_id"), "case_id", "left_anti")


def escalation_reasons(cases: DataFrame, min_confidence: float = 0.5, share_floor: float | None = None,
                       recur_after: int | None = None) -> DataFrame:
    """Adds ``escalation_reasons``. Verdict reasons always apply; the floor and recurrence reasons
    are opt-in and leave out warn rules that are only reported."""
    confidence = F.col("confidence")
    tests: list[tuple[str, Column]] = [
        ("ai_verdict", F.col("true_positive") & (F.coalesce(confidence, F.lit(0.0)) >= min_confidence)),
        ("low_confidence", F.coalesce(confidence, F.lit(1.0)) < LOW_CONFIDENCE)]
    relevant = ~((F.col("severity") == "warn") & (F.col("on_fail") == "report_only"))
    if share_floor is not None:
        floor = (F.coalesce(F.col("force_escalate_above"), F.lit(share_floor))
                 if "force_escalate_above" in cases.columns else F.lit(share_floor))
        tests.append(("failed_share", relevant & (F.col("failed_share") > floor)))
    if recur_after is not None:
        tests.append(("recurrence", relevant & (F.col("recurrence") >= recur_after)))
    return cases.withColumn("escalation_reasons", F.array_compact(F.array(*[
        F.when(F.coalesce(t, F.lit(False)), F.lit(n)) for n, t in tests])))


VERDICT_FIELDS = ["true_positive", "cause", "confidence", "explanation", "escalation_summary",
                  "current_xpath", "suggested_xpath", "model"]


def case_verdict(verdicts: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Row verdicts to one verdict per case.

    The first true positive wins, then the first false positive, then a note of how many rows
    failed, then whatever came first. ``row_seq`` gives the order within a case.
    """
    keys = keys or ["case_id"]
    have = [c for c in VERDICT_FIELDS if c in verdicts.columns and c not in keys]
    rank = (F.when(F.col("true_positive"), 0).when(~F.col("true_positive"), 1)
            .when(F.col("error").isNotNull(), 2).otherwise(3))
    place = F.struct(rank.alias("r"), F.col("row_seq").alias("s"))
    agg = verdicts.groupBy(*keys).agg(
        F.min_by(F.struct(rank.alias("rank"), *have), place).alias("v"),
        count_where(F.col("true_positive")).alias("true_positive_count"),
        count_where(~F.col("true_positive")).alias("false_positive_count"),
        count_where(F.col("error").isNotNull()).alias("failed_investigation_count"),
        F.count(F.lit(1)).alias("row_verdicts"))
    failed = F.col("v.rank") == 2
    note = F.concat(F.col("failed_investigation_count").cast("string"), F.lit("/"),
                    F.col("row_verdicts").cast("string"),
                    F.lit(" row(s) failed investigation (see row_verdicts for each error)"))
    fields = [F.col(f"v.{c}").alias(c) if c == "model" else F.when(~failed, F.col(f"v.{c}")).alias(c)
              for c in have]
    return agg.select(*keys, *fields, F.when(failed, note).alias("error"), "true_positive_count",
                      "false_positive_count", "failed_investigation_count", "row_verdicts")


def majority_cause(verdicts: DataFrame) -> DataFrame:
    """True if any row is a true positive; the cause most of those rows share, ties are unknown."""
    n = verdicts.groupBy("case_id", "true_positive", "cause").agg(F.count(F.lit(1)).alias("n"))
    real = F.coalesce(F.col("true_positive"), F.lit(False))
    usable = F.when(real & F.col("cause").isNotNull(), F.struct(F.col("n").alias("n"), F.col("cause").alias("c")))
    lowest = F.when(real & F.col("cause").isNotNull(), F.struct((-F.col("n")).alias("n"), F.col("cause").alias("c")))
    # largest and smallest name among the most frequent causes: they differ exactly on a tie
    agg = n.groupBy("case_id").agg(
        F.max(real).alias("case_true_positive"), F.max(usable).alias("hi"), F.min(lowest).alias("lo"),
        F.coalesce(F.sum(F.when(real, F.col("n"))), F.lit(0)).alias("true_positive_rows"))
    return agg.select("case_id", "case_true_positive", "true_positive_rows",
                      F.when(F.col("hi.c") == F.col("lo.c"), F.col("hi.c"))
                      .when(F.col("case_true_positive"), F.lit("unknown")).alias("majority_cause"))

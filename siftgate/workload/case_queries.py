"""Registered queries: failures, cases, escalation and reporting."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from siftgate.operators import case_states as cst, heavy_values
from siftgate.operators import escalation as esc, failures as fl, reporting as rep
from siftgate.plans.rules import shipped_rules
from siftgate.workload.check_queries import (CRAWL_SQL, DAILY_SQL, GROUP_FAILS_SQL, GROUP_RULES, OSA_AMAZON_SQL,
                                             VISIBILITY_SQL, union_of)
from siftgate.workload.registry import query
from siftgate.workload.views import CASE_VERDICTS, CRAWL, MARKET, VERDICTS, duck, view

KEYS = ["keyword", "time_stamp"]


def amazon_failures(spark: SparkSession, d: str) -> DataFrame:
    return fl.failure_records(view(spark, d, CRAWL), shipped_rules("visibility/amazon"))


def amazon_cases(spark: SparkSession, d: str) -> DataFrame:
    return fl.fingerprint_cases(amazon_failures(spark, d), KEYS)


# Failing rows, failures and cases of the Amazon search-result rules.
FAILS = f"""
fails AS (SELECT rule_id, severity, on_fail, keyword, time_stamp, count(*) AS failed_count
  FROM ({union_of(VISIBILITY_SQL, 'keyword, time_stamp')}) GROUP BY ALL),
guarded AS (SELECT rule_id, count(*) AS total_count FROM ({union_of(VISIBILITY_SQL, '1 AS one', only_failed=False)}) GROUP BY rule_id),
failures AS (SELECT *, concat(failed_count, ' of ', total_count, ' rows failed') AS detail
  FROM fails JOIN guarded USING (rule_id))"""
CASES = f"""{FAILS},
texts AS (SELECT rule_id, detail, min((keyword, time_stamp)) AS place FROM failures GROUP BY rule_id, detail),
ranked AS (SELECT *, row_number() OVER (PARTITION BY rule_id ORDER BY place, detail) AS no FROM texts),
cases AS (
  SELECT rule_id, concat('t_visibility_hourly|Amazon|', rule_id) AS case_id, severity, on_fail,
    CAST(sum(failed_count) AS BIGINT) AS failed_count, count(*) AS n_crawls,
    sum(failed_count)::DOUBLE / (SELECT count(*) FROM crawl)::DOUBLE AS failed_share,
    (SELECT string_agg(detail, '; ' ORDER BY no) FROM ranked r WHERE r.rule_id = f.rule_id AND no <= 2) AS two_details,
    (SELECT detail FROM ranked r WHERE r.rule_id = f.rule_id AND no = 1) AS first_detail
  FROM failures f GROUP BY rule_id, severity, on_fail)"""
CRAWL_CASES = CRAWL_SQL + "," + CASES


def flagship(spark: SparkSession, d: str) -> DataFrame:
    return amazon_cases(spark, d).select(
        "case_id", "severity", "on_fail", "failed_count", "n_crawls", "failed_share",
        F.array_join("crawl_labels", ", ").alias("labels"), F.get("details", F.lit(0)).alias("first_detail"))


# ------------------------------------------------------------------ failures and cases

@query("d1_failure_records", CRAWL_SQL + "," + FAILS + """
SELECT rule_id, keyword, time_stamp, failed_count, total_count, detail FROM failures""", text=("time_stamp",))
def failure_records(spark, d):
    return amazon_failures(spark, d).select("rule_id", *KEYS, "failed_count", "total_count", "detail")


@query("d2_case_details", CRAWL_SQL + "," + FAILS + """
SELECT concat('t_visibility_hourly|Amazon|', rule_id) AS case_id, detail, count(*) AS n_failures,
  CAST(sum(failed_count) AS BIGINT) AS failed_count FROM failures GROUP BY rule_id, detail""")
def all_details(spark, d):
    return fl.case_details(amazon_failures(spark, d))


@query("d2_case_crawls", CRAWL_SQL + "," + FAILS + """
SELECT concat('t_visibility_hourly|Amazon|', rule_id) AS case_id, coalesce(CAST(keyword AS VARCHAR), 'null') AS label,
  count(*) AS n_failures, CAST(sum(failed_count) AS BIGINT) AS failed_count FROM failures GROUP BY rule_id, 2""")
def all_crawls(spark, d):
    return fl.case_crawls(amazon_failures(spark, d), KEYS)


@query("d1_group_failures", CRAWL_SQL + "," + GROUP_FAILS_SQL + """
SELECT rule_id, keyword, time_stamp, group_rows AS failed_count, group_rows AS total_count,
  (SELECT count(*) FROM crawl) AS entry_rows FROM gf""", text=("time_stamp",))
def group_failures(spark, d):
    return fl.failure_records(view(spark, d, CRAWL), GROUP_RULES).select(
        "rule_id", *KEYS, "failed_count", "total_count", "entry_rows")


@query("d2_fingerprint_cases", CRAWL_CASES + """,
lab AS (SELECT rule_id, keyword, row_number() OVER (PARTITION BY rule_id ORDER BY keyword) AS no
  FROM (SELECT DISTINCT rule_id, keyword FROM failures))
SELECT case_id, severity, on_fail, failed_count, n_crawls, failed_share, first_detail,
  (SELECT string_agg(keyword, ', ' ORDER BY no) FROM lab WHERE lab.rule_id = cases.rule_id AND no <= 8) AS labels
FROM cases""")
def cases(spark, d):
    return flagship(spark, d)


@query("d2_group_cases", CRAWL_SQL + "," + GROUP_FAILS_SQL + """
SELECT concat('t_visibility_hourly|Amazon|', rule_id) AS case_id, CAST(sum(group_rows) AS BIGINT) AS failed_count,
  count(keyword) AS n_crawls, sum(group_rows)::DOUBLE / (SELECT count(*) FROM crawl)::DOUBLE AS failed_share
FROM gf GROUP BY rule_id""")
def group_cases(spark, d):
    records = fl.failure_records(view(spark, d, CRAWL), GROUP_RULES)
    return fl.fingerprint_cases(records, KEYS).select("case_id", "failed_count", "n_crawls", "failed_share")


@query("d2_merged_cases", CRAWL_CASES + """,
lab AS (SELECT rule_id, keyword, row_number() OVER (PARTITION BY rule_id ORDER BY keyword) AS no
  FROM (SELECT DISTINCT rule_id, keyword FROM failures))
SELECT case_id, severity, on_fail, failed_count, n_crawls, failed_share,
  (SELECT string_agg(keyword, ', ' ORDER BY no) FROM lab WHERE lab.rule_id = cases.rule_id AND no <= 8) AS labels
FROM cases""")
def merged_cases(spark, d):
    """Old and new crawls are judged apart, and their states merged."""
    rules, crawl, new = shipped_rules("visibility/amazon"), view(spark, d, CRAWL), F.col("time_stamp") >= F.lit("1996-01-01")
    parts = [crawl.where(~new), crawl.where(new)]
    states = cst.merge_case_states(*[cst.case_states(fl.failure_records(p, rules), KEYS) for p in parts])
    sizes = cst.merge_entry_sizes(*[cst.entry_sizes(p, rules) for p in parts])
    return cst.cases_of(states, sizes).select("case_id", "severity", "on_fail", "failed_count", "n_crawls", "failed_share",
                                              F.array_join("crawl_labels", ", ").alias("labels"))


SAMPLE = ["platform_code", "sp", "absolute_rank"]


@query("d3_case_samples", CRAWL_SQL + f""",
t AS ({union_of(VISIBILITY_SQL, 'keyword, time_stamp, platform_code, sp, absolute_rank')}),
r AS (SELECT *, row_number() OVER (PARTITION BY rule_id ORDER BY keyword, time_stamp, platform_code NULLS LAST,
  sp NULLS LAST, absolute_rank NULLS LAST) AS no FROM t)
SELECT rule_id, CAST(no AS INT) AS sample_no, keyword, time_stamp, platform_code, sp, absolute_rank
FROM r WHERE no <= 5""", text=("time_stamp",))
def samples(spark, d):
    return fl.case_samples(view(spark, d, CRAWL), shipped_rules("visibility/amazon"), SAMPLE).select(
        "rule_id", "sample_no", *KEYS, *SAMPLE)


@query("d3_group_samples", CRAWL_SQL + "," + GROUP_FAILS_SQL + """,
t AS (SELECT gf.rule_id, c.keyword, c.time_stamp, c.platform_code, c.sp, c.absolute_rank FROM crawl c, gf
  WHERE (gf.keyword IS NULL OR (gf.keyword = c.keyword AND gf.time_stamp = c.time_stamp))
    AND (gf.rule_id <> 'ad_sellers' OR c.product_type = 'SB') AND (gf.rule_id <> 'oos_above_40' OR c.rating IS NOT NULL)),
r AS (SELECT *, row_number() OVER (PARTITION BY rule_id ORDER BY keyword, time_stamp, platform_code NULLS LAST,
  sp NULLS LAST, absolute_rank NULLS LAST) AS no FROM t)
SELECT rule_id, CAST(no AS INT) AS sample_no, keyword, time_stamp, platform_code, sp, absolute_rank
FROM r WHERE no <= 5""", text=("time_stamp",))
def group_samples(spark, d):
    return fl.case_samples(view(spark, d, CRAWL), GROUP_RULES, SAMPLE).select(
        "rule_id", "sample_no", *KEYS, *SAMPLE)


def entry_sql(dataset: str, rules: dict) -> str:
    return f"""SELECT '{dataset}' AS dataset, rule_id, count(*) AS failed_count,
  count(*)::DOUBLE / (SELECT count(*) FROM crawl)::DOUBLE AS failed_share
FROM ({union_of(rules, '1 AS one')}) GROUP BY rule_id"""


@query("d4_failed_share", CRAWL_SQL + entry_sql("t_osa_hourly", OSA_AMAZON_SQL))
def share(spark, d):
    records = fl.failure_records(view(spark, d, CRAWL), shipped_rules("osa/amazon"))
    return fl.fingerprint_cases(records, ["date_stamp", "hour_stamp"]).select(
        "dataset", "rule_id", "failed_count", "failed_share")


@query("d5_union_entries", CRAWL_SQL + " UNION ALL ".join(
    [entry_sql("t_visibility_hourly", VISIBILITY_SQL), entry_sql("t_osa_hourly", OSA_AMAZON_SQL),
     entry_sql("t_osa_daily", DAILY_SQL)]))
def union_cases(spark, d):
    crawl, parts = view(spark, d, CRAWL), []
    for name, keys in (("visibility/amazon", KEYS), ("osa/amazon", ["date_stamp", "hour_stamp"]),
                       ("osa_daily/amazon", KEYS)):
        parts.append(fl.fingerprint_cases(fl.failure_records(crawl, shipped_rules(name)), keys))
    return fl.union_entries(*parts).select("dataset", "rule_id", "failed_count", "failed_share")


BASE_RULES = {r: c for r, c in VISIBILITY_SQL.items()
              if r not in ("relative_rank_must_not_null", "campaign_id_not_null", "platform_constant")}


@query("d5_platforms_one_scan", f"WITH crawl AS ({duck(MARKET)})," + f"""
amazon AS (SELECT * FROM crawl WHERE platform = 'Amazon'), flipkart AS (SELECT * FROM crawl WHERE platform = 'Flipkart'),
f AS (SELECT 'Amazon' AS platform, * FROM (SELECT rule_id, count(*) AS failed_count FROM (
    {union_of({r: c for r, c in VISIBILITY_SQL.items() if r != 'platform_constant'}, '1 AS one', 'amazon')}) GROUP BY rule_id)
  UNION ALL SELECT 'Flipkart', * FROM (SELECT rule_id, count(*) FROM ({union_of(BASE_RULES, '1 AS one', 'flipkart')}) GROUP BY rule_id)
  UNION ALL SELECT 'Flipkart', 'image_diversity', CAST(sum(n) AS BIGINT) FROM (
    SELECT keyword, time_stamp, sum(c) AS n FROM (SELECT keyword, time_stamp, product_image_url, count(*) AS c
      FROM flipkart GROUP BY ALL) GROUP BY keyword, time_stamp HAVING max(c)::DOUBLE / sum(c)::DOUBLE > 0.5))
SELECT platform, rule_id, failed_count,
  failed_count::DOUBLE / (SELECT count(*) FROM crawl c WHERE c.platform = f.platform)::DOUBLE AS failed_share FROM f""")
def platforms_one_scan(spark, d):
    sets = [shipped_rules("visibility/amazon"), shipped_rules("visibility/flipkart")]
    records = fl.failure_records(view(spark, d, MARKET), sets, platform_column="platform")
    return fl.fingerprint_cases(records, KEYS).select("platform", "rule_id", "failed_count", "failed_share")


CASE_RUNS = """
SELECT CASE WHEN user_id % 2 = 0 THEN 'even' ELSE 'odd' END AS dataset, event_type AS case_id,
  CAST(floor({epoch} / 14400) AS BIGINT) AS run_seq, value
FROM events
"""
SPARK_EPOCH, DUCK_EPOCH = "(unix_micros(CAST(ts AS TIMESTAMP)) / 1000000)", "epoch(ts)"


@query("d6_recurrence_streak", f"""
WITH e AS ({CASE_RUNS.format(epoch=DUCK_EPOCH)}),
runs AS (SELECT dataset, run_seq, row_number() OVER (PARTITION BY dataset ORDER BY run_seq) AS place
  FROM (SELECT DISTINCT dataset, run_seq FROM e)),
seen AS (SELECT DISTINCT dataset, case_id, run_seq, place FROM e JOIN runs USING (dataset, run_seq) WHERE value > 120),
isl AS (SELECT *, place - row_number() OVER (PARTITION BY dataset, case_id ORDER BY place) AS g FROM seen)
SELECT dataset, case_id, run_seq, CAST(row_number() OVER (PARTITION BY dataset, case_id, g ORDER BY place) AS INT) AS recurrence
FROM isl""")
def streaks(spark, d):
    runs = view(spark, d, CASE_RUNS.format(epoch=SPARK_EPOCH))
    return fl.recurrence_streak(runs.where("value > 120"), runs)


STREAK_CASES = "SELECT concat(event_type, '|', CAST(user_id AS STRING)) AS case_id, value, ts FROM events"


@query("d6_next_streaks", f"""
WITH e AS ({duck(STREAK_CASES)}),
now AS (SELECT DISTINCT case_id FROM e WHERE ts >= TIMESTAMP '2024-01-20' AND value > 60),
past AS (SELECT case_id, count(*) AS recurrence FROM e WHERE ts < TIMESTAMP '2024-01-20' AND value > 60 GROUP BY case_id)
SELECT case_id, coalesce(recurrence, 0) + 1 AS recurrence FROM now LEFT JOIN past USING (case_id)""")
def next_streaks(spark, d):
    e = view(spark, d, STREAK_CASES).where("value > 60")
    now = e.where("ts >= TIMESTAMP_NTZ '2024-01-20'").select("case_id").distinct()
    past = e.where("ts < TIMESTAMP_NTZ '2024-01-20'").groupBy("case_id").agg(F.count(F.lit(1)).alias("recurrence"))
    return fl.next_streaks(now, past)


# ------------------------------------------------------------------ queue

QUEUE = CRAWL_CASES + """,
queue AS (SELECT *, row_number() OVER (ORDER BY CASE WHEN severity = 'error' THEN 0 ELSE 1 END, failed_count DESC, case_id) AS queue_no
  FROM cases WHERE on_fail = 'investigate')"""


@query("d7_severity_order", QUEUE + """
SELECT case_id, severity, failed_count, CAST(queue_no AS INT) AS queue_no FROM queue""")
def severity_order(spark, d):
    return esc.severity_order(amazon_cases(spark, d)).select("case_id", "severity", "failed_count", "queue_no")


@query("d8_budgeted_queue", QUEUE + """
SELECT case_id, CAST(2 * (queue_no - 1) AS BIGINT) AS calls_before, 2 * (queue_no - 1) < 7 AS admitted FROM queue""")
def budgeted_queue(spark, d):
    return esc.budgeted_queue(esc.severity_order(amazon_cases(spark, d)), cap=7).select(
        "case_id", "calls_before", "admitted")


@query("d9_resume_queue", QUEUE + f""", v AS ({duck(CASE_VERDICTS)})
SELECT case_id, CAST(queue_no AS INT) AS queue_no FROM queue
WHERE NOT EXISTS (SELECT 1 FROM v WHERE v.case_id = queue.case_id AND v.true_positive)""")
def resume_queue(spark, d):
    done = view(spark, d, CASE_VERDICTS).where("true_positive")
    return esc.resume_queue(esc.severity_order(amazon_cases(spark, d)), done).select("case_id", "queue_no")


# ------------------------------------------------------------------ verdicts and escalation

def roll_up(verdicts: str, keys: str = "case_id") -> str:
    """Case verdict: first true positive, else first false positive, else a failure note."""
    return f"""
v AS ({duck(verdicts)}),
p AS (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY
    CASE WHEN true_positive THEN 0 WHEN NOT true_positive THEN 1 WHEN error IS NOT NULL THEN 2 ELSE 3 END, row_seq) AS no FROM v),
c AS (SELECT {keys}, count(*) FILTER (WHERE true_positive) AS true_positive_count,
    count(*) FILTER (WHERE NOT true_positive) AS false_positive_count,
    count(*) FILTER (WHERE error IS NOT NULL) AS failed_investigation_count, count(*) AS row_verdicts FROM v GROUP BY {keys}),
verdict AS (SELECT {keys}, p.true_positive, p.cause, p.confidence, p.explanation, true_positive_count, false_positive_count,
    failed_investigation_count, row_verdicts,
    CASE WHEN p.error IS NOT NULL THEN concat(failed_investigation_count, '/', row_verdicts,
      ' row(s) failed investigation (see row_verdicts for each error)') END AS error
  FROM c JOIN p USING ({keys}) WHERE no = 1)"""


@query("d11_case_verdict", "WITH" + roll_up(VERDICTS) + """
SELECT case_id, true_positive, cause, confidence, explanation, error, true_positive_count, failed_investigation_count FROM verdict""",
       text=("true_positive",))
def case_verdict(spark, d):
    return esc.case_verdict(view(spark, d, VERDICTS)).select(
        "case_id", "true_positive", "cause", "confidence", "explanation", "error", "true_positive_count",
        "failed_investigation_count")


def judged(spark: SparkSession, d: str, **policy) -> DataFrame:
    """Cases with their verdict, a recurrence and escalation reasons."""
    verdicts = esc.case_verdict(view(spark, d, CASE_VERDICTS))
    cases = amazon_cases(spark, d).withColumn("recurrence", F.length("rule_id") % 4)
    return esc.escalation_reasons(cases.join(verdicts, "case_id", "left"), **policy)


JUDGED = CRAWL_CASES + "," + roll_up(CASE_VERDICTS) + """,
judged AS (SELECT cases.*, verdict.* EXCLUDE (case_id), CAST(length(rule_id) % 4 AS INT) AS recurrence,
  CASE WHEN coalesce(true_positive AND confidence >= 0.6, FALSE) THEN 'ai_verdict' END AS r1,
  CASE WHEN confidence < 0.6 THEN 'low_confidence' END AS r2
  FROM cases LEFT JOIN verdict USING (case_id))"""
REASONS = "concat_ws(',', r1, r2)"
POLICY = {"min_confidence": 0.6}


@query("d10_escalation_reasons", JUDGED + f"SELECT case_id, {REASONS} AS reasons FROM judged")
def escalation_reasons(spark, d):
    return judged(spark, d, **POLICY).select("case_id", F.array_join("escalation_reasons", ",").alias("reasons"))


@query("d10_escalation_floor", JUDGED + """
SELECT case_id, concat_ws(',', r1, r2,
  CASE WHEN NOT (severity = 'warn' AND on_fail = 'report_only') AND failed_share > 0.05 THEN 'failed_share' END,
  CASE WHEN NOT (severity = 'warn' AND on_fail = 'report_only') AND recurrence >= 2 THEN 'recurrence' END) AS reasons
FROM judged""")
def escalation_floor(spark, d):
    return judged(spark, d, share_floor=0.05, recur_after=2, **POLICY).select(
        "case_id", F.array_join("escalation_reasons", ",").alias("reasons"))


ALERTS = JUDGED + f""",
alerts AS (SELECT *, CASE WHEN error IS NOT NULL THEN 'investigation_failed' ELSE coalesce(cause, 'not_investigated') END AS alert_cause,
  CASE WHEN error IS NOT NULL THEN error ELSE coalesce(nullif(explanation, ''), two_details) END AS summary
  FROM judged WHERE {REASONS} <> '')"""


@query("d12_alert_rows", ALERTS + """
SELECT case_id, severity, alert_cause AS cause, confidence, summary, failed_count, true_positive_count,
  failed_investigation_count, failed_share, recurrence FROM alerts""")
def alert_rows(spark, d):
    return rep.alert_rows(judged(spark, d, **POLICY)).select(
        "case_id", "severity", "cause", "confidence", "summary", "failed_count", "true_positive_count",
        "failed_investigation_count", "failed_share", "recurrence")


@query("d13_digest_rows", JUDGED + f"""
SELECT case_id, severity, failed_count, failed_share, recurrence, first_detail AS detail, cause
FROM judged WHERE {REASONS} = ''""")
def digest_rows(spark, d):
    return rep.digest_rows(judged(spark, d, **POLICY)).select(
        "case_id", "severity", "failed_count", "failed_share", "recurrence", "detail", "cause")


@query("d14_run_summary", JUDGED + f"""
SELECT count(*) AS total_cases, count(*) FILTER (WHERE on_fail = 'investigate') AS investigated,
  count(*) FILTER (WHERE {REASONS} <> '') AS escalations FROM judged""")
def run_summary(spark, d):
    return rep.run_summary(judged(spark, d, **POLICY))


@query("d15_actionable_split", ALERTS + """
SELECT case_id, alert_cause AS cause, alert_cause NOT IN ('legitimate', 'not_applicable') AS actionable FROM alerts""")
def actionable_split(spark, d):
    return rep.actionable_split(rep.alert_rows(judged(spark, d, **POLICY))).select("case_id", "cause", "actionable")


@query("d16_impact_rank", ALERTS + """
SELECT case_id, CAST(row_number() OVER (ORDER BY failed_share DESC, recurrence DESC, failed_count DESC, case_id) AS INT) AS impact_rank
FROM alerts""")
def impact_rank(spark, d):
    return rep.impact_rank(rep.alert_rows(judged(spark, d, **POLICY))).select("case_id", "impact_rank")


@query("d17_share_mismatch", CRAWL_SQL + "," + FAILS + """,
s AS (SELECT rule_id, sum(failed_count)::DOUBLE / (SELECT count(*) FROM crawl)::DOUBLE AS share FROM failures GROUP BY rule_id)
SELECT rule_id, keyword, time_stamp, failed_count::DOUBLE / total_count::DOUBLE AS implied_share,
  abs(failed_count::DOUBLE / total_count::DOUBLE - share) > 0.15 AS share_mismatch
FROM failures JOIN s USING (rule_id)""", text=("time_stamp",))
def share_mismatch(spark, d):
    records = amazon_failures(spark, d)
    per_case = (records.groupBy("rule_id").agg((F.sum("failed_count") / F.max("entry_rows")).alias("share")))
    return rep.share_mismatch(records.join(per_case, "rule_id"), "detail", "share").select(
        "rule_id", *KEYS, "implied_share", "share_mismatch")


@query("d18_crawl_label_sample", CRAWL_SQL + f""",
f AS (SELECT DISTINCT rule_id, date_stamp, hour_stamp FROM ({union_of(OSA_AMAZON_SQL, 'date_stamp, hour_stamp')})),
r AS (SELECT *, count(*) OVER (PARTITION BY rule_id) AS total_crawls,
  row_number() OVER (PARTITION BY rule_id ORDER BY date_stamp, hour_stamp) AS no FROM f)
SELECT rule_id, total_crawls, string_agg(concat(date_stamp, ' hour ', hour_stamp), ', ' ORDER BY no) AS labels
FROM r WHERE no <= 8 GROUP BY rule_id, total_crawls""")
def crawl_labels(spark, d):
    records = fl.failure_records(view(spark, d, CRAWL), shipped_rules("osa/amazon"))
    return fl.crawl_label_sample(records, ["date_stamp", "hour_stamp"]).select(
        "rule_id", "total_crawls", F.array_join("labels", ", ").alias("labels"))


# ------------------------------------------------------------------ drill-down

RANGE = "date_stamp BETWEEN DATE '1997-01-01' AND DATE '1997-12-31' AND hour_stamp BETWEEN 3 AND 20"


@query("d19_failing_rows", CRAWL_SQL + f"""
SELECT keyword, date_stamp, hour_stamp, platform_code, sp, mrp FROM crawl WHERE {RANGE} AND sp > mrp""", text=("date_stamp",))
def failing_rows(spark, d):
    rule = shipped_rules("visibility/amazon").get("sp_not_above_mrp")
    return rep.failing_rows(view(spark, d, CRAWL), rule, F.expr(RANGE)).select(
        "keyword", "date_stamp", "hour_stamp", "platform_code", "sp", "mrp")


@query("d20_dominant_value_drilldown", CRAWL_SQL + """,
n AS (SELECT keyword, time_stamp, product_image_url, count(*) AS occurrences,
  CAST(sum(count(*)) OVER (PARTITION BY keyword, time_stamp) AS BIGINT) AS crawl_rows FROM crawl
  GROUP BY keyword, time_stamp, product_image_url)
SELECT *, occurrences::DOUBLE / crawl_rows::DOUBLE AS share FROM n WHERE occurrences::DOUBLE / crawl_rows::DOUBLE > 0.5""",
       text=("time_stamp",))
def dominant_value(spark, d):
    return rep.dominant_value_drilldown(view(spark, d, CRAWL), "product_image_url", KEYS)


@query("d20_frequent_values", CRAWL_SQL + """,
n AS (SELECT keyword, time_stamp, stock_status, count(*) AS occurrences,
  CAST(sum(count(*)) OVER (PARTITION BY keyword, time_stamp) AS BIGINT) AS crawl_rows FROM crawl
  GROUP BY keyword, time_stamp, stock_status)
SELECT *, occurrences::DOUBLE / crawl_rows::DOUBLE AS share FROM n WHERE occurrences::DOUBLE / crawl_rows::DOUBLE > 0.3""",
       text=("time_stamp",))
def frequent_values(spark, d):
    return rep.dominant_value_drilldown(view(spark, d, CRAWL), "stock_status", KEYS, 0.3)


@query("d20_heavy_values", CRAWL_SQL + """,
n AS (SELECT keyword, seller, count(*) AS occurrences,
  CAST(sum(count(*)) OVER (PARTITION BY keyword) AS BIGINT) AS group_rows FROM crawl GROUP BY keyword, seller)
SELECT *, occurrences::DOUBLE / group_rows::DOUBLE AS share FROM n WHERE occurrences::DOUBLE / group_rows::DOUBLE > 0.02""")
def frequent_by_sketch(spark, d):
    return heavy_values.heavy_values(view(spark, d, CRAWL), "seller", ["keyword"], 0.02)


@query("d21_drilldown_count", CRAWL_SQL + " UNION ALL ".join(
    f"SELECT '{r}' AS rule_id, count(*) AS failing_rows FROM crawl WHERE {RANGE} AND ({g}) AND ({bad})"
    for r, (g, bad, _, _) in OSA_AMAZON_SQL.items()))
def drilldown_count(spark, d):
    return rep.drilldown_counts(view(spark, d, CRAWL), shipped_rules("osa/amazon").rules, F.expr(RANGE))


@query("case_rollup", CRAWL_SQL + """,
x AS (""" + " UNION ALL ".join([entry_sql("t_visibility_hourly", VISIBILITY_SQL), entry_sql("t_osa_hourly", OSA_AMAZON_SQL)]) + """)
SELECT dataset, platform, rule_id, CAST(sum(failed_count) AS BIGINT) AS failed_count, count(*) AS cases
FROM (SELECT *, 'Amazon' AS platform FROM x) GROUP BY ROLLUP (dataset, platform, rule_id)""")
def case_rollup(spark, d):
    crawl = view(spark, d, CRAWL)
    parts = [fl.fingerprint_cases(fl.failure_records(crawl, shipped_rules(n)), k)
             for n, k in (("visibility/amazon", KEYS), ("osa/amazon", ["date_stamp", "hour_stamp"]))]
    return fl.case_rollup(fl.union_entries(*parts))

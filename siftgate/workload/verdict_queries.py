"""Registered queries: reconciliation, verdicts, replies and call statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from siftgate.operators import call_stats as cs, escalation as esc, reconcile as rc
from siftgate.plans.rules import Rule
from siftgate.workload.case_queries import roll_up
from siftgate.workload.registry import query
from siftgate.workload.views import CALLS, EXTRACTION, REPLIES, RUN_WINDOWS, STORED, VERDICTS, duck, view

COLUMNS = ["product_name", "sp", "stock_status", "seller"]
STORED_SQL = f"WITH s AS ({duck(STORED)}), x AS ({duck(EXTRACTION)})"


def extraction(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, EXTRACTION).withColumnRenamed("field", "column")


def same_sql(stored: str, shown: str) -> str:
    num = "CASE WHEN regexp_matches({0}, '^ *[0-9]+([.][0-9]*)?(E[0-9]+)? *$') THEN TRY_CAST(trim({0}) AS DOUBLE) END"
    return f"coalesce({num.format(stored)} = {num.format(shown)}, trim({stored}) = trim({shown}), FALSE)"


RECONCILED = f""", t AS (SELECT row_id, 0 AS column_no, 'product_name' AS field, CAST(product_name AS VARCHAR) AS v FROM s
  UNION ALL SELECT row_id, 1, 'sp', CAST(sp AS VARCHAR) FROM s UNION ALL SELECT row_id, 2, 'stock_status', stock_status FROM s
  UNION ALL SELECT row_id, 3, 'seller', NULL FROM s),
first_x AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY row_id, field ORDER BY seq) AS k FROM x) WHERE k = 1),
rec AS (SELECT t.row_id, CAST(column_no AS INT) AS column_no, t.field, html_value, current_xpath, working_xpath,
  {same_sql('v', 'html_value')} AS match FROM t LEFT JOIN first_x USING (row_id, field))"""


@query("f1_reconcile_columns", STORED_SQL + RECONCILED + """
SELECT row_id, field, html_value, current_xpath, working_xpath, match FROM rec""")
def reconcile_columns(spark, d):
    return rc.reconcile_columns(view(spark, d, STORED), extraction(spark, d), ["row_id"], COLUMNS).select(
        "row_id", F.col("column").alias("field"), "html_value", "current_xpath", "working_xpath", "match")


@query("f2_reconcile_completeness", STORED_SQL + RECONCILED + """
SELECT row_id, string_agg(field, ',' ORDER BY column_no) AS fields, count(*) AS n, count(html_value) AS shown FROM rec GROUP BY row_id""")
def reconcile_completeness(spark, d):
    rec = rc.reconcile_columns(view(spark, d, STORED), extraction(spark, d), ["row_id"], COLUMNS)
    return rec.groupBy("row_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("column_no", "column"))), lambda x: x["column"]), ",")
        .alias("fields"), F.count(F.lit(1)).alias("n"), F.count("html_value").alias("shown"))


SP_RULE = Rule("sp_not_above_mrp", "compare", "sp", {"expr": "sp <= mrp"}, when="sp is not null and mrp is not null")
POSITIVE_RULE = Rule("sp_positive", "range", "sp", {"min": 1})
STOCK_RULE = Rule("stock_status_valid", "allowed_values", "stock_status", {"values": ["In Stock", "Out of Stock"]})
NAME_RULE = Rule("name_present", "not_null", "product_name")
VERDICT_COLUMNS = ["rule_id", "row_id", "true_positive", "cause", "confidence"]


def verdict_sql(rule: str, fails: str, page_bad: str | None, field: str) -> str:
    """Decision table; ``page_bad`` marks a business rule. Every 18th row has no page; other pages lack the value."""
    drift = "CASE WHEN current_xpath <> working_xpath THEN 'xpath_drift' ELSE 'genuine_data_issue' END"
    stock = ("html_value IN ('Available', 'In Stock') AND s.stock_status IN ('In Stock') OR "
             "html_value IN ('Notify me', 'Out of Stock') AND s.stock_status IN ('Out of Stock', 'Notify me')"
             if field == "stock_status" else "FALSE")
    legit = f"WHEN {page_bad} THEN 'legitimate'" if page_bad else ""
    return f"""SELECT '{rule}' AS rule_id, row_id, CASE WHEN row_id % 18 = 0 THEN 'unknown' WHEN {stock} THEN 'not_applicable'
  WHEN html_value IS NULL THEN {drift} {legit} WHEN match THEN 'not_applicable' ELSE {drift} END AS cause,
  CASE WHEN row_id % 18 = 0 OR html_value IS NULL THEN 0.5::DOUBLE ELSE 0.9::DOUBLE END AS confidence
FROM s JOIN rec USING (row_id) WHERE field = '{field}' AND ({fails})"""


PAGE_SP = "TRY_CAST(trim(html_value) AS DOUBLE)"


@query("f3_rule_based_verdict", STORED_SQL + RECONCILED + ", v AS (" + "\nUNION ALL\n".join([
    verdict_sql("sp_not_above_mrp", "sp > mrp", f"{PAGE_SP} > mrp", "sp"),
    verdict_sql("sp_positive", "sp < 1", f"{PAGE_SP} < 1", "sp"),
    verdict_sql("stock_status_valid", "s.stock_status NOT IN ('In Stock', 'Out of Stock')", None, "stock_status"),
    verdict_sql("name_present", "product_name IS NULL", None, "product_name")]) + """)
SELECT rule_id, row_id, cause IN ('unknown', 'xpath_drift', 'genuine_data_issue') AS true_positive, cause, confidence FROM v""")
def rule_based_verdict(spark, d):
    stored = view(spark, d, STORED).withColumn("html_available", F.col("row_id") % 18 != 0)
    rules = [SP_RULE, POSITIVE_RULE, STOCK_RULE, NAME_RULE]
    return rc.rule_set_verdicts(stored, extraction(spark, d), ["row_id"], rules).select(*VERDICT_COLUMNS)


@query("f4_majority_cause", f"WITH v AS ({duck(VERDICTS)})," + """
n AS (SELECT case_id, cause, count(*) AS n FROM v WHERE true_positive AND cause IS NOT NULL GROUP BY ALL),
r AS (SELECT *, rank() OVER (PARTITION BY case_id ORDER BY n DESC) AS k FROM n),
m AS (SELECT case_id, CASE WHEN count(*) = 1 THEN min(cause) ELSE 'unknown' END AS majority_cause FROM r WHERE k = 1 GROUP BY case_id)
SELECT case_id, coalesce(bool_or(true_positive), FALSE) AS case_true_positive,
  count(*) FILTER (WHERE true_positive) AS true_positive_rows, any_value(majority_cause) AS majority_cause
FROM v LEFT JOIN m USING (case_id) GROUP BY case_id""")
def majority_cause(spark, d):
    return esc.majority_cause(view(spark, d, VERDICTS))


@query("f5_attach_selector", STORED_SQL + """,
f AS (SELECT row_id, field, min(current_xpath) AS current_xpath FROM x WHERE current_xpath <> '' GROUP BY ALL)
SELECT s.row_id, c.field, f.current_xpath FROM s CROSS JOIN (VALUES ('sp'), ('stock_status'), ('rating')) c(field)
LEFT JOIN f ON f.row_id = s.row_id AND f.field = c.field""")
def attach_selector(spark, d):
    verdicts = view(spark, d, STORED).select("row_id", F.explode(F.array(*[
        F.lit(c) for c in ("sp", "stock_status", "rating")])).alias("column"))
    return rc.attach_selector(verdicts, extraction(spark, d), ["row_id"]).select(
        "row_id", F.col("column").alias("field"), "current_xpath")


@query("f6_drift_flag", STORED_SQL + """
SELECT row_id, field, seq, CASE WHEN nullif(current_xpath, '') <> nullif(working_xpath, '') THEN 'drift'
  WHEN nullif(working_xpath, '') IS NOT NULL THEN 'suggested_only' WHEN nullif(current_xpath, '') IS NOT NULL THEN 'current_only' END AS drift
FROM x""")
def drift_flag(spark, d):
    x = view(spark, d, EXTRACTION).withColumnRenamed("working_xpath", "suggested_xpath")
    return rc.drift_flag(x).select("row_id", "field", "seq", "drift")


@query("f7_parse_replies", """
SELECT event_id, CASE WHEN event_type = 'error' THEN 'no_json' WHEN event_type = 'signup' THEN CASE WHEN user_id % 2 = 0 THEN 'no_json' ELSE 'malformed' END
    WHEN user_id % 5 = 0 OR user_id > 1 THEN 'invalid' ELSE 'valid' END AS reply_state,
  CASE WHEN event_type NOT IN ('error', 'signup') AND user_id % 5 <> 0 AND user_id <= 1 THEN
    CASE WHEN user_id % 3 = 0 THEN 'site_change' ELSE 'legitimate' END END AS cause,
  CASE WHEN event_type NOT IN ('error', 'signup') AND user_id % 5 <> 0 AND user_id <= 1 THEN concat('case ', event_id) END AS explanation
FROM events""")
def parse_replies(spark, d):
    return rc.parse_replies(view(spark, d, REPLIES), "text").select(
        "event_id", "reply_state", "reply.cause", "reply.explanation")


@query("f7_reply_validity", """
SELECT event_type, count(*) AS replies,
  count(*) FILTER (WHERE event_type NOT IN ('error', 'signup') AND user_id % 5 <> 0 AND user_id <= 1) AS valid,
  count(*) FILTER (WHERE event_type NOT IN ('error', 'signup') AND (user_id % 5 = 0 OR user_id > 1)) AS invalid,
  count(*) FILTER (WHERE event_type = 'signup' AND user_id % 2 = 1) AS malformed,
  count(*) FILTER (WHERE event_type = 'error' OR (event_type = 'signup' AND user_id % 2 = 0)) AS no_json
FROM events GROUP BY event_type""")
def reply_validity(spark, d):
    return rc.reply_validity(rc.parse_replies(view(spark, d, REPLIES), "text"), ["event_type"])


TEMPLATE = 'Rule {{ rule_id }} on {{status}}: stored {"name": "{{ product_name }}"}.'


@query("f8_prompt_table", STORED_SQL + """
SELECT row_id, concat('Rule sp_positive on ', stock_status, ': stored {"name": "', coalesce(product_name, 'None'), '"}.') AS prompt FROM s""")
def prompt_table(spark, d):
    return rc.prompt_table(view(spark, d, STORED), TEMPLATE, {
        "rule_id": F.lit("sp_positive"), "status": F.col("stock_status")}).select("row_id", "prompt")


@query("f9_drop_empty_fields", """
SELECT o_orderkey AS row_id, concat('{', array_to_string([x FOR x IN [
  CASE WHEN o_orderkey % 17 <> 0 THEN concat('"name":"', o_orderpriority, '"') END,
  CASE WHEN o_orderkey % 5 <> 0 THEN concat('"note":"', o_orderstatus, '"') END,
  CASE WHEN o_orderkey % 13 <> 0 THEN concat('"customer":', o_custkey) END] IF x IS NOT NULL], ','), '}') AS row_json FROM orders""")
def drop_empty_fields(spark, d):
    rows = view(spark, d, """SELECT o_orderkey AS row_id, CASE WHEN o_orderkey % 17 <> 0 THEN o_orderpriority END AS name,
      CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE o_orderstatus END AS note,
      CASE WHEN o_orderkey % 13 <> 0 THEN o_custkey END AS customer FROM orders""")
    return rows.select("row_id", rc.drop_empty_fields(rows, ["name", "note", "customer"]).alias("row_json"))


# ------------------------------------------------------------------ call statistics

# All cases of the runs; rules 20 to 24 are never judged.
RUN_CASES = """
SELECT concat('t_visibility|Amazon|rule_', CAST(user_id % 20 AS STRING)) AS case_id, concat('model-', CAST(user_id % 3 AS STRING)) AS model,
  CAST(event_id % 4 AS INT) AS run FROM events
UNION SELECT concat('t_visibility|Amazon|rule_', CAST(20 + user_id % 5 AS STRING)), concat('model-', CAST(user_id % 3 AS STRING)),
  CAST(event_id % 4 AS INT) FROM events
"""
RUN_STATS = "WITH" + roll_up(VERDICTS, "model, run, case_id") + f""", k AS ({duck(RUN_CASES)}),
stats AS (SELECT model, run, count(*) AS cases,
  count(*) FILTER (WHERE coalesce(true_positive AND confidence >= 0.5, FALSE) OR coalesce(confidence < 0.6, FALSE)) AS escalated_cases,
  CAST(coalesce(sum(true_positive_count), 0) AS BIGINT) AS true_positive_rows,
  CAST(coalesce(sum(false_positive_count), 0) AS BIGINT) AS false_positive_rows,
  CAST(coalesce(sum(failed_investigation_count), 0) AS BIGINT) AS failed_llm_rows,
  CAST(coalesce(sum(row_verdicts - failed_investigation_count), 0) AS BIGINT) AS investigated_rows
  FROM k LEFT JOIN verdict USING (model, run, case_id) GROUP BY model, run)"""


@query("g1_run_stats", RUN_STATS + "SELECT * FROM stats")
def run_stats(spark, d):
    return cs.run_stats(view(spark, d, VERDICTS), cases=view(spark, d, RUN_CASES))


CALLS_SQL = f"WITH c AS ({duck(CALLS)})"


@query("g2_latency_stats", CALLS_SQL + """
SELECT model, run, count(*) AS call_count, round(avg(latency_s), 2) AS avg_latency_s,
  round(avg(nullif(completion_tokens, 0)), 1) AS avg_completion_tokens FROM c GROUP BY model, run""")
def latency_stats(spark, d):
    return cs.latency_stats(view(spark, d, CALLS), ["model", "run"])


@query("g3_p95_exclusive", CALLS_SQL + """,
r AS (SELECT model, run, latency_s AS v, row_number() OVER w AS k, count(*) OVER (PARTITION BY model, run) AS n
  FROM c WINDOW w AS (PARTITION BY model, run ORDER BY latency_s)),
j AS (SELECT *, greatest(1, least(19 * (n + 1) // 20, n - 1)) AS j FROM r)
SELECT model, run, max(n) AS values, round((max(v) FILTER (WHERE k = j) * (20 - (19 * (max(n) + 1) - 20 * max(j)))
  + max(v) FILTER (WHERE k = j + 1) * (19 * (max(n) + 1) - 20 * max(j))) / 20.0::DOUBLE, 9) AS p95
FROM j GROUP BY model, run""")
def p95(spark, d):
    return cs.quantile_exclusive(view(spark, d, CALLS), ["model", "run"], "latency_s").withColumn("p95", F.round("p95", 9))


# The calls of the verdict runs, for their latencies. The last run of a model made none.
MODEL_CALLS = """
SELECT concat('model-', CAST(user_id % 3 AS STRING)) AS model, CAST(event_id % 4 AS INT) AS run, value / 10.0D AS latency_s,
  CAST(0 AS INT) AS completion_tokens
FROM events WHERE event_id % 4 <> 3 OR user_id % 3 <> 2
"""


@query("g4_model_summary", RUN_STATS + f""",
m AS (SELECT model, run, round(avg(latency_s), 2) AS avg_latency_s FROM ({duck(MODEL_CALLS)}) x GROUP BY model, run),""" + """
l AS (SELECT stats.*, CASE WHEN run = 3 THEN concat('run ', run, ' stopped') END AS error, CAST(round(avg_latency_s * 100) AS BIGINT) AS cents
  FROM stats LEFT JOIN m USING (model, run))
SELECT model, count(*) AS runs, count(error) AS runs_with_error, CAST(sum(investigated_rows + failed_llm_rows) AS BIGINT) AS total_rows_attempted,
  CAST(sum(failed_llm_rows) AS BIGINT) AS total_llm_call_failures,
  round(sum(failed_llm_rows)::DOUBLE / sum(investigated_rows + failed_llm_rows)::DOUBLE, 3) AS call_failure_rate,
  CAST(sum(true_positive_rows) AS BIGINT) AS total_true_positive_rows, CAST(sum(false_positive_rows) AS BIGINT) AS total_false_positive_rows,
  CAST(sum(escalated_cases) AS BIGINT) AS total_escalated_cases, CAST((2 * sum(cents) + count(cents)) // (2 * count(cents)) AS DOUBLE) / 100 AS avg_latency_s,
  string_agg(error, ';' ORDER BY error) AS run_errors
FROM l GROUP BY model""")
def model_summary(spark, d):
    runs = (cs.run_stats(view(spark, d, VERDICTS), cases=view(spark, d, RUN_CASES))
            .withColumn("error", F.when(F.col("run") == 3, F.concat(F.lit("run "), F.col("run").cast("string"), F.lit(" stopped"))))
            .join(cs.latency_stats(view(spark, d, MODEL_CALLS), ["model", "run"]), ["model", "run"], "left"))
    return cs.model_summary(runs).withColumn("run_errors", F.array_join("run_errors", ";"))


@query("g5_log_window_join", CALLS_SQL + f""", w AS ({duck(RUN_WINDOWS)})
SELECT w.model, w.run AS bench_run, count(*) AS calls, CAST(sum(completion_tokens) AS BIGINT) AS tokens
FROM c JOIN w ON c.model = w.model AND c.ts BETWEEN w.started AND w.ended GROUP BY w.model, w.run""")
def log_window_join(spark, d):
    windows = view(spark, d, RUN_WINDOWS).withColumnRenamed("run", "bench_run")
    hit = cs.log_window_join(view(spark, d, CALLS), windows, bucket_seconds=6 * 3600, start="started", end="ended")
    return hit.groupBy("model", "bench_run").agg(F.count(F.lit(1)).alias("calls"),
                                                 F.sum("completion_tokens").alias("tokens"))

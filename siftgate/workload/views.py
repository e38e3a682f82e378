"""Inputs of the registered queries, derived from the given tables by SQL.

Each view is one SQL text used for both engines; only type names and literals differ.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()

# One row per line item, with gaps, blanks and bad values planted by key.
CRAWL = """
SELECT
  p.p_brand AS keyword,
  CAST(date_trunc('month', l.l_shipdate) AS TIMESTAMP_NTZ) AS time_stamp,
  CAST(l.l_shipdate AS DATE) AS date_stamp,
  CAST(l.l_orderkey % 24 AS INT) AS hour_stamp,
  CASE WHEN l.l_suppkey % 50 = 0 THEN 'amazon' ELSE 'Amazon' END AS platform,
  CASE WHEN l.l_partkey % 97 = 0 THEN NULL
       WHEN l.l_partkey % 89 = 0 THEN '  '
       WHEN l.l_partkey % 83 = 0 THEN concat('X0', lpad(CAST(l.l_partkey AS STRING), 8, '0'))
       ELSE concat('B0', lpad(CAST(l.l_partkey AS STRING), 8, '0')) END AS platform_code,
  CASE WHEN l.l_partkey % 61 = 0 THEN 'n/a' ELSE p.p_name END AS product_name,
  CASE WHEN l.l_partkey % 53 = 0 THEN NULL
       WHEN l.l_partkey % 47 = 0 THEN CAST(0 AS DOUBLE)
       ELSE l.l_extendedprice / l.l_quantity END AS sp,
  CASE WHEN l.l_partkey % 59 = 0 THEN NULL ELSE p.p_retailprice * 2.0D END AS mrp,
  CASE WHEN l.l_suppkey % 10 = 0 THEN NULL ELSE CAST(l.l_orderkey % 7 AS DOUBLE) END AS rating,
  CASE WHEN l.l_partkey % 11 = 0 THEN NULL ELSE CAST(l.l_quantity AS INT) END AS num_of_rating,
  CASE WHEN l.l_returnflag = 'A' THEN 'In Stock'
       WHEN l.l_returnflag = 'N' THEN 'Out of Stock'
       WHEN l.l_linestatus = 'F' THEN 'Currently unavailable'
       ELSE 'Notify me' END AS stock_status,
  CASE WHEN l.l_suppkey % 13 = 0 THEN NULL ELSE concat('Supplier#', CAST(l.l_suppkey AS STRING)) END AS seller,
  CAST(l.l_quantity AS INT) + 15 AS delivery_days,
  CASE l.l_linenumber WHEN 1 THEN 'SP' WHEN 2 THEN 'SB' WHEN 3 THEN 'SBV' WHEN 4 THEN 'SD' ELSE 'ORGANIC' END AS product_type,
  CASE WHEN l.l_linenumber <= 4 AND l.l_partkey % 5 <> 0 THEN concat('C', CAST(l.l_partkey AS STRING)) END AS campaign_id,
  CASE WHEN l.l_suppkey % 2 = 0 THEN 'https://img.example/placeholder.svg'
       ELSE concat('https://img.example/', CAST(l.l_partkey AS STRING), '.jpg') END AS product_image_url,
  l.l_linenumber AS absolute_rank,
  CASE WHEN l.l_orderkey % 41 = 0 THEN NULL ELSE l.l_linenumber END AS relative_rank
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
"""

# The same rows on two platforms, for jobs over several rule sets.
MARKET = CRAWL.replace("CASE WHEN l.l_suppkey % 50 = 0 THEN 'amazon' ELSE 'Amazon' END AS platform",
                       "CASE WHEN l.l_suppkey % 50 = 0 THEN 'amazon' WHEN l.l_suppkey % 3 = 0 THEN 'Flipkart'\n"
                       "       ELSE 'Amazon' END AS platform")

# Row verdicts of 20 cases. Odd rules have no true positive, rule 1 has only errors.
VERDICTS = """
SELECT concat('t_visibility|Amazon|rule_', CAST(user_id % 20 AS STRING)) AS case_id,
  event_id AS row_seq,
  CASE WHEN failed THEN NULL
       WHEN event_type = 'purchase' AND user_id % 2 = 0 THEN TRUE ELSE FALSE END AS true_positive,
  CASE WHEN failed THEN NULL
       WHEN event_type = 'purchase' THEN CASE WHEN value > 60 THEN 'site_change' ELSE 'xpath_drift' END
       WHEN event_type = 'view' THEN 'not_applicable'
       WHEN event_type = 'click' THEN 'legitimate' ELSE 'unknown' END AS cause,
  CASE WHEN NOT failed THEN value / 500.0D END AS confidence,
  CASE WHEN NOT failed THEN concat('seen ', CAST(event_id AS STRING)) END AS explanation,
  CASE WHEN failed THEN concat('timeout ', CAST(event_id AS STRING)) END AS error,
  concat('model-', CAST(user_id % 3 AS STRING)) AS model,
  CAST(event_id % 4 AS INT) AS run
FROM (SELECT *, event_type = 'error' OR user_id % 20 = 1 AS failed FROM events) e
"""

CALLS = """
SELECT event_type AS model, ts, CAST(user_id % 5 AS INT) AS run, value / 10.0D AS latency_s,
  CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS completion_tokens, event_id AS call_id
FROM events
"""

# One benchmark run per model and user group: from its first to its last call.
RUN_WINDOWS = f"""
SELECT model, run, min(ts) AS started, max(ts) AS ended
FROM ({CALLS}) c GROUP BY model, run
"""

# Stored product rows keyed by order, and what the page of each one shows.
STORED = """
SELECT o_orderkey AS row_id,
  CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE concat('Order ', o_orderpriority) END AS product_name,
  CASE WHEN o_orderkey % 29 = 0 THEN CAST(0 AS DOUBLE) ELSE o_totalprice END AS sp,
  o_totalprice * CASE WHEN o_orderkey % 5 = 0 THEN 0.5D ELSE 2.0D END AS mrp,
  CAST(o_custkey % 6 AS DOUBLE) AS rating,
  CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE CAST(o_custkey AS INT) END AS num_of_rating,
  CASE o_orderstatus WHEN 'F' THEN 'In Stock' WHEN 'O' THEN 'Out of Stock' ELSE 'Notify me' END AS stock_status,
  CAST(o_orderdate AS DATE) AS date_stamp
FROM orders
"""

EXTRACTION = """
SELECT o_orderkey AS row_id, 'sp' AS field, 1 AS seq,
  CASE WHEN o_orderkey % 9 = 0 THEN NULL WHEN o_orderkey % 29 = 0 AND o_orderkey % 2 = 0 THEN '0'
       WHEN o_orderkey % 7 = 0 THEN '0.50' ELSE concat(' ', CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING), '0') END AS html_value,
  '//span[@class="price"]' AS current_xpath,
  CASE WHEN o_orderkey % 4 = 0 THEN '//div[@id="price"]/span' ELSE '//span[@class="price"]' END AS working_xpath
FROM orders
UNION ALL
SELECT o_orderkey, 'stock_status', 1,
  CASE WHEN o_orderkey % 9 = 0 THEN NULL WHEN o_orderstatus = 'F' THEN 'Available'
       WHEN o_orderkey % 5 = 0 THEN 'In Stock' WHEN o_orderkey % 3 = 0 THEN 'Notify me' ELSE 'Out of Stock' END,
  CASE WHEN o_orderkey % 6 = 0 THEN '//b' ELSE '' END, '//b'
FROM orders
UNION ALL
SELECT o_orderkey, 'product_name', 1,
  CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE concat('Order ', o_orderpriority, CASE WHEN o_orderkey % 8 = 0 THEN '!' ELSE ' ' END) END,
  CAST(NULL AS STRING), '//h1'
FROM orders
UNION ALL
SELECT o_orderkey, 'product_name', 2, 'second entry', '//h2', '//h2' FROM orders
"""

# Crawled pages with product blocks: the given page source plus elements carrying codes.
PRODUCT_PAGES = """
SELECT page_id, CAST(page_id % 7 AS INT) AS crawl, concat('page-', lpad(CAST(page_id AS STRING), 8, '0'), '.zip') AS object_name,
  replace(html, '</body>', concat(
    '<div data-component-type="s-search-result" data-asin="B0', lpad(CAST(page_id % 50 AS STRING), 8, '0'), '"><b>first</b></div>',
    '<div data-asin="B0', lpad(CAST(page_id AS STRING), 8, '0'), '"><i>own ', CAST(page_id AS STRING), '</i><script>x</script></div>',
    '<div data-asin="B0', lpad(CAST(page_id % 50 AS STRING), 8, '0'), '">again</div>',
    CASE WHEN page_id % 3 = 0 THEN '' ELSE concat('<div id="ppd"><h2>Product</h2><span>code B0',
      lpad(CAST(page_id + 1 AS STRING), 8, '0'), '</span></div>') END,
    CASE WHEN page_id % 11 = 0 THEN '<p>To discuss automated access</p>' ELSE '' END,
    '</body>')) AS html
FROM pages
"""

# Objects of the hourly crawls in which something was returned.
OBJECTS = f"""
SELECT concat('table=t_osa_hourly/date_stamp=', CAST(date_stamp AS STRING), '/hour_stamp=', CAST(hour_stamp AS STRING), '/',
              keyword, '_', CAST(date_stamp AS STRING), '_', CAST(hour_stamp AS STRING), '.zip') AS object_name,
       count(*) AS object_rows
FROM ({CRAWL}) c WHERE stock_status = 'Currently unavailable' GROUP BY keyword, date_stamp, hour_stamp
"""

# Model replies around the documents' labels and the events: clean, fenced, cut off, out of range.
REPLIES = """
SELECT event_id, event_type,
  CASE WHEN event_type = 'error' THEN concat('no answer for ', CAST(event_id AS STRING))
       WHEN event_type = 'signup' AND user_id % 2 = 0 THEN '{"true_positive": true, "cause": "xpath_drift", "confid'
       WHEN event_type = 'signup' THEN 'Here: {"true_positive": tru, "cause"} end'
       ELSE concat(CASE WHEN event_type = 'click' THEN 'Sure:\n```json\n' ELSE 'Verdict ' END,
         '{"true_positive": ', CASE WHEN user_id % 2 = 0 THEN 'true' ELSE 'false' END,
         ', "cause": "', CASE WHEN user_id % 5 = 0 THEN 'other' WHEN user_id % 3 = 0 THEN 'site_change' ELSE 'legitimate' END,
         '", "confidence": ', CAST(CAST(user_id AS DECIMAL(10,1)) AS STRING),
         ', "explanation": "case ', CAST(event_id AS STRING), '"}', CASE WHEN event_type = 'click' THEN '\n```\nDone {ok}' ELSE '' END) END AS text
FROM events
"""


def duck(sql: str) -> str:
    """The DuckDB form of a view text."""
    return (sql.replace("AS STRING", "AS VARCHAR").replace("TIMESTAMP_NTZ", "TIMESTAMP").replace("2.0D", "2.0::DOUBLE")
            .replace("0.5D", "0.5::DOUBLE").replace("500.0D", "500.0::DOUBLE").replace("10.0D", "10.0::DOUBLE"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """A view text over the tables of a folder, without registering anything in the session."""
    sql = sql.replace("{", "{{").replace("}", "}}")  # the SQL formatter reads braces
    used = {}
    for t in TABLES:
        for word in ("FROM", "JOIN"):
            if re.search(rf"{word} {t}\b", sql):
                used[t] = table(spark, sf_dir, t)
                sql = re.sub(rf"{word} {t}\b", f"{word} {{{t}}}", sql)
    return spark.sql(sql, **used)


# Verdicts for the cases of the Amazon search-result rules.
CASE_RULES = ["platform_constant", "platform_code_present", "name_present", "sp_positive", "sp_not_above_mrp",
              "rating_bounds", "num_of_rating_not_null", "relative_rank_not_null", "campaign_id_not_null"]
CASE_VERDICTS = VERDICTS.replace(
    "concat('t_visibility|Amazon|rule_', CAST(user_id % 20 AS STRING)) AS case_id",
    "concat('t_visibility_hourly|Amazon|', CASE user_id % 20 "
    + " ".join(f"WHEN {i + 1} THEN '{r}'" for i, r in enumerate(CASE_RULES)) + " ELSE 'other' END) AS case_id").replace("value / 500.0D", "CAST(user_id % 11 AS DOUBLE) / 10.0D")


def crawl_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, CRAWL)

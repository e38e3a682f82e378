"""Registered queries: sources, row checks and group checks."""

from __future__ import annotations

import io
import re
import zipfile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from siftgate.functions.values import count_where, null_normalise
from siftgate.operators.failures import failure_records
from siftgate.operators import heavy_values, opaque_checks
from siftgate.operators.group_checks import contiguous_gaps, group_rule_set, single
from siftgate.operators.row_checks import failing_counts, outside_table, passes, row_check, row_rule_set
from siftgate.plans.rules import Rule, RuleSet, guard, shipped_rules
from siftgate.sources import objects, page_objects, runs, storage, tables
from siftgate.streaming.live import write_stream
from siftgate.workload.registry import query
from siftgate.workload.views import CALLS, CRAWL, MARKET, duck, table, view

CRAWL_SQL = f"WITH crawl AS ({duck(CRAWL)})"
AS_OF = "1998-12-01 00:00:00"
BLANK = r"regexp_matches({c}, '[^\s]')"


# ------------------------------------------------------------------ sources and sinks

@query("a1_csv_source", CRAWL_SQL + """
SELECT keyword, count(*) AS n, count(platform_code) AS codes, CAST(sum(num_of_rating) AS BIGINT) AS ratings,
  max(sp) AS max_sp, max(date_stamp) AS last_day
FROM crawl GROUP BY keyword""", text=("last_day",))
def csv_source(spark: SparkSession, d: str) -> DataFrame:
    crawl, path = view(spark, d, CRAWL), storage.shared_dir(spark)
    (crawl.write.option("header", True).option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))
    back = tables.csv_source(spark, path, crawl.schema)
    return back.groupBy("keyword").agg(
        F.count(F.lit(1)).alias("n"), F.count("platform_code").alias("codes"),
        F.sum("num_of_rating").alias("ratings"), F.max("sp").alias("max_sp"), F.max("date_stamp").alias("last_day"))


@query("a2_table_window_scan", f"WITH crawl AS ({duck(MARKET)})" + """
SELECT platform, date_stamp, hour_stamp, count(*) AS n FROM crawl
WHERE platform IN ('Amazon', 'Flipkart')
  AND ((date_stamp = DATE '1997-06-10' AND hour_stamp >= 20) OR (date_stamp = DATE '1997-06-11' AND hour_stamp <= 5))
GROUP BY platform, date_stamp, hour_stamp""", text=("date_stamp",))
def table_window_scan(spark, d):
    scan = tables.table_window_scan(view(spark, d, MARKET), "t_visibility_hourly", ["Amazon", "Flipkart"],
                                    as_of="1997-06-11 05:40:00", lookback_hours=10)
    return scan.groupBy("platform", "date_stamp", "hour_stamp").agg(F.count(F.lit(1)).alias("n"))


@query("a3_hour_window_pairs", """
SELECT o_orderkey, CAST(n AS INT) AS pair_no,
  CAST(o_orderdate + (CAST(o_orderkey % 24 AS BIGINT) - 3 + n) * INTERVAL 1 HOUR AS DATE) AS date_stamp,
  CAST(hour(o_orderdate + (CAST(o_orderkey % 24 AS BIGINT) - 3 + n) * INTERVAL 1 HOUR) AS INT) AS hour_stamp
FROM orders, range(4) t(n)""", text=("date_stamp",))
def hour_window_pairs(spark, d):
    moments = table(spark, d, "orders").select(
        "o_orderkey", (F.col("o_orderdate").cast("timestamp_ntz")
                       + F.make_dt_interval(F.lit(0), (F.col("o_orderkey") % 24).cast("int"))).alias("as_of"))
    return tables.hour_window_table(moments, "as_of", 4).drop("as_of")


@query("a4_hour_window_filter", CRAWL_SQL + """
SELECT date_stamp, hour_stamp, count(*) AS n FROM crawl
WHERE (date_stamp = DATE '1996-02-29' AND hour_stamp IN (22, 23)) OR (date_stamp = DATE '1996-03-01' AND hour_stamp IN (0, 1))
GROUP BY date_stamp, hour_stamp""", text=("date_stamp",))
def hour_window_filter(spark, d):
    pairs = tables.hour_window_pairs("1996-03-01 01:10:00", 4)
    return (view(spark, d, CRAWL).where(tables.hour_window_filter(pairs))
            .groupBy("date_stamp", "hour_stamp").agg(F.count(F.lit(1)).alias("n")))


@query("a4_dataset_windows", CRAWL_SQL + """,
w AS (SELECT DISTINCT 'Brand#' || (o_custkey % 25 + 1) AS keyword, CAST(m AS DATE) AS date_stamp, CAST(hour(m) AS INT) AS hour_stamp
  FROM (SELECT o_custkey, o_orderdate + (CAST(o_orderkey % 24 AS BIGINT) - 11 + n) * INTERVAL 1 HOUR AS m FROM orders, range(12) t(n) WHERE o_orderkey % 20 = 3))
SELECT keyword, date_stamp, count(*) AS n FROM crawl SEMI JOIN w USING (keyword, date_stamp, hour_stamp) GROUP BY keyword, date_stamp""", text=("date_stamp",))
def dataset_windows(spark, d):
    """Twelve hours before the moments of some keywords, each keyword with its own."""
    moments = table(spark, d, "orders").where("o_orderkey % 20 = 3").select(
        F.concat(F.lit("Brand#"), (F.col("o_custkey") % 25 + 1).cast("string")).alias("keyword"),
        (F.col("o_orderdate").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), (F.col("o_orderkey") % 24).cast("int"))).alias("as_of"))
    windows = tables.hour_window_table(moments, "as_of", 12)
    rows = tables.windows_scan(view(spark, d, CRAWL), windows, ("keyword", "date_stamp", "hour_stamp"))
    return rows.groupBy("keyword", "date_stamp").agg(F.count(F.lit(1)).alias("n"))


@query("a5_daily_window_filter", CRAWL_SQL + """
SELECT keyword, count(*) AS n FROM crawl WHERE date_stamp = DATE '1998-11-30' GROUP BY keyword""")
def daily_window_filter(spark, d):
    return (view(spark, d, CRAWL).where(tables.daily_window_filter(AS_OF))
            .groupBy("keyword").agg(F.count(F.lit(1)).alias("n")))


def zipped(pages: DataFrame) -> DataFrame:
    """Pages as crawl objects: a zip with the source as its first member."""
    def pack(batches):
        for batch in batches:
            keys, html = batch.column("page_id"), batch.column("html")
            for start in range(0, batch.num_rows, 256):  # few pages at a time, whatever a batch holds
                content = []
                for text in html.slice(start, 256):
                    buffer = io.BytesIO()
                    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
                        archive.writestr("page.html", text.as_py())
                        archive.writestr("later.html", "not read")
                    content.append(buffer.getvalue())
                yield pa.RecordBatch.from_arrays([keys.slice(start, 256), pa.array(content, pa.binary())], names=["page_id", "content"])
    return pages.select("page_id", "html").mapInArrow(pack, "page_id long, content binary")


@query("a6_raw_page_source", "SELECT page_id, md5(html) AS digest, CAST(length(html) AS INT) AS chars FROM pages")
def raw_page_source(spark, d):
    html = objects.unzip_pages(zipped(table(spark, d, "pages")))
    return html.select("page_id", F.md5("html").alias("digest"), F.length("html").alias("chars"))


# Pages as crawl objects of three platforms, four days and five hours.
CRAWLED_PAGES = """
SELECT concat('p', CAST(page_id % 3 AS STRING)) AS platform_id, CAST(DATE '2024-01-01' + CAST(page_id % 4 AS INT) AS DATE) AS date_stamp,
  CAST(page_id % 5 AS INT) AS hour_stamp, concat('page_', CAST(page_id AS STRING), '.zip') AS object_name, html
FROM pages
"""
PAGE_TEMPLATE = "layer=raw/platform_id={platform_id}/date_stamp={date_stamp}/hour_stamp={hour_stamp}/"


@query("a6_page_objects", f"""
SELECT object_name, hour_stamp, md5(html) AS digest FROM ({duck(CRAWLED_PAGES)}) p
WHERE platform_id = 'p1' AND date_stamp >= DATE '2024-01-03' AND hour_stamp IN (0, 3)""")
def pages_by_prefix(spark, d):
    root = storage.shared_dir(spark)
    page_objects.write_page_objects(view(spark, d, CRAWLED_PAGES), root, PAGE_TEMPLATE)
    wanted = (F.col("platform_id") == "p1") & (F.col("date_stamp") >= F.lit("2024-01-03").cast("date")) & F.col("hour_stamp").isin(0, 3)
    return (page_objects.page_objects(spark, root, PAGE_TEMPLATE, splits=2).where(wanted)
            .select("object_name", "hour_stamp", F.md5("html").alias("digest")))


@query("a6_page_object_stream", f"""
SELECT platform_id, date_stamp, count(*) AS pages, CAST(sum(length(html)) AS BIGINT) AS chars
FROM ({duck(CRAWLED_PAGES)}) p WHERE date_stamp >= DATE '2024-01-02' GROUP BY platform_id, date_stamp""", text=("date_stamp",))
def page_stream(spark, d):
    """Objects of the second crawl arrive after the stream has read the first."""
    base, pages = storage.shared_dir(spark), view(spark, d, CRAWLED_PAGES)
    stream = page_objects.page_object_stream(spark, f"{base}/objects", PAGE_TEMPLATE, settle_seconds=0, from_date="2024-01-02")
    late = F.col("hour_stamp") >= 3
    for part in (pages.where(~late), pages.where(late)):
        page_objects.write_page_objects(part, f"{base}/objects", PAGE_TEMPLATE)
        write_stream(stream, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    read = spark.read.schema(stream.schema).parquet(f"{base}/out")
    return read.groupBy("platform_id", "date_stamp").agg(F.count(F.lit(1)).alias("pages"), F.sum(F.length("html")).alias("chars"))


@query("a7_call_log_source", f"""
SELECT model, count(*) AS calls, CAST(sum(completion_tokens) AS BIGINT) AS tokens, max(latency_s) AS slowest
FROM ({duck(CALLS)}) c
WHERE model NOT IN ('error', 'signup') AND ts BETWEEN TIMESTAMP '2024-01-03 06:00:00' AND TIMESTAMP '2024-01-20 18:30:00'
GROUP BY model""")
def call_log_source(spark, d):
    calls, path = view(spark, d, CALLS), storage.shared_dir(spark)
    line = F.to_json(F.struct(
        "model", "latency_s", F.struct(F.col("completion_tokens").cast("long").alias("completion_tokens")).alias("usage"),
        F.when(F.col("model") == "signup", F.lit("yesterday")).otherwise(F.col("ts").cast("string")).alias("ts")))
    # error lines are cut short and do not parse
    calls.select(F.when(F.col("model") == "error", F.substring(line, 1, 20)).otherwise(line)).write.text(path)
    log = objects.call_log_source(spark, path, since="2024-01-03 06:00:00", until="2024-01-20 18:30:00")
    return log.groupBy("model").agg(F.count(F.lit(1)).alias("calls"), F.sum("usage.completion_tokens").alias("tokens"),
                                    F.max("latency_s").alias("slowest"))


@query("a8_null_normalise", """
SELECT l_returnflag, count(*) AS n, count(*) FILTER (WHERE l_linenumber = 2 OR l_quantity > 45) AS missing,
  count(*) FILTER (WHERE l_linenumber <> 2 AND l_quantity <= 45 AND l_discount >= 0.05) AS high
FROM lineitem GROUP BY l_returnflag""")
def normalise(spark, d):
    rows = table(spark, d, "lineitem").select("l_returnflag", F.when(F.col("l_linenumber") == 2, F.lit(float("nan")))
                                              .when(F.col("l_quantity") <= 45, F.col("l_discount")).alias("x"))
    return null_normalise(rows).groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), count_where(F.col("x").isNull()).alias("missing"),
        count_where(F.col("x") >= 0.05).alias("high"))


@query("a9_sinks", CRAWL_SQL + """
SELECT r.run_id, keyword, failed FROM (
  SELECT keyword, count(*) AS failed FROM crawl WHERE sp < 1 GROUP BY keyword) x, (VALUES ('r1'), ('r2')) r(run_id)""")
def sinks(spark, d):
    path = storage.shared_dir(spark)
    bad = (row_rule_set(view(spark, d, CRAWL), shipped_rules("visibility/amazon").with_rules(
        Rule("sp_positive", "range", "sp", {"min": 1})), keep=["keyword"]).groupBy("keyword")
        .agg(F.count(F.lit(1)).alias("failed")))
    storage.write_run(bad, path, "r1", "failures", "json")
    storage.write_run(bad, path, "r2", "failures", "json")
    storage.write_run(bad, path, "r2", "failures", "json")  # a repeated run does not double
    return storage.read_runs(spark, path, "failures", bad.schema, "json").select("run_id", "keyword", "failed")


@query("a9_committed_runs", CRAWL_SQL + """
SELECT r.run_id, keyword, failed FROM (SELECT keyword, count(*) AS failed FROM crawl WHERE sp < 1 GROUP BY keyword) x,
  (VALUES ('r1'), ('r2')) r(run_id)""")
def committed_runs(spark, d):
    """Two published runs, one of them twice, and one that stops before its end."""
    path = storage.shared_dir(spark)
    bad = view(spark, d, CRAWL).where("sp < 1").groupBy("keyword").agg(F.count(F.lit(1)).alias("failed"))
    for run_id, whole in (("r1", True), ("r2", True), ("r2", True), ("r3", False)):
        run = runs.RunWriter(spark, path, run_id)
        run.write(bad, "failures")
        if whole:
            run.publish()
    return runs.read_table(spark, path, "failures").select("run_id", "keyword", "failed")


# ------------------------------------------------------------------ row checks

PRICE_TEXT = """CASE WHEN l.l_partkey % 37 = 0 THEN '1,234' WHEN l.l_partkey % 31 = 0 THEN '1.5f'
  WHEN l.l_partkey % 29 = 0 THEN ' 12 ' WHEN l.l_partkey % 23 = 0 THEN '' WHEN l.l_partkey % 19 = 0 THEN '1e3'
  WHEN l.l_partkey % 17 = 0 THEN 'nan'
  ELSE CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) AS STRING) END AS price_text, """
TEXT_CRAWL = CRAWL.replace("SELECT\n", "SELECT " + PRICE_TEXT, 1)


def per_keyword(df: DataFrame, rule: Rule, as_of=None) -> DataFrame:
    """Rows, guarded rows and failing rows per keyword for one rule."""
    applies, ok = guard(rule), passes(df.schema, rule, as_of)
    return df.groupBy("keyword").agg(F.count(F.lit(1)).alias("n"), count_where(applies).alias("guarded"),
                                     count_where(applies & ~ok).alias("failed"))


def keyword_sql(fails: str, guarded: str = "TRUE", source: str = CRAWL) -> str:
    return f"""WITH crawl AS ({duck(source)})
SELECT keyword, count(*) AS n, count(*) FILTER (WHERE {guarded}) AS guarded,
  count(*) FILTER (WHERE ({guarded}) AND ({fails})) AS failed
FROM crawl GROUP BY keyword"""


ROW_QUERIES = {
    "b1_not_null": (Rule("r", "not_null", "platform_code"),
                    keyword_sql("platform_code IS NULL OR trim(platform_code) = ''")),
    "b2_must_null": (Rule("r", "must_null", "campaign_id", when="product_type = 'SP'"),
                     keyword_sql("campaign_id IS NOT NULL", "product_type = 'SP'")),
    "b3_constant": (Rule("r", "constant", "platform", {"value": "Amazon"}), keyword_sql("platform <> 'Amazon'")),
    "b4_regex": (Rule("r", "regex", "platform_code", {"pattern": "^B0[A-Z0-9]{8}$"}),
                 keyword_sql("trim(platform_code) <> '' AND NOT regexp_matches(platform_code, '^B0[A-Z0-9]{8}$')")),
    "b5_range": (Rule("r", "range", "rating", {"min": 1, "max": 5}), keyword_sql("rating < 1 OR rating > 5")),
    "b6_length": (Rule("r", "length", "product_name", {"min": 5, "max": 9}),
                  keyword_sql("length(product_name) < 5 OR length(product_name) > 9")),
    "b7_allowed_values": (Rule("r", "allowed_values", "stock_status",
                               {"values": ["In Stock", "Out of Stock", "Currently unavailable"]}),
                          keyword_sql("stock_status NOT IN ('In Stock', 'Out of Stock', 'Currently unavailable')")),
    "b8_compare": (Rule("r", "compare", "sp", {"expr": "sp <= mrp"}), keyword_sql("sp > mrp")),
    "b9_freshness": (Rule("r", "freshness", "time_stamp", {"max_age_hours": 8760}),
                     keyword_sql(f"time_stamp < TIMESTAMP '{AS_OF}' - INTERVAL 8760 HOUR")),
    "b10_when_guard": (Rule("r", "not_null", "campaign_id", when='product_type in ["SB", "SD", "SBV"] and rating is not null'),
                       keyword_sql("campaign_id IS NULL", "product_type IN ('SB', 'SD', 'SBV') AND rating IS NOT NULL")),
}


def _row_query(rule: Rule):
    return lambda spark, d: per_keyword(view(spark, d, CRAWL), rule, AS_OF)


for _name, (_rule, _sql) in ROW_QUERIES.items():
    query(_name, _sql)(_row_query(_rule))


@query("b5_range_text", keyword_sql(
    "trim(price_text) <> '' AND NOT coalesce(regexp_matches(price_text, '^ *[0-9]+([.][0-9]*)?(e[0-9]+)? *$') "
    "AND TRY_CAST(trim(price_text) AS DOUBLE) BETWEEN 900 AND 80000, FALSE)", source=TEXT_CRAWL))
def range_text(spark, d):
    return per_keyword(view(spark, d, TEXT_CRAWL), Rule("r", "range", "price_text", {"min": 900, "max": 80000}))


@query("b7_allowed_values_table", CRAWL_SQL + """
SELECT seller, count(*) AS n FROM crawl
WHERE seller IS NOT NULL AND seller NOT IN (
  SELECT concat('Supplier#', CAST(s_suppkey AS VARCHAR)) FROM supplier WHERE s_acctbal > 0)
GROUP BY seller""")
def allowed_table(spark, d):
    known = table(spark, d, "supplier").where("s_acctbal > 0").select(
        F.concat(F.lit("Supplier#"), F.col("s_suppkey").cast("string")).alias("seller"))
    return (outside_table(view(spark, d, CRAWL), "seller", known).groupBy("seller")
            .agg(F.count(F.lit(1)).alias("n")))


# The row rules of the Amazon search-result and availability files as conditions over the crawl view.
MISSING_CODE = "platform_code IS NULL OR trim(platform_code) = ''"
VISIBILITY_SQL = {
    "timestamp_present": ("TRUE", "time_stamp IS NULL", "warn", "report_only"),
    "platform_constant": ("TRUE", "platform <> 'Amazon'", "error", "report_only"),
    "platform_code_present": ("TRUE", MISSING_CODE, "error", "investigate"),
    "name_present": ("TRUE", "length(product_name) < 5", "error", "investigate"),
    "sp_positive": ("TRUE", "sp < 1", "error", "investigate"),
    "sp_not_above_mrp": ("sp IS NOT NULL AND mrp IS NOT NULL", "sp > mrp", "error", "investigate"),
    "rating_bounds": ("TRUE", "rating < 1 OR rating > 5", "error", "investigate"),
    "num_of_rating_not_null": ("rating IS NOT NULL", "num_of_rating IS NULL", "warn", "investigate"),
    "rank_present": ("TRUE", "absolute_rank IS NULL", "error", "investigate"),
    "relative_rank_not_null": ("TRUE", "relative_rank IS NULL", "error", "investigate"),
    "relative_rank_must_not_null": ("TRUE", "relative_rank IS NULL", "error", "investigate"),
    "campaign_id_not_null": ("product_type IN ('SB', 'SD', 'SBV')", "campaign_id IS NULL", "error", "investigate"),
}
IN_STOCK = "stock_status = 'In Stock'"
OSA_SQL = {
    "platform_constant": ("TRUE", "platform <> 'Amazon'", "error", "report_only"),
    "code_present": ("TRUE", MISSING_CODE, "error", "investigate"),
    "stock_status_valid": ("TRUE", "stock_status NOT IN ('In Stock', 'Out of Stock', 'Currently unavailable')",
                           "error", "investigate"),
    "sp_null_when_instock": (IN_STOCK, "sp IS NULL", "error", "investigate"),
    "sp_positive": (IN_STOCK, "sp < 1", "error", "investigate"),
    "sp_not_above_mrp": ("sp IS NOT NULL AND mrp IS NOT NULL", "sp > mrp", "error", "investigate"),
    "rating_bounds": ("TRUE", "rating < 1 OR rating > 5", "error", "investigate"),
    "delivery_days_sane": ("TRUE", "delivery_days < 0 OR delivery_days > 60", "warn", "report_only"),
    "num_of_rating_not_null": ("rating IS NOT NULL", "num_of_rating IS NULL", "warn", "investigate"),
}
OSA_AMAZON_SQL = {**OSA_SQL, "asin_format": (
    "TRUE", "trim(platform_code) <> '' AND NOT regexp_matches(platform_code, '^B0[A-Z0-9]{8}$')", "error", "investigate")}
DAILY_SQL = {**OSA_SQL, "seller_not_null": ("TRUE", "seller IS NULL", "warn", "report_only")}


def union_of(rules: dict, columns: str, source: str = "crawl", only_failed: bool = True) -> str:
    """One SELECT per rule: its guarded rows, or only the failing ones."""
    return "\nUNION ALL\n".join(
        f"SELECT '{r}' AS rule_id, '{sev}' AS severity, '{act}' AS on_fail, {columns}, coalesce({bad}, FALSE) AS failed "
        f"FROM {source} WHERE ({g})" + (f" AND ({bad})" if only_failed else "")
        for r, (g, bad, sev, act) in rules.items())


@query("b11_row_rule_set", CRAWL_SQL + f"""
SELECT rule_id, product_type, count(*) AS failing_rows
FROM ({union_of(VISIBILITY_SQL, 'product_type')}) t GROUP BY rule_id, product_type""")
def rule_set(spark, d):
    tagged = row_rule_set(view(spark, d, CRAWL), shipped_rules("visibility/amazon"), keep=["product_type"])
    return tagged.groupBy("rule_id", "product_type").agg(F.count(F.lit(1)).alias("failing_rows"))


@query("b11_rule_counts", CRAWL_SQL + f"""
SELECT rule_id, count(*) AS guarded, count(*) FILTER (WHERE failed) AS failed, count(*) FILTER (WHERE NOT failed) AS passed
FROM ({union_of(OSA_AMAZON_SQL, '1 AS one', only_failed=False)}) t GROUP BY rule_id""")
def rule_counts(spark, d):
    return failing_counts(view(spark, d, CRAWL), shipped_rules("osa/amazon")).select(
        "rule_id", "guarded", "failed", "passed")


@row_check("multiple_of")
def multiple_of(fld, params, as_of=None):
    """Example of a user-defined check: whole multiples of a step; missing passes."""
    return ~fld.present | F.coalesce(fld.number % F.lit(float(params["step"])) == 0, F.lit(False))


@query("b12_registered_check", keyword_sql("num_of_rating % 3 <> 0"))
def registered_check(spark, d):
    return per_keyword(view(spark, d, CRAWL), Rule("r", "multiple_of", "num_of_rating", {"step": 3}))


@opaque_checks.opaque_row_check("digit_sum")
def digit_sum(values: pa.Array, params: dict) -> pa.Array:
    """The digits of a code add up to a multiple of ``step``."""
    return pa.array([None if v is None else sum(int(c) for c in v if c in "0123456789") % params["step"] == 0 for v in values.to_pylist()])


@query("b12_opaque_row", keyword_sql(
    "length(trim(platform_code)) > 0 AND list_sum([CAST(x AS INT) FOR x IN regexp_extract_all(platform_code, '[0-9]')]) % 3 <> 0"))
def opaque_row(spark, d):
    return per_keyword(view(spark, d, CRAWL), Rule("r", "digit_sum", "platform_code", {"step": 3}))


@opaque_checks.opaque_group_check("variance_max")
class SpreadMax:
    """Variance of a whole-number column, by its count, sum and sum of squares."""

    def start(self):
        return [0, 0, 0]

    def add(self, state, values, params):
        v = [x for x in values.to_pylist() if x is not None]
        return [state[0] + len(v), state[1] + sum(v), state[2] + sum(x * x for x in v)]

    def merge(self, a, b):
        return [x + y for x, y in zip(a, b)]

    def verdict(self, state, params):
        n, total, squares = state
        return n * squares - total * total <= params["max"] * n * n, f"{total} of {n} values"


@query("b12_opaque_group", CRAWL_SQL + """
SELECT keyword, time_stamp, count(*) AS group_rows, concat(coalesce(sum(num_of_rating), 0), ' of ', count(num_of_rating), ' values') AS detail,
  count(num_of_rating) * coalesce(sum(num_of_rating * num_of_rating), 0) - coalesce(sum(num_of_rating), 0) * coalesce(sum(num_of_rating), 0)
    <= 200 * count(num_of_rating) * count(num_of_rating) AS ok
FROM crawl WHERE product_type <> 'SD' GROUP BY keyword, time_stamp""", text=("time_stamp",))
def opaque_group(spark, d):
    out = single(view(spark, d, CRAWL), "variance_max", "num_of_rating", {"max": 200}, ["keyword", "time_stamp"], "product_type <> 'SD'")
    return out.select("keyword", "time_stamp", "group_rows", "detail", "ok")


@opaque_checks.page_function("page_links", "place int, target string")
def page_links(html: str, params: dict):
    for i, hit in enumerate(re.finditer(r'<a href="([^"]*)"', html)):
        yield i, hit[1]


@query("b12_page_function", """
SELECT page_id, CAST(generate_subscripts(x, 1) - 1 AS INT) AS place, unnest(x) AS target
FROM (SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS x FROM pages)""")
def page_function(spark, d):
    return opaque_checks.page_rows(table(spark, d, "pages"), "page_links", ["page_id"])


# ------------------------------------------------------------------ group checks

CRAWL_KEY = ["keyword", "time_stamp"]


@query("c1_share_max", CRAWL_SQL + """, n AS (
  SELECT keyword, time_stamp, product_image_url AS v, count(*) AS c FROM crawl GROUP BY ALL),
r AS (SELECT *, sum(c) OVER w AS total, row_number() OVER (w ORDER BY c DESC, v NULLS LAST) AS no
  FROM n WINDOW w AS (PARTITION BY keyword, time_stamp))
SELECT keyword, time_stamp, v AS top_value, c AS top_rows, CAST(total AS BIGINT) AS group_rows,
  c::DOUBLE / total::DOUBLE <= 0.5 AS ok FROM r WHERE no = 1""", text=("time_stamp",))
def share_max(spark, d):
    return single(view(spark, d, CRAWL), "share_max", "product_image_url", {"max_share": 0.5}, CRAWL_KEY).select(
        *CRAWL_KEY, "top_value", "top_rows", "group_rows", "ok")


@query("c1_share_max_failures", CRAWL_SQL + """, n AS (
  SELECT keyword, time_stamp, seller AS v, count(*) AS c FROM crawl GROUP BY ALL),
r AS (SELECT *, sum(c) OVER w AS total, row_number() OVER (w ORDER BY c DESC, v NULLS LAST) AS no
  FROM n WINDOW w AS (PARTITION BY keyword, time_stamp))
SELECT keyword, time_stamp, v AS top_value, c AS top_rows, CAST(total AS BIGINT) AS group_rows
FROM r WHERE no = 1 AND c::DOUBLE / total::DOUBLE > 0.1""", text=("time_stamp",))
def share_max_failures(spark, d):
    return heavy_values.share_max_failures(view(spark, d, CRAWL), "seller", 0.1, CRAWL_KEY)


@query("c2_share_max_value", CRAWL_SQL + """
SELECT date_stamp, hour_stamp, count(*) FILTER (WHERE stock_status = 'Out of Stock') AS hits, count(*) AS group_rows,
  count(*) FILTER (WHERE stock_status = 'Out of Stock')::DOUBLE / count(*)::DOUBLE <= 0.8 AS ok
FROM crawl GROUP BY date_stamp, hour_stamp""", text=("date_stamp",))
def share_max_value(spark, d):
    return single(view(spark, d, CRAWL), "share_max", "stock_status", {"value": "Out of Stock", "max_share": 0.8},
                  ["date_stamp", "hour_stamp"]).select("date_stamp", "hour_stamp", F.col("value_rows").alias("hits"),
                                                       "group_rows", "ok")


@query("c3_distinct_min", CRAWL_SQL + """
SELECT keyword, time_stamp, count(DISTINCT seller) AS distinct_values, count(DISTINCT seller) >= 20 AS ok
FROM crawl GROUP BY keyword, time_stamp""", text=("time_stamp",))
def distinct_min(spark, d):
    return single(view(spark, d, CRAWL), "distinct_min", "seller", {"min": 20}, CRAWL_KEY).select(
        *CRAWL_KEY, "distinct_values", "ok")


ORDER_RANKS_SQL = """
SELECT l_orderkey, count(l_linenumber) AS value_rows,
  count(l_linenumber) = 0 OR (count(l_linenumber) = count(DISTINCT l_linenumber) AND min(l_linenumber) = 1
    AND max(l_linenumber) = count(l_linenumber)) AS ok
FROM lineitem GROUP BY l_orderkey"""


@query("c4_contiguous", ORDER_RANKS_SQL)
def contiguous(spark, d):
    return single(table(spark, d, "lineitem"), "contiguous", "l_linenumber", {}, ["l_orderkey"]).select(
        "l_orderkey", "value_rows", "ok")


@query("c5_contiguous_gaps", """
WITH n AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey),
e AS (SELECT l_orderkey, unnest(range(1, n + 1)) AS gap FROM n),
m AS (SELECT * FROM e WHERE NOT EXISTS (
  SELECT 1 FROM lineitem l WHERE l.l_orderkey = e.l_orderkey AND l.l_linenumber = e.gap))
SELECT l_orderkey, gap, CAST(no AS INT) AS gap_no FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY gap) AS no FROM m) WHERE no <= 5""")
def gaps(spark, d):
    return contiguous_gaps(table(spark, d, "lineitem"), "l_linenumber", ["l_orderkey"])


@query("c5_run_gaps", """
WITH m AS (SELECT CAST(k AS BIGINT) AS gap FROM range(1, (SELECT count(o_custkey) + 1 FROM orders)) t(k)
  WHERE k NOT IN (SELECT o_custkey FROM orders))
SELECT gap, CAST(row_number() OVER (ORDER BY gap) AS INT) AS gap_no FROM m ORDER BY gap LIMIT 5""")
def run_gaps(spark, d):
    return contiguous_gaps(table(spark, d, "orders"), "o_custkey", [])


@query("c6_row_count_min", CRAWL_SQL + """
SELECT keyword, time_stamp, count(*) AS group_rows, count(*) >= 30 AS ok FROM crawl GROUP BY keyword, time_stamp""", text=("time_stamp",))
def row_count_min(spark, d):
    return single(view(spark, d, CRAWL), "row_count_min", None, {"min": 30}, CRAWL_KEY).select(
        *CRAWL_KEY, "group_rows", "ok")


@query("c7_contains_all", CRAWL_SQL + """, need(v) AS (VALUES ('SP'), ('SB'), ('SBV'), ('SD')),
g AS (SELECT DISTINCT date_stamp FROM crawl), h AS (SELECT DISTINCT date_stamp, product_type FROM crawl),
m AS (SELECT g.date_stamp, string_agg(v, ', ' ORDER BY v) AS missing FROM g CROSS JOIN need
  WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.date_stamp = g.date_stamp AND h.product_type = need.v) GROUP BY 1)
SELECT g.date_stamp, coalesce(m.missing, '') AS missing, m.missing IS NULL AS ok FROM g LEFT JOIN m USING (date_stamp)""", text=("date_stamp",))
def contains_all(spark, d):
    return single(view(spark, d, CRAWL), "contains_all", "product_type", {"value": ["SP", "SB", "SBV", "SD"]},
                  ["date_stamp"]).select("date_stamp", F.array_join("missing", ", ").alias("missing"), "ok")


GROUP_RULES = RuleSet("t_visibility_hourly", "Amazon", ("keyword", "time_stamp"), (
    Rule("image_diversity", "share_max", "product_image_url", {"max_share": 0.5}, "crawl", on_fail="investigate"),
    Rule("min_results", "row_count_min", None, {"min": 10}, "crawl", severity="warn", on_fail="investigate"),
    Rule("ad_sellers", "distinct_min", "seller", {"min": 5}, "crawl", when="product_type = 'SB'"),
    Rule("rank_contiguous", "contiguous", "absolute_rank", {}, "crawl", on_fail="investigate"),
    Rule("types_complete", "contains_all", "product_type", {"value": ["SP", "SB", "SBV", "SD", "XX"]}, "run"),
    Rule("oos_above_40", "share_max", "stock_status", {"value": "Out of Stock", "max_share": 0.4}, "run",
         when="rating is not null"),
    Rule("never_guarded", "row_count_min", None, {"min": 10}, "run", when="product_type = 'none'"),
))

GROUP_FAILS_SQL = """
img AS (SELECT keyword, time_stamp, product_image_url, count(*) AS c FROM crawl GROUP BY ALL),
gf AS (
  SELECT 'image_diversity' AS rule_id, keyword, time_stamp, CAST(sum(c) AS BIGINT) AS group_rows FROM img
    GROUP BY keyword, time_stamp HAVING max(c)::DOUBLE / sum(c)::DOUBLE > 0.5
  UNION ALL SELECT 'min_results', keyword, time_stamp, count(*) FROM crawl GROUP BY keyword, time_stamp HAVING count(*) < 10
  UNION ALL SELECT 'ad_sellers', keyword, time_stamp, count(*) FROM crawl WHERE product_type = 'SB'
    GROUP BY keyword, time_stamp HAVING count(DISTINCT seller) < 5
  UNION ALL SELECT 'rank_contiguous', keyword, time_stamp, count(*) FROM crawl GROUP BY keyword, time_stamp
    HAVING NOT (count(absolute_rank) = count(DISTINCT absolute_rank) AND min(absolute_rank) = 1 AND max(absolute_rank) = count(absolute_rank))
  UNION ALL SELECT 'types_complete', NULL, NULL, count(*) FROM crawl
  UNION ALL SELECT 'oos_above_40', NULL, NULL, count(*) FROM crawl WHERE rating IS NOT NULL
    HAVING count(*) FILTER (WHERE stock_status = 'Out of Stock')::DOUBLE / count(*)::DOUBLE > 0.4)"""


@query("c8_group_rule_set", CRAWL_SQL + "," + GROUP_FAILS_SQL + """
SELECT rule_id, keyword, time_stamp, group_rows FROM gf""", text=("time_stamp",))
def group_rules(spark, d):
    return group_rule_set(view(spark, d, CRAWL), GROUP_RULES).where("NOT ok").select(
        "rule_id", "keyword", "time_stamp", "group_rows")


@query("c9_crawl_grouping", f"WITH crawl AS ({duck(CRAWL)})" + f"""
SELECT rule_id, time_stamp, count(*) AS failed_count
FROM ({union_of(DAILY_SQL, 'time_stamp')}) t GROUP BY rule_id, time_stamp""", text=("time_stamp",))
def crawl_grouping(spark, d):
    # the daily table has no keyword column, so its crawl key shrinks to the time stamp
    daily = view(spark, d, CRAWL).drop("keyword")
    rules = shipped_rules("osa_daily/amazon")
    return failure_records(daily, rules).select("rule_id", "time_stamp", "failed_count")

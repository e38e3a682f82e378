"""Failure records, cases and their samples.

A failure record is one (rule, crawl) that failed. A case is one (dataset, platform, rule). Cases
keep exact counts and a few representatives; the full list of crawls stays in the failure table,
so no group is ever collected whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from siftgate.functions.values import ascending, count_where, sort_struct
from siftgate.operators.group_checks import ROWS, RUN, Tally, group_flags, group_results, numbered_rules
from siftgate.operators.row_checks import ENTRY, RULE_NO, Entries, row_rule_set, rule_facts, rule_ids
from siftgate.plans.rules import RuleError, crawl_columns
from siftgate.sources.storage import materialise

SAMPLE_ROWS = 5
DETAILS = 3
CRAWL_LABELS = 8

CASE_KEY = ["dataset", "platform", "rule_id"]
RULE_FACTS = ["column", "check", "scope", "severity", "on_fail", "description", "force_escalate_above"]


def case_id(dataset: Column, platform: Column, rule_id: Column) -> Column:
    return F.concat_ws("|", dataset, platform, rule_id)


def row_flags(bound) -> dict[tuple, Column]:
    return {("row", kind, i): c for i, b in enumerate(bound) for kind, c in (("g", b.applies), ("f", b.fails))}


def row_failures(df: DataFrame, rules, as_of=None, platform_column: str | None = None, tally: Tally | None = None) -> DataFrame:
    """Failures of row rules. The table is scanned once: counts for all rules are taken per crawl
    in one aggregate, then turned into rows. Totals per rule come from that same aggregate."""
    entries = Entries.of(rules, platform_column)
    ready = entries.prepare(df)
    bound = entries.bind(ready.schema, True, as_of)
    if not bound:
        raise RuleError("no row rules")
    keys = crawl_columns(df.columns, entries.crawl_key)
    if tally:
        wide = tally.rows().groupBy(ENTRY, *keys).agg(F.sum(ROWS).alias("n"), *[tally.count(k).alias(f"{k[1]}{k[2]}") for k in row_flags(bound)])
    else:
        wide = ready.groupBy(ENTRY, *keys).agg(F.count(F.lit(1)).alias("n"),
                                               *[count_where(c).alias(f"{k[1]}{k[2]}") for k, c in row_flags(bound).items()])
    tall = wide.select(ENTRY, *keys, "n", F.explode(F.array(*[
        F.struct(F.lit(i).alias("no"), F.col(f"g{i}").alias("g"), F.col(f"f{i}").alias("f"))
        for i in range(len(bound))])).alias("r"))
    # Reading f here as well keeps both branches on one shuffle of the aggregate.
    totals = (tall.groupBy(F.col(ENTRY).alias("_e"), F.col("r.no").alias("_no"))
              .agg(F.sum("r.g").alias("total_count"), F.sum("n").alias("entry_rows"), F.sum("r.f").alias("_f"))
              .where(F.col("_f") > 0)
              .select("_e", "_no", "total_count", "entry_rows", rule_facts(bound, F.col("_no")).alias("_rule"))
              .select("_e", "_no", "total_count", "entry_rows", "_rule.*"))
    failed = tall.where(F.col("r.f") > 0)
    # totals hold one row per (entry, rule): bounded by the rule files, so safe to broadcast
    joined = failed.join(F.broadcast(totals), (F.col(ENTRY) == F.col("_e")) & (F.col("r.no") == F.col("_no")))
    return joined.select(
        F.lit(entries.dataset).alias("dataset"), F.col(ENTRY).alias("platform"),
        "rule_id", *RULE_FACTS, F.lit(False).alias("run_scope"), *keys,
        F.col("r.f").alias("failed_count"), "total_count", "entry_rows",
        F.concat(F.col("r.f").cast("string"), F.lit(" of "), F.col("total_count").cast("string"),
                 F.lit(" rows failed")).alias("detail"))


def group_failures(df: DataFrame, rules, as_of=None, platform_column: str | None = None, tally: Tally | None = None) -> DataFrame:
    """Failures of crawl and run rules: all rows of a failing group count as failed."""
    if tally is None:  # sizes of entries and all kinds of rules from one scan
        tally = scan_once(df, Entries.of(rules, platform_column), as_of)
    res, bound, keys, entries = group_results(df, rules, as_of, platform_column, tally)
    # one row per entry, bounded by the configured platforms
    sizes = tally.rows().groupBy(F.col(ENTRY).alias("_e")).agg(F.sum(ROWS).alias("entry_rows"))
    bad = (res.where(~F.col("ok")).join(F.broadcast(sizes), F.col(ENTRY) == F.col("_e"))
           .withColumn("_rule", rule_facts(bound, F.col(RULE_NO))))
    return bad.select(
        F.lit(entries.dataset).alias("dataset"), F.col(ENTRY).alias("platform"),
        "_rule.*", F.col(RUN).alias("run_scope"), *keys,
        F.col("group_rows").alias("failed_count"), F.col("group_rows").alias("total_count"), "entry_rows",
        "detail")


def scan_once(df: DataFrame, entries: Entries, as_of=None) -> Tally:
    """The counts behind all rules of a table, row rules and group rules alike, from one scan."""
    ready = entries.prepare(df)
    counted, valued = numbered_rules(ready.schema, entries.bind(ready.schema, False, as_of))
    flags = row_flags(entries.bind(ready.schema, True, as_of)) | group_flags(counted)
    return Tally.of(ready, flags, valued, crawl_columns(df.columns, entries.crawl_key))


def failure_records(df: DataFrame, rules, as_of=None, platform_column: str | None = None) -> DataFrame:
    """One record per (rule, crawl) of all scopes. The table is scanned once, whatever kinds of rules there are; with
    group rules the counts are written first and everything else reads those."""
    entries = Entries.of(rules, platform_column)
    by_row, by_group = (any(f(s) for s in entries.rulesets) for f in (lambda s: s.row_rules(), lambda s: s.group_rules()))
    if not (by_row or by_group):
        raise RuleError("no rules")
    tally = scan_once(df, entries, as_of) if by_group else None
    parts = [make(df, entries, as_of, tally=tally) for make, any_ in ((row_failures, by_row), (group_failures, by_group)) if any_]
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def crawl_map(keys: list[str]) -> Column:
    """Crawl key as map<string,string>, the form shared by datasets with different keys."""
    if not keys:
        return F.lit(None).cast("map<string,string>")
    return F.when(~F.col("run_scope"), F.map_from_arrays(
        F.array(*[F.lit(k) for k in keys]), F.array(*[F.col(k).cast("string") for k in keys])))


def crawl_label(keys: list[str]) -> Column:
    """What a reader calls the crawl: its keyword, else date and hour, else all keys."""
    if "keyword" in keys:
        return F.coalesce(F.col("keyword").cast("string"), F.lit("null"))
    if "date_stamp" in keys or "hour_stamp" in keys:
        part = {k: F.coalesce(F.col(k).cast("string"), F.lit("?")) if k in keys else F.lit("?")
                for k in ("date_stamp", "hour_stamp")}
        return F.concat(part["date_stamp"], F.lit(" hour "), part["hour_stamp"])
    return F.to_json(crawl_map(keys))


def first_distinct(df: DataFrame, label: str, order: Column, limit: int, name: str) -> DataFrame:
    """First ``limit`` distinct labels per case, by the earliest place each is seen."""
    seen = df.groupBy(*CASE_KEY, label).agg(F.min(order).alias("_at"))
    rank = Window.partitionBy(*CASE_KEY).orderBy("_at", label)
    top = seen.withColumn("_r", F.row_number().over(rank)).where(F.col("_r") <= limit)
    return (top.groupBy(*CASE_KEY).agg(F.array_sort(F.collect_list(F.struct("_r", label))).alias("_l"))
            .select(*CASE_KEY, F.transform("_l", lambda x: x[label]).alias(name)))


def crawl_label_sample(failures: DataFrame, keys: list[str], limit: int = CRAWL_LABELS) -> DataFrame:
    """Per case: exact number of crawls and the first few distinct labels."""
    crawls = failures.where(~F.col("run_scope"))
    labelled = crawls.withColumn("label", crawl_label(keys))
    totals = crawls.groupBy(*CASE_KEY).agg(F.count(F.lit(1)).alias("total_crawls"))
    return totals.join(first_distinct(labelled, "label", sort_struct(keys), limit, "labels"), CASE_KEY, "left")


def fingerprint_cases(failures: DataFrame, keys: list[str]) -> DataFrame:
    """One row per (dataset, platform, rule).

    ``details`` and ``crawl_labels`` hold the first few distinct texts for display; ``n_details`` and
    ``n_crawls`` are exact. ``case_details`` and ``case_crawls`` hold all of them.
    """
    # True for every record. Reading all three counts in every branch keeps their column sets equal,
    # so the branches below share one scan and one shuffle.
    failures = failures.where((F.col("failed_count") > 0) & (F.col("total_count") > 0) & (F.col("entry_rows") > 0))
    order = sort_struct(keys)
    base = failures.groupBy(*CASE_KEY).agg(
        *[F.first(c, ignorenulls=False).alias(c) for c in RULE_FACTS],
        F.sum("failed_count").alias("failed_count"),
        F.max("entry_rows").alias("total_rows"),
        count_where(~F.col("run_scope")).alias("n_crawls"),
        F.count_distinct("detail").alias("n_details"))
    if not keys:
        base = base.withColumn("n_crawls", F.lit(0).cast("long"))
    cases = (base.withColumn("case_id", case_id(*[F.col(c) for c in CASE_KEY]))
             .join(first_distinct(failures, "detail", order, DETAILS, "details"), CASE_KEY, "left"))
    if keys:
        labels = crawl_label_sample(failures, keys).select(*CASE_KEY, F.col("labels").alias("crawl_labels"))
        cases = cases.join(labels, CASE_KEY, "left")
    else:
        cases = cases.withColumn("crawl_labels", F.lit(None).cast("array<string>"))
    return failed_share(cases)


def case_details(failures: DataFrame) -> DataFrame:
    """Every distinct detail text of every case, one row each."""
    return _per_case(failures, F.col("detail"), "detail")


def case_crawls(failures: DataFrame, keys: list[str]) -> DataFrame:
    """Every crawl label of every case, one row each; run-wide failures name no crawl."""
    return _per_case(failures.where(~F.col("run_scope")), crawl_label(keys), "label")


def _per_case(failures: DataFrame, text: Column, name: str) -> DataFrame:
    return (failures.groupBy(case_id(*[F.col(c) for c in CASE_KEY]).alias("case_id"), text.alias(name))
            .agg(F.count(F.lit(1)).alias("n_failures"), F.sum("failed_count").alias("failed_count")))


def failed_share(cases: DataFrame) -> DataFrame:
    """Failed rows over all rows of the entry, unrounded and rounded for display."""
    share = F.col("failed_count") / F.greatest(F.col("total_rows"), F.lit(1))
    return cases.withColumn("failed_share", share).withColumn("failed_share_3dp", F.bround(share, 3))


def case_samples(df: DataFrame, rules, columns: list[str], as_of=None, limit: int = SAMPLE_ROWS,
                 platform_column: str | None = None, per_crawl: bool = False, records: DataFrame | None = None) -> DataFrame:
    """First failing rows per case (or per case and crawl): crawl keys ascending, then the columns.

    ``records`` are the failure records of the same table and rules, if they are already there: the failing groups are
    then taken from them and not judged again.

    Each task keeps only its own first rows before the shuffle, so frequent rules do not pile up.
    """
    entries = Entries.of(rules, platform_column)
    keys = crawl_columns(df.columns, entries.crawl_key)
    carried = list(dict.fromkeys([*keys, *columns]))
    parts = []
    if any(s.row_rules() for s in entries.rulesets):
        parts.append(row_rule_set(df, entries, as_of, keep=carried))
    if any(s.group_rules() for s in entries.rulesets):
        parts.append(rows_of_failing_groups(df, entries, carried, as_of, first=None if per_crawl else limit, records=records))
    tagged = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    group = ["dataset", "platform_entry", "rule_id", *(keys if per_crawl else [])]
    rank = Window.partitionBy(*group).orderBy(*ascending(carried))
    return tagged.withColumn("sample_no", F.row_number().over(rank)).where(F.col("sample_no") <= limit)


def rows_of_failing_groups(df: DataFrame, rules, columns: list[str], as_of=None,
                           platform_column: str | None = None, first: int | None = None, records: DataFrame | None = None) -> DataFrame:
    """Guarded rows that belong to a failing crawl or run (of ``records``, or judged here).

    With ``first``, only the first failing crawls of each rule. That is enough for as many samples in
    crawl order, since each of them has a row, and leaves a handful of keys to look up.
    """
    if records is None:
        res, bound, keys, entries = group_results(df, rules, as_of, platform_column)
        bad = res.where(~F.col("ok")).select(ENTRY, RULE_NO, *keys)
    else:
        entries = Entries.of(rules, platform_column)
        keys = crawl_columns(df.columns, entries.crawl_key)
        bound = entries.bind(entries.prepare(df).schema, False, as_of)
        number = F.lit(None).cast("int")
        for n, b in enumerate(bound):  # the same id may be another rule for another platform
            here = (F.col("rule_id") == b.rule.id) & F.col("platform").isin(list(b.entries))
            number = F.when(here, F.lit(n)).otherwise(number)
        bad = records.where(F.col("scope") != "row").select(F.col("platform").alias(ENTRY), number.alias(RULE_NO), *keys)
    if first is not None:
        rank = Window.partitionBy(ENTRY, RULE_NO).orderBy(*(ascending(keys) or [F.lit(0)]))
        # a few rows per rule, written once: both parts below read them without checking again
        bad = materialise(bad.withColumn("_r", F.row_number().over(rank)).where(F.col("_r") <= first).drop("_r"))
    ready = entries.prepare(df)

    def rows_of(numbered, by: list[str]) -> DataFrame:
        """Rows under the guard of a failing rule, in the failing crawl when ``by`` names its keys."""
        numbers = [n for n, _ in numbered]
        keyed = bad.where(F.col(RULE_NO).isin(numbers)).select(
            F.col(ENTRY).alias("_e"), F.col(RULE_NO).alias("_no"), *[F.col(k).alias(f"_k_{k}") for k in by])
        crawls = keyed.select("_e", *[f"_k_{k}" for k in by]).distinct()
        if first is not None:  # at most ``first`` rows per rule and entry of the rule files
            keyed, crawls = F.broadcast(keyed), F.broadcast(crawls)
        here = F.col(ENTRY) == F.col("_e")
        for k in by:
            here = here & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
        rows = ready.join(crawls, here, "left_semi")  # first down to the crawls in question
        applied = F.array_remove(F.array(*[F.when(b.applies, n).otherwise(-1) for n, b in numbered]), -1)
        tagged = rows.select(ENTRY, *columns, *[c for c in by if c not in columns], F.explode(applied).alias("_n"))
        return tagged.join(keyed, here & (F.col("_n") == F.col("_no")), "left_semi").select(
            F.lit(entries.dataset).alias("dataset"), F.col(ENTRY).alias("platform_entry"),
            rule_ids(bound, F.col("_n")).alias("rule_id"), *columns)

    scopes = [[(n, b) for n, b in enumerate(bound) if (b.rule.scope == "crawl") == crawl] for crawl in (True, False)]
    parts = [rows_of(numbered, by) for numbered, by in zip(scopes, (keys, [])) if numbered]
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def union_entries(*cases: DataFrame) -> DataFrame:
    """Cases of several datasets as one table."""
    out = cases[0]
    for c in cases[1:]:
        out = out.unionByName(c, allowMissingColumns=True)
    return out


def case_rollup(cases: DataFrame) -> DataFrame:
    """Totals per dataset, platform and rule with subtotals."""
    return (cases.rollup(*CASE_KEY).agg(F.sum("failed_count").alias("failed_count"),
                                        F.count(F.lit(1)).alias("cases")))


# ------------------------------------------------------------------ recurrence

def recurrence_streak(case_runs: DataFrame, runs: DataFrame) -> DataFrame:
    """Consecutive runs in which a case was seen, counted over its own dataset's runs.

    ``case_runs``: dataset, case_id, run_seq. ``runs``: dataset, run_seq of every executed run,
    including those without cases. Windows hold one entry per run, never per row of data.
    """
    place = runs.select("dataset", "run_seq").distinct().withColumn(
        "_place", F.row_number().over(Window.partitionBy("dataset").orderBy("run_seq")))
    seen = case_runs.select("dataset", "case_id", "run_seq").distinct().join(place, ["dataset", "run_seq"])
    per_case = Window.partitionBy("dataset", "case_id").orderBy("_place")
    islands = seen.withColumn("_island", F.col("_place") - F.row_number().over(per_case))
    within = Window.partitionBy("dataset", "case_id", "_island").orderBy("_place")
    return islands.select("dataset", "case_id", "run_seq", F.row_number().over(within).alias("recurrence"))


def next_streaks(current: DataFrame, state: DataFrame) -> DataFrame:
    """Recurrence of the current run's cases from the previous run's state (case_id, recurrence)."""
    before = state.select("case_id", F.col("recurrence").alias("_before"))
    return (current.join(before, "case_id", "left")
            .withColumn("recurrence", F.coalesce(F.col("_before"), F.lit(0)) + 1).drop("_before"))

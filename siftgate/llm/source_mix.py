"""Mixing sources to target weights: Sainte-Laguë apportionment of equal-token blocks, then seeded block selection.

``mix`` counts the words of every document, gives every source a target, and fills it in three steps:

1. Sources that reach their limit (``repeat`` times their size) are taken whole that often. What is left is cut into
   blocks of equal length and given to the other sources, one block after the other to the highest quotient
   weight / (2 * blocks held + 1).
2. The blocks of a source go to its shards in the same way, by their sizes. Shards are hash classes of documents, so a
   hot source is many shards, and nothing larger than a shard is ever ordered in one task.
3. In a shard, documents stand in seeded order, end to end, and are cut into blocks. The quota is a number of whole
   passes and a rest; the rest takes every so many-th block from a seeded start on. So a document's share follows from
   its place alone, and no block is ever a row.

Only DataFrame functions. The quotients of a group are not listed: a divisor gives all but at most one block per
member, and only the candidates for those few are ordered. One row per source passes through one task (weights are an
input of that size); ``MAX_SHARDS`` bounds the shards of a source.

Defined results: a null or empty text has size 0 and nothing is taken; a null source is a source of its own; equal
rows are documents of their own and share what their places get; an empty table gives an empty result. Ties of
quotients go to the source that sorts first, ties of the seeded order to the smaller doc_id, then size. Columns other
than doc_id, source and text are not read, so extra columns never clash. Words are counted over whole texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from siftgate.llm.columns import WORD, words
from siftgate.sources.storage import materialise

WEIGHTS = (3, 1, 2)  # of the sources in order, repeating
PERCENT, REPEAT = 150, 2  # words of the mix in percent of all words; passes over a source or document at most
BLOCK, FINENESS = 64, 1000  # words of a block; a target is at least so many blocks, smaller targets have shorter blocks
SHARD_WORDS, MAX_SHARDS = 4_000_000, 4096
SEED = "mix"


def seeded(*parts: Column) -> Column:
    """A number below 2**60 that depends on the seed and the parts only."""
    text = F.concat_ws(":", F.lit(SEED), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def sainte_lague(df: DataFrame, group: str, key: str, votes: Column, seats: Column) -> DataFrame:
    """``group``, ``key``, ``quota``: the seats of each group dealt to its keys by highest votes / (2 * seats held + 1).

    ``seats`` is the same in all rows of a group, ``votes`` are whole numbers; no votes, no seats. With half a seat per
    member less than there is, rounded shares are seats that every member gets; with half a seat more they are the
    most it can get. Only the seats between the two are ordered, about one per member.
    """
    whole = Window.partitionBy(group)
    rounded = lambda more: F.expr(f"CAST(greatest(0, (_votes * (2 * _seats {more} _members) + _all) div (2 * _all)) AS LONG)")
    sized = (df.select(group, key, votes.cast("decimal(20,0)").alias("_votes"), seats.cast("decimal(16,0)").alias("_seats"))
             .withColumns({"_all": F.sum("_votes").over(whole).cast("decimal(20,0)"), "_members": F.count("*").over(whole).cast("decimal(16,0)")})
             .withColumns({"_all": F.greatest("_all", F.lit(1).cast("decimal(20,0)"))})
             .withColumns({"_low": rounded("-"), "_high": rounded("+")})
             .withColumn("_rest", F.col("_seats").cast("long") - F.sum("_low").over(whole)))
    tried = sized.withColumn("_seat", F.explode_outer(F.when(F.col("_high") > F.col("_low"), F.sequence(F.col("_low") + 1, F.col("_high")))))
    best = Window.partitionBy(group).orderBy(F.desc("_quotient"), key, "_seat")
    ranked = (tried.withColumn("_quotient", F.col("_votes").cast("double") / (2 * F.col("_seat") - 1))
              .withColumn("_rank", F.row_number().over(best)))
    return ranked.groupBy(group, key).agg(
        (F.min("_low") + F.count_if(F.col("_seat").isNotNull() & (F.col("_rank") <= F.col("_rest")))).alias("quota"))


def targets(sources: DataFrame, weight: Column, percent: int = PERCENT, repeat: int = REPEAT) -> DataFrame:
    """Sources (``source``, ``source_size``) with ``source_no``, ``weight``, ``target`` and ``full`` (taken ``repeat`` times).

    ``percent`` of all sizes are shared by weight; a target stops at ``repeat`` times its source, and what is left over
    is shared again until no target is above. Sources in order of limit over weight: one is full if sharing among it and
    those after it would reach its limit.
    """
    number = Window.orderBy(F.asc_nulls_last("source"))
    whole = Window.partitionBy()
    filling = Window.orderBy(F.col("_limit") / F.col("weight"), "source_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    wanted = F.sum("source_size").over(whole) * (percent / 100)
    return (sources.withColumn("source_no", F.row_number().over(number)).withColumn("weight", weight.cast("long"))
            .withColumns({"_limit": F.col("source_size") * repeat, "_wanted": wanted, "_weights": F.sum("weight").over(whole)})
            .withColumns({"_before": F.sum("_limit").over(filling) - F.col("_limit"), "_used": F.sum("weight").over(filling) - F.col("weight")})
            .withColumn("full", F.col("_limit") * (F.col("_weights") - F.col("_used")).cast("double") <= (F.col("_wanted") - F.col("_before")) * F.col("weight"))
            .withColumns({"_left": F.col("_wanted") - F.coalesce(F.sum(F.when(F.col("full"), F.col("_limit"))).over(whole), F.lit(0)),
                          "_open": F.sum(F.when(~F.col("full"), F.col("weight"))).over(whole)})
            .withColumn("target", F.when(F.col("full"), F.col("_limit").cast("double")).otherwise(F.col("weight") * F.col("_left") / F.col("_open")))
            .withColumn("_least", F.min(F.when(~F.col("full"), F.col("target"))).over(whole))
            .select("source_no", "source", "source_size", "weight", "target", "full", F.coalesce("_left", F.lit(0.0)).alias("left_over"),
                    F.greatest(F.lit(1), F.least(F.lit(BLOCK), F.floor(F.col("_least") / FINENESS))).cast("long").alias("block")))


def taken_before(place: Column) -> Column:
    """Words of a shard before a place that lie in chosen blocks: block k is chosen where (k * rest + start) div blocks steps."""
    steps = lambda k: F.floor((k.cast("decimal(20,0)") * F.col("rest").cast("decimal(18,0)") + F.col("start")) / F.col("blocks")).cast("long")
    block = F.floor(place / F.col("block")).cast("long")
    return steps(block) * F.col("block") + (place - block * F.col("block")) * (steps(block + 1) - steps(block))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, percent: int = PERCENT, repeat: int = REPEAT) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target (its source's), passes, pieces, taken.

    The mix holds the whole document ``passes`` times and besides the words of ``pieces`` (start, end) once;
    ``taken`` counts them all. ``weights`` are dealt to the sources in code point order, null last, and repeat.
    """
    sizes = materialise(docs.select("doc_id", "source", F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long").alias("size")))
    place = (F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1) % len(weights)
    plan = targets(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), F.array(*map(F.lit, weights))[place], percent, repeat)
    plan = materialise(plan.withColumn("shards", F.least(F.lit(MAX_SHARDS), F.greatest(F.lit(1), F.ceil(F.col("source_size") / SHARD_WORDS))).cast("long")))
    quotas = sainte_lague(plan.filter("NOT full").withColumn("all", F.lit(0)), "all", "source_no", F.col("weight"), F.round(F.col("left_over") / F.col("block")))
    plan = plan.join(quotas.drop("all"), "source_no", "left")

    dealt = (sizes.join(plan.select("source_no", F.col("source").alias("_source"), "source_size", "target", "shards"), F.col("source").eqNullSafe(F.col("_source")))
             .withColumn("_seed", seeded(F.col("doc_id"))).withColumn("shard", F.col("_seed") % F.col("shards")))
    shards = dealt.groupBy("source_no", "shard").agg(F.sum("size").alias("words")).join(plan.select("source_no", "quota", "full", "block"), "source_no")
    shards = shards.withColumn("blocks", F.ceil(F.col("words") / F.col("block")).cast("long"))
    dealt_quotas = sainte_lague(shards.filter("NOT full"), "source_no", "shard", F.col("words"), F.col("quota"))
    shards = (shards.select("source_no", "shard", "full", "block", "blocks").join(dealt_quotas, ["source_no", "shard"], "left")
              .withColumn("quota", F.when(F.col("full"), F.col("blocks") * repeat).otherwise(F.least("quota", F.col("blocks") * repeat)))
              .filter("blocks > 0")
              .select("source_no", "shard", "block", "blocks", F.expr("quota div blocks").alias("passes"), (F.col("quota") % F.col("blocks")).alias("rest"),
                      (seeded(F.col("source_no"), F.col("shard")) % F.col("blocks")).alias("start")))
    in_shard = Window.partitionBy("source_no", "shard").orderBy("_seed", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (dealt.join(shards, ["source_no", "shard"], "left")
              .withColumn("_end", F.sum("size").over(in_shard)).withColumn("_begin", F.col("_end") - F.col("size")))
    once = F.when((F.col("rest") > 0) & (F.col("size") > 0), taken_before(F.col("_end")) - taken_before(F.col("_begin"))).otherwise(F.lit(0))
    return placed.select("doc_id", "source", "size", "source_size", "target", F.coalesce("passes", F.lit(0)).alias("passes"), pieces().alias("pieces"),
                         F.coalesce(F.col("passes") * F.col("size") + once, F.lit(0)).cast("long").alias("taken"))


def pieces() -> Column:
    """The parts of a document that lie in chosen blocks, as (start, end) in words."""
    inside = F.expr("""transform(filter(sequence(_begin div block, (_end - 1) div block),
        k -> (CAST(k AS DECIMAL(20,0)) * rest + start) div blocks < ((CAST(k AS DECIMAL(20,0)) + 1) * rest + start) div blocks),
        k -> struct(CAST(greatest(k * block - _begin, 0) AS LONG) AS start, CAST(least((k + 1) * block, _end) - _begin AS LONG) AS end))""")
    return F.when((F.col("rest") > 0) & (F.col("size") > 0), inside).otherwise(F.expr("CAST(array() AS array<struct<start:bigint,end:bigint>>)"))


def mixed_parts(text: Column, passes: Column, parts: Column) -> Column:
    """The texts that a document gives to the mix: itself ``passes`` times, then the words of each piece."""
    cut = F.transform(parts, lambda p: F.array_join(F.slice(words(text), (p["start"] + 1).cast("int"), (p["end"] - p["start"]).cast("int")), " "))
    return F.concat(F.array_repeat(text, passes.cast("int")), cut)

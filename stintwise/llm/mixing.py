"""Mix of sources to target weights by a low-discrepancy schedule of equal-token blocks.

Targets are solved over the table of sources: weights share the total, no source above a multiple of
its own size. Each source's documents are put in a shuffled order by a keyed digest of the id and laid
end to end; blocks of equal token counts are cut from that line. Slot n of the schedule is the point
frac(n * golden ratio) on the line of cumulative targets and so belongs to one source; the slot's rank
among its source's slots names the block it takes, starting again after the last block. A source stops at
its target, inside a block if need be.

Running sums and ranks over a source go in two levels (buckets or runs of slots, then inside them), so
a source that holds a third of all rows is dealt over many tasks. Everything is built-in columns.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import staged

WORD = r"[^\x20\x09-\x0D]+"
GOLDEN = (math.sqrt(5) - 1) / 2


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def shuffle_key(doc_id: Column, seed: str) -> Column:
    return F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: float, most: float) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``, one row per source.

    The weights repeat over the sources by code point, null last. Sharing out what is above a source's
    limit by weight, until nothing is, ends at min(limit, level * weight): sources are filled in order of
    limit per weight and the level is what is left over the weights left.
    """
    one = F.lit(1)  # the table of sources is as long as there are sources
    ranked = sizes.withColumn("nth", F.row_number().over(W.partitionBy(one).orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("nth") % len(weights) + 1).cast("int"))
    limited = ranked.withColumns({"weight": weight, "limit": F.col("source_size") * F.lit(most)})
    order = W.partitionBy(one).orderBy(F.col("limit") / F.col("weight"), "nth")
    before, after = order.rowsBetween(W.unboundedPreceding, -1), order.rowsBetween(0, W.unboundedFollowing)
    left = F.sum("source_size").over(W.partitionBy(one)) * F.lit(share) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    levelled = limited.withColumn("level", left / F.sum("weight").over(after))
    full = F.col("limit") <= F.col("level") * F.col("weight")
    level = F.min(F.when(~full, F.struct(F.col("limit") / F.col("weight"), F.col("nth"), F.col("level").alias("v")))).over(W.partitionBy(one))
    return levelled.select("source", "source_size", "nth", F.when(full, F.col("limit")).otherwise(F.least("limit", level["v"] * F.col("weight"))).alias("target"))


def slot_ranks(spark, n_slots: int, shares: DataFrame, cells: int, run: int = 4096) -> DataFrame:
    """``nth, rank, slot``: the golden-ratio points mapped to sources and ranked within each by slot.

    ``shares`` has ``nth, low, high``: each source's stretch of [0, 1). A point meets only the stretches in its
    own cell of the line. Ranks come from counts per run of slots plus the rank inside the run.
    """
    points = spark.range(n_slots).select(F.col("id").alias("slot"), ((F.col("id") + 0.5) * GOLDEN % 1.0).alias("point"), F.expr(f"id div {run}").alias("run"))
    points = points.withColumn("cell", F.floor(F.col("point") * cells))
    last = F.least(F.floor(F.col("high") * cells), F.lit(cells - 1))
    stretches = shares.where("low < high").select("nth", "low", "high", F.explode(F.sequence(F.floor(F.col("low") * cells), last)).alias("cell"))
    taken = points.join(stretches, "cell").where("low <= point and point < high").select("nth", "run", "slot")
    counts = taken.groupBy("nth", "run").agg(F.count("*").alias("n"))
    opening = F.coalesce(F.sum("n").over(W.partitionBy("nth").orderBy("run").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select("nth", "run", opening.alias("opening"))
    inside = F.row_number().over(W.partitionBy("nth", "run").orderBy("slot")) - 1
    return taken.withColumn("r", inside).join(starts, ["nth", "run"]).select("nth", (F.col("r") + F.col("opening")).alias("rank"), "slot")


def mix_sources(
    docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0, block: int = 4096, least_slots: int = 500, seed: str = "mix", bucket_rows: int = 20_000
) -> DataFrame:
    """``doc_id, size, source_size, target, taken, first_slot`` for every row of ``docs``.

    ``first_slot`` is the place in the mix at which a document is first reached, null for one that is not: up to any slot each
    source has had the share of slots that the points give it.

    Null and empty texts have size 0 and nothing taken. A null source is a source of its own, the last. A
    null id is shuffled as the empty text. Repeated rows take their own place each. ``block`` is the number of words
    in a block, less where the mix would have under ``least_slots`` blocks a source. ``taken`` is whole: a source's
    documents together take its target rounded down. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    sized = staged(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), n_words(F.col("text")).alias("size")), "mix-sizes")
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    targets = staged(source_targets(sizes.select("source", "source_size"), weights, share, most), "mix-targets")
    total = targets.agg(F.sum("target"), F.count("*"), F.sum("source_size")).first()
    n_rows = sized.count()
    words, n_sources = float(total[0] or 0), int(total[1])
    block = max(1, min(block, int(words / (max(1, n_sources) * least_slots))))
    placed = _laid_out(sized, targets, max(256, math.ceil(n_rows / bucket_rows)), seed)
    slots = _schedule(spark, targets, words, block)
    first, last = F.expr(f"start div {block}"), F.expr(f"(start + size - 1) div {block}")
    pieces = placed.where("size > 0").select("row", "nth", "start", "size", F.explode(F.sequence(first, last)).alias("block"))
    low = F.greatest(F.col("start"), F.col("block") * block) - F.col("block") * block
    high = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block) - F.col("block") * block
    cut = pieces.select("row", "nth", "block", low.alias("low"), high.alias("high"))
    used = slots.groupBy("nth", "block").agg(F.collect_list("take").alias("takes"), F.min(F.struct("slot", "take")).alias("first"))
    got = F.aggregate("takes", F.lit(0).cast("long"), lambda a, t: a + F.greatest(F.lit(0), F.least(F.col("high"), t) - F.col("low")))
    reached = F.when(F.col("low") < F.col("first.take"), F.col("first.slot"))  # a later slot of the block never takes more of it
    taken = cut.join(used, ["nth", "block"]).groupBy("row").agg(F.sum(got).alias("taken"), F.min(reached).alias("first_slot"))
    return placed.join(taken, "row", "left").select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken"), "first_slot")


def _laid_out(sized: DataFrame, targets: DataFrame, buckets: int, seed: str) -> DataFrame:
    """Rows with ``nth`` of their source, its size and target, and ``start``: the words before them in its shuffled order."""
    key = shuffle_key(F.col("doc_id"), seed)
    known = sized.join(targets, sized["source"].eqNullSafe(targets["source"])).select("doc_id", "size", "nth", "source_size", "target", key.alias("key"))
    bucket = (F.conv(F.substring("key", 1, 8), 16, 10).cast("long") * buckets / F.lit(1 << 32)).cast("long")
    rows = known.withColumn("bucket", bucket)
    sums = rows.groupBy("nth", "bucket").agg(F.sum("size").alias("words"))
    opening = F.coalesce(F.sum("words").over(W.partitionBy("nth").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = sums.select("nth", "bucket", opening.alias("opening"))
    inside = W.partitionBy("nth", "bucket").orderBy("key", "doc_id", "size").rowsBetween(W.unboundedPreceding, -1)
    start = F.col("opening") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    return staged(rows.join(starts, ["nth", "bucket"]).withColumn("start", start).select("doc_id", "size", "nth", "source_size", "target", "start", F.monotonically_increasing_id().alias("row")), "mix-rows")


def _schedule(spark, targets: DataFrame, words: float, block: int) -> DataFrame:
    """``nth, slot, block, take``: each used slot's block of its source and how many of its words it takes.

    The sequence may leave a source a few slots short of its target; those follow at the end, at one slot beyond its last.
    """
    goal = F.floor("target")
    per_pass = F.ceil(F.col("source_size") / block)
    over = goal - F.floor(goal / F.col("source_size")) * F.col("source_size")
    need = F.floor(goal / F.col("source_size")) * per_pass + F.ceil(over / block)
    plan = targets.where("source_size > 0").select("nth", "source_size", goal.alias("goal"), per_pass.alias("per_pass"), need.alias("need"), "target")
    order = W.partitionBy(F.lit(1)).orderBy("nth")
    before = F.coalesce(F.sum("target").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    low = before / F.lit(max(words, 1.0))
    plan = staged(plan.withColumn("low", low).withColumn("high", F.lead("low", 1, 1.0).over(order)), "mix-plan")
    n_sources = plan.count()
    n_slots = math.ceil(words / block) + n_sources
    ranked = slot_ranks(spark, n_slots, plan.select("nth", "low", "high"), max(4096, 4 * n_sources))
    reached = ranked.groupBy("nth").agg(F.count("*").alias("got"))
    short = plan.join(reached, "nth", "left").select("nth", F.coalesce("got", F.lit(0)).alias("got"), "need").where("got < need")
    rest = short.select("nth", F.explode(F.sequence(F.col("got"), F.col("need") - 1)).alias("rank"), F.lit(n_slots).cast("long").alias("slot"))
    slots = ranked.select("nth", "rank", "slot").unionByName(rest).join(plan, "nth").where("rank < need")
    place = F.expr("rank % per_pass")
    at = F.expr("rank div per_pass") * F.col("source_size") + place * block
    length = F.least(F.lit(block), F.col("source_size") - place * block)
    return slots.select("nth", "slot", place.alias("block"), F.least(length, F.col("goal") - at).cast("long").alias("take"))

"""Order-dependent operators that stay parallel when one group is huge.

A plain window sends each group to one task. Where a group is too large for that, its rows are dealt over ranges of the
group's order (``in_ranges``), and three shapes of work go on from there without bringing the group together again:

* ``neighbours``  - functions of a few adjacent rows (lag, lead, rolling mean), in chunks of equal size which hold
  the rows on either side of them as well;
* ``running``     - functions of all rows before (row number, running sum, previous value, last known value), each
  range going on from one opening row that holds what came before it;
* ``rank_within`` - rank and dense rank by a numeric value, as a running sum over distinct values.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..session import shared_dir, written
from .hot import HOT_ROWS, join_back, prefixed, rows_in_hot_groups, same_keys, split_hot

CHUNK_ROWS = 2_000_000

WindowFn = Callable[[WindowSpec], Column]


def in_ranges(df: DataFrame, keys: Sequence[str], arrange: Sequence[Column], rows: int, per_range: int) -> DataFrame:
    """``df`` in order of (keys, ``arrange``), with ``__part`` and ``__at``, both rising along that order.

    The rows are ranged by sampled bounds into parts of about ``per_range`` rows; rows that ``arrange`` cannot tell apart are
    told apart by a number, so not even a run of equal rows must fit in one part. The result is written to the shared
    folder: a second evaluation would sample other bounds.
    """
    parts = max(math.ceil(rows / per_range), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    order = [*map(F.asc, keys), *arrange]
    numbered = df.withColumn("__number", F.monotonically_increasing_id())
    ranged = numbered.repartitionByRange(parts, *order, "__number").sortWithinPartitions(*order, "__number").drop("__number")
    return written(ranged.withColumns({"__part": F.spark_partition_id(), "__at": F.monotonically_increasing_id()}), "ranges")


def positions(placed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``in_ranges`` with ``__pos``, their place in the group from 0, and ``__size``, the group's.

    Rows of a group stand without a gap inside a part, so a count per (group, part) is all that must be known of the others.
    """
    counted = placed.groupBy(*keys, "__part").agg(F.count(F.lit(1)).alias("__rows"), F.min("__at").alias("__first"))
    group = Window.partitionBy(*keys)
    before = F.coalesce(F.sum("__rows").over(group.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    opened = counted.select(*keys, "__part", (before - F.col("__first")).alias("__shift"), F.sum("__rows").over(group).alias("__size"))
    # One row a part and one more a group; groups here are hot, so both are few.
    side = F.broadcast(prefixed(opened, [*keys, "__part"], "__s_"))
    joined = placed.join(side, same_keys([*keys, "__part"], "__s_")).drop(*[f"__s_{k}" for k in [*keys, "__part"]])
    return joined.withColumn("__pos", F.col("__at") + F.col("__shift")).drop("__shift")


def in_chunks(placed: DataFrame, keys: Sequence[str], back: int, ahead: int, chunk_rows: int) -> DataFrame:
    """Rows of ``in_ranges`` dealt to chunks of exactly ``chunk_rows`` rows of a group, by ``__chunk``.

    Each row stands in its own chunk (``__own``) and, as a guest, in every other that holds a row which looks at it.
    """
    first = F.expr(f"greatest(__pos - {ahead}, 0) div {chunk_rows}")
    last = F.expr(f"least(__pos + {back}, __size - 1) div {chunk_rows}")
    dealt = positions(placed, keys).withColumn("__chunk", F.explode(F.sequence(first, last)))
    return dealt.withColumn("__own", F.col("__chunk") == F.expr(f"__pos div {chunk_rows}")).drop("__size")


def neighbours(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: Mapping[str, WindowFn],
    back: int,
    ahead: int,
    nulls_last: bool = False,
    hot_rows: int = HOT_ROWS,
    chunk_rows: int = CHUNK_ROWS,
    sizes_from: DataFrame | None = None,
) -> DataFrame:
    """Add columns that look at most ``back`` rows behind and ``ahead`` rows on.

    Ties are broken by the other columns, so the result does not depend on how rows arrive; select only what is needed
    before calling. Ordinary groups use one window. Hot groups are put in order by ranges and cut into chunks of
    ``chunk_rows`` rows; no step orders more than a chunk and the few rows next to it.

    A counting job finds out whether there are hot groups. Where ``df`` is
    expensive, ``sizes_from`` can name an earlier table with the same groups. Without a folder to
    write to (see ``shared_dir``) all groups use one window.
    """
    names = df.columns
    ties = [c for c in names if c not in keys and c not in order]
    toward = F.asc_nulls_last if nulls_last else F.asc_nulls_first
    by_hash = F.xxhash64(*ties) if ties else F.lit(0)
    arrange = [*map(toward, order), by_hash, *map(F.asc, ties)]
    plain = Window.partitionBy(*keys).orderBy(*arrange)
    rows = _hot_rows(df if sizes_from is None else sizes_from, keys, hot_rows)
    if not rows:
        return df.withColumns({n: f(plain) for n, f in columns.items()})

    ordinary, hot = split_hot(df, keys, hot_rows)
    done = ordinary.withColumns({n: f(plain) for n, f in columns.items()})
    # Ranges go by the hash of the other columns, sorting and windows by the columns themselves after it.
    placed = in_ranges(hot.drop("hot_count").withColumn("__ties", by_hash), keys, [*map(toward, order), F.asc("__ties")], rows, max(chunk_rows, back + ahead))
    chunks = in_chunks(placed, keys, back, ahead, chunk_rows)
    along = Window.partitionBy(*keys, "__chunk").orderBy("__pos")
    solved = chunks.withColumns({n: f(along) for n, f in columns.items()}).where("__own")
    return done.unionByName(solved.select(*names, *columns))


def _hot_rows(df: DataFrame, keys: Sequence[str], hot_rows: int) -> int:
    """Rows in hot groups; 0 as well where there is no folder for ranges, so that callers use one window."""
    return rows_in_hot_groups(df, keys, hot_rows) if shared_dir(df.sparkSession) else 0


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    position: str | None = None,
    totals: Mapping[str, Column] | None = None,
    previous: Mapping[str, Column] | None = None,
    latest: Mapping[str, Column] | None = None,
    hot_rows: int = HOT_ROWS,
    per_range: int = CHUNK_ROWS,
    sizes_from: DataFrame | None = None,
) -> DataFrame:
    """Row number, inclusive running totals, previous values and last known values.

    ``order`` should identify a row. Where ``df`` is expensive, ``sizes_from`` can name an earlier table with the same groups. Ordinary groups use one window. In hot groups windows run per (keys, range), and a table
    with one row per group and range carries counts, sums and last values from range to range: no task sees a whole group.
    """
    totals, previous, latest = totals or {}, previous or {}, latest or {}

    def upto_here(window: WindowSpec, step: Column, source: Callable[[str], Column]) -> dict[str, Column]:
        upto = window.rowsBetween(Window.unboundedPreceding, 0)
        added = {position: F.sum(step).over(upto)} if position else {}
        added.update({n: F.sum(source(n)).over(upto) for n in totals})
        added.update({n: F.lag(source(n)).over(window) for n in previous})
        added.update({n: F.last(source(n), ignorenulls=True).over(upto) for n in latest})
        return added

    inputs = {**totals, **previous, **latest}
    arrange = [F.asc(c) if isinstance(c, str) else c for c in order]
    whole = upto_here(Window.partitionBy(*keys).orderBy(*arrange), F.lit(1), inputs.__getitem__)
    rows = _hot_rows(df if sizes_from is None else sizes_from, keys, hot_rows)
    if not rows:
        return df.withColumns(whole)

    ordinary, hot = split_hot(df, keys, hot_rows)
    done = ordinary.withColumns(whole)
    wide = hot.drop("hot_count").withColumns({f"__in_{n}": c for n, c in inputs.items()}) if inputs else hot.drop("hot_count")
    placed = in_ranges(wide, keys, arrange, rows, per_range)
    cells = [*keys, "__part"]
    per_part = placed.groupBy(*cells).agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.sum(f"__in_{n}").alias(f"__sum_{n}") for n in totals],
        *[F.max_by(F.col(f"__in_{n}"), "__at").alias(f"__end_{n}") for n in previous],
        *[F.max_by(F.col(f"__in_{n}"), F.when(F.col(f"__in_{n}").isNotNull(), F.col("__at"))).alias(f"__known_{n}") for n in latest],
    )
    by_part = Window.partitionBy(*keys).orderBy("__part")
    before = by_part.rowsBetween(Window.unboundedPreceding, -1)
    # One opening row per part brings in what the parts before it hold, so
    # the windows inside a part continue from there without a join.
    opening = per_part.select(
        *cells,
        F.lit(-1).cast("long").alias("__at"),
        F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__step"),
        *[F.sum(f"__sum_{n}").over(before).alias(f"__in_{n}") for n in totals],
        *[F.lag(f"__end_{n}").over(by_part).alias(f"__in_{n}") for n in previous],
        *[F.last(f"__known_{n}", ignorenulls=True).over(before).alias(f"__in_{n}") for n in latest],
    )
    inside = Window.partitionBy(*cells).orderBy("__at")
    added = upto_here(inside, F.col("__step"), lambda n: F.col(f"__in_{n}"))
    both = placed.withColumn("__step", F.lit(1)).unionByName(opening, allowMissingColumns=True)
    solved = both.withColumns(added).where(F.col("__at") >= 0)
    return done.unionByName(solved.select(*done.columns))


def rank_within(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    name: str,
    descending: bool = False,
    dense: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``rank()`` or ``dense_rank()`` of a numeric column within each group.

    Nulls rank first ascending and last descending, as in Spark SQL. In hot groups equal values fold into one counted
    value; the values, not the rows, are numbered and summed up in order.
    """
    toward = F.desc_nulls_last if descending else F.asc_nulls_first
    plain = (F.dense_rank() if dense else F.rank()).over(Window.partitionBy(*keys).orderBy(toward(value)))
    if not _hot_rows(df, keys, hot_rows):
        return df.withColumn(name, plain)

    ordinary, hot = split_hot(df, keys, hot_rows)
    done = ordinary.withColumn(name, plain)
    hot = hot.drop("hot_count")
    counted = hot.select(*keys, F.col(value).alias("__v")).groupBy(*keys, "__v").agg(F.count(F.lit(1)).alias("__ties"))
    scanned = running(counted, keys, [toward("__v")], position="__nth", totals={"__seen": F.col("__ties")}, hot_rows=hot_rows)
    rank = F.col("__nth") if dense else F.col("__seen") - F.col("__ties") + 1
    ranks = scanned.select(*keys, F.col("__v").alias("__rank_v"), rank.cast("int").alias(name))
    ranked = join_back(hot.withColumn("__rank_v", F.col(value)), ranks, [*keys, "__rank_v"], null_safe=True).drop("__rank_v")
    return done.unionByName(ranked)

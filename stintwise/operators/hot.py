"""Splitting off groups too large for one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 10_000_000
"""Groups above this many rows are not handed to a single task."""

BROADCAST_GROUPS = 100_000
"""Summaries of up to this many groups are broadcast."""


def all_known(columns: Sequence[str]) -> Column:
    return reduce(and_, [F.col(c).isNotNull() for c in columns])


def same_keys(keys: Sequence[str], prefix: str) -> Column:
    """Null-safe equality of each key with ``<prefix><key>``, a hash-join condition."""
    return reduce(and_, [F.col(k).eqNullSafe(F.col(prefix + k)) for k in keys])


def prefixed(df: DataFrame, keys: Sequence[str], prefix: str) -> DataFrame:
    return df.withColumnsRenamed({k: prefix + k for k in keys})


def hot_groups(df: DataFrame, keys: Sequence[str], hot_rows: int, **stats: Column) -> DataFrame:
    """Keys of the groups with more than ``hot_rows`` rows, as ``hot_<key>``.

    The count combines map-side. The result has at most
    ``rows / hot_rows`` rows, which is the bound that lets callers broadcast it.
    """
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("hot_count"), *[c.alias(n) for n, c in stats.items()])
    return prefixed(counted.where(F.col("hot_count") > hot_rows), keys, "hot_")


def rows_in_hot_groups(df: DataFrame, keys: Sequence[str], hot_rows: int) -> int:
    """How many rows are in groups that exceed ``hot_rows``: one job over the key columns.

    Asking first keeps the plan of ordinary data to a single window.
    """
    return hot_groups(df, keys, hot_rows).agg(F.coalesce(F.sum("hot_count"), F.lit(0))).first()[0]


def split_hot(
    df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS, **stats: Column
) -> tuple[DataFrame, DataFrame]:
    """(rows of ordinary groups, rows of hot groups with ``hot_count`` and stats).

    Adds no shuffle of the rows: the hot keys are broadcast.
    """
    hot = F.broadcast(hot_groups(df, keys, hot_rows, **stats))
    on = same_keys(keys, "hot_")
    ordinary = df.join(hot, on, "left_anti")
    large = df.join(hot, on, "inner").drop(*[f"hot_{k}" for k in keys])
    return ordinary, large


def few_groups(df: DataFrame, keys: Sequence[str], limit: int = BROADCAST_GROUPS) -> bool:
    """Whether the keys take about ``limit`` values at most.

    A sketch over the key columns: one narrow scan, nothing shuffled but the
    sketches.
    """
    return df.agg(F.approx_count_distinct(F.struct(*keys))).first()[0] <= limit


def join_back(
    rows: DataFrame,
    summary: DataFrame,
    keys: Sequence[str],
    null_safe: bool = False,
    sizes_from: DataFrame | None = None,
) -> DataFrame:
    """Left join of a per-group summary onto its rows.

    ``sizes_from`` names a table whose groups are counted first: few groups
    are broadcast and the rows stay where they are. Otherwise both sides are
    shuffled for the join. The null-safe condition keeps the join from leaning
    on the partitioning of the aggregate below it, which AQE needs to be able
    to split a skewed group on the row side.

    Rows with a null key get nulls unless ``null_safe``.
    """
    if not null_safe:
        summary = summary.where(all_known(keys))
    if sizes_from is not None and few_groups(sizes_from, keys):
        summary = F.broadcast(summary)
    side = prefixed(summary, keys, "__s_")
    return rows.join(side, same_keys(keys, "__s_"), "left").drop(*[f"__s_{k}" for k in keys])

"""Lap-level measures: sector deltas, rolling pace, circuit score, group shares."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import share_pct
from .hot import HOT_ROWS, all_known, few_groups, join_back, prefixed, rows_in_hot_groups, same_keys, split_hot
from .ordered import neighbours

ROLLING_LAPS = 5
RACE_KEYS = ("race_name",)
SECTOR_DELTAS = {
    "sector1_delta": "sector1_time_seconds",
    "sector2_delta": "sector2_time_seconds",
    "sector3_delta": "sector3_time_seconds",
}


def delta_to_best(
    df: DataFrame, keys: Sequence[str], deltas: dict[str, str], sizes_from: DataFrame | None = None, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Each value minus the smallest of its group. Rows with a null key get null.

    Few groups: their minima combine map-side, are broadcast, and the rows stay where they are. Many groups: the rows go by
    key once and a window has the minimum; only groups too large for that, of which there can be few, take theirs from a broadcast.
    """
    source = df if sizes_from is None else sizes_from
    best = {f"__best_{name}": F.min(s) for name, s in deltas.items()}

    def less(joined: DataFrame) -> DataFrame:
        known = all_known(keys)
        return joined.withColumns({n: F.when(known, F.col(s) - F.col(f"__best_{n}")) for n, s in deltas.items()}).drop(*best)

    if few_groups(source, keys):
        small = F.broadcast(prefixed(df.groupBy(*keys).agg(*[c.alias(n) for n, c in best.items()]), keys, "__s_"))
        return less(df.join(small, same_keys(keys, "__s_"), "left").drop(*[f"__s_{k}" for k in keys]))
    group = Window.partitionBy(*keys)
    windowed = {n: c.over(group) for n, c in best.items()}
    if not rows_in_hot_groups(source, keys, hot_rows):
        return less(df.withColumns(windowed))
    ordinary, hot = split_hot(df, keys, hot_rows, **best)
    return less(ordinary.withColumns(windowed).unionByName(hot.drop("hot_count")))


def sector_deltas(df: DataFrame, race_keys: Sequence[str] = RACE_KEYS, lap: str = "lap_number") -> DataFrame:
    """Loss to the fastest driver of the same lap, per sector."""
    return delta_to_best(df, [*race_keys, lap], SECTOR_DELTAS)


def rolling_pace(
    df: DataFrame,
    race_keys: Sequence[str] = RACE_KEYS,
    order: Sequence[str] = ("lap_number",),
    driver: str = "driver",
    value: str = "lap_time_seconds",
    laps: int = ROLLING_LAPS,
    hot_rows: int = HOT_ROWS,
    sizes_from: DataFrame | None = None,
) -> DataFrame:
    """``race_pace_index``, the mean of the last ``laps`` laps, and the delta to it.

    With keys that leave out the season, name it in ``order`` to fix which of
    two equal lap numbers comes first.
    """
    keys = [*race_keys, driver]

    def mean(w):
        return F.avg(value).over(w.rowsBetween(1 - laps, Window.currentRow))

    rolled = neighbours(
        df, keys, order, {"race_pace_index": mean}, back=laps - 1, ahead=0, nulls_last=True,
        hot_rows=hot_rows, sizes_from=sizes_from,
    )
    rolled = rolled.withColumn("race_pace_index", F.when(all_known(keys), F.col("race_pace_index")))
    return rolled.withColumn("race_pace_delta", F.col(value) - F.col("race_pace_index"))


def performance_score(
    df: DataFrame,
    race_keys: Sequence[str] = RACE_KEYS,
    driver: str = "driver",
    value: str = "lap_time_seconds",
    measured_on: DataFrame | None = None,
) -> DataFrame:
    """Race mean over driver mean, in percent; null where the driver mean is zero.

    Both means come from per-driver sums and counts: the race level rolls up
    the driver level, and one join brings the score to the laps. Where ``df``
    is expensive, ``measured_on`` can name an earlier table with the same rows.
    """
    source = df if measured_on is None else measured_on
    measured = source.where(all_known([*race_keys, driver]) & F.col(value).isNotNull())
    per_driver = measured.groupBy(*race_keys, driver).agg(F.sum(value).alias("__sum"), F.count(value).alias("__n"))
    # A lap without a driver still counts for the race mean.
    per_race = source.groupBy(*race_keys).agg(F.avg(value).alias("__race_mean"))
    means = join_back(per_driver, per_race, race_keys)
    score = F.try_divide(F.col("__race_mean"), F.col("__sum") / F.col("__n")) * 100
    scores = means.select(*race_keys, driver, score.alias("circuit_performance_score"))
    return join_back(df, scores, [*race_keys, driver], sizes_from=source)


def share_of_group(df: DataFrame, group: Sequence[str], part: Sequence[str], name: str) -> DataFrame:
    """Rows per (group, part) as a percentage of the rows of the group."""
    counts = df.groupBy(*group, *part).agg(F.count(F.lit(1)).alias("__part"))
    totals = df.groupBy(*group).agg(F.count(F.lit(1)).alias("__whole"))
    joined = join_back(counts, totals, group, null_safe=True)
    return joined.select(*group, *part, share_pct(F.col("__part"), F.col("__whole")).alias(name))

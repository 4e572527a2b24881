"""The four gold tables, each from engineered laps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import consistency_index, is_pit_free, strategy_type
from ..operators.hot import HOT_ROWS, all_known, join_back
from ..operators.ordered import neighbours
from ..operators.transform import share_of_group

RACE = ("season", "race_name")
DRIVER_RACE = ("season", "race_name", "driver")
UNDERCUT_LAPS = 10


def driver_analytics(laps: DataFrame, keys: Sequence[str] = DRIVER_RACE) -> DataFrame:
    """Pace, spread and places gained per driver and race.

    The laps of a driver carry one grid and one final position; where they differ the least counts, so reruns agree.
    """
    lap_time = F.col("lap_time_seconds")
    return (
        laps.groupBy(*keys)
        .agg(
            F.avg(lap_time).alias("avg_lap_time_seconds"),
            F.min(lap_time).alias("fastest_lap"),
            F.stddev_samp(lap_time).alias("lap_time_std"),
            F.min("grid_position").alias("grid_position"),
            F.min("final_position").alias("final_position"),
        )
        .withColumns(
            {
                "consistency_index": consistency_index(F.col("lap_time_std")),
                "position_change": F.col("grid_position") - F.col("final_position"),
            }
        )
    )


def compound_usage(laps: DataFrame, race: Sequence[str] = RACE) -> DataFrame:
    """Laps on each compound as a percentage of the laps of the race."""
    return share_of_group(laps, race, ["compound"], "compound_usage_pct")


def tire_analytics(laps: DataFrame, keys: Sequence[str] = DRIVER_RACE, race: Sequence[str] = RACE) -> DataFrame:
    """Pace, wear and stint length per driver and compound, with the compound's share."""
    base = laps.groupBy(*keys, "compound").agg(
        F.avg("lap_time_seconds").alias("avg_lap_time"),
        F.avg("tire_degradation_rate").alias("tire_degradation_rate"),
        F.max("stint_length").alias("max_stint_length"),
    )
    return join_back(base, compound_usage(laps, race), [*race, "compound"])


def pit_entries(
    laps: DataFrame, keys: Sequence[str] = DRIVER_RACE, lookahead: int = UNDERCUT_LAPS, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Pit-entry laps with the position one lap before, ``lookahead`` laps after, and the gain.

    Where the race ends sooner the final position stands in for the later one.
    """
    needed = laps.select(*keys, "lap_number", "position", "pit_in_time_seconds", "final_position")
    looked = neighbours(
        needed, keys, ["lap_number"],
        {
            "pos_before_stop": lambda w: F.lag("position", 1).over(w),
            "pos_after_stop": lambda w: F.coalesce(F.lead("position", lookahead).over(w), F.col("final_position")),
        },
        back=1, ahead=lookahead, hot_rows=hot_rows,
    )
    before, after = F.col("pos_before_stop"), F.col("pos_after_stop")
    return looked.where(F.col("pit_in_time_seconds").isNotNull()).withColumns(
        {
            "undercut_success_flag": F.when(after < before, 1).otherwise(0),
            "position_gain": before - after,
        }
    )


def pitstop_analytics(
    laps: DataFrame, keys: Sequence[str] = DRIVER_RACE, lookahead: int = UNDERCUT_LAPS, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Stops, timing, undercut rate and net places per driver; drivers without a stop do not appear."""
    summary = pit_entries(laps, keys, lookahead, hot_rows).groupBy(*keys).agg(
        F.count("lap_number").alias("pit_count"),
        F.avg("lap_number").alias("avg_pit_window"),
        F.avg("undercut_success_flag").alias("undercut_success_rate"),
        F.avg("position_gain").cast("double").alias("pit_stop_efficiency_score"),
    )
    return summary.withColumn("strategy_type", strategy_type(F.col("pit_count"))).fillna(
        0.0, ["pit_stop_efficiency_score", "undercut_success_rate"]
    )


def positions_gained(laps: DataFrame, keys: Sequence[str] = DRIVER_RACE, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Places won on track per driver: laps after the first, off the pit lane, that end further ahead."""
    needed = laps.select(*keys, "lap_number", "position", "pit_in_time_seconds", "pit_out_time_seconds")
    looked = neighbours(
        needed, keys, ["lap_number"], {"prev_position": lambda w: F.lag("position", 1).over(w)},
        back=1, ahead=0, hot_rows=hot_rows,
    )
    gain = F.col("prev_position") - F.col("position")
    counted = looked.where(all_known(keys) & (F.col("lap_number") > 1) & (gain > 0) & is_pit_free())
    return counted.groupBy(*keys).agg(F.sum(gain).alias("driver_positions_gained"))


def race_benchmarks(laps: DataFrame, race: Sequence[str] = RACE) -> DataFrame:
    """Fastest sectors and mean pace per race."""
    fastest = [F.min(f"sector{i}_time_seconds").alias(f"fastest_sector{i}_time") for i in (1, 2, 3)]
    return laps.groupBy(*race).agg(*fastest, F.avg("lap_time_seconds").alias("avg_race_pace"))


def clean_pace(laps: DataFrame, keys: Sequence[str] = DRIVER_RACE) -> DataFrame:
    """Mean lap time per driver over laps off the pit lane."""
    return laps.where(is_pit_free()).groupBy(*keys).agg(F.avg("lap_time_seconds").alias("driver_avg_clean_lap_time"))


def race_analytics(
    laps: DataFrame, keys: Sequence[str] = DRIVER_RACE, race: Sequence[str] = RACE, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Clean-pace rank and places gained per driver, beside the benchmarks of the race.

    One scan and one exchange of the laps: the window that looks one lap back deals them by driver, and the driver's sums, counts and
    minima need no other. Race figures and ranks come from one row a driver. Where a driver's laps are too many for a window the
    sums combine map-side on top of the chunks.
    """
    needed = laps.select(
        *keys, "lap_number", "position", "pit_in_time_seconds", "pit_out_time_seconds", "lap_time_seconds",
        *[f"sector{i}_time_seconds" for i in (1, 2, 3)],
    )
    looked = neighbours(
        needed, keys, ["lap_number"], {"prev_position": lambda w: F.lag("position", 1).over(w)}, back=1, ahead=0, hot_rows=hot_rows, sizes_from=laps.select(*keys)
    )
    gain, lap_time, free = F.col("prev_position") - F.col("position"), F.col("lap_time_seconds"), is_pit_free()
    counted = all_known(keys) & (F.col("lap_number") > 1) & (gain > 0) & free
    per_driver = looked.groupBy(*keys).agg(
        F.count_if(free).alias("__free"), F.avg(F.when(free, lap_time)).alias("driver_avg_clean_lap_time"),
        F.sum(F.when(counted, gain)).alias("driver_positions_gained"),
        F.sum(lap_time).alias("__sum"), F.count(lap_time).alias("__n"),
        *[F.min(f"sector{i}_time_seconds").alias(f"__best{i}") for i in (1, 2, 3)],
    )
    # One row a driver and race from here on; those of a race meet in a window.
    field = Window.partitionBy(*race)
    clean = F.col("__free") > 0
    by_pace = field.orderBy(F.desc(clean), F.asc_nulls_first("driver_avg_clean_lap_time"))
    whole = per_driver.withColumns(
        {
            "race_pace_ranking": F.rank().over(by_pace),
            **{f"fastest_sector{i}_time": F.min(f"__best{i}").over(field) for i in (1, 2, 3)},
            "avg_race_pace": F.try_divide(F.sum("__sum").over(field), F.sum("__n").over(field)),
            "estimated_positions_gained": F.sum("driver_positions_gained").over(field),
        }
    )
    # A driver without a clean lap does not appear; one whose clean laps have no time does.
    columns = [
        *keys, "driver_avg_clean_lap_time", "race_pace_ranking", "driver_positions_gained",
        *[f"fastest_sector{i}_time" for i in (1, 2, 3)], "avg_race_pace", "estimated_positions_gained",
    ]
    return whole.where(clean).select(columns).fillna(0)

"""The six standing reports over the gold tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.hot import HOT_ROWS
from ..operators.ordered import rank_within


def consistency_rank(drivers: DataFrame, top: int | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Drivers of each race by consistency index, all of them unless ``top`` is given."""
    ranked = rank_within(
        drivers.select("race_name", "driver", "lap_time_std", "consistency_index"),
        ["race_name"], "consistency_index", "consistency_rank", descending=True, dense=True, hot_rows=hot_rows,
    )
    if top is not None:
        ranked = ranked.where(F.col("consistency_rank") <= top)
    return ranked.orderBy("race_name", "consistency_rank")


def places_gained(drivers: DataFrame) -> DataFrame:
    """Drivers who finished ahead of their grid place, largest gain first per race."""
    columns = ["race_name", "driver", "grid_position", "final_position", "position_change"]
    gainers = drivers.select(*columns).where(F.col("position_change") > 0)
    return gainers.orderBy("race_name", F.desc("position_change"))


def compound_performance(tires: DataFrame) -> DataFrame:
    """Pace, wear, longest stint and usage per compound over all races."""
    def mean(column: str, places: int):
        return F.round(F.avg(column), places)

    return (
        tires.groupBy("compound")
        .agg(
            mean("avg_lap_time", 3).alias("global_avg_lap_time_seconds"),
            mean("tire_degradation_rate", 4).alias("avg_degradation_rate_seconds_per_lap"),
            F.max("max_stint_length").alias("max_observed_stint_laps"),
            mean("compound_usage_pct", 2).alias("avg_compound_usage_pct"),
        )
        .orderBy("global_avg_lap_time_seconds")
    )


def pit_efficiency(pits: DataFrame) -> DataFrame:
    """Strategy and undercut success per driver, best net gain first per race."""
    return pits.select(
        "race_name", "driver", "pit_count", "avg_pit_window", "strategy_type",
        F.round(F.col("undercut_success_rate") * 100.0, 1).alias("undercut_success_percentage"),
        "pit_stop_efficiency_score",
    ).orderBy("race_name", F.desc("pit_stop_efficiency_score"))


def pace_vs_result(races: DataFrame, drivers: DataFrame, keys: Sequence[str] = ("race_name", "driver")) -> DataFrame:
    """Pace rank beside the final position.

    The default keys leave the season out, so a driver seen in two seasons of
    one race pairs each with each; add ``season`` to the keys to avoid that.
    """
    ranks = races.select(*keys, "race_pace_ranking", "driver_avg_clean_lap_time")
    finals = drivers.select(*keys, "final_position")
    delta = F.col("final_position") - F.col("race_pace_ranking")
    joined = ranks.join(finals, list(keys)).withColumn("pace_to_result_delta", delta)
    return joined.orderBy("race_name", "final_position")


def sector_benchmarks(races: DataFrame, per_driver_sum: bool = True) -> DataFrame:
    """Best theoretical lap, mean pace and overtakes per race name.

    The race total of gains repeats on every driver row. Summing it, as the
    standing report does, counts it once per driver; ``per_driver_sum=False``
    takes it once per season instead.
    """
    best = [F.col(f"fastest_sector{i}_time") for i in (1, 2, 3)]
    measures = [F.round(F.min(b), 3).alias(f"theoretical_fastest_s{i}") for i, b in enumerate(best, start=1)]
    measures.append(F.round(F.min(best[0] + best[1] + best[2]), 3).alias("theoretical_lap_record"))
    measures.append(F.round(F.avg("avg_race_pace"), 3).alias("overall_average_race_pace"))
    gains = "estimated_positions_gained"
    if per_driver_sum:
        report = races.groupBy("race_name").agg(*measures, F.sum(gains).alias("total_on_track_overtakes"))
    else:
        once = races.groupBy("race_name", "season").agg(F.max(gains).alias(gains))
        totals = once.groupBy("race_name").agg(F.sum(gains).alias("total_on_track_overtakes"))
        report = races.groupBy("race_name").agg(*measures).join(totals, "race_name", "left")
    return report.orderBy("race_name")

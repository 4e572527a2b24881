"""Tables behind the analysis pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.names import race_label
from ..functions.scalars import heuristic_lap_time
from ..operators.features import trendlines
from ..operators.hot import join_back

RACE = ("season", "race_name")


def one_race(df: DataFrame, season: int, race_name: str) -> DataFrame:
    """Rows of one race; on tables partitioned by race this reads one partition."""
    return df.where((F.col("season") == season) & (F.col("race_name") == race_name))


def for_drivers(df: DataFrame, drivers: Sequence[str] | None) -> DataFrame:
    return df if drivers is None else df.where(F.col("driver").isin(list(drivers)))


def distinct_races(laps: DataFrame) -> DataFrame:
    """Every race with its label, in calendar order."""
    races = laps.select(*RACE).distinct()
    return races.withColumn("race_display", race_label(F.col("season"), F.col("race_name"))).orderBy(*RACE)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)


def race_overview(laps: DataFrame, drivers: DataFrame, races: DataFrame) -> DataFrame:
    """Winner and team, fastest lap, laps run and places gained, for all races at once."""
    length = laps.groupBy(*RACE).agg(F.max("lap_number").cast("int").alias("total_laps"))
    timed = F.col("fastest_lap").isNotNull()
    best = drivers.groupBy(*RACE).agg(
        F.min(F.when(F.col("final_position") == 1, F.col("driver"))).alias("winner"),
        F.min(F.when(timed, F.struct("fastest_lap", "driver"))).alias("__best"),
    )
    teams = laps.groupBy(*RACE, F.col("driver").alias("winner")).agg(F.min("team").alias("winner_team"))
    gains = races.groupBy(*RACE).agg(F.max("estimated_positions_gained").cast("int").alias("total_gains"))
    joined = join_back(join_back(length, best, RACE), teams, [*RACE, "winner"])
    return join_back(joined, gains, RACE).select(
        *RACE, "winner", "winner_team",
        F.col("__best.driver").alias("fastest_driver"), F.col("__best.fastest_lap").alias("fastest_lap"),
        "total_laps", F.coalesce("total_gains", F.lit(0)).alias("total_gains"),
    )


def position_series(laps: DataFrame) -> DataFrame:
    """Position over laps, in drawing order."""
    return laps.select(*RACE, "driver", "team", "lap_number", "position").orderBy(*RACE, "driver", "lap_number")


def pace_series(laps: DataFrame, drivers: Sequence[str] | None = None) -> DataFrame:
    """Lap times of the chosen drivers over laps, per race label."""
    return (
        for_drivers(laps, drivers)
        .select(race_label(F.col("season"), F.col("race_name")).alias("race_display"), "driver", "lap_number", "lap_time_seconds")
        .orderBy("driver", "lap_number", "race_display")
    )


def driver_comparison(drivers: DataFrame, chosen: Sequence[str] | None = None) -> DataFrame:
    """Consistency and places gained of the chosen drivers, per race label."""
    return for_drivers(drivers, chosen).select(
        race_label(F.col("season"), F.col("race_name")).alias("race_display"),
        "driver", "consistency_index", "position_change",
    )


def wear_trendlines(laps: DataFrame, compound: str | None = None) -> DataFrame:
    """Lap time against tyre age: one line per driver and compound of each race."""
    chosen = laps if compound is None else laps.where(F.col("compound") == compound)
    return trendlines(chosen, [*RACE, "compound", "driver"])


def usage_per_race(tires: DataFrame) -> DataFrame:
    """The usage share once per compound and race."""
    return tires.select(*RACE, "compound", "compound_usage_pct").distinct()


def stint_page(tires: DataFrame) -> DataFrame:
    """Longest stint and mean wear by driver and compound."""
    return tires.select(*RACE, "driver", "compound", "max_stint_length", "tire_degradation_rate")


def pit_timing(laps: DataFrame) -> DataFrame:
    """Pit-entry laps with the compound coming off."""
    entries = laps.where(F.col("pit_in_time_seconds").isNotNull())
    return entries.select(*RACE, "driver", "lap_number", "compound")


def strategy_distribution(pits: DataFrame) -> DataFrame:
    return pits.groupBy(*RACE, "strategy_type").agg(F.count(F.lit(1)).alias("driver_count"))


def pit_efficiency_order(pits: DataFrame) -> DataFrame:
    """Drivers of each race, best net gain first."""
    return pits.select(*RACE, "driver", "pit_stop_efficiency_score", "undercut_success_rate").orderBy(
        *RACE, F.desc("pit_stop_efficiency_score"), "driver"
    )


def undercut_mean(pits: DataFrame) -> DataFrame:
    """Mean undercut success of a race's drivers, in percent."""
    return pits.groupBy(*RACE).agg((F.avg("undercut_success_rate") * 100.0).alias("avg_undercut_pct"))


def heuristic_predictions(laps: DataFrame) -> DataFrame:
    """Baseline prediction for every lap."""
    predicted = heuristic_lap_time(
        F.col("tyre_life"), F.col("compound"), F.col("lap_number"), F.col("track_temp"), F.col("rainfall")
    )
    return laps.select(*RACE, "driver", "lap_number", predicted.alias("predicted_lap_time"))

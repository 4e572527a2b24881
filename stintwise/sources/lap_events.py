"""Lap table and its side tables derived from an event log.

Each event becomes one lap of the driver ``user_id % 20``; days decide season
and race. A driver-race grows with the log, so everything along lap order goes
through ``running`` instead of a plain window.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import epoch_micros
from ..operators.hot import all_known, join_back
from ..operators.ordered import running

DRIVER_RACE = ["season", "race_name", "driver"]
COMPOUNDS = ["SOFT", "MEDIUM", "HARD"]


def _races(events: DataFrame) -> DataFrame:
    day = F.dayofmonth(F.to_date("ts"))
    dn = (F.col("user_id") % 20).cast("int")
    return events.withColumns(
        {
            "season": F.when(day <= 15, 2023).otherwise(2024),
            "race_name": F.concat(F.lit("R"), ((day - 1) % 5).cast("string")),
            "dn": dn,
            "driver": F.concat(F.lit("D"), dn.cast("string")),
        }
    )


def laps_from_events(events: DataFrame, stage: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """The lap table.

    Two later steps read the numbered laps; ``stage`` may write them and
    return the written table, so that numbering runs once.
    """
    error = F.col("event_type") == "error"
    ident = F.col("event_id")
    base = _races(events).select(
        "season", "race_name", "dn", "driver", "event_id", "ts",
        (F.lit(6000) + F.round(F.col("value") * 100).cast("long")).alias("cents"),
        F.when(error & (ident % 4 == 0), F.col("value")).alias("pit_in_time_seconds"),
        F.when(~(error & (ident % 7 == 0)), F.col("value") + 60).alias("lap_time_seconds"),
        (F.regexp_extract("props", "[0-9]+", 0).cast("int") % 10 + 20).cast("double").alias("air_temp"),
        (ident % 13 + 30).cast("double").alias("track_temp"),
        (F.col("event_type") == "signup").alias("rainfall"),
    )
    pit = F.col("pit_in_time_seconds")
    laps = running(
        base, DRIVER_RACE, ["ts", "event_id"],
        position="lap_number",
        totals={"cum_cents": F.col("cents"), "entries": pit.isNotNull().cast("int")},
        previous={"pit_out_time_seconds": pit},
    )
    laps = laps.withColumns(
        {
            "lap_number": F.col("lap_number").cast("double"),
            "stint": (1 + F.col("entries") - pit.isNotNull().cast("int")).cast("int"),
        }
    )
    # A stint starts on the lap after a pit entry; the laps are dealt and in order for that already.
    opened = F.when(F.col("pit_out_time_seconds").isNotNull(), F.col("lap_number"))
    laps = running(laps, DRIVER_RACE, ["lap_number"], latest={"stint_start": opened}, sizes_from=base)
    start = F.when(all_known(DRIVER_RACE), F.coalesce("stint_start", F.lit(1.0)))
    laps = stage(laps.withColumn("stint_start", start))
    # One row per driver and lap, so at most 20 rows per group.
    field = Window.partitionBy("season", "race_name", "lap_number").orderBy("cum_cents", "driver")
    laps = laps.withColumn("position", F.row_number().over(field).cast("double"))
    ends = laps.groupBy(*DRIVER_RACE).agg(
        F.min_by("position", "lap_number").alias("grid_position"),
        F.max_by("position", "lap_number").alias("final_position"),
    )
    laps = join_back(laps, ends, DRIVER_RACE, sizes_from=base)
    lap_time, picked = F.col("lap_time_seconds"), (F.col("stint") + F.col("dn")) % 3
    return laps.select(
        "season", "race_name", "driver", "lap_number", "event_id", "ts", "cum_cents",
        F.col("dn").cast("string").alias("driver_number"),
        F.concat(F.lit("T"), (F.col("dn") % 10).cast("string")).alias("team"),
        "position", "grid_position", "final_position", "stint",
        (F.col("lap_number") - F.col("stint_start") + 1).alias("tyre_life"),
        F.element_at(F.array(*map(F.lit, COMPOUNDS)), picked + 1).alias("compound"),
        "lap_time_seconds",
        (lap_time * (F.lit(0.30) + F.lit(0.001) * (ident % 7))).alias("sector1_time_seconds"),
        (lap_time * (F.lit(0.33) + F.lit(0.001) * (ident % 5))).alias("sector2_time_seconds"),
        (lap_time * (F.lit(0.35) + F.lit(0.001) * (ident % 3))).alias("sector3_time_seconds"),
        "pit_in_time_seconds", "pit_out_time_seconds", "air_temp", "track_temp", "rainfall",
    )


def weather_from_events(events: DataFrame) -> DataFrame:
    """One weather sample per (season, race_name, ts) from the ``view`` events."""
    views = _races(events.where(F.col("event_type") == "view"))
    return views.groupBy("season", "race_name", "ts").agg(F.max("event_id").cast("double").alias("sample"))


def schedule_from_events(events: DataFrame) -> DataFrame:
    """Season calendar; the race numbered 0 plays the test event."""
    number = F.substring("race_name", 2, 10).cast("int")
    return _races(events).select("season", number.alias("RoundNumber"), F.col("race_name").alias("EventName")).distinct()


def results_from_laps(laps: DataFrame, blank_race: str = "R1") -> DataFrame:
    """Session results per driver; one race comes without positions."""
    known = F.col("race_name") != blank_race
    return (
        laps.groupBy("season", "race_name", "driver_number")
        .agg(F.max("grid_position").alias("grid"), F.max("final_position").alias("final"), F.max("lap_number").alias("done"))
        .select(
            "season", "race_name",
            F.col("driver_number").alias("DriverNumber"),
            F.when(known, F.col("grid")).alias("GridPosition"),
            F.when(known, F.col("final")).alias("Position"),
            F.when(F.col("done") >= 40, "Finished").otherwise("Retired").alias("Status"),
        )
    )


def overrides_from_laps(laps: DataFrame) -> DataFrame:
    """Corrected positions for every third driver number."""
    number = F.col("driver_number").cast("int")
    return laps.select("race_name", "driver_number").distinct().where(number % 3 == 0).select(
        "race_name", "driver_number",
        (number + 1).cast("double").alias("grid_position"),
        (20 - number).cast("double").alias("final_position"),
    )


def raw_from_laps(laps: DataFrame) -> DataFrame:
    """The same laps as an ingest would leave them: PascalCase names, durations
    and start times in nanoseconds, NaN for missing numbers, gaps in labels."""
    ident = F.col("event_id")

    def nanos(name: str) -> Column:
        return (F.round(F.col(name) * 1000).cast("long") * 1_000_000)

    hole = F.lit(float("nan"))
    return laps.select(
        "season", "race_name",
        F.when(ident % 29 != 0, F.col("driver")).alias("Driver"),
        F.col("driver_number").alias("DriverNumber"),
        F.col("team").alias("Team"),
        F.col("lap_number").alias("LapNumber"),
        F.col("stint").cast("double").alias("Stint"),
        nanos("lap_time_seconds").alias("LapTime"),
        nanos("sector1_time_seconds").alias("Sector1Time"),
        nanos("sector2_time_seconds").alias("Sector2Time"),
        nanos("sector3_time_seconds").alias("Sector3Time"),
        nanos("pit_in_time_seconds").alias("PitInTime"),
        nanos("pit_out_time_seconds").alias("PitOutTime"),
        (epoch_micros(F.col("ts")) * 1000 + ident % 1000).alias("LapStartDate"),
        F.when(ident % 23 != 0, F.col("compound")).alias("Compound"),
        F.when(ident % 17 == 0, hole).otherwise(F.col("tyre_life")).alias("TyreLife"),
        F.when(ident % 19 == 0, hole).otherwise(F.col("position")).alias("Position"),
        F.when(ident % 11 == 0, hole).otherwise(F.col("air_temp")).alias("AirTemp"),
        F.col("track_temp").alias("TrackTemp"),
        F.lit(None).cast("double").alias("Humidity"),
        F.col("rainfall").alias("Rainfall"),
        F.when(ident % 13 == 0, "TRACK LIMITS").alias("DeletedReason"),
        F.when(ident % 5 == 0, hole).otherwise(F.col("grid_position")).alias("grid_position"),
        F.when(ident % 5 == 1, hole).otherwise(F.col("final_position")).alias("final_position"),
    )

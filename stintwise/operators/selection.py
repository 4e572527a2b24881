"""Choosing races from a season calendar and keeping only their laps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

DEFAULT_FIRST = 5
# The races used when nothing is chosen.
DEFAULT_RACES = [
    (2023, "Bahrain", "R"),
    (2023, "Monaco", "R"),
    (2023, "Monza", "R"),
    (2023, "Silverstone", "R"),
    (2023, "Spa", "R"),
]
SELECTION_COLUMNS = ["season", "race_name", "session_type"]
SELECTION_SCHEMA = "season int, race_name string, session_type string"


def selection(spark: SparkSession, races: Sequence[tuple[int, str, str]] | None = None) -> DataFrame:
    """An explicit list of (season, race, session type), or the default list."""
    return spark.createDataFrame(list(DEFAULT_RACES if races is None else races), SELECTION_SCHEMA)


def save_selection(races: DataFrame, path: str) -> None:
    """Keep a selection for later sessions."""
    races.select(*SELECTION_COLUMNS).write.mode("overwrite").parquet(path)


def saved_selection(spark: SparkSession, path: str) -> DataFrame:
    """A kept selection; without one the default list."""
    try:
        return spark.read.schema(SELECTION_SCHEMA).parquet(path)
    except AnalysisException:
        return selection(spark)


def races_only(schedule: DataFrame, season: int | None = None) -> DataFrame:
    """Calendar of one season, or of all, without test events, which are numbered 0."""
    races = schedule.where(F.col("RoundNumber") > 0)
    return races if season is None else races.where(F.col("season") == season)


def _as_selection(schedule: DataFrame) -> DataFrame:
    return schedule.select("season", F.col("EventName").alias("race_name"), F.lit("R").alias("session_type"))


def first_races(schedule: DataFrame, n: int = DEFAULT_FIRST, season: int | None = None) -> DataFrame:
    """The first ``n`` races of each season in calendar order.

    The rank filter prunes map-side (window group limit), so ``n`` rows per
    season and task are all that is shuffled.
    """
    by_round = Window.partitionBy("season").orderBy("RoundNumber", "EventName")
    ranked = races_only(schedule, season).withColumn("__nth", F.row_number().over(by_round))
    return _as_selection(ranked.where(F.col("__nth") <= n))


def named_races(schedule: DataFrame, names: Sequence[str], season: int | None = None) -> DataFrame:
    return _as_selection(races_only(schedule, season).where(F.col("EventName").isin(list(names))))


def whole_season(schedule: DataFrame, season: int | None = None) -> DataFrame:
    return _as_selection(races_only(schedule, season))


def keep_selected(df: DataFrame, chosen: DataFrame, keys: Sequence[str] = ("season", "race_name")) -> DataFrame:
    """Rows whose race is in the selection.

    Where the table is laid out by race, only the chosen races' files are read, whatever the selection comes from: a race
    has a name, and with that condition on the chosen side the keys prune partitions while the query runs.
    """
    named = chosen.select(*keys).where(F.length(F.col(keys[-1])) > 0)
    return df.join(named, list(keys), "left_semi")

"""Putting raw tables together: unions, weather, session results."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .hot import HOT_ROWS, all_known, join_back
from .ordered import running

RACE = ("season", "race_name")


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL matched by column name; columns missing on one side are null there."""
    if not frames:
        raise ValueError("no tables to combine")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def asof_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_time: str,
    right_time: str,
    values: Sequence[str],
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Each left row with the latest right row of its group at or before its time.

    A right row at exactly the left time counts; of several right rows at one
    time the largest by ``values`` does. Left rows with no earlier right row,
    or with a null key or time, get nulls.

    Both sides go through one exchange as one sequence, right rows before left rows of the same time, and each left row
    takes the last right row before it; nothing is joined back. A hot group is dealt over ranges of time, and one
    row a range carries the last right row on.
    """
    kept = [c for c in left.columns if c not in values]
    asked = left.select(*kept, F.col(left_time).alias("__t"), F.lit(1).alias("__side"))
    samples = right.where(all_known([*keys, right_time])).select(
        *keys, F.col(right_time).alias("__t"), F.lit(0).alias("__side"), F.struct(*values).alias("__sample")
    )
    both = asked.unionByName(samples, allowMissingColumns=True)
    scanned = running(both, keys, ["__t", "__side", "__sample"], latest={"__found": F.col("__sample")}, hot_rows=hot_rows)
    return scanned.where(F.col("__side") == 1).select(*kept, *[F.col(f"__found.{v}").alias(v) for v in values])


def complete_positions(
    results: DataFrame,
    laps: DataFrame,
    race_keys: Sequence[str] = RACE,
    driver: str = "driver_number",
    lap: str = "lap_number",
    position: str = "position",
) -> DataFrame:
    """Fill positions from the laps for races whose results carry none at all.

    Final position: the last known position of the driver. Grid: the position
    on lap 1, else the final position. A race with at least one known value in
    a column keeps that column as it is.
    """
    known = F.col(position).isNotNull()
    from_laps = laps.groupBy(*race_keys, driver).agg(
        F.max_by(F.when(known, F.col(position)), F.when(known, F.col(lap))).alias("__last"),
        F.max(F.when(F.col(lap) == 1, F.col(position))).alias("__first"),
    )
    coverage = results.groupBy(*race_keys).agg(
        F.count("grid_position").alias("__grids"), F.count("final_position").alias("__finals")
    )
    joined = join_back(join_back(results, from_laps, [*race_keys, driver]), coverage, race_keys)
    final = F.when(F.col("__finals") == 0, F.col("__last")).otherwise(F.col("final_position"))
    grid = F.when(F.col("__grids") == 0, F.coalesce(F.col("__first"), final)).otherwise(F.col("grid_position"))
    return joined.withColumns({"grid_position": grid, "final_position": final}).drop("__last", "__first", "__grids", "__finals")


def rename_results(results: DataFrame, keys: Sequence[str] = RACE) -> DataFrame:
    """The four used columns of a results table under their lap-table names."""
    return results.select(
        *keys,
        F.col("DriverNumber").alias("driver_number"),
        F.col("GridPosition").alias("grid_position"),
        F.col("Position").alias("final_position"),
        F.col("Status").alias("status"),
    )


def assemble_laps(
    laps: DataFrame,
    weather: DataFrame,
    results: DataFrame,
    weather_values: Sequence[str],
    time: str = "ts",
    session_type: str = "R",
    race_keys: Sequence[str] = RACE,
) -> DataFrame:
    """Laps with the weather of their moment, their driver's result and the session type."""
    samples = weather.withColumnRenamed(time, "__sampled")
    with_weather = asof_join(laps, samples, race_keys, time, "__sampled", weather_values)
    complete = complete_positions(rename_results(results, race_keys), laps, race_keys)
    joined = join_back(with_weather, complete, [*race_keys, "driver_number"])
    return joined.withColumn("session_type", F.lit(session_type))

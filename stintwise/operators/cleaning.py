"""Cleaning of raw lap tables: types, position overrides, missing values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import interval_to_seconds, nanos_to_seconds, nanos_to_timestamp
from .hot import few_groups
from .median import exact_medians

# Columns filled with their median, columns filled with a label.
MEDIAN_COLUMNS = [
    "lap_time_seconds", "sector1_time_seconds", "sector2_time_seconds", "sector3_time_seconds",
    "speed_i1", "speed_i2", "speed_fl", "speed_st", "tyre_life", "position",
    "air_temp", "track_temp", "humidity", "pressure", "wind_speed", "wind_direction",
    "grid_position", "final_position",
]
LABEL_FILLS = {
    "compound": "Unknown",
    "team": "Unknown",
    "driver": "Unknown",
    "track_status": "Unknown",
    "status": "Unknown",
    "deleted_reason": "Not Deleted",
}

# Integer columns with these names hold nanoseconds.
DURATION_COLUMNS = (
    "time", "lap_time", "lap_start_time", "pit_in_time", "pit_out_time",
    "sector1_time", "sector2_time", "sector3_time",
    "sector1_session_time", "sector2_session_time", "sector3_session_time",
)
TIMESTAMP_COLUMNS = ("lap_start_date",)

def durations_to_seconds(df: DataFrame, nano_columns: Sequence[str] = DURATION_COLUMNS) -> DataFrame:
    """Replace durations by ``<name>_seconds``: intervals by type, nanoseconds by name."""
    added, gone = {}, []
    for field in df.schema:
        name = field.name
        if isinstance(field.dataType, T.DayTimeIntervalType):
            seconds = interval_to_seconds(F.col(name))
        elif isinstance(field.dataType, T.LongType) and name in nano_columns:
            seconds = nanos_to_seconds(F.col(name))
        else:
            continue
        target = name if name.endswith("_seconds") else f"{name}_seconds"
        added[target] = seconds
        if target != name:
            gone.append(name)
    return df.withColumns(added).drop(*gone) if added else df


def timestamps_to_micros(df: DataFrame, nano_columns: Sequence[str] = TIMESTAMP_COLUMNS) -> DataFrame:
    """Turn epoch-nanosecond integers into timestamps of microsecond precision."""
    longs = {f.name for f in df.schema if isinstance(f.dataType, T.LongType)}
    found = [c for c in nano_columns if c in longs]
    return df.withColumns({c: nanos_to_timestamp(F.col(c)) for c in found}) if found else df


def override_positions(
    df: DataFrame,
    overrides: DataFrame,
    keys: Sequence[str] = ("race_name", "driver_number"),
    columns: Sequence[str] = ("grid_position", "final_position"),
) -> DataFrame:
    """Values from the override table win; rows it does not know keep their own.

    Keys compare as strings. A key with several override rows takes the largest,
    so no lap is repeated. Overrides are counted first: few are broadcast and the
    laps stay where they are, however often the result is read.
    """
    values = F.struct(*[F.col(c).cast("double").alias(f"__o_{c}") for c in columns])
    side = overrides.groupBy(*[F.col(k).cast("string").alias(f"__k_{k}") for k in keys]).agg(F.max(values).alias("__v")).select(
        *[f"__k_{k}" for k in keys], "__v.*"
    )
    if few_groups(overrides, keys):
        side = F.broadcast(side)
    on = [F.col(k).cast("string") == F.col(f"__k_{k}") for k in keys]
    present = [c for c in columns if c in df.columns]
    joined = df.join(side, on, "left")
    merged = {c: F.coalesce(f"__o_{c}", F.col(c).cast("double")) for c in present}
    merged.update({c: F.col(f"__o_{c}") for c in columns if c not in present})
    return joined.withColumns(merged).drop(*[f"__k_{k}" for k in keys], *[f"__o_{c}" for c in columns])


def fill_medians(df: DataFrame, columns: Sequence[str] = MEDIAN_COLUMNS) -> DataFrame:
    """Nulls become the median of their column over the whole table, or 0.0 if it has none."""
    present = [c for c in columns if c in df.columns]
    if not present:
        return df
    # One entry per listed column, read as a scalar subquery.
    entries = F.collect_list(F.struct("column", "median"))
    lookup = exact_medians(df, present).agg(F.map_from_entries(entries)).scalar()
    held = df.withColumn("__medians", lookup)
    filled = {c: F.coalesce(F.col(c).cast("double"), F.col("__medians")[c], F.lit(0.0)) for c in present}
    return held.withColumns(filled).drop("__medians")


def fill_labels(df: DataFrame, fills: Mapping[str, str] = LABEL_FILLS) -> DataFrame:
    present = {c: v for c, v in fills.items() if c in df.columns}
    return df.fillna(present) if present else df

"""From raw laps to engineered laps, as one lazy plan."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

from ..functions.names import snake_columns
from ..operators.cleaning import (
    durations_to_seconds,
    fill_labels,
    fill_medians,
    override_positions,
    timestamps_to_micros,
)
from ..operators.features import position_change, stint_features
from ..operators.transform import RACE_KEYS, performance_score, rolling_pace, sector_deltas


def clean_laps(raw: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
    """Names, durations, timestamps, recorded positions, then missing values."""
    typed = timestamps_to_micros(durations_to_seconds(snake_columns(raw)))
    placed = override_positions(typed, overrides) if overrides is not None else typed
    return fill_labels(fill_medians(placed))


def transform_laps(
    laps: DataFrame, race_keys: Sequence[str] = RACE_KEYS, order: Sequence[str] = ("lap_number", "season"), **options
) -> DataFrame:
    """Sector deltas, rolling pace and circuit score.

    ``race_keys`` decide whether two seasons of one race mix; the default
    leaves the season out and only breaks ties of lap order by it.
    """
    paced = rolling_pace(sector_deltas(laps, race_keys), race_keys, order, sizes_from=laps, **options)
    return performance_score(paced, race_keys, measured_on=laps)


def engineer_laps(
    laps: DataFrame, race_keys: Sequence[str] = RACE_KEYS, measured_on: DataFrame | None = None
) -> DataFrame:
    """Position change, stint length and wear rate on every lap."""
    return stint_features(position_change(laps), [*race_keys, "driver", "stint"], measured_on)


def silver_laps(
    raw: DataFrame,
    overrides: DataFrame | None = None,
    race_keys: Sequence[str] = RACE_KEYS,
    stage: Callable[[DataFrame], DataFrame] = lambda df: df,
    **options,
) -> DataFrame:
    """Raw to engineered laps.

    The measures all read the cleaned laps, so ``stage`` may write those and
    return the written table.
    """
    cleaned = stage(clean_laps(raw, overrides))
    return engineer_laps(transform_laps(cleaned, race_keys, **options), race_keys, measured_on=cleaned)

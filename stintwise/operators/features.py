"""Engineered lap features: position change, stint length, tyre wear rate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.linear import first_of_three
from .hot import all_known, join_back

STINT_KEYS = ("race_name", "driver", "stint")
WEAR_INPUTS = ("tyre_life", "air_temp", "track_temp")
MIN_FIT_LAPS = 4


def position_change(df: DataFrame, grid: str = "grid_position", final: str = "final_position") -> DataFrame:
    return df.withColumn("position_change", F.col(grid) - F.col(final))


def _wear_rate(inputs: Sequence[str], target: str) -> Column:
    """Wear slope per group as an aggregate, from sums that combine map-side.

    Missing inputs and targets count as 0 in the fit. Groups with fewer than
    four rows or a single known tyre age have rate 0.
    """
    x = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in inputs]
    y = F.coalesce(F.col(target).cast("double"), F.lit(0.0))
    cov = {f"{i + 1}{j + 1}": F.covar_pop(x[i], x[j]) for i in range(3) for j in range(i, 3)}
    cov.update({f"{i + 1}y": F.covar_pop(x[i], y) for i in range(3)})
    fits = (F.count(F.lit(1)) >= MIN_FIT_LAPS) & (F.min(inputs[0]) < F.max(inputs[0]))
    return F.when(fits, F.coalesce(first_of_three(cov), F.lit(0.0))).otherwise(F.lit(0.0))


def stint_summary(
    df: DataFrame,
    keys: Sequence[str] = STINT_KEYS,
    inputs: Sequence[str] = WEAR_INPUTS,
    target: str = "lap_time_seconds",
) -> DataFrame:
    """One row per stint: ``stint_length`` and ``tire_degradation_rate``."""
    return df.where(all_known(keys)).groupBy(*keys).agg(
        F.max(inputs[0]).alias("stint_length"),
        _wear_rate(inputs, target).alias("tire_degradation_rate"),
    )


def stint_features(
    df: DataFrame, keys: Sequence[str] = STINT_KEYS, measured_on: DataFrame | None = None, **options
) -> DataFrame:
    """Stint length and wear rate on every lap, with one aggregate and one join.

    Where ``df`` is expensive, ``measured_on`` can name an earlier table with
    the same rows.
    """
    source = df if measured_on is None else measured_on
    return join_back(df, stint_summary(source, keys, **options), keys, sizes_from=source)


def trendlines(df: DataFrame, keys: Sequence[str], x: str = "tyre_life", y: str = "lap_time_seconds") -> DataFrame:
    """Straight-line fit of y on x per group; rows missing either are left out."""
    pairs = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    return pairs.groupBy(*keys).agg(
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.regr_r2(y, x).alias("r2"),
        F.count(F.lit(1)).alias("laps"),
    )

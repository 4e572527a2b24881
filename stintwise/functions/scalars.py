"""Scalar column expressions shared by the plans."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NANOS = 1_000_000_000


def nanos_to_seconds(col: Column) -> Column:
    """Duration stored as a count of nanoseconds, in seconds."""
    return col.cast("double") / F.lit(float(NANOS))


def interval_to_seconds(col: Column) -> Column:
    """Day-time interval in seconds."""
    parts = [(86400, "DAY"), (3600, "HOUR"), (60, "MINUTE"), (1, "SECOND")]
    pieces = [F.extract(F.lit(unit), col).cast("double") * factor for factor, unit in parts]
    return pieces[0] + pieces[1] + pieces[2] + pieces[3]


def nanos_to_timestamp(col: Column) -> Column:
    """Epoch nanoseconds as a zone-less timestamp, cut to microseconds."""
    micros = ((col - F.pmod(col, F.lit(1000))) / F.lit(1000)).cast("decimal(20,0)")
    since = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (micros / F.lit(1_000_000)).cast("decimal(18,6)"))
    return F.lit("1970-01-01").cast("timestamp_ntz") + since


def epoch_minutes(ts: Column) -> Column:
    """Minutes since the epoch of a zone-less timestamp, whatever the session zone."""
    return F.unix_date(F.to_date(ts)).cast("long") * 1440 + F.hour(ts) * 60 + F.minute(ts)


def micros_of_minute(ts: Column) -> Column:
    return (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("long")


def epoch_micros(ts: Column) -> Column:
    return epoch_minutes(ts) * 60_000_000 + micros_of_minute(ts)


def consistency_index(std: Column) -> Column:
    """100 / std to two places; 0.0 where there is no spread to speak of."""
    return F.when(std.isNull() | (std == 0), F.lit(0.0)).otherwise(F.round(F.lit(100.0) / std, 2))


def share_pct(part: Column, whole: Column) -> Column:
    return part / whole * F.lit(100.0)


def strategy_type(stops: Column) -> Column:
    """Label for a stop count: exactly three is "3-stop", more is "3+ stops"."""
    return (
        F.when(stops.isin(1, 2, 3), F.concat(stops.cast("string"), F.lit("-stop")))
        .when(stops > 3, F.lit("3+ stops"))
        .otherwise(F.lit("0-stop"))
    )


def is_pit_free(pit_in: str = "pit_in_time_seconds", pit_out: str = "pit_out_time_seconds") -> Column:
    """Lap with neither a pit entry nor a pit exit."""
    return F.col(pit_in).isNull() & F.col(pit_out).isNull()


# Fixed values of the baseline lap-time formula.
BASE_LAP_SECONDS = 85.0
WEAR_SECONDS_PER_LAP = {"SOFT": 0.08, "MEDIUM": 0.05}
WEAR_SECONDS_OTHER = 0.03
FUEL_SECONDS_PER_LAP = -0.01
TRACK_SECONDS_PER_DEGREE = 0.02
TRACK_REFERENCE_DEGREES = 30.0
RAIN_SECONDS = 10.0


def heuristic_lap_time(tyre_life: Column, compound: Column, lap: Column, track_temp: Column, rain: Column) -> Column:
    """Lap time expected without a trained model."""
    wear = F.lit(WEAR_SECONDS_OTHER)
    for name, rate in WEAR_SECONDS_PER_LAP.items():
        wear = F.when(compound == name, F.lit(rate)).otherwise(wear)
    return (
        F.lit(BASE_LAP_SECONDS)
        + tyre_life * wear
        + lap * F.lit(FUEL_SECONDS_PER_LAP)
        + (track_temp - F.lit(TRACK_REFERENCE_DEGREES)) * F.lit(TRACK_SECONDS_PER_DEGREE)
        + F.when(rain, F.lit(RAIN_SECONDS)).otherwise(F.lit(0.0))
    )


def tidy(col: Column, places: int = 6) -> Column:
    """Rounded double for comparing outputs of two engines.

    Means of two-place decimals often end exactly on half a unit of the last
    place, where the last bit decides; the nudge moves them off it. Adding
    zero folds negative zero.
    """
    return F.round(col.cast("double") + F.lit(1e-9), places) + F.lit(0.0)

"""Wear rates, medians and trendlines against numpy."""

import numpy as np
import pandas as pd
import pytest
from conftest import by
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from stintwise.operators import features
from stintwise.operators.median import exact_medians

COLUMNS = ["race_name", "driver", "stint", "tyre_life", "air_temp", "track_temp", "lap_time_seconds"]
SCHEMA = "race_name string, driver string, stint int, tyre_life double, air_temp double, track_temp double, lap_time_seconds double"


def brute_rate(group: pd.DataFrame) -> float:
    if len(group) < 4 or group.tyre_life.nunique() < 2:
        return 0.0
    x = group[["tyre_life", "air_temp", "track_temp"]].fillna(0).to_numpy()
    y = group.lap_time_seconds.fillna(0).to_numpy()
    return float(np.linalg.lstsq(x - x.mean(0), y - y.mean(), rcond=1e-8)[0][0])


def stints() -> pd.DataFrame:
    rng = np.random.default_rng(3)
    out = []
    for stint in range(60):
        n = int(rng.integers(1, 25))
        life = np.arange(1.0, n + 1)
        air, track = rng.normal(25, 2, n), rng.normal(35, 4, n)
        kind = stint % 6
        if kind == 1:
            air[:] = 25.0
        if kind == 2:
            air[:], track[:] = 25.0, 40.0
        if kind == 3:
            track = 2 * air + 1
        if kind == 4:
            air, track = life * 0.5, life * 2.0
        if kind == 5:
            life[:] = 7.0
        time = 90 + 0.1 * life + 0.3 * air + rng.normal(0, 0.5, n)
        frame = pd.DataFrame({"race_name": "R", "driver": f"D{kind}", "stint": stint, "tyre_life": life, "air_temp": air, "track_temp": track, "lap_time_seconds": time})
        frame.loc[frame.index % 9 == 5, "lap_time_seconds"] = np.nan
        frame.loc[frame.index % 11 == 6, "air_temp"] = np.nan
        out.append(frame)
    return pd.concat(out, ignore_index=True)


def to_spark(spark, pdf):
    rows = [tuple(None if isinstance(v, float) and np.isnan(v) else v for v in r) for r in pdf[COLUMNS].itertuples(index=False)]
    return spark.createDataFrame([(r[0], r[1], int(r[2]), *r[3:]) for r in rows], SCHEMA)


def test_wear_rate_equals_least_squares(spark):
    pdf = stints()
    got = by(features.stint_summary(to_spark(spark, pdf)), "stint")
    for stint, group in pdf.groupby("stint"):
        assert got[stint].tire_degradation_rate == pytest.approx(brute_rate(group), abs=1e-6), stint
        assert got[stint].stint_length == group.tyre_life.max()


def test_null_stint_keys_stay_without_features(spark):
    df = spark.createDataFrame([("R", None, 1, 1.0, 1.0, 1.0, 90.0)] * 5, SCHEMA)
    row = features.stint_features(df).first()
    assert row.stint_length is None and row.tire_degradation_rate is None


def test_wear_rate_on_the_lap_table(spark, laps):
    pdf = laps.select(COLUMNS).toPandas()
    got = by(features.stint_summary(laps), "race_name", "driver", "stint")
    for key, group in pdf.groupby(["race_name", "driver", "stint"]):
        assert got[key].tire_degradation_rate == pytest.approx(brute_rate(group), abs=1e-5), key


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.none(), st.integers(-5, 5).map(float), st.floats(-1e6, 1e6)), min_size=1, max_size=60))
def test_medians(spark, values):
    df = spark.createDataFrame([(v, 1.0) for v in values], "a double, b double")
    got = {r["column"]: r["median"] for r in exact_medians(df, ["a", "b"]).collect()}
    known = [v for v in values if v is not None]
    assert got.get("a") == (pytest.approx(float(np.median(known)), rel=1e-12, abs=1e-12) if known else None)
    assert got["b"] == 1.0


def test_median_of_many_rows_with_heavy_ties(spark):
    df = spark.range(300_001).select(F.when(F.col("id") % 3 == 0, 17.0).otherwise(F.col("id") * 7919 % 100_003 / 3.0).alias("x"))
    got = exact_medians(df, ["x"]).first()["median"]
    assert got == float(np.median(df.toPandas().x))


@pytest.mark.parametrize("most_rows", [50, 1_000_000])
def test_medians_by_narrowing_brackets(spark, most_rows):
    """Outliers, ties, constants, nulls and NaN, with brackets that must shrink and with one that need not."""
    rng = np.random.default_rng(1)
    rows = [
        (float(rng.normal()), float(i % 4), 5.0, None if i % 2 else 1e300 * float(rng.random()), float("nan") if i % 3 else 1.0, -1.0 if i < 2500 else 1.0 + i)
        for i in range(5000)
    ]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double, f double").repartition(4)
    got = {r["column"]: r["median"] for r in exact_medians(df, list("abcdef"), most_rows).collect()}
    assert np.isnan(got.pop("e"))
    assert got == {c: float(np.median([r["abcdef".index(c)] for r in rows if r["abcdef".index(c)] is not None])) for c in "abcdf"}


def test_trendline(spark, laps):
    got = by(features.trendlines(laps, ["driver"]), "driver")
    for driver, group in laps.select("driver", "tyre_life", "lap_time_seconds").toPandas().dropna().groupby("driver"):
        if group.tyre_life.nunique() > 1:
            slope, intercept = np.polyfit(group.tyre_life, group.lap_time_seconds, 1)
            assert (got[driver].slope, got[driver].intercept) == pytest.approx((slope, intercept))

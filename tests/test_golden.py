"""Hand-computed results of the gold tables and the cleaning steps."""

import pytest
from conftest import by
from pyspark.sql import functions as F
from stintwise.operators import cleaning, features, selection, transform
from stintwise.plans import gold, silver
from stintwise.sources.readers import nan_to_null

RAW_SCHEMA = (
    "Time interval day to second, Driver string, DriverNumber string, LapTime bigint, LapNumber double, Sector1Time bigint, "
    "Sector2Time bigint, Sector3Time bigint, Compound string, TyreLife double, Team string, Position double, race_name string, "
    "AirTemp double, TrackTemp double, Rainfall boolean, grid_position double, final_position double"
)
S = 1_000_000_000


@pytest.fixture(scope="module")
def raw(spark):
    from datetime import timedelta

    rest = ("MEDIUM", 3.0, "Works")
    nan = float("nan")
    return spark.createDataFrame(
        [
            (timedelta(minutes=70), "ALO", "14", 81 * S, 4.0, 26 * S, 29 * S, 26 * S, *rest, 5.0, "Imola", 19.0, 28.5, False, nan, nan),
            (timedelta(minutes=71, seconds=15), "NOR", "4", 83 * S, 4.0, 27 * S, 29 * S, 27 * S, *rest, 6.0, "Imola", 19.0, 28.5, False, nan, nan),
        ],
        RAW_SCHEMA,
    )


def test_durations_become_seconds(raw):
    cleaned = by(silver.clean_laps(nan_to_null(raw)), "driver")
    assert cleaned["ALO"].lap_time_seconds == 81.0
    assert [cleaned[d].sector1_time_seconds for d in ("ALO", "NOR")] == [26.0, 27.0]
    assert cleaned["ALO"].time_seconds == 4200.0 and cleaned["NOR"].time_seconds == 4275.0
    assert "lap_time" not in cleaned["ALO"].asDict()


def test_override_table_fills_positions_without_repeating_laps(spark, raw):
    places = spark.createDataFrame(
        [("Imola", "14", 7.0, 3.0), ("Imola", "14", 7.0, 2.0), ("Imola", "99", 1.0, 1.0)],
        "race_name string, driver_number string, grid_position double, final_position double",
    )
    cleaned = silver.clean_laps(nan_to_null(raw), places)
    assert cleaned.count() == 2
    alo = by(cleaned, "driver")["ALO"]
    assert (alo.grid_position, alo.final_position) == (7.0, 3.0)


def test_all_missing_numbers_become_zero(raw):
    cleaned = silver.clean_laps(nan_to_null(raw))
    assert {r.grid_position for r in cleaned.collect()} == {0.0}


def test_integer_columns_take_an_interpolated_median(spark):
    df = spark.createDataFrame([(1,), (2,), (None,), (3,), (4,)], "position int")
    assert sorted(r.position for r in cleaning.fill_medians(df).collect()) == [1.0, 2.0, 2.5, 3.0, 4.0]


def test_sector_deltas(spark):
    df = spark.createDataFrame(
        [("Imola", 7.0, 26.25, 41.0, 33.5), ("Imola", 7.0, 28.0, 41.0, 33.0), ("Imola", 8.0, 27.0, 40.0, 30.0), (None, 7.0, 10.0, 10.0, 10.0)],
        "race_name string, lap_number double, sector1_time_seconds double, sector2_time_seconds double, sector3_time_seconds double",
    )
    got = by(transform.sector_deltas(df), "sector1_time_seconds")
    assert (got[26.25].sector1_delta, got[28.0].sector1_delta, got[27.0].sector1_delta) == (0.0, 1.75, 0.0)
    assert (got[26.25].sector3_delta, got[28.0].sector3_delta) == (0.5, 0.0)
    assert got[10.0].sector1_delta is None


def test_performance_score(spark):
    df = spark.createDataFrame(
        [("Bahrain", "VER", 90.0), ("Bahrain", "PER", 110.0), ("Zero", "A", 0.0), ("Gone", "B", None)],
        "race_name string, driver string, lap_time_seconds double",
    )
    got = {d: r.circuit_performance_score for d, r in by(transform.performance_score(df), "driver").items()}
    assert got["VER"] == pytest.approx(111.11, abs=0.005) and got["PER"] == pytest.approx(90.91, abs=0.005)
    assert got["A"] is None and got["B"] is None


DRIVER_SCHEMA = "season double, race_name string, driver string, lap_time_seconds double, grid_position double, final_position double"


def test_driver_analytics(spark):
    rows = [(2022.0, "Imola", "ALO", 81.5, 4.0, 6.0)] * 4 + [
        (2022.0, "Imola", "NOR", 80.0, 9.0, 5.0), (2022.0, "Imola", "NOR", 84.0, 9.0, 5.0), (2022.0, "Imola", "ONE", 88.0, 2.0, 2.0),
    ]
    got = by(gold.driver_analytics(spark.createDataFrame(rows, DRIVER_SCHEMA)), "driver")
    alo, nor, one = got["ALO"], got["NOR"], got["ONE"]
    assert (alo.avg_lap_time_seconds, alo.fastest_lap, alo.consistency_index, alo.position_change) == (81.5, 81.5, 0.0, -2.0)
    assert (nor.avg_lap_time_seconds, nor.fastest_lap, nor.consistency_index, nor.position_change) == (82.0, 80.0, 35.36, 4.0)
    assert one.lap_time_std is None and one.consistency_index == 0.0 and one.position_change == 0.0


def test_tire_analytics(spark):
    stints = {("ALO", "HARD"): [(81.0, 0.25, 9.0)], ("ALO", "MEDIUM"): [(79.0, 0.5, 6.0), (83.0, 0.5, 6.0)], ("NOR", "MEDIUM"): [(80.0, 0.75, 4.0)] * 2}
    df = spark.createDataFrame(
        [(2022.0, "Imola", *who, *lap) for who, laps in stints.items() for lap in laps],
        "season double, race_name string, driver string, compound string, lap_time_seconds double, tire_degradation_rate double, stint_length double",
    )
    got = by(gold.tire_analytics(df), "driver", "compound")
    assert {k: r.compound_usage_pct for k, r in got.items()} == {("ALO", "HARD"): 20.0, ("ALO", "MEDIUM"): 80.0, ("NOR", "MEDIUM"): 80.0}
    assert got["ALO", "MEDIUM"].avg_lap_time == 81.0 and got["ALO", "HARD"].max_stint_length == 9.0


LAP_SCHEMA = (
    "season double, race_name string, driver string, lap_number double, position double, pit_in_time_seconds double, final_position double"
)


def test_pitstop_analytics(spark):
    """Stops on the second of three laps: one place lost by the end, two places gained, and a driver without a stop."""
    places = {"ALO": [2.0, 2.0, 3.0], "NOR": [8.0, 7.0, 6.0], "NIL": [1.0, 1.0, 1.0]}
    final = {"ALO": 3.0, "NOR": 6.0, "NIL": 1.0}
    rows = [
        (2022.0, "Imola", d, float(n), place, 31.0 if n == 2 and d != "NIL" else None, final[d])
        for d, run in places.items() for n, place in enumerate(run, start=1)
    ]
    got = by(gold.pitstop_analytics(spark.createDataFrame(rows, LAP_SCHEMA)), "driver")
    assert set(got) == {"ALO", "NOR"}
    for driver, rate, score in (("ALO", 0.0, -1.0), ("NOR", 1.0, 2.0)):
        r = got[driver]
        assert (r.pit_count, r.avg_pit_window, r.strategy_type) == (1, 2.0, "1-stop")
        assert (r.undercut_success_rate, r.pit_stop_efficiency_score) == (rate, score)


@pytest.mark.parametrize("hot_rows", [5, 1_000_000])
def test_stop_counts_first_lap_and_lookahead(spark, hot_rows):
    """Stops on laps 1..n; a stop on lap 1 has no earlier position; lap 11 answers for lap 1."""
    def driver(name, stops, laps=14):
        return [(2023.0, "R", name, float(i), float(20 - i), 20.0 if i <= stops else None, 3.0) for i in range(1, laps + 1)]

    rows = driver("one", 1) + driver("three", 3) + driver("four", 4)
    rows += [(2023.0, "R", "null", None, 5.0, 20.0, 5.0)]
    got = by(gold.pitstop_analytics(spark.createDataFrame(rows, LAP_SCHEMA), hot_rows=hot_rows), "driver")
    assert {d: r.strategy_type for d, r in got.items()} == {"one": "1-stop", "three": "3-stop", "four": "3+ stops", "null": "0-stop"}
    assert got["one"].undercut_success_rate == 0.0 and got["one"].pit_stop_efficiency_score == 0.0
    # Lap 2 goes from 19 to 8 (lap 12), lap 3 from 18 to 7 (lap 13), lap 4 from 17 to 6 (lap 14).
    assert got["three"].pit_stop_efficiency_score == 11.0 and got["three"].undercut_success_rate == pytest.approx(2 / 3)
    assert got["four"].pit_stop_efficiency_score == 11.0


RACE_SCHEMA = (
    "season int, race_name string, driver string, lap_number double, position double, pit_in_time_seconds double, pit_out_time_seconds double, "
    "lap_time_seconds double, sector1_time_seconds double, sector2_time_seconds double, sector3_time_seconds double"
)


@pytest.mark.parametrize("hot_rows", [2, 1_000_000])
def test_race_analytics(spark, hot_rows):
    def lap(driver, n, pos, time, pit_in=None, pit_out=None, season=2023):
        return (season, "R", driver, float(n), float(pos), pit_in, pit_out, time, 30.0 + n, 31.0, 32.0 - n)

    rows = [
        lap("A", 1, 3, 90.0), lap("A", 2, 2, 91.0), lap("A", 3, 1, 95.0, pit_in=20.0), lap("A", 4, 3, 99.0, pit_out=20.0), lap("A", 5, 1, 92.0),
        lap("B", 1, 1, 91.0), lap("B", 2, 3, None), lap("B", 3, 2, 91.0),
        lap("C", 1, 2, 95.0, pit_in=1.0), lap("D", 1, 4, None),
        lap("A", 1, 9, 80.0, season=2024),
    ]
    got = by(gold.race_analytics(spark.createDataFrame(rows, RACE_SCHEMA), hot_rows=hot_rows), "season", "driver")
    # C has no lap off the pit lane and is absent. D has no time: ranked first, shown as 0.
    assert set(got) == {(2023, "A"), (2023, "B"), (2023, "D"), (2024, "A")}
    assert {d: got[2023, d].race_pace_ranking for d in "ABD"} == {"D": 1, "A": 2, "B": 2}
    assert got[2023, "D"].driver_avg_clean_lap_time == 0.0 and got[2023, "A"].driver_avg_clean_lap_time == 91.0
    # Lap 3 is an entry lap and lap 4 an exit lap, so only laps 2 and 5 count for A.
    assert {d: got[2023, d].driver_positions_gained for d in "ABD"} == {"A": 3.0, "B": 1.0, "D": 0.0}
    for d in "ABD":
        r = got[2023, d]
        assert (r.fastest_sector1_time, r.fastest_sector2_time, r.fastest_sector3_time) == (31.0, 31.0, 27.0)
        assert r.estimated_positions_gained == 4.0 and r.avg_race_pace == pytest.approx(93.0)
    assert got[2024, "A"].estimated_positions_gained == 0.0


def test_rolling_pace_skips_missing_times_and_mixes_seasons_by_default(spark):
    rows = [(2023, "R", "A", 1.0, 10.0), (2023, "R", "A", 2.0, None), (2023, "R", "A", 3.0, 20.0), (2024, "R", "A", 1.0, 40.0), (2023, "R", None, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "season int, race_name string, driver string, lap_number double, lap_time_seconds double")
    mixed = by(transform.rolling_pace(df, order=("lap_number", "season")), "season", "driver", "lap_number")
    assert mixed[2023, "A", 2.0].race_pace_index == 25.0 and mixed[2023, "A", 2.0].race_pace_delta is None
    assert mixed[2023, "A", 3.0].race_pace_index == pytest.approx(70 / 3)
    assert mixed[2023, None, 1.0].race_pace_index is None
    apart = by(transform.rolling_pace(df, ("season", "race_name")), "season", "driver", "lap_number")
    assert apart[2023, "A", 3.0].race_pace_index == 15.0 and apart[2024, "A", 1.0].race_pace_delta == 0.0


def test_selection_modes(spark):
    schedule = spark.createDataFrame(
        [(2023, n, f"GP {n}") for n in range(8)] + [(2024, 2, "Late"), (2024, 1, "Early")], "season int, RoundNumber int, EventName string"
    )
    def names(df):
        return {(r.season, r.race_name) for r in df.collect()}

    assert names(selection.selection(spark)) == {(y, r) for y, r, _ in selection.DEFAULT_RACES}
    assert names(selection.first_races(schedule, 2)) == {(2023, "GP 1"), (2023, "GP 2"), (2024, "Early"), (2024, "Late")}
    assert names(selection.first_races(schedule, 2, season=2024)) == {(2024, "Early"), (2024, "Late")}
    assert len(names(selection.first_races(schedule))) == 7
    assert names(selection.named_races(schedule, ["GP 3", "GP 0"])) == {(2023, "GP 3")}
    assert names(selection.named_races(schedule, ["GP 3"], season=2024)) == set()
    assert len(names(selection.whole_season(schedule))) == 9 and len(names(selection.whole_season(schedule, 2023))) == 7


def test_saved_selection(spark, tmp_path):
    path = str(tmp_path / "chosen")
    assert selection.saved_selection(spark, path).count() == len(selection.DEFAULT_RACES)
    selection.save_selection(selection.selection(spark, [(2022, "Imola", "R")]), path)
    assert [tuple(r) for r in selection.saved_selection(spark, path).collect()] == [(2022, "Imola", "R")]


def test_position_change(spark):
    df = spark.createDataFrame([(5.0, 3.0), (None, 1.0)], "grid_position double, final_position double")
    assert [r.position_change for r in features.position_change(df).collect()] == [2.0, None]

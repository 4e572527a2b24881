"""Readers, sinks, catalog and the quality report."""

import glob
import json

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import by
from pyspark.sql import functions as F
from stintwise.functions.names import snake_name
from stintwise.operators import quality, selection
from stintwise.operators.cleaning import timestamps_to_micros
from stintwise.sources import catalog, readers, sinks


def race_rows(spark, season, race, extra=None):
    df = spark.createDataFrame([(season, race, "A", 1.0, float("nan")), (season, race, "B", 2.0, 5.0)], "season int, race_name string, Driver string, LapNumber double, Position double")
    return df if extra is None else df.withColumn(extra, F.lit("x"))


def test_races_read_as_one_scan_with_absent_files_skipped(spark, tmp_path):
    base = str(tmp_path)
    race_rows(spark, 2023, "Bahrain").write.parquet(readers.race_file(base, 2023, "Bahrain"))
    race_rows(spark, 2024, "Las Vegas", "Team").write.parquet(readers.race_file(base, 2024, "Las Vegas"))
    assert glob.glob(f"{base}/las_vegas_2024.parquet")
    both = readers.read_races(spark, base, [(2023, "Bahrain"), (2023, "Monza"), (2024, "Las Vegas")])
    assert both.count() == 4 and both._jdf.queryExecution().optimizedPlan().collectLeaves().size() == 1
    rows = by(both, "season", "Driver")
    assert rows[2023, "A"].Position is None and rows[2023, "B"].Position == 5.0
    assert rows[2023, "B"].Team is None and rows[2024, "B"].Team == "x"
    with pytest.raises(ValueError):
        readers.read_races(spark, base, [(2023, "Monza")])
    with pytest.raises(FileNotFoundError):
        readers.read_race(spark, base, 2023, "Monza")
    assert readers.read_race(spark, base, 2023, "Bahrain").count() == 2


def test_required_columns(spark):
    df = race_rows(spark, 2023, "R")
    with pytest.raises(ValueError, match="LapTime.*Compound.*TyreLife"):
        readers.require_columns(df)
    assert readers.require_columns(df, ["Driver"]) is df


def test_nanosecond_timestamps(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    pq.write_table(pa.table({"lap_start_date": pa.array([1_700_000_000_123_456_789, None, -1_001], pa.timestamp("ns"))}), path)
    spark.conf.set("spark.sql.legacy.parquet.nanosAsLong", "true")
    try:
        got = timestamps_to_micros(readers.read_raw(spark, path))
        assert [str(r[0]) for r in got.collect()] == ["2023-11-14 22:13:20.123456", "None", "1969-12-31 23:59:59.999998"]
    finally:
        spark.conf.unset("spark.sql.legacy.parquet.nanosAsLong")


@pytest.mark.parametrize(
    "name, snake",
    [("LapTime", "lap_time"), ("SpeedI1", "speed_i1"), ("SpeedFL", "speed_fl"), ("Sector1SessionTime", "sector1_session_time"), ("race_name", "race_name"), ("DriverNumber", "driver_number")],
)
def test_snake_names(name, snake):
    assert snake_name(name) == snake


def test_partitioned_write_prunes_and_overwrites_by_partition(spark, laps, tmp_path):
    path = str(tmp_path / "laps")
    sinks.write_partitioned(laps.select("season", "race_name", "driver", "lap_number"), path)
    back = spark.read.parquet(path)
    assert back.count() == laps.count()
    one = back.where((F.col("season") == 2023) & (F.col("race_name") == "R1"))
    assert "PartitionFilters: [isnotnull(season" in one._jdf.queryExecution().executedPlan().toString()
    kept = back.where("season = 2024").count()
    sinks.write_partitioned(spark.createDataFrame([(2023, "R1", "X", 1.0)], "season int, race_name string, driver string, lap_number double"), path, only_touched=True)
    again = spark.read.parquet(path)
    assert again.where("season = 2023 and race_name = 'R1'").count() == 1 and again.where("season = 2024").count() == kept


def test_heavy_partition_is_written_by_several_tasks(spark, tmp_path):
    path = str(tmp_path / "heavy")
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        df = spark.range(0, 100_000, 1, 8).select(F.lit(2023).alias("season"), F.when(F.col("id") % 3 == 0, "R2").otherwise("R1").alias("race_name"), F.xxhash64("id").alias("v"))
        sinks.write_partitioned(df, path)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    assert len(glob.glob(f"{path}/season=2023/race_name=R1/*.parquet")) > 1
    assert spark.read.parquet(path).count() == 100_000


def test_per_race_folders(spark, laps, tmp_path):
    path = str(tmp_path / "split")
    chosen = selection.selection(spark, [(2023, "R1", "R"), (2024, "R2", "R"), (2024, "Nowhere", "R")])
    sinks.write_selected_races(laps.select("season", "race_name", "driver"), chosen, path)
    assert sorted(p.rsplit("/", 1)[1] for p in glob.glob(f"{path}/race_slug=*")) == ["race_slug=processed_r1_2023", "race_slug=processed_r2_2024"]


def test_gold_tables_in_the_catalog(spark, tmp_path):
    base = str(tmp_path)
    for table in catalog.GOLD_SCHEMAS:
        empty = spark.createDataFrame([], catalog.gold_schema(table))
        values = {c: F.lit(1).cast(empty.schema[c].dataType) for c in empty.columns}
        row = spark.range(1).select([v.alias(c) for c, v in values.items()])
        sinks.write_partitioned(catalog.as_gold(row, table), f"{base}/{table}")
    catalog.register_gold(spark, base, "gold_test")
    catalog.register_gold(spark, base, "gold_test")
    found = spark.sql("SELECT d.driver, r.race_pace_ranking FROM gold_test.driver_analytics d JOIN gold_test.race_analytics r USING (season, race_name, driver)")
    assert [tuple(r) for r in found.collect()] == [("1", 1)]
    assert spark.sql("SHOW PARTITIONS gold_test.tire_analytics").first()[0] == "season=1/race_name=1"


def test_quality_report(spark, tmp_path):
    nan = float("nan")
    df = spark.createDataFrame(
        [("R", "A", 1.0, 90.0, "SOFT"), ("R", "A", 1.0, 0.0, "soft"), ("R", "A", 1.0, 301.0, "Hyper"), ("R", None, 1.0, 300.0, None), ("R", None, 1.0, nan, "Hyper"), ("R", "B", nan, -1.0, "Ultra")],
        "race_name string, driver string, lap_number double, lap_time_seconds double, compound string",
    )
    df = readers.nan_to_null(df)
    assert quality.duplicate_rows(df).first()[0] == 3
    assert quality.duplicate_rows(df.limit(1)).first()[0] == 0
    assert quality.invalid_values(df).first()[0] == 3
    assert {r[0] for r in quality.invalid_categories(df).collect()} == {"Hyper", "Ultra"}
    sinks.write_quality_report(quality.quality_rows(df), str(tmp_path / "report"))
    files = glob.glob(f"{tmp_path}/report/*.json")
    report = json.loads(open(files[0]).read())
    assert len(files) == 1
    shares = report.pop("null_percentages")
    assert report == {"row_count": 6, "column_count": 5, "duplicate_laps": 3, "invalid_lap_times": 3, "invalid_tire_compounds": ["Hyper", "Ultra"]}
    assert shares["driver"] == pytest.approx(100 / 3) and shares["race_name"] == 0.0 and shares["lap_time_seconds"] == pytest.approx(100 / 6)


def test_quality_report_without_the_checked_columns(spark):
    rows = by(quality.quality_rows(spark.createDataFrame([("R", "A")], "race_name string, driver string"), ("race_name", "driver")), "measure", "item")
    assert rows["invalid_lap_times", None].value == 0.0 and not [k for k in rows if k[0] == "invalid_tire_compounds"]


def test_null_percentages_count_nan(spark):
    df = spark.createDataFrame([(float("nan"), 1), (1.0, None), (None, None), (2.0, 3)], "a double, b int")
    assert {r.column_name: r.null_pct for r in quality.null_percentages(df).collect()} == {"a": 50.0, "b": 50.0}


def files_of(path):
    return {str(f.relative_to(path)) for f in path.rglob("*.parquet")}


def test_refresh_touches_only_changed_races(spark, tmp_path):
    """A changed race has new files, a race that is gone none, all others keep theirs; the tables equal a computation from nothing."""
    from stintwise.plans import gold, refresh
    from stintwise.registry.workspace import Workspace
    from stintwise.sources.catalog import as_gold, read_gold

    ws = Workspace(spark, "/root/testdata/sf0.001")
    base = tmp_path / "gold"
    first = refresh.refresh_gold(ws.first_delivery(), str(base), medians=["tyre_life"])
    assert {r.change for r in first.collect()} == {"new"}
    before = {t: files_of(base / t) for t in ("driver_analytics", "race_analytics", refresh.SKETCHES)}
    changes = {(r.season, r.race_name): r.change for r in refresh.refresh_gold(ws.corrected(), str(base), medians=["tyre_life"]).collect()}
    assert changes == {(2023, "R2"): "changed", (2024, "R3"): "new", (2024, "R4"): "gone"}
    touched = {f"season={s}/race_name={r}" for s, r in changes}
    for table, files in before.items():
        now = files_of(base / table)
        assert {f for f in now if f.rpartition("/")[0] not in touched} == {f for f in files if f.rpartition("/")[0] not in touched}
        assert not any(f.startswith("season=2024/race_name=R4") for f in now)
        assert {f for f in now if "race_name=R2" in f and "2023" in f}.isdisjoint(files)
    for table in ("driver_analytics", "pitstop_analytics", "tire_analytics"):
        whole = as_gold(getattr(gold, table)(ws.corrected()), table)
        kept = read_gold(spark, str(base), table)
        assert kept.count() == whole.count() and kept.select(*[c for c, t in kept.dtypes if t != "double"]).exceptAll(whole.select(*[c for c, t in kept.dtypes if t != "double"])).count() == 0
    assert refresh.refresh_gold(ws.corrected(), str(base)).count() == 0


def test_digests_see_nulls_moves_and_copies(spark):
    from stintwise.plans.refresh import race_digests

    schema = "season int, race_name string, a double, b double"
    base = [(1, "R", 1.0, None), (1, "R", 2.0, 3.0)]
    variants = [base, [(1, "R", None, 1.0), base[1]], [*base, base[0]], base[:1], [*base, base[0], base[0]]]
    digests = [tuple(race_digests(spark.createDataFrame(v, schema)).first()) for v in variants]
    assert len(set(digests)) == len(variants)
    assert tuple(race_digests(spark.createDataFrame(base[::-1], schema).repartition(3)).first()) == digests[0]


def test_partitions_are_registered_one_by_one(spark, tmp_path):
    from stintwise.plans import refresh
    from stintwise.registry.workspace import Workspace
    from stintwise.sources import catalog

    ws, base = Workspace(spark, "/root/testdata/sf0.001"), str(tmp_path / "gold")
    refresh.refresh_gold(ws.first_delivery(), base)
    catalog.register_gold(spark, base, "kept_up")
    catalog.add_partitions(spark, base, refresh.refresh_gold(ws.corrected(), base), "kept_up")
    races = {tuple(r) for r in spark.table("kept_up.driver_analytics").select("season", "race_name").distinct().collect()}
    assert (2024, "R3") in races and (2024, "R4") not in races
    assert spark.table("kept_up.race_analytics").count() == catalog.read_gold(spark, base, "race_analytics").count()

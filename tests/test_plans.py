"""The physical plans the operators are meant to have."""

import pytest
from conftest import SMALL_DIR
from pyspark.sql import functions as F
from stintwise.operators import assembly, cleaning, quality, selection
from stintwise.plans import gold, reports, silver, views
from stintwise.registry.queries import REGISTRY
from stintwise.registry.workspace import Workspace
from stintwise.sources import lap_events, sinks
from stintwise.sources.readers import read_raw


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.collect()
    return plan(df)


def test_no_python_in_any_plan(spark):
    for name in ("race_analytics", "clean_laps", "engineer_laps", "transform_laps", "dq_report", "lap_assembly", "ols_trendline"):
        text = plan(REGISTRY[name](spark, SMALL_DIR))
        assert not any(node in text for node in ("MapInPandas", "ArrowEvalPython", "BatchEvalPython", "FlatMapGroupsInPandas")), name


def test_no_cartesian_or_nested_loop_joins(spark):
    for name in ("race_analytics", "tire_analytics", "sql_pace_vs_result", "clean_laps", "transform_laps", "lap_assembly", "select_specific", "column_medians"):
        text = plan(REGISTRY[name](spark, SMALL_DIR))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_gold_reads_only_what_it_needs(spark):
    laps = Workspace(spark, SMALL_DIR).engineered()
    text = plan(gold.driver_analytics(laps))
    assert "ReadSchema: struct<driver:string,grid_position:double,final_position:double,lap_time_seconds:double>" in text
    assert text.count("Exchange") == 1
    assert "PushedFilters: [IsNotNull(pit_in_time_seconds)]" in plan(views.pit_timing(laps))


def test_race_filter_prunes_partitions(spark):
    drivers = Workspace(spark, SMALL_DIR).gold("driver_analytics")
    text = plan(views.one_race(drivers, 2023, "R1"))
    assert "PartitionFilters: [isnotnull(season" in text and "(season" in text and "= 2023)" in text


def test_aggregates_combine_before_the_shuffle(spark):
    text = plan(Workspace(spark, SMALL_DIR).laps().transform(lambda d: silver.engineer_laps(d)))
    assert "partial_covar_pop" in text


def test_small_summaries_do_not_move_the_laps(spark):
    laps = Workspace(spark, SMALL_DIR).laps()
    text = plan(silver.engineer_laps(laps))
    assert "BroadcastHashJoin" in text and text.count("SortMergeJoin") == 0


def test_many_files_stay_one_scan(spark, tmp_path):
    paths = []
    for i in range(12):
        paths.append(str(tmp_path / f"f{i}"))
        spark.range(3).select(F.lit(float(i)).alias(f"c{i % 3}")).write.parquet(paths[-1])
    df = read_raw(spark, *paths)
    assert plan(df).count("Scan parquet") == 1 and set(df.columns) == {"c0", "c1", "c2"}


def test_union_by_name_keeps_duplicates(spark):
    a, b = spark.range(2).select("id", F.lit(1).alias("x")), spark.range(2).select(F.lit("s").alias("y"), "id")
    assert sorted(tuple(r) for r in assembly.union_by_name([a, a, b]).select("id", F.coalesce("x", F.lit(0))).collect()) == [(0, 0), (0, 1), (0, 1), (1, 0), (1, 1), (1, 1)]


def test_report_top_k_is_a_cut_of_the_whole_rank(spark):
    drivers = Workspace(spark, SMALL_DIR).gold("driver_analytics")
    whole = reports.consistency_rank(drivers)
    assert sorted(map(tuple, reports.consistency_rank(drivers, top=2).collect())) == sorted(tuple(r) for r in whole.collect() if r.consistency_rank <= 2)


def test_null_share_is_one_pass(spark):
    text = plan(quality.null_percentages(Workspace(spark, SMALL_DIR).laps()))
    assert text.count("Scan parquet") == 1


def test_properties_of_the_gold_tables(spark):
    ws = Workspace(spark, SMALL_DIR)
    usage = gold.compound_usage(ws.laps()).groupBy("season", "race_name").agg(F.sum("compound_usage_pct").alias("s"))
    assert usage.where(F.abs(F.col("s") - 100) > 1e-9).count() == 0
    ranks = ws.gold("race_analytics").groupBy("season", "race_name").agg(F.min("race_pace_ranking").alias("r"))
    assert {r.r for r in ranks.collect()} == {1}
    moved = silver.transform_laps(ws.laps())
    assert moved.groupBy("race_name", "lap_number").agg(F.min("sector1_delta").alias("d")).where("d <> 0").count() == 0


def test_race_analytics_scans_and_deals_the_laps_once(spark):
    """Gains, clean pace and benchmarks, of drivers and of races, from one scan, one exchange of laps and one of drivers."""
    text = final_plan(gold.race_analytics(Workspace(spark, SMALL_DIR).engineered()))
    text = text.partition("== Initial Plan ==")[0]
    assert text.count("Scan parquet") == 1 and text.count("Exchange hashpartitioning") == 2 and "Join" not in text


def test_a_selection_prunes_the_files_of_other_races(spark, tmp_path):
    laps = Workspace(spark, SMALL_DIR).laps()
    path = str(tmp_path / "selection")
    spark.createDataFrame([(2023, "R1"), (2023, "R0")], "season int, race_name string").write.parquet(path)
    kept = selection.keep_selected(laps, spark.read.parquet(path))
    kept.collect()
    executed = kept._jdf.queryExecution().executedPlan()
    assert "dynamicpruning" in executed.toString()
    scans = executed.collectLeaves()
    while scans.head().nodeName().startswith(("AdaptiveSparkPlan", "ResultQueryStage", "ShuffleQueryStage", "BroadcastQueryStage")):
        head = scans.head()
        scans = (head.executedPlan() if head.nodeName().startswith("Adaptive") else head.plan()).collectLeaves()
    files = {scans.apply(i).metrics().apply("numFiles").value() for i in range(scans.size()) if "Scan parquet" in scans.apply(i).nodeName()}
    assert laps.select("season", "race_name").distinct().count() > 2 and 2 in files


def test_quality_figures_come_with_the_write(spark, tmp_path):
    laps = Workspace(spark, SMALL_DIR).laps()
    table, rows = sinks.write_measured(laps, str(tmp_path / "laps"))
    assert table.count() == laps.count()
    assert "Scan" not in plan(rows) or "ExistingRDD" in plan(rows) or "LocalTableScan" in plan(rows)
    whole = {(r.measure, r.item): r.value for r in quality.quality_rows(laps).collect() if r.measure != "duplicate_laps"}
    found = {(r.measure, r.item): r.value for r in rows.collect()}
    assert set(found) == set(whole) and all(found[k] == pytest.approx(v, rel=1e-12) for k, v in whole.items())
    _, none = sinks.write_measured(laps.limit(0), str(tmp_path / "none"))
    assert {r.measure: r.value for r in none.collect() if r.item is None}["row_count"] == 0.0


@pytest.fixture
def no_sizes(spark):
    """No join is a broadcast one by the size of its side."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_few_overrides_leave_the_laps_where_they_are(spark, no_sizes):
    laps = spark.createDataFrame([("R1", 4, 1.0, 2.0), ("R1", None, 3.0, 4.0)], "race_name string, driver_number int, grid_position double, final_position double")
    given = spark.createDataFrame([("R1", "4", 7.0, None), ("R1", "4", 5.0, 6.0)], "race_name string, driver_number string, grid_position double, final_position double")
    placed = cleaning.override_positions(laps, given)
    assert sorted(tuple(r)[2:] for r in placed.collect()) == [(3.0, 4.0), (7.0, 2.0)]
    assert "BroadcastHashJoin" in plan(placed) and "SortMergeJoin" not in plan(placed)


def test_stints_start_without_a_join_of_the_laps(spark, no_sizes):
    """Pit entries on the 2nd and last of five laps; a lap without a driver has no tyre age."""
    rows = [(i, f"2024-01-01 00:00:0{i}", None if i == 9 else 20, "error" if i in (4, 8) else "click", 1.0 + i) for i in (2, 4, 8, 6, 7, 9)]
    events = spark.createDataFrame(rows, "event_id long, ts string, user_id long, event_type string, value double")
    events = events.withColumn("ts", F.to_timestamp("ts")).withColumn("props", F.lit("7"))
    numbered = []
    laps = lap_events.laps_from_events(events, lambda df: numbered.append(df) or df)
    found = {r.event_id: (r.stint, r.tyre_life) for r in laps.collect()}
    assert found == {2: (1, 1.0), 4: (1, 2.0), 6: (2, 1.0), 7: (2, 2.0), 8: (2, 3.0), 9: (1, None)}
    text = plan(numbered[0])
    assert "stint_start" in text and text.count("Exchange") == 1 and "Join" not in text

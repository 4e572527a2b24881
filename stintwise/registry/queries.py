"""Every operator as a query over the given tables.

Doubles are rounded so that two engines that add in a different order agree.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import names
from ..functions.names import snake_columns
from ..functions.scalars import tidy
from ..operators import assembly, boosting, cleaning, features, quality, selection, transform
from ..operators.median import exact_medians
from ..operators.median import sketched_medians as sketched_medians_of
from ..operators.ordered import rank_within
from ..plans import gold, model, refresh, reports, silver, views
from ..sources import catalog, readers, sinks
from ..sources.readers import nan_to_null
from .workspace import Workspace

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

RACE = ["season", "race_name"]
LAP = ["season", "race_name", "driver", "lap_number"]
BY_SEASON = ("season", "race_name")


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    doubles = {f.name for f in df.schema if isinstance(f.dataType, T.DoubleType)}
    return df.select([tidy(F.col(c), places).alias(c) if c in doubles else F.col(c) for c in df.columns])


def query(build: Callable[[Workspace], DataFrame]) -> Callable[[Workspace], DataFrame]:
    REGISTRY[build.__name__] = lambda spark, sf_dir: rounded(build(Workspace(spark, sf_dir)))
    return build


# --- lap table and gold tables -------------------------------------------------


@query
def lap_table(ws):
    return ws.laps()


@query
def driver_analytics(ws):
    return gold.driver_analytics(ws.engineered())


@query
def tire_analytics(ws):
    return gold.tire_analytics(ws.engineered())


@query
def pitstop_analytics(ws):
    return gold.pitstop_analytics(ws.engineered())


@query
def race_analytics(ws):
    return gold.race_analytics(ws.engineered())


@query
def compound_usage(ws):
    return gold.compound_usage(ws.laps())


@query
def pit_position_delta(ws):
    return gold.pit_entries(ws.laps())


@query
def positions_gained(ws):
    return gold.positions_gained(ws.laps())


@query
def race_benchmarks(ws):
    return gold.race_benchmarks(ws.laps())


@query
def clean_pace(ws):
    return gold.clean_pace(ws.laps())


@query
def race_pace_rank(ws):
    return rank_within(gold.clean_pace(ws.laps()), RACE, "driver_avg_clean_lap_time", "race_pace_ranking")


# --- reports over gold tables --------------------------------------------------


@query
def sql_consistency_rank(ws):
    return reports.consistency_rank(ws.gold("driver_analytics"))


@query
def topk_consistency(ws):
    return reports.consistency_rank(ws.gold("driver_analytics"), top=5)


@query
def sql_positions_gained(ws):
    return reports.places_gained(ws.gold("driver_analytics"))


@query
def sql_compound_performance(ws):
    return reports.compound_performance(ws.gold("tire_analytics"))


@query
def sql_pit_efficiency(ws):
    return reports.pit_efficiency(ws.gold("pitstop_analytics"))


@query
def sql_pace_vs_result(ws):
    return reports.pace_vs_result(ws.gold("race_analytics"), ws.gold("driver_analytics"))


@query
def sql_pace_vs_result_by_season(ws):
    keys = ("season", "race_name", "driver")
    return reports.pace_vs_result(ws.gold("race_analytics"), ws.gold("driver_analytics"), keys)


@query
def sql_sector_benchmarks(ws):
    return reports.sector_benchmarks(ws.gold("race_analytics"))


@query
def sql_sector_benchmarks_once(ws):
    return reports.sector_benchmarks(ws.gold("race_analytics"), per_driver_sum=False)


# --- lap-level measures --------------------------------------------------------

DELTAS = [*LAP, *transform.SECTOR_DELTAS]


@query
def sector_deltas(ws):
    return transform.sector_deltas(ws.laps()).select(DELTAS)


@query
def sector_deltas_by_season(ws):
    return transform.sector_deltas(ws.laps(), BY_SEASON).select(DELTAS)


@query
def rolling_pace(ws):
    laps = ws.laps().select(*LAP, "lap_time_seconds")
    return transform.rolling_pace(laps, order=("lap_number", "season"))


@query
def rolling_pace_by_season(ws):
    return transform.rolling_pace(ws.laps().select(*LAP, "lap_time_seconds"), BY_SEASON)


@query
def performance_score(ws):
    return transform.performance_score(ws.laps().select(*LAP, "lap_time_seconds"))


@query
def performance_score_by_season(ws):
    return transform.performance_score(ws.laps().select(*LAP, "lap_time_seconds"), BY_SEASON)


@query
def position_change(ws):
    return features.position_change(ws.laps()).select(*LAP, "position_change")


@query
def stint_length(ws):
    return features.stint_features(ws.laps()).select(*LAP, "stint", "stint_length")


@query
def degradation_rate(ws):
    return features.stint_summary(ws.laps())


@query
def degradation_rate_by_season(ws):
    return features.stint_summary(ws.laps(), [*RACE, "driver", "stint"])


@query
def engineer_laps(ws):
    return silver.engineer_laps(ws.laps()).select(
        *LAP, "stint", "position_change", "stint_length", "tire_degradation_rate"
    )


@query
def transform_laps(ws):
    return silver.transform_laps(ws.laps()).select(
        *DELTAS, "race_pace_index", "race_pace_delta", "circuit_performance_score"
    )


# --- cleaning ------------------------------------------------------------------


@query
def snake_case_rename(ws):
    return snake_columns(ws.raw()).drop("humidity")


@query
def snake_case_values(ws):
    segment = F.concat(F.initcap(F.lower("c_mktsegment")), F.lit("Segment"), F.col("c_nationkey").cast("string"), F.lit("Name"))
    return ws.given("customer").select("c_custkey", segment.alias("camel"), names.snake_value(segment).alias("snake"))


@query
def duration_to_seconds(ws):
    return cleaning.durations_to_seconds(snake_columns(ws.raw())).select(
        "season", "race_name", "driver_number", "lap_number", "lap_time_seconds",
        "sector1_time_seconds", "sector2_time_seconds", "sector3_time_seconds", "pit_in_time_seconds", "pit_out_time_seconds",
    )


@query
def timestamp_to_micros(ws):
    return cleaning.timestamps_to_micros(snake_columns(ws.raw())).select(
        "season", "race_name", "driver_number", "lap_number", "lap_start_date"
    )


@query
def override_lookup(ws):
    laps = ws.laps().select(*LAP, "driver_number", "grid_position", "final_position")
    return cleaning.override_positions(laps, ws.overrides())


@query
def impute_median(ws):
    typed = _typed(ws)
    filled = [c for c in cleaning.MEDIAN_COLUMNS if c in typed.columns]
    return cleaning.fill_medians(typed).select("season", "race_name", "driver_number", "lap_number", *filled)


@query
def column_medians(ws):
    typed = _typed(ws)
    return exact_medians(typed, [c for c in cleaning.MEDIAN_COLUMNS if c in typed.columns])


@query
def impute_categorical(ws):
    return cleaning.fill_labels(snake_columns(ws.raw())).select(
        "season", "race_name", "driver_number", "lap_number", "driver", "compound", "team", "deleted_reason"
    )


def _typed(ws):
    return cleaning.durations_to_seconds(snake_columns(nan_to_null(ws.raw())))


CLEANED = [
    "season", "race_name", "driver", "driver_number", "team", "lap_number", "stint", "compound", "tyre_life", "position",
    "air_temp", "track_temp", "humidity", "rainfall", "deleted_reason", "grid_position", "final_position",
    "lap_start_date", "lap_time_seconds", "sector1_time_seconds", "sector2_time_seconds", "sector3_time_seconds",
    "pit_in_time_seconds", "pit_out_time_seconds",
]


@query
def clean_laps(ws):
    return silver.clean_laps(nan_to_null(ws.raw()), ws.overrides()).select(CLEANED)


@query
def silver_pipeline(ws):
    return ws.engineered_from_raw().select(
        "season", "race_name", "driver_number", "lap_number", "position_change", "stint_length", "tire_degradation_rate",
        "sector1_delta", "sector2_delta", "sector3_delta", "race_pace_index", "race_pace_delta", "circuit_performance_score",
    )


# Cleaning names a lost driver "Unknown", so the tables that look along a driver's laps go by number.
BY_NUMBER = ("season", "race_name", "driver_number")


@query
def gold_from_raw_driver(ws):
    return gold.driver_analytics(ws.engineered_from_raw())


@query
def gold_from_raw_tire(ws):
    return gold.tire_analytics(ws.engineered_from_raw())


@query
def gold_from_raw_pitstop(ws):
    return gold.pitstop_analytics(ws.engineered_from_raw(), BY_NUMBER)


@query
def gold_from_raw_race(ws):
    return gold.race_analytics(ws.engineered_from_raw(), BY_NUMBER)


# --- quality -------------------------------------------------------------------

RAW_KEYS = ("race_name", "driver", "lap_number")


@query
def dq_null_pct(ws):
    return quality.null_percentages(snake_columns(ws.raw()))


@query
def dq_duplicates(ws):
    return quality.duplicate_rows(snake_columns(ws.raw()), RAW_KEYS)


@query
def dq_invalid_values(ws):
    return quality.invalid_values(_typed(ws))


@query
def dq_invalid_categories(ws):
    return quality.invalid_categories(ws.given("events"), "event_type", ["VIEW", "CLICK", "PURCHASE"])


@query
def dq_report(ws):
    return quality.quality_rows(_typed(ws), RAW_KEYS)


@query
def dq_observed(ws):
    """The report's figures taken while the laps are written, without a scan of their own."""
    _, rows = sinks.write_measured(_typed(ws), f"{ws.folder()}/measured", RACE)
    return rows


@query
def dq_document(ws):
    """The nested report written as JSON and read back, a row for each column's null share."""
    path = f"{ws.folder()}/quality"
    rows = quality.quality_rows(_typed(ws), RAW_KEYS)
    sinks.write_quality_report(rows, path)
    read = ws.spark.read.schema(quality.quality_document(rows).schema).json(path)
    wrong = F.array_join("invalid_tire_compounds", ",").alias("invalid_tire_compounds")
    counts = ["row_count", "column_count", "duplicate_laps", "invalid_lap_times"]
    return read.select(*counts, wrong, F.explode("null_percentages").alias("column_name", "null_pct"))


# --- assembly and selection ----------------------------------------------------


@query
def union_by_name(ws):
    laps = ws.laps()
    first = laps.where(F.col("season") == 2023).select(*LAP, "air_temp")
    second = laps.where(F.col("season") != 2023).select("tyre_life", *LAP)
    return assembly.union_by_name([first, second])


@query
def asof_weather(ws):
    laps = ws.laps().select(*LAP, "ts")
    weather = ws.weather().withColumnRenamed("ts", "sampled")
    return assembly.asof_join(laps, weather, RACE, "ts", "sampled", ["sample"])


@query
def position_fallback(ws):
    results = assembly.rename_results(ws.results())
    return assembly.complete_positions(results, ws.laps())


@query
def lap_assembly(ws):
    laps = ws.laps().select(*LAP, "driver_number", "position", "ts")
    return assembly.assemble_laps(laps, ws.weather(), ws.results(), ["sample"])


@query
def select_first_n(ws):
    return selection.first_races(ws.schedule(), 3)


@query
def select_specific(ws):
    return selection.keep_selected(ws.laps(), selection.named_races(ws.schedule(), ["R1", "R3"])).select(LAP)


@query
def select_season(ws):
    return selection.whole_season(ws.schedule())


@query
def saved_selection(ws):
    """Laps of the races of one season that an earlier session chose and kept."""
    path = f"{ws.folder()}/selection"
    selection.save_selection(selection.first_races(ws.schedule(), 2, season=2023), path)
    return selection.keep_selected(ws.laps(), selection.saved_selection(ws.spark, path)).select(LAP)


@query
def raw_race_read(ws):
    """Every race written to a file of its own and read by list; one listed race has no file."""
    base, raw = f"{ws.folder()}/raw", ws.raw()
    races = [(r["season"], r["EventName"]) for r in ws.schedule().collect()]  # a calendar
    for season, race_name in races:
        sinks.write_table(views.one_race(raw, season, race_name), readers.race_file(base, season, race_name))
    read = readers.require_columns(readers.read_races(ws.spark, base, [*races, (1949, "No Race")]))
    return read.select(*RACE, "Driver", "LapNumber", "LapTime", "Compound", "TyreLife", "Position")


@query
def single_race_read(ws):
    """One race read alone from a file of its own."""
    base = f"{ws.folder()}/single"
    sinks.write_table(views.one_race(ws.raw(), 2023, "R1"), readers.race_file(base, 2023, "R1"))
    return readers.read_race(ws.spark, base, 2023, "R1").select(*RACE, "Driver", "LapNumber", "LapTime", "Compound", "TyreLife", "Position")


@query
def race_slug(ws):
    long_name = F.concat(F.lit("Grand Prix "), "EventName")
    slug = names.race_slug(long_name, F.col("season"), "processed_")
    return ws.schedule().select("season", "EventName", slug.alias("slug"))


@query
def race_label(ws):
    label = F.col("race_display")
    return views.distinct_races(ws.laps()).select(
        label, names.label_season(label).alias("season"), names.label_race(label).alias("race_name")
    )


# --- sinks and catalog ---------------------------------------------------------


@query
def partitioned_write_read(ws):
    ws.gold("pitstop_analytics")
    return catalog.read_gold(ws.spark, ws.gold_folder(), "pitstop_analytics")


@query
def catalog_roundtrip(ws):
    catalog.register_gold(ws.spark, ws.gold_folder())
    return ws.spark.table(f"{catalog.DATABASE}.race_analytics")


KEPT_MEDIANS = ("lap_time_seconds", "tyre_life", "track_temp")


@query
def refreshed_changes(ws):
    """What a second delivery of laps changes, found by digests of races."""
    return ws.refreshed(KEPT_MEDIANS)[1]


@query
def refreshed_driver_analytics(ws):
    """A gold table after a refresh that touched three races: the same as if all had been computed again."""
    return catalog.read_gold(ws.spark, ws.refreshed(KEPT_MEDIANS)[0], "driver_analytics")


@query
def refreshed_pitstop_analytics(ws):
    return catalog.read_gold(ws.spark, ws.refreshed(KEPT_MEDIANS)[0], "pitstop_analytics")


@query
def sketched_medians(ws):
    """Medians from sketches kept per race and refreshed with it: how many values they stand for, and whether their rank is within 1 %."""
    base, _ = ws.refreshed(KEPT_MEDIANS)
    found = sketched_medians_of(ws.spark.read.parquet(f"{base}/{refresh.SKETCHES}"))
    laps = ws.corrected().select(*KEPT_MEDIANS).unpivot([], list(KEPT_MEDIANS), "of", "value").where("value is not null")
    placed = laps.join(F.broadcast(found), F.col("of") == F.col("column"))  # one row a column
    below, upto = F.avg((F.col("value") < F.col("median")).cast("int")), F.avg((F.col("value") <= F.col("median")).cast("int"))
    return placed.groupBy("column", "n").agg(((below <= 0.51) & (upto >= 0.49)).alias("near_middle"))


@query
def per_group_split(ws):
    path = f"{ws.gold_folder()}/per_race"
    laps = ws.laps().select(LAP)
    sinks.write_selected_races(laps, selection.whole_season(ws.schedule()), path)
    return ws.spark.read.parquet(path)


# --- tables behind the analysis pages ------------------------------------------


@query
def race_overview(ws):
    return views.race_overview(ws.laps(), ws.gold("driver_analytics"), ws.gold("race_analytics"))


@query
def position_series(ws):
    return views.position_series(ws.laps())


@query
def driver_pace_series(ws):
    return views.pace_series(ws.laps())


@query
def driver_comparison(ws):
    return views.driver_comparison(ws.gold("driver_analytics"))


@query
def ols_trendline(ws):
    return views.wear_trendlines(ws.laps())


@query
def one_race_page(ws):
    return views.one_race(ws.gold("driver_analytics"), 2023, "R1")


CHOSEN = ["D1", "D7", "D12"]


@query
def chosen_drivers_pace(ws):
    return views.pace_series(ws.laps(), CHOSEN)


@query
def chosen_drivers_comparison(ws):
    return views.driver_comparison(ws.gold("driver_analytics"), CHOSEN)


@query
def chosen_compound_trendline(ws):
    return views.wear_trendlines(ws.laps(), "SOFT")


@query
def distinct_races(ws):
    return views.distinct_races(ws.laps())


@query
def distinct_values(ws):
    return views.distinct_values(ws.laps(), "driver")


@query
def distinct_usage(ws):
    return views.usage_per_race(ws.gold("tire_analytics"))


@query
def stint_page(ws):
    return views.stint_page(ws.gold("tire_analytics"))


@query
def pit_entry_laps(ws):
    return views.pit_timing(ws.laps())


@query
def strategy_distribution(ws):
    return views.strategy_distribution(ws.gold("pitstop_analytics"))


@query
def pit_efficiency_sorted(ws):
    return views.pit_efficiency_order(ws.gold("pitstop_analytics"))


@query
def undercut_mean(ws):
    return views.undercut_mean(ws.gold("pitstop_analytics"))


@query
def heuristic_lap_time(ws):
    return views.heuristic_predictions(ws.laps())


# --- model ---------------------------------------------------------------------


@query
def ml_features(ws):
    return ws.model_rows()


@query
def ml_split(ws):
    train, holdout = ws.holdout_split()
    keys = [f"key_{c}" for c in LAP]
    return train.select(*keys, F.lit("train").alias("part")).unionByName(holdout.select(*keys, F.lit("holdout").alias("part")))


@query
def ml_metrics(ws):
    return model.evaluate(ws.model(), ws.holdout_split()[1])


@query
def ml_importance(ws):
    return model.importance(ws.model(), ws.spark)


@query
def ml_predictions(ws):
    return model.predict(ws.model(), ws.model_rows())


@query
def ml_scored_rows(ws):
    """Whether each lap has a finite prediction."""
    p = F.col("prediction")
    finite = p.isNotNull() & ~F.isnan(p) & (F.abs(p) < float("inf"))
    return model.predict(ws.model(), ws.model_rows()).select(*[f"key_{c}" for c in LAP], finite.alias("scored"))


@query
def ml_evaluated_rows(ws):
    """Holdout laps behind the metrics, and what holds of any such metrics."""
    found = model.evaluate(ws.model(), ws.holdout_split()[1])
    return found.select("rows", ((F.col("rmse") >= F.col("mae")) & (F.col("mae") >= 0) & (F.col("r2") <= 1)).alias("consistent"))


def _first_cut(fitted, spark):
    """What the first cut of a forest is, its gain as a share of the squares there were, and the rows on either side."""
    nodes = fitted.forest.table(spark)
    top = nodes.where("tree = 0 and node = 0").select("feature", "threshold", "missing_left", "gain", "rows")
    sides = nodes.where("tree = 0").agg(*[F.max(F.when(F.col("node") == i, F.col("rows"))).alias(n) for i, n in ((1, "left_rows"), (2, "right_rows"))])
    return top.crossJoin(F.broadcast(sides))  # one row each


@query
def ml_first_split(ws):
    return _first_cut(model.fit(ws.holdout_split()[0], trees=1, depth=1), ws.spark)


@query
def ml_first_split_gaps(ws):
    """The first cut where numbers are missing: which side the laps without one take is part of what is learned."""
    return _first_cut(model.fit(ws.gapped_split()[0], trees=1, depth=1), ws.spark)


@query
def ml_stump_metrics(ws):
    """A forest of one cut from fit to evaluation on the holdout, numbers missing in both."""
    train, holdout = ws.gapped_split()
    return model.evaluate(model.fit(train, trees=1, rate=1.0, depth=1), holdout)


@query
def ml_stump_importance(ws):
    return model.importance(model.fit(ws.gapped_split()[0], trees=1, depth=1), ws.spark)


# A small forest by hand: label codes, a number, missing numbers to either side.
FIXED_FOREST = boosting.Forest(
    [*model.LABELS, *model.NUMBERS], 90.0,
    [
        (0, 0, "TyreLife", 8.0, True, 4.0, 10, None), (0, 1, "Compound", 0.0, False, 2.0, 6, None), (0, 2, None, None, None, None, 4, 1.5),
        (0, 3, None, None, None, None, 3, -0.75), (0, 4, None, None, None, None, 3, 0.25),
        (1, 0, "AirTemp", 24.0, False, 3.0, 10, None), (1, 1, None, None, None, None, 5, -1.25), (1, 2, "Driver", 4.0, True, 1.0, 5, None),
        (1, 5, None, None, None, None, 2, 0.5), (1, 6, None, None, None, None, 3, 2.0),
    ],
)
FIXED_LABELS = {"Compound": ["HARD", "MEDIUM", "SOFT"], "Circuit": [], "Driver": ["D0", "D1", "D10", "D11", "D12", "D13"]}


@query
def ml_fixed_forest(ws):
    """Every lap scored by a forest given as nodes; most drivers are unknown to it."""
    rows = ws.gapped_split()
    laps = rows[0].unionByName(rows[1])
    return model.predict(model.LapModel(FIXED_LABELS, FIXED_FOREST), laps).select(*[f"key_{c}" for c in LAP], "prediction")


# --- the same operators on other tables ----------------------------------------


@query
def star_usage_share(ws):
    items = ws.given("lineitem").withColumn("ship_year", F.year("l_shipdate"))
    return transform.share_of_group(items, ["ship_year"], ["l_returnflag"], "share_pct")


@query
def star_price_above_best(ws):
    items = ws.given("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_quantity")
    return transform.delta_to_best(items, ["l_orderkey"], {"price_delta": "l_extendedprice", "quantity_delta": "l_quantity"})


@query
def star_customer_rank(ws):
    customers = ws.given("customer").select("c_custkey", "c_nationkey", "c_acctbal")
    return rank_within(customers, ["c_nationkey"], "c_acctbal", "balance_rank", descending=True, dense=True)


@query
def star_rolling_orders(ws):
    day = F.unix_date(F.to_date("o_orderdate"))
    orders = ws.given("orders").select("o_custkey", day.alias("order_day"), "o_orderkey", "o_totalprice")
    rolled = transform.rolling_pace(orders, [], ["order_day", "o_orderkey"], driver="o_custkey", value="o_totalprice")
    return rolled.select("o_custkey", "o_orderkey", "race_pace_index", "race_pace_delta")


@query
def star_null_pct(ws):
    labelled = ws.given("documents").select("doc_id", "lang", "source", "n_chars").join(ws.given("labels"), "doc_id", "left")
    return quality.null_percentages(labelled)


@query
def star_duplicates(ws):
    return quality.duplicate_rows(ws.given("lineitem"), ["l_orderkey", "l_linenumber"])


@query
def star_invalid_values(ws):
    return quality.invalid_values(ws.given("customer"), "c_acctbal", 0.0, 9000.0)


@query
def star_medians(ws):
    return exact_medians(ws.given("lineitem"), ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])


@query
def star_trendline(ws):
    return features.trendlines(ws.given("lineitem"), ["l_suppkey"], "l_quantity", "l_extendedprice")


@query
def star_asof_orders(ws):
    items = ws.given("lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate",
        (F.col("l_suppkey") % 100).alias("lane"),
    )
    orders = ws.given("orders").groupBy((F.col("o_custkey") % 100).alias("lane"), "o_orderdate").agg(
        F.max("o_orderkey").alias("latest_order")
    )
    return assembly.asof_join(items, orders, ["lane"], "l_shipdate", "o_orderdate", ["latest_order"])

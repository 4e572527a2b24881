"""Plain SQL with the meaning of each registered query."""

from __future__ import annotations

import re

from ..operators.cleaning import MEDIAN_COLUMNS
from .oracle_laps import over_laps

ORACLE: dict[str, str] = {}

# --- derived tables ------------------------------------------------------------


def fitted(source: str, keys: str) -> str:
    """Stint summaries: the closed form of the minimum-norm fit on covariances."""
    x = {"1": "coalesce(tyre_life, 0)", "2": "coalesce(air_temp, 0)", "3": "coalesce(track_temp, 0)", "y": "coalesce(lap_time_seconds, 0)"}
    pairs = ["11", "12", "13", "22", "23", "33", "1y", "2y", "3y"]
    cov = ", ".join(f"covar_pop({x[p[0]]}, {x[p[1]]}) AS c{p}" for p in pairs)
    known = " AND ".join(f"{k.strip()} IS NOT NULL" for k in keys.split(","))
    return f"""
  SELECT {keys}, stint_length, CASE WHEN n < 4 OR NOT coalesce(youngest < stint_length, FALSE) THEN 0.0
    WHEN det > q * p * 1e-10 THEN
      (c1y * (c22 * c33 - c23 * c23) - c12 * (c2y * c33 - c23 * c3y) + c13 * (c2y * c23 - c22 * c3y)) / det
    WHEN q > p * p * 1e-10 THEN (p * c1y - (c11 * c1y + c12 * c2y + c13 * c3y)) / q
    ELSE c1y / p END AS tire_degradation_rate
  FROM (
    SELECT *, c11 + c22 + c33 AS p,
      (c11 * c22 - c12 * c12) + (c11 * c33 - c13 * c13) + (c22 * c33 - c23 * c23) AS q,
      c11 * (c22 * c33 - c23 * c23) - c12 * (c12 * c33 - c13 * c23) + c13 * (c12 * c23 - c13 * c22) AS det
    FROM (
      SELECT {keys}, count(*) AS n, min(tyre_life) AS youngest, max(tyre_life) AS stint_length, {cov}
      FROM {source} WHERE {known} GROUP BY {keys}))"""


STINTS = f"stints AS ({fitted('laps', 'race_name, driver, stint')})"
ENGINEERED = f"""{STINTS},
engineered AS (
  SELECT laps.*, grid_position - final_position AS position_change, stint_length, tire_degradation_rate
  FROM laps LEFT JOIN stints USING (race_name, driver, stint))"""

DRIVERS = """
driver_analytics AS (
  SELECT season, race_name, driver, avg(lap_time_seconds) AS avg_lap_time_seconds, min(lap_time_seconds) AS fastest_lap,
    stddev_samp(lap_time_seconds) AS lap_time_std, min(grid_position) AS grid_position, min(final_position) AS final_position,
    CASE WHEN coalesce(stddev_samp(lap_time_seconds), 0) = 0 THEN 0.0
      ELSE round(100.0 / stddev_samp(lap_time_seconds), 2) END AS consistency_index,
    min(grid_position) - min(final_position) AS position_change
  FROM laps GROUP BY season, race_name, driver)"""

USAGE = """
usage AS (
  SELECT season, race_name, compound, count(*) * 100.0::DOUBLE / sum(count(*)) OVER (PARTITION BY season, race_name) AS compound_usage_pct
  FROM laps GROUP BY season, race_name, compound)"""

TIRES = f"""{ENGINEERED}, {USAGE},
tire_analytics AS (
  SELECT e.season, e.race_name, e.driver, e.compound, avg(lap_time_seconds) AS avg_lap_time,
    avg(tire_degradation_rate) AS tire_degradation_rate, max(stint_length) AS max_stint_length, any_value(u.compound_usage_pct) AS compound_usage_pct
  FROM engineered e LEFT JOIN usage u ON e.season = u.season AND e.race_name = u.race_name AND e.compound = u.compound
  GROUP BY e.season, e.race_name, e.driver, e.compound)"""

ENTRIES = """
entries AS (
  SELECT * EXCLUDE (before, later), before AS pos_before_stop, coalesce(later, final_position) AS pos_after_stop,
    CAST(coalesce(coalesce(later, final_position) < before, FALSE) AS INTEGER) AS undercut_success_flag,
    before - coalesce(later, final_position) AS position_gain
  FROM (
    SELECT season, race_name, driver, lap_number, position, pit_in_time_seconds, final_position,
      lag(position) OVER w AS before, lead(position, 10) OVER w AS later
    FROM laps WINDOW w AS (PARTITION BY season, race_name, driver ORDER BY lap_number))
  WHERE pit_in_time_seconds IS NOT NULL)"""

PITS = f"""{ENTRIES},
pitstop_analytics AS (
  SELECT *, CASE WHEN pit_count BETWEEN 1 AND 3 THEN pit_count || '-stop' WHEN pit_count > 3 THEN '3+ stops' ELSE '0-stop' END AS strategy_type
  FROM (
    SELECT season, race_name, driver, count(lap_number) AS pit_count, avg(lap_number) AS avg_pit_window,
      coalesce(avg(undercut_success_flag), 0) AS undercut_success_rate, coalesce(avg(position_gain), 0) AS pit_stop_efficiency_score
    FROM entries GROUP BY season, race_name, driver))"""

GAINS = """
gains AS (
  SELECT season, race_name, driver, sum(before - position) AS driver_positions_gained
  FROM (SELECT *, lag(position) OVER (PARTITION BY season, race_name, driver ORDER BY lap_number) AS before FROM laps)
  WHERE lap_number > 1 AND position < before AND pit_in_time_seconds IS NULL AND pit_out_time_seconds IS NULL
  GROUP BY season, race_name, driver)"""

BENCHMARKS = """
benchmarks AS (
  SELECT season, race_name, min(sector1_time_seconds) AS fastest_sector1_time, min(sector2_time_seconds) AS fastest_sector2_time,
    min(sector3_time_seconds) AS fastest_sector3_time, avg(lap_time_seconds) AS avg_race_pace
  FROM laps GROUP BY season, race_name)"""

PACE = """
pace AS (
  SELECT *, CAST(rank() OVER (PARTITION BY season, race_name ORDER BY driver_avg_clean_lap_time ASC NULLS FIRST) AS INTEGER) AS race_pace_ranking
  FROM (
    SELECT season, race_name, driver, avg(lap_time_seconds) AS driver_avg_clean_lap_time
    FROM laps WHERE pit_in_time_seconds IS NULL AND pit_out_time_seconds IS NULL GROUP BY season, race_name, driver))"""

RACES = f"""{GAINS}, {BENCHMARKS}, {PACE},
race_analytics AS (
  SELECT season, race_name, driver, coalesce(driver_avg_clean_lap_time, 0) AS driver_avg_clean_lap_time, race_pace_ranking,
    coalesce(driver_positions_gained, 0) AS driver_positions_gained, coalesce(fastest_sector1_time, 0) AS fastest_sector1_time,
    coalesce(fastest_sector2_time, 0) AS fastest_sector2_time, coalesce(fastest_sector3_time, 0) AS fastest_sector3_time,
    coalesce(avg_race_pace, 0) AS avg_race_pace, coalesce(total, 0) AS estimated_positions_gained
  FROM pace LEFT JOIN gains USING (season, race_name, driver) LEFT JOIN benchmarks USING (season, race_name)
  LEFT JOIN (SELECT season, race_name, sum(driver_positions_gained) AS total FROM gains GROUP BY season, race_name) USING (season, race_name))"""


def _nanos(source: str, name: str) -> str:
    return f'CAST(round({source} * 1000) AS BIGINT) * 1000000 AS "{name}"'


RAW = f"""
raw AS (
  SELECT season, race_name, CASE WHEN event_id % 29 <> 0 THEN driver END AS driver, driver_number, team, lap_number,
    CAST(stint AS DOUBLE) AS stint, {_nanos('lap_time_seconds', 'lap_time')}, {_nanos('sector1_time_seconds', 'sector1_time')},
    {_nanos('sector2_time_seconds', 'sector2_time')}, {_nanos('sector3_time_seconds', 'sector3_time')},
    {_nanos('pit_in_time_seconds', 'pit_in_time')}, {_nanos('pit_out_time_seconds', 'pit_out_time')},
    epoch_us(ts) * 1000 + event_id % 1000 AS lap_start_date, ts AS started,
    CASE WHEN event_id % 23 <> 0 THEN compound END AS compound,
    CASE WHEN event_id % 17 = 0 THEN 'NaN'::DOUBLE ELSE tyre_life END AS tyre_life,
    CASE WHEN event_id % 19 = 0 THEN 'NaN'::DOUBLE ELSE position END AS position,
    CASE WHEN event_id % 11 = 0 THEN 'NaN'::DOUBLE ELSE air_temp END AS air_temp, track_temp,
    NULL::DOUBLE AS humidity, rainfall, CASE WHEN event_id % 13 = 0 THEN 'TRACK LIMITS' END AS deleted_reason,
    CASE WHEN event_id % 5 = 0 THEN 'NaN'::DOUBLE ELSE grid_position END AS grid_position,
    CASE WHEN event_id % 5 = 1 THEN 'NaN'::DOUBLE ELSE final_position END AS final_position
  FROM laps)"""

DURATIONS = ["lap_time", "sector1_time", "sector2_time", "sector3_time", "pit_in_time", "pit_out_time"]
HOLED = ["tyre_life", "position", "air_temp", "grid_position", "final_position"]
TYPED = f"""{RAW},
typed AS (
  SELECT * EXCLUDE ({', '.join(DURATIONS)}, lap_start_date) REPLACE ({', '.join(f'CASE WHEN NOT isnan({c}) THEN {c} END AS {c}' for c in HOLED)}),
    started AS lap_start_date, {', '.join(f'{c} / 1e9::DOUBLE AS {c}_seconds' for c in DURATIONS)}
  FROM raw)"""

RAW_COLUMNS = [
    "season", "race_name", "driver", "driver_number", "team", "lap_number", "stint", *DURATIONS, "lap_start_date", "compound",
    "tyre_life", "position", "air_temp", "track_temp", "humidity", "rainfall", "deleted_reason", "grid_position", "final_position",
]
TYPED_COLUMNS = [c for c in RAW_COLUMNS if c not in DURATIONS] + [f"{c}_seconds" for c in DURATIONS]
FILLED = [c for c in MEDIAN_COLUMNS if c in TYPED_COLUMNS]

OVERRIDES = """
overrides AS (
  SELECT DISTINCT race_name, driver_number, CAST(driver_number AS INTEGER) + 1.0::DOUBLE AS o_grid, 20.0::DOUBLE - CAST(driver_number AS INTEGER) AS o_final
  FROM laps WHERE CAST(driver_number AS INTEGER) % 3 = 0)"""


def _filled(source: str) -> str:
    medians = ", ".join(f"coalesce({c}, (SELECT median({c}) FROM {source}), 0.0) AS {c}" for c in FILLED)
    return f"""SELECT * REPLACE ({medians}) FROM {source}"""


CLEANED = f"""{TYPED}, {OVERRIDES},
placed AS (
  SELECT typed.* EXCLUDE (grid_position, final_position), coalesce(o_grid, grid_position) AS grid_position,
    coalesce(o_final, final_position) AS final_position
  FROM typed LEFT JOIN overrides USING (race_name, driver_number)),
numbered AS ({_filled('placed')}),
cleaned AS (
  SELECT * REPLACE (coalesce(driver, 'Unknown') AS driver, coalesce(compound, 'Unknown') AS compound, coalesce(team, 'Unknown') AS team,
    coalesce(deleted_reason, 'Not Deleted') AS deleted_reason)
  FROM numbered)"""

WEATHER = """
weather AS (
  SELECT season, race_name, ts, CAST(max(event_id) AS DOUBLE) AS sample FROM ev WHERE event_type = 'view' GROUP BY season, race_name, ts)"""
SCHEDULE = """
schedule AS (
  SELECT DISTINCT season, CAST(substr(race_name, 2) AS INTEGER) AS round, race_name FROM ev)"""
RESULTS = """
results AS (
  SELECT season, race_name, driver_number,
    CASE WHEN race_name <> 'R1' THEN max(grid_position) END AS grid_position,
    CASE WHEN race_name <> 'R1' THEN max(final_position) END AS final_position,
    CASE WHEN max(lap_number) >= 40 THEN 'Finished' ELSE 'Retired' END AS status
  FROM laps GROUP BY season, race_name, driver_number),
complete AS (
  SELECT r.season, r.race_name, r.driver_number, r.status,
    CASE WHEN count(r.final_position) OVER race = 0 THEN l.last_position ELSE r.final_position END AS final_position,
    CASE WHEN count(r.grid_position) OVER race = 0
      THEN coalesce(l.first_position, CASE WHEN count(r.final_position) OVER race = 0 THEN l.last_position ELSE r.final_position END)
      ELSE r.grid_position END AS grid_position
  FROM results r LEFT JOIN (
    SELECT season, race_name, driver_number, arg_max(position, lap_number) FILTER (position IS NOT NULL) AS last_position,
      max(position) FILTER (lap_number = 1) AS first_position
    FROM laps GROUP BY season, race_name, driver_number) l USING (season, race_name, driver_number)
  WINDOW race AS (PARTITION BY r.season, r.race_name))"""


# --- output --------------------------------------------------------------------


def tidy(column: str) -> str:
    """Six places, off the rounding boundary, without negative zero."""
    return f"round({column} + 1e-9::DOUBLE, 6) + 0.0"


def shown(columns: str) -> str:
    """Select list; a trailing * marks a double, rounded like the Spark side."""
    items = []
    for c in columns.split():
        items.append(f"{tidy(c[:-1])} AS {c[:-1]}" if c.endswith("*") else c)
    return ", ".join(items)


def laps_query(name: str, columns: str, source: str, *ctes: str) -> None:
    ORACLE[name] = over_laps(f"SELECT {shown(columns)} FROM {source}", *ctes)


LAP = "season race_name driver lap_number*"
RACE = "season race_name"

laps_query(
    "lap_table",
    f"{LAP} event_id ts cum_cents driver_number team position* grid_position* final_position* stint tyre_life* compound lap_time_seconds* "
    "sector1_time_seconds* sector2_time_seconds* sector3_time_seconds* pit_in_time_seconds* pit_out_time_seconds* air_temp* track_temp* rainfall",
    "laps",
)

DRIVER_COLUMNS = (
    "season race_name driver avg_lap_time_seconds* fastest_lap* lap_time_std* grid_position* final_position* consistency_index* position_change*"
)
RACE_COLUMNS = (
    "season race_name driver driver_avg_clean_lap_time* race_pace_ranking driver_positions_gained* fastest_sector1_time* fastest_sector2_time* "
    "fastest_sector3_time* avg_race_pace* estimated_positions_gained*"
)
PIT_COLUMNS = "season race_name driver pit_count avg_pit_window* undercut_success_rate* pit_stop_efficiency_score* strategy_type"
laps_query("driver_analytics", DRIVER_COLUMNS, "driver_analytics", DRIVERS)
TIRE_COLUMNS = "season race_name driver compound avg_lap_time* tire_degradation_rate* max_stint_length* compound_usage_pct*"
laps_query("tire_analytics", TIRE_COLUMNS, "tire_analytics", TIRES)
laps_query("pitstop_analytics", PIT_COLUMNS, "pitstop_analytics", PITS)
laps_query("race_analytics", RACE_COLUMNS, "race_analytics", RACES)
laps_query("compound_usage", f"{RACE} compound compound_usage_pct*", "usage", USAGE)
laps_query(
    "pit_position_delta",
    f"{LAP} position* pit_in_time_seconds* final_position* pos_before_stop* pos_after_stop* undercut_success_flag position_gain*",
    "entries", ENTRIES,
)
laps_query("positions_gained", f"{RACE} driver driver_positions_gained*", "gains", GAINS)
laps_query(
    "race_benchmarks", f"{RACE} fastest_sector1_time* fastest_sector2_time* fastest_sector3_time* avg_race_pace*", "benchmarks", BENCHMARKS
)
laps_query("clean_pace", f"{RACE} driver driver_avg_clean_lap_time*", "pace", PACE)
laps_query("race_pace_rank", f"{RACE} driver driver_avg_clean_lap_time* race_pace_ranking", "pace", PACE)

RANKED = """
ranked AS (
  SELECT *, CAST(dense_rank() OVER (PARTITION BY race_name ORDER BY consistency_index DESC NULLS LAST) AS INTEGER) AS consistency_rank
  FROM driver_analytics)"""
RANK_COLUMNS = "race_name driver lap_time_std* consistency_index* consistency_rank"
laps_query("sql_consistency_rank", RANK_COLUMNS, "ranked", DRIVERS, RANKED)
laps_query("topk_consistency", RANK_COLUMNS, "ranked WHERE consistency_rank <= 5", DRIVERS, RANKED)
laps_query(
    "sql_positions_gained", "race_name driver grid_position* final_position* position_change*", "driver_analytics WHERE position_change > 0", DRIVERS
)
laps_query(
    "sql_compound_performance",
    "compound global_avg_lap_time_seconds* avg_degradation_rate_seconds_per_lap* max_observed_stint_laps* avg_compound_usage_pct*",
    """(SELECT compound, round(avg(avg_lap_time), 3) AS global_avg_lap_time_seconds,
      round(avg(tire_degradation_rate), 4) AS avg_degradation_rate_seconds_per_lap, max(max_stint_length) AS max_observed_stint_laps,
      round(avg(compound_usage_pct), 2) AS avg_compound_usage_pct FROM tire_analytics GROUP BY compound)""",
    TIRES,
)
laps_query(
    "sql_pit_efficiency",
    "race_name driver pit_count avg_pit_window* strategy_type undercut_success_percentage* pit_stop_efficiency_score*",
    "(SELECT *, round(undercut_success_rate * 100.0, 1) AS undercut_success_percentage FROM pitstop_analytics)",
    PITS,
)
for _name, _keys in (("sql_pace_vs_result", "race_name, driver"), ("sql_pace_vs_result_by_season", "season, race_name, driver")):
    laps_query(
        _name,
        f"{_keys.replace(',', '')} race_pace_ranking driver_avg_clean_lap_time* final_position* pace_to_result_delta*",
        f"""(SELECT *, final_position - race_pace_ranking AS pace_to_result_delta
          FROM race_analytics JOIN driver_analytics USING ({_keys}))""",
        DRIVERS, RACES,
    )
SECTORS = """
sectors AS (
  SELECT race_name, round(min(fastest_sector1_time), 3) AS theoretical_fastest_s1, round(min(fastest_sector2_time), 3) AS theoretical_fastest_s2,
    round(min(fastest_sector3_time), 3) AS theoretical_fastest_s3,
    round(min(fastest_sector1_time + fastest_sector2_time + fastest_sector3_time), 3) AS theoretical_lap_record,
    round(avg(avg_race_pace), 3) AS overall_average_race_pace, sum(estimated_positions_gained) AS total_on_track_overtakes
  FROM race_analytics GROUP BY race_name),
once AS (
  SELECT race_name, sum(gains) AS gains_once
  FROM (SELECT race_name, season, max(estimated_positions_gained) AS gains FROM race_analytics GROUP BY race_name, season) GROUP BY race_name)"""
SECTOR_COLUMNS = (
    "race_name theoretical_fastest_s1* theoretical_fastest_s2* theoretical_fastest_s3* theoretical_lap_record* overall_average_race_pace* "
    "total_on_track_overtakes*"
)
laps_query("sql_sector_benchmarks", SECTOR_COLUMNS, "sectors", RACES, SECTORS)
laps_query(
    "sql_sector_benchmarks_once", SECTOR_COLUMNS,
    "(SELECT * REPLACE (gains_once AS total_on_track_overtakes) FROM sectors JOIN once USING (race_name))", RACES, SECTORS,
)

# --- lap-level measures --------------------------------------------------------


def measured(source: str, race: str, lap_order: str, driver: str = "driver") -> str:
    """Lap rows with sector deltas, rolling pace and score for the given race keys."""
    best = ", ".join(
        f"sector{i}_time_seconds - min(sector{i}_time_seconds) OVER (PARTITION BY {race}, lap_number) AS sector{i}_delta" for i in (1, 2, 3)
    )
    return f"""
measured AS (
  SELECT *, lap_time_seconds - race_pace_index AS race_pace_delta
  FROM (
    SELECT *, {best},
      avg(lap_time_seconds) OVER (PARTITION BY {race}, {driver} ORDER BY {lap_order} ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS race_pace_index,
      avg(lap_time_seconds) OVER (PARTITION BY {race}) / avg(lap_time_seconds) OVER (PARTITION BY {race}, {driver}) * 100 AS circuit_performance_score
    FROM {source}))"""


PLAIN, SEASONAL = measured("laps", "race_name", "lap_number, season"), measured("laps", "season, race_name", "lap_number")
DELTA_COLUMNS = f"{LAP} sector1_delta* sector2_delta* sector3_delta*"
for _suffix, _cte in (("", PLAIN), ("_by_season", SEASONAL)):
    laps_query(f"sector_deltas{_suffix}", DELTA_COLUMNS, "measured", _cte)
    laps_query(f"rolling_pace{_suffix}", f"{LAP} lap_time_seconds* race_pace_index* race_pace_delta*", "measured", _cte)
    laps_query(f"performance_score{_suffix}", f"{LAP} lap_time_seconds* circuit_performance_score*", "measured", _cte)
laps_query("transform_laps", f"{DELTA_COLUMNS} race_pace_index* race_pace_delta* circuit_performance_score*", "measured", PLAIN)
laps_query("position_change", f"{LAP} position_change*", "engineered", ENGINEERED)
laps_query("stint_length", f"{LAP} stint stint_length*", "engineered", ENGINEERED)
laps_query("degradation_rate", "race_name driver stint stint_length* tire_degradation_rate*", "stints", STINTS)
laps_query(
    "degradation_rate_by_season", "season race_name driver stint stint_length* tire_degradation_rate*", "stints",
    f"stints AS ({fitted('laps', 'season, race_name, driver, stint')})",
)
laps_query("engineer_laps", f"{LAP} stint position_change* stint_length* tire_degradation_rate*", "engineered", ENGINEERED)

# --- cleaning and quality ------------------------------------------------------

RAW_LAP = "season race_name driver_number lap_number*"
DOUBLES = {"lap_number", "stint", "tyre_life", "position", "air_temp", "track_temp", "humidity", "grid_position", "final_position"}


def starred(columns: list[str]) -> str:
    return " ".join(c + ("*" if c in DOUBLES or c.endswith("_seconds") else "") for c in columns)


laps_query("snake_case_rename", starred([c for c in RAW_COLUMNS if c != "humidity"]), "raw", RAW)
ORACLE["snake_case_values"] = """
SELECT c_custkey, camel, lower(regexp_replace(regexp_replace(camel, '(.)([A-Z][a-z]+)', '\\1_\\2', 'g'), '([a-z0-9])([A-Z])', '\\1_\\2', 'g')) AS snake
FROM (SELECT c_custkey, upper(c_mktsegment[1]) || lower(substr(c_mktsegment, 2)) || 'Segment' || c_nationkey || 'Name' AS camel FROM customer)"""
laps_query("duration_to_seconds", f"{RAW_LAP} " + " ".join(f"{c}_seconds*" for c in DURATIONS), "typed", TYPED)
laps_query("timestamp_to_micros", f"{RAW_LAP} lap_start_date", "typed", TYPED)
laps_query(
    "override_lookup", f"{LAP} driver_number grid_position* final_position*",
    """(SELECT l.* REPLACE (coalesce(o_grid, grid_position) AS grid_position, coalesce(o_final, final_position) AS final_position)
      FROM laps l LEFT JOIN overrides o ON l.race_name = o.race_name AND l.driver_number = o.driver_number)""",
    OVERRIDES,
)
laps_query(
    "impute_median", f"{RAW_LAP} {' '.join(c + '*' for c in FILLED)}", f"({_filled('typed')})", TYPED
)
ORACLE["column_medians"] = over_laps(
    f"SELECT \"column\", {tidy('median')} AS median FROM ("
    + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", median({c}) AS median FROM typed" for c in FILLED)
    + ") WHERE median IS NOT NULL",
    TYPED,
)
laps_query(
    "impute_categorical", f"{RAW_LAP} driver compound team deleted_reason",
    """(SELECT * REPLACE (coalesce(driver, 'Unknown') AS driver, coalesce(compound, 'Unknown') AS compound, coalesce(team, 'Unknown') AS team,
      coalesce(deleted_reason, 'Not Deleted') AS deleted_reason) FROM raw)""",
    RAW,
)
laps_query("clean_laps", starred(TYPED_COLUMNS), "cleaned", CLEANED)
def cleaned(cte: str, driver: str = "driver") -> str:
    """A CTE over the lap table, read from the cleaned laps instead."""
    return re.sub(r"\bdriver\b", driver, re.sub(r"\blaps\b", "cleaned", cte))


laps_query(
    "silver_pipeline",
    f"{RAW_LAP} position_change* stint_length* tire_degradation_rate* sector1_delta* sector2_delta* sector3_delta* "
    "race_pace_index* race_pace_delta* circuit_performance_score*",
    "(SELECT m.*, grid_position - final_position AS position_change, stint_length, tire_degradation_rate "
    "FROM measured m LEFT JOIN stints USING (race_name, driver, stint))",
    CLEANED, cleaned(STINTS), measured("cleaned", "race_name", "lap_number, season, driver_number"),
)
laps_query("gold_from_raw_driver", DRIVER_COLUMNS, "driver_analytics", CLEANED, cleaned(DRIVERS))
laps_query("gold_from_raw_tire", TIRE_COLUMNS, "tire_analytics", CLEANED, cleaned(TIRES))
laps_query("gold_from_raw_pitstop", cleaned(PIT_COLUMNS, "driver_number"), "pitstop_analytics", CLEANED, cleaned(PITS, "driver_number"))
laps_query("gold_from_raw_race", cleaned(RACE_COLUMNS, "driver_number"), "race_analytics", CLEANED, cleaned(RACES, "driver_number"))


def null_share(columns: list[str], source: str, doubles: set[str], label: str = "column_name", value: str = "null_pct") -> str:
    def missing(c: str) -> str:
        return f"{c} IS NULL OR isnan({c})" if c in doubles else f"{c} IS NULL"

    return " UNION ALL ".join(
        f"SELECT '{c}' AS {label}, {tidy(f'avg(CASE WHEN {missing(c)} THEN 1.0 ELSE 0.0 END) * 100')} AS {value} FROM {source}" for c in columns
    )


REPEATED = """SELECT coalesce(sum(n), 0)::BIGINT AS duplicate_rows FROM (
  SELECT count(*) AS n FROM {source} WHERE {known} GROUP BY {keys} HAVING count(*) > 1)"""


def repeated(source: str, *keys: str) -> str:
    return REPEATED.format(source=source, keys=", ".join(keys), known=" AND ".join(f"{k} IS NOT NULL" for k in keys))


ORACLE["dq_null_pct"] = over_laps(null_share(RAW_COLUMNS, "raw", DOUBLES), RAW)
ORACLE["dq_duplicates"] = over_laps(repeated("raw", "race_name", "driver", "lap_number"), RAW)
ORACLE["dq_invalid_values"] = over_laps(
    "SELECT count(*) AS invalid_rows FROM typed WHERE lap_time_seconds <= 0 OR lap_time_seconds > 300", TYPED
)
ORACLE["dq_invalid_categories"] = "SELECT DISTINCT event_type FROM events WHERE upper(event_type) NOT IN ('VIEW', 'CLICK', 'PURCHASE')"
ORACLE["dq_report"] = over_laps(
    f"""SELECT 'row_count' AS measure, NULL::VARCHAR AS item, count(*)::DOUBLE AS value FROM typed
UNION ALL SELECT 'column_count', NULL, {float(len(TYPED_COLUMNS))}::DOUBLE
UNION ALL SELECT 'invalid_lap_times', NULL, count(*)::DOUBLE FROM typed WHERE lap_time_seconds <= 0 OR lap_time_seconds > 300
UNION ALL SELECT 'duplicate_laps', NULL, duplicate_rows::DOUBLE FROM ({repeated('typed', 'race_name', 'driver', 'lap_number')})
UNION ALL SELECT 'null_percentages', column_name, null_pct FROM ({null_share(TYPED_COLUMNS, 'typed', set())})
UNION ALL SELECT 'invalid_tire_compounds', compound, NULL FROM (SELECT DISTINCT compound FROM typed
  WHERE upper(compound) NOT IN ('SOFT', 'MEDIUM', 'HARD', 'INTERMEDIATE', 'WET', 'UNKNOWN'))""",
    TYPED,
)

ORACLE["dq_document"] = over_laps(
    f"""SELECT n AS row_count, {len(TYPED_COLUMNS)}::BIGINT AS column_count, duplicate_rows AS duplicate_laps, bad AS invalid_lap_times,
  coalesce(wrong, '') AS invalid_tire_compounds, column_name, null_pct
FROM (SELECT count(*) AS n, count(*) FILTER (lap_time_seconds <= 0 OR lap_time_seconds > 300) AS bad,
    string_agg(DISTINCT compound, ',' ORDER BY compound) FILTER (upper(compound) NOT IN ('SOFT', 'MEDIUM', 'HARD', 'INTERMEDIATE', 'WET', 'UNKNOWN')) AS wrong FROM typed),
  ({repeated('typed', 'race_name', 'driver', 'lap_number')}), ({null_share(TYPED_COLUMNS, 'typed', set())})""",
    TYPED,
)

# --- assembly, selection, sinks ------------------------------------------------

ORACLE["union_by_name"] = over_laps(
    f"""SELECT {shown(LAP + ' air_temp* tyre_life*')} FROM (
  SELECT season, race_name, driver, lap_number, air_temp FROM laps WHERE season = 2023
  UNION ALL BY NAME SELECT tyre_life, season, race_name, driver, lap_number FROM laps WHERE season <> 2023)"""
)
ASOF = "(SELECT l.*, w.sample FROM {laps} l ASOF LEFT JOIN weather w ON l.season = w.season AND l.race_name = w.race_name AND l.ts >= w.ts)"
laps_query("asof_weather", f"{LAP} ts sample*", ASOF.format(laps="laps"), WEATHER)
laps_query("position_fallback", f"{RACE} driver_number status grid_position* final_position*", "complete", RESULTS)
laps_query(
    "lap_assembly",
    f"{LAP} driver_number position* ts sample* status grid_position* final_position* session_type",
    f"""(SELECT a.* EXCLUDE (grid_position, final_position), c.status, c.grid_position, c.final_position, 'R' AS session_type
      FROM {ASOF.format(laps='laps')} a LEFT JOIN complete c USING (season, race_name, driver_number))""",
    WEATHER, RESULTS,
)
ORACLE["select_first_n"] = over_laps(
    """SELECT season, race_name, 'R' AS session_type FROM schedule WHERE round > 0
QUALIFY row_number() OVER (PARTITION BY season ORDER BY round, race_name) <= 3""",
    SCHEDULE,
)
laps_query("select_specific", LAP, "laps WHERE race_name IN ('R1', 'R3')")
ORACLE["select_season"] = over_laps("SELECT season, race_name, 'R' AS session_type FROM schedule WHERE round > 0", SCHEDULE)
ORACLE["race_slug"] = over_laps(
    """SELECT season, race_name AS "EventName", 'processed_' || replace(lower('Grand Prix ' || race_name), ' ', '_') || '_' || season AS slug FROM schedule""",
    SCHEDULE,
)
ORACLE["race_label"] = over_laps("SELECT DISTINCT season || ' - ' || race_name AS race_display, season, race_name FROM laps")
laps_query("partitioned_write_read", PIT_COLUMNS, "pitstop_analytics", PITS)
laps_query("catalog_roundtrip", RACE_COLUMNS, "race_analytics", RACES)
ORACLE["per_group_split"] = over_laps(
    f"SELECT {shown(LAP)}, 'processed_' || lower(race_name) || '_' || season AS race_slug FROM laps WHERE race_name <> 'R0'"
)

ORACLE["saved_selection"] = over_laps(
    f"""SELECT {shown(LAP)} FROM laps WHERE season = 2023 AND race_name IN (
  SELECT race_name FROM schedule WHERE season = 2023 AND round > 0 ORDER BY round LIMIT 2)""",
    SCHEDULE,
)
ORACLE["raw_race_read"] = over_laps(
    f"""SELECT season, race_name, driver AS "Driver", {tidy('lap_number')} AS "LapNumber", lap_time AS "LapTime", compound AS "Compound",
  {tidy('CASE WHEN NOT isnan(tyre_life) THEN tyre_life END')} AS "TyreLife", {tidy('CASE WHEN NOT isnan(position) THEN position END')} AS "Position" FROM raw""",
    RAW,
)
ORACLE["single_race_read"] = f"SELECT * FROM ({ORACLE['raw_race_read']}) WHERE season = 2023 AND race_name = 'R1'"

# --- analysis pages ------------------------------------------------------------

ORACLE["race_overview"] = over_laps(
    f"""SELECT season, race_name, winner, winner_team, fastest_driver, {tidy('fastest_lap')} AS fastest_lap, total_laps,
  CAST(coalesce(gained, 0) AS INTEGER) AS total_gains
FROM (SELECT season, race_name, CAST(max(lap_number) AS INTEGER) AS total_laps FROM laps GROUP BY season, race_name)
LEFT JOIN (SELECT season, race_name, min(driver) AS winner FROM driver_analytics WHERE final_position = 1 GROUP BY season, race_name) USING (season, race_name)
LEFT JOIN (SELECT season, race_name, driver AS winner, min(team) AS winner_team FROM laps GROUP BY season, race_name, driver) USING (season, race_name, winner)
LEFT JOIN (SELECT season, race_name, driver AS fastest_driver, fastest_lap FROM driver_analytics WHERE fastest_lap IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY season, race_name ORDER BY fastest_lap, driver) = 1) USING (season, race_name)
LEFT JOIN (SELECT season, race_name, max(estimated_positions_gained) AS gained FROM race_analytics GROUP BY season, race_name) USING (season, race_name)""",
    DRIVERS, RACES,
)
LABEL = "season || ' - ' || race_name AS race_display"
laps_query("position_series", f"{RACE} driver team lap_number* position*", "laps")
ORACLE["driver_pace_series"] = over_laps(f"SELECT {LABEL}, {shown('driver lap_number* lap_time_seconds*')} FROM laps")
ORACLE["driver_comparison"] = over_laps(
    f"SELECT {LABEL}, {shown('driver consistency_index* position_change*')} FROM driver_analytics", DRIVERS
)
ORACLE["ols_trendline"] = over_laps(
    f"""SELECT {shown(RACE + ' compound driver slope* intercept* r2* laps')} FROM (
  SELECT season, race_name, compound, driver, nullif(regr_slope(lap_time_seconds, tyre_life), 'NaN'::DOUBLE) AS slope,
    regr_intercept(lap_time_seconds, tyre_life) AS intercept, regr_r2(lap_time_seconds, tyre_life) AS r2, count(*) AS laps
  FROM laps WHERE lap_time_seconds IS NOT NULL AND tyre_life IS NOT NULL GROUP BY season, race_name, compound, driver)"""
)
laps_query("one_race_page", DRIVER_COLUMNS, "driver_analytics WHERE season = 2023 AND race_name = 'R1'", DRIVERS)
for _name, _whole, _chosen in (
    ("chosen_drivers_pace", "driver_pace_series", "driver IN ('D1', 'D7', 'D12')"),
    ("chosen_drivers_comparison", "driver_comparison", "driver IN ('D1', 'D7', 'D12')"),
    ("chosen_compound_trendline", "ols_trendline", "compound = 'SOFT'"),
):
    ORACLE[_name] = f"SELECT * FROM ({ORACLE[_whole]}) WHERE {_chosen}"
ORACLE["distinct_races"] = over_laps(f"SELECT DISTINCT season, race_name, {LABEL} FROM laps")
ORACLE["distinct_values"] = over_laps("SELECT DISTINCT driver FROM laps")
laps_query("distinct_usage", f"{RACE} compound compound_usage_pct*", "usage", USAGE)
laps_query("stint_page", f"{RACE} driver compound max_stint_length* tire_degradation_rate*", "tire_analytics", TIRES)
laps_query("pit_entry_laps", f"{LAP} compound", "laps WHERE pit_in_time_seconds IS NOT NULL")
ORACLE["strategy_distribution"] = over_laps(
    "SELECT season, race_name, strategy_type, count(*) AS driver_count FROM pitstop_analytics GROUP BY season, race_name, strategy_type", PITS
)
laps_query("pit_efficiency_sorted", f"{RACE} driver pit_stop_efficiency_score* undercut_success_rate*", "pitstop_analytics", PITS)
laps_query(
    "undercut_mean", f"{RACE} avg_undercut_pct*",
    "(SELECT season, race_name, avg(undercut_success_rate) * 100 AS avg_undercut_pct FROM pitstop_analytics GROUP BY season, race_name)", PITS,
)
laps_query(
    "heuristic_lap_time", f"{LAP} predicted_lap_time*",
    """(SELECT *, 85.0::DOUBLE + tyre_life * (CASE compound WHEN 'SOFT' THEN 0.08 WHEN 'MEDIUM' THEN 0.05 ELSE 0.03 END)::DOUBLE
      - 0.01::DOUBLE * lap_number + 0.02::DOUBLE * (track_temp - 30) + CASE WHEN rainfall THEN 10.0 ELSE 0.0 END AS predicted_lap_time FROM laps)""",
)

# --- model ---------------------------------------------------------------------

KEYS = "season AS key_season, race_name AS key_race_name, driver AS key_driver, lap_number + 0.0 AS key_lap_number"
ORACLE["ml_features"] = over_laps(
    f"""SELECT {KEYS}, tyre_life + 0.0 AS "TyreLife", compound AS "Compound", lap_number + 0.0 AS "LapNumber", race_name AS "Circuit", driver AS "Driver",
  air_temp + 0.0 AS "AirTemp", track_temp + 0.0 AS "TrackTemp", CAST(rainfall AS DOUBLE) AS "Rainfall",
  {tidy('coalesce(lap_time_seconds, (SELECT median(lap_time_seconds) FROM laps))')} AS "LapTime" FROM laps"""
)
ORACLE["ml_split"] = over_laps(
    f"""SELECT {KEYS}, CASE WHEN ('0x' || substr(md5(concat_ws('|', season, race_name, driver, lap_number, '42')), 1, 8))::BIGINT % 100 < 20
  THEN 'holdout' ELSE 'train' END AS part FROM laps"""
)

ORACLE["ml_scored_rows"] = over_laps(f"SELECT {KEYS}, TRUE AS scored FROM laps")
ORACLE["ml_evaluated_rows"] = f"SELECT count(*) AS rows, TRUE AS consistent FROM ({ORACLE['ml_split']}) WHERE part = 'holdout'"


ORACLE["dq_observed"] = f"SELECT * FROM ({ORACLE['dq_report']}) WHERE measure <> 'duplicate_laps'"

# --- gold tables after a refresh -----------------------------------------------

CORRECTED = """
corrected AS (
  SELECT * REPLACE (CASE WHEN season = 2023 AND race_name = 'R2' AND lap_number::INT % 2 = 0 THEN lap_time_seconds + 1 ELSE lap_time_seconds END AS lap_time_seconds)
  FROM laps WHERE NOT (season = 2024 AND race_name = 'R4'))"""


def over_corrected(ctes: str) -> str:
    return f"{CORRECTED},\n{ctes.replace('FROM laps', 'FROM corrected')}"


laps_query("refreshed_driver_analytics", DRIVER_COLUMNS, "driver_analytics", over_corrected(DRIVERS))
laps_query("refreshed_pitstop_analytics", PIT_COLUMNS, "pitstop_analytics", over_corrected(PITS))
ORACLE["refreshed_changes"] = over_laps(
    """SELECT season, race_name, CASE race_name WHEN 'R2' THEN 'changed' WHEN 'R3' THEN 'new' ELSE 'gone' END AS change
  FROM (SELECT DISTINCT season, race_name FROM laps) WHERE (season = 2023 AND race_name = 'R2') OR (season = 2024 AND race_name IN ('R3', 'R4'))"""
)
ORACLE["sketched_medians"] = over_laps(
    " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count({c}) AS n, TRUE AS near_middle FROM corrected" for c in ("lap_time_seconds", "tyre_life", "track_temp")),
    CORRECTED,
)


def model_parts(gaps: bool) -> str:
    """CTEs ``coded`` (inputs as numbers, target, part) and ``train``: labels as places in the alphabet of the training part."""
    air = "CASE WHEN lap_number::INT % 3 <> 0 THEN air_temp END" if gaps else "air_temp"
    life = "CASE WHEN lap_number::INT % 2 = 0 OR tyre_life <= 20 THEN tyre_life END" if gaps else "tyre_life"
    labels = [("Compound", "compound"), ("Circuit", "race_name"), ("Driver", "driver")]
    codes = ", ".join(f"""CASE WHEN {c} IS NOT NULL THEN coalesce((SELECT code FROM label_codes k WHERE k.input = '{i}' AND k.label = p.{c}), -1.0) END::DOUBLE AS in_{i}""" for i, c in labels)
    seen = " UNION ALL ".join(f"SELECT '{i}' AS input, label, dense_rank() OVER (ORDER BY label) - 1.0 AS code FROM (SELECT DISTINCT {c} AS label FROM parted WHERE part = 'train')" for i, c in labels)
    return f"""parted AS (
  SELECT *, coalesce(lap_time_seconds, (SELECT median(lap_time_seconds) FROM laps)) AS y,
    CASE WHEN ('0x' || substr(md5(concat_ws('|', season, race_name, driver, lap_number, '42')), 1, 8))::BIGINT % 100 < 20 THEN 'holdout' ELSE 'train' END AS part
  FROM laps),
label_codes AS ({seen}),
coded AS (
  SELECT season, race_name, driver, lap_number, part, y, {codes}, ({life})::DOUBLE AS in_TyreLife, lap_number::DOUBLE AS in_LapNumber, ({air})::DOUBLE AS in_AirTemp,
    track_temp::DOUBLE AS in_TrackTemp, rainfall::DOUBLE AS in_Rainfall FROM parted p),
train AS (SELECT * FROM coded WHERE part = 'train')"""


INPUTS = ["Compound", "Circuit", "Driver", "TyreLife", "LapNumber", "AirTemp", "TrackTemp", "Rainfall"]


def first_cut(gaps: bool) -> str:
    """CTE ``best``: of all cuts at quantiles, missing rows on either side, the one that wins most squares."""
    tall = " UNION ALL ".join(f"""SELECT {i} AS nth, '{c}' AS feature, in_{c} AS x, y - (SELECT avg(y) FROM train) AS g FROM train""" for i, c in enumerate(INPUTS))
    return model_parts(gaps) + f""",
tall AS ({tall}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY nth ORDER BY x) AS r, count(*) OVER (PARTITION BY nth) AS n FROM tall WHERE x IS NOT NULL),
cuts AS (SELECT DISTINCT nth, feature, x AS threshold FROM ranked WHERE r * 256 // n > (r - 1) * 256 // n),
sums AS (
  SELECT c.nth, c.feature, threshold, m.missing_left,
    sum(CASE WHEN x <= threshold OR (x IS NULL AND m.missing_left) THEN g ELSE 0 END) AS gl,
    count(CASE WHEN x <= threshold OR (x IS NULL AND m.missing_left) THEN 1 END) AS nl, sum(g) AS ga, count(*) AS na
  FROM cuts c JOIN tall t ON c.nth = t.nth CROSS JOIN (VALUES (TRUE), (FALSE)) m(missing_left) GROUP BY ALL),
gains AS (SELECT *, gl * gl / (nl + 1) + (ga - gl) * (ga - gl) / (na - nl + 1) - ga * ga / (na + 1) AS gain FROM sums WHERE nl > 0 AND nl < na),
best AS (SELECT * FROM gains ORDER BY round(gain, 4) DESC, nth, threshold, missing_left DESC LIMIT 1)"""


FIRST_CUT = f"""SELECT feature, {tidy('threshold')} AS threshold, missing_left, {tidy('gain')} AS gain, na AS rows, nl AS left_rows, na - nl AS right_rows FROM best"""
ORACLE["ml_first_split"] = over_laps(FIRST_CUT, first_cut(False))
ORACLE["ml_first_split_gaps"] = over_laps(FIRST_CUT, first_cut(True))
CUT_SIDE = " ".join(f"WHEN feature = '{c}' THEN in_{c}" for c in INPUTS)
ORACLE["ml_stump_metrics"] = over_laps(
    f"""SELECT {tidy('sqrt(avg(e * e))')} AS rmse, {tidy('avg(abs(e))')} AS mae, {tidy('1 - avg(e * e) / var_pop(y)')} AS r2, count(*) AS rows FROM (
  SELECT y, (SELECT avg(y) FROM train) + CASE WHEN coalesce(x <= threshold, missing_left) THEN gl / (nl + 1) ELSE (ga - gl) / (na - nl + 1) END - y AS e
  FROM (SELECT *, CASE {CUT_SIDE} END AS x FROM coded CROSS JOIN best WHERE part = 'holdout'))""",
    first_cut(True),
)
ORACLE["ml_stump_importance"] = over_laps(
    f"""SELECT i.feature, (CASE WHEN b.feature IS NULL THEN 0 ELSE 1 END)::BIGINT AS cuts, {tidy('coalesce(gain, 0)')} AS total_gain,
  {tidy('CASE WHEN b.feature IS NULL THEN 0 ELSE 1 END')} AS importance
FROM (SELECT unnest({INPUTS}) AS feature) i LEFT JOIN best b ON i.feature = b.feature""",
    first_cut(True),
)
ORACLE["ml_fixed_forest"] = over_laps(
    f"""SELECT {KEYS}, {tidy("""90.0
  + CASE WHEN in_TyreLife > 8 THEN 1.5 WHEN compound = 'HARD' THEN -0.75 ELSE 0.25 END
  + CASE WHEN in_AirTemp <= 24 THEN -1.25 WHEN driver IN ('D0', 'D1', 'D10', 'D11', 'D12') OR driver NOT IN ('D13') THEN 0.5 ELSE 2.0 END""")} AS prediction
FROM coded p JOIN (SELECT season, race_name, driver, lap_number, compound FROM laps) USING (season, race_name, driver, lap_number)""",
    model_parts(True),
)

# --- other tables --------------------------------------------------------------

ORACLE["star_usage_share"] = f"""
SELECT ship_year, l_returnflag, {tidy('n * 100.0::DOUBLE / sum(n) OVER (PARTITION BY ship_year)')} AS share_pct
FROM (SELECT CAST(year(l_shipdate) AS INTEGER) AS ship_year, l_returnflag, count(*) AS n FROM lineitem GROUP BY 1, 2)"""
ORACLE["star_price_above_best"] = f"""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, {shown('l_extendedprice* l_quantity* price_delta* quantity_delta*')} FROM (
  SELECT *, l_extendedprice - min(l_extendedprice) OVER o AS price_delta, l_quantity - min(l_quantity) OVER o AS quantity_delta
  FROM lineitem WINDOW o AS (PARTITION BY l_orderkey))"""
ORACLE["star_customer_rank"] = f"""
SELECT c_custkey, c_nationkey, {tidy('c_acctbal')} AS c_acctbal,
  CAST(dense_rank() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC NULLS LAST) AS INTEGER) AS balance_rank FROM customer"""
ORACLE["star_rolling_orders"] = f"""
SELECT o_custkey, o_orderkey, {shown('race_pace_index* race_pace_delta*')} FROM (
  SELECT *, o_totalprice - race_pace_index AS race_pace_delta FROM (
    SELECT *, avg(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE), o_orderkey
      ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS race_pace_index FROM orders))"""
ORACLE["star_null_pct"] = (
    "WITH labelled AS (SELECT d.doc_id, lang, source, n_chars, quality, toxic FROM documents d LEFT JOIN labels USING (doc_id)) "
    + null_share(["doc_id", "lang", "source", "n_chars", "quality", "toxic"], "labelled", set())
)
ORACLE["star_duplicates"] = repeated("lineitem", "l_orderkey", "l_linenumber")
ORACLE["star_invalid_values"] = "SELECT count(*) AS invalid_rows FROM customer WHERE c_acctbal <= 0 OR c_acctbal > 9000"
ORACLE["star_medians"] = (
    f"SELECT \"column\", {tidy('median')} AS median FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", median({c}) AS median FROM lineitem" for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    )
    + ")"
)
ORACLE["star_trendline"] = f"""
SELECT {shown('l_suppkey slope* intercept* r2* laps')} FROM (
  SELECT l_suppkey, nullif(regr_slope(l_extendedprice, l_quantity), 'NaN'::DOUBLE) AS slope, regr_intercept(l_extendedprice, l_quantity) AS intercept,
    regr_r2(l_extendedprice, l_quantity) AS r2, count(*) AS laps
  FROM lineitem WHERE l_extendedprice IS NOT NULL AND l_quantity IS NOT NULL GROUP BY l_suppkey)"""
ORACLE["star_asof_orders"] = """
SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, l_extendedprice, l_shipdate, i.lane, latest_order
FROM (SELECT *, l_suppkey % 100 AS lane FROM lineitem) i
ASOF LEFT JOIN (SELECT o_custkey % 100 AS lane, o_orderdate, max(o_orderkey) AS latest_order FROM orders GROUP BY 1, 2) o
ON i.lane = o.lane AND i.l_shipdate >= o.o_orderdate"""

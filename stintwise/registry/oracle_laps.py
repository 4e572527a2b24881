"""SQL for the lap table and its side tables, as CTEs over ``events``."""

LAPS = """
ev AS (
  SELECT *,
    CASE WHEN extract(day FROM ts) <= 15 THEN 2023 ELSE 2024 END AS season,
    'R' || CAST((extract(day FROM ts) - 1) % 5 AS INTEGER) AS race_name,
    CAST(user_id % 20 AS INTEGER) AS dn,
    'D' || CAST(user_id % 20 AS INTEGER) AS driver
  FROM events),
l1 AS (
  SELECT *,
    CAST(row_number() OVER g AS DOUBLE) AS lap_number,
    CAST(sum(6000 + CAST(round(value * 100) AS BIGINT)) OVER (g ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cum_cents,
    CASE WHEN event_type = 'error' AND event_id % 4 = 0 THEN value END AS pit_in_time_seconds,
    lag(CASE WHEN event_type = 'error' AND event_id % 4 = 0 THEN value END) OVER g AS pit_out_time_seconds
  FROM ev WINDOW g AS (PARTITION BY season, race_name, driver ORDER BY ts, event_id)),
l2 AS (
  SELECT *,
    CAST(row_number() OVER (PARTITION BY season, race_name, lap_number ORDER BY cum_cents, driver) AS DOUBLE) AS position,
    CAST(1 + count(pit_out_time_seconds) OVER (PARTITION BY season, race_name, driver ORDER BY lap_number
      ROWS UNBOUNDED PRECEDING) AS INTEGER) AS stint,
    CASE WHEN event_type = 'error' AND event_id % 7 = 0 THEN NULL ELSE 60 + value END AS lap_time_seconds
  FROM l1),
laps AS (
  SELECT season, race_name, driver, lap_number, event_id, ts, cum_cents,
    CAST(dn AS VARCHAR) AS driver_number, 'T' || (dn % 10) AS team, position,
    first_value(position) OVER whole AS grid_position, last_value(position) OVER whole AS final_position,
    stint,
    CAST(row_number() OVER (PARTITION BY season, race_name, driver, stint ORDER BY lap_number) AS DOUBLE) AS tyre_life,
    CASE (stint + dn) % 3 WHEN 0 THEN 'SOFT' WHEN 1 THEN 'MEDIUM' ELSE 'HARD' END AS compound,
    lap_time_seconds,
    lap_time_seconds * (0.30 + 0.001 * (event_id % 7)::DOUBLE)::DOUBLE AS sector1_time_seconds,
    lap_time_seconds * (0.33 + 0.001 * (event_id % 5)::DOUBLE)::DOUBLE AS sector2_time_seconds,
    lap_time_seconds * (0.35 + 0.001 * (event_id % 3)::DOUBLE)::DOUBLE AS sector3_time_seconds,
    pit_in_time_seconds, pit_out_time_seconds,
    CAST(20 + CAST(regexp_extract(props, '[0-9]+', 0) AS INTEGER) % 10 AS DOUBLE) AS air_temp,
    CAST(30 + event_id % 13 AS DOUBLE) AS track_temp,
    event_type = 'signup' AS rainfall
  FROM l2
  WINDOW whole AS (PARTITION BY season, race_name, driver ORDER BY lap_number
    ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))"""


def over_laps(select: str, *ctes: str) -> str:
    return "WITH " + ",\n".join([LAPS, *ctes]) + "\n" + select

"""The racing tables as DuckDB SQL over the generic test tables (fixed translation rules)."""

WEEK = "date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) // 7"


def _at(seconds: str) -> str:
    return f"TIMESTAMP '2018-01-07 14:00:00' + to_seconds({seconds})"


def _ev(kinds: str) -> str:
    return f"""(SELECT event_id % 344 AS session_key, CAST(user_id % 20 + 1 AS INT) AS driver_number,
        {_at("(event_id % 344) * 604800 + (event_id // 344) % 7200")} AS date, value,
        CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k
        FROM events WHERE event_type IN ({kinds}))"""


SQL_TABLES = {
    "sessions": f"""
SELECT i AS session_key, i // 7 AS meeting_key, 2018 + i // 56 AS year,
  CASE i % 7 WHEN 0 THEN 'Practice 1' WHEN 1 THEN 'Practice 2' WHEN 2 THEN 'Practice 3'
    WHEN 3 THEN 'Sprint Qualifying' WHEN 4 THEN 'Sprint' WHEN 5 THEN 'Qualifying' ELSE 'Race' END AS session_name,
  CASE WHEN i % 7 <= 2 THEN 'Practice' WHEN i % 7 IN (3, 5) THEN 'Qualifying' WHEN i % 7 = 4 THEN 'Sprint'
    ELSE 'Race' END AS session_type,
  {_at("i * 604800")} AS date_start, {_at("i * 604800 + 7200")} AS date_end
FROM (SELECT DISTINCT {WEEK} AS i FROM orders)""",
    "meetings": f"""
SELECT m AS meeting_key, 2018 + m // 8 AS year, 'GP ' || (m % 8 + 1) AS meeting_name,
  CASE m % 8 WHEN 0 THEN 'Monaco' WHEN 1 THEN 'Monza' WHEN 2 THEN 'Silverstone'
    ELSE 'Circuit ' || (m % 8 + 1) END AS circuit_short_name,
  n_name AS country_name, {_at("m * 4233600")} AS date_start
FROM (SELECT DISTINCT {WEEK} // 7 AS m FROM orders) JOIN nation ON n_nationkey = m % 25""",
    "laps_dup": f"""
SELECT session_key, driver_number, lap_number,
  CASE WHEN l_quantity <> 1 THEN seconds END AS lap_duration,
  CASE WHEN l_quantity <> 1 AND l_discount <> 0 THEN seconds END AS lap_time,
  CASE WHEN l_tax <> 0 THEN 250 + l_quantity END AS i1_speed,
  260 + l_quantity AS i2_speed, 350 - l_quantity AS st_speed,
  l_orderkey % 10 = 0 AS is_pit_out_lap,
  CASE l_returnflag WHEN 'A' THEN 'SOFT' WHEN 'N' THEN 'MEDIUM' WHEN 'R' THEN 'HARD' END AS compound,
  CAST(l_linenumber - 1 AS INT) AS tyre_life, l_linestatus = 'O' AS fresh_tyre,
  {_at("session_key * 604800 + lap_number * 90 + driver_number")} AS date_start,
  l_orderkey, l_partkey, l_extendedprice, l_quantity, l_tax
FROM (SELECT *, {WEEK} AS session_key, CAST(l_suppkey % 20 + 1 AS INT) AS driver_number,
    CAST((l_linenumber - 1) * 10 + l_orderkey % 10 + 1 AS INT) AS lap_number,
    (80000 + floor(l_extendedprice / 10)) / 1000.0::DOUBLE AS seconds
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""",
    "laps": """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY session_key, driver_number, lap_number
  ORDER BY l_orderkey DESC, l_partkey DESC, l_extendedprice DESC, l_quantity DESC, l_tax DESC) AS rn
  FROM laps_dup) WHERE rn = 1""",
    "drivers": """
SELECT session_key, driver_number, 'Driver ' || driver_number AS full_name, 'D' || driver_number AS name_acronym,
  'Team ' || ((driver_number - 1) // 2 + 1) AS team_name
FROM (SELECT DISTINCT session_key, driver_number FROM laps_dup)""",
    "positions": f"""
SELECT session_key, driver_number,
  {_at("session_key * 604800 + lap_number * 90 + driver_number + (driver_number * 7 + lap_number * 11) % 80 - 40 + 25 * s")} AS date,
  CAST(row_number() OVER (PARTITION BY session_key, lap_number, s
    ORDER BY CASE WHEN s = 0 THEN coalesce(lap_duration, 999.0) ELSE driver_number END, driver_number) AS INT) AS position
FROM (SELECT *, unnest([0, 1]) AS s FROM laps)""",
    "session_result": """
SELECT session_key, driver_number, CAST(row_number() OVER (PARTITION BY session_key
    ORDER BY laps_done DESC, pace, driver_number) AS INT) AS position,
  laps_done < 35 AS dnf, false AS dns, false AS dsq
FROM (SELECT session_key, driver_number, max(lap_number) AS laps_done, avg(coalesce(lap_duration, 999.0)) AS pace
  FROM laps WHERE session_key % 7 = 6 GROUP BY ALL)""",
    "starting_grid": """
SELECT session_key + 1 AS session_key, driver_number, CAST(row_number() OVER (PARTITION BY session_key
    ORDER BY best, driver_number) AS INT) AS position
FROM (SELECT session_key, driver_number, min(coalesce(lap_duration, 999.0)) AS best
  FROM laps WHERE session_key % 7 = 5 GROUP BY ALL)""",
    "pit": """
SELECT session_key, driver_number, lap_number, date_start AS date, 20 + l_tax AS pit_duration
FROM laps WHERE is_pit_out_lap""",
    "stints": """
SELECT session_key, driver_number, s AS stint_number, (s - 1) * 35 + 1 AS lap_start, s * 35 AS lap_end,
  CASE (driver_number + s) % 3 WHEN 0 THEN 'SOFT' WHEN 1 THEN 'MEDIUM' ELSE 'HARD' END AS compound,
  (driver_number * s) % 4 AS tyre_age_at_start
FROM (SELECT session_key, driver_number, unnest([1, 2]) AS s FROM drivers)""",
    "car_data": f"""
SELECT session_key, driver_number, date, CASE WHEN value < 300 THEN CAST(floor(value) AS INT) END AS speed,
  k AS throttle, CASE WHEN k >= 70 THEN 100 ELSE 0 END AS brake
FROM {_ev("'click','purchase','signup'")}""",
    "weather": f"""
SELECT session_key, date, (1500 + floor(value * 5)) / 100.0::DOUBLE AS air_temperature,
  (2500 + floor(value * 7)) / 100.0::DOUBLE AS track_temperature, CASE WHEN k >= 80 THEN 1 ELSE 0 END AS rainfall
FROM {_ev("'view'")}""",
    "race_control": f"""
SELECT session_key, date, driver_number,
  CASE k % 4 WHEN 0 THEN 'SafetyCar' WHEN 2 THEN 'Other' ELSE 'Flag' END AS category,
  CASE k % 3 WHEN 0 THEN 'RED' WHEN 1 THEN 'YELLOW' END AS flag,
  CASE WHEN k % 10 = 0 THEN (5 + k % 7) || ' SECOND TIME PENALTY' ELSE 'NOTED' END AS message
FROM {_ev("'error'")}""",
}

"""Aggregations: laps, pit stops, telemetry, tyres, weather, events and the reports."""

from pyspark.sql import functions as F

from pitwall.functions.scalars import points
from pitwall.operators import clean
from pitwall.plans import features, performance, reports, results
from pitwall.plans.results import DRIVER
from suite.joining import rounded
from suite.registry import query

SQL_POINTS = ("CASE {p} WHEN 1 THEN 25 WHEN 2 THEN 18 WHEN 3 THEN 15 WHEN 4 THEN 12 WHEN 5 THEN 10 WHEN 6 THEN 8 "
              "WHEN 7 THEN 6 WHEN 8 THEN 4 WHEN 9 THEN 2 WHEN 10 THEN 1 ELSE 0 END")


@query("fastest_lap_per_driver", """
SELECT session_key, driver_number, min(lap_duration) AS fastest_lap FROM laps WHERE lap_duration IS NOT NULL GROUP BY ALL""")
def fastest_lap_per_driver(t):
    return results.fastest_laps(t["laps"])


@query("championship_points", f"""
WITH last_seen AS (SELECT session_key, driver_number, {SQL_POINTS.format(p="arg_max(position, (date, position))")} AS points
  FROM positions GROUP BY ALL)
SELECT m.year, full_name AS driver_name, team_name, CAST(sum(points) AS BIGINT) AS championship_points,
  count(DISTINCT meeting_name) AS races_participated,
  CAST(rank() OVER (PARTITION BY m.year ORDER BY sum(points) DESC) AS INT) AS championship_position
FROM last_seen JOIN drivers d USING (session_key, driver_number) JOIN sessions s USING (session_key)
  JOIN meetings m USING (meeting_key) WHERE session_type = 'Race' GROUP BY m.year, full_name, team_name""")
def championship_points(t):
    return reports.championship(t)


SQL_TEAM = """
WITH team_stats AS (SELECT team_name, m.year, meeting_name, session_name, count(DISTINCT driver_number) AS drivers_count,
    avg(lap_time) AS avg_lap_time, min(lap_time) AS fastest_lap_time, count(lap_number) AS total_laps
  FROM laps l JOIN drivers d USING (session_key, driver_number) JOIN sessions s USING (session_key)
    JOIN meetings m USING (meeting_key) WHERE lap_time > 0 GROUP BY ALL)
SELECT team_name, year, count(DISTINCT meeting_name) AS races_participated,
  round(avg(drivers_count) + 1e-9, 6) AS avg_drivers_per_race, round(avg(avg_lap_time) + 1e-9, 6) AS season_avg_lap_time,
  min(fastest_lap_time) AS season_fastest_lap, CAST(sum(total_laps) AS BIGINT) AS season_total_laps,
  CAST(rank() OVER (PARTITION BY year ORDER BY avg(avg_lap_time)) AS INT) AS performance_rank
FROM team_stats GROUP BY team_name, year"""


@query("team_performance", SQL_TEAM)
def team_performance(t):
    return rounded(reports.team_performance(t))


@query("session_statistics", """
SELECT meeting_name, m.year, country_name, circuit_short_name, session_name, session_type, s.date_start, s.date_end,
  count(DISTINCT d.driver_number) AS participating_drivers, count(DISTINCT d.team_name) AS participating_teams,
  count(l.lap_number) AS total_laps_recorded, round(avg(lap_time) + 1e-9, 6) AS average_lap_time,
  min(lap_time) AS fastest_lap_time, max(lap_time) AS slowest_lap_time, round(stddev(lap_time) + 1e-9, 6) AS lap_time_variation
FROM laps l LEFT JOIN drivers d USING (session_key, driver_number) JOIN sessions s USING (session_key)
  JOIN meetings m USING (meeting_key) WHERE lap_time > 0
GROUP BY meeting_name, m.year, country_name, circuit_short_name, session_name, session_type, s.date_start, s.date_end""")
def session_statistics(t):
    return rounded(reports.session_stats(t))


@query("driver_consistency", """
SELECT full_name AS driver_name, team_name, m.year, session_type, count(lap_number) AS total_laps,
  round(avg(lap_time) + 1e-9, 6) AS avg_lap_time, round(stddev(lap_time) + 1e-9, 6) AS consistency_score, min(lap_time) AS best_lap_time,
  max(lap_time) AS worst_lap_time, round(percentile_cont(0.5) WITHIN GROUP (ORDER BY lap_time) + 1e-9, 6) AS median_lap_time,
  round(stddev(lap_time) / avg(lap_time) * 100 + 1e-9, 6) AS coefficient_of_variation
FROM laps l JOIN drivers d USING (session_key, driver_number) JOIN sessions s USING (session_key)
  JOIN meetings m USING (meeting_key) WHERE lap_time > 0 GROUP BY full_name, team_name, m.year, session_type
HAVING count(lap_number) >= 10""")
def driver_consistency(t):
    return rounded(reports.driver_consistency(t, rounded=False))


@query("lap_performance", """
SELECT session_key, driver_number, min(lap_duration) AS best_lap_time, round(avg(lap_duration) + 1e-9, 6) AS average_lap_time
FROM laps WHERE lap_duration IS NOT NULL AND NOT is_pit_out_lap GROUP BY ALL""")
def lap_performance(t):
    return rounded(performance.lap_perf(t["laps"]))


@query("pit_performance", """
SELECT session_key, driver_number, round(coalesce(sum(pit_duration), 0) + 1e-9, 6) AS total_pit_time, count(pit_duration) AS pit_stops
FROM drivers LEFT JOIN pit USING (session_key, driver_number) GROUP BY ALL""")
def pit_performance(t):
    rows = t["drivers"].select(*DRIVER).join(performance.pit_perf(t["pit"]), DRIVER, "left")
    return rounded(rows.na.fill({"total_pit_time": 0.0, "pit_stops": 0}))


SQL_TELEMETRY = """round(avg(speed) + 1e-9, 6) AS avg_speed, max(speed) AS max_speed, round(avg(throttle) + 1e-9, 6) AS avg_throttle,
  round(count(*) FILTER (brake > 0) * 100.0 / count(*) + 1e-9, 6) AS time_spent_braking_pct"""


@query("telemetry_aggregates", f"""
SELECT session_key, driver_number, {SQL_TELEMETRY} FROM car_data WHERE speed IS NOT NULL GROUP BY ALL""")
def telemetry_aggregates(t):
    return rounded(performance.telemetry(t["car_data"]))


@query("tire_summary", """
SELECT session_key, driver_number, string_agg(compound, '|' ORDER BY first, compound) AS compounds,
  CAST(sum(n) AS BIGINT) AS tire_stint_count
FROM (SELECT session_key, driver_number, compound, min(stint_number) AS first, count(*) AS n FROM stints GROUP BY ALL)
GROUP BY ALL""")
def tire_summary(t):
    rows = performance.tires(t["stints"])
    return rows.select(*DRIVER, F.array_join("tire_compounds_used", "|").alias("compounds"), "tire_stint_count")


@query("race_events", """
SELECT session_key, count(*) FILTER (category LIKE '%Safety%') AS safety_car_deployments,
  count(*) FILTER (flag LIKE '%RED%') AS red_flag_periods
FROM race_control WHERE category LIKE '%Safety%' OR flag LIKE '%RED%' GROUP BY ALL""")
def race_events(t):
    return features.race_events(t["race_control"])


@query("race_events_distinct", """
SELECT session_key, count(*) FILTER (category LIKE '%Safety%') AS safety_car_deployments,
  count(*) FILTER (flag LIKE '%RED%') AS red_flag_periods
FROM (SELECT DISTINCT session_key, category, flag FROM race_control)
WHERE category LIKE '%Safety%' OR flag LIKE '%RED%' GROUP BY ALL""")
def race_events_distinct(t):
    return features.race_events(t["race_control"], literal=True)


@query("weather_features", """
SELECT session_key, coalesce(var_samp(air_temperature) > 5, false) AS weather_changes,
  round(avg(coalesce(rainfall > 0, false)::INT) + 1e-9, 6) AS rain_probability FROM weather GROUP BY ALL""")
def weather_features(t):
    return rounded(features.weather_features(t["weather"]))


@query("weather_context", """
SELECT session_key, round(avg(air_temperature) + 1e-9, 6) AS air_temperature, round(avg(track_temperature) + 1e-9, 6) AS track_temperature
FROM weather GROUP BY ALL""")
def weather_context(t):
    return rounded(features.weather_context(t["weather"]))


@query("table_stats_meetings", """
SELECT year, count(*) AS meeting_count, count(DISTINCT country_name) AS unique_countries,
  count(DISTINCT circuit_short_name) AS unique_circuits FROM meetings GROUP BY year""")
def table_stats_meetings(t):
    return reports.meeting_stats(t["meetings"])


def lake_laps(t):
    return clean.valid_laps(t["laps"]).withColumn("date_start", F.to_date("date_start"))


SQL_LAKE_LAPS = """(SELECT session_key, driver_number, lap_time, CAST(date_start AS DATE) AS date_start,
  (lap_time IS NOT NULL)::INT * 0.3::DOUBLE + (i1_speed IS NOT NULL)::INT * 0.2::DOUBLE + (i2_speed IS NOT NULL)::INT * 0.2::DOUBLE
  + (st_speed IS NOT NULL)::INT * 0.2::DOUBLE + (compound IS NOT NULL)::INT * 0.1::DOUBLE AS data_completeness_score FROM laps)"""


@query("table_stats_laps", f"""
SELECT date_start, count(*) AS total_laps, count(DISTINCT session_key) AS unique_sessions,
  count(DISTINCT driver_number) AS unique_drivers, round(avg(data_completeness_score) + 1e-9, 6) AS avg_completeness_score,
  count(CASE WHEN lap_time IS NOT NULL THEN 1 END) AS laps_with_times
FROM {SQL_LAKE_LAPS} GROUP BY date_start ORDER BY date_start DESC LIMIT 10""")
def table_stats_laps(t):
    return rounded(reports.lap_stats(lake_laps(t)))


@query("table_stats_total", f"""
SELECT count(*) AS total_laps, min(date_start) AS earliest_date, max(date_start) AS latest_date,
  count(DISTINCT date_start) AS total_dates FROM {SQL_LAKE_LAPS}""")
def table_stats_total(t):
    return reports.lap_totals(lake_laps(t))


@query("first_per_group", """
SELECT DISTINCT m.date_start AS date, meeting_name AS grand_prix FROM session_result
JOIN sessions USING (session_key) JOIN meetings m USING (meeting_key)""")
def first_per_group(t):
    return results.race_results(t).select("date", "grand_prix").distinct()


@query("wins_podiums", f"""
SELECT year, driver_number, session_key, CAST(count(*) FILTER (position = 1) OVER w AS BIGINT) AS wins,
  CAST(count(*) FILTER (position <= 3) OVER w AS BIGINT) AS podiums,
  CAST(count(*) FILTER ({SQL_POINTS.format(p="position")} > 0) OVER w AS BIGINT) AS points_finishes
FROM session_result JOIN sessions USING (session_key)
WINDOW w AS (PARTITION BY year, driver_number ORDER BY date_start RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def wins_podiums(t):
    rows = t["session_result"].join(t["sessions"].select("session_key", "year", "date_start"), "session_key")
    to_date = "OVER (PARTITION BY year, driver_number ORDER BY date_start RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return rows.withColumn("points", points("position")).select(
        "year", "driver_number", "session_key", F.expr(f"count_if(position = 1) {to_date}").alias("wins"),
        F.expr(f"count_if(position <= 3) {to_date}").alias("podiums"),
        F.expr(f"count_if(points > 0) {to_date}").alias("points_finishes"))


@query("count_case", """
SELECT session_key, count(CASE WHEN lap_time IS NOT NULL THEN 1 END) AS laps_with_times, count(*) AS total_laps
FROM laps GROUP BY session_key""")
def count_case(t):
    return t["laps"].groupBy("session_key").agg(F.count("lap_time").alias("laps_with_times"), F.count(F.lit(1)).alias("total_laps"))


SQL_RACE_TIME = """(SELECT session_key, min(s) AS total_race_time FROM (SELECT session_key, driver_number, sum(lap_duration) AS s
  FROM laps JOIN session_result USING (session_key, driver_number) WHERE NOT dnf GROUP BY ALL) GROUP BY ALL)"""


@query("total_race_time", f"SELECT session_key, round(total_race_time + 1e-9, 6) AS total_race_time FROM {SQL_RACE_TIME}")
def total_race_time(t):
    return rounded(features.total_race_time(t["laps"], t["session_result"]))


@query("telemetry_by_session", f"""
SELECT c.session_key, c.driver_number, l.lap_number, {SQL_TELEMETRY}
FROM car_data c ASOF LEFT JOIN laps l ON c.session_key = l.session_key AND c.driver_number = l.driver_number
  AND c.date >= l.date_start WHERE speed IS NOT NULL GROUP BY ALL""")
def telemetry_by_session(t):
    return rounded(reports.telemetry_by_lap(t))

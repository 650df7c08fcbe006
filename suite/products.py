"""The derived tables and the jobs that write them."""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pitwall import catalog
from pitwall.functions.scalars import points
from pitwall.operators.upsert import upsert, upsert_path
from pitwall.plans import features, jobs, performance, reports, results
from pitwall.plans.results import DRIVER
from pitwall.session import stage, work_dir
from pitwall.sources import tables, writers
from suite.aggregates import SQL_POINTS, SQL_RACE_TIME, SQL_TELEMETRY
from suite.filters import SQL_LAP_RULES, SQL_LAP_SCORE
from suite.joining import SQL_NEAREST, SQL_PENALTIES, rounded
from suite.registry import query
from suite.scans import extracted
from suite.tables import closed, new_database
from suite.windows import SQL_SPEED_RANKS

# Results ---------------------------------------------------------------------

SQL_RESULTS = f"""(SELECT *, CAST(row_number() OVER (PARTITION BY year, date ORDER BY total_season_points DESC, driver_number) AS INT)
    AS drivers_championship_ranking,
  max(total_season_points) OVER (PARTITION BY year, date) - total_season_points AS points_from_first
FROM (SELECT *, CAST(sum(points) OVER (PARTITION BY year, driver_number ORDER BY date, race_round
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS total_season_points
  FROM (SELECT races.year || '_' || race_round || '_' || driver_number AS result_id, session_key, races.date, races.year,
      CAST(race_round AS INT) AS race_round, grand_prix, circuit_name, driver_number, full_name AS driver_name,
      name_acronym AS driver_acronym, team_name, g.position AS starting_grid_position, r.position AS final_position,
      CAST({SQL_POINTS.format(p="r.position")} + (coalesce(f.quick = 1, false) AND r.position <= 10)::INT AS INT) AS points,
      f.fastest_lap, coalesce(p.penalty_seconds, 0) AS total_time_penalty, dnf, dns, dsq
    FROM session_result r
    JOIN (SELECT session_key, s.year, m.date_start AS date, meeting_name AS grand_prix, circuit_short_name AS circuit_name,
        dense_rank() OVER (PARTITION BY s.year ORDER BY s.date_start, meeting_name) AS race_round
      FROM sessions s JOIN meetings m USING (meeting_key) WHERE session_type = 'Race') races USING (session_key)
    JOIN drivers d USING (session_key, driver_number)
    LEFT JOIN starting_grid g USING (session_key, driver_number)
    LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY session_key ORDER BY fastest_lap, driver_number) AS quick
      FROM (SELECT session_key, driver_number, min(lap_duration) AS fastest_lap FROM laps WHERE lap_duration IS NOT NULL GROUP BY ALL)
      ) f USING (session_key, driver_number)
    LEFT JOIN {SQL_PENALTIES} p USING (session_key, driver_number))))"""


@query("gp_results", f"SELECT * FROM {SQL_RESULTS}")
def gp_results(t):
    return results.gp_results(t)


@query("points", f"""
SELECT session_key, driver_number, position, CAST({SQL_POINTS.format(p="position")} + (position <= 10 AND quick = 1)::INT AS INT) AS points
FROM (SELECT *, row_number() OVER (PARTITION BY session_key ORDER BY fastest_lap, driver_number) AS quick
  FROM session_result JOIN (SELECT session_key, driver_number, min(lap_duration) AS fastest_lap FROM laps
    WHERE lap_duration IS NOT NULL GROUP BY ALL) USING (session_key, driver_number))""")
def points_with_bonus(t):
    rows = t["session_result"].join(results.fastest_laps(t["laps"]), DRIVER)
    order = W.partitionBy("session_key").orderBy("fastest_lap", "driver_number")
    quick = F.row_number().over(order) == 1
    return rows.withColumn("quick", quick).select(*DRIVER, "position", points("position", "quick").alias("points"))


@query("penalties", f"SELECT * FROM {SQL_PENALTIES}")
def penalties(t):
    return results.penalties(t["race_control"])


SQL_STANDINGS = """
WITH results AS (SELECT * FROM {results}),
races AS (SELECT *, dense_rank() OVER (PARTITION BY year ORDER BY date, grand_prix) AS race_round
  FROM (SELECT DISTINCT year, date, grand_prix FROM results)),
raced AS (SELECT year, race_round, {by}, sum(points) AS points, min(final_position) AS place, count(*) FILTER (final_position = 1) AS wins,
    count(*) FILTER (final_position <= 3) AS podiums, count(*) FILTER (points > 0) AS points_finishes
  FROM (SELECT * EXCLUDE (race_round) FROM results) q JOIN races USING (year, date, grand_prix) GROUP BY year, race_round, {by}),
known AS (SELECT year, {by}, min(race_round) AS first_round, arg_min(place, race_round) AS first_place FROM raced GROUP BY ALL),
filled AS (SELECT races.year, races.race_round, races.grand_prix, known.{by}, first_round, first_place,
    coalesce(sum(points) OVER w, 0) AS points, coalesce(sum(wins) OVER w, 0) AS wins, coalesce(sum(podiums) OVER w, 0) AS podiums,
    coalesce(sum(points_finishes) OVER w, 0) AS points_finishes
  FROM known JOIN races ON known.year = races.year AND races.race_round >= first_round
  LEFT JOIN raced ON raced.year = races.year AND raced.race_round = races.race_round AND raced.{by} = known.{by}
  WINDOW w AS (PARTITION BY races.year, known.{by} ORDER BY races.race_round ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT f.year || '_' || race_round || '_' || {by} AS standing_id, f.year, CAST(race_round AS INT) AS race_round, grand_prix AS after_race,
  {by}, {names} CAST(row_number() OVER w AS INT) AS position, CAST(points AS BIGINT) AS points,
  CAST(first_value(points) OVER w - points AS BIGINT) AS points_behind_leader,
  CAST(coalesce(points - lead(points) OVER w, 0) AS BIGINT) AS points_ahead_next,
  CAST(wins AS BIGINT) AS wins, CAST(podiums AS BIGINT) AS podiums, CAST(points_finishes AS BIGINT) AS points_finishes
FROM filled f {who}
WINDOW w AS (PARTITION BY f.year, race_round ORDER BY points DESC, first_round, first_place NULLS LAST, {by})"""


def standings_sql(by, names="", who=""):
    return SQL_STANDINGS.format(results=SQL_RESULTS, by=by, names=names, who=who)


@query("championship_standings", standings_sql("driver_number", "driver_name, team_name,", """JOIN (SELECT year, driver_number,
  arg_min(driver_name, date) AS driver_name, arg_min(team_name, date) AS team_name FROM results GROUP BY ALL) n USING (year, driver_number)"""))
def championship_standings(t):
    return results.standings(stage(results.race_results(t), "results"))


@query("constructor_standings", standings_sql("team_name"))
def constructor_standings(t):
    return reports.constructor_standings(stage(results.race_results(t), "results"))


# Performance -----------------------------------------------------------------

SQL_PERFORMANCE = f"""(SELECT s.year || '_' || session_key || '_' || driver_number AS performance_id, session_key, s.date_start AS date,
  s.year, meeting_name AS grand_prix, session_name, session_type, driver_number, full_name AS driver_name, team_name,
  best_lap_time, average_lap_time, coalesce(total_pit_time, 0) AS total_pit_time, coalesce(pit_stops, 0) AS pit_stops,
  avg_speed, max_speed, avg_throttle, time_spent_braking_pct, coalesce(compounds, '') AS compounds, coalesce(tire_stint_count, 0) AS tire_stint_count
FROM drivers d JOIN sessions s USING (session_key) JOIN meetings m USING (meeting_key)
LEFT JOIN (SELECT session_key, driver_number, min(lap_duration) AS best_lap_time, round(avg(lap_duration) + 1e-9, 6) AS average_lap_time
  FROM laps WHERE lap_duration IS NOT NULL AND NOT is_pit_out_lap GROUP BY ALL) l USING (session_key, driver_number)
LEFT JOIN (SELECT session_key, driver_number, round(sum(pit_duration) + 1e-9, 6) AS total_pit_time, count(*) AS pit_stops FROM pit GROUP BY ALL)
  p USING (session_key, driver_number)
LEFT JOIN (SELECT session_key, driver_number, {SQL_TELEMETRY} FROM car_data WHERE speed IS NOT NULL GROUP BY ALL)
  c USING (session_key, driver_number)
LEFT JOIN (SELECT session_key, driver_number, string_agg(compound, '|' ORDER BY stint_number) AS compounds, count(*) AS tire_stint_count
  FROM stints GROUP BY ALL) q USING (session_key, driver_number))"""


@query("gp_performance", f"SELECT * FROM {SQL_PERFORMANCE}")
def gp_performance(t):
    rows = performance.gp_performance(t)
    return rounded(rows.withColumn("compounds", F.array_join("tire_compounds_used", "|")).drop("tire_compounds_used"))


# Features --------------------------------------------------------------------

SQL_FEATURES = f"""
WITH perf AS (SELECT p.*, r.final_position, r.starting_grid_position FROM {SQL_PERFORMANCE} p
  LEFT JOIN {SQL_RESULTS} r ON p.year = r.year AND p.grand_prix = r.grand_prix AND p.driver_number = r.driver_number AND p.session_name = 'Race'),
rounds AS (SELECT s.year, meeting_name AS grand_prix, dense_rank() OVER (PARTITION BY s.year ORDER BY s.date_start) AS race_round
  FROM sessions s JOIN meetings m USING (meeting_key) WHERE session_type = 'Race'),
deltas AS (SELECT *, best_lap_time - avg(best_lap_time) OVER (PARTITION BY year, grand_prix, session_name) AS field,
    count(*) OVER team AS cars, (sum(best_lap_time) OVER team - best_lap_time) / nullif(count(best_lap_time) OVER team - 1, 0) AS others
  FROM perf WINDOW team AS (PARTITION BY year, grand_prix, session_name, team_name))
SELECT d.year || '_' || coalesce(race_round, 0) || '_' || session_name || '_' || driver_number AS feature_id, d.year,
  CAST(coalesce(race_round, 0) AS INT) AS race_round, session_name AS session_type, driver_number,
  round(best_lap_time - others + 1e-9, 6) AS pace_vs_teammate, round(field + 1e-9, 6) AS pace_vs_field, round(spread + 1e-9, 6) AS consistency_score,
  starting_grid_position AS track_position_start, CAST(final_position AS DOUBLE) AS track_position_avg,
  straight_line_speed_rank, cornering_speed_rank, round(air + 1e-9, 6) AS air_temperature, round(track + 1e-9, 6) AS track_temperature
FROM deltas d LEFT JOIN rounds USING (year, grand_prix)
LEFT JOIN (SELECT session_key, avg(air_temperature) AS air, avg(track_temperature) AS track FROM weather GROUP BY ALL) w USING (session_key)
LEFT JOIN (SELECT session_key, driver_number, stddev_samp(lap_duration) AS spread FROM laps GROUP BY ALL) k USING (session_key, driver_number)
LEFT JOIN {SQL_SPEED_RANKS} v USING (session_key, driver_number)
WHERE cars >= 2"""


@query("driver_features", SQL_FEATURES)
def driver_features(t):
    saved = stage(performance.gp_performance(t), "performance"), stage(results.race_results(t), "results")
    return rounded(features.driver_features(t, *saved))


@query("race_context", f"""
SELECT r.year || '_' || race_round AS context_id, r.year, CAST(race_round AS INT) AS race_round, grand_prix,
  CASE circuit WHEN 'Monaco' THEN 3.337::DOUBLE WHEN 'Monza' THEN 5.793::DOUBLE WHEN 'Silverstone' THEN 5.891::DOUBLE END AS circuit_length,
  CASE circuit WHEN 'Monaco' THEN 19 WHEN 'Monza' THEN 11 WHEN 'Silverstone' THEN 18 END AS number_of_turns,
  CASE circuit WHEN 'Monaco' THEN 0.9::DOUBLE WHEN 'Monza' THEN 0.3::DOUBLE WHEN 'Silverstone' THEN 0.5::DOUBLE END AS overtaking_difficulty,
  coalesce(safety, 0) AS safety_car_deployments, coalesce(red, 0) AS red_flag_periods, round(total_race_time + 1e-9, 6) AS total_race_time,
  coalesce(changes, false) AS weather_changes, round(rain + 1e-9, 6) AS rain_probability
FROM (SELECT session_key, s.year, meeting_name AS grand_prix, circuit_short_name AS circuit,
    dense_rank() OVER (PARTITION BY s.year ORDER BY s.date_start, meeting_name) AS race_round
  FROM sessions s JOIN meetings m USING (meeting_key) WHERE session_type = 'Race') r
LEFT JOIN (SELECT session_key, count(*) FILTER (category LIKE '%Safety%') AS safety, count(*) FILTER (flag LIKE '%RED%') AS red
  FROM race_control GROUP BY ALL) e USING (session_key)
LEFT JOIN {SQL_RACE_TIME} x USING (session_key)
LEFT JOIN (SELECT session_key, var_samp(air_temperature) > 5 AS changes, avg(coalesce(rainfall > 0, false)::INT) AS rain
  FROM weather GROUP BY ALL) w USING (session_key)""")
def race_context(t):
    return rounded(features.race_context(t))


@query("car_behind", f"""
WITH near AS (SELECT n.*, meeting_name FROM {SQL_NEAREST} n JOIN sessions s USING (session_key) JOIN meetings m USING (meeting_key)
  WHERE session_type = 'Race')
SELECT n.session_key, n.driver_number, n.lap_number, position, lap_duration AS lap_time,
  s.tyre_age_at_start + n.lap_number - s.lap_start AS tire_age, lead(n.driver_number) OVER w IS NOT NULL AS has_car_behind,
  round(lead(lap_duration) OVER w - lap_duration + 1e-9, 6) AS gap_to_behind, lead(n.driver_number) OVER w AS car_behind_driver,
  lag(n.driver_number) OVER w IS NOT NULL AS has_car_ahead, lag(n.driver_number) OVER w AS car_ahead_driver, meeting_name
FROM near n LEFT JOIN stints s ON n.session_key = s.session_key AND n.driver_number = s.driver_number
  AND n.lap_number BETWEEN s.lap_start AND s.lap_end
WINDOW w AS (PARTITION BY n.session_key, n.lap_number ORDER BY position, n.driver_number, date)""")
def car_behind(t):
    return features.analysis(t).withColumn("gap_to_behind", F.round("gap_to_behind", 6))


# Lake ------------------------------------------------------------------------

MEETING = ["meeting_key", "meeting_name", "circuit_short_name", "country_name", "date_start", "year"]


@query("upsert_meetings", """
SELECT meeting_key, CASE WHEN meeting_key % 3 = 0 THEN upper(meeting_name) ELSE meeting_name END AS meeting_name,
  CASE WHEN meeting_key % 3 = 0 THEN 'moved' ELSE circuit_short_name END AS circuit_short_name, country_name, date_start, year
FROM meetings WHERE meeting_key % 3 = 0 OR meeting_key % 2 = 0""")
def upsert_meetings(t):
    rows = t["meetings"].select(*MEETING)
    target = rows.where("meeting_key % 2 = 0")
    updates = rows.where("meeting_key % 3 = 0").withColumns({"meeting_name": F.upper("meeting_name"), "circuit_short_name": F.lit("moved")})
    return upsert(target, updates, ["meeting_key", "year"], ["meeting_name"])


@query("upsert_laps", f"""
SELECT session_key, driver_number, lap_number, CAST(date_start AS DATE) AS date_start,
  CASE WHEN lap_number % 3 = 0 THEN lap_time + 1 ELSE lap_time END AS lap_time,
  CASE WHEN lap_number % 3 = 0 THEN 'WET' ELSE compound END AS compound
FROM laps WHERE lap_number % 3 = 0 OR lap_number % 2 = 0""")
def upsert_laps(t):
    path, keys = work_dir(t.spark, "lake-laps"), ["session_key", "driver_number", "lap_number", "date_start"]
    rows = t["laps"].select(*keys[:3], F.to_date("date_start").alias("date_start"), "lap_time", "compound")
    upsert_path(t.spark, path, rows.where("lap_number % 2 = 0"), keys, ["compound"], ["date_start"])
    later = rows.where("lap_number % 3 = 0").withColumns({"lap_time": F.col("lap_time") + 1, "compound": F.lit("WET")})
    upsert_path(t.spark, path, later.unionByName(later), keys, ["compound"], ["date_start"])
    return t.spark.read.parquet(path)


@query("lake_ddl", """
SELECT 'lake_meetings' AS table_name, 'year' AS partition_column, CAST(year AS VARCHAR) AS partition_value, count(*) AS n FROM meetings GROUP BY year
UNION ALL SELECT 'lake_laps', 'date_start', CAST(CAST(date_start AS DATE) AS VARCHAR), count(*) FROM laps GROUP BY ALL""")
def lake_ddl(t):
    db = new_database(t, "lake")
    tables.save_table(t["meetings"], f"{db}.lake_meetings")
    tables.save_table(t["laps"].withColumn("date_start", F.to_date("date_start")), f"{db}.lake_laps")
    out = None
    for name in ("lake_meetings", "lake_laps"):
        by = catalog.TABLES[name].partition_by[0]
        part = t.spark.table(f"{db}.{name}").groupBy(F.col(by).cast("string").alias("partition_value")).agg(F.count(F.lit(1)).alias("n"))
        part = part.select(F.lit(name).alias("table_name"), F.lit(by).alias("partition_column"), "partition_value", "n")
        out = part if out is None else out.unionByName(part)
    return closed(t, db, out)


def landed(t, endpoints):
    """Raw rows of some endpoints landed as JSON, each with its season."""
    root = work_dir(t.spark, "landed")
    years = t["sessions"].select("session_key", F.col("year").cast("int").alias("year"))
    for endpoint in endpoints:
        rows = t[{"laps": "laps_dup"}.get(endpoint, endpoint)]
        rows = rows.withColumn("year", F.col("year").cast("int")) if endpoint in ("meetings", "sessions") else rows.join(years, "session_key")
        if endpoint == "laps":
            rows = rows.drop(*t.LAP_ORDER)
        writers.land(rows, root, endpoint, extracted(), "json")
    return root


@query("raw_job", """
SELECT * FROM (SELECT 'meetings' AS endpoint, CAST(year AS INT) AS year, count(*) AS records_processed, 'SUCCESS' AS status FROM meetings GROUP BY ALL
UNION ALL SELECT 'sessions', CAST(year AS INT), count(*), 'SUCCESS' FROM sessions GROUP BY ALL
UNION ALL SELECT 'drivers', CAST(s.year AS INT), count(*), 'SUCCESS' FROM drivers JOIN sessions s USING (session_key) GROUP BY ALL
UNION ALL SELECT 'laps', CAST(s.year AS INT), count(*), 'SUCCESS' FROM laps_dup JOIN sessions s USING (session_key) GROUP BY ALL
UNION ALL SELECT 'position', CAST(s.year AS INT), count(*), 'SUCCESS' FROM positions JOIN sessions s USING (session_key) GROUP BY ALL)""")
def raw_job(t):
    root = landed(t, ("meetings", "sessions", "drivers", "laps", "position"))
    return jobs.raw_job(t.spark, root, work_dir(t.spark, "processed"), processed_at=extracted())


@query("meetings_job", """
SELECT meeting_key, meeting_name, circuit_short_name, country_name, date_start, CAST(year AS INT) AS year,
  0.6::DOUBLE AS data_quality_score FROM meetings""")
def meetings_job(t):
    processed, lake = work_dir(t.spark, "processed"), work_dir(t.spark, "lake")
    jobs.raw_job(t.spark, landed(t, ("meetings",)), processed, ["meetings"], processed_at=extracted())
    rows = jobs.meetings_job(t.spark, processed, lake)
    rows = jobs.meetings_job(t.spark, processed, lake)  # once more: nothing is added
    return rows.select(*MEETING, "data_quality_score").withColumn("date_start", F.col("date_start").cast("timestamp_ntz"))


@query("laps_job", f"""
SELECT session_key, driver_number, lap_number, CAST(date_start AS DATE) AS date_start, lap_duration, lap_time, i1_speed, compound,
  {SQL_LAP_SCORE} AS data_completeness_score FROM
(SELECT *, row_number() OVER (PARTITION BY session_key, driver_number, lap_number, CAST(date_start AS DATE) ORDER BY lap_duration NULLS LAST,
  lap_time NULLS LAST, i1_speed NULLS LAST, i2_speed NULLS LAST, st_speed NULLS LAST, compound NULLS LAST, tyre_life, fresh_tyre) AS rn
 FROM laps_dup WHERE {SQL_LAP_RULES}) WHERE rn = 1""")
def laps_job(t):
    processed, lake = work_dir(t.spark, "processed"), work_dir(t.spark, "lake")
    jobs.raw_job(t.spark, landed(t, ("laps",)), processed, ["laps"], processed_at=extracted())
    rows = jobs.laps_job(t.spark, processed, lake)
    return rounded(rows.select("session_key", "driver_number", "lap_number", "date_start", "lap_duration", "lap_time", "i1_speed",
                               "compound", "data_completeness_score"))


@query("sessions_job", """
SELECT session_key, session_name, session_type, date_start, date_end, meeting_key, CAST(year AS INT) AS year FROM sessions""")
def sessions_job(t):
    processed, lake = work_dir(t.spark, "processed"), work_dir(t.spark, "lake")
    jobs.raw_job(t.spark, landed(t, ("sessions",)), processed, ["sessions"], processed_at=extracted())
    rows = jobs.sessions_job(t.spark, processed, lake).drop("processing_timestamp", "gmt_offset")
    return rows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("date_start", "date_end")})


@query("drivers_job", """
SELECT session_key, driver_number, full_name, name_acronym, team_name, CAST(s.year AS INT) AS year FROM drivers JOIN sessions s USING (session_key)""")
def drivers_job(t):
    processed, lake = work_dir(t.spark, "processed"), work_dir(t.spark, "lake")
    jobs.raw_job(t.spark, landed(t, ("drivers",)), processed, ["drivers"], processed_at=extracted())
    rows = jobs.drivers_job(t.spark, processed, lake)
    return rows.select("session_key", "driver_number", "full_name", "name_acronym", "team_name", "year")


def analytics_database(t):
    db = new_database(t, "analytics")
    tables.create_tables(t.spark, db, "ml", work_dir(t.spark, "db"))
    return db


def per_year(t, db, names):
    out = None
    for name in names:
        part = t.spark.table(f"{db}.{name}").groupBy("year").agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "year", "n")
        out = part if out is None else out.unionByName(part)
    return out


@query("save_analytics", f"""
SELECT 'grand_prix_results' AS table_name, CAST(year AS INT) AS year, count(*) AS n FROM session_result JOIN sessions USING (session_key) GROUP BY ALL
UNION ALL SELECT 'grand_prix_performance', CAST(year AS INT), count(*) FROM drivers JOIN sessions USING (session_key) GROUP BY ALL
UNION ALL SELECT 'driver_championship_standings', CAST(year AS INT), count(*) FROM (
  SELECT k.year, k.driver_number, r.session_key FROM (SELECT year, driver_number, min(session_key) AS first FROM session_result
    JOIN sessions USING (session_key) GROUP BY ALL) k
  JOIN (SELECT DISTINCT session_key, year FROM session_result JOIN sessions USING (session_key)) r ON k.year = r.year AND r.session_key >= k.first)
GROUP BY ALL""")
def save_analytics(t):
    db = analytics_database(t)
    jobs.save_analytics(t, db, extracted())
    return closed(t, db, per_year(t, db, ("grand_prix_results", "grand_prix_performance", "driver_championship_standings")))


@query("save_features", f"""
SELECT 'driver_performance_features' AS table_name, CAST(year AS INT) AS year, count(*) AS n
FROM (SELECT s.year, count(*) OVER (PARTITION BY session_key, team_name) AS cars FROM drivers JOIN sessions s USING (session_key))
WHERE cars >= 2 GROUP BY year
UNION ALL SELECT 'race_context_features', CAST(year AS INT), count(*) FROM sessions WHERE session_type = 'Race' GROUP BY year""")
def save_features(t):
    db = analytics_database(t)
    for name, rows in (("grand_prix_results", results.gp_results(t)), ("grand_prix_performance", performance.gp_performance(t))):
        tables.save_table(rows.withColumn("created_at", extracted()), f"{db}.{name}")
    jobs.save_features(t, db, extracted())
    return closed(t, db, per_year(t, db, ("driver_performance_features", "race_context_features")))


@query("aggregator_job", f"""
SELECT CAST(year AS INT) AS year, driver_number, CAST(max(total_season_points) AS BIGINT) AS season_points, count(*) AS races
FROM {SQL_RESULTS} GROUP BY ALL""")
def aggregator_job(t):
    db = analytics_database(t)
    jobs.aggregator_job(t, db, extracted())
    rows = t.spark.table(f"{db}.grand_prix_results")
    return closed(t, db, rows.groupBy("year", "driver_number").agg(
        F.max("total_season_points").cast("bigint").alias("season_points"), F.count(F.lit(1)).alias("races")))

"""Joins: calendar, first match, outer, interval, nearest, range, star and anti."""

from pyspark.sql import functions as F

from pitwall.operators import joins
from pitwall.plans import features, results
from pitwall.plans.reports import valid_times
from pitwall.plans.results import DRIVER
from pitwall.plans.sessions import sessions_with_meeting
from suite.registry import query


@query("join_sessions_meetings", """
SELECT session_key, s.year, session_name, meeting_name, circuit_short_name, m.date_start AS race_date
FROM sessions s JOIN meetings m USING (meeting_key)""")
def join_sessions_meetings(t):
    return sessions_with_meeting(t).select("session_key", "year", "session_name", "meeting_name", "circuit_short_name", "race_date")


@query("join_result_driver", """
SELECT session_key, driver_number, position, full_name, name_acronym, team_name
FROM session_result JOIN drivers USING (session_key, driver_number)""")
def join_result_driver(t):
    rows = t["session_result"].join(results.entrants(t["drivers"]), DRIVER)
    return rows.select(*DRIVER, "position", "full_name", "name_acronym", "team_name")


@query("join_left_grid", """
SELECT r.session_key, r.driver_number, r.position, g.position AS starting_grid_position
FROM session_result r LEFT JOIN starting_grid g USING (session_key, driver_number)""")
def join_left_grid(t):
    grid = results.grid_positions(t["starting_grid"])
    return t["session_result"].join(grid, DRIVER, "left").select(*DRIVER, "position", "starting_grid_position")


@query("join_left_fastest", """
SELECT r.session_key, r.driver_number, f.fastest_lap FROM session_result r
LEFT JOIN (SELECT session_key, driver_number, min(lap_duration) AS fastest_lap FROM laps
  WHERE lap_duration IS NOT NULL GROUP BY ALL) f USING (session_key, driver_number)""")
def join_left_fastest(t):
    best = results.fastest_laps(t["laps"])
    return t["session_result"].join(best, DRIVER, "left").select(*DRIVER, "fastest_lap")


SQL_PENALTIES = """(SELECT session_key, driver_number,
  CAST(sum(CAST(regexp_extract(message, '([0-9]+) SECOND TIME PENALTY', 1) AS INT)) AS BIGINT) AS penalty_seconds
  FROM race_control WHERE message LIKE '% SECOND TIME PENALTY%' GROUP BY ALL)"""


@query("join_left_penalty", f"""
SELECT r.session_key, r.driver_number, coalesce(p.penalty_seconds, 0) AS total_time_penalty
FROM session_result r LEFT JOIN {SQL_PENALTIES} p USING (session_key, driver_number)""")
def join_left_penalty(t):
    rows = t["session_result"].join(results.penalties(t["race_control"]), DRIVER, "left")
    return rows.select(*DRIVER, F.coalesce("penalty_seconds", F.lit(0)).alias("total_time_penalty"))


@query("join_left_conditional", """
SELECT s.session_key, d.driver_number, s.session_name, r.position
FROM drivers d JOIN sessions s USING (session_key)
LEFT JOIN (SELECT meeting_key, driver_number, position FROM session_result JOIN sessions USING (session_key)) r
  ON s.meeting_key = r.meeting_key AND d.driver_number = r.driver_number AND s.session_name = 'Race'""")
def join_left_conditional(t):
    entries = t["drivers"].select(*DRIVER).join(t["sessions"].select("session_key", "meeting_key", "session_name"), "session_key")
    outcome = t["session_result"].join(t["sessions"], "session_key").select(
        F.col("meeting_key").alias("r_meeting"), F.col("driver_number").alias("r_driver"), "position")
    on = ((F.col("meeting_key") == F.col("r_meeting")) & (F.col("driver_number") == F.col("r_driver"))
          & (F.col("session_name") == "Race"))
    return entries.join(outcome, on, "left").select("session_key", "driver_number", "session_name", "position")


@query("interval_join", """
SELECT l.session_key, l.driver_number, l.lap_number, p.date, p.position
FROM laps l JOIN positions p ON l.session_key = p.session_key AND l.driver_number = p.driver_number
  AND abs(epoch(l.date_start) - epoch(p.date)) < 30
WHERE l.lap_duration IS NOT NULL""")
def interval_join(t):
    laps = t["laps"].where("lap_duration IS NOT NULL").select(*DRIVER, "lap_number", "date_start")
    samples = t["position"].select(*DRIVER, "date", "position")
    pairs = joins.interval_join(laps, samples, DRIVER, "date_start", "date", 30)
    return pairs.select(*DRIVER, "lap_number", "date", "position")


SQL_NEAREST = """(SELECT * FROM (SELECT l.session_key, l.driver_number, l.lap_number, l.lap_duration, l.date_start, p.date, p.position,
    row_number() OVER (PARTITION BY l.session_key, l.driver_number, l.lap_number
      ORDER BY abs(epoch(l.date_start) - epoch(p.date)), p.date, p.position) AS rn
  FROM laps l JOIN positions p ON l.session_key = p.session_key AND l.driver_number = p.driver_number
    AND abs(epoch(l.date_start) - epoch(p.date)) < 30 WHERE l.lap_duration IS NOT NULL) WHERE rn = 1)"""


@query("asof_nearest", f"SELECT session_key, driver_number, lap_number, date, position FROM {SQL_NEAREST}")
def asof_nearest(t):
    laps = t["laps"].where("lap_duration IS NOT NULL").select(*DRIVER, "lap_number", "date_start")
    samples = t["position"].select(*DRIVER, "date", "position")
    near = joins.nearest_join(laps, samples, DRIVER, "date_start", "date", 30, ["position"])
    return near.select(*DRIVER, "lap_number", "date", "position")


@query("range_join_stints", """
SELECT session_key, driver_number, lap_number, compound, tire_age FROM (
  SELECT l.session_key, l.driver_number, l.lap_number, s.compound, s.tyre_age_at_start + l.lap_number - s.lap_start AS tire_age,
    row_number() OVER (PARTITION BY l.session_key, l.driver_number, l.lap_number ORDER BY s.lap_start NULLS LAST) AS rn
  FROM laps l LEFT JOIN (SELECT * FROM stints WHERE driver_number <> 3) s ON l.session_key = s.session_key AND l.driver_number = s.driver_number
    AND l.lap_number BETWEEN s.lap_start AND s.lap_end) WHERE rn = 1""")
def range_join_stints(t):
    laps = t["laps"].select(*DRIVER, "lap_number")
    stints = t["stints"].where("driver_number <> 3").select(  # a driver without stints keeps their laps
        *DRIVER, "lap_start", "lap_end", F.col("compound"), "tyre_age_at_start")
    rows = joins.range_join(laps, stints, DRIVER, "lap_number", "lap_start", "lap_end",
                            [F.asc_nulls_last("lap_start")])
    return rows.select(*DRIVER, "lap_number", "compound",
                       (F.col("tyre_age_at_start") + F.col("lap_number") - F.col("lap_start")).alias("tire_age"))


@query("join_weather_sessions", """
SELECT session_key, round(avg(air_temperature) + 1e-9, 6) AS air_temperature, round(avg(track_temperature) + 1e-9, 6) AS track_temperature
FROM weather JOIN sessions USING (session_key) WHERE year = 2021 GROUP BY ALL""")
def join_weather_sessions(t):
    of_year = t["weather"].join(t["sessions"].where("year = 2021").select("session_key"), "session_key")
    return rounded(features.weather_context(of_year))


def rounded(df):
    """Doubles to six digits, since sums run in different orders.

    Half-way values are nudged first, here and in the SQL: means of thousandths over 16 or
    32 laps fall on them exactly, and either engine may sit a hair below.
    """
    return df.withColumns({f.name: F.round(F.col(f.name) + 1e-9, 6) for f in df.schema if f.dataType.typeName() == "double"})


@query("lookup_session_key", """
SELECT w.year, w.meeting_name, w.session_name, s.session_key
FROM (SELECT year, meeting_name, unnest(['Race', 'Qualifying', 'Warm-up']) AS session_name FROM meetings) w
LEFT JOIN (SELECT s.year, meeting_name, session_name, session_key FROM sessions s JOIN meetings USING (meeting_key)) s
  USING (year, meeting_name, session_name)""")
def lookup_session_key(t):
    names = F.explode(F.array(F.lit("Race"), F.lit("Qualifying"), F.lit("Warm-up"))).alias("session_name")
    wanted = t["meetings"].select("year", "meeting_name", names)
    dim = sessions_with_meeting(t).select("year", "meeting_name", "session_name", "session_key")
    return joins.lookup(wanted, dim, ["year", "meeting_name", "session_name"], {"session_key": "session_key"})


@query("lookup_track", """
SELECT meeting_key, circuit_short_name, circuit_length, number_of_turns, overtaking_difficulty FROM meetings
LEFT JOIN (VALUES ('Monaco', 3.337::DOUBLE, 19, 0.9::DOUBLE), ('Monza', 5.793::DOUBLE, 11, 0.3::DOUBLE),
  ('Silverstone', 5.891::DOUBLE, 18, 0.5::DOUBLE)) v(circuit_short_name, circuit_length, number_of_turns, overtaking_difficulty)
USING (circuit_short_name)""")
def lookup_track(t):
    tracks = F.broadcast(features.track_dim(t.spark))
    rows = t["meetings"].select("meeting_key", "circuit_short_name")
    return rows.join(tracks, "circuit_short_name", "left")


def star(t, how="inner"):
    return joins.star(valid_times(t["laps"]), t["drivers"], t["sessions"], t["meetings"], how=how)


SQL_STAR = """laps l {how} JOIN drivers d USING (session_key, driver_number)
  JOIN sessions s USING (session_key) JOIN meetings m USING (meeting_key)"""


@query("star_join_4way", f"""
SELECT session_key, driver_number, lap_number, lap_time, full_name, team_name, session_name, meeting_name, m.year
FROM {SQL_STAR.format(how="")} WHERE lap_time > 0""")
def star_join_4way(t):
    return star(t).select("session_key", "driver_number", "lap_number", "lap_time", "full_name", "team_name",
                          "session_name", "meeting_name", "year")


@query("star_join_left", f"""
SELECT session_key, driver_number, lap_number, lap_time, d.team_name, session_type, country_name, m.year
FROM laps l LEFT JOIN (SELECT * FROM drivers WHERE driver_number <> 2) d USING (session_key, driver_number)
  JOIN sessions s USING (session_key) JOIN meetings m USING (meeting_key) WHERE lap_time > 0""")
def star_join_left(t):
    known = t["drivers"].where("driver_number <> 2")
    rows = joins.star(valid_times(t["laps"]), known, t["sessions"], t["meetings"], how="left")
    return rows.select("session_key", "driver_number", "lap_number", "lap_time", "team_name", "session_type", "country_name", "year")


@query("join_positions_star", """
SELECT session_key, driver_number, p.date, p.position, full_name, team_name, meeting_name, m.year
FROM positions p JOIN drivers d USING (session_key, driver_number) JOIN sessions s USING (session_key)
  JOIN meetings m USING (meeting_key) WHERE session_type = 'Race'""")
def join_positions_star(t):
    rows = joins.star(t["position"], t["drivers"], t["sessions"], t["meetings"]).where("session_type = 'Race'")
    return rows.select("session_key", "driver_number", "date", "position", "full_name", "team_name", "meeting_name", "year")


@query("fk_anti", """
SELECT session_key, driver_number, count(*) AS laps FROM laps l
WHERE NOT EXISTS (SELECT 1 FROM sessions s WHERE s.session_key = l.session_key AND s.session_type <> 'Race') GROUP BY ALL""")
def fk_anti(t):
    listed = t["sessions"].where("session_type <> 'Race'")
    return joins.orphans(t["laps"], listed, "session_key").groupBy(*DRIVER).agg(F.count(F.lit(1)).alias("laps"))

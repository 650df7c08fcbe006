"""Ranks, running totals, gaps, neighbours and relative pace."""

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from pitwall.functions.scalars import points
from pitwall.operators import windows
from pitwall.plans import features, reports
from pitwall.plans.performance import lap_perf
from pitwall.plans.results import DRIVER, season_context
from pitwall.plans.sessions import race_rounds, sessions_with_meeting
from suite.aggregates import SQL_POINTS, SQL_TEAM
from suite.joining import SQL_STAR, rounded
from suite.registry import query


@query("rank_fastest_lap", f"""
SELECT * EXCLUDE (rn) FROM (SELECT full_name AS driver_name, team_name, lap_time, meeting_name, session_name, lap_number,
    row_number() OVER (PARTITION BY driver_number ORDER BY lap_time, session_key, lap_number) AS rn
  FROM {SQL_STAR.format(how="")} WHERE lap_time > 0 AND session_type = 'Race') WHERE rn = 1""")
def rank_fastest_lap(t):
    return reports.best_lap_per_driver(t)


@query("rank_championship", f"""
SELECT year, driver_number, CAST(sum(p) AS BIGINT) AS season_points, CAST(rank() OVER (PARTITION BY year ORDER BY sum(p) DESC) AS INT) AS rank
FROM (SELECT year, driver_number, {SQL_POINTS.format(p="position")} AS p FROM session_result JOIN sessions USING (session_key))
GROUP BY year, driver_number""")
def rank_championship(t):
    rows = t["session_result"].join(t["sessions"].select("session_key", "year"), "session_key")
    season = rows.groupBy("year", "driver_number").agg(F.sum(points("position")).alias("season_points"))
    return season.withColumn("rank", F.rank().over(W.partitionBy("year").orderBy(F.desc("season_points"))))


@query("rank_team_pace", f"SELECT team_name, year, performance_rank FROM ({SQL_TEAM})")
def rank_team_pace(t):
    return reports.team_performance(t).select("team_name", "year", "performance_rank")


@query("running_total", """
SELECT session_key, driver_number, lap_number, round(sum(lap_duration) OVER (PARTITION BY driver_number
  ORDER BY session_key, lap_number ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 3) AS running_total
FROM laps WHERE lap_duration IS NOT NULL""")
def running_total(t):
    # A driver's whole career is one group, so it is summed by session first.
    timed = t["laps"].where("lap_duration IS NOT NULL").select(*DRIVER, "lap_number", "lap_duration")
    total = windows.running_total(timed, ["driver_number"], ["session_key", "lap_number"], "lap_duration", block="session_key")
    return total.select(*DRIVER, "lap_number", F.round("running_total", 3).alias("running_total"))


def race_points(t):
    races = race_rounds(sessions_with_meeting(t)).select("session_key", "year", "race_round", F.col("race_date").alias("date"))
    return t["session_result"].join(races, "session_key").select(
        "year", "race_round", "date", "driver_number", points("position").alias("points"))


SQL_RACE_POINTS = f"""(SELECT year, race_round, date, driver_number, CAST(sum(points) OVER (PARTITION BY year, driver_number
    ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS total_season_points
  FROM (SELECT year, race_round, r.race_date AS date, driver_number, {SQL_POINTS.format(p="position")} AS points
    FROM session_result JOIN (SELECT s.*, m.date_start AS race_date, dense_rank() OVER (PARTITION BY s.year ORDER BY s.date_start) AS race_round
      FROM sessions s JOIN meetings m USING (meeting_key) WHERE session_type = 'Race') r USING (session_key)))"""


@query("position_on_date", f"""
SELECT year, date, driver_number, total_season_points,
  CAST(row_number() OVER (PARTITION BY year, date ORDER BY total_season_points DESC, driver_number) AS INT) AS ranking,
  max(total_season_points) OVER (PARTITION BY year, date) - total_season_points AS points_from_first FROM {SQL_RACE_POINTS}""")
def position_on_date(t):
    rows = season_context(race_points(t))
    return rows.select("year", "date", "driver_number", "total_season_points",
                       F.col("drivers_championship_ranking").alias("ranking"), "points_from_first")


@query("gap_to_leader_next", f"""
SELECT year, CAST(race_round AS INT) AS race_round, driver_number, CAST(row_number() OVER w AS INT) AS position,
  first_value(total_season_points) OVER w - total_season_points AS points_behind_leader,
  coalesce(total_season_points - lead(total_season_points) OVER w, 0) AS points_ahead_next
FROM {SQL_RACE_POINTS} WINDOW w AS (PARTITION BY year, race_round ORDER BY total_season_points DESC, driver_number)""")
def gap_to_leader_next(t):
    table = W.partitionBy("year", "race_round").orderBy(F.desc("total_season_points"), "driver_number")
    total = F.col("total_season_points")
    return season_context(race_points(t)).select(
        "year", "race_round", "driver_number", F.row_number().over(table).alias("position"),
        (F.first(total).over(table) - total).alias("points_behind_leader"),
        F.coalesce(total - F.lead(total).over(table), F.lit(0)).alias("points_ahead_next"))


@query("race_round", """
SELECT session_key, s.year, meeting_name, CAST(dense_rank() OVER (PARTITION BY s.year ORDER BY s.date_start, meeting_name) AS INT) AS race_round
FROM sessions s JOIN meetings m USING (meeting_key) WHERE session_type = 'Race'""")
def race_round(t):
    return race_rounds(sessions_with_meeting(t)).select("session_key", "year", "meeting_name", "race_round")


@query("neighbour_cars", """
SELECT session_key, lap_number, driver_number, lag(driver_number) OVER w AS driver_ahead, lead(driver_number) OVER w AS driver_behind,
  lead(lap_duration) OVER w AS lap_behind, lag(lap_duration) OVER w AS lap_ahead,
  lag(driver_number) OVER w IS NOT NULL AS has_car_ahead, lead(driver_number) OVER w IS NOT NULL AS has_car_behind
FROM laps WHERE lap_duration IS NOT NULL WINDOW w AS (PARTITION BY session_key, lap_number ORDER BY lap_duration, driver_number)""")
def neighbour_cars(t):
    timed = t["laps"].where("lap_duration IS NOT NULL").select(*DRIVER, "lap_number", "lap_duration")
    rows = windows.neighbours(timed, ["session_key", "lap_number"], ["lap_duration", "driver_number"],
                              {"driver_number": "driver", "lap_duration": "lap"})
    return rows.drop("lap_duration")


SQL_BEST = """(SELECT session_key, driver_number, team_name, best FROM drivers LEFT JOIN (SELECT session_key, driver_number,
  min(lap_duration) AS best FROM laps WHERE lap_duration IS NOT NULL AND NOT is_pit_out_lap GROUP BY ALL)
  USING (session_key, driver_number))"""


def best_of_entrants(t):
    best = lap_perf(t["laps"]).select(*DRIVER, F.col("best_lap_time").alias("best"))
    return t["drivers"].select(*DRIVER, "team_name").join(best, DRIVER, "left")


@query("teammate_delta", f"""
SELECT a.session_key, a.driver_number, round(a.best - avg(b.best) + 1e-9, 6) AS pace_vs_teammate FROM {SQL_BEST} a
LEFT JOIN {SQL_BEST} b ON a.session_key = b.session_key AND a.team_name = b.team_name AND a.driver_number <> b.driver_number
GROUP BY a.session_key, a.driver_number, a.best""")
def teammate_delta(t):
    rows = windows.leave_one_out(best_of_entrants(t), ["session_key", "team_name"], "best", "pace_vs_teammate")
    return rounded(rows.select(*DRIVER, "pace_vs_teammate"))


@query("field_delta", f"""
SELECT session_key, driver_number, round(best - avg(best) OVER (PARTITION BY session_key) + 1e-9, 6) AS pace_vs_field FROM {SQL_BEST}""")
def field_delta(t):
    rows = windows.field_delta(best_of_entrants(t), ["session_key"], "best", "pace_vs_field")
    return rounded(rows.select(*DRIVER, "pace_vs_field"))


@query("team_size_filter", """
SELECT session_key, driver_number, team_name FROM (SELECT *, count(*) OVER (PARTITION BY session_key, team_name) AS n FROM drivers)
WHERE n >= 2""")
def team_size_filter(t):
    return windows.at_least(t["drivers"].select(*DRIVER, "team_name"), ["session_key", "team_name"], 2)


@query("first_seen_attrs", """
SELECT year, driver_number, arg_min(full_name, session_key) AS driver_name, arg_min(team_name, session_key) AS team_name
FROM drivers JOIN sessions USING (session_key) GROUP BY ALL""")
def first_seen_attrs(t):
    rows = t["drivers"].join(t["sessions"].select("session_key", "year"), "session_key")
    return rows.groupBy("year", "driver_number").agg(
        F.min_by("full_name", "session_key").alias("driver_name"), F.min_by("team_name", "session_key").alias("team_name"))


SQL_SPEED_RANKS = """(SELECT session_key, driver_number,
  CAST(rank() OVER (PARTITION BY session_key ORDER BY max(st_speed) DESC NULLS LAST) AS INT) AS straight_line_speed_rank,
  CAST(rank() OVER (PARTITION BY session_key ORDER BY round(avg((i1_speed + i2_speed) / 2), 9) DESC NULLS LAST) AS INT) AS cornering_speed_rank
  FROM laps GROUP BY session_key, driver_number)"""


@query("speed_ranks", f"SELECT * FROM {SQL_SPEED_RANKS}")
def speed_ranks(t):
    return features.speed_ranks(t["laps"])


@query("consistency", """
SELECT session_key, driver_number, round(stddev_samp(lap_duration) + 1e-9, 6) AS consistency_score FROM laps GROUP BY ALL""")
def consistency(t):
    return rounded(features.consistency(t["laps"]))

"""Sorts and top-n."""

from pyspark.sql import functions as F

from pitwall.operators import clean
from pitwall.plans import reports
from suite.aggregates import lake_laps
from suite.joining import SQL_STAR
from suite.registry import query


@query("order_by", """
SELECT session_key, lap_number, driver_number, lap_duration FROM laps
ORDER BY session_key DESC, lap_number, lap_duration DESC NULLS LAST, driver_number""")
def order_by(t):
    rows = t["laps"].select("session_key", "lap_number", "driver_number", "lap_duration")
    return rows.orderBy(F.desc("session_key"), "lap_number", F.desc_nulls_last("lap_duration"), "driver_number")


@query("topk_fastest_laps", f"""
SELECT driver_name, team_name, lap_time, meeting_name, session_name, lap_number FROM (
  SELECT full_name AS driver_name, team_name, lap_time, meeting_name, session_name, lap_number,
    row_number() OVER (PARTITION BY driver_number ORDER BY lap_time, session_key, lap_number) AS rn
  FROM {SQL_STAR.format(how="")} WHERE lap_time > 0 AND session_type = 'Race')
WHERE rn = 1 ORDER BY lap_time, driver_name LIMIT 10""")
def topk_fastest_laps(t):
    return reports.fastest_drivers(t)


@query("limit_latest_dates", """
SELECT CAST(date_start AS DATE) AS date_start, count(*) AS total_laps FROM laps GROUP BY ALL ORDER BY 1 DESC LIMIT 10""")
def limit_latest_dates(t):
    return reports.lap_stats(lake_laps(t)).select("date_start", "total_laps")


@query("last_n_sessions", "SELECT session_key, session_name, date_start FROM sessions ORDER BY date_start DESC LIMIT 5")
def last_n_sessions(t):
    rows = t["sessions"].select("session_key", "session_name", "date_start")
    return clean.last_n(rows, [F.desc("date_start")], 5)

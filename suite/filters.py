"""Row filters: equality, null guards, ranges, text and semi-joins."""

from pyspark.sql import functions as F

from pitwall.functions.scalars import contains_text
from pitwall.operators import clean
from pitwall.operators.joins import semi
from pitwall.operators.upsert import upsert_path
from pitwall.plans import reports
from pitwall.session import work_dir
from pitwall.sources import readers
from suite.registry import query
from suite.scans import landed_laps


@query("filter_year_type", "SELECT * FROM sessions WHERE year = 2020 AND session_type = 'Race'")
def filter_year_type(t):
    return t["sessions"].where((F.col("year") == 2020) & (F.col("session_type") == "Race"))


@query("filter_notnull", """
SELECT session_key, driver_number, lap_number, lap_duration FROM laps WHERE lap_duration IS NOT NULL AND lap_time IS NOT NULL""")
def filter_notnull(t):
    rows = t["laps"].where(F.col("lap_duration").isNotNull() & F.col("lap_time").isNotNull())
    return rows.select("session_key", "driver_number", "lap_number", "lap_duration")


FLAG = "CASE WHEN driver_number <> 3 THEN is_pit_out_lap END"


@query("filter_flag", f"SELECT session_key, driver_number, lap_number FROM laps WHERE NOT ({FLAG})")
def filter_flag(t):
    # An unknown flag is not a "no": such rows go.
    return t["laps"].where(~F.expr(FLAG)).select("session_key", "driver_number", "lap_number")


@query("validate_meetings", """
SELECT meeting_key, CAST(year + meeting_key % 8 AS BIGINT) AS year, meeting_name, country_name AS location,
  CASE WHEN meeting_key % 3 = 0 THEN 'Grand Prix' END AS meeting_official_name,
  CASE WHEN meeting_key % 3 = 0 THEN 1.0::DOUBLE ELSE 0.8::DOUBLE END AS data_quality_score
FROM meetings WHERE year + meeting_key % 8 BETWEEN 2018 AND 2030 AND meeting_key % 9 <> 0""")
def validate_meetings(t):
    key = F.col("meeting_key")
    rows = t["meetings"].select(
        "meeting_key", (F.col("year") + key % 8).alias("year"), F.when(key % 9 != 0, F.col("meeting_name")).alias("meeting_name"),
        F.col("country_name").alias("location"), F.when(key % 3 == 0, F.lit("Grand Prix")).alias("meeting_official_name"),
    )
    return clean.valid_meetings(rows)


# Bad rows are made by arithmetic: lap numbers past 200, driver 0, a speed of 0.
ODD_LAPS = {"driver_number": "driver_number - 1", "lap_number": "lap_number * 5", "st_speed": "st_speed - 320",
            "tyre_life": "tyre_life - 1"}


def odd_laps(t):
    rows = t["laps"].select("session_key", "driver_number", "lap_number", "date_start", "lap_time", "lap_duration",
                            "i1_speed", "i2_speed", "st_speed", "tyre_life", "compound")
    return rows.withColumns({c: F.expr(e) for c, e in ODD_LAPS.items()})


SQL_ODD_LAPS = """SELECT session_key, driver_number - 1 AS driver_number, lap_number * 5 AS lap_number, date_start, lap_time,
  lap_duration, i1_speed, i2_speed, st_speed - 320 AS st_speed, tyre_life - 1 AS tyre_life, compound FROM laps"""
SQL_LAP_RULES = """session_key IS NOT NULL AND date_start IS NOT NULL AND lap_number > 0 AND lap_number < 200
  AND driver_number BETWEEN 1 AND 99 AND coalesce(lap_time > 0, true) AND coalesce(lap_duration > 0, true)
  AND coalesce(i1_speed > 0, true) AND coalesce(i2_speed > 0, true) AND coalesce(st_speed > 0, true)
  AND coalesce(tyre_life >= 0, true)"""
SQL_LAP_SCORE = """round((lap_time IS NOT NULL)::INT * 0.3::DOUBLE + (i1_speed IS NOT NULL)::INT * 0.2::DOUBLE
  + (i2_speed IS NOT NULL)::INT * 0.2::DOUBLE + (st_speed IS NOT NULL)::INT * 0.2::DOUBLE + (compound IS NOT NULL)::INT * 0.1::DOUBLE + 1e-9, 6)"""


@query("validate_laps", f"""
SELECT session_key, driver_number, lap_number, lap_time, st_speed, tyre_life, {SQL_LAP_SCORE} AS data_completeness_score
FROM ({SQL_ODD_LAPS}) WHERE {SQL_LAP_RULES}""")
def validate_laps(t):
    return clean.valid_laps(odd_laps(t)).select(
        "session_key", "driver_number", "lap_number", "lap_time", "st_speed", "tyre_life",
        F.round("data_completeness_score", 6).alias("data_completeness_score"))


@query("filter_like", """
SELECT session_key, date, driver_number, category, flag FROM race_control WHERE category LIKE '%Safety%' OR flag LIKE '%RED%'""")
def filter_like(t):
    rows = t["race_control"].where(contains_text("category", "Safety") | contains_text("flag", "RED"))
    return rows.select("session_key", "date", "driver_number", "category", "flag")


@query("filter_in_subquery", """
SELECT session_key, driver_number, lap_start, lap_end, compound, tyre_age_at_start FROM stints
WHERE session_key IN (SELECT DISTINCT session_key FROM sessions WHERE year = 2022 AND session_type = 'Race')""")
def filter_in_subquery(t):
    races = t["sessions"].where("year = 2022 AND session_type = 'Race'").select("session_key")
    return semi(t["stints"], races, ["session_key"]).select(
        "session_key", "driver_number", "lap_start", "lap_end", "compound", "tyre_age_at_start")


@query("filter_name_contains", """
SELECT session_key, session_name FROM sessions
WHERE lower(session_name) LIKE '%race%' OR lower(session_name) LIKE '%qualifying%'""")
def filter_name_contains(t):
    return clean.name_contains(t["sessions"], "session_name", "race", "qualifying").select("session_key", "session_name")


@query("filter_positive_laps", """
SELECT session_key, driver_number, lap_number, lap_time FROM laps WHERE lap_time IS NOT NULL AND lap_time > 0""")
def filter_positive_laps(t):
    return reports.valid_times(t["laps"]).select("session_key", "driver_number", "lap_number", "lap_time")


@query("having_min_count", """
SELECT session_key, driver_number, count(lap_number) AS total_laps FROM laps WHERE lap_time > 0
GROUP BY ALL HAVING count(lap_number) >= 10""")
def having_min_count(t):
    per = reports.valid_times(t["laps"]).groupBy("session_key", "driver_number").agg(F.count("lap_number").alias("total_laps"))
    return per.where("total_laps >= 10")


@query("filter_by_endpoint_param", """
SELECT session_key, driver_number, lap_number, lap_time FROM laps WHERE session_key = 90""")
def filter_by_endpoint_param(t):
    raw = readers.scan_raw(t.spark, landed_laps(t, "parquet"), "laps", session_key=90)
    return raw.select("session_key", "driver_number", "lap_number", "lap_time")


@query("partition_filter", """
SELECT CAST(date_start AS DATE) AS day, count(*) AS n, count(DISTINCT driver_number) AS drivers
FROM laps WHERE date_start < TIMESTAMP '2021-01-01' GROUP BY ALL""")
def partition_filter(t):
    # All day partitions merge in one statement; a date filter then reads only its own.
    path, keys = work_dir(t.spark, "days"), ["session_key", "driver_number", "lap_number", "day"]
    rows = t["laps"].select(*keys[:3], F.to_date("date_start").alias("day"))
    upsert_path(t.spark, path, rows, keys, ["session_key"], ["day"])
    days = t.spark.read.parquet(path).where("day < DATE'2021-01-01'")
    return days.groupBy("day").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("driver_number").alias("drivers"))

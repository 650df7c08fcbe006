"""Single expressions over whole tables."""

from pyspark.sql import functions as F

from pitwall.functions import scalars
from pitwall.plans.performance import tires
from suite.aggregates import SQL_POINTS
from suite.registry import query

LAP = ["session_key", "driver_number", "lap_number"]
ID = ", ".join(LAP)


def lap_query(name, sql, source="laps"):
    """A query of the lap keys plus expressions."""

    def wrap(columns):
        query(name, f"SELECT {ID}, {sql} FROM {source}")(lambda t: t["laps"].select(*LAP, *columns(t)))
        return columns

    return wrap


@query("scalar_points_lookup", f"""
SELECT session_key, driver_number, position, {SQL_POINTS.format(p="position")} AS points FROM session_result""")
def points_lookup(t):
    return t["session_result"].select("session_key", "driver_number", "position", scalars.points("position").alias("points"))


@lap_query("scalar_case_score", "CASE WHEN lap_time IS NOT NULL THEN 0.3::DOUBLE ELSE 0.0::DOUBLE END AS score")
def case_score(t):
    return [scalars.weight_if_present("lap_time", 0.3).alias("score")]


@lap_query("scalar_null_or_valid", "i1_speed IS NULL OR i1_speed > 270 AS ok")
def null_or_valid(t):
    return [scalars.null_or("i1_speed", F.col("i1_speed") > 270).alias("ok")]


@lap_query("scalar_default", "coalesce(lap_time, 0) AS lap_time_or_zero")
def default(t):
    return [F.coalesce("lap_time", F.lit(0.0)).alias("lap_time_or_zero")]


@lap_query("scalar_null_guard", "round(i2_speed - i1_speed + 1e-9, 6) AS gain")
def null_guard(t):
    return [F.round(F.col("i2_speed") - F.col("i1_speed"), 6).alias("gain")]


@lap_query("scalar_epoch_delta",
           "CAST(abs(epoch(date_start) - epoch(TIMESTAMP '2020-06-01 12:00:30')) AS BIGINT) AS seconds_apart")
def epoch_delta(t):
    return [scalars.abs_seconds("date_start", F.lit("2020-06-01 12:00:30").cast("timestamp")).alias("seconds_apart")]


@lap_query("scalar_round_ratio", "round(i1_speed / st_speed * 100 + 1e-9, 6) AS ratio_pct, round(lap_duration, 3) AS seconds")
def round_ratio(t):
    return [F.round(scalars.ratio("i1_speed", "st_speed") * 100 + 1e-9, 6).alias("ratio_pct"), F.round("lap_duration", 3).alias("seconds")]


@query("scalar_pct", """
SELECT session_key, driver_number, round(coalesce(count(*) FILTER (brake > 0 AND throttle > 90) * 100.0
  / nullif(count(*) FILTER (brake > 0), 0), 0) + 1e-9, 6) AS share FROM car_data GROUP BY ALL""")
def pct(t):
    braking = F.col("brake") > 0
    per = t["car_data"].groupBy("session_key", "driver_number").agg(
        F.count_if(braking & (F.col("throttle") > 90)).alias("part"), F.count_if(braking).alias("whole"))
    return per.select("session_key", "driver_number", F.round(scalars.pct("part", "whole") + 1e-9, 6).alias("share"))


@query("scalar_cast_double", """
SELECT session_key, round(avg(CAST(lap_number AS DOUBLE)) + 1e-9, 6) AS mean_lap, max(CAST(driver_number AS DOUBLE)) AS top
FROM laps GROUP BY session_key""")
def cast_double(t):
    return t["laps"].groupBy("session_key").agg(
        F.round(F.avg(F.col("lap_number").cast("double")) + 1e-9, 6).alias("mean_lap"), F.max(F.col("driver_number").cast("double")).alias("top"))


@lap_query("scalar_typed_cast", """
TRY_CAST(CASE WHEN lap_number % 4 = 0 THEN 'n/a' ELSE CAST(l_orderkey AS VARCHAR) END AS BIGINT) AS order_key,
TRY_CAST(CASE WHEN lap_number % 4 = 1 THEN '' ELSE CAST(lap_number AS VARCHAR) END AS INT) AS lap,
TRY_CAST(CASE WHEN lap_number % 4 = 2 THEN '1:30' ELSE CAST(lap_time AS VARCHAR) END AS DOUBLE) AS seconds,
TRY_CAST(CASE WHEN lap_number % 4 = 3 THEN 'maybe' ELSE CAST(fresh_tyre AS VARCHAR) END AS BOOLEAN) AS fresh""")
def typed_cast(t):
    def spoiled(c, rest, text):
        return F.when(F.col("lap_number") % 4 == rest, F.lit(text)).otherwise(F.col(c).cast("string"))

    return [
        scalars.typed(spoiled("l_orderkey", 0, "n/a"), "bigint").alias("order_key"),
        scalars.typed(spoiled("lap_number", 1, ""), "int").alias("lap"),
        scalars.typed(spoiled("lap_time", 2, "1:30"), "double").alias("seconds"),
        scalars.typed(spoiled("fresh_tyre", 3, "maybe"), "boolean").alias("fresh"),
    ]


def iso_text(t):
    text = F.concat(F.date_format("date_start", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00"))
    return F.when(F.col("lap_number") % 7 == 0, F.lit("not yet")).otherwise(text)


@lap_query("scalar_parse_ts", "CASE WHEN lap_number % 7 <> 0 THEN date_start - INTERVAL 2 HOUR END AS started")
def parse_ts(t):
    return [scalars.parse_ts(iso_text(t)).cast("timestamp_ntz").alias("started")]


@lap_query("scalar_to_date", "CASE WHEN lap_number % 7 <> 0 THEN CAST(date_start - INTERVAL 2 HOUR AS DATE) END AS day")
def to_date(t):
    return [scalars.parse_date(iso_text(t)).alias("day")]


@lap_query("scalar_date_parts", """CAST(year(date_start) AS INT) AS year, CAST(month(date_start) AS INT) AS month,
  CAST(day(date_start) AS INT) AS day""")
def date_parts(t):
    return [F.year("date_start").alias("year"), F.month("date_start").alias("month"), F.dayofmonth("date_start").alias("day")]


@lap_query("scalar_now_tag", "strftime(date_start, '%Y%m%d_%H%M%S') AS label")
def now_tag(t):
    return [scalars.stamp("date_start").alias("label")]


@query("scalar_like_contains", """
SELECT session_key, date, driver_number, coalesce(contains(category, 'Safety'), false) AS safety, coalesce(contains(flag, 'RED'), false) AS red,
  coalesce(flag LIKE '%ELL%', false) AS yellow FROM race_control""")
def like_contains(t):
    return t["race_control"].select(
        "session_key", "date", "driver_number", scalars.contains_text("category", "Safety").alias("safety"),
        scalars.contains_text("flag", "RED").alias("red"), F.coalesce(F.col("flag").like("%ELL%"), F.lit(False)).alias("yellow"))


@query("scalar_lower_contains", """
SELECT session_key, session_name, contains(lower(session_name), 'qualifying') AS is_qualifying FROM sessions""")
def lower_contains(t):
    return t["sessions"].select("session_key", "session_name", scalars.contains_any_case("session_name", "Qualifying").alias("is_qualifying"))


@lap_query("scalar_id_concat", "session_key || '_' || driver_number || '_' || compound AS id",
           "(SELECT session_key, driver_number, lap_number, CASE WHEN lap_number % 9 <> 0 THEN compound END AS compound FROM laps)")
def id_concat(t):
    kept = F.when(F.col("lap_number") % 9 != 0, F.col("compound"))
    return [scalars.surrogate_id("session_key", "driver_number", kept).alias("id")]


@query("scalar_json_array", """
SELECT session_key, driver_number, '["' || string_agg(compound, '","' ORDER BY stint_number) || '"]' AS compounds FROM stints GROUP BY ALL""")
def json_array(t):
    return tires(t["stints"]).select("session_key", "driver_number", F.to_json("tire_compounds_used").alias("compounds"))


@query("scalar_array_distinct", """
SELECT session_key, driver_number, lap_number, CASE WHEN compound = 'SOFT' THEN 'SOFT|HARD' WHEN compound = 'HARD' THEN 'HARD'
  ELSE compound || '|HARD' END AS compounds FROM laps""")
def array_distinct(t):
    used = F.array_distinct(F.array(F.col("compound"), F.lit("HARD"), F.col("compound")))
    return t["laps"].select(*LAP, F.array_join(used, "|").alias("compounds"))


@lap_query("scalar_between", "lap_number BETWEEN 10 AND 20 AS in_window")
def between(t):
    return [F.col("lap_number").between(10, 20).alias("in_window")]


@query("scalar_hash_bucket", """
SELECT full_name, count(*) AS laps, 1::BIGINT AS buckets, true AS in_range
FROM laps JOIN drivers USING (session_key, driver_number) GROUP BY ALL""")
def hash_bucket(t):
    # Which bucket a name gets is Spark's choice; that it is one, and within 1..23, is not.
    rows = t["laps"].join(t["drivers"].select("session_key", "driver_number", "full_name"), ["session_key", "driver_number"])
    per = rows.groupBy("full_name", scalars.hash_bucket("full_name", 23).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy("full_name").agg(
        F.sum("n").alias("laps"), F.count("bucket").alias("buckets"),
        F.every(F.col("bucket").between(1, 23)).alias("in_range"))


@query("scalar_tyre_age", """
SELECT session_key, driver_number, stint_number, tyre_age_at_start + lap_end - lap_start AS age_at_end FROM stints""")
def tyre_age(t):
    return t["stints"].select("session_key", "driver_number", "stint_number",
                              scalars.tyre_age("tyre_age_at_start", "lap_end", "lap_start").alias("age_at_end"))


@lap_query("scalar_flag_threshold", "coalesce(i1_speed > 280, false) AS fast, coalesce(lap_time > 120, false) AS slow")
def flag_threshold(t):
    return [scalars.flag_above("i1_speed", 280).alias("fast"), scalars.flag_above("lap_time", 120).alias("slow")]


@lap_query("scalar_row_nulls", """concat_ws('|', CASE WHEN lap_duration IS NULL THEN 'lap_duration' END,
  CASE WHEN lap_time IS NULL THEN 'lap_time' END, CASE WHEN i1_speed IS NULL THEN 'i1_speed' END) AS missing""")
def row_nulls(t):
    return [F.array_join(scalars.missing_names(["lap_duration", "lap_time", "i1_speed"]), "|").alias("missing")]

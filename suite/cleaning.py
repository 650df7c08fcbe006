"""Typed projections, de-duplication, sampling, tagging and ids."""

from pyspark.sql import functions as F

from pitwall.functions.scalars import surrogate_id
from pitwall.operators import clean
from pitwall.plans.sessions import race_rounds, sessions_with_meeting
from suite.registry import query
from suite.scans import extracted


def as_text(df, **columns):
    """The raw form of a table: every value as text, as it comes from outside."""
    return df.select(*[c.cast("string").alias(n) for n, c in columns.items()])


def iso(c):
    return F.concat(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))


def local(df):
    """Timestamps as the test tables hold them, and no processing time."""
    times = {f.name: F.col(f.name).cast("timestamp_ntz") for f in df.schema if f.dataType.typeName() == "timestamp"}
    return df.withColumns(times).drop("processing_timestamp")


@query("process_meetings", """
SELECT meeting_key, meeting_name, CAST(NULL AS VARCHAR) AS meeting_official_name, country_name AS location,
  CASE WHEN meeting_key % 5 = 0 THEN NULL ELSE meeting_key % 25 END AS country_key,
  upper(country_name[:3]) AS country_code, country_name, meeting_key % 8 AS circuit_key, circuit_short_name,
  CASE WHEN meeting_key % 4 <> 0 THEN date_start END AS date_start, CAST(year AS INT) AS year, '08:00:00' AS gmt_offset
FROM meetings WHERE meeting_key % 7 <> 0""")
def process_meetings(t):
    key = F.col("meeting_key")
    raw = as_text(
        t["meetings"], meeting_key=F.when(key % 7 != 0, key), meeting_name=F.col("meeting_name"),
        meeting_official_name=F.lit(None), location=F.col("country_name"),
        country_key=F.when(key % 5 == 0, F.lit("none")).otherwise((key % 25).cast("string")),
        country_code=F.upper(F.substring("country_name", 1, 3)), country_name=F.col("country_name"), circuit_key=key % 8,
        circuit_short_name=F.col("circuit_short_name"),
        date_start=F.when(key % 4 == 0, F.lit("to be announced")).otherwise(iso("date_start")),
        year=F.col("year"), gmt_offset=F.lit("08:00:00"),
    )
    return local(clean.process(raw, "meetings"))


@query("process_sessions", """
SELECT session_key, session_name, session_type, date_start, CASE WHEN session_key % 3 <> 0 THEN date_end END AS date_end,
  '01:00:00' AS gmt_offset, meeting_key FROM sessions WHERE session_key % 11 <> 0""")
def process_sessions(t):
    key = F.col("session_key")
    raw = as_text(
        t["sessions"], session_key=F.when(key % 11 == 0, F.lit("x")).otherwise(key.cast("string")),
        session_name=F.col("session_name"), session_type=F.col("session_type"), date_start=iso("date_start"),
        date_end=F.when(key % 3 != 0, iso("date_end")), gmt_offset=F.lit("01:00:00"), meeting_key=F.col("meeting_key"),
    )
    return local(clean.process(raw, "sessions"))


@query("process_drivers", """
SELECT driver_number, upper(full_name) AS broadcast_name, full_name, name_acronym, team_name, CAST(NULL AS VARCHAR) AS team_colour,
  'Driver' AS first_name, CAST(driver_number AS VARCHAR) AS last_name, CAST(NULL AS VARCHAR) AS headshot_url,
  CAST(NULL AS VARCHAR) AS country_code, session_key FROM drivers WHERE driver_number % 9 <> 0""")
def process_drivers(t):
    number = F.col("driver_number")
    raw = as_text(
        t["drivers"], driver_number=F.when(number % 9 != 0, number), broadcast_name=F.upper("full_name"),
        full_name=F.col("full_name"), name_acronym=F.col("name_acronym"), team_name=F.col("team_name"),
        first_name=F.lit("Driver"), last_name=number, session_key=F.col("session_key"),
    )
    return local(clean.process(raw, "drivers"))


@query("process_laps", """
SELECT CAST(date_start AS DATE) AS date_start, session_key, driver_number, lap_number,
  CASE WHEN driver_number <> 5 THEN lap_duration END AS lap_duration, lap_time, i1_speed, i2_speed, st_speed,
  is_pit_out_lap AS is_personal_best, compound, CASE WHEN lap_number % 10 <> 0 THEN tyre_life END AS tyre_life, fresh_tyre
FROM laps WHERE lap_number % 13 <> 0""")
def process_laps(t):
    lap = F.col("lap_number")
    raw = as_text(
        t["laps"], date_start=iso("date_start"), session_key=F.col("session_key"), driver_number=F.col("driver_number"),
        lap_number=F.when(lap % 13 != 0, lap),
        lap_duration=F.when(F.col("driver_number") == 5, F.lit("1:32.5")).otherwise(F.col("lap_duration").cast("string")),
        lap_time=F.col("lap_time"), i1_speed=F.col("i1_speed"), i2_speed=F.col("i2_speed"), st_speed=F.col("st_speed"),
        is_personal_best=F.col("is_pit_out_lap"), compound=F.col("compound"),
        tyre_life=F.when(lap % 10 == 0, F.lit("new")).otherwise(F.col("tyre_life").cast("string")),
        fresh_tyre=F.col("fresh_tyre"),
    )
    return local(clean.process(raw, "laps"))


@query("process_positions", """
SELECT date, session_key, driver_number, CASE WHEN position <> 3 THEN position END AS position
FROM positions WHERE driver_number <> 8""")
def process_positions(t):
    number, place = F.col("driver_number"), F.col("position")
    raw = as_text(
        t["position"], date=iso("date"), session_key=F.col("session_key"), driver_number=F.when(number != 8, number),
        position=F.when(place == 3, F.lit("P3")).otherwise(place.cast("string")),
    )
    return local(clean.process(raw, "position"))


@query("tag_metadata", """
SELECT session_key, driver_number, pit_duration, TIMESTAMP '2024-01-01' AS _extracted_at, 'pit' AS _endpoint FROM pit""")
def tag_metadata(t):
    rows = t["pit"].select("session_key", "driver_number", "pit_duration")
    return clean.tag_metadata(rows, "pit", extracted().cast("timestamp_ntz"))


@query("surrogate_id", """
SELECT r.year || '_' || r.race_round || '_' || d.driver_number AS result_id,
  r.year || '_' || session_key || '_' || d.driver_number AS performance_id,
  r.year || '_' || r.race_round AS context_id,
  r.year || '_' || r.race_round || '_' || r.session_name || '_' || d.driver_number AS feature_id
FROM (SELECT *, dense_rank() OVER (PARTITION BY year ORDER BY date_start) AS race_round FROM sessions
  WHERE session_type = 'Race') r JOIN drivers d USING (session_key)""")
def surrogate_ids(t):
    rows = t["drivers"].join(race_rounds(sessions_with_meeting(t)), "session_key")
    return rows.select(
        surrogate_id("year", "race_round", "driver_number").alias("result_id"),
        surrogate_id("year", "session_key", "driver_number").alias("performance_id"),
        surrogate_id("year", "race_round").alias("context_id"),
        surrogate_id("year", "race_round", "session_name", "driver_number").alias("feature_id"),
    )


@query("rename_project", """
SELECT d.full_name AS driver_name, d.team_name AS team, l.lap_time AS seconds, l.lap_number AS lap
FROM laps l JOIN drivers d USING (session_key, driver_number)""")
def rename_project(t):
    rows = t["laps"].join(t["drivers"], ["session_key", "driver_number"])
    return rows.select(F.col("full_name").alias("driver_name"), F.col("team_name").alias("team"),
                       F.col("lap_time").alias("seconds"), F.col("lap_number").alias("lap"))


@query("select_star_qualified", """
SELECT s.*, m.meeting_name, m.circuit_short_name, m.date_start AS race_date
FROM sessions s JOIN meetings m ON s.meeting_key = m.meeting_key""")
def select_star_qualified(t):
    s, m = t["sessions"].alias("s"), t["meetings"].alias("m")
    return s.join(m, F.col("s.meeting_key") == F.col("m.meeting_key")).select(
        "s.*", "m.meeting_name", "m.circuit_short_name", F.col("m.date_start").alias("race_date"))


@query("distinct", "SELECT DISTINCT driver_number, full_name, name_acronym, team_name FROM drivers")
def distinct(t):
    return t["drivers"].select("driver_number", "full_name", "name_acronym", "team_name").distinct()


@query("dedup_by_key", "SELECT session_key, driver_number, lap_number, lap_time, l_orderkey, l_partkey FROM laps")
def dedup_by_key(t):
    order = [F.desc(c) for c in t.LAP_ORDER]
    rows = clean.dedup(t["laps_dup"], t.LAP_KEYS, order)
    return rows.select(*t.LAP_KEYS, "lap_time", "l_orderkey", "l_partkey")


@query("union_all", """
SELECT session_key, driver_number, date, pit_duration, NULL AS air_temperature FROM pit
UNION ALL SELECT session_key, NULL, date, NULL, air_temperature FROM weather""")
def union_all(t):
    pit = t["pit"].select("session_key", "driver_number", "date", "pit_duration")
    return clean.union_all(pit, t["weather"].select("session_key", "date", "air_temperature"))


@query("sample_n", """
SELECT session_key, driver_number, lap_number FROM (SELECT *, row_number() OVER (PARTITION BY session_key
  ORDER BY md5(session_key || '|' || driver_number || '|' || lap_number || '|' || 42), session_key, driver_number, lap_number) AS rn FROM laps)
WHERE rn <= 100""")
def sample_n(t):
    rows = t["laps"].select("session_key", "driver_number", "lap_number")
    return clean.sample_per_group(rows, ["session_key"], ["session_key", "driver_number", "lap_number"], 100, 42)

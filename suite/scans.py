"""Sources and sinks: each query writes derived rows, reads them back and reports on them."""

from pyspark.sql import functions as F

from pitwall.operators import upsert
from pitwall.plans.jobs import raw_job
from pitwall.plans.reports import summary_report
from pitwall.session import work_dir
from pitwall.sources import readers, writers
from suite.registry import query

LAP_COLUMNS = ["session_key", "driver_number", "lap_number", "lap_duration", "lap_time", "compound", "date_start"]


def extracted():
    return F.lit("2024-01-01 00:00:00").cast("timestamp")


def lap_sums():
    return [
        F.count(F.lit(1)).alias("n"), F.count("lap_duration").alias("timed"), F.min("lap_duration").alias("best"),
        F.max("lap_number").alias("last_lap"), F.max("date_start").alias("latest"),
    ]


SQL_SUMS = ("count(*) AS n, count(lap_duration) AS timed, min(lap_duration) AS best, max(lap_number) AS last_lap, "
            "max(l.date_start) AS latest")


def laps_by_year(t):
    years = t["sessions"].select("session_key", F.col("year").cast("int").alias("year"))
    return t["laps"].select(*LAP_COLUMNS).join(years, "session_key")


def landed_laps(t, fmt):
    root = work_dir(t.spark, "landed")
    writers.land(laps_by_year(t), root, "laps", extracted(), fmt)
    return root


def lap_schema(t):
    return t["laps"].select(*LAP_COLUMNS).schema


@query("scan_raw_json", f"""
SELECT CAST(year AS INT) AS extraction_year, 'laps' AS endpoint, session_key, {SQL_SUMS}
FROM laps l JOIN sessions USING (session_key) WHERE year >= 2020 GROUP BY year, session_key""")
def scan_raw_json(t):
    raw = readers.scan_raw(t.spark, landed_laps(t, "json"), "laps", None, lap_schema(t), "json", min_year=2020)
    return raw.groupBy("extraction_year", "endpoint", "session_key").agg(*lap_sums())


@query("scan_json_documents", f"""
SELECT session_key, {SQL_SUMS}, (SELECT count(*) FROM sessions WHERE session_key % 7 = 3)::BIGINT AS broken_documents,
  (SELECT count(*) FROM sessions WHERE session_key % 5 = 2 AND session_key % 7 <> 3)::BIGINT AS broken_records
FROM laps l WHERE session_key % 7 <> 3 AND session_key IN (SELECT session_key FROM sessions) GROUP BY session_key""")
def scan_json_documents(t):
    """Of each session a document with an array of its laps over many lines; some are cut off, and some have a lap with a word for a number."""
    lap = F.to_json(F.struct(*LAP_COLUMNS), {"timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS", "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"})
    arrays = t["laps"].select("session_key", lap.alias("lap")).groupBy("session_key").agg(F.collect_list("lap").alias("laps"))  # of one session
    key = F.col("session_key")
    odd = F.when(key % 5 == 2, F.array(F.lit('{"session_key": "none", "lap_number": 1}'))).otherwise(F.array().cast("array<string>"))
    whole = t["sessions"].select("session_key").join(arrays, "session_key", "left").select(
        "session_key", F.concat(F.coalesce("laps", F.array().cast("array<string>")), odd).alias("laps"))
    text = F.concat(F.lit("[\n"), F.array_join("laps", ",\n"), F.when(key % 7 == 3, ",").otherwise("\n]"))
    landed, bad = work_dir(t.spark, "documents"), work_dir(t.spark, "broken")
    whole.select(text.alias("value")).repartition(8).write.option("lineSep", "\x1e").option("maxRecordsPerFile", 1).text(landed)
    schema = lap_schema(t)
    laps = readers.scan_documents(t.spark, f"{landed}/*.txt", schema, bad)
    kinds = t.spark.read.parquet(bad).agg(F.count_if(F.col("kind") == "document").alias("broken_documents"), F.count_if(F.col("kind") == "record").alias("broken_records"))
    return laps.groupBy("session_key").agg(*lap_sums()).join(F.broadcast(kinds))


@query("scan_parquet", f"SELECT session_key, {SQL_SUMS} FROM laps l GROUP BY session_key")
def scan_parquet(t):
    path = work_dir(t.spark, "parquet")
    writers.write_files(t["laps"].select(*LAP_COLUMNS), path)
    return readers.scan(t.spark, path).groupBy("session_key").agg(*lap_sums())


@query("scan_csv", f"SELECT driver_number, {SQL_SUMS} FROM laps l GROUP BY driver_number")
def scan_csv(t):
    path = work_dir(t.spark, "csv")
    writers.write_files(t["laps"].select(*LAP_COLUMNS), path, "csv")
    return readers.scan(t.spark, path, "csv", lap_schema(t)).groupBy("driver_number").agg(*lap_sums())


@query("scan_json_records", f"SELECT compound, {SQL_SUMS} FROM laps l GROUP BY compound")
def scan_json_records(t):
    path = work_dir(t.spark, "json")
    writers.write_files(t["laps"].select(*LAP_COLUMNS), path, "json")
    return readers.scan(t.spark, path, "json", lap_schema(t)).groupBy("compound").agg(*lap_sums())


@query("sink_files", f"""
SELECT format, session_key, {SQL_SUMS} FROM laps l, (SELECT unnest(['parquet', 'csv', 'json']) AS format)
GROUP BY format, session_key""")
def sink_files(t):
    parts = []
    for fmt in readers.FORMATS:
        path = work_dir(t.spark, "sink")
        writers.write_files(t["laps"].select(*LAP_COLUMNS), path, fmt)
        back = readers.scan(t.spark, path, fmt, lap_schema(t))
        parts.append(back.groupBy(F.lit(fmt).alias("format"), "session_key").agg(*lap_sums()))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("sink_processed", f"""
SELECT CAST(year AS INT) AS year, {SQL_SUMS} FROM laps l JOIN sessions USING (session_key) GROUP BY year""")
def sink_processed(t):
    root = work_dir(t.spark, "processed")
    rows = laps_by_year(t)
    writers.write_processed(rows, root, "laps")
    # A second run over some seasons replaces just those.
    writers.write_processed(rows.where("year >= 2022"), root, "laps")
    return readers.scan(t.spark, f"{root}/laps").groupBy("year").agg(*lap_sums())


@query("sink_hive_partitioned", """
SELECT CAST(year(date) AS INT) AS year, CAST(month(date) AS INT) AS month, CAST(day(date) AS INT) AS day,
  count(*) AS n, round(sum(pit_duration) + 1e-9, 6) AS total_pit
FROM pit GROUP BY ALL""")
def sink_hive_partitioned(t):
    path = work_dir(t.spark, "hive")
    writers.write_partitioned(writers.with_date_parts(t["pit"], "date"), path)
    return readers.scan(t.spark, path).groupBy("year", "month", "day").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("pit_duration"), 6).alias("total_pit")
    )


@query("land_raw", """
SELECT CAST(year AS INT) AS year, endpoint, endpoint AS _endpoint, TIMESTAMP '2024-01-01' AS _extracted_at, count(*) AS n
FROM (SELECT session_key, 'laps' AS endpoint FROM laps UNION ALL SELECT session_key, 'pit' FROM pit
  UNION ALL SELECT session_key, 'pit' FROM pit) x JOIN sessions USING (session_key) GROUP BY ALL""")
def land_raw(t):
    root = work_dir(t.spark, "land")
    years = t["sessions"].select("session_key", F.col("year").cast("int").alias("year"))
    pit = t["pit"].join(years, "session_key")
    writers.land(laps_by_year(t), root, "laps", extracted())
    writers.land(pit, root, "pit", extracted())
    writers.land(pit, root, "pit", extracted())  # landing appends
    both = [
        readers.scan_raw(t.spark, root, e).select("year", "endpoint", "_endpoint", F.col("_extracted_at").cast("timestamp_ntz").alias("_extracted_at"))
        for e in ("laps", "pit")
    ]
    return both[0].unionByName(both[1]).groupBy("year", "endpoint", "_endpoint", "_extracted_at").agg(F.count(F.lit(1)).alias("n"))


@query("scan_jdbc", """
SELECT session_key, driver_number, min(lap_duration) AS best FROM laps
WHERE lap_duration IS NOT NULL AND driver_number = 7 GROUP BY ALL""")
def scan_jdbc(t):
    sql = ("SELECT session_key, driver_number, min(lap_duration) AS best FROM fetch_laps "
           "WHERE lap_duration IS NOT NULL AND driver_number = :driver GROUP BY session_key, driver_number")
    return readers.scan_query(t.spark, sql, {"driver": 7}, {"fetch_laps": t["laps"]})


@query("param_query", """
SELECT session_key, session_name, year FROM sessions WHERE year = 2021 AND session_type = 'Race'""")
def param_query(t):
    sql = "SELECT session_key, session_name, year FROM bound_sessions WHERE year = ? AND session_type = ?"
    return readers.scan_query(t.spark, sql, [2021, "Race"], {"bound_sessions": t["sessions"]})


@query("execute_many", """
SELECT session_key, driver_number, lap_number, lap_duration FROM laps l
JOIN (SELECT session_key, driver_number, max(lap_number) AS lap_number FROM laps GROUP BY ALL) p
USING (session_key, driver_number, lap_number)""")
def execute_many(t):
    params = t["laps"].groupBy("session_key", "driver_number").agg(F.max("lap_number").alias("lap_number"))
    rows = t["laps"].select("session_key", "driver_number", "lap_number", "lap_duration")
    return readers.scan_each(t.spark, params, rows, ["session_key", "driver_number", "lap_number"])


@query("execute_many_writes", """
SELECT session_key, count(*) AS n, round(sum(CASE WHEN lap_number % 10 = 3 THEN 1.5 ELSE lap_duration END), 3) AS seconds, min(lap_number) AS first_lap, max(lap_number) AS last_lap
FROM (SELECT session_key, driver_number, lap_number, lap_duration FROM laps WHERE lap_number % 10 <> 4
  UNION ALL SELECT DISTINCT session_key, driver_number, 1000, 2.5 FROM laps) GROUP BY session_key""")
def execute_many_writes(t):
    """Update, delete and insert by thousands of parameter sets, each kind as one change of the table."""
    path, key = work_dir(t.spark, "written"), ["session_key", "driver_number", "lap_number"]
    laps = t["laps"].select(*key, "lap_duration")
    laps.write.parquet(path)
    upsert.execute_each(t.spark, path, "update", laps.where("lap_number % 10 = 3").select(*key, F.lit(1.5).alias("lap_duration")), key)
    upsert.execute_each(t.spark, path, "delete", laps.where("lap_number % 10 = 4").select(*key), key)
    fresh = laps.select("session_key", "driver_number").distinct().select("*", F.lit(1000).alias("lap_number"), F.lit(2.5).alias("lap_duration"))
    for _ in range(2):  # the second time adds nothing
        upsert.execute_each(t.spark, path, "insert", fresh, key)
    return t.spark.read.parquet(path).groupBy("session_key").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("lap_duration"), 3).alias("seconds"), F.min("lap_number").alias("first_lap"), F.max("lap_number").alias("last_lap"))


@query("scan_multi_year", f"""
SELECT CAST(year AS INT) AS year, session_key, {SQL_SUMS} FROM laps l JOIN sessions USING (session_key)
WHERE year IN (2019, 2021, 2023) GROUP BY ALL""")
def scan_multi_year(t):
    raw = readers.scan_raw(t.spark, landed_laps(t, "parquet"), "laps", [2019, 2021, 2023])
    return raw.groupBy("year", "session_key").agg(*lap_sums())


@query("extraction_stats", """
SELECT CAST(year AS INT) AS year, endpoint, CAST(sum(n) AS BIGINT) AS total_records, count(*) AS endpoints_processed
FROM (SELECT year, endpoint, count(*) AS n FROM (SELECT session_key, 'laps' AS endpoint FROM laps
    UNION ALL SELECT session_key, 'pit' FROM pit UNION ALL SELECT session_key, 'weather' FROM weather) x
  JOIN sessions USING (session_key) GROUP BY ALL)
GROUP BY ROLLUP (year, endpoint)""")
def extraction_stats(t):
    root = work_dir(t.spark, "stats")
    years = t["sessions"].select("session_key", F.col("year").cast("int").alias("year"))
    for endpoint in ("laps", "pit", "weather"):
        writers.land(t[endpoint].join(years, "session_key"), root, endpoint, extracted())
    return readers.extraction_stats(t.spark.read.parquet(root))


@query("list_dataset", """
SELECT 'year=' || year AS directory, true AS has_files, true AS has_bytes
FROM laps JOIN sessions USING (session_key) GROUP BY year""")
def list_dataset(t):
    root = work_dir(t.spark, "list")
    writers.write_processed(laps_by_year(t), root, "laps")
    files = readers.list_dataset(t.spark, root).where(F.col("path").contains("/year="))
    return files.groupBy(F.regexp_extract("path", "(year=[0-9]+)/", 1).alias("directory")).agg(
        (F.count(F.lit(1)) > 0).alias("has_files"), (F.sum("length") > 0).alias("has_bytes")
    )


@query("summary_report", """
SELECT (SELECT count(*) FROM meetings) AS meetings_count, (SELECT count(*) FROM sessions) AS sessions_count,
  (SELECT count(*) FROM drivers) AS drivers_count, (SELECT count(*) FROM laps) AS laps_count,
  (SELECT count(*) FROM positions) AS position_count""")
def summary(t):
    path = work_dir(t.spark, "summary")
    report = summary_report(t, ("meetings", "sessions", "drivers", "laps", "position"))
    writers.write_files(report, path, "csv")
    return readers.scan(t.spark, path, "csv", report.schema)


@query("scan_endpoint", """
SELECT session_key, lap_number, lap_duration, 'laps' AS _endpoint, TIMESTAMP '2024-01-01' AS _extracted_at
FROM laps WHERE driver_number = 4 AND lap_number = 11""")
def scan_endpoint(t):
    raw = readers.scan_raw(t.spark, landed_laps(t, "parquet"), "laps", driver_number=4, lap_number=11)
    return raw.select("session_key", "lap_number", "lap_duration", "_endpoint",
                      F.col("_extracted_at").cast("timestamp_ntz").alias("_extracted_at"))


@query("processing_summary", """
SELECT 'laps' AS endpoint, CAST(year AS INT) AS year, count(*) AS records_processed, 'SUCCESS' AS status
FROM laps JOIN sessions USING (session_key) GROUP BY year
UNION ALL SELECT 'sessions', CAST(year AS INT), count(*), 'SUCCESS' FROM sessions GROUP BY year
UNION ALL SELECT 'no_such_endpoint', NULL, 0, 'ERROR'""")
def processing_summary(t):
    root, out = work_dir(t.spark, "landed"), work_dir(t.spark, "processed")
    writers.land(laps_by_year(t), root, "laps", extracted())
    writers.land(t["sessions"].withColumn("year", F.col("year").cast("int")), root, "sessions", extracted())
    done = raw_job(t.spark, root, out, ["laps", "sessions", "no_such_endpoint"], fmt="parquet", processed_at=extracted())
    return done.withColumn("status", F.when(F.col("status").startswith("ERROR"), "ERROR").otherwise(F.col("status")))

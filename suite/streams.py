"""File streams run until their input is used up, next to the batch result."""

from pyspark.sql import functions as F

from pitwall.session import work_dir
from pitwall.sources import writers
from pitwall.streaming import streams
from suite.aggregates import SQL_TELEMETRY
from suite.joining import rounded
from suite.registry import query
from suite.scans import extracted

EVENT_SUMS = "count(*) AS n, round(sum(value), 4) AS total, min(ts) AS first, max(ts) AS last"


def event_sums(df):
    first, last = F.min("ts").cast("timestamp_ntz"), F.max("ts").cast("timestamp_ntz")
    return df.agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"), first.alias("first"), last.alias("last"))


def landed_events(t, fmt="json", parts=None):
    """The event log as files in a landing directory, in several parts."""
    path = work_dir(t.spark, "events")
    events = t.source("events").withColumn("ts", F.col("ts").cast("timestamp"))
    writers.write_files(events.repartition(parts, "event_id") if parts else events, path, fmt)
    return path, events.schema


@query("stream_ingest", f"SELECT event_type, {EVENT_SUMS} FROM events GROUP BY event_type")
def stream_ingest(t):
    path, schema = landed_events(t)
    out = work_dir(t.spark, "ingested")
    streams.stream_ingest(t.spark, path, schema, out, work_dir(t.spark, "ckpt")).awaitTermination()
    return event_sums(t.spark.read.parquet(out).groupBy("event_type"))


@query("stream_bookmark", f"SELECT user_id % 10 AS slice, {EVENT_SUMS} FROM events GROUP BY ALL")
def stream_bookmark(t):
    # Two landings and three runs: each file is taken up once, and the last run finds nothing.
    path, out, ckpt = (work_dir(t.spark, n) for n in ("events", "ingested", "ckpt"))
    events = t.source("events")
    for part in (events.where("event_id % 2 = 0"), events.where("event_id % 2 = 1"), None):
        if part is not None:
            writers.write_files(part, path, "json", "append")
        streams.stream_ingest(t.spark, path, events.schema, out, ckpt).awaitTermination()
    return event_sums(t.spark.read.parquet(out).groupBy((F.col("user_id") % 10).alias("slice")))


@query("stream_upsert", """
SELECT user_id, event_type, arg_max(event_id, (ts, event_id)) AS event_id, max(ts) AS ts FROM events GROUP BY ALL""")
def stream_upsert(t):
    path, schema = landed_events(t, "parquet", 4)
    out, keys = work_dir(t.spark, "current"), ["user_id", "event_type"]
    # Several batches, in no order of time: the newest row of a key counts all the same.
    rows = streams.read_stream(t.spark, path, schema, files_per_batch=2).select("user_id", "event_type", "event_id", "ts")
    streams.stream_upsert(rows, out, keys, [F.desc("ts"), F.desc("event_id")], work_dir(t.spark, "ckpt"), ["event_type"]).awaitTermination()
    return t.spark.read.parquet(out).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("stream_dedup", """
SELECT event_type, count(DISTINCT event_id) AS n, round(sum(value), 4) AS total FROM events GROUP BY event_type""")
def stream_dedup(t):
    path, schema = landed_events(t, "parquet")
    writers.write_files(t.spark.read.parquet(path), path, mode="append")  # everything arrives twice
    rows = streams.stream_dedup(streams.read_stream(t.spark, path, schema), ["event_id"], "ts", "1 hour")
    out = work_dir(t.spark, "unique")
    streams.stream_append(rows, out, work_dir(t.spark, "ckpt")).awaitTermination()
    return t.spark.read.parquet(out).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query("stream_telemetry_window", f"""
SELECT time_bucket(INTERVAL 10 MINUTE, date) AS window_start, time_bucket(INTERVAL 10 MINUTE, date) + INTERVAL 10 MINUTE AS window_end,
  session_key, driver_number, {SQL_TELEMETRY} FROM car_data WHERE speed IS NOT NULL GROUP BY ALL""")
def stream_telemetry_window(t):
    path = work_dir(t.spark, "telemetry")
    rows = t["car_data"].withColumn("date", F.col("date").cast("timestamp"))
    writers.write_files(rows, path)
    live = streams.read_stream(t.spark, path, rows.schema)
    windows = streams.stream_telemetry(live, "10 minutes", "30 seconds")
    windows = windows.withColumn("window_month", F.date_trunc("month", "window_start").cast("date"))
    out, keys = work_dir(t.spark, "windows"), ["window_month", "window_start", "window_end", "session_key", "driver_number"]
    streams.stream_upsert(windows, out, keys, None, work_dir(t.spark, "ckpt"), ["window_month"], "update").awaitTermination()
    saved = t.spark.read.parquet(out).drop("window_month")
    return rounded(saved.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")}))


@query("stream_late_rows", """
WITH timed AS (SELECT date, driver_number FROM car_data WHERE speed IS NOT NULL),
late AS (SELECT time_bucket(INTERVAL 10 MINUTE, date) + INTERVAL 10 MINUTE <= (SELECT max(date) FROM timed) - INTERVAL 30 SECOND AS dropped FROM timed WHERE driver_number = 7),
again AS (SELECT count(*) AS n FROM timed WHERE date = (SELECT max(date) FROM timed))
SELECT (SELECT count(*) FROM timed) + n + (SELECT count(*) FROM late) AS sent, (SELECT count(*) FROM late WHERE dropped) AS dropped,
  (SELECT count(*) FROM timed) + n + (SELECT count(*) FROM late WHERE NOT dropped) AS in_windows,
  (SELECT count(*) FROM timed) + n + (SELECT count(*) FROM late WHERE NOT dropped) AS stored FROM again""")
def stream_late_rows(t):
    """All samples, the last ones again, and then those of one car again, most of which come too late for the watermark."""
    path, out, counts = (work_dir(t.spark, n) for n in ("telemetry", "windows", "counts"))
    rows = t["car_data"].where("speed IS NOT NULL").withColumn("date", F.col("date").cast("timestamp"))
    rows.coalesce(1).write.parquet(path)
    last = rows.agg(F.max("date")).first()[0]
    rows.where(F.col("date") == F.lit(last)).coalesce(1).write.mode("append").parquet(path)  # a batch is judged by the watermark of the one before
    rows.where("driver_number = 7").coalesce(1).write.mode("append").parquet(path)
    live = streams.read_stream(t.spark, path, rows.schema, files_per_batch=1)
    running = streams.stream_windows_told(live, out, "10 minutes", "30 seconds", ["session_key", "driver_number"], [F.avg("speed").alias("avg_speed")],
                                          work_dir(t.spark, "ckpt"), counts)
    running.awaitTermination()
    told = streams.late_rows(running, counts).agg(F.sum("sent").alias("sent"), F.sum("dropped").alias("dropped"), F.sum("in_windows").alias("in_windows"))
    return told.join(F.broadcast(t.spark.read.parquet(out).agg(F.sum("n").alias("stored"))))


@query("stream_incremental_endpoint", """
SELECT session_key, driver_number, count(*) AS n, round(sum(pit_duration) + 1e-9, 6) AS total FROM pit GROUP BY ALL""")
def stream_incremental_endpoint(t):
    root, out = work_dir(t.spark, "landed"), work_dir(t.spark, "pit")
    years = t["sessions"].select("session_key", F.col("year").cast("int").alias("year"))
    for endpoint in ("pit", "weather"):
        writers.land(t[endpoint].join(years, "session_key"), root, endpoint, extracted())
    schema = t["pit"].select("session_key", "driver_number", "pit_duration").schema
    streams.stream_endpoint(t.spark, root, "pit", schema, out, work_dir(t.spark, "ckpt")).awaitTermination()
    return t.spark.read.parquet(out).groupBy("session_key", "driver_number").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("pit_duration"), 6).alias("total"))

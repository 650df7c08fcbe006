"""Data quality measures over whole tables."""

from pyspark.sql import functions as F

from pitwall.operators import clean, outliers, quality, quantiles
from pitwall.operators.joins import orphans
from pitwall.plans.lineage import column_lineage
from pitwall.session import stage, work_dir
from pitwall.sources import readers, writers
from suite.filters import SQL_LAP_RULES, SQL_LAP_SCORE, SQL_ODD_LAPS, odd_laps
from suite.joining import rounded
from suite.registry import query

LAP = ["session_key", "driver_number", "lap_number"]
CHECKED = [*LAP, "lap_duration", "lap_time", "i1_speed", "i2_speed", "compound"]
LIST = ", ".join(CHECKED)


@query("null_counts", f"""
SELECT unnest(['{"', '".join(CHECKED)}']) AS column_name, unnest([{", ".join(f"count(*) - count({c})" for c in CHECKED)}]) AS nulls,
  count(*) AS total_records FROM laps""")
def null_counts(t):
    counted = quality.null_counts(t["laps"].select(*CHECKED))
    return counted.select(F.explode("null_counts").alias("column_name", "nulls"), "total_records")


@query("completeness_table", f"""
SELECT count(*) AS total_records, round(1 - ({" + ".join(f"count(*) - count({c})" for c in CHECKED)}) / (count(*) * {len(CHECKED)}) + 1e-9, 6)
  AS completeness_score FROM laps""")
def completeness_table(t):
    return rounded(quality.completeness(t["laps"].select(*CHECKED)))


@query("duplicate_records", """
SELECT count(*) - count(DISTINCT (session_key, driver_number, lap_number)) AS duplicate_records FROM laps_dup""")
def duplicate_records(t):
    return quality.duplicates(t["laps_dup"], LAP)


@query("constraint_violations", """
SELECT error, count(*) AS n FROM (
  SELECT unnest(['Required field pit_duration is missing or null', 'Required field lap_number is missing or null']) AS error,
    unnest([pit_duration > 20.05, lap_number % 6 = 0]) AS broken FROM pit
  UNION ALL SELECT 'orphan session_key', session_key % 5 = 0 FROM pit)
WHERE broken GROUP BY error""")
def constraint_violations(t):
    years = t["sessions"].select("session_key", "meeting_key", "year")
    rows = t["pit"].join(years, "session_key").withColumns({
        "pit_duration": F.when(F.col("pit_duration") <= 20.05, F.col("pit_duration")),
        "lap_number": F.when(F.col("lap_number") % 6 != 0, F.col("lap_number")),
        "_extracted_at": F.col("date"), "_endpoint": F.lit("pit"),
    })
    broken = quality.violations(rows, "raw_pit").select(F.explode("errors").alias("error"))
    unlisted = orphans(rows, t["sessions"].where("session_key % 5 <> 0"), "session_key").select(F.lit("orphan session_key").alias("error"))
    return broken.unionByName(unlisted).groupBy("error").agg(F.count(F.lit(1)).alias("n"))


@query("completeness_row", f"SELECT session_key, driver_number, lap_number, {SQL_LAP_SCORE} AS data_completeness_score FROM laps")
def completeness_row(t):
    return t["laps"].select(*LAP, F.round(clean.lap_completeness(), 6).alias("data_completeness_score"))


@query("quality_tier", """
SELECT meeting_key, CASE WHEN meeting_key % 3 = 0 THEN 1.0::DOUBLE WHEN meeting_key % 3 = 1 THEN 0.8::DOUBLE ELSE 0.6::DOUBLE END AS data_quality_score
FROM meetings""")
def quality_tier(t):
    key = F.col("meeting_key") % 3
    rows = t["meetings"].withColumns({
        "meeting_official_name": F.when(key == 0, F.col("meeting_name")), "location": F.when(key == 1, F.col("country_name"))})
    return rows.select("meeting_key", clean.meeting_tier().alias("data_quality_score"))


@query("freshness_outliers", """
SELECT latest_data_timestamp, round(epoch(TIMESTAMP '2025-01-01' - latest_data_timestamp) / 3600.0 + 1e-9, 6) AS data_freshness_hours,
  outlier_count, round(outlier_count / total_records + 1e-9, 6) AS anomaly_score, total_records, duplicate_records,
  CAST(0 AS BIGINT) AS constraint_violations, round(completeness + 1e-9, 6) AS completeness_score
FROM (SELECT max(date) AS latest_data_timestamp, count(*) AS total_records,
    count(*) FILTER (abs(speed - m) > 3 * s) AS outlier_count, 1 - (count(*) - count(speed)) / (count(*) * 6) AS completeness,
    count(*) - count(DISTINCT (session_key, driver_number, date)) AS duplicate_records
  FROM car_data, (SELECT avg(speed) AS m, stddev_samp(speed) AS s FROM car_data))""")
def freshness_outliers(t):
    as_of = F.lit("2025-01-01 00:00:00").cast("timestamp_ntz")
    measured = ["meeting_key", "year", "_extracted_at", "_endpoint"]
    rows = t["car_data"]
    full = quality.metrics(
        rows.withColumns({c: F.lit("x") for c in measured}), "raw_car_data", as_of, ts="date", outlier_col="speed")
    cells = F.col("total_records") * len(rows.columns)
    nulls = F.aggregate(F.map_values("null_counts"), F.lit(0).cast("bigint"), lambda a, x: a + x)
    return rounded(full.select(
        "latest_data_timestamp", "data_freshness_hours", "outlier_count", "anomaly_score", "total_records", "duplicate_records",
        "constraint_violations", (1 - nulls / cells).alias("completeness_score")))


@query("iqr_outliers", """
WITH q AS (SELECT session_key, quantile_disc(lap_time, 0.25) AS q1, quantile_disc(lap_time, 0.75) AS q3, count(lap_time) AS timed FROM laps_dup GROUP BY session_key)
SELECT session_key, q1, q3, timed, count(*) FILTER (lap_time < q1 - 1.5 * (q3 - q1) OR lap_time > q3 + 1.5 * (q3 - q1)) AS outliers,
  max(lap_time) FILTER (lap_time < q1 - 1.5 * (q3 - q1) OR lap_time > q3 + 1.5 * (q3 - q1)) AS largest
FROM laps_dup JOIN q USING (session_key) WHERE timed > 0 GROUP BY ALL""")
def iqr_outliers(t):
    laps = stage(t["laps_dup"].select("session_key", "lap_time", "date_start"), "timed")  # joined once, read several times
    days = stage(outliers.sketches(laps, ["session_key"], "lap_time", "date_start"), "sketches")  # kept by day, and merged
    q = stage(outliers.quartiles(laps, ["session_key"], "lap_time", "date_start", days), "quartiles")
    far = outliers.outliers(laps, ["session_key"], "lap_time", "date_start", found=q).groupBy("session_key").agg(
        F.count(F.lit(1)).alias("outliers"), F.max("lap_time").alias("largest"))
    return q.join(far, "session_key", "left").select("session_key", "q1", "q3", F.col("n").alias("timed"), F.coalesce("outliers", F.lit(0).cast("long")).alias("outliers"), "largest")


@query("exact_quantiles", """
SELECT driver_number, round(quantile_cont(lap_time, 0.1) + 1e-9, 6) AS low, round(quantile_cont(lap_time, 0.5) + 1e-9, 6) AS middle, round(quantile_cont(lap_time, 0.9) + 1e-9, 6) AS high FROM laps_dup
WHERE lap_time IS NOT NULL GROUP BY driver_number
UNION ALL SELECT NULL, round(quantile_cont(lap_time, 0.1) + 1e-9, 6), round(quantile_cont(lap_time, 0.5) + 1e-9, 6), round(quantile_cont(lap_time, 0.9) + 1e-9, 6) FROM laps_dup""")
def exact_quantiles(t):
    """By driver, and of all laps as one group, which no task holds."""
    laps = t["laps_dup"].where("lap_time IS NOT NULL")
    both = laps.select("driver_number", "lap_time").unionByName(laps.select(F.lit(None).cast("int").alias("driver_number"), "lap_time"))
    counted = stage(both.groupBy("driver_number", F.col("lap_time").cast("double").alias("x")).agg(F.count(F.lit(1)).alias("n")), "counted")
    return rounded(quantiles.exact_quantiles(counted, ["driver_number"], {"low": 0.1, "middle": 0.5, "high": 0.9}))


@query("lineage_metadata", """
SELECT t AS table_name, '1' AS schema_version, u AS upstream, d AS downstream, n AS records FROM (
  SELECT 'raw_laps' AS t, '' AS u, 'grand_prix_results|grand_prix_performance|driver_performance_features|race_context_features|lake_laps' AS d,
    (SELECT count(*) FROM laps) AS n
  UNION ALL SELECT 'raw_pit', '', 'grand_prix_performance', (SELECT count(*) FROM pit)
  UNION ALL SELECT 'raw_weather', '', 'driver_performance_features|race_context_features', (SELECT count(*) FROM weather)
  UNION ALL SELECT 'raw_car_data', '', 'grand_prix_performance', (SELECT count(*) FROM car_data))""")
def lineage_metadata(t):
    counts = None
    for name in ("laps", "pit", "weather", "car_data"):
        part = t[name].agg(F.count(F.lit(1)).alias("records")).select(F.lit(f"raw_{name}").alias("table_name"), "records")
        counts = part if counts is None else counts.unionByName(part)
    return quality.lineage(t.spark).join(counts, "table_name").select(
        "table_name", "schema_version", F.array_join("upstream_dependencies", "|").alias("upstream"),
        F.array_join("downstream_dependencies", "|").alias("downstream"), "records")


@query("lineage_columns", """
SELECT unnest(['average_lap_time', 'avg_speed', 'avg_throttle', 'best_lap_time', 'driver_name']) AS column_name,
  unnest(['raw_laps', 'raw_car_data', 'raw_car_data', 'raw_laps', 'raw_drivers']) AS source_table,
  unnest(['lap_duration', 'speed', 'throttle', 'lap_duration', 'full_name']) AS source_column,
  unnest([(SELECT count(lap_duration) FROM laps), (SELECT count(speed) FROM car_data), (SELECT count(throttle) FROM car_data),
    (SELECT count(lap_duration) FROM laps), (SELECT count(full_name) FROM drivers)]) AS filled""")
def lineage_columns(t):
    """Columns of the performance table, the raw columns their values are made of, and how many values those have."""
    edges = column_lineage(t.spark).where("table_name = 'grand_prix_performance'").where(
        F.col("column_name").isin("average_lap_time", "avg_speed", "avg_throttle", "best_lap_time", "driver_name"))
    counts = None
    for name, columns in (("laps", ["lap_duration"]), ("car_data", ["speed", "throttle"]), ("drivers", ["full_name"])):
        per = t[name].agg(*[F.count(c).alias(c) for c in columns])
        part = per.select(F.inline(F.array(*[F.struct(F.lit(f"raw_{name}").alias("source_table"), F.lit(c).alias("source_column"), F.col(c).alias("filled")) for c in columns])))
        counts = part if counts is None else counts.unionByName(part)
    return edges.join(counts, ["source_table", "source_column"]).select("column_name", "source_table", "source_column", "filled")


@query("validation_report", f"""
SELECT count(*) AS rows_before, count(DISTINCT CASE WHEN {SQL_LAP_RULES} THEN (session_key, driver_number, lap_number) END) AS rows_after,
  count(*) - count(DISTINCT CASE WHEN {SQL_LAP_RULES} THEN (session_key, driver_number, lap_number) END) AS rows_removed
FROM ({SQL_ODD_LAPS.replace("FROM laps", "FROM laps_dup")})""")
def validation_report(t):
    rows = odd_laps({"laps": t["laps_dup"]})
    return quality.validation_report(rows, LAP, clean.lap_rules())


@query("roundtrip_check", "SELECT count(*) AS n, CAST(0 AS BIGINT) AS only_first, CAST(0 AS BIGINT) AS only_second FROM laps_dup")
def roundtrip_check(t):
    path = work_dir(t.spark, "roundtrip")
    rows = t["laps_dup"].select(*CHECKED)
    writers.write_files(rows, path)
    back = readers.scan(t.spark, path)
    return quality.same_rows(rows, back).withColumn("n", F.lit(back.count()).cast("bigint"))

"""Catalog tables: defined, filled with derived rows and read back."""

import re
import uuid

from pyspark.sql import functions as F

from pitwall import catalog
from pitwall.session import stage, work_dir
from pitwall.sources import readers, tables, writers
from suite.registry import query
from suite.scans import extracted, LAP_COLUMNS, lap_sums, SQL_SUMS, laps_by_year


def new_database(t, layer="raw"):
    name = f"pitwall_{uuid.uuid4().hex[:10]}"
    tables.create_tables(t.spark, name, layer, work_dir(t.spark, "db"))
    return name


def closed(t, db, out):
    """The result, saved, after which the database is dropped; its tables' files are in the working folder."""
    out = stage(out, "result")
    t.spark.sql(f"DROP DATABASE {db} CASCADE")
    return out


def raw_rows(t, source):
    """Rows of a table with the columns all raw tables carry."""
    years = t["sessions"].select("session_key", "meeting_key", F.col("year").cast("int").alias("year"))
    rows = t[source] if source in ("sessions", "meetings") else t[source].join(years, "session_key", "left")
    return rows.withColumns({"_extracted_at": extracted(), "_endpoint": F.lit(source)})


@query("create_tables", """
SELECT 'raw_laps' AS table_name, 16 AS columns, count(*) AS n FROM laps
UNION ALL SELECT 'raw_pit', 9, count(*) FROM pit
UNION ALL SELECT 'raw_car_data', 13, count(*) FROM car_data
UNION ALL SELECT 'raw_weather', 13, count(*) FROM weather""")
def create_tables(t):
    db = new_database(t)
    tables.create_tables(t.spark, db, "raw", work_dir(t.spark, "again"))  # a second run changes nothing
    out = None
    for source in ("laps", "pit", "car_data", "weather"):
        name = f"{db}.raw_{source}"
        tables.save_table(raw_rows(t, source), name)
        part = t.spark.table(name).agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(f"raw_{source}").alias("table_name"), F.lit(len(t.spark.table(name).columns)).alias("columns"), "n")
        out = part if out is None else out.unionByName(part)
    return closed(t, db, out)


@query("create_table", f"SELECT session_key, {SQL_SUMS} FROM laps l GROUP BY session_key")
def create_table(t):
    db = new_database(t, "metadata")
    columns = {"session_key": "BIGINT NOT NULL", "driver_number": "INTEGER NOT NULL", "lap_number": "INTEGER",
               "lap_duration": "REAL", "lap_time": "REAL", "compound": "TEXT DEFAULT 'SOFT'", "date_start": "TIMESTAMP NOT NULL"}
    tables.create_table(t.spark, f"{db}.laps", columns, work_dir(t.spark, "table"))
    tables.save_table(t["laps"].select(*LAP_COLUMNS), f"{db}.laps")
    saved = t.spark.table(f"{db}.laps").withColumn("date_start", F.col("date_start").cast("timestamp_ntz"))
    return closed(t, db, saved.groupBy("session_key").agg(*lap_sums()))


@query("sink_table", """
SELECT step, CAST(year AS INT) AS year, count(*) AS n, round(sum(pit_duration) + 1e-9, 6) AS total
FROM (SELECT 'appended twice' AS step, * FROM pit UNION ALL SELECT 'appended twice', * FROM pit
  UNION ALL SELECT 'seasons replaced', * FROM pit UNION ALL SELECT 'replaced', * FROM pit)
JOIN sessions USING (session_key) WHERE step <> 'replaced' OR year >= 2021 GROUP BY ALL""")
def sink_table(t):
    db = new_database(t)
    name, rows = f"{db}.raw_pit", raw_rows(t, "pit")
    steps = []

    def keep(step):
        path = work_dir(t.spark, "step")
        t.spark.table(name).groupBy("year").agg(
            F.count(F.lit(1)).alias("n"), F.round(F.sum("pit_duration"), 6).alias("total")
        ).select(F.lit(step).alias("step"), "year", "n", "total").write.parquet(path)
        steps.append(path)

    tables.save_table(rows, name)
    tables.save_table(rows, name)
    keep("appended twice")
    tables.save_table(rows, name, "replace_partitions")
    keep("seasons replaced")
    tables.save_table(rows.where("year >= 2021"), name, "replace")
    keep("replaced")
    return closed(t, db, t.spark.read.parquet(*steps))


@query("table_exists", """
SELECT 'raw_pit' AS table_name, true AS found, count(*) AS n FROM pit
UNION ALL SELECT 'raw_tyres', false, 0""")
def table_exists(t):
    db = new_database(t)
    tables.save_table(raw_rows(t, "pit"), f"{db}.raw_pit")
    out = None
    for name in ("raw_pit", "raw_tyres"):
        found = tables.table_exists(t.spark, f"{db}.{name}")
        rows = t.spark.table(f"{db}.{name}") if found else t["pit"].where(F.lit(False))
        part = rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), F.lit(found).alias("found"), "n")
        out = part if out is None else out.unionByName(part)
    return closed(t, db, out)


def filled_by_column(df, types):
    """Per column its type and number of filled values, one pass."""
    counts = df.agg(*[F.count(c).alias(c) for c in types])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(k).alias("type"), F.col(c).alias("filled")) for c, k in types.items()])
    return counts.select(F.inline(pairs))


@query("describe_table", """
SELECT unnest(['session_key', 'driver_number', 'date', 'lap_number', 'pit_duration', 'year']) AS column_name,
  unnest(['bigint', 'int', 'timestamp', 'int', 'double', 'int']) AS type,
  unnest([count(session_key), count(driver_number), count(date), count(lap_number), count(pit_duration), count(session_key)]) AS filled
FROM pit""")
def describe_table(t):
    db = new_database(t)
    tables.save_table(raw_rows(t, "pit"), f"{db}.raw_pit")
    types = tables.describe_table(t.spark, f"{db}.raw_pit")
    return closed(t, db, filled_by_column(t.spark.table(f"{db}.raw_pit"), {c: k for c, k in types.items() if c[0] != "_" and c != "meeting_key"}))


@query("get_schema_by_layer", """
SELECT 'raw_weather' AS table_name, unnest(['session_key', 'date', 'air_temperature', 'rainfall', 'track_temperature']) AS column_name,
  unnest(['bigint', 'timestamp', 'double', 'int', 'double']) AS type,
  unnest([count(session_key), count(date), count(air_temperature), count(rainfall), count(track_temperature)]) AS filled FROM weather
UNION ALL
SELECT 'raw_position', unnest(['session_key', 'driver_number', 'date', 'position']),
  unnest(['bigint', 'int', 'timestamp', 'int']),
  unnest([count(session_key), count(driver_number), count(date), count(position)]) FROM positions""")
def get_schema_by_layer(t):
    layer = catalog.get_schema_by_layer("raw")
    out = None
    for source in ("weather", "position"):
        schema = layer[f"raw_{source}"]
        types = {f.name: f.dataType.simpleString() for f in schema if f.name in t[source].columns}
        part = filled_by_column(t[source], types).select(F.lit(f"raw_{source}").alias("table_name"), "*")
        out = part if out is None else out.unionByName(part)
    return out


@query("layout_hints", f"""
SELECT CAST(year AS INT) AS year, session_key, driver_number, {SQL_SUMS}
FROM laps l JOIN sessions USING (session_key) WHERE session_key BETWEEN 100 AND 160 GROUP BY ALL""")
def layout_hints(t):
    path = work_dir(t.spark, "clustered")
    writers.write_clustered(laps_by_year(t), path, ["year"], ["session_key", "driver_number"])
    return readers.scan(t.spark, path).where(F.col("session_key").between(100, 160)).groupBy(
        "year", "session_key", "driver_number").agg(*lap_sums())


ZORDERED = ["session_key", "meeting_key", "year", "driver_number", "date_start"]


def located_laps(t):
    places = t["sessions"].select("session_key", "meeting_key", F.col("year").cast("int").alias("year"))
    return t["laps"].select(*LAP_COLUMNS).join(places, "session_key")


@query("layout_zorder", f"""
SELECT 'session_key' AS looked_up, {SQL_SUMS} FROM laps l JOIN sessions USING (session_key) WHERE session_key = 120
UNION ALL SELECT 'meeting_key', {SQL_SUMS} FROM laps l JOIN sessions s USING (session_key) WHERE s.meeting_key = 12
UNION ALL SELECT 'year', {SQL_SUMS} FROM laps l JOIN sessions USING (session_key) WHERE year = 2021
UNION ALL SELECT 'driver_number', {SQL_SUMS} FROM laps l JOIN sessions USING (session_key) WHERE driver_number = 7
UNION ALL SELECT 'date_start', {SQL_SUMS} FROM laps l JOIN sessions USING (session_key)
  WHERE l.date_start >= TIMESTAMP '2022-03-01' AND l.date_start < TIMESTAMP '2022-04-01'""")
def layout_zorder(t):
    path = work_dir(t.spark, "zordered")
    writers.write_zordered(located_laps(t), path, ZORDERED, files=64)
    laps = readers.scan(t.spark, path)
    date = F.col("date_start")
    asked = {"session_key": F.col("session_key") == 120, "meeting_key": F.col("meeting_key") == 12, "year": F.col("year") == 2021,
             "driver_number": F.col("driver_number") == 7, "date_start": (date >= "2022-03-01") & (date < "2022-04-01")}
    out = None
    for name, which in asked.items():
        part = laps.where(which).agg(*lap_sums()).select(F.lit(name).alias("looked_up"), "*")
        out = part if out is None else out.unionByName(part)
    return out


@query("schema_evolution", f"""
SELECT CAST(year AS INT) AS year, {SQL_SUMS}, sum(CASE WHEN year >= 2021 THEN driver_number * 3000000000 END)::BIGINT AS added,
  CAST('bigint' AS VARCHAR) AS lap_number_type, 'added:extra,widened:lap_number' AS changes
FROM laps l JOIN sessions USING (session_key) GROUP BY year""")
def schema_evolution(t):
    db, root = new_database(t, "metadata"), work_dir(t.spark, "evolving")
    laps = laps_by_year(t)
    first = laps.where("year < 2021").withColumn("lap_number", F.col("lap_number").cast("int"))
    second = laps.where("year >= 2021").withColumns({"lap_number": F.col("lap_number").cast("long"), "extra": F.col("driver_number") * F.lit(3_000_000_000)})
    first.write.partitionBy("year").parquet(f"{root}/laps")
    tables.evolve(t.spark, f"{db}.evolving_laps", f"{root}/laps")
    second.write.mode("append").partitionBy("year").parquet(f"{root}/laps")
    report = tables.evolve(t.spark, f"{db}.evolving_laps", f"{root}/laps").collect()
    changes = ",".join(sorted(f"{r['change']}:{r['column']}" for r in report))
    table = t.spark.table(f"{db}.evolving_laps")
    sums = table.withColumn("lap_number", F.col("lap_number").cast("int")).groupBy("year").agg(*lap_sums(), F.sum("extra").alias("added"))
    return closed(t, db, sums.withColumns({"lap_number_type": F.lit(table.schema["lap_number"].dataType.simpleString()), "changes": F.lit(changes)}))


@query("compact", f"SELECT 4 AS files, session_key, {SQL_SUMS} FROM laps l GROUP BY session_key")
def compact(t):
    path = work_dir(t.spark, "small-files")
    t["laps"].select(*LAP_COLUMNS).repartition(32).write.parquet(path)
    writers.compact(t.spark, path, files=4)
    files = readers.list_dataset(t.spark, path).where(F.col("path").endswith(".parquet")).count()
    sums = readers.scan(t.spark, path).groupBy("session_key").agg(*lap_sums())
    return sums.withColumn("files", F.lit(files))


@query("compact_small", f"""
SELECT true AS fewer, true AS large_untouched, CAST(year AS INT) AS year, {SQL_SUMS} FROM laps l JOIN sessions USING (session_key) GROUP BY year""")
def compact_small(t):
    """Of each season one large file and many small ones."""
    path = work_dir(t.spark, "mixed-files")
    laps = laps_by_year(t)
    laps.where("lap_number > 12").repartition(1).write.partitionBy("year").parquet(path)
    large = readers.list_dataset(t.spark, path).where("path LIKE '%.parquet'").select("path").collect()
    laps.where("lap_number <= 12").repartition(6).write.mode("append").partitionBy("year").parquet(path)
    sizes = readers.list_dataset(t.spark, path).where("path LIKE '%.parquet'")
    least = sizes.where(F.col("path").isin([r["path"] for r in large])).agg(F.min("length")).first()[0]
    before = sizes.count()
    writers.compact_small(t.spark, path, ["year"], 2 * least)
    after = {r["path"] for r in readers.list_dataset(t.spark, path).where("path LIKE '%.parquet'").select("path").collect()}
    sums = readers.scan(t.spark, path).groupBy("year").agg(*lap_sums())
    return sums.withColumns({"fewer": F.lit(len(after) < before), "large_untouched": F.lit({r["path"] for r in large} <= after)})


@query("bucketed_star", """
SELECT session_key, driver_number, max(team_name) AS team_name, count(*) AS laps, min(lap_time) AS best, max(places) AS places
FROM laps JOIN drivers USING (session_key, driver_number)
  JOIN (SELECT session_key, driver_number, count(*) AS places FROM positions GROUP BY ALL) USING (session_key, driver_number)
WHERE lap_time > 0 GROUP BY session_key, driver_number""")
def bucketed_star(t):
    """Laps, drivers and positions in buckets of one kind: the joins and the grouping move no row."""
    db, root, keys = new_database(t, "metadata"), work_dir(t.spark, "bucketed"), ["session_key", "driver_number"]
    for name, rows in (("laps", t["laps"].select(*keys, "lap_number", "lap_time")), ("drivers", t["drivers"].select(*keys, "team_name")),
                       ("places", t["position"].select(*keys, "position"))):
        tables.save_bucketed(rows, f"{db}.{name}", f"{root}/{name}", keys, 8)
    laps, drivers, places = (t.spark.table(f"{db}.{n}").hint("merge") for n in ("laps", "drivers", "places"))
    counted = places.groupBy(*keys).agg(F.count(F.lit(1)).alias("places"))
    joined = laps.where("lap_time > 0").join(drivers, keys).join(counted, keys)
    return closed(t, db, joined.groupBy(*keys).agg(
        F.max("team_name").alias("team_name"), F.count(F.lit(1)).alias("laps"), F.min("lap_time").alias("best"), F.max("places").alias("places")))


@query("table_statistics", """
SELECT unnest(['session_key', 'lap_number', 'lap_time']) AS column_name,
  unnest([count(*) - count(session_key), count(*) - count(lap_number), count(*) - count(lap_time)]) AS nulls,
  unnest([min(session_key)::DOUBLE, min(lap_number)::DOUBLE, min(lap_time)]) AS least, unnest([max(session_key)::DOUBLE, max(lap_number)::DOUBLE, max(lap_time)]) AS greatest,
  true AS distinct_close, count(*) AS row_count FROM laps""")
def table_statistics(t):
    """Read from the catalog after one ANALYZE; distinct values are within a tenth of the exact number."""
    db = new_database(t, "metadata")
    columns = ["session_key", "lap_number", "lap_time"]
    tables.create_table(t.spark, f"{db}.measured", t["laps"].select(*columns).schema, work_dir(t.spark, "measured"))
    tables.save_table(t["laps"].select(*columns), f"{db}.measured")
    tables.analyze(t.spark, f"{db}.measured", columns, histograms=True)
    rows = int(re.search(r"(\d+) rows", tables.table_detail(t.spark, f"{db}.measured")["Statistics"])[1])
    exact = t["laps"].agg(*[F.count_distinct(c).alias(c) for c in columns]).first()
    near = F.create_map(*[x for c in columns for x in (F.lit(c), F.lit(exact[c]))])[F.col("column")]
    stats = tables.column_statistics(t.spark, f"{db}.measured")
    return closed(t, db, stats.select(
        F.col("column").alias("column_name"), "nulls", F.col("least").cast("double").alias("least"), F.col("greatest").cast("double").alias("greatest"),
        (F.abs(F.col("distinct") - near) <= near * 0.1).alias("distinct_close"), F.lit(rows).cast("long").alias("row_count")))


@query("discover", f"""
SELECT CAST(year AS INT) AS year, {SQL_SUMS} FROM laps l JOIN sessions USING (session_key) GROUP BY ALL""")
def discover(t):
    db, root = new_database(t, "metadata"), work_dir(t.spark, "found")
    writers.write_processed(laps_by_year(t), root, "laps")
    tables.discover(t.spark, f"{db}.raw_laps", f"{root}/laps")
    return closed(t, db, t.spark.table(f"{db}.raw_laps").groupBy("year").agg(*lap_sums()))

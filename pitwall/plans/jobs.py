"""The batch jobs: land, process, merge into the lake, build analytics and features.

Jobs write and return a small summary.  Derived tables are rewritten by season partition,
so that running a job twice leaves one copy.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from pitwall.catalog import TABLES
from pitwall.operators.clean import PROCESSED, process, valid_laps, valid_meetings
from pitwall.operators.quality import metrics, schema_metadata
from pitwall.operators.upsert import upsert_apart, upsert_path
from pitwall.plans.features import driver_features, race_context
from pitwall.plans.performance import gp_performance
from pitwall.plans.results import gp_results, standings
from pitwall.sources.readers import landed_years, path_exists, scan, scan_raw
from pitwall.sources.tables import save_table
from pitwall.sources.writers import write_partitioned
from pitwall.streaming.streams import read_stream, stream_upsert


def _as_text(endpoint: str, fmt: str) -> T.StructType | None:
    """Text formats are read as text: inferring types would take a pass over all the data."""
    if fmt == "parquet" or endpoint not in PROCESSED:
        return None
    return T.StructType([T.StructField(c, T.StringType()) for c in PROCESSED[endpoint][0]])


def raw_job(spark: SparkSession, landed: str, processed: str, endpoints: Sequence[str] = tuple(PROCESSED),
            years: Sequence[int] | None = None, fmt: str = "json", multi_line: bool = False,
            processed_at: Column | None = None) -> DataFrame:
    """Process landed rows of each endpoint, all years at once; returns what this run wrote.

    Rows are counted by season while they are written.  An endpoint without landed data is left
    out; a failing one is reported in its row and does not stop the others.
    """
    done: list[tuple] = []
    for endpoint in endpoints:
        try:
            seasons = landed_years(spark, landed, endpoint)
            seasons = [y for y in seasons if years is None or y in {int(x) for x in years}]
            if not seasons and endpoint in PROCESSED:
                continue
            raw = scan_raw(spark, landed, endpoint, seasons, _as_text(endpoint, fmt), fmt, multi_line)
            written = Observation()
            counts = [F.count_if(F.col("year") == y).alias(f"y{y}") for y in seasons]
            rows = process(raw, endpoint, processed_at, keep=["year"]).observe(written, *counts)
            write_partitioned(rows, f"{processed}/{endpoint}", ["year"])
            done += [(endpoint, y, n, "SUCCESS") for y, n in zip(seasons, (written.get[f"y{y}"] for y in seasons), strict=True) if n]
        except Exception as e:  # noqa: BLE001 - one endpoint's failure is part of the report
            done.append((endpoint, None, 0, f"ERROR: {e}"))
    return spark.createDataFrame(done, "endpoint string, year int, records_processed bigint, status string")


def lake_job(spark: SparkSession, processed: str, lake: str, endpoint: str,
             clean: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame | None:
    """Clean one processed table, keep the latest row per key and merge it into the lake table.

    Serves meetings, sessions, drivers and laps alike.  The merge rewrites each partition it
    touches into well-sized files, so no separate compaction of the table is needed.
    Returns the lake table, or nothing when there was no input.
    """
    table = TABLES[f"lake_{endpoint}"]
    source = scan(spark, f"{processed}/{endpoint}")
    if source.isEmpty():
        return None
    path = f"{lake}/{table.name}"
    batch = clean(source)
    columns = [c for c in table.schema.names if c in batch.columns]
    order = [F.desc_nulls_last("processing_timestamp"), *[F.asc_nulls_last(c) for c in columns if c not in table.keys]]
    keys = list(dict.fromkeys([*table.keys, *table.partition_by]))
    upsert_path(spark, path, batch.select(*columns), keys, order, table.partition_by)
    return spark.read.parquet(path)


def lake_stream(spark: SparkSession, processed: str, lake: str, endpoint: str, checkpoint: str,
                clean: Callable[[DataFrame], DataFrame] = lambda df: df) -> StreamingQuery | None:
    """``lake_job`` over the processed files not seen before; the checkpoint is the bookmark.

    Only partitions with new rows are read and rewritten.  ``clean`` looks at single rows.
    """
    table, source = TABLES[f"lake_{endpoint}"], f"{processed}/{endpoint}"
    if not path_exists(spark, source):
        return None
    batch = clean(read_stream(spark, source, scan(spark, source).schema))
    columns = [c for c in table.schema.names if c in batch.columns]
    order = [F.desc_nulls_last("processing_timestamp"), *[F.asc_nulls_last(c) for c in columns if c not in table.keys]]
    keys = list(dict.fromkeys([*table.keys, *table.partition_by]))
    return stream_upsert(batch.select(*columns), f"{lake}/{table.name}", keys, order, checkpoint, table.partition_by)


def save_metadata(spark: SparkSession, database: str, tables: Mapping[str, DataFrame], as_of: Column) -> None:
    """Append a row of quality metrics for each of the tables given, and replace the schema metadata of all."""
    for name, df in tables.items():
        ts = next((c for c in ("date", "date_start") if c in df.columns), None)
        save_table(metrics(df, name, as_of, ts=ts), f"{database}.data_quality_metrics")
    save_table(schema_metadata(spark, as_of), f"{database}.schema_metadata", "replace")


def meetings_job(spark: SparkSession, processed: str, lake: str) -> DataFrame | None:
    return lake_job(spark, processed, lake, "meetings", valid_meetings)


def laps_job(spark: SparkSession, processed: str, lake: str) -> DataFrame | None:
    return lake_job(spark, processed, lake, "laps", valid_laps)


def laps_job_by_date(spark: SparkSession, processed: str, lake: str) -> DataFrame:
    """``laps_job`` that leaves out dates whose laps cannot be read or merged, and tells them: (date_start, status)."""
    table, source = TABLES["lake_laps"], scan(spark, f"{processed}/laps")
    batch = valid_laps(source)
    columns = [c for c in table.schema.names if c in batch.columns]
    order = [F.desc_nulls_last("processing_timestamp"), *[F.asc_nulls_last(c) for c in columns if c not in table.keys]]
    keys = list(dict.fromkeys([*table.keys, *table.partition_by]))
    told = upsert_apart(spark, f"{lake}/{table.name}", batch.select(*columns), "date_start", keys, order, table.partition_by)
    return spark.createDataFrame([(d, f"ERROR: {e}" if e else "SUCCESS") for d, e in told], "date_start date, status string")


def sessions_job(spark: SparkSession, processed: str, lake: str) -> DataFrame | None:
    return lake_job(spark, processed, lake, "sessions", lambda df: df.where("session_key IS NOT NULL"))


def drivers_job(spark: SparkSession, processed: str, lake: str) -> DataFrame | None:
    return lake_job(spark, processed, lake, "drivers", lambda df: df.where("session_key IS NOT NULL AND driver_number IS NOT NULL"))


def save_analytics(t: Mapping[str, DataFrame], database: str, created_at: Column, literal: bool = False) -> dict[str, bool]:
    """Write results, performance and standings.

    Standings are computed from the results as written, not once more from the raw tables.
    """
    spark = t["laps"].sparkSession
    saved = {}
    saved["grand_prix_results"] = _save(gp_results(t, literal), database, "grand_prix_results", created_at)
    saved["grand_prix_performance"] = _save(gp_performance(t), database, "grand_prix_performance", created_at)
    saved["driver_championship_standings"] = saved["grand_prix_results"] and _save(
        standings(spark.table(f"{database}.grand_prix_results")), database, "driver_championship_standings", created_at
    )
    return saved


def save_features(t: Mapping[str, DataFrame], database: str, created_at: Column) -> dict[str, bool]:
    """Write driver features and race context from the saved analytics tables and the raw ones."""
    spark = t["laps"].sparkSession
    results = spark.table(f"{database}.grand_prix_results")
    performance = spark.table(f"{database}.grand_prix_performance")
    return {
        "driver_performance_features": _save(driver_features(t, performance, results), database, "driver_performance_features", created_at),
        "race_context_features": _save(race_context(t), database, "race_context_features", created_at),
    }


def _save(df: DataFrame, database: str, table: str, created_at: Column) -> bool:
    """Write the rows; whether there were any."""
    written = Observation()
    rows = df.withColumn("created_at", created_at).observe(written, F.count(F.lit(1)).alias("n"))
    save_table(rows, f"{database}.{table}", "replace_partitions")
    return written.get["n"] > 0


def aggregator_job(t: Mapping[str, DataFrame], database: str, created_at: Column) -> dict[str, bool]:
    """Rebuild analytics, then features."""
    return {**save_analytics(t, database, created_at), **save_features(t, database, created_at)}

"""Incremental forms of the batch operators over file streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from pitwall.operators.upsert import touched_rows, upsert_path
from pitwall.plans.performance import telemetry_aggs
from pitwall.session import stage
from pitwall.sources.readers import path_exists
from pitwall.sources.swap import has_data


def read_stream(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet",
                files_per_batch: int | None = None) -> DataFrame:
    """New files below a directory, in the order they arrived."""
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def stream_ingest(spark: SparkSession, in_dir: str, schema: StructType, out: str, checkpoint: str,
                  fmt: str = "json", partition_by: Sequence[str] = (), files_per_batch: int | None = None) -> StreamingQuery:
    """Copy files not seen before into a Parquet table, each exactly once.

    The checkpoint remembers what was read: run it again after more files have landed and
    only those are added.
    """
    writer = read_stream(spark, in_dir, schema, fmt, files_per_batch).writeStream.format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_endpoint(spark: SparkSession, root: str, endpoint: str, schema: StructType, out: str, checkpoint: str,
                    fmt: str = "parquet") -> StreamingQuery:
    """New landed files of one endpoint, of any year."""
    return stream_ingest(spark, f"{root}/year=*/endpoint={endpoint}", schema, out, checkpoint, fmt)


def stream_dedup(df: DataFrame, keys: Sequence[str], ts: str, delay: str) -> DataFrame:
    """First arrival of each key, remembered for ``delay`` of event time."""
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def stream_telemetry(df: DataFrame, window: str, delay: str, by: Sequence[str] = ("session_key", "driver_number"),
                     ts: str = "date") -> DataFrame:
    """Telemetry aggregates by driver and tumbling window; samples later than ``delay`` are dropped."""
    timed = df.where(F.col("speed").isNotNull()).withWatermark(ts, delay)
    return timed.groupBy(F.window(ts, window), *by).agg(*telemetry_aggs()).select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *by,
        "avg_speed", "max_speed", "avg_throttle", "time_spent_braking_pct",
    )


def stream_upsert(df: DataFrame, path: str, keys: Sequence[str], order_by: Sequence[str | Column] | None, checkpoint: str,
                  partition_by: Sequence[str] = (), output_mode: str = "append") -> StreamingQuery:
    """Merge every micro-batch into a Parquet table by key, rewriting the partitions it touches.

    Of the rows of a key, stored or new, the first in ``order_by`` stays, so the table does not
    depend on how files are dealt out over batches.  ``order_by=None`` lets a later batch
    replace an earlier one, as the current value of an aggregate in ``update`` mode must.  A
    batch repeated after a failure merges to the same table.
    """

    def merge(batch: DataFrame, _: int) -> None:
        order = list(keys) if order_by is None else order_by
        upsert_path(batch.sparkSession, path, batch, keys, order, partition_by, ranked=order_by is not None)

    return (
        df.writeStream.outputMode(output_mode).foreachBatch(merge)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def stream_windows_told(df: DataFrame, path: str, window: str, delay: str, by: Sequence[str], aggs: Sequence[Column], checkpoint: str,
                        counts: str, ts: str = "date", partition_by: Sequence[str] = ()) -> StreamingQuery:
    """Aggregates by window and ``by`` as a Parquet table at ``path``, each with its number of rows ``n``; and, for ``late_rows``, how many rows each
    micro-batch brought into windows, as a Parquet table at ``counts``.

    The engine tells how many groups of late rows it left out, not how many rows. So a batch's windows are compared with those stored: what
    their ``n`` have grown by came in, and what was sent beyond that was late. A batch that is repeated after a failure keeps the
    count of its first try, which was taken before the table was touched. The engine judges a batch by the watermark that the batch before it
    began with, so rows are late from the third batch on. Partition columns must be of ``by``.
    """
    keys = ["window_start", *by]
    timed = df.observe("sent", F.count(F.lit(1)).alias("rows")).withWatermark(ts, delay)
    windows = timed.groupBy(F.window(ts, window), *by).agg(F.count(F.lit(1)).alias("n"), *aggs)
    flat = windows.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *[c for c in windows.columns if c != "window"])

    def merge(batch: DataFrame, number: int) -> None:
        spark, batch = batch.sparkSession, stage(batch, "windows")
        if not path_exists(spark, f"{counts}/batch={number}"):
            grown = batch.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"))
            if has_data(spark, path, partition_by):
                held = touched_rows(spark.read.parquet(path), batch, partition_by) if partition_by else spark.read.parquet(path)
                old = held.select(*keys, F.col("n").alias("old"))
                grown = batch.join(old, keys, "left").agg(F.coalesce(F.sum(F.col("n") - F.coalesce("old", F.lit(0))), F.lit(0)).alias("rows"))
            grown.coalesce(1).write.mode("overwrite").parquet(f"{counts}/batch={number}")
        upsert_path(spark, path, batch, keys, keys, partition_by)

    return (flat.writeStream.outputMode("update").foreachBatch(merge)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def late_rows(query: StreamingQuery, counts: str) -> DataFrame:
    """(batch, sent, in_windows, dropped) of each micro-batch of a finished ``stream_windows_told``: rows sent are those in windows and
    those that the watermark dropped. The engine keeps the progress of so many batches as ``spark.sql.streaming.numRecentProgressUpdates``."""
    told: dict[int, int] = {}
    for p in query.recentProgress:
        sent = p.observedMetrics.get("sent")
        told[p.batchId] = max(told.get(p.batchId, 0), sent["rows"] if sent else 0)
    spark = SparkSession.active()
    sent = spark.createDataFrame(list(told.items()), "batch int, sent long")
    came = spark.read.parquet(counts).select(F.col("batch").cast("int").alias("batch"), F.col("rows").alias("in_windows"))
    return sent.join(came, "batch").select("batch", "sent", "in_windows", (F.col("sent") - F.col("in_windows")).alias("dropped"))


def stream_append(df: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    return (
        df.writeStream.format("parquet").outputMode("append").option("path", out)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )

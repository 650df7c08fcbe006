"""The bookmarked lake job and the metadata tables."""

from pathlib import Path

from pyspark.sql import functions as F

from racing import rows
from pitwall.operators import quality
from pitwall.operators.clean import valid_laps
from pitwall.plans import jobs
from pitwall.session import work_dir
from pitwall.sources import tables, writers


def stamp():
    return F.lit("2024-01-01").cast("timestamp")


def laps(spark, day, time, at):
    df = spark.createDataFrame([(1, 4, n, time) for n in (1, 2)], "session_key long, driver_number int, lap_number int, lap_time double")
    names = {c: F.lit(1.0) for c in ("lap_duration", "i1_speed", "i2_speed", "st_speed")}
    return df.withColumns(names | {"compound": F.lit("SOFT"), "tyre_life": F.lit(1), "date_start": F.lit(day).cast("date"),
                                   "processing_timestamp": F.lit(at).cast("timestamp"), "year": F.lit(2023)})


def test_second_run_touches_only_new_partitions(spark):
    processed, lake, mark = (work_dir(spark, n) for n in ("processed", "lake", "ckpt"))
    run = lambda: jobs.lake_stream(spark, processed, lake, "laps", mark, valid_laps)
    assert run() is None
    writers.write_files(laps(spark, "2023-03-05", 80.0, "2023-03-06"), f"{processed}/laps", mode="append")
    writers.write_files(laps(spark, "2023-03-12", 81.0, "2023-03-13"), f"{processed}/laps", mode="append")
    run().awaitTermination()
    root = Path(f"{lake}/lake_laps")
    files = lambda: {d.name: {f.name for f in d.glob("*.parquet")} for d in root.glob("date_start=*")}
    before = files()
    writers.write_files(laps(spark, "2023-03-12", 79.0, "2023-03-14"), f"{processed}/laps", mode="append")
    writers.write_files(laps(spark, "2023-03-12", 99.0, "2023-03-01"), f"{processed}/laps", mode="append")  # older than what is there
    run().awaitTermination()
    after = files()
    assert {f for f in after if after[f] != before.get(f)} == {"date_start=2023-03-12"}
    got = rows(spark.read.parquet(f"{lake}/lake_laps"), F.col("date_start").cast("string"), "lap_number", "lap_time")
    assert got == [("2023-03-05", 1, 80.0), ("2023-03-05", 2, 80.0), ("2023-03-12", 1, 79.0), ("2023-03-12", 2, 79.0)]


def test_saved_metadata_fills_what_is_required(spark):
    db = "pitwall_metadata_test"
    tables.create_tables(spark, db, "metadata", work_dir(spark, "db"))
    stints = spark.createDataFrame([(1, 2, 4, 1), (1, 2, 4, 1)], "session_key long, meeting_key long, driver_number int, stint_number int")
    for _ in range(2):
        jobs.save_metadata(spark, db, {"raw_stints": stints}, stamp())
    saved = {n: spark.table(f"{db}.{n}") for n in ("data_quality_metrics", "schema_metadata")}
    assert rows(saved["data_quality_metrics"], "table_name", "total_records", "duplicate_records") == [("raw_stints", 2, 1)] * 2
    for name, df in saved.items():
        bad = quality.metrics(df, name, stamp()).first()
        assert bad.constraint_violations == 0 and df.count() > 0
    spark.sql(f"DROP DATABASE {db} CASCADE")

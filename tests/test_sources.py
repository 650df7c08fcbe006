"""Files, landing, tables, upserts, jobs and streams in temporary folders."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from racing import rows, season

from pitwall.operators.upsert import upsert, upsert_path
from pitwall.plans import jobs, results
from pitwall.plans.performance import telemetry
from pitwall.session import shared_root, stage, work_dir
from pitwall.sources import readers, tables, writers
from pitwall.streaming import streams

STAMP = "2024-01-01 00:00:00"


def stamp():
    return F.lit(STAMP).cast("timestamp")


@pytest.fixture
def there(tmp_path):
    return lambda name: str(tmp_path / name)


def sample(spark):
    return spark.createDataFrame([(1, 10.5, "a,b"), (2, None, "ü\"x"), (3, -1.0, None)], "id int, value double, category string")


@pytest.mark.parametrize("fmt", ["parquet", "csv", "json"])
def test_round_trip(spark, there, fmt):
    df = sample(spark).withColumn("at", F.lit("2023-01-01 00:00:00.123456").cast("timestamp"))
    writers.write_files(df, there("x"), fmt)
    back = readers.scan(spark, there("x"), fmt, df.schema)
    assert rows(back.select(df.columns)) == rows(df)


def test_unknown_format(spark, there):
    for call in (lambda: readers.scan(spark, there("x"), "xml"), lambda: writers.write_files(spark.range(1), there("x"), "xml")):
        with pytest.raises(ValueError, match="xml"):
            call()


def test_json_arrays(spark, tmp_path):
    folder = tmp_path / "year=2023" / "endpoint=pit"
    folder.mkdir(parents=True)
    (folder / "a.json").write_text(json.dumps([{"session_key": 1, "pit_duration": 22.1}, {"session_key": 2, "pit_duration": None}], indent=1))
    (folder / "b.json").write_text(json.dumps([{"session_key": 3, "pit_duration": 23}]))
    got = readers.scan_raw(spark, str(tmp_path), "pit", fmt="json", multi_line=True, processed_at=stamp())
    assert rows(got, "session_key", "extraction_year", "endpoint") == [(1, 2023, "pit"), (2, 2023, "pit"), (3, 2023, "pit")]


def test_landing_appends_and_filters(spark, there):
    df = sample(spark).selectExpr("id AS session_key", "value AS pit_duration", "2022 + id % 2 AS year", "7 AS driver_number")
    writers.land(df, there("raw"), "pit", stamp())
    writers.land(df, there("raw"), "pit", stamp())
    assert readers.scan_raw(spark, there("raw"), "pit").count() == 6
    assert rows(readers.scan_raw(spark, there("raw"), "pit", [2022]), "session_key", "_endpoint") == [(2, "pit"), (2, "pit")]
    assert readers.scan_raw(spark, there("raw"), "pit", session_key=3, driver_number=7).count() == 2
    assert readers.scan_raw(spark, there("raw"), "pit", [1999]).count() == 0
    assert readers.scan_raw(spark, there("raw"), "laps", schema=df.schema).count() == 0


def test_text_is_landed_compressed_in_files_of_bounded_rows(spark, there, monkeypatch):
    monkeypatch.setattr(writers, "LANDED_ROWS", 100)
    df = spark.range(1000).coalesce(1).selectExpr("id AS session_key", "id / 8 AS pit_duration", "timestamp_ntz'2024-01-01 00:00:00.000001' + make_dt_interval(0, 0, 0, id) AS date",
                                                  "2022 + id % 2 AS year")
    for fmt in ("json", "csv"):
        writers.land(df, there(fmt), "pit", stamp(), fmt)
        files = [f for f in Path(there(fmt)).rglob("part-*")]
        assert len(files) == 10 and all(f.name.endswith(f".{fmt}.gz") for f in files)
    schema = df.drop("year").schema
    back = readers.scan_raw(spark, there("json"), "pit", None, schema, "json")
    assert rows(back, *df.columns) == rows(df.withColumn("year", F.col("year").cast("int")), *df.columns)
    assert sum(f.stat().st_size for f in Path(there("json")).rglob("part-*.gz")) < back.count() * 40  # a line has about 170 bytes


def test_endpoint_filters_reach_the_scan(spark, there):
    df = spark.range(10).selectExpr("id AS session_key", "CAST(id AS int) AS driver_number", "2023 AS year")
    writers.land(df, there("raw"), "laps", stamp())
    plan = readers.scan_raw(spark, there("raw"), "laps", session_key=4)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(session_key), EqualTo(session_key,4)]" in plan


def test_endpoint_errors(spark, there):
    with pytest.raises(ValueError, match="unknown endpoint"):
        readers.scan_raw(spark, there("raw"), "tyres")
    with pytest.raises(ValueError, match="cannot be filtered"):
        readers.scan_raw(spark, there("raw"), "weather", driver_number=1)


def test_partitioned_write_replaces_only_its_partitions(spark, there):
    df = spark.createDataFrame([("2023-01-01", 1), ("2023-01-02", 2), ("2024-01-01", 3)], "date string, v int").withColumn("date", F.to_date("date"))
    writers.write_partitioned(writers.with_date_parts(df), there("p"))
    writers.write_partitioned(writers.with_date_parts(df.where("v = 2").withColumn("v", F.lit(20))), there("p"))
    assert rows(spark.read.parquet(there("p")), "year", "month", "day", "v") == [(2023, 1, 1, 1), (2023, 1, 2, 20), (2024, 1, 1, 3)]


@pytest.mark.parametrize("parts", [(), ("k",)])
def test_compact(spark, there, parts):
    df = spark.range(1000).selectExpr("id", "id % 3 AS k")
    (df.repartition(20).write.partitionBy(*parts) if parts else df.repartition(20).write).parquet(there("c"))
    before = readers.list_dataset(spark, there("c")).where("path LIKE '%.parquet'").count()
    writers.compact(spark, there("c"), parts, files=None if parts else 2)
    after = readers.list_dataset(spark, there("c")).where("path LIKE '%.parquet'").count()
    assert before >= 20 and after <= 3
    assert spark.read.parquet(there("c")).select("id", "k").exceptAll(df).isEmpty()
    assert spark.read.parquet(there("c")).count() == 1000


def test_queries_with_parameters(spark):
    args = {"t_pits": sample(spark)}
    assert rows(readers.scan_query(spark, "SELECT id FROM t_pits WHERE category = :c", {"c": "a,b"}, args)) == [(1,)]
    assert rows(readers.scan_query(spark, "SELECT id FROM t_pits WHERE id > ? AND id < ?", [1, 3], args)) == [(2,)]
    assert rows(readers.scan_query(spark, "SELECT id FROM t_pits WHERE category = :c", {"c": "' OR 1=1 --"}, args)) == []


def test_extraction_stats(spark):
    df = spark.createDataFrame([(2022, "laps"), (2022, "laps"), (2022, "pit"), (2023, "pit")], "year int, endpoint string")
    assert rows(readers.extraction_stats(df)) == sorted(
        [(2022, "laps", 2, 1), (2022, "pit", 1, 1), (2023, "pit", 1, 1), (2022, None, 3, 2), (2023, None, 1, 1), (None, None, 4, 3)], key=repr)


def test_tables(spark, there):
    db = f"t_{abs(hash(there('x')))}"
    names = tables.create_tables(spark, db, "analytics", there("db"))
    assert names == ["grand_prix_results", "grand_prix_performance", "driver_championship_standings"]
    assert tables.table_exists(spark, f"{db}.grand_prix_results") and not tables.table_exists(spark, f"{db}.nothing")
    assert tables.describe_table(spark, f"{db}.grand_prix_results")["points"] == "double"
    rows_ = results.gp_results(season(spark)).withColumn("created_at", stamp())
    for _ in range(2):
        tables.save_table(rows_, f"{db}.grand_prix_results", "replace_partitions")
    assert spark.table(f"{db}.grand_prix_results").count() == 8
    tables.save_table(rows_, f"{db}.grand_prix_results", "append")
    assert spark.table(f"{db}.grand_prix_results").count() == 16
    with pytest.raises(ValueError, match="unknown mode"):
        tables.save_table(rows_, f"{db}.grand_prix_results", "merge")


def test_aggregator_twice_leaves_one_copy(spark, there):
    db = f"a_{abs(hash(there('x')))}"
    tables.create_tables(spark, db, "analytics", there("a"))
    tables.create_tables(spark, db, "ml", there("m"))
    for _ in range(2):
        saved = jobs.aggregator_job(season(spark), db, stamp())
    assert saved == dict.fromkeys(("grand_prix_results", "grand_prix_performance", "driver_championship_standings",
                                   "driver_performance_features", "race_context_features"), True)
    counts = {t: spark.table(f"{db}.{t}").count() for t in saved}
    assert counts == {"grand_prix_results": 8, "grand_prix_performance": 11, "driver_championship_standings": 9,
                      "driver_performance_features": 8, "race_context_features": 3}


def test_standings_wait_for_results(spark, there):
    db = f"w_{abs(hash(there('x')))}"
    tables.create_tables(spark, db, "analytics", there("a"))
    saved = jobs.save_analytics(season(spark, session_result=[]), db, stamp())
    assert saved == {"grand_prix_results": False, "grand_prix_performance": True, "driver_championship_standings": False}


TARGET = [(1, 1, "a", 10), (2, 1, "b", 20), (None, 1, "n", 30)]


def frame(spark, data):
    return spark.createDataFrame(data, "k int, p int, v string, w int")


@pytest.mark.parametrize(("batch", "want"), [
    ([(1, 1, "A", 11)], [(1, 1, "A", 11), (2, 1, "b", 20), (None, 1, "n", 30)]),
    ([(3, 2, "c", 1)], [*TARGET, (3, 2, "c", 1)]),
    ([(1, 1, "A", None), (3, 1, "c", 1)], [(1, 1, "A", None), (2, 1, "b", 20), (None, 1, "n", 30), (3, 1, "c", 1)]),
    ([(1, 1, "x", 1), (1, 1, "y", 2)], [(1, 1, "y", 2), (2, 1, "b", 20), (None, 1, "n", 30)]),
    ([(None, 1, "m", 1)], [*TARGET, (None, 1, "m", 1)]),
    ([], TARGET),
])
def test_upsert(spark, there, batch, want):
    got = upsert(frame(spark, TARGET), frame(spark, batch), ["k", "p"], [F.desc("w")])
    assert rows(got) == sorted(want, key=repr)
    for parts in ([], ["p"]):
        path = there(f"u{len(parts)}")
        frame(spark, TARGET).write.partitionBy(*parts).parquet(path)
        upsert_path(spark, path, frame(spark, batch), ["k", "p"], [F.desc("w")], parts)
        assert rows(spark.read.parquet(path), "k", "p", "v", "w") == sorted(want, key=repr)


def test_upsert_of_some_columns(spark):
    got = upsert(frame(spark, TARGET), frame(spark, [(1, 1, "A", 99), (5, 1, "e", 50)]), ["k", "p"], ["v"], update_cols=["v"])
    assert rows(got) == sorted([(1, 1, "A", 10), (2, 1, "b", 20), (None, 1, "n", 30), (5, 1, "e", 50)], key=repr)


def test_upsert_leaves_other_partitions_alone(spark, there):
    path = there("u")
    frame(spark, [(1, 1, "a", 1), (2, 2, "b", 2), (3, None, "c", 3)]).write.partitionBy("p").parquet(path)
    files = lambda p: sorted(r["path"] for r in readers.list_dataset(spark, path).where(F.col("path").contains(p)).collect())
    before = files("/p=1/")
    upsert_path(spark, path, frame(spark, [(2, 2, "B", 9), (4, None, "d", 4)]), ["k", "p"], ["v"], ["p"])
    assert files("/p=1/") == before
    assert rows(spark.read.parquet(path), "k", "v") == [(1, "a"), (2, "B"), (3, "c"), (4, "d")]
    with pytest.raises(ValueError, match="part of the key"):
        upsert_path(spark, path, frame(spark, []), ["k"], ["v"], ["p"])


def test_upsert_twice_is_the_same(spark, there):
    batch = frame(spark, [(1, 1, "A", 11), (7, 3, "g", 70)])
    for _ in range(3):
        upsert_path(spark, there("u"), batch, ["k", "p"], ["v"], ["p"])
    assert rows(spark.read.parquet(there("u")), "k", "p", "v", "w") == [(1, 1, "A", 11), (7, 3, "g", 70)]


def test_raw_and_lake_jobs(spark, tmp_path, there):
    for year, name in ((2022, "Old"), (2023, "New")):
        folder = tmp_path / "landed" / f"year={year}" / "endpoint=meetings"
        folder.mkdir(parents=True)
        meetings = [{"meeting_key": 1000 + year, "meeting_name": name, "date_start": f"{year}-03-05T13:00:00+00:00", "year": year, "location": "Town"},
                    {"meeting_key": None, "meeting_name": "no key", "year": year}, {"meeting_key": 5, "meeting_name": None, "year": year}]
        (folder / "d.json").write_text(json.dumps(meetings))
    done = jobs.raw_job(spark, there("landed"), there("processed"), ["meetings", "laps"], fmt="json", multi_line=True, processed_at=stamp())
    assert rows(done.where("endpoint = 'meetings'"), "records_processed", "status")[0][1] == "SUCCESS"
    assert rows(done.where("endpoint = 'laps'"), "status") == []  # nothing has landed
    for _ in range(2):
        lake = jobs.meetings_job(spark, there("processed"), there("lake"))
    assert rows(lake, "meeting_key", "year", "data_quality_score") == [(3022, 2022, 0.8), (3023, 2023, 0.8)]


def test_lake_job_without_input(spark, there):
    spark.range(0).selectExpr("id AS session_key").write.parquet(there("processed/laps"))
    assert jobs.laps_job(spark, there("processed"), there("lake")) is None


def test_working_folders_are_new_and_shared(spark):
    a, b = work_dir(spark, "x"), work_dir(spark, "x")
    assert a != b and a.startswith(shared_root(spark))
    assert rows(stage(sample(spark), "s")) == rows(sample(spark))


def test_stream_ingest_takes_each_file_once(spark, there):
    df = spark.range(20).selectExpr("id", "id * 1.5 AS v")
    for part in range(3):
        if part < 2:
            writers.write_files(df.where(f"id % 2 = {part}"), there("in"), "json", "append")
        streams.stream_ingest(spark, there("in"), df.schema, there("out"), there("ckpt"), files_per_batch=1).awaitTermination()
    assert rows(spark.read.parquet(there("out"))) == rows(df)


def test_stream_dedup_within_the_delay(spark, there):
    df = spark.createDataFrame([(1, "2023-01-01 00:00:00"), (1, "2023-01-01 00:00:30"), (2, "2023-01-01 00:00:10")], "k int, t string").withColumn("t", F.to_timestamp("t"))
    writers.write_files(df, there("in"))
    unique = streams.stream_dedup(streams.read_stream(spark, there("in"), df.schema), ["k"], "t", "1 minute")
    streams.stream_append(unique, there("out"), there("ckpt")).awaitTermination()
    assert rows(spark.read.parquet(there("out")), "k") == [(1,), (2,)]


def test_stream_windows_equal_batch_and_drop_late_rows(spark, there):
    cols = "session_key int, driver_number int, date string, speed int, throttle int, brake int"
    first = [(1, 1, "2023-01-01 00:00:01", 100, 10, 0), (1, 1, "2023-01-01 00:00:09", 200, 20, 1), (1, 1, "2023-01-01 00:05:00", 300, 30, 1)]
    late = [(1, 1, "2023-01-01 00:00:05", 999, 99, 1)]
    keys = ["window_start", "window_end", "session_key", "driver_number"]

    def feed(data):
        df = spark.createDataFrame(data, cols).withColumn("date", F.to_timestamp("date"))
        writers.write_files(df, there("in"), mode="append")
        live = streams.read_stream(spark, there("in"), df.schema)
        windows = streams.stream_telemetry(live, "10 seconds", "30 seconds")
        streams.stream_upsert(windows, there("out"), keys, ["avg_speed"], there("ckpt"), output_mode="update").awaitTermination()
        return df

    df = feed(first)
    got = spark.read.parquet(there("out"))
    want = telemetry(df.withColumn("window_start", F.window("date", "10 seconds")["start"]), ("window_start", "session_key", "driver_number"))
    assert rows(got.select(want.columns)) == rows(want)
    feed(late)  # the watermark is past that window
    assert rows(spark.read.parquet(there("out")).select(want.columns)) == rows(want)


def test_stream_of_one_endpoint(spark, there):
    df = spark.createDataFrame([(1, 22.0, 2022), (2, 23.0, 2023)], "session_key int, pit_duration double, year int")
    for endpoint in ("pit", "laps"):
        writers.land(df, there("raw"), endpoint, stamp())
    schema = df.select("session_key", "pit_duration").schema
    for _ in range(2):
        streams.stream_endpoint(spark, there("raw"), "pit", schema, there("out"), there("ckpt")).awaitTermination()
    assert rows(spark.read.parquet(there("out"))) == [(1, 22.0), (2, 23.0)]

"""Upserts and compaction survive a failure at any step, and touch only what they must."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from racing import rows
from pitwall.operators.joins import range_join
from pitwall.operators.upsert import execute_each, upsert_apart, upsert_path
from pitwall.operators.windows import running_total
from pitwall.plans import jobs, reports
from pitwall.session import work_dir
from pitwall.sources import readers, swap, writers
from pitwall.streaming import streams

SCHEMA = "k long, day int, v string"


def table(spark, parts):
    path = work_dir(spark, "table")
    df = spark.createDataFrame([(k, k % 4, "old") for k in range(100)], SCHEMA)
    (df.write.partitionBy(*parts) if parts else df.write).parquet(path)
    return path


def state(spark, path):
    return sorted((r.k, r.v) for r in spark.read.parquet(path).collect())


class Broken(Exception):
    pass


def files(path):
    """Data files by partition folder."""
    root = Path(path.removeprefix("file:"))
    return {str(f.relative_to(root).parent): {x.name for x in f.parent.glob("*.parquet")} for f in root.rglob("*.parquet")}


def put_breaks(monkeypatch, when, path, where="*"):
    done = swap._put

    def breaks(*args):
        if when == "half":  # some files of the table are gone, none of the new ones is there
            for f in list(Path(path).glob(f"{where}/*.parquet" if where else "*.parquet"))[::2]:
                f.unlink()
        if when == "after":
            done(*args)
        raise Broken

    monkeypatch.setattr(swap, "_put", breaks)


@pytest.mark.parametrize("parts", [[], ["day"]])
@pytest.mark.parametrize("when", ["before", "half", "after", "copy", "remove"])
def test_upsert_fails_anywhere_and_is_run_again(spark, monkeypatch, parts, when):
    path = table(spark, parts)
    batch = spark.createDataFrame([(1, 1, "new"), (5, 1, "new"), (1000, 2, "new")], SCHEMA)
    want = sorted([(k, "new" if k in (1, 5) else "old") for k in range(100)] + [(1000, "new")])
    with monkeypatch.context() as m:
        if when == "copy":  # a copy that was not written in full
            Path(f"{swap.Copies(spark, path).new()}").mkdir(parents=True)
        elif when == "remove":
            m.setattr(swap.Copies, "remove", lambda self: (_ for _ in ()).throw(Broken()))
        else:
            put_breaks(m, when, path, "day=1" if parts else "")
        if when != "copy":
            with pytest.raises(Broken):
                upsert_path(spark, path, batch, ["k", "day"], ["v"], parts)
            if when == "remove":  # before anything else: an older copy may be waiting
                assert state(spark, path) == [(k, "old") for k in range(100)]
    upsert_path(spark, path, batch, ["k", "day"], ["v"], parts)
    assert state(spark, path) == want
    assert not Path(swap.Copies(spark, path).folder).exists()


@pytest.mark.parametrize("parts", [[], ["day"]])
def test_a_failing_task_leaves_the_table(spark, parts):
    path = table(spark, parts)
    bad = spark.createDataFrame([(1, 1, "x")], SCHEMA).withColumn("v", F.expr("raise_error('no')"))
    with pytest.raises(Exception, match="no"):
        upsert_path(spark, path, bad, ["k", "day"], ["k"], parts)
    assert state(spark, path) == [(k, "old") for k in range(100)]


@pytest.mark.parametrize("parts", [[], ["day"]])
def test_compact_fails_and_is_run_again(spark, monkeypatch, parts):
    path = table(spark, parts)
    with monkeypatch.context() as m:
        put_breaks(m, "half", path, "day=*" if parts else "")
        with pytest.raises(Broken):
            writers.compact(spark, path, parts)
    writers.compact(spark, path, parts)
    assert state(spark, path) == [(k, "old") for k in range(100)]


def test_only_touched_partitions_are_read_and_written(spark, monkeypatch):
    path = table(spark, ["day"])
    before = files(path)
    plans = []
    done = swap.replace
    monkeypatch.setattr("pitwall.operators.upsert.replace", lambda df, *a, **b: (plans.append(df._jdf.queryExecution().toString()), done(df, *a, **b)))
    upsert_path(spark, path, spark.createDataFrame([(7, 3, "new")], SCHEMA), ["k", "day"], ["v"], ["day"])
    assert re.search(r"PartitionFilters: \[[^\]]*day", plans[0])
    after = files(path)
    assert {f for f in before if before[f] != after[f]} == {"day=3"}


def test_many_partitions_are_no_literals(spark, monkeypatch):
    monkeypatch.setattr("pitwall.operators.upsert.LITERALS", 2)
    path = work_dir(spark, "table")
    spark.createDataFrame([(k, k % 9 if k % 9 < 8 else None, "old") for k in range(90)], SCHEMA).write.partitionBy("day").parquet(path)
    before = files(path)
    upsert_path(spark, path, spark.createDataFrame([(k, k % 9, "new") for k in (1, 2, 4, 5)] + [(500, None, "new")], SCHEMA), ["k", "day"], ["v"], ["day"])
    assert state(spark, path) == sorted([(k, "new" if k in (1, 2, 4, 5) else "old") for k in range(90)] + [(500, "new")])
    assert {f for f in before if before[f] != files(path)[f]} == {"day=1", "day=2", "day=4", "day=5", "day=__HIVE_DEFAULT_PARTITION__"}


def test_a_failing_day_is_told_and_left_out(spark):
    path = table(spark, ["day"])
    bad = F.when(F.col("day").isin(2, 11), F.expr("raise_error('no such day')")).otherwise(F.col("v"))
    batch = spark.createDataFrame([(k, day, "new") for k, day in ((1, 1), (2, 2), (3, 3), (4, 0), (900, 10), (901, 11))], SCHEMA).withColumn("v", bad)
    told = upsert_apart(spark, path, batch, "day", ["k", "day"], ["v"], ["day"])
    assert [v for v, e in told] == [0, 1, 2, 3, 10, 11] and {v for v, e in told if e} == {2, 11} and all("no such day" in e for _, e in told if e)
    assert state(spark, path) == sorted([(k, "new" if k in (1, 3, 4) else "old") for k in range(100)] + [(900, "new")])
    assert upsert_apart(spark, path, batch.where("false"), "day", ["k", "day"], ["v"], ["day"]) == []


@pytest.mark.parametrize("parts", [[], ["day"]])
def test_statements_for_many_parameter_sets(spark, parts):
    path, key = table(spark, parts), ["k", "day"]
    sets = lambda rows, schema: spark.createDataFrame(rows, schema)
    execute_each(spark, path, "update", sets([(1, 1, "b"), (1, 1, "a"), (7, 2, "no row"), (None, 1, "null")], SCHEMA), key, ["v"], parts)
    execute_each(spark, path, "delete", sets([(k, 3) for k in range(100)] + [(2, 2), (None, None)], "k long, day int"), key, (), parts)
    for _ in range(2):
        execute_each(spark, path, "insert", sets([(1, 1, "there"), (600, 1, "x"), (601, 9, None)], SCHEMA), key, ["v"], parts)
    want = [(k, "a" if k == 1 else "old") for k in range(100) if k % 4 != 3 and k != 2] + [(600, "x"), (601, None)]
    assert rows(spark.read.parquet(path), "k", "v") == sorted(want, key=repr)
    if parts:
        assert "day=3" not in files(path)
    with pytest.raises(ValueError):
        execute_each(spark, path, "merge", sets([(1, 1)], "k long, day int"), key)
    with pytest.raises(ValueError):
        execute_each(spark, path, "update", sets([(1, 1, 2)], "k long, day int, other int"), key)


def test_stream_upsert_does_not_depend_on_batches(spark):
    for per_batch in (None, 1):
        source, out = work_dir(spark, "files"), work_dir(spark, "out")
        for ts in (20, 10, 30, 5):
            spark.createDataFrame([(1, ts if ts < 30 else 1, f"{ts}"), (2, ts, f"{ts}")], "k long, ts int, v string").coalesce(1).write.mode("append").parquet(source)
        stream = streams.read_stream(spark, source, spark.read.parquet(source).schema, files_per_batch=per_batch)
        streams.stream_upsert(stream.withColumn("part", F.col("k") % 2), out, ["k", "part"], [F.desc("ts")], work_dir(spark, "ckpt"), ["part"]).awaitTermination()
        assert rows(spark.read.parquet(out), "k", "v") == [(1, "20"), (2, "30")]


def test_running_total_in_blocks_equals_the_plain_one(spark):
    data = [(1, 1, 1, 5), (1, 2, 1, None), (1, 2, 2, 3), (None, 1, 1, 7), (None, 2, 1, None), (2, None, 0, 4), (2, 1, 1, 1), (3, 1, 1, None), (3, 2, 1, None), (3, 3, 1, 2)]
    df = spark.createDataFrame(data, "d int, b int, o int, x int")
    plain, blocks = (running_total(df, ["d"], ["b", "o"], "x", block=b) for b in (None, "b"))
    assert rows(plain, "d", "b", "o", "running_total") == rows(blocks, "d", "b", "o", "running_total")


def test_long_ranges_and_copies_of_ranges(spark):
    laps = spark.createDataFrame([(1, n) for n in range(-5, 60)], "k int, lap int")
    stints = spark.createDataFrame([(1, 10, 2**31 - 1, "long"), (1, -(2**31), 3, "low"), (1, 20, 19, "empty"), (1, None, 5, "null")] + [(1, 4, 30, "copy")] * 3000,
                                   "k int, lo int, hi int, name string")
    got = dict(rows(range_join(laps, stints, ["k"], "lap", "lo", "hi", ["name"]), "lap", "name"))
    assert got == {n: "low" if n <= 3 else "copy" if n <= 30 else "long" for n in range(-5, 60)}


def test_a_sample_dated_centuries_ahead(spark):
    ts = lambda text: F.to_timestamp(F.lit(text))
    laps = spark.createDataFrame([(1, 1, 1), (1, 1, 2)], "session_key long, driver_number int, lap_number int").withColumn(
        "date_start", F.when(F.col("lap_number") == 1, ts("2023-01-01 10:00:00")).otherwise(ts("2023-01-01 10:30:00")))
    samples = spark.createDataFrame([(1, 1, "2023-01-01 09:59:59"), (1, 1, "2023-01-01 10:00:00"), (1, 1, "2023-01-01 10:29:59"), (1, 1, "2223-01-01 00:00:00"), (1, 2, "2023-01-01 10:00:00")],
                                    "session_key long, driver_number int, date string").withColumns(
        {"date": F.to_timestamp("date"), "speed": F.lit(100), "throttle": F.lit(1), "brake": F.lit(0)})
    got = reports.telemetry_by_lap({"car_data": samples, "laps": laps})
    assert rows(got, "driver_number", "lap_number") == sorted([(1, None), (1, 1), (1, 2), (2, None)], key=repr)


def test_deviation_of_equal_and_of_large_times(spark):
    values = [83.123] * 199
    near = [5400.0 + (k % 7) / 1000 for k in range(300)]
    for times in (values, near):
        df = spark.createDataFrame([(k % 9, t) for k, t in enumerate(times)], "part int, lap_time double").withColumn("lap_number", F.lit(1))
        per = df.groupBy("part").agg(*reports._lap_totals()).agg(F.collect_list("moments").alias("m")).select(reports._stddev(F.col("m")).alias("s"))
        want = df.agg(F.stddev_samp("lap_time")).first()[0]
        assert per.first().s == pytest.approx(want, rel=1e-9, abs=1e-12)


def test_landed_season_without_an_end_and_endpoint_without_rows(spark):
    root = work_dir(spark, "landed")
    laps = spark.createDataFrame([(1, 4, 1, y) for y in (2019, 2020, 2042)], "session_key long, driver_number int, lap_number int, year int")
    writers.land(laps, root, "laps", F.current_timestamp())
    assert rows(readers.scan_raw(spark, root, "laps", min_year=2020), "extraction_year") == [(2020,), (2042,)]
    empty = readers.scan_raw(spark, root, "race_control", flag="RED")
    assert empty.count() == 0 and "message" in empty.columns
    done = jobs.raw_job(spark, root, work_dir(spark, "processed"), ["laps", "sessions"], fmt="parquet")
    assert rows(done, "endpoint", "year", "records_processed", "status") == [("laps", y, 1, "SUCCESS") for y in (2019, 2020, 2042)]  # no row for sessions

"""Projection, validation, de-duplication, sampling and quality measures."""

import datetime as dt

import pytest
from racing import rows
from pyspark.sql import functions as F

from pitwall import catalog
from pitwall.functions import scalars
from pitwall.operators import clean, quality


def test_bad_text_becomes_null_and_keys_are_required(spark):
    raw = spark.createDataFrame(
        [("9165", "1", "1", "2023-09-17T13:00:30+00:00", "91.5", "true"), ("9165", "44", "x", "2023-09-17", "1", "no"),
         ("9165", "44", "2", "soon", "1:32.4", "perhaps"), (None, "44", "3", None, None, None)],
        "session_key string, driver_number string, lap_number string, date_start string, lap_duration string, fresh_tyre string")
    got = clean.process(raw, "laps", F.lit("2024-01-01").cast("timestamp"))
    assert rows(got, "session_key", "driver_number", "lap_number", "date_start", "lap_duration", "fresh_tyre", "compound") == [
        (9165, 1, 1, dt.date(2023, 9, 17), 91.5, True, None), (9165, 44, 2, None, None, None, None)]
    assert got.columns[-1] == "processing_timestamp"
    assert [f.dataType.simpleString() for f in got.schema] == [*clean.PROCESSED["laps"][0].values(), "timestamp"]


def test_positions_keep_their_time_of_day(spark):
    raw = spark.createDataFrame([("2023-09-17T15:00:30+02:00", "1", "2", "3")], "date string, session_key string, driver_number string, position string")
    assert clean.process(raw, "position").first()["date"] == dt.datetime(2023, 9, 17, 13, 0, 30)


def test_unknown_endpoint(spark):
    with pytest.raises(ValueError, match="weather"):
        clean.process(spark.range(1), "weather")


GOOD = {"session_key": 1, "driver_number": 1, "lap_number": 1, "date_start": dt.date(2023, 1, 1), "lap_time": 90.0, "lap_duration": 90.0,
        "i1_speed": 280.0, "i2_speed": 290.0, "st_speed": 300.0, "tyre_life": 3, "compound": "SOFT"}
LAP_SCHEMA = ("session_key long, driver_number int, lap_number int, date_start date, lap_time double, lap_duration double, "
              "i1_speed double, i2_speed double, st_speed double, tyre_life int, compound string")


@pytest.mark.parametrize(("change", "valid", "score"), [
    ({}, True, 1.0), ({"lap_number": 0}, False, None), ({"lap_number": 199}, True, 1.0), ({"lap_number": 200}, False, None),
    ({"driver_number": 0}, False, None), ({"driver_number": 99}, True, 1.0), ({"driver_number": 100}, False, None),
    ({"lap_time": None}, True, 0.7), ({"lap_time": 0.0}, False, None), ({"lap_duration": -1.0}, False, None), ({"lap_duration": None}, True, 1.0),
    ({"i1_speed": None, "i2_speed": None}, True, 0.6), ({"st_speed": 0.0}, False, None), ({"tyre_life": 0}, True, 1.0), ({"tyre_life": -1}, False, None),
    ({"compound": None}, True, 0.9), ({"date_start": None}, False, None), ({"session_key": None}, False, None), ({"lap_number": None}, False, None),
])
def test_lap_rules(spark, change, valid, score):
    df = spark.createDataFrame([tuple({**GOOD, **change}.values())], LAP_SCHEMA)
    got = [round(r["data_completeness_score"], 6) for r in clean.valid_laps(df).collect()]
    assert got == ([score] if valid else [])
    ok, bad = clean.split_valid(df, clean.lap_rules())
    assert (ok.count(), bad.count()) == (int(valid), int(not valid))


def test_meeting_rules(spark):
    data = [(1, 2018, "A", "Official", "L"), (2, 2030, "B", None, "L"), (3, 2023, "C", None, None), (4, 2017, "D", None, None), (5, 2031, "E", None, None),
            (None, 2023, "F", None, None), (6, None, "G", None, None), (7, 2023, None, None, None)]
    df = spark.createDataFrame(data, "meeting_key long, year int, meeting_name string, meeting_official_name string, location string")
    assert rows(clean.valid_meetings(df), "meeting_key", "data_quality_score") == [(1, 1.0), (2, 0.8), (3, 0.6)]


def test_sample_is_repeatable_and_whole_below_the_limit(spark):
    df = spark.range(500).selectExpr("CASE WHEN id < 30 THEN 1 ELSE 2 END AS g", "id")
    one, two = (rows(clean.sample_per_group(df.repartition(n), ["g"], ["id"], 100, 7)) for n in (3, 5))
    assert one == two
    assert [sum(1 for g, _ in one if g == k) for k in (1, 2)] == [30, 100]
    assert rows(clean.sample_per_group(df, ["g"], ["id"], 100, 8)) != one


def test_union_fills_missing_columns(spark):
    a, b = spark.createDataFrame([(1, "x")], "a int, b string"), spark.createDataFrame([("y", 2.0)], "b string, c double")
    assert rows(clean.union_all(a, b)) == sorted([(1, "x", None), (None, "y", 2.0)], key=repr)


def test_scalars(spark):
    df = spark.createDataFrame([(1, "Qualifying", None, 0), (None, "race", "RED FLAG", 4)], "a int, s string, f string, n int")
    got = df.select(
        scalars.surrogate_id("a", "s").alias("id"), scalars.contains_any_case("s", "RACE").alias("race"), scalars.contains_text("f", "RED").alias("red"),
        scalars.pct(F.lit(1), "n").alias("pct"), scalars.ratio(F.lit(1), "n").alias("ratio"), scalars.flag_above("a", 0).alias("above"),
        scalars.missing_names(["a", "f"]).alias("missing"))
    assert rows(got) == sorted([("1_Qualifying", False, False, 0.0, None, True, ["f"]), (None, True, True, 25.0, 0.25, False, ["a"])], key=repr)


def test_null_counts_and_completeness(spark):
    df = spark.createDataFrame([(1, None, None), (2, "x", None)], "a int, b string, c double")
    assert rows(quality.null_counts(df)) == [(2, {"a": 0, "b": 1, "c": 2})]
    assert rows(quality.completeness(df)) == [(2, 0.5)]
    assert rows(quality.completeness(df.where("a > 9"))) == [(0, None)]


def test_duplicates(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 1), (None, 1)], "a int, b int")
    assert rows(quality.duplicates(df, ["a", "b"])) == [(2,)]
    assert rows(quality.duplicates(df.where("false"), ["a"])) == [(0,)]


def test_violations_name_each_missing_field(spark):
    columns = catalog.TABLES["raw_pit"].schema
    df = spark.createDataFrame([], columns).select(*[c for c in columns.names if c != "_endpoint"])
    one = spark.range(1).selectExpr("1L AS session_key", "1L AS meeting_key", "CAST(NULL AS int) AS driver_number", "current_timestamp() AS date",
                                    "3 AS lap_number", "CAST(NULL AS double) AS pit_duration", "2023 AS year", "current_timestamp() AS _extracted_at")
    got = quality.violations(df.unionByName(one), "raw_pit").first()["errors"]
    assert got == ["Required field driver_number is missing or null", "Required field pit_duration is missing or null",
                   "Required field _endpoint is missing or null"]
    with pytest.raises(KeyError, match="not defined"):
        quality.violations(one, "raw_tyres")


def test_columns_with_default_are_not_required():
    table = catalog.TABLES["grand_prix_results"]
    assert "points" not in table.required and "date" in table.required and table.defaults["points"] == "0"


def test_outliers_and_freshness(spark):
    df = spark.range(100).selectExpr("id % 2 AS g", "CASE WHEN id = 98 THEN 1000.0D ELSE 10.0D + id % 5 END AS v", "timestamp'2023-01-01 00:00:00' + make_interval(0,0,0,0,0,0,id) AS t")
    assert rows(quality.outliers(df, "v"), "v") == [(1000.0,)]
    assert rows(quality.outliers(df, "v", ["g"]), "g", "v") == [(0, 1000.0)]
    assert rows(quality.outliers(df.limit(1), "v")) == []
    got = quality.freshness(df, "t", F.lit("2023-01-01 02:01:39").cast("timestamp")).first()
    assert got["data_freshness_hours"] == 2.0


def test_metrics_row(spark):
    df = spark.createDataFrame([(1, 1, 22.0), (1, 1, 22.0), (2, None, None)], "session_key int, driver_number int, pit_duration double")
    as_of = F.lit("2024-01-01").cast("timestamp")
    got = quality.metrics(df, "raw_pit", as_of, keys=["session_key", "driver_number"]).first()
    assert (got["total_records"], got["duplicate_records"], got["constraint_violations"], got["outlier_count"]) == (3, 1, 3, 0)
    assert got["null_counts"] == {"session_key": 0, "driver_number": 1, "pit_duration": 1}
    assert round(got["completeness_score"], 6) == 0.777778
    assert set(catalog.TABLES["data_quality_metrics"].schema.names) == set(got.asDict())


def test_validation_report(spark):
    data = [(1, 1, 5), (1, 1, -5), (1, 2, -1), (1, 3, None)]
    df = spark.createDataFrame(data, "a int, b int, v int")
    assert rows(quality.validation_report(df, ["a", "b"], F.col("v") > 0)) == [(4, 1, 3)]


def test_same_rows_counts_copies(spark):
    a, b = spark.createDataFrame([(1,), (1,), (2,)], "a int"), spark.createDataFrame([(1,), (2,), (3,)], "a int")
    assert rows(quality.same_rows(a, b)) == [(1, 1)]
    assert rows(quality.same_rows(a, a)) == [(0, 0)]


def test_lineage_covers_every_table(spark):
    got = {r["table_name"]: r for r in quality.lineage(spark).collect()}
    assert set(got) == set(catalog.TABLES)
    assert got["driver_championship_standings"]["upstream_dependencies"] == ["grand_prix_results"]
    assert "grand_prix_results" in got["raw_laps"]["downstream_dependencies"]
    assert got["raw_laps"]["field_types"]["lap_duration"] == "double"


def test_layers():
    assert len(catalog.get_schema_by_layer("raw")) == 16
    with pytest.raises(ValueError, match="unknown layer"):
        catalog.get_schema_by_layer("gold")
    with pytest.raises(ValueError, match="unknown column type"):
        catalog.column_type("BLOB")
    assert [f.nullable for f in catalog.struct_of({"a": "INTEGER PRIMARY KEY", "b": "REAL"})] == [False, True]

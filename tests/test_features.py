"""Performance and feature plans on hand-made rows."""

import pytest
from pyspark.sql import functions as F
from racing import Small, lap, rows, season

from pitwall.operators import windows
from pitwall.plans import features, performance, reports, results

AT = "2023-03-05 13:00:0"


def test_lap_performance_leaves_out_pit_and_untimed_laps(spark):
    t = Small(spark, laps=[lap(1, 1, 1, None, 90.0), lap(1, 1, 2, None, 80.0, out=True), lap(1, 1, 3, None, None),
                           lap(1, 1, 4, None, 92.0), lap(1, 2, 1, None, 95.0, out=None)])
    # An unknown pit flag is no "no".
    assert rows(performance.lap_perf(t["laps"])) == [(1, 1, 90.0, 91.0)]


def test_telemetry_share_is_over_samples_with_speed(spark):
    t = Small(spark, car_data=[(1, 1, AT + "1", 100, 50, 100), (1, 1, AT + "2", 200, 60, None), (1, 1, AT + "3", None, 99, 100),
                               (1, 1, AT + "4", 300, None, 0), (1, 2, AT + "1", None, 1, 1)])
    assert rows(performance.telemetry(t["car_data"]).withColumn("b", F.round("time_spent_braking_pct", 4)),
                "driver_number", "avg_speed", "max_speed", "avg_throttle", "b") == [(1, 200.0, 300, 55.0, 33.3333)]


def test_tires_in_order_of_first_use(spark):
    t = Small(spark, stints=[(1, 1, 3, 31, 40, "SOFT", 0), (1, 1, 1, 1, 15, "SOFT", 2), (1, 1, 2, 16, 30, "HARD", 0)])
    assert rows(performance.tires(t["stints"])) == [(1, 1, ["SOFT", "HARD"], 3)]


def test_performance_has_a_row_for_every_entry(spark):
    t = season(spark, pit=[(11, 1, 1, AT + "1", 22.5), (11, 1, 2, AT + "2", 2.5)])
    got = performance.gp_performance(t)
    assert got.count() == 11
    assert rows(got.where("session_key = 11"), "driver_number", "best_lap_time", "total_pit_time", "pit_stops", "tire_compounds_used") == [
        (1, 91.5, 25.0, 2, []), (2, 92.4, 0.0, 0, []), (3, None, 0.0, 0, [])]


def test_two_spellings_give_two_rows(spark):
    t = season(spark, drivers=[(11, 1, "Max V", "MV", "Red"), (11, 1, "Max v", "MV", "Red"), (11, 1, "Max V", "MV", "Red")])
    assert performance.gp_performance(t).count() == 2


def pace(spark, cars):
    return spark.createDataFrame(cars, "s int, team string, d int, best double")


def test_pace_deltas(spark):
    df = pace(spark, [(1, "A", 1, 90.0), (1, "A", 2, 91.0), (1, "A", 3, 95.0), (1, "B", 4, 100.0), (1, "C", 5, None), (1, "C", 6, 80.0)])
    mate = dict(rows(windows.leave_one_out(df, ["s", "team"], "best", "x"), "d", "x"))
    assert mate == {1: -3.0, 2: -1.5, 3: 4.5, 4: None, 5: None, 6: None}
    field = dict(rows(windows.field_delta(df, ["s"], "best", "x"), "d", "x"))
    assert field[4] == pytest.approx(100 - (90 + 91 + 95 + 100 + 80) / 5) and field[5] is None
    assert rows(windows.at_least(df, ["s", "team"], 2), "d") == [(1,), (2,), (3,), (5,), (6,)]


def test_groups_of_null_keys_stay(spark):
    df = pace(spark, [(1, None, 1, 90.0), (1, None, 2, 92.0)])
    assert rows(windows.leave_one_out(df, ["s", "team"], "best", "x"), "d", "x") == [(1, -2.0), (2, 2.0)]


@pytest.mark.parametrize("block", [None, "day"])
def test_running_total_does_not_merge_ties(spark, block):
    data = [("a", 1, 1, 5), ("a", 1, 1, 7), ("a", 2, 3, 1), ("a", 2, 4, None), ("b", 1, 1, 2)]
    df = spark.createDataFrame(data, "k string, day int, t int, v int")
    got = rows(windows.running_total(df, ["k"], ["day", "t", "v"], "v", block=block), "k", "day", "t", "v", "running_total")
    assert got == sorted([("a", 1, 1, 5, 5), ("a", 1, 1, 7, 12), ("a", 2, 3, 1, 13), ("a", 2, 4, None, 13), ("b", 1, 1, 2, 2)], key=repr)


def test_running_total_blocks_equal_plain(spark):
    df = spark.range(500).selectExpr("id % 3 AS k", "id div 40 AS block", "id AS t", "id * 7 % 11 AS v")
    plain = windows.running_total(df, ["k"], ["t"], "v")
    blocked = windows.running_total(df, ["k"], ["t"], "v", block="block").select(plain.columns)
    assert plain.exceptAll(blocked).isEmpty() and blocked.exceptAll(plain).isEmpty()


def test_driver_features(spark):
    t = season(spark, weather=[(11, AT + "1", 20.0, 30.0, 0), (11, AT + "2", 22.0, 32.0, 1)])
    got = features.driver_features(t, performance.gp_performance(t), results.gp_results(t))
    # Driver 3 is alone in the team: no row, but in the field mean. Practice has no result.
    race = rows(got.where("race_round = 1 AND session_type = 'Race'"), "driver_number", "pace_vs_teammate", "track_position_start", "track_position_avg", "air_temperature")
    assert [(r[0], round(r[1], 6), *r[2:]) for r in race] == [(1, -0.9, 2, 1.0, 21.0), (2, 0.9, 1, 2.0, 21.0)]
    assert rows(got.where("session_type = 'Practice 1'"), "feature_id", "track_position_avg") == [
        ("2023_1_Practice 1_1", None), ("2023_1_Practice 1_2", None)]
    assert got.groupBy("feature_id").count().where("count > 1").isEmpty()


def test_meeting_without_a_race_has_round_zero(spark):
    t = Small(spark, meetings=[(1, "Test days", "X", "Y", "2023-02-01", 2023)], sessions=[(5, 1, "Day 1", "Practice", "2023-02-01", None, 2023)],
              drivers=[(5, d, f"D{d}", f"D{d}", "T") for d in (1, 2)])
    got = features.driver_features(t, performance.gp_performance(t), results.race_results(t))
    assert rows(got, "feature_id", "race_round") == [("2023_0_Day 1_1", 0), ("2023_0_Day 1_2", 0)]


def test_weather_features(spark):
    t = Small(spark, weather=[(1, AT + "1", 20.0, 30.0, 1), (2, AT + "1", 10.0, 1.0, None), (2, AT + "2", 20.0, 1.0, 2),
                              (3, AT + "1", 19.0, 1.0, 0), (3, AT + "2", 21.0, 1.0, 0)])
    assert rows(features.weather_features(t["weather"])) == [(1, False, 1.0), (2, True, 0.5), (3, False, 0.0)]


def test_race_events_by_message_and_by_pair(spark):
    rc = season(spark)["race_control"]
    assert rows(features.race_events(rc)) == [(11, 2, 1)]
    assert rows(features.race_events(rc, literal=True)) == [(11, 1, 1)]


def test_race_context(spark):
    got = {r["race_round"]: r for r in features.race_context(season(spark)).collect()}
    assert len(got) == 3
    assert (got[1]["circuit_length"], got[1]["number_of_turns"], got[1]["safety_car_deployments"]) == (5.793, 11, 2)
    assert got[2]["circuit_length"] is None and got[2]["total_race_time"] is None and got[2]["weather_changes"] is False
    assert got[1]["total_race_time"] == 92.4  # driver 2 finished with one timed lap
    assert got[3]["total_race_time"] == 71.0 and got[3]["rain_probability"] is None


def test_car_behind(spark):
    t = season(spark, position=[(11, 1, "2023-03-05 13:00:20", 2), (11, 1, "2023-03-05 13:00:35", 1), (11, 2, "2023-03-05 13:00:40", 2),
                                (11, 1, "2023-03-05 13:03:00", 1), (12, 1, "2023-03-05 13:00:30", 9)],
               stints=[(11, 1, 1, 1, 10, "SOFT", 3)])
    got = rows(features.car_behind(t), "driver_number", "lap_number", "position", "tire_age", "has_car_behind", "car_behind_driver", "car_ahead_driver")
    assert got == [(1, 1, 1, 3, True, 2, None), (2, 1, 2, None, False, None, 1)]
    gap = features.car_behind(t).where("driver_number = 1").first()["gap_to_behind"]
    assert gap == pytest.approx(0.9)
    assert features.car_behind(t, literal=True).count() == 3
    assert features.analysis(t, "something else").count() == 0


def test_speed_ranks_and_consistency(spark):
    t = Small(spark, laps=[lap(1, 1, 1, None, 90.0, st=320), lap(1, 1, 2, None, 92.0, st=300), lap(1, 2, 1, None, 91.0, i1=300, st=310),
                           lap(1, 3, 1, None, 91.0, i1=None, st=None)])
    assert rows(features.speed_ranks(t["laps"])) == [(1, 1, 1, 2), (1, 2, 2, 1), (1, 3, 3, 3)]
    assert rows(features.consistency(t["laps"]).withColumn("c", F.round("consistency_score", 6)), "driver_number", "c") == [
        (1, 1.414214), (2, None), (3, None)]


def test_telemetry_by_lap(spark):
    t = Small(spark, laps=[lap(1, 1, 1, "2023-03-05 13:00:00", 100.0), lap(1, 1, 2, "2023-03-05 13:01:40", 100.0)],
              car_data=[(1, 1, "2023-03-05 12:59:59", 80, 1, 0), (1, 1, "2023-03-05 13:00:00", 100, 1, 0), (1, 1, "2023-03-05 13:01:30", 200, 1, 1),
                        (1, 1, "2023-03-05 13:07:00", 300, 1, 1)])
    assert rows(reports.telemetry_by_lap(t), "lap_number", "avg_speed", "max_speed") == sorted([(None, 80.0, 80), (1, 150.0, 200), (2, 300.0, 300)], key=repr)


def test_championship_takes_the_last_known_position(spark):
    t = season(spark, position=[(11, 1, "2023-03-05 13:10:00", 3), (11, 1, "2023-03-05 14:50:00", 1), (11, 2, "2023-03-05 14:00:00", 2)])
    assert rows(reports.championship(t), "driver_name", "championship_points", "championship_position") == [("Driver 1", 25, 1), ("Driver 2", 18, 2)]
    assert rows(reports.championship(t, literal=True), "driver_name", "championship_points") == [("Driver 1", 40), ("Driver 2", 18)]


def test_session_stats_single_lap_has_no_deviation(spark):
    got = reports.session_stats(season(spark)).where("meeting_name = 'Gamma GP'").collect()
    assert [(r["total_laps_recorded"], r["participating_drivers"], r["participating_teams"], round(r["lap_time_variation"], 6)) for r in got] == [(2, 2, 2, 0.707107)]
    alpha = season(spark, laps=[lap(11, 1, 1, None, 91.5)])
    assert reports.session_stats(alpha).first()["lap_time_variation"] is None


def test_consistency_needs_ten_laps_and_rounds(spark):
    laps = [lap(11, 1, i, None, 90.0 + i) for i in range(1, 11)] + [lap(11, 2, i, None, 90.0) for i in range(1, 10)]
    got = rows(reports.driver_consistency(season(spark, laps=laps)), "driver_name", "total_laps", "avg_lap_time", "consistency_score", "median_lap_time", "coefficient_of_variation")
    assert got == [("Driver 1", 10, 95.5, 3.028, 95.5, 3.17)]

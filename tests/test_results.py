"""Points, race results and standings on a hand-made season."""

import pytest
from pyspark.sql import functions as F
from racing import Small, rows, season

from pitwall.functions.scalars import points
from pitwall.plans import results
from pitwall.plans.reports import constructor_standings


def test_points_table(spark):
    df = spark.createDataFrame([(1, True), (1, False), (10, True), (11, True), (None, True), (0, False), (2, None)], "p int, f boolean")
    got = [tuple(r) for r in df.select("p", "f", points("p", "f"), points("p")).collect()]
    assert got == [(1, True, 26, 25), (1, False, 25, 25), (10, True, 2, 1), (11, True, 0, 0), (None, True, 0, 0), (0, False, 0, 0), (2, None, 18, 18)]


def test_results_join_and_bonus(spark):
    got = rows(results.gp_results(season(spark)), "race_round", "driver_number", "starting_grid_position", "fastest_lap", "points", "total_time_penalty")
    assert got == sorted([
        (1, 1, 2, 90.0, 26, 15),       # pole listed, quickest lap, two penalties
        (1, 2, 1, 92.4, 18, 0),        # listed twice on the grid: the front slot
        (1, 3, None, None, 15, 0),     # no grid slot, no laps; driver 9 has no entry and is dropped
        (2, 1, None, None, 18, 0), (2, 2, None, None, 25, 0),
        (3, 1, None, 70.0, 0, 0),      # quickest, but outside the top 10
        (3, 2, None, None, 0, 0), (3, 3, None, 71.0, 25, 0),
    ], key=repr)


def test_literal_bonus_goes_to_everyone_timed(spark):
    got = dict(rows(results.race_results(season(spark), literal=True).where("race_round = 1"), "driver_number", "points"))
    assert got == {1: 26, 2: 19, 3: 15}


def test_season_context_ranks_those_who_raced_that_date(spark):
    got = rows(results.gp_results(season(spark)).where("year = 2023 AND race_round = 3"), "driver_number",
               "total_season_points", "drivers_championship_ranking", "points_from_first")
    assert got == [(1, 44, 1, 0), (2, 43, 2, 1), (3, 40, 3, 4)]


def test_flags_default_to_no(spark):
    assert rows(results.gp_results(season(spark)).where("dns IS NULL OR dnf IS NULL OR dsq IS NULL")) == []


def standing(spark, t=None):
    return results.standings(results.race_results(t or season(spark)))


def test_standings_carry_absent_drivers(spark):
    got = rows(standing(spark).where("race_round = 2"), "driver_number", "position", "points", "points_behind_leader", "points_ahead_next")
    assert got == [(1, 1, 44, 0, 1), (2, 2, 43, 1, 28), (3, 3, 15, 29, 0)]


def test_wins_count_by_date_not_round(spark):
    # Races 1 and 2 share a date: after race 1 driver 2 already counts the win of race 2.
    got = dict(rows(standing(spark).where("race_round = 1"), "driver_number", "wins"))
    assert got == {1: 1, 2: 1, 3: 0}


def test_team_is_that_of_the_first_race(spark):
    assert rows(standing(spark).where("driver_number = 3").select("team_name").distinct()) == [("Blue",)]


def test_ties_keep_first_appearance(spark):
    schema = "year int, date string, grand_prix string, driver_number int, driver_name string, team_name string, final_position int, points int"
    data = [(2023, "2023-01-01", "A", 7, "S", "x", 1, 25), (2023, "2023-01-01", "A", 5, "F", "y", 2, 18),
            (2023, "2023-01-08", "B", 5, "F", "y", 1, 25), (2023, "2023-01-08", "B", 7, "S", "x", 2, 18),
            (2023, "2023-01-08", "B", 4, "T", "z", 3, 43)]
    df = spark.createDataFrame(data, schema).withColumn("date", F.to_timestamp("date"))
    got = rows(results.standings(df).where("race_round = 2"), "position", "driver_number", "points")
    assert got == [(1, 7, 43), (2, 5, 43), (3, 4, 43)]


def test_positions_and_points_are_consistent(spark):
    table = standing(spark)
    per = table.groupBy("race_round").agg(F.collect_set("position").alias("p"), F.count(F.lit(1)).alias("n")).collect()
    assert all(sorted(r["p"]) == list(range(1, r["n"] + 1)) for r in per)
    total = results.race_results(season(spark)).agg(F.sum("points")).first()[0]
    assert table.where("race_round = 3").agg(F.sum("points")).first()[0] == total


def test_constructors(spark):
    got = rows(constructor_standings(results.race_results(season(spark))).where("race_round = 3"), "team_name", "position", "points")
    assert got == [("Blue", 3, 15), ("Green", 2, 25), ("Red", 1, 87)]


def test_sprint_and_race_of_one_meeting(spark):
    """Two race sessions of one meeting are two rounds, of results and of standings."""
    t = season(
        spark, sessions=[(11, 1, "Race", "Race", "2023-03-05 13:00:00", None, 2023), (10, 1, "Sprint", "Race", "2023-03-04 13:00:00", None, 2023)],
        session_result=[(11, 1, 1, False, False, False), (10, 1, 2, False, False, False)],
        drivers=[(s, 1, "Driver 1", "D1", "Red") for s in (10, 11)])
    got = results.race_results(t)
    assert rows(got, "race_round", "points") == [(1, 18), (2, 26)]
    assert rows(results.standings(got), "race_round", "points", "wins", "podiums") == [(1, 18, 1, 2), (2, 44, 1, 2)]
    assert rows(results.season_context(got), "race_round", "drivers_championship_ranking") == [(1, 1), (2, 1)]


def test_penalty_text_only(spark):
    t = Small(spark, race_control=[(1, None, 4, "Other", None, "NOTED"), (1, None, None, "Other", None, "5 SECOND TIME PENALTY"),
                                   (1, None, 4, "Other", None, "FIVE SECOND TIME PENALTY")])
    assert rows(results.penalties(t["race_control"])) == []


@pytest.mark.parametrize("table", ["laps", "starting_grid", "race_control"])
def test_results_without_optional_tables(spark, table):
    assert results.gp_results(season(spark, **{table: []})).count() == 8


def test_empty_season(spark):
    t = Small(spark)
    assert results.gp_results(t).count() == 0
    assert results.standings(results.race_results(t)).count() == 0

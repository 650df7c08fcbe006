"""Race results, points and championship standings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from pitwall.functions.scalars import points, surrogate_id
from pitwall.operators.joins import first_match
from pitwall.operators.windows import running_total
from pitwall.plans.sessions import race_rounds, sessions_with_meeting

DRIVER = ["session_key", "driver_number"]


def fastest_laps(laps: DataFrame) -> DataFrame:
    """Best timed lap of each driver in a session."""
    return laps.where(F.col("lap_duration").isNotNull()).groupBy(*DRIVER).agg(F.min("lap_duration").alias("fastest_lap"))


def penalties(race_control: DataFrame) -> DataFrame:
    """Penalty seconds of each driver in a session, read from race-control messages."""
    seconds = F.regexp_extract("message", r"(\d+) SECOND TIME PENALTY", 1)
    found = race_control.where(F.col("message").contains(" SECOND TIME PENALTY") & F.col("driver_number").isNotNull())
    return (
        found.select(*DRIVER, seconds.try_cast("int").alias("s")).where("s IS NOT NULL")
        .groupBy(*DRIVER).agg(F.sum("s").alias("penalty_seconds"))
    )


def grid_positions(starting_grid: DataFrame) -> DataFrame:
    """A driver's grid slot; the front one if listed twice."""
    return starting_grid.groupBy(*DRIVER).agg(F.min("position").alias("starting_grid_position"))


def entrants(drivers: DataFrame) -> DataFrame:
    """One row per driver and session."""
    return first_match(
        drivers.select(*DRIVER, "full_name", "name_acronym", "team_name"), DRIVER,
        ["full_name", "name_acronym", "team_name"],
    )


def race_results(t: Mapping[str, DataFrame], literal: bool = False) -> DataFrame:
    """Race results with grid, best lap, penalty and points, before season totals.

    The bonus point goes to the driver of the session's best lap; the ``literal`` form
    gives it to everybody in the top 10 with a timed lap.
    """
    races = race_rounds(sessions_with_meeting(t)).select(
        "session_key", "year", "race_round", F.col("race_date").alias("date"),
        F.col("meeting_name").alias("grand_prix"), F.col("circuit_short_name").alias("circuit_name"),
    )
    laps = t["laps"].join(races.select("session_key"), "session_key", "left_semi")
    best = fastest_laps(laps)
    order = W.partitionBy("session_key").orderBy("fastest_lap", "driver_number")
    best = best.withColumn("_quickest", F.row_number().over(order) == 1)
    bonus = F.col("fastest_lap").isNotNull() if literal else F.coalesce("_quickest", F.lit(False))
    return (
        t["session_result"].select(*DRIVER, F.col("position").alias("final_position"), "dnf", "dns", "dsq")
        .join(races, "session_key")
        .join(entrants(t["drivers"]), DRIVER)
        .join(grid_positions(t["starting_grid"]), DRIVER, "left")
        .join(best, DRIVER, "left")
        .join(penalties(t["race_control"]), DRIVER, "left")
        .select(
            surrogate_id("year", "race_round", "driver_number").alias("result_id"),
            "session_key", "date", "year", "race_round", "grand_prix", "circuit_name", "driver_number",
            F.col("full_name").alias("driver_name"), F.col("name_acronym").alias("driver_acronym"), "team_name",
            "starting_grid_position", "final_position",
            points("final_position", bonus).alias("points"),
            "fastest_lap",
            F.coalesce("penalty_seconds", F.lit(0)).alias("total_time_penalty"),
            *[F.coalesce(c, F.lit(False)).alias(c) for c in ("dnf", "dns", "dsq")],
        )
    )


def season_context(results: DataFrame, literal: bool = False) -> DataFrame:
    """Season points after each result, and rank and gap among the drivers of that race.

    A sprint weekend has two races on one date; ``literal`` ranks by date and so has its drivers
    twice in one ranking.
    """
    total = running_total(results, ["year", "driver_number"], ["date", "race_round"], "points", "total_season_points")
    day = W.partitionBy("year", "date" if literal else "race_round")
    return total.withColumns({
        "drivers_championship_ranking": F.row_number().over(day.orderBy(F.desc("total_season_points"), "driver_number")),
        "points_from_first": F.max("total_season_points").over(day) - F.col("total_season_points"),
    })


def gp_results(t: Mapping[str, DataFrame], literal: bool = False) -> DataFrame:
    """The race-results table, all seasons in one plan."""
    return season_context(race_results(t, literal), literal)


def standings(results: DataFrame, by: str = "driver_number", names: Sequence[str] = ("driver_name", "team_name")) -> DataFrame:
    """Championship table after every race, for everybody who has raced so far that season.

    Somebody absent from a race keeps their points and still has a row.  Level on points,
    who appeared first stays ahead: by first race, then by place in it.  Rounds are those of the
    results, if these have any, else races are numbered by date and name.  With
    ``by="team_name"`` the same gives the constructors' table.  The results are read
    several times: pass a saved or staged table.
    """
    season, race = ["year", by], ["year", "date", "grand_prix"]
    numbered = "race_round" in results.columns
    race += ["race_round"] * numbered
    per_race = results.groupBy(*race, by).agg(
        F.sum("points").alias("points"),
        F.min("final_position").alias("place"),
        F.count_if(F.col("final_position") == 1).alias("wins"),
        F.count_if(F.col("final_position") <= 3).alias("podiums"),
        F.count_if(F.col("points") > 0).alias("points_finishes"),
    )
    calendar = results.select(*race).distinct()
    if not numbered:
        calendar = calendar.withColumn("race_round", F.dense_rank().over(W.partitionBy("year").orderBy("date", "grand_prix")))
    raced = per_race if numbered else per_race.join(calendar, race)
    races = calendar.groupBy("year").agg(F.max("race_round").alias("last_round"))
    known = raced.groupBy(*season).agg(
        F.min("race_round").alias("first_round"), F.min_by("place", "race_round").alias("first_place")
    )
    spine = known.join(races, "year").select(
        *season, "first_round", "first_place", F.explode(F.sequence("first_round", "last_round")).alias("race_round")
    )
    counted = raced.select(*season, "race_round", "points", "wins", "podiums", "points_finishes")
    filled = spine.join(calendar, ["year", "race_round"]).join(counted, [*season, "race_round"], "left")

    so_far = W.partitionBy(*season).orderBy("race_round").rowsBetween(W.unboundedPreceding, W.currentRow)
    to_date = W.partitionBy(*season).orderBy("date").rangeBetween(W.unboundedPreceding, W.currentRow)
    table = filled.withColumns({
        "points": F.coalesce(F.sum("points").over(so_far), F.lit(0)),
        **{c: F.coalesce(F.sum(c).over(to_date), F.lit(0)) for c in ("wins", "podiums", "points_finishes")},
    })
    ranked = W.partitionBy("year", "race_round").orderBy(
        F.desc("points"), "first_round", F.asc_nulls_last("first_place"), by
    )
    table = table.withColumns({
        "position": F.row_number().over(ranked),
        "points_behind_leader": F.first("points").over(ranked) - F.col("points"),
        "points_ahead_next": F.coalesce(F.col("points") - F.lead("points").over(ranked), F.lit(0)),
    })
    names = [n for n in names if n != by]
    if names:
        first = F.min_by(F.struct(*names), F.struct("date", F.coalesce("final_position", F.lit(0)), "driver_number"))
        who = results.groupBy(*season).agg(first.alias("_who"))
        table = table.join(who, season).select("*", *[F.col("_who")[n].alias(n) for n in names])
    return table.select(
        surrogate_id("year", "race_round", by).alias("standing_id"), "year", "race_round",
        F.col("grand_prix").alias("after_race"), by, *names, "position", "points",
        "points_behind_leader", "points_ahead_next", "wins", "podiums", "points_finishes",
    )

"""Session performance of each driver: laps, pit stops, telemetry and tyres."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwall.functions.scalars import pct, surrogate_id
from pitwall.plans.results import DRIVER
from pitwall.plans.sessions import sessions_with_meeting


def lap_perf(laps: DataFrame) -> DataFrame:
    """Best and mean of timed laps that do not leave the pits."""
    timed = laps.where(F.col("lap_duration").isNotNull() & ~F.col("is_pit_out_lap"))
    return timed.groupBy(*DRIVER).agg(
        F.min("lap_duration").alias("best_lap_time"), F.avg("lap_duration").alias("average_lap_time")
    )


def pit_perf(pit: DataFrame) -> DataFrame:
    return pit.groupBy(*DRIVER).agg(
        F.coalesce(F.sum("pit_duration"), F.lit(0.0)).alias("total_pit_time"), F.count(F.lit(1)).alias("pit_stops")
    )


def telemetry_aggs() -> list:
    """Speed, throttle and braking share over samples that have a speed."""
    return [
        F.avg("speed").alias("avg_speed"), F.max("speed").alias("max_speed"), F.avg("throttle").alias("avg_throttle"),
        pct(F.count_if(F.col("brake") > 0), F.count(F.lit(1))).alias("time_spent_braking_pct"),
    ]


def telemetry(car_data: DataFrame, by: tuple[str, ...] = tuple(DRIVER)) -> DataFrame:
    return car_data.where(F.col("speed").isNotNull()).groupBy(*by).agg(*telemetry_aggs())


def tires(stints: DataFrame) -> DataFrame:
    """Distinct compounds in the order of first use, and the number of stints.

    Stints are first reduced to one row per compound, so the list built per driver never
    holds more than the compounds there are.
    """
    per = stints.groupBy(*DRIVER, "compound").agg(F.min("stint_number").alias("first"), F.count(F.lit(1)).alias("n"))
    ordered = F.sort_array(F.collect_list(F.struct("first", "compound")))
    return per.groupBy(*DRIVER).agg(
        F.transform(ordered, lambda x: x["compound"]).alias("tire_compounds_used"), F.sum("n").alias("tire_stint_count")
    )


def gp_performance(t: Mapping[str, DataFrame]) -> DataFrame:
    """The session-performance table, all seasons in one plan.

    Two spellings of a driver in one session give two rows, as the entry list holds them.
    """
    sessions = sessions_with_meeting(t).select(
        "session_key", "year", "session_name", "session_type", "date_start", "meeting_name"
    )
    entered = t["drivers"].select(*DRIVER, "full_name", "name_acronym", "team_name").distinct()
    return (
        entered.join(sessions, "session_key")
        .join(lap_perf(t["laps"]), DRIVER, "left")
        .join(pit_perf(t["pit"]), DRIVER, "left")
        .join(telemetry(t["car_data"]), DRIVER, "left")
        .join(tires(t["stints"]), DRIVER, "left")
        .select(
            surrogate_id("year", "session_key", "driver_number").alias("performance_id"),
            "session_key", F.col("date_start").alias("date"), "year", F.col("meeting_name").alias("grand_prix"),
            "session_name", "session_type", "driver_number", F.col("full_name").alias("driver_name"), "team_name",
            "best_lap_time", "average_lap_time",
            F.coalesce("total_pit_time", F.lit(0.0)).alias("total_pit_time"),
            F.coalesce("pit_stops", F.lit(0)).alias("pit_stops"),
            "avg_speed", "max_speed", "avg_throttle", "time_spent_braking_pct",
            F.coalesce("tire_compounds_used", F.array().cast("array<string>")).alias("tire_compounds_used"),
            F.coalesce("tire_stint_count", F.lit(0)).alias("tire_stint_count"),
        )
    )

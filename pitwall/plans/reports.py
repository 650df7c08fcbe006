"""Season, team, session and table reports.

Timed laps are the one large input.  Every report first aggregates them on their own keys,
which Spark does in each task before the shuffle, and joins drivers, sessions and meetings
to the small result.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from pitwall.functions.scalars import epoch_seconds, points, ratio
from pitwall.operators.joins import first_match, star
from pitwall.operators.quantiles import exact_quantiles
from pitwall.plans.performance import telemetry
from pitwall.plans.results import DRIVER, standings
from pitwall.plans.sessions import RACE
from pitwall.session import stage

TOP = 10
MIN_LAPS = 10


def valid_times(laps: DataFrame) -> DataFrame:
    return laps.where(F.col("lap_time").isNotNull() & (F.col("lap_time") > 0))


def _dims(t: Mapping[str, DataFrame], rows: DataFrame) -> DataFrame:
    return star(rows, t["drivers"], t["sessions"], t["meetings"])


def best_lap_per_driver(t: Mapping[str, DataFrame]) -> DataFrame:
    """Each driver's quickest race lap over all seasons, with where it was driven."""
    races = t["sessions"].where(F.col("session_type") == RACE).select("session_key")
    laps = valid_times(t["laps"]).join(races, "session_key", "left_semi")
    per_session = first_match(laps.select(*DRIVER, "lap_number", "lap_time"), DRIVER, ["lap_time", "lap_number"])
    return first_match(_dims(t, per_session), ["driver_number"], ["lap_time", "session_key", "lap_number"]).select(
        F.col("full_name").alias("driver_name"), "team_name", "lap_time", "meeting_name", "session_name", "lap_number"
    )


def fastest_drivers(t: Mapping[str, DataFrame], n: int = TOP) -> DataFrame:
    """The ``n`` quickest drivers by their best race lap."""
    return best_lap_per_driver(t).orderBy("lap_time", "driver_name").limit(n)


def championship(t: Mapping[str, DataFrame], literal: bool = False) -> DataFrame:
    """Season points by the last known position of each race; ``literal`` counts every sample."""
    races = t["sessions"].where(F.col("session_type") == RACE).select("session_key")
    samples = t["position"].join(races, "session_key", "left_semi")
    if literal:
        scored = samples.groupBy(*DRIVER).agg(F.sum(points("position")).alias("points"))
    else:
        last = F.max_by("position", F.struct("date", "position"))
        scored = samples.groupBy(*DRIVER).agg(points(last).cast("bigint").alias("points"))
    season = _dims(t, scored).groupBy("year", F.col("full_name").alias("driver_name"), "team_name").agg(
        F.sum("points").alias("championship_points"), F.count_distinct("meeting_name").alias("races_participated")
    )
    rank = F.rank().over(W.partitionBy("year").orderBy(F.desc("championship_points")))
    return season.withColumn("championship_position", rank).orderBy(F.desc("year"), F.desc("championship_points"))


def _lap_totals() -> list[Column]:
    lap = F.col("lap_time").cast("double")
    return [
        F.count("lap_number").alias("n_laps"), F.count(lap).alias("n"), F.sum(lap).alias("s"),
        F.min(lap).alias("lo"), F.max(lap).alias("hi"),
        F.struct(F.count(lap).alias("n"), F.avg(lap).alias("mean"), (F.var_pop(lap) * F.count(lap)).alias("m2")).alias("moments"),
    ]


def _stddev(moments: Column) -> Column:
    """Sample deviation from (n, mean, m2) of parts; null for a single value.

    Parts are merged one after the other: squared distances within both, and that of their means, so nothing cancels.
    """

    def merged(a: Column, x: Column) -> Column:
        n, apart = a["n"] + x["n"], x["mean"] - a["mean"]
        return F.struct(n.alias("n"), (a["mean"] + apart * x["n"] / n).alias("mean"), (a["m2"] + x["m2"] + apart * apart * a["n"] * x["n"] / n).alias("m2"))

    none = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))
    whole = F.aggregate(F.filter(moments, lambda x: x["n"] > 0), none, merged)
    return F.sqrt(whole["m2"] / F.nullif(whole["n"] - 1, F.lit(0).cast("long")))


def team_performance(t: Mapping[str, DataFrame]) -> DataFrame:
    """Season pace of each team over its sessions, ranked."""
    per_driver = valid_times(t["laps"]).groupBy(*DRIVER).agg(*_lap_totals())
    session = _dims(t, per_driver).groupBy("team_name", "year", "meeting_name", "session_name").agg(
        F.count_distinct("driver_number").alias("drivers_count"), ratio(F.sum("s"), F.sum("n")).alias("avg_lap_time"),
        F.min("lo").alias("fastest_lap_time"), F.sum("n_laps").alias("total_laps"),
    )
    season = session.groupBy("team_name", "year").agg(
        F.count_distinct("meeting_name").alias("races_participated"),
        F.avg("drivers_count").alias("avg_drivers_per_race"),
        F.avg("avg_lap_time").alias("season_avg_lap_time"),
        F.min("fastest_lap_time").alias("season_fastest_lap"),
        F.sum("total_laps").alias("season_total_laps"),
    )
    rank = F.rank().over(W.partitionBy("year").orderBy("season_avg_lap_time"))
    return season.withColumn("performance_rank", rank).orderBy(F.desc("year"), "season_avg_lap_time")


def session_stats(t: Mapping[str, DataFrame]) -> DataFrame:
    """Laps, drivers, teams and lap-time spread of every session with a timed lap."""
    per_driver = valid_times(t["laps"]).groupBy(*DRIVER).agg(*_lap_totals())
    keys = ["meeting_name", "year", "country_name", "circuit_short_name", "session_name", "session_type"]
    n, s = F.sum("n"), F.sum("s")
    joined = star(per_driver, t["drivers"], t["sessions"], t["meetings"], how="left")
    return joined.groupBy(*keys, F.col("session_start").alias("date_start"), F.col("session_end").alias("date_end")).agg(
        F.count_distinct(F.when(F.col("full_name").isNotNull(), F.col("driver_number"))).alias("participating_drivers"),
        F.count_distinct("team_name").alias("participating_teams"),
        F.sum("n_laps").alias("total_laps_recorded"),
        (s / n).alias("average_lap_time"), F.min("lo").alias("fastest_lap_time"), F.max("hi").alias("slowest_lap_time"),
        F.collect_list("moments").alias("_moments"),  # one a driver of the session
    ).withColumn("lap_time_variation", _stddev(F.col("_moments"))).drop("_moments").orderBy(F.desc("year"), F.desc("date_start"))


def driver_consistency(t: Mapping[str, DataFrame], min_laps: int = MIN_LAPS, rounded: bool = True) -> DataFrame:
    """Lap-time spread of each driver by season and session type.

    Equal times are counted before the joins. The deviation is from squared distances to the group's mean, and the median is
    selected by rank (``exact_quantiles``), so a group's times never meet in one place.
    """
    times = valid_times(t["laps"]).groupBy(*DRIVER, F.col("lap_time").cast("double").alias("x")).agg(
        F.count(F.lit(1)).alias("n"), F.count("lap_number").alias("n_laps")
    )
    keys = ["driver_name", "team_name", "year", "session_type"]
    counted = stage(_dims(t, times).groupBy(F.col("full_name").alias("driver_name"), *keys[1:], "x").agg(
        F.sum("n").alias("n"), F.sum("n_laps").alias("n_laps")), "times")
    stats = stage(counted.groupBy(*keys).agg(
        F.sum("n_laps").alias("total_laps"), (F.sum(F.col("n") * F.col("x")) / F.sum("n")).alias("avg_lap_time"), F.sum("n").alias("_n"),
        F.min("x").alias("best_lap_time"), F.max("x").alias("worst_lap_time"),
    ).where(F.col("total_laps") >= min_laps), "consistency")
    renamed = stats.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("avg_lap_time").alias("_mean"), "_n")
    known = F.expr(" AND ".join(f"{k} <=> _{k}" for k in keys))
    kept = counted.join(renamed, known)
    apart = F.col("x") - F.col("_mean")
    spread = kept.groupBy(*[f"_{k}" for k in keys]).agg(F.sqrt(F.sum(F.col("n") * apart * apart) / F.nullif(F.first("_n") - 1, F.lit(0).cast("long"))).alias("consistency_score"))
    middle = exact_quantiles(kept.select(*keys, "x", "n"), keys, {"median_lap_time": 0.5})
    middle = middle.select(*[F.col(k).alias(f"_{k}") for k in keys], "median_lap_time")
    gone = [f"_{k}" for k in keys]
    stats = stats.drop("_n").join(spread, known).drop(*gone).join(middle, known).drop(*gone)
    stats = stats.withColumn("coefficient_of_variation", ratio("consistency_score", "avg_lap_time") * 100)
    if rounded:
        places = {"avg_lap_time": 3, "consistency_score": 3, "best_lap_time": 3, "worst_lap_time": 3,
                  "median_lap_time": 3, "coefficient_of_variation": 2}
        stats = stats.withColumns({c: F.round(c, p) for c, p in places.items()})
    return stats.orderBy(F.desc("year"), "session_type", "coefficient_of_variation")


def constructor_standings(results: DataFrame) -> DataFrame:
    """The championship table of teams after every race."""
    return standings(results, by="team_name", names=())


TELEMETRY_BLOCK = 600


def telemetry_by_lap(t: Mapping[str, DataFrame]) -> DataFrame:
    """Telemetry aggregates of each driver's laps.

    Samples carry no lap number: each belongs to the driver's latest lap started by then, of
    laps that start together to the one with the highest number; earlier samples belong to none.
    The latest start is carried along the time order within blocks of TELEMETRY_BLOCK seconds, and
    the state at the start of each block along the blocks that have any rows.  So a driver with
    very many samples is spread over many tasks, and no row depends on how far apart times are.
    """
    lap = F.struct("date_start", "lap_number")
    samples = t["car_data"].where(F.col("speed").isNotNull())
    starts = t["laps"].where(F.col("date_start").isNotNull()).select(*DRIVER, F.col("date_start").alias("date"), lap.alias("_lap"))
    for key in DRIVER:
        starts = starts.where(F.col(key).isNotNull())
    both = samples.withColumn("_sample", F.lit(1)).unionByName(starts.withColumn("_sample", F.lit(0)), allowMissingColumns=True)
    both = both.withColumn("_block", F.floor(epoch_seconds("date") / TELEMETRY_BLOCK))

    keys = [*DRIVER, "_block"]
    earlier = W.partitionBy(*DRIVER).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    blocks = both.groupBy(*keys).agg(F.max("_lap").alias("_last"))
    state = blocks.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.last("_last", ignorenulls=True).over(earlier).alias("_before"))
    so_far = W.partitionBy(*keys).orderBy("date", "_sample", "_lap.lap_number").rowsBetween(W.unboundedPreceding, W.currentRow)
    carried = both.withColumn("_now", F.last("_lap", ignorenulls=True).over(so_far)).where("_sample = 1")
    placed = carried.join(state, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])
    known = F.when(F.col("date").isNotNull(), F.coalesce("_now", "_before"))
    return telemetry(placed.withColumn("lap_number", known["lap_number"]), (*DRIVER, "lap_number"))


def meeting_stats(meetings: DataFrame) -> DataFrame:
    return meetings.groupBy("year").agg(
        F.count(F.lit(1)).alias("meeting_count"), F.count_distinct("country_name").alias("unique_countries"),
        F.count_distinct("circuit_short_name").alias("unique_circuits"),
    ).orderBy(F.desc("year"))


def lap_stats(laps: DataFrame, n: int = 10) -> DataFrame:
    """Laps, sessions, drivers and completeness of the latest ``n`` dates."""
    per = laps.groupBy("date_start", *DRIVER).agg(
        F.count(F.lit(1)).alias("n"), F.sum("data_completeness_score").alias("score"),
        F.count("data_completeness_score").alias("scored"), F.count("lap_time").alias("timed"),
    )
    return per.groupBy("date_start").agg(
        F.sum("n").alias("total_laps"), F.count_distinct("session_key").alias("unique_sessions"),
        F.count_distinct("driver_number").alias("unique_drivers"),
        ratio(F.sum("score"), F.sum("scored")).alias("avg_completeness_score"), F.sum("timed").alias("laps_with_times"),
    ).orderBy(F.desc("date_start")).limit(n)


def lap_totals(laps: DataFrame) -> DataFrame:
    """One row: laps, first and last date, number of dates."""
    per = laps.groupBy("date_start").agg(F.count(F.lit(1)).alias("n"))
    return per.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_laps"), F.min("date_start").alias("earliest_date"),
        F.max("date_start").alias("latest_date"), F.count("date_start").alias("total_dates"),
    )


def summary_report(t: Mapping[str, DataFrame], tables: tuple[str, ...]) -> DataFrame:
    """One row: the number of records of each table."""
    counts = [t[n].agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("name"), "n") for n in tables]
    union = counts[0]
    for c in counts[1:]:
        union = union.unionByName(c)
    return union.agg(*[F.max(F.when(F.col("name") == n, F.col("n"))).alias(f"{n}_count") for n in tables])

"""Machine-learning features: pace deltas, race context and the effect of the cars around."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from pitwall.functions.scalars import contains_text, flag_above, surrogate_id, tyre_age
from pitwall.operators.joins import first_match, interval_join, nearest_join, range_join
from pitwall.operators.windows import neighbours
from pitwall.plans.results import DRIVER
from pitwall.plans.sessions import RACE, meeting_rounds, race_rounds, sessions_with_meeting

# Length in km, turns and overtaking difficulty of the circuits known.
TRACKS = [
    ("Monaco", 3.337, 19, 0.9),
    ("Monza", 5.793, 11, 0.3),
    ("Silverstone", 5.891, 18, 0.5),
]
TEMPERATURE_VARIANCE = 5
POSITION_SECONDS = 30


def track_dim(spark: SparkSession) -> DataFrame:
    schema = T.StructType([
        T.StructField("circuit_short_name", T.StringType()), T.StructField("circuit_length", T.DoubleType()),
        T.StructField("number_of_turns", T.IntegerType()), T.StructField("overtaking_difficulty", T.DoubleType()),
    ])
    return spark.createDataFrame(TRACKS, schema)


def weather_context(weather: DataFrame) -> DataFrame:
    """Mean air and track temperature of a session."""
    return weather.groupBy("session_key").agg(
        F.avg("air_temperature").alias("air_temperature"), F.avg("track_temperature").alias("track_temperature")
    )


def weather_features(weather: DataFrame) -> DataFrame:
    """Whether the air temperature varied much, and the share of samples with rain."""
    return weather.groupBy("session_key").agg(
        flag_above(F.var_samp("air_temperature"), TEMPERATURE_VARIANCE).alias("weather_changes"),
        F.avg(flag_above("rainfall", 0).cast("int")).alias("rain_probability"),
    )


def race_events(race_control: DataFrame, literal: bool = False) -> DataFrame:
    """Safety-car and red-flag messages of a session; ``literal`` counts distinct (category, flag) pairs."""
    safety, red = contains_text("category", "Safety"), contains_text("flag", "RED")
    if literal:
        race_control = race_control.select("session_key", "category", "flag").distinct()
    return race_control.where(safety | red).groupBy("session_key").agg(
        F.count_if(safety).alias("safety_car_deployments"), F.count_if(red).alias("red_flag_periods")
    )


def total_race_time(laps: DataFrame, session_result: DataFrame) -> DataFrame:
    """Shortest sum of lap times among the drivers who finished."""
    finished = session_result.where(~F.coalesce(F.col("dnf") | F.col("dns") | F.col("dsq"), F.lit(False)))
    per = laps.join(finished.select(*DRIVER), DRIVER, "left_semi").groupBy(*DRIVER).agg(F.sum("lap_duration").alias("s"))
    return per.groupBy("session_key").agg(F.min("s").alias("total_race_time"))


def pace_deltas(rows: DataFrame, session: list[str]) -> DataFrame:
    """Rows of teams with two cars or more, with ``pace_vs_field`` and ``pace_vs_teammate`` by best lap time."""
    cars = ["_sum", "_n", "_size"]
    teams = rows.groupBy(*session, "team_name").agg(
        F.sum("best_lap_time").alias("_sum"), F.count("best_lap_time").alias("_n"), F.count(F.lit(1)).alias("_size"))
    field = W.partitionBy(*session)  # over the teams of a session
    teams = teams.withColumn("_mean", F.sum("_sum").over(field) / F.nullif(F.sum("_n").over(field), F.lit(0).cast("long")))
    same = [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in [*session, "team_name"]]
    pairs = teams.where(F.col("team_name").isNotNull() & (F.col("_size") >= 2))
    joined = rows.join(pairs.select(*[F.col(c).alias(f"_k_{c}") for c in [*session, "team_name"]], *cars, "_mean"), same)
    own = F.col("best_lap_time")
    return joined.withColumns({
        "pace_vs_field": own - F.col("_mean"),
        "pace_vs_teammate": own - (F.col("_sum") - own) / F.nullif(F.col("_n") - 1, F.lit(0).cast("long")),
    }).drop(*cars, "_mean", *[f"_k_{c}" for c in [*session, "team_name"]])


def lap_measures(laps: DataFrame) -> DataFrame:
    """``consistency`` and ``speed_ranks`` in one pass over the laps."""
    per = laps.groupBy(*DRIVER).agg(
        F.stddev_samp("lap_duration").alias("consistency_score"),
        F.max("st_speed").alias("top"), F.avg((F.col("i1_speed") + F.col("i2_speed")) / 2).alias("corner"))
    return per.select(*DRIVER, "consistency_score", *_ranks())


def _ranks() -> list[Column]:
    session = W.partitionBy("session_key")
    return [
        F.rank().over(session.orderBy(F.desc_nulls_last("top"))).alias("straight_line_speed_rank"),
        F.rank().over(session.orderBy(F.desc_nulls_last("corner"))).alias("cornering_speed_rank"),
    ]


def consistency(laps: DataFrame) -> DataFrame:
    """Spread of a driver's lap times in a session; lower is steadier."""
    return laps.groupBy(*DRIVER).agg(F.stddev_samp("lap_duration").alias("consistency_score"))


def speed_ranks(laps: DataFrame) -> DataFrame:
    """Rank in a session by top speed at the trap, and by mean intermediate speed."""
    per = laps.groupBy(*DRIVER).agg(
        F.max("st_speed").alias("top"), F.avg((F.col("i1_speed") + F.col("i2_speed")) / 2).alias("corner")
    )
    return per.select(*DRIVER, *_ranks())


def driver_features(t: Mapping[str, DataFrame], performance: DataFrame, results: DataFrame, literal: bool = False) -> DataFrame:
    """One row per driver of a team with two cars or more in a session.

    The field mean covers all drivers of the session, one-car teams included.  Grid and place are
    those of the driver in that session; ``literal`` takes those of any race of the meeting
    for the session named as the race, so that sprint weekends give several rows.  The sums of
    teams are formed once and those of sessions from them.
    """
    session = ["year", "grand_prix", "session_name"]
    rows = performance.select("session_key", *session, "driver_number", "team_name", "best_lap_time")
    if literal:
        outcome = results.select("year", "grand_prix", "driver_number", "final_position", "starting_grid_position", F.lit(RACE).alias("session_name"))
        rows = rows.join(outcome, [*session, "driver_number"], "left")
    else:
        outcome = results.where(F.col("session_key").isNotNull()).select(*DRIVER, "final_position", "starting_grid_position")
        rows = rows.join(outcome, DRIVER, "left")
    rows = pace_deltas(rows, session)
    rounds = meeting_rounds(t).withColumnRenamed("meeting_name", "grand_prix")
    return (
        rows.join(rounds, ["year", "grand_prix"], "left")
        .join(weather_context(t["weather"]), "session_key", "left")
        .join(lap_measures(t["laps"]), DRIVER, "left")
        .withColumn("race_round", F.coalesce("race_round", F.lit(0)))  # a meeting without a race
        .select(
            surrogate_id("year", "race_round", "session_name", "driver_number").alias("feature_id"),
            "year", "race_round", F.col("session_name").alias("session_type"), "driver_number",
            "pace_vs_teammate", "pace_vs_field", "consistency_score",
            F.col("starting_grid_position").alias("track_position_start"),
            F.col("final_position").cast("double").alias("track_position_avg"),
            "straight_line_speed_rank", "cornering_speed_rank", "air_temperature", "track_temperature",
        )
    )


def race_context(t: Mapping[str, DataFrame], literal: bool = False) -> DataFrame:
    """One row per race: its circuit, interruptions, duration and weather."""
    races = race_rounds(sessions_with_meeting(t))
    of_races = races.select("session_key")
    laps = t["laps"].join(of_races, "session_key", "left_semi")
    return (
        races.join(F.broadcast(track_dim(races.sparkSession)), "circuit_short_name", "left")
        .join(race_events(t["race_control"], literal), "session_key", "left")
        .join(total_race_time(laps, t["session_result"]), "session_key", "left")
        .join(weather_features(t["weather"]), "session_key", "left")
        .select(
            surrogate_id("year", "race_round").alias("context_id"), "year", "race_round",
            F.col("meeting_name").alias("grand_prix"),
            "circuit_length", "number_of_turns", "overtaking_difficulty",
            F.coalesce("safety_car_deployments", F.lit(0)).alias("safety_car_deployments"),
            F.coalesce("red_flag_periods", F.lit(0)).alias("red_flag_periods"),
            "total_race_time", F.coalesce("weather_changes", F.lit(False)).alias("weather_changes"), "rain_probability",
        )
    )


LAP = ["session_key", "driver_number", "lap_number"]


def laps_with_position(t: Mapping[str, DataFrame], literal: bool = False) -> DataFrame:
    """Timed race laps with the driver's position nearest the lap's start.

    ``literal`` keeps every position sample within the interval, so that a lap may occur
    several times.
    """
    races = t["sessions"].where(F.col("session_type") == RACE).select("session_key")
    laps = t["laps"].where(F.col("lap_duration").isNotNull()).join(races, "session_key", "left_semi")
    laps = laps.select(*LAP, "lap_duration", "date_start")
    samples = t["position"].join(races, "session_key", "left_semi").select(*DRIVER, "date", "position")
    if literal:
        return interval_join(laps, samples, DRIVER, "date_start", "date", POSITION_SECONDS)
    return nearest_join(laps, samples, DRIVER, "date_start", "date", POSITION_SECONDS, ["position"])


def laps_with_tyre_age(laps: DataFrame, stints: DataFrame) -> DataFrame:
    """Laps with the age of the tyres; null outside the driver's stints."""
    known = stints.select(*DRIVER, "lap_start", "lap_end", "tyre_age_at_start")
    joined = range_join(laps, known, DRIVER, "lap_number", "lap_start", "lap_end",
                        [F.asc_nulls_last("lap_start"), F.asc_nulls_last("lap_end"), F.asc_nulls_last("tyre_age_at_start")])
    age = tyre_age("tyre_age_at_start", "lap_number", "lap_start")
    return joined.withColumn("tire_age", age).drop("lap_start", "lap_end", "tyre_age_at_start")


def car_behind(t: Mapping[str, DataFrame], literal: bool = False) -> DataFrame:
    """For every race lap the cars directly ahead and behind, and the lap-time gap to the one behind."""
    placed = laps_with_position(t, literal)
    around = neighbours(placed, ["session_key", "lap_number"], ["position", "driver_number", "date"],
                        {"lap_duration": "lap", "driver_number": "driver"})
    # Ages belong to the plain laps, so that the placed ones are planned once.
    races = t["sessions"].where(F.col("session_type") == RACE).select("session_key")
    laps = t["laps"].where(F.col("lap_duration").isNotNull()).join(races, "session_key", "left_semi").select(*LAP).distinct()
    aged = around.join(laps_with_tyre_age(laps, t["stints"]), LAP, "left")
    meetings = t["sessions"].select("session_key", "meeting_key").join(t["meetings"].select("meeting_key", "meeting_name"), "meeting_key")
    return aged.join(meetings.select("session_key", "meeting_name"), "session_key").select(
        *LAP, "position", F.col("lap_duration").alias("lap_time"), "tire_age",
        "has_car_behind", (F.col("lap_behind") - F.col("lap_duration")).alias("gap_to_behind"),
        F.col("driver_behind").alias("car_behind_driver"),
        "has_car_ahead", F.col("driver_ahead").alias("car_ahead_driver"), "meeting_name",
    )


def analysis(t: Mapping[str, DataFrame], kind: str = "car_behind_impact") -> DataFrame:
    """A comparative dataset by name; an unknown name gives an empty one."""
    data = car_behind(t)
    return data if kind == "car_behind_impact" else data.where(F.lit(False))

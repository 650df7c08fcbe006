"""The calendar: sessions with their meeting, and the number of each race in its season."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

RACE = "Race"


def sessions_with_meeting(t: Mapping[str, DataFrame]) -> DataFrame:
    """Every session with its meeting's name, circuit and date."""
    meetings = t["meetings"].select(
        "meeting_key", "meeting_name", "circuit_short_name", F.col("date_start").alias("race_date")
    )
    sessions = t["sessions"].select(
        "session_key", "meeting_key", "year", "session_name", "session_type", "date_start", "date_end"
    )
    return sessions.join(meetings, "meeting_key")


def race_rounds(sessions: DataFrame) -> DataFrame:
    """Race sessions numbered by date within their season, from 1.

    The window is over one season's races; there are never more than a few dozen.
    """
    order = W.partitionBy("year").orderBy("date_start", "meeting_name")
    return sessions.where(F.col("session_type") == RACE).withColumn("race_round", F.dense_rank().over(order))


def meeting_rounds(t: Mapping[str, DataFrame]) -> DataFrame:
    """Round of each meeting by name and season; the first of its races counts."""
    races = race_rounds(sessions_with_meeting(t))
    return races.groupBy("year", "meeting_name").agg(F.min("race_round").alias("race_round"))

"""Typed projection, validation, de-duplication, sampling and union of raw tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from pitwall.functions.scalars import contains_any_case, null_or, parse_date, parse_ts, typed, weight_if_present
from pitwall.operators.joins import first_match

# Columns and types of the processed tables, and the keys that must be present.
PROCESSED = {
    "meetings": ({"meeting_key": "bigint", "meeting_name": "string", "meeting_official_name": "string",
                  "location": "string", "country_key": "bigint", "country_code": "string", "country_name": "string",
                  "circuit_key": "bigint", "circuit_short_name": "string", "date_start": "timestamp", "year": "int",
                  "gmt_offset": "string"}, ["meeting_key"]),
    "sessions": ({"session_key": "bigint", "session_name": "string", "session_type": "string",
                  "date_start": "timestamp", "date_end": "timestamp", "gmt_offset": "string",
                  "meeting_key": "bigint"}, ["session_key"]),
    "drivers": ({"driver_number": "int", "broadcast_name": "string", "full_name": "string", "name_acronym": "string",
                 "team_name": "string", "team_colour": "string", "first_name": "string", "last_name": "string",
                 "headshot_url": "string", "country_code": "string", "session_key": "bigint"}, ["driver_number"]),
    "laps": ({"date_start": "date", "session_key": "bigint", "driver_number": "int", "lap_number": "int",
              "lap_duration": "double", "lap_time": "double", "i1_speed": "double", "i2_speed": "double",
              "st_speed": "double", "is_personal_best": "boolean", "compound": "string", "tyre_life": "int",
              "fresh_tyre": "boolean"}, ["session_key", "driver_number", "lap_number"]),
    # The sample's time of day is kept: who was where last depends on it.
    "position": ({"date": "timestamp", "session_key": "bigint", "driver_number": "int", "position": "int"},
                 ["session_key", "driver_number"]),
}


def project(df: DataFrame, columns: Mapping[str, str], required: Sequence[str],
            processed_at: Column | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Cast named columns, turn misfits into nulls and drop rows lacking a required one.

    A column the input lacks becomes null.  ``keep`` passes columns through as they are.
    """

    def cast(name: str, kind: str) -> Column:
        if name not in df.columns:
            return F.lit(None).cast(kind)
        return {"timestamp": parse_ts, "date": parse_date}.get(kind, lambda c: typed(c, kind))(F.col(name))

    out = df.select(
        *[cast(n, k).alias(n) for n, k in columns.items()],
        *[F.col(c) for c in keep if c not in columns],
        (processed_at if processed_at is not None else F.current_timestamp()).alias("processing_timestamp"),
    )
    return out.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in required]))


def process(df: DataFrame, endpoint: str, processed_at: Column | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """The processed form of one endpoint's raw rows."""
    if endpoint not in PROCESSED:
        raise ValueError(f"no processed form for endpoint {endpoint!r}")
    columns, required = PROCESSED[endpoint]
    return project(df, columns, required, processed_at, keep)


def tag_metadata(df: DataFrame, endpoint: str, extracted_at: Column) -> DataFrame:
    return df.withColumns({"_extracted_at": extracted_at, "_endpoint": F.lit(endpoint)})


def dedup(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column]) -> DataFrame:
    """One defined survivor per key: the first in ``order_by``."""
    return first_match(df, keys, order_by)


def meeting_rules() -> Column:
    return (
        F.col("meeting_key").isNotNull() & F.col("year").isNotNull()
        & F.col("year").between(2018, 2030) & F.col("meeting_name").isNotNull()
    )


def lap_rules() -> Column:
    keys = ("session_key", "driver_number", "lap_number", "date_start")
    present = [F.col(c).isNotNull() for c in keys]
    positive = [null_or(c, F.col(c) > 0) for c in ("lap_time", "lap_duration", "i1_speed", "i2_speed", "st_speed")]
    rules = [
        *present,
        (F.col("lap_number") > 0) & (F.col("lap_number") < 200),
        F.col("driver_number").between(1, 99),
        *positive,
        null_or("tyre_life", F.col("tyre_life") >= 0),
    ]
    return reduce(lambda a, b: a & b, rules)


def meeting_tier() -> Column:
    """1.0 with an official name, 0.8 with at least a location, else 0.6."""
    return (
        F.when(F.col("meeting_official_name").isNotNull(), F.lit(1.0))
        .when(F.col("location").isNotNull(), F.lit(0.8)).otherwise(F.lit(0.6))
    )


# Weight of each lap column in the completeness score.
LAP_WEIGHTS = {"lap_time": 0.3, "i1_speed": 0.2, "i2_speed": 0.2, "st_speed": 0.2, "compound": 0.1}


def lap_completeness() -> Column:
    return reduce(lambda a, b: a + b, [weight_if_present(c, w) for c, w in LAP_WEIGHTS.items()])


def valid_meetings(df: DataFrame) -> DataFrame:
    return df.where(meeting_rules()).withColumn("data_quality_score", meeting_tier())


def valid_laps(df: DataFrame) -> DataFrame:
    return df.where(lap_rules()).withColumn("data_completeness_score", lap_completeness())


def split_valid(df: DataFrame, rules: Column) -> tuple[DataFrame, DataFrame]:
    """Rows that meet the rules, and all others (an undecided rule counts as broken)."""
    ok = F.coalesce(rules, F.lit(False))
    return df.where(ok), df.where(~ok)


def sample_per_group(df: DataFrame, group: Sequence[str], keys: Sequence[str], n: int, seed: int) -> DataFrame:
    """At most ``n`` rows per group, the same ones on every run.

    Rows are ordered by a hash of their keys and the seed; Spark drops rows beyond ``n``
    in each task before the shuffle.
    """
    ticket = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed))))
    order = W.partitionBy(*group).orderBy(ticket, *keys)
    return df.withColumn("_rn", F.row_number().over(order)).where(F.col("_rn") <= n).drop("_rn")


def last_n(df: DataFrame, order_by: Sequence[str | Column], n: int) -> DataFrame:
    """The first ``n`` rows of the order given, kept as a per-task top-n."""
    return df.orderBy(*order_by).limit(n)


def union_all(*dfs: DataFrame) -> DataFrame:
    """Rows of all inputs, columns matched by name and filled with nulls where absent."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def name_contains(df: DataFrame, column: str, *words: str) -> DataFrame:
    """Rows whose text holds any of the words, in any letter case."""
    return df.where(reduce(lambda a, b: a | b, [contains_any_case(column, w) for w in words]))

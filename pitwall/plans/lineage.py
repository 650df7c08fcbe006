"""Lineage of the library's own tables: what each is computed from, as the plans say."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession

from pitwall.catalog import TABLES
from pitwall.operators.clean import process, valid_laps, valid_meetings
from pitwall.operators.lineage import column_edges, edges, named
from pitwall.plans.features import driver_features, race_context
from pitwall.plans.performance import gp_performance
from pitwall.plans.results import gp_results, standings


def products(spark: SparkSession) -> tuple[dict[str, DataFrame], set[str]]:
    """The derived tables over empty tables of their definitions, and the names of those."""
    source = named({name: spark.createDataFrame([], table.schema) for name, table in TABLES.items()})
    raw = {name.removeprefix("raw_"): df for name, df in source.items() if name.startswith("raw_")}
    results, performance = source["grand_prix_results"], source["grand_prix_performance"]
    return {
        "grand_prix_results": gp_results(raw), "grand_prix_performance": gp_performance(raw),
        "driver_championship_standings": standings(results), "driver_performance_features": driver_features(raw, performance, results),
        "race_context_features": race_context(raw), "lake_meetings": valid_meetings(process(raw["meetings"], "meetings")),
        "lake_sessions": process(raw["sessions"], "sessions"), "lake_drivers": process(raw["drivers"], "drivers"),
        "lake_laps": valid_laps(process(raw["laps"], "laps")),
    }, set(source)


@functools.lru_cache(1)
def _upstream(application: str) -> dict[str, list[str]]:
    spark = SparkSession.active()
    derived, names = products(spark)
    found = {table: {e[1] for e in column_edges(df, names)} for table, df in derived.items()}
    return {table: [name for name in TABLES if name in tables] for table, tables in found.items()}


def upstream(spark: SparkSession) -> dict[str, list[str]]:
    """The tables that each derived table reads, in the order of their definitions; worked out once in an application."""
    return _upstream(spark.sparkContext.applicationId)


def column_lineage(spark: SparkSession) -> DataFrame:
    """(table_name, column_name, source_table, source_column) of all derived tables; see ``operators.lineage.column_edges``."""
    return edges(spark, *products(spark))

"""Row- and table-level data quality, each measure one aggregation over the table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitwall.catalog import TABLES, get_table
from pitwall.functions.scalars import ratio

SIGMAS = 3.0  # our choice: the data model only declares an outlier count


def null_counts(df: DataFrame) -> DataFrame:
    """One row: total records and a map of column name to number of nulls."""
    counts = [F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(df.columns)]
    names = F.array(*[F.lit(c) for c in df.columns])
    return df.agg(F.count(F.lit(1)).alias("total_records"), *counts).select(
        "total_records",
        F.map_from_arrays(names, F.array(*[F.col(f"n{i}") for i in range(len(df.columns))])).alias("null_counts"),
    )


def completeness(df: DataFrame) -> DataFrame:
    """One row: share of filled cells, null for an empty table."""
    nulls = F.aggregate(F.map_values("null_counts"), F.lit(0).cast("bigint"), lambda a, x: a + x)
    cells = F.col("total_records") * len(df.columns)
    return null_counts(df).select("total_records", (1 - ratio(nulls, cells)).alias("completeness_score"))


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows beyond the first of each key."""
    per_key = df.groupBy(*keys).agg((F.count(F.lit(1)) - 1).alias("extra"))
    return per_key.agg(F.coalesce(F.sum("extra"), F.lit(0)).alias("duplicate_records"))


def violations(df: DataFrame, table: str) -> DataFrame:
    """Rows that break the table's definition, with the error texts of each."""
    required = get_table(table).required
    errors = F.array_compact(F.array(*[
        F.when(F.col(c).isNull() if c in df.columns else F.lit(True), F.lit(f"Required field {c} is missing or null"))
        for c in required
    ]))
    return df.withColumn("errors", errors).where(F.size("errors") > 0)


def freshness(df: DataFrame, ts: str, as_of: Column) -> DataFrame:
    """One row: latest timestamp and hours from it to ``as_of``."""
    latest = F.max(ts)
    hours = (F.unix_timestamp(as_of.cast("timestamp")) - F.unix_timestamp(latest.cast("timestamp"))) / 3600.0
    return df.agg(latest.alias("latest_data_timestamp"), hours.alias("data_freshness_hours"))


def outliers(df: DataFrame, col: str, group: Sequence[str] = ()) -> DataFrame:
    """Rows whose value lies beyond 3 sample standard deviations from the mean of its group."""
    spread = F.stddev_samp(col) * SIGMAS
    bounds = [(F.avg(col) - spread).alias("_lo"), (F.avg(col) + spread).alias("_hi")]
    if not group:
        whole = df.agg(*bounds)
        return df.where((F.col(col) < whole.select("_lo").scalar()) | (F.col(col) > whole.select("_hi").scalar()))
    stats = df.groupBy(*group).agg(*bounds).select(*[F.col(g).alias(f"_g_{g}") for g in group], "_lo", "_hi")
    joined = df.join(stats, [F.col(g).eqNullSafe(F.col(f"_g_{g}")) for g in group])
    return joined.where((F.col(col) < F.col("_lo")) | (F.col(col) > F.col("_hi"))).select(*df.columns)


def validation_report(df: DataFrame, keys: Sequence[str], rules: Column) -> DataFrame:
    """One row: records in, left after de-duplication and rules, and removed.

    Every copy of a key counts once, as valid when any of its copies is, which equals
    de-duplicating to a valid survivor first.
    """
    ok = F.coalesce(rules, F.lit(False)).cast("int")
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.max(ok).alias("ok"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_before"), F.coalesce(F.sum("ok"), F.lit(0)).cast("bigint").alias("rows_after")
    ).withColumn("rows_removed", F.col("rows_before") - F.col("rows_after"))


def _seconds(c: Column) -> Column:
    return F.unix_timestamp(c.cast("timestamp"))


def metrics(df: DataFrame, table: str, as_of: Column, keys: Sequence[str] | None = None,
            ts: str | None = None, outlier_col: str | None = None) -> DataFrame:
    """The table's row of the quality-metrics table.

    Nulls, violations and freshness come from one pass; duplicates need their own grouping
    and outliers a second look at the values.
    """
    definition = get_table(table)
    keys = list(keys or definition.keys)
    broken = F.lit(False)
    for c in definition.required:
        broken = broken | (F.col(c).isNull() if c in df.columns else F.lit(True))
    nulls = [F.count_if(F.col(c).isNull()) for c in df.columns]
    latest = F.max(ts) if ts else F.lit(None).cast("timestamp")
    name = F.lit(table).alias("table_name")
    once = df.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(broken).alias("constraint_violations"),
        latest.alias("latest_data_timestamp"),
        *[n.alias(f"n{i}") for i, n in enumerate(nulls)],
    ).select(
        name, "total_records", "constraint_violations", "latest_data_timestamp",
        F.map_from_arrays(F.array(*[F.lit(c) for c in df.columns]),
                          F.array(*[F.col(f"n{i}") for i in range(len(nulls))])).alias("null_counts"),
    )
    out = once.join(duplicates(df, keys).select(name, "duplicate_records"), "table_name")
    if outlier_col:
        found = outliers(df, outlier_col).agg(F.count(F.lit(1)).alias("outlier_count"))
        out = out.join(found.select(name, "outlier_count"), "table_name")
    else:
        out = out.withColumn("outlier_count", F.lit(0).cast("bigint"))
    total_nulls = F.aggregate(F.map_values("null_counts"), F.lit(0).cast("bigint"), lambda a, x: a + x)
    return out.select(
        "table_name", as_of.alias("measurement_date"), "total_records", "null_counts",
        (1 - ratio(total_nulls, F.col("total_records") * len(df.columns))).alias("completeness_score"),
        "duplicate_records", "constraint_violations", "latest_data_timestamp",
        ((_seconds(as_of) - _seconds(F.col("latest_data_timestamp"))) / 3600.0).alias("data_freshness_hours"),
        "outlier_count", ratio("outlier_count", "total_records").alias("anomaly_score"), as_of.alias("created_at"),
    )


def lineage(spark: SparkSession, version: str = "1", layers: Sequence[str] | None = None) -> DataFrame:
    """One row per defined table: version, field types and the tables before and after it, as the plans that derive them say."""
    from pitwall.plans.lineage import upstream  # plans are built of operators

    above, down = upstream(spark), {}
    for table, sources in above.items():
        for source in sources:
            down.setdefault(source, []).append(table)
    rows = [
        (t.name, t.layer, version, {f.name: f.dataType.simpleString() for f in t.schema},
         above.get(t.name, []), down.get(t.name, []))
        for t in TABLES.values() if layers is None or t.layer in layers
    ]
    strings = T.ArrayType(T.StringType())
    schema = T.StructType([
        T.StructField("table_name", T.StringType()), T.StructField("layer", T.StringType()),
        T.StructField("schema_version", T.StringType()),
        T.StructField("field_types", T.MapType(T.StringType(), T.StringType())),
        T.StructField("upstream_dependencies", strings), T.StructField("downstream_dependencies", strings),
    ])
    return spark.createDataFrame(rows, schema)


def schema_metadata(spark: SparkSession, as_of: Column, version: str = "1", layers: Sequence[str] | None = None,
                    update_frequency: str | None = None) -> DataFrame:
    """``lineage`` with all columns of the schema-metadata table, described from the definitions."""
    from pitwall.plans.lineage import upstream

    rows, above = [], upstream(spark)
    for t in TABLES.values():
        if layers is None or t.layer in layers:
            source = ", ".join(above.get(t.name, [])) or f"landing endpoint {t.name.removeprefix('raw_')}"
            fields = {f.name: "key" if f.name in t.keys else "required" if f.name in t.required else "optional" for f in t.schema}
            rows.append((t.name, f"{t.layer} table, a row for each {', '.join(t.keys)}", source, fields))
    described = spark.createDataFrame(rows, "table_name string, description string, data_source string, field_descriptions map<string,string>")
    return lineage(spark, version, layers).drop("layer").join(described, "table_name").withColumns(
        {"last_updated": as_of, "update_frequency": F.lit(update_frequency).cast("string"), "created_at": as_of})


def same_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: rows only in the first and only in the second input, copies counted."""
    cols = a.columns
    signed = a.select(*cols, F.lit(1).alias("_n")).unionAll(b.select(*cols, F.lit(-1).alias("_n")))
    diff = signed.groupBy(*cols).agg(F.sum("_n").alias("_d"))
    return diff.agg(
        F.coalesce(F.sum(F.greatest("_d", F.lit(0))), F.lit(0)).alias("only_first"),
        F.coalesce(F.sum(F.greatest(-F.col("_d"), F.lit(0))), F.lit(0)).alias("only_second"),
    )

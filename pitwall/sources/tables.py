"""Catalog tables: create, fill, inspect, register."""

from __future__ import annotations

import contextlib
import re
from collections.abc import Iterator, Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitwall.catalog import TABLES, get_schema_by_layer, struct_of
from pitwall.sources.readers import list_dataset


def create_table(spark: SparkSession, name: str, columns: Mapping[str, str] | T.StructType,
                 location: str, partition_by: Sequence[str] = ()) -> None:
    """Create a Parquet table if absent, from a schema or SQL-style column definitions.

    Required-ness is checked by the quality functions: files may hold what they may.
    """
    schema = columns if isinstance(columns, T.StructType) else struct_of(dict(columns))
    if not spark.catalog.tableExists(name):
        body = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        parts = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({body}) USING parquet{parts} LOCATION '{location}'")


def create_tables(spark: SparkSession, database: str, layer: str, root: str) -> list[str]:
    """Create every table of a layer that does not exist yet; returns their names."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{root}'")
    for table, schema in get_schema_by_layer(layer).items():
        create_table(spark, f"{database}.{table}", schema, f"{root}/{table}", TABLES[table].partition_by)
    return list(get_schema_by_layer(layer))


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def describe_table(spark: SparkSession, name: str) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in spark.table(name).schema}


def table_detail(spark: SparkSession, name: str) -> dict[str, str]:
    """What the catalog knows of a table beside its columns: provider, location, partition columns, bucketing, statistics."""
    rows = spark.sql(f"DESCRIBE EXTENDED {name}").collect()
    parts = [r["col_name"] for r in rows]
    at = parts.index("# Detailed Table Information") if "# Detailed Table Information" in parts else len(parts)
    out = {r["col_name"]: r["data_type"] for r in rows[at + 1 :] if r["col_name"]}
    return out | {"Partition Columns": ",".join(c.name for c in spark.catalog.listColumns(name) if c.isPartition)}


def analyze(spark: SparkSession, name: str, columns: Sequence[str] = (), histograms: bool = False) -> None:
    """Measure a table for the optimizer: rows, bytes, and of the columns given (all without) values, nulls and bounds.

    One pass; distinct values come from a mergeable sketch. With ``histograms``, equal-height ones of numeric columns take a second pass.
    """
    held = spark.conf.get("spark.sql.statistics.histogram.enabled")
    spark.conf.set("spark.sql.statistics.histogram.enabled", str(histograms).lower())
    try:
        wanted = f"COLUMNS {', '.join(f'`{c}`' for c in columns)}" if columns else "ALL COLUMNS"
        spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR {wanted}")
    finally:
        spark.conf.set("spark.sql.statistics.histogram.enabled", held)


def column_statistics(spark: SparkSession, name: str) -> DataFrame:
    """(column, distinct, nulls, least, greatest) of each measured column, bounds as text; read from the catalog, not from the data."""
    out = []
    for c in spark.table(name).columns:
        found = {r["info_name"]: r["info_value"] for r in spark.sql(f"DESCRIBE EXTENDED {name} `{c}`").collect()}
        known = {k: None if v in (None, "NULL") else v for k, v in found.items()}
        if known.get("distinct_count") is not None:
            out.append((c, int(known["distinct_count"]), int(known["num_nulls"]), known.get("min"), known.get("max")))
    return spark.createDataFrame(out, "column string, distinct bigint, nulls bigint, least string, greatest string")


@contextlib.contextmanager
def cost_based(spark: SparkSession) -> Iterator[None]:
    """Within it, joins are ordered by the cost that the tables' statistics tell."""
    names = ("spark.sql.cbo.enabled", "spark.sql.cbo.joinReorder.enabled")
    held = {n: spark.conf.get(n) for n in names}
    try:
        for n in names:
            spark.conf.set(n, "true")
        yield
    finally:
        for n, v in held.items():
            spark.conf.set(n, v)


def save_bucketed(df: DataFrame, name: str, location: str, keys: Sequence[str], buckets: int) -> None:
    """Write a table whose rows lie in buckets by a hash of ``keys``, sorted by them, one file a bucket.

    Tables bucketed alike are joined or grouped by these keys where they lie: no row is shuffled. Choose ``buckets`` for the largest
    of them, so that a bucket of it fits a task.
    """
    (df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys).mode("overwrite").option("path", location).saveAsTable(name))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of a schema in its order: cast where present, null where absent."""
    return df.select(*[
        (F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema
    ])


def save_table(df: DataFrame, name: str, mode: str = "append") -> None:
    """Append to a table, replace it, or replace just the partitions that receive rows.

    ``mode`` is ``append``, ``replace`` or ``replace_partitions``; a repeated run with the
    last leaves one copy of each season.
    """
    spark = df.sparkSession
    rows = conform(df, spark.table(name).schema)
    if mode == "append":
        rows.write.insertInto(name)
    elif mode == "replace":
        rows.write.option("partitionOverwriteMode", "static").insertInto(name, overwrite=True)
    elif mode == "replace_partitions":
        rows.write.option("partitionOverwriteMode", "dynamic").insertInto(name, overwrite=True)
    else:
        raise ValueError(f"unknown mode {mode!r}")


def discover(spark: SparkSession, name: str, path: str) -> None:
    """Register a partitioned Parquet dataset: schema inferred, partitions picked up."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING parquet LOCATION '{path}'")
    if any(c.isPartition for c in spark.catalog.listColumns(name)):
        spark.sql(f"MSCK REPAIR TABLE {name}")


# What Parquet files of one type can be read as, narrowest first.
LADDERS = (("tinyint", "smallint", "int", "bigint"), ("float", "double"))


def wider(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The type that holds both, if files of either can be read as it."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    for ladder in LADDERS:
        if a.simpleString() in ladder and b.simpleString() in ladder:
            return max(a, b, key=lambda t: ladder.index(t.simpleString()))
    return None


def merge_schemas(schemas: Sequence[T.StructType]) -> tuple[T.StructType, list[tuple[str, str, str]]]:
    """All columns in the order they first appear, each with its widest type; and the conflicts (column, type, other type)."""
    merged: dict[str, T.DataType] = {}
    conflicts = []
    for field in (f for schema in schemas for f in schema):
        held = merged.setdefault(field.name, field.dataType)
        both = wider(held, field.dataType)
        if both is None:
            conflicts.append((field.name, held.simpleString(), field.dataType.simpleString()))
        else:
            merged[field.name] = both
    return T.StructType([T.StructField(c, k) for c, k in merged.items()]), list(dict.fromkeys(conflicts))


def _schemas(spark: SparkSession, root: str, paths: list[str]) -> list[T.StructType]:
    """Schemas of the files at the paths. Spark merges them, many footers at a time; only where types differ, paths are halved."""
    try:
        return [spark.read.option("basePath", root).option("mergeSchema", True).parquet(*paths).schema]
    except (PySparkException, Py4JJavaError):
        if len(paths) > 1:
            half = len(paths) // 2
            return _schemas(spark, root, paths[:half]) + _schemas(spark, root, paths[half:])
        inside = [r["path"] for r in list_dataset(spark, paths[0]).where("path LIKE '%.parquet'").orderBy("path").collect()]
        if inside in ([], paths):
            raise
        return _schemas(spark, root, inside)


def evolve(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Register a partitioned Parquet dataset, or bring its table up to what has been landed since.

    New columns are added to the table, and columns whose type has become wider (a whole number or a float) are widened; files
    written before read as null and as the wider type. Partitions are picked up. Returns (column, change, from_type, to_type),
    change being ``created``, ``added``, ``widened`` or ``conflict``. A column with types that do not go together is a conflict: it is
    reported, and the table is left as it is. Columns that no file has any more stay.
    """
    folder = F.regexp_extract("path", "^(.*)/[^/]*$", 1)
    found = list_dataset(spark, path).where("path LIKE '%.parquet'").select(folder.alias("folder")).distinct().orderBy("folder")
    folders = [r["folder"] for r in found.collect()]  # one for each partition
    if not folders:
        raise ValueError(f"no Parquet file below {path}")
    known = spark.catalog.tableExists(name)
    held = spark.table(name).schema if known else T.StructType()
    parts = re.findall(r"/([^/=]+)=[^/]*", folders[0].removeprefix(re.match(r"^(?:[a-z]+:)?", folders[0])[0])[len(path.removeprefix("file:").rstrip("/")) :])
    merged, conflicts = merge_schemas([*([held] if known else []), *_schemas(spark, path, folders)])
    types = {f.name: f.dataType.simpleString() for f in held}
    done = [(c, "conflict", a, b) for c, a, b in conflicts]
    if not conflicts:
        new = [f for f in merged if f.name not in types]
        wide = [(f.name, "widened", types[f.name], f.dataType.simpleString()) for f in merged if f.name in types and f.dataType.simpleString() != types[f.name]]
        done = [(f.name, "added" if known else "created", None, f.dataType.simpleString()) for f in new] + wide
        if known and wide:  # a type can't be altered; the table is external, so its files stay
            spark.sql(f"DROP TABLE {name}")
        if known and not wide and new:
            spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in new)})")
        create_table(spark, name, merged, path, parts)
        if parts:
            spark.sql(f"MSCK REPAIR TABLE {name}")
        spark.catalog.refreshTable(name)
    return spark.createDataFrame(done, "column string, change string, from_type string, to_type string")

"""Reading landed files, processed tables and query results."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import StructType

from pitwall.catalog import ENDPOINTS, endpoint_schema
from pitwall.session import stage

FORMATS = ("parquet", "csv", "json")


def _matches(spark: SparkSession, path: str) -> list:
    """File status of what a path or glob matches, on whatever file system its scheme names."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return list(fs.globStatus(hadoop_path) or [])


def path_exists(spark: SparkSession, path: str) -> bool:
    return len(_matches(spark, path)) > 0


def file_versions(spark: SparkSession, paths: Sequence[str]) -> tuple:
    """Name, length and modification time of each file, to tell whether anything changed.

    Folders are listed: on an object store they have neither a length nor a time.
    """
    found = []
    for status in (s for p in paths for s in _matches(spark, p)):
        inner = _matches(spark, f"{status.getPath().toString()}/*") if status.isDirectory() else [status]
        found += [(s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in inner if not s.isDirectory()]
    return tuple(sorted(found))


def landed_years(spark: SparkSession, root: str, endpoint: str) -> list[int]:
    """Years with a landing directory of the endpoint."""
    parents = (s.getPath().getParent().getName() for s in _matches(spark, f"{root}/year=*/endpoint={endpoint}"))
    return sorted(int(p.removeprefix("year=")) for p in parents)


def scan(spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | None = None,
         multi_line: bool = False) -> DataFrame:
    """Read Parquet, CSV with a header, or JSON records.

    JSON is one record per line, which splits over tasks; ``multi_line`` reads files that
    hold one array or document each.
    """
    if fmt not in FORMATS:
        raise ValueError(f"unsupported format {fmt!r}; one of {FORMATS}")
    reader = spark.read if schema is None else spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    if fmt == "json":
        reader = reader.option("multiLine", multi_line)
    return reader.format(fmt).load(path)


def _endpoint(name: str, filters: Mapping[str, object]) -> None:
    if name not in ENDPOINTS:
        raise ValueError(f"unknown endpoint {name!r}; one of {sorted(ENDPOINTS)}")
    wrong = set(filters) - set(ENDPOINTS[name])
    if wrong:
        raise ValueError(f"endpoint {name!r} cannot be filtered by {sorted(wrong)}")


def scan_raw(spark: SparkSession, root: str, endpoint: str, years: Sequence[int] | None = None,
             schema: StructType | None = None, fmt: str = "parquet", multi_line: bool = False,
             processed_at: Column | None = None, min_year: int | None = None, **filters: object) -> DataFrame:
    """Landed rows of one endpoint, all or some years, with equality filters it allows.

    The layout is ``root/year=Y/endpoint=E/``.  ``years`` are the only directories listed;
    ``min_year`` prunes the listed ones, with no last year.  Filters reach the Parquet scan.
    Nothing landed gives an empty table, by default with the endpoint's columns.  Without a
    ``schema`` the columns of all Parquet files are merged, which reads all their footers.
    """
    _endpoint(endpoint, filters)
    which = "*" if years is None else "{" + ",".join(str(int(y)) for y in years) + "}"
    pattern = f"{root}/year={which}/endpoint={endpoint}"
    if not path_exists(spark, pattern):
        fields = list(schema if schema is not None else endpoint_schema(endpoint))
        fields += [f for f in (T.StructField("year", T.IntegerType()), T.StructField("endpoint", T.StringType()))
                   if f.name not in [x.name for x in fields]]
        df = spark.createDataFrame([], T.StructType(fields))
    else:
        reader = spark.read.option("basePath", root)
        if schema is not None:
            body = [f for f in schema.fields if f.name not in ("year", "endpoint")]
            reader = reader.schema(T.StructType(
                [*body, T.StructField("year", T.IntegerType()), T.StructField("endpoint", T.StringType())]))
        if fmt == "json":
            reader = reader.option("multiLine", multi_line)
        if fmt == "parquet" and schema is None:
            reader = reader.option("mergeSchema", True)
        df = reader.format(fmt).load(pattern)
    if min_year is not None:
        df = df.where(F.col("year") >= min_year)
    for name, value in filters.items():
        df = df.where(F.col(name) == F.lit(value))
    stamp = processed_at if processed_at is not None else F.current_timestamp()
    return df.withColumns({"extraction_year": F.col("year"), "processing_timestamp": stamp})


def scan_documents(spark: SparkSession, path: str, schema: StructType, quarantine: str, root: str | None = None) -> DataFrame:
    """Records of JSON files that hold one document each, an array of records or a single one, over any number of lines.

    A file is parsed as a variant, so one that is broken does not spoil others, and a field is taken by its name and type. What can't
    be read goes to the Parquet table at ``quarantine`` (file, kind, position, content) and not into the result: a ``document``
    that is no JSON array or object, an ``element`` of an array that is no object, and a ``record`` with a field that is there but has
    another type. Missing fields, and those that are null, are null; fields that ``schema`` does not have are left out; an empty array has no record; Spark passes over files of no bytes.

    ``path`` may be a glob; below ``root`` the names of its folders give partition columns, which come last. Files are parsed one a task, as any
    such document must be; rows are spread over tasks right after.
    """
    reader = spark.read.option("basePath", root) if root else spark.read
    files = reader.text(path, wholetext=True)
    parts = [c for c in files.columns if c != "value"]
    document = F.try_parse_json("value")
    parsed = files.select(*parts, F.col("_metadata.file_path").alias("_file"), "value", document.alias("_document"))
    elements = F.coalesce(F.try_variant_get("_document", "$", "array<variant>"), F.array("_document"))
    each = parsed.select("*", F.posexplode_outer(elements).alias("_position", "_element"))
    kind = F.schema_of_variant
    taken, wrong = [], F.lit(False)
    for f in schema.fields:
        if '"' in f.name:
            raise ValueError(f"a field's name has a double quote: {f.name}")
        inside = F.try_variant_get("_element", f'$["{f.name}"]', "variant")
        value = F.try_variant_get("_element", f'$["{f.name}"]', f.dataType.simpleString())
        taken.append(value.alias(f.name))
        wrong = wrong | (inside.isNotNull() & ~F.is_variant_null(inside) & value.isNull())
    is_list = kind("_document").startswith("ARRAY")
    object_ = kind("_element").startswith("OBJECT")
    fault = (F.when(F.col("_document").isNull() | ~(is_list | kind("_document").startswith("OBJECT")), "document")
             .when(is_list & F.col("_position").isNull(), "nothing").when(~F.coalesce(object_, F.lit(False)), "element").when(wrong, "record"))
    rows = stage(each.select(*taken, *parts, "_file", F.col("_position").cast("long").alias("_position"), fault.alias("_kind"),
                             F.when(fault == "document", F.col("value")).when(fault.isNotNull(), F.to_json("_element")).alias("_content")).hint("rebalance"), "documents")
    rows.where("_kind != 'nothing'").select(
        F.col("_file").alias("file"), F.col("_kind").alias("kind"), F.when(F.col("_kind") != "document", F.col("_position")).alias("position"),
        F.col("_content").alias("content")).write.mode("append").parquet(quarantine)
    return rows.where("_kind IS NULL").select(*[f"`{f.name}`" for f in schema.fields], *parts)


def scan_query(spark: SparkSession, sql: str, args: Mapping[str, object] | Sequence[object] | None = None,
               tables: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Rows of a query with bound parameters (``:name`` or ``?``) over catalog tables or DataFrames."""
    if tables:
        for name, df in tables.items():
            df.createOrReplaceTempView(name)
    return spark.sql(sql, args=args if args is None or isinstance(args, Mapping) else list(args))


def scan_each(spark: SparkSession, params: DataFrame, df: DataFrame, on: Sequence[str]) -> DataFrame:
    """One statement for many parameter sets: the sets are a table, and the lookup a join."""
    return df.join(params, list(on))


def scan_jdbc(spark: SparkSession, url: str, query: str, partition_column: str | None = None,
              bounds: tuple[int, int] | None = None, partitions: int = 16, **options: str) -> DataFrame:
    """Rows of a query in an external database, read by ``partitions`` tasks over the bounds of
    a numeric column; without one the database is read by a single task."""
    reader = spark.read.format("jdbc").option("url", url).options(**options)
    if partition_column is None or bounds is None:
        return reader.option("query", query).load()
    return (
        reader.option("dbtable", f"({query}) q").option("partitionColumn", partition_column)
        .option("lowerBound", bounds[0]).option("upperBound", bounds[1]).option("numPartitions", partitions).load()
    )


def list_dataset(spark: SparkSession, path: str) -> DataFrame:
    """Path and length of every file below a path; file contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", "length")


def extraction_stats(raw: DataFrame) -> DataFrame:
    """Records per year and endpoint, per year, and overall (nulls mark the totals)."""
    per = raw.groupBy("year", "endpoint").agg(F.count(F.lit(1)).alias("n"))
    return per.rollup("year", "endpoint").agg(
        F.sum("n").alias("total_records"), F.count(F.lit(1)).alias("endpoints_processed")
    )

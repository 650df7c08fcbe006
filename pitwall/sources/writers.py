"""Writing files, partitioned datasets and landing directories."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitwall.operators.clean import tag_metadata
from pitwall.session import stage
from pitwall.sources.readers import FORMATS, list_dataset, path_exists
from pitwall.sources.swap import drop_folders, recover, replace


# Text formats would otherwise cut timestamps to milliseconds.
MICROSECONDS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}

LANDED_ROWS = 500_000  # of a compressed text file


def with_date_parts(df: DataFrame, date_col: str = "date") -> DataFrame:
    return df.withColumns({"year": F.year(date_col), "month": F.month(date_col), "day": F.dayofmonth(date_col)})


def write_files(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Save as Parquet, CSV with a header, or one JSON record per line."""
    if fmt not in FORMATS:
        raise ValueError(f"unsupported format {fmt!r}; one of {FORMATS}")
    writer = df.write.mode(mode)
    if fmt != "parquet":
        writer = writer.options(**MICROSECONDS)
    (writer.option("header", True) if fmt == "csv" else writer).format(fmt).save(path)


def write_partitioned(df: DataFrame, path: str, cols: Sequence[str] = ("year", "month", "day"),
                      mode: str = "overwrite") -> None:
    """Save under Hive-style directories, replacing only those that receive rows.

    The rebalance hint brings rows of one directory together, so that it gets few files,
    and splits a large one over several tasks by size.
    """
    (
        df.hint("rebalance", *cols).write.mode(mode).option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy").partitionBy(*cols).parquet(path)
    )


def land(df: DataFrame, root: str, endpoint: str, extracted_at: Column, fmt: str = "parquet") -> None:
    """Append fetched rows, which carry their ``year``, below ``year=/endpoint=``.

    Text repeats every field's name in every row, so it is landed compressed. Such a file is read by one task; it ends at LANDED_ROWS.
    """
    tagged = tag_metadata(df, endpoint, extracted_at).withColumn("endpoint", F.lit(endpoint))
    writer = tagged.write.mode("append").partitionBy("year", "endpoint")
    text = {**MICROSECONDS, "compression": "gzip", "maxRecordsPerFile": LANDED_ROWS}
    (writer if fmt == "parquet" else writer.options(**text)).format(fmt).save(root)


def write_processed(df: DataFrame, root: str, endpoint: str) -> None:
    """Replace the years present in one endpoint's processed table."""
    write_partitioned(df, f"{root}/{endpoint}", ["year"])


def write_clustered(df: DataFrame, path: str, partition_by: Sequence[str], cluster_by: Sequence[str],
                    files: int | None = None) -> None:
    """Save with rows ordered by ``cluster_by`` across and within files.

    Range partitions keep each file to a narrow span of keys, so the Parquet min/max
    values let a keyed read skip most files and row groups.  A hash of the row comes last
    in the range, so that the rows of one very common key can still be split.
    """
    spread = [*partition_by, *cluster_by]
    ranges = [*[F.col(c) for c in spread], F.xxhash64(*df.columns)]
    ranged = df.repartitionByRange(files, *ranges) if files else df.repartitionByRange(*ranges)
    writer = ranged.sortWithinPartitions(*spread).write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def _ordinal(df: DataFrame, column: str) -> Column:
    """A number that orders as the column does; text by its first seven bytes."""
    kind, c = df.schema[column].dataType, F.col(f"`{column}`")
    if isinstance(kind, T.StringType):
        return F.conv(F.rpad(F.hex(F.substring(F.encode(c, "UTF-8"), 1, 7)), 14, "0"), 16, 10).cast("long")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp"))
    return F.unix_date(c) if isinstance(kind, T.DateType) else c.cast("int") if isinstance(kind, T.BooleanType) else c


def _rank(value: Column, bounds: Sequence[tuple], reached: int = 0) -> Column:
    """How many bounds the value has reached, by halving; 0 for null. ``bounds`` are ascending, each with the number up to it."""
    if not bounds:
        return F.lit(reached)
    half = len(bounds) // 2
    bound, upto = bounds[half]
    return F.when(value >= F.lit(bound), _rank(value, bounds[half + 1 :], upto)).otherwise(_rank(value, bounds[:half], reached))


def z_value(df: DataFrame, columns: Sequence[str], bits: int = 6) -> Column:
    """The place of a row on the Z-curve over the columns: the bits of its ranks in turn, the first column's first.

    A rank is one of 2**bits of about equal numbers of rows; their bounds come from one pass of mergeable
    quantile sketches, so the driver gets 2**bits numbers a column. A common value takes several bounds, so that the ranks of few values
    are far apart, and their high bits tell.
    """
    if bits * len(columns) > 62:
        raise ValueError("the bits of all columns must fit one number")
    shares = [k / 2**bits for k in range(1, 2**bits)]
    found = df.agg(*[F.percentile_approx(_ordinal(df, c), shares, 10_000).alias(f"b{j}") for j, c in enumerate(columns)]).first()
    z = F.lit(0).cast("long")
    for j, c in enumerate(columns):
        bounds = found[j] or []
        rank = _rank(_ordinal(df, c), [(b, k + 1) for k, b in enumerate(bounds) if bounds[k + 1 : k + 2] != [b]])
        for k in range(bits):
            bit = F.shiftright(rank, k).bitwiseAND(1).cast("long")
            z = z.bitwiseOR(F.shiftleft(bit, k * len(columns) + len(columns) - 1 - j))
    return z


def write_zordered(df: DataFrame, path: str, columns: Sequence[str], files: int | None = None, bits: int = 6,
                   partition_by: Sequence[str] = ()) -> None:
    """Save with rows ordered along the Z-curve over ``columns``, so that a look-up on any one of them skips most files.

    A file covers a piece of the curve, hence a narrow span of each column, and the Parquet min/max values tell. A linear
    order (``write_clustered``) serves its leading columns only. The rows of one place on the curve can still be split, by a hash.
    """
    placed = df.withColumn("_z", z_value(df, columns, bits))
    ranges = [*[F.col(c) for c in partition_by], F.col("_z"), F.xxhash64(*df.columns)]
    ranged = placed.repartitionByRange(files, *ranges) if files else placed.repartitionByRange(*ranges)
    writer = ranged.sortWithinPartitions(*partition_by, "_z").drop("_z").write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def compact(spark: SparkSession, path: str, partition_by: Sequence[str] = (), files: int | None = None) -> None:
    """Rewrite many small files as few.

    Without ``files`` the number follows from the data size.  The new files are complete
    before the old ones go; after a failure run it again.
    """
    recover(spark, path, partition_by)
    replace(spark.read.parquet(path), path, partition_by, files)


def bins(files: DataFrame, target: int) -> DataFrame:
    """(folder, path, length, bin) of those of ``files`` (folder, path, length) worth rewriting: first fit, the largest first.

    Only files of less than half of ``target`` bytes are small. A bin holds files of one folder of ``target`` bytes at most; bins of a single file
    are left out, as there is nothing to join. A folder's small files are packed in one task.
    """

    def packed(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "path"], ascending=[False, True]).reset_index(drop=True)
        room: list[int] = []
        taken = []
        for length in group["length"].tolist():
            at = next((k for k, left in enumerate(room) if left >= length), len(room))
            if at == len(room):
                room.append(target)
            room[at] -= length
            taken.append(at)
        group["bin"] = taken
        return group[group.groupby("bin")["bin"].transform("size") > 1]

    small = files.where(F.col("length") < target / 2)
    return small.groupBy("folder").applyInPandas(packed, "folder string, path string, length long, bin int")


def compact_small(spark: SparkSession, path: str, partition_by: Sequence[str] = (), target: int = 128 << 20) -> DataFrame:
    """Join the small files of a Parquet table into files of about ``target`` bytes; large files are neither read nor touched.

    Returns (folder, files, bytes) of what was joined. Spark appends the new files; only after its commit the small ones they were read
    from go. What an interrupted run left is put right by the next: a list beside the table names the files there were. If all the
    small ones are still there, the new ones go, else the rest of the small ones. One writer at a time; between the commit and the end a reader
    sees rows twice. The driver holds the names of small files only.
    """
    notes = f"{path.rstrip('/').rpartition('/')[0]}/_compact_{path.rstrip('/').rpartition('/')[2]}"
    folder = F.regexp_extract("path", "^(.*)/[^/]*$", 1)

    def listed() -> DataFrame:
        name = F.regexp_extract("path", "([^/]*)$", 1)
        return list_dataset(spark, path).where(~name.rlike("^[_.]")).select(folder.alias("folder"), "path", "length")

    if path_exists(spark, f"{notes}/_SUCCESS"):
        known = spark.read.parquet(notes)
        gone = known.where("bin IS NOT NULL").join(listed().select("path"), "path", "left_anti").isEmpty()
        rest = listed().join(known.select("path"), "path", "left_anti") if gone else known.where("bin IS NOT NULL")
        drop_folders(spark, [r["path"] for r in rest.select("path").collect()])
    drop_folders(spark, [notes])
    found = stage(listed(), "files")
    chosen = stage(bins(found, target), "bins")
    names = [r["path"] for r in chosen.select("path").collect()]
    done = chosen.groupBy("folder").agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
    if not names:
        return done
    found.join(chosen.select("path", "bin"), "path", "left").write.parquet(notes)
    reader = spark.read.option("basePath", path) if partition_by else spark.read
    rows = reader.schema(spark.read.parquet(path).schema).parquet(*names).withColumn("_path", F.col("_metadata.file_path"))
    place = F.broadcast(chosen.select(F.regexp_replace("path", "^file:/+", "/").alias("_from"), F.concat_ws("/", "folder", F.col("bin").cast("string")).alias("_bin")))
    placed = rows.join(place, F.regexp_replace("_path", "^file:/+", "/") == F.col("_from")).drop("_path", "_from")
    n = chosen.select("folder", "bin").distinct().count()
    writer = placed.repartition(n, "_bin").sortWithinPartitions("_bin").drop("_bin").write.mode("append").option("compression", "snappy")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    drop_folders(spark, names)
    drop_folders(spark, [notes])
    return done

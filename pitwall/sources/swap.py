"""Replacing partitions of a Parquet table so that a failure at any moment loses no rows.

The new rows are written in full beside the table first. Spark's success file commits that copy; only then does one overwrite of the
partitions it has rows for put them in place, and the copy goes. A writer that finds a committed copy puts it in place
again, before it reads the table: an overwrite that is done twice has the same result. So a job that is simply run again
starts from the last whole version. One writer at a time; a reader sees what Spark's overwrite shows it.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


class Copies:
    """The copies beside a table: a few calls to the file system, however many files the table has."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        parent, _, name = path.rstrip("/").rpartition("/")
        self.spark, self.folder = spark, f"{parent}/_next_{name}"
        self.jvm = spark.sparkContext._jvm
        self.fs = self._path(self.folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, text: str):
        return self.jvm.org.apache.hadoop.fs.Path(text)

    def new(self) -> str:
        return f"{self.folder}/{uuid.uuid4().hex}"

    def committed(self) -> list[str]:
        """Copies that were written in full."""
        if not self.fs.exists(self._path(self.folder)):
            return []
        found = [f"{self.folder}/{s.getPath().getName()}" for s in self.fs.listStatus(self._path(self.folder))]
        return [f for f in found if self.fs.exists(self._path(f"{f}/_SUCCESS"))]

    def remove(self) -> None:
        self.fs.delete(self._path(self.folder), True)


def has_data(spark: SparkSession, path: str, partition_by: Sequence[str] = ()) -> bool:
    """Whether a table with data files is at the path; a change that was committed is finished first."""
    recover(spark, path, partition_by)
    try:
        spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return False
    return True


def recover(spark: SparkSession, path: str, partition_by: Sequence[str] = ()) -> None:
    """Finish a committed change that was interrupted, and drop what an uncommitted one left."""
    copies = Copies(spark, path)
    for copy in copies.committed():  # one at most
        _put(spark, copy, path, partition_by)
    copies.remove()


def replace(df: DataFrame, path: str, partition_by: Sequence[str] = (), files: int | None = None) -> None:
    """Make ``df`` the content of those partitions of the table at ``path`` that it has rows for.

    Without ``partition_by`` the whole table is replaced, in ``files`` files if that is given. ``df`` may read the table itself. The
    caller has finished earlier changes (``recover``, ``has_data``).
    """
    copies = Copies(df.sparkSession, path)
    copy = copies.new()
    df.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(copy)
    _put(df.sparkSession, copy, path, partition_by, files)
    copies.remove()


def _put(spark: SparkSession, copy: str, path: str, partition_by: Sequence[str], files: int | None = None) -> None:
    """One overwrite from a committed copy; rows of a partition come together, and large ones are split by size."""
    rows = spark.read.parquet(copy)
    rows = rows.repartition(files) if files else rows.hint("rebalance", *partition_by)
    writer = rows.write.mode("overwrite").option("compression", "snappy").option("partitionOverwriteMode", "dynamic")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def drop_folders(spark: SparkSession, folders: Sequence[str]) -> None:
    """Remove partitions that have no rows any more."""
    for folder in folders:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

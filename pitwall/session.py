"""Session settings the library relies on, and the shared working folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that change results or plans; everything else is left to the cluster.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else started."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(app: str = "pitwall", cores: str = "*", memory: str = "8g") -> SparkSession:
    """A single-machine session for tests, the bench and trying things out."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="pitwall-"))
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    That is ``spark.checkpoint.dir``; where it is not set, a folder of the warehouse, which the
    executors of a session share as well, unless it is a machine's own: then a cluster must set it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        if not re.match(r"(?!file:)[A-Za-z0-9+.-]+:", warehouse) and not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir is not set, and the warehouse is a local folder: executors share no place to write to")
        root = f"{warehouse.rstrip('/')}/_work"
    return root.rstrip("/")


def work_dir(spark: SparkSession, label: str) -> str:
    """A new, never reused path below the shared folder."""
    app = spark.sparkContext.applicationId
    return f"{shared_root(spark)}/pitwall/{app}/{label}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write a result to the shared folder and go on from there.

    For results several later steps read: they are computed once, the plan behind them is
    cut, and a lost executor costs a re-read.
    """
    path = work_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

"""Sharding by a two-pass external shuffle, in DataFrame functions only.

Pass one scatters the rows over buckets of bounded size by a seeded hash, shuffles each bucket in memory (Spark's
``shuffle`` of an array is Fisher-Yates) and writes it. Pass two counts the written buckets, so that the order of the
buckets and the order in them make one random order of all rows, and cuts it into shards of equal row counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitwall.session import stage, work_dir

BUCKET_BYTES = 16 << 20
SHARDS = 40
COPIES = 1024
MANY = 1_000_000  # rows of two numbers


def shuffle_shards(docs: DataFrame, path: str, shards: int = SHARDS, seed: int = 7,
                   bucket_bytes: int = BUCKET_BYTES, text: str = "text") -> DataFrame:
    """Write all rows of ``docs`` below ``path`` in random order and return them with their shard and slot.

    Added columns: ``shard`` (0 to shards - 1) and ``slot`` (place in the shard, gapless from 0); an input column of such a
    name is replaced. Shard s has the places from s * N / shards on, so row counts differ by one at most; with fewer rows
    than shards some shards stay empty, and an empty table gives an empty table. Every row is kept, whatever is null in it
    and however often it is repeated.

    A row's bucket and its draw are hashes of the seed and of the whole row, so the same rows in other partitions or after a retry get the
    same order. No source or group of copies fills a bucket, as their rows differ; rows that are repeated in full more than COPIES
    times are found first, and dealt out by a random number as well: which copy is which then makes no difference. A very long text
    makes its bucket larger by its own length only. There may be 100,000 tasks at most; with more buckets a task has several.

    Rows are shuffled once, between the passes they are read from the written buckets, which a lost executor cannot
    change, and the shards are written below ``path`` as folders. The buckets' starts are a number each and go to the tasks.
    """
    spark = docs.sparkSession
    kept = [c for c in docs.columns if c not in ("shard", "slot")]
    whole = F.struct(*[F.col(f"`{c}`") for c in kept])
    total = docs.agg(F.sum(F.coalesce(F.octet_length(text), F.lit(0)) + 64)).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))
    rows = docs.select(whole.alias("row"), F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in kept]).alias("draw"))
    many = stage(rows.groupBy("draw").agg(F.count("*").alias("n")).where(F.col("n") > COPIES).select("draw", F.lit(1).alias("many")), "copies")
    if (n := many.count()):
        rows = rows.join(F.broadcast(many) if n <= MANY else many, "draw", "left")
        rows = rows.select("row", F.when(F.col("many").isNull(), F.col("draw")).otherwise(F.xxhash64("draw", F.rand(seed))).alias("draw"))
    (rows.withColumn("bucket", F.pmod(F.xxhash64("draw", F.lit(seed)), F.lit(buckets)))
     .repartition(min(buckets, 100_000), "bucket").sortWithinPartitions("bucket", "draw")
     .groupBy("bucket").agg(F.shuffle(F.collect_list("row"), F.lit(seed)).alias("rows"))
     .select("bucket", F.posexplode("rows").alias("place", "row"))
     .write.parquet(f"{path}/buckets"))
    written = spark.read.parquet(f"{path}/buckets")
    sizes = stage(written.groupBy("bucket").agg(F.count("*").alias("n"), F.expr("any_value(bucket div 1000)").alias("thousand")), "sizes")
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    thousands = sizes.groupBy("thousand").agg(F.sum("n").alias("all")).select(
        "thousand", F.coalesce(F.sum("all").over(before.orderBy("thousand")), F.lit(0)).alias("base"))  # a row for a thousand buckets
    starts = sizes.join(F.broadcast(thousands), "thousand").select(
        "bucket", (F.col("base") + F.coalesce(F.sum("n").over(before.partitionBy("thousand").orderBy("bucket")), F.lit(0))).alias("start"))
    placed = written.join(F.broadcast(starts) if buckets <= MANY else starts, "bucket").withColumn("place", F.col("place") + F.col("start"))
    count = sizes.agg(F.sum("n")).first()[0] or 0
    cut(placed, count, shards).select("row", "slot", "shard").write.partitionBy("shard").parquet(f"{path}/shards")
    back = placed.select("row").schema
    read = spark.read.schema(back.add("slot", "long").add("shard", "integer")).parquet(f"{path}/shards")
    return read.select(*[F.col(f"row.`{c}`") for c in kept], "shard", "slot")


def cut(placed: DataFrame, rows: int, shards: int) -> DataFrame:
    """Shard and slot of each of the places 0 to rows - 1, in whole numbers."""
    shard = F.expr(f"place * {shards}L div {max(1, rows)}L")
    slot = F.col("place") - F.expr(f"(shard * {rows}L + {shards - 1}L) div {shards}L")
    return placed.withColumn("shard", shard).withColumn("slot", slot).withColumn("shard", F.col("shard").cast("int"))


def op9_external_shuffle(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    placed = shuffle_shards(docs, work_dir(spark, "shards"))
    text = F.coalesce(F.col("text"), F.lit(""))
    return placed.select(
        "doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )

"""The shuffle's order follows from the seed and the rows alone, however they are cut into partitions."""

from collections import Counter

from pyspark.sql import functions as F

from pitwall.llm import sharding
from pitwall.session import work_dir


def placed(docs, spark, **more):
    out = sharding.shuffle_shards(docs, work_dir(spark, "s"), shards=5, bucket_bytes=20_000, **more).collect()
    return {(r.shard, r.slot): (r.doc_id, r.text) for r in out}


def test_same_rows_same_order(spark):
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.md5((F.col("id") % 700).cast("string"))).alias("text"))
    three, five, other = (placed(docs.repartition(n), spark, seed=s) for n, s in ((3, 7), (5, 7), (3, 8)))
    assert three == five and len(three) == 2000
    assert sum(three[k] == other[k] for k in three) < 40
    assert sum(three[k][0] < three[k2][0] for k, k2 in zip(sorted(three), sorted(three)[1:], strict=False)) in range(900, 1100)


def test_rows_repeated_in_full_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(sharding, "COPIES", 50)
    docs = spark.range(900).select(F.when(F.col("id") < 600, 1).otherwise(F.col("id")).alias("doc_id"), F.when(F.col("id") < 600, "x" * 100).otherwise("y").alias("text"))
    path = work_dir(spark, "s")
    out = sharding.shuffle_shards(docs, path, shards=4, bucket_bytes=4_000).collect()
    assert Counter(r.shard for r in out) == {k: 225 for k in range(4)}
    assert sum(r.doc_id == 1 for r in out) == 600 and sorted((r.shard, r.slot) for r in out) == [(s, k) for s in range(4) for k in range(225)]
    most = spark.read.parquet(f"{path}/buckets").groupBy("bucket").count().agg(F.max("count")).first()[0]
    assert most < 100
    assert len(spark.read.format("binaryFile").load(f"{path}/shards").select(F.regexp_extract("path", "shard=([0-9]+)", 1)).distinct().collect()) == 4

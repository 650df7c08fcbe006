"""Sources of columns, read off plans."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from pitwall.operators.lineage import column_edges, named
from pitwall.plans import lineage


def tables(spark):
    return named({"a": spark.createDataFrame([], "k int, x double, y double, list array<int>"), "b": spark.createDataFrame([], "k int, z string, w int")})


def test_edges(spark):
    t = tables(spark)
    joined = t["a"].join(t["b"], "k").where("w > 3")
    df = joined.groupBy("k", "z").agg((F.sum("x") + F.max("y")).alias("total"), F.lit(1).alias("one"))
    df = df.withColumn("place", F.rank().over(Window.partitionBy("z").orderBy("total"))).select(F.upper("z").alias("name"), "total", "one", "place")
    got = column_edges(df, {"a", "b"})
    assert [e for e in got if e[0]] == [("name", "b", "z"), ("place", "a", "x"), ("place", "a", "y"), ("place", "b", "z"), ("total", "a", "x"), ("total", "a", "y")]
    assert {e[1:] for e in got if e[0] is None} == {("a", "k"), ("b", "k"), ("b", "w"), ("b", "z")}


def test_edges_through_unions_arrays_rollups_and_self_joins(spark):
    t = tables(spark)
    both = t["a"].select("k", F.col("x").alias("v")).unionByName(t["b"].select("k", F.col("w").cast("double").alias("v")))
    assert [e for e in column_edges(both, {"a", "b"})] == [("k", "a", "k"), ("k", "b", "k"), ("v", "a", "x"), ("v", "b", "w")]
    each = t["a"].select(F.explode("list").alias("item"))
    assert column_edges(each, {"a"}) == [("item", "a", "list")]
    rolled = t["a"].rollup("k", "y").agg(F.sum("x").alias("s")).select("k", "y", "s")
    assert [e for e in column_edges(rolled, {"a"}) if e[0]] == [("k", "a", "k"), ("s", "a", "x"), ("y", "a", "y")]
    other = t["a"].select(F.col("k").alias("k2"), F.col("y").alias("y2"))
    pairs = t["a"].join(other, F.col("k") == F.col("k2")).select("x", "y2")
    assert [e for e in column_edges(pairs, {"a"}) if e[0]] == [("x", "a", "x"), ("y2", "a", "y")]
    assert column_edges(t["a"].select(F.lit(2).alias("two")), {"a"}) == []


def test_products(spark):
    up = lineage.upstream(spark)
    assert up["driver_championship_standings"] == ["grand_prix_results"] and up["lake_laps"] == ["raw_laps"]
    assert "raw_pit" in up["grand_prix_performance"] and "raw_pit" not in up["grand_prix_results"]

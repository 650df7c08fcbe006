"""Approximate nearest neighbours: a hierarchical navigable small-world graph for each shard, results merged.

Equal vectors are one node of a graph. Shards have a bounded number of nodes; a shard's graph is stored as flat arrays of
neighbours in one row. Every block of queries meets every shard, and the best of all shards are taken.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitwall.llm.packing import pack, unpack
from pitwall.session import stage

SHARD_NODES = 4096
QUERY_BLOCK = 512
NEIGHBOURS = 16  # of a node in the upper layers; twice as many in the lowest
BUILD_WIDTH = 64
SEARCH_WIDTH = 96


class Graph:
    """Layers of neighbours over unit vectors; nodes are entered one by one."""

    def __init__(self, unit: np.ndarray, top: np.ndarray, links: list[np.ndarray] | None = None, entry: int = -1) -> None:
        self.unit, self.top, self.entry = unit, top, entry
        layers = int(top.max(initial=0)) + 1
        # Rows of the upper layers are kept for all nodes while building; they are cut to the nodes there when stored.
        self.links = links or [np.full((len(unit), NEIGHBOURS * (2 if k == 0 else 1)), -1, np.int32) for k in range(layers)]
        self.seen = np.zeros(len(unit), np.int64)
        self.turn = 0

    def search(self, query: np.ndarray, starts: list[tuple[float, int]], width: int, layer: int) -> list[tuple[float, int]]:
        """The nearest nodes that a best-first walk of the given width finds, nearest first."""
        links, unit, seen = self.links[layer], self.unit, self.seen
        self.turn += 1
        seen[[i for _, i in starts]] = self.turn
        queue = [(-s, i) for s, i in starts]
        best = list(starts)
        heapq.heapify(queue)
        heapq.heapify(best)
        while queue:
            s, node = heapq.heappop(queue)
            if -s < best[0][0] and len(best) >= width:
                break
            near = links[node]
            near = near[near >= 0]
            near = near[seen[near] != self.turn]
            if not len(near):
                continue
            seen[near] = self.turn
            worst = best[0][0]
            for s, i in zip((unit[near] @ query).tolist(), near.tolist(), strict=True):
                if len(best) < width:
                    heapq.heappush(best, (s, i))
                    heapq.heappush(queue, (-s, i))
                    worst = best[0][0]
                elif s > worst:
                    heapq.heapreplace(best, (s, i))
                    heapq.heappush(queue, (-s, i))
                    worst = best[0][0]
        return sorted(best, reverse=True)

    def spread(self, nodes: np.ndarray, similar: np.ndarray, most: int) -> np.ndarray:
        """Of nodes sorted by similarity, those not more similar to one already chosen; filled up with the nearest others."""
        if len(nodes) <= most:
            return nodes
        among = self.unit[nodes] @ self.unit[nodes].T
        cover = np.full(len(nodes), -2.0, np.float32)
        chosen: list[int] = []
        for k in range(len(nodes)):
            if cover[k] < similar[k]:
                chosen.append(k)
                if len(chosen) == most:
                    break
                np.maximum(cover, among[k], out=cover)
        if len(chosen) < most:
            taken = set(chosen)
            chosen += [k for k in range(len(nodes)) if k not in taken][: most - len(chosen)]
        return nodes[chosen]

    def link(self, node: int, new: int, layer: int) -> None:
        row = self.links[layer][node]
        free = np.flatnonzero(row < 0)
        if len(free):
            row[free[0]] = new
            return
        nodes = np.r_[row, np.int32(new)]
        similar = self.unit[nodes] @ self.unit[node]
        by = np.argsort(-similar, kind="stable")
        row[:] = self.spread(nodes[by], similar[by], len(row))

    def add(self, node: int) -> None:
        if self.entry < 0:
            self.entry = node
            return
        query, top = self.unit[node], int(self.top[node])
        starts = [(float(self.unit[self.entry] @ query), self.entry)]
        for layer in range(int(self.top[self.entry]), -1, -1):
            if layer > top:
                starts = self.search(query, starts, 1, layer)[:1]
                continue
            starts = self.search(query, starts, BUILD_WIDTH, layer)
            nodes = np.array([i for _, i in starts], np.int32)
            chosen = self.spread(nodes, np.array([s for s, _ in starts], np.float32), NEIGHBOURS)
            self.links[layer][node, : len(chosen)] = chosen
            for other in chosen.tolist():
                self.link(other, node, layer)
        if top > self.top[self.entry]:
            self.entry = node

    def nearest(self, query: np.ndarray, k: int, width: int) -> list[int]:
        starts = [(float(self.unit[self.entry] @ query), self.entry)]
        for layer in range(int(self.top[self.entry]), 0, -1):
            starts = self.search(query, starts, 1, layer)[:1]
        return [i for _, i in self.search(query, starts, max(k, width), 0)[:k]]


def unit_vectors(vectors: np.ndarray) -> np.ndarray:
    wide = vectors.astype(np.float64)
    wide /= np.abs(wide).max(axis=1, keepdims=True)  # so that squares stay in range
    return (wide / np.sqrt((wide * wide).sum(axis=1, keepdims=True))).astype(np.float32)


def scaled(vectors: np.ndarray) -> np.ndarray:
    wide = vectors.astype(np.float64)
    return np.ldexp(wide, -np.frexp(np.abs(wide).max(axis=1, keepdims=True))[1])


def _build(group: pd.DataFrame) -> pd.DataFrame:
    """One row for a shard: its vectors, the ids of each, and the graph's arrays."""
    group = group.sort_values("first")
    vectors = np.stack(group["vector"].to_numpy())
    n = len(vectors)
    draw = np.random.default_rng(11).random(n)
    top = np.floor(-np.log(1.0 - draw) / math.log(NEIGHBOURS)).astype(np.int64)
    graph = Graph(unit_vectors(vectors), top)
    for node in range(n):
        graph.add(node)
    ids = group["ids"].to_list()
    blob = pack(
        vectors=vectors.ravel(), sizes=np.array([len(x) for x in ids], np.int64), ids=np.concatenate(ids).astype(np.int64), top=top,
        entry=np.array([graph.entry], np.int64),
        **{f"links{k}": (x if k == 0 else x[top >= k]).ravel() for k, x in enumerate(graph.links)})
    return pd.DataFrame({"dim": [int(group["dim"].iloc[0])], "shard": [int(group["shard"].iloc[0])], "graph": [blob]})


def cosines(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """In double precision; a row's value does not depend on the other rows.

    Vectors are scaled by a power of two first, which changes no digit and keeps squares in range.
    """
    q, v = scaled(query[None, :])[0], scaled(vectors)
    return (v * q).sum(axis=1) / (math.sqrt((q * q).sum()) * np.sqrt((v * v).sum(axis=1)))


def _search(k: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                vectors, sizes, ids, top, entry, *links = unpack(batch.column(1)[row].as_py())
                dim, n = batch.column(0)[row].as_py(), len(sizes)
                vectors = vectors.reshape(n, dim)
                layers = []
                for layer, x in enumerate(links):
                    own = x.reshape(-1, NEIGHBOURS * (2 if layer == 0 else 1))
                    full = own
                    if layer:
                        full = np.full((n, own.shape[1]), -1, np.int32)
                        full[top >= layer] = own
                    layers.append(full)
                graph = Graph(unit_vectors(vectors), top, layers, int(entry[0]))
                first = np.r_[0, np.cumsum(sizes)]
                queries = batch.column(2)[row].values
                points = queries.field("vector").flatten().to_numpy().reshape(-1, dim)
                units = unit_vectors(points)
                out: tuple[list, list, list] = ([], [], [])
                for query, point, unit in zip(queries.field("query_id").to_pylist(), points, units, strict=True):
                    # All that the walk has found: own rows are among them, and single precision does not tell the nearest apart.
                    nodes = np.array(graph.nearest(unit, max(k + 1, width), width))
                    scores = cosines(point, vectors[nodes])
                    found = [(-s, int(i)) for s, node in zip(scores.tolist(), nodes, strict=True)
                             for i in ids[first[node] : first[node + 1]] if i != query]
                    for s, i in sorted(found)[:k]:
                        out[0].append(query)
                        out[1].append(i)
                        out[2].append(-s)
                yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64())],
                                                 ["query_id", "vec_id", "score"])

    return run


def usable(vector: str) -> Column:
    """Vectors with a direction: all components finite, one at least not zero."""
    v = F.col(vector)
    return v.isNotNull() & (F.size(v) > 0) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0)


def kept_type(df: DataFrame) -> str:
    """Single precision stays so; all other numbers are doubles."""
    return "array<float>" if df.schema["embedding"].dataType.simpleString() == "array<float>" else "array<double>"


def build(vectors: DataFrame, k: int, shard_nodes: int = SHARD_NODES) -> DataFrame:
    """(dim, shard, graph) of all usable rows of ``vectors`` (vec_id, embedding), written to the shared folder.

    A node stands for all rows with its vector and lists the k + 1 smallest ids of them: a search for k needs no more. They are
    picked in the map tasks first, so a vector that most rows have is no large group.
    """
    rows = vectors.where(usable("embedding") & F.col("vec_id").isNotNull()).select("vec_id", F.col("embedding").cast(kept_type(vectors)).alias("vector"))
    smallest = Window.partitionBy("vector").orderBy("vec_id")
    nodes = (rows.distinct().withColumn("place", F.row_number().over(smallest)).where(F.col("place") <= k + 1)
             .groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")))
    nodes = stage(nodes, "nodes")
    sizes = nodes.groupBy(F.size("vector").alias("dim")).agg(F.count("*").alias("n"))
    shards = sizes.select("dim", F.ceil(F.col("n") / shard_nodes).alias("shards"))  # a row for each length of vectors
    total = sum(r["shards"] for r in shards.collect())
    dealt = (nodes.withColumn("dim", F.size("vector")).join(F.broadcast(shards), "dim")
             .select("dim", F.pmod(F.xxhash64("vector"), F.col("shards")).alias("shard"), "vector", "ids", F.col("ids")[0].alias("first")))
    return stage(dealt.repartition(max(1, 2 * total), "dim", "shard").groupBy("dim", "shard")
                 .applyInPandas(_build, "dim int, shard long, graph binary"), "graphs")


def nearest(graphs: DataFrame, queries: DataFrame, k: int = 5, width: int = SEARCH_WIDTH) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows found for each usable row of ``queries`` (query_id, embedding).

    Nearness is the cosine, in double precision on the original vectors; equal ones rank by vec_id, and the row with the query's
    own id is left out. Fewer candidates than k give all of them. Vectors that are null, empty, all zero or not finite take no
    part, and vectors of another length than the query's are no candidates. Of query rows with one id that with the smallest vector
    counts; rows of ``build`` with one id are candidates each. Graphs are walked in single precision. Vectors must have been indexed for at least k. Queries are replicated to the shards in blocks, not one by one.
    """
    asked = (queries.where(usable("embedding") & F.col("query_id").isNotNull())
             .groupBy("query_id").agg(F.min(F.col("embedding").cast(kept_type(queries))).alias("vector")))
    blocks = asked.count() // QUERY_BLOCK + 1
    packed = (asked.groupBy(F.size("vector").alias("dim"), F.pmod(F.xxhash64("query_id"), F.lit(blocks)).alias("block"))
              .agg(F.collect_list(F.struct("query_id", "vector")).alias("queries")))  # about QUERY_BLOCK
    shards = graphs.select("dim", "shard")
    units = stage(packed.join(shards, "dim").select("dim", "shard", "block", "queries"), "blocks")
    found = (graphs.join(units, ["dim", "shard"]).repartition(max(1, 2 * units.count()), "shard", "block").select("dim", "graph", "queries")
             .mapInArrow(_search(k, width), "query_id long, vec_id long, score double"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op2_hnsw(spark: SparkSession, folder: str) -> DataFrame:
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding")
    queries = vectors.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    return nearest(build(vectors, 5), queries, 5)

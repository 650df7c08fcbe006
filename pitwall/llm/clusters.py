"""Centroid clustering on bit planes: exact squared distances from AND and popcount.

A vector of 64 whole numbers is held as its bit planes in two's complement, one unsigned 64-bit number for each plane, with a bit
for each component. A dot product is the sum over pairs of planes of their weights times popcount(a AND b), and a squared
distance follows from three dot products, so every figure is a whole number and no order of rows can change it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitwall.llm.memory import tidy
from pitwall.session import stage

COMPONENTS = 64
SCALE = 256
CLUSTERS = 40
ROUNDS = 5
LARGEST = 1 << 27  # beyond this a squared distance may not fit a long
SLICE_ROWS = 4096
SUMS = [f"s{j}" for j in range(COMPONENTS)]


def whole_numbers(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, numbers) of the usable rows of ``vectors`` (vec_id, embedding): floor(scale * x) of each component.

    Usable are vectors of exactly 64 components, none null or not finite, and none that is 2**27 or more when scaled, whose
    distances would leave the range of a long. Rows without a vec_id and repeated rows are vectors like others.
    """
    x = F.col("embedding").cast("array<double>")
    scaled = F.transform(x, lambda c: F.floor(c * F.lit(float(scale))))
    fits = (F.size(x) == COMPONENTS) & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float(LARGEST) / scale))
    return vectors.where(F.coalesce(fits, F.lit(False))).select("vec_id", scaled.cast("array<long>").alias("numbers"))


def packed(numbers: np.ndarray, planes: int) -> np.ndarray:
    """(rows, planes) of uint64 from (rows, 64) of int64; plane p has bit j where component j has bit p in two's complement."""
    shifts = np.arange(planes, dtype=np.int64)[None, :, None]
    bits = (numbers[:, None, :] >> shifts) & 1
    return np.packbits(bits.astype(np.uint8), axis=2, bitorder="little").view("<u8")[:, :, 0]


def weights(planes: int) -> np.ndarray:
    """What a bit of each plane is worth; the last one is the sign."""
    w = np.int64(1) << np.arange(planes, dtype=np.int64)
    w[-1] = -w[-1]
    return w


def unpacked(bits: np.ndarray) -> np.ndarray:
    """The (rows, 64) numbers of (rows, planes) bit planes."""
    rows, planes = bits.shape
    apart = np.unpackbits(np.ascontiguousarray(bits).astype("<u8").view(np.uint8).reshape(rows, planes, 8), axis=2, bitorder="little")
    return np.einsum("p,rpj->rj", weights(planes), apart.astype(np.int64))


def dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact dot products of rows of bit planes, broadcast over all but the last axis."""
    out = np.zeros(np.broadcast_shapes(a.shape[:-1], b.shape[:-1]), np.int64)
    for p, wp in enumerate(weights(a.shape[-1]).tolist()):
        for q, wq in enumerate(weights(b.shape[-1]).tolist()):
            out += np.bitwise_count(a[..., p] & b[..., q]).astype(np.int64) * (wp * wq)
    return out


def nearest(bits: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row the nearest centroid (the smaller number if equal) and its squared distance."""
    own = dot(centroids, centroids)
    best, least = np.zeros(len(bits), np.int32), np.full(len(bits), np.iinfo(np.int64).max)
    for k in range(len(centroids)):
        part = own[k] - 2 * dot(bits, centroids[k][None, :])
        better = part < least
        best[better], least[better] = k, part[better]
    return best, least + dot(bits, bits)


def _planes_of(batch: pa.RecordBatch, planes: int) -> np.ndarray:
    """The column ``bits`` as (rows, planes); every row has as many."""
    column = batch.column(batch.schema.names.index("bits"))
    return column.flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(len(column), planes)


def _pack(planes: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(len(batch), COMPONENTS)
            parts = [packed(numbers[at : at + SLICE_ROWS], planes) for at in range(0, len(numbers), SLICE_ROWS)]
            flat = pa.array(np.concatenate(parts).reshape(-1).view(np.int64) if parts else np.zeros(0, np.int64))
            offsets = pa.array(np.arange(len(batch) + 1, dtype=np.int32) * planes)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(offsets, flat)], ["vec_id", "bits"])

    return tidy(run)


def _sums(planes: int, centroids: np.ndarray):
    """A task's own sums of each cluster: a row for each cluster at most, however many vectors it has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(len(centroids), np.int64), np.zeros((len(centroids), COMPONENTS), np.int64)
        for batch in batches:
            bits = _planes_of(batch, planes)
            for at in range(0, len(bits), SLICE_ROWS):
                part = bits[at : at + SLICE_ROWS]
                cluster, _ = nearest(part, centroids)
                count += np.bincount(cluster, minlength=len(centroids))
                np.add.at(total, cluster, unpacked(part))
        some = np.flatnonzero(count)
        if len(some):
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(count[some]), *(pa.array(x) for x in total[some].T)], ["cluster", "n", *SUMS])

    return tidy(run)


def _assign(planes: int, centroids: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = _planes_of(batch, planes)
            parts = [nearest(bits[at : at + SLICE_ROWS], centroids) for at in range(0, len(bits), SLICE_ROWS)]
            if parts:
                cluster, distance = (np.concatenate(x) for x in zip(*parts, strict=True))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cluster), pa.array(distance)], ["vec_id", "cluster", "distance"])

    return tidy(run)


def seeds(numbers: DataFrame, clusters: int = CLUSTERS) -> list[list[int]]:
    """The numbers of the first centroids: those of the ``clusters`` vectors with the smallest SHA-256 of ``2:<vec_id>``.

    Rows of one vec_id go by their numbers; rows without one come last.
    """
    order = F.sha2(F.concat(F.lit("2:"), F.col("vec_id").cast("string")), 256)
    first = numbers.select(order.alias("order"), "numbers").orderBy(F.asc_nulls_last("order"), "numbers").limit(clusters)
    return [list(r["numbers"]) for r in first.orderBy(F.asc_nulls_last("order"), "numbers").collect()]


def cluster(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, list[list[int]]]:
    """(vec_id, cluster, distance) of each usable row of ``vectors`` (vec_id, embedding), and the final centroids.

    Lloyd's rounds in whole numbers: every vector goes to the nearest centroid, ties to the smaller number, and a centroid
    becomes the componentwise floor of its vectors' mean; an empty one stays. Fewer vectors than ``clusters`` give as many
    centroids as there are vectors, and an empty table gives an empty one. Other columns of the input are not read.

    Vectors are packed once and written to the shared folder. A round is one pass over the planes that ends in a row for
    each cluster and task; only the sums of each cluster meet, and ``clusters`` times 64 of them reach the driver. So a
    cluster that holds most vectors is no large group, and no vector is shuffled.
    """
    numbers = whole_numbers(vectors, scale)
    held = seeds(numbers, clusters)
    highest = numbers.agg(F.max(F.greatest(F.array_max("numbers"), -1 - F.array_min("numbers")))).first()[0] or 0
    planes = int(highest).bit_length() + 1
    bits = stage(numbers.mapInArrow(_pack(planes), "vec_id long, bits array<long>"), "planes")
    for _ in range(rounds if held else 0):
        now = packed(np.array(held, np.int64), planes)
        sums = bits.mapInArrow(_sums(planes, now), ", ".join(["cluster int", "n long", *(f"{s} long" for s in SUMS)]))
        for r in sums.groupBy("cluster").agg(*[F.sum(c).alias(c) for c in ("n", *SUMS)]).collect():  # a row a cluster
            held[r["cluster"]] = [r[s] // r["n"] for s in SUMS]
    final = packed(np.array(held, np.int64).reshape(-1, COMPONENTS), planes)
    return bits.mapInArrow(_assign(planes, final), "vec_id long, cluster int, distance long"), held


def op11_bit_planes(spark: SparkSession, folder: str) -> DataFrame:
    assigned, centroids = cluster(spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding"))
    assigned = stage(assigned, "assigned")
    named = [(k, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for k, c in enumerate(centroids)]
    names = spark.createDataFrame(named, "cluster int, centroid_sha256 string")
    inertias = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("own"))  # a row a cluster
    total = inertias.agg(F.sum("own").alias("all"))
    figures = inertias.join(F.broadcast(names), "cluster").join(F.broadcast(total))
    return assigned.join(F.broadcast(figures), "cluster").select(
        "vec_id", "cluster", "distance", F.col("own").cast("long").alias("cluster_inertia"), F.col("all").cast("long").alias("inertia"), "centroid_sha256")


def _sql(clusters: int = CLUSTERS, rounds: int = ROUNDS) -> str:
    steps = [f"""
        kept AS MATERIALIZED (
            SELECT row_number() OVER () AS place, vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * {SCALE}) AS BIGINT)) AS v
            FROM embeddings WHERE len(embedding) = {COMPONENTS} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {COMPONENTS}),
        c0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), v) - 1 AS cluster, v FROM kept
            QUALIFY row_number() OVER (ORDER BY sha256('2:' || vec_id), v) <= {clusters})"""]
    for k in range(rounds + 1):
        steps.append(f"""
        a{k} AS MATERIALIZED (
            SELECT place, any_value(vec_id) AS vec_id, any_value(v) AS v, min(far)[2] AS cluster, min(far)[1] AS distance FROM (
                SELECT k.place, k.vec_id, k.v, [list_sum(list_transform(list_zip(k.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))), c.cluster] AS far
                FROM kept k, c{k} c) GROUP BY place)""")
        if k < rounds:
            steps.append(f"""
        c{k + 1} AS MATERIALIZED (
            SELECT c.cluster, coalesce(m.v, c.v) AS v FROM c{k} c LEFT JOIN (
                SELECT cluster, list(mean ORDER BY j) AS v FROM (
                    SELECT cluster, j, (sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS mean
                    FROM (SELECT cluster, unnest(v) AS x, generate_subscripts(v, 1) AS j FROM a{k}) GROUP BY cluster, j) GROUP BY cluster) m USING (cluster))""")
    return f"""WITH {",".join(steps)}
        SELECT a.vec_id, CAST(a.cluster AS INTEGER) AS cluster, CAST(a.distance AS BIGINT) AS distance,
            CAST(sum(a.distance) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia, CAST(sum(a.distance) OVER () AS BIGINT) AS inertia,
            sha256(array_to_string(c.v, ',')) AS centroid_sha256
        FROM a{rounds} a JOIN c{rounds} c USING (cluster)"""


OP11_SQL = _sql()

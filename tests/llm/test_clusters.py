"""Clustering on bit planes against whole-number arithmetic."""

import hashlib
import math
import random
from collections import Counter

import numpy as np

from pitwall.llm import clusters


def brute(rows, k, rounds):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) and abs(x) < 2**27 / 256 for x in v):
            kept.append((i, [math.floor(256 * x) for x in v]))
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))
    held = [v for _, v in order[:k]]

    def assign():
        out = []
        for i, v in kept:
            far = [(sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(held)]
            out.append((i, min(far)[1], min(far)[0]))
        return out

    for _ in range(rounds):
        got = assign()
        for n in range(len(held)):
            own = [v for (_, c, _), (_, v) in zip(got, kept, strict=True) if c == n]
            if own:
                held[n] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    return assign() if held else [], held


def vectors():
    rng = random.Random(4)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(64)]) for i in range(60)]
    rows += [(i, rows[7][1]) for i in range(60, 110)]  # a third of all
    rows += [(110, [0.0] * 64), (111, [1000.5] * 64), (112, [-1000.5] * 64), (113, [1e300] * 64), (None, rows[3][1]), (None, [0.25] * 64),
             (5, [0.5] * 64), (5, [0.5] * 64), (114, None), (115, []), (116, [1.0] * 63), (117, [None] + [1.0] * 63), (118, [float("nan")] + [1.0] * 63),
             (119, [float("-inf")] + [1.0] * 63)]
    return rows


def test_clusters(spark):
    rows = vectors()
    df = spark.createDataFrame([(i, v, "x", "y") for i, v in rows], "vec_id long, embedding array<double>, bits string, cluster string").repartition(7)
    for k, rounds in ((6, 3), (500, 1)):
        got, held = clusters.cluster(df, k, rounds)
        want, final = brute(rows, k, rounds)
        assert held == final
        assert Counter(map(tuple, got.collect())) == Counter(want)


def test_nothing_to_cluster(spark):
    for rows in ([], [(1, None), (2, [1.0])]):
        got, held = clusters.cluster(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
        assert held == [] and got.count() == 0


def test_planes_are_exact():
    rng = np.random.default_rng(1)
    for bits in (1, 5, 28):
        a, b = (rng.integers(-(1 << bits - 1), 1 << bits - 1, (50, 64)) for _ in range(2))
        a[0], b[0] = -(1 << bits - 1), (1 << bits - 1) - 1
        assert (clusters.unpacked(clusters.packed(a, bits)) == a).all()
        assert (clusters.dot(clusters.packed(a, bits), clusters.packed(b, bits)) == (a * b).sum(axis=1)).all()

"""Exact quantiles of groups of any size: no group's values ever meet in one buffer.

A rank is narrowed down by histograms. A round counts the values between the bounds of each group's open ranks in buckets,
combined in the map tasks, and keeps the bucket that holds the rank, with its own smallest and largest value as
the next bounds. The value is found when the two are one. Each round splits the bounds, so rounds end; with values on a grid
two or three are enough.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pitwall.session import stage

BUCKETS = 1024
BROADCAST_ROWS = 200_000


def same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Equal keys; null equals null."""
    out = F.lit(True)
    for k in keys:
        out = out & left[k].eqNullSafe(right[k])
    return out


def _narrowed(counted: DataFrame, held: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """Open ranks (keys, _rank, _before, _lo, _hi) with the bounds of their bucket: ``_before`` values are under ``_lo``."""
    spans = held.select(*[F.col(k).alias(f"_{k}") for k in keys], "_before", "_lo", "_hi").distinct()
    match = F.col("x").between(F.col("_lo"), F.col("_hi"))
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"_{k}"))
    spans = F.broadcast(spans) if held.count() <= BROADCAST_ROWS else spans
    # Halves, so that the difference of two finite numbers is finite.
    width = F.col("_hi") / 2 - F.col("_lo") / 2
    place = F.when(width > 0, F.floor(F.try_divide(F.col("x") / 2 - F.col("_lo") / 2, width) * buckets)).otherwise(F.when(F.col("x") > F.col("_lo"), buckets).otherwise(0))
    groups = [*keys, "_before", "_lo", "_hi"]
    counts = counted.join(spans, match).groupBy(*groups, F.least(place, F.lit(buckets - 1)).alias("_bucket")).agg(
        F.sum("n").alias("_n"), F.min("x").alias("_least"), F.max("x").alias("_most"))
    upto = F.sum("_n").over(W.partitionBy(*groups).orderBy("_bucket").rowsBetween(W.unboundedPreceding, 0))
    cut = counts.withColumn("_upto", F.col("_before") + upto).withColumn("_from", F.col("_upto") - F.col("_n"))
    inside = same(held, cut, groups) & (held["_rank"] >= cut["_from"]) & (held["_rank"] < cut["_upto"])
    return held.join(cut, inside).select(
        *[held[k] for k in keys], held["_rank"], cut["_from"].alias("_before"), cut["_least"].alias("_lo"), cut["_most"].alias("_hi"))


def select_ranks(counted: DataFrame, ranks: DataFrame, keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """(keys, _rank, x): the value at each rank, from 0, of its group.

    ``counted`` (keys, x, n) has how often each value occurs, null and NaN left out, and is read once a round: a staged table is best.
    ``ranks`` is (keys, _rank, _before, _lo, _hi): bounds of the value, and how many values are under the lower one.
    """
    held = stage(ranks, "ranks")
    found = held.where("_lo = _hi")
    while not (rest := held.where("_lo < _hi")).isEmpty():
        held = stage(_narrowed(counted, rest, keys, buckets), "ranks")
        found = found.unionByName(held.where("_lo = _hi"))
    return found.select(*keys, "_rank", F.col("_lo").alias("x"))


def exact_quantiles(counted: DataFrame, keys: Sequence[str], probs: dict[str, float], interpolate: bool = True,
                    buckets: int = BUCKETS) -> DataFrame:
    """(keys, one column for each name in ``probs``): quantiles of each group of ``counted`` (keys, x, n).

    With ``interpolate`` a quantile between two values is taken in proportion; without, it is the smallest value that at least the
    given share of the group does not exceed. Rows whose x is null or NaN, or n not positive, have no say; a group of such rows is left out.
    """
    counted = counted.where(F.col("x").isNotNull() & ~F.isnan("x") & (F.col("n") > 0))
    spans = counted.groupBy(*keys).agg(F.sum("n").alias("_total"), F.min("x").alias("_lo"), F.max("x").alias("_hi"))
    last = F.col("_total") - 1

    def places(p: float) -> list[Column]:
        if not interpolate:
            return [F.greatest(F.ceil(F.lit(p) * F.col("_total")) - 1, F.lit(0).cast("long"))]
        return [F.floor(last * F.lit(p)), F.ceil(last * F.lit(p))]

    spans = stage(spans, "spans")
    wanted = F.array_distinct(F.array(*[x.cast("long") for p in probs.values() for x in places(p)]))
    ranks = spans.select(*keys, F.explode(wanted).alias("_rank"), F.lit(0).cast("long").alias("_before"), "_lo", "_hi")
    at = select_ranks(counted, ranks, keys, buckets).groupBy(*keys).agg(F.map_from_entries(F.collect_set(F.struct("_rank", "x"))).alias("_at"))
    both = spans.join(at.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_at"),
                      F.expr(" AND ".join(f"`{k}` <=> _k{i}" for i, k in enumerate(keys)) or "true"))

    def quantile(p: float) -> Column:
        low, high = (F.col("_at")[x.cast("long")] for x in (places(p) * 2)[:2])
        share = last * F.lit(p) - F.floor(last * F.lit(p))
        return low + (high - low) * share if interpolate else low

    return both.select(*keys, *[quantile(p).alias(name) for name, p in probs.items()])

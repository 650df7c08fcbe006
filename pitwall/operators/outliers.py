"""Outliers by quartiles, exact for groups of any size, from mergeable sketches of each day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwall.operators.quantiles import BROADCAST_ROWS, same, select_ranks
from pitwall.session import stage

SKETCH_K = 400
SLACK = 0.02  # of a rank on either side; a sketch of SKETCH_K is off by less than half of it with a chance of 99 %
QUARTILES = {"q1": 0.25, "q3": 0.75}


def sketches(df: DataFrame, keys: Sequence[str], value: str, day: str, k: int = SKETCH_K) -> DataFrame:
    """(keys, day, sketch, n): a quantile sketch of the values of each group and day.

    Null and NaN have no say. Days can be added one by one, as they come, and any of them merged (``merged``), so a new day does not
    mean reading the old ones.
    """
    x = F.col(value).cast("double")
    return df.where(x.isNotNull() & ~F.isnan(x)).groupBy(*keys, F.to_date(day).alias("day")).agg(
        F.kll_sketch_agg_double(x, F.lit(k)).alias("sketch"), F.count(F.lit(1)).alias("n"))


def merged(days: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, sketch, n) over all days."""
    return days.groupBy(*keys).agg(F.kll_merge_agg_double("sketch").alias("sketch"), F.sum("n").alias("n"))


def quartiles(df: DataFrame, keys: Sequence[str], value: str, day: str, days: DataFrame | None = None) -> DataFrame:
    """(keys, n, q1, q3) of each group: the exact discrete quartiles, those that at least a quarter and three quarters do not exceed.

    The sketches over days bracket each quartile between two values. One pass counts, per group, the values under and inside the brackets;
    only those inside, a few in a hundred, are then counted by value, and the quartile is selected among them by rank. Where a
    sketch was off and the rank is not in its bracket, the bracket is the whole group, so the result is exact in any case.
    ``days`` are the sketches, if they are kept somewhere; they must be of the same rows. ``df`` is read several times: where a join
    or a de-duplication is behind it, a staged table is best.
    """
    keys = list(keys)
    whole = merged(sketches(df, keys, value, day) if days is None else days, keys)
    at = lambda p: F.kll_sketch_get_quantile_double("sketch", F.lit(min(max(p, 0.0), 1.0)))
    brackets = stage(whole.select(*keys, *[at(p + d * SLACK).alias(f"_{q}_{side}") for q, p in QUARTILES.items() for side, d in (("lo", -1), ("hi", 1))]), "brackets")
    brackets = F.broadcast(brackets) if brackets.count() <= BROADCAST_ROWS else brackets
    x = F.col(value).cast("double")
    valued = df.where(x.isNotNull() & ~F.isnan(x)).select(*keys, x.alias("x"))
    near = valued.join(brackets.select(*[F.col(k).alias(f"_{k}") for k in keys], *[c for c in brackets.columns if c not in keys]),
                       F.expr(" AND ".join(f"`{k}` <=> `_{k}`" for k in keys) or "true")).select(*keys, "x", *[c for c in brackets.columns if c not in keys])
    inside = {q: F.col("x").between(F.col(f"_{q}_lo"), F.col(f"_{q}_hi")) for q in QUARTILES}
    counts = near.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.min("x").alias("_least"), F.max("x").alias("_most"),
        *[F.count_if(F.col("x") < F.col(f"_{q}_lo")).alias(f"_{q}_under") for q in QUARTILES], *[F.count_if(inside[q]).alias(f"_{q}_in") for q in QUARTILES],
        *[F.any_value(f"_{q}_{side}").alias(f"_{q}_{side}") for q in QUARTILES for side in ("lo", "hi")])
    wanted = []
    for q, p in QUARTILES.items():
        rank = F.greatest(F.ceil(F.lit(p) * F.col("n")) - 1, F.lit(0).cast("long"))
        holds = (rank >= F.col(f"_{q}_under")) & (rank < F.col(f"_{q}_under") + F.col(f"_{q}_in"))
        wanted.append(F.struct(F.lit(q).alias("q"), rank.alias("_rank"), F.when(holds, F.col(f"_{q}_under")).otherwise(0).alias("_before"),
                               F.when(holds, F.col(f"_{q}_lo")).otherwise(F.col("_least")).alias("_lo"), F.when(holds, F.col(f"_{q}_hi")).otherwise(F.col("_most")).alias("_hi")))
    ranks = stage(counts.select(*keys, "n", F.explode(F.array(*wanted)).alias("r")).select(*keys, "n", "r.*"), "ranks")
    spans = ranks.select(*[F.col(k).alias(f"_{k}") for k in keys], "_lo", "_hi").distinct()
    spans = F.broadcast(spans) if ranks.count() <= BROADCAST_ROWS else spans
    match = F.col("x").between(F.col("_lo"), F.col("_hi")) & F.expr(" AND ".join(f"`{k}` <=> `_{k}`" for k in keys) or "true")
    counted = stage(valued.join(spans, match, "left_semi").groupBy(*keys, "x").agg(F.count(F.lit(1)).alias("n")), "counted")
    found = select_ranks(counted, ranks.select(*keys, "_rank", "_before", "_lo", "_hi"), keys)
    placed = ranks.join(found, same(ranks, found, [*keys, "_rank"])).select(*[ranks[k] for k in keys], "n", "q", found["x"])
    return placed.groupBy(*keys).agg(F.any_value("n").alias("n"), *[F.max(F.when(F.col("q") == q, F.col("x"))).alias(q) for q in QUARTILES])


def outliers(df: DataFrame, keys: Sequence[str], value: str, day: str, reach: float = 1.5, days: DataFrame | None = None,
             found: DataFrame | None = None) -> DataFrame:
    """The rows of ``df`` whose value is more than ``reach`` times the distance between its group's quartiles beyond them, with
    ``q1`` and ``q3``. Null and NaN are no outliers. ``found`` are the ``quartiles`` of ``df``, if they are at hand."""
    keys = list(keys)
    q = (quartiles(df, keys, value, day, days) if found is None else found).select(*[F.col(k).alias(f"_{k}") for k in keys], "q1", "q3")
    x, far = F.col(value).cast("double"), (F.col("q3") - F.col("q1")) * reach
    joined = df.join(q, F.expr(" AND ".join(f"`{k}` <=> `_{k}`" for k in keys) or "true"))
    return joined.where(~F.isnan(x) & ((x < F.col("q1") - far) | (x > F.col("q3") + far))).select(*df.columns, "q1", "q3")

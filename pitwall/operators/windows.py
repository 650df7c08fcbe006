"""Running, relative and neighbour values.

Group-wide values (means, sizes) are aggregated and joined back rather than taken over a
window: partial aggregation then absorbs a group of any size, and the join is on the
small aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def _with_group(df: DataFrame, part: Sequence[str], **aggs: Column) -> DataFrame:
    """Add aggregates of a row's group; null keys form a group of their own."""
    stats = df.groupBy(*part).agg(*[c.alias(n) for n, c in aggs.items()])
    stats = stats.select(*[F.col(p).alias(f"_{p}") for p in part], *aggs)
    on = [F.col(p).eqNullSafe(F.col(f"_{p}")) for p in part]
    return df.join(stats, on).drop(*[f"_{p}" for p in part])


def running_total(df: DataFrame, part: Sequence[str], order_by: Sequence[str | Column], col: str,
                  out: str = "running_total", block: str | None = None) -> DataFrame:
    """Cumulative sum per group, row by row in the order given (ties are not merged).

    ``block`` names a column that rises with the order, such as a day.  Sums are then taken
    within blocks, and each block starts from the total of the earlier ones, so that a long
    group is worked on by as many tasks as it has blocks.  The result is that without blocks:
    null values add nothing, null groups are groups, and a null block comes first.
    """
    if block is None:
        order = W.partitionBy(*part).orderBy(*order_by).rowsBetween(W.unboundedPreceding, W.currentRow)
        return df.withColumn(out, F.sum(col).over(order))
    before = W.partitionBy(*part).orderBy(block).rowsBetween(W.unboundedPreceding, -1)
    keys = list(dict.fromkeys([*part, block]))
    starts = df.groupBy(*keys).agg(F.sum(col).alias("_s")).withColumn("_start", F.sum("_s").over(before))
    starts = starts.select(*[F.col(k).alias(f"_k_{k}") for k in keys], "_start")
    within = W.partitionBy(*keys).orderBy(*order_by).rowsBetween(W.unboundedPreceding, W.currentRow)
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    summed = df.withColumn("_in", F.sum(col).over(within)).join(starts, same)
    # Null only where no value has come yet.
    total = F.coalesce(F.col("_in") + F.col("_start"), "_in", "_start")
    return summed.withColumn(out, total).drop("_in", "_start", *[f"_k_{k}" for k in keys])


def leave_one_out(df: DataFrame, part: Sequence[str], col: str, out: str) -> DataFrame:
    """A row's value minus the mean of the other rows' known values in its group."""
    both = _with_group(df, part, _sum=F.sum(col), _n=F.count(col))
    others = (F.col("_sum") - F.col(col)) / F.nullif(F.col("_n") - 1, F.lit(0))
    return both.withColumn(out, F.col(col) - others).drop("_sum", "_n")


def field_delta(df: DataFrame, part: Sequence[str], col: str, out: str) -> DataFrame:
    """A row's value minus the mean of its group."""
    return _with_group(df, part, _avg=F.avg(col)).withColumn(out, F.col(col) - F.col("_avg")).drop("_avg")


def at_least(df: DataFrame, part: Sequence[str], n: int) -> DataFrame:
    """Rows of groups with ``n`` rows or more."""
    return _with_group(df, part, _size=F.count(F.lit(1))).where(F.col("_size") >= n).drop("_size")


def neighbours(df: DataFrame, part: Sequence[str], order_by: Sequence[str | Column], cols: dict[str, str]) -> DataFrame:
    """Values of the rows before and after in order; ``cols`` maps a column to its base name.

    Adds ``<base>_ahead`` and ``<base>_behind``, and the flags ``has_car_ahead`` and
    ``has_car_behind``.  Meant for groups of the cars of one lap, whose size the entry
    list bounds.
    """
    order = W.partitionBy(*part).orderBy(*order_by)
    one = F.lit(True)
    added = {"has_car_ahead": F.lag(one, 1, False).over(order), "has_car_behind": F.lead(one, 1, False).over(order)}
    for col, base in cols.items():
        added[f"{base}_ahead"] = F.lag(col).over(order)
        added[f"{base}_behind"] = F.lead(col).over(order)
    return df.withColumns(added)

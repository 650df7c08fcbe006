"""Joins the racing questions need beyond a plain equi-join.

All of them stay hash or sort-merge joins on equality keys.  Time and range conditions
get a bucket key, so that one busy car or session spreads over many tasks and no
condition ever compares every pair of rows within a key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from pitwall.functions.scalars import epoch_seconds


def first_match(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column]) -> DataFrame:
    """One row per key, the first in ``order_by``.

    Written as ``row_number() = 1`` directly over the window: Spark then keeps one row per
    key in every task before the shuffle, so a key with very many copies costs no more
    than any other.
    """
    ranked = df.withColumn("_rn", F.row_number().over(W.partitionBy(*keys).orderBy(*order_by)))
    return ranked.where(F.col("_rn") == 1).drop("_rn")


def semi(df: DataFrame, keys_df: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose keys occur in ``keys_df`` (``IN (SELECT ...)``)."""
    return df.join(keys_df, list(on), "left_semi")


def _bucketed(left: DataFrame, right: DataFrame, lt: str, rt: str, seconds: int, width: int):
    """Give both sides a bucket so that rows closer than ``seconds`` meet in exactly one.

    Left rows get their own bucket; right rows are copied to each bucket their
    neighbourhood touches: one, or two near a border (``width >= 2 * seconds``).
    """
    l_sec, r_sec = epoch_seconds(lt), epoch_seconds(rt)
    reach = seconds - 1
    lo, hi = F.floor((F.col("_rs") - reach) / width), F.floor((F.col("_rs") + reach) / width)
    left = left.withColumn("_ls", l_sec).withColumn("_b", F.floor(F.col("_ls") / width))
    right = right.withColumn("_rs", r_sec).withColumn("_b", F.explode(F.sequence(lo, hi)))
    return left, right


def interval_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], lt: str, rt: str, seconds: int,
    bucket: int | None = None,
) -> DataFrame:
    """Inner join of rows with equal keys and times less than ``seconds`` whole seconds apart.

    Every match is kept, so the result may hold several right rows per left row.  Columns
    of the same name on both sides must be renamed beforehand; the keys appear once.
    """
    width = bucket or 8 * seconds
    if width < 2 * seconds:
        raise ValueError("bucket must be at least twice the interval")
    left, right = _bucketed(left, right, lt, rt, seconds, width)
    pairs = left.join(right, [*keys, "_b"])
    return pairs.where(F.abs(F.col("_ls") - F.col("_rs")) < seconds).drop("_ls", "_rs", "_b")


def nearest_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], lt: str, rt: str, seconds: int,
    tie: Sequence[str | Column] = (), bucket: int | None = None,
) -> DataFrame:
    """Left rows with the right row nearest in time, if one is closer than ``seconds``.

    Nearest means by whole-second distance, then the earlier time, then ``tie``.  So the
    answer depends on the key and the second alone: left rows are reduced to their distinct
    seconds and right rows to the first of each second, both before the shuffle.  The last
    right row before a second and the first one after it are then carried along the time
    order within a bucket, which holds no more rows than it has seconds, and the winner is
    joined back to the left rows.
    """
    width = bucket or 8 * seconds
    reach = seconds - 1
    first = first_match(right.withColumn("_sec", epoch_seconds(rt)), [*keys, "_sec"], [F.col(rt), *tie])
    lo, hi = F.floor((F.col("_sec") - reach) / width), F.floor((F.col("_sec") + reach) / width)
    rights = first.select(
        *keys, "_sec", F.struct(*[c for c in right.columns if c not in keys]).alias("_right"),
        F.explode(F.sequence(lo, hi)).alias("_b"),
    )
    timed = left.withColumn("_sec", epoch_seconds(lt))
    lefts = timed.select(*keys, "_sec").distinct().withColumn("_b", F.floor(F.col("_sec") / width))
    rows = lefts.unionByName(rights, allowMissingColumns=True)

    is_left = F.col("_right").isNull()
    seen = F.last(F.when(~is_left, F.struct("_sec", "_right")), ignorenulls=True)
    span = W.partitionBy(*keys, "_b")
    up = span.orderBy("_sec", is_left).rowsBetween(W.unboundedPreceding, W.currentRow)
    down = span.orderBy(F.desc("_sec"), is_left).rowsBetween(W.unboundedPreceding, W.currentRow)
    both = rows.withColumns({"_before": seen.over(up), "_after": seen.over(down)}).where(is_left)
    back, ahead = F.col("_sec") - F.col("_before._sec"), F.col("_after._sec") - F.col("_sec")
    take_after = F.col("_after").isNotNull() & (F.col("_before").isNull() | (ahead < back))
    hits = both.select(
        *keys, "_sec", F.when(take_after, F.col("_after")).otherwise(F.col("_before")).alias("_hit")
    ).where(F.abs(F.col("_hit._sec") - F.col("_sec")) < seconds)
    return timed.join(hits.select(*keys, "_sec", "_hit._right.*"), [*keys, "_sec"]).drop("_sec")


def range_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], point: str, lo: str, hi: str,
    first_by: Sequence[str | Column],
) -> DataFrame:
    """Left rows with the first right row whose ``[lo, hi]`` holds ``point``; nulls if none.

    Points and bounds are whole numbers.  The answer depends on the key and the point alone, so
    it is found once per distinct point and joined back.  A range is cut to the span of its
    key's points and into aligned blocks of a power of 16, 30 of a size at most; a point lies
    in one block of each size.  Ranges of a block are reduced to the first before they meet
    points, so neither long ranges nor copies of a range multiply anything: n points and m
    ranges of a key whose points span s make (n + 30 m) log16 s rows.
    """
    kind = left.schema[point].dataType
    if not isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        raise ValueError(f"{point} is no whole number")
    points = left.where(F.col(point).isNotNull()).select(*keys, point).distinct()
    spans = points.groupBy(*keys).agg(F.min(point).cast("long").alias("_from"), F.max(point).cast("long").alias("_to"))
    # Sizes 16**0 to 16**_top; above that a cut range has no block.
    spans = spans.withColumn("_top", F.ceil(F.log2(F.col("_to") - F.col("_from") + 2) / 4).cast("int"))
    start, end = F.greatest(F.col(lo).cast("long"), F.col("_from")), F.least(F.col(hi).cast("long"), F.col("_to")) + 1
    cut = right.where(F.col(lo) <= F.col(hi)).join(spans, keys).withColumns({"_s": start, "_e": end}).where("_s < _e")
    # Of the whole blocks of a size in the range, those that no larger whole block has: some at either end.
    first, last = "shiftright(_s + shiftleft(1L, 4 * k) - 1, 4 * k)", "shiftright(_e, 4 * k)"
    after, before = f"shiftright({first} + 15, 4) * 16", f"shiftright({last}, 4) * 16"
    run = lambda a, b: f"if({a} < {b}, sequence({a}, {b} - 1), cast(array() as array<bigint>))"
    blocks = F.expr(f"""flatten(transform(sequence(0, _top), k -> transform(
        if({after} < {before}, concat({run(first, after)}, {run(before, last)}), {run(first, last)}), x -> struct(k as size, x as number))))""")
    best = first_match(cut.withColumn("_block", F.explode(blocks)), [*keys, "_block"], first_by).select(*right.columns, "_block")
    asked = points.join(spans, keys).select(*keys, point, F.explode(F.expr(
        f"transform(sequence(0, _top), k -> struct(k as size, shiftright(cast({point} as bigint), 4 * k) as number))")).alias("_block"))
    hits = first_match(asked.join(best, [*keys, "_block"]), [*keys, point], first_by).drop("_block")
    return left.join(hits, [*keys, point], "left")


def orphans(df: DataFrame, parent: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows whose non-null foreign key has no parent row."""
    keys = [key] if isinstance(key, str) else list(key)
    known = parent.select(*keys)
    return df.dropna(subset=keys).join(known, keys, "left_anti")


def star(
    laps: DataFrame, drivers: DataFrame, sessions: DataFrame, meetings: DataFrame,
    literal: bool = False, how: str = "inner",
) -> DataFrame:
    """Timed rows with their driver, session and meeting.

    Drivers are entered per session, so the join is on session and driver; the
    ``literal`` form joins on the driver number alone, as the SQL reports were written,
    and repeats a lap for each session its driver ever entered.
    """
    on = ["driver_number"] if literal else ["session_key", "driver_number"]
    who = drivers.select(*on, "full_name", "team_name")
    when = sessions.select("session_key", "meeting_key", "session_name", "session_type",
                           F.col("date_start").alias("session_start"), F.col("date_end").alias("session_end"))
    where = meetings.select("meeting_key", "meeting_name", "year", "country_name", "circuit_short_name")
    return laps.join(who, on, how).join(when, "session_key").join(where, "meeting_key")


def lookup(df: DataFrame, dim: DataFrame, on: Sequence[str], values: Mapping[str, str]) -> DataFrame:
    """Left join to the first dimension row per key; ``values`` maps its columns to new names."""
    picked = first_match(dim, on, [F.asc_nulls_last(c) for c in values])
    return df.join(picked.select(*on, *[F.col(c).alias(n) for c, n in values.items()]), list(on), "left")

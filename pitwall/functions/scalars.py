"""Column expressions shared by the operators.  All are built-in Spark expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Championship points for places 1 to 10, and one bonus point for the
# fastest lap when its driver finishes in the top 10.
POINTS = (25, 18, 15, 12, 10, 8, 6, 4, 2, 1)
BONUS_TOP = 10


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def points(position: str | Column, is_fastest: str | Column | None = None) -> Column:
    """Points for a finishing position, 0 outside the table or when it is unknown."""
    pos = _c(position)
    table = F.array(*[F.lit(p) for p in POINTS])
    base = F.when(pos.between(1, len(POINTS)), F.get(table, pos.cast("int") - 1)).otherwise(F.lit(0))
    if is_fastest is None:
        return base
    return base + F.when(_c(is_fastest) & pos.between(1, BONUS_TOP), 1).otherwise(0)


def epoch_seconds(c: str | Column) -> Column:
    """Whole seconds since 1970, fractions dropped, for timestamps with or without zone."""
    return F.unix_timestamp(_c(c).cast("timestamp"))


def abs_seconds(a: str | Column, b: str | Column) -> Column:
    """Distance in whole seconds."""
    return F.abs(epoch_seconds(a) - epoch_seconds(b))


def null_or(c: str | Column, cond: Column) -> Column:
    """True where the value is absent or meets the condition."""
    return _c(c).isNull() | cond


def weight_if_present(c: str | Column, weight: float) -> Column:
    return F.when(_c(c).isNotNull(), F.lit(float(weight))).otherwise(F.lit(0.0))


def pct(part: str | Column, whole: str | Column) -> Column:
    """Share times 100; 0 when the base is 0 or absent."""
    return F.coalesce(_c(part) * 100.0 / F.nullif(_c(whole), F.lit(0)), F.lit(0.0))


def ratio(part: str | Column, whole: str | Column) -> Column:
    """Quotient, null when the base is 0."""
    return _c(part) / F.nullif(_c(whole), F.lit(0))


def flag_above(c: str | Column, threshold: float) -> Column:
    """Strictly above a threshold; an absent value counts as no."""
    return F.coalesce(_c(c) > threshold, F.lit(False))


def contains_text(c: str | Column, text: str) -> Column:
    """Case-sensitive containment; an absent value counts as no."""
    return F.coalesce(F.contains(_c(c), F.lit(text)), F.lit(False))


def contains_any_case(c: str | Column, text: str) -> Column:
    return F.coalesce(F.contains(F.lower(_c(c)), F.lit(text.lower())), F.lit(False))


def typed(c: str | Column, kind: str | T.DataType) -> Column:
    """Cast that yields null, never an error, on text that does not fit."""
    return _c(c).try_cast(kind)


def parse_ts(c: str | Column) -> Column:
    """ISO-8601 text to a timestamp, null when it is none."""
    return F.try_to_timestamp(_c(c).cast("string"))


def parse_date(c: str | Column) -> Column:
    """The date of an ISO-8601 text, null when it is none."""
    return F.to_date(parse_ts(c))


def surrogate_id(*parts: str | Column) -> Column:
    """Text id of parts joined by ``_``; null when any part is, so that none goes missing."""
    whole = F.concat_ws("_", *[_c(p).cast("string") for p in parts])
    return F.when(reduce(lambda a, b: a & b, [_c(p).isNotNull() for p in parts]), whole)


def stamp(ts: str | Column) -> Column:
    """Label of a moment as used in file names."""
    return F.date_format(_c(ts), "yyyyMMdd_HHmmss")


def hash_bucket(c: str | Column, n: int) -> Column:
    """Bucket 1..n of a value, the same in every process."""
    return F.pmod(F.xxhash64(_c(c)), F.lit(n)) + 1


def tyre_age(age_at_start: str | Column, lap: str | Column, first_lap: str | Column) -> Column:
    return _c(age_at_start) + _c(lap) - _c(first_lap)


def missing_names(columns: list[str]) -> Column:
    """Names of the columns that are null in a row."""
    return F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in columns]))

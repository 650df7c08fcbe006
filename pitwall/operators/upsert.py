"""Insert-or-update by key, for tables without MERGE support."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pitwall.operators.joins import first_match
from pitwall.session import stage
from pitwall.sources.swap import drop_folders, has_data, replace

LITERALS = 500  # partitions named in a filter


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column],
           update_cols: Sequence[str] | None = None) -> DataFrame:
    """The target after merging a batch: matched keys updated, new keys inserted.

    Several batch rows of one key count once, the first in ``order_by``.  A null key
    matches nothing, so it is inserted.  ``update_cols`` limits what a match overwrites;
    by default every non-key column.  The batch is normally the small side: Spark then
    broadcasts it, by its size, and the target is not shuffled.
    """
    keys, columns = list(keys), target.columns
    batch = first_match(updates, keys, order_by).select(*columns)
    changed = [c for c in columns if c not in keys] if update_cols is None else list(update_cols)
    if set(changed) == set(columns) - set(keys):
        return target.join(batch.select(*keys), keys, "left_anti").select(*columns).unionByName(batch)
    marked = batch.select(*keys, *[F.col(c).alias(f"_u_{c}") for c in changed], F.lit(True).alias("_hit"))
    updated = target.join(marked, keys, "left").select(*[
        F.when(F.col("_hit"), F.col(f"_u_{c}")).otherwise(F.col(c)).alias(c) if c in changed else F.col(c)
        for c in columns
    ])
    return updated.unionByName(batch.join(target.select(*keys), keys, "left_anti").select(*columns))


def upsert_path(spark: SparkSession, path: str, updates: DataFrame, keys: Sequence[str],
                order_by: Sequence[str | Column], partition_by: Sequence[str] = (),
                update_cols: Sequence[str] | None = None, ranked: bool = False) -> None:
    """Upsert a batch into a Parquet table, reading and rewriting only the partitions it touches.

    Partition columns must be keys, so that a row never changes partition.  The batch is
    saved first, as it is read several times.  Its partitions prune the scan of the table
    (``touched_rows``).  The rewritten partitions replace the old ones by ``swap``: after a
    failure at any point, run the same batch again.

    With ``ranked`` the stored row of a key takes part in ``order_by``: the result is then
    the same however rows are dealt out over batches.
    """
    keys, parts = list(keys), list(partition_by)
    if not set(parts) <= set(keys):
        raise ValueError("partition columns must be part of the key")
    if ranked and update_cols is not None:
        raise ValueError("a ranked upsert replaces whole rows")
    if not has_data(spark, path, parts):
        replace(first_match(updates, keys, order_by), path, parts)
        return
    stored = spark.read.parquet(path).schema
    columns, kinds = stored.names, {f.name: f for f in updates.schema}
    batch = stage(updates.select(*columns), "batch")
    schema = StructType([kinds.get(f.name, f) for f in stored])
    target = spark.read.schema(schema).parquet(path)  # partition values typed as in the batch
    if parts:
        target = touched_rows(target, batch, parts)
    merged = latest(target, batch, keys, order_by) if ranked else upsert(target, batch, keys, order_by, update_cols)
    replace(merged, path, parts)


def upsert_apart(spark: SparkSession, path: str, updates: DataFrame, by: str, keys: Sequence[str], order_by: Sequence[str | Column],
                 partition_by: Sequence[str] = (), values: Sequence | None = None) -> list[tuple[object, str | None]]:
    """``upsert_path``, but a value of ``by`` whose rows cannot be read or merged is left out and told, and the others are merged.

    Returns (value, what failed or nothing) of each value.  All values are merged together; only when that fails is the batch
    halved, so k failing ones of n cost about k log n merges.  ``by`` must be a key, so that the halves touch different
    rows.  ``values`` are those to merge; without them they are fetched from the updates.
    """
    if by not in keys:
        raise ValueError("the column to go by must be part of the key")
    if values is None:
        values = [r[0] for r in updates.select(by).distinct().orderBy(F.asc_nulls_first(by)).collect()]
    if not values:
        return []
    try:
        upsert_path(spark, path, updates.where(in_partitions([by], [(v,) for v in values])), keys, order_by, partition_by)
    except Exception as e:  # noqa: BLE001 - told for each value
        if len(values) == 1:
            return [(values[0], f"{type(e).__name__}: {str(e).splitlines()[0] if str(e) else ''}")]
        half = len(values) // 2
        return [x for some in (values[:half], values[half:]) for x in upsert_apart(spark, path, updates, by, keys, order_by, partition_by, some)]
    return [(v, None) for v in values]


def touched_rows(target: DataFrame, batch: DataFrame, parts: Sequence[str]) -> DataFrame:
    """The rows of the table's partitions that the batch has rows for.

    Up to LITERALS partitions become literals in the filter on the table.  Of more, the scan is pruned by the range of the first
    column, and the rows by a semi-join with the batch's partitions; partitions with a null are then kept.
    """
    distinct = batch.select(*parts).distinct()
    few = [tuple(r) for r in distinct.limit(LITERALS + 1).collect()]
    if len(few) <= LITERALS:
        return target.where(in_partitions(parts, few))
    low, high = batch.agg(F.min(parts[0]), F.max(parts[0])).first()
    empty = F.lit(False)
    for p in parts:
        empty = empty | F.col(p).isNull()
    inside = target.where(F.col(parts[0]).between(F.lit(low), F.lit(high)) & ~empty)
    return inside.join(distinct, list(parts), "left_semi").unionByName(target.where(empty))


def latest(target: DataFrame, batch: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column]) -> DataFrame:
    """The first row per key of stored and new rows together; rows with a null key are all kept once."""
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    both = target.unionByName(batch.select(*target.columns))
    return first_match(both.where(known), keys, order_by).unionByName(both.where(~known).distinct())


def in_partitions(parts: Sequence[str], values: Sequence[tuple]) -> Column:
    """Rows of the given partitions, as literals that a scan can prune by."""

    def one(column: str, value: object) -> Column:
        return F.col(column).isNull() if value is None else F.col(column) == F.lit(value)

    if len(parts) == 1:
        known = [v for (v,) in values if v is not None]
        column = F.col(parts[0])
        return column.isin(known) | column.isNull() if len(known) < len(values) else column.isin(known)
    # By the first column, then the rest below each of its values: one branch a partition.
    branches: dict[object, list[tuple]] = {}
    for first, *rest in values:
        branches.setdefault(first, []).append(tuple(rest))
    out = F.lit(False)
    for first, rest in branches.items():
        out = out | (one(parts[0], first) & in_partitions(parts[1:], rest))
    return out


def execute_each(spark: SparkSession, path: str, action: str, params: DataFrame, on: Sequence[str], order_by: Sequence[str | Column] = (),
                 partition_by: Sequence[str] = ()) -> None:
    """One statement that writes, for many parameter sets, as one change of a Parquet table: the sets are the rows of ``params``.

    ``insert`` adds a row for each set whose ``on`` columns the table does not have yet, so that running it again adds nothing;
    ``update`` sets the other columns of ``params`` where the ``on`` columns are equal; ``delete`` removes such rows. Of several sets
    with equal ``on`` columns the first in ``order_by`` counts. Null equals nothing. Columns of an insert that the sets lack are null.
    Partition columns must be among ``on``; only partitions that the sets name are rewritten.
    """
    on, parts = list(on), list(partition_by)
    if action not in ("insert", "update", "delete"):
        raise ValueError(f"unknown action {action!r}")
    if not set(parts) <= set(on):
        raise ValueError("partition columns must be among those the statement goes by")
    if not has_data(spark, path, parts):
        if action == "insert":
            replace(first_match(params, on, order_by or on), path, parts)
        return
    batch = stage(first_match(params, on, order_by or on), "parameters")
    target = spark.read.parquet(path)
    kinds = {f.name: f.dataType for f in target.schema}
    unknown = [c for c in batch.columns if c not in kinds]
    if unknown:
        raise ValueError(f"the table has no columns {unknown}")
    batch = batch.select(*[F.col(c).cast(kinds[c]).alias(c) for c in batch.columns])
    touched = touched_rows(target, batch, parts) if parts else target
    if action == "insert":
        fresh = batch.join(touched.select(*on), on, "left_anti")
        changed = touched.unionByName(fresh, allowMissingColumns=True)
    elif action == "delete":
        changed = touched.join(batch.select(*on), on, "left_anti").select(*target.columns)
        if parts:  # an overwrite leaves partitions that get no row as they are
            located = touched_rows(target.withColumn("_folder", F.regexp_extract("_metadata.file_path", "^(.*)/[^/]*$", 1)), batch, parts)
            held = located.select(*parts, "_folder").distinct().dropna(subset=parts)
            emptied = [r["_folder"] for r in held.join(changed.select(*parts).distinct(), parts, "left_anti").collect()]
            replace(changed, path, parts)
            drop_folders(spark, emptied)
            return
    else:
        sets = [c for c in batch.columns if c not in on]
        marked = batch.select(*on, *[F.col(c).alias(f"_u_{c}") for c in sets], F.lit(True).alias("_hit"))
        changed = touched.join(marked, on, "left").select(*[
            F.when(F.col("_hit"), F.col(f"_u_{c}")).otherwise(F.col(c)).alias(c) if c in sets else F.col(c) for c in target.columns])
    replace(changed, path, parts)

"""Near duplicates: minima of universal hashes, banding, a check on the full sets, and connected components.

Two texts are linked when the Jaccard similarity of their sets of word shingles is at least a threshold. The links that are
formed always suffice for the components: copies of a set are one node, a bucket of a band gives a star first, and only
nodes of a bucket that the stars left apart are compared with each other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitwall.llm.memory import tidy
from pitwall.llm.components import components
from pitwall.llm.packing import runs
from pitwall.llm.words import NON_SPACE, raw_bytes, shingles, whole, words
from pitwall.session import stage

BANDS, ROWS = 32, 4  # a pair at 0.8 misses every band with a chance of (1 - 0.8**4)**32 = 5e-8
PERCENT = 80
# Share of equal minima below which a pair is not checked: 5.5 standard deviations under 0.8 for 128 minima, 5 for FINE.
LEAST_EQUAL = 0.605
FINE, FINE_EQUAL = 1024, 0.738
BLOCK = 512
# Ids that are broadcast to pick their texts; more of them are joined by a shuffle.
BROADCAST_IDS = 2_000_000
CHUNK_BYTES = 1 << 20


def _family(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Multiply-shift hashes x -> (a x + b mod 2**64) >> 32, a odd."""
    rng = np.random.default_rng(20240229)
    a, b = (rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) for _ in range(2))
    return a | np.uint64(1), b


def shingle_set(hashes: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct shingles; the whole sequence as one if there are fewer than n words."""
    if not len(hashes):
        return hashes
    return np.unique(shingles(hashes, n)) if len(hashes) >= n else whole(hashes)


def signature(items: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The minimum of every hash over the set, as 32-bit numbers."""
    out = np.full(len(a), np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(items), 256):  # stays in the cache, and bounded for any length of text
        part = items[at : at + 256, None] * a
        part += b
        np.minimum(out, part.min(axis=0), out=out)
    return (out >> np.uint64(32)).astype(np.uint32)


def _slices(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of whole texts of about CHUNK_BYTES."""
    at = 0
    while at < len(offsets) - 1:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK_BYTES, side="right")) - 1)
        yield at, to
        at = to


def _sketches(n: int, bands: int, rows: int):
    a, b = _family(bands * rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = raw_bytes(batch.column(1))
            for at, to in _slices(data, offsets):
                hashes, starts = words(data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at], NON_SPACE)
                sizes, keys, sigs = [], [], []
                for k in range(to - at):
                    items = shingle_set(hashes[starts[k] : starts[k + 1]], n)
                    sizes.append(len(items))
                    if not len(items):
                        keys.append(None)
                        sigs.append(None)
                        continue
                    # Two sums of differently mixed members stand for the set, 128 bits in all.
                    odd = (items ^ (items >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
                    keys.append(items.sum(dtype=np.uint64).tobytes() + (odd ^ (odd >> np.uint64(33))).sum(dtype=np.uint64).tobytes())
                    sigs.append(signature(items, a, b).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, to - at), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(sigs, pa.binary())],
                    ["doc_id", "n_shingles", "set_key", "sig"])

    return tidy(run)


def _fine(n: int):
    """(node, sig): FINE minima of a byte each, for a closer estimate."""
    a, b = _family(FINE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = raw_bytes(batch.column(1))
            for at, to in _slices(data, offsets):
                hashes, starts = words(data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at], NON_SPACE)
                sigs = [signature(items, a, b).astype(np.uint8).tobytes() if len(items := shingle_set(hashes[starts[k] : starts[k + 1]], n)) else None
                        for k in range(to - at)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, to - at), pa.array(sigs, pa.binary())], ["node", "sig"])

    return tidy(run)


def band_keys(sig: np.ndarray, rows: int) -> np.ndarray:
    """A 64-bit key for each band of each signature."""
    sig = sig.reshape(len(sig), -1, rows).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, sig.shape[1] + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), sig.shape[:2]).copy()
    for r in range(rows):
        key = (key ^ sig[:, :, r]) * np.uint64(0xBF58476D1CE4E5B9)
        key ^= key >> np.uint64(29)
    return key.view(np.int64)


def _bands(bands: int, rows: int):
    """(node, key) for each band of a signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, _ = raw_bytes(batch.column(1))
            key = band_keys(np.frombuffer(data.tobytes(), np.uint32).reshape(-1, bands * rows), rows)
            nodes = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), bands)
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(key.ravel())], ["node", "key"])

    return tidy(run)


def _equal_minima(left: pd.Series, right: pd.Series) -> pd.Series:
    if not len(left):
        return pd.Series([], dtype="float64")
    x, y = (np.frombuffer(b"".join(s), np.uint32).reshape(len(s), -1) for s in (left, right))
    return pd.Series((x == y).mean(axis=1))


def _similar(n: int, percent: int):
    def sets(texts: pd.Series) -> list[np.ndarray]:
        data, offsets = raw_bytes(pa.array(texts, pa.large_binary()))
        out: list[np.ndarray] = []
        for at, to in _slices(data, offsets):
            hashes, starts = words(data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at], NON_SPACE)
            out += [shingle_set(hashes[starts[k] : starts[k + 1]], n) for k in range(to - at)]
        return out

    def run(left: pd.Series, right: pd.Series) -> pd.Series:
        ok = []
        for at in range(0, len(left), 64):  # sets of a few pairs at a time in memory
            for x, y in zip(sets(left[at : at + 64]), sets(right[at : at + 64]), strict=True):
                both = np.intersect1d(x, y, assume_unique=True).size
                ok.append(bool(100 * both >= percent * (len(x) + len(y) - both)))
        return pd.Series(ok, dtype="bool")

    return run


def _apart(least: float, rows: int):
    """Pairs of one bucket block whose components differ and whose minima agree often enough; rows come sorted by block.

    A pair is told in the first band that it shares only.
    """

    def pairs(side, node, comp, m, base, key):
        first, second = np.flatnonzero(side <= 1), np.flatnonzero(side != 1)  # side 0: in both halves
        for at in range(0, len(first), 16):
            i = first[at : at + 16]
            near = (m[i][:, None, :] == m[second][None, :, :]).mean(axis=2) >= least
            near &= (comp[i][:, None] != comp[second][None, :]) & (node[i][:, None] != node[second][None, :])
            x, y = np.nonzero(near)
            if len(x):
                mine = band_keys(base[i[x]], rows)
                same = mine == band_keys(base[second[y]], rows)
                told = mine[np.arange(len(x)), same.argmax(axis=1)] == key
                yield node[i[x[told]]], node[second[y[told]]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(table: pa.Table):
            key = table.column("block").to_numpy()
            side, node, comp = (table.column(c).to_numpy() for c in ("side", "node", "comp"))
            sig = raw_bytes(table.column("sig"))[0].reshape(len(key), -1)
            base, bucket = (table.column(c) for c in ("base", "key"))
            base, bucket = np.frombuffer(raw_bytes(base)[0].tobytes(), np.uint32).reshape(len(key), -1), bucket.to_numpy()
            for s, e in runs(key):
                for x, y in pairs(side[s:e], node[s:e], comp[s:e], sig[s:e], base[s:e], bucket[s]):
                    if len(x):
                        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], ["a", "b"])

        held: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            key = table.column("block").to_numpy()
            last = int(np.searchsorted(key, key[-1]))  # the last block may go on in the next batch
            if last:
                yield from flush(table.slice(0, last).combine_chunks())
            held = table.slice(last)
        if held is not None and held.num_rows:
            yield from flush(held.combine_chunks())

    return tidy(run)


def near_duplicates(docs: DataFrame, n: int = 5, percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of ``docs``.

    Words are runs of bytes other than space and 09 to 0D, with A-Z lower-cased; a document's set is its distinct shingles
    of ``n`` words, or its whole sequence of fewer words. Documents are linked when 100 times the shared shingles are at
    least ``percent`` times all shingles of the two. ``component_id`` is the smallest doc_id that links reach and ``kept``
    tells whether that is the document's own. A null, empty or blank text has an empty set and is linked with nothing. Rows
    of the same doc_id are one document: each row counts its own shingles, and a link of one holds for all. A row
    without a doc_id is linked with nothing, has a null component and is kept. Extra columns are ignored.

    No bucket is capped or sampled. Documents with equal sets are reduced to one first, by a sum and not by pairs. A bucket
    of m documents gives m - 1 pairs with its hub, the member with the most company over all bands. What the hubs leave
    in different components is compared in blocks, by finer signatures; pairs that may be similar are checked on the texts.
    """
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    sketch = stage(texts.mapInArrow(_sketches(n, bands, rows), "doc_id long, n_shingles long, set_key binary, sig binary"), "sketch")
    known = sketch.where(F.col("set_key").isNotNull() & F.col("doc_id").isNotNull())
    classes = stage(known.groupBy("set_key").agg(F.min("doc_id").alias("node"), F.any_value("sig").alias("sig")), "classes")
    # An id with several texts is one node with several signatures.
    keys = classes.select("node", "sig").mapInArrow(_bands(bands, rows), "node long, key long").distinct()
    sizes = keys.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    buckets = stage(keys.join(sizes, "key"), "buckets")

    company = buckets.groupBy("node").agg(F.sum("size").alias("company"))
    hubs = (buckets.join(company, "node").groupBy("key")
            .agg(F.max(F.struct("company", (-F.col("node")).alias("minus"))).alias("hub"))
            .select("key", (-F.col("hub.minus")).alias("hub")))
    stars = (buckets.join(hubs, "key").where("node <> hub")
             .select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct())
    sig = classes.select("node", "sig")
    enough = F.pandas_udf(_equal_minima, "double")
    likely = (stars.join(sig.select(F.col("node").alias("a"), F.col("sig").alias("sig_a")), "a")
              .join(sig.select(F.col("node").alias("b"), F.col("sig").alias("sig_b")), "b")
              .where(enough("sig_a", "sig_b") >= LEAST_EQUAL).select("a", "b").distinct())

    # All that may be asked for again: texts of nodes that share a bucket with another.
    company_of = stage(buckets.select(F.col("node").alias("doc_id")).distinct(), "nodes")
    few = company_of.count() <= BROADCAST_IDS
    shared = stage(texts.join(F.broadcast(company_of) if few else company_of, "doc_id", "left_semi"), "shared")
    similar = F.pandas_udf(_similar(n, percent), "boolean")

    def confirmed(pairs: DataFrame) -> DataFrame:
        return (pairs.join(shared.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
                .join(shared.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
                .where(similar("text_a", "text_b")).select("a", "b").distinct())

    # Different ids of one class are linked through its node; ids with several texts link their classes.
    same_id = (known.join(classes.select("set_key", "node"), "set_key").where("doc_id <> node")
               .join(known.groupBy("doc_id").agg(F.count_distinct("set_key").alias("sets")).where("sets > 1"), "doc_id", "left_semi")
               .select(F.col("node").alias("a"), F.col("doc_id").alias("b")).distinct())
    links = stage(confirmed(likely).union(same_id), "links")
    label = stage(components(links), "labels")

    placed = (buckets.join(label, "node", "left").withColumn("comp", F.coalesce("component", "node")).select("key", "node", "size", "comp"))
    split = placed.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high").select("key")
    left = stage(placed.where("size > 2").join(split, "key"), "apart")
    fine = (shared.join(left.select(F.col("node").alias("doc_id")).distinct(), "doc_id", "left_semi")
            .mapInArrow(_fine(n), "node long, sig binary").where(F.col("sig").isNotNull()))
    parts = F.ceil(F.col("size") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("node"), parts).cast("int")
    base = classes.select("node", F.col("sig").alias("base"))
    mixed = (left.join(fine, "node").join(base, "node").select("key", "node", "comp", "sig", "base", parts.alias("parts"), own.alias("own"))
             .select("key", "node", "comp", "sig", "base", "own", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
             .select(F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("block"),
                     F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2).alias("side"),
                     "node", "comp", "sig", "base", "key"))
    rest = (mixed.repartition("block").sortWithinPartitions("block")
            .mapInArrow(_apart(FINE_EQUAL, rows), "a long, b long").distinct()
            .join(likely, ["a", "b"], "left_anti"))
    more = stage(confirmed(rest), "links")
    final = label if more.isEmpty() else stage(components(links.union(more)), "labels")

    ends = classes.select("set_key", "node").join(final, "node", "left").select("set_key", F.coalesce("component", "node").alias("reached"))
    return (
        sketch.join(ends, "set_key", "left")
        .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("reached", "doc_id")).alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def op3_minhash_lsh(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{folder}/documents.parquet"), n=4)

"""Benchmark decontamination by suffix arrays of the training text.

Each task keeps shards of a few megabytes of whole documents as suffix arrays over words. Every suffix of every test item is
searched in them by bisection, which gives its longest verbatim match and the places of all its windows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitwall.llm.memory import tidy
from pitwall.llm.words import ALNUM, raw_bytes, shingles, words
from pitwall.session import stage

WINDOW = 10
SHARD_BYTES = 2 << 20
# Text of test items that one broadcast carries; more items take several passes over the documents.
BLOCK_BYTES = 16 << 20


class Suffixes(NamedTuple):
    """A shard's words and their suffixes in order; a suffix ends with its document."""

    tokens: np.ndarray
    end: np.ndarray  # of the document that a position lies in
    order: np.ndarray


def suffix_array(tokens: np.ndarray, starts: np.ndarray, depth: int) -> Suffixes:
    """Suffixes sorted by their first ``depth`` words, by prefix doubling over those still tied.

    The order of words is that of their hashes. ``starts`` has the offsets of the documents.
    """
    n = len(tokens)
    end = np.repeat(starts[1:], np.diff(starts))
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64) + 1
    order, slots, done = np.arange(n), np.arange(n), 0
    while len(slots) and done < depth:
        at = order[slots]
        if done:
            follow = at + done
            inside = follow < end[at]
            key = (rank[at] << 32) | np.where(inside, rank[np.where(inside, follow, 0)], 0)
        else:
            key = rank[at]
        by = np.argsort(key, kind="stable")
        at, key = at[by], key[by]
        order[slots] = at
        new = np.r_[True, key[1:] != key[:-1]]
        group = np.maximum.accumulate(np.where(new, slots, 0)) + 1  # a rank is the first place of its group
        fresh = rank if not done else rank.copy()
        fresh[at] = group
        rank = fresh
        tied = ~new | ~np.r_[new[1:], True]
        slots = slots[tied]
        done = max(1, done * 2)
    return Suffixes(tokens, end, order)


def common_words(s: Suffixes, at: np.ndarray, patterns: np.ndarray, begin: np.ndarray, size: np.ndarray):
    """Words that the suffix at a place shares with a pattern, and whether the suffix comes before it."""
    shared = np.zeros(len(at), dtype=np.int64)
    before = np.zeros(len(at), dtype=bool)
    live = np.flatnonzero(size > 0)
    while len(live):
        place = at[live] + shared[live]
        over = place >= s.end[at[live]]
        mine = s.tokens[np.where(over, 0, place)]
        theirs = patterns[begin[live] + shared[live]]
        before[live] = over | (mine < theirs)
        live = live[~over & (mine == theirs)]
        shared[live] += 1
        before[live] = False
        live = live[shared[live] < size[live]]
    return shared, before


def bisect(s: Suffixes, patterns: np.ndarray, begin: np.ndarray, size: np.ndarray, above: bool) -> np.ndarray:
    """For each pattern the first place in the order whose suffix is not before it (or above all that start with it)."""
    low, high = np.zeros(len(begin), dtype=np.int64), np.full(len(begin), len(s.order), dtype=np.int64)
    while (open_ := np.flatnonzero(low < high)).size:
        mid = (low[open_] + high[open_]) // 2
        shared, before = common_words(s, s.order[mid], patterns, begin[open_], size[open_])
        right = before | (shared == size[open_]) if above else before
        low[open_[right]] = mid[right] + 1
        high[open_[~right]] = mid[~right]
    return low


class Items(NamedTuple):
    """A block of test items: their words, and every suffix of theirs."""

    ids: list
    tokens: np.ndarray
    item: np.ndarray  # of each suffix
    begin: np.ndarray
    size: np.ndarray

    @staticmethod
    def of(ids: list, texts: list[bytes | None]) -> Items:
        data, offsets = raw_bytes(pa.array(texts, pa.large_binary()))
        tokens, starts = words(data, offsets, ALNUM)
        sizes = np.diff(starts)
        item = np.repeat(np.arange(len(ids)), sizes)
        begin = np.arange(len(tokens))
        return Items(ids, tokens, item, begin, starts[1:][item] - begin)


def windows(items: Items, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The different windows: where each begins among the items' words, and its size; and of every place its window and item."""
    whole = np.bincount(items.item, minlength=len(items.ids))[items.item]  # words of the item
    cut = np.minimum(window, whole)
    full = np.flatnonzero(items.size >= cut)
    begin, size = items.begin[full], cut[full]
    key = np.zeros((len(full), 2), np.uint64)
    key[:, 1] = size
    for n in np.unique(size).tolist():
        mine = size == n
        key[mine, 0] = shingles(items.tokens, n)[begin[mine]]
    _, first, which = np.unique(key, axis=0, return_index=True, return_inverse=True)
    return begin[first], size[first], which.reshape(-1), items.item[full]


def search(s: Suffixes, items: Items, window: int, doc_of: np.ndarray):
    """Places where a window begins and the longest one's size there, the (document, item) pairs that have a window in common, and per
    suffix of an item its longest match (words, place).

    ``doc_of`` has the document of each word. A different window is looked up once. Windows of one size have ranges of the suffix array that do
    not overlap, so no more is made than an entry for each suffix and size, however often a window occurs.
    """
    begin, size, which, item = windows(items, window)
    low, high = bisect(s, items.tokens, begin, size, False), bisect(s, items.tokens, begin, size, True)
    covers, pairs = np.zeros(len(s.order), np.int64), []
    owners = np.unique(np.stack([which, item], 1), axis=0)  # of each window its items, once
    first = np.searchsorted(owners[:, 0], np.arange(len(begin) + 1))
    for n in np.unique(size).tolist():
        mine = np.flatnonzero((size == n) & (high > low))
        counts = high[mine] - low[mine]
        rank = np.repeat(low[mine] - np.r_[0, np.cumsum(counts)[:-1]], counts) + np.arange(counts.sum()) if len(mine) else mine
        covers[rank] = np.maximum(covers[rank], n)
        met = np.unique(np.stack([doc_of[s.order[rank]], np.repeat(mine, counts)], 1), axis=0)
        many = first[met[:, 1] + 1] - first[met[:, 1]]
        at = np.repeat(first[met[:, 1]] - np.r_[0, np.cumsum(many)[:-1]], many) + np.arange(many.sum()) if len(met) else met[:, 0]
        pairs.append(np.unique(np.stack([np.repeat(met[:, 0], many), owners[at, 1]], 1), axis=0))
    found = np.unique(np.concatenate(pairs), axis=0) if pairs else np.zeros((0, 2), np.int64)
    rank = np.flatnonzero(covers)
    at = bisect(s, items.tokens, items.begin, items.size, False)
    best, where = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
    for near in (at - 1, at):
        ok = (near >= 0) & (near < len(s.order))
        spot = s.order[np.where(ok, near, 0)]
        shared = np.where(ok, common_words(s, spot, items.tokens, items.begin, items.size)[0], 0)
        where, best = np.where(shared > best, spot, where), np.maximum(shared, best)
    return s.order[rank], covers[rank], found, best, where


def _covered(place: np.ndarray, size: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of covered words."""
    edges = np.bincount(place, minlength=n + 1) - np.bincount(place + size, minlength=n + 1)
    on = np.r_[False, np.cumsum(edges)[:n] > 0, False]
    turn = np.flatnonzero(on[1:] != on[:-1])
    return turn[::2], turn[1::2]


OUT = "row long, doc_id long, n_words long, spans array<struct<start:int,end:int>>, items array<string>, longest int"


class Found(NamedTuple):
    """What a shard of documents has in common with the items, by document."""

    at: int
    to: int
    n_words: np.ndarray
    spans: list
    items: list
    longest: np.ndarray


def _shards(texts: pa.Array, items: Items, window: int) -> Iterator[Found]:
    data, offsets = raw_bytes(texts)
    depth = int(max(window, items.size.max(initial=0)))
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SHARD_BYTES, side="right")) - 1)
        tokens, starts = words(data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at], ALNUM)
        rows = to - at
        spans, found, longest = [[] for _ in range(rows)], [[] for _ in range(rows)], np.zeros(rows, np.int32)
        if len(tokens) and len(items.tokens):
            # Of documents with the same start all but the last are empty.
            doc_of = np.repeat(np.arange(rows), np.diff(starts))
            place, size, pairs, best, where = search(suffix_array(tokens, starts, depth), items, window, doc_of)
            np.maximum.at(longest, doc_of[where], best.astype(np.int32))
            for doc, k in pairs.tolist():
                if items.ids[k] is not None:
                    found[doc].append(items.ids[k])
            for b, e in zip(*_covered(place, size, len(tokens)), strict=True):
                # A run of covered words that reaches into the next document is cut there.
                for doc in range(int(np.searchsorted(starts, b, side="right")) - 1, int(np.searchsorted(starts, e, side="left"))):
                    f, t = max(b, starts[doc]), min(e, starts[doc + 1])
                    if f < t:
                        spans[doc].append({"start": int(f - starts[doc]), "end": int(t - starts[doc])})
        yield Found(at, to, np.diff(starts), spans, found, longest)
        at = to


def _matches(block, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in _shards(batch.column(2), block.value, window):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(x.at, x.to - x.at), batch.column(1).slice(x.at, x.to - x.at), pa.array(x.n_words, pa.int64()),
                     pa.array(x.spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                     pa.array(x.items, pa.list_(pa.string())), pa.array(x.longest, pa.int32())],
                    ["row", "doc_id", "n_words", "spans", "items", "longest"])

    return tidy(run)


def _clean(block, window: int, column: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in _shards(batch.column(column), block.value, window):
                yield batch.slice(x.at, x.to - x.at).filter(pa.array([not s for s in x.spans]))

    return tidy(run)


def _blocks(items: DataFrame) -> tuple[int, Callable[[int], Broadcast]]:
    """How many blocks of about BLOCK_BYTES of text the items make, and a function that fetches and broadcasts one of them."""
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))

    def block(k: int) -> Broadcast:
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k) if blocks > 1 else items
        got = part.select(F.col("item_id").cast("string"), F.col("text").cast("binary")).distinct().collect()
        return items.sparkSession.sparkContext.broadcast(Items.of([r[0] for r in got], [r[1] for r in got]))

    return blocks, block


def matches(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """For each row of ``docs`` (doc_id, text) the verbatim matches with ``items`` (item_id, text).

    Words are runs of digits, ASCII letters (A-Z lower-cased) and bytes beyond ASCII. A window is ``window`` words in a row of
    an item, or the whole item if it has fewer; all places of all windows count. Columns: ``doc_id``, ``n_words``, ``spans``
    (maximal runs of matched words, as word numbers), ``items`` (item_ids with a matched window, as strings, any order, each
    once), ``longest`` (words of the longest match of a test suffix that ends up in this document: the best place in each
    shard). Null, empty and blank texts have no words; items without words match nothing; an item without an id is matched but
    not listed. Every row is answered, also repeated ones. Extra columns of either table are ignored.

    The items' text is measured first. Up to BLOCK_BYTES go to the tasks in one broadcast and the documents are read once,
    without a shuffle; more items are taken in blocks of that size by item hash, each with a pass of its own, and the
    blocks' answers are put together by row.
    """
    blocks, block = _blocks(items)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    if blocks == 1:
        return rows.mapInArrow(_matches(block(0), window), OUT).withColumn("items", F.array_distinct("items")).drop("row")
    rows, answers = stage(rows, "rows"), []
    for k in range(blocks):  # one after the other, so that one block at a time is in memory
        held = block(k)
        answers.append(stage(rows.mapInArrow(_matches(held, window), OUT), "matches"))
        held.destroy()
    both = answers[0]
    for more in answers[1:]:
        both = both.unionByName(more)
    merged = both.groupBy("row").agg(
        F.any_value("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"), F.max("longest").alias("longest"),
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))
    joined = F.reduce("spans", F.expr("cast(array() as array<struct<start:int,end:int>>)"), lambda done, x: F.when(
        (F.size(done) > 0) & (F.element_at(done, -1)["end"] >= x["start"]),
        F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(
            F.element_at(done, -1)["start"].alias("start"), F.greatest(F.element_at(done, -1)["end"], x["end"]).alias("end")))))
        .otherwise(F.concat(done, F.array(x))))
    return merged.select("doc_id", "n_words", joined.alias("spans"), "items", "longest")


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` that have no window of an item, in the columns they came with.

    Each row is judged by its own text; see ``matches`` for words, windows and blocks of items. There is no shuffle.
    """
    column = docs.columns.index("text")
    blocks, block = _blocks(items)
    if blocks == 1:
        return docs.mapInArrow(_clean(block(0), window, column), docs.schema)
    for k in range(blocks):
        held = block(k)
        docs = stage(docs.mapInArrow(_clean(held, window, column), docs.schema), "clean")
        held.destroy()
    return docs


def op5_suffix_arrays(spark: SparkSession, folder: str) -> DataFrame:
    docs, items = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "benchmark"))
    hit = F.reduce("spans", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    return matches(docs, items).select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256).alias("items_sha256"), (hit > 0).alias("contaminated"), "longest")

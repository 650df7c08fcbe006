"""Removal of repeated passages by a distributed merge sort of suffixes.

A string of ``length`` bytes that also starts in a document with a smaller id is removed, byte by byte. Not every suffix has to
be sorted for that. In each string of ``length`` bytes the grams of half that length are compared by hash, and the place of
the smallest is the string's anchor; equal strings have their anchor at the same place, so it is enough to sort the suffixes
that start at anchors (about one byte in thirteen), each followed by the bytes before it in reverse. Steps:

1. Documents are packed into compressed chunks and written.
2. Fingerprints of the anchors' grams are exchanged as sorted, delta-coded lists; those of one document only drop out.
3. Each chunk sorts its other anchors' suffixes, equal ones reduced to their smallest doc_id, and sends them as front-coded runs.
4. Runs are merged by a loser tree that compares two suffixes only beyond what both share with the last one put out. Its
   common-prefix lengths give the groups of equal strings, and these the smallest doc_id of each string.
5. The answers go back to the chunks, which cut the texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitwall.llm.packing import pack, runs, unpack
from pitwall.llm.words import INVERSE, mix, powers, prefix_hash, raw_bytes, substring_hash
from pitwall.session import stage

LENGTH = 50
CHUNK_BYTES = 3 << 20
BLOCK = 1 << 14  # strings whose anchors are found at a time
NO_ID = np.iinfo(np.int64).max
# Text whose fingerprints, and whose suffixes, one task gathers from all chunks.
BUCKET_TEXT, PART_TEXT = 24 << 20, 16 << 20


def _chunks(chunk_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            data, offsets = raw_bytes(batch.column(1))
            ids = batch.column(0).fill_null(NO_ID).to_numpy()
            at = 0
            while at < len(ids):
                to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + chunk_bytes, side="right")) - 1)
                text = zstandard.compress(data[offsets[at] : offsets[to]].tobytes(), 3)
                docs = pack(ids=ids[at:to], sizes=np.diff(offsets[at : to + 1]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number], pa.int64()), pa.array([docs], pa.binary()), pa.array([text], pa.binary())], ["chunk", "docs", "text"])
                number += 1
                at = to

    return run


class Anchors:
    """A chunk's texts and their anchors: place, document, and the offsets of strings that have it (least, most)."""

    def __init__(self, docs: bytes, text: bytes, length: int) -> None:
        self.ids, sizes = unpack(docs)
        self.data = np.frombuffer(zstandard.decompress(text), np.uint8) if sizes.sum() else np.zeros(0, np.uint8)
        self.starts = np.r_[0, np.cumsum(sizes)]
        n, gram = len(self.data), length // 2
        width = length - gram + 1
        full = n - length + 1  # strings of the whole chunk, those across documents included
        if full <= 0:
            self.place = self.low = self.high = np.zeros(0, np.int64)
            self.doc, self.gram = self.place, np.zeros(0, np.uint64)
            return
        prefix = prefix_hash(self.data)
        inverse = powers(INVERSE, len(prefix))
        place = np.empty(full, np.int64)
        for s in range(0, full, BLOCK):  # blocks that stay in the processor's cache
            e = min(s + BLOCK, full)
            grams = e + width - 1
            key = mix((prefix[s + gram : grams + gram] - prefix[s:grams]) * inverse[s:grams])
            key &= np.uint64(0xFFFFFFFF00000000)
            key |= np.arange(s, grams, dtype=np.uint64)
            step = 1
            while step * 2 <= width:
                key = np.minimum(key[:-step], key[step:])
                step *= 2
            key = np.minimum(key[: e - s], key[width - step : width - step + e - s])  # the leftmost smallest of each string
            place[s:e] = key & np.uint64(0xFFFFFFFF)
        valid = np.ones(full, bool)
        for end in self.starts[1:]:
            valid[max(0, end - length + 1) : end] = False
        start = np.flatnonzero(valid)
        place = place[start]
        new = np.flatnonzero(np.r_[True, place[1:] != place[:-1]]) if len(place) else place
        self.place = place[new]
        self.high = self.place - start[new]
        self.low = self.place - start[np.r_[new[1:], len(start)] - 1] if len(new) else self.place
        self.doc = np.searchsorted(self.starts, self.place, side="right") - 1
        self.gram = mix(substring_hash(prefix, self.place, self.place + gram))

    def fingerprints(self, bits: int) -> np.ndarray:
        return mix(self.gram ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(64 - bits)

    def several(self, prints: np.ndarray) -> np.ndarray:
        """Fingerprints that more than one document of this chunk has: of equal ones side by side, some two neighbours differ in the id."""
        order = np.argsort(prints, kind="stable")
        prints, ids = prints[order], self.ids[self.doc[order]]
        return np.unique(prints[1:][(prints[1:] == prints[:-1]) & (ids[1:] != ids[:-1])])


def _listed(bits: int, buckets: int, length: int):
    """(bucket, chunk, prints): a chunk's distinct fingerprints by range, as differences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, docs, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                prints = np.unique(Anchors(docs, text, length).fingerprints(bits))
                bucket = (prints * np.uint64(buckets)) >> np.uint64(bits)
                for s, e in runs(bucket):
                    blob = pack(prints=np.diff(prints[s:e], prepend=np.uint64(0)))
                    yield pa.RecordBatch.from_arrays([pa.array([int(bucket[s])], pa.int64()), pa.array([chunk], pa.int64()), pa.array([blob], pa.binary())],
                                                     ["bucket", "chunk", "prints"])

    return run


def _shared(group: pd.DataFrame) -> pd.DataFrame:
    """For each chunk those of its fingerprints that another chunk has too."""
    lists = [np.cumsum(unpack(b)[0], dtype=np.uint64) for b in group["prints"]]
    every = np.sort(np.concatenate(lists))
    twice = np.unique(every[1:][every[1:] == every[:-1]])
    out = []
    for chunk, own in zip(group["chunk"], lists, strict=True):
        both = own[np.isin(own, twice, assume_unique=True)] if len(twice) else twice
        if len(both):
            out.append((chunk, pack(prints=np.diff(both, prepend=np.uint64(0)))))
    return pd.DataFrame(out, columns=["chunk", "prints"])


class Suffixes:
    """The suffixes a chunk sends, as rows of bytes: gram and what follows, what precedes reversed, offsets least and most."""

    def __init__(self, a: Anchors, shared: list[bytes], bits: int, parts: int, length: int) -> None:
        half = length // 2
        prints = a.fingerprints(bits)
        wanted = np.concatenate([a.several(prints), *(np.cumsum(unpack(b)[0], dtype=np.uint64) for b in shared)])
        self.pick = np.flatnonzero(np.isin(prints, wanted))
        place, doc = a.place[self.pick], a.doc[self.pick]
        back = length - half
        padded = np.concatenate([np.zeros(back, np.uint8), a.data, np.zeros(length, np.uint8)])
        around = np.lib.stride_tricks.sliding_window_view(padded, back + length)[place] if len(place) else np.zeros((0, back + length), np.uint8)
        part = (mix(a.gram[self.pick]) % np.uint64(parts)).astype(np.int64)
        # The part comes first, as four bytes, so that one sort of bytes does; bytes beyond the document are zero.
        rows = np.zeros((len(place), 4 + length + back + 2), np.uint8)
        rows[:, :4] = part.astype(">u4").view(np.uint8).reshape(-1, 4)
        rows[:, 4 : 4 + length] = np.where(np.arange(length) < (a.starts[doc + 1] - place)[:, None], around[:, back:], 0)
        rows[:, 4 + length : -2] = np.where(np.arange(back) < (place - a.starts[doc])[:, None], around[:, back - 1 :: -1] if back else 0, 0)
        rows[:, -2], rows[:, -1] = a.low[self.pick], a.high[self.pick]
        order = np.argsort(rows.view(f"S{rows.shape[1]}").ravel(), kind="stable")
        rows, part = rows[order][:, 4:], part[order]
        new = np.r_[True, (rows[1:] != rows[:-1]).any(axis=1) | (part[1:] != part[:-1])][: len(rows)]
        entry = np.cumsum(new) - 1
        self.entry = np.empty(len(rows), np.int64)  # of each picked anchor
        self.entry[order] = entry
        self.rows, self.part = rows[new], part[new]
        ids = a.ids[doc][order]
        self.least = np.minimum.reduceat(ids, np.flatnonzero(new)) if len(rows) else ids

    def coded(self) -> Iterator[tuple[int, bytes]]:
        """A front-coded run for each part: how much each row shares with the one before, and the rest of it."""
        for s, e in runs(self.part):
            rows = self.rows[s:e]
            common = np.zeros(len(rows), np.uint8)
            if len(rows) > 1:
                common[1:] = (rows[1:] != rows[:-1]).argmax(axis=1)
            rest = rows[np.arange(rows.shape[1]) >= common[:, None]]
            yield int(self.part[s]), pack(common=common, rest=rest, least=self.least[s:e])


def _runs(bits: int, parts: int, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, docs, text, shared in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for part, blob in Suffixes(Anchors(docs, text, length), shared or [], bits, parts, length).coded():
                    yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([chunk], pa.int64()), pa.array([blob], pa.binary())],
                                                     ["part", "chunk", "run"])

    return run


def front_decoded(common: np.ndarray, rest: np.ndarray, width: int) -> list[bytes]:
    out, before, at, data = [], b"", 0, rest.tobytes()
    for c in common.tolist():
        before = before[:c] + data[at : at + width - c]
        at += width - c
        out.append(before)
    return out


def merge(runs: list[list[bytes]], width: int) -> tuple[np.ndarray, np.ndarray]:
    """The runs' rows in order, as numbers over all runs, and how many bytes each shares with the one before.

    A loser tree: its nodes hold the losers of their matches, and a loser knows how much it shares with the row that beat it.
    Of two rows the one that shares more with the last row put out comes first, unseen; only with equal shares are bytes
    compared, from there on, as one number.
    """
    k = len(runs)
    first = np.r_[0, np.cumsum([len(r) for r in runs])].tolist()
    masks = [(1 << (8 * (width - h))) - 1 for h in range(width + 1)]
    numbers = [[int.from_bytes(x, "big") for x in r] for r in runs]
    head = [0] * k  # place in each run
    value = [r[0] if r else None for r in numbers]
    share = [0] * k  # bytes in common with the last row put out

    def play(x: int, y: int) -> tuple[int, int]:
        """Winner and loser; the loser's share is now with the winner."""
        vx, vy = value[x], value[y]
        if vy is None:
            return x, y
        if vx is None:
            return y, x
        hx, hy = share[x], share[y]
        if hx > hy:
            return x, y
        if hy > hx:
            return y, x
        mask = masks[hx]
        tx, ty = vx & mask, vy & mask
        if tx == ty:
            x, y = (x, y) if x < y else (y, x)
            share[y] = width
            return x, y
        h = width - ((tx ^ ty).bit_length() + 7) // 8
        if tx < ty:
            share[y] = h
            return x, y
        share[x] = h
        return y, x

    total = first[-1]
    order, common = [0] * total, [0] * total
    tree = [-1] * (2 * k)  # inner nodes 1 to k - 1 hold losers; leaves k to 2 k - 1
    winners = [-1] * (2 * k)
    for leaf in range(k):
        winners[k + leaf] = leaf
    for node in range(k - 1, 0, -1):
        winners[node], tree[node] = play(winners[2 * node], winners[2 * node + 1])
    win = winners[1] if k > 1 else 0
    for out in range(total):
        order[out] = first[win] + head[win]
        common[out] = share[win]
        # The next row of the winner's run: what it shares with the row just put out is known within the run.
        at = head[win] = head[win] + 1
        mine = numbers[win]
        if at < len(mine):
            value[win] = mine[at]
            share[win] = width - ((mine[at] ^ mine[at - 1]).bit_length() + 7) // 8
        else:
            value[win] = None
        node = (k + win) >> 1
        while node:
            win, tree[node] = play(win, tree[node])
            node >>= 1
    return np.array(order, np.int64), np.array(common, np.int64)


def smallest_ids(rows: np.ndarray, common: np.ndarray, ids: np.ndarray, length: int) -> np.ndarray:
    """For each sorted row and each offset of a string around its anchor the smallest id that has the string; else NO_ID."""
    half, width = length // 2, rows.shape[1]
    spread = length - half + 1
    group = np.cumsum(common < half)  # equal grams
    new = np.flatnonzero(common < width) if len(common) else common
    entry = np.cumsum(common < width) - 1
    least = np.minimum.reduceat(ids, new)
    first, group = rows[new], group[new]
    low, high = first[:, -2].astype(np.int64), first[:, -1].astype(np.int64)
    scale = powers(0x9E3779B97F4A7C15, 2 * length)
    right = np.zeros((len(first), spread), np.uint64)
    left = np.zeros((len(first), spread), np.uint64)
    right[:, 1:] = np.cumsum((first[:, half:length].astype(np.uint64) + np.uint64(1)) * scale[: length - half], axis=1, dtype=np.uint64)
    left[:, 1:] = np.cumsum((first[:, length : length + spread - 1].astype(np.uint64) + np.uint64(1)) * scale[: spread - 1], axis=1, dtype=np.uint64)
    out = np.full((len(first), spread), NO_ID)
    alone = np.r_[True, group[1:] != group[:-1]] & np.r_[group[1:] != group[:-1], True]
    for o in range(spread):
        has = (low <= o) & (o <= high)
        out[has & alone, o] = least[has & alone]
        at = np.flatnonzero(has & ~alone)
        if len(at):
            key = mix(mix(right[at, spread - 1 - o]) ^ (mix(left[at, o] + np.uint64(o)) * np.uint64(3)) ^ mix(group[at].astype(np.uint64) << np.uint64(20)))
            by = np.argsort(key, kind="stable")
            cut = np.flatnonzero(np.r_[True, key[by][1:] != key[by][:-1]])
            out[at[by], o] = np.repeat(np.minimum.reduceat(least[at[by]], cut), np.diff(np.r_[cut, len(at)]))
    return out[entry]


def _merged(length: int):
    half = length // 2
    width = length + half + length % 2 + 2

    def run(group: pd.DataFrame) -> pd.DataFrame:
        runs, least = [], []
        for blob in group["run"]:
            common, rest, ids = unpack(blob)
            runs.append(front_decoded(common, rest, width))
            least.append(ids)
        order, common = merge(runs, width)
        rows = np.frombuffer(b"".join(x for r in runs for x in r), np.uint8).reshape(-1, width)[order]
        back = np.empty_like(order)
        back[order] = np.arange(len(order))
        ids = smallest_ids(rows, common, np.concatenate(least)[order], length)[back]
        out, at = [], 0
        for chunk, r in zip(group["chunk"], runs, strict=True):
            own = ids[at : at + len(r)]
            # Offsets in a row mostly have the same id; only changes are sent.
            change = np.ones(own.shape, bool)
            change[:, 1:] = own[:, 1:] != own[:, :-1]
            out.append((chunk, int(group["part"].iloc[0]), pack(
                changes=change.sum(axis=1).astype(np.uint8), offsets=np.nonzero(change)[1].astype(np.uint8), ids=own[change])))
            at += len(r)
        return pd.DataFrame(out, columns=["chunk", "part", "ids"])

    return run


OUT = "doc_id long, n_bytes long, spans array<struct<start:int,end:int>>, kept binary"


def _cut(bits: int, parts: int, length: int):
    spread = length - length // 2 + 1

    def covered(a: Anchors, own: Suffixes, found: list) -> np.ndarray:
        """How many strings that go cover each byte, as differences."""
        changes, offsets, ids = (np.concatenate(x) for x in zip(*(unpack(f["ids"]) for f in sorted(found, key=lambda f: f["part"])), strict=True))
        first = np.r_[0, np.cumsum(changes, dtype=np.int64)]
        until = np.r_[offsets[1:], 0]  # a change holds up to the next one, the last up to all offsets
        until[first[1:] - 1] = spread
        n = changes[own.entry].astype(np.int64)
        anchor = np.repeat(np.arange(len(n)), n)
        change = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + first[own.entry][anchor]
        gone = ids[change] < a.ids[a.doc[own.pick]][anchor]
        place, change = a.place[own.pick][anchor[gone]], change[gone]
        size = len(a.data) + 1
        return np.bincount(place - until[change] + 1, minlength=size) - np.bincount(place - offsets[change] + length, minlength=size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, docs, text, shared, found in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                a = Anchors(docs, text, length)
                own = Suffixes(a, shared or [], bits, parts, length)
                gone = np.cumsum(covered(a, own, found)[:-1]) > 0 if found else np.zeros(len(a.data), bool)
                spans, kept = [], []
                for s, e in zip(a.starts[:-1], a.starts[1:], strict=True):
                    turn = np.flatnonzero(np.diff(np.r_[False, gone[s:e], False]))
                    spans.append([{"start": int(x), "end": int(y)} for x, y in zip(turn[::2], turn[1::2], strict=True)])
                    kept.append(a.data[s:e][~gone[s:e]].tobytes() if len(turn) else a.data[s:e].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a.ids, pa.int64(), mask=a.ids == NO_ID), pa.array(np.diff(a.starts), pa.int64()),
                     pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), pa.array(kept, pa.binary())],
                    ["doc_id", "n_bytes", "spans", "kept"])

    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH, chunk_bytes: int = CHUNK_BYTES, bucket_text: int = BUCKET_TEXT,
                   part_text: int = PART_TEXT) -> DataFrame:
    """For each row of ``docs`` (doc_id, text): doc_id, n_bytes, spans (maximal removed runs, in bytes) and kept (the rest).

    Texts are UTF-8 bytes; a null text is empty. A byte goes if a string of ``length`` bytes that covers it also starts in a
    document with a smaller doc_id; strings are judged on the input and never cross documents. A text of fewer bytes stays. So
    do repeats within a document, and rows of the same doc_id do not count against each other. A row without a doc_id comes
    after all others: it loses what any of these has, but not what only rows without an id share. Other columns are ignored.

    ``chunk_bytes`` is the text of a chunk; ``bucket_text`` and ``part_text`` that whose fingerprints, and whose suffixes, one
    task gathers. They change no result. Nothing is capped. A passage of very many documents is one row of the run of each chunk that has it.
    """
    chunks = stage(docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(_chunks(chunk_bytes), "chunk long, docs binary, text binary"), "chunks")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(60, max(24, int(size // 13 + 1).bit_length() + 10))  # about one fingerprint in 1000 is shared by chance
    buckets, parts = size // bucket_text + 1, size // part_text + 1
    listed = chunks.mapInArrow(_listed(bits, buckets, length), "bucket long, chunk long, prints binary")
    shared = stage(listed.groupBy("bucket").applyInPandas(_shared, "chunk long, prints binary"), "shared")
    shared = shared.groupBy("chunk").agg(F.collect_list("prints").alias("prints"))  # at most the chunk's own anchors
    known = chunks.join(shared, "chunk", "left")
    runs = known.select("chunk", "docs", "text", "prints").mapInArrow(_runs(bits, parts, length), "part long, chunk long, run binary")
    ids = runs.groupBy("part").applyInPandas(_merged(length), "chunk long, part long, ids binary")
    ids = ids.groupBy("chunk").agg(F.collect_list(F.struct("part", "ids")).alias("found"))  # likewise
    return known.join(ids, "chunk", "left").select("chunk", "docs", "text", "prints", "found").mapInArrow(_cut(bits, parts, length), OUT)


def op10_front_coded_merge(spark: SparkSession, folder: str) -> DataFrame:
    cut = remove_repeats(spark.read.parquet(f"{folder}/documents.parquet"))
    return cut.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
                      F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))

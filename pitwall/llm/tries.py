"""The prefix trie of conversations, by z-fast tries of its parts.

A conversation is the path of its turns' digests: the digest of its first d turns, for each d, names the node of depth d. Two
conversations share a node if and only if they have the same digest there (128 bits; texts themselves are never moved).

* Conversations that are equal are one path, with their number, smallest id and a digest of all their ids.
* Prefixes that more than ``SHARD_TURNS`` turns lie on are hot. Hot ones, and the root, are the upper trie; it is small, and made of
  counts and sums that tasks combine before they are shuffled.
* The paths that leave the upper trie by one node make a shard, of ``SHARD_TURNS`` turns at most, so neither a first turn that most
  conversations share nor copies fill a task. A shard is a z-fast trie (``ZFastTrie``), whose edges are then expanded.
* What shards hold is added to the upper nodes above them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitwall.llm.memory import tidy
from pitwall.session import stage

SHARD_TURNS = 2048
BATCH = 256
BROADCAST_ROWS = 200_000
CHUNK_BYTES = 1 << 20
ROOT = bytes(16)
NO_ENDS = hashlib.sha256(b"").hexdigest()


# -- a shard ------------------------------------------------------------------------------------------------------------


class Path:
    """A distinct conversation: prefix digests by depth (the first is of depth 1), code points of each turn, and its copies."""

    __slots__ = ("digests", "chars", "conv_id", "copies", "ends")

    def __init__(self, digests: list[bytes], chars: list[int], conv_id: int, copies: int, ends: str) -> None:
        self.digests, self.chars, self.conv_id, self.copies, self.ends = digests, chars, conv_id, copies, ends


class Node:
    """A compacted node: the depths over ``low`` up to ``top`` of one path, without a branch or an end before ``top``."""

    __slots__ = ("low", "top", "path", "parent", "children", "ended", "changed", "n_convs", "conv_id", "n_leaves", "saved")

    def __init__(self, low: int, top: int, path: Path, parent: Node | None) -> None:
        self.low, self.top, self.path, self.parent = low, top, path, parent
        self.children: dict[bytes, Node] = {}
        self.ended: Path | None = None
        self.changed = -1
        self.n_convs = self.n_leaves = self.saved = 0
        self.conv_id: int | None = None


def two_fattest(low: int, high: int) -> int:
    """Of the numbers over ``low`` up to ``high`` the one that the largest power of two divides."""
    return high & -1 << (low ^ high).bit_length() - 1


class ZFastTrie:
    """Paths that agree up to depth ``base`` + 1. ``handles`` has each compacted node by the digest at its two-fattest depth, so
    the node where a path leaves the trie is found by a binary search over depths, with one look-up each."""

    def __init__(self, base: int) -> None:
        self.base, self.batch = base, 0
        self.top: Node | None = None
        self.nodes: list[Node] = []
        self.handles: dict[bytes, Node] = {}

    def _handle(self, node: Node) -> bytes:
        return node.path.digests[two_fattest(node.low, node.top) - 1]

    def _add(self, low: int, top: int, path: Path, parent: Node | None) -> Node:
        node = Node(low, top, path, parent)
        self.nodes.append(node)
        self.handles[self._handle(node)] = node
        return node

    def exit_node(self, path: Path) -> Node:
        """The deepest node that the path enters: it ends in it, leaves it, or goes on where the node has no child."""
        digests, low, high, found = path.digests, self.base, len(path.digests), None
        while low < high:
            at = two_fattest(low, high)
            node = self.handles.get(digests[at - 1])
            if node is None:
                high = at - 1
                continue
            if node.top > len(digests) or digests[node.top - 1] != node.path.digests[node.top - 1]:
                return node
            found, low = node, node.top
        if found is None:
            return self.top
        return found.children.get(digests[low], found) if len(digests) > low else found

    def _common(self, path: Path, node: Node) -> int:
        """The depth up to which the path agrees with the node."""
        low, high = node.low + 1, min(len(path.digests), node.top)
        while low < high:
            at = (low + high + 1) // 2
            if path.digests[at - 1] == node.path.digests[at - 1]:
                low = at
            else:
                high = at - 1
        return low

    def insert(self, paths: Iterable[Path]) -> None:
        """Insert a batch: all exit nodes are looked up first, and once more where the batch itself has changed one."""
        paths = list(paths)
        if self.top is None and paths:
            self.top = self._add(self.base, len(paths[0].digests), paths[0], None)
            self.top.ended = paths.pop(0)
        self.batch += 1
        for path, node in [(p, self.exit_node(p)) for p in paths]:
            if node.changed == self.batch:
                node = self.exit_node(path)
            depth = self._common(path, node)
            if depth < node.top:
                node = self._split(node, depth)
            if len(path.digests) == depth:
                node.ended = path
            else:
                leaf = node.children[path.digests[depth]] = self._add(depth, len(path.digests), path, node)
                leaf.ended = path
                leaf.changed = self.batch
            node.changed = self.batch

    def _split(self, node: Node, depth: int) -> Node:
        """Cut a node at ``depth``: a new one has the depths up to it, and the old one, below it, those beyond."""
        del self.handles[self._handle(node)]
        upper = self._add(node.low, depth, node.path, node.parent)
        if node.parent is None:
            self.top = upper
        else:
            node.parent.children[node.path.digests[node.low]] = upper
        upper.children[node.path.digests[depth]] = node
        node.low, node.parent, node.changed = depth, upper, self.batch
        self.handles[self._handle(node)] = node
        return upper

    def expand(self) -> Iterator[tuple]:
        """A row for each depth of each node: conv_id, depth, parent_conv_id (none for the first), n_convs, n_children, n_leaves,
        saved_tokens, ends_sha256."""
        rows = []
        for node in sorted(self.nodes, key=lambda x: -x.top):  # children first
            below = node.children.values()
            node.n_convs = sum(x.n_convs for x in below) + (node.ended.copies if node.ended else 0)
            node.conv_id = min([x.conv_id for x in below] + ([node.ended.conv_id] if node.ended else []))
            node.n_leaves = sum(x.n_leaves for x in below) if below else 1
            node.saved = sum(x.saved for x in below)
            at = len(rows)
            for depth in range(node.top, node.low, -1):
                node.saved += (node.n_convs - 1) * node.path.chars[depth - 1]
                last = depth == node.top
                rows.append((node, depth, len(below) if last else 1, node.saved, node.ended.ends if last and node.ended else NO_ENDS))
            assert len(rows) - at == node.top - node.low
        for node, depth, children, saved, ends in rows:
            over = node.conv_id if depth > node.low + 1 else node.parent and node.parent.conv_id
            yield node.conv_id, depth, over, node.n_convs, children, node.n_leaves, saved, ends


# -- paths ---------------------------------------------------------------------------------------------------------------


def sequences(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): of each conversation in ``turns`` (conv_id, turn, role, text) the digests and code points, in order.

    The order is by turn, null first, and by the turn's digest where it is the same; a null role or text is empty. Rows without a
    conv_id belong to no conversation. A conversation's turns, about 50 bytes each, meet in one task.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))
    rows = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.unhex(digest).alias("digest"), F.char_length(text).alias("chars"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "digest", "chars"))).alias("turns"))


def rebuilt(seqs: DataFrame, every: int = 100, heads: int = 6) -> DataFrame:
    """(conv_id, turns): each conversation c begins with the first h turns of conversation c - c % every, and goes on with its own
    after its first h; h is crc32(c) % heads. A conversation that is not there has no turns."""
    h = (F.crc32(F.col("conv_id").cast("string")) % heads).cast("int")
    first = seqs.where(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("first_id"), F.slice("turns", 1, heads).alias("head"))
    both = seqs.withColumn("first_id", F.col("conv_id") - F.col("conv_id") % every).join(first, "first_id", "left").withColumn("h", h)
    own = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1)))
    return both.select("conv_id", F.when(F.col("head").isNull(), own).otherwise(F.concat(F.slice("head", F.lit(1), F.col("h")), own)).alias("turns"))


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each prefix, from that of the prefix before and the next turn."""
    for batch in batches:
        digests = batch.column(1)
        flat, ends = digests.flatten().to_pylist(), digests.offsets.to_pylist()
        paths, last = [], []
        for at, to in zip(ends, ends[1:]):  # noqa: B905 - the last has no successor
            held = ROOT
            for k in range(at - ends[0], to - ends[0]):
                held = hashlib.md5(held + flat[k], usedforsecurity=False).digest()
                paths.append(held)
            last.append(held)
        offsets = pa.array([x - ends[0] for x in ends], pa.int32())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(last, pa.binary()), pa.ListArray.from_arrays(offsets, pa.array(paths, pa.binary())), batch.column(2)],
            ["conv_id", "whole", "path", "chars"])


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (whole, conv_id) in order, the ids of equal conversations joined, in pieces of bounded length."""
    key, ids, size, out = None, [], 0, []

    def close() -> None:
        out.append((key, ids[0], len(ids), ",".join(map(str, ids))))

    for batch in batches:
        for whole, conv_id in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if ids and (whole != key or size > CHUNK_BYTES):
                close()
                ids, size = [], 0
            key = whole
            ids.append(conv_id)
            size += 12
        if out:
            yield _batch(out, RUNS)
            out = []
    if ids:
        close()
        yield _batch(out, RUNS)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of pieces (whole, conv_id, copies, ids) in order, one row for each ``whole``; the digest is fed piece by piece."""
    now, out = None, []

    def close() -> None:
        out.append((now[1], now[2], now[3].hexdigest()))

    for batch in batches:
        for whole, conv_id, copies, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if now and now[0] == whole:
                now[2] += copies
                now[3].update(b"," + ids.encode())
            else:
                if now:
                    close()
                now = [whole, conv_id, copies, hashlib.sha256(ids.encode())]
        if out:
            yield _batch(out, ENDS)
            out = []
    if now:
        close()
        yield _batch(out, ENDS)


RUNS = "whole binary, conv_id long, copies long, ids string"
ENDS = "conv_id long, copies long, ends string"
KINDS = {"long": pa.int64(), "binary": pa.binary(), "string": pa.string(), "array<binary>": pa.list_(pa.binary())}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names, kinds = zip(*(x.split() for x in schema.split(", ")), strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, KINDS[k]) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], list(names))


def distinct_paths(seqs: DataFrame) -> DataFrame:
    """(conv_id, copies, ends, path, chars) of each different conversation: smallest id, how many, SHA-256 of all their ids."""
    chained = seqs.select("conv_id", F.col("turns.digest").alias("digests"), F.col("turns.chars").alias("chars")).mapInArrow(
        tidy(_chain), "conv_id long, whole binary, path array<binary>, chars array<int>")
    paths = stage(chained, "paths")
    pieces = (paths.select("whole", "conv_id").repartitionByRange("whole", "conv_id").sortWithinPartitions("whole", "conv_id")
              .mapInArrow(tidy(_runs), RUNS))
    ends = pieces.repartition("whole").sortWithinPartitions("whole", "conv_id").mapInArrow(tidy(_digests), ENDS)
    return stage(paths.drop("whole").join(ends, "conv_id"), "distinct")


# -- the whole trie ------------------------------------------------------------------------------------------------------

NODES = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
SHARD_NODES = f"{NODES}, above binary, over array<binary>"


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (shard, base, conv_id, copies, ends, path, chars) in the order of shards, all nodes of each shard."""

    def close(base: int, paths: list[Path]) -> list[tuple]:
        trie = ZFastTrie(base)
        for at in range(0, len(paths), BATCH):
            trie.insert(paths[at : at + BATCH])
        over = paths[0].digests[:base]
        return [row + ((over[-1] if over else ROOT, [ROOT, *over]) if row[1] == base + 1 else (None, None)) for row in trie.expand()]

    key, base, paths, out = None, 0, [], []
    for batch in batches:
        for shard, depth, conv_id, copies, ends, path, chars in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if paths and shard != key:
                out += close(base, paths)
                paths = []
                if len(out) > 10_000:
                    yield _batch(out, SHARD_NODES)
                    out = []
            key, base = shard, depth
            paths.append(Path(path, chars, conv_id, copies, ends))
    if paths:
        out += close(base, paths)
        yield _batch(out, SHARD_NODES)


def trie(seqs: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The nodes of the trie of all conversations in ``seqs`` (conv_id, turns), each with its figures; see NODES.

    ``conv_id`` is the smallest of the conversations that begin with the node's turns, ``n_convs`` their number; ``n_leaves`` and
    ``saved_tokens`` are of the node's subtree, and ``ends_sha256`` is of the ids of those that end at the node. The root, of depth
    0, has all conversations, those without turns as well, and no parent. An empty table has no node. conv_ids must differ.

    A path is as long as its conversation, and is sent once to its shard; of hot prefixes only counts are shuffled.
    """
    paths = distinct_paths(seqs)
    own = F.size("path").cast("long")
    lying = paths.select(F.explode("path").alias("node"), own.alias("turns")).groupBy("node").agg(F.sum("turns").alias("turns"))
    hot = stage(lying.where(F.col("turns") > shard_turns).select("node"), "hot")
    small = hot.count() <= BROADCAST_ROWS

    def few(df: DataFrame) -> DataFrame:
        """What has at most a row for each hot node."""
        return F.broadcast(df) if small else df

    on_hot = paths.select("conv_id", F.explode("path").alias("node")).join(few(hot), "node").groupBy("conv_id").agg(F.count("*").cast("int").alias("base"))
    placed = stage(paths.join(on_hot, "conv_id", "left").fillna(0, ["base"]), "placed")

    shard = F.try_element_at("path", F.col("base") + 1)
    below = stage(placed.where(F.size("path") > F.col("base")).select(shard.alias("shard"), "base", "conv_id", "copies", "ends", "path", "chars")
                  .repartition("shard").sortWithinPartitions("shard").mapInArrow(tidy(_shards), SHARD_NODES), "shards")

    line = F.concat(F.array(F.lit(ROOT)), F.slice("path", F.lit(1), F.col("base")))
    upper = placed.select("conv_id", "copies", "ends", "chars", F.size("path").alias("turns"), line.alias("line"), F.posexplode(line).alias("depth", "node"))
    upper = stage(upper.groupBy("node").agg(
        F.min("conv_id").alias("conv_id"), F.any_value("depth").cast("long").alias("depth"), F.sum("copies").alias("n_convs"),
        F.any_value(_chars()).alias("chars"),
        F.any_value(F.when(F.col("depth") > 0, F.try_element_at("line", F.greatest("depth", F.lit(1))))).alias("above"),
        F.max(F.when(F.col("turns") == F.col("depth"), F.col("ends"))).alias("ends")), "upper")

    tops = below.where("above IS NOT NULL")
    children = tops.select("above").union(upper.where("depth > 0").select("above")).groupBy("above").agg(F.count("*").alias("n_children"))
    counted = upper.join(few(children.withColumnRenamed("above", "node")), "node", "left").fillna(0, ["n_children"])
    # Nodes of one conv_id lie above one another without a gap: sums along them, then those of each such line for the nodes over it.
    up = Window.partitionBy("conv_id").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    summed = stage(counted.withColumns({
        "leaves": F.sum((F.col("n_children") == 0).cast("long")).over(up), "saved": F.sum((F.col("n_convs") - 1) * F.col("chars")).over(up)}), "summed")
    firsts = summed.groupBy("conv_id").agg(F.min("depth").alias("depth"), F.max("leaves").alias("leaves"), F.max("saved").alias("saved"))
    lines = firsts.where("depth > 0").join(placed.select("conv_id", line.alias("line")), "conv_id").select(
        F.explode(F.slice("line", F.lit(1), F.col("depth").cast("int"))).alias("node"), "leaves", "saved")
    given = tops.select(F.explode("over").alias("node"), F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved")).union(lines)
    given = given.groupBy("node").agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))

    names = few(upper.select(F.col("node").alias("above"), F.col("conv_id").alias("parent")))
    total = summed.join(given, "node", "left").join(names, "above", "left").select(
        "conv_id", "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children",
        (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("n_leaves"), (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved_tokens"),
        F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256"))
    inner = below.join(names, "above", "left").withColumn("parent_conv_id", F.coalesce("parent", "parent_conv_id"))
    return total.unionByName(inner.select(total.columns))


def _chars() -> Column:
    """Code points of the last turn of a node on a path; none for the root."""
    return F.when(F.col("depth") > 0, F.try_element_at("chars", F.greatest("depth", F.lit(1)))).otherwise(0)


def op12_z_fast_trie(spark: SparkSession, folder: str) -> DataFrame:
    turns = spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return trie(rebuilt(stage(sequences(turns), "sequences")))


OP12_SQL = """
    WITH turns AS (
        SELECT conv_id, md5(strlen(role) || ':' || role || text) AS digest, length(text) AS chars, turn
        FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)),
    placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) AS place FROM turns),
    convs AS (
        SELECT conv_id, conv_id - conv_id % 100 AS first_id,
            xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
                lambda a, b: list_reduce(list_concat([xor(a, b)], range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 6 AS h
        FROM (SELECT DISTINCT conv_id FROM turns)),
    joined AS (
        SELECT c.conv_id, 0 AS part, p.place, p.digest, p.chars FROM convs c JOIN placed p ON p.conv_id = c.first_id AND p.place <= c.h
        UNION ALL SELECT c.conv_id, 1, p.place, p.digest, p.chars FROM convs c JOIN placed p ON p.conv_id = c.conv_id AND p.place > c.h),
    prefixes AS (
        SELECT conv_id, string_agg(digest, '') OVER w AS node, row_number() OVER w AS depth, chars,
            row_number() OVER w = count(*) OVER (PARTITION BY conv_id) AS ends
        FROM joined WINDOW w AS (PARTITION BY conv_id ORDER BY part, place)
        UNION ALL SELECT conv_id, '', 0, 0, conv_id NOT IN (SELECT conv_id FROM joined) FROM convs),
    nodes AS (
        SELECT node, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars,
            sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256,
            CASE WHEN any_value(depth) > 0 THEN left(node, length(node) - 32) END AS above
        FROM prefixes GROUP BY node),
    children AS (SELECT above AS node, count(*) AS n FROM nodes WHERE above IS NOT NULL GROUP BY above),
    subtrees AS (
        SELECT left(node, CAST(32 * d AS INTEGER)) AS node, sum(leaf) AS n_leaves, sum(saved) AS saved_tokens
        FROM (SELECT n.node, unnest(range(0, n.depth + 1)) AS d, CAST(c.n IS NULL AS INTEGER) AS leaf, (n.n_convs - 1) * n.chars AS saved
              FROM nodes n LEFT JOIN children c USING (node)) GROUP BY ALL)
    SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children,
        CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
    FROM nodes n LEFT JOIN nodes p ON p.node = n.above LEFT JOIN children c ON c.node = n.node JOIN subtrees s ON s.node = n.node"""

"""The prefix trie against nested dictionaries."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from pitwall.llm import tries

TURNS = "conv_id long, turn long, role string, text string, path string, node string, line string"


def brute(rows, every=100):
    """Rows of the trie from (conv_id, turn, role, text)."""
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            pair = (role or "", text or "")
            digest = hashlib.md5(f"{len(pair[0].encode())}:{pair[0]}{pair[1]}".encode()).hexdigest()
            convs[c].append((turn is not None, turn or 0, digest, pair))
    own = {c: [x[-1] for x in sorted(v)] for c, v in convs.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 6
        whole = tuple(own.get(c - c % every, [])[:h] + own[c][h:])
        ends[whole].append(c)
        for d in range(len(whole) + 1):
            members[whole[:d]].append(c)
    out = []
    for node, ids in members.items():
        under = [x for x in members if x[: len(node)] == node]
        children = [x for x in under if len(x) == len(node) + 1]
        leaves = [x for x in under if not any(len(y) == len(x) + 1 and y[: len(x)] == x for y in members)]
        saved = sum((len(members[x]) - 1) * len(x[-1][1]) for x in under if x)
        over = min(members[node[:-1]]) if node else None
        out.append((min(ids), len(node), over, len(ids), len(children), len(leaves), saved,
                    hashlib.sha256(",".join(map(str, ends.get(node, []))).encode()).hexdigest()))
    return sorted(out, key=repr)


def talks():
    rng = random.Random(6)
    rows = []
    for c in range(120):
        for k in range(rng.randrange(1, 8)):
            rows.append((c, k, rng.choice(["user", "assistant"]), rng.choice(["hi", "no", "Ünï 🙂"])))
    rows += [(200 + c, k, "user", f"same {k}") for c in range(60) for k in range(5)]  # copies
    rows += [(300 + c, k, "user", "first" if k == 0 else f"{c % 30} {k}") for c in range(60) for k in range(3)]  # one first turn
    rows += [(1000, k, "user", f"long {k % 5}") for k in range(150)] + [(1001, k, "user", f"long {k % 5}") for k in range(140)]
    rows += [(5, None, "user", "before"), (7, None, None, None), (7, None, None, None), (7, 3, "user", "tie"), (7, 3, "assistant", "tie"), (None, 1, "user", "x"),
             (-250, 0, "user", "minus"), (2**62, 0, "user", "large"), (9001, 0, "", ""), (9002, 0, "", None), (9003, 0, None, "x" * 70_000)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("shard_turns", [8, 60, 100_000])
def test_trie(spark, shard_turns):
    rows = talks()
    turns = spark.createDataFrame([r + ("x", "y", "z") for r in rows], TURNS).repartition(6)
    got = tries.trie(tries.rebuilt(tries.sequences(turns)), shard_turns)
    positive = [r for r in rows if r[0] is None or r[0] >= 0]
    want = brute(positive + [r for r in rows if r[0] is not None and r[0] < 0])
    assert got.columns == [x.split()[0] for x in tries.NODES.split(", ")]
    assert sorted(map(tuple, got.collect()), key=repr) == want


def test_no_conversation(spark):
    for rows in ([], [(None, 1, "user", "x", "", "", "")]):
        assert tries.trie(tries.rebuilt(tries.sequences(spark.createDataFrame(rows, TURNS)))).count() == 0


def test_pieces_of_ids(spark, monkeypatch):
    """The digest of many ids does not depend on how they are cut."""
    rows = [(b"a", c) for c in range(5000)] + [(b"b", 7)]
    monkeypatch.setattr(tries, "CHUNK_BYTES", 100)
    import pyarrow as pa

    def batches():
        for at in range(0, len(rows), 999):
            part = rows[at : at + 999]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in part], pa.binary()), pa.array([r[1] for r in part])], ["whole", "conv_id"])

    pieces = list(tries._runs(batches()))
    assert sum(len(b) for b in pieces) > 100
    ends = {r["conv_id"]: r for b in tries._digests(iter(pieces)) for r in b.to_pylist()}
    assert ends[0] == {"conv_id": 0, "copies": 5000, "ends": hashlib.sha256(",".join(map(str, range(5000))).encode()).hexdigest()}
    assert ends[7]["ends"] == hashlib.sha256(b"7").hexdigest() and len(ends) == 2


def test_exit_nodes():
    """A fat binary search finds the deepest node that a path enters, as a walk does."""
    rng = random.Random(8)

    def path(words, n):
        held, digests = b"", []
        for w in words:
            held = hashlib.md5(held + w.encode()).digest()
            digests.append(held)
        return tries.Path(digests, [1] * len(words), n, 1, "")

    words = {("s", *(rng.choice("ab") for _ in range(rng.randrange(0, 14)))) for _ in range(300)}
    paths = [path(w, n) for n, w in enumerate(sorted(words, key=lambda w: rng.random()))]
    trie = tries.ZFastTrie(0)
    for at in range(0, len(paths), 40):
        trie.insert(paths[at : at + 40])
    assert {trie._handle(x) for x in trie.nodes} == set(trie.handles)
    for p in paths:
        node = trie.top
        while node.top < len(p.digests) and node.path.digests[: node.top] == p.digests[: node.top]:
            node = node.children[p.digests[node.top]]
        assert trie.exit_node(p) is node and node.top == len(p.digests) and node.ended is p

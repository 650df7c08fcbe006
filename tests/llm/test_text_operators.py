"""Operators on documents against brute force over the awkward corpus."""

import hashlib
import math
import re
import time
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from pitwall.llm import decontaminate as dec
from pitwall.llm import language, lines, minhash, pieces, quality, sharding, suffixes
from pitwall.llm.components import components
from pitwall.session import work_dir

FOLDER = "/root/testdata/sf0.001"
WORDS = [f"w{k}{'aeiou'[k % 5]}" for k in range(400)]


def lower(text):
    return (text or "").encode().lower()


# -- near duplicates ---------------------------------------------------------------------------------------------------


def near_brute(rows, n, percent):
    sets = []
    for _, text, *_ in rows:
        w = lower(text).split()
        sets.append({tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set()))
    parent = {r[0]: r[0] for r in rows if r[0] is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if rows[i][0] is not None and rows[j][0] is not None and a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(rows[i][0]), find(rows[j][0])
                parent[max(x, y)] = min(x, y)
    return Counter((r[0], len(s), None if r[0] is None else find(r[0])) for r, s in zip(rows, sets, strict=True))


@pytest.mark.parametrize("n", [4, 5])
def test_near_duplicates(docs, corpus, n):
    got = minhash.near_duplicates(docs, n=n).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == near_brute(corpus, n, 80)
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in got)


def test_near_duplicates_of_nothing(no_docs, clashing, corpus):
    assert minhash.near_duplicates(no_docs).count() == 0
    assert minhash.near_duplicates(clashing).count() == len(corpus)


def test_group_of_graded_copies(spark):
    """A bucket's hub does not see all links: copies that differ from it more and more, in pairs that agree."""
    base = [f"t{k}" for k in range(200)]
    rows = []
    for g in range(40):
        words = base.copy()
        for k in range(g):  # g changed words
            words[(k * 5) % 200] = f"c{k}"
        for copy in (0, 1):
            rows.append((10 * g + copy, " ".join([*words[:199], f"end{g}{copy}"]), None, None))
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), n=4).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == near_brute(rows, 4, 80)


def test_blocks_find_what_hubs_leave_apart():
    """Two pairs in one bucket: each pair agrees, the pairs do not."""
    import pyarrow as pa

    one, two = np.arange(128, dtype=np.uint8), np.arange(128, 256, dtype=np.uint8)
    base = np.arange(128, dtype=np.uint32).tobytes()
    key = int(minhash.band_keys(np.frombuffer(base, np.uint32).reshape(1, -1), 4)[0, 0])
    sig = [one.tobytes(), two.tobytes(), one.tobytes(), two.tobytes()]
    batch = pa.RecordBatch.from_arrays(
        [pa.array([1, 1, 1, 1], pa.int64()), pa.array([0, 0, 0, 0], pa.int32()), pa.array([1, 2, 3, 4], pa.int64()),
         pa.array([1, 2, 3, 4], pa.int64()), pa.array(sig, pa.binary()), pa.array([base] * 4, pa.binary()), pa.array([key] * 4)],
        ["block", "side", "node", "comp", "sig", "base", "key"])
    halves = [batch.slice(0, 3), batch.slice(3)]  # a block over two batches
    pairs = {(a, b) for out in minhash._apart(0.6, 4)(iter(halves)) for a, b in zip(*(c.to_pylist() for c in out.columns), strict=True)}
    assert pairs == {(1, 3), (2, 4)}


def test_components_of_a_long_path(spark):
    edges = [(k, k + 1) for k in range(0, 60)] + [(100, 200), (150, 200)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(61), 0), 100: 100, 200: 100, 150: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# -- decontamination ---------------------------------------------------------------------------------------------------


def matches_brute(text, items, window):
    word = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    w = word.findall(lower(text))
    hit, found = [False] * len(w), set()
    for i, t in items:
        k = word.findall(lower(t))
        d = min(window, len(k))
        own = {tuple(k[a : a + d]) for a in range(len(k) - d + 1)} if k else set()
        for a in range(len(w) - d + 1):
            if tuple(w[a : a + d]) in own:
                hit[a : a + d] = [True] * d
                if i is not None:
                    found.add(str(i))
    spans, turn = [], np.flatnonzero(np.diff([0, *map(int, hit), 0]))
    for s, e in zip(turn[::2].tolist(), turn[1::2].tolist(), strict=True):
        spans.append((s, e))
    return len(w), tuple(spans), tuple(sorted(found))


@pytest.fixture(scope="module")
def items(corpus):
    texts = {i: t for i, t, *_ in corpus if t}
    cut = [" ".join(texts[i].split(" ")[2:16]).upper() for i in (61, 62, 95)]
    return [(1, cut[0]), (2, cut[1] + " and more"), (3, cut[2]), (4, "w0a"), (5, None), (6, ""), (7, "!!"), (None, cut[0]), (8, cut[0]), (9, "日本語 🙂")]


@pytest.mark.parametrize("block_bytes", [1 << 24, 60])
def test_matches(spark, docs, corpus, items, block_bytes, monkeypatch):
    monkeypatch.setattr(dec, "BLOCK_BYTES", block_bytes)  # the second takes several passes
    table = spark.createDataFrame(items, "item_id long, text string")
    got = Counter((r.doc_id, r.n_words, tuple((s.start, s.end) for s in r.spans), tuple(sorted(r["items"]))) for r in dec.matches(docs, table).collect())
    assert got == Counter((r[0], *matches_brute(r[1], items, dec.WINDOW)) for r in corpus)
    clean = dec.decontaminate(docs, table)
    assert Counter(map(tuple, clean.collect())) == Counter(r for r in corpus if not matches_brute(r[1], items, dec.WINDOW)[1])
    assert clean.columns == docs.columns


def test_no_items_and_no_documents(spark, docs, no_docs, clashing, corpus):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "w0a")], "item_id long, text string")
    assert dec.matches(no_docs, some).count() == 0 and dec.decontaminate(no_docs, some).count() == 0
    assert dec.decontaminate(docs, none).count() == len(corpus)
    assert dec.decontaminate(clashing, none).columns == clashing.columns


def test_suffix_array_and_longest_match():
    rng = np.random.default_rng(2)
    tokens, starts = rng.integers(1, 4, 300).astype(np.uint64), np.array([0, 0, 90, 91, 200, 300, 300])
    s = dec.suffix_array(tokens, starts, 300)
    end = np.repeat(starts[1:], np.diff(starts))
    assert s.order.tolist() == sorted(range(300), key=lambda p: (tokens[p : end[p]].tolist(), 0)) or [
        tokens[p : end[p]].tolist() for p in s.order] == sorted(tokens[p : end[p]].tolist() for p in range(300))
    pattern = tokens[120:150]
    at = dec.bisect(s, pattern, np.array([0]), np.array([30]), False)
    assert dec.common_words(s, s.order[at], pattern, np.array([0]), np.array([30]))[0][0] == 30


# -- repeated passages -------------------------------------------------------------------------------------------------


def repeats_brute(rows, length):
    big = 1 << 62
    first = {}
    for i, text, *_ in rows:
        b, i = (text or "").encode(), big if i is None else i
        for p in range(len(b) - length + 1):
            w = b[p : p + length]
            first[w] = min(first.get(w, big), i)
    out = []
    for i, text, *_ in rows:
        b = (text or "").encode()
        gone = np.zeros(len(b) + 1, int)
        for p in range(len(b) - length + 1):
            if first[b[p : p + length]] < (big if i is None else i):
                gone[p] += 1
                gone[p + length] -= 1
        on = np.cumsum(gone[:-1]) > 0
        turn = np.flatnonzero(np.diff(np.r_[False, on, False])).tolist()
        out.append((i, len(b), tuple(zip(turn[::2], turn[1::2], strict=True)), np.frombuffer(b, np.uint8)[~on].tobytes()))
    return Counter(out)


@pytest.mark.parametrize(("length", "size"), [(50, 1 << 22), (50, 3000), (31, 5000)])
def test_remove_repeats(docs, corpus, length, size):
    cut = suffixes.remove_repeats(docs, length, chunk_bytes=size, bucket_text=20_000, part_text=20_000).collect()
    got = Counter((r.doc_id, r.n_bytes, tuple((s.start, s.end) for s in r.spans), bytes(r.kept)) for r in cut)
    assert got == repeats_brute(corpus, length)


def test_remove_repeats_of_nothing(no_docs, clashing, corpus):
    assert suffixes.remove_repeats(no_docs).count() == 0
    assert suffixes.remove_repeats(clashing).count() == len(corpus)


def test_merge_gives_order_and_common_prefixes():
    rng = np.random.default_rng(3)
    for k in (1, 2, 3, 7):
        runs = [sorted(bytes(rng.integers(0, 3, 12).astype(np.uint8)) for _ in range(rng.integers(0, 40))) for _ in range(k)]
        runs[0] = runs[0] or [b"\0" * 12]
        order, common = suffixes.merge(runs, 12)
        flat = [x for r in runs for x in r]
        got = [flat[i] for i in order]
        assert got == sorted(flat)
        for a, b, c in zip(got, got[1:], common[1:].tolist(), strict=False):
            assert c == next((i for i in range(12) if a[i] != b[i]), 12)


# -- tokens ------------------------------------------------------------------------------------------------------------


def test_pieces_equal_the_library(docs, clashing, no_docs, corpus):
    sentencepiece = pytest.importorskip("sentencepiece")
    known = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    got = Counter((r.doc_id, None if r.ids is None else tuple(r.ids), r.decoded) for r in pieces.decode(pieces.encode(docs)).select("doc_id", "ids", "decoded").collect())
    assert got == Counter((r[0], None if r[1] is None else tuple(known.encode(r[1])), r[1]) for r in corpus)
    assert pieces.encode(no_docs).count() == 0
    assert pieces.encode(clashing).columns.count("ids") == 1


def test_pieces_of_odd_texts():
    sentencepiece = pytest.importorskip("sentencepiece")
    known, fst = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL), pieces.compiled(open(pieces.MODEL, "rb").read())
    rng = np.random.default_rng(4)
    alphabet = list("aehinorst  ▁.,\n\t🙂éß中<>0xA_")
    texts = ["", " ", "  a  b   c ", "<s> </s> <0x0A> <unk>", " " * 300, "the" * 200, "\x00\x01", *("".join(rng.choice(alphabet, n)) for n in range(1, 300))]
    for text in texts:
        ids = np.frombuffer(fst.encode(text), np.int32)
        assert ids.tolist() == known.encode(text), text
        assert fst.decode(ids) == known.decode(ids.tolist()) == text.replace("▁", " ")


def test_unigram_path_is_the_cheapest():
    fst = pieces.Transducer.__new__(pieces.Transducer)
    fst.kind, fst.cost, fst.worst = pieces.UNIGRAM, {"a": 3.0, "b": 3.0, "ab": 5.0, "ba": 1.0, "c": 1.0}, 20.0
    fst.arcs = pieces.automaton(fst.cost)
    assert fst.shortest("abac") == ["a", "ba", "c"] and fst.shortest("a?b") == ["a", "?", "b"]


def test_repeated_words_make_no_pairs(spark):
    """An item and a document of one word again and again: places are not multiplied by windows."""
    docs = spark.createDataFrame([(1, "w " * 20_000), (2, "w " * 9), (3, "x " + "w " * 12 + "y")], "doc_id long, text string")
    items = spark.createDataFrame([("a", "w " * 2_000), ("b", "w w w"), ("c", "w " * 10), ("c2", "w " * 10), ("d", "y x")], "item_id string, text string")
    got = {r.doc_id: (sum(x.end - x.start for x in r.spans), sorted(r["items"]), r.longest) for r in dec.matches(docs, items).collect()}
    assert got == {1: (20_000, ["a", "b", "c", "c2"], 2_000), 2: (9, ["b"], 9), 3: (12, ["a", "b", "c", "c2"], 12)}


def test_blocks_of_items_one_by_one(spark, docs, monkeypatch):
    items = spark.createDataFrame([(f"i{k}", " ".join(WORDS[k : k + 12])) for k in range(40)], "item_id string, text string")
    more = docs.unionByName(spark.createDataFrame([(500, " ".join(WORDS[:60]), "en", "a")], docs.schema))
    whole = Counter((r.doc_id, r.n_words, tuple(map(tuple, r.spans)), tuple(sorted(r["items"]))) for r in dec.matches(more, items).collect())
    clean = dec.decontaminate(more, items).count()
    monkeypatch.setattr(dec, "BLOCK_BYTES", 800)
    assert Counter((r.doc_id, r.n_words, tuple(map(tuple, r.spans)), tuple(sorted(r["items"]))) for r in dec.matches(more, items).collect()) == whole
    assert dec.decontaminate(more, items).count() == clean < more.count()


# -- language ----------------------------------------------------------------------------------------------------------


def test_language_by_compression(spark):
    import random

    rng, rows = random.Random(1), []
    syllables = {"xx": ["ka", "to", "mi", "ren"], "yy": ["schl", "ung", "ach", "ei"], "zz": ["eau", "ou", "ier", "qui"]}
    for i in range(600):
        lang = ["xx", "yy", "zz"][i % 3]
        rows.append((i, " ".join("".join(rng.choices(syllables[lang], k=rng.randint(1, 4))) for _ in range(40)), lang))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    learned = language.dictionaries(df.where("doc_id < 300"))
    assert sorted(learned) == ["xx", "yy", "zz"] and all(len(d) <= language.DICTIONARY_BYTES for d in learned.values())
    held = language.identify(df.where("doc_id >= 300"), learned).collect()
    assert sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held) and all(0 <= r.score <= 1 for r in held)


def test_language_of_long_and_of_short_texts(spark):
    """Length does not dilute the margin, and what ties in bytes is rejected."""
    import random

    rng = random.Random(2)
    syllables = {"xx": ["ka", "to", "mi", "ren", "sol"], "yy": ["schl", "ung", "ach", "ei", "wort"]}
    vocabulary = {g: ["".join(rng.choices(s, k=3)) for _ in range(120)] for g, s in syllables.items()}

    def text(lang, n):
        return " ".join(rng.choices(vocabulary[lang], k=n))

    taught = spark.createDataFrame([(text(g, 60), g) for g in ("xx", "yy") for _ in range(40)], "text string, lang string")
    learned = language.dictionaries(taught, dictionary_bytes=2048)
    rows = [(1, text("yy", 400_000)), (2, text("xx", 400_000)), (3, "Wort."), (4, "Ren."), (5, text("yy", 3)), (6, text("xx", 1_000) + text("yy", 5))]
    got = {r.doc_id: r for r in language.identify(spark.createDataFrame(rows, "doc_id long, text string"), learned).collect()}
    assert {i: r.lang_pred for i, r in got.items() if not r.rejected} == {1: "yy", 2: "xx", 5: "yy", 6: "xx"}
    assert got[3].rejected and got[4].rejected  # a word too short to be worth a reference to a dictionary


def test_letters_are_letters(spark):
    judge = language.Judge({"a": b"one two three " * 9, "b": b"eins zwei drei " * 9})
    for text in ("²", "½ ¼", "Ⅷ", "12 34", "_!", "", None, "١٢"):
        assert judge(text) == ("und", 0.0, False), text
    for text in ("ª", "x", "日本", "ж1"):
        assert judge(text)[0] in ("a", "b") and 0 <= judge(text)[1] <= 1


def test_long_texts_teach(spark):
    """A language of long texts only is learned, by a piece of each."""
    rows = [(" ".join(f"wort{k}{i}" for k in range(9000)), "long") for i in range(5)] + [("a few words", "short"), ("a few words", "short")]
    learned = language.dictionaries(spark.createDataFrame(rows, "text string, lang string"))
    assert sorted(learned) == ["long", "short"] and 0 < len(learned["long"]) <= language.DICTIONARY_BYTES
    parts = learned["long"].decode().strip().split("\n")
    assert len(parts) == 5 and all(len(x) == language.SAMPLE_CHARS and any(x in t.lower() for t, _ in rows) for x in parts)
    assert learned["short"] == b"a few words\n"


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables are not here")
def test_registered_languages_row_by_row(spark):
    """Each size anew by the library, one compressor a text, piece and dictionary."""
    import zstandard

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    held = (F.crc32(F.col("doc_id").cast("string")) % 3 == 1)
    learned = language.dictionaries(docs.where(~held))
    names = sorted(learned)

    def size(piece, dictionary, level):
        d = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(level=level)
        return len(zstandard.ZstdCompressor(dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False).compress(piece))

    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    narrow = 0
    for r in language.op8_zstd_dictionaries(spark, FOLDER).collect():
        text = texts[r.doc_id]
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        if text is None or not any(c.isalpha() for c in text):
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        raw = text.lower().encode()
        cuts = list(range(0, len(raw), language.PIECE_BYTES))
        if len(cuts) > 1 and len(raw) - cuts[-1] < language.PIECE_BYTES // 2:
            cuts.pop()
        pieces = [raw[a:b] for a, b in zip(cuts, [*cuts[1:], len(raw)], strict=True)]
        sizes = [(sum(size(x, learned[n], language.LEVEL) for x in pieces), n) for n in names]
        best, second = sorted(sizes)[:2]
        if (second[0] - best[0]) / second[0] < language.MIN_MARGIN:
            narrow += 1
            step = {n: -(-len(learned[n]) // language.PARTS) for n in names}
            part = {n: [learned[n][a : a + step[n]] for a in range(0, len(learned[n]), step[n])] for n in names}
            sizes = [(sum(size(x, d, language.FINE_LEVEL) for x in pieces for d in part[n]) / len(part[n]), n) for n in names]
            best, second = sorted(sizes)[:2]
        assert (r.lang_pred, r.score, r.rejected) == (best[1], (second[0] - best[0]) / second[0], (second[0] - best[0]) / second[0] < language.MIN_MARGIN)
    assert narrow < 0.05 * len(texts)


def test_language_of_awkward_rows(spark, docs, no_docs, clashing, corpus):
    learned = language.dictionaries(docs)
    assert sorted(learned) == ["de", "en"]
    got = {r.doc_id: r for r in language.identify(clashing, learned).collect()}
    for i in (100, 101, 102, 108):
        assert (got[i].lang_pred, got[i].score, got[i].rejected) == ("und", 0.0, True)
    assert got[105].lang_pred in learned and got[107].lang_pred in learned
    assert language.dictionaries(no_docs) == {} and language.identify(no_docs, {}).count() == 0
    assert {r.lang_pred for r in language.identify(docs, {}).collect()} == {"und"}
    one = language.identify(docs.where("doc_id = 0"), {"en": b"some text"}).first()
    assert (one.lang_pred, one.score) == ("en", 1.0)


# -- lines -------------------------------------------------------------------------------------------------------------


def test_boilerplate_lines(spark, no_docs, docs, corpus):
    rows = [(i, f"menu\nown {i}\n\nmenu", "h1") for i in range(20)] + [(100 + i, f"menu\nown {i}", None) for i in range(12)]
    rows += [(200, None, "h1"), (201, "", "h1"), (202, "menu", "h2"), (203, "menu \nmenu", "h1"), (203, "menu \nmenu", "h1")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("n_lines", F.lit("x"))
    out = lines.drop_boilerplate(df, ratio=0.5)
    got = Counter((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in out.collect())
    want = [(i, f"own {i}", 4, 3) for i in range(20)] + [(100 + i, f"own {i}", 2, 1) for i in range(12)]
    want += [(200, None, 0, 0), (201, "", 1, 1), (202, "menu", 1, 0), (203, "menu ", 2, 1), (203, "menu ", 2, 1)]
    assert got == Counter(want)
    assert lines.drop_boilerplate(no_docs).count() == 0
    assert lines.drop_boilerplate(docs).count() == len(corpus)


def test_copies_are_one_page(spark):
    rows = [(i, f"menu\nown {i}", "a") for i in range(30)] + [(100 + i, "copied\ntext", "a") for i in range(15)]
    rows += [(200 + i, None if i % 2 else "", "a") for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    got = {r.doc_id: r.text for r in lines.drop_boilerplate(df, copies=False).collect()}
    assert got == {i: f"own {i}" if i < 30 else t for i, t, _ in rows}
    assert {r.text for r in lines.drop_boilerplate(df).where("doc_id BETWEEN 100 AND 199").collect()} == {""}


# -- shards ------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("bucket_bytes", [1 << 24, 20_000])
def test_shards(spark, docs, clashing, no_docs, corpus, bucket_bytes):
    out = sharding.shuffle_shards(docs, work_dir(spark, "s"), shards=7, bucket_bytes=bucket_bytes).collect()
    assert Counter(tuple(r)[:4] for r in out) == Counter(corpus)
    by = defaultdict(list)
    for r in out:
        by[r.shard].append(r.slot)
    sizes = [len(by[s]) for s in range(7)]
    assert max(sizes) - min(sizes) <= 1 and all(sorted(v) == list(range(len(v))) for v in by.values())
    assert [r.doc_id for r in sorted(out, key=lambda r: (r.shard, r.slot))] != [r[0] for r in corpus]
    assert sharding.shuffle_shards(no_docs, work_dir(spark, "s")).count() == 0
    more = sharding.shuffle_shards(clashing, work_dir(spark, "s"))
    assert more.count() == len(corpus) and dict(more.dtypes)["slot"] == "bigint"
    few = sharding.shuffle_shards(docs.limit(3), work_dir(spark, "s"), shards=40).collect()
    assert len({r.shard for r in few}) == 3 and {r.slot for r in few} == {0}


# -- quality -----------------------------------------------------------------------------------------------------------


def kneser_ney(texts, order):
    """The model as nested dicts, and a function for the probability of a character after its context."""
    mark = chr(quality.START) * (order - 1)
    level = Counter()
    for t in texts:
        s = mark + t
        level.update(s[k : k + order] for k in range(len(s) - order + 1))
    tables = {}
    for k in range(order, 0, -1):
        n = [sum(v == i for v in level.values()) for i in range(5)]
        if min(n[1:]) > 0:
            y = n[1] / (n[1] + 2 * n[2])
            d = [max(0.0, i - (i + 1) * y * n[i + 1] / n[i]) for i in (1, 2, 3)]
        else:
            d = [0.5, 1.0, 1.5]
        total, taken = Counter(), Counter()
        for g, v in level.items():
            total[g[:-1]] += v
            taken[g[:-1]] += d[min(v, 3) - 1]
        tables[k] = ({g: (v - d[min(v, 3) - 1]) / total[g[:-1]] for g, v in level.items()}, {c: taken[c] / total[c] for c in total}, len(level))
        level = Counter(g[1:] for g in level)

    def p(gram):
        out = 1 / (tables[1][2] + 1)
        for k in range(1, order + 1):
            g = gram[-k:]
            out = tables[k][0].get(g, 0.0) + tables[k][1].get(g[:-1], 1.0) * out
        return out

    return p


def test_kneser_ney(spark):
    import random

    rng = random.Random(3)
    texts = ["".join(rng.choices("abcdé ", weights=[9, 5, 3, 1, 1, 4], k=rng.randint(1, 60))) for _ in range(80)]
    df = spark.createDataFrame([(i, t, ["x", None][i % 2]) for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    model = quality.train(df.where("doc_id < 60"))
    scored = {r.doc_id: r.perplexity for r in quality.perplexities(df, model, F.floor(F.col("doc_id") / 7)).collect()}
    again = {r.doc_id: r.perplexity for r in quality.perplexities(df, model).collect()}
    mark = chr(quality.START) * (quality.ORDER - 1)
    for odd in (0, 1):
        p = kneser_ney([t for i, t in enumerate(texts) if i < 60 and i % 2 == odd], quality.ORDER)
        assert sum(p("ab" + c) for c in "abcdé ") == pytest.approx(1, abs=0.05)
        for i, t in enumerate(texts):
            if i % 2 == odd:
                s = mark + t
                want = math.exp(-sum(math.log(p(s[k : k + quality.ORDER])) for k in range(len(t))) / len(t))
                assert scored[i] == pytest.approx(want) and again[i] == pytest.approx(want)


def test_quality_of_awkward_rows(spark, docs, no_docs, clashing, corpus):
    trusted = docs.where("doc_id < 60 AND lang = 'en'").select("doc_id")
    out = quality.classify(clashing, trusted).collect()
    assert Counter(r.doc_id for r in out) == Counter(r[0] for r in corpus)
    got = {r.doc_id: r for r in out}
    assert got[100].kept and got[100].perplexity is None and got[101].perplexity is None
    assert any(r.lang == "de" and r.perplexity is None and r.kept for r in out)  # no trusted text, no model
    assert not got[106].kept or got[106].perplexity is None
    assert quality.classify(no_docs, trusted).count() == 0
    assert all(r.kept for r in quality.classify(docs, trusted.where("false")).collect())


def test_bad_text_has_high_perplexity(spark):
    import random

    rng = random.Random(9)
    rows = [(i, " ".join("".join(rng.choices(["ka", "to", "mi", "ren"], k=3)) for _ in range(30)), "x") for i in range(400)]
    rows += [(1000 + i, "".join(rng.choices("#$%&QZX", k=200)), "x") for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = {r.doc_id: r.kept for r in quality.classify(df, df.where("doc_id < 200").select("doc_id")).collect()}
    assert all(kept[i] for i in range(400)) and not any(kept[1000 + i] for i in range(20))


def test_threshold_is_the_quantile_and_every_model_has_one(spark):
    import random

    rng = random.Random(4)
    ids = spark.range(3000).select("id", (F.pmod(F.xxhash64("id"), F.lit(quality.HELD_OUT)) == 0).alias("out")).collect()
    held = [r.id for r in ids if r.out]
    few = [r.id for r in ids if not r.out][:3]  # a language none of whose trusted texts is held out
    rows = [(r.id, "".join(rng.choices("abcdé ", weights=[9, 5, 3, 1, 1, 4], k=40)), "y" if r.id in few else "x") for r in ids]
    rows.append((5000, "#$%&QZX" * 9, "y"))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in quality.classify(df, df.where("doc_id < 3000").select("doc_id")).collect()}
    values = sorted(got[i].perplexity for i in held)
    step = math.ceil(math.log(values[math.ceil(0.99 * len(values)) - 1]) * quality.GRID)
    assert len(values) >= 300 and [*{r.threshold for r in got.values()}] == [pytest.approx(math.exp(step / quality.GRID))]
    assert not got[5000].kept and sum(not got[i].kept for i in held) <= 0.01 * len(held)


# -- digests -----------------------------------------------------------------------------------------------------------


def test_registered_digests(spark):
    """The digest columns of the queries follow from the operators' outputs."""
    from pitwall.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    cut = {(r.doc_id, r.n_removed, r.kept_sha256) for r in QUERIES["op10_front_coded_merge"](spark, folder).collect()}
    want = {(i, n - len(kept), hashlib.sha256(kept).hexdigest()) for i, n, _, kept in repeats_brute(list(docs.items()), 50)}
    assert cut == want
    for r in QUERIES["op9_external_shuffle"](spark, folder).collect():
        import zlib

        assert (r.size, r.text_crc32) == (len(docs[r.doc_id].encode()) + 16, zlib.crc32(docs[r.doc_id].encode()))


def test_fingerprints_of_several_documents_cost_a_sort():
    """The same as by sets, documents of one id count once, and in a few times the time of sorting the fingerprints."""
    rng = np.random.default_rng(3)
    a = object.__new__(suffixes.Anchors)
    a.ids = rng.integers(-50, 150, 300) * 1_000_003
    a.doc = np.sort(rng.integers(0, 300, 200_000))
    prints = rng.integers(0, 150_000, 200_000).astype(np.uint64)
    owners: dict[int, set] = {}
    for p, d in zip(prints.tolist(), a.ids[a.doc].tolist(), strict=True):
        owners.setdefault(p, set()).add(d)
    assert a.several(prints).tolist() == sorted(p for p, ids in owners.items() if len(ids) > 1)

    def seconds(run):
        times = []
        for _ in range(3):
            start = time.process_time()
            run()
            times.append(time.process_time() - start)
        return min(times)

    assert seconds(lambda: a.several(prints)) < 8 * seconds(lambda: np.argsort(prints, kind="stable"))

"""Archives, nearest neighbours, registered SQL and the pipeline."""

import base64
import gzip
import hashlib
import random
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pitwall.llm import neighbours, warc
from pitwall.llm.queries import QUERIES, SQL
from pitwall.session import work_dir
from suite.check import compare, duck

FOLDER = "/root/testdata/sf0.001"

PAGES = [
    (1, "http://a/1", "<p>x</p>"), (2, "http://a/2", "<p>x</p>"), (3, None, None), (4, "http://a/4\r\nWARC-Type: evil", ""), (5, "http://a/5", "ü\r\n\r\nWARC/1.1\r\n\r\n"),
    (6, "http://a/6", "y" * 70_000), (6, "http://a/6", "y" * 70_000), (7, "http://a/7", "y" * 70_000), (None, "http://n", "<p>x</p>"), (None, "http://n", "alone"),
]


@pytest.mark.parametrize("least", [0, 100])
def test_archives(spark, least):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    path = work_dir(spark, "warc")
    warc.write_archives(pages.withColumn("payload_digest", pages.url), path, least)
    got = Counter((r.page_id, bytes(r.payload), r.payload_digest, r.record_type, r.refers_to) for r in warc.original_payloads(warc.read_archives(spark, path)).collect())
    want = []
    for i, _, html in PAGES:
        body = (html or "").encode()
        same = [j for j, _, h in PAGES if (h or "") == (html or "") and j is not None]
        again = len(body) >= least and bool(same) and i != max(same)
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        want.append((i, body, digest, "revisit" if again else "response", max(same) if again else None))
    assert got == Counter(want)


def test_archives_of_nothing_and_of_one_payload(spark):
    none, path = spark.createDataFrame([], "page_id long, url string, html string"), work_dir(spark, "warc")
    warc.write_archives(none, path)
    assert warc.read_archives(spark, path).count() == 0
    same, path = spark.range(2000).selectExpr("id AS page_id", "'u' AS url", "'same' AS html"), work_dir(spark, "warc")
    warc.write_archives(same, path)
    kinds = Counter((r.record_type, r.refers_to) for r in warc.read_archives(spark, path).collect())
    assert kinds == {("response", None): 1, ("revisit", 1999): 1999}


def test_a_changed_payload_is_noticed(spark):
    record = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nab\r\n\r\n\r\n\r\n"
    with pytest.raises(ValueError):
        list(warc.parse(record[:-3]))


def test_ids_of_several_payloads(spark):
    pages = spark.createDataFrame([(5, "u", "aaaa"), (5, "u", "bbbbbbbbbb"), (3, "u", "aaaa"), (2, "u", "bbbbbbbbbb")], "page_id long, url string, html string")
    path = work_dir(spark, "warc")
    warc.write_archives(pages, path)
    got = Counter((r.page_id, bytes(r.payload).decode(), r.record_type, r.refers_to) for r in warc.original_payloads(warc.read_archives(spark, path)).collect())
    assert got == Counter([(5, "aaaa", "response", None), (5, "bbbbbbbbbb", "response", None), (3, "aaaa", "revisit", 5), (2, "bbbbbbbbbb", "revisit", 5)])


def test_files_are_bounded_by_bytes(spark):
    pages = spark.range(40).selectExpr("id AS page_id", "'u' AS url", "repeat(chr(cast(65 + id AS int)), 5000) AS html").coalesce(1)
    path = work_dir(spark, "warc")
    warc.write_archives(pages, path, file_bytes=20_000)
    files = spark.read.format("binaryFile").load(path).select("content").collect()
    assert 10 <= len(files) <= 20 and all(len(warc.members(bytes(f.content))) < 26_000 for f in files)
    assert warc.read_archives(spark, path).count() == 40


def test_foreign_archives(spark):
    """A member for each record, other record types, and no digest."""
    def record(kind, body, more=""):
        return f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:uuid:1>\r\n{more}Content-Length: {len(body)}\r\n\r\n{body}\r\n\r\n".encode()

    parts = [record("warcinfo", "software: x"), record("request", "GET / HTTP/1.1\r\n\r\n"), record("response", "HTTP/1.1 200 OK\r\n\r\nbody", "WARC-Target-URI: http://a\r\n"),
             record("resource", "plain"), record("metadata", "a: b")]
    path = Path(work_dir(spark, "foreign").removeprefix("file:"))
    path.mkdir(parents=True)
    (path / "a.warc.gz").write_bytes(b"".join(gzip.compress(x) for x in parts))
    got = {r.record_type: (r.page_id, r.payload, r.payload_digest is not None) for r in warc.read_archives(spark, str(path)).collect()}
    assert got == {"warcinfo": (None, None, False), "request": (None, None, False), "response": (None, b"body", True), "resource": (None, b"plain", True), "metadata": (None, None, False)}
    with pytest.raises(ValueError):
        warc.members(gzip.compress(b"x" * 900)[:-9])


def test_vectors_of_doubles(spark):
    """Scores come from the original numbers, also those beyond single precision; a query row that is repeated counts by its smallest vector."""
    rows = [(1, [1e200, 2e200]), (2, [2e-200, 4e-200]), (3, [1.0, 2.0 + 1e-12]), (4, [1.0, -2.0]), (5, [3.0, 1.0]), (6, [1e300, 1e-300]), (7, [1.0, 2.0]), (7, [-1.0, 0.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    asked = df.select(F.col("vec_id").alias("query_id"), "embedding")
    got = neighbours.nearest(neighbours.build(df, 3), asked, 3).collect()
    vectors = {1: [1.0, 2.0], 2: [1.0, 2.0], 6: [1.0, 0.0]}
    plain = [(i, vectors.get(i, v)) for i, v in rows]

    def cosine(a, b):
        return float(np.dot(a, b) / (np.linalg.norm(a) * np.linalg.norm(b)))

    for q in range(1, 8):
        v = [-1.0, 0.5] if q == 7 else dict(plain)[q]
        want = sorted(((-cosine(v, w), i) for i, w in plain if i != q))[:3]
        mine = sorted((r["rank"], r.vec_id, r.score) for r in got if r.query_id == q)
        # Found in single precision, scored in double.
        assert [x[2] for x in mine] == pytest.approx([-s for s, _ in want], abs=1e-7), q
        for _, i, score in mine:
            assert any(score == pytest.approx(cosine(v, w), abs=1e-15) for j, w in plain if i == j), (q, i)


def exact(rows, queries, k):
    out = {}
    keep = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    for q, v in keep:
        if q in queries:
            near = [(-float((v * w).sum() / (np.sqrt((v * v).sum()) * np.sqrt((w * w).sum()))), i) for i, w in keep if i != q and len(w) == len(v)]
            out[q] = [(i, -s) for s, i in sorted(near)[:k]]
    return out


def test_nearest(spark):
    rng = np.random.default_rng(6)
    near = rng.normal(size=(60, 8)).round(2)
    rows = [(i, near[i % 60].tolist()) for i in range(0, 90)] + [(100 + i, [1.0, 0.0, 0.5]) for i in range(9)] + [(200 + i, near[0].tolist()) for i in range(30)]
    rows += [(300, None), (301, []), (302, [0.0] * 8), (303, [float("nan")] * 8), (304, [None] * 8), (305, [float("inf")] * 8), (306, [1e30] * 8),
             (307, [1e-30] * 8), (None, [1.0] * 8)]
    schema = "vec_id long, embedding array<float>"
    vectors = spark.createDataFrame(rows, schema)
    rows = [(r.vec_id, r.embedding) for r in vectors.collect()]
    queries = vectors.where("vec_id % 10 = 0 OR vec_id = 306").withColumnRenamed("vec_id", "query_id")
    got: dict = {}
    for r in neighbours.nearest(neighbours.build(vectors, 5, shard_nodes=20), queries, 5).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(got[r.query_id])
    want = exact(rows, {i for i, _ in rows if i is not None and (i % 10 == 0 or i == 306)}, 5)
    assert set(got) == set(want)
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]], q
        assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]], atol=1e-14)
    none = spark.createDataFrame([], schema)
    assert neighbours.nearest(neighbours.build(none, 5), queries, 5).count() == 0


def test_recall(spark):
    vectors = spark.read.parquet(f"{FOLDER}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in vectors.collect()]
    found = {(r.query_id, r.vec_id) for r in QUERIES["op2_hnsw"](spark, FOLDER).collect()}
    want = {(q, i) for q, near in exact(rows, {i for i, _ in rows if i % 50 == 0}, 5).items() for i, _ in near}
    assert len(found & want) >= 0.9 * len(want)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equal_to_sql(spark, name):
    assert compare(spark, duck(FOLDER), QUERIES[name], SQL[name], FOLDER) is None


def test_registered_once_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_pipeline(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "decontaminate", "tokens"]
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    before = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, FOLDER)
        assert after.columns == docs.columns
        path = work_dir(spark, "stage")
        after.write.parquet(path)
        after = spark.read.parquet(path)
        assert 0 < after.count() <= before.count()
        before = after
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    assert len(rows) == before.count() and all(r.round_trip for r in rows)


def test_pipeline_of_awkward_and_of_no_rows(spark, clashing, no_docs):
    for docs in (clashing, no_docs):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, FOLDER)
            assert name == "tokens" or docs.columns == columns
            path = work_dir(spark, "stage")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)


def test_pipeline_keeps_one_of_a_large_group_of_copies(spark):
    """Stages 4 and 3 by brute force: boilerplate counted over different pages, then one document of each group of copies."""
    rng = random.Random(8)
    words = [f"w{k}" for k in range(500)]

    def own():
        return "\n".join(" ".join(rng.choices(words, k=12)) for _ in range(4))

    rows = [(i, f"site menu\n{own()}", "en", "a") for i in range(40)] + [(100 + i, own(), "en", "b") for i in range(30)]
    copied, other = f"site menu\n{own()}", own()
    rows += [(200 + i, copied, "en", "a") for i in range(35)] + [(300 + i, other, "en", "b") for i in range(12)]
    menu = {}
    for source in "ab":
        pages = {t for _, t, _, s in rows if s == source}
        n = Counter(x for t in pages for x in set(t.split("\n")))
        menu[source] = {x for x, k in n.items() if k >= 10 and k > 0.1 * len(pages)}
    want = {}
    for i, t, _, s in sorted(rows):
        left = "\n".join(x for x in t.split("\n") if x not in menu[s])
        want.setdefault(left, i)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(4)
    for name, stage in corpus_pipeline.STAGES:
        if name in ("line_dedup", "near_dedup"):
            docs = stage(spark, docs, FOLDER)
    got = {r.text: r.doc_id for r in docs.collect()}
    assert got == want and menu == {"a": {"site menu"}, "b": set()}


def test_nothing_else_imports_the_subpackage():
    root = Path(__file__).resolve().parents[2]
    for top in ("pitwall", "suite", "tests"):
        for p in (root / top).rglob("*.py"):
            if "llm" not in p.parent.parts:
                assert "pitwall.llm" not in p.read_text(), p

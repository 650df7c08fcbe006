"""Quality by perplexity under an interpolated modified Kneser-Ney model of characters, trained on trusted text.

All tables of the model are DataFrames, sharded by n-gram: counts are summed over all trusted text, continuation counts,
discounts and weights follow by grouping and joining. A block of neighbouring documents asks for the probabilities of its
distinct n-grams in one join, and its texts are scored with the answers.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401 - pa.compute
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitwall.llm.memory import tidy
from pitwall.llm.packing import pack, runs, unpack
from pitwall.llm.words import mix
from pitwall.session import stage

ORDER = 4
START = 2  # stands ORDER - 1 times before each text
QUANTILE = 0.99
SLACK = 1.0  # a multiplier of the quantile; 1 is the quantile itself
HELD_OUT = 5  # one in so many trusted documents is not trained on and sets the thresholds
GRID = 1000  # steps of log perplexity between which quantiles are not told apart
LEAST_TRUSTED = 30
CONFIDENCE = 0.95  # of a bound of the quantile where there are too few values to see it
BLOCK_ROWS = 16384
SLICE_CHARS, PACKED_CHARS = 1 << 20, 4 << 20
# Ids of trusted documents that are broadcast; more of them are joined by a shuffle.
BROADCAST_IDS = 2_000_000


def _characters(texts: list[str | None], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the texts, each after order - 1 start marks, and where each begins (marks included)."""
    mark = chr(START) * (order - 1)
    points = [np.frombuffer((mark + (t or "")).encode("utf-32-le"), np.uint32) for t in texts]
    return np.concatenate(points) if points else np.zeros(0, np.uint32), np.r_[0, np.cumsum([len(p) for p in points])].astype(np.int64)


def _keys(points: np.ndarray, order: int) -> np.ndarray:
    """A 64-bit key for each run of ``order`` characters."""
    n = max(0, len(points) - order + 1)
    key = np.zeros(n, np.uint64)
    for k in range(order):
        key *= np.uint64(0x9E3779B97F4A7C15)
        key += points[k : k + n].astype(np.uint64) + np.uint64(1)
    return mix(key)


def _language(lang: str | None) -> np.uint64:
    return mix(np.array([zlib.crc32((lang or "").encode()) + (lang is not None)], np.uint64))[0]


def _slices(column: pa.Array, most: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    at = to = size = 0
    lengths = pa.compute.utf8_length(column).fill_null(0).to_pylist()
    for to, n in enumerate(lengths, 1):
        size += n
        if size >= most:
            yield at, to
            at, size = to, 0
    if at < to:
        yield at, to


def _grams(order: int, counted: bool):
    """(block, lang, gram[, n]): n-grams by block and language, with counts if asked for.

    Without counts, an n-gram is told once for each run of rows of one block.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told: dict[str | None, np.ndarray] = {}
        current: int | None = None
        for batch in batches:
            for at, to in _slices(batch.column(2)):
                blocks, langs, texts = (c.slice(at, to - at).to_pylist() for c in batch.columns)
                groups: dict[tuple[int, str | None], list[str | None]] = {}
                for b, g, t in zip(blocks, langs, texts, strict=True):
                    groups.setdefault((b, g), []).append(t)
                for (block, lang), own in groups.items():
                    points, starts = _characters(own, order)
                    inside = np.ones(len(points), bool)  # n-grams that end in a text, not in the next one's marks
                    for k in range(order - 1):
                        inside[starts[:-1] + k] = False
                    ends = np.flatnonzero(inside)
                    if not len(ends):
                        continue
                    keys, first, n = np.unique(_keys(points, order)[ends - order + 1], return_index=True, return_counts=True)
                    if not counted:
                        if block != current:
                            told, current = {}, block
                        known = told.get(lang, keys[:0])
                        fresh = ~np.isin(keys, known, assume_unique=True)
                        first, told[lang] = first[fresh], np.union1d(known, keys)
                        if not len(first):
                            continue
                    flat = points[(ends[first] - order + 1)[:, None] + np.arange(order)].astype("<u4").tobytes().decode("utf-32-le")
                    # With one code point a character, n-grams are equal slices.
                    grams = pa.array([flat[i : i + order] for i in range(0, len(flat), order)], pa.string())
                    columns = [pa.array([block] * len(grams), pa.int64()), pa.array([lang] * len(grams), pa.string()), grams]
                    names = ["block", "lang", "gram"]
                    yield pa.RecordBatch.from_arrays(columns + [pa.array(n, pa.int64())] * counted, names + ["n"] * counted)

    return tidy(run)


def _discount(n: Column) -> Column:
    return F.when(n == 1, F.col("d1")).when(n == 2, F.col("d2")).otherwise(F.col("d3"))


def train(trusted: DataFrame, order: int = ORDER) -> dict[int, tuple[DataFrame, DataFrame]]:
    """The model of (lang, text) rows: for each order k the tables alpha (lang, gram, alpha) and gamma (lang, ctx, gamma).

    The probability of a character after its context is alpha of the k-gram (0 if it is unseen) plus gamma of the context
    (1 if unseen) times the probability one order below; below order 1 it is 1 over the number of characters and one unknown.
    The highest order has counts, the lower ones numbers of different characters before the k-gram. Each order and language has
    the three discounts of modified Kneser-Ney, from its numbers of k-grams that occur once to four times; where one of
    these is 0, the discounts are 0.5, 1 and 1.5. Each language, null too, has a model of its own.
    """
    shown = trusted.select(F.lit(0).cast("long").alias("block"), "lang", "text")
    counts = shown.mapInArrow(_grams(order, True), "block long, lang string, gram string, n long")
    level = stage(counts.groupBy("lang", "gram").agg(F.sum("n").alias("n")), "grams")
    out: dict[int, tuple[DataFrame, DataFrame]] = {}
    for k in range(order, 0, -1):
        n = F.col("n")
        tally = level.groupBy("lang").agg(*[F.count(F.when(n == i, 1)).cast("double").alias(f"n{i}") for i in (1, 2, 3, 4)],
                                          F.count("*").alias("kinds"))
        y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))
        usable = F.least("n1", "n2", "n3", "n4") > 0
        d = tally.select(
            F.col("lang").alias("_lang"), "kinds",
            *[F.when(usable, F.greatest(F.lit(0.0), i - (i + 1) * y * F.try_divide(F.col(f"n{i + 1}"), F.col(f"n{i}")))).otherwise(i / 2).alias(f"d{i}")
              for i in (1, 2, 3)])
        known = level.join(F.broadcast(d), level["lang"].eqNullSafe(d["_lang"])).drop("_lang").withColumn("ctx", F.substring("gram", 1, k - 1))  # a row a language
        contexts = known.groupBy("lang", "ctx").agg(F.sum("n").alias("total"), F.sum(_discount(n)).alias("taken"), F.max("kinds").alias("kinds"))
        gamma = contexts.select("lang", "ctx", F.when(F.lit(k) > 1, F.col("taken") / F.col("total")).otherwise(
            F.col("taken") / F.col("total") / (F.col("kinds") + 1)).alias("gamma"))
        c = contexts.select(F.col("lang").alias("_lang"), F.col("ctx").alias("_ctx"), "total")
        alpha = known.join(c, (known["ctx"] == c["_ctx"]) & known["lang"].eqNullSafe(c["_lang"])).select(
            "lang", "gram", ((n - _discount(n)) / F.col("total")).alias("alpha"))
        out[k] = stage(alpha, f"alpha{k}"), stage(gamma, f"gamma{k}")
        level = level.groupBy("lang", F.substring("gram", 2, k - 1).alias("gram")).agg(F.count("*").alias("n"))
    return out


def log_probabilities(grams: DataFrame, model: dict[int, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """(lang, gram, logp) of distinct (lang, gram) rows, by one join for each table of the model; null without a model."""
    order = max(model)
    out = grams.select("lang", "gram", F.lit(1.0).alias("p"))
    for k in range(1, order + 1):
        alpha, gamma = model[k]
        own = F.substring("gram", order - k + 1, k)
        out = out.withColumn("_own", own).withColumn("_ctx", F.substring("gram", order - k + 1, k - 1))
        a = alpha.select(F.col("lang").alias("_lang"), F.col("gram").alias("_gram"), "alpha")
        out = out.join(a, (out["_own"] == a["_gram"]) & out["lang"].eqNullSafe(a["_lang"]), "left").drop("_lang", "_gram")
        g = gamma.select(F.col("lang").alias("_lang"), F.col("ctx").alias("_known"), "gamma")
        out = out.join(g, (out["_ctx"] == g["_known"]) & out["lang"].eqNullSafe(g["_lang"]), "left")
        # gamma of order 1 has the share of an unknown character; without one, the language has no model.
        weight = F.col("gamma") if k == 1 else F.coalesce("gamma", F.lit(1.0))
        out = out.select("lang", "gram", (F.coalesce("alpha", F.lit(0.0)) + weight * F.col("p")).alias("p"))
    return out.select("lang", "gram", F.log("p").alias("logp"))


def _packed(order: int):
    """(block, docs, text): neighbouring rows of a block in one, compressed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to in _slices(batch.column(3), PACKED_CHARS):
                blocks = batch.column(0).slice(at, to - at).to_numpy()
                for s, e in runs(blocks):
                    ids, langs, texts = (batch.column(c).slice(at + s, e - s) for c in (1, 2, 3))
                    texts = texts.to_pylist()
                    sizes = np.array([-1 if t is None else len(t.encode()) for t in texts], np.int64)
                    body = zstandard.compress("".join(t or "" for t in texts).encode(), 6)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([blocks[s]], pa.int64()), pa.array([ids.to_pylist()], pa.list_(pa.int64())), pa.array([langs.to_pylist()], pa.list_(pa.string())),
                         pa.array([pack(sizes=sizes)], pa.binary()), pa.array([body], pa.binary())], ["block", "ids", "langs", "sizes", "text"])

    return tidy(run)


def _table(order: int):
    """(block, answers): the n-grams of a block by key, sorted, with their log probabilities."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                a = batch.column(1)[row].values
                points = np.frombuffer("".join(a.field("gram").to_pylist()).encode("utf-32-le"), np.uint32)
                codes = pa.compute.dictionary_encode(a.field("lang"), null_encoding="encode")
                seed = np.array([_language(x) for x in codes.dictionary.to_pylist()], np.uint64)[codes.indices.to_numpy()]
                keys = _keys(points, order)[::order] ^ seed
                by = np.argsort(keys)
                value = a.field("logp").to_numpy(zero_copy_only=False)[by]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, 1), pa.array([pack(keys=keys[by], value=value)], pa.binary())], ["block", "answers"])

    return tidy(run)


def _score(order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                ids, langs, sizes, text, answers = (batch.column(c)[row] for c in range(batch.num_columns))
                ids, langs = ids.as_py(), langs.as_py()
                (size,) = unpack(sizes.as_py())
                body = zstandard.decompress(text.as_py()) if size.max(initial=0) > 0 else b""
                table, value = unpack(answers.as_py()) if answers.is_valid else (np.zeros(0, np.uint64), np.zeros(0))
                sums, n = [], []
                at = 0
                for lang, s in zip(langs, size.tolist(), strict=True):
                    own = body[at : at + max(0, s)].decode()
                    at += max(0, s)
                    points, _ = _characters([own], order)
                    keys = _keys(points, order) ^ _language(lang)
                    n.append(len(own))
                    sums.append(float(value[np.searchsorted(table, keys)].sum()) if len(own) else None)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(langs, pa.string()), pa.array(n, pa.int64()),
                     pa.array([None if x is None or np.isnan(x) else x for x in sums], pa.float64())], ["doc_id", "lang", "n_chars", "logp"])

    return tidy(run)


def perplexities(docs: DataFrame, model: dict[int, tuple[DataFrame, DataFrame]], block: Column | None = None) -> DataFrame:
    """(doc_id, lang, n_chars, perplexity) for each row of ``docs`` (doc_id, text, lang), by characters.

    ``block`` is a number that neighbouring rows share; it only decides how many n-grams are asked for more than once. By
    default it is a hash of the doc_id. Null and empty texts, and languages without a model, have a null perplexity.
    """
    order = max(model)
    if block is None:
        size = docs.count() // BLOCK_ROWS + 1
        block = F.pmod(F.xxhash64("doc_id"), F.lit(size)).cast("long")
    rows = docs.select(block.alias("block"), "doc_id", "lang", "text")
    asked = stage(rows.select("block", "lang", "text").mapInArrow(_grams(order, False), "block long, lang string, gram string"), "asked")
    known = log_probabilities(asked.select("lang", "gram").distinct(), model).select(F.col("lang").alias("_lang"), F.col("gram").alias("_gram"), "logp")
    answers = (asked.join(known, (asked["gram"] == known["_gram"]) & asked["lang"].eqNullSafe(known["_lang"]))
               .groupBy("block").agg(F.collect_list(F.struct("lang", "gram", "logp")).alias("answers"))  # n-grams of one block
               .mapInArrow(_table(order), "block long, answers binary"))
    parts = asked.agg(F.count_distinct("block")).first()[0] or 1  # a block's texts and its answers meet in one task
    packed = rows.mapInArrow(_packed(order), "block long, ids array<long>, langs array<string>, sizes binary, text binary")
    return (packed.repartition(min(parts, 100_000), "block").join(answers, "block", "left").select("ids", "langs", "sizes", "text", "answers")
            .mapInArrow(_score(order), "doc_id long, lang string, n_chars long, logp double")
            .select("doc_id", "lang", "n_chars", F.exp(-F.col("logp") / F.col("n_chars")).alias("perplexity")))


def _at_least(n: Column, quantile: float) -> Column:
    """How many standard deviations above the mean of n normal values their law's quantile is at most, with CONFIDENCE."""
    z, c = NormalDist().inv_cdf(quantile), NormalDist().inv_cdf(CONFIDENCE)
    a, b = 1 - c * c / (2 * (n - 1)), z * z - c * c / n
    return (z + F.sqrt(F.greatest(F.lit(0.0), z * z - a * b))) / a


def thresholds(scored: DataFrame, quantile: float = QUANTILE, languages: DataFrame | None = None) -> DataFrame:
    """(lang, threshold): the ``quantile`` of the perplexities of each language, rounded up to a step of the grid.

    Counts by step are what is shuffled. A language with fewer than LEAST_TRUSTED values takes the quantile of all, one of
    ``languages`` (lang) without any value too; without values of any language there are no thresholds. Values so few that all of
    them may well be below the law's quantile (298 at 0.99) do not show it: there the threshold is its upper bound, by mean and deviation of
    the log perplexity, where that is more than the values' own quantile.
    """
    steps = (scored.where(F.col("perplexity").isNotNull())
             .withColumn("step", F.ceil(F.log("perplexity") * GRID)).groupBy("lang", "step").agg(F.count("*").alias("n")))
    every = steps.groupBy("step").agg(F.sum("n").alias("n"))
    enough = math.log(1 - CONFIDENCE) / math.log(quantile) if 0 < quantile < 1 else 0

    def at(table: DataFrame, *by: str) -> DataFrame:
        up = Window.partitionBy(*by, F.lit(0)).orderBy("step")  # as many rows as steps
        whole = Window.partitionBy(*by, F.lit(0))
        mean = F.sum(F.col("n") * F.col("step")).over(whole) / F.col("all")
        ranked = table.withColumn("below", F.sum("n").over(up)).withColumn("all", F.sum("n").over(whole)).withColumn("mean", mean)
        ranked = ranked.withColumn("square", F.sum(F.col("n") * (F.col("step") - F.col("mean")) ** 2).over(whole))
        found = ranked.where(F.col("below") >= F.col("all") * quantile).groupBy(*by).agg(
            F.min("step").alias("step"), F.max("all").alias("all"), F.max("mean").alias("mean"), F.max("square").alias("square"))
        if not enough:
            return found
        bound = F.ceil(F.col("mean") + _at_least(F.col("all"), quantile) * F.sqrt(F.col("square") / (F.col("all") - 1)))
        few = (F.col("all") >= LEAST_TRUSTED) & (F.col("all") < enough)
        return found.withColumn("step", F.when(few, F.greatest("step", bound)).otherwise(F.col("step")))

    pooled = at(every).select(F.min("step")).first()[0]  # one number
    own = at(steps, "lang").select(F.col("lang").alias("_lang"), "step", "all")
    langs = scored.where(F.col("perplexity").isNotNull()).select("lang").distinct() if languages is None else languages.select("lang").distinct()
    return langs.join(own, langs["lang"].eqNullSafe(own["_lang"]), "left").select(
        "lang", F.exp(F.when(F.col("all") >= LEAST_TRUSTED, F.col("step")).otherwise(F.lit(pooled)) / GRID).alias("threshold"))


def classify(docs: DataFrame, trusted: DataFrame, quantile: float = QUANTILE, slack: float = SLACK, block: Column | None = None) -> DataFrame:
    """(doc_id, lang, n_chars, perplexity, threshold, kept) for each row of ``docs`` (doc_id, text, lang).

    Texts of ``docs`` whose doc_id is in ``trusted`` (doc_id) are trusted. One in HELD_OUT of them, by hash of the id, is left
    out of the training; the threshold of a language is ``slack`` times the ``quantile`` of these documents' perplexities (see
    ``thresholds``), so it holds for texts that the model has not seen. A language that has a model has a threshold. A document is kept unless its perplexity is above its language's threshold:
    what cannot be judged (null or empty text, a language without trusted text) is kept, with nulls. Rows of one doc_id
    are judged one by one. Extra columns are ignored.
    """
    ids = stage(trusted.select("doc_id").where("doc_id IS NOT NULL").distinct(), "trusted")
    few = ids.count() <= BROADCAST_IDS
    held_out = F.pmod(F.xxhash64("doc_id"), F.lit(HELD_OUT)) == 0
    shown = ids.where(~held_out)
    model = train(docs.join(F.broadcast(shown) if few else shown, "doc_id", "left_semi").select("lang", "text"))
    scored = stage(perplexities(docs, model, block), "scored")
    limits = (thresholds(scored.join(ids.where(held_out), "doc_id", "left_semi"), quantile, model[1][1])  # gamma of order 1: a row a language
              .select(F.col("lang").alias("_lang"), (F.col("threshold") * slack).alias("threshold")))
    return scored.join(limits, scored["lang"].eqNullSafe(limits["_lang"]), "left").select(
        "doc_id", "lang", "n_chars", "perplexity", "threshold", F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True)).alias("kept"))


def op1_kneser_ney(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("place"))
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    trusted = labels.where("quality = 1 AND coalesce(toxic, 0) = 0")
    block = F.xxhash64("file", F.floor(F.col("place") / BLOCK_ROWS))
    return classify(docs, trusted, block=block).drop("n_chars")

"""A training corpus from raw documents: stages of the operators in ``pitwall.llm``, each on all that the last one kept.

Stages take and return the columns of documents, in their order and whatever they are beside ``doc_id``, ``text``, ``lang`` and
``source``; the last one adds token ids. An empty table passes through all of them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitwall.llm.decontaminate import decontaminate
from pitwall.llm.language import dictionaries, identify
from pitwall.llm.lines import drop_boilerplate
from pitwall.llm.minhash import near_duplicates
from pitwall.llm.pieces import encode
from pitwall.session import work_dir


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language compression cannot tell go: no letter, or a narrow margin. The labels teach it."""
    learned = dictionaries(docs.select("text", "lang"))
    return identify(docs, learned).where(~F.col("rejected")).select(docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines of a source go; every document stays, with its new length.

    Copies are left to the next stage, so here they count as one page: the lines of a text that is copied often are kept.
    """
    left = drop_boilerplate(docs, copies=False)
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.length("text").cast("long"))
    return left.select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five words, 0.8) the document with the smallest id stays."""
    gone = near_duplicates(docs).where(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a benchmark item go."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, and whether decoding them gives the text back."""
    coded = encode(docs, check=True)
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "round_trip")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", benchmark_free),
    ("tokens", tokens),
]

# Compression, similarity components and token ids are beyond SQL; tests/llm compares each with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what a stage returns is written as Parquet and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = work_dir(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)

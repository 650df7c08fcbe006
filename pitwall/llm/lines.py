"""Boilerplate lines by their frequency in a site, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitwall.session import stage

RATIO = 0.1
BROADCAST_LINES = 1_000_000  # hashes of 8 bytes


def boilerplate(docs: DataFrame, host: str = "source", ratio: float = RATIO, copies: bool = True) -> DataFrame:
    """(host, lines): hashes of the lines on more than ``ratio`` of the host's pages, and not on a single page only.

    A page counts a line once. Without ``copies``, pages of one host with the same text are one page, in the counts and in the
    totals (a null text is the empty one); copies are reduced in the map tasks before they are shuffled. Page totals and line counts are summed in the map tasks before the shuffle, by host and
    line, so a host with a third of all pages is spread over its lines. A host has at most (mean number of distinct
    lines of its pages) / ratio such lines, which bounds the array.
    """
    # A line of null stands for the page itself; it is counted by the same aggregation and gives the host's total.
    text = F.coalesce("text", F.lit(""))
    pages = docs.select(
        F.col(host).alias("_host"), F.xxhash64(text).alias("_page"), F.octet_length(text).alias("_size"),
        F.array_distinct(F.transform(F.split(text, "\n"), lambda x: F.xxhash64(x))).alias("_lines"))
    if not copies:
        pages = pages.groupBy("_host", "_page", "_size").agg(F.first("_lines").alias("_lines"))
    lines = pages.select("_host", F.explode(F.array_append("_lines", F.lit(None).cast("long"))).alias("_line"))
    counts = lines.groupBy("_host", "_line").agg(F.count("*").alias("_n"))
    # What is on one page repeats nothing: few lines are left to be joined with the totals.
    often = counts.where(F.col("_line").isNotNull() & (F.col("_n") > 1))
    totals = counts.where(F.col("_line").isNull()).select("_host", F.col("_n").alias("_pages"))
    return (
        often.join(totals, often["_host"].eqNullSafe(totals["_host"]))
        .where(F.col("_n") > F.col("_pages") * F.lit(ratio))
        .groupBy(often["_host"]).agg(F.collect_set("_line").alias("_lines"))
    )


def drop_boilerplate(docs: DataFrame, host: str = "source", ratio: float = RATIO, copies: bool = True) -> DataFrame:
    """``docs`` without the boilerplate lines of their host; all rows stay.

    ``text`` is what is left, its lines in their order, joined by a line feed; ``n_lines`` and ``n_dropped`` are added (and
    replace input columns of these names). Lines are compared exactly, including empty ones and white space at their ends.
    A text of boilerplate only becomes empty, a null text stays null with no lines, rows with a null host form a host of
    their own. A line of a single page is never boilerplate, so a host of one page loses nothing. Without ``copies``, only pages
    of different texts count, so that a text is not boilerplate for being copied; copies all lose the same lines.

    The boilerplate is written and measured. Up to BROADCAST_LINES lines it goes to the tasks, and texts stay where they are; more
    are joined by host, which Spark splits where one host is most rows.
    """
    bad = stage(boilerplate(docs, host, ratio, copies).select(F.col("_host").alias("site"), F.col("_lines").alias("bad")), "boilerplate")
    size = bad.agg(F.sum(F.size("bad") + 1)).first()[0] or 0
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{host}`").alias("own"), F.split(F.coalesce("text", F.lit("")), "\n").alias("split"))
    joined = whole.join(F.broadcast(bad) if size <= BROADCAST_LINES else bad, F.col("own").eqNullSafe(F.col("site")), "left")
    left = F.filter("split", lambda x: ~F.coalesce(F.array_contains("bad", F.xxhash64(x)), F.lit(False)))
    out, text = joined.withColumn("left", left), F.col("row.text")
    kept = [c for c in docs.columns if c not in ("text", "n_lines", "n_dropped")]
    return out.select(
        *[F.col(f"row.`{c}`") for c in kept],
        F.when(text.isNotNull(), F.when(F.col("bad").isNull(), text).otherwise(F.array_join("left", "\n"))).alias("text"),
        F.when(text.isNotNull(), F.size("split")).otherwise(0).cast("long").alias("n_lines"),
        F.when(text.isNotNull(), F.size("split") - F.size("left")).otherwise(0).cast("long").alias("n_dropped"),
    )


def op4_site_lines(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    return drop_boilerplate(docs).select("doc_id", "n_lines", "n_dropped", "text")


OP4_SQL = f"""
WITH lines AS (
  SELECT doc_id, source, unnest(list_distinct(string_split(coalesce(text, ''), chr(10)))) AS line FROM documents),
totals AS (SELECT source, count(*) AS pages FROM documents GROUP BY source),
bad AS (
  SELECT l.source, l.line FROM lines l JOIN totals t ON l.source IS NOT DISTINCT FROM t.source
  GROUP BY l.source, l.line, t.pages HAVING count(*) > 1 AND count(*) > t.pages * {RATIO}::DOUBLE),
sets AS (SELECT source, list(line) AS bad FROM bad GROUP BY source)
SELECT doc_id,
  CASE WHEN text IS NULL THEN 0 ELSE len(string_split(text, chr(10))) END AS n_lines,
  CASE WHEN text IS NULL THEN 0
    ELSE len(list_filter(string_split(text, chr(10)), lambda x: coalesce(list_contains(bad, x), false))) END AS n_dropped,
  CASE WHEN text IS NULL THEN NULL
    ELSE array_to_string(list_filter(string_split(text, chr(10)), lambda x: NOT coalesce(list_contains(bad, x), false)), chr(10))
    END AS text
FROM documents d LEFT JOIN sets s ON d.source IS NOT DISTINCT FROM s.source
"""

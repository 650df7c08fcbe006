"""WARC archives without repeated payloads: revisit records that refer to one original response.

Archives are written and read by Spark's own sources, so files appear only with their task's commit and may be in any store
that Spark reaches: a record is a line of the text source whose separator is the record's closing pair of line ends.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitwall.session import work_dir

# Fixed values of the formats.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"

FILE_BYTES = 16 << 20


def base32_sha1(payload: Column | str) -> Column:
    """SHA-1 in upper-case base32; five hex digits make four base32 digits."""
    hexed = F.sha1(payload)
    groups = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda g: F.conv(F.substring(hexed, g * 5 + 1, F.lit(5)), 16, 10).cast("int"))
    digits = F.transform(groups, lambda n: F.concat(*[F.substring(F.lit(BASE32), F.shiftright(n, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)]))
    return F.array_join(digits, "")


def resolve(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``pages`` (page_id, url, html) as (page_id, url, html, payload_bytes, payload_digest, refers_to, refers_url).

    Of pages with equal payloads of at least ``min_bytes`` bytes the largest page_id is the original, and ``refers_to`` of the
    others names it; it is null for originals and for smaller payloads. A null html is an empty payload. Rows that repeat the
    original's page_id are originals too. Rows without a page_id refer to the original, if one has an id.

    Only headers (digest, id, url) are shuffled, reduced in the map tasks; the originals that anything refers to are joined
    back, so that payloads stay where they are while these are few, and Spark splits the join if one payload is most pages.
    """
    payload = F.coalesce("html", F.lit(""))
    headers = pages.select("page_id", "url", payload.alias("html"), F.octet_length(payload).cast("long").alias("payload_bytes"),
                           base32_sha1(payload).alias("payload_digest"))
    originals = (
        headers.where(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest")
        .agg(F.count("*").alias("copies"), F.max("page_id").alias("original"), F.max_by("url", "page_id").alias("original_url"))
        .where("copies > 1")
    )
    again = F.col("original").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("original"))
    return headers.join(originals, "payload_digest", "left").select(
        "page_id", "url", "html", "payload_bytes", "payload_digest",
        F.when(again, F.col("original")).alias("refers_to"), F.when(again, F.col("original_url")).alias("refers_url"))


def record(date: str) -> Column:
    """A whole record with fresh headers, up to the line ends that close it."""

    def urn(c: str) -> Column:
        return F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("null")), F.lit(">"))

    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))

    def uri(c: str) -> Column:
        return F.regexp_replace(F.coalesce(c, F.lit("about:blank")), "[\\r\\n]+", "%20")

    again = F.col("refers_to").isNotNull()
    http = F.concat(F.lit(HTTP), line("Content-Length", F.col("payload_bytes").cast("string")), F.lit("\r\n"))
    size = F.octet_length(http) + F.when(again, 0).otherwise(F.col("payload_bytes"))
    return F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", F.when(again, "revisit").otherwise("response")),
        line("WARC-Record-ID", urn("page_id")), line("WARC-Date", F.lit(date)), line("WARC-Target-URI", uri("url")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "payload_digest")),
        F.when(again, F.concat(line("WARC-Refers-To", urn("refers_to")), line("WARC-Refers-To-Target-URI", uri("refers_url")),
                               line("WARC-Profile", F.lit(PROFILE)))).otherwise(""),
        line("Content-Type", F.lit("application/http; msgtype=response")), line("Content-Length", size.cast("string")), F.lit("\r\n"),
        http, F.when(again, "").otherwise(F.col("html")))


def _packed(file_bytes: int):
    """Records joined up to about so many bytes; a larger one is alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for value in batch.column(0):
                text = value.as_py()
                if held and size + len(text) > file_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array(["\r\n\r\n".join(held)], pa.large_string())], ["value"])
                    held, size = [], 0
                held.append(text)
                size += len(text)
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(["\r\n\r\n".join(held)], pa.large_string())], ["value"])

    return run


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0, date: str = "2024-01-01T00:00:00Z", file_bytes: int = FILE_BYTES) -> None:
    """Write one record for each row of ``pages``; see ``resolve`` for which are revisits. An empty table writes no record.

    A file has records of about ``file_bytes`` characters, or a single larger one, so it is read as one value whatever the pages' sizes.
    """
    records = resolve(pages, min_bytes).select(record(date).alias("value"))
    records.mapInArrow(_packed(file_bytes), "value string").write.option("lineSep", "\r\n\r\n").option(
        "maxRecordsPerFile", 1).option("compression", "gzip").text(path)


def members(data: bytes) -> bytes:
    """The content of a gzip file of any number of members, such as one for each record."""
    out = []
    while data:
        one = zlib.decompressobj(31)
        out.append(one.decompress(data) + one.flush())
        if not one.eof:
            raise ValueError("the archive is cut off")
        data = one.unused_data
    return b"".join(out)


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record, by the lengths that the headers give."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        headers = {k.lower(): v.strip() for k, v in (x.split(":", 1) for x in lines[1:])}
        size = int(headers["content-length"])
        yield headers, data[end + 4 : end + 4 + size]
        if data[end + 4 + size : end + 8 + size] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} does not end where its length says")
        at = end + 8 + size


RECORD = "page_id long, url string, record_type string, payload_digest string, refers_to long, payload binary"


def _read(keep_payload: bool):
    def number(urn: str | None) -> int | None:
        m = re.fullmatch(r"<urn:page:(-?\d+)>", urn or "")
        return int(m[1]) if m else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows = []
                for h, block in parse(members(content.as_py())):
                    payload, digest = None, h.get("warc-payload-digest", "").removeprefix("sha1:") or None
                    if h["warc-type"] in ("response", "resource"):
                        payload = block[block.index(b"\r\n\r\n") + 4 :] if h["warc-type"] == "response" and b"\r\n\r\n" in block else block
                        found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                        if digest not in (None, found) and "sha1:" in h.get("warc-payload-digest", ""):
                            raise ValueError(f"{h['warc-record-id']}: the payload has digest {found}, not {digest}")
                        digest = digest or found
                    size = None if payload is None else len(payload)
                    rows.append((number(h.get("warc-record-id")), h.get("warc-target-uri"), h["warc-type"], digest, number(h.get("warc-refers-to")),
                                 payload if keep_payload else size))
                kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.binary() if keep_payload else pa.int64()]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                                                     ["page_id", "url", "record_type", "payload_digest", "refers_to", "payload"])

    return run


def read_archives(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """The records below ``path``: page_id, url, record_type, payload_digest, refers_to, payload.

    ``payload`` has the bytes, or only their number if it is False; it is null for revisits (see ``original_payloads``). A
    response whose payload does not have its SHA-1, and a broken record, raise. Other records than responses, resources and revisits
    (requests, metadata, information on the archive) come with their type and without payload; ids that are no numbers of pages are null.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(_read(payload), RECORD if payload else RECORD.replace("payload binary", "payload long"))


def original_payloads(records: DataFrame) -> DataFrame:
    """``records`` with each revisit's payload taken from the response it refers to; null if that is not there.

    That response has the id and the digest that the revisit names: several pages of one id may have other payloads.
    """
    named = ["_id", "_digest"]
    held = (records.where("record_type = 'response' AND page_id IS NOT NULL")
            .groupBy(F.col("page_id").alias("_id"), F.col("payload_digest").alias("_digest")).agg(F.max("payload").alias("_payload")))
    asked = records.where("refers_to IS NOT NULL").select(F.col("refers_to").alias("_id"), F.col("payload_digest").alias("_digest")).distinct()
    match = (records["refers_to"] == F.col("_id")) & (records["payload_digest"] == F.col("_digest"))
    return (records.join(held.join(asked, named, "left_semi"), match, "left")
            .withColumn("payload", F.coalesce("payload", "_payload")).drop(*named, "_payload"))


def op6_revisits(spark: SparkSession, folder: str) -> DataFrame:
    path = work_dir(spark, "warc")
    write_archives(spark.read.parquet(f"{folder}/pages.parquet"), path)
    records = original_payloads(read_archives(spark, path, payload=False))
    return records.select("page_id", F.col("payload").alias("payload_bytes"), "payload_digest", "record_type", "refers_to")


OP6_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (
  SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha1(html) AS x FROM p),
b AS (
  SELECT page_id, payload_bytes, array_to_string(list_transform(range(0, 32), lambda i: substr('{BASE32}',
    1 + ((('0x' || substr(x, (i // 4 * 5 + 1)::INTEGER, 5))::INTEGER >> (15 - i % 4 * 5)::INTEGER) & 31), 1)), '') AS payload_digest FROM d),
o AS (SELECT payload_digest, max(page_id) AS original FROM b GROUP BY payload_digest)
SELECT page_id, payload_bytes, b.payload_digest,
  CASE WHEN page_id IS NOT DISTINCT FROM original OR original IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM original THEN original END AS refers_to
FROM b JOIN o ON b.payload_digest = o.payload_digest
"""

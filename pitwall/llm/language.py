"""Language identification by compression: the language whose dictionary compresses a text best."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitwall.llm.memory import tidy

SAMPLE_DOCS = 128
SAMPLE_CHARS = 4096
DICTIONARY_BYTES = 112 << 10
LEVEL = 9
MIN_MARGIN = 0.004
PIECE_BYTES = 8192  # a dictionary's help is bounded, so what it is measured on is as well
PARTS, FINE_LEVEL = 8, 19

UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")


def dictionaries(labelled: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS,
                 dictionary_bytes: int = DICTIONARY_BYTES) -> dict[str, bytes]:
    """Raw-content dictionaries by language, from ``labelled`` (text, lang) rows.

    Fitted on a bounded sample: ``sample_docs`` different texts of each language, those with the smallest hashes, whatever their
    length. A text longer than ``sample_chars`` teaches by a piece of so many characters, at a place that its hash gives. Of these a
    dictionary holds as many as ``dictionary_bytes`` have room for. Copies count once, so a group of copies cannot fill a
    dictionary. Rows without text or language, and empty texts, teach nothing.
    """
    place = F.pmod(F.xxhash64("text", F.lit(1)), F.greatest(F.char_length("text") - sample_chars + 1, F.lit(1))) + 1
    piece = F.substring("text", place.cast("int"), F.lit(sample_chars))
    known = labelled.where(F.col("lang").isNotNull() & (F.octet_length("text") > 0))
    hashed = known.select("lang", "text", F.xxhash64("text").alias("hash"))
    first = Window.partitionBy("lang").orderBy("hash")
    chosen = (hashed.select("lang", "hash").distinct().withColumn("place", F.row_number().over(first))
              .where(F.col("place") <= sample_docs).select("lang", "hash"))  # sample_docs rows a language at most
    sample = hashed.join(F.broadcast(chosen), ["lang", "hash"]).groupBy("lang", "hash").agg(F.min(piece).alias("text")).collect()
    out: dict[str, bytes] = {}
    for lang, _, text in sorted(sample):
        held = out.setdefault(lang, b"")
        if len(more := text.lower().encode() + b"\n") + len(held) <= dictionary_bytes:
            out[lang] = more + held
    return out


def pieces_of(raw: bytes) -> list[bytes]:
    """Consecutive pieces that cover all of it; a short end goes with the piece before it."""
    pieces = [raw[at : at + PIECE_BYTES] for at in range(0, len(raw), PIECE_BYTES)]
    if len(pieces) > 1 and len(pieces[-1]) < PIECE_BYTES // 2:
        pieces[-2:] = [pieces[-2] + pieces[-1]]
    return pieces


def coders(dictionary: bytes, parts: int, level: int) -> list[zstandard.ZstdCompressor]:
    """One compressor for each of so many equal parts of the dictionary."""
    step, out = max(1, -(-len(dictionary) // parts)), []
    for at in range(0, len(dictionary), step):
        d = zstandard.ZstdCompressionDict(dictionary[at : at + step], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(level=level)
        out.append(zstandard.ZstdCompressor(dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False))
    return out


def told(sizes: list[float]) -> tuple[int, float]:
    """The place of the smallest size, and by how much of the second smallest it is smaller."""
    best, second = np.argsort(np.array(sizes), kind="stable")[:2].tolist()
    return best, float(sizes[second] - sizes[best]) / sizes[second]


class Judge:
    """Tells the language of a text by the dictionaries."""

    def __init__(self, learned: dict[str, bytes], min_margin: float = MIN_MARGIN) -> None:
        self.names, self.min_margin = sorted(learned), min_margin
        self.whole = [coders(learned[n], 1, LEVEL)[0] for n in self.names]
        self.learned = learned

    @functools.cached_property
    def parts(self) -> list[list[zstandard.ZstdCompressor]]:
        """Made when the first margin is narrow."""
        return [coders(self.learned[n], PARTS, FINE_LEVEL) for n in self.names]

    def __call__(self, text: str | None) -> tuple[str, float, bool]:
        """Name, score and whether it is sure."""
        if not self.names or text is None or not LETTER.search(text):
            return UNKNOWN, 0.0, False
        if len(self.names) == 1:
            return self.names[0], 1.0, 1.0 >= self.min_margin
        pieces = pieces_of(text.lower().encode())
        best, margin = told([sum(len(c.compress(p)) for p in pieces) for c in self.whole])
        if margin < self.min_margin:
            # The mean over the parts, as dictionaries of unequal lengths have unequal numbers of them.
            best, margin = told([sum(len(c.compress(p)) for p in pieces for c in part) / len(part) for part in self.parts])
        return self.names[best], margin, margin >= self.min_margin


def _classifier(learned: dict[str, bytes], min_margin: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(learned, min_margin)
        for batch in batches:
            told_ = [judge(value.as_py()) for value in batch.column(batch.num_columns - 1)]
            preds, scores, sure = zip(*told_, strict=True) if told_ else ((), (), ())
            columns = [*batch.columns[:-1], pa.array(preds, pa.string()), pa.array(scores, pa.float64()), pa.array([not x for x in sure], pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], "lang_pred", "score", "rejected"])

    return tidy(run)


def identify(docs: DataFrame, learned: dict[str, bytes], min_margin: float = MIN_MARGIN) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``rejected``; input columns of these names are replaced.

    A whole text, in lower case as the dictionaries are, is compressed with the dictionary of each language, in consecutive
    pieces of PIECE_BYTES, each from the dictionary anew; the smallest sum wins. So a text's length does not dilute what a
    dictionary saves. ``score`` is by how much of the second smallest sum the smallest is smaller (1 with a single language).
    Where that is under ``min_margin``, sizes in bytes may be too coarse: then the text is compressed harder with each of PARTS equal
    parts of every dictionary, and the sums over these decide in the same way. ``rejected`` tells that the margin is still
    narrow; ties go to the first name. This is so for texts of any length. A null text, a text without a letter (of any
    script) and anything when nothing was learned get ``und``, score 0, and are rejected. No other column has a say. Rows are
    answered one by one; there is no shuffle.
    """
    kept = [f for f in docs.schema.fields if f.name not in ("lang_pred", "score", "rejected")]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "lang_pred string", "score double", "rejected boolean"])
    rows = docs.select(*[f"`{f.name}`" for f in kept], F.col("text").alias("_text"))
    return rows.mapInArrow(_classifier(learned, min_margin), schema)


def op8_zstd_dictionaries(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    learned = dictionaries(docs.where(~held_out))
    return identify(docs.select("doc_id", "text"), learned).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")

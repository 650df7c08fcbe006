"""SentencePiece encoding and decoding by a weighted finite-state transducer.

The transducer is the composition of three: the normaliser (a dummy space in front, spaces become a visible mark), the
pieces, and byte fallback for characters that no piece has. Composed with a text it is a lattice: an arc is a piece that stands
at a place in the text. The encoding is the lattice's shortest path in the tropical semiring (sums of weights along a path,
minimum over paths).

* Unigram models: an arc weighs minus the piece's score; states are places.
* BPE models: states are places with the piece that ends there, and an arc weighs 0 or infinity. It is finite when merging the
  two neighbours' characters by the model's ranks gives just these two pieces. Merges act on neighbours only and in one
  order, so a path is the model's merge result if and only if all its neighbours pass, and exactly one path does.

No arc crosses from a character to a following space mark (checked when the model is compiled), so the shortest path of a text
is put together from those of its words, and these are kept in a bounded cache.
"""

from __future__ import annotations

import re
from array import array
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitwall.llm.memory import keeps, tidy

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
CACHED_WORDS = 300_000
CACHED_LENGTH = 64
KNOWN_PAIRS = 2_000_000
SLICE_BYTES = 4 << 20

# Fixed values of the model file's format.
NORMAL, USER_DEFINED, BYTE = 1, 4, 6
UNIGRAM, BPE = 1, 2
UNKNOWN_PENALTY = 10.0


def automaton(pieces: Iterable[str]) -> dict:
    """The pieces as nested tables by character; a state where a piece ends has it under the empty string."""
    start: dict = {}
    for piece in pieces:
        state = start
        for c in piece:
            state = state.setdefault(c, {})
        state[""] = piece
    return start


class Transducer:
    """A compiled model."""

    def __init__(self, model: bytes) -> None:
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        self.kind, rules = proto.trainer_spec.model_type, proto.normalizer_spec
        if self.kind not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models have pieces with weights")
        if rules.precompiled_charsmap or not rules.escape_whitespaces:
            raise ValueError("only the identity normaliser with visible spaces is compiled")
        self.prefix, self.squeeze = rules.add_dummy_prefix, rules.remove_extra_whitespaces
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type in (NORMAL, USER_DEFINED)}
        self.cost = {p.piece: -p.score for p in proto.pieces if p.type in (NORMAL, USER_DEFINED)}
        self.unknown = next(i for i, p in enumerate(proto.pieces) if p.type == 2)
        bytes_of = {int(p.piece[3:5], 16): i for i, p in enumerate(proto.pieces) if p.type == BYTE}
        self.byte_ids = [bytes_of[b] for b in range(256)] if len(bytes_of) == 256 else None
        self.arcs = automaton(self.ids)
        self.worst = max(self.cost.values()) + UNKNOWN_PENALTY
        self.follows: defaultdict[str, dict[str, bool]] = defaultdict(dict)
        self.pairs = 0
        characters = set("".join(self.ids))
        crossing = any(MARK in p.lstrip(MARK) for p in self.ids)
        alone = "".join(c for c in "\n\t\r" if c not in characters)
        cut = f"[{re.escape(alone)}]|" if alone else ""
        self.words: Callable[[str], list[str]] = (
            (lambda text: [text]) if crossing else re.compile(f"{cut}{MARK}+[^{MARK}{re.escape(alone)}]*|[^{MARK}{re.escape(alone)}]+").findall)
        self.text_of = [b""] * len(proto.pieces)
        for i, p in enumerate(proto.pieces):
            if p.type in (NORMAL, USER_DEFINED):
                self.text_of[i] = p.piece.replace(MARK, " ").encode()
            elif p.type == BYTE:
                self.text_of[i] = bytes([int(p.piece[3:5], 16)])
            elif i == self.unknown:
                self.text_of[i] = " ⁇ ".encode()
        self.cache: dict[str, bytes] = {}

    def normalise(self, text: str) -> str:
        if self.squeeze:
            text = re.sub(" +", " ", text).strip(" ")
        return (MARK if self.prefix and text else "") + text.replace(" ", MARK)

    def merged(self, text: str) -> list[str]:
        """The pieces that merging the best-ranked neighbours, the leftmost first, ends in."""
        parts = list(text)
        while True:
            best, at = None, -1
            for k in range(len(parts) - 1):
                c = self.cost.get(parts[k] + parts[k + 1])
                if c is not None and (best is None or c < best):
                    best, at = c, k
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def finite(self, last: str, piece: str) -> bool:
        """Whether the arc of ``piece`` after ``last`` has weight 0 in a BPE model; ``last`` is empty at the start."""
        if self.pairs >= KNOWN_PAIRS:
            self.follows.clear()
            self.pairs = 0
        self.pairs += 1
        ok = self.follows[last][piece] = self.merged(last + piece) == ([last, piece] if last else [piece])
        return ok

    def only_path(self, word: str) -> list[str]:
        """BPE: paths of weight 0 form a tree with one path to each place; longer pieces are followed first."""
        n = len(word)
        last: list[str] = [""] + [None] * n  # type: ignore[list-item]
        arcs, follows, finite = self.arcs, self.follows, self.finite
        open_ = [0]
        while (at := open_.pop()) < n:
            here, node, to = last[at], arcs, at
            known = follows[here]
            while to < n and (node := node.get(word[to])) is not None:
                to += 1
                piece = node.get("")
                # A character is an arc even if it is no piece.
                if piece is None and to == at + 1:
                    piece = word[at]
                if piece is not None and last[to] is None:
                    ok = known.get(piece)
                    if finite(here, piece) if ok is None else ok:
                        last[to] = piece
                        open_.append(to)
            if to == at and finite(here, word[at]):  # a character that no piece begins with
                last[to + 1] = word[at]
                open_.append(to + 1)
        out, at = [], n
        while at:
            out.append(last[at])
            at -= len(last[at])
        return out[::-1]

    def cheapest_path(self, word: str) -> list[str]:
        """Unigram: the path of the smallest sum."""
        n = len(word)
        cost, before = [0.0] + [float("inf")] * n, [0] * (n + 1)
        for at in range(n):
            node, to = self.arcs.get(word[at], {"": None}), at + 1
            while node is not None:
                if (piece := node.get("")) is not None or to == at + 1:
                    new = cost[at] + (self.worst if piece is None else self.cost[piece])
                    if new < cost[to]:
                        cost[to], before[to] = new, at
                node = node.get(word[to]) if to < n else None
                to += 1
        out, at = [], n
        while at:
            out.append(word[before[at] : at])
            at = before[at]
        return out[::-1]

    def shortest(self, word: str) -> list[str]:
        """The pieces on the shortest path through the lattice of a word."""
        return self.only_path(word) if self.kind == BPE else self.cheapest_path(word)

    def encode_word(self, word: str) -> bytes:
        """Ids of a normalised word as 32-bit numbers."""
        out: list[int] = []
        for piece in self.shortest(word):
            if (i := self.ids.get(piece)) is not None:
                out.append(i)
            elif self.byte_ids:
                out += [self.byte_ids[b] for b in piece.encode()]
            else:
                out.append(self.unknown)
        coded = array("i", out).tobytes()
        if len(word) <= CACHED_LENGTH:
            if len(self.cache) >= CACHED_WORDS:
                self.cache.clear()
            self.cache[word] = coded
        return coded

    def encode(self, text: str) -> bytes:
        get, new = self.cache.get, self.encode_word
        return b"".join([get(w) or new(w) for w in self.words(self.normalise(text))])

    def decode(self, ids: np.ndarray) -> str:
        """The inverse transducer: the pieces' text, without the dummy space."""
        text_of = self.text_of
        out = b"".join([text_of[i] for i in ids.tolist()]).decode("utf-8", "replace")
        return out[1:] if self.prefix and out.startswith(" ") else out


_COMPILED: dict[int, Transducer] = {}


def compiled(model: bytes) -> Transducer:
    """One transducer a process and model."""
    key = hash(model)
    if key not in _COMPILED:
        _COMPILED[key] = Transducer(model)
    return _COMPILED[key]


keeps(__name__, _COMPILED.clear)


def _encoder(block, check: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fst = compiled(block.value)
        fst.cache.clear()  # of an earlier task
        for batch in batches:
            column, at = batch.column(batch.num_columns - 1), 0
            while at < len(column):
                coded: list[bytes | None] = []
                size = 0
                while at + len(coded) < len(column) and size < SLICE_BYTES:
                    text = column[at + len(coded)].as_py()
                    coded.append(None if text is None else fst.encode(text))
                    size += len(coded[-1] or b"")
                flat = b"".join(x for x in coded if x)
                ends = np.cumsum([len(x or b"") // 4 for x in coded], dtype=np.int32)
                ids = pa.ListArray.from_arrays(
                    pa.array(np.r_[np.int32(0), ends], pa.int32()), pa.Array.from_buffers(pa.int32(), len(flat) // 4, [None, pa.py_buffer(flat)]),
                    mask=pa.array([x is None for x in coded]))
                columns, names = [*(c.slice(at, len(coded)) for c in batch.columns[:-1]), ids], [*batch.schema.names[:-1], "ids"]
                if check:
                    same = [x is None or fst.decode(np.frombuffer(x, np.int32)) == column[at + k].as_py() for k, x in enumerate(coded)]
                    columns, names = [*columns, pa.array(same, pa.bool_())], [*names, "round_trip"]
                yield pa.RecordBatch.from_arrays(columns, names)
                at += len(coded)
        fst.cache.clear()

    return tidy(run)


def _decoder(block):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fst = compiled(block.value)
        for batch in batches:
            texts = [None if x.as_py() is None else fst.decode(x.values.to_numpy()) for x in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], [*batch.schema.names[:-1], "decoded"])

    return tidy(run)


def _model(spark: SparkSession, path: str):
    """The model file, read once by the driver; a vocabulary has a fixed size that no data changes."""
    return spark.sparkContext.broadcast(Path(path).read_bytes())


def _mapped(df: DataFrame, function, column: str, new: dict[str, str]) -> DataFrame:
    kept = [f for f in df.schema.fields if f.name not in new]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), *(f"`{name}` {kind}" for name, kind in new.items())])
    return df.select(*[f"`{f.name}`" for f in kept], F.col(f"`{column}`").alias("_in")).mapInArrow(function, schema)


def encode(docs: DataFrame, model: str = MODEL, check: bool = False) -> DataFrame:
    """``docs`` with ``ids``, the pieces of the whole text (array<int>); an input column of that name is replaced.

    With ``check`` the ids are decoded again in the same task, and ``round_trip`` tells whether that gives the text.

    A null text has null ids, an empty one has none. Control pieces' names in a text are ordinary text. Rows are answered one
    by one, without a shuffle; a text without spaces is one word, whose path takes time in proportion to its length.
    """
    new = {"ids": "array<int>"} | ({"round_trip": "boolean"} if check else {})
    return _mapped(docs, _encoder(_model(docs.sparkSession, model), check), "text", new)


def decode(coded: DataFrame, model: str = MODEL) -> DataFrame:
    """``coded`` with ``decoded``, the text of ``ids``; null for null.

    It is the encoded text, except that a space mark (U+2581) of the text comes back as a space.
    """
    return _mapped(coded, _decoder(_model(coded.sparkSession, model)), "ids", {"decoded": "string"})


def op7_pieces(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return encode(docs, check=True).select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "round_trip")

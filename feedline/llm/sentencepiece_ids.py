"""SentencePiece encoding and decoding by a distinct-chunk table (operator 7).

A text is read as marked words: every blank (or the marker U+2581 itself) starts a new chunk, and so
does every line feed and every sign after a letter.  When no piece of the model crosses such a border, the segmentation of a text is
the concatenation of its chunks' segmentations.  Each Arrow task therefore keeps a table of distinct
chunks, segments each of them once, and joins ids, their decimal strings and decoded strings back by
position.  The table is bounded: when it holds ``TABLE_CHUNKS`` chunks it becomes the older of two, from
which used chunks are taken over, and a new one is begun.  That costs time but changes no result.  A model for which the border rule does not hold is applied to whole texts.

Defined cases: null and empty texts have no ids, the digest of the empty string and an empty decoded
text; repeated rows and repeated ids are encoded row by row; rows with a null ``doc_id`` are kept;
other columns of the input are ignored, whatever their names; an empty table gives an empty result.
Texts of any length are encoded whole.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedline.llm.words import frugal

MARKER = "▁"
#: Distinct chunks in each of the two tables that a task keeps between groups of texts.
TABLE_CHUNKS = 200_000
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
TEXT_SCHEMA = "doc_id long, ids array<int>, decoded string"

_LETTERS, _SIGNS = "A-Za-zÀ-ÖØ-öø-ÿ", ",.!?;|#$%&*"


def _chunks(signs: str) -> re.Pattern:
    """Chunks: from a blank, a line feed, or a sign that follows a letter, to the next of these."""
    led = f"(?:[{_LETTERS}]+(?=[{re.escape(signs)}])|[^ ▁\n]*)" if signs else "[^ ▁\n]*"
    return re.compile(f"[ ▁]+{led}|\n[^ ▁\n]*|[^ ▁\n]+")


class ChunkTable:
    """Segments texts through distinct chunks: ``chunks(text)`` gives (ids, decimal ids, decoded) of each."""

    def __init__(self, model_path: str):
        from sentencepiece import SentencePieceProcessor

        self.sp = SentencePieceProcessor(model_file=model_path)
        pieces = [self.sp.id_to_piece(i) for i in range(self.sp.get_piece_size())]
        # Borders hold if no piece continues over a marker or holds a line feed, and if blanks are kept as written.
        self.borders = (
            not any(re.search(f"[^{MARKER}]{MARKER}|\n", p) for p in pieces)
            and self.sp.encode("\n")[0] == self.sp.piece_to_id(MARKER)
            and self.sp.encode("a b") == self.sp.encode("a") + self.sp.encode("b")
            and len(self.sp.decode(self.sp.encode(" a  b "))) == len(" a  b ")
            and self.sp.encode("Åﬁ") != self.sp.encode("Åfi")
        )
        signs = "".join(c for c in _SIGNS if not any(re.search(f"[{_LETTERS}]{re.escape(c)}", p) for p in pieces))
        self.pattern = _chunks(signs)
        self.blank = self.sp.piece_to_id(MARKER)
        self.table: dict[str, tuple[int, str, str]] = {}
        self.older: dict[str, tuple[int, str, str]] = {}

    def fill(self, chunks: Iterable[str]) -> None:
        """Segments the chunks that the table lacks, all in one call."""
        new, older = [], self.older
        for c in chunks:
            if c in older:
                self.table[c] = older[c]
            else:
                new.append(c)
        if not new:
            return
        led = [c[0] in " ▁" for c in new]
        # encode() puts a marker before a text: it stands for a chunk's own, or is cut off with the line feed.
        ids = self.sp.encode([c[1:] if m else "\n" + c for c, m in zip(new, led, strict=True)], num_threads=1)
        ids = [(x or [self.blank]) if m else x[2:] for x, m in zip(ids, led, strict=True)]
        # decode() takes a first marker off.
        for c, m, x, shown in zip(new, led, ids, self.sp.decode(ids, num_threads=1), strict=True):
            self.table[c] = len(x), ",".join(map(str, x)), " " + shown if m else shown

    def encode_all(self, texts: list[str | None]) -> list[tuple[int, str, str]]:
        """(number of ids, decimal ids joined by commas, decoded text) of each whole text."""
        whole = [bool(t) and (not self.borders or "\0" in t) for t in texts]
        cut = [[] if not t or w else self.pattern.findall(" " + t) for t, w in zip(texts, whole, strict=True)]
        if len(self.table) > TABLE_CHUNKS:
            self.older, self.table = self.table, {}
        self.fill(set().union(*cut).difference(self.table))
        out, table = [], self.table
        for text, w, chunks in zip(texts, whole, cut, strict=True):
            if w:
                ids = self.sp.encode(text)
                out.append((len(ids), ",".join(map(str, ids)), self.sp.decode(ids)))
            else:
                found = [table[c] for c in chunks]
                out.append((sum([x[0] for x in found]), ",".join([x[1] for x in found]), "".join([x[2] for x in found])[1:]))
        return out


    def clear(self) -> None:
        """Gives the tables' memory back at a task's end, as the worker may stay idle beside large JVM stages."""
        self.table, self.older = {}, {}


def _tables(model_path: str, _kept: dict = {}) -> ChunkTable:  # noqa: B006 - one model for each Python worker
    if model_path not in _kept:
        _kept[model_path] = ChunkTable(model_path)
    return _kept[model_path]


def encode_texts(docs: DataFrame, model_path: str) -> DataFrame:
    """Ids and decoded text of every document: ``doc_id, ids, decoded``."""

    @frugal
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _tables(model_path)
        for batch in batches:
            for part in (batch.slice(i, 512) for i in range(0, len(batch), 512)):
                got = table.encode_all(part.column("text").to_pylist())
                ids = [[int(x) for x in s.split(",")] if s else [] for _, s, _ in got]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(ids, pa.list_(pa.int32())), pa.array([x[2] for x in got], pa.string())],
                    ["doc_id", "ids", "decoded"],
                )
        table.clear()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, TEXT_SCHEMA)


def encode_digests(docs: DataFrame, model_path: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every document, without moving the ids."""

    @frugal
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _tables(model_path)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        for batch in batches:
            for part in (batch.slice(i, 512) for i in range(0, len(batch), 512)):
                rows = [(n, sha(ids), sha(shown)) for n, ids, shown in table.encode_all(part.column("text").to_pylist())]
                n, ids, shown = zip(*rows, strict=True) if rows else ((), (), ())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(shown, pa.string())],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )
        table.clear()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, SCHEMA)

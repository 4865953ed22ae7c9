"""Token-id files with fixed-width bit packing, and byte-level BPE ids to fill them (operator 5).

File format, all little-endian.  A file holds the ids of consecutive documents:

====================  ====================================================================
``PIDS``              4 bytes
bits, block, docs,    five unsigned 64-bit integers: bits of an id, ids in a block,
ids, blocks           documents, ids and blocks of the file
``doc_ids``           ``docs`` signed 64-bit integers
``ends``              ``docs`` 64-bit integers: ids up to and with each document
``offsets``           ``blocks + 1`` 64-bit integers: where each block's bytes begin
payload               per block: its ids, each in ``bits`` bits, lowest bit first
====================  ====================================================================

``bits`` is the least width that holds every id of the vocabulary.  A block starts at a byte, so any
id range is read from the offsets and its own blocks alone (``TokenFile.slice``).

Documents are ordered by a range partitioning on ``doc_id``; each task packs its range into files of at
most about ``FILE_IDS`` ids and moves each into place whole, under a name that depends on the partition
only, so a task that runs again replaces its own files.  A manifest table lists the files that count.

Defined cases: a null or empty text has only the end id; rows with a null ``doc_id`` are not written,
as they have no place in the order; rows that share a ``doc_id`` follow each other in order of their
texts; other columns are ignored, whatever their names; an empty table gives no files and an empty
result.  Texts of any length are encoded whole.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedline.llm.shared import shared_folder
from feedline.llm.words import frugal, slices

MAGIC, BLOCK_IDS, FILE_IDS = b"PIDS", 4096, 8 << 20
#: Distinct chunks in each of the two tables that a task keeps between groups of texts.
TABLE_CHUNKS = 150_000

# ---------------------------------------------------------------- packing


def id_bits(vocabulary: int) -> int:
    """The least number of bits that holds the ids 0 .. vocabulary - 1."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    spread = (ids.astype(np.uint64)[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(spread.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(payload: memoryview | bytes, count: int, bits: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(payload, f"<u{bits // 8}", count).astype(np.uint32)
    flat = np.unpackbits(np.frombuffer(payload, np.uint8), count=count * bits, bitorder="little").reshape(count, bits)
    return (flat.astype(np.uint64) << np.arange(bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64).astype(np.uint32)


def build_file(doc_ids: list[int], lengths: list[int], ids: np.ndarray, bits: int, block: int = BLOCK_IDS) -> bytes:
    blocks = [pack(ids[i : i + block], bits) for i in range(0, len(ids), block)]
    offsets = np.concatenate([[0], np.cumsum([len(b) for b in blocks], dtype=np.int64)]).astype("<i8")
    head = MAGIC + struct.pack("<5Q", bits, block, len(doc_ids), len(ids), len(blocks))
    return b"".join([head, np.array(doc_ids, "<i8").tobytes(), np.cumsum(lengths, dtype="<i8").tobytes(), offsets.tobytes(), *blocks])


class TokenFile:
    """Random access to the bytes of one file."""

    def __init__(self, content: bytes | memoryview):
        if bytes(content[:4]) != MAGIC:
            raise ValueError("not a token-id file")
        self.bits, self.block, docs, self.n_ids, blocks = struct.unpack_from("<5Q", content, 4)
        at = 4 + 40
        self.doc_ids = np.frombuffer(content, "<i8", docs, at)
        self.ends = np.frombuffer(content, "<i8", docs, at + 8 * docs)
        self.offsets = np.frombuffer(content, "<i8", blocks + 1, at + 16 * docs)
        self.payload = memoryview(content)[at + 16 * docs + 8 * (blocks + 1) :]

    def slice(self, start: int, end: int) -> np.ndarray:
        """The ids ``start <= i < end``, from the blocks that hold them."""
        if end <= start:
            return np.zeros(0, np.uint32)
        a, b = start // self.block, (end - 1) // self.block + 1
        parts = []
        for k in range(a, b):
            count = min(self.block, self.n_ids - k * self.block)
            parts.append(unpack(self.payload[self.offsets[k] : self.offsets[k + 1]], count, self.bits))
        return np.concatenate(parts)[start - a * self.block : end - a * self.block]


# ---------------------------------------------------------------- ids

#: RE2: a blank that a longer run of white space may claim, rarer white space by any reading of the term, and
#: the start of a special token's string.  Texts with one of these are encoded whole.
_WHOLE = r"[ \t\r\n] (?:[ \t\r\n]|\z)|[\x0b\x0c\x1c-\x1f\x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200b}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}]|<\|"
#: A word and the signs (no apostrophe) that follow its last letter.
_TAILED = re.compile("(.*[A-Za-zÀ-ÖØ-öø-ÿ])([!\"#$%&()*+,./:;<=>?@\\[\\\\\\]^_`{|}~-]+)", re.DOTALL)


class ByteBpe:
    """Ids of a byte-level BPE tokenizer file, each distinct chunk encoded once.

    The tokenizer's own splitting puts a border before a single blank and between a letter and a sign other
    than an apostrophe.  Cutting there changes no id.  Texts in which a blank may belong to a longer run of
    white space, or with the string of a special token, are encoded whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.vocabulary = self.tokenizer.get_vocab_size(with_added_tokens=True)
        #: Ids of chunks with the blank before them, of chunks at a text's start and of signs at a word's end.
        self.table: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.heads: dict[str, bytes] = {}
        words = self.tokenizer.get_vocab(with_added_tokens=True)
        self.blank_first = np.zeros(max(words.values()) + 1, bool)
        self.blank_first[[i for w, i in words.items() if w.startswith("\u0120")]] = True
        probe = ["Ab", ",", " c's", " d", ".\n\nE—f", " ###", " g", "!!"]
        self.cuts = [i for c in probe for i in self.raw([c])[0]] == self.raw(["".join(probe)])[0]

    def raw(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def fill(self, chunks: list[str]) -> None:
        """Ids of chunks with the blank before them, from one text of all: each chunk begins at a token with a blank."""
        ids = np.array(self.raw([" " + " ".join(chunks)])[0] if chunks else [], "<u4")
        starts = np.append(np.flatnonzero(self.blank_first[ids]), len(ids))
        if len(starts) == len(chunks) + 1:
            line = ids.tobytes()
            self.table.update(zip(chunks, [line[4 * a : 4 * b] for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)], strict=True))
        else:
            for c, ids in zip(chunks, self.raw([" " + c for c in chunks]), strict=True):
                self.table[c] = struct.pack(f"<{len(ids)}I", *ids)

    def first(self, chunks: list[str]) -> list[bytes]:
        """Ids of chunks without a blank before them."""
        if len(self.heads) > TABLE_CHUNKS:
            self.heads = {}
        new = [c for c in dict.fromkeys(chunks) if c not in self.heads]
        self.heads.update((c, struct.pack(f"<{len(ids)}I", *ids)) for c, ids in zip(new, self.raw(new), strict=True))
        return [self.heads[c] for c in chunks]

    def learn(self, chunks: list[str]) -> list[bytes]:
        """Ids of distinct chunks; a word with signs at its end is learnt by its two parts."""
        if len(self.table) > TABLE_CHUNKS:
            self.older, self.table = self.table, {}
        table, older = self.table, self.older
        new = [c for c in chunks if c not in table]
        for c in new:
            if c in older:
                table[c] = older[c]
        new = [c for c in new if c not in table]
        tailed = [(c, *m.groups()) for c in new if (m := _TAILED.fullmatch(c))]
        plain = set(new).difference(c for c, _, _ in tailed).union(stem for _, stem, _ in tailed if stem not in table)
        self.fill(list(plain))
        for (c, stem, _), tail in zip(tailed, self.first([t for _, _, t in tailed]), strict=True):
            table[c] = table[stem] + tail
        return [table[c] for c in chunks]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all whole texts one after the other, where each text's ids begin and the last ones end)."""
        whole = pc.fill_null(pc.match_substring_regex(texts, _WHOLE), False)
        if not self.cuts:
            whole = pc.fill_null(pc.greater(pc.binary_length(texts), 0), False)
        plain = pc.if_else(whole, "", pc.fill_null(texts, ""))
        pieces = pc.split_pattern(plain, " ")
        first = pieces.offsets.to_numpy()
        coded = pieces.flatten().dictionary_encode()
        chunks, of = coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64)
        entries = self.learn(chunks)
        starts = first[:-1]  # a text's first chunk has no blank; an empty text is one empty chunk
        heads = {k: n for n, k in enumerate(dict.fromkeys(of[starts].tolist()), len(entries))}
        entries += self.first([chunks[k] for k in heads])
        of[starts] = [heads[k] for k in of[starts].tolist()]
        for i in np.flatnonzero(whole.to_numpy(zero_copy_only=False)):
            of[first[i]] = len(entries)
            entries.append(np.array(self.raw([texts[int(i)].as_py()])[0], "<u4").tobytes())
        sizes = np.fromiter(map(len, entries), np.int64, len(entries)) // 4
        begins = np.cumsum(sizes) - sizes
        line, each = np.frombuffer(b"".join(entries), "<u4"), sizes[of]
        ends = np.cumsum(each)
        ids = line[np.repeat(begins[of] - ends + each, each) + np.arange(int(ends[-1]) if len(ends) else 0)]
        return ids, np.concatenate([[0], ends])[first]


def _bpe(path: str, _kept: dict = {}) -> ByteBpe:  # noqa: B006 - one table for each Python worker
    if path not in _kept:
        _kept[path] = ByteBpe(path)
    return _kept[path]


# ---------------------------------------------------------------- Spark

MANIFEST = "file string, part int, seq int, n_docs long, n_ids long"


def _place(folder: str, name: str, content: bytes) -> None:
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(folder)
    store.create_dir(path, recursive=True)
    hidden = f"{path}/_{name}.{uuid.uuid4().hex}"
    with store.open_output_stream(hidden) as out:
        out.write(content)
    store.move(hidden, f"{path}/{name}")


def write_token_files(docs: DataFrame, tokenizer: str, folder: str, end_id: int = 0, parts: int | None = None) -> None:
    """Encodes ``docs`` (``doc_id``, ``text``), appends ``end_id`` to each, and writes files and manifest to ``folder``."""

    @frugal
    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, part, seq = _bpe(tokenizer), TaskContext.get().partitionId(), 0
        bits = id_bits(bpe.vocabulary)
        held: list[np.ndarray] = []
        lengths: list[int] = []
        ids: list[int] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal seq, size
            name = f"part-{part:06d}-{seq:06d}.ids"
            packed = np.concatenate(held)
            _place(folder, name, build_file(ids, lengths, packed, bits))
            row = pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([len(ids)], pa.int64()), pa.array([len(packed)], pa.int64())],
                ["file", "part", "seq", "n_docs", "n_ids"],
            )
            for x in (held, lengths, ids):
                x.clear()
            seq, size = seq + 1, 0
            return row

        for batch in batches:
            for piece in slices(batch, "text"):
                found, bounds = bpe.encode(piece.column("text"))
                held.append(np.insert(found, bounds[1:], end_id).astype(f"<u{2 if bits <= 16 else 4}"))
                lengths += (np.diff(bounds) + 1).tolist()
                ids += piece.column("doc_id").to_pylist()
                size += len(held[-1])
                if size >= FILE_IDS:
                    yield flush()
        if ids:
            yield flush()
        bpe.older, bpe.heads = {}, {}  # the worker may stay idle beside large JVM stages

    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("doc_id IS NOT NULL")
    count = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(count, "doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(write, MANIFEST).write.parquet(f"{folder}/manifest")


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of each document, from the files that the manifest lists."""

    @frugal
    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for base, content in zip(batch.column("base").to_pylist(), batch.column("content"), strict=True):
                file = TokenFile(content.as_buffer())
                starts = np.concatenate([[0], file.ends[:-1]]).astype(np.int64)
                sums = [zlib.crc32(file.slice(a, b).astype("<u4").tobytes()) for a, b in zip(starts, file.ends, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(file.doc_ids), pa.array(starts + base), pa.array(file.ends - starts), pa.array(sums, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    # One row a file: the only rows that meet in one task.
    before = F.sum("n_ids").over(W.orderBy("part", "seq").rowsBetween(W.unboundedPreceding, -1))
    listed = manifest.select("file", F.coalesce(before, F.lit(0)).alias("base"))
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.ids").load(folder)
    files = files.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")
    return files.join(F.broadcast(listed), "file").select("base", "content").mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_file_rows(docs: DataFrame, tokenizer: str, end_id: int = 0) -> DataFrame:
    """Writes token files for ``docs`` in the shared folder and reads them back."""
    spark = docs.sparkSession
    folder = shared_folder(spark, "token-ids")
    write_token_files(docs, tokenizer, folder, end_id)
    return read_token_files(spark, folder)

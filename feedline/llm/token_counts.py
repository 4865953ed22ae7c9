"""Token counts by a whole-token shortcut (operator 13).

Before any text is read, the driver proves for each string of the vocabulary whether it encodes alone as one token:
the tokenizer's own splitter leaves it one pre-token, and its merges end in that one id.  Both facts depend on the string
only, so a pre-token that equals a proven string counts 1 without any merge.  Only the other pre-tokens are merged, each
distinct one once per task.  The proven strings are as bounded as the vocabulary file.

A task cuts the texts of a slice where the splitter has a border whatever stands around it (see ``_borders``), so most
chunks are single pre-tokens.  All chunks of the slice are made distinct at once and looked up among the proven strings;
those that are none are split and merged by the library in one call.  Texts with the string of an
added token are encoded whole, as the library's default gives such strings ids of their own.  For a tokenizer file with a
normalizer or another splitter the cut is left out: the whole text is normalised and split by the library, then looked up.

Defined cases: null and empty texts have 0 bytes and 0 tokens; repeated rows and ids are counted row by row; rows with a
null ``doc_id`` are kept; other columns are ignored, whatever their names; an empty table gives an empty result.  Texts of
any length are counted whole.  ``text`` is read as a string.
"""

from __future__ import annotations

import json
import os
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedline.llm.words import frugal, slices

#: Tokens beyond which a document is over the limit.
LIMIT = 512
#: Bytes of merged pre-tokens that a task remembers; it starts anew beyond that.
TABLE_BYTES = 32 << 20

#: Classes of bytes: letter, digit, other visible sign, white space, and 0 for all bytes that are not decided alone.
_LETTER, _DIGIT, _SIGN, _SPACE = 1, 2, 3, 4
_CLASS = np.zeros(256, np.uint8)
_CLASS[0x21:0x7F] = _SIGN
_CLASS[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = _LETTER
_CLASS[0x30:0x3A] = _DIGIT
_CLASS[[0x20, *range(0x09, 0x0E)]] = _SPACE
#: First bytes of characters that are no white space: visible ASCII, and lead bytes other than C2, E1 to E3 and EF.
_VISIBLE = np.zeros(256, bool)
_VISIBLE[0x21:0x7F] = True
_VISIBLE[0xC3:0xF5] = True
_VISIBLE[[0xE1, 0xE2, 0xE3, 0xEF]] = False


def _borders(data: np.ndarray) -> np.ndarray:
    """Places in UTF-8 ``data`` before which the byte-level splitter has a border whatever stands around them.

    Runs of letters, of digits and of signs end where another class begins (an apostrophe may belong to the letters behind
    it); a visible character ends its run before white space; a blank before a visible character opens the run of that
    character, and what white space stands before the blank is a run of its own; so is a lone line feed.
    """
    if len(data) < 2:
        return np.zeros(0, np.int64)
    kind, visible = _CLASS[data], _VISIBLE[data]
    # U+00C0 to U+00FF: letters but for the signs of multiplication and division.
    lead = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7))
    kind[lead] = kind[lead + 1] = _LETTER
    here, there = kind[:-1], kind[1:]
    cut = (here != there) & (here > 0) & (there > 0) & (here != _SPACE)
    cut &= ~((data[:-1] == 0x27) & (there == _LETTER))
    cut[:-1] |= (data[1:-1] == 0x20) & visible[2:]
    alone = np.flatnonzero((data[1:-1] == 0x0A) & (there[1:] > 0) & (there[1:] < _SPACE) & (here[:-1] > 0) & (here[:-1] < _SPACE))
    cut[alone + 1] = True
    return np.flatnonzero(cut) + 1


class PreTokens:
    """The pre-tokens of texts, as the tokenizer file's own normalizer and splitter give them."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        added = [t["content"] for t in spec["added_tokens"]]
        if spec["normalizer"] is not None:  # a normalised text may come to hold the string of an added token
            added = [c for c in added for c in (c, re.sub(r"\W", "", c)) if c]
        self.added = re.compile("|".join(map(re.escape, added)), re.IGNORECASE) if added else None
        #: What the vocabulary puts at the end of a string that ends a word.
        self.ending = spec["model"].get("end_of_word_suffix") or ""
        #: The splitter may be applied to chunks that begin with a blank and end before one.
        self.cuts = spec["normalizer"] is None and spec["pre_tokenizer"] == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}

    def split(self, text: str) -> list[str]:
        if self.tokenizer.normalizer is not None:
            text = self.tokenizer.normalizer.normalize_str(text)
        return [p for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)] if self.tokenizer.pre_tokenizer else [text]

    def merged(self, pre_token: str) -> int:
        return len(self.tokenizer.model.tokenize(pre_token))

    def all_merged(self, chunks: list[str]) -> list[int]:
        return list(map(len, self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False))) if chunks else []

    def whole(self, text: str) -> int:
        return len(self.tokenizer.encode(text, add_special_tokens=False).ids)


def proven(path: str) -> tuple[list[str], list[str]]:
    """(vocabulary strings that as pre-tokens end in one token, texts of those that the splitter leaves whole)."""
    tokens = PreTokens(path)
    vocabulary = tokens.tokenizer.get_vocab(with_added_tokens=False)
    strings = {s.removesuffix(tokens.ending): i for s, i in vocabulary.items() if s.endswith(tokens.ending)}
    alone = [s for s, i in strings.items() if s and [t.id for t in tokens.tokenizer.model.tokenize(s)] == [i]]
    decoder = tokens.tokenizer.decoder
    texts = [decoder.decode([s]) for s in alone] if decoder and tokens.cuts else []
    return alone, [t for s, t in zip(alone, texts, strict=False) if "�" not in t and tokens.split(t) == [s]]


class TokenCounter:
    """Numbers of tokens of texts, through ``proven`` strings."""

    def __init__(self, path: str, alone: list[str], texts: pa.Array):
        self.tokens, self.alone, self.texts = PreTokens(path), set(alone), texts
        self.memory: dict[str, int] = {}
        self.held = 0

    def remembered(self, strings: list[str], count: Callable[[list[str]], list[int]]) -> list[int]:
        """The numbers of distinct strings, those not seen before by one call of ``count``."""
        if self.held > TABLE_BYTES:
            self.memory, self.held = {}, 0
        new = [x for x in strings if x not in self.memory]
        self.memory.update(zip(new, count(new), strict=True))
        self.held += sum(map(len, new)) + 120 * len(new)
        return [self.memory[x] for x in strings]

    def of_whole(self, text: str) -> int:
        found = Counter(self.tokens.split(text))
        rest = [p for p in found if p not in self.alone]
        numbers = self.remembered(rest, lambda new: list(map(self.tokens.merged, new)))
        return found.total() + sum(found[p] * (n - 1) for p, n in zip(rest, numbers, strict=True))

    def count(self, texts: pa.Array) -> np.ndarray:
        """The number of tokens of each text of a slice; null counts 0."""
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        special = np.zeros(len(texts), bool)
        if self.tokens.added:
            special = pc.match_substring_regex(texts, self.tokens.added.pattern, ignore_case=True).to_numpy(zero_copy_only=False)
        plain = pc.if_else(pa.array(special), pa.scalar("", pa.large_string()), texts) if special.any() else texts
        out = self._cut(plain) if self.tokens.cuts else np.array([self.of_whole(t.as_py()) for t in plain], np.int64)
        for i in np.flatnonzero(special):
            out[i] = self.tokens.whole(texts[int(i)].as_py())
        return out

    def _cut(self, texts: pa.Array) -> np.ndarray:
        _, offsets, values = texts.buffers()
        bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        base, bounds = bounds[0], bounds - bounds[0]
        data = np.frombuffer(values, np.uint8)[base : base + bounds[-1]] if bounds[-1] else np.zeros(0, np.uint8)
        edge = np.zeros(len(data) + 1, bool)
        edge[bounds] = True
        edge[_borders(data)] = True
        edges = np.flatnonzero(edge)
        sizes = np.diff(edges)
        if not len(sizes):
            return np.zeros(len(texts), np.int64)
        chunks = pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(edges), pa.py_buffer(data))
        coded = chunks.dictionary_encode()
        one = pc.is_in(coded.dictionary, value_set=self.texts).to_numpy(zero_copy_only=False)
        each = np.ones(len(one), np.int64)
        rest = np.flatnonzero(~one)
        each[rest] = self.remembered(coded.dictionary.take(pa.array(rest)).to_pylist(), self.tokens.all_merged)
        sums = np.concatenate([[0], np.cumsum(each[coded.indices.to_numpy()])])
        return np.diff(sums[np.searchsorted(edges, bounds)])


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every document, for the tokenizer file at ``path``."""
    alone, whole = proven(path)
    whole = pa.array(whole, pa.large_string())

    @frugal
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TokenCounter(path, alone, whole)
        for batch in batches:
            for part in slices(batch, "text"):
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("n_bytes"), pa.array(counter.count(part.column("text")))], ["doc_id", "n_bytes", "n_tokens"])

    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"), text.alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)

"""Vectorised word splitting and hashing over Arrow string columns.

The helpers run inside Arrow tasks and work on the UTF-8 bytes of a whole batch at once, so the cost
per word is a few numpy operations.  All word classes used here are decided by single bytes (ASCII
separators; bytes of 0x80 and above are always word bytes), which makes byte-wise splitting exact.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Word bytes: all but space and the controls 0x09-0x0D.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False

#: Runs of letters, digits and non-ASCII characters are words (1), runs of other visible characters signs (2).
WORDS_AND_SIGNS = np.full(256, 2, np.uint8)
WORDS_AND_SIGNS[: 0x21] = 0
WORDS_AND_SIGNS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = 1
WORDS_AND_SIGNS[0x7F] = 0

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_SHIFT = np.uint64(32)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    h = (h ^ (h >> _SHIFT)) * _M1
    h = (h ^ (h >> _SHIFT)) * _M2
    return h ^ (h >> _SHIFT)


class Words:
    """The words of some texts: ``doc`` (index of the text), ``start`` and ``end`` in ``data``.

    A word is a longest run of bytes of one ``word_byte`` class other than 0; ``kind`` is its class.
    ``first[i]:first[i + 1]`` are the words of text ``i``.  A null text has no words.
    """

    def __init__(self, texts: pa.Array, word_byte: np.ndarray = NOT_SPACE, lower: bool = True):
        texts = texts.cast(pa.large_binary())
        self.n = len(texts)
        _, offsets, values = texts.buffers()
        offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + self.n + 1]
        raw = np.frombuffer(values, np.uint8)[offsets[0] : offsets[-1]] if values else np.zeros(0, np.uint8)
        self.bounds = bounds = offsets - offsets[0]
        size = len(raw)
        self.data = np.zeros(size + 8, np.uint8)
        self.data[:size] = LOWER[raw] if lower else raw
        kind = np.zeros(size + 1, np.uint8)
        kind[:size] = word_byte[raw]
        cut = np.zeros(size + 1, bool)
        cut[bounds] = True
        border = cut
        border[1:] |= kind[1:] != kind[:-1]
        self.start = np.flatnonzero(border & (kind > 0))
        self.end = np.flatnonzero(border[1:] & (kind[:-1] > 0)) + 1
        self.kind = kind[self.start]
        self.first = np.searchsorted(self.start, bounds)
        self.counts = np.diff(self.first)
        self.doc = np.repeat(np.arange(self.n), self.counts)

    def hashes(self, seed: int = 0x9E3779B97F4A7C15) -> np.ndarray:
        """A 64-bit hash of each word's bytes, eight bytes a step."""
        eight = np.ndarray((len(self.data) - 7,), "<u8", self.data, strides=(1,))
        left = self.end - self.start
        h = mix(left.astype(np.uint64) + np.uint64(seed))
        at, live = self.start, np.arange(len(left))
        while len(live):
            some = np.minimum(left, 8).astype(np.uint64)
            got = eight[at] & (~np.uint64(0) >> (np.uint64(64) - some * np.uint64(8)))
            h[live] = mix(h[live] ^ got)
            more = left > 8
            live, at, left = live[more], at[more] + 8, left[more] - 8
        return h


def shingles(words: Words, hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(text index, hash) of each run of ``size`` words; a text of fewer words gives its whole sequence once."""
    n, out = len(hashes), hashes
    for k in range(1, size):
        if n - k <= 0:
            out = out[:0]
            break
        out = mix(out[: n - k] * _M1 + hashes[k:])
    keep = np.zeros(len(out), bool)
    long = words.counts >= size
    if len(out):
        room = words.first[1:][words.doc[: len(out)]] - np.arange(len(out))
        keep = room >= size
    docs, values = words.doc[: len(out)][keep], out[keep]
    short = np.flatnonzero((words.counts > 0) & ~long)
    if len(short):
        whole = []
        for d in short:
            h = np.uint64(words.counts[d])
            with np.errstate(over="ignore"):
                for x in hashes[words.first[d] : words.first[d + 1]]:
                    h = mix(np.array([h * _M1 + x], np.uint64))[0]
            whole.append(h)
        docs = np.concatenate([docs, short])
        values = np.concatenate([values, np.array(whole, np.uint64)])
    return docs, values


def slices(batch: pa.RecordBatch, column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about ``limit`` text bytes (a longer text is a piece of its own)."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes.astype(np.int64)) // limit
    at = 0
    for end in [*(np.flatnonzero(np.diff(part)) + 1), len(batch)]:
        if end > at:
            yield batch.slice(at, end - at)
        at = end


def frugal(run: Callable[..., Iterator[pa.RecordBatch]]) -> Callable[..., Iterator[pa.RecordBatch]]:
    """A task that gives its Arrow memory back at its end, as its worker may stay idle beside large JVM stages."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()

    return task

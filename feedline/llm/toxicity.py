"""Toxicity: subword-bag embeddings averaged into a linear softmax (operator 9).

A word is the bag of its character n-grams (3 to 5 bytes, with marks at both ends) and the word itself,
hashed into ``2 ** BITS`` embedding rows; its vector is their mean, so a misspelling shares most of its
vector with the word it hides.  A text's vector is the weighted mean of its words' vectors: a word counts
with the square root of its occurrences, frequent words less (a / (a + p)), and ``PAD`` empty words keep
very short texts near the prior.  Embeddings and softmax are fitted jointly by Adagrad in numpy on a bounded
sample of labelled rows (``SAMPLE_ROWS``) on the driver.  As softmax and means are linear, scoring needs one
number for each n-gram (1 MB broadcast): each distinct word of a batch is scored once.

Defined cases: a null or empty text scores the model's bias alone; repeated rows are scored row by row; rows
with a null ``doc_id`` are scored and never held out; other columns are ignored, whatever their names; an
empty table gives an empty result; without usable labels every score is 0.5.  Texts of any length are scored
whole.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedline.llm.samples import fold, labelled_sample
from feedline.llm.words import WORDS_AND_SIGNS, Words, mix, slices

BITS, DIM, SAMPLE_ROWS, EPOCHS, RATE, SEED = 18, 8, 8000, 5, 0.1, 7
#: Weight of frequent words, empty words added to each text, scale of text vectors.
RARE, PAD, SCALE = 1e-3, 20.0, 20.0
#: One text without words for so many labelled ones.
EMPTY = 20
SCHEMA = "doc_id long, score double"


@dataclass
class Model:
    grams: np.ndarray  # logit of each n-gram row
    bias: float
    frequent: np.ndarray  # sorted hashes of frequent words
    weight: np.ndarray  # and their weights


class Bag:
    """Distinct words of some texts: their n-grams, and their occurrences in each text."""

    def __init__(self, texts: pa.Array):
        words = Words(texts, WORDS_AND_SIGNS == 1)
        hashes, first, inverse = np.unique(words.hashes(), return_index=True, return_inverse=True)
        self.hashes, n = hashes, len(hashes)
        both, counts = np.unique(words.doc.astype(np.uint64) << np.uint64(32) | inverse.astype(np.uint64), return_counts=True)
        self.doc, self.word, self.count = (both >> np.uint64(32)).astype(np.int64), (both & np.uint64(0xFFFFFFFF)).astype(np.int64), counts
        size = words.end[first] - words.start[first]
        # The distinct words one after the other, as <word>.
        ends = np.cumsum(size + 2)
        begins = ends - size - 2
        line = np.zeros((int(ends[-1]) if n else 0) + 8, np.uint8)
        line[begins], line[ends - 1] = ord("<"), ord(">")
        own = np.repeat(np.arange(n), size)
        step = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        line[begins[own] + 1 + step] = words.data[words.start[first][own] + step]
        eight = np.ndarray((len(line) - 7,), "<u8", line, strides=(1,))
        at = [mix(hashes ^ np.uint64(1))]
        of = [np.arange(n)]
        place = np.arange(len(line) - 8)
        owner = np.repeat(np.arange(n), size + 2)
        for length in (3, 4, 5):
            good = place + length <= ends[owner]
            at.append(mix(eight[:-1][good] & np.uint64((1 << 8 * length) - 1) | np.uint64(length << 56)))
            of.append(owner[good])
        order = np.argsort(np.concatenate(of), kind="stable")
        self.gram = (np.concatenate(at)[order] >> np.uint64(64 - BITS)).astype(np.int64)
        self.gram_first = np.searchsorted(np.concatenate(of)[order], np.arange(n + 1))


def _weigh(bag: Bag, n: int, frequent: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Each occurrence's share in its text's vector."""
    share = np.ones(len(bag.hashes))
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, bag.hashes), len(frequent) - 1)
        share = np.where(frequent[at] == bag.hashes, weight[at], 1.0)
    x = np.sqrt(bag.count) * share[bag.word]
    total = np.bincount(bag.doc, x, minlength=n) + PAD
    return SCALE * x / total[bag.doc]


def fit(texts: pa.Array, labels: np.ndarray) -> Model:
    bags = [(len(p), Bag(p.column(0))) for p in slices(pa.RecordBatch.from_arrays([texts], ["text"]), "text")]
    words = np.concatenate([np.repeat(b.hashes, np.bincount(b.word, b.count, minlength=len(b.hashes)).astype(int)) for _, b in bags] or [np.zeros(0, np.uint64)])
    seen, counts = np.unique(words, return_counts=True)
    often = counts / max(1, len(words)) > RARE / 100
    frequent, weight = seen[often], RARE / (RARE + counts[often] / max(1, len(words)))
    del words, seen, counts
    rows: list[tuple[np.ndarray, np.ndarray]] = []
    for n, bag in bags:
        x, lengths = _weigh(bag, n, frequent, weight), np.diff(bag.gram_first)
        first = np.searchsorted(bag.doc, np.arange(n + 1))
        for a, b in zip(first[:-1], first[1:], strict=True):
            own = lengths[bag.word[a:b]]
            at = np.repeat(bag.gram_first[bag.word[a:b]] - np.cumsum(own) + own, own) + np.arange(own.sum())
            grams, inverse = np.unique(bag.gram[at], return_inverse=True)
            rows.append((grams.astype(np.int32), np.bincount(inverse, np.repeat(x[a:b] / own, own)).astype(np.float32)))
    # Texts without words are the commoner kind: this holds the bias, and with it short texts, near the prior.
    prior = int(labels.mean() >= 0.5) if len(labels) else 0
    labels = np.concatenate([labels, np.full(len(rows) // EMPTY, prior)])
    rows += [(np.zeros(0, np.int32), np.zeros(0, np.float32))] * (len(rows) // EMPTY)
    random = np.random.default_rng(SEED)
    table = ((random.random((1 << BITS, DIM)) - 0.5) / DIM / 10).astype(np.float32)
    soft, bias = (random.random((DIM, 2)) - 0.5).astype(np.float32), np.zeros(2, np.float32)
    table_sum, soft_sum, bias_sum = np.full(1 << BITS, 1e-8, np.float32), np.full((DIM, 2), 1e-8, np.float32), np.full(2, 1e-8, np.float32)
    for _ in range(EPOCHS):
        for i in random.permutation(len(rows)):
            at, x = rows[i]
            own = table[at]
            vector = x @ own
            logits = vector @ soft + bias
            error = np.exp(logits - logits.max())
            error /= error.sum()
            error[int(labels[i])] -= 1
            step = x[:, None] * (soft @ error)
            table_sum[at] += (step * step).mean(axis=1)
            table[at] = own - RATE / np.sqrt(table_sum[at])[:, None] * step
            step = np.outer(vector, error)
            soft_sum += step * step
            soft -= RATE * step / np.sqrt(soft_sum)
            bias_sum += error * error
            bias -= RATE * error / np.sqrt(bias_sum)
    if not rows:
        return Model(np.zeros(1 << BITS, np.float32), 0.0, frequent, weight)
    return Model(table @ (soft[:, 1] - soft[:, 0]), float(bias[1] - bias[0]), frequent, weight)


def logits(model: Model, texts: pa.Array) -> np.ndarray:
    bag, n = Bag(texts), len(texts)
    if not len(bag.hashes):
        return np.full(n, model.bias)
    sums = np.concatenate([[0.0], np.cumsum(model.grams[bag.gram], dtype=np.float64)])
    word = np.diff(sums[bag.gram_first]) / np.diff(bag.gram_first)
    return np.bincount(bag.doc, _weigh(bag, n, model.frequent, model.weight) * word[bag.word], minlength=n) + model.bias


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` of every document."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = 1 / (1 + np.exp(-np.clip(logits(held.value, part.column("text")), -35, 35)))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(found)], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, SCHEMA)


def toxicity_scores(docs: DataFrame, labels: DataFrame, folds: int = 4, held: int = 2, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``doc_id, held_out, score`` of every document; labels of fold ``held`` are not learnt from."""
    sample = labelled_sample(docs, labels.where(fold("doc_id", folds) != held), "toxic", sample_rows)
    model = fit(sample.column("text").combine_chunks(), sample.column("label").to_numpy())
    return score(docs, model).select("doc_id", F.coalesce(fold("doc_id", folds) == held, F.lit(False)).alias("held_out"), "score")

"""Quality classifier: hashed word n-grams, logistic regression, FTRL updates (operator 2).

A text becomes a sparse vector: words and runs of signs, lower-cased, and their bigrams, hashed into
``2 ** BITS`` places with the square root of their counts, at length 1.  A word that repeats the last
word or the last but one is replaced by a mark for that, so loops of any word look alike.  Weights are
fitted by follow-the-regularised-leader (proximal, per coordinate) over a bounded sample of labelled
rows (``SAMPLE_ROWS``) on the driver, and every text is scored as a sparse dot product in Arrow tasks;
the weight vector (4 MB) is the only thing broadcast.

Defined cases: a null or empty text has no features and scores the model's bias alone; repeated rows are
scored row by row; rows with a null ``doc_id`` are scored and never held out; other columns are ignored,
whatever their names; an empty table gives an empty result; without usable labels the score is 0.5.
Texts of any length are scored whole.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedline.llm.samples import fold, labelled_sample
from feedline.llm.words import WORDS_AND_SIGNS, Words, mix, slices

BITS, SAMPLE_ROWS, EPOCHS, SEED = 20, 8000, 4, 7
#: FTRL: learning rate, its offset, L1 and L2.
ALPHA, BETA, L1, L2 = 5.0, 1.0, 0.0, 1e-6
SCHEMA = "doc_id long, score double"


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, place, value): the vector of text ``i`` is ``first[i]:first[i + 1]`` of the two others."""
    words = Words(texts, WORDS_AND_SIGNS)
    hashes = words.hashes()
    real = np.flatnonzero(words.kind == 1)
    was, doc = hashes[real], words.doc[real]
    for back in (2, 1):
        same = np.zeros(len(real), bool)
        same[back:] = (was[back:] == was[:-back]) & (doc[back:] == doc[:-back])
        hashes[real[same]] = np.uint64(back)
    pair = mix(hashes[:-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[1:])
    within = words.doc[:-1] == words.doc[1:]
    docs = np.concatenate([words.doc, words.doc[:-1][within]]).astype(np.uint64)
    place = np.concatenate([mix(hashes), pair[within]]) >> np.uint64(64 - BITS)
    both, counts = np.unique(docs << np.uint64(BITS) | place, return_counts=True)
    docs, place = (both >> np.uint64(BITS)).astype(np.int64), (both & np.uint64((1 << BITS) - 1)).astype(np.uint32)
    first = np.searchsorted(docs, np.arange(len(texts) + 1))
    total = np.bincount(docs, counts, minlength=len(texts))
    return first, place, np.sqrt(counts / total[docs]).astype(np.float32)


def fit(texts: pa.Array, labels: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and bias after ``EPOCHS`` passes in a fixed random order."""
    rows: list[tuple[np.ndarray, np.ndarray]] = []
    for part in slices(pa.RecordBatch.from_arrays([texts], ["text"]), "text"):
        first, place, value = features(part.column(0))
        rows += [(place[a:b], value[a:b]) for a, b in zip(first[:-1], first[1:], strict=True)]
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    z0 = n0 = 0.0
    weights = lambda z, n: np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))
    bias = lambda: -z0 * ALPHA / (BETA + np.sqrt(n0))
    random = np.random.default_rng(SEED)
    for _ in range(EPOCHS):
        for i in random.permutation(len(rows)):
            at, x = rows[i]
            zi, ni = z[at], n[at]
            w, w0 = weights(zi, ni), bias()
            error = 1 / (1 + np.exp(-np.clip(w @ x + w0, -35, 35))) - labels[i]
            g = error * x
            z[at] = zi + g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / ALPHA * w
            n[at] = ni + g * g
            z0 += error - (np.sqrt(n0 + error * error) - np.sqrt(n0)) / ALPHA * w0
            n0 += error * error
    return weights(z, n).astype(np.float32), float(bias())


def score(docs: DataFrame, model: tuple[np.ndarray, float]) -> DataFrame:
    """``doc_id, score`` of every document."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = held.value
        for batch in batches:
            for part in slices(batch, "text"):
                first, place, value = features(part.column("text"))
                sums = np.concatenate([[0.0], np.cumsum(weights[place] * value, dtype=np.float64)])
                logit = np.clip(sums[first[1:]] - sums[first[:-1]] + bias, -35, 35)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(1 / (1 + np.exp(-logit)))], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, SCHEMA)


def quality_scores(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``doc_id, held_out, score`` of every document; labels of fold ``held`` are not learnt from."""
    sample = labelled_sample(docs, labels.where(fold("doc_id", folds) != held), "quality", sample_rows)
    model = fit(sample.column("text").combine_chunks(), sample.column("label").to_numpy())
    return score(docs, model).select("doc_id", F.coalesce(fold("doc_id", folds) == held, F.lit(False)).alias("held_out"), "score")

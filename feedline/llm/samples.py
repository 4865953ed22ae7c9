"""Bounded samples of labelled texts for fitting a classifier on the driver."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: str, folds: int) -> Column:
    """The fold of a document: crc32 of its id as text, modulo ``folds``."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int) -> pa.Table:
    """``text, label`` of at most ``rows`` labelled documents: those whose ids have the smallest hashes.

    The ids are chosen first (``rows`` bounds them, so they may be broadcast); texts are read for these only.
    Rows with a null id or a label other than 0 and 1 are no labels; of repeated labels of an id the largest counts.
    """
    some = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
        .where("doc_id IS NOT NULL AND label IN (0, 1)")
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = texts.join(F.broadcast(some), "doc_id").groupBy("doc_id").agg(F.max("label").alias("label"), F.max("text").alias("text"))
    return found.orderBy("doc_id").select("text", "label").toArrow()

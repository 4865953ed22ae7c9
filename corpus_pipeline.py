"""Corpus pipeline: five stages from raw documents to tokenised ones.

Each stage is a function of (spark, docs, sf_dir); its result is written as Parquet and read again as the next one's
``docs``.  All but the last return the columns of ``docs``:

1. ``quality``: documents that the quality rules reject go.
2. ``lines``: later copies of repeated line runs are cut out; a document that had text and has no line with a word left goes.
3. ``near_duplicates``: of each component of the n-gram Jaccard join the document with the smallest id stays
   (rows without an id, and repeated rows of one id beyond the first, are not told apart from their group: of rows
   with equal ids one stays).
4. ``contamination``: documents that the decontamination rule calls contaminated go.
5. ``tokens``: ids of each document, as number and digest, beside digest of the decoded text.

Defined cases: a stage keeps nulls in all columns other than the text; null and empty texts fail the base rules of the
first stage; empty tables give empty results of the same columns; further columns of any name pass through all but
the last stage.  Repeated rows: the first two stages judge each by itself, the third keeps one of each id, the fourth
drops or keeps rows of one id by their text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedline.llm.decontamination import contaminated, contamination, mark
from feedline.llm.jaccard_join import jaccard_components
from feedline.llm.line_dedup import dedup
from feedline.llm.quality_rules import accepted
from feedline.llm.queries import table, tokenizer_path, trusted_ids
from feedline.llm.sentencepiece_ids import encode_digests
from feedline.llm.shared import small, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return accepted(docs, trusted_ids(spark, sf_dir))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = dedup(docs)
    emptied = (F.col("n_removed") > 0) & ~F.coalesce(F.col("text").rlike(r"[^ \x09-\x0D]"), F.lit(False))
    kept = found.where(~emptied)
    n_chars = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("row.n_chars"))
    new = {"text": F.col("text"), "n_chars": n_chars.cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {"text": F.col("text")}
    return kept.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = jaccard_components(docs)
    gone = written(found.where("component_id <> doc_id").select("doc_id").distinct(), "near-duplicates")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    kept = docs.join(small(gone), "doc_id", "left_anti").select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("key"), row)
    # Rows that share an id are one document: the first by text stays.
    repeated = small(written(kept.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("n"), F.min("key").alias("least")).where("n > 1"), "repeated-ids"))
    single = kept.join(repeated, "doc_id", "left_anti").select("row")
    again = kept.join(repeated, "doc_id").where("key = least").dropDuplicates(["doc_id"]).select("row")
    return single.unionByName(again).select("row.*")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = contamination(docs, table(spark, sf_dir, "benchmark")).where(contaminated()).select(F.col("doc_id").alias("bad_id"), F.col("mark").alias("bad_mark"))
    bad = small(written(found, "contaminated"))
    return docs.join(bad, docs["doc_id"].cast("long").eqNullSafe(bad["bad_id"]) & (mark(docs["text"]) == bad["bad_mark"]), "left_anti")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encode_digests(docs, tokenizer_path("piece_bpe_32k.model"))


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("contamination", decontaminate),
    ("tokens", tokens),
]

#: Hashed likelihood ratios and tokenisation are beyond SQL; tests/llm compares with a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

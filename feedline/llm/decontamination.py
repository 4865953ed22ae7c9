"""Benchmark decontamination: a prefix-filtered set join (operator 1).

Texts are lower-cased (A-Z) and cut into words of ASCII digits and letters and all non-ASCII characters.  A
benchmark item's windows are its runs of ``WINDOW`` words; an item of fewer words is one window.  A document
word is hit when it lies in an occurrence of a window.

The join looks for shingles, runs of ``SHINGLE`` words (a shorter window is its own shingle).  Shingles are
ordered by rarity: one pass counts the benchmark's shingles in all documents.  As every shingle of a window must
be in a document that contains it, the necessary prefix of a window is its rarest shingle alone; a window with a
shingle that never occurs is dropped at once.  That pass also writes the places of all benchmark shingles, so
the places of the prefix shingles are read back; a place gives the window's place, which must lie within the document
(bounds on position and length).  Only documents with such a place are cut into words again, and the words there
are compared with the window's words, one by one.

The benchmark side is broadcast only after its rows were counted (``BROADCAST_ROWS``); a larger one is joined by
shuffles on the shingle in two passes over the documents, and the few matches are joined with them for the comparison.

Defined cases: a null or empty text has no words and nothing is hit; an item without words has no window; items
with a null id hit words but are not listed; rows with the same ``doc_id`` and text are one document, with the same
id and other texts separate ones, and rows with a null id are kept alike; equal windows of several items list them
all; other columns are ignored, whatever their names; an empty table gives an empty result, an empty benchmark no
hits.  Texts of any length are read whole.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedline.llm.shared import small as broadcast_if_small
from feedline.llm.shared import written

WINDOW, SHINGLE = 13, 3
#: Rows of the benchmark side (about 300 bytes each) up to which it is broadcast.
BROADCAST_ROWS = 200_000


def words(text: Column) -> Column:
    """The words of a text, A-Z lower-cased; none for null."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    ascii_only = F.octet_length(text) == F.length(text)
    lower = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))
    return F.regexp_extract_all(lower, F.lit(r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)"), F.lit(1))


def mark(text: Column) -> Column:
    """A hash of a text, which tells rows with the same id apart."""
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def _shingle(words: str, at: Column, size: int) -> Column:
    """Hash of the ``size`` words from position ``at``; null where fewer are left."""
    run = [F.get(words, at + k) for k in range(size)]
    return F.when(run[-1].isNotNull(), F.xxhash64(F.lit(size), *run))


def windows(benchmark: DataFrame, window: int, shingle: int) -> DataFrame:
    """``window`` (its words), ``items``, and its shingles: ``size, offset, token``."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), words(F.col("text")).alias("words")).withColumn("n", F.size("words")).where("n > 0")
    starts = items.select("item", "words", F.explode(F.sequence(F.lit(1), F.greatest(F.col("n") - window + 1, F.lit(1)))).alias("start"))
    each = starts.select("item", F.slice("words", F.col("start"), window).alias("window"))
    grouped = each.groupBy("window").agg(F.array_sort(F.collect_set("item")).alias("items"))
    placed = grouped.withColumn("size", F.least(F.size("window"), F.lit(shingle)))
    placed = placed.select("*", F.explode(F.sequence(F.lit(0), F.size("window") - F.col("size"))).alias("offset"))
    token = F.coalesce(*[F.when(F.col("size") == k, _shingle("window", F.col("offset"), k)) for k in range(1, shingle + 1)])
    return placed.select("window", "items", "size", "offset", token.alias("token"))


def hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, mark, n_words`` and, of each window found in the document, ``start, length, items``.

    A document without a window has one row with nulls; ``mark`` is a hash of the text.
    """
    text = F.col("text").cast("string")
    cut = docs.select(F.col("doc_id").cast("long").alias("doc_id"), mark(text).alias("mark"), words(text).alias("words"))
    cut = cut.withColumn("n_words", F.size("words").cast("long"))
    shingles = windows(benchmark, window, shingle).persist()
    sizes = sorted(r["size"] for r in shingles.select("size").distinct().collect())  # at most SHINGLE values
    small = shingles.count() <= BROADCAST_ROWS

    def tokens(rows: DataFrame) -> DataFrame:
        found = [_shingle("words", F.col("at"), k) for k in sizes]
        one = found[0] if len(found) == 1 else F.explode_outer(F.array(*found)) if found else F.lit(None).cast("bigint")
        return rows.select("*", F.posexplode_outer("words").alias("at", "word")).select("*", one.alias("token"))

    # Rarity: how often each benchmark shingle occurs in the documents.
    known = shingles.select("token").distinct()
    if small:
        # A document's first place is kept in any case: it stands for the document.
        places = tokens(cut).join(F.broadcast(known.withColumn("known", F.lit(True))), "token", "left").where("known OR coalesce(at, 0) = 0")
        places = written(places.select("doc_id", "mark", "n_words", "at", F.when(F.col("known"), F.col("token")).alias("token")), "shingle-places")
        occurring = places.select("token").where("token IS NOT NULL")
    else:
        occurring = tokens(cut.select("words")).select("token").join(known, "token")
    counts = occurring.groupBy("token").agg(F.count("*").alias("count"))
    ranked = shingles.join(F.broadcast(counts) if small else counts, "token", "left")
    rarest = F.min(F.struct(F.coalesce("count", F.lit(0)).alias("count"), "offset", "token")).alias("rarest")
    prefix = ranked.groupBy("window").agg(rarest, F.first("items").alias("items")).where("rarest.count > 0")
    prefix = prefix.select(F.col("rarest.token").alias("token"), F.col("rarest.offset").alias("offset"), "window", "items")

    inside = F.col("at") - F.col("offset")
    length = F.size("window")
    fits = (inside >= 0) & (inside + length <= F.col("n_words")) & (F.slice("words", F.greatest(inside, F.lit(0)) + 1, length) == F.col("window"))
    result = ["doc_id", "mark", "n_words", F.when(fits, inside).alias("start"), F.when(fits, length).alias("length"), F.when(fits, F.col("items")).alias("items")]
    same = F.col("d.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("d.mark") == F.col("f.mark"))
    if small:
        found = places.join(F.broadcast(prefix), "token").where((inside >= 0) & (inside + length <= F.col("n_words")))
        found = written(found.select("doc_id", "mark", "at", "token").distinct(), "prefix-places")
        few = broadcast_if_small(found.select("doc_id", "mark").distinct(), BROADCAST_ROWS)
        texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), mark(text).alias("mark"), text.alias("text"))
        cut = texts.alias("d").join(few.alias("f"), same, "left_semi").select("doc_id", "mark", words(F.col("text")).alias("words"))
        cut = cut.withColumn("n_words", F.size("words").cast("long"))
        joined = cut.alias("d").join(broadcast_if_small(found, BROADCAST_ROWS).alias("f"), same).select("d.*", "at", "token")
        hit = joined.join(F.broadcast(prefix), "token").select(*result).where("start IS NOT NULL")
        nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in hit.schema.fields[3:]]
        return hit.unionByName(places.where("coalesce(at, 0) = 0").select("doc_id", "mark", "n_words", *nulls))
    found = tokens(cut).select("doc_id", "mark", "at", "token").join(prefix, "token").drop("token")
    return cut.alias("d").join(found.alias("f"), same, "left").select("d.*", "at", "offset", "window", "items").select(*result)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, mark, n_words, n_hit, items`` of every document; ``items`` are sorted ids as strings."""
    spans = F.array_sort(F.collect_set(F.when(F.col("start").isNotNull(), F.struct("start", (F.col("start") + F.col("length")).alias("end")))))
    found = hits(docs, benchmark, window, shingle).groupBy("doc_id", "mark", "n_words").agg(spans.alias("spans"), F.collect_set("items").alias("items"))
    zero = F.struct(F.lit(0).alias("hit"), F.lit(0).alias("upto"))
    covered = F.aggregate(
        "spans",
        zero,
        lambda t, s: F.struct((t["hit"] + F.greatest(F.lit(0), s["end"] - F.greatest(s["start"], t["upto"]))).alias("hit"), F.greatest(t["upto"], s["end"]).alias("upto")),
    )
    items = F.array_sort(F.array_distinct(F.flatten("items")))
    return found.select("doc_id", "mark", "n_words", covered["hit"].cast("long").alias("n_hit"), items.alias("items"))


def contaminated() -> Column:
    """The rule: some word is hit, and at least one word in twenty."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))

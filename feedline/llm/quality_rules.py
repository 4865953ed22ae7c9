"""Quality rules: base counts of each text, and an n-gram log-likelihood ratio (operator 8).

All of it is DataFrame expressions.  Words and word pairs are counted by 64-bit hashes, so what is gathered grows
with the corpus.  Two multinomials are counted in one pass: the raw corpus (every document) and the
trusted documents.  A text's verdict compares the mean, over its n-grams, of log(p_trusted / p_raw) with a fixed
threshold; ``SMOOTHING`` n-grams with the raw corpus's trusted share are added to each n-gram, so that rarely
seen ones say little.

Every n-gram is counted exactly, in one of two ways.  Up to ``FREQUENT`` n-grams, found in a sample of the texts, are
counted by a broadcast of their hashes, and their occurrences find the ratio by another one.  The occurrences of all
others are shuffled by their hash, in ``PASSES`` passes over ranges of it, so that the shuffle files of one pass are gone
before the next: there, occurrences of one n-gram meet and are counted and scored at once.  Which n-grams the
sample finds changes the cost, never a count.  One that occurs once is left out there, and its ratio follows from
whether the text that is judged is trusted.  Ratios are rounded to multiples of 2^-24, so that their sums do not depend on
the order.

Counts over 3-word windows use 64-bit hashes of the windows.  Windows that occur twice are found by sorting a
text's hashes, so the cost of a text is n log n at any length.

Defined cases: a null or empty text has no words, zero counts, fails the base rules and has the ratio 0; repeated
rows are judged row by row; rows with a null ``doc_id`` are judged and never trusted; all input columns are kept
in the struct ``row``, so no name clashes; an empty table gives an empty result; without trusted documents every
ratio is 0, so the base rules alone decide.  A text exactly at the threshold is kept.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedline.llm.shared import small, written

SMOOTHING, THRESHOLD = 20.0, -0.15
#: At most so many n-grams, frequent ones, have their ratio broadcast; they are found in this share of the texts.
FREQUENT, SAMPLE = 1 << 20, 1 / 16
#: The occurrences of all others are shuffled in so many passes; a pass has the n-grams of its share of the hashes.
PASSES = 4
#: Least words, and the largest percentage of words in repeated windows.
MIN_WORDS, MAX_REPEATED = 50, 50
#: Trusted ids up to this number (16 bytes each) are broadcast; more are joined by a shuffle.
BROADCAST_IDS = 1_000_000
#: Repeated windows of a text up to this number are looked up, more are found by sorting.
FEW = 16

_SPACE, _SPACES = "[ \\x09-\\x0D]", " \t\n\x0b\x0c\r"


def words(text: Column) -> Column:
    """The words of a text; none for null."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(_SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"{_SPACE}+"))


def occurrences(texts: DataFrame, *columns: str) -> DataFrame:
    """``columns`` beside ``gram``, a 64-bit hash, for each word and each pair of neighbours of ``text``."""
    cut = texts.select(*columns, words(F.col("text")).alias("words"))
    # Lambdas over arrays of words would be interpreted; rows of places are compiled with all around them.
    places = F.when(F.size("words") > 0, F.sequence(F.lit(0), F.size("words") - 1))
    pairs = cut.select(*columns, "words", F.explode(places).alias("i")).select(*columns, F.get("words", F.col("i")).alias("word"), F.get("words", F.col("i") + 1).alias("next"))
    grams = F.array(F.xxhash64("word"), F.when(F.col("next").isNotNull(), F.xxhash64("word", "next")))
    return pairs.select(*columns, F.explode(grams).alias("gram")).where("gram IS NOT NULL")


def text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def scores(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """For each text's ``key``: ``found``, its n-grams that occur twice or more, ``total``, the sum of their ratios, and
    ``other``, the ratio of each other n-gram; ``trusted`` has the ids of trusted documents."""
    spark = docs.sparkSession
    ids = trusted.select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(1).alias("flag")).where("doc_id IS NOT NULL").distinct()
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    keyed = texts.join(ids, "doc_id", "left").select(text_key(F.col("text")).alias("key"), F.coalesce("flag", F.lit(0)).alias("flag"), "text")
    # Flags by text are written once; the passes join the ids again, beside the texts.
    flags = written(keyed.groupBy("key").agg(F.max("flag").alias("flag"), F.count("*").alias("copies")), "flags")
    candidates = _frequent(keyed)

    # One row for each frequent n-gram, and one without a gram for all others together.
    marked = occurrences(keyed, "flag").join(F.broadcast(candidates.withColumn("frequent", F.lit(True))), "gram", "left")
    counts = marked.groupBy(F.when(F.col("frequent"), F.col("gram")).alias("gram")).agg(F.count("*").alias("raw"), F.sum("flag").alias("trusted"))
    table = written(counts, "frequent")
    all_raw, all_trusted = table.agg(F.sum("raw"), F.sum("trusted")).first()
    if not all_trusted:
        return spark.createDataFrame([], "key long, found long, total double, other double")

    share = all_trusted / all_raw
    grid = float(1 << 24)
    ratio = lambda raw, t: F.round(F.log((t + SMOOTHING * share) / (raw + SMOOTHING) / share) * grid) / grid
    summed = lambda x: x.groupBy("key").agg(F.count("*").alias("found"), F.sum("ratio").alias("total"))
    known = table.where("gram IS NOT NULL").select("gram", ratio(F.col("raw"), F.col("trusted")).alias("ratio"))
    parts = [summed(occurrences(keyed, "key").join(F.broadcast(known), "gram"))]
    same = Window.partitionBy("gram")
    for k in range(PASSES):
        rare = dealt(keyed, candidates, k).repartition("gram").select("key", F.count("*").over(same).alias("raw"), F.sum("flag").over(same).alias("trusted")).where("raw > 1")
        parts.append(written(summed(rare.select("key", ratio(F.col("raw"), F.col("trusted")).alias("ratio"))), f"rare-{k}"))
    rows = [x.select("key", "found", "total", F.lit(0).alias("flag"), F.lit(0).cast("long").alias("copies")) for x in parts]
    rows.append(flags.select("key", F.lit(0).cast("long").alias("found"), F.lit(0.0).alias("total"), "flag", "copies"))
    summed = functools.reduce(DataFrame.unionAll, rows).groupBy("key")
    summed = summed.agg(F.sum("found").alias("found"), F.sum("total").alias("total"), F.max("flag").alias("flag"), F.sum("copies").alias("copies"))
    # Rows with the same text were summed together; each has the same part of it.
    other = ratio(F.lit(1), F.col("flag"))
    return written(summed.select("key", (F.col("found") / F.col("copies")).cast("long").alias("found"), (F.col("total") / F.col("copies")).alias("total"), other.alias("other")), "scores")


def dealt(texts: DataFrame, frequent: DataFrame, k: int) -> DataFrame:
    """Pass ``k``'s share of the occurrences of n-grams that are not ``frequent``: each n-gram has one pass."""
    mine = F.pmod(F.shiftrightunsigned("gram", 32), F.lit(PASSES)) == k
    return occurrences(texts, "key", "flag").where(mine).join(F.broadcast(frequent), "gram", "left_anti")


def _frequent(texts: DataFrame) -> DataFrame:
    """``gram`` of the up to ``FREQUENT`` n-grams seen most often, and twice at least, in a sample of the texts."""
    seen = occurrences(texts.sample(SAMPLE, 8)).groupBy("gram").count().where("count > 1")
    seen = written(seen, "seen")
    return written(seen.where(F.col("count") >= _least(seen)).select("gram"), "candidates")


def _least(seen: DataFrame) -> int:
    """The least power of two so that at most ``FREQUENT`` n-grams of the table were seen so often."""
    least, n = 1 << 62, 0
    for x in seen.groupBy((F.length(F.bin("count")) - 1).alias("power")).agg(F.count("*").alias("n")).orderBy(F.desc("power")).collect():
        n += x["n"]
        if n > FREQUENT:
            break
        least = 1 << x["power"]
    return least


def judge(docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Every row of ``docs`` as the struct ``row``, with its counts, ``ratio``, ``base_failed`` and ``kept``."""
    n = F.size("words")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), text_key(F.col("text")).alias("key"))
    rows = rows.join(small(scores(docs, trusted)), "key", "left").withColumn("text", F.coalesce(F.col("row.text").cast("string"), F.lit("")))
    rows = rows.select("row", "text", "found", "total", "other", words(F.col("text")).alias("words")).withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    lines = F.filter(F.split("text", "\n", -1), lambda line: F.btrim(line, F.lit(_SPACES)) != "")
    windows = F.transform(F.slice("hashes", 1, F.greatest(n - 2, F.lit(0))), lambda h, i: F.xxhash64(h, F.get("hashes", i + 1), F.get("hashes", i + 2)))

    score = F.coalesce(F.col("total") + (2 * n - 1 - F.col("found")) * F.col("other"), F.lit(0.0))
    rows = rows.select(
        "row",
        n.cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        lines.alias("lines"),
        windows.alias("windows"),
        F.when(n > 0, score / (2 * n - 1)).otherwise(0.0).alias("ratio"),
    )
    rows = rows.withColumn("sorted", F.when(F.size(F.array_distinct("windows")) < F.size("windows"), F.sort_array("windows")).otherwise(F.array().cast("array<bigint>")))
    twice = F.array_distinct(F.filter("sorted", lambda h, i: (i > 0) & (h == F.get("sorted", i - 1))))
    rows = rows.withColumn("twice", twice)
    placed = F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    rows = rows.withColumn("placed", F.when(F.size("twice") > FEW, placed).otherwise(F.array().cast("array<struct<h:bigint,i:int>>")))
    rows = rows.withColumn("repeated", _repeated())
    at = F.col("repeated")
    covered = F.array_distinct(F.concat(at, F.transform(at, lambda p: p + 1), F.transform(at, lambda p: p + 2)))
    rows = rows.select(
        "row", "n_words", "word_chars", "n_symbols", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"), F.size(covered).cast("long").alias("n_repeat_words"), "ratio"
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    return rows.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("ratio") >= threshold))


def accepted(docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that are kept."""
    # The row number is always at least 0; as it depends on the place of a row, the verdict is computed
    # once before the filter and not again, expanded, within it.
    judged = judge(docs, trusted, threshold).select("row", "kept", F.monotonically_increasing_id().alias("place"))
    return judged.where("kept AND place >= 0").select("row.*")


def _repeated() -> Column:
    """Positions of windows that occur twice or more: by lookup where few are, else by sorting windows with positions."""
    few = F.filter(F.transform("windows", lambda h, i: F.when(F.array_contains("twice", h), i)), lambda i: i.isNotNull())
    same = lambda k, x: F.coalesce(F.get("placed", k)["h"] == x["h"], F.lit(False))
    many = F.transform(F.filter("placed", lambda x, k: same(k - 1, x) | same(k + 1, x)), lambda x: x["i"])
    return F.when(F.size("twice") == 0, F.array().cast("array<int>")).when(F.size("placed") == 0, few).otherwise(many)

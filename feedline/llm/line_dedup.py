"""Line dedup: repeated runs of lines by prefix doubling over line ids (operator 10).

A text's lines with a word, trimmed, are a sequence of line ids.  A run of whole lines with ``MIN_WORDS`` words or
more that occurs earlier, in a document with a smaller id or further up in the same one, is a later copy, and its
lines are deleted; of each maximal run the first copy stays.  Blank lines go with the line before them.

Suffixes are ordered by distributed prefix doubling: the rank of a suffix by its first ``2k`` lines is the place of
the pair of ranks by ``k`` lines, at its start and ``k`` lines on, in the sorted list of all such pairs.  Only pairs
that occur twice are ranked; suffixes that are alone with their prefix drop out.  A run of lines is one row with an
array of ranks, so the rank ``k`` lines on is a step in the array, and only pairs of ranks are shuffled.  They are
counted before they are sorted, and looked up by broadcast or by a salted join, so a line, a passage or a copy that
fills a third of the corpus is one row in each sort and no task's alone.

Suffixes with a common prefix of m lines are an interval of the suffix array: the suffixes between two neighbours whose
longest common prefix is below m.  It is named by the ranks of its first and last ``w`` lines, ``w`` the greatest
power of two up to m: they overlap or touch, so equal names mean m equal lines.  Which lines of a maximal repeated run
are copies is read from the intervals of least length: each of its lines lies in a window of the run that begins, or
ends, at a line and has just reached ``MIN_WORDS`` words, and the run has an earlier copy just where the windows have
one.  Such windows have ``MIN_WORDS`` lines at most, which bounds the doubling.

Line ids are ranks of 128-bit hashes of the lines.  All of it is DataFrame expressions.

Defined cases: null and empty texts have no lines and stay as they are; rows with the same ``doc_id`` and text are
one document and all get its result; rows with the same id and other texts are ordered by a hash of the text; null
ids come before all others; all input columns are kept in the struct ``row``, so no name clashes; an empty table
gives an empty result; a run that overlaps its own earlier copy keeps the lines of the first copy.  Texts of any
length are read whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedline.llm.decontamination import mark
from feedline.llm.shared import BROADCAST_ROWS, written

MIN_WORDS = 50
#: Documents with deleted lines, and deleted lines, up to which the list of them is broadcast.
BROADCAST_DOCS, BROADCAST_LINES = 300_000, 2_000_000
#: Parts into which the rows of each key are dealt where a table of ranks is too large to be broadcast.
SALTS = 16

_SPACES = " \t\n\x0b\x0c\r"
_PLACE = ["doc_id", "mark"]


def lines(docs: DataFrame) -> DataFrame:
    """``doc_id, mark, pos, n, h1, h2`` of each line with a word: its place, its words and its hash."""
    text = F.col("text").cast("string")
    each = docs.select(F.col("doc_id").cast("long").alias("doc_id"), mark(text).alias("mark"), F.posexplode(_units(text)).alias("pos", "unit"))
    each = each.select("doc_id", "mark", "pos", F.btrim("unit", F.lit(_SPACES)).alias("line")).where("line <> ''")
    # Single blanks are counted by the bytes that go without them; rarer white space by the words.
    plain = ~(F.contains("line", F.lit("  ")) | F.contains("line", F.lit("\t")) | F.contains("line", F.lit("\x0b")) | F.contains("line", F.lit("\x0c")) | F.contains("line", F.lit("\r")))
    blanks = F.octet_length("line") - F.octet_length(F.replace("line", F.lit(" "), F.lit("")))
    n = F.when(plain, blanks + 1).otherwise(F.regexp_count("line", F.lit("[^ \\x09-\\x0D]+")))
    return each.select("doc_id", "mark", "pos", n.alias("n"), F.xxhash64("line").alias("h1"), F.xxhash64(F.lit("line"), "line").alias("h2"))


def _units(text: Column) -> Column:
    """The lines of a text, each with the blank lines that follow it; blank lines at the start are a unit of their own."""
    return F.split(F.coalesce(text, F.lit("")), r"\n(?![ \t\x0B\f\r]*(?:\n|\z))", -1)


def _ranked(pairs: DataFrame, first: str, second: str, name: str) -> DataFrame:
    """``first, second, rank`` of the pairs that occur twice or more, in the order of the pairs."""
    twice = pairs.groupBy(first, second).agg(F.count("*").alias("n")).where("n > 1").select(first, second)
    return written(twice.orderBy(first, second).withColumn("rank", F.monotonically_increasing_id()), name)


def _looked_up(rows: DataFrame, table: DataFrame, keys: list[str], spread: list[str], how: str = "inner") -> DataFrame:
    """``rows`` with the columns that ``table`` has for their keys: broadcast if a count shows it to be small enough;
    else ``SALTS`` copies of the table meet the rows, dealt by ``spread``, so no key's rows lie in one task."""
    if table.count() <= BROADCAST_ROWS:
        return rows.join(F.broadcast(table), keys, how)
    dealt = rows.withColumn("salt", F.pmod(F.xxhash64(*spread), F.lit(SALTS)).cast("int"))
    return dealt.join(table.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), [*keys, "salt"], how).drop("salt")


def runs(found: DataFrame, min_words: int) -> DataFrame:
    """``doc_id, mark, at, lines``: the runs of repeated lines with ``min_words`` words or more, each a row: the place of its
    first line, and for each line its ``rank`` and the numbers of lines ``ms`` of the windows that begin with it."""
    place = [F.col(c) for c in _PLACE]
    rank = _ranked(found.select("h1", "h2"), "h1", "h2", "line-ranks")
    kept = _looked_up(found, rank, ["h1", "h2"], [*_PLACE, "pos"]).select(*_PLACE, "pos", "n", "rank")
    # All that follows is within a document, on this one exchange.
    kept = kept.repartition(*place).dropDuplicates([*_PLACE, "pos"])
    run = [*_PLACE, "run"]
    kept = kept.withColumn("run", F.col("pos") - F.row_number().over(W.partitionBy(*_PLACE).orderBy("pos")))
    kept = kept.withColumn("upto", F.sum("n").over(W.partitionBy(*run).orderBy("pos"))).withColumn("before", F.col("upto") - F.col("n"))
    on = W.partitionBy(*run).orderBy("before").rangeBetween(0, min_words - 1)
    back = W.partitionBy(*run).orderBy("upto").rangeBetween(1 - min_words, 0)
    reach = lambda over: F.when(F.sum("n").over(over) >= min_words, F.count("*").over(over)).cast("int")
    kept = kept.withColumns({"m_on": reach(on), "m_back": reach(back)})
    # A window counts at its first line; one that is reached back from a line is listed there once more.
    own = F.struct("pos", F.struct("rank").alias("line"), F.col("m_on").alias("m"))
    ending = F.struct((F.col("pos") - F.col("m_back") + 1).alias("pos"), F.lit(None).cast("struct<rank:bigint>").alias("line"), F.col("m_back").alias("m"))
    each = kept.select(*run, F.explode(F.array(own, F.when(F.col("m_back").isNotNull(), ending))).alias("x")).where("x IS NOT NULL").select(*run, "x.*")
    each = each.groupBy(*run, "pos").agg(F.max("line.rank").alias("rank"), F.collect_set("m").alias("ms"))
    row = each.groupBy(*run).agg(F.min("pos").alias("at"), F.array_sort(F.collect_list(F.struct("pos", "rank", "ms"))).alias("lines"))
    row = row.where(F.exists("lines", lambda x: F.size(x["ms"]) > 0))
    return row.select(*_PLACE, "at", F.transform("lines", lambda x: F.struct(x["rank"].alias("rank"), x["ms"].alias("ms"))).alias("lines"))


def _named(ranked: DataFrame, width: int) -> DataFrame:
    """``doc_id, mark, start, m, a, b``: the windows of ``width`` lines or more, but fewer than twice as many, named by the
    ranks of their first and their last ``width`` lines.  Without a rank there is no other copy."""
    each = F.transform("lines", lambda x, i: F.transform(
        F.filter(x["ms"], lambda m: (m >= width) & (m < 2 * width)),
        lambda m: F.struct((F.col("at") + i).alias("start"), m.alias("m"), x["rank"].alias("a"), F.get("lines", i + m - width)["rank"].alias("b"))))
    return ranked.select(*_PLACE, F.explode(F.flatten(each)).alias("x")).select(*_PLACE, "x.*").where("a IS NOT NULL AND b IS NOT NULL")


def _doubled(ranked: DataFrame, width: int) -> DataFrame:
    """The runs with a window of ``2 * width`` lines or more, ranked by that many lines."""
    longer = ranked.where(F.exists("lines", lambda x: F.exists(x["ms"], lambda m: m >= 2 * width)))
    # The last ``width`` suffixes have no other half; neither have they a window of this length.
    each = F.transform(F.slice("lines", F.lit(1), F.greatest(F.size("lines") - width, F.lit(0))), lambda x, i: F.struct(
        x["rank"].alias("first"), F.get("lines", i + width)["rank"].alias("second"), F.filter(x["ms"], lambda m: m >= 2 * width).alias("ms")))
    pairs = longer.select(*_PLACE, "at", F.posexplode(each).alias("i", "x")).select(*_PLACE, "at", "i", "x.*")
    better = _ranked(pairs.where("first IS NOT NULL AND second IS NOT NULL").select("first", "second"), "first", "second", "pair-ranks")
    found = _looked_up(pairs, better, ["first", "second"], [*_PLACE, "at", "i"], "left")
    row = found.groupBy(*_PLACE, "at").agg(F.array_sort(F.collect_list(F.struct("i", "rank", "ms"))).alias("lines"))
    return row.select(*_PLACE, "at", F.transform("lines", lambda x: F.struct(x["rank"].alias("rank"), x["ms"].alias("ms"))).alias("lines"))


def copies(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``doc_id, mark, pos``: lines that lie in a later copy of a run."""
    ranked = written(runs(written(lines(docs), "lines"), min_words), "repeated-runs")
    longest = F.array_max(F.transform("lines", lambda x: F.coalesce(F.array_max(x["ms"]), F.lit(0))))
    widest = ranked.agg(F.max(longest)).first()[0] or 0  # one row; at most min_words
    named, width = _named(ranked, 1), 1
    while 2 * width <= widest:
        ranked = written(_doubled(ranked, width), "suffix-ranks")
        width *= 2
        named = named.unionByName(_named(ranked, width))
    named = written(named, "line-windows")
    here = F.struct(*_PLACE, "start")
    earliest = written(named.groupBy("m", "a", "b").agg(F.min(here).alias("earliest"), F.count("*").alias("copies")).where("copies > 1"), "intervals")
    later = _looked_up(named, earliest, ["m", "a", "b"], [*_PLACE, "start"]).where(here > F.col("earliest"))
    gone = later.select(*_PLACE, F.explode(F.sequence("start", (F.col("start") + F.col("m") - 1).cast("int"))).alias("pos"))
    return gone.repartition(*[F.col(c) for c in _PLACE]).distinct()


def dedup(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Every row of ``docs`` as the struct ``row``, with the cleaned ``text``, ``n_lines`` (lines, blank ones too) and
    ``n_removed`` (of these)."""
    gone = copies(docs, min_words).groupBy(*_PLACE).agg(F.collect_list("pos").alias("gone"))
    gone = written(gone.select(F.col("doc_id").alias("gone_id"), F.col("mark").alias("gone_mark"), "gone"), "deleted-lines")
    size = gone.agg(F.count("*").alias("docs"), F.sum(F.size("gone")).alias("lines")).first()
    if size["docs"] <= BROADCAST_DOCS and (size["lines"] or 0) <= BROADCAST_LINES:
        gone = F.broadcast(gone)
    text = F.col("text").cast("string")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("own_id"), mark(text).alias("own_mark"), text.alias("text"))
    rows = rows.join(gone, F.col("own_id").eqNullSafe(F.col("gone_id")) & (F.col("own_mark") == F.col("gone_mark")), "left")
    rows = rows.withColumn("units", F.when(F.col("gone").isNotNull(), _units(F.col("text"))))
    left = F.array_except(F.sequence(F.lit(0), F.size("units") - 1), F.col("gone"))
    rows = rows.withColumn("left", F.when(F.col("gone").isNotNull(), left))
    cleaned = F.array_join(F.transform("left", lambda i: F.get("units", i)), "\n")
    count = lambda c: F.coalesce(F.size(F.split(c, "\n", -1)), F.lit(0)).cast("long")
    rows = rows.select("row", F.coalesce(cleaned, F.col("text")).alias("text"), count(F.col("text")).alias("n_lines"), F.size("left").alias("left"))
    remain = F.when(F.col("left") == 0, 0).otherwise(count(F.col("text")))
    return rows.select("row", "text", "n_lines", F.when(F.col("left").isNull(), 0).otherwise(F.col("n_lines") - remain).cast("long").alias("n_removed"))

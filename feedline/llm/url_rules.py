"""URL filter: a sort-merge range join of page hosts with nested host rules (operator 3).

A host's canonical key is its labels in reverse order, each with a dot after it (``m.example.com`` becomes
``com.example.m.``), so a rule's host and all its subdomains are the interval of keys that start with the
rule's key.  Intervals nest or are apart.  Pages and rules are sorted together by key over range partitions;
a sweep along each keeps the stack of active rules, and each page takes the longest active rule whose path its
own path starts with.  A partition begins with the rules that are active at its first key: only prefixes of
that key can be, so they are found by an equi-join.  A host with any share of the pages is spread over
partitions, as pages are ordered by key and id.

Defined cases: a null url, or one without ``://``, has an empty host and path and matches only rules for the
empty host; a null ``page_id`` is kept; repeated pages are judged row by row; a rule's null or empty path fits
every path, its host is read without regard to the case of A-Z; of equal rules with different verdicts ``block``
wins; of fitting rules of equal length the one with the longer host wins; without a fitting rule the default
verdict holds and ``rule`` is null.  Other columns are ignored, whatever their names; empty tables give an empty
result, no rules the default.  Urls of any length are judged whole.
"""

from __future__ import annotations

import string
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedline.llm.shared import written

RESULT = "page_id long, host string, path string, rule string, verdict string"


def _lower(c: Column) -> Column:
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def _key(host: Column) -> Column:
    return F.when(host == "", "").otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit(".")))


def with_host_and_path(pages: DataFrame) -> DataFrame:
    """``page_id, host, path`` of each page."""
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(F.col("rest"), r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(F.col("rest"), F.length("raw") + 1, F.length("rest")), r"^[^?#]*", 0)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), rest.alias("rest")).withColumn("raw", host)
    return rows.select("page_id", _lower(F.col("raw")).alias("host"), path.alias("path"))


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", parts: int | None = None) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every page; ``rules`` has ``host, path, verdict``."""
    count = parts or int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    host = _lower(F.trim(F.coalesce(F.col("host").cast("string"), F.lit(""))))
    rule = rules.select(host.alias("host"), F.coalesce(F.col("path").cast("string"), F.lit("")).alias("path"), F.col("verdict").cast("string").alias("verdict"))
    rule = rule.groupBy("host", "path").agg(F.max("verdict").alias("verdict")).where("verdict IS NOT NULL")
    rule = rule.select(_key(F.col("host")).alias("key"), F.lit(0).alias("kind"), F.lit(None).cast("long").alias("page_id"), "host", "path", "verdict")
    page = with_host_and_path(pages)
    page = page.select(_key(F.col("host")).alias("key"), F.lit(1).alias("kind"), "page_id", "host", "path", F.lit(None).cast("string").alias("verdict"))
    ranged = rule.unionByName(page).repartitionByRange(count, "key", "kind", "page_id", "path").withColumn("part", F.spark_partition_id())
    ranged = written(ranged, "url-ranges")  # from here on each row's part is fixed
    # Rules that are active where a part begins: those for a prefix, label by label, of its first key.
    labels = F.split(F.col("first"), r"(?<=\.)")
    heads = ranged.groupBy("part").agg(F.min("key").alias("first")).select(
        "part", F.explode(F.array_distinct(F.transform(F.sequence(F.lit(0), F.size(labels)), lambda n: F.array_join(F.slice(labels, 1, n), "")))).alias("key")
    )
    carried = heads.join(rule, "key").select(*ranged.columns)
    rows = ranged.unionByName(carried).repartition(count, "part").sortWithinPartitions("part", "key", "kind", "page_id")

    def sweep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part: int | None = None
        #: (key, path -> (rule, verdict), lengths of paths) of active hosts, each key a prefix of the next.
        stack: list[tuple[str, dict[str, tuple[str, str]], list[int]]] = []
        for batch in batches:
            out: list[tuple] = []
            for at, key, kind, page_id, host, path, verdict in zip(*(batch.column(c).to_pylist() for c in ("part", "key", "kind", "page_id", "host", "path", "verdict")), strict=True):
                if at != part:
                    part = at
                    stack.clear()
                while stack and not key.startswith(stack[-1][0]):
                    stack.pop()
                if kind == 0:
                    if not stack or stack[-1][0] != key:
                        stack.append((key, {}, []))
                    found = stack[-1]
                    if path not in found[1]:
                        found[1][path] = host + path, verdict
                        found[2][:] = sorted({*found[2], len(path)}, reverse=True)
                    continue
                best: tuple[str, str] | None = None
                for _, by_path, lengths in reversed(stack):  # the longest host first
                    fit = next((by_path[path[:n]] for n in lengths if n <= len(path) and path[:n] in by_path), None)
                    if fit and (best is None or len(fit[0]) > len(best[0])):
                        best = fit
                out.append((page_id, host, path, *(best or (None, default))))
            columns = list(zip(*out, strict=True)) or [()] * 5
            types = [pa.int64(), *[pa.string()] * 4]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["page_id", "host", "path", "rule", "verdict"])

    return rows.mapInArrow(sweep, RESULT)

"""Header line of every CSV file in a batch, read in parallel on the executors.

Spark applies one header (the first file's) or one given schema *by position*
to all files of a read, so files whose columns were added or reordered would
be mis-assigned.  We group the batch's files by their own header and read each
group by name.  Only the first line of each file is read: a ``mapInPandas``
task opens the file through Arrow's filesystem layer and stops after one line.
When Arrow cannot open the URI scheme, a Spark text scan of the files' first
splits is the fallback.
"""

from __future__ import annotations

import csv
import io
import re
from collections import defaultdict
from urllib.parse import unquote

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


#: A header longer than this is an error, so a file without line ends is never read whole.
MAX_HEADER_BYTES = 16 << 20
_ESCAPES = {"\\t": "\t", "\\r": "\r", "\\b": "\b", "\\f": "\f", '\\"': '"', "\\'": "'", "\\\\": "\\", "\\u0000": "\0"}


def delimiter_text(sep: str) -> str:
    """The characters a delimiter option stands for (``\\t`` written as two characters is a tab)."""
    return _ESCAPES.get(sep, sep) or ","


def _split(line: str, sep: str) -> list[str]:
    """The fields of one line; a field in double quotes may hold the delimiter."""
    if len(sep) == 1:
        return next(csv.reader(io.StringIO(line), delimiter=sep), [])
    field = re.compile(r'"((?:[^"]|"")*)"(?=' + re.escape(sep) + r"|$)|(.*?)(?=" + re.escape(sep) + r"|$)")
    fields, at = [], 0
    while True:
        m = field.match(line, at)
        fields.append(m[2] if m[1] is None else m[1].replace('""', '"'))
        at = m.end() + len(sep)
        if m.end() >= len(line):
            return fields


def _parse_header(line: str, sep: str) -> list[str]:
    names, seen = [], {}
    for i, raw in enumerate(_split(line, delimiter_text(sep))):
        name = raw.strip() or f"_c{i}"
        key = name.lower()
        if key in seen:
            seen[key] += 1
            name = f"{name}{seen[key]}"
        else:
            seen[key] = 0
        names.append(name)
    return names


def first_lines_spark(spark: SparkSession, paths: list[str], encoding: str) -> dict:
    """Fallback: first line of each file from a Spark text scan of the files' first
    splits (any Hadoop file system)."""
    first = (spark.read.option("encoding", encoding).text(literal_paths(paths))
             .where((F.col("_metadata.file_block_start") == 0) & F.col("value").rlike(r"\S"))
             .select(F.col("_metadata.file_path").alias("p"), "value",
                     F.monotonically_increasing_id().alias("i"))
             .groupBy("p").agg(F.min_by("value", "i").alias("header")).collect())
    # The scan reports paths as encoded URIs, the caller may not.
    found = {_plain(unquote(r["p"])): r["header"] for r in first}
    return {p: found.get(_plain(p)) for p in paths}


def _plain(path: str) -> str:
    """A path without the spelling variants of the local scheme."""
    return re.sub("^file:/+", "/", path)


def literal_paths(paths: list[str]) -> list[str]:
    """Paths of existing files, with the characters escaped that Spark would read as a pattern."""
    return [re.sub(r"([\[\]{}*?\\])", r"\\\1", p) for p in paths]


def csv_headers(spark: SparkSession, paths: list[str], sep: str, encoding: str):
    """[(column names, [paths])] for the batch's files, grouped by header line."""
    limit = MAX_HEADER_BYTES

    def first_lines(batches):
        # Runs on the executors; self-contained so it is shipped by value.
        import pandas as pd
        from pyarrow import fs as pafs

        for pdf in batches:
            out, long = [], []
            for path in pdf["path"]:
                line = None
                try:
                    uri = ("file://" + path[5:] if path.startswith("file:/")
                           and not path.startswith("file://") else path)
                    for hadoop_scheme in ("s3a://", "s3n://"):  # the same objects, as Arrow names them
                        if uri.startswith(hadoop_scheme):
                            uri = "s3://" + uri[len(hadoop_scheme):]
                    filesystem, inner = pafs.FileSystem.from_uri(uri)
                    with filesystem.open_input_stream(inner) as stream:
                        buf, lines = b"", []
                        while not lines and len(buf) <= limit:
                            chunk = stream.read(65536)
                            buf += chunk
                            ended = buf.split(b"\n")[: None if not chunk else -1]
                            # the header is the first line that is not blank
                            lines = [x for x in ended if x.strip(b" \t\r\xef\xbb\xbf")]
                            if not chunk:
                                break
                    if not lines and len(buf) > limit:
                        long.append(path)
                    line = lines[0].rstrip(b"\r").decode(encoding, errors="replace").lstrip("\ufeff") if lines else None
                except Exception:  # noqa: BLE001 - unknown scheme: Spark fallback below
                    line = None
                out.append(line)
            if long:
                raise ValueError(f"no line end in the first {limit} bytes of {long[0]}")
            yield pd.DataFrame({"path": pdf["path"], "header": out})

    pdf_paths = spark.createDataFrame([(p,) for p in paths], "path string")
    n = max(1, min(len(paths), spark.sparkContext.defaultParallelism * 4))
    heads = (pdf_paths.repartition(n)
             .mapInPandas(first_lines, "path string, header string")
             .collect())
    by_path = {r["path"]: r["header"] for r in heads}
    missing = [p for p, h in by_path.items() if h is None]
    if missing:
        found = first_lines_spark(spark, missing, encoding)
        for p in missing:
            by_path[p] = found.get(p)
    groups = defaultdict(list)
    for p in paths:
        h = by_path.get(p)
        if h is None:  # empty file: nothing to read
            continue
        groups[h].append(p)
    return [(_parse_header(h, sep), ps) for h, ps in groups.items()]

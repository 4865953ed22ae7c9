"""Streaming sources: exactly-once file discovery (S1, S14) and table-as-stream.

Discovery is a ``binaryFile`` stream that selects only the file *metadata*
(``path``, ``modificationTime``, ``length``): the content column is pruned from
the scan, so the stream costs a listing, not a read.  Its checkpoint's file log
is what makes every file land once, across restarts (T2, T5, T6).  The records
themselves are read in ``foreachBatch`` by the format readers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedline.sources.readers import SRC

BINARY_FILE_SCHEMA = T.StructType([
    T.StructField("path", T.StringType(), False),
    T.StructField("modificationTime", T.TimestampType(), False),
    T.StructField("length", T.LongType(), False),
    T.StructField("content", T.BinaryType(), True),
])

# With no throttle configured a batch holds at most this many files, which bounds
# the path list a micro-batch hands to its reader.
DEFAULT_MAX_FILES_PER_TRIGGER = 1000


def incremental_files(spark: SparkSession, path: str, max_files_per_trigger: int | None) -> DataFrame:
    """S1 + S14: a stream of new files under ``path`` (globs allowed)."""
    n = max_files_per_trigger or DEFAULT_MAX_FILES_PER_TRIGGER
    return (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
            .option("maxFilesPerTrigger", int(n))
            .load(path)
            .select("path", "modificationTime", "length"))


def stream_table(spark: SparkSession, table_name: str) -> DataFrame:
    """The appends of a catalog table as a stream (with the source file kept)."""
    df = spark.readStream.table(table_name)
    try:
        return df.select("*", F.col("_metadata.file_path").alias(SRC))
    except Exception:  # noqa: BLE001 - a source without file metadata
        return df

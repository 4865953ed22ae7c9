"""The folder that driver and executors share, and lineage cuts through it."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder's path under ``spark.checkpoint.dir``; a local folder only for a local master without that setting."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = "file://" + tempfile.mkdtemp(prefix="feedline-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df`` from a Parquet table written in the shared folder: computed once, with no lineage.

    The shuffle files of the write are deleted at its end and not when the driver next collects its garbage."""
    path = shared_folder(df.sparkSession, name)
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key, None)
    conf.set(key, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.unset(key) if before is None else conf.set(key, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows (of an id or a hash or two) up to which a side of a join is broadcast.
BROADCAST_ROWS = 1_000_000


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df``, broadcast if a count shows it to be small enough; else joined as Spark sees fit."""
    return F.broadcast(df) if df.count() <= rows else df

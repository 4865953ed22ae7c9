"""The changes of a landing table as numbered batches.

A file stream over a table's folder sees files, not rows: a merge's new snapshot, a batch delivered again or a table loaded
anew after a reset would reach its readers as more rows.  This feed reads what the producer recorded instead:

* An **append** table is a set of ``_batch_id`` partitions.  Those not yet handed out are new, in the order of their
  generation and number; a batch that its producer writes again is the same partition.  When one that was handed out is
  gone (the table was reset), everything is handed out anew as a replacement.
* A **merge** table is a series of versions in its commit log.  A reader that merges gets the batches that went into the versions
  since its last one, as they were staged: no snapshot is read or compared.  Other readers, which could not
  take a row back, get the newest version as a replacement; so does everybody after a reset.
* An **overwrite** table's new version is a replacement.

What a batch holds is written to the feed's own log before it is handed out, and marked when its sink is done; a run that
died between the two gets the same batch again, under the same number.  A replacement takes the place of all rows
that its feed wrote before: an append reader adds the new partitions and then drops its older ones, a merge reader
rewrites its target without the rows stamped with its operation, an overwrite reader starts its snapshot as always.

The lists on the driver are of batches (at most ``limit`` a batch) and versions, never of rows.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedline.functions.columns import BATCH_COLUMN
from feedline.operators import commits, tables
from feedline.operators.commits import CommitLog, batch_of
from feedline.operators.sinks import read_staged
from feedline.sources.readers import MTIME, SRC

PLAN = T.StructType([
    T.StructField("batch", T.LongType()), T.StructField("replaces", T.BooleanType()), T.StructField("units", T.ArrayType(T.StringType())),
    T.StructField("version", T.LongType()), T.StructField("since", T.LongType())])
#: Batches of an append table that one batch of its reader takes, unless the feed sets ``max_files_per_trigger``.
DEFAULT_UNITS = 1000
_NUMBERS = r"-g(\d+)-b(\d+)$"


@dataclass(frozen=True)
class Batch:
    number: int
    replaces: bool
    rows: DataFrame
    done: Callable[[], None]


class ChangeFeed:
    """``log`` is the commit log of a merge or overwrite table, None for an append table; ``keyed`` tells whether
    the reader merges; ``path`` is the folder of the feed's own log."""

    def __init__(self, spark: SparkSession, table: str, path: str, log: CommitLog | None, keyed: bool, limit: int | None = None):
        self.spark, self.table, self.path, self.log, self.keyed = spark, table, path.rstrip("/"), log, keyed
        self.limit = limit or DEFAULT_UNITS

    # -- the feed's own log ------------------------------------------------------------
    def _put(self, kind: str, row: dict, mode: str = "overwrite") -> None:
        one = self.spark.range(1).select(F.from_json(F.lit(json.dumps(row)), PLAN).alias("r")).select("r.*")
        one.write.mode(mode).parquet(f"{self.path}/{kind}/b={row['batch'] + 1:09d}")

    def _rows(self, kind: str) -> DataFrame:
        self._put(kind, {"batch": -1}, "ignore")  # nothing happens when the log is there
        return self.spark.read.schema(PLAN).option("recursiveFileLookup", "true").parquet(f"{self.path}/{kind}")

    def newest(self) -> dict | None:
        """The batch planned last."""
        row = self._rows("plan").where("batch >= 0").orderBy(F.desc("batch")).first()
        return row.asDict() if row else None

    def replaced_at(self) -> int | None:
        """The number of the newest batch that begins a replacement."""
        return self._rows("plan").where("replaces").agg(F.max("batch")).first()[0]

    # -- batches -----------------------------------------------------------------------
    def batches(self) -> Iterator[Batch]:
        """What a broken run was given, then what is new by now, in batches."""
        last = self.newest()
        if last and self._rows("done").where(F.col("batch") == last["batch"]).isEmpty():
            yield self._batch(last)
        for plan in self._plans(last):
            commits.step("change planned")
            yield self._batch(plan)

    def _batch(self, plan: dict) -> Batch:
        rows = self._units(plan["units"]) if plan["units"] is not None else self._version(plan)
        return Batch(plan["batch"], bool(plan["replaces"]), rows, lambda: self._put("done", {"batch": plan["batch"]}))

    def _plans(self, last: dict | None) -> Iterator[dict]:
        following = last["batch"] + 1 if last else 0
        if not tables.table_exists(self.spark, self.table):
            raise ValueError(f"the table {self.table} that is to be read does not exist")
        for number, plan in enumerate(self._new_units() if self.log is None else self._new_version(last), following):
            row = {"batch": number, "replaces": False, "units": None, "version": None, "since": None} | plan
            self._put("plan", row)
            yield row

    # -- append tables -----------------------------------------------------------------
    def _new_units(self) -> Iterator[dict]:
        shown = self.spark.sql(f"SHOW PARTITIONS {self.table}").select(F.regexp_extract("partition", f"^{BATCH_COLUMN}=([^/]*)", 1).alias("u"))
        now = shown.select(F.url_decode(F.replace("u", F.lit("+"), F.lit("%2B"))).alias("unit")).distinct()
        taken = self._rows("plan").where(F.col("batch") >= (self.replaced_at() or 0)).select(F.explode("units").alias("unit"))
        gone = not taken.join(now, "unit", "left_anti").isEmpty()
        number = lambda i: F.regexp_extract("unit", _NUMBERS, i).try_cast("long")
        new = (now if gone else now.join(taken, "unit", "left_anti")).orderBy(number(1), number(2), "unit")
        units = [r["unit"] for r in new.collect()]  # one name per batch of the producer that is new
        for i in range(0, len(units), self.limit):
            yield {"replaces": gone and i == 0, "units": units[i:i + self.limit]}

    def _units(self, units: list[str]) -> DataFrame:
        rows = self.spark.table(self.table)
        number = lambda i: F.regexp_extract(BATCH_COLUMN, _NUMBERS, i).try_cast("long")
        at = [F.col(c) for c in ("_ingested_at",) if c in rows.columns]
        # Literal partition values: the catalog prunes the scan to these batches.
        return (rows.where(F.col(BATCH_COLUMN).isin(units))
                .select("*", F.col("_metadata.file_path").alias(SRC), F.struct(*at, number(1), number(2)).alias(MTIME)))

    # -- merge and overwrite tables ----------------------------------------------------
    def _new_version(self, last: dict | None) -> Iterator[dict]:
        self.log.refresh()
        now = self.log.last()
        if now is None:
            raise ValueError(f"{self.table} has no committed version")
        if last is None:
            yield {"version": now["version"]}
            return
        since = self.log.rows().where((F.col("version") >= last["version"]) & (F.col("version") <= now["version"]) & (F.col("kind") != "stage"))
        old, *steps = since.orderBy("version").collect()  # one row per version since
        content = lambda r: (r["location"], r["folders"], r["done"])
        if not steps or not old["is_open"] and content(old) == content(now):
            return
        merged = self.keyed and all(r["kind"] in ("merge", "partitions") for r in [old, *steps])
        if merged and self._staged(last["version"], now["version"]):
            yield {"version": now["version"], "since": last["version"]}
        else:
            yield {"version": now["version"], "replaces": True}

    def _staged(self, since: int, upto: int) -> list:
        """The staged batches that the versions after ``since`` took in; of one staged twice the later."""
        rows = self.log.rows().where((F.col("version") >= since) & (F.col("version") <= upto)).orderBy("version").collect()
        held = next(r for r in rows if r["version"] == since)["done"] or {}
        found = {r["token"]: r for r in rows if r["kind"] == "stage"}
        new = lambda token: batch_of(token)[1] > held.get(batch_of(token)[0], -1)
        return [r for token, r in found.items() if new(token)]

    def _version(self, plan: dict) -> DataFrame:
        if plan["since"] is not None:
            return read_staged(self.spark, self._staged(plan["since"], plan["version"]), SRC)
        row = self.log.rows().where((F.col("version") == plan["version"]) & (F.col("kind") != "stage")).first()
        return self.log.read(row, SRC)

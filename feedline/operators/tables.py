"""Catalog plumbing for landing tables stored as parquet at explicit locations.

A table is (name, location, schema, partition columns).  Versions of merge and
overwrite targets are *snapshot directories*; switching version re-points the
catalog entry.  Old snapshots stay readable for queries that already resolved
them.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from feedline.workspace import quote, sql_string


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def create_table(spark: SparkSession, name: str, schema: StructType,
                 partition_cols: list[str], location: str,
                 buckets: tuple[list[str], int] | None = None) -> None:
    """CREATE TABLE IF NOT EXISTS with an explicit schema, partitioning, optional
    bucketing ``(columns, count)`` and location."""
    data = StructType([f for f in schema.fields if f.name not in partition_cols])
    parts = [next(f for f in schema.fields if f.name == p) for p in partition_cols]
    ddl = StructType(data.fields + parts).toDDL()
    part_sql = ""
    if partition_cols:
        part_sql = " PARTITIONED BY (" + ", ".join(quote(p) for p in partition_cols) + ")"
    if buckets:
        part_sql += (" CLUSTERED BY (" + ", ".join(quote(c) for c in buckets[0])
                     + f") INTO {int(buckets[1])} BUCKETS")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet{part_sql} "
              f"LOCATION {sql_string(location)}")


def point_table_at(spark: SparkSession, name: str, schema: StructType,
                   partition_cols: list[str], location: str,
                   buckets: tuple[list[str], int] | None = None) -> None:
    """Make ``name`` show the snapshot at ``location`` (schema may change).

    An unpartitioned table that keeps its columns is re-pointed by one catalog change, so it
    exists at every moment and a run that dies leaves the old or the new version, never none.
    New columns are added before (the old files show them as NULL).  In other cases the new
    entry is made whole, with all its partitions, before it takes the name (``_take_over``)."""
    if not partition_cols and table_exists(spark, name) and not partition_columns(spark, name):
        have = {f.name.lower(): f.dataType for f in spark.table(name).schema.fields}
        new = {f.name.lower(): f.dataType for f in schema.fields}
        if all(new.get(c) == t for c, t in have.items()) and bucket_spec(spark, name) == buckets:
            add_missing_columns(spark, name, schema)
            spark.sql(f"ALTER TABLE {name} SET LOCATION {sql_string(location)}")
            spark.catalog.refreshTable(name)
            return

    def create(entry: str) -> None:
        create_table(spark, entry, schema, partition_cols, location, buckets)
        if partition_cols:
            spark.sql(f"ALTER TABLE {entry} RECOVER PARTITIONS")

    _take_over(spark, name, create)


def _take_over(spark: SparkSession, name: str, create: Callable[[str], None]) -> None:
    """Replaces the catalog entry ``name`` by one that ``create`` makes under another name:
    no reader sees it half made, and only two renames lie between the old and the new."""
    token = uuid.uuid4().hex[:12]
    entry = lambda tag: f"{name[:-1]}__{tag}_{token}`"
    create(entry("next"))
    present = table_exists(spark, name)
    if present:
        spark.sql(f"ALTER TABLE {name} RENAME TO {entry('old')}")
    spark.sql(f"ALTER TABLE {entry('next')} RENAME TO {name}")
    if present:
        spark.sql(f"DROP TABLE {entry('old')}")  # external: the files stay
    spark.catalog.refreshTable(name)


VERSION_PROPERTY = "feedline.version"


def version(spark: SparkSession, name: str) -> int | None:
    """The committed version that the catalog entry shows; None without entry or version."""
    if not table_exists(spark, name):
        return None
    value = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}.get(VERSION_PROPERTY)
    return int(value) if value is not None else None


def set_version(spark: SparkSession, name: str, number: int) -> None:
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{VERSION_PROPERTY}' = '{int(number)}')")


NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def partition_values(path: str) -> dict[str, str | None]:
    """Values of a partition from its folder path ``a=1/b=x``, as written there."""
    values = {k: unquote(v) for k, v in (seg.split("=", 1) for seg in path.strip("/").split("/"))}
    return {k: None if v == NULL_PARTITION else v for k, v in values.items()}


def _spec(path: str) -> str:
    return "PARTITION (" + ", ".join(f"{quote(k)} = " + ("NULL" if v is None else sql_string(v))
                                     for k, v in partition_values(path).items()) + ")"


def move_partitions(spark: SparkSession, name: str, parts: list[str], folders: dict[str, str],
                    step: Callable[[str], None] = lambda _: None) -> None:
    """Each partition path of ``folders`` shows its folder: new ones are added by one statement,
    one that exists is re-pointed in place, so it shows its old or new rows and never none."""
    registered = {r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    shown = partition_folders(spark, name, parts) if registered else {}
    new = [p for p in folders if p not in registered]
    if new:
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS "
                  + " ".join(f"{_spec(p)} LOCATION {sql_string(folders[p])}" for p in new))
    step("partitions added")
    for p, folder in folders.items():
        if p in registered and _bare(shown.get(p)) != _bare(folder):
            spark.sql(f"ALTER TABLE {name} {_spec(p)} SET LOCATION {sql_string(folder)}")
            step("partition moved")
    spark.sql(f"REFRESH TABLE {name}")


def drop_partitions(spark: SparkSession, name: str, paths: list[str]) -> None:
    """Takes partitions out of the catalog entry by one statement."""
    if paths:
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS " + ", ".join(map(_spec, paths)))


def _bare(path: str | None) -> str | None:
    return path and re.sub(r"^file:/+", "/", unquote(path)).rstrip("/")


def partition_folders(spark: SparkSession, name: str, parts: list[str]) -> dict[str, str]:
    """Where each partition that has files keeps them, from the file listing of the table (no file
    is opened).  Partition folders end in ``column=value`` segments wherever they were moved to."""
    found = {}
    for file in spark.table(name).inputFiles():
        folder = file.rsplit("/", 1)[0]
        # Listed paths are URIs: escaped once more than the names on disk.
        plain = unquote(folder)
        found["/".join(plain.split("/")[-len(parts):])] = plain
    return found


def bucket_spec(spark: SparkSession, name: str) -> tuple[list[str], int] | None:
    """``(bucket columns in bucketing order, number of buckets)``, or None."""
    info = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}")
            .where("col_name IN ('Num Buckets', 'Bucket Columns')").collect()}
    if not info.get("Num Buckets") or not info.get("Bucket Columns"):
        return None
    cols = [c.replace("``", "`") for c in re.findall(r"`((?:[^`]|``)*)`", info["Bucket Columns"])]
    return cols, int(info["Num Buckets"])


def table_location(spark: SparkSession, name: str) -> str | None:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"] if rows else None


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def add_missing_columns(spark: SparkSession, name: str, schema: StructType) -> list[str]:
    """K12 generalised: ALTER TABLE ADD COLUMNS for every field the table lacks."""
    have = {f.name.lower() for f in spark.table(name).schema.fields}
    missing = [f for f in schema.fields if f.name.lower() not in have]
    if missing:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({StructType(missing).toDDL()})")
    return [f.name for f in missing]


def replace_schema(spark: SparkSession, name: str, schema: StructType) -> None:
    """Re-create ``name`` with a new schema at the same location, re-registering exactly
    the partitions it had, each in the folder where it is now (a scoped merge moves partitions;
    parquet reads files written under the narrower schema by column name).  Used when a nested
    column gains fields."""
    location, buckets, number = table_location(spark, name), bucket_spec(spark, name), version(spark, name)
    parts = partition_columns(spark, name)
    registered = [r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()] if parts else []
    folders = partition_folders(spark, name, parts) if registered else {}

    def create(entry: str) -> None:
        create_table(spark, entry, schema, parts, location, buckets)
        if registered:
            spark.sql(f"ALTER TABLE {entry} ADD IF NOT EXISTS " + " ".join(
                f"{_spec(p)} LOCATION {sql_string(folders.get(p) or location.rstrip('/') + '/' + p)}" for p in registered))
        if number is not None:
            set_version(spark, entry, number)

    _take_over(spark, name, create)


def new_snapshot_dir(base: str, tag: str = "") -> str:
    return f"{base.rstrip('/')}/_v={tag}{'-' if tag else ''}{uuid.uuid4().hex[:12]}"

"""Where a deployment keeps its state: control tables, landing tables, checkpoints.

Everything lives under one *shared* root (a folder every executor and the driver
can reach).  The root defaults to the cluster's ``spark.checkpoint.dir``; only
when that is unset (tests, a laptop) do we create and register a local one.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

_IDENT = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def shared_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; set one only if unset."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="feedline-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def sql_string(value: str) -> str:
    """A SQL string literal (only used for paths in DDL)."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


class Workspace:
    """Names and locations of one registry deployment.

    ``catalog`` plays the role of the reference's top-level catalog: control
    tables live in ``<catalog>.metadata``.  When ``catalog`` is a configured
    Spark catalog (``spark.sql.catalog.<name>``) three-part names are used as
    is; otherwise the session catalog holds a database ``<catalog>__<schema>``.
    """

    def __init__(self, spark: SparkSession, root: str | None = None,
                 catalog: str = "feedline", metadata_schema: str = "metadata"):
        if not _IDENT.match(catalog or ""):
            # The catalog must be an identifier
            raise ValueError(
                f"Invalid catalog '{catalog}' — expected an identifier [A-Za-z_][A-Za-z0-9_]*")
        self.spark = spark
        self.root = (root or f"{shared_root(spark)}/feedline").rstrip("/")
        self.catalog = catalog
        self.metadata_schema = metadata_schema

    @classmethod
    def scratch(cls, spark: SparkSession, prefix: str = "q") -> "Workspace":
        """A fresh, isolated workspace under the shared root (one per query run)."""
        token = uuid.uuid4().hex[:10]
        return cls(spark, root=f"{shared_root(spark)}/feedline/{prefix}_{token}",
                   catalog=f"{prefix}_{token}")

    # -- names --------------------------------------------------------------------
    def database(self, catalog: str, schema: str) -> str:
        if catalog == "spark_catalog" or self.spark.conf.get(
                f"spark.sql.catalog.{catalog}", None):
            return f"{quote(catalog)}.{quote(schema)}"
        return quote(f"{catalog}__{schema}")

    def table(self, catalog: str, schema: str, table: str) -> str:
        return f"{self.database(catalog, schema)}.{quote(table)}"

    def meta_table(self, name: str) -> str:
        return self.table(self.catalog, self.metadata_schema, name)

    def ensure_database(self, catalog: str, schema: str) -> None:
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database(catalog, schema)}")

    # -- locations ----------------------------------------------------------------
    def meta_location(self, name: str) -> str:
        return f"{self.root}/metadata/{name}"

    def table_location(self, catalog: str, schema: str, table: str) -> str:
        return f"{self.root}/tables/{catalog}/{schema}/{table}"

    def checkpoint_root(self, operation_id: str, generation: int) -> str:
        return f"{self.root}/checkpoints/{operation_id}/g{generation}"

"""Queries over replicas whose producers merge, overwrite, write a batch again or are reset; the oracles are the producers' rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedline.streaming.runner import Runner
from feedline.suite import _landing, _new, _operation, _register, _run, _source, _t, _target
from feedline.suite_recovery import broken_run

QUERIES = {}
ORACLE_SQL = {}


def _query(f):
    QUERIES[f.__name__] = f
    return f


def replicated(spark, ws, reg, name: str, load_type: str, readers: dict[str, str], key: str, **op_kw) -> str:
    """A parquet feed ``op_<name>`` and one operation ``op_<reader>`` for each reader of its table; the raw folder."""
    raw = f"{ws.root}/raw/{name}"
    merging = lambda t: {"merge_keys": key} if t == "merge" else {}
    objects = [_source(f"src_{name}", raw, "*.parquet", "parquet"), _target(f"tgt_{name}", ws, name, **merging(load_type)),
               {"object_id": f"src_{name}_table", "object_type": "source", "source_format": "delta", "file_path": f"{ws.catalog}.bronze.{name}"}]
    operations = [_operation(f"op_{name}", f"src_{name}", f"tgt_{name}", load_type=load_type, **op_kw)]
    for reader, reads in readers.items():
        objects.append(_target(f"tgt_{reader}", ws, reader, **merging(reads)))
        operations.append(_operation(f"op_{reader}", f"src_{name}_table", f"tgt_{reader}", load_type=reads, schema_evolution_mode="none"))
    _register(spark, reg, objects, operations)
    return raw


def _all(spark, ws, tables: list[str], columns: list[str]) -> DataFrame:
    whole = None
    for t in tables:
        rows = _landing(spark, ws, t).select(*columns, F.lit(t).alias("replica"))
        whole = rows if whole is None else whole.unionByName(rows)
    return whole


@_query
def ingest_table_stream_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A merged table read by a merging and by an appending replica, before and after an update."""
    ws, reg = _new(spark)
    readers = {"merged": "merge", "appended": "append"}
    raw = replicated(spark, ws, reg, "customer", "merge", readers, "c_custkey")
    c = _t(spark, sf_dir, "customer")
    c.repartition(2).write.parquet(raw)
    for op in ("op_customer", "op_merged", "op_appended"):
        _run(ws, op)
    c.where("c_nationkey < 10").withColumn("c_name", F.concat("c_name", F.lit("-v1"))).write.mode("append").parquet(raw)
    _run(ws, "op_customer")
    c.where("c_nationkey < 5").withColumn("c_name", F.concat("c_name", F.lit("-v2"))).write.mode("append").parquet(raw)
    for op in ("op_customer", "op_merged", "op_appended"):
        _run(ws, op)
    return _all(spark, ws, list(readers), c.columns)


_CUSTOMER = "c_custkey, c_name || CASE WHEN c_nationkey < 5 THEN '-v2' WHEN c_nationkey < 10 THEN '-v1' ELSE '' END AS c_name"
ORACLE_SQL["ingest_table_stream_merge"] = f"""SELECT customer.* REPLACE ({_CUSTOMER.split(', ', 1)[1]}), replica
FROM customer, (VALUES ('merged'), ('appended')) AS r(replica)"""


@_query
def ingest_replica_after_reset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An appended table is reset and loaded anew from fewer and other rows; its replicas follow."""
    ws, reg = _new(spark)
    readers = {"appended": "append", "merged": "merge"}
    raw = replicated(spark, ws, reg, "orders", "append", readers, "o_orderkey", max_files_per_trigger=2)
    o = _t(spark, sf_dir, "orders")
    o.repartition(5).write.parquet(raw)
    for op in ("op_orders", "op_appended", "op_merged"):
        _run(ws, op)
    o.where("o_orderstatus <> 'F'").repartition(3).write.mode("overwrite").parquet(raw)
    Runner(ws).reset(["op_orders"])
    for op in ("op_orders", "op_appended", "op_merged"):
        _run(ws, op)
    return _all(spark, ws, list(readers), o.columns)


ORACLE_SQL["ingest_replica_after_reset"] = """SELECT orders.*, replica FROM orders, (VALUES ('merged'), ('appended')) AS r(replica)
WHERE o_orderstatus <> 'F'"""


@_query
def ingest_replica_redelivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replicas of an overwritten table whose runs die with a batch planned, and with one written and not marked."""
    ws, reg = _new(spark)
    readers = {"appended": "append", "merged": "merge", "snapshot": "overwrite"}
    raw = replicated(spark, ws, reg, "part", "overwrite", readers, "p_partkey")
    p = _t(spark, sf_dir, "part")
    p.repartition(2).write.parquet(raw)
    _run(ws, "op_part")
    for reader in readers:
        broken_run(ws, f"op_{reader}", "change planned")
        _run(ws, f"op_{reader}")
    p.where("p_size <= 30").withColumn("p_name", F.concat("p_name", F.lit("-v1"))).write.mode("append").parquet(raw)
    _run(ws, "op_part")
    for reader in readers:
        broken_run(ws, f"op_{reader}", "change written")
        _run(ws, f"op_{reader}")
    return _all(spark, ws, list(readers), p.columns)


ORACLE_SQL["ingest_replica_redelivered"] = """SELECT part.* REPLACE (p_name || '-v1' AS p_name), replica
FROM part, (VALUES ('appended'), ('merged'), ('snapshot')) AS r(replica) WHERE p_size <= 30"""

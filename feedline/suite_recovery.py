"""Queries over feeds whose runs die between two steps of a commit and are run again; the oracles know of no fault."""

from __future__ import annotations

import contextlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedline.operators import commits
from feedline.streaming.runner import Runner
from feedline.suite import _landing, _new, _run, _single_feed, _t

QUERIES = {}
ORACLE_SQL = {}


class RunDied(RuntimeError):
    """What a run meets where its driver would be lost."""


@contextlib.contextmanager
def dies_at(name: str, occurrence: int = 1):
    """Within it, the n-th time a commit comes to the step ``name`` fails."""
    left, real = [occurrence], commits.step

    def step(at: str) -> None:
        if at == name:
            left[0] -= 1
            if left[0] == 0:
                raise RunDied(name)

    commits.step = step
    try:
        yield
    finally:
        commits.step = real


def broken_run(ws, operation_id: str, step: str, occurrence: int = 1) -> None:
    with dies_at(step, occurrence):
        result = Runner(ws).run_operation(operation_id, raise_errors=False)
    if result.status != "FAILED" or step not in (result.error or ""):
        raise RuntimeError(f"the run did not die at '{step}': {result.status} {result.error}")


def _query(f):
    QUERIES[f.__name__] = f
    return f


CUSTOMER = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment", "c_acctbal"]


@_query
def ingest_merge_after_crash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A seed run that dies with its snapshot written and not committed, an update that dies between
    its commit and the catalog's change, and one that dies with its batch staged; each is run again."""
    ws, reg = _new(spark)
    raw = _single_feed(spark, ws, reg, "customer", "parquet", "*.parquet", target_kw={"merge_keys": "c_custkey"}, load_type="merge")
    c = _t(spark, sf_dir, "customer").select(*CUSTOMER)
    c.repartition(2).write.parquet(raw)
    broken_run(ws, "op_customer", "before commit")
    _run(ws, "op_customer")
    c.where("c_mktsegment = 'BUILDING'").withColumn("c_name", F.concat("c_name", F.lit("-v1"))).write.mode("append").parquet(raw)
    broken_run(ws, "op_customer", "committed")
    _run(ws, "op_customer")
    new = c.where("c_mktsegment = 'MACHINERY'").withColumns({"c_custkey": F.col("c_custkey") + 1000000, "c_name": F.concat("c_name", F.lit("-new"))})
    new.write.mode("append").parquet(raw)
    broken_run(ws, "op_customer", "stage recorded")
    _run(ws, "op_customer")
    return _landing(spark, ws, "customer").select(*CUSTOMER)


ORACLE_SQL["ingest_merge_after_crash"] = """SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN c_name || '-v1' ELSE c_name END AS c_name,
  c_nationkey, c_mktsegment, c_acctbal FROM customer
UNION ALL
SELECT c_custkey + 1000000, c_name || '-new', c_nationkey, c_mktsegment, c_acctbal FROM customer WHERE c_mktsegment = 'MACHINERY'"""


@_query
def ingest_overwrite_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6: a snapshot of several batches whose run dies between them is taken up again and stays whole."""
    ws, reg = _new(spark)
    raw = _single_feed(spark, ws, reg, "part", "parquet", "*.parquet", load_type="overwrite", max_files_per_trigger=1)
    p = _t(spark, sf_dir, "part")
    p.repartition(2).write.parquet(raw)
    _run(ws, "op_part")
    p.where("p_size <= 25").repartition(3).write.mode("append").parquet(raw)
    broken_run(ws, "op_part", "inserted")
    _run(ws, "op_part")
    return _landing(spark, ws, "part").select(*p.columns)


ORACLE_SQL["ingest_overwrite_resumed"] = "SELECT * FROM part WHERE p_size <= 25"


@_query
def ingest_merge_widened_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3 K5: partitions moved by a scoped merge stay where they are when a nested column gains a field later, in a run that
    dies while partitions move."""
    ws, reg = _new(spark)
    raw = _single_feed(spark, ws, reg, "customer", "parquet", "*.parquet", target_kw={"merge_keys": "c_nationkey, c_custkey", "partition_cols": "c_nationkey"}, load_type="merge")
    c = _t(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", F.struct(F.col("c_name").alias("name")).alias("who"), "c_acctbal")
    c.repartition(2).write.parquet(raw)
    _run(ws, "op_customer")
    renamed = c.where("c_nationkey < 8").withColumn("who", F.struct(F.concat("who.name", F.lit("-v1")).alias("name")))
    renamed.write.mode("append").parquet(raw)
    _run(ws, "op_customer")
    wider = _t(spark, sf_dir, "customer").where("c_nationkey < 4").select(
        "c_custkey", "c_nationkey", F.struct(F.concat("c_name", F.lit("-v2")).alias("name"), F.col("c_mktsegment").alias("segment")).alias("who"), "c_acctbal")
    wider.write.mode("append").parquet(raw)
    broken_run(ws, "op_customer", "partition moved")
    _run(ws, "op_customer")
    return _landing(spark, ws, "customer").select("c_custkey", "c_nationkey", F.col("who.name").alias("name"), F.col("who.segment").alias("segment"), "c_acctbal")


ORACLE_SQL["ingest_merge_widened_partitioned"] = """SELECT c_custkey, c_nationkey,
  c_name || CASE WHEN c_nationkey < 4 THEN '-v2' WHEN c_nationkey < 8 THEN '-v1' ELSE '' END AS name,
  CASE WHEN c_nationkey < 4 THEN c_mktsegment END AS segment, c_acctbal FROM customer"""

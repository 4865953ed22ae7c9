"""Queries over feeds that read each other in circles: their order as a table, and a run in that order."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedline.plans import deps
from feedline.streaming.runner import Runner
from feedline.suite import _landing, _new, _operation, _register, _source, _t, _target

QUERIES = {}
ORACLE_SQL = {}


def _query(f):
    QUERIES[f.__name__] = f
    return f


def feed_graph(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """One feed a customer, in blocks of seven keys: place x of a block reads place (3 x + 1) mod 7, which makes a circle
    of six and a feed that reads itself.  Place 0 also reads the circle of the block before, except in each third
    block, and place 3 the circle of its own block."""
    c = _t(spark, sf_dir, "customer").selectExpr("c_custkey AS k", "c_custkey % 7 AS x", "c_custkey - c_custkey % 7 AS b")
    feed = lambda k: F.concat(F.lit("op_"), F.lpad(k.cast("string"), 12, "0"))
    reads = F.array_compact(F.array(F.expr("b + (3 * x + 1) % 7"),
                                    F.expr("CASE WHEN x = 0 AND b % 21 <> 0 THEN b - 5 WHEN x = 3 THEN b + 4 END")))
    nodes = c.select(feed(F.col("k")).alias("operation_id"))
    edges = c.select(feed(F.col("k")).alias("consumer"), F.explode(reads).alias("r")).select("consumer", feed(F.col("r")).alias("producer"))
    return nodes, edges.join(nodes.withColumnRenamed("operation_id", "producer"), "producer", "left_semi")


_GRAPH = """nodes AS (SELECT 'op_' || lpad(CAST(c_custkey AS VARCHAR), 12, '0') AS op, c_custkey AS k, c_custkey % 7 AS x,
  c_custkey - c_custkey % 7 AS b FROM customer),
reads AS (SELECT op, b + (3 * x + 1) % 7 AS r FROM nodes
  UNION ALL SELECT op, b - 5 FROM nodes WHERE x = 0 AND b % 21 <> 0
  UNION ALL SELECT op, b + 4 FROM nodes WHERE x = 3),
edges AS (SELECT DISTINCT reads.op AS consumer, p.op AS producer FROM reads JOIN nodes p ON p.k = reads.r WHERE reads.op <> p.op),
behind(a, z) AS (SELECT consumer, producer FROM edges
  UNION SELECT behind.a, edges.producer FROM behind JOIN edges ON edges.consumer = behind.z),
circle AS (SELECT x.a AS op, MIN(x.z) AS component FROM behind x JOIN behind y ON x.a = y.z AND x.z = y.a GROUP BY x.a)"""


@_query
def dependency_circles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feeds that wait for themselves, with the smallest id of their circle."""
    _, edges = feed_graph(spark, sf_dir)
    return deps.circles(edges)


ORACLE_SQL["dependency_circles"] = f"WITH RECURSIVE {_GRAPH}\nSELECT op AS operation_id, component FROM circle"


@_query
def run_waves_with_cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wave of every feed, with each circle opened at its smallest id."""
    return deps.dependency_waves(*feed_graph(spark, sf_dir))


# Each circle of these feeds is simple, so opening it once leaves none.
ORACLE_SQL["run_waves_with_cycles"] = f"""WITH RECURSIVE {_GRAPH},
kept AS (SELECT edges.* FROM edges LEFT JOIN circle c ON c.op = consumer LEFT JOIN circle p ON p.op = producer
  WHERE NOT COALESCE(c.op = c.component AND p.component = c.component, FALSE)),
lv(op, wave) AS (SELECT op, 0 FROM nodes WHERE op NOT IN (SELECT consumer FROM kept)
  UNION SELECT kept.consumer, lv.wave + 1 FROM lv JOIN kept ON kept.producer = lv.op)
SELECT lv.op AS operation_id, CAST(MAX(lv.wave) AS INTEGER) AS wave, COALESCE(MAX(circle.component) = lv.op, FALSE) AS opens_cycle
FROM lv LEFT JOIN circle ON circle.op = lv.op GROUP BY lv.op"""


@_query
def run_all_with_cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two circles, each of a table that a file feed and its own copy of a copy write, and a feed behind each.

    The run opens each circle at the copy, which sees the file feed's rows; the way back adds them to the first
    table again; what is behind the circle follows the copy."""
    ws, reg = _new(spark)
    objects, operations, columns = [], [], {"orders": "o_orderkey", "supplier": "s_suppkey"}
    for t in columns:
        raw = f"{ws.root}/raw/{t}"
        _t(spark, sf_dir, t).repartition(2).write.parquet(raw)
        table = lambda name: {"object_type": "source", "source_format": "delta", "file_path": f"{ws.catalog}.bronze.{name}"}
        objects += [_source(f"src_{t}", raw, "*.parquet", "parquet"), _target(f"tgt_{t}", ws, t),
                    {"object_id": f"src_{t}_table", **table(t)}, {"object_id": f"src_{t}_copy", **table(f"{t}_copy")},
                    _target(f"tgt_{t}_copy", ws, f"{t}_copy"), _target(f"tgt_{t}_behind", ws, f"{t}_behind")]
        operations += [_operation(f"op_{t}_files", f"src_{t}", f"tgt_{t}")]
        operations += [_operation(op, source, target, schema_evolution_mode="none") for op, source, target in (
            (f"op_{t}_1copy", f"src_{t}_table", f"tgt_{t}_copy"), (f"op_{t}_2back", f"src_{t}_copy", f"tgt_{t}"),
            (f"op_{t}_0behind", f"src_{t}_copy", f"tgt_{t}_behind"))]
    _register(spark, reg, objects, operations)
    with warnings.catch_warnings():
        warnings.simplefilter("ignore", RuntimeWarning)
        results = Runner(ws).run_all()
    for r in results:
        if r.status != "SUCCESS":
            raise RuntimeError(f"{r.operation_id}: {r.error}")
    landed = [_landing(spark, ws, name).select(F.lit(name).alias("landing"), F.col(key).alias("key"), "_operation_id")
              for t, key in columns.items() for name in (t, f"{t}_copy", f"{t}_behind")]
    whole = landed[0]
    for rows in landed[1:]:
        whole = whole.unionByName(rows)
    return whole


ORACLE_SQL["run_all_with_cycles"] = "\nUNION ALL ".join(
    f"SELECT '{t}{end}' AS landing, {key} AS key, 'op_{t}_{op}' AS _operation_id FROM {t}"
    for t, key in (("orders", "o_orderkey"), ("supplier", "s_suppkey"))
    for end, op in (("", "files"), ("", "2back"), ("_copy", "1copy"), ("_behind", "0behind")))

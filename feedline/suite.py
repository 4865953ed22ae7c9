"""Driver queries: every operator of the inventory run over the given tables.

Ingestion queries turn a table into a raw feed (written by Spark into a fresh
folder under the shared root), register an operation for it, run the
framework, and read the landing table back.  Registry/report queries derive
their registry or audit rows from the tables with Spark expressions.  Each
query has an oracle in plain SQL over the original tables (``ORACLE_SQL``);
the derivations are written once as SQL expressions and used by both sides.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedline.operators import sinks
from feedline.plans import deps, reports, rules
from feedline.plans.registry import FILE_SOURCE, OBJECT_SCHEMA, OPERATION_SCHEMA, Registry, \
    _nullable, resolve_operations
from feedline.streaming.runner import Runner
from feedline.workspace import Workspace

AS_OF = "2024-01-31 00:00:00"


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# -- registry helpers ---------------------------------------------------------------------

def _new(spark: SparkSession, prefix: str = "q"):
    ws = Workspace.scratch(spark, prefix)
    reg = Registry(ws)
    reg.create_control_tables()
    return ws, reg


def _source(object_id: str, path: str, glob: str | None, fmt: str | None, **kw) -> dict:
    return {"object_id": object_id, "object_type": "source", "source_format": FILE_SOURCE,
            "file_path": path.rstrip("/") + "/", "wildcard_pattern": glob, "file_format": fmt, **kw}


def _target(object_id: str, ws: Workspace, table: str, **kw) -> dict:
    return {"object_id": object_id, "object_type": "target", "target_catalog": ws.catalog,
            "target_schema": "bronze", "target_table": table, **kw}


def _operation(operation_id: str, src: str, tgt: str, **kw) -> dict:
    base = {"operation_id": operation_id, "enabled": True, "source_object_id": src,
            "target_object_id": tgt, "load_type": "append", "merge_schema": True,
            "schema_evolution_mode": "addNewColumns", "cast_all_as_string": False,
            "multiline": False, "case_sensitive": False, "max_files_per_trigger": None}
    base.update(kw)
    return base


def _register(spark: SparkSession, reg: Registry, objects: list[dict], operations: list[dict]):
    objs = spark.createDataFrame([tuple(o.get(f) for f in OBJECT_SCHEMA.fieldNames()) for o in objects],
                                 _nullable(OBJECT_SCHEMA))
    ops = spark.createDataFrame([tuple(o.get(f) for f in OPERATION_SCHEMA.fieldNames())
                                 for o in operations], _nullable(OPERATION_SCHEMA))
    reg.publish(objs, ops)


def _landing(spark: SparkSession, ws: Workspace, table: str) -> DataFrame:
    return spark.table(ws.table(ws.catalog, "bronze", table))


def _single_feed(spark, ws, reg, name, fmt, glob, target_kw=None, source_kw=None, **op_kw):
    raw = f"{ws.root}/raw/{name}"
    _register(spark, reg, [_source(f"src_{name}", raw, glob, fmt, **(source_kw or {})),
                           _target(f"tgt_{name}", ws, name, **(target_kw or {}))],
              [_operation(f"op_{name}", f"src_{name}", f"tgt_{name}", **op_kw)])
    return raw


def _run(ws: Workspace, operation_id: str):
    res = Runner(ws).run_operation(operation_id)
    if res.status != "SUCCESS":
        raise RuntimeError(res.error)
    return res


# -- ingestion queries --------------------------------------------------------------------

ORDERS_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
               "o_orderpriority"]


def ingest_parquet_append(spark, sf_dir):
    """Orders as a parquet feed, appended, partitioned by status."""
    ws, reg = _new(spark)
    raw = _single_feed(spark, ws, reg, "orders", "parquet", "*.parquet",
                       target_kw={"partition_cols": "o_orderstatus"}, max_files_per_trigger=3)
    _t(spark, sf_dir, "orders").repartition(8).write.parquet(raw)
    _run(ws, "op_orders")
    return _landing(spark, ws, "orders").select(*ORDERS_COLS, "_operation_id", "_rescued_data")


def ingest_hive_glob(spark, sf_dir):
    """Orders in ``key=value`` folders read through the glob
    ``year=*/month=*/*.parquet``; the folder values land as columns (basePath)."""
    ws, reg = _new(spark)
    raw = _single_feed(spark, ws, reg, "orders_by_month", "parquet", "year=*/month=*/*.parquet")
    (_t(spark, sf_dir, "orders")
     .select(*ORDERS_COLS, F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))
     .repartition("year", "month").write.partitionBy("year", "month").parquet(raw))
    _run(ws, "op_orders_by_month")
    return _landing(spark, ws, "orders_by_month").select(*ORDERS_COLS, "year", "month")


SUPPLIER_FEED = [
    "s_suppkey",
    "s_name",
    "CASE WHEN s_acctbal > 9000 THEN 'n' || CAST(s_nationkey AS STRING) "
    "ELSE CAST(s_nationkey AS STRING) END AS s_nationkey",
    "CASE WHEN s_acctbal < 0 THEN NULL ELSE s_acctbal END AS s_acctbal",
]
SUPPLIER_SCHEMA = ('{"type":"struct","fields":['
                   '{"name":"s_suppkey","type":"long","nullable":true,"metadata":{}},'
                   '{"name":"s_name","type":"string","nullable":true,"metadata":{}},'
                   '{"name":"s_nationkey","type":"integer","nullable":true,"metadata":{}},'
                   '{"name":"s_acctbal","type":"double","nullable":true,"metadata":{}}]}')


def ingest_csv_explicit_schema(spark, sf_dir):
    """Headerless pipe CSV with NULL tokens, explicit schema, text in an int."""
    ws, reg = _new(spark)
    raw = _single_feed(spark, ws, reg, "supplier", "csv", "*.csv",
                       source_kw={"object_schema": SUPPLIER_SCHEMA, "delimiter": "|",
                                  "null_value": "NULL"},
                       schema_evolution_mode="none")
    (_t(spark, sf_dir, "supplier").selectExpr(*SUPPLIER_FEED).repartition(2)
     .write.options(sep="|", nullValue="NULL", header="false").csv(raw))
    _run(ws, "op_supplier")
    return _landing(spark, ws, "supplier").select("s_suppkey", "s_name", "s_nationkey",
                                                   "s_acctbal", "_rescued_data")


def ingest_csv_as_string(spark, sf_dir):
    """S2 P1 S12 + header grouping: header CSV in two files with different column order,
    everything landed as string."""
    ws, reg = _new(spark)
    raw = _single_feed(spark, ws, reg, "customer", "csv", "*.csv", cast_all_as_string=True)
    c = _t(spark, sf_dir, "customer")
    (c.where("c_nationkey < 12").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
     .coalesce(1).write.option("header", "true").csv(raw))
    (c.where("c_nationkey >= 12").select("c_mktsegment", "c_nationkey", "c_name", "c_custkey")
     .coalesce(1).write.mode("append").option("header", "true").csv(raw))
    _run(ws, "op_customer")
    return _landing(spark, ws, "customer").select("c_custkey", "c_name", "c_nationkey",
                                                   "c_mktsegment")


def ingest_jsonl_explode(spark, sf_dir):
    """One JSON Lines record per order with its line items in items[]."""
    ws, reg = _new(spark)
    raw = _single_feed(spark, ws, reg, "order_items", "jsonl", "*.json", explode_key="items")
    items = (_t(spark, sf_dir, "lineitem")
             .groupBy("l_orderkey")
             .agg(F.collect_list(F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_quantity",
                                          "l_returnflag")).alias("items")))
    orders = _t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("export_id"))
    (orders.join(items, orders.export_id == items.l_orderkey, "left")
     .select("export_id", "items").write.json(raw))
    _run(ws, "op_order_items")
    return _landing(spark, ws, "order_items").select("l_orderkey", "l_linenumber", "l_partkey",
                                                      "l_quantity", "l_returnflag")


def ingest_json_multiline(spark, sf_dir):
    """S3: nation as JSON arrays spanning many lines, with a comment line."""
    ws, reg = _new(spark)
    raw = _single_feed(spark, ws, reg, "nation", "json", "*/*.txt", multiline=True)
    # one JSON array per region, each in its own file
    (_t(spark, sf_dir, "nation").groupBy("n_regionkey")
     .agg(F.concat(F.lit("// nation feed\n[\n"),
                   F.concat_ws(",\n", F.collect_list(F.to_json(F.struct("n_nationkey", "n_name",
                                                                        "n_regionkey")))),
                   F.lit("\n]")).alias("value"))
     .repartition("n_regionkey").write.partitionBy("n_regionkey").text(raw))
    _run(ws, "op_nation")
    return _landing(spark, ws, "nation").select("n_nationkey", "n_name", "n_regionkey")


def _xml_parts(rows: int) -> int:
    """Parts of one XML document: 500, of more than 40 documents more, up to 60,000 (about 8 MB).

    Spark counts 4 MB for opening a file when it spreads files over the tasks that infer a schema, so many
    small ones would go to one task."""
    return min(60_000, max(500, -(-rows // 40)))


def ingest_xml(spark, sf_dir):
    """Part rows as <Part id="..."> elements, rowTag Part, typed inference."""
    ws, reg = _new(spark)
    raw = _single_feed(spark, ws, reg, "part", "xml", "*/*.txt", source_kw={"row_tag": "Part"})
    line = F.concat(F.lit('<Part id="'), F.col("p_partkey").cast("string"), F.lit('"><p_name>'),
                    F.col("p_name"), F.lit("</p_name><p_brand>"), F.col("p_brand"),
                    F.lit("</p_brand><p_size>"), F.col("p_size").cast("string"),
                    F.lit("</p_size><p_retailprice>"), F.col("p_retailprice").cast("string"),
                    F.lit("</p_retailprice></Part>"))
    # one XML document (single root) per bucket of 500 parts or more, each in its own file
    part = _t(spark, sf_dir, "part")
    (part.select(F.floor(F.col("p_partkey") / _xml_parts(part.count())).alias("bucket"), line.alias("line"))
     .groupBy("bucket")
     .agg(F.concat(F.lit("<Parts>\n"), F.concat_ws("\n", F.collect_list("line")),
                   F.lit("\n</Parts>")).alias("value"))
     .repartition("bucket").write.partitionBy("bucket").text(raw))
    _run(ws, "op_part")
    return _landing(spark, ws, "part").select("_id", "p_name", "p_brand", "p_size", "p_retailprice")


def _customer_waves(spark, sf_dir, ws, reg, mode):
    raw = _single_feed(spark, ws, reg, "customer", "csv", "*.csv", schema_evolution_mode=mode)
    c = _t(spark, sf_dir, "customer")
    (c.where("c_nationkey < 12").select("c_custkey", "c_name", "c_nationkey")
     .repartition(2).write.option("header", "true").csv(raw))
    _run(ws, "op_customer")
    (c.where("c_nationkey >= 12").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
     .repartition(2).write.mode("append").option("header", "true").csv(raw))
    _run(ws, "op_customer")
    return _landing(spark, ws, "customer")


def ingest_add_columns(spark, sf_dir):
    """A second wave with one more column widens the table."""
    ws, reg = _new(spark)
    return _customer_waves(spark, sf_dir, ws, reg, "addNewColumns").select(
        "c_custkey", "c_name", "c_nationkey", "c_mktsegment")


def ingest_fail_on_new_columns(spark, sf_dir):
    """P6 failOnNewColumns + K9: a second wave with one more column fails its run; nothing
    of it lands, the audit log records SUCCESS then FAILED, and the files are offered
    again by the next run (the failed batch was never committed)."""
    ws, reg = _new(spark)
    raw = _single_feed(spark, ws, reg, "customer", "csv", "*.csv",
                       schema_evolution_mode="failOnNewColumns")
    c = _t(spark, sf_dir, "customer")
    (c.where("c_nationkey < 12").select("c_custkey", "c_name", "c_nationkey")
     .repartition(2).write.option("header", "true").csv(raw))
    runner = Runner(ws)
    runner.run_operation("op_customer")
    (c.where("c_nationkey >= 12").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
     .repartition(2).write.mode("append").option("header", "true").csv(raw))
    runner.run_operation("op_customer", raise_errors=False)
    runner.run_operation("op_customer", raise_errors=False)  # the same files, again refused
    landed = _landing(spark, ws, "customer").count()
    return (reg.audit_log().where(F.col("operation_id") == "op_customer")
            .select(F.row_number().over(Window.partitionBy("operation_id").orderBy("run_ts"))
                    .alias("run"), "status", "rows_written",
                    F.lit(landed).cast("bigint").alias("landed_rows")))


def ingest_reset_reload(spark, sf_dir):
    """K13 + K2: orders landed at an external location; ``reset`` drops the table and
    forgets the file history, so the next run reads every file again and the table
    holds each row once."""
    ws, reg = _new(spark)
    _single_feed(spark, ws, reg, "orders", "parquet", "*.parquet",
                 target_kw={"table_path": f"{ws.root}/external/orders"})
    _t(spark, sf_dir, "orders").repartition(4).write.parquet(f"{ws.root}/raw/orders")
    _run(ws, "op_orders")
    Runner(ws).reset(["op_orders"])
    reloaded = _run(ws, "op_orders")
    return (_landing(spark, ws, "orders").groupBy("o_orderstatus")
            .agg(F.count(F.lit(1)).alias("n"))
            .select("o_orderstatus", "n",
                    F.lit(reloaded.rows_written).cast("bigint").alias("reloaded_rows")))


def ingest_rescue(spark, sf_dir):
    """Schema frozen after the first wave; the new column's values go to _rescued_data."""
    ws, reg = _new(spark)
    return _customer_waves(spark, sf_dir, ws, reg, "rescue").select(
        "c_custkey", "c_name", "c_nationkey", "_rescued_data")


EVENTS_FEED = ["event_id", "user_id", "event_type",
               "CASE WHEN ts >= TIMESTAMP_NTZ '2024-01-16 00:00:00' AND event_type = 'error' "
               "THEN 'n/a' ELSE CAST(value AS STRING) END AS value"]


def ingest_type_rescue(spark, sf_dir):
    """P5: a value that does not fit the tracked type is NULL in its column and kept
    as written in _rescued_data."""
    ws, reg = _new(spark)
    raw = _single_feed(spark, ws, reg, "events", "csv", "*.csv")
    e = _t(spark, sf_dir, "events")
    (e.where("ts < TIMESTAMP_NTZ '2024-01-16 00:00:00'").selectExpr(*EVENTS_FEED).repartition(2)
     .write.option("header", "true").csv(raw))
    _run(ws, "op_events")
    (e.where("ts >= TIMESTAMP_NTZ '2024-01-16 00:00:00'").selectExpr(*EVENTS_FEED).repartition(2)
     .write.mode("append").option("header", "true").csv(raw))
    _run(ws, "op_events")
    return _landing(spark, ws, "events").select("event_id", "user_id", "event_type", "value",
                                                 "_rescued_data")


def ingest_merge(spark, sf_dir):
    """Customers seeded, then two versions of the BUILDING segment in two
    later files (the later file wins) plus new MACHINERY keys."""
    ws, reg = _new(spark)
    raw = _single_feed(spark, ws, reg, "customer", "jsonl", "*.json",
                       target_kw={"merge_keys": "c_custkey"}, load_type="merge")
    c = _t(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    c.repartition(2).write.json(raw)
    _run(ws, "op_customer")
    b = c.where("c_mktsegment = 'BUILDING'")
    b.withColumn("c_name", F.concat("c_name", F.lit("-v1"))).repartition(2).write.mode("append").json(raw)
    time.sleep(1.1)
    newer = b.withColumn("c_name", F.concat("c_name", F.lit("-v2"))).unionByName(
        c.where("c_mktsegment = 'MACHINERY'").select(
            (F.col("c_custkey") + 1000000).alias("c_custkey"),
            F.concat("c_name", F.lit("-new")).alias("c_name"), "c_nationkey", "c_mktsegment"))
    newer.repartition(2).write.mode("append").json(raw)
    _run(ws, "op_customer")
    return _landing(spark, ws, "customer").select("c_custkey", "c_name", "c_nationkey",
                                                   "c_mktsegment")


def ingest_merge_partitioned(spark, sf_dir):
    """K3 partition-scoped: keys (c_nationkey, c_custkey), partitioned by c_nationkey —
    only the nations a batch touches are rebuilt."""
    ws, reg = _new(spark)
    raw = _single_feed(spark, ws, reg, "customer", "jsonl", "*.json",
                       target_kw={"merge_keys": "c_nationkey, c_custkey",
                                  "partition_cols": "c_nationkey"}, load_type="merge")
    c = _t(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    c.repartition(2).write.json(raw)
    _run(ws, "op_customer")
    b = c.where("c_mktsegment = 'BUILDING' AND c_nationkey < 10")
    b.withColumn("c_name", F.concat("c_name", F.lit("-v1"))).repartition(2).write.mode("append").json(raw)
    time.sleep(1.1)
    newer = b.withColumn("c_name", F.concat("c_name", F.lit("-v2"))).unionByName(
        c.where("c_mktsegment = 'MACHINERY' AND c_nationkey < 10").select(
            (F.col("c_custkey") + 1000000).alias("c_custkey"),
            F.concat("c_name", F.lit("-new")).alias("c_name"), "c_nationkey", "c_mktsegment"))
    newer.repartition(2).write.mode("append").json(raw)
    _run(ws, "op_customer")
    return _landing(spark, ws, "customer").select("c_custkey", "c_name", "c_nationkey",
                                                   "c_mktsegment")


def ingest_overwrite(spark, sf_dir):
    """K6: a second full snapshot (fewer rows) replaces the first one."""
    ws, reg = _new(spark)
    raw = _single_feed(spark, ws, reg, "part", "csv", "*.csv", load_type="overwrite",
                       max_files_per_trigger=2)
    p = _t(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_size")
    p.repartition(3).write.option("header", "true").csv(raw)
    _run(ws, "op_part")
    p.where("p_size <= 25").repartition(3).write.mode("append").option("header", "true").csv(raw)
    _run(ws, "op_part")
    return _landing(spark, ws, "part").select("p_partkey", "p_name", "p_brand", "p_size")


def ingest_restart_no_duplicates(spark, sf_dir):
    """A second run without new files writes nothing; a re-delivered batch
    replaces itself."""
    ws, reg = _new(spark)
    raw = _single_feed(spark, ws, reg, "orders", "parquet", "*.parquet")
    _t(spark, sf_dir, "orders").repartition(4).write.parquet(raw)
    _run(ws, "op_orders")
    second = _run(ws, "op_orders")
    target = Runner(ws).target_of(reg.config("op_orders"))
    landed = spark.table(target.name)
    token = landed.select("_batch_id").first()["_batch_id"]
    again = landed.where(F.col("_batch_id") == token).drop("_batch_id").checkpoint()
    sinks.append(spark, again, target, token)  # re-delivery of an already landed batch
    return (spark.table(target.name).groupBy("o_orderstatus")
            .agg(F.count(F.lit(1)).alias("n"))
            .select("o_orderstatus", "n", F.lit(second.rows_written).cast("bigint")
                    .alias("second_run_rows")))


def ingest_table_stream(spark, sf_dir):
    """A landing table streamed into a replica (the replica runs after its producer)."""
    ws, reg = _new(spark)
    raw = f"{ws.root}/raw/orders"
    _register(spark, reg,
              [_source("src_orders", raw, "*.parquet", "parquet"),
               _target("tgt_orders", ws, "orders"),
               {"object_id": "src_orders_stream", "object_type": "source", "source_format": "delta",
                "file_path": f"{ws.catalog}.bronze.orders"},
               _target("tgt_orders_replica", ws, "orders_replica")],
              [_operation("op_orders", "src_orders", "tgt_orders"),
               _operation("op_orders_replica", "src_orders_stream", "tgt_orders_replica",
                          schema_evolution_mode="none")])
    _t(spark, sf_dir, "orders").repartition(4).write.parquet(raw)
    results = Runner(ws).run_all()
    bad = [r for r in results if r.status != "SUCCESS"]
    if bad:
        raise RuntimeError(bad[0].error)
    return _landing(spark, ws, "orders_replica").select(*ORDERS_COLS, "_operation_id")


#: Rows of one file of a throttled feed, as one task writes a file.
THROTTLED_FILE_ROWS = 1_000_000


def _throttled_files(rows: int) -> int:
    """Six files, and as many times six as keep each within ``THROTTLED_FILE_ROWS``."""
    return 6 * max(1, -(-rows // (6 * THROTTLED_FILE_ROWS)))


def ingest_throttled(spark, sf_dir):
    """Six files, two per trigger -> three micro-batches; of larger tables a multiple of both."""
    ws, reg = _new(spark)
    lineitem = _t(spark, sf_dir, "lineitem")
    files = _throttled_files(lineitem.count())
    raw = _single_feed(spark, ws, reg, "lineitem", "parquet", "*.parquet", max_files_per_trigger=files // 3)
    lineitem.repartition(files).write.parquet(raw)
    _run(ws, "op_lineitem")
    landed = _landing(spark, ws, "lineitem")
    return (landed.groupBy("l_returnflag", "l_linestatus")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("sum_qty"),
                 F.countDistinct("_batch_id").alias("batches")))


def run_all_summary(spark, sf_dir):
    """A registry of feeds in several formats run in dependency order."""
    ws, reg = _new(spark)
    root = f"{ws.root}/raw"
    _register(spark, reg,
              [_source("src_orders", f"{root}/orders", "*.parquet", "parquet"),
               _target("tgt_orders", ws, "orders"),
               {"object_id": "src_orders_stream", "object_type": "source",
                "source_format": "delta", "file_path": f"{ws.catalog}.bronze.orders"},
               _target("tgt_replica", ws, "orders_replica"),
               _source("src_customer", f"{root}/customer", "*.csv", "csv"),
               _target("tgt_customer", ws, "customer", merge_keys="c_custkey"),
               _source("src_supplier", f"{root}/supplier", "*.json", "jsonl"),
               _target("tgt_supplier", ws, "supplier")],
              [_operation("op_orders", "src_orders", "tgt_orders"),
               _operation("op_a_replica", "src_orders_stream", "tgt_replica",
                          schema_evolution_mode="none"),
               _operation("op_customer", "src_customer", "tgt_customer", load_type="merge"),
               _operation("op_supplier", "src_supplier", "tgt_supplier", load_type="overwrite")])
    _t(spark, sf_dir, "orders").repartition(4).write.parquet(f"{root}/orders")
    _t(spark, sf_dir, "customer").repartition(2).write.option("header", "true").csv(f"{root}/customer")
    _t(spark, sf_dir, "supplier").repartition(2).write.json(f"{root}/supplier")
    results = Runner(ws).run_all()
    return reports.run_summary(spark, results).select("operation_id", "status", "rows_written",
                                                      "all_success")


def publish_snapshot_query(spark, sf_dir):
    """Publish a snapshot and read its count back."""
    ws, _ = _new(spark)
    name = ws.table(ws.catalog, "bronze", "orders_snapshot")
    ws.ensure_database(ws.catalog, "bronze")
    sinks.publish_snapshot(spark, name, _t(spark, sf_dir, "orders"),
                           ws.table_location(ws.catalog, "bronze", "orders_snapshot"))
    return spark.table(name).agg(F.count(F.lit(1)).alias("n"))


def table_detail_query(spark, sf_dir):
    """Physical detail of a landed table: one task writes one file for each status."""
    ws, reg = _new(spark)
    raw = _single_feed(spark, ws, reg, "orders", "parquet", "*.parquet",
                       target_kw={"partition_cols": "o_orderstatus"})
    _t(spark, sf_dir, "orders").coalesce(1).write.parquet(raw)
    _run(ws, "op_orders")
    return reports.table_detail(spark, ws.table(ws.catalog, "bronze", "orders")).select(
        "format", F.array_join("partition_columns", ",").alias("partition_columns"), "num_files",
        (F.col("size_in_bytes") > 0).alias("has_bytes"))


# -- audit rows derived from events -----------------------------------------------------------

AUDIT_EXPR_COMMON = [
    "'op_u' || CAST(user_id AS STRING) AS operation_id",
    "ts AS run_ts",
    "CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS status",
    "CAST(ROUND(value * 1000) AS BIGINT) AS duration_ms",
]


def audit_from_events(events: DataFrame) -> DataFrame:
    rows = "CAST(get_json_object(props, '$.k') AS BIGINT)"
    return events.selectExpr(
        *AUDIT_EXPR_COMMON, f"{rows} AS rows_written",
        "CASE WHEN event_type = 'error' THEN 'error event ' || CAST(event_id AS STRING) END "
        "AS error_message",
        f"CASE WHEN event_type = 'view' THEN {rows} ELSE 0 END AS rescued_rows")


def operations_from_events(spark, sf_dir) -> DataFrame:
    e = _t(spark, sf_dir, "events").select("user_id").distinct()
    c = _t(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = _t(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (e.join(c, e.user_id == c.c_custkey, "left").join(n, c.c_nationkey == n.n_nationkey, "left")
            .select(F.concat(F.lit("op_u"), F.col("user_id").cast("string")).alias("operation_id"),
                    F.col("n_name").alias("country")))


def audit_latest_query(spark, sf_dir):
    return reports.audit_latest(audit_from_events(_t(spark, sf_dir, "events")))


def audit_history_query(spark, sf_dir):
    return reports.audit_history(audit_from_events(_t(spark, sf_dir, "events")),
                                 operations_from_events(spark, sf_dir), AS_OF, 30)


def audit_daily_query(spark, sf_dir):
    return reports.audit_daily(audit_from_events(_t(spark, sf_dir, "events")),
                               operations_from_events(spark, sf_dir), AS_OF, 14)


def audit_log_query(spark, sf_dir):
    return reports.audit_log(audit_from_events(_t(spark, sf_dir, "events")),
                             operations_from_events(spark, sf_dir), status="FAILED",
                             start="2024-01-10 00:00:00", end="2024-01-20 00:00:00")


# -- registries derived from nation / customer / part / region --------------------------------

NATION_OBJECTS_SRC = [
    "'src_n' || CAST(n_nationkey AS STRING) AS object_id",
    "'source' AS object_type",
    "CASE WHEN n_regionkey = 2 THEN 'delta' WHEN n_regionkey = 3 THEN '  ' "
    "WHEN n_regionkey = 4 THEN NULL ELSE 'cloudFiles' END AS source_format",
    "CASE WHEN n_regionkey = 1 THEN 'acct' || CAST(n_nationkey AS STRING) END AS storage_account",
    "CASE WHEN n_regionkey = 1 THEN 'raw' END AS container",
    "CASE WHEN n_regionkey = 2 THEN 'cat.bronze.t_' || lower(n_name) "
    "ELSE '/landing/' || lower(n_name) || '/' END AS file_path",
    "CASE WHEN n_regionkey = 0 THEN '*.csv' WHEN n_regionkey = 1 THEN 'year=*/month=*/*.parquet' "
    "WHEN n_regionkey = 3 THEN ' ' END AS wildcard_pattern",
    "CASE WHEN n_regionkey = 0 THEN 'csv' WHEN n_regionkey = 1 THEN 'parquet' "
    "WHEN n_regionkey = 3 THEN 'json' WHEN n_regionkey = 4 THEN 'jsonl' END AS file_format",
    "CASE WHEN n_regionkey = 0 THEN '|' WHEN n_regionkey = 3 THEN '' END AS delimiter",
    "CASE WHEN n_regionkey = 0 THEN 'ISO-8859-1' WHEN n_regionkey = 3 THEN '' END AS encoding",
    "CASE WHEN n_regionkey = 0 THEN 'NULL' END AS null_value",
]
NATION_OBJECTS_TGT = [
    "'tgt_n' || CAST(n_nationkey AS STRING) AS object_id",
    "'target' AS object_type",
    "'cat' AS target_catalog",
    "'bronze' AS target_schema",
    "'t_' || lower(n_name) AS target_table",
    "CASE WHEN n_regionkey = 4 THEN '  ' END AS table_path",
    "CASE WHEN n_regionkey = 1 THEN 'load_date, region ,' END AS partition_cols",
    "CASE WHEN n_regionkey = 3 THEN ' id ,, key2' END AS merge_keys",
]
CUSTOMER_OPERATIONS = [
    "'op_c' || CAST(c_custkey AS STRING) AS operation_id",
    "c_acctbal > 0 AS enabled",
    "'src_n' || CAST(c_nationkey AS STRING) AS source_object_id",
    "'tgt_n' || CAST(c_nationkey AS STRING) AS target_object_id",
    "CASE c_mktsegment WHEN 'BUILDING' THEN 'merge' WHEN 'FURNITURE' THEN 'overwrite' "
    "ELSE 'append' END AS load_type",
    "TRUE AS merge_schema",
    "CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'rescue' ELSE 'addNewColumns' END "
    "AS schema_evolution_mode",
    "c_mktsegment = 'HOUSEHOLD' AS cast_all_as_string",
    "FALSE AS multiline",
    "FALSE AS case_sensitive",
    "CASE WHEN c_nationkey < 10 THEN c_nationkey + 1 END AS max_files_per_trigger",
    "CASE WHEN c_mktsegment = 'MACHINERY' THEN ' events ' END AS explode_key",
]


def _conform(df: DataFrame, schema) -> DataFrame:
    cols = set(df.columns)
    return df.select([(F.col(f.name) if f.name in cols else F.lit(None)).cast(f.dataType).alias(f.name)
                      for f in schema.fields])


def nation_objects(spark, sf_dir) -> DataFrame:
    n = _t(spark, sf_dir, "nation")
    return _conform(n.selectExpr(*NATION_OBJECTS_SRC), OBJECT_SCHEMA).unionByName(
        _conform(n.selectExpr(*NATION_OBJECTS_TGT), OBJECT_SCHEMA))


def customer_operations(spark, sf_dir) -> DataFrame:
    return _conform(_t(spark, sf_dir, "customer").selectExpr(*CUSTOMER_OPERATIONS), OPERATION_SCHEMA)


def registry_resolve(spark, sf_dir):
    """Operations (from customer) ⋈ objects in two roles (from nation)."""
    r = resolve_operations(customer_operations(spark, sf_dir), nation_objects(spark, sf_dir))
    return r.select("operation_id", "enabled", "source_format", "full_path", "file_format",
                    "delimiter", "encoding", "null_value", "fq_table", "table_path",
                    F.array_join("partition_cols", ",").alias("partition_list"),
                    F.array_join("merge_keys", ",").alias("merge_list"), "load_type",
                    "explode_key", "max_files_per_trigger")


def registry_bundles(spark, sf_dir):
    """Bundle view, flattened back for comparison."""
    from feedline.plans.registry import bundle_view
    b = bundle_view(customer_operations(spark, sf_dir), nation_objects(spark, sf_dir))
    return b.select("operation_id", F.col("source.object_id").alias("source_id"),
                    F.col("source.file_format").alias("file_format"),
                    F.col("target.target_table").alias("target_table"),
                    F.col("operation.load_type").alias("load_type"))


def registry_counts(spark, sf_dir):
    """A5: enabled / total operations."""
    return reports.operation_counts(customer_operations(spark, sf_dir)).select(
        F.col("total").cast("bigint").alias("total"), F.col("enabled").cast("bigint").alias("enabled"))


PART_OPERATIONS = [
    "CASE WHEN p_size = 1 THEN '9op_' ELSE 'op_p' END || CAST(p_partkey AS STRING) AS operation_id",
    "p_size > 10 AS enabled",
    "'src_p' || CAST(p_partkey AS STRING) AS source_object_id",
    "CASE WHEN p_size = 50 THEN 'tgt_missing' ELSE 'tgt_p' END || CAST(p_partkey AS STRING) "
    "AS target_object_id",
    "CASE WHEN p_type LIKE '%BRASS' THEN 'merge' WHEN p_type LIKE '%TIN' THEN 'upsert' "
    "WHEN p_type LIKE '%COPPER' THEN 'overwrite' ELSE 'append' END AS load_type",
    "TRUE AS merge_schema",
    "CASE WHEN p_type LIKE 'PROMO%' THEN 'rescue' WHEN p_type LIKE 'SMALL%' THEN 'none' "
    "WHEN p_type LIKE 'LARGE%' THEN 'evolve' ELSE 'addNewColumns' END AS schema_evolution_mode",
    "p_type LIKE '%PLATED%' AS cast_all_as_string",
    "FALSE AS multiline",
    "FALSE AS case_sensitive",
    "CASE WHEN p_size = 2 THEN 0 WHEN p_size < 20 THEN p_size END AS max_files_per_trigger",
    "CASE WHEN p_brand IN ('Brand#11', 'Brand#12') THEN 'events' END AS explode_key",
]
PART_SOURCES = [
    "'src_p' || CAST(p_partkey AS STRING) AS object_id",
    "'source' AS object_type",
    "CASE WHEN p_size = 3 THEN 'delta' END AS source_format",
    "CASE WHEN p_size BETWEEN 4 AND 6 THEN 'acct' END AS storage_account",
    "CASE WHEN p_size = 4 THEN NULL ELSE 'raw' END AS container",
    "CASE WHEN p_size = 7 THEN '' ELSE '/raw/' || CAST(p_partkey AS STRING) END AS file_path",
    "CASE WHEN p_size BETWEEN 8 AND 12 THEN 'xml' WHEN p_size BETWEEN 13 AND 20 THEN 'json' "
    "WHEN p_size BETWEEN 21 AND 25 THEN 'txt' WHEN p_size > 40 THEN 'jsonl' ELSE 'csv' END "
    "AS file_format",
    "CASE WHEN p_size IN (8, 9) THEN NULL ELSE 'Row' END AS row_tag",
    "CASE WHEN p_brand = 'Brand#21' THEN '{\"type\":\"struct\",\"fields\":[]}' "
    "WHEN p_brand = 'Brand#22' THEN '{\"type\":' END AS object_schema",
]
PART_TARGETS = [
    "'tgt_p' || CAST(p_partkey AS STRING) AS object_id",
    "'target' AS object_type",
    "CASE WHEN p_size = 5 THEN '1cat' WHEN p_size = 6 THEN '' ELSE 'cat' END AS target_catalog",
    "'bronze' AS target_schema",
    "CASE WHEN p_size = 14 THEN NULL ELSE 'p' || CAST(p_partkey AS STRING) END AS target_table",
    "CASE WHEN p_brand LIKE 'Brand#3%' THEN NULL ELSE 'id' END AS merge_keys",
]


def registry_violations(spark, sf_dir):
    """Every rule over a registry derived from part (duplicates for size 49)."""
    p = _t(spark, sf_dir, "part")
    ops = _conform(p.selectExpr(*PART_OPERATIONS), OPERATION_SCHEMA)
    ops = ops.unionByName(_conform(p.where("p_size = 49").selectExpr(*PART_OPERATIONS),
                                   OPERATION_SCHEMA))
    objs = _conform(p.selectExpr(*PART_SOURCES), OBJECT_SCHEMA).unionByName(
        _conform(p.selectExpr(*PART_TARGETS), OBJECT_SCHEMA))
    return rules.validate_registry(ops, objs)


DAG_SRC_R = ["'src_r' || CAST(r_regionkey AS STRING) AS object_id", "'source' AS object_type",
             "CASE WHEN r_regionkey = 0 THEN 'cloudFiles' ELSE 'delta' END AS source_format",
             "CASE WHEN r_regionkey = 0 THEN '/raw/regions/' ELSE 'cat.bronze.t_r' || "
             "CAST(r_regionkey - 1 AS STRING) END AS file_path",
             "'parquet' AS file_format"]
DAG_TGT_R = ["'tgt_r' || CAST(r_regionkey AS STRING) AS object_id", "'target' AS object_type",
             "'cat' AS target_catalog", "'bronze' AS target_schema",
             "'t_r' || CAST(r_regionkey AS STRING) AS target_table"]
DAG_SRC_N = ["'src_n' || CAST(n_nationkey AS STRING) AS object_id", "'source' AS object_type",
             "'delta' AS source_format",
             "CASE WHEN n_nationkey = 23 THEN 'cat.bronze.t_n23' ELSE 'cat.bronze.t_r' || "
             "CAST(n_regionkey AS STRING) END AS file_path"]
DAG_TGT_N = ["'tgt_n' || CAST(n_nationkey AS STRING) AS object_id", "'target' AS object_type",
             "'cat' AS target_catalog", "'bronze' AS target_schema",
             "'t_n' || CAST(n_nationkey AS STRING) AS target_table"]
DAG_OPS_R = ["'op_r' || CAST(r_regionkey AS STRING) AS operation_id", "TRUE AS enabled",
             "'src_r' || CAST(r_regionkey AS STRING) AS source_object_id",
             "'tgt_r' || CAST(r_regionkey AS STRING) AS target_object_id",
             "'append' AS load_type"]
DAG_OPS_N = ["'op_n' || CAST(n_nationkey AS STRING) AS operation_id", "n_nationkey <> 24 AS enabled",
             "'src_n' || CAST(n_nationkey AS STRING) AS source_object_id",
             "'tgt_n' || CAST(n_nationkey AS STRING) AS target_object_id",
             "'append' AS load_type"]


def _dag_registry(spark, sf_dir):
    """Regions feed a chain of table-sourced operations; every nation reads its region's
    table (nation 23 reads its own target: a self-loop, ignored; nation 24 is disabled)."""
    r = _t(spark, sf_dir, "region")
    n = _t(spark, sf_dir, "nation")
    objects = (_conform(r.selectExpr(*DAG_SRC_R), OBJECT_SCHEMA)
               .unionByName(_conform(r.selectExpr(*DAG_TGT_R), OBJECT_SCHEMA))
               .unionByName(_conform(n.selectExpr(*DAG_SRC_N), OBJECT_SCHEMA))
               .unionByName(_conform(n.selectExpr(*DAG_TGT_N), OBJECT_SCHEMA)))
    ops = _conform(r.selectExpr(*DAG_OPS_R), OPERATION_SCHEMA).unionByName(
        _conform(n.selectExpr(*DAG_OPS_N), OPERATION_SCHEMA))
    return resolve_operations(ops, objects)


def dependency_edges_query(spark, sf_dir):
    """consumer/producer edges of table-sourced operations."""
    return deps.dependency_edges(_dag_registry(spark, sf_dir))


def dependency_levels_query(spark, sf_dir):
    """Producers before consumers, as levels."""
    resolved = _dag_registry(spark, sf_dir)
    nodes = resolved.where("enabled").select("operation_id")
    return deps.dependency_levels(nodes, deps.dependency_edges(resolved))


def _existing_tables(spark, sf_dir) -> DataFrame:
    return _t(spark, sf_dir, "nation").where("n_regionkey <= 1").selectExpr(
        "'t_' || lower(n_name) AS table_name")


def _customer_audit(spark, sf_dir) -> DataFrame:
    return audit_from_events(_t(spark, sf_dir, "events")).withColumn(
        "operation_id", F.regexp_replace("operation_id", "^op_u", "op_c"))


def operation_status_query(spark, sf_dir):
    """Operation ⟕ existing landing table ⟕ latest audit row."""
    resolved = resolve_operations(customer_operations(spark, sf_dir), nation_objects(spark, sf_dir))
    return reports.operation_status(resolved, _existing_tables(spark, sf_dir),
                                    _customer_audit(spark, sf_dir))


def lineage_edges_query(spark, sf_dir):
    """C4: lineage edges with labels and the ingested flag."""
    resolved = resolve_operations(customer_operations(spark, sf_dir), nation_objects(spark, sf_dir))
    return reports.lineage_edges(resolved, _existing_tables(spark, sf_dir))


def lineage_downstream_query(spark, sf_dir):
    """Declared downstream tiers; no mapping -> 'no downstream'."""
    resolved = resolve_operations(customer_operations(spark, sf_dir), nation_objects(spark, sf_dir))
    mapping = _t(spark, sf_dir, "nation").where("n_regionkey = 2").selectExpr(
        "'t_' || lower(n_name) AS table_name", "'silver_' || lower(n_name) AS consumer",
        "'silver' AS tier")
    return reports.downstream_tiers(resolved, mapping)


QUERIES = {
    "ingest_parquet_append": ingest_parquet_append,
    "ingest_hive_glob": ingest_hive_glob,
    "ingest_csv_explicit_schema": ingest_csv_explicit_schema,
    "ingest_csv_as_string": ingest_csv_as_string,
    "ingest_jsonl_explode": ingest_jsonl_explode,
    "ingest_json_multiline": ingest_json_multiline,
    "ingest_xml": ingest_xml,
    "ingest_add_columns": ingest_add_columns,
    "ingest_rescue": ingest_rescue,
    "ingest_fail_on_new_columns": ingest_fail_on_new_columns,
    "ingest_reset_reload": ingest_reset_reload,
    "ingest_type_rescue": ingest_type_rescue,
    "ingest_merge": ingest_merge,
    "ingest_merge_partitioned": ingest_merge_partitioned,
    "ingest_overwrite": ingest_overwrite,
    "ingest_restart_no_duplicates": ingest_restart_no_duplicates,
    "ingest_table_stream": ingest_table_stream,
    "ingest_throttled": ingest_throttled,
    "run_all_summary": run_all_summary,
    "publish_snapshot": publish_snapshot_query,
    "table_detail": table_detail_query,
    "audit_latest": audit_latest_query,
    "audit_history_30d": audit_history_query,
    "audit_daily_14d": audit_daily_query,
    "audit_log_filtered": audit_log_query,
    "registry_resolve": registry_resolve,
    "registry_bundles": registry_bundles,
    "registry_counts": registry_counts,
    "registry_violations": registry_violations,
    "dependency_edges": dependency_edges_query,
    "dependency_levels": dependency_levels_query,
    "operation_status": operation_status_query,
    "lineage_edges": lineage_edges_query,
    "lineage_downstream": lineage_downstream_query,
}


# -- catalog views, registry writes, counts -----------------------------------------------------

def schema_browser_query(spark, sf_dir):
    """J5 + C1 + C2: operations ⟕ the columns of their landing tables (orders landed,
    customer registered but not yet run), with the table's type and format."""
    ws, reg = _new(spark)
    raw = f"{ws.root}/raw"
    _register(spark, reg,
              [_source("src_orders", f"{raw}/orders", "*.parquet", "parquet"),
               _target("tgt_orders", ws, "orders"),
               _source("src_customer", f"{raw}/customer", "*.csv", "csv"),
               _target("tgt_customer", ws, "customer")],
              [_operation("op_orders", "src_orders", "tgt_orders"),
               _operation("op_customer", "src_customer", "tgt_customer")])
    _t(spark, sf_dir, "orders").repartition(4).write.parquet(f"{raw}/orders")
    _run(ws, "op_orders")
    db = ws.database(ws.catalog, "bronze")
    columns = reports.landing_columns(spark, db)
    tables = reports.landing_tables(spark, db).select(
        F.col("table_name").alias("target_table"), "table_type", "data_source_format")
    return (reports.schema_browser(reg.resolve_operations(), columns)
            .join(tables, "target_table", "left")
            .select("operation_id", "target_table", "column_name", "full_data_type",
                    "ordinal_position", "is_audit_column", "table_type", "data_source_format"))


def registry_writes_query(spark, sf_dir):
    """R3 seed-if-empty, R1 keyed upsert, R2 enable flip, K12 ensure_column, J6 checks,
    each through K10 (snapshot + read-back count)."""
    ws, reg = _new(spark)
    objs, ops = nation_objects(spark, sf_dir), customer_operations(spark, sf_dir)
    assert reg.seed_if_empty(objs, ops)
    assert not reg.seed_if_empty(objs, ops.where(F.lit(False)))
    c = _t(spark, sf_dir, "customer")
    updates = _conform(c.where("c_mktsegment = 'BUILDING'").selectExpr(*CUSTOMER_OPERATIONS),
                       OPERATION_SCHEMA).withColumn("load_type", F.lit("overwrite"))
    new_ops = _conform(_t(spark, sf_dir, "supplier").selectExpr(*SUPPLIER_OPERATIONS),
                       OPERATION_SCHEMA)
    upsert = updates.unionByName(new_ops)
    missing = rules.unknown_ids(upsert, reg.operations(), "operation_id").count()
    existing = rules.existing_ids(upsert, reg.operations(), "operation_id").count()
    reg.upsert_bundles(objs.where(F.lit(False)), upsert)
    reg.set_enabled("op_c1", False)
    reg.ensure_column("operation", "country", "string")       # present: no-op
    reg.ensure_column("operation", "owner", "string")         # added
    return reg.operations().select(
        "operation_id", "enabled", "load_type", "source_object_id", "owner",
        F.lit(missing).cast("bigint").alias("new_ids"),
        F.lit(existing).cast("bigint").alias("updated_ids"))


SUPPLIER_OPERATIONS = [
    "'op_s' || CAST(s_suppkey AS STRING) AS operation_id",
    "TRUE AS enabled",
    "'src_n' || CAST(s_nationkey AS STRING) AS source_object_id",
    "'tgt_n' || CAST(s_nationkey AS STRING) AS target_object_id",
    "'append' AS load_type",
    "TRUE AS merge_schema",
    "'addNewColumns' AS schema_evolution_mode",
    "FALSE AS cast_all_as_string",
    "FALSE AS multiline",
    "FALSE AS case_sensitive",
]


def landing_counts_query(spark, sf_dir):
    """A3: row count per landing table; NULL for a registered table that does not exist."""
    ws, reg = _new(spark)
    raw = _single_feed(spark, ws, reg, "orders", "parquet", "*.parquet")
    _t(spark, sf_dir, "orders").repartition(4).write.parquet(raw)
    _run(ws, "op_orders")
    return reports.table_counts(spark, {
        "orders": ws.table(ws.catalog, "bronze", "orders"),
        "customer": ws.table(ws.catalog, "bronze", "customer")})


QUERIES.update({
    "schema_browser": schema_browser_query,
    "registry_writes": registry_writes_query,
    "landing_counts": landing_counts_query,
})

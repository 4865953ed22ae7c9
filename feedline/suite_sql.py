"""Oracle SQL (DuckDB) for the driver queries in ``feedline.suite``.

Each string runs on the original tables (views ``region nation customer
supplier part orders lineitem events ...``) and returns the same columns as
the Spark query.  Registry and audit derivations reuse the exact SQL
expressions the Spark side uses.
"""

from __future__ import annotations

from feedline import suite as s


def _sel(exprs: list[str]) -> str:
    return ",\n  ".join(exprs)


BLANK = "NULLIF(TRIM({0}), '')"


def _list(col: str) -> str:
    return ("array_to_string(list_filter(list_transform(string_split(COALESCE({0}, ''), ','), "
            "lambda x: trim(x)), lambda x: x <> ''), ',')").format(col)


ORDERS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"

AUDIT_CTE = f"""a AS (
  SELECT {_sel(s.AUDIT_EXPR_COMMON)},
  CAST(json_extract_string(props, '$.k') AS BIGINT) AS rows_written,
  CASE WHEN event_type = 'view' THEN CAST(json_extract_string(props, '$.k') AS BIGINT) ELSE 0 END
    AS rescued_rows
  FROM events)"""

OPS_CTE = """o AS (
  SELECT DISTINCT 'op_u' || CAST(e.user_id AS VARCHAR) AS operation_id, n.n_name AS country
  FROM (SELECT DISTINCT user_id FROM events) e
  LEFT JOIN customer c ON e.user_id = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey)"""


def _windowed(days: int) -> str:
    return f"""WITH {AUDIT_CTE},
{OPS_CTE},
w AS (
  SELECT a.*, o.country FROM a LEFT JOIN o USING (operation_id)
  WHERE run_ts >= TIMESTAMP '{s.AS_OF}' - INTERVAL {days} DAY AND run_ts <= TIMESTAMP '{s.AS_OF}')"""


NATION_REGISTRY = f"""src AS (SELECT {_sel(s.NATION_OBJECTS_SRC)} FROM nation),
tgt AS (SELECT {_sel(s.NATION_OBJECTS_TGT)} FROM nation),
ops AS (SELECT {_sel(s.CUSTOMER_OPERATIONS)} FROM customer),
r AS (
  SELECT ops.*, src.object_id AS source_id, src.file_format AS raw_file_format,
         TRIM(src.file_format) AS file_format, tgt.target_table
  FROM ops JOIN src ON ops.source_object_id = src.object_id
           JOIN tgt ON ops.target_object_id = tgt.object_id)"""

EXISTING = """ex AS (SELECT DISTINCT 't_' || lower(n_name) AS table_name FROM nation
             WHERE n_regionkey <= 1)"""

DAG_REGISTRY = f"""objs AS (
  SELECT object_id, source_format, file_path, NULL AS target_catalog, NULL AS target_schema,
         NULL AS target_table FROM (SELECT {_sel(s.DAG_SRC_R)} FROM region)
  UNION ALL SELECT object_id, NULL, NULL, target_catalog, target_schema, target_table
         FROM (SELECT {_sel(s.DAG_TGT_R)} FROM region)
  UNION ALL SELECT object_id, source_format, file_path, NULL, NULL, NULL
         FROM (SELECT {_sel(s.DAG_SRC_N)} FROM nation)
  UNION ALL SELECT object_id, NULL, NULL, target_catalog, target_schema, target_table
         FROM (SELECT {_sel(s.DAG_TGT_N)} FROM nation)),
ops AS (SELECT {_sel(s.DAG_OPS_R)} FROM region
        UNION ALL SELECT {_sel(s.DAG_OPS_N)} FROM nation),
res AS (
  SELECT ops.operation_id, ops.enabled,
         COALESCE(NULLIF(TRIM(src.source_format), ''), 'cloudFiles') AS source_format,
         src.file_path AS source_file_path,
         concat_ws('.', tgt.target_catalog, tgt.target_schema, tgt.target_table) AS fq_table
  FROM ops JOIN objs src ON ops.source_object_id = src.object_id
           JOIN objs tgt ON ops.target_object_id = tgt.object_id),
edges AS (
  SELECT c.operation_id AS consumer, p.operation_id AS producer, c.source_file_path AS table_name
  FROM res c JOIN res p ON c.source_file_path = p.fq_table
  WHERE c.enabled AND p.enabled AND c.source_format IN ('delta', 'table')
    AND c.operation_id <> p.operation_id)"""


def _violations() -> str:
    b = BLANK.format
    rules = [
        ("src_object_id IS NOT NULL AND NOT COALESCE(regexp_matches(src_object_id, "
         "'^[a-zA-Z][a-zA-Z0-9_]*$'), FALSE)", "source.object_id",
         "'the source''s id does not fit the id pattern'"),
        ("tgt_object_id IS NOT NULL AND NOT COALESCE(regexp_matches(tgt_object_id, "
         "'^[a-zA-Z][a-zA-Z0-9_]*$'), FALSE)", "target.object_id",
         "'the target''s id does not fit the id pattern'"),
        ("NOT COALESCE(regexp_matches(operation_id, '^[a-zA-Z][a-zA-Z0-9_]*$'), FALSE)",
         "operation.operation_id",
         "'the operation''s id does not fit the id pattern'"),
        ("src_object_id IS NOT NULL AND (src_file_path IS NULL OR length(src_file_path) = 0)",
         "source.file_path", "'the source names no file_path'"),
        ("tgt_object_id IS NOT NULL AND (tgt_target_catalog IS NULL OR length(tgt_target_catalog) = 0)",
         "target.target_catalog", "'the target names no catalog'"),
        ("tgt_object_id IS NOT NULL AND (tgt_target_schema IS NULL OR length(tgt_target_schema) = 0)",
         "target.target_schema", "'the target names no schema'"),
        ("tgt_object_id IS NOT NULL AND (tgt_target_table IS NULL OR length(tgt_target_table) = 0)",
         "target.target_table", "'the target names no table'"),
        (f"src_object_id IS NOT NULL AND COALESCE({b('src_source_format')}, 'cloudFiles') "
         "NOT IN ('delta', 'table') AND NOT COALESCE(src_file_format IN "
         "('csv', 'json', 'jsonl', 'parquet', 'avro', 'xml'), FALSE)",
         "source.file_format", "'unknown file_format; known: csv, json, jsonl, parquet, avro, xml'"),
        ("NOT COALESCE(load_type IN ('append', 'merge', 'overwrite'), FALSE)",
         "operation.load_type", "'unknown load_type; known: append, merge, overwrite'"),
        ("NOT COALESCE(schema_evolution_mode IN ('addNewColumns', 'rescue', 'failOnNewColumns', "
         "'none'), FALSE)", "operation.schema_evolution_mode",
         "'unknown schema_evolution_mode; known: addNewColumns, rescue, failOnNewColumns, none'"),
        ("max_files_per_trigger IS NOT NULL AND max_files_per_trigger <= 0",
         "operation.max_files_per_trigger", "'a batch takes one file or more'"),
        (f"src_object_id IS NOT NULL AND src_file_format = 'xml' AND {b('src_row_tag')} IS NULL",
         "source.row_tag", "'XML is read by row_tag, which is blank'"),
        (f"load_type = 'merge' AND {b('tgt_merge_keys')} IS NULL", "target.merge_keys",
         "'a merge has no merge_keys to match on'"),
        (f"{b('src_object_schema')} IS NOT NULL AND NOT COALESCE(schema_evolution_mode = 'none', FALSE)",
         "operation.schema_evolution_mode",
         "'an explicit schema goes with mode none alone'"),
        (f"{b('explode_key')} IS NOT NULL AND NOT COALESCE(src_file_format IN ('json', 'jsonl'), FALSE)",
         "operation.explode_key", "'explode_key applies to JSON records alone'"),
        (f"{b('src_storage_account')} IS NOT NULL AND {b('src_container')} IS NULL",
         "source.container", "'storage_account without a container'"),
        (f"{b('src_object_schema')} IS NOT NULL AND NOT json_valid({b('src_object_schema')})",
         "source.object_schema", "'object_schema does not parse'"),
        ("src_object_id IS NULL", "operation.source_object_id",
         "'no source object ' || source_object_id"),
        ("tgt_object_id IS NULL", "operation.target_object_id",
         "'no target object ' || target_object_id"),
        ("tgt_object_id IS NOT NULL AND NOT (tgt_target_catalog IS NULL OR length(tgt_target_catalog) = 0) "
         "AND NOT COALESCE(regexp_matches(tgt_target_catalog, '^[A-Za-z_][A-Za-z0-9_]*$'), FALSE)",
         "target.target_catalog",
         "'not an identifier: ' || tgt_target_catalog"),
        (f"{b('explode_key')} IS NOT NULL AND COALESCE(cast_all_as_string, FALSE)",
         "operation.explode_key", "'explode_key cannot be combined with cast_all_as_string'"),
    ]
    selects = "\nUNION ALL ".join(
        f"SELECT operation_id, '{path}' AS path, {msg} AS message FROM f WHERE {cond}"
        for cond, path, msg in rules)
    return f"""WITH ops AS (
  SELECT {_sel(s.PART_OPERATIONS)} FROM part
  UNION ALL SELECT {_sel(s.PART_OPERATIONS)} FROM part WHERE p_size = 49),
src AS (SELECT {_sel(s.PART_SOURCES)} FROM part),
tgt AS (SELECT {_sel(s.PART_TARGETS)} FROM part),
f AS (
  SELECT ops.*, src.object_id AS src_object_id, src.source_format AS src_source_format,
         src.storage_account AS src_storage_account, src.container AS src_container,
         src.file_path AS src_file_path, src.file_format AS src_file_format,
         src.row_tag AS src_row_tag, src.object_schema AS src_object_schema,
         tgt.object_id AS tgt_object_id, tgt.target_catalog AS tgt_target_catalog,
         tgt.target_schema AS tgt_target_schema, tgt.target_table AS tgt_target_table,
         tgt.merge_keys AS tgt_merge_keys
  FROM ops LEFT JOIN src ON ops.source_object_id = src.object_id
           LEFT JOIN tgt ON ops.target_object_id = tgt.object_id)
{selects}
UNION ALL
SELECT operation_id, 'operation.operation_id' AS path,
       'operation_id ''' || operation_id || ''' appears ' || CAST(COUNT(*) AS VARCHAR) || ' times'
       AS message
FROM ops GROUP BY operation_id HAVING COUNT(*) > 1"""


def _resolve() -> str:
    b = BLANK.format
    glob = f"COALESCE({b('src.wildcard_pattern')}, '')"
    return f"""WITH {NATION_REGISTRY.split(',' + chr(10) + 'r AS')[0]}
SELECT ops.operation_id, ops.enabled,
  COALESCE({b('src.source_format')}, 'cloudFiles') AS source_format,
  CASE WHEN {b('src.storage_account')} IS NOT NULL
       THEN 'abfss://' || COALESCE(src.container, '') || '@' || {b('src.storage_account')}
            || '.dfs.core.windows.net' || COALESCE(src.file_path, '') || {glob}
       ELSE COALESCE(src.file_path, '') || {glob} END AS full_path,
  TRIM(src.file_format) AS file_format,
  COALESCE(NULLIF(src.delimiter, ''), ',') AS delimiter,
  COALESCE(NULLIF(src.encoding, ''), 'UTF-8') AS encoding,
  COALESCE(src.null_value, '') AS null_value,
  concat_ws('.', tgt.target_catalog, tgt.target_schema, tgt.target_table) AS fq_table,
  {b('tgt.table_path')} AS table_path,
  {_list('tgt.partition_cols')} AS partition_list,
  {_list('tgt.merge_keys')} AS merge_list,
  ops.load_type, {b('ops.explode_key')} AS explode_key, ops.max_files_per_trigger
FROM ops JOIN src ON ops.source_object_id = src.object_id
         JOIN tgt ON ops.target_object_id = tgt.object_id"""


ORACLE_SQL = {
    "ingest_parquet_append": f"""SELECT {ORDERS}, 'op_orders' AS _operation_id,
  CAST(NULL AS VARCHAR) AS _rescued_data FROM orders""",

    "ingest_hive_glob": f"""SELECT {ORDERS}, year(o_orderdate) AS year, month(o_orderdate) AS month
FROM orders""",

    "ingest_csv_explicit_schema": """SELECT s_suppkey, s_name,
  CASE WHEN s_acctbal > 9000 THEN NULL ELSE s_nationkey END AS s_nationkey,
  CASE WHEN s_acctbal < 0 THEN NULL ELSE s_acctbal END AS s_acctbal,
  CASE WHEN s_acctbal > 9000 THEN '{"s_nationkey":"n' || CAST(s_nationkey AS VARCHAR) || '"}' END
    AS _rescued_data
FROM supplier""",

    "ingest_csv_as_string": """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name,
  CAST(c_nationkey AS VARCHAR) AS c_nationkey, c_mktsegment FROM customer""",

    "ingest_jsonl_explode": """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
  l_partkey, l_quantity, l_returnflag
FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders)""",

    "ingest_json_multiline": """SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey, n_name,
  CAST(n_regionkey AS BIGINT) AS n_regionkey FROM nation""",

    "ingest_xml": """SELECT p_partkey AS _id, p_name, p_brand, CAST(p_size AS BIGINT) AS p_size,
  p_retailprice FROM part""",

    "ingest_add_columns": """SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey,
  CASE WHEN c_nationkey >= 12 THEN c_mktsegment END AS c_mktsegment FROM customer""",

    "ingest_rescue": """SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey,
  CASE WHEN c_nationkey >= 12 THEN '{"c_mktsegment":"' || c_mktsegment || '"}' END AS _rescued_data
FROM customer""",

    "ingest_type_rescue": """SELECT event_id, user_id, event_type,
  CASE WHEN ts >= TIMESTAMP '2024-01-16 00:00:00' AND event_type = 'error' THEN NULL ELSE value END
    AS value,
  CASE WHEN ts >= TIMESTAMP '2024-01-16 00:00:00' AND event_type = 'error' THEN '{"value":"n/a"}' END
    AS _rescued_data
FROM events""",

    "ingest_merge": """SELECT c_custkey,
  CASE WHEN c_mktsegment = 'BUILDING' THEN c_name || '-v2' ELSE c_name END AS c_name,
  CAST(c_nationkey AS BIGINT) AS c_nationkey, c_mktsegment
FROM customer
UNION ALL
SELECT c_custkey + 1000000 AS c_custkey, c_name || '-new' AS c_name,
  CAST(c_nationkey AS BIGINT) AS c_nationkey, c_mktsegment
FROM customer WHERE c_mktsegment = 'MACHINERY'""",

    "ingest_merge_partitioned": """SELECT c_custkey,
  CASE WHEN c_mktsegment = 'BUILDING' AND c_nationkey < 10 THEN c_name || '-v2' ELSE c_name END
    AS c_name,
  CAST(c_nationkey AS BIGINT) AS c_nationkey, c_mktsegment
FROM customer
UNION ALL
SELECT c_custkey + 1000000 AS c_custkey, c_name || '-new' AS c_name,
  CAST(c_nationkey AS BIGINT) AS c_nationkey, c_mktsegment
FROM customer WHERE c_mktsegment = 'MACHINERY' AND c_nationkey < 10""",

    "ingest_overwrite": """SELECT p_partkey, p_name, p_brand, CAST(p_size AS BIGINT) AS p_size
FROM part WHERE p_size <= 25""",

    "ingest_fail_on_new_columns": """WITH w1 AS (SELECT COUNT(*) AS n FROM customer WHERE c_nationkey < 12)
SELECT r.run, r.status, r.rows_written, w1.n AS landed_rows
FROM (SELECT 1 AS run, 'SUCCESS' AS status, (SELECT n FROM w1) AS rows_written
      UNION ALL SELECT 2, 'FAILED', CAST(0 AS BIGINT)
      UNION ALL SELECT 3, 'FAILED', CAST(0 AS BIGINT)) r, w1""",

    "ingest_reset_reload": """SELECT o_orderstatus, COUNT(*) AS n,
  (SELECT COUNT(*) FROM orders) AS reloaded_rows FROM orders GROUP BY o_orderstatus""",

    "ingest_restart_no_duplicates": """SELECT o_orderstatus, COUNT(*) AS n,
  CAST(0 AS BIGINT) AS second_run_rows FROM orders GROUP BY o_orderstatus""",

    "table_detail": """SELECT 'parquet' AS format, '_batch_id,o_orderstatus' AS partition_columns,
  COUNT(DISTINCT o_orderstatus) AS num_files, TRUE AS has_bytes FROM orders""",
    "ingest_table_stream": f"""SELECT {ORDERS}, 'op_orders_replica' AS _operation_id FROM orders""",

    "ingest_throttled": """SELECT l_returnflag, l_linestatus, COUNT(*) AS n, SUM(l_quantity) AS sum_qty,
  CAST(3 AS BIGINT) AS batches FROM lineitem GROUP BY l_returnflag, l_linestatus""",

    "run_all_summary": """SELECT 'op_customer' AS operation_id, 'SUCCESS' AS status,
  (SELECT COUNT(*) FROM customer) AS rows_written, TRUE AS all_success
UNION ALL SELECT 'op_orders', 'SUCCESS', (SELECT COUNT(*) FROM orders), TRUE
UNION ALL SELECT 'op_a_replica', 'SUCCESS', (SELECT COUNT(*) FROM orders), TRUE
UNION ALL SELECT 'op_supplier', 'SUCCESS', (SELECT COUNT(*) FROM supplier), TRUE""",

    "publish_snapshot": "SELECT COUNT(*) AS n FROM orders",

    "audit_latest": f"""WITH {AUDIT_CTE}
SELECT operation_id, run_ts, status, rows_written, duration_ms FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY operation_id
                               ORDER BY run_ts DESC, duration_ms DESC, status DESC) AS rn
  FROM a) WHERE rn = 1""",

    "audit_history_30d": _windowed(30) + """,
ps AS (SELECT operation_id, country, status, COUNT(*) AS runs, AVG(duration_ms) AS avg_d,
              SUM(rows_written) AS rw FROM w GROUP BY operation_id, country, status),
po AS (SELECT operation_id,
              CAST(COUNT(*) FILTER (WHERE status = 'SUCCESS') AS DOUBLE) / COUNT(*) AS sr
       FROM w GROUP BY operation_id)
SELECT ps.operation_id, ps.country, ps.status, ps.runs, ROUND(po.sr, 6) AS success_rate,
       ROUND(ps.avg_d, 6) AS avg_duration_ms, CAST(ps.rw AS BIGINT) AS rows_written
FROM ps LEFT JOIN po USING (operation_id)""",

    "audit_daily_14d": _windowed(14) + """
SELECT CAST(run_ts AS DATE) AS run_date, country,
  COUNT(*) FILTER (WHERE status = 'SUCCESS' AND COALESCE(rescued_rows, 0) = 0) AS success,
  COUNT(*) FILTER (WHERE status = 'SUCCESS' AND COALESCE(rescued_rows, 0) > 0) AS warn,
  COUNT(*) FILTER (WHERE status = 'FAILED') AS fail
FROM w GROUP BY CAST(run_ts AS DATE), country""",

    "audit_log_filtered": f"""WITH {AUDIT_CTE},
{OPS_CTE}
SELECT a.operation_id, o.country, a.run_ts, a.status, a.duration_ms, a.rows_written,
  CAST(COALESCE(a.rescued_rows, 0) AS BIGINT) AS rescued_rows
FROM a LEFT JOIN o USING (operation_id)
WHERE a.status = 'FAILED' AND a.run_ts >= TIMESTAMP '2024-01-10 00:00:00'
  AND a.run_ts < TIMESTAMP '2024-01-20 00:00:00'""",

    "registry_resolve": _resolve(),

    "registry_bundles": f"""WITH {NATION_REGISTRY.split(',' + chr(10) + 'r AS')[0]}
SELECT ops.operation_id, src.object_id AS source_id, src.file_format, tgt.target_table,
       ops.load_type
FROM ops LEFT JOIN src ON ops.source_object_id = src.object_id
         LEFT JOIN tgt ON ops.target_object_id = tgt.object_id""",

    "registry_counts": """SELECT COUNT(*) AS total, COUNT(*) FILTER (WHERE c_acctbal > 0) AS enabled
FROM customer""",

    "registry_violations": _violations(),

    "dependency_edges": f"""WITH {DAG_REGISTRY}
SELECT consumer, producer, table_name FROM edges""",

    "dependency_levels": f"""WITH RECURSIVE {DAG_REGISTRY},
nodes AS (SELECT operation_id FROM res WHERE enabled),
lv(op, level) AS (
  SELECT operation_id, 0 FROM nodes WHERE operation_id NOT IN (SELECT consumer FROM edges)
  UNION ALL
  SELECT e.consumer, lv.level + 1 FROM lv JOIN edges e ON e.producer = lv.op)
SELECT nodes.operation_id, CAST(MAX(lv.level) AS INTEGER) AS level
FROM nodes LEFT JOIN lv ON nodes.operation_id = lv.op GROUP BY nodes.operation_id""",

    "operation_status": f"""WITH {NATION_REGISTRY},
{EXISTING},
a AS (SELECT 'op_c' || CAST(user_id AS VARCHAR) AS operation_id, ts AS run_ts,
             CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
             CAST(ROUND(value * 1000) AS BIGINT) AS duration_ms,
             CAST(json_extract_string(props, '$.k') AS BIGINT) AS rows_written FROM events),
latest AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY operation_id
             ORDER BY run_ts DESC, duration_ms DESC, status DESC) AS rn FROM a) WHERE rn = 1)
SELECT r.operation_id, r.enabled, r.target_table, r.load_type,
       (ex.table_name IS NOT NULL) AS ingested, l.run_ts AS last_run_ts,
       l.status AS last_status, l.rows_written AS last_rows_written,
       l.duration_ms AS last_duration_ms
FROM r LEFT JOIN ex ON r.target_table = ex.table_name
       LEFT JOIN latest l ON r.operation_id = l.operation_id""",

    "lineage_edges": f"""WITH {NATION_REGISTRY},
{EXISTING},
r2 AS (SELECT r.*, (ex.table_name IS NOT NULL) AS ingested
       FROM r LEFT JOIN ex ON r.target_table = ex.table_name)
SELECT 'read:' || operation_id AS edge_id, 'src:' || operation_id AS source,
       'framework' AS target, file_format AS label, COALESCE(enabled, FALSE) AS animated,
       FALSE AS ingested, operation_id
FROM r2
UNION ALL
SELECT 'write:' || operation_id, 'framework', 'tgt:' || operation_id,
       load_type || ' · ' || schema_evolution_mode
         || CASE WHEN cast_all_as_string THEN ' · cast→str' ELSE '' END,
       COALESCE(enabled, FALSE) AND ingested, ingested, operation_id
FROM r2""",

    "lineage_downstream": f"""WITH {NATION_REGISTRY},
d AS (SELECT 't_' || lower(n_name) AS table_name, 'silver_' || lower(n_name) AS consumer,
             'silver' AS tier FROM nation WHERE n_regionkey = 2)
SELECT r.operation_id, r.target_table, COALESCE(d.tier, 'none') AS tier,
       COALESCE(d.consumer, 'no downstream') AS consumer
FROM r LEFT JOIN d ON r.target_table = d.table_name""",
}


_SPARK_TYPE = """CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int'
  WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double' WHEN 'TIMESTAMP' THEN 'timestamp_ntz'
  WHEN 'BOOLEAN' THEN 'boolean' WHEN 'DATE' THEN 'date' ELSE lower(data_type) END"""

ORACLE_SQL.update({
    "schema_browser": f"""WITH c AS (
  SELECT column_name, {_SPARK_TYPE} AS full_data_type, CAST(ordinal_position AS INTEGER) AS pos
  FROM information_schema.columns WHERE table_name = 'orders'),
n AS (SELECT CAST(COUNT(*) AS INTEGER) AS k FROM c),
audit(column_name, full_data_type, off) AS (VALUES ('_rescued_data', 'string', 1),
  ('_source_file', 'string', 2), ('_ingested_at', 'timestamp', 3),
  ('_operation_id', 'string', 4), ('_batch_id', 'string', 5))
SELECT 'op_orders' AS operation_id, 'orders' AS target_table, column_name, full_data_type,
       pos AS ordinal_position, FALSE AS is_audit_column, 'EXTERNAL' AS table_type,
       'PARQUET' AS data_source_format FROM c
UNION ALL
SELECT 'op_orders', 'orders', a.column_name, a.full_data_type,
       CAST((SELECT k FROM n) + a.off AS INTEGER), TRUE, 'EXTERNAL', 'PARQUET' FROM audit a
UNION ALL
SELECT 'op_customer', 'customer', NULL, NULL, NULL, NULL, NULL, NULL""",

    "registry_writes": f"""WITH ops AS (SELECT {_sel(s.CUSTOMER_OPERATIONS)} FROM customer),
upd AS (
  SELECT operation_id, enabled, 'overwrite' AS load_type, source_object_id
  FROM (SELECT {_sel(s.CUSTOMER_OPERATIONS)} FROM customer WHERE c_mktsegment = 'BUILDING')
  UNION ALL
  SELECT operation_id, enabled, load_type, source_object_id
  FROM (SELECT {_sel(s.SUPPLIER_OPERATIONS)} FROM supplier)),
merged AS (
  SELECT operation_id, enabled, load_type, source_object_id FROM ops
  WHERE operation_id NOT IN (SELECT operation_id FROM upd)
  UNION ALL SELECT * FROM upd)
SELECT operation_id, CASE WHEN operation_id = 'op_c1' THEN FALSE ELSE enabled END AS enabled,
       load_type, source_object_id, CAST(NULL AS VARCHAR) AS owner,
       (SELECT COUNT(*) FROM supplier) AS new_ids,
       (SELECT COUNT(*) FROM customer WHERE c_mktsegment = 'BUILDING') AS updated_ids
FROM merged""",

    "landing_counts": """SELECT 'orders' AS table_name, COUNT(*) AS "rows" FROM orders
UNION ALL SELECT 'customer', CAST(NULL AS BIGINT)""",
})

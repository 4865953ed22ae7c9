"""Queries over registry rows: schemas built from column lists, lineage nodes, the audit log's listing, a run's summary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedline.plans import reports
from feedline.plans.registry import resolve_operations, schema_json
from feedline.suite import _existing_tables, _t, audit_from_events, customer_operations, nation_objects
from feedline.suite_sql import AUDIT_CTE, EXISTING, NATION_REGISTRY

QUERIES = {}
ORACLE_SQL = {}


def _query(f):
    QUERIES[f.__name__] = f
    return f


#: The customers of a nation as the columns of one object: blank names, padded ones, missing types and null flags.
COLUMN_ROWS = ["'src_n' || CAST(c_nationkey AS VARCHAR(9)) AS object_id", "c_custkey AS position",
               "CASE WHEN c_custkey % 10 = 0 THEN '  ' WHEN c_custkey % 11 = 0 THEN ' ' || c_name || ' ' ELSE c_name END AS name",
               "CASE c_mktsegment WHEN 'BUILDING' THEN 'long' WHEN 'FURNITURE' THEN 'decimal(12,2)' WHEN 'MACHINERY' THEN ' date ' END AS type",
               "CASE WHEN c_custkey % 7 <> 0 THEN c_acctbal > 0 END AS nullable"]


@_query
def registry_schema_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """f9: the JSON form of a schema from rows of name, type and nullability, one object a nation."""
    return schema_json(_t(spark, sf_dir, "customer").selectExpr(*COLUMN_ROWS))


ORACLE_SQL["registry_schema_json"] = f"""WITH c AS (SELECT {', '.join(COLUMN_ROWS)} FROM customer)
SELECT object_id, '{{"type":"struct","fields":[' || COALESCE(string_agg('{{"name":"' || TRIM(name) || '","type":"'
  || COALESCE(TRIM(type), 'string') || '","nullable":' || CASE WHEN COALESCE(nullable, TRUE) THEN 'true' ELSE 'false' END
  || ',"metadata":{{}}}}', ',' ORDER BY position) FILTER (WHERE TRIM(name) <> ''), '') || ']}}' AS object_schema
FROM c GROUP BY object_id"""


@_query
def lineage_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C4: a node for each feed's source and landing table, and the one between them."""
    resolved = resolve_operations(customer_operations(spark, sf_dir), nation_objects(spark, sf_dir))
    return reports.lineage_nodes(resolved, _existing_tables(spark, sf_dir))


ORACLE_SQL["lineage_nodes"] = f"""WITH {NATION_REGISTRY},
{EXISTING},
r2 AS (SELECT r.*, src.wildcard_pattern, (ex.table_name IS NOT NULL) AS ingested
       FROM r JOIN src ON r.source_object_id = src.object_id LEFT JOIN ex ON r.target_table = ex.table_name)
SELECT 'src:' || operation_id AS node_id, 'source' AS tier, source_id AS label,
  COALESCE(file_format, '') || ' · ' || COALESCE(wildcard_pattern, '') AS sublabel, operation_id, FALSE AS ingested FROM r2
UNION ALL SELECT 'tgt:' || operation_id, 'bronze', target_table,
  CASE WHEN ingested THEN 'landed' ELSE 'no run has landed rows' END, operation_id, ingested FROM r2
UNION ALL SELECT 'framework', 'framework', 'feeds', NULL, NULL, FALSE"""


@_query
def audit_newest_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1: the whole audit log, newest rows first."""
    listed = reports.audit_newest_first(audit_from_events(_t(spark, sf_dir, "events")))
    return listed.select("operation_id", "run_ts", "status", "duration_ms", "rows_written", "rescued_rows")


ORACLE_SQL["audit_newest_first"] = f"""WITH {AUDIT_CTE}
SELECT operation_id, run_ts, status, duration_ms, rows_written, rescued_rows FROM a"""

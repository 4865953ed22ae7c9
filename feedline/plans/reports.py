"""Run reports, audit rollups, catalog views and lineage as DataFrames.

W1 audit_latest, A3-A7, O1/O2, J4, J5, C1-C6.  Per-key "latest" uses a
``max_by`` aggregate (map-side partial aggregation) instead of a window, so
an operation holding a third of the audit log never lands in one task whole.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedline.functions.columns import is_audit_column
from feedline.sources.discovery import BINARY_FILE_SCHEMA
from feedline.sources.headers import literal_paths

LATEST_COLUMNS = ("operation_id", "run_ts", "status", "rows_written", "duration_ms")


def audit_latest(audit: DataFrame, tiebreak: tuple = ("duration_ms", "status")) -> DataFrame:
    """Newest audit row per operation (ties broken by ``tiebreak``)."""
    values = [c for c in LATEST_COLUMNS if c != "operation_id"]
    order = F.struct("run_ts", *tiebreak)
    return (audit.groupBy("operation_id")
            .agg(F.max_by(F.struct(*values), order).alias("v"))
            .select("operation_id", *[F.col(f"v.{c}").alias(c) for c in values]))


def audit_newest_first(audit: DataFrame) -> DataFrame:
    """O1; rows of one time by operation and status."""
    return audit.orderBy(F.col("run_ts").desc(), "operation_id", "status")


def _with_country(audit: DataFrame, operations: DataFrame) -> DataFrame:
    if "country" in audit.columns:
        return audit
    countries = operations.select("operation_id", "country").dropDuplicates(["operation_id"])
    return audit.join(countries, "operation_id", "left")


def _ts_literal(audit: DataFrame, value):
    """A timestamp literal of the same kind (with or without time zone) as run_ts."""
    kind = "timestamp_ntz" if isinstance(audit.schema["run_ts"].dataType, T.TimestampNTZType) \
        else "timestamp"
    return F.lit(str(value)).cast(kind)


def _window(audit: DataFrame, as_of, days: int) -> DataFrame:
    end = _ts_literal(audit, as_of)
    start = end - F.make_interval(days=F.lit(days))
    return audit.where((F.col("run_ts") >= start) & (F.col("run_ts") <= end))


def audit_history(audit: DataFrame, operations: DataFrame, as_of, days: int = 30) -> DataFrame:
    """Per (operation, country, status) in the window: runs, success rate of the
    (operation, country), average duration, rows written."""
    a = _window(_with_country(audit, operations), as_of, days)
    per_status = a.groupBy("operation_id", "country", "status").agg(
        F.count(F.lit(1)).alias("runs"),
        F.avg("duration_ms").alias("avg_duration_ms"),
        F.sum("rows_written").alias("rows_written"))
    # country depends on the operation only, so the rate is per operation.  It is taken
    # from the aggregated rows (a handful per operation), not from a second scan.
    per_op = Window.partitionBy("operation_id")
    ok_runs = F.sum(F.when(F.col("status") == "SUCCESS", F.col("runs")).otherwise(0)).over(per_op)
    return (per_status.withColumn("success_rate", ok_runs / F.sum("runs").over(per_op))
            .select("operation_id", "country", "status", F.col("runs").cast("bigint").alias("runs"),
                    F.round("success_rate", 6).alias("success_rate"),
                    F.round("avg_duration_ms", 6).alias("avg_duration_ms"),
                    F.col("rows_written").cast("bigint").alias("rows_written")))


def audit_daily(audit: DataFrame, operations: DataFrame, as_of, days: int = 14) -> DataFrame:
    """Per (day, country): success, warn (success with rescued rows), fail."""
    a = _window(_with_country(audit, operations), as_of, days)
    ok = F.col("status") == "SUCCESS"
    rescued = F.coalesce(F.col("rescued_rows"), F.lit(0)) > 0
    return (a.groupBy(F.to_date("run_ts").alias("run_date"), "country")
            .agg(F.count_if(ok & ~rescued).cast("bigint").alias("success"),
                 F.count_if(ok & rescued).cast("bigint").alias("warn"),
                 F.count_if(F.col("status") == "FAILED").cast("bigint").alias("fail")))


def audit_log(audit: DataFrame, operations: DataFrame, status: str | None = None,
              start=None, end=None) -> DataFrame:
    """O2: filterable audit log, newest first."""
    a = _with_country(audit, operations)
    if status:
        a = a.where(F.col("status") == status)
    if start is not None:
        a = a.where(F.col("run_ts") >= _ts_literal(a, start))
    if end is not None:
        a = a.where(F.col("run_ts") < _ts_literal(a, end))
    return a.select("operation_id", "country", "run_ts", "status", "duration_ms",
                    "rows_written", F.coalesce("rescued_rows", F.lit(0)).cast("bigint")
                    .alias("rescued_rows")).orderBy(F.col("run_ts").desc(), "operation_id")


def operation_counts(operations: DataFrame) -> DataFrame:
    """A5: enabled / total operations."""
    return operations.agg(F.count(F.lit(1)).alias("total"),
                          F.count_if(F.col("enabled")).alias("enabled"))


def all_success(results: DataFrame) -> DataFrame:
    """A4."""
    return results.agg(F.bool_and(F.col("status") == "SUCCESS").alias("all_success"))


# -- catalog views (C1-C3) --------------------------------------------------------------

def landing_tables(spark: SparkSession, database: str) -> DataFrame:
    """Tables of one database with type and data source format."""
    rows = []
    if spark.catalog.databaseExists(database.strip("`")):
        for t in spark.catalog.listTables(database.strip("`")):
            if t.isTemporary:
                continue
            fmt = None
            info = spark.sql(f"DESCRIBE TABLE EXTENDED {database}.`{t.name}`") \
                .where("col_name = 'Provider'").collect()
            if info:
                fmt = info[0]["data_type"].upper()
            rows.append((t.name, t.tableType, fmt))
    return spark.createDataFrame(rows, "table_name string, table_type string, "
                                       "data_source_format string").orderBy("table_name")


def landing_columns(spark: SparkSession, database: str) -> DataFrame:
    """(table, column, type, nullable, position) of every table in a database."""
    rows = []
    if spark.catalog.databaseExists(database.strip("`")):
        for t in spark.catalog.listTables(database.strip("`")):
            if t.isTemporary:
                continue
            schema = spark.table(f"{database}.`{t.name}`").schema
            for i, f in enumerate(schema.fields, start=1):
                rows.append((t.name, f.name, f.dataType.simpleString(),
                             "YES" if f.nullable else "NO", i))
    return spark.createDataFrame(rows, "table_name string, column_name string, full_data_type "
                                       "string, is_nullable string, ordinal_position int") \
        .orderBy("table_name", "ordinal_position")


def table_detail(spark: SparkSession, name: str) -> DataFrame:
    """Format, partition columns, number of files, bytes, location; empty when the
    table does not exist.  The folders are those that the catalog shows for the table's partitions; files
    and bytes come from a distributed listing of them, and no file is opened."""
    schema = ("name string, format string, partition_columns array<string>, "
              "num_files bigint, size_in_bytes bigint, location string")
    if not spark.catalog.tableExists(name):
        return spark.createDataFrame([], schema)
    desc = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    parts = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    return listed_files(spark, name).agg(F.count("path").alias("num_files"), F.sum("length").alias("size_in_bytes")).select(
        F.lit(name).alias("name"), F.lit((desc.get("Provider") or "").lower()).alias("format"),
        F.array(*[F.lit(p) for p in parts]).cast("array<string>").alias("partition_columns"),
        F.col("num_files"), F.coalesce(F.col("size_in_bytes"), F.lit(0)).cast("bigint").alias("size_in_bytes"),
        F.lit(desc.get("Location")).alias("location"))


def listed_files(spark: SparkSession, name: str) -> DataFrame:
    """``path, length`` of the files of a table's current partitions, from their metadata alone."""
    folders = sorted({unquote(f.rsplit("/", 1)[0]) for f in spark.table(name).inputFiles()})
    if not folders:
        return spark.createDataFrame([], "path string, length bigint")
    return (spark.read.format("binaryFile").schema(BINARY_FILE_SCHEMA).load(literal_paths(folders))
            .select("path", "length"))


def table_counts(spark: SparkSession, names: dict[str, str]) -> DataFrame:
    """A3: row count per landing table, NULL when the table does not exist."""
    frames = []
    for label, name in names.items():
        if spark.catalog.tableExists(name):
            frames.append(spark.table(name).agg(F.count(F.lit(1)).alias("rows"))
                          .select(F.lit(label).alias("table_name"), "rows"))
        else:
            frames.append(spark.createDataFrame([(label, None)], "table_name string, rows bigint"))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


# -- joins over the registry (J4, J5) ---------------------------------------------------

def operation_status(resolved: DataFrame, existing_tables: DataFrame, audit: DataFrame) -> DataFrame:
    """Each operation ⟕ its landing table (exists?) ⟕ its latest audit row."""
    latest = audit_latest(audit)
    exists = existing_tables.select(F.col("table_name").alias("target_table"),
                                    F.lit(True).alias("_exists")).dropDuplicates(["target_table"])
    return (resolved.select("operation_id", "enabled", "target_table", "load_type")
            .join(exists, "target_table", "left")
            .join(latest, "operation_id", "left")
            .select("operation_id", "enabled", "target_table", "load_type",
                    F.coalesce("_exists", F.lit(False)).alias("ingested"),
                    F.col("run_ts").alias("last_run_ts"), F.col("status").alias("last_status"),
                    F.col("rows_written").alias("last_rows_written"),
                    F.col("duration_ms").alias("last_duration_ms")))


def schema_browser(resolved: DataFrame, columns: DataFrame) -> DataFrame:
    """Each operation ⟕ the columns of its landing table, by position; audit
    columns are flagged by exact name (D17)."""
    cols = columns.select(F.col("table_name").alias("target_table"), "column_name",
                          "full_data_type", "ordinal_position")
    return (resolved.select("operation_id", "target_table").join(cols, "target_table", "left")
            .select("operation_id", "target_table", "column_name", "full_data_type",
                    "ordinal_position",
                    is_audit_column("column_name").alias("is_audit_column"))
            .orderBy("operation_id", "ordinal_position"))


# -- lineage (C4, C5) ---------------------------------------------------------------------

FRAMEWORK_NODE = "framework"


def lineage_nodes(resolved: DataFrame, existing_tables: DataFrame) -> DataFrame:
    ex = existing_tables.select(F.col("table_name").alias("target_table"),
                                F.lit(True).alias("_ex")).dropDuplicates(["target_table"])
    r = resolved.join(ex, "target_table", "left")
    ingested = F.coalesce(F.col("_ex"), F.lit(False))
    src = r.select(F.concat(F.lit("src:"), "operation_id").alias("node_id"),
                   F.lit("source").alias("tier"), F.col("source_id").alias("label"),
                   F.concat_ws(" · ", F.coalesce("file_format", F.lit("")),
                               F.coalesce("wildcard_pattern", F.lit(""))).alias("sublabel"),
                   F.col("operation_id"), F.lit(False).alias("ingested"))
    tgt = r.select(F.concat(F.lit("tgt:"), "operation_id").alias("node_id"),
                   F.lit("bronze").alias("tier"), F.col("target_table").alias("label"),
                   F.when(ingested, F.lit("landed")).otherwise(F.lit("no run has landed rows"))
                   .alias("sublabel"), F.col("operation_id"), ingested.alias("ingested"))
    fw = r.sparkSession.createDataFrame(
        [(FRAMEWORK_NODE, "framework", "feeds", None, None, False)],
        "node_id string, tier string, label string, sublabel string, operation_id string, "
        "ingested boolean")
    return src.unionByName(tgt).unionByName(fw)


def lineage_edges(resolved: DataFrame, existing_tables: DataFrame) -> DataFrame:
    """C4: source -> framework (label = format) and framework -> landing table
    (label = 'load_type · mode' + ' · cast→str'), with ``ingested`` / ``animated``."""
    ex = existing_tables.select(F.col("table_name").alias("target_table"),
                                F.lit(True).alias("_ex")).dropDuplicates(["target_table"])
    r = resolved.join(ex, "target_table", "left")
    ingested = F.coalesce(F.col("_ex"), F.lit(False))
    enabled = F.coalesce(F.col("enabled"), F.lit(False))
    e1 = r.select(F.concat(F.lit("read:"), "operation_id").alias("edge_id"),
                  F.concat(F.lit("src:"), "operation_id").alias("source"),
                  F.lit(FRAMEWORK_NODE).alias("target"),
                  F.col("file_format").alias("label"), enabled.alias("animated"),
                  F.lit(False).alias("ingested"), "operation_id")
    label = F.concat(F.col("load_type"), F.lit(" · "), F.col("schema_evolution_mode"),
                     F.when(F.col("cast_all_as_string"), F.lit(" · cast→str")).otherwise(F.lit("")))
    e2 = r.select(F.concat(F.lit("write:"), "operation_id").alias("edge_id"),
                  F.lit(FRAMEWORK_NODE).alias("source"),
                  F.concat(F.lit("tgt:"), "operation_id").alias("target"),
                  label.alias("label"), (enabled & ingested).alias("animated"),
                  ingested.alias("ingested"), "operation_id")
    return e1.unionByName(e2)


def downstream_tiers(resolved: DataFrame, downstream: DataFrame) -> DataFrame:
    """Landing table ⟕ declared downstream mapping (silver / consumer tiers);
    an operation without a mapping yields one 'no downstream' row."""
    d = downstream.select(F.col("table_name").alias("target_table"), "consumer", "tier")
    return (resolved.select("operation_id", "target_table").join(d, "target_table", "left")
            .select("operation_id", "target_table",
                    F.coalesce("tier", F.lit("none")).alias("tier"),
                    F.coalesce("consumer", F.lit("no downstream")).alias("consumer")))


#: Characters of an error that the summary of a run shows; the audit row has all of them.
ERROR_CHARS = 500


def run_summary(spark: SparkSession, results: list, error_chars: int = ERROR_CHARS) -> DataFrame:
    """Status per operation of this run, rows written, the first ``error_chars`` of an error, overall flag."""
    rows = [(r.operation_id, r.status, r.rows_written, r.rescued_rows, r.duration_ms, r.error) for r in results]
    df = spark.createDataFrame(rows, "operation_id string, status string, rows_written bigint, "
                                     "rescued_rows bigint, duration_ms bigint, error string")
    df = df.withColumn("error", F.nullif(F.substring("error", 1, error_chars), F.lit("")))
    return df.withColumn("all_success", F.every(F.col("status") == "SUCCESS").over(Window.partitionBy()))

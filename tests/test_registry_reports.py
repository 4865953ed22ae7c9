"""Schemas from column lists, the audit log's order, a run's summary."""

from datetime import datetime
from types import SimpleNamespace

from pyspark.sql import types as T

from feedline.plans import reports
from feedline.plans.registry import schema_json


def test_schema_from_a_column_list_reads_back(spark):
    rows = [("o", 2, " b ", "decimal(12,2)", False), ("o", 1, 'a"q', None, None), ("o", 3, "  ", "long", True),
            ("o", 4, None, "long", True), ("o", 5, "b", "long", True), ("empty", 1, "", "long", True)]
    columns = spark.createDataFrame(rows, "object_id string, position int, name string, type string, nullable boolean")
    found = {r["object_id"]: r["object_schema"] for r in schema_json(columns).collect()}
    import json
    schema = T.StructType.fromJson(json.loads(found["o"]))
    assert [(f.name, f.dataType.simpleString(), f.nullable) for f in schema] == [
        ('a"q', "string", True), ("b", "decimal(12,2)", False), ("b", "bigint", True)]
    assert found["empty"] == '{"type":"struct","fields":[]}'
    assert schema_json(columns.limit(0)).count() == 0


def test_audit_log_is_listed_newest_first(spark):
    at = lambda day: datetime(2024, 1, day)
    audit = spark.createDataFrame([("b", at(2), "FAILED"), ("a", at(3), "SUCCESS"), ("a", at(2), "SUCCESS"), ("c", None, "FAILED")],
                                  "operation_id string, run_ts timestamp, status string")
    assert [(r[0], r[1]) for r in reports.audit_newest_first(audit).collect()] == [("a", at(3)), ("a", at(2)), ("b", at(2)), ("c", None)]


def test_run_summary_cuts_errors_by_its_parameter(spark):
    run = lambda op, error: SimpleNamespace(operation_id=op, status="FAILED" if error else "SUCCESS", rows_written=1,
                                            rescued_rows=0, duration_ms=1, error=error)
    rows = {r["operation_id"]: r for r in reports.run_summary(spark, [run("a", None), run("b", "é" * 600)]).collect()}
    assert rows["b"]["error"] == "é" * 500 and rows["a"]["error"] is None and rows["a"]["all_success"] is False
    assert reports.run_summary(spark, [run("b", "x" * 600)], error_chars=550).first()["error"] == "x" * 550
    assert reports.run_summary(spark, [run("a", "")]).first()["all_success"] is True
    assert reports.run_summary(spark, []).count() == 0

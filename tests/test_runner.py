"""Runner behaviours: hive-style globs, restart, drift failure, reset, guards, catalog views."""

import os

import pytest

from feedline import suite
from feedline.plans import reports
from feedline.plans.registry import Registry
from feedline.streaming.runner import Runner


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_hive_style_glob_keeps_partition_columns(spark, ws, tmp_path):
    raw = str(tmp_path / "orders")
    for y, m in [(2024, 1), (2024, 2), (2025, 1)]:
        _write(f"{raw}/year={y}/month={m}/part.csv", f"id,amount\n{y}{m},1.5\n")
    reg = Registry(ws)
    suite._register(spark, reg, [suite._source("src", raw, "year=*/month=*/*.csv", "csv"),
                                 suite._target("tgt", ws, "t")],
                    [suite._operation("op", "src", "tgt")])
    assert Runner(ws).run_operation("op").rows_written == 3
    rows = {(r["year"], r["month"]) for r in spark.table(ws.table(ws.catalog, "bronze", "t")).collect()}
    assert rows == {(2024, 1), (2024, 2), (2025, 1)}


def test_rewritten_file_is_not_read_again(spark, ws, tmp_path):
    raw = str(tmp_path / "f")
    _write(f"{raw}/a.csv", "id\n1\n2\n")
    reg = Registry(ws)
    suite._register(spark, reg, [suite._source("src", raw, "*.csv", "csv"),
                                 suite._target("tgt", ws, "t")], [suite._operation("op", "src", "tgt")])
    runner = Runner(ws)
    assert runner.run_operation("op").rows_written == 2
    _write(f"{raw}/a.csv", "id\n1\n2\n3\n")  # same path, new content (T6)
    assert runner.run_operation("op").rows_written == 0
    _write(f"{raw}/b.csv", "id\n4\n")
    assert runner.run_operation("op").rows_written == 1
    assert spark.table(ws.table(ws.catalog, "bronze", "t")).count() == 3


def test_fail_on_new_columns_keeps_files_pending(spark, ws, tmp_path):
    raw = str(tmp_path / "f")
    _write(f"{raw}/a.csv", "id,name\n1,x\n")
    reg = Registry(ws)
    suite._register(spark, reg, [suite._source("src", raw, "*.csv", "csv"),
                                 suite._target("tgt", ws, "t")],
                    [suite._operation("op", "src", "tgt", schema_evolution_mode="failOnNewColumns")])
    runner = Runner(ws)
    assert runner.run_operation("op").rows_written == 1
    _write(f"{raw}/b.csv", "id,name,extra\n2,y,z\n")
    res = runner.run_operation("op", raise_errors=False)
    assert res.status == "FAILED" and "extra" in res.error
    with pytest.raises(Exception):
        runner.run_operation("op")
    audit = reg.audit_log().orderBy("run_ts").collect()
    assert [a["status"] for a in audit] == ["SUCCESS", "FAILED", "FAILED"]
    assert audit[1]["error_message"]
    # switch the operation to addNewColumns: the pending file lands now
    suite._register(spark, reg, [suite._source("src", raw, "*.csv", "csv"),
                                 suite._target("tgt", ws, "t")],
                    [suite._operation("op", "src", "tgt")])
    assert runner.run_operation("op").rows_written == 1
    assert "extra" in spark.table(ws.table(ws.catalog, "bronze", "t")).columns


def test_reset_reingests_everything(spark, ws, tmp_path):
    raw = str(tmp_path / "f")
    _write(f"{raw}/a.csv", "id\n1\n2\n")
    reg = Registry(ws)
    suite._register(spark, reg, [suite._source("src", raw, "*.csv", "csv"),
                                 suite._target("tgt", ws, "t")], [suite._operation("op", "src", "tgt")])
    runner = Runner(ws)
    runner.run_operation("op")
    runner.reset(["op"])
    assert not spark.catalog.tableExists(ws.table(ws.catalog, "bronze", "t"))
    assert runner.run_operation("op").rows_written == 2
    assert spark.table(ws.table(ws.catalog, "bronze", "t")).count() == 2


def test_guards(spark, ws, tmp_path):
    reg = Registry(ws)
    suite._register(spark, reg,
                    [suite._source("s1", str(tmp_path), "*.txt", "txt"),
                     suite._source("s2", str(tmp_path), "*.xml", "xml"),
                     suite._source("s3", str(tmp_path / "av"), "*.avro", "avro"),
                     suite._target("t", ws, "t")],
                    [suite._operation("op_txt", "s1", "t"), suite._operation("op_xml", "s2", "t"),
                     suite._operation("op_off", "s1", "t", enabled=False),
                     suite._operation("op_avro", "s3", "t"),
                     suite._operation("op_dangling", "nope", "t")])
    runner = Runner(ws)
    assert "Unsupported file format" in runner.run_operation("op_txt", raise_errors=False).error
    assert "row_tag" in runner.run_operation("op_xml", raise_errors=False).error
    assert "has no enabled operation op_off" in runner.run_operation("op_off", raise_errors=False).error
    _write(str(tmp_path / "av" / "a.avro"), "not really avro")
    assert "spark-avro" in runner.run_operation("op_avro", raise_errors=False).error
    assert "no source object nope" in runner.run_operation("op_dangling",
                                                                    raise_errors=False).error


def test_catalog_views(spark, ws, tmp_path):
    raw = str(tmp_path / "f")
    _write(f"{raw}/a.csv", "id,name\n1,x\n")
    reg = Registry(ws)
    suite._register(spark, reg, [suite._source("src", raw, "*.csv", "csv"),
                                 suite._target("tgt", ws, "t", partition_cols="name")],
                    [suite._operation("op", "src", "tgt")])
    Runner(ws).run_operation("op")
    db = ws.database(ws.catalog, "bronze")
    tables = reports.landing_tables(spark, db).collect()
    assert [(t["table_name"], t["data_source_format"]) for t in tables] == [("t", "PARQUET")]
    cols = [r["column_name"] for r in reports.landing_columns(spark, db).collect()]
    assert cols[:2] == ["id", "_rescued_data"] and "_batch_id" in cols
    detail = reports.table_detail(spark, ws.table(ws.catalog, "bronze", "t")).first()
    assert detail["num_files"] >= 1 and detail["size_in_bytes"] > 0
    assert detail["partition_columns"] == ["_batch_id", "name"]
    assert reports.table_detail(spark, ws.table(ws.catalog, "bronze", "missing")).count() == 0


def test_run_all_in_parallel_waves(spark, ws, tmp_path):
    raw = str(tmp_path)
    for name in ("a", "b", "c"):
        _write(f"{raw}/{name}/x.csv", "id\n1\n2\n3\n")
    reg = Registry(ws)
    objects = [suite._source(f"src_{n}", f"{raw}/{n}", "*.csv", "csv") for n in "abc"]
    objects += [suite._target(f"tgt_{n}", ws, n) for n in "abc"]
    objects += [{"object_id": "src_rep", "object_type": "source", "source_format": "delta",
                 "file_path": f"{ws.catalog}.bronze.a"}, suite._target("tgt_rep", ws, "rep")]
    ops = [suite._operation(f"op_{n}", f"src_{n}", f"tgt_{n}") for n in "abc"]
    ops += [suite._operation("op_0rep", "src_rep", "tgt_rep", schema_evolution_mode="none")]
    suite._register(spark, reg, objects, ops)
    results = Runner(ws).run_all(parallelism=3)
    assert {r.operation_id: (r.status, r.rows_written) for r in results} == {
        "op_a": ("SUCCESS", 3), "op_b": ("SUCCESS", 3), "op_c": ("SUCCESS", 3),
        "op_0rep": ("SUCCESS", 3)}
    assert [r.operation_id for r in results][-1] == "op_0rep"
    assert reg.audit_log().count() == 4


def test_an_empty_append_batch_leaves_no_partition(spark, ws, tmp_path):
    raw = str(tmp_path / "f")
    reg = Registry(ws)
    suite._register(spark, reg, [suite._source("src", raw, "*.parquet", "parquet"), suite._target("tgt", ws, "t")],
                    [suite._operation("op", "src", "tgt")])
    name = ws.table(ws.catalog, "bronze", "t")
    for rows, batches in (([(1,)], 1), ([], 1), ([(2,)], 2)):
        spark.createDataFrame(rows, "id bigint").coalesce(1).write.mode("append").parquet(raw)
        assert Runner(ws).run_operation("op").rows_written == len(rows)
        assert spark.sql(f"SHOW PARTITIONS {name}").count() == batches
    assert sorted(r["id"] for r in spark.table(name).collect()) == [1, 2]

"""Plan shapes that matter at scale, checked on the physical plan Spark chooses.

* the append path is scan -> projection -> write: no shuffle;
* a parquet batch reads only the columns the landing table needs;
* last-version-per-key reads its batch once and shuffles once, with a
  map-side partial aggregate (a hot key collapses before the shuffle);
* NULL-key rows are all kept, each in its own group.
"""

import contextlib
import glob
import io
import re

from pyspark.sql import functions as F

from feedline.operators import schema as schema_ops
from feedline.operators.transforms import add_audit_columns, latest_per_key
from feedline.plans.registry import IngestConfig
from feedline.sources.readers import HIDDEN, SRC, read_batch


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def _nodes(plan: str, name: str) -> int:
    """Number of physical operators called ``name`` (the numbered detail headers)."""
    return len(re.findall(rf"^\(\d+\) {name}\b", plan, flags=re.M))


def _cfg(fmt: str, **kw) -> IngestConfig:
    base = dict(operation_id="op", source_id="s", source_format="cloudFiles", full_path="",
                file_format=fmt, row_tag=None, schema=None, delimiter=",", encoding="UTF-8",
                null_value="", target_catalog="c", target_schema="bronze", target_table="t",
                table_path=None)
    base.update(kw)
    return IngestConfig(**base)


def _landed(spark, paths, cfg):
    batch = read_batch(spark, paths, cfg)
    target, rescue = schema_ops.evolve(batch.df, None, "addNewColumns", False, batch.infer)
    return schema_ops.conform(batch.df, target, rescue)


def _json_files(spark, tmp_path, rows, schema, parts=4):
    out = str(tmp_path / "feed")
    spark.createDataFrame(rows, schema).repartition(parts).write.json(out)
    return sorted(glob.glob(f"{out}/*.json"))


def test_append_projection_has_no_shuffle(spark, tmp_path):
    paths = _json_files(spark, tmp_path, [(i, f"v{i}") for i in range(50)], "k bigint, v string")
    df = add_audit_columns(_landed(spark, paths, _cfg("jsonl")), "op", F.col(SRC)).drop(*HIDDEN)
    plan = _plan(df)
    assert _nodes(plan, "Exchange") == 0
    assert _nodes(plan, "Scan json") == 1
    assert "[codegen id" in plan


def test_parquet_batch_reads_only_needed_columns(spark, tmp_path):
    out = str(tmp_path / "pq")
    spark.range(20).selectExpr("id AS a", "id * 2 AS b", "CAST(id AS STRING) AS c").write.parquet(out)
    df = _landed(spark, sorted(glob.glob(f"{out}/*.parquet")), _cfg("parquet")).select("a", "b")
    plan = _plan(df)
    read_schema = next(line for line in plan.splitlines() if line.startswith("ReadSchema"))
    assert "c:" not in read_schema and "a:" in read_schema and "b:" in read_schema


def test_latest_per_key_scans_once_and_shuffles_once(spark, tmp_path):
    rows = [(i % 7 if i % 5 else None, f"v{i}") for i in range(60)]
    paths = _json_files(spark, tmp_path, rows, "k bigint, v string")
    latest = latest_per_key(_landed(spark, paths, _cfg("jsonl")), ["k"])
    plan = _plan(latest)
    assert _nodes(plan, "Scan json") == 1
    assert _nodes(plan, "Exchange") == 1
    assert "partial_max" in plan  # map-side partial aggregate before the shuffle
    got = latest.collect()
    assert len([r for r in got if r["k"] is None]) == 12  # every NULL-key row kept
    assert sorted(r["k"] for r in got if r["k"] is not None) == list(range(7))


def test_latest_per_key_with_a_map_value(spark):
    df = spark.createDataFrame(
        [(1, {"a": "old"}, 1), (1, {"a": "new"}, 2), (2, {"b": "x"}, 1)],
        "k bigint, m map<string,string>, __src_pos bigint")
    got = {r["k"]: r["m"] for r in latest_per_key(df, ["k"]).collect()}
    assert got == {1: {"a": "new"}, 2: {"b": "x"}}


def test_latest_per_key_missing_key_is_a_clear_error(spark):
    import pytest
    df = spark.createDataFrame([(1, "a")], "k bigint, v string")
    with pytest.raises(ValueError, match="Merge keys not in the data"):
        latest_per_key(df, ["nope"])


def test_merge_into_bucketed_target_shuffles_only_the_batch(spark, ws, monkeypatch):
    from feedline.operators import sinks, tables

    ws.ensure_database(ws.catalog, "bronze")
    t = sinks.Target(ws.table(ws.catalog, "bronze", "bk"),
                     ws.table_location(ws.catalog, "bronze", "bk"), [])
    sinks.merge(spark, spark.range(2000).selectExpr("id AS k", "'a' AS v"), t, ["k"], "b0")
    assert tables.bucket_spec(spark, t.name) == (["k"], 8)  # seeded bucketed on the key
    captured = {}
    real = sinks._write_bucketed

    def spy(session, merged, *args):
        captured["plan"] = _plan(merged)
        return real(session, merged, *args)

    monkeypatch.setattr(sinks, "_write_bucketed", spy)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # a batch too big to broadcast
    try:
        batch = spark.range(0, 2000, 7).selectExpr("id AS k", "'b' AS v")
        sinks.merge(spark, batch, t, ["k"], "b1")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    plan = captured["plan"]
    assert "Bucketed: true" in plan  # the target is read bucket by bucket
    exchanges = [ln for ln in plan.splitlines() if ln.startswith("Arguments: hashpartitioning")]
    assert exchanges and all("REPARTITION_BY_NUM" in ln for ln in exchanges)  # batch side only
    got = spark.table(t.name)
    assert got.count() == 2000 and got.where("v = 'b'").count() == len(range(0, 2000, 7))
    assert tables.bucket_spec(spark, t.name) == (["k"], 8)


def test_discovery_stream_reads_no_file_content(spark, tmp_path):
    """The discovery stream lists files; its scan never reads their content."""
    from feedline.sources.discovery import incremental_files

    raw = tmp_path / "raw"
    raw.mkdir()
    for i in range(3):
        (raw / f"f{i}.csv").write_text("a,b\n1,2\n")
    batches = []

    def capture(batch, batch_id):
        batches.append([r["path"] for r in batch.select("path").collect()])

    query = (incremental_files(spark, f"{raw}/*.csv", 2).writeStream
             .trigger(availableNow=True)
             .option("checkpointLocation", str(tmp_path / "ck"))
             .foreachBatch(capture).start())
    query.awaitTermination()
    assert sorted(len(b) for b in batches) == [1, 2]  # throttled: batches of 2 and 1 files
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        query.explain()  # the last micro-batch's executed plan
    plan = buf.getvalue()
    assert "FileScan binaryFile" in plan
    read_schema = plan.split("ReadSchema:", 1)[1].splitlines()[0]
    assert "path" in read_schema and "content" not in read_schema


def test_table_detail_reads_file_metadata_only(spark, ws):
    from feedline.operators import sinks
    from feedline.plans import reports

    ws.ensure_database(ws.catalog, "bronze")
    t = sinks.Target(ws.table(ws.catalog, "bronze", "d"), ws.table_location(ws.catalog, "bronze", "d"), ["v"])
    for token in ("op-g0-b0", "op-g0-b1"):
        sinks.append(spark, spark.createDataFrame([(1, "a b"), (2, "x{y}*[z]%?"), (3, None)], "k bigint, v string").coalesce(1), t, token)
    sinks.drop_batches_before(spark, t, "op-g0-b1", "op")  # its files stay on disk and are not counted
    plan = _plan(reports.listed_files(spark, t.name))
    assert "Scan binaryFile" in plan and "ReadSchema: struct<path:string,length:bigint>" in plan and "Exchange" not in plan
    detail = reports.table_detail(spark, t.name).first()
    assert (detail["num_files"], detail["partition_columns"]) == (3, ["_batch_id", "v"]) and detail["size_in_bytes"] > 0

"""Sink contracts on parquet tables."""

import pytest
from pyspark.sql import functions as F

from feedline.operators import sinks
from feedline.operators.transforms import latest_per_key


def _target(ws, name, parts=()):
    ws.ensure_database(ws.catalog, "bronze")
    return sinks.Target(ws.table(ws.catalog, "bronze", name),
                        ws.table_location(ws.catalog, "bronze", name), list(parts))


def test_append_redelivery_is_idempotent(spark, ws):
    t = _target(ws, "a", ["p"])
    df = spark.createDataFrame([(1, "x"), (2, "y")], "k bigint, p string")
    sinks.append(spark, df, t, "op-g0-b0")
    sinks.append(spark, df, t, "op-g0-b0")  # the same batch again
    assert spark.table(t.name).count() == 2
    sinks.append(spark, df, t, "op-g0-b1")
    assert spark.table(t.name).count() == 4


def test_append_adds_columns_only_with_merge_schema(spark, ws):
    t = _target(ws, "b")
    sinks.append(spark, spark.createDataFrame([(1,)], "k bigint"), t, "b0")
    wider = spark.createDataFrame([(2, "n")], "k bigint, extra string")
    with pytest.raises(ValueError):
        sinks.append(spark, wider, t, "b1", merge_schema=False)
    sinks.append(spark, wider, t, "b1")
    rows = {r["k"]: r["extra"] for r in spark.table(t.name).collect()}
    assert rows == {1: None, 2: "n"}


def test_merge_upsert_and_null_keys(spark, ws):
    t = _target(ws, "m")
    seed = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n1")], "k bigint, v string")
    sinks.merge(spark, seed, t, ["k"], "b0")
    batch = spark.createDataFrame([(2, "B"), (3, "c"), (None, "n2")], "k bigint, v string")
    sinks.merge(spark, batch, t, ["k"], "b1")
    got = sorted((r["k"] if r["k"] is not None else -1, r["v"]) for r in spark.table(t.name).collect())
    assert got == [(-1, "n1"), (-1, "n2"), (1, "a"), (2, "B"), (3, "c")]
    sinks.merge(spark, batch, t, ["k"], "b1")  # replaying a merged batch changes nothing...
    assert spark.table(t.name).where("k IS NOT NULL").count() == 3


def test_merge_spreads_null_keys_over_tasks(spark, ws):
    """A NULL key that holds a third of the batch does not land in one task, and no row is lost."""
    t = _target(ws, "hot")
    batch = spark.range(6000).selectExpr("if(id % 3 = 0, null, id) AS k", "if(id % 2 = 0, 'x', null) AS j", "id AS v")
    for keys in (["k"], ["k", "j"]):
        parts = [r["count"] for r in sinks._by_bucket(batch, (keys, 8)).where("k IS NULL").groupBy(F.spark_partition_id()).count().collect()]
        assert sum(parts) == 2000 and max(parts) < 500
    sinks.merge(spark, batch, t, ["k"], "b0")
    sinks.merge(spark, batch.withColumn("v", F.col("v") + 6000), t, ["k"], "b1")
    got = spark.table(t.name)
    assert got.where("k IS NULL").count() == 4000 and got.where("k IS NOT NULL AND v >= 6000").count() == got.where("k IS NOT NULL").count() == 4000


def test_latest_per_key_last_version_wins(spark):
    df = spark.createDataFrame(
        [(1, "old", 1, 0), (1, "new", 2, 0), (2, "only", 1, 0), (None, "x", 1, 0), (None, "y", 2, 0)],
        "k bigint, v string, __src_mtime int, __src_pos int")
    rows = sorted((r["k"] if r["k"] is not None else -1, r["v"])
                  for r in latest_per_key(df, ["k"]).collect())
    assert rows == [(-1, "x"), (-1, "y"), (1, "new"), (2, "only")]


def test_overwrite_keeps_a_snapshot_spread_over_batches(spark, ws):
    t = _target(ws, "o")
    run = {}
    sinks.overwrite(spark, spark.createDataFrame([(1,), (2,)], "k bigint"), t, "r1b0", run)
    sinks.overwrite(spark, spark.createDataFrame([(3,)], "k bigint"), t, "r1b1", run)
    assert spark.table(t.name).count() == 3
    run2 = {}
    sinks.overwrite(spark, spark.createDataFrame([(9, "z")], "k bigint, w string"), t, "r2b0", run2)
    assert [r["k"] for r in spark.table(t.name).collect()] == [9]
    assert "w" in spark.table(t.name).columns


def test_publish_snapshot_reads_back(spark, ws):
    t = _target(ws, "pub")
    n = sinks.publish_snapshot(spark, t.name, spark.range(7).withColumn("x", F.lit("a")), t.location)
    assert n == 7 and spark.table(t.name).count() == 7
    assert sinks.publish_snapshot(spark, t.name, spark.range(0), t.location) == 0


def test_unknown_load_type(spark, ws):
    with pytest.raises(ValueError, match="Unknown load_type"):
        sinks.write_batch(spark, spark.range(1), "upsert", _target(ws, "u"), [], "b", True, {})


def test_partition_scoped_merge(spark, ws):
    t = _target(ws, "pm", ["region"])
    seed = spark.createDataFrame([("eu", 1, "a"), ("eu", 2, "b"), ("us", 3, "c"), ("apac", 4, "d")],
                                 "region string, k bigint, v string")
    sinks.merge(spark, seed, t, ["region", "k"], "b0")
    before = {r["region"]: r["f"] for r in spark.table(t.name).select(
        "region", F.col("_metadata.file_path").alias("f")).collect()}
    batch = spark.createDataFrame([("eu", 2, "B"), ("eu", 5, "e"), ("latam", 6, "f")],
                                  "region string, k bigint, v string")
    sinks.merge(spark, batch, t, ["region", "k"], "b1")
    got = sorted((r["region"], r["k"], r["v"]) for r in spark.table(t.name).collect())
    assert got == [("apac", 4, "d"), ("eu", 1, "a"), ("eu", 2, "B"), ("eu", 5, "e"),
                   ("latam", 6, "f"), ("us", 3, "c")]
    after = {r["region"]: r["f"] for r in spark.table(t.name).select(
        "region", F.col("_metadata.file_path").alias("f")).collect()}
    assert after["us"] == before["us"] and after["apac"] == before["apac"]  # untouched
    assert after["eu"] != before["eu"]
    sinks.merge(spark, batch, t, ["region", "k"], "b1")  # replay: same content
    assert spark.table(t.name).count() == 6


def test_merge_widens_nested_struct(spark, ws):
    t = _target(ws, "mn")
    sinks.merge(spark, spark.createDataFrame([(1, ("Oslo",))], "k bigint, a struct<city:string>"),
                t, ["k"], "b0")
    sinks.merge(spark, spark.createDataFrame([(2, ("Lima", "15001"))],
                                             "k bigint, a struct<city:string, zip:string>"),
                t, ["k"], "b1")
    got = {r["k"]: (r["a"]["city"], r["a"]["zip"]) for r in spark.table(t.name).collect()}
    assert got == {1: ("Oslo", None), 2: ("Lima", "15001")}


def test_partition_scoped_merge_keeps_string_partition_values(spark, ws):
    t = _target(ws, "pz", ["store"])
    seed = spark.createDataFrame([("0050", 1, "a"), ("50", 2, "b"), ("007", 3, "c")],
                                 "store string, k bigint, v string")
    sinks.merge(spark, seed, t, ["store", "k"], "b0")
    batch = spark.createDataFrame([("0050", 1, "A"), ("0050", 4, "d")],
                                  "store string, k bigint, v string")
    sinks.merge(spark, batch, t, ["store", "k"], "b1")
    got = sorted((r["store"], r["k"], r["v"]) for r in spark.table(t.name).collect())
    assert got == [("0050", 1, "A"), ("0050", 4, "d"), ("007", 3, "c"), ("50", 2, "b")]
    parts = sorted(r[0] for r in spark.sql(f"SHOW PARTITIONS {t.name}").collect())
    assert parts == ["store=0050", "store=007", "store=50"]


def test_partition_scoped_merge_prunes_the_target_scan(spark, ws, monkeypatch):
    t = _target(ws, "pp", ["region"])
    seed = spark.createDataFrame([(r, i, "v") for i, r in enumerate(["eu", "us", "apac", "latam"])],
                                 "region string, k bigint, v string")
    sinks.merge(spark, seed, t, ["region", "k"], "b0")
    plans = []
    real_union = type(seed).unionByName

    def spy(self, other, *a, **kw):
        out = real_union(self, other, *a, **kw)
        plans.append(out)
        return out

    monkeypatch.setattr(type(seed), "unionByName", spy)
    batch = spark.createDataFrame([("eu", 0, "w")], "region string, k bigint, v string")
    sinks.merge(spark, batch, t, ["region", "k"], "b1")
    monkeypatch.undo()
    import contextlib, io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        plans[-1].explain("formatted")
    scans = [ln for ln in buf.getvalue().splitlines() if ln.startswith("PartitionFilters")]
    assert scans and all("eu" in ln for ln in scans)  # only the touched partition is listed


def test_partition_scoped_merge_with_a_null_partition_value(spark, ws):
    t = _target(ws, "pn", ["region"])
    seed = spark.createDataFrame([("eu", 1, "a"), ("us", 2, "b")], "region string, k bigint, v string")
    sinks.merge(spark, seed, t, ["region", "k"], "b0")
    batch = spark.createDataFrame([(None, 3, "n"), ("eu", 1, "A")], "region string, k bigint, v string")
    sinks.merge(spark, batch, t, ["region", "k"], "b1")  # full snapshot instead
    got = sorted((r["region"] or "-", r["k"], r["v"]) for r in spark.table(t.name).collect())
    assert got == [("-", 3, "n"), ("eu", 1, "A"), ("us", 2, "b")]


def test_bucketed_merge_with_partitions_and_a_new_column(spark, ws):
    from feedline.operators import tables

    t = _target(ws, "bp", ["day"])  # partition column is not a merge key: full snapshot
    seed = spark.createDataFrame([(1, "a", "d1"), (2, "b", "d1"), (3, "c", "d2")],
                                 "k bigint, v string, day string")
    sinks.merge(spark, seed, t, ["k"], "b0")
    assert tables.bucket_spec(spark, t.name) == (["k"], 8)
    batch = spark.createDataFrame([(2, "B", "d3", "x"), (4, "d", "d1", "y")],
                                  "k bigint, v string, day string, extra string")
    sinks.merge(spark, batch, t, ["k"], "b1")  # key 2 moves from d1 to d3; a column is added
    got = sorted((r["k"], r["v"], r["day"], r["extra"]) for r in spark.table(t.name).collect())
    assert got == [(1, "a", "d1", None), (2, "B", "d3", "x"), (3, "c", "d2", None),
                   (4, "d", "d1", "y")]
    assert tables.bucket_spec(spark, t.name) == (["k"], 8)
    assert tables.partition_columns(spark, t.name) == ["day"]
    sinks.merge(spark, batch, t, ["k"], "b1")  # replay changes nothing
    assert spark.table(t.name).count() == 4


def test_merge_buckets_an_unbucketed_target_on_its_next_rewrite(spark, ws):
    from feedline.operators import tables

    t = _target(ws, "ub")
    from pyspark.sql import types as T
    tables.create_table(spark, t.name, T._parse_datatype_string(T_SCHEMA), [],
                        tables.new_snapshot_dir(t.location, "x"))
    spark.createDataFrame([(1, "a", "b0"), (2, "b", "b0")], T_SCHEMA).write.insertInto(t.name)
    assert tables.bucket_spec(spark, t.name) is None  # e.g. created before bucketing
    batch = spark.createDataFrame([(2, "B"), (3, "c")], "k bigint, v string")
    sinks.merge(spark, batch, t, ["k"], "b1")
    assert tables.bucket_spec(spark, t.name) == (["k"], 8)
    got = sorted((r["k"], r["v"]) for r in spark.table(t.name).collect())
    assert got == [(1, "a"), (2, "B"), (3, "c")]


T_SCHEMA = "k bigint, v string, _batch_id string"


def test_bucketed_merge_when_a_key_is_also_a_partition_column(spark, ws):
    from feedline.operators import tables

    t = _target(ws, "kp", ["day", "region"])  # not all partition columns are keys
    seed = spark.createDataFrame([(1, "d1", "eu", "a"), (2, "d1", "us", "b")],
                                 "id bigint, day string, region string, v string")
    sinks.merge(spark, seed, t, ["id", "day"], "b0")
    batch = spark.createDataFrame([(1, "d1", "apac", "A"), (3, "d2", "eu", "c")],
                                  "id bigint, day string, region string, v string")
    sinks.merge(spark, batch, t, ["id", "day"], "b1")
    got = sorted((r["id"], r["day"], r["region"], r["v"]) for r in spark.table(t.name).collect())
    assert got == [(1, "d1", "apac", "A"), (2, "d1", "us", "b"), (3, "d2", "eu", "c")]
    assert tables.bucket_spec(spark, t.name) is None  # a key is a partition column: not bucketed


def test_merge_bucket_count_from_the_session_setting(spark, ws):
    from feedline.operators import tables

    t = _target(ws, "bc")
    spark.conf.set(sinks.MERGE_BUCKETS_CONF, "3")
    try:
        sinks.merge(spark, spark.createDataFrame([(1, "a")], "k bigint, v string"), t, ["k"], "b0")
    finally:
        spark.conf.unset(sinks.MERGE_BUCKETS_CONF)
    assert tables.bucket_spec(spark, t.name) == (["k"], 3)
    sinks.merge(spark, spark.createDataFrame([(1, "b")], "k bigint, v string"), t, ["k"], "b1")
    assert tables.bucket_spec(spark, t.name) == (["k"], 3)  # the table keeps its count
    assert [(r["k"], r["v"]) for r in spark.table(t.name).collect()] == [(1, "b")]

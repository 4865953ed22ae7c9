"""Batches of one large file: their rows are dealt over tasks, and a first batch is not kept in memory."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedline.operators.transforms import MERGE_TASKS, dealt, latest_per_key


def test_the_rows_of_one_task_are_dealt_before_they_are_sorted(spark):
    """One task's 20,000 rows: a third of one key, some without a key, two versions of the rest."""
    i = F.col("id")
    key = F.when(i % 3 == 0, 7).when(i % 1000 == 1, None).otherwise(100 + i % 5000)
    rows = spark.range(0, 20000, 1, 1).select(key.alias("k"), i.alias("v"))
    spread = dealt(rows)
    latest = latest_per_key(spread, ["k"]).select("k", "v")
    assert spread.rdd.getNumPartitions() >= MERGE_TASKS
    most = spread.select(F.spark_partition_id().alias("p")).groupBy("p").count().agg(F.max("count")).first()[0]
    assert most < 1000
    got = [tuple(r) for r in latest.collect()]
    expected, solo = {}, []
    for n, k in ((r["v"], r["k"]) for r in rows.collect()):
        if k is None:
            solo.append((None, n))
        else:
            expected[k] = n
    assert sorted(x for x in got if x[0] is not None) == sorted(expected.items())
    assert sorted(x[1] for x in got if x[0] is None) == [n for _, n in solo]


def test_a_first_batch_is_written_without_being_kept(spark, ws, tmp_path, monkeypatch):
    from feedline.plans.registry import Registry
    from feedline.streaming.runner import Runner
    from feedline.suite import _landing, _single_feed

    raw = _single_feed(spark, ws, Registry(ws), "n", "parquet", "*.parquet")
    spark.range(100).withColumn("s", F.lit("x")).repartition(3).write.parquet(raw)

    def kept(*_):
        raise AssertionError("the batch is kept")

    for name in ("persist", "cache"):
        monkeypatch.setattr(DataFrame, name, kept, raising=False)
        monkeypatch.setattr(type(spark.range(1)), name, kept)
    result = Runner(ws).run_operation("op_n")
    assert (result.status, result.rows_written) == ("SUCCESS", 100)
    assert _landing(spark, ws, "n").count() == 100

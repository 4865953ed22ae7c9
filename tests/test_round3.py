"""Findings of round 3."""

import os
import time

from pyspark.sql import functions as F


def test_throttled_feed_has_three_batches_of_bounded_files(spark, tmp_path, monkeypatch):
    from feedline import suite

    rows = [("R" if i % 3 else "N", "O", float(i), i) for i in range(100)]
    spark.createDataFrame(rows, "l_returnflag string, l_linestatus string, l_quantity double, l_orderkey long").write.parquet(f"{tmp_path}/lineitem.parquet")
    assert [suite._throttled_files(n) for n in (0, 600_000, 6_000_000, 6_000_001, 36_000_000)] == [6, 6, 6, 12, 36]
    monkeypatch.setattr(suite, "THROTTLED_FILE_ROWS", 10)
    roots = []
    monkeypatch.setattr(suite, "_new", lambda spark, new=suite._new: roots.append(new(spark)) or roots[-1])
    got = {r["l_returnflag"]: (r["n"], r["batches"]) for r in suite.ingest_throttled(spark, str(tmp_path)).collect()}
    assert got == {"R": (66, 3), "N": (34, 3)}
    raw = spark.read.parquet(f"{roots[0][0].root}/raw/lineitem").groupBy(F.input_file_name()).count()
    assert raw.count() == 12 and raw.agg(F.max("count")).first()[0] <= 10


def test_xml_feed_of_a_large_table_has_few_files(spark, tmp_path, monkeypatch):
    from feedline import suite

    assert [suite._xml_parts(n) for n in (0, 20_000, 100_000, 200_000, 1_200_000, 10**9)] == [500, 500, 2500, 5000, 30_000, 60_000]
    columns = ["id p_partkey", "concat('part ', id) p_name", "'b' p_brand", "cast(id % 50 as int) p_size", "1.5D p_retailprice"]
    spark.range(1, 2001).selectExpr(*columns).write.parquet(f"{tmp_path}/part.parquet")
    sizes = []
    monkeypatch.setattr(suite, "_xml_parts", lambda n: sizes.append(n) or 1000)
    roots = []
    monkeypatch.setattr(suite, "_new", lambda spark, new=suite._new: roots.append(new(spark)) or roots[-1])
    got = suite.ingest_xml(spark, str(tmp_path)).agg(F.count("*"), F.sum("_id"), F.sum("p_size"), F.countDistinct("p_name")).first()
    assert sizes == [2000] and tuple(got) == (2000, 2001000, 49000, 2000)
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt").load(f"{roots[0][0].root}/raw/part")
    assert raw.count() == 3


def _shuffle_files(spark):
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for d in dirs for _, _, files in os.walk(d) for f in files if f.startswith("shuffle_")}


def test_written_leaves_no_shuffle_files(spark):
    from feedline.llm.shared import written

    before = _shuffle_files(spark)
    made = written(spark.range(1000, numPartitions=4).groupBy((F.col("id") % 7).alias("k")).count(), "counts")
    deadline = time.time() + 10
    while _shuffle_files(spark) - before and time.time() < deadline:
        time.sleep(0.2)
    assert not _shuffle_files(spark) - before
    assert made.count() == 7


def test_decontamination_cuts_only_documents_with_a_prefix_place_again(spark):
    from feedline.llm import decontamination

    item = " ".join(f"w{i}" for i in range(13))
    docs = spark.createDataFrame([(1, f"a {item} b"), (1, f"a {item} b"), (2, "w0 w1 w2"), (3, None), (None, item), (4, item[:-1])], "doc_id long, text string")
    found = decontamination.contamination(docs, spark.createDataFrame([(7, item)], "item_id long, text string"))
    assert "LeftSemi" in found._jdf.queryExecution().optimizedPlan().toString()
    got = {(r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in found.collect()}
    assert got == {(1, 15, 13, ("7",)), (2, 3, 0, ()), (3, 0, 0, ()), (None, 13, 13, ("7",)), (4, 13, 0, ())}

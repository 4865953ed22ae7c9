"""The registered queries and the pipeline's stages on the smallest tables."""

import random


def test_every_operator_is_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op") and n[2:3].isdigit()) == list(range(1, 14))
    assert "pipeline" in names and {"op1_decontamination", "op3_url_rules", "op10_line_dedup"} <= set(entry.oracle_sql())


def test_stages_keep_columns_and_take_effect(spark, tmp_path):
    import corpus_pipeline as pipeline

    r = random.Random(11)
    good = [f"w{k}" for k in range(400)]
    text = lambda n=120: "\n".join(" ".join(r.choice(good) for _ in range(20)) for _ in range(n // 20))
    texts = [text() for _ in range(40)]
    passage = " ".join(f"p{k}" for k in range(60))
    near = texts[0].split()
    near[50] = "changed"
    item = " ".join(f"b{k}" for k in range(14))
    rows = list(enumerate(texts)) + [(100, " ".join(near)), (101, texts[1]), (102, text() + "\n" + passage), (103, text() + "\n" + passage), (104, item + " " + text(40)), (105, "too short"), (106, None)]
    docs = spark.createDataFrame([(i, t, "en", None, len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    d = str(tmp_path)
    docs.write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(30)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    kept = {}
    for k, (name, stage) in enumerate(pipeline.STAGES):
        out = stage(spark, docs, d)
        if k < len(pipeline.STAGES) - 1:
            assert out.columns == docs.columns
        out.write.parquet(f"{d}/{name}")
        docs = spark.read.parquet(f"{d}/{name}")
        kept[name] = {x["doc_id"]: x for x in docs.collect()}
    assert not {105, 106} & kept["quality"].keys() and set(range(40)) <= kept["quality"].keys()
    assert 101 not in kept["lines"] and passage in kept["lines"][102]["text"] and passage not in kept["lines"][103]["text"]
    assert kept["lines"][103]["n_chars"] == len(kept["lines"][103]["text"])
    assert 100 not in kept["near_duplicates"] and 0 in kept["near_duplicates"]
    assert 104 not in kept["contamination"] and set(range(40)) <= kept["contamination"].keys()
    assert kept["tokens"].keys() == kept["contamination"].keys()
    assert sorted(x["doc_id"] for x in pipeline.run(spark, d).collect()) == sorted(kept["tokens"])


def test_stages_pass_odd_rows_and_names(spark, tmp_path):
    import corpus_pipeline as pipeline

    item = " ".join(f"b{k}" for k in range(14))
    rows = [(1, "one two three four five six", "x"), (1, "one two three four five six", "y"), (2, "one two three four five six", None),
            (3, "a b c d e f g", "z"), (3, "h i j k l m n", "z"), (None, item, None), (None, "q r s t u v w", None), (4, None, "n"), (5, item, "i"), (5, "", "i")]
    extra = ["n", "least", "key", "row", "bad_id", "bad_mark", "component_id"]
    names = ["doc_id", "text", "source", *extra]
    docs = spark.createDataFrame([(*r, *["e"] * len(extra)) for r in rows], "doc_id long, text string, source string, " + ", ".join(f"{c} string" for c in extra))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    single = pipeline.near_duplicates(spark, docs, str(tmp_path))
    assert single.columns == names
    assert sorted(((r["doc_id"], r["text"]) for r in single.collect()), key=repr) == sorted(
        [(1, rows[0][1]), (3, rows[3][1]), (None, item), (None, rows[6][1]), (4, None), (5, "")], key=repr)
    clean = pipeline.decontaminate(spark, docs, str(tmp_path))
    assert clean.columns == names
    assert sorted(((r["doc_id"], r["text"]) for r in clean.collect()), key=repr) == sorted([r[:2] for r in rows if r[1] != item], key=repr)
    for stage in (pipeline.near_duplicates, pipeline.decontaminate):
        empty = stage(spark, docs.limit(0), str(tmp_path))
        assert empty.columns == names and empty.count() == 0

"""What a reader cannot place is found again in ``_rescued_data``."""

import json
import os

from feedline.streaming.runner import Runner
from feedline.suite import _landing, _new, _single_feed


def land(spark, files, fmt, waves=None, **kw):
    ws, reg = _new(spark, "t")
    raw = _single_feed(spark, ws, reg, "f", fmt, "*", **kw)
    local = raw.removeprefix("file://")
    os.makedirs(local)
    for wave in waves or [files]:
        for name, text in wave.items():
            with open(f"{local}/{name}", "w", encoding="utf-8") as f:
                f.write(text)
        assert Runner(ws).run_operation("op_f").status == "SUCCESS"
    return _landing(spark, ws, "f")


def test_csv_surplus_tokens_with_headers(spark):
    rows = land(spark, {"a.csv": 'a,b\n1,2\n3,4,EXTRA\n5\n"x,y",6\n7,8,,far\n', "b.csv": "b,a,c\n9,10,11\n12,13,14,15\n"}, "csv")
    got = {r["a"]: (r["b"], r["_rescued_data"] and json.loads(r["_rescued_data"])) for r in rows.collect()}
    assert got == {"1": (2, None), "3": (4, {"_corrupt_record": "3,4,EXTRA"}), "5": (None, None), "x,y": (6, None), "7": (8, {"_corrupt_record": "7,8,,far"}), "10": (9, None), "13": (12, {"_corrupt_record": "12,13,14,15"})}


def test_malformed_json_is_kept_and_adds_no_column(spark):
    rows = land(spark, {"a.json": '{"a": 1, "b": "0050"}\n{bad\n{"a": 2.50, "b": 12345678.90}\n'}, "jsonl")
    assert [c for c in rows.columns if "corrupt" in c] == []
    got = sorted(((r["a"], r["b"], r["_rescued_data"]) for r in rows.collect()), key=str)
    assert got == [(1.0, "0050", None), (2.5, "12345678.90", None), (None, None, '{"_corrupt_record":"{bad"}')]


def test_json_values_that_do_not_fit_a_tracked_type(spark):
    rows = land(spark, None, "jsonl", waves=[{"a.json": '{"k": 1, "n": 5}\n'}, {"b.json": '{"k": 2, "n": "five"}\n{"k": 3, "n": 7}\n'}])
    assert sorted((r["k"], r["n"], r["_rescued_data"]) for r in rows.collect() if r["n"]) == [(1, 5, None), (3, 7, None)]
    assert [r["_rescued_data"] for r in rows.where("k = 2").collect()] == ['{"n":"five"}']


def test_malformed_record_of_an_exploded_feed(spark):
    rows = land(spark, {"a.json": '{"id": 1, "events": [{"e": "x"}, {"e": "y"}]}\n{broken\n{"id": 2, "events": []}\n'}, "jsonl", explode_key="events")
    assert sorted(((r["e"], r["_rescued_data"]) for r in rows.collect()), key=str) == [("x", None), ("y", None), (None, '{"_corrupt_record":"{broken"}')]


def test_multiline_json_arrays_and_xml(spark):
    rows = land(spark, {"a.json": '[{"a": 1}, {"a": 2}]', "b.json": '{"a": }'}, "json", multiline=True)
    assert sorted((str(r["a"]), r["_rescued_data"]) for r in rows.collect()) == [("1", None), ("2", None), ("None", '{"_corrupt_record":"{\\"a\\": }"}')]
    rows = land(spark, {"a.xml": '<r><o id="1"><v>0050</v></o><o id="2"><v>x</v><w>3</w></o></r>'}, "xml", source_kw={"row_tag": "o"})
    assert sorted((r["_id"], r["v"], r["w"]) for r in rows.collect()) == [(1, "0050", None), (2, "x", 3)]


def test_parquet_types_that_clash(spark):
    ws, reg = _new(spark, "t")
    raw = _single_feed(spark, ws, reg, "f", "parquet", "*.parquet")
    for frame in (spark.createDataFrame([(1, 5)], "k bigint, v int"), spark.createDataFrame([(2, 2.5)], "k bigint, v double"), spark.createDataFrame([(3, "x", "n")], "k bigint, v string, w string")):
        frame.coalesce(1).write.mode("append").parquet(raw)
    assert Runner(ws).run_operation("op_f").status == "SUCCESS"
    assert sorted((r["k"], r["v"], r["w"]) for r in _landing(spark, ws, "f").collect()) == [(1, "5", None), (2, "2.5", None), (3, "x", "n")]

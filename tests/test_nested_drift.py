"""Drift inside nested values: rows are never lost, values land in a column or in
_rescued_data."""

import json
import os

from feedline import suite
from feedline.plans.registry import Registry
from feedline.streaming.runner import Runner


def _jsonl(path, records):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join(json.dumps(r) for r in records) + "\n")


WAVE1 = [{"export_id": "X1", "events": [{"event_id": "e1", "type": "view"},
                                        {"event_id": "e2", "type": "cart"}]}]
WAVE2 = [{"export_id": "X2", "events": [{"event_id": "e3", "type": "view", "page": "/home"}]}]


def _feed(spark, ws, raw, mode, explode="events"):
    suite._register(spark, Registry(ws), [suite._source("src", raw, "*.jsonl", "jsonl"),
                                          suite._target("tgt", ws, "t")],
                    [suite._operation("op", "src", "tgt", explode_key=explode,
                                      schema_evolution_mode=mode)])
    return Runner(ws)


def test_exploded_feed_gains_a_field(spark, ws, tmp_path):
    raw = str(tmp_path / "c")
    runner = _feed(spark, ws, raw, "addNewColumns")
    _jsonl(f"{raw}/a.jsonl", WAVE1)
    assert runner.run_operation("op").rows_written == 2
    _jsonl(f"{raw}/b.jsonl", WAVE2)
    assert runner.run_operation("op").rows_written == 1
    rows = {r["event_id"]: r for r in spark.table(ws.table(ws.catalog, "bronze", "t")).collect()}
    assert set(rows) == {"e1", "e2", "e3"}
    assert rows["e3"]["page"] == "/home" and rows["e1"]["page"] is None


def test_exploded_feed_frozen_schema_rescues(spark, ws, tmp_path):
    raw = str(tmp_path / "c")
    runner = _feed(spark, ws, raw, "rescue")
    _jsonl(f"{raw}/a.jsonl", WAVE1)
    runner.run_operation("op")
    _jsonl(f"{raw}/b.jsonl", WAVE2)
    res = runner.run_operation("op")
    assert res.rows_written == 1 and res.rescued_rows == 1
    t = spark.table(ws.table(ws.catalog, "bronze", "t"))
    assert "page" not in t.columns
    e3 = t.where("event_id = 'e3'").first()
    rescued = json.loads(e3["_rescued_data"])  # values are kept as text
    assert json.loads(rescued["events"])[0]["page"] == "/home"


def test_struct_column_widens_in_place(spark, ws, tmp_path):
    raw = str(tmp_path / "s")
    runner = _feed(spark, ws, raw, "addNewColumns", explode=None)
    _jsonl(f"{raw}/a.jsonl", [{"id": 1, "addr": {"city": "Oslo"}}])
    runner.run_operation("op")
    _jsonl(f"{raw}/b.jsonl", [{"id": 2, "addr": {"city": "Lima", "zip": "15001"}}])
    runner.run_operation("op")
    t = spark.table(ws.table(ws.catalog, "bronze", "t"))
    got = {r["id"]: (r["addr"]["city"], r["addr"]["zip"]) for r in t.collect()}
    assert got == {1: ("Oslo", None), 2: ("Lima", "15001")}

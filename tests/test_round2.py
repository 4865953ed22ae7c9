"""Faults found by review: delimiters, blank first lines, odd file names, writes to the registry."""

import uuid

import pytest

from feedline.sources.headers import _parse_header, delimiter_text
from feedline.suite import _operation, _source, _target


def test_delimiters_are_used_whole():
    assert _parse_header('a||"b||c"||d', "||") == ["a", "b||c", "d"]
    assert _parse_header("a\tb", "\\t") == ["a", "b"] and delimiter_text("\\t") == "\t"
    assert _parse_header("a,b,,a", ",") == ["a", "b", "_c2", "a1"] and _parse_header("a||", "||") == ["a", "_c1"]


def _land(spark, ws, files, **source):
    """Lands some CSV files, as strings, and returns the rows."""
    from feedline.plans.registry import Registry
    from feedline.streaming.runner import Runner

    folder = f"{ws.root}/raw-{uuid.uuid4().hex[:6]}"
    import os
    local = folder.removeprefix("file://")
    os.makedirs(local)
    for name, text in files.items():
        with open(f"{local}/{name}", "w", encoding="utf-8") as f:
            f.write(text)
    objects = [
        {"object_id": "src", "object_type": "source", "source_format": "cloudFiles", "file_format": "csv", "file_path": folder, "file_glob": None, **source},
        {"object_id": "tgt", "object_type": "target", "target_catalog": ws.catalog, "target_schema": "s", "target_table": "t"},
    ]
    operations = [{"operation_id": "op", "source_object_id": "src", "target_object_id": "tgt", "load_type": "append", "schema_evolution_mode": "addNewColumns", "cast_all_as_string": True, "enabled": True}]
    reg = Registry(ws)
    names = lambda rows, schema: spark.createDataFrame([tuple(r.get(f.name) for f in schema.fields) for r in rows], schema)
    reg.publish(names(objects, reg.objects().schema), names(operations, reg.operations().schema))
    Runner(ws).run_operation("op")
    return spark.table(ws.table(ws.catalog, "s", "t"))


def test_files_with_odd_names_and_blank_first_lines_land_once(spark, ws):
    rows = _land(spark, ws, {"r[1].csv": "a,b\n1,x\n", "r1.csv": "a,b\n2,y\n", "a b.csv": "\n\na,b\n3,z\n", "{c}*.csv": "b,a\nw,4\n"})
    assert sorted((r["a"], r["b"]) for r in rows.collect()) == [("1", "x"), ("2", "y"), ("3", "z"), ("4", "w")]


def test_two_character_delimiter(spark, ws):
    rows = _land(spark, ws, {"f.csv": "a||b||c\n1||x||\n2||y||q\n"}, delimiter="||")
    assert sorted((r["a"], r["b"], r["c"]) for r in rows.collect()) == [("1", "x", None), ("2", "y", "q")]


def test_registry_write_keeps_added_columns_and_rejects_repeated_ids(spark, ws):
    from feedline.plans.registry import Registry

    reg = Registry(ws)
    reg.ensure_column("operation", "owner", "string")
    schema = reg.operations().schema
    objects = [_source("src", "/raw", "*.csv", "csv"), _target("tgt", ws, "t")]
    objects = spark.createDataFrame([tuple(o.get(f.name) for f in reg.objects().schema.fields) for o in objects], reg.objects().schema)
    one = lambda i: tuple({**_operation(i, "src", "tgt"), "owner": "me"}.get(f.name) for f in schema.fields)
    reg.upsert_bundles(objects, spark.createDataFrame([one("a"), one("b")], schema))
    assert {r["operation_id"]: r["owner"] for r in reg.operations().collect()} == {"a": "me", "b": "me"}
    with pytest.raises(ValueError, match="more than once"):
        reg.upsert_bundles(objects, spark.createDataFrame([one("c"), one("c")], schema))


def test_a_published_table_is_never_absent(spark, ws, monkeypatch):
    from feedline.operators import tables
    from feedline.operators.sinks import publish_snapshot

    name = ws.table(ws.catalog, ws.metadata_schema, "pub")
    publish_snapshot(spark, name, spark.range(3), f"{ws.root}/pub")

    def broken(*args, **kwargs):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(tables, "create_table", broken)
    publish_snapshot(spark, name, spark.range(5), f"{ws.root}/pub")
    assert spark.table(name).count() == 5

"""Registry writes: refused bundles leave both tables as they were, writers do not mix, a crash is completed."""

import pytest
from pyspark.sql import functions as F

from feedline.plans.registry import OBJECT_SCHEMA, OPERATION_SCHEMA, Registry, RegistryConflict, _nullable
from feedline.suite import _operation, _source, _target
from feedline.suite_recovery import RunDied, dies_at


def frames(spark, ws, ids, **op):
    objects = [o for i in ids for o in (_source(f"src_{i}", f"/raw/{i}", "*.csv", "csv"), _target(f"tgt_{i}", ws, i))]
    operations = [_operation(f"op_{i}", f"src_{i}", f"tgt_{i}", **op) for i in ids]
    make = lambda rows, schema: spark.createDataFrame([tuple(r.get(f) for f in schema.fieldNames()) for r in rows], _nullable(schema))
    return make(objects, OBJECT_SCHEMA), make(operations, OPERATION_SCHEMA)


def state(reg):
    return sorted(r[0] for r in reg.objects().select("object_id").collect()), sorted(map(str, reg.operations().select("operation_id", "load_type", "enabled").collect()))


def test_refused_writes_leave_both_tables(spark, ws):
    reg = Registry(ws)
    reg.upsert_bundles(*frames(spark, ws, ["a", "b"]), mode="create")
    before = state(reg)
    objects, operations = frames(spark, ws, ["c"])
    for rows, message in ((operations.withColumn("operation_id", F.lit("9 bad")), "operation_id"), (operations.withColumn("load_type", F.lit("bogus")), "load_type"),
                          (operations.withColumn("source_object_id", F.lit("nowhere")), "source_object_id"), (operations.withColumn("load_type", F.lit("merge")), "merge_keys")):
        with pytest.raises(ValueError, match=message):
            reg.upsert_bundles(objects, rows)
        assert state(reg) == before
    with pytest.raises(ValueError, match="already registered: op_b"):
        reg.upsert_bundles(*frames(spark, ws, ["b", "d"]), mode="create")
    with pytest.raises(ValueError, match="not registered: op_d"):
        reg.upsert_bundles(*frames(spark, ws, ["b", "d"]), mode="update")
    assert state(reg) == before
    reg.upsert_bundles(*frames(spark, ws, ["b"], load_type="overwrite"), mode="update")
    assert "overwrite" in str(state(reg)) and len(state(reg)[1]) == 2


def test_an_old_issue_does_not_block_other_writes(spark, ws):
    reg = Registry(ws)
    objects, operations = frames(spark, ws, ["a"], load_type="bogus")
    reg.publish(objects, operations)
    reg.upsert_bundles(*frames(spark, ws, ["b"]))
    assert len(state(reg)[1]) == 2


@pytest.mark.parametrize("step", ["registry written", "registry committed", "object shown", "operation shown"])
def test_a_writer_that_dies(spark, ws, step):
    reg = Registry(ws)
    reg.upsert_bundles(*frames(spark, ws, ["a"]))
    with pytest.raises(RunDied), dies_at(step):
        reg.upsert_bundles(*frames(spark, ws, ["b"]))
    fresh = Registry(ws)
    fresh.recover()
    objects, operations = state(fresh)
    assert (len(objects), len(operations)) == ((2, 1) if step == "registry written" else (4, 2))


def test_two_writers(spark, ws, monkeypatch):
    reg, other = Registry(ws), Registry(ws)
    reg.upsert_bundles(*frames(spark, ws, ["a"]))
    real = Registry._commit

    def late(self, log, written):
        monkeypatch.setattr(Registry, "_commit", real)
        other.upsert_bundles(*frames(spark, ws, ["b"]))
        return real(self, log, written)

    monkeypatch.setattr(Registry, "_commit", late)
    with pytest.raises(RegistryConflict):
        reg.upsert_bundles(*frames(spark, ws, ["c"]))
    assert len(state(reg)[1]) == 2
    reg.upsert_bundles(*frames(spark, ws, ["c"]))
    assert len(state(reg)[1]) == 3
    reg.set_enabled("op_a", False)
    assert {r["operation_id"]: r["enabled"] for r in reg.operations().collect()} == {"op_a": False, "op_b": True, "op_c": True}

"""Evolution modes and rescue, plus a property test: no value is lost."""

import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from feedline.operators.schema import SchemaDriftError, conform, evolve

TRACKED = T.StructType([T.StructField("id", T.StringType()), T.StructField("qty", T.LongType())])


def _raw(spark, rows, cols):
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols))


def test_add_new_columns(spark):
    raw = _raw(spark, [("a", "1", "x")], ["id", "qty", "extra"])
    target, rescue = evolve(raw, TRACKED, "addNewColumns", False)
    assert target.fieldNames() == ["id", "qty", "extra"] and rescue == []
    row = conform(raw, target, rescue).first()
    assert row["qty"] == 1 and row["extra"] == "x" and row["_rescued_data"] is None


@pytest.mark.parametrize("mode", ["rescue", "none"])
def test_frozen_modes_rescue_new_columns(spark, mode):
    raw = _raw(spark, [("a", "1", "x")], ["id", "qty", "extra"])
    target, rescue = evolve(raw, TRACKED, mode, False)
    assert target.fieldNames() == ["id", "qty"] and rescue == ["extra"]
    row = conform(raw, target, rescue).first()
    assert json.loads(row["_rescued_data"]) == {"extra": "x"}


def test_fail_on_new_columns(spark):
    raw = _raw(spark, [("a", "1", "x")], ["id", "qty", "extra"])
    with pytest.raises(SchemaDriftError):
        evolve(raw, TRACKED, "failOnNewColumns", False)
    # no new column: no failure
    ok = _raw(spark, [("a", "1")], ["id", "qty"])
    assert evolve(ok, TRACKED, "failOnNewColumns", False)[0] == TRACKED


def test_type_mismatch_is_rescued_and_missing_is_null(spark):
    raw = _raw(spark, [("a", "12"), ("b", "2.5"), ("c", "abc"), ("d", None)], ["id", "qty"])
    target, rescue = evolve(raw, TRACKED, "none", False)
    rows = {r["id"]: r for r in conform(raw, target, rescue).collect()}
    assert rows["a"]["qty"] == 12 and rows["a"]["_rescued_data"] is None
    assert rows["b"]["qty"] is None and json.loads(rows["b"]["_rescued_data"]) == {"qty": "2.5"}
    assert json.loads(rows["c"]["_rescued_data"]) == {"qty": "abc"}
    assert rows["d"]["qty"] is None and rows["d"]["_rescued_data"] is None
    only_id = _raw(spark, [("e",)], ["id"])
    assert conform(only_id, target, []).first()["qty"] is None


def test_cast_all_as_string(spark):
    raw = spark.createDataFrame([(1, 2.5, True)], "a bigint, b double, c boolean")
    target, _ = evolve(raw, None, "addNewColumns", True)
    assert all(isinstance(f.dataType, T.StringType) for f in target.fields)
    assert conform(raw, target, []).first().asDict()["b"] == "2.5"


def test_case_insensitive_match(spark):
    raw = _raw(spark, [("a", "3")], ["ID", "Qty"])
    target, rescue = evolve(raw, TRACKED, "rescue", False)
    assert rescue == [] and conform(raw, target, rescue).first()["qty"] == 3


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.integers(-10**12, 10**12).map(str),
                          st.text(alphabet="abc.-0123456789 ", min_size=1, max_size=6)),
                min_size=1, max_size=12))
def test_no_value_is_lost(spark, values):
    """Every non-null input value is in its column or, as written, in _rescued_data."""
    rows = [(str(i), v, f"x{i}") for i, v in enumerate(values)]
    raw = _raw(spark, rows, ["id", "qty", "extra"])
    target, rescue = evolve(raw, TRACKED, "rescue", False)
    for (i, v, extra), out in zip(rows, sorted(conform(raw, target, rescue).collect(),
                                               key=lambda r: int(r["id"]))):
        rescued = json.loads(out["_rescued_data"]) if out["_rescued_data"] else {}
        assert rescued.get("extra") == extra
        if v is not None:
            assert out["qty"] is not None or rescued.get("qty") == v
            if out["qty"] is not None:
                assert int(v.strip()) == out["qty"]


def test_tracked_schema_history_is_append_only(spark, ws):
    from pyspark.sql import types as T
    from feedline.plans.registry import Registry

    reg = Registry(ws)
    assert reg.tracked_schema("op", 0) is None  # nothing saved yet
    first = T.StructType([T.StructField("a", T.LongType())])
    second = T.StructType(first.fields + [T.StructField("b", T.StringType())])
    reg.save_tracked_schema("op", 0, first)
    reg.save_tracked_schema("op", 0, second)
    reg.save_tracked_schema("op", 1, first)  # a reset starts a new generation
    assert reg.tracked_schema("op", 0) == second  # the newest wins
    assert reg.tracked_schema("op", 1) == first
    assert reg.tracked_schema("other", 0) is None
    assert spark.table(reg.name("schema_history")).count() == 3  # nothing overwritten

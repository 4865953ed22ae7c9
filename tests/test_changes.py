"""The feed of a table's changes: batches in order, planned once, read from what was staged; replacements after a reset."""

import pytest

from feedline.operators import sinks
from feedline.streaming.changes import ChangeFeed


def _target(ws, name):
    ws.ensure_database(ws.catalog, "bronze")
    return sinks.Target(ws.table(ws.catalog, "bronze", name), ws.table_location(ws.catalog, "bronze", name), [])


def _taken(feed):
    out = []
    for b in feed.batches():
        out.append((b.number, b.replaces, sorted(r["k"] for r in b.rows.collect())))
        b.done()
    return out


def test_batches_of_an_append_table_come_once_and_in_order(spark, ws, tmp_path):
    t = _target(ws, "a")
    put = lambda k, token: sinks.append(spark, spark.createDataFrame([(k,)], "k bigint"), t, token)
    for n in (9, 10, 2):
        put(n, f"op-g0-b{n}")
    feed = ChangeFeed(spark, t.name, str(tmp_path / "f"), None, False, limit=2)
    assert _taken(feed) == [(0, False, [2, 9]), (1, False, [10])]
    put(10, "op-g0-b10")  # its producer delivers a batch again
    assert _taken(feed) == []
    put(11, "op-g0-b11")
    given = next(feed.batches())  # the run dies here: the batch is not marked as done
    put(12, "op-g0-b12")
    assert (given.number, _taken(feed)) == (2, [(2, False, [11]), (3, False, [12])])
    spark.sql(f"DROP TABLE {t.name}")
    with pytest.raises(ValueError, match="does not exist"):
        _taken(feed)
    put(5, "op-g1-b0")
    assert _taken(feed) == [(4, True, [5])] and _taken(feed) == []


def test_a_merging_reader_gets_the_staged_batches_and_others_the_version(spark, ws, tmp_path):
    t = _target(ws, "m")

    def merge(rows, *numbers):
        for n in numbers:
            sinks.stage(spark, spark.createDataFrame(rows, "k bigint, v string"), t, f"op-g0-b{n}", lambda: False)
        sinks.merge_staged(spark, t, ["k"])

    merge([(1, "a"), (2, "b")], 0)
    keyed, other = (ChangeFeed(spark, t.name, str(tmp_path / str(k)), t.log(spark), k) for k in (True, False))
    assert _taken(keyed) == _taken(other) == [(0, False, [1, 2])]
    merge([(2, "B")], 1)
    merge([(3, "c")], 2)
    given = next(keyed.batches())
    assert {f.split("/")[-3] for f in given.rows.inputFiles()} == {"_staged"}  # neither snapshot is read
    assert _taken(keyed) == [(1, False, [2, 3])] and _taken(other) == [(1, True, [1, 2, 3])]
    assert _taken(keyed) == _taken(other) == []
    t.log(spark).write("reset")
    spark.sql(f"DROP TABLE {t.name}")
    merge([(7, "z")], 3)
    assert _taken(keyed) == _taken(other) == [(2, True, [7])]


def test_a_replacement_takes_the_place_of_one_operations_rows(spark, ws):
    t = _target(ws, "r")
    frame = lambda rows: spark.createDataFrame(rows, "k bigint, _operation_id string")
    sinks.merge(spark, frame([(1, "x"), (2, "y"), (None, "x"), (3, None)]), t, ["k"], "x-g0-b0")
    sinks.stage(spark, frame([(9, "x")]), t, "x-g0-b1", lambda: False)  # of a run that died, older than the replacement
    sinks.stage(spark, frame([(5, "x")]), t, "x-g0-b2", lambda: False)
    for _ in range(2):  # the second finds nothing that waits
        sinks.merge_staged(spark, t, ["k"], replaces=("x", "x-g0", 2))
        assert {(r["k"], r["_operation_id"]) for r in spark.table(t.name).collect()} == {(2, "y"), (3, None), (5, "x")}
    a = _target(ws, "ra")
    for token in ("x-g0-b1", "x-g0-b2", "x-g1-b0", "xx-g0-b1"):
        sinks.append(spark, frame([(1, token)]), a, token)
    sinks.drop_batches_before(spark, a, "x-g1-b0", "x")
    assert {r["_operation_id"] for r in spark.table(a.name).collect()} == {"x-g1-b0", "xx-g0-b1"}

"""A fault at every step of a commit, then a retry, gives the rows of a run without faults; readers see the old or the new version."""

import pytest
from pyspark.sql import functions as F

from feedline.operators import commits, sinks, tables
from feedline.suite_recovery import RunDied, dies_at

STEPS = ["snapshot written", "before commit", "committed", "pointed", "shown"]


def _target(ws, name, parts=()):
    ws.ensure_database(ws.catalog, "bronze")
    return sinks.Target(ws.table(ws.catalog, "bronze", name), ws.table_location(ws.catalog, "bronze", name), list(parts))


def _rows(df):
    return sorted(map(str, df.drop("_batch_id").collect()))


@pytest.mark.parametrize("step", STEPS)
def test_merge_dies_at_each_step(spark, ws, step):
    t = _target(ws, "m")
    seed = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n1")], "k bigint, v string")
    batch = spark.createDataFrame([(2, "B"), (3, "c"), (None, "n2")], "k bigint, v string")
    old = ["(1, 'a')", "(2, 'b')", "(None, 'n1')"]
    new = ["(1, 'a')", "(2, 'B')", "(3, 'c')", "(None, 'n1')", "(None, 'n2')"]
    shown = lambda df: sorted(str((r["k"], r["v"])) for r in df.collect())
    sinks.merge(spark, seed, t, ["k"], "op-g0-b0")
    with pytest.raises(RunDied), dies_at(step):
        sinks.merge(spark, batch, t, ["k"], "op-g0-b1")
    after = shown(spark.table(t.name))
    assert after in (old, new) and shown(t.log(spark).read()) in (old, new)
    sinks.merge(spark, batch, t, ["k"], "op-g0-b1")
    assert shown(spark.table(t.name)) == new == shown(t.log(spark).read())
    sinks.merge(spark, batch, t, ["k"], "op-g0-b1")  # also NULL-key rows are not added again
    assert shown(spark.table(t.name)) == new


@pytest.mark.parametrize("step", ["snapshot written", "committed", "partitions added", "partition moved", "shown"])
def test_scoped_and_widened_merge_dies_at_each_step(spark, ws, step):
    t = _target(ws, "w", ["p"])
    keys = ["p", "k"]
    frame = lambda rows, who: spark.createDataFrame(rows, f"p string, k bigint, who struct<{who}>")
    sinks.merge(spark, frame([("0050", 1, ("a",)), ("us", 2, ("b",)), ("x y", 3, ("c",))], "name:string"), t, keys, "op-g0-b0")
    sinks.merge(spark, frame([("0050", 1, ("A",)), ("x y", 4, ("d",))], "name:string"), t, keys, "op-g0-b1")
    wider = frame([("0050", 5, ("e", "E")), ("new", 6, ("f", "F"))], "name:string, tag:string")
    with pytest.raises(RunDied), dies_at(step):
        sinks.merge(spark, wider, t, keys, "op-g0-b2")
    assert {r["p"] for r in spark.table(t.name).collect()} >= {"0050", "us", "x y"}
    sinks.merge(spark, wider, t, keys, "op-g0-b2")
    want = [("0050", 1, "A", None), ("0050", 5, "e", "E"), ("new", 6, "f", "F"), ("us", 2, "b", None), ("x y", 3, "c", None), ("x y", 4, "d", None)]
    flat = lambda df: sorted((r["p"], r["k"], r["who"]["name"], r["who"]["tag"]) for r in df.collect())
    assert flat(spark.table(t.name)) == want == flat(t.log(spark).read())


def test_a_lost_entry_is_recovered_and_not_seeded_over(spark, ws):
    t = _target(ws, "l", ["day"])
    sinks.merge(spark, spark.createDataFrame([(1, "d1"), (2, "d2")], "k bigint, day string"), t, ["k"], "op-g0-b0")
    spark.sql(f"DROP TABLE {t.name}")
    sinks.merge(spark, spark.createDataFrame([(3, "d1")], "k bigint, day string"), t, ["k"], "op-g0-b1")
    assert sorted(r["k"] for r in spark.table(t.name).collect()) == [1, 2, 3]


def test_partitioned_and_retyped_targets_are_replaced_whole(spark, ws, monkeypatch):
    t = _target(ws, "p", ["day"])
    sinks.overwrite(spark, spark.createDataFrame([(1, "d1")], "k bigint, day string"), t, "op-g0-b0", {})
    seen = []
    real = tables.create_table

    def spy(session, name, *args, **kwargs):
        seen.append((name, session.table(t.name).count()))
        return real(session, name, *args, **kwargs)

    monkeypatch.setattr(tables, "create_table", spy)
    sinks.overwrite(spark, spark.createDataFrame([("x", "d2"), ("y", "d3")], "k string, day string"), t, "op-g1-b0", {})
    assert seen and all(name != t.name and n == 1 for name, n in seen)  # the old version is there while the new entry is made
    assert sorted(r["k"] for r in spark.table(t.name).collect()) == ["x", "y"]


@pytest.mark.parametrize("step,occurrence", [("committed", 1), ("pointed", 1), ("evolved", 1), ("inserted", 1), ("inserted", 2)])
def test_three_batch_overwrite_is_taken_up_again(spark, ws, step, occurrence):
    t = _target(ws, "o")
    batches = [spark.createDataFrame([(i, None if i < 2 else "w")], "k bigint, w string") if i else spark.createDataFrame([(0,)], "k bigint") for i in range(3)]
    sinks.overwrite(spark, spark.createDataFrame([(99,)], "k bigint"), t, "op-g0-b0", {})
    t.log(spark).close()

    def run(start):
        state = {"resume": True}
        for i in range(start, 3):
            at[0] = i
            sinks.overwrite(spark, batches[i], t, f"op-g0-b{i + 1}", state)
        t.log(spark).close()

    at = [0]
    with pytest.raises(RunDied), dies_at(step, occurrence):
        run(0)
    run(at[0])  # the stream delivers the batch that failed again
    assert sorted(r["k"] for r in spark.table(t.name).collect()) == [0, 1, 2]
    sinks.overwrite(spark, spark.createDataFrame([(7,)], "k bigint"), t, "op-g0-b9", {"resume": True})
    assert [r["k"] for r in spark.table(t.name).collect()] == [7]  # a closed snapshot is replaced


def test_one_rewrite_for_all_batches_of_a_run(spark, ws):
    t = _target(ws, "s")
    for i, (v, extra) in enumerate([("a", None), ("b", None), ("c", "x")]):
        df = spark.createDataFrame([(1, v), (10 + i, v), (None, v)], "k bigint, v string")
        df = df.withColumn("extra", F.lit(extra)) if extra else df
        sinks.stage(spark, df, t, f"op-g0-b{i}", lambda: False)
        sinks.stage(spark, df, t, f"op-g0-b{i}", lambda: False)  # a batch delivered twice counts once
    sinks.merge_staged(spark, t, ["k"])
    log = t.log(spark)
    assert log.rows().where("kind = 'merge'").count() == 1
    assert sorted(r["v"] for r in spark.table(t.name).where("k IS NULL").collect()) == ["a", "b", "c"]
    assert {(r["k"], r["v"]) for r in spark.table(t.name).where("k IS NOT NULL").collect()} == {(1, "c"), (10, "a"), (11, "b"), (12, "c")}
    sinks.merge_staged(spark, t, ["k"])
    sinks.stage(spark, spark.createDataFrame([(None, "c")], "k bigint, v string"), t, "op-g0-b2", lambda: False)
    sinks.merge_staged(spark, t, ["k"])  # delivered again after its merge: not kept again
    assert spark.table(t.name).count() == 7


def test_two_writers_of_one_version(spark, ws):
    one, other = (commits.CommitLog(spark, ws.table(ws.catalog, "bronze", "z"), f"{ws.root}/z") for _ in range(2))
    one.refresh()
    other.refresh()
    assert one.write("stage", token="a") == 1
    with pytest.raises(Exception, match="(?i)exist"):
        other.write("stage", token="b")
    assert other.write("stage", token="b") == 2  # it has read the log again

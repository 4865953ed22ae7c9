"""Circles of feeds and the order of a run, compared with a search over all pairs."""

import random

import pytest

from feedline.plans import deps


def _reach(edges):
    found = set(edges)
    while True:
        more = {(a, d) for a, b in found for c, d in edges if b == c} - found
        if not more:
            return found
        found |= more


def _expected(nodes, edges):
    edges, opened = {e for e in edges if e[0] != e[1]}, set()
    while True:
        reach = _reach(edges)
        circles = {a: min(b for b in nodes if (a, b) in reach and (b, a) in reach) for a in nodes if (a, a) in reach}
        if not circles:
            break
        opened |= set(circles.values())
        edges = {(c, p) for c, p in edges if not (circles.get(c) == c and circles.get(p) == c)}
    waves = {}
    while len(waves) < len(nodes):
        ready = [n for n in nodes if n not in waves and all(p in waves for c, p in edges if c == n)]
        waves |= {n: 1 + max((waves[p] for c, p in edges if c == n), default=-1) for n in ready}
    return {n: (waves[n], n in opened) for n in nodes}


def _frames(spark, nodes, edges):
    return (spark.createDataFrame([(n,) for n in nodes], "operation_id string"),
            spark.createDataFrame(list(edges), "consumer string, producer string"))


def _waves(spark, nodes, edges):
    return {r["operation_id"]: (r["wave"], r["opens_cycle"]) for r in deps.dependency_waves(*_frames(spark, nodes, edges)).collect()}


def test_consumers_behind_a_cycle_follow_their_producers(spark):
    edges = [("a", "b"), ("b", "a"), ("aa", "b"), ("y", "z"), ("a", "y"), ("z", "z")]
    assert _waves(spark, ["a", "b", "aa", "z", "y"], edges) == {"z": (0, False), "y": (1, False), "a": (2, True), "b": (3, False), "aa": (4, False)}


def test_no_feeds_and_no_edges(spark):
    assert _waves(spark, [], []) == {}
    assert _waves(spark, ["a", "b"], []) == {"a": (0, False), "b": (0, False)}
    assert deps.circles(_frames(spark, [], [])[1]).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_waves_equal_a_search_over_all_pairs(spark, seed):
    r = random.Random(seed)
    nodes = [f"n{i:02d}" for i in range(14)]
    edges = {(r.choice(nodes), r.choice(nodes)) for _ in range(20)}
    reach = _reach({e for e in edges if e[0] != e[1]})
    expected = {a: min(b for b in nodes if (a, b) in reach and (b, a) in reach) for a in nodes if (a, a) in reach}
    assert expected
    assert {x["operation_id"]: x["component"] for x in deps.circles(_frames(spark, nodes, edges)[1]).collect()} == expected
    assert _waves(spark, nodes, edges) == _expected(nodes, edges)


def test_circles_behind_each_other_are_found_in_two_rounds(spark, monkeypatch):
    """Circles of three, each reading the one before: one round tells them apart, one finds them."""
    nodes = [f"n{c}{x}" for c in range(5) for x in range(3)]
    edges = [(f"n{c}{x}", f"n{c}{(x + 1) % 3}") for c in range(5) for x in range(3)] + [(f"n{c}0", f"n{c - 1}1") for c in range(1, 5)]
    rounds, real = [], deps._least_ends
    monkeypatch.setattr(deps, "_least_ends", lambda left: rounds.append(1) or real(left))
    found = {x["operation_id"]: x["component"] for x in deps.circles(_frames(spark, nodes, edges)[1]).collect()}
    assert found == {n: f"{n[:2]}0" for n in nodes}
    assert len(rounds) <= 2


def test_a_level_reads_only_the_edges_that_wait(spark, monkeypatch):
    """A star whose edges all go in the first round, and a chain: no round writes the star's edges again."""
    leaves, chain = [f"leaf{i:02d}" for i in range(40)], [f"chain{i}" for i in range(6)]
    edges = [(leaf, "chain0") for leaf in leaves] + list(zip(chain[1:], chain, strict=False))
    written, real = [], deps._kept

    def kept(df):
        rows = real(df)
        written.append(rows.count())
        return rows

    monkeypatch.setattr(deps, "_kept", kept)
    levels = {r["operation_id"]: r["level"] for r in deps.dependency_levels(*_frames(spark, leaves + chain, edges)).collect()}
    assert levels == {leaf: 1 for leaf in leaves} | {c: i for i, c in enumerate(chain)}
    assert sum(written) < 4 * len(edges)


def test_waves_wait_for_ever_for_an_unknown_producer(spark):
    waves = {r["operation_id"]: (r["wave"], r["opens_cycle"]) for r in deps.dependency_waves(*_frames(spark, ["a", "b"], [("a", "gone")])).collect()}
    assert waves == {"a": (None, False), "b": (0, False)}

"""Dependencies between feeds (J3) and their order.

A table-sourced operation consumes the landing table another enabled
operation produces.  Edges are an equi self-join of the resolved registry;
levels are computed on the cluster by rounds of joins (one per level of the
DAG) over the edges that still wait, each round's tables written to the
shared folder, which cuts the lineage.
Circles are found by rounds of joins as well, so a run's order is a table.
"""

from __future__ import annotations

import uuid
import warnings
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedline.plans.registry import TABLE_SOURCES
from feedline.workspace import shared_root


def dependency_edges(resolved: DataFrame) -> DataFrame:
    """(consumer, producer, table_name) among enabled operations; self-loops excluded."""
    enabled = resolved.where(F.col("enabled") == F.lit(True))
    consumers = enabled.where(F.col("source_format").isin(*TABLE_SOURCES)).select(
        F.col("operation_id").alias("consumer"), F.col("source_file_path").alias("table_name"))
    producers = enabled.where(F.col("fq_table").isNotNull()).select(
        F.col("operation_id").alias("producer"), F.col("fq_table").alias("table_name"))
    return (consumers.join(producers, "table_name")
            .where(F.col("consumer") != F.col("producer"))
            .select("consumer", "producer", "table_name"))


def _kept(df: DataFrame) -> DataFrame:
    """The rows of ``df`` from a table in the shared folder: computed once, with no lineage.

    The shuffle files of the write are deleted at its end and not when the driver next collects its garbage."""
    spark = df.sparkSession
    path = f"{shared_root(spark)}/order-{uuid.uuid4().hex}"
    conf, key = spark.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key, None)
    conf.set(key, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.unset(key) if before is None else conf.set(key, before)
    return spark.read.schema(df.schema).parquet(path)


def dependency_levels(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(operation_id, level): 0 for operations without producers, else 1 + the highest
    level of their producers; NULL for operations blocked by a cycle.

    A round reads the edges that still wait and no others: those of the operations that got a level last go, and a
    consumer all of whose edges are gone has the next level."""
    nodes = nodes.select("operation_id").distinct()
    own = nodes.select(F.col("operation_id").alias("consumer"))
    waiting = _kept(edges.select("consumer", "producer").distinct().join(own, "consumer", "left_semi"))
    ready = _kept(nodes.where("operation_id IS NOT NULL")
                  .join(waiting.select(F.col("consumer").alias("operation_id")), "operation_id", "left_anti"))
    assigned, level = ready.select("operation_id", F.lit(0).alias("level")), 0
    while not ready.isEmpty():  # one round per level: every round but the last assigns at least one operation
        gone = ready.select(F.col("operation_id").alias("producer"), F.lit(True).alias("gone"))
        marked = _kept(waiting.join(gone, "producer", "left").select("consumer", "producer", F.coalesce("gone", F.lit(False)).alias("gone")))
        ready = _kept(marked.groupBy(F.col("consumer").alias("operation_id")).agg(F.min("gone").alias("free"))
                      .where("free").select("operation_id"))
        waiting = marked.where("NOT gone").select("consumer", "producer")
        level += 1
        assigned = assigned.unionByName(ready.select("operation_id", F.lit(level).alias("level")))
    return nodes.join(assigned, "operation_id", "left")


def circles(edges: DataFrame) -> DataFrame:
    """(operation_id, component): the operations that wait for themselves through others.  Two of them have the
    same ``component``, the smallest id among them, if each waits for the other.

    Each round finds for every operation the smallest id that it waits for and the smallest that waits for it, itself
    included.  Where both are one id, the operation and that id wait for each other, and the id is their
    component's smallest.  Components found leave; edges between operations with different smallest ids are in no
    circle and leave too.  The rounds go over numbers in the order of the ids.
    Every table has at most one row for each operation, or two for each edge."""
    left = _trimmed(edges.select("consumer", "producer").where("consumer <> producer").distinct())
    numbered = _numbered(left)
    for end in ("consumer", "producer"):
        left = left.join(numbered.withColumnsRenamed({"operation_id": end, "number": f"{end}_n"}), end)
    left = _kept(left.select(F.col("consumer_n").alias("consumer"), F.col("producer_n").alias("producer")))
    found = numbered.select("number", F.col("number").alias("component_n")).where("false")
    while not left.isEmpty():
        named = _least_ends(left)
        alone = named.where("ahead = behind").select(F.col("number"), F.col("ahead").alias("component_n"))
        several = alone.groupBy("component_n").count().where("count > 1").select("component_n")
        found = found.unionByName(_kept(alone.join(several, "component_n", "left_semi").select(*found.columns)))
        rest = left
        for end in ("consumer", "producer"):
            rest = rest.join(named.where("ahead <> behind").withColumnsRenamed(
                {"number": end, "ahead": f"{end}_ahead", "behind": f"{end}_behind"}), end)
        rest = rest.where("consumer_ahead = producer_ahead AND consumer_behind = producer_behind")
        left = _trimmed(rest.select("consumer", "producer"))
    component = numbered.withColumnsRenamed({"operation_id": "component", "number": "component_n"})
    return found.join(numbered, "number").join(component, "component_n").select("operation_id", "component")


def _trimmed(edges: DataFrame) -> DataFrame:
    """The edges without those before or behind all circles: a consumer nobody reads or a producer that waits for nobody."""
    edges = _kept(edges)
    n = edges.count()
    while n:
        consumers = edges.select(F.col("consumer").alias("producer")).distinct()
        producers = edges.select(F.col("producer").alias("consumer")).distinct()
        edges = _kept(edges.join(consumers, "producer", "left_semi").join(producers, "consumer", "left_semi"))
        before, n = n, edges.count()
        if n == before:
            break
    return edges


def _numbered(edges: DataFrame) -> DataFrame:
    """(operation_id, number): the operations with numbers in the order of their ids."""
    ids = edges.select(F.explode(F.array("consumer", "producer")).alias("operation_id")).distinct()
    return _kept(ids.orderBy("operation_id").select("operation_id", F.monotonically_increasing_id().alias("number")))


def _least_ends(edges: DataFrame) -> DataFrame:
    """(number, ahead, behind): the smallest number among an operation and all that it directly or indirectly waits for,
    and among it and all that directly or indirectly wait for it."""
    ways = F.explode(F.array(F.struct(F.col("consumer").alias("number"), F.col("producer").alias("of"), F.lit(True).alias("forward")),
                             F.struct(F.col("producer").alias("number"), F.col("consumer").alias("of"), F.lit(False).alias("forward"))))
    ways = _kept(edges.select(ways.alias("w")).select("w.*"))
    both = F.col("number")
    named = ways.groupBy("number").agg(F.min(F.when(F.col("forward"), F.col("of"))).alias("a"), F.min(F.when(~F.col("forward"), F.col("of"))).alias("b"))
    named = _kept(named.select("number", F.least(both, "a").alias("ahead"), F.least(both, "b").alias("behind"),
                               F.coalesce(F.col("a") < both, F.lit(False)).alias("new_ahead"), F.coalesce(F.col("b") < both, F.lit(False)).alias("new_behind")))
    while True:  # only numbers that became smaller are passed on
        changed = named.where("new_ahead OR new_behind").withColumnRenamed("number", "of")
        if changed.isEmpty():
            return named.select("number", "ahead", "behind")
        passed = ways.join(changed, "of").where("CASE WHEN forward THEN new_ahead ELSE new_behind END")
        passed = passed.groupBy("number").agg(F.min(F.when(F.col("forward"), F.col("ahead"))).alias("a"),
                                              F.min(F.when(~F.col("forward"), F.col("behind"))).alias("b"))
        named = named.select("number", "ahead", "behind").join(passed, "number", "left")
        named = _kept(named.select("number", F.least("ahead", "a").alias("ahead"), F.least("behind", "b").alias("behind"),
                                   F.coalesce(F.col("a") < F.col("ahead"), F.lit(False)).alias("new_ahead"),
                                   F.coalesce(F.col("b") < F.col("behind"), F.lit(False)).alias("new_behind")))


def dependency_waves(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(operation_id, wave, opens_cycle): every operation with the run's wave that it belongs to.

    Producers are in earlier waves than their consumers.  Operations that read each other in a circle have no
    such order: of each circle the one with the smallest id does not wait for the others of its circle
    (``opens_cycle``), and what is still a circle then is opened likewise.  Operations behind a circle
    wait for all their producers."""
    edges = _kept(edges.select("consumer", "producer").where("consumer <> producer").distinct())
    opened = edges.select(F.col("consumer").alias("operation_id")).where("false")
    ids = nodes.select("operation_id").distinct()
    inside = edges
    for end in ("consumer", "producer"):
        inside = inside.join(ids.withColumnRenamed("operation_id", end), end, "left_semi")
    while True:
        found = _kept(circles(inside))
        if found.isEmpty():
            break
        ends = [found.withColumnsRenamed({"operation_id": end, "component": f"{end}_component"}) for end in ("consumer", "producer")]
        inside = _kept(inside.join(ends[0], "consumer").join(ends[1], "producer").where("consumer_component = producer_component")
                       .select("consumer", "producer", (F.col("consumer") == F.col("consumer_component")).alias("cut")))
        edges = _kept(edges.join(inside.where("cut"), ["consumer", "producer"], "left_anti"))
        inside = inside.where("NOT cut").select("consumer", "producer")  # what is still a circle is within one that was opened
        opened = opened.unionByName(found.where("operation_id = component").select("operation_id"))
    opens = opened.distinct().withColumn("opens_cycle", F.lit(True))
    return (dependency_levels(nodes, edges).withColumnRenamed("level", "wave").join(opens, "operation_id", "left")
            .select("operation_id", "wave", F.coalesce("opens_cycle", F.lit(False)).alias("opens_cycle")))


def run_waves(registry) -> Iterator[list[tuple[str, str]]]:
    """The enabled operations' (operation_id, target table), wave by wave, ordered by id.  The order is computed on the
    cluster; only the wave that starts next comes to the driver."""
    resolved = registry.resolve_operations(enabled_only=True).select(
        "operation_id", "enabled", "source_format", "source_file_path", "fq_table").checkpoint()
    waves = dependency_waves(resolved, dependency_edges(resolved))
    plan = resolved.select("operation_id", "fq_table").join(waves, "operation_id").checkpoint()
    opened = plan.where("opens_cycle").agg(F.count("*").alias("n"), F.min("operation_id").alias("least")).first()
    if opened["n"]:
        warnings.warn(f"feeds read each other in circles: {opened['n']} started without all their producers, the first is "
                      f"{opened['least']}", RuntimeWarning, stacklevel=2)
    last = plan.agg(F.max("wave")).first()[0]
    for wave in range(-1 if last is None else last + 1):
        rows = plan.where(F.col("wave") == wave).orderBy("operation_id").collect()
        yield [(r["operation_id"], r["fq_table"]) for r in rows]

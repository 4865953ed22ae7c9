"""Prefix trie of conversations by fixed-length block digests (operator 11).

A node of the trie is a distinct sequence of the first ``d`` turns.  A turn at depth ``d`` has a 128-bit digest of its depth, role and
text; the digest of a block of ``BLOCK`` turns, and the key of a prefix, is the exclusive-or of its turns' digests, so keys
of prefixes follow from those of blocks by a running exclusive-or.

1. Conversations are grouped by the key before a block and the block's digest: one row for each distinct block under each
   parent, with its members counted and its smallest member.  From here on the work is by distinct blocks.
2. Turn boundaries are refined where siblings diverge: under a parent with several blocks, the prefixes of its
   distinct blocks are grouped into nodes.  Under a parent with one block nothing diverges, and all its turns are nodes
   with the members of the block.
3. Sums over subtrees: what a node adds is given to its smallest member, and summed from the last to the first block along that
   conversation.  A node's sum is that of its members, again by distinct blocks.

A conversation is never gathered: turns are numbered by a range partitioning on conversation and turn, and running sums go
by segments of ``SEGMENT`` blocks, whose totals are carried over.  Groups (equal prefixes) are counts and minima, combined
before the shuffle.  The digest of a node's ids is one SHA-256 over all of them; ids are sorted and written out in chunks
of at most ``CHUNK``, which are hashed one after the other.  The key of a parent is joined by a shuffle, whose skewed parts
the adaptive planner splits; the root, everyone's parent, needs no join.

Defined cases: a null role or text is empty; a null turn comes first; rows with equal turns are ordered by a digest of role and
text; repeated rows are turns of their own; rows with a null ``conv_id`` have no number to be rebuilt from, and are left out; ids below
zero take the remainder of their sign; other columns are ignored, whatever their names; an empty table has no conversation
and so no root: the result is empty.  Texts of any length are read whole, and only their digests are moved.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedline.llm.shared import small, written

#: Turns of a block, blocks of a segment of running sums, ids of a chunk.
BLOCK, SEGMENT, CHUNK = 4, 4096, 1 << 16

# ---------------------------------------------------------------- turns and their places


def turns_of(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, key, words``: digest of role and text, and words of the text, of each row with a conversation."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    key = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    return rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), key.alias("key"), words.alias("words")).where("conv_id IS NOT NULL")


def placed(turns: DataFrame) -> DataFrame:
    """``conv_id, pos, total, key, words``: the turns with their place (from 0) and the number of turns of their conversation."""
    ordered = turns.withColumn("copy", F.monotonically_increasing_id()).repartitionByRange("conv_id", "turn", "key", "copy")
    ordered = ordered.sortWithinPartitions("conv_id", "turn", "key", "copy").select("conv_id", "key", "words", F.monotonically_increasing_id().alias("at"))
    ordered = written(ordered.withColumn("part", F.shiftright("at", 33)), "turns")
    parts = ordered.groupBy("conv_id", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    own = W.partitionBy("conv_id")
    offset = F.coalesce(F.sum("n").over(own.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("conv_id", "part", (F.col("first") - offset).alias("zero"), F.sum("n").over(own).alias("total"))
    return ordered.join(parts, ["conv_id", "part"]).select("conv_id", (F.col("at") - F.col("zero")).alias("pos"), "total", "key", "words")


def _digests(rows: DataFrame) -> DataFrame:
    """Adds ``za`` and ``zb``, the digest of the turn at its depth."""
    return rows.withColumns({"za": F.xxhash64("depth", "key"), "zb": F.xxhash64(F.lit("b"), "key", "depth")}).drop("key")


def whole(rows: DataFrame) -> DataFrame:
    """The turns of conversations as they are: ``conv_id, depth, size, key, words`` (see ``prefix_trie``)."""
    return placed(turns_of(rows)).select("conv_id", (F.col("pos") + 1).alias("depth"), F.col("total").alias("size"), "key", "words")


def rebuilt(rows: DataFrame) -> DataFrame:
    """As ``whole``, each conversation ``c`` with the first ``h`` turns of conversation ``c - c % 20`` before its own from the ``h``-th on;
    ``h`` is the checksum of ``c`` modulo 4.  A conversation without turns has one row of depth 0."""
    turns = written(placed(turns_of(rows)), "placed-turns")
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4).alias("h")
    sizes = turns.where("pos = 0").select("conv_id", "total", h, (F.col("conv_id") - F.col("conv_id") % 20).alias("base"))
    bases = sizes.select(F.col("conv_id").alias("base"), F.col("total").alias("n_base"))
    sizes = sizes.join(bases, "base", "left").withColumn("lead", F.least("h", F.coalesce("n_base", F.lit(0))))
    sizes = written(sizes.select("conv_id", "base", "h", "lead", (F.col("lead") + F.greatest(F.col("total") - F.col("h"), F.lit(0))).alias("size")), "rebuilt-sizes")
    # The bases' first turns: at most three, taken over by at most twenty conversations.
    lent = turns.where("pos < 3").select(F.col("conv_id").alias("base"), "pos", "key", "words")
    led = sizes.join(lent, "base").where("pos < h").select("conv_id", (F.col("pos") + 1).alias("depth"), "size", "key", "words")
    own = turns.select("conv_id", "pos", "total", "key", "words", h).where("pos >= h")
    own = _with_sizes(own, sizes).select("conv_id", (F.col("lead") + F.col("pos") - F.col("h") + 1).alias("depth"), "size", "key", "words")
    bare = sizes.where("size = 0").select("conv_id", F.lit(0).cast("long").alias("depth"), "size", F.lit(None).cast("string").alias("key"), F.lit(0).cast("long").alias("words"))
    return led.unionByName(own).unionByName(bare)


def _with_sizes(own: DataFrame, sizes: DataFrame) -> DataFrame:
    """``own`` with ``lead`` and ``size`` of its conversation.  Turns beyond the first segment, which only long conversations have, meet
    the few sizes of such conversations, spread by segment; so no conversation is one task's."""
    step = BLOCK * SEGMENT
    slim = sizes.select("conv_id", "lead", "size")
    near = own.where(F.col("pos") < step).join(slim, "conv_id")
    spread = slim.where(F.col("size") > step - 3).withColumn("segment", F.explode(F.sequence(F.lit(1), (F.col("size") / step).cast("int") + 1)))
    far = own.where(F.col("pos") >= step).withColumn("segment", (F.col("pos") / step).cast("int")).join(spread, ["conv_id", "segment"]).drop("segment")
    return near.unionByName(far)


# ---------------------------------------------------------------- running values along conversations


def _running(rows: DataFrame, columns: list[str], fold: str, forward: bool) -> DataFrame:
    """Adds ``run_<c>``: the fold (``xor`` or ``sum``) of ``c`` over the conversation's blocks before each row's (or, backward, behind it)."""
    agg, zero, both = (F.bit_xor, F.lit(0).cast("long"), lambda a, b: a.bitwiseXOR(b)) if fold == "xor" else (F.sum, F.lit(0).cast("long"), lambda a, b: a + b)
    order = (lambda c: F.col(c).asc()) if forward else (lambda c: F.col(c).desc())
    rows = rows.withColumn("segment", (F.col("block") / SEGMENT).cast("long"))
    earlier = lambda of, key: F.coalesce(agg(of).over(W.partitionBy(*key[:-1]).orderBy(order(key[-1])).rowsBetween(W.unboundedPreceding, -1)), zero)
    here = rows.withColumns({f"run_{c}": earlier(c, ["conv_id", "segment", "block"]) for c in columns})
    totals = rows.where(F.col("size") > BLOCK * SEGMENT).groupBy("conv_id", "segment").agg(*[agg(c).alias(c) for c in columns])
    carried = small(written(totals.select("conv_id", "segment", *[earlier(c, ["conv_id", "segment"]).alias(f"carry_{c}") for c in columns]), "carried"))
    joined = here.join(carried, ["conv_id", "segment"], "left")
    return joined.withColumns({f"run_{c}": both(F.col(f"run_{c}"), F.coalesce(f"carry_{c}", zero)) for c in columns}).drop("segment", *[f"carry_{c}" for c in columns])


# ---------------------------------------------------------------- trie

_KIND = ["block", "before_a", "before_b", "a", "b"]
_NODE = ["depth", "ka", "kb"]


def _prefix(n: Column, z: str) -> Column:
    """The exclusive-or of digest ``z`` of a block's first ``n`` turns."""
    return F.aggregate(F.slice("turns", F.lit(1), n), F.lit(0).cast("long"), lambda acc, t: acc.bitwiseXOR(t[z]))


def _boundaries(kinds: DataFrame, values: list[str], sums: dict[str, str] | None = None) -> DataFrame:
    """One row for each turn of each distinct block: node key, parent key, and columns.  ``sums`` names arrays by place in the block."""
    turns = F.transform(
        F.sequence(F.lit(1), F.size("turns")),
        lambda j: F.struct(
            F.element_at("turns", j)["depth"].alias("depth"),
            *[F.col(f"before_{x}").bitwiseXOR(_prefix(j, f"z{x}")).alias(f"k{x}") for x in "ab"],
            *[F.col(f"before_{x}").bitwiseXOR(_prefix(j - 1, f"z{x}")).alias(f"p{x}") for x in "ab"],
            F.element_at("turns", j)["words"].alias("words"),
            *[(F.aggregate(F.slice(c, j, F.lit(BLOCK)), F.lit(0).cast("long"), lambda acc, x: acc + x)).alias(name) for name, c in (sums or {}).items()],
        ),
    )
    return kinds.select(F.explode(turns).alias("t"), *values).select("t.*", *values)


def _refined(kinds: DataFrame, diverging: DataFrame, values: list[str], folds: dict[str, Column], sums: dict[str, str] | None = None) -> DataFrame:
    """Nodes of distinct blocks: grouped where siblings diverge, as they are where a parent has one block."""
    on = _KIND[:3]
    apart = _boundaries(kinds.join(diverging, on, "left_semi"), values, sums)
    once = ["pa", "pb", "words"]
    grouped = apart.groupBy(*_NODE).agg(*[F.first(c).alias(c) for c in once], *[f.alias(c) for c, f in folds.items()])
    return grouped.unionByName(_boundaries(kinds.join(diverging, on, "left_anti"), values, sums))


def prefix_trie(turns: DataFrame) -> DataFrame:
    """The nodes of the trie of conversations, from the turns of ``rebuilt`` or ``whole``: ``conv_id`` (smallest member), ``depth``,
    ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``."""
    turns = _digests(turns)
    block = ((F.col("depth") - 1) / BLOCK).cast("long").alias("block")
    listed = F.array_sort(F.collect_list(F.struct("depth", "za", "zb", "words")))
    blocks = turns.where("depth > 0").groupBy("conv_id", block).agg(F.bit_xor("za").alias("a"), F.bit_xor("zb").alias("b"), F.max("size").alias("size"), listed.alias("turns"))
    chained = _running(written(blocks, "blocks"), ["a", "b"], "xor", True).withColumnsRenamed({"run_a": "before_a", "run_b": "before_b"})
    chained = written(chained, "chained-blocks")
    kinds = written(chained.groupBy(*_KIND).agg(F.count("*").alias("n"), F.min("conv_id").alias("conv_id"), F.first("turns").alias("turns")), "distinct-blocks")
    diverging = small(written(kinds.groupBy(*_KIND[:3]).count().where("count > 1").drop("count"), "diverging"))

    bare = turns.where("depth = 0").select("conv_id", *[F.lit(0).cast("long").alias(c) for c in _NODE])
    last = chained.where(F.col("block") == ((F.col("size") - 1) / BLOCK).cast("long"))
    ends = written(bare.unionByName(last.select("conv_id", F.col("size").alias("depth"), *[F.col(f"before_{x}").bitwiseXOR(F.col(x)).alias(f"k{x}") for x in "ab"])), "ends")
    root = ends.agg(F.count("*").alias("n"), F.min("conv_id").alias("conv_id")).first()
    nothing = F.lit(None).cast("long")
    top = ends.agg(F.count("*").alias("n"), F.min("conv_id").alias("conv_id")).where("n > 0")
    top = top.select(*[F.lit(0).cast("long").alias(c) for c in _NODE], nothing.alias("pa"), nothing.alias("pb"), F.lit(0).cast("long").alias("words"), "n", "conv_id")
    nodes = _refined(kinds, diverging, ["n", "conv_id"], {"n": F.sum("n"), "conv_id": F.min("conv_id")})
    nodes = written(nodes.unionByName(top), "nodes")

    children = written(nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("pa").alias("ka"), F.col("pb").alias("kb")).agg(F.count("*").alias("n_children")), "children")
    leaves = nodes.join(children, _NODE, "left_anti").select("conv_id", "depth", F.lit(0).cast("long").alias("saved"), F.lit(1).cast("long").alias("leaf"))
    shared = nodes.where("n > 1 AND words > 0").select("conv_id", "depth", ((F.col("n") - 1) * F.col("words")).alias("saved"), F.lit(0).cast("long").alias("leaf"))
    added = leaves.unionByName(shared).where("depth > 0")
    place = (F.col("depth") - 1) % BLOCK
    at = [F.sum(F.when(place == j, F.col("saved")).otherwise(0)).alias(f"s{j}") for j in range(BLOCK)]
    added = added.groupBy("conv_id", block).agg(*at, F.sum("leaf").alias("leaf"))
    zero = F.lit(0).cast("long")
    own = [F.coalesce(c, zero).alias(c) for c in [f"s{j}" for j in range(BLOCK)] + ["leaf"]]
    along = chained.select("conv_id", "size", *_KIND).join(added, ["conv_id", "block"], "left").select("conv_id", "size", *_KIND, *own)
    along = _running(along.withColumn("saved", reduce(Column.__add__, [F.col(f"s{j}") for j in range(BLOCK)])), ["saved", "leaf"], "sum", False)
    along = along.groupBy(*_KIND).agg(*[F.sum(f"s{j}").alias(f"s{j}") for j in range(BLOCK)], F.sum("run_saved").alias("behind"), F.sum(F.col("leaf") + F.col("run_leaf")).alias("n_leaves"))
    along = kinds.select(*_KIND, "turns").join(along, _KIND).withColumn("saved", F.array(*[F.col(f"s{j}") for j in range(BLOCK)]))
    # What lies in the block from a turn on, and behind the block.
    sums = _refined(
        along, diverging, ["behind", "n_leaves"], {"saved": F.sum("saved"), "behind": F.sum("behind"), "n_leaves": F.sum("n_leaves")}, {"saved": "saved"}
    ).select(*_NODE, (F.col("saved") + F.col("behind")).alias("saved_tokens"), "n_leaves")
    sums = written(sums, "subtrees")
    # The root's sums are those of the nodes under it.
    first = nodes.where("depth = 1").select(*_NODE).join(sums, _NODE).agg(F.sum("saved_tokens").alias("saved_tokens"), F.sum("n_leaves").alias("n_leaves"))
    first = first.select(*[zero.alias(c) for c in _NODE], F.coalesce("saved_tokens", zero).alias("saved_tokens"), F.coalesce("n_leaves", F.lit(1).cast("long")).alias("n_leaves"))

    sha = end_digests(ends)
    parts = [nodes.select(*_NODE, "pa", "pb", "n", "conv_id"), children, sums.unionByName(first), sha]
    names = {"pa": "long", "pb": "long", "n": "long", "conv_id": "long", "n_children": "long", "saved_tokens": "long", "n_leaves": "long", "ends_sha256": "string"}
    filled = [p.select(*_NODE, *[F.col(c) if c in p.columns else F.lit(None).cast(t).alias(c) for c, t in names.items()]) for p in parts]
    # Each node has one row of each part at most.
    rows = reduce(DataFrame.unionByName, filled).groupBy(*_NODE).agg(*[F.max(c).alias(c) for c in names]).where("n IS NOT NULL")
    parents = nodes.where("depth > 0").select((F.col("depth") + 1).alias("depth"), F.col("ka").alias("pa"), F.col("kb").alias("pb"), F.col("conv_id").alias("parent_conv_id"))
    upper = rows.where("depth <= 1").withColumn("parent_conv_id", F.when(F.col("depth") == 1, F.lit(root["conv_id"]).cast("long")))
    rows = rows.where("depth > 1").join(parents, ["depth", "pa", "pb"], "left").unionByName(upper)
    return rows.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        F.col("n").alias("n_convs"),
        F.coalesce("n_children", zero).alias("n_children"),
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )


def end_digests(ends: DataFrame) -> DataFrame:
    """``ends_sha256`` of each node key: the hash of its ``conv_id``s in ascending order, joined by commas."""
    order = [*_NODE, "conv_id"]
    ordered = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    ids = F.array_join(F.array_sort(F.collect_list("conv_id")).cast("array<string>"), ",")
    chunks = ordered.groupBy(*_NODE, F.shiftright("at", CHUNK.bit_length() - 1).alias("chunk")).agg(ids.alias("ids"))
    stream = chunks.repartition(*_NODE).sortWithinPartitions(*_NODE, "chunk").select(*_NODE, "ids")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, sha = None, None
        types = [pa.int64()] * 3 + [pa.string()]

        def out(done: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*done, strict=True), types, strict=True)], [*_NODE, "ends_sha256"])

        for batch in batches:
            done = []
            for *key, ids in zip(*[batch.column(c).to_pylist() for c in [*_NODE, "ids"]], strict=True):
                if key == node:
                    sha.update(b",")
                else:
                    if sha:
                        done.append((*node, sha.hexdigest()))
                    node, sha = key, hashlib.sha256()
                sha.update(ids.encode())
            if done:
                yield out(done)
        if sha:
            yield out([(*node, sha.hexdigest())])

    return stream.mapInArrow(run, "depth long, ka long, kb long, ends_sha256 string")

"""N-gram Jaccard join with a token-group matrix (operator 6).

A document's set is its distinct 5-word shingles (a shorter text is one shingle), as 64-bit hashes.  Two documents
are linked when ``|x & y| >= 3/4 |x | y|``.  The join is exact (up to hash collisions), whatever the groups are:

1. Sets.  Arrow tasks make each document's set, its digest, four min-hashes and its prefix: in a global order of
   tokens the first ``|x| - ceil(3/4 |x|) + 1``, of which linked documents share one.  Documents with equal sets are
   one class from here on.
2. Order.  Frequent tokens come last, the most frequent at the end, so prefixes are made of rare ones.  Tokens that
   repeat within a task's texts are counted over all tasks; the list is bounded (``FREQUENT``).  The order affects
   cost only.
3. Groups.  Classes that share a min-hash are alike; they are cut into blocks of about ``BLOCK``, and the links within
   each block are found.  The linked classes of a block, and the others of a block, are groups.
4. Matrix.  For each group the union of its members' prefix tokens is stored as (token, group) rows.  Two groups
   are a candidate pair if their sizes allow a link and the tokens that they share there are enough for one.
5. Opening.  For each candidate pair the overlap of a member with the other group's token union bounds its overlap
   with any document in it; only where that bound reaches the threshold the group is opened and its members are
   compared, except those that are joined already.

Links of groups and blocks give the components.  No pairs within a class or a group are emitted.

Defined cases: null and empty texts have an empty set and link with nothing; rows with the same id are one document
and all their texts are linked; rows with a null id get their set's size, a null component, and link nothing; other
columns are ignored, whatever their names; an empty table gives an empty result.  Texts of any length are read whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedline.llm.components import components
from feedline.llm.shared import BROADCAST_ROWS, small, written
from feedline.llm.words import Words, frugal, mix, shingles, slices

SIZE, BLOCK, SKETCHES = 5, 64, 2
#: The threshold as a fraction.
UP, DOWN = 3, 4
#: Tokens that a task counts at a time, and bytes of text that it reads at a time.
HELD, SLICE = 2 << 20, 1 << 20
#: Occurrences that make a token frequent, and the most tokens in the list (16 bytes each, broadcast).
OFTEN, FREQUENT = 6, 1 << 20


def token_sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words = Words(texts)
    docs, values = shingles(words, words.hashes(), size)
    if np.any(docs[1:] < docs[:-1]):
        order = np.argsort(docs, kind="stable")
        docs, values = docs[order], values[order]
    first = np.searchsorted(docs, np.arange(len(texts) + 1))
    out = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        x = np.sort(values[a:b])
        out.append(x[np.append(True, x[1:] != x[:-1])] if b - a > 1 else x)
    return out


def digest(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def _need(n: int) -> int:
    """Least overlap of a set of ``n`` with a set that it links with."""
    return -(-UP * n // DOWN)


def linked(x: np.ndarray, y: np.ndarray) -> bool:
    if DOWN * min(len(x), len(y)) < UP * max(len(x), len(y)):
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return DOWN * both >= UP * (len(x) + len(y) - both) and both > 0


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def frequent_tokens(docs: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Tokens that repeat within tasks and occur ``OFTEN`` times or more there in all, and their ranks by count."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            tokens, counts = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            some = counts > 1
            return pa.RecordBatch.from_arrays([pa.array(tokens[some].view(np.int64)), pa.array(counts[some].astype(np.int64))], ["token", "count"])

        seen = 0
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                held += token_sets(part.column("text"), size)
                seen += sum(map(len, held[-len(part) :]))
                if seen > HELD:
                    yield flush()
                    seen = 0
        if held:
            yield flush()

    counts = _texts(docs).select("text").mapInArrow(frugal(run), "token long, count long").groupBy("token").agg(F.sum("count").alias("count"))
    return most_frequent(written(counts.where(F.col("count") >= OFTEN), "token-counts"))


def most_frequent(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of the highest counts, ``FREQUENT`` at most, sorted, and the rank of each by count."""
    steps = counts.groupBy(F.least("count", F.lit(4096)).alias("count")).agg(F.count("*").alias("n")).orderBy(F.desc("count")).collect()  # 4096 rows at most
    total, least = 0, 1 << 62
    for row in steps:
        total += row["n"]
        if total > FREQUENT:
            break
        least = row["count"]
    some = counts.where(F.col("count") >= least).select("token", "count").toArrow()
    tokens, times = some.column("token").to_numpy().view(np.uint64), some.column("count").to_numpy()
    rank = np.empty(len(tokens), np.int64)
    rank[np.lexsort((tokens, times))] = np.arange(len(tokens))
    order = np.argsort(tokens)
    return tokens[order], rank[order]


SETS = "doc_id long, n_shingles long, digest binary, sketch array<long>, prefix array<long>"


def prefixes(docs: DataFrame, size: int, frequent: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """Size, digest, min-hashes and prefix of each document."""
    held = docs.sparkSession.sparkContext.broadcast(frequent)
    seeds = mix(np.arange(1, SKETCHES + 1).astype(np.uint64))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often, rank = held.value
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                sets = token_sets(part.column("text"), size)
                sketch, prefix = [], []
                for x in sets:
                    n = len(x)
                    if not n:
                        sketch.append([])
                        prefix.append(np.zeros(0, np.int64))
                        continue
                    if len(often):
                        at = np.minimum(np.searchsorted(often, x), len(often) - 1)
                        late = often[at] == x
                        ordered = np.concatenate([x[~late], x[late][np.argsort(rank[at[late]])]])
                    else:
                        ordered = x
                    prefix.append(ordered[: n - _need(n) + 1].view(np.int64))
                    sketch.append([int((mix(x ^ s)).min().view(np.int64)) for s in seeds])
                lengths = np.cumsum([0, *map(len, prefix)]).astype(np.int32)
                flat = np.concatenate(prefix) if prefix else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([len(x) for x in sets], pa.int64()),
                        pa.array(map(digest, sets), pa.binary()),
                        pa.array(sketch, pa.list_(pa.int64())),
                        pa.ListArray.from_arrays(pa.array(lengths), pa.array(flat)),
                    ],
                    ["doc_id", "n_shingles", "digest", "sketch", "prefix"],
                )

    return _texts(docs).mapInArrow(frugal(run), SETS)


def _sets_of(docs: DataFrame, ids: DataFrame, size: int) -> DataFrame:
    """``ids``, a row for each of some ``doc_id``, with ``tokens``, the bytes of its sorted 64-bit hashes, for each of its texts.

    What goes with a document is joined to its text, so that a set is not shuffled to meet it."""
    names = [f.name for f in ids.schema if f.name != "doc_id"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                sets = [x.tobytes() for x in token_sets(part.column("text"), size)]
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in ("doc_id", *names)), pa.array(sets, pa.binary())], ["doc_id", *names, "tokens"])

    schema = ", ".join(["doc_id long", *(f"`{f.name}` {f.dataType.simpleString()}" for f in ids.schema if f.name in names), "tokens binary"])
    return _texts(docs).join(small(ids, BROADCAST_ROWS // 2), "doc_id").select("doc_id", "text", *names).mapInArrow(frugal(run), schema)


def _load(tokens: bytes) -> np.ndarray:
    return np.frombuffer(tokens, np.uint64)


def _links(sets: list[np.ndarray], names: list, pairs: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Links among ``pairs`` of sets, enough to join all that they join; sets of one name are joined already."""
    parent = {n: n for n in names}

    def top(n):  # noqa: ANN001, ANN202
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    found = []
    for i, j in pairs:
        a, b = top(names[i]), top(names[j])
        if a != b and linked(sets[i], sets[j]):
            parent[a] = b
            found.append((i, j))
    return found


def _table(ids: list[int], links: list[tuple[int, int]]) -> dict[str, pa.Array]:
    return {"a": pa.array([ids[i] for i, _ in links], pa.int64()), "b": pa.array([ids[j] for _, j in links], pa.int64())}


def _block_links(rows: DataFrame) -> DataFrame:
    """``a, b``: links within each block of rows ``home, doc_id, tokens``, enough to join all that are joined there."""

    def run(key: tuple, block: pa.Table) -> pa.Table:
        ids, sets = block.column("doc_id").to_pylist(), [_load(t) for t in block.column("tokens").to_pylist()]
        order = sorted(range(len(ids)), key=lambda i: (len(sets[i]), ids[i]))
        near = ((order[i], order[j]) for j in range(len(order)) for i in range(j) if DOWN * len(sets[order[i]]) >= UP * len(sets[order[j]]))
        return pa.table(_table(ids, _links(sets, ids, near)))

    return rows.groupBy("home").applyInArrow(run, "a long, b long")


def homes(classes: DataFrame) -> DataFrame:
    """``doc_id, which, home``: for each min-hash that a class shares, the block of similar classes that it is in.

    A min-hash that very many classes share makes many blocks of about ``BLOCK`` members; a hash of the id picks one.
    Classes of sizes that hardly link are apart.
    """
    keys = classes.where("n_shingles > 0").select("doc_id", "n_shingles", F.posexplode("sketch").alias("which", "sketch"))
    shared = keys.groupBy("which", "sketch").agg(F.count("*").alias("n")).where("n > 1")
    grain = F.floor(F.log(F.col("n_shingles").cast("double")) / F.log(F.lit(DOWN / UP)) / 2)
    part = F.pmod(F.xxhash64("doc_id", "sketch"), F.ceil(F.col("n") / BLOCK).cast("bigint"))
    return keys.join(shared, ["which", "sketch"]).select("doc_id", "which", F.xxhash64("which", "sketch", part, grain).alias("home"))


def _candidates(matrix: DataFrame) -> DataFrame:
    """``group, other``: pairs of groups that may hold a link, by the tokens that their prefixes share.

    Sizes must allow a link.  Common tokens outside both prefixes are in the rest of one of the two sets, so the
    number of shared prefix tokens and the larger rest bound the overlap of any two members.
    """
    sizes = f"{DOWN} * a.most >= {UP} * b.least AND {DOWN} * b.most >= {UP} * a.least"
    apart = "coalesce(a.component <> b.component, true)"  # groups of one component have nothing to add
    meet = matrix.alias("a").join(matrix.alias("b"), F.expr(f"a.token = b.token AND a.group < b.group AND {sizes} AND {apart}"))
    meet = meet.select(F.col("a.group"), F.col("b.group").alias("other"), "a.least", "a.most", F.col("b.least").alias("other_least"), F.col("b.most").alias("other_most"))
    shared = meet.groupBy("group", "other").agg(
        F.count("*").alias("n"), (F.min("least") + F.min("other_least")).alias("least"), F.greatest(F.max("most"), F.max("other_most")).alias("most")
    )
    rest = F.ceil(UP * F.col("most") / DOWN) - 1
    return shared.where((UP + DOWN) * (F.col("n") + rest) >= UP * F.col("least")).select("group", "other")


def _opened(pairs: DataFrame) -> DataFrame:
    """``a, b``: links between the two groups of each pair, enough to join all that are joined by them."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for left, right in zip(*(batch.column(c).to_pylist() for c in ("members", "others")), strict=True):
                both = left + right
                ids, names, sets = [m["doc_id"] for m in both], [m["component"] for m in both], [_load(m["tokens"]) for m in both]
                n = len(left)
                union = sets[n] if len(right) == 1 else np.unique(np.concatenate(sets[n:]))
                # A member whose overlap with the other group's tokens is too small links with none of them.
                open_ = [i for i in range(n) if len(np.intersect1d(sets[i], union, assume_unique=True)) >= _need(len(sets[i]))]
                links = _links(sets, names, ((i, j) for i in open_ for j in range(n, len(both))))
                if links:
                    yield pa.RecordBatch.from_pydict(_table(ids, links))

    return pairs.mapInArrow(frugal(run), "a long, b long")


def jaccard_components(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every document."""
    spark = docs.sparkSession
    found = written(prefixes(docs, size, frequent_tokens(docs, size)), "prefixes")
    ids = found.where("doc_id IS NOT NULL")
    classes = written(ids.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.max("n_shingles").alias("n_shingles")).where("n_shingles > 0"), "classes")
    # Rows of one id are one document: their classes are linked.
    own = ids.select("doc_id", "digest").join(classes, "digest").groupBy("doc_id").agg(F.min("rep").alias("least"), F.max("rep").alias("most"))
    own = own.where("least <> most").select(F.col("least").alias("a"), F.col("most").alias("b"))
    reps = small(classes.select(F.col("rep").alias("doc_id"), "digest"))
    first = ids.join(reps, ["doc_id", "digest"], "left_semi")

    home = written(homes(first), "homes")
    sets = _sets_of(docs, home.groupBy("doc_id").agg(F.collect_set("home").alias("homes")), size)
    near = written(_block_links(sets.select(F.explode("homes").alias("home"), "doc_id", "tokens")).unionByName(own), "links")
    grouped = components(near)
    # Groups: linked classes of a block; the other classes of a block; each class without a block.
    member = first.join(small(home.groupBy("doc_id").agg(F.min_by("home", "which").alias("home"))), "doc_id", "left").join(small(grouped), F.col("doc_id") == F.col("node"), "left")
    place = F.when(F.col("component").isNotNull(), F.xxhash64(F.lit("linked"), "component", F.coalesce("home", "doc_id")))
    place = place.when(F.col("home").isNotNull(), F.xxhash64(F.lit("alike"), "home")).otherwise(F.xxhash64(F.lit("alone"), "doc_id"))
    member = member.withColumns({"component": F.coalesce("component", "doc_id"), "group": place})
    # The matrix: rows meet by token; tokens of one component only say nothing.
    rows = member.select(F.explode("prefix").alias("token"), "component", "group", F.col("n_shingles").cast("int").alias("n"))
    rows = rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "token")
    spread = [f(c).alias(f"{c}_{n}") for c in ("component", "group", "n") for f, n in ((F.min, "least"), (F.max, "most"))]
    # The rows are shuffled once for both readers: n, always above 0, is asked for so that both need the same columns, and
    # an inner join (a token is in ``between`` once) stays above the repartition, unlike a semi join.
    between = rows.groupBy("token").agg(*spread).where("component_least <> component_most AND group_least <> group_most AND n_least > 0")
    shared = rows.join(between.select("token").hint("shuffle_hash"), "token")
    one = F.when(F.min("component") == F.max("component"), F.min("component"))
    matrix = written(shared.groupBy("token", "group").agg(one.alias("component"), F.min("n").alias("least"), F.max("n").alias("most")), "matrix")
    pairs = written(_candidates(matrix), "group-pairs")

    wanted = pairs.select("group").unionByName(pairs.select(F.col("other").alias("group"))).distinct()
    members = written(member.select("doc_id", "group", "component").join(small(wanted), "group", "left_semi").distinct(), "group-members")
    groups = _sets_of(docs, members, size).groupBy("group").agg(F.collect_list(F.struct("doc_id", "component", "tokens")).alias("members"))  # about BLOCK at most
    groups = written(groups, "group-sets")
    other = groups.select(F.col("group").alias("other"), F.col("members").alias("others"))
    opened = _opened(pairs.join(other, "other").join(groups, "group").select("members", "others"))
    final = components(near.unionByName(opened))

    mapped = classes.select("digest", "rep").join(final, F.col("rep") == F.col("node"), "left").select("digest", F.coalesce("component", "rep").alias("component"))
    result = found.select("doc_id", "n_shingles", "digest").join(mapped, "digest", "left")
    result = result.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))
    return result

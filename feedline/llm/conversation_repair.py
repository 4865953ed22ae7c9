"""Conversation structure repair by a grammar-compressed shortest-edit search (operator 12).

The rows of a conversation, in order, become a sequence of symbols: the initial of the role (system, user, assistant or
other) with the first fault of the row (none, truncated, blank, duplicate).  The cheapest edits that give role initials
``(s?(ua)+)?`` depend on that sequence alone, and sequences are much alike.  So:

* Re-Pair: the distinct sequences of all conversations share one grammar.  A round counts neighbouring symbols over all
  sequences and makes rules of the most frequent pairs that share no symbol; rounds go on until no pair occurs
  twice, or to ``RULES`` rules or ``ROUNDS`` rounds.  These bounds decide how much is shared, never a result.
* Each symbol has a min-plus matrix over the four states of the pattern (nothing yet, after s, after u, after a): the cost
  and edits of the cheapest way through its rows.  A rule's matrix is the product of those of its two sides, computed
  once, bottom-up.  Edits are kept as ropes, which a rule shares with its parts; equal parts are skipped when two ropes
  are compared.  A row's inserts stand before its own edit, so all ropes over the same rows have as many other edits and
  end in one; none is the beginning of another, and the least of two stays least whatever follows.
* A task compresses the sequences of a batch and multiplies what is left, pairwise.

Edits (costs): Keep 0, Rerole to user or assistant 3, Delete 4 (the only one for blank and duplicate rows), Insert of an
empty user or assistant row anywhere 3; a truncated row that stays costs 3 more.  Of equal costs the ASCII-least sequence
of initials wins.

Bounded memory: rows are put in order by a range partitioning on conversation *and* turn, so one conversation with a
third of all rows is dealt over many tasks; only one byte of each of its rows meets in one place, as the sequence (the audit, which is a result, is as
long).  The digest of a repaired conversation is one SHA-256 over all its texts, which can only be computed in order:
its texts pass, sorted, through one task as a stream.

Defined cases: null ids make one conversation of their own; a null role or text is one blank (so such texts are blank, and
such roles can only be reroled or deleted); a null turn comes first; rows with equal turns are ordered by a digest of role
and text; the digest that tells duplicates is 128 bits wide.  A conversation without rows has zeros, an empty audit and the
digest of the empty text.  Roles count by their first character, as written.  Other columns are ignored, whatever their
names; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedline.llm.shared import written
from feedline.llm.words import slices

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: Most rules, rounds, and pairs of a round that the driver receives.
RULES, ROUNDS, ROUND_PAIRS = 1024, 12, 256
#: Sequences whose results a task remembers.
REMEMBERED = 50_000

INITIALS, FAULTS = "suao", ("", "truncated", "blank", "duplicate")
_SPACES = " \t\n\x0b\x0c\r"
#: Symbols are numbered from 1; 0 separates sequences.  In text they are letters from A.
_SYMBOLS = len(INITIALS) * len(FAULTS)

# ---------------------------------------------------------------- ropes and matrices


class Rope:
    """Edits as a text that shares its parts: a leaf's ``text``, or ``left`` and ``right``."""

    __slots__ = ("left", "right", "text", "size", "mark")

    def __init__(self, text: str = "", left: Rope | None = None, right: Rope | None = None):
        self.left, self.right, self.text = left, right, text
        if left is None:
            self.size, self.mark = len(text), 0
            for c in text:
                self.mark = (self.mark * _BASE + ord(c)) % _PRIME
        else:
            self.size = left.size + right.size
            self.mark = (left.mark * pow(_BASE, right.size, _PRIME) + right.mark) % _PRIME

    def __str__(self) -> str:
        out, todo = [], [self]
        while todo:
            x = todo.pop()
            if x.left is None:
                out.append(x.text)
            else:
                todo += [x.right, x.left]
        return "".join(out)


_PRIME, _BASE = (1 << 61) - 1, 0x1F3D5B79A2C4E681


def joined(a: Rope, b: Rope) -> Rope:
    return b if not a.size else a if not b.size else Rope(left=a, right=b)


def before(a: Rope, b: Rope) -> bool:
    """Whether the text of ``a`` is less than that of ``b``; equal parts are skipped whole."""
    x, y = [a], [b]
    while x and y:
        p, q = x.pop(), y.pop()
        if p.size == q.size and p.mark == q.mark:
            continue
        if p.left is None and q.left is None:
            n = min(p.size, q.size)
            if p.text[:n] != q.text[:n]:
                return p.text[:n] < q.text[:n]
            if p.size > n:
                x.append(Rope(p.text[n:]))
            elif q.size > n:
                y.append(Rope(q.text[n:]))
            continue
        if q.left is None or (p.left is not None and p.size >= q.size):
            x += [p.right, p.left]
            y.append(q)
        else:
            y += [q.right, q.left]
            x.append(p)
    return bool(y)


Way = tuple[int, Rope]

#: States: nothing yet (0), after s (1), after u (2), after a (3); 0 and 3 may end.
_NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
_ENDS = (0, 3)


def _better(way: Way, than: Way | None) -> bool:
    return than is None or way[0] < than[0] or (way[0] == than[0] and before(way[1], than[1]))


def _inserts() -> dict[tuple[int, int], int]:
    """Least inserts that lead from one state to another."""
    out = {}
    for x in range(4):
        found, n = {x}, 0
        while found:
            out.update({(x, z): n for z in found if (x, z) not in out})
            found, n = {_NEXT[z, r] for z in found for r in "ua" if (z, r) in _NEXT and (x, _NEXT[z, r]) not in out}, n + 1
    return out


INSERTS = _inserts()


class Part:
    """What a symbol stands for: matrix, counts of faults, illegal neighbours, first and last initial."""

    __slots__ = ("ways", "blank", "duplicate", "truncated", "illegal", "first", "last")

    def __init__(self, ways: dict[tuple[int, int], Way], blank: int, duplicate: int, truncated: int, illegal: int, first: str, last: str):
        self.ways, self.blank, self.duplicate, self.truncated, self.illegal, self.first, self.last = ways, blank, duplicate, truncated, illegal, first, last


def row_part(initial: str, fault: str) -> Part:
    edits = [(z, z, DELETE, "D") for z in range(4)]
    if fault in ("", "truncated"):
        more = TRUNCATED if fault else 0
        edits += [(z, y, KEEP + more, "K") for (z, r), y in _NEXT.items() if r == initial]
        edits += [(z, y, REROLE + more, "R") for (z, r), y in _NEXT.items() if r in "ua"]
    ways: dict[tuple[int, int], Way] = {}
    for x in range(4):
        for z, y, cost, letter in edits:
            if (x, z) in INSERTS:
                way = (cost + INSERT * INSERTS[x, z], Rope("I" * INSERTS[x, z] + letter))
                if _better(way, ways.get((x, y))):
                    ways[x, y] = way
    return Part(ways, int(fault == "blank"), int(fault == "duplicate"), int(fault == "truncated"), 0, initial, initial)


def product(a: Part, b: Part) -> Part:
    ways: dict[tuple[int, int], Way] = {}
    for (x, z), (cost, edits) in a.ways.items():
        for y in range(4):
            if more := b.ways.get((z, y)):
                if (best := ways.get((x, y))) is None or cost + more[0] <= best[0]:
                    way = (cost + more[0], joined(edits, more[1]))
                    if _better(way, best):
                        ways[x, y] = way
    illegal = a.illegal + b.illegal + (a.last + b.first not in ("su", "ua", "au"))
    return Part(ways, a.blank + b.blank, a.duplicate + b.duplicate, a.truncated + b.truncated, illegal, a.first, b.last)


def cheapest(part: Part) -> tuple[int, str]:
    """(cost, edits) from nothing to a state that may end."""
    best = None
    for y in range(4):
        if (0, y) in part.ways:
            for z in _ENDS:
                if (y, z) in INSERTS:
                    cost, edits = part.ways[0, y]
                    way = (cost + INSERT * INSERTS[y, z], joined(edits, Rope("I" * INSERTS[y, z])))
                    if _better(way, best):
                        best = way
    return best[0], str(best[1])


# ---------------------------------------------------------------- grammar


class Grammar:
    """Rules in rounds; the rules of a round share no symbol, so all are applied at once."""

    def __init__(self):
        self.rounds: list[tuple[np.ndarray, np.ndarray]] = []
        self.parts: list[Part | None] = [None] + [row_part(i, f) for i in INITIALS for f in FAULTS]

    def extend(self, pairs: list[tuple[int, int]]) -> None:
        """A round of rules for ``pairs``, the most frequent first; pairs that share a symbol with an earlier one wait."""
        used: set[int] = set()
        codes, made = [], []
        for a, b in pairs:
            if len(self.parts) - 1 - _SYMBOLS < RULES and not used & {a, b}:
                used |= {a, b}
                codes.append(a << 32 | b)
                made.append(len(self.parts))
                self.parts.append(product(self.parts[a], self.parts[b]))
        order = np.argsort(codes)
        self.rounds.append((np.array(codes, np.int64)[order], np.array(made, np.int64)[order]))

    @property
    def full(self) -> bool:
        return len(self.parts) - 1 - _SYMBOLS >= RULES

    def compress(self, sequences: pa.Array) -> np.ndarray:
        """The symbols of all sequences after all rules, with a 0 behind each sequence."""
        line = "@".join(sequences.to_pylist()) + "@"
        symbols = np.frombuffer(line.encode(), np.uint8).astype(np.int64) - ord("@")
        for codes, made in self.rounds:
            pairs = symbols[:-1] << 32 | symbols[1:]
            at = np.minimum(np.searchsorted(codes, pairs), len(codes) - 1)
            hit = codes[at] == pairs
            # Only a pair of one symbol with itself can overlap: every other one of such a run counts.
            i = np.flatnonzero(hit)
            starts = np.flatnonzero(np.diff(i, prepend=-2) != 1)
            runs = np.repeat(starts, np.diff(np.append(starts, len(i))))
            i = i[(np.arange(len(i)) - runs) % 2 == 0]
            symbols[i] = made[at[i]]
            symbols = np.delete(symbols, i + 1)
        return symbols

    def results(self, sequences: list[str]) -> list[tuple[int, int, int, int, int, str]]:
        """(blank, duplicate, truncated, illegal, cost, audit) of each sequence."""
        symbols = self.compress(pa.array(sequences, pa.string()))
        out, begin = [], 0
        for end in np.flatnonzero(symbols == 0).tolist():
            parts = [self.parts[s] for s in symbols[begin:end].tolist()]
            while len(parts) > 1:
                parts = [product(*parts[k : k + 2]) if k + 1 < len(parts) else parts[k] for k in range(0, len(parts), 2)]
            begin = end + 1
            p = parts[0] if parts else None
            out.append((p.blank, p.duplicate, p.truncated, p.illegal, *cheapest(p)) if p else (0, 0, 0, 0, 0, ""))
        return out


def build_grammar(sequences: DataFrame) -> Grammar:
    """The grammar of the distinct strings ``seq``; a round is one pass that counts pairs in the tasks and merges the counts."""
    grammar = Grammar()
    for _ in range(ROUNDS):

        def pairs(batches: Iterable[pa.RecordBatch], so_far: Grammar = grammar) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for piece in slices(batch, "seq"):
                    s = so_far.compress(piece.column("seq"))
                    both = (s[:-1] > 0) & (s[1:] > 0)
                    code, n = np.unique((s[:-1] << 32 | s[1:])[both], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(n.astype(np.int64))], ["code", "n"])

        counted = sequences.mapInArrow(pairs, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).where("n > 1")
        top = counted.orderBy(F.desc("n"), "code").limit(ROUND_PAIRS).collect()
        if not top or grammar.full:
            break
        grammar.extend([(x["code"] >> 32, x["code"] & 0xFFFFFFFF) for x in top])
    return grammar


# ---------------------------------------------------------------- Spark


def turns_of(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` of the rows, nulls of role and text as one blank."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    return rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), blank("role").alias("role"), blank("text").alias("text"))


def damaged(rows: DataFrame) -> DataFrame:
    """Rows of ``turns_of`` with ``copies``, after the damage that a checksum of conversation and turn decides; 0 copies: dropped."""
    spot = F.concat(*[F.coalesce(F.col(c).cast("string"), F.lit(" ")) if c else F.lit(":") for c in ("conv_id", "", "turn")])
    kind = F.crc32(spot.cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    return rows.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), copies.alias("copies"))


def _key() -> Column:
    return F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"))


def sequences_of(rows: DataFrame) -> DataFrame:
    """``conv_id, seq``: the symbols of each conversation's rows in order."""
    last = F.right(F.rtrim("text", F.lit(_SPACES)), F.lit(1))
    fault = F.when(last == "", FAULTS.index("blank")).when(~last.isin(".", "!", "?"), FAULTS.index("truncated")).otherwise(0)
    initial = F.coalesce(F.nullif(F.instr(F.lit(INITIALS[:3]), F.left("role", F.lit(1))), F.lit(0)) - 1, F.lit(3))
    initial = F.when(F.col("role") == "", 3).otherwise(initial)
    slim = rows.select("conv_id", "turn", _key().alias("key"), initial.alias("initial"), fault.alias("fault"), "copies")
    slim = slim.groupBy("conv_id", "turn", "key", "initial", "fault").agg(F.sum("copies").alias("copies"))
    # The first place of each role and text: whole-key joins, so no frequent text of a conversation is one task's.
    first = slim.groupBy("conv_id", "key").agg(F.min(F.struct("turn")).alias("at")).select(F.col("conv_id").alias("c"), F.col("key").alias("k"), F.col("at.turn").alias("t"), F.lit(True).alias("is_first"))
    slim = slim.join(first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("key") == F.col("k")) & F.col("turn").eqNullSafe(F.col("t")), "left")
    letter = lambda fault: F.char((ord("A") + F.col("initial") * len(FAULTS) + fault).cast("long"))
    again = letter(F.when(F.col("fault") == FAULTS.index("blank"), F.col("fault")).otherwise(FAULTS.index("duplicate")))
    here = F.concat(F.when(F.col("is_first"), letter(F.col("fault"))).otherwise(again), F.repeat(again, (F.col("copies") - 1).cast("int")))
    ordered = slim.select("conv_id", "turn", "key", here.alias("symbols")).repartitionByRange("conv_id", "turn", "key").sortWithinPartitions("conv_id", "turn", "key")
    ordered = ordered.select("conv_id", "symbols", F.monotonically_increasing_id().alias("at"))
    in_order = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", c))), lambda x: x[c]), "")
    pieces = ordered.groupBy("conv_id", F.shiftright("at", 33).alias("part")).agg(in_order("symbols").alias("piece")).withColumnRenamed("part", "at")
    return pieces.groupBy("conv_id").agg(in_order("piece").alias("seq"))


def edits(sequences: DataFrame, grammar: Grammar) -> DataFrame:
    """``sequences`` with ``blank, duplicate, truncated, illegal, cost, audit`` instead of ``seq``."""
    names = ["blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    kept = [c for c in sequences.columns if c != "seq"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory: dict[str, tuple] = {}
        for batch in batches:
            for piece in slices(batch, "seq"):
                coded = piece.column("seq").dictionary_encode()
                kinds = coded.dictionary.to_pylist()
                if len(memory) > REMEMBERED:
                    memory = {}
                new = [s for s in kinds if s not in memory]
                memory.update(zip(new, grammar.results(new) if new else [], strict=True))
                found = list(zip(*[memory[s] for s in kinds], strict=True))
                columns = [pa.array(x, pa.string() if n == "audit" else pa.int64()).take(coded.indices) for x, n in zip(found, names, strict=True)]
                yield pa.RecordBatch.from_arrays([piece.column(c) for c in kept] + columns, kept + names)

    given = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in sequences.schema if f.name != "seq")
    return sequences.mapInArrow(run, f"{given}, blank long, duplicate long, truncated long, illegal long, cost long, audit string")


class _Digest:
    """SHA-256 of a repaired conversation whose rows come one by one."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state, self.sha, self.begun = audit, 0, 0, hashlib.sha256(), False

    def put(self, role: str, text: str) -> None:
        self.sha.update(f"{chr(10) if self.begun else ''}{role}:{text}".encode())
        self.begun, self.state = True, _NEXT[self.state, role[:1]]

    def forced(self) -> str:
        return "assistant" if self.state == 2 else "user"

    def inserts(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.put(self.forced(), "")
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self.inserts()
        letter, self.at = self.audit[self.at], self.at + 1
        if letter != "D":
            self.put(role if letter == "K" else self.forced(), text)

    def hexdigest(self) -> str:
        self.inserts()
        return self.sha.hexdigest()


RESULT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def repaired(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256`` of each conversation of ``conversations``
    (``conv_id``), whose rows are ``rows`` (``conv_id, turn, role, text, copies``)."""
    rows = rows.where("copies > 0")
    spots = rows.select(F.col("conv_id").alias("c"), "turn").distinct().groupBy("c").agg(F.min("turn").alias("low"), F.max("turn").alias("high"), F.count("turn").alias("n"))
    found = written(sequences_of(rows), "turn-sequences")
    grammar = build_grammar(written(found.select("seq").distinct(), "turn-patterns"))
    ids = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    heads = ids.join(spots, F.col("conv_id").eqNullSafe(F.col("c")), "left").drop("c").join(found.withColumnRenamed("conv_id", "c"), F.col("conv_id").eqNullSafe(F.col("c")), "left")
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("n"), F.lit(0))
    heads = edits(heads.select("conv_id", gaps.cast("long").alias("gaps"), F.coalesce("seq", F.lit("")).alias("seq")), grammar)

    nothing = {f.name: F.lit(None).cast(f.dataType).alias(f.name) for f in heads.schema}
    texts = rows.select(F.lit(1).alias("kind"), *[nothing.get(c, F.col(c)) if c != "conv_id" else F.col(c) for c in heads.columns], "turn", _key().alias("key"), "role", "text", "copies")
    heads = heads.select(F.lit(0).alias("kind"), *heads.columns, *[F.lit(None).cast(texts.schema[c].dataType).alias(c) for c in ("turn", "key", "role", "text", "copies")])
    # A conversation's head, then its rows in the order of its sequence.
    stream = heads.unionByName(texts).repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "key")
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head: list | None = None
        digest = None
        types = [pa.int64()] * 7 + [pa.string()] * 2

        def out(done: list[list]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*done, strict=True), types, strict=True)], [*names, "repaired_sha256"])

        for batch in batches:
            for piece in slices(batch, "text"):
                done = []
                columns = [piece.column(c).to_pylist() for c in ("kind", "role", "text", "copies")]
                heading = iter(zip(*[piece.filter(pc.equal(piece.column("kind"), 0)).column(c).to_pylist() for c in names], strict=True))
                for kind, role, text, copies in zip(*columns, strict=True):
                    if kind == 0:
                        if digest:
                            done.append([*head, digest.hexdigest()])
                        head = next(heading)
                        digest = _Digest(head[-1])
                    else:
                        for _ in range(copies):
                            digest.row(role, text)
                if done:
                    yield out(done)
        if digest:
            yield out([[*head, digest.hexdigest()]])

    return stream.mapInArrow(run, RESULT)


def repair(rows: DataFrame) -> DataFrame:
    """The repair of conversations as they are: ``repaired`` without damage."""
    rows = turns_of(rows)
    return repaired(rows, rows.withColumn("copies", F.lit(1)))


def repair_damaged(rows: DataFrame) -> DataFrame:
    """The repair of conversations after the damage of ``damaged``."""
    rows = turns_of(rows)
    return repaired(rows, damaged(rows))

"""Conversation repair against a plain search over all edits, row by row, and its defined cases."""

import hashlib
import heapq
import random
import zlib

import pytest

SCHEMA = "conv_id long, turn long, role string, text string, copies int, key string, seq string, kind int, audit string, c long, at long"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 7, "k", "s", 5, "a", 9, 3) for r in rows], SCHEMA)


SPACES = " \t\n\x0b\x0c\r"
NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}


def search(rows):
    """Cheapest edits by best-first search over (rows done, state), ordered by cost and edits."""
    heap, seen = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, state, out = heapq.heappop(heap)
        if i == len(rows) and state in ("", "a"):
            # Of equal costs the least edits come first, but a longer one may still be under way.
            best = min([(audit, out)] + [(x[1], x[4]) for x in heap if x[0] == cost and x[2] == len(rows) and x[3] in ("", "a")])
            return cost, best[0], best[1]
        if (i, state) in seen:
            continue
        seen.add((i, state))
        for r in "ua":
            if (state, r) in NEXT:
                heapq.heappush(heap, (cost + 3, audit + "I", i, NEXT[state, r], (*out, ({"u": "user", "a": "assistant"}[r], ""))))
        if i < len(rows):
            role, text, fault = rows[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, state, out))
            if fault in ("", "truncated"):
                more = 3 if fault else 0
                if (state, role[:1]) in NEXT:
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, NEXT[state, role[:1]], (*out, (role, text))))
                for r in "ua":
                    if (state, r) in NEXT:
                        heapq.heappush(heap, (cost + 3 + more, audit + "R", i + 1, NEXT[state, r], (*out, ({"u": "user", "a": "assistant"}[r], text))))
    raise AssertionError


def md5(role, text):
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()


def brute(rows, damage=True):
    out = {}
    for c in {r[0] for r in rows}:
        own = []
        for _, turn, role, text in [r for r in rows if r[0] == c]:
            role, text = " " if role is None else role, " " if text is None else text
            kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20 if damage else 19
            if kind == 0:
                continue
            text = "" if kind == 1 else text.translate({ord(x): None for x in ".!?"}) if kind == 2 else text
            role = "user" if kind == 4 else role
            own += [(turn, role, text)] * (2 if kind == 3 else 1)
        own.sort(key=lambda x: (x[0] is not None, x[0] or 0, md5(*x[1:])))
        seen, marked = set(), []
        for _, role, text in own:
            bare = text.rstrip(SPACES)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated"
            seen.add((role, text))
            marked.append((role, text, fault))
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        count = [sum(f == x for _, _, f in marked) for x in ("blank", "duplicate", "truncated")]
        illegal = sum((a[0][:1] + b[0][:1]) not in ("su", "ua", "au") for a, b in zip(marked, marked[1:]))
        cost, audit, kept = search(marked)
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()
        out[c] = (c, gaps, *count, illegal, cost, audit, sha)
    return sorted(out.values(), key=lambda x: (x[0] is None, x[0] or 0))


def conversations(seed, n):
    r = random.Random(seed)
    rows = []
    for c in range(n):
        turn = r.choice([0, 0, 0, 5, -2])
        for _ in range(r.choice([1, 2, 3, 5, 8, 13])):
            role = r.choice(["system", "user", "user", "assistant", "assistant", "user", "assistant", "tool", "User", "", "u", None][: r.choice([3, 5, 7, 12])])
            text = r.choice(["Yes.", "No!", "Well then", "What?\n ", " \t", "", "ok. sure", "é.", None, f"t{r.randint(0, 99)}.", f"x{r.randint(0, 99)}."])
            rows.append((c, None if r.random() < 0.05 else turn, role, text))
            turn += r.choice([1, 1, 1, 1, 2, 0])
    return rows


def result(df):
    return sorted(map(tuple, df.collect()), key=lambda x: (x[0] is None, x[0] or 0))


@pytest.mark.parametrize("damage", [True, False])
def test_repair_equals_a_plain_search(spark, damage):
    from feedline.llm.conversation_repair import repair, repair_damaged

    rows = conversations(3, 150)
    rows += [(None, 0, "user", "Lost."), (None, None, None, None), (None, 1, "assistant", "Found.")]
    rows += [(500, i, "user", "One.") for i in range(6)] + [(-7, 0, "system", "Only."), (-7, 0, "system", "Only.")]
    got = result((repair_damaged if damage else repair)(frame(spark, rows)))
    assert got == brute(rows, damage)


def test_long_conversations_share_rules(spark):
    """Conversations of thousands of turns: costs against a plain table, edits give a legal order."""
    from feedline.llm.conversation_repair import repair

    r = random.Random(9)
    rows = [(1, i, ["user", "assistant"][i % 2], f"Turn {i}.") for i in range(4001)]
    rows += [(2, i, r.choice(["user", "assistant", "system"]), f"Turn {i}" + r.choice([".", ""])) for i in range(3000)]
    rows += [(3, i, "system", "x" * 3000 + ".") for i in range(50)]
    got = {x["conv_id"]: x for x in repair(frame(spark, rows)).collect()}
    assert got[1]["cost"] == 3 and got[1]["audit"] == "K" * 4001 + "I" and got[1]["illegal"] == 0
    assert got[3]["duplicate"] == 49

    infinite = 10**9
    best = {"": 0}
    for _, _, role, text in rows[4001:7001]:
        for _ in range(2):
            for x in list(best):
                for q in "ua":
                    if (x, q) in NEXT:
                        best[NEXT[x, q]] = min(best.get(NEXT[x, q], infinite), best[x] + 3)
        new = {x: n + 4 for x, n in best.items()}
        more = 0 if text.endswith(".") else 3
        for x, n in best.items():
            for q, price in ((role[0], 0), ("u", 3), ("a", 3)):
                if (x, q) in NEXT:
                    new[NEXT[x, q]] = min(new.get(NEXT[x, q], infinite), n + price + more)
        best = new
    want = min(best.get("", infinite), best.get("a", infinite), best.get("u", infinite) + 3, best.get("s", infinite) + 6)
    audit = got[2]["audit"]
    assert got[2]["cost"] == want and len(audit) - audit.count("I") == 3000


def test_empty_and_without_rows(spark):
    from feedline.llm.conversation_repair import repair, repair_damaged

    assert repair(frame(spark, [])).count() == 0
    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    empty = hashlib.sha256(b"").hexdigest()
    assert result(repair_damaged(frame(spark, [(dropped, 0, "user", "Gone.")]))) == [(dropped, 0, 0, 0, 0, 0, 0, "", empty)]
    assert result(repair(frame(spark, [(1, None, "assistant", "")]))) == [(1, 0, 1, 0, 0, 0, 4, "D", empty)]


def test_ropes_compare_like_texts():
    from feedline.llm.conversation_repair import Rope, before, joined

    r = random.Random(1)
    for _ in range(2000):
        ropes = []
        for _ in range(2):
            x = Rope("")
            for _ in range(r.randint(0, 6)):
                y = Rope("".join(r.choice("DI") for _ in range(r.randint(0, 3))))
                x = joined(x, y) if r.random() < 0.5 else joined(y, x)
            ropes.append(x)
        assert before(*ropes) == (str(ropes[0]) < str(ropes[1]))

"""The prefix trie against a plain one, and its defined cases."""

import collections
import hashlib
import random
import re
import zlib

import pytest

SCHEMA = "conv_id long, turn long, role string, text string, block long, size int, depth long, n int, key string, pos long, words string, a long"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 7, 1, 2, 3, "k", 4, "w", 5) for r in rows], SCHEMA)


def brute(rows, lend=True):
    convs = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            convs[c].append((turn is not None, turn or 0, hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest(), role, text))
    plain = {c: [x[3:] for x in sorted(v)] for c, v in convs.items()}
    h = {c: zlib.crc32(str(c).encode()) % 4 if lend else 0 for c in plain}
    base = lambda c: c - (abs(c) % 20) * (1 if c >= 0 else -1)
    made = {c: (plain.get(base(c), [])[: h[c]] if lend else []) + v[h[c] :] for c, v in plain.items()}
    members, ends, children = collections.defaultdict(list), collections.defaultdict(list), collections.defaultdict(set)
    for c in sorted(made):
        v = tuple(made[c])
        for d in range(len(v) + 1):
            members[v[:d]].append(c)
            if d:
                children[v[: d - 1]].add(v[:d])
        ends[v].append(c)
    saved, leaves = collections.Counter(), collections.Counter()
    for node in members:
        own = (len(members[node]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += own
            leaves[node[:d]] += not children.get(node)
    out = []
    for node, m in members.items():
        sha = hashlib.sha256(",".join(map(str, ends.get(node, []))).encode()).hexdigest()
        out.append((m[0], len(node), members[node[:-1]][0] if node else None, len(m), len(children.get(node, ())), leaves[node], saved[node], sha))
    return sorted(out, key=str)


def conversations(seed, n):
    r = random.Random(seed)
    rows = []
    for c in range(-25, n):
        if r.random() < 0.1:
            continue
        turn = 0
        few = r.random() < 0.6  # many share turns with others
        for i in range(r.choice([1, 1, 2, 3, 4, 5, 8, 9, 13])):
            text = r.choice(["yes", "no it is", "", None, f" one\ttwo\n{i} "]) if few else f"text {r.randint(0, 10**6)}"
            rows.append((c, None if r.random() < 0.03 else turn, r.choice(["user", "assistant"]) if not few else ["user", "assistant", None][i % 3], text))
            turn += r.choice([1, 1, 1, 0])
    copied = [(c + 1000, *x[1:]) for x in rows if (c := x[0]) is not None and c % 3 == 0]
    return rows + copied + [(None, 0, "user", "no conversation"), rows[0], rows[5]]


def result(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_equals_a_plain_one(spark, seed):
    from feedline.llm.conversation_trie import prefix_trie, rebuilt

    rows = conversations(seed, 120)
    assert result(prefix_trie(rebuilt(frame(spark, rows)))) == brute(rows)


def test_long_conversations_by_segments(spark, monkeypatch):
    """Prefixes, sums and places go on over segments; one long conversation and its copy with another end."""
    from feedline.llm import conversation_trie as trie

    monkeypatch.setattr(trie, "SEGMENT", 2)
    monkeypatch.setattr(trie, "CHUNK", 4)
    rows = [(c, i, ["user", "assistant"][i % 2], f"w {i} " + ("end" if i >= 57 and c % 2 else "")) for c in (20, 21, 22, 23, 24, 45) for i in range(60)]
    rows += [(c, 0, "user", "same") for c in range(100, 140)]
    assert result(trie.prefix_trie(trie.rebuilt(frame(spark, rows)))) == brute(rows)
    assert result(trie.prefix_trie(trie.whole(frame(spark, rows)))) == brute(rows, lend=False)


def test_turnless_and_empty(spark):
    from feedline.llm.conversation_trie import prefix_trie, rebuilt

    assert prefix_trie(rebuilt(frame(spark, []))).count() == 0
    assert prefix_trie(rebuilt(frame(spark, [(None, 1, "user", "x")]))).count() == 0
    bare = [c for c in range(21, 200) if c % 20 and zlib.crc32(str(c).encode()) % 4 == 3][:3]
    rows = [(c, 0, "user", "cut off") for c in bare]
    assert result(prefix_trie(rebuilt(frame(spark, rows)))) == brute(rows)
    long = [(20, 0, "user", "word " * 50_000), (20, 1, None, None)]
    assert result(prefix_trie(rebuilt(frame(spark, long)))) == brute(long)

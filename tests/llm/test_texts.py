"""Operators on documents against brute force, and their defined cases: nulls, empty and long texts, repeated rows,
clashing columns, empty tables."""

import collections
import hashlib
import random
import re
import zlib

import pyarrow as pa
import pytest

SCHEMA = "doc_id long, text string, lang string, row string, words string, place long, kept boolean, n_words int, mark int, units int"
SPACE = r"[^\x20\x09-\x0D]+"


def frame(spark, rows):
    """Documents with extra columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, None, "r", "w", 1, True, 7, 3, 5) for i, t in rows], SCHEMA)


def corpus(seed=1, n=60):
    r = random.Random(seed)
    vocabulary = ["der", "and", "Thé", "of", "blee", "ñandú", "X1", "can't", "re,", "###", "漢字", "end."]
    out = []
    for i in range(n):
        text = "\n".join(" ".join(r.choice(vocabulary) for _ in range(r.randint(1, 30))) for _ in range(r.randint(1, 6)))
        out.append((i, text))
    out += [(n, None), (n + 1, ""), (n + 2, " \t\n"), (None, "lost id of a text"), (3, out[3][1]), (n + 3, "word " * 20_000), (n + 4, "a  b\tc\r\n\n d ")]
    return out


def test_sentencepiece_equals_the_library(spark):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from sentencepiece import SentencePieceProcessor

    from feedline.llm.sentencepiece_ids import encode_digests, encode_texts

    path = public_tokenizers.path("piece_bpe_32k.model")
    sp = SentencePieceProcessor(model_file=path)
    rows = corpus() + [(900, "▁a▁▁b \n\n c,d.e!f"), (901, "<s> </s> <0x0A>"), (902, "x\0y")]
    got = encode_digests(frame(spark, rows), path).collect()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for i, t in rows:
        ids = sp.encode(t or "")
        want.append((i, len(ids), sha(",".join(map(str, ids))), sha(sp.decode(ids))))
    key = lambda x: (x[0] is None, x[0] or 0, x[2])
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    one = encode_texts(frame(spark, [(1, "ab, cd")]), path).first()
    assert one["ids"] == sp.encode("ab, cd") and one["decoded"] == "ab, cd"
    assert encode_digests(frame(spark, []), path).count() == 0


def test_token_files_round_trip(spark):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    import struct

    from tokenizers import Tokenizer

    from feedline.llm.token_files import token_file_rows

    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    rows = [x for x in corpus() if x != (3, corpus()[3][1])] + [(3, corpus()[3][1]), (901, "I'm <|endoftext|> x"), (902, "a\xa0 b  c \n\n d")]
    got = sorted(map(tuple, token_file_rows(frame(spark, rows), path).collect()))
    want, start = [], 0
    for i, t in sorted(((i, t) for i, t in rows if i is not None), key=lambda x: (x[0], x[1] or "")):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [0]
        want.append((i, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    assert got == sorted(want)
    assert token_file_rows(frame(spark, [(None, "x")]), path).count() == 0


def test_packing_is_exact_for_every_width():
    import numpy as np

    from feedline.llm.token_files import TokenFile, build_file, id_bits

    assert [id_bits(n) for n in (1, 2, 3, 256, 257, 50257)] == [1, 1, 2, 8, 9, 16]
    for bits in (1, 3, 8, 13, 16, 17, 32):
        ids = np.random.default_rng(bits).integers(0, 1 << bits, 1003, dtype=np.uint64).astype(np.uint32)
        file = TokenFile(build_file([4, 9], [1000, 3], ids, bits, block=64))
        assert (file.slice(0, 1003) == ids).all() and (file.slice(63, 65) == ids[63:65]).all() and not len(file.slice(5, 5))


def base_counts(text):
    words = re.findall(SPACE, text or "")
    runs = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times, hit = collections.Counter(runs), set()
    for i, run in enumerate(runs):
        if times[run] > 1:
            hit |= {i, i + 1, i + 2}
    lines = [x for x in (text or "").split("\n") if re.search(SPACE, x)]
    failed = len(words) < 50 or 100 * len(hit) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit), failed


def test_quality_rules_counts(spark):
    from feedline.llm.quality_rules import accepted, judge

    rows = corpus(n=40)
    trusted = spark.createDataFrame([(i,) for i in [0, 1, 2, None]], "doc_id long")
    docs = frame(spark, rows)
    got = judge(docs, trusted).collect()
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    assert sorted([(r["row"]["doc_id"], tuple(r[c] for c in columns)) for r in got], key=key) == sorted([(i, base_counts(t)) for i, t in rows], key=key)
    assert all(r["kept"] == (not r["base_failed"] and r["ratio"] >= -0.15) for r in got)
    kept = accepted(docs, trusted)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(r["row"]["doc_id"] for r in got if r["kept"])
    assert judge(frame(spark, []), trusted).count() == 0
    assert {r["ratio"] for r in judge(docs, trusted.limit(0)).collect()} == {0.0}


def test_quality_rules_tell_junk_from_trusted_texts(spark):
    from feedline.llm.quality_rules import judge

    r = random.Random(3)
    good = [f"w{k}" for k in range(300)]
    rows = [(i, " ".join(r.choice(good) for _ in range(200))) for i in range(80)]
    rows += [(100 + i, " ".join(r.choice(good) + "###" for _ in range(200))) for i in range(20)]
    verdicts = {x["row"]["doc_id"]: x["kept"] for x in judge(frame(spark, rows), spark.createDataFrame([(i,) for i in range(60)], "doc_id long")).collect()}
    assert all(verdicts[i] for i in range(80)) and not any(verdicts[100 + i] for i in range(20))


def grams_of(text):
    w = re.findall(SPACE, text or "")
    return w + list(zip(w, w[1:]))


@pytest.mark.parametrize("frequent", [1 << 20, 40])  # all repeated n-grams broadcast, and most of them shuffled
def test_quality_ratios_equal_exact_counts(spark, monkeypatch, frequent):
    import math

    from feedline.llm import quality_rules

    monkeypatch.setattr(quality_rules, "FREQUENT", frequent, raising=False)
    rows = [*corpus(n=40), (5, corpus(n=40)[9][1]), (70, "only here and never again"), (71, "trusted words seen but once")]
    r = random.Random(4)
    rows += [(200 + i, " ".join(f"n{r.randrange(100_000)}" for _ in range(3000))) for i in range(40)]  # more distinct n-grams than 2^16
    trusted = {0, 1, 2, 9, 71}
    raw, good = collections.Counter(), collections.Counter()
    for i, t in rows:
        raw.update(grams_of(t))
        good.update(grams_of(t) if i in trusted else [])
    share = good.total() / raw.total()
    ratio = lambda g: math.log((good[g] + 20 * share) / (raw[g] + 20) / share)
    want = [(i, t or "", sum(map(ratio, grams_of(t))) / max(1, len(grams_of(t)))) for i, t in rows]
    got = [(x["row"]["doc_id"], x["row"]["text"] or "", x["ratio"]) for x in quality_rules.judge(frame(spark, rows), spark.createDataFrame([(i,) for i in trusted], "doc_id long")).collect()]
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    assert [x[:2] for x in sorted(got, key=key)] == [x[:2] for x in sorted(want, key=key)]
    assert all(abs(x[2] - y[2]) < 1e-6 for x, y in zip(sorted(got, key=key), sorted(want, key=key), strict=True))


@pytest.mark.parametrize("sample", [0.0, 0.5, 1.0])  # all n-grams shuffled, some, and all repeated ones broadcast
def test_quality_ratios_do_not_depend_on_the_frequent_ngrams(spark, monkeypatch, sample):
    import math

    from feedline.llm import quality_rules

    monkeypatch.setattr(quality_rules, "SAMPLE", sample)
    rows = [*corpus(seed=8, n=20), (3, "once more"), (80, None)]
    raw, good = collections.Counter(), collections.Counter()
    for i, t in rows:
        raw.update(grams_of(t))
        good.update(grams_of(t) if i in (0, 1, 3) else [])
    share = good.total() / raw.total()
    want = {t or "": sum(math.log((good[g] + 20 * share) / (raw[g] + 20) / share) for g in grams_of(t)) / max(1, len(grams_of(t))) for _, t in rows}
    got = quality_rules.judge(frame(spark, rows), spark.createDataFrame([(0,), (1,), (3,)], "doc_id long")).collect()
    assert len(got) == len(rows) and all(abs(x["ratio"] - want[x["row"]["text"] or ""]) < 1e-6 for x in got)


def test_quality_passes_share_out_the_occurrences(spark):
    from feedline.llm import quality_rules

    r = random.Random(6)
    texts = [(i, i % 2, " ".join(f"v{r.randrange(3000)}" for _ in range(400))) for i in range(40)] + [(90, 0, None), (91, 1, " ")]
    keyed = spark.createDataFrame(texts, "key long, flag int, text string")
    every = quality_rules.occurrences(keyed, "key", "flag")
    frequent = every.groupBy("gram").count().where("count > 7").select("gram")
    want = collections.Counter(tuple(x) for x in every.select("gram", "key", "flag").join(frequent, "gram", "left_anti").collect())
    parts = [quality_rules.dealt(keyed, frequent, k).select("gram", "key", "flag").collect() for k in range(quality_rules.PASSES)]
    assert every.count() == sum(len(grams_of(t)) for _, _, t in texts) and frequent.count() > 0
    assert want == collections.Counter(tuple(x) for part in parts for x in part)
    assert not any({x["gram"] for x in a} & {x["gram"] for x in b} for k, a in enumerate(parts) for b in parts[:k])
    # No pass shuffles much more than its share.
    assert max(map(len, parts)) < 1.2 * want.total() / quality_rules.PASSES


def test_quality_verdicts_hold_when_the_corpus_grows(spark):
    from feedline.llm.quality_rules import judge

    def texts(copy):  # of each copy, with words of its own: 80 good and 20 bad ones
        r = random.Random(copy)
        word = lambda kind, n: f"{kind}{copy}x{r.randrange(n)}"
        return [" ".join(word("g", 400) if i < 80 else word("###", 1000) for _ in range(400)) for i in range(100)]

    def kept(copies):
        rows = [(100 * c + i, t) for c in range(copies) for i, t in enumerate(texts(c))]
        ids = [(i,) for i, _ in rows if i % 100 < 60]
        judged = judge(frame(spark, rows), spark.createDataFrame(ids, "doc_id long"))
        return {x["row"]["doc_id"]: x["kept"] for x in judged.where("row.doc_id < 100").collect()}

    assert kept(1) == kept(16) == {i: i < 80 for i in range(100)}


def contamination_brute(docs, items, window=13):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    found = collections.defaultdict(set)
    for i, t in items:
        w = words(t)
        for s in range(max(1, len(w) - window + 1) if w else 0):
            found[tuple(w[s : s + window])].add(i)
    out = []
    for i, t in docs:
        w, hit, ids = words(t), set(), set()
        for run, of in found.items():
            for s in range(len(w) - len(run) + 1):
                if tuple(w[s : s + len(run)]) == run:
                    hit |= set(range(s, s + len(run)))
                    ids |= of
        out.append((i, len(w), len(hit), tuple(sorted(str(x) for x in ids if x is not None))))
    return out


@pytest.mark.parametrize("limit", [200_000, 0])  # broadcast and shuffled benchmark
def test_decontamination_equals_brute_force(spark, monkeypatch, limit):
    from feedline.llm import decontamination

    monkeypatch.setattr(decontamination, "BROADCAST_ROWS", limit)
    r = random.Random(5)
    word = lambda: r.choice(["Aa", "bé", "c", "DD", "e9", "É"])
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([13, 14, 20, 5, 2, 1, 13])] + [(7, None), (8, "..."), (None, "zz yy xx"), (9, "zz yy xx")]
    docs = [(i, " ".join(word() for _ in range(r.randint(0, 60)))) for i in range(20)]
    docs += [(20 + i, f"start {items[i][1].lower()}, end {items[i][1]}") for i in range(4)] + [(30, None), (31, ""), (32, "ZZ-yy xx"), (None, "zz yy xx zz yy xx"), (33, "q " * 3000)]
    rows = decontamination.contamination(frame(spark, docs + [docs[20]]), spark.createDataFrame(items, "item_id long, text string")).collect()
    got = [(x["doc_id"], x["n_words"], x["n_hit"], tuple(x["items"])) for x in rows]
    key = lambda x: (x[0] is None, x[0] or 0)
    assert sorted(got, key=key) == sorted(contamination_brute(docs, items), key=key)
    empty = spark.createDataFrame([], "item_id long, text string")
    assert {x["n_hit"] for x in decontamination.contamination(frame(spark, docs), empty).collect()} == {0}
    assert decontamination.contamination(frame(spark, []), empty).count() == 0


def components_brute(docs, size=5):
    fold = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    sets = []
    for i, t in docs:
        w = re.findall(SPACE, fold(t))
        sets.append({tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else set())
    label = {i: i for i, _ in docs if i is not None}
    changed = True
    while changed:
        changed = False
        for (i, _), x in zip(docs, sets, strict=True):
            for (j, _), y in zip(docs, sets, strict=True):
                if i is not None and j is not None and x and y and (i == j or 100 * len(x & y) >= 75 * len(x | y)):
                    low = min(label[i], label[j])
                    changed |= label[i] != low or label[j] != low
                    label[i] = label[j] = low
    return [(i, len(x), label.get(i)) for (i, _), x in zip(docs, sets, strict=True)]


def test_jaccard_components_equal_brute_force(spark):
    from feedline.llm.jaccard_join import jaccard_components

    r = random.Random(9)
    base = [f"w{r.randint(0, 400)}" for _ in range(60)]
    docs = []
    for i in range(70):  # near copies of one text, with all degrees of likeness
        w = list(base)
        for _ in range(r.randint(0, 5)):
            w[r.randrange(len(w))] = f"x{r.randint(0, 99)}"
        docs.append((1000 - i, " ".join(w)))
    docs += [(i, " ".join(f"w{r.randint(0, 30)}" for _ in range(r.randint(1, 12)))) for i in range(40)]
    docs += [(200 + i, "One two  three\tfour") for i in range(4)] + [(300, None), (301, ""), (302, " \n"), (None, "one two three four"), (303, "q " * 5000), (7, docs[75][1])]
    got = sorted(map(tuple, jaccard_components(frame(spark, docs)).collect()), key=str)
    assert got == sorted(components_brute(docs), key=str)
    assert jaccard_components(frame(spark, [])).count() == 0


@pytest.mark.parametrize("limit", [1_000_000, 0])  # broadcast and shuffled documents of the groups
def test_jaccard_join_shuffles_prefix_rows_once_and_sets_to_their_groups_only(spark, monkeypatch, limit):
    from feedline.llm import jaccard_join

    plans, write, blocks = {}, jaccard_join.written, jaccard_join._block_links

    def spied(df, name):
        if name == "matrix":
            df.collect()
            plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, name)

    def spied_blocks(rows):
        plans["blocks"] = rows._jdf.queryExecution().optimizedPlan().toString()
        return blocks(rows)

    monkeypatch.setattr(jaccard_join, "written", spied)
    monkeypatch.setattr(jaccard_join, "_block_links", spied_blocks)
    monkeypatch.setattr(jaccard_join, "BROADCAST_ROWS", limit, raising=False)
    r = random.Random(10)
    docs = [(i % 60, " ".join(f"w{r.randint(0, 6)}" for _ in range(r.randint(4, 14)))) for i in range(64)]  # four ids twice
    base = [f"b{k}" for k in range(50)]
    docs += [(100 + i, " ".join(base[:i] + ["x"] + base[i + 1 :])) for i in range(40)]
    got = sorted(map(tuple, jaccard_join.jaccard_components(frame(spark, docs)).collect()), key=str)
    assert got == sorted(components_brute(docs), key=str)
    final = plans["matrix"].split("== Initial Plan ==")[0]
    assert re.search(r"ReusedExchange \[[^\]]*\], Exchange hashpartitioning\(token", final)
    assert "Join" not in plans["blocks"].split("MapInArrow")[0]


def line_dedup_brute(docs, least=50):
    """Deletes every line of a run of ``least`` words or more that occurs earlier."""
    seqs = []
    for i, t in docs:
        lines = (t or "").split("\n")
        real = [k for k, x in enumerate(lines) if x.strip(" \t\n\x0b\x0c\r")]
        seqs.append((i, t, lines, real, [lines[k].strip(" \t\n\x0b\x0c\r") for k in real]))
    order = sorted(range(len(docs)), key=lambda d: docs[d][0])
    first, out = {}, {}
    for d in order:
        i, t, lines, real, x = seqs[d]
        n = [len(re.findall(SPACE, s)) for s in x]
        gone = set()
        for a in range(len(x)):
            for b in range(a + 1, len(x) + 1):
                if sum(n[a:b]) >= least:
                    if first.setdefault(tuple(x[a:b]), (d, a)) != (d, a):
                        gone |= set(range(a, b))
        drop = {k for p in gone for k in range(real[p], real[p + 1] if p + 1 < len(real) else len(lines))}
        out[i] = (t if not drop else "\n".join(s for k, s in enumerate(lines) if k not in drop), len(drop))
    return out


def test_line_dedup_equals_brute_force(spark):
    from feedline.llm.line_dedup import dedup

    r = random.Random(4)
    pool = [" ".join(f"{k}w{m}" for m in range(r.randint(1, 22))) for k in range(9)] + ["", " ", "long " * 60]
    docs = [(i, "\n".join(r.choice(pool) for _ in range(r.randint(0, 25)))) for i in range(45)] + [(100, None), (101, ""), (102, "\n\n"), (103, "\nx\n\n" + pool[-1])]
    docs.append((104, docs[5][1]))
    frame_ = frame(spark, docs)
    got = {x["row"]["doc_id"]: (x["text"], x["n_removed"]) for x in dedup(frame_).collect()}
    assert got == line_dedup_brute(docs)
    twice = dedup(frame(spark, [(1, pool[-1]), (1, pool[-1]), (None, pool[-1])])).collect()
    assert [(x["row"]["doc_id"], x["n_removed"]) for x in sorted(twice, key=lambda x: x["row"]["doc_id"] or 0)] == [(None, 0), (1, 1), (1, 1)]
    assert dedup(frame(spark, [])).count() == 0 and dedup(frame(spark, [(1, "a")])).first()["text"] == "a"


def test_line_dedup_with_shuffled_ranks_equals_brute_force(spark, monkeypatch):
    """Rank tables too large to be broadcast, one passage in most documents, repeated rows, and runs of many short lines."""
    from feedline.llm import line_dedup

    monkeypatch.setattr(line_dedup, "BROADCAST_ROWS", -1)
    monkeypatch.setattr(line_dedup, "BROADCAST_DOCS", -1)
    r = random.Random(8)
    passage, short = "\n".join(f"a b c{i}" for i in range(20)), "\n".join(["x"] * 61)
    docs = [(i, f"own {i}\n" + "\n".join(r.sample([passage, short, "rare %d" % r.randint(0, 5), "y " * 49], r.randint(1, 4)))) for i in range(40)]
    got = {x["row"]["doc_id"]: (x["text"], x["n_removed"]) for x in line_dedup.dedup(frame(spark, docs + docs[:7])).collect()}
    assert got == line_dedup_brute(docs)


def test_components_of_a_path_and_a_star(spark):
    from feedline.llm.components import components

    links = [(i, i + 1) for i in range(1, 20)] + [(100, k) for k in range(101, 140)] + [(50, 50), (None, 3)]
    got = {x["node"]: x["component"] for x in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 21)}, **{i: 100 for i in range(100, 140)}}


def test_word_hashes_tell_words_apart():
    from feedline.llm.words import Words, shingles

    words = Words(pa.array(["Ab ab abc\tabcdefgh abcdefghi", None, "", "ab"]))
    hashes = words.hashes()
    assert list(words.counts) == [5, 0, 0, 1] and hashes[0] == hashes[1] == hashes[5] and len(set(hashes.tolist())) == 4
    docs, values = shingles(words, hashes, 5)
    assert sorted(docs.tolist()) == [0, 3] and len(set(values.tolist())) == 2

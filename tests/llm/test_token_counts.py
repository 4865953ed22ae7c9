"""Token counts against the library on whole texts, and their defined cases."""

import random

import pytest

from tests.llm.test_texts import corpus, frame

#: White space, signs, contractions, special strings and scripts in which the splitter's rules meet.
PARTS = [" ", "  ", "\n", "\t", " \n", "\r\n", " ", "　", " ", "\u0085", "​", "﻿", "\x1c", "᠎", "\x00", "'s", "'S", "'ll", "don't", "'", "'5", "5'", "’s", "a", "É", "é", "́", "×", "ſ", "ª", "²", "½", "Ⅷ", "漢字", "123", "٣", "!", "...", "<|endoftext|>", "<|", "|>", "🙂", "\U0001f468‍\U0001f469", "word", "ab.cd", "A1b2"]


def sorted_rows(rows):
    return sorted(map(tuple, rows), key=lambda x: (x[0] is None, x[0] or 0, x[1:]))


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_counts_equal_the_library(spark, name):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    from feedline.llm.token_counts import token_counts

    path = public_tokenizers.path(name)
    r = random.Random(5)
    rows = corpus() + [(1000 + i, "".join(r.choice(PARTS) for _ in range(r.randint(0, 14)))) for i in range(4000)]
    rows += [(1, "again"), (1, "again"), (7000, "x" * 30_000), (7001, "\n" * 5000 + " a" * 5000)]
    library = Tokenizer.from_file(path)
    want = [(i, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 512) for i, t in rows]
    assert sorted_rows(token_counts(frame(spark, rows), path).collect()) == sorted_rows(want)


def test_empty_table_and_limit(spark):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from feedline.llm.token_counts import token_counts

    path = public_tokenizers.path("byte_bpe_50k.json")
    assert token_counts(frame(spark, []), path).count() == 0
    assert [x["over_limit"] for x in token_counts(frame(spark, [(1, "a b c")]), path, limit=2).collect()] == [True]
    assert [x["over_limit"] for x in token_counts(frame(spark, [(1, "a b c")]), path, limit=3).collect()] == [False]


def test_proven_strings_are_tokens_by_themselves():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    from feedline.llm.token_counts import proven

    path = public_tokenizers.path("byte_bpe_50k.json")
    _, texts = proven(path)
    library = Tokenizer.from_file(path)
    assert len(texts) > 40_000 and all(len(e.ids) == 1 for e in library.encode_batch(texts, add_special_tokens=False))

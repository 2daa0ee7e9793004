"""Encoding against the public libraries, and the speculation's test against exact merging."""

import random

import numpy as np
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from curlew.llm.tokenizer import PATTERN, Encoder, count_tokens, default_path, encode, load_ranks, merge

RANKS = load_ranks(default_path())
CODER = Encoder(RANKS)
TRUE = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=RANKS, special_tokens={})


def ids(text):
    return CODER.encode_batch([text])[0].tolist()


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=60))
def test_any_text(text):
    assert ids(text) == TRUE.encode_ordinary(text) and TRUE.decode(ids(text)) == text


def test_made_up_words():
    r = random.Random(0)
    words = ["".join(r.choice(["th", "e", "ing", "a", "é", "zz", "中", "ation", "s", "un", "ß"]) for _ in range(r.randrange(1, 30))) for _ in range(5000)]
    before = CODER.merged
    assert [list(x) for x in CODER.encode_words(words)] == [TRUE.encode_ordinary(w) for w in words]
    assert 0 < CODER.merged - before < 5000  # some speculation fails, some doesn't


def test_compatible_pairs_are_those_that_merging_leaves_alone():
    r, back = np.random.default_rng(1), {v: k for k, v in RANKS.items()}
    a, b = r.integers(0, 5000, 3000), r.integers(0, 5000, 3000)
    told = CODER.vocabulary.compatible(a, b)
    for x, y, ok in zip(a.tolist(), b.tolist(), told):
        if CODER.vocabulary.own[x] and CODER.vocabulary.own[y]:
            assert ok == (merge(back[x] + back[y], RANKS) == [back[x], back[y]])


@pytest.mark.parametrize("text", ["<|endoftext|>", "a\x1c\x1db", "  　x", "I'll  we've", "\n\n\n", "x" * 30_000, "ab1" * 20_000, "語" * 9_000])
def test_odd_and_long_texts(text):
    assert ids(text) == TRUE.encode_ordinary(text)


def test_tables(spark):
    rows = [(1, "Hello world"), (2, None), (3, ""), (4, "  "), (1, "Hello world"), (None, "x"), (5, "lang " * 50_000)]
    df = spark.createDataFrame([(*r, 1, "clash") for r in rows], "doc_id long, text string, ids long, _text string")
    out = encode(df).collect()
    key = lambda x: (str(x[0]), str(x[1]))
    assert sorted(((r["doc_id"], r["ids"]) for r in out), key=key) == sorted(((d, TRUE.encode_ordinary(t) if t else []) for d, t in rows), key=key)
    assert {r["doc_id"]: r["n_tokens"] for r in count_tokens(df).collect()}[2] == 0
    assert encode(df.limit(0)).count() == 0


def test_a_forgetful_worker_gives_the_same_ids(monkeypatch):
    monkeypatch.setattr("curlew.llm.tokenizer.REMEMBERED", 3)
    coder = Encoder(RANKS)
    for text in ("one two three four", "five six one", "one two seven"):
        assert coder.encode_batch([text])[0].tolist() == TRUE.encode_ordinary(text)

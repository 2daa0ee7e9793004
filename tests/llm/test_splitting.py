"""Pieces cover their text in order, stay under the limit and end at natural breaks."""

import random
from collections import defaultdict

import pytest

from curlew.llm.splitting import breaks, pieces, split_documents
from curlew.llm.tokenizer import Encoder, default_path, load_ranks

CODER = Encoder(load_ranks(default_path()))


def split(spark, texts, **options):
    df = spark.createDataFrame([(i, t, 1, "clash") for i, t in enumerate(texts)], "doc_id long, text string, piece_no long, piece string")
    out = defaultdict(list)
    for r in split_documents(df, **options).collect():
        out[r["doc_id"]].append(r)
    return {k: sorted(v, key=lambda r: r["piece_no"]) for k, v in out.items()}


def check(text, rows, limit, overlap):
    at = 0
    for i, r in enumerate(rows):
        assert r["piece_no"] == i and r["piece"] == text[r["char_start"] : r["char_end"]]
        assert r["n_tokens"] == CODER.count(r["piece"]) <= limit
        assert r["char_start"] <= at < r["char_end"]
        assert r["overlap_tokens"] <= overlap and (r["overlap_tokens"] == 0) == (r["char_start"] == at)
        at = r["char_end"]
    assert at == len(text)


def prose(seed, topics=4):
    r = random.Random(seed)
    out = []
    for topic in range(topics):
        words = [f"{a}{b}" for a in ("river", "stone", "music", "court")[topic % 4 : topic % 4 + 1] for b in ("", "bed", "work", "side", "man")]
        out += [" ".join(r.choice(words + ["and", "the", "old"]) for _ in range(9)).capitalize() + "." for _ in range(14)]
    return " ".join(out)


@pytest.mark.parametrize("limit,overlap", [(64, 0), (64, 16), (200, 40), (8, 4)])
def test_cover_limit_and_overlap(spark, limit, overlap):
    texts = [prose(1), "a" * 5000, "語" * 900, "one. two. " * 300, "\n\n".join(prose(i, 1) for i in range(5)), "x \n\n\n " * 400, "I: Hm.\n[00:01:02] R: Yes, indeed.\n" * 60, "- item one two three\n" * 90, "\U0001f600é" * 700, "short"]
    out = split(spark, texts, limit=limit, overlap=overlap)
    for i, text in enumerate(texts):
        check(text, out[i], limit, overlap)
    assert len(out[9]) == 1 and out[9][0]["cut"] == "end"


def test_cuts_fall_on_natural_breaks(spark):
    out = split(spark, [prose(5), "I: Hm yes.\n[00:01:02] R: Yes, indeed it was so then.\n" * 60], limit=120, overlap=0)
    assert {r["cut"] for r in out[0][:-1]} == {"sentence"}
    assert {r["cut"] for r in out[1][:-1]} <= {"turn", "sentence"}


def test_the_deepest_valley_is_where_the_topic_changes(spark):
    text = prose(2)
    first = text.index("Stone") if "Stone" in text else None
    border = text.index(next(s for s in text.split(". ") if "stone" in s.lower()))
    rows = split(spark, [text], limit=CODER.count(text[:border]) + 60, overlap=0)[0]
    assert abs(rows[0]["char_end"] - border) < 200, (first, border, rows[0]["char_end"])


def test_nulls_repeats_and_empty(spark):
    out = split(spark, [None, "", "same", "same"])
    assert set(out) == {2, 3}
    df = spark.createDataFrame([], "doc_id long, text string")
    assert split_documents(df).count() == 0
    with pytest.raises(ValueError):
        split_documents(df, limit=4)
    with pytest.raises(ValueError):
        split_documents(df, limit=100, overlap=80)


def test_kinds_of_breaks():
    text = "A one. B two\nC\n\nD\n- e\nI: f"
    assert {text[p:].split()[0]: k for k, p in sorted(zip(*breaks(text)[::-1])) if 0 < p < len(text) and not text[p].isspace()} == {"C": 3, "D": 6, "-": 4, "I:": 5}
    assert breaks("") == ([], []) and breaks("none") == ([], [])


@pytest.mark.parametrize("limit,overlap", [(8, 0), (64, 16)])
def test_words_that_come_apart_keep_their_counts(spark, limit, overlap):
    r = random.Random(4)
    junk = ["".join(r.choice("xqzé語\U0001f600") for _ in range(700)) for _ in range(8)]
    texts = ["'" * 900 + "re we", "!?'" * 500 + "s 'll", " " * 3000 + "x", "\n" * 2000 + "\t" * 900 + "y", "\ud800" * 300, *junk, " ".join(junk)]
    coder = CODER
    for text in texts:
        words = coder.learn([text])[0]
        at = 0
        for start, end, tokens, _, _ in pieces(text, words, coder, limit, overlap):
            assert tokens == coder.count(text[start:end]) <= limit and start <= at < end
            at = end
        assert at == len(text)

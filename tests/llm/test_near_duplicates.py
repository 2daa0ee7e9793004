"""Near-duplicates against brute force over all pairs."""

import random

import numpy as np
import pytest

from curlew.llm import sketch as S
from curlew.llm.near_duplicates import agreement, near_duplicate_classes, near_duplicates, words_of

SCHEMA = "project_uid string, title string, description string, band long, id string, words string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "clash", "clash") for r in rows], SCHEMA)


def brute(rows, min_words=30, least=0.75):
    known = {u: words_of(t) + words_of(d) for u, t, d in rows if u is not None and len(words_of(d)) >= min_words}
    keys = sorted(known)
    return {(a, b) for i, a in enumerate(keys) for b in keys[i + 1 :] if agreement(known[a], known[b]) >= least}


def corpus(seed=1, groups=60):
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdefghijklmnoprstuv") for _ in range(r.randrange(3, 9))) for _ in range(900)]
    rows = []
    for g in range(groups):
        base = [r.choice(vocabulary) for _ in range(r.randrange(32, 120))]
        for v in range(r.randrange(1, 5)):
            text = list(base)
            for _ in range(r.randrange(0, len(text) // 3)):
                at = r.randrange(len(text))
                if r.random() < 0.4:
                    text[at] = r.choice(vocabulary)
                elif r.random() < 0.5:
                    text.insert(at, r.choice(vocabulary))
                elif len(text) > 31:
                    text.pop(at)
            if r.random() < 0.3:
                r.shuffle(text)
            rows.append((f"p{g:03}-{v}", r.choice([None, "", "A title", " ".join(base[:4]).upper()]), (", " if r.random() < 0.3 else " ").join(text)))
    return rows


def pairs(df):
    assert df.columns == ["project_uid_a", "project_uid_b"]
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows)) and all(a < b for a, b in rows)
    return set(rows)


def test_same_pairs_as_brute_force(spark):
    rows = corpus()
    true, found = brute(rows), pairs(near_duplicates(frame(spark, rows)))
    assert found <= true and len(found) >= 0.97 * len(true) and len(true) > 50


def test_copies_nulls_and_long_texts(spark):
    text = " ".join(f"word{i}" for i in range(40))
    rows = [("b", "T", text), ("a", "t!", text.upper()), ("c", None, " ".join(reversed(text.split()))), ("b", "T", text), (None, "T", text), ("d", "T", None), ("e", "T", ""), ("f", "T", "too short"), ("g", None, "long " * 60_000), ("h", None, "long " * 59_000)]
    assert pairs(near_duplicates(frame(spark, rows))) == brute([r for r in rows if r[0]]) == {("a", "b"), ("a", "c"), ("b", "c"), ("g", "h")}


def test_large_classes_become_stars(spark):
    text = " ".join(f"word{i}" for i in range(40))
    rows = [(f"p{i}", "t", text) for i in range(9)] + [("q", "t", text + " more")]
    found = pairs(near_duplicates(frame(spark, rows), expand=5))
    assert found == {("p0", f"p{i}") for i in range(1, 9)} | {("p0", "q")}
    assert pairs(near_duplicates(frame(spark, rows))) == brute(rows)


def test_empty_table(spark):
    assert pairs(near_duplicates(frame(spark, []))) == set()
    assert pairs(near_duplicates(frame(spark, [("a", None, None)]))) == set()


@pytest.mark.parametrize("share", [0.2, 0.5, 0.8])
def test_sketch_estimates_jaccard_and_fills(share):
    r = np.random.default_rng(0)
    n, t = 400, 256
    common = int(n * 2 * share / (1 + share))
    a, b = r.integers(0, 2**63, n), r.integers(0, 2**63, n)
    b[:common] = a[:common]
    made = S.sketch(S.mix(np.concatenate([a, b, a[:1]]).astype(np.uint64)), np.repeat([0, 1, 2], [n, n, 1]), 4, t)
    full = np.iinfo(np.uint64).max
    assert (made[:3] != full).all() and (made[3] == full).all()
    assert abs((made[0] == made[1]).mean() - common / (2 * n - common)) < 0.12


def templates(shared, own, rows, seed=2):
    """Texts of ``shared`` equal words and ``own`` words each that hardly any other text has; half repeat another's with few changes."""
    r, out = random.Random(seed), []
    for i in range(rows):
        words = [f"own{r.randrange(10**6)}" for _ in range(own)]
        if i % 2:
            words[: own - 3] = out[-1][: own - 3]
        out.append(words)
    return [(f"p{i:03}", None, " ".join([f"shared{k}" for k in range(shared)] + words)) for i, words in enumerate(out)]


@pytest.mark.parametrize("hot", [10, 10_000])
@pytest.mark.parametrize("shared, own", [(48, 16), (40, 24)])
def test_hot_template_with_rare_edits(spark, shared, own, hot):
    rows = templates(shared, own, 80) + [("x", None, " ".join(f"other{k}" for k in range(64)))]
    true, found = brute(rows), pairs(near_duplicates(frame(spark, rows), hot=hot))
    assert len(true) == (80 * 79 // 2 if own == 16 else 40)
    assert found <= true and len(found) >= (1 if hot == 10 else 0.97) * len(true)


def test_filters_lose_no_pair(spark):
    rows = corpus(seed=3)
    true = brute(rows)
    assert pairs(near_duplicates(frame(spark, rows), bands=160, band_rows=1)) == true
    assert pairs(near_duplicates(frame(spark, rows), bands=160, band_rows=1, hot=1)) == true


@pytest.mark.parametrize("block", [2, 7])
def test_large_keys_in_blocks_lose_no_pair(spark, block):
    rows = corpus(seed=4) + templates(48, 16, 60)
    assert pairs(near_duplicates(frame(spark, rows), bands=160, band_rows=1, block=block)) == brute(rows)
    assert pairs(near_duplicates(frame(spark, rows), bands=160, band_rows=1, block=block, hot=1)) == brute(rows)


def test_only_identical_texts_of_large_classes_become_stars(spark):
    words = [f"word{i}" for i in range(40)]
    rows = [(f"p{i}", "t", " ".join(words[i:] + words[:i])) for i in range(8)] + [("q", "t", " ".join(words) + " more")]
    assert pairs(near_duplicates(frame(spark, rows), expand=5)) == brute(rows)
    copies = [(f"r{i}", "t", " ".join(words)) for i in range(3)]
    assert pairs(near_duplicates(frame(spark, rows + copies), expand=5)) == brute(rows) | {("p0", f"r{i}") for i in range(3)}


@pytest.mark.parametrize("frequent", [True, False])
def test_pairs_at_the_threshold_whose_edits_are_rare(spark, frequent):
    """Thirty shared words, frequent or not, and ten own ones: agreement is 0.75 exactly."""
    r = random.Random(6)
    rare = lambda: f"x{r.randrange(10**9)}"
    common = [f"c{i}" for i in range(60)]
    rows, true = [(f"f{i}", None, " ".join(r.choice(common) if r.random() < 0.7 else rare() for _ in range(40))) for i in range(400)], set()
    for i in range(300):
        shared = [r.choice(common) if frequent else rare() for _ in range(30)]
        for n in "ab":
            own = shared + [rare() for _ in range(10)]
            r.shuffle(own)
            rows.append((f"{n}{i:03}", None, " ".join(own)))
        true.add((f"a{i:03}", f"b{i:03}"))
    assert len(true & pairs(near_duplicates(frame(spark, rows)))) >= 0.99 * len(true)


def test_classes_and_links_hold_every_pair(spark):
    rows = corpus(seed=5, groups=30)
    rows += [(f"copy{i}", t, d) for i, (_, t, d) in enumerate(rows[:10])] + [("n", None, None)]
    members, links = near_duplicate_classes(frame(spark, rows), bands=160, band_rows=1)
    assert members.columns == ["project_uid", "class_key", "copies"] and links.columns == ["class_key_a", "class_key_b", "agreement"]
    of = {}
    for uid, c, n in members.collect():
        of.setdefault(c, []).append((uid, n))
    assert all(c == min(u for u, _ in m) and all(n == len(m) for _, n in m) for c, m in of.items())
    joined = [(a, b) for x, y, _ in links.collect() for a, _ in of[x] for b, _ in of[y]]
    within = [(a, b) for m in of.values() for a, _ in m for b, _ in m if a < b]
    assert {(min(p), max(p)) for p in joined} | set(within) == brute(rows)

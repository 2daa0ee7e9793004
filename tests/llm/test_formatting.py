"""Formatting copies against a plain Python grouping."""

import re
import unicodedata

from curlew.llm.formatting import collapse, copies

SCHEMA = "project_uid string, doi string, title string, id long, c string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "clash") for r in rows], SCHEMA)


def bare(value):
    return "".join(c for c in value.lower().replace("ß", "ss") if unicodedata.category(c)[0] in "LMN")


def brute(rows):
    groups = {}
    for key, doi, title in rows:
        if None in (key, doi, title):
            continue
        if re.search(r"10\.\d{4,9}/", doi):
            doi = re.sub(r"(?s)^.*?(?=10\.\d{4,9}/)", "", doi)
        elif re.search(r"10\.\d{4,9}/", title):
            title = re.sub(r"(?s)^.*?(?=10\.\d{4,9}/)", "", title)
        pair = tuple(sorted((bare(doi), bare(title))))
        if all(pair):
            groups.setdefault(pair, set()).add(key)
    return groups


ROWS = [
    ("b", "https://doi.example.org/10.1234/AB-c.", "The  Straße: a study"),
    ("a", "doi:10.1234/abc", "the strasse  a​study"),
    ("c", "The STRASSE; a study!", " <10.1234/ab.C> "),
    ("d", "10.1234/abd", "The Straße: a study"),
    ("e", "10.1234/abc", "Another"),
    ("f", None, "The Straße: a study"), ("g", "10.1234/abc", None), ("h", "", "x"), ("i", "-", "x"), ("j", "x", "  ​"), (None, "10.1234/abc", "the strasse a study"),
    ("k", "10.5555/q", "cites 10.1234/abc"), ("l", "urn:doi:10.5555/q", "Cites 10.1234/ABC."),
    ("m", "10.9999/long", "x" * 100_000), ("n", "(10.9999/LONG)", "X " * 100_000),
    ("b", "https://doi.example.org/10.1234/AB-c.", "The  Straße: a study"),
]


def test_groups(spark):
    groups = brute(ROWS)
    found = {(r[0], r[1], r[2]) for r in collapse(frame(spark, ROWS)).collect()}
    assert found == {(k, min(g), len(g)) for g in groups.values() for k in g}
    assert {tuple(r) for r in copies(frame(spark, ROWS)).collect()} == {("a", "b"), ("a", "c"), ("k", "l"), ("m", "n")}


def test_a_group_of_a_third_of_all_rows(spark):
    rows = [(f"p{i:05}", f"10.1234/{'x' if i % 3 == 0 else i}", "Same" if i % 3 == 0 else f"title {i}") for i in range(3000)]
    found = copies(frame(spark, rows)).collect()
    assert len(found) == 999 and {r[0] for r in found} == {"p00000"}


def test_empty_table(spark):
    assert copies(frame(spark, [])).count() == 0
    assert collapse(frame(spark, [("a", None, None)])).count() == 0

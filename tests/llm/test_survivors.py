"""Survivors by rule, and truth discovery, on small cases."""

from datetime import datetime

import pytest

from curlew.llm.survivors import claims_of, survivors, truth_discovery

PROJECTS = "project_uid string, source_database_id long, title string, doi string, description string, project_url string, score double, cluster_id string"
DECISIONS = "decision_id long, project_uid string, canonical_score double, decided_at_utc timestamp, cluster_id string"
MEMBERS = "cluster_id string, project_uid string, score double"


def day(n):
    return datetime(2025, 1, n)


def run(spark, members, decisions, projects):
    m = spark.createDataFrame([(*r, 9.0) for r in members], MEMBERS)
    d = spark.createDataFrame([(*r, "clash") for r in decisions], DECISIONS)
    p = spark.createDataFrame([(u, 1, None, None, text, url, 9.0, "clash") for u, text, url in projects], PROJECTS)
    out = survivors(m, d, p)
    assert out.columns == ["cluster_id", "field_name", "project_uid"]
    return {(r[0], r[1]): r[2] for r in out.collect()}


def test_rules(spark):
    members = [("k", "a"), ("k", "b"), ("k", "c"), ("k", "c"), ("k", "unknown"), (None, "a"), ("k", None), ("empty", "x"), ("tie", "t2"), ("tie", "t1")]
    decisions = [(1, "a", 9.0, day(1)), (2, "a", 3.0, day(2)), (3, "b", 5.0, day(1)), (4, "b", None, day(9)), (5, "c", 5.0, day(1)), (6, "t1", 1.0, day(1)), (7, "t2", 1.0, day(1)), (8, None, 99.0, day(1))]
    projects = [
        ("a", "a" + " " * 50, "https://host.example/path"),
        ("b", "See  TITLE ", "https://host.example"),
        ("c", "This record was imported automatically from somewhere and has not yet been described; please contact the help desk of the archive for details.", "see DOI"),
        ("t1", "same", "HTTP://h.example/x?y"), ("t2", "same", "http://h.example/x"), ("x", None, None),
    ]
    assert run(spark, members, decisions, projects) == {
        ("k", "record"): "b", ("k", "description"): "a", ("k", "project_url"): "a",
        ("tie", "record"): "t1", ("tie", "description"): "t1", ("tie", "project_url"): "t1",
    }


@pytest.mark.parametrize("url", [None, "", "https://", "https:///x", "file:///srv/x", "/record/1", "n/a", "mailto:a@b.example", "https://host.example", "https://host.example/"])
def test_unusable_links(spark, url):
    assert ("k", "project_url") not in run(spark, [("k", "a")], [(1, "a", 1.0, day(1))], [("a", "text", url)])


def test_empty_tables(spark):
    assert run(spark, [], [], []) == {}
    assert run(spark, [("k", "a")], [], []) == {}
    assert run(spark, [("k", "a")], [(1, "a", 1.0, None)], []) == {("k", "record"): "a"}


def test_truth_discovery_trusts_the_source_that_agrees(spark):
    claims = [(f"k{i}", "title", s, f"{s}{i}", v) for i in range(20) for s, v in (("good", f"v{i}"), ("fair", f"v{i}"), ("bad", f"w{i}"))]
    claims += [("z", "title", "good", "g", "right"), ("z", "title", "bad", "b", "wrong")]
    df = spark.createDataFrame(claims, "cluster_id string, field_name string, source string, project_uid string, value string")
    truth, reliability = truth_discovery(df)
    weights = {r[0]: r[1] for r in reliability.collect()}
    assert weights["good"] > weights["bad"] and weights["fair"] > weights["bad"]
    values = {r["cluster_id"]: r["value"] for r in truth.collect()}
    assert values["z"] == "right" and all(values[f"k{i}"] == f"v{i}" for i in range(20))
    empty, none = truth_discovery(df.limit(0))
    assert empty.count() == 0 and none.count() == 0


def test_claims_skip_what_says_nothing(spark):
    projects = spark.createDataFrame([("a", 1, "A title", "doi:10.1234/X", "n/a", "https://", 1.0, "c"), ("b", None, "A title", None, None, None, 1.0, "c")], PROJECTS)
    members = spark.createDataFrame([("k", "a", 1.0), ("k", "b", 1.0)], MEMBERS)
    assert {(r["field_name"], r["value"]) for r in claims_of(members, projects).collect()} == {("title", "atitle"), ("doi", "101234x")}


def test_stock_texts_are_learned_from_the_data(spark):
    """A sentence in a fourth language, with and without the name of its repository, that many unlike records share; copies of one study don't make stock."""
    stock = lambda n: f"Aucune description n’est disponible pour ce jeu de données; veuillez écrire au service de {n} pour tout renseignement."
    host = {"north": "https://www.northdepot.example/", "lumen": "https://lumen.example.org"}
    rows = [(f"s{i:02}", f"Title {i}", stock("northdepot" if i % 2 else "lumenrepo"), host["north" if i % 2 else "lumen"]) for i in range(12)]
    study = "A long account of a single study that was delivered many times by one and the same depositor over the years."
    rows += [(f"c{i:02}", f"The study, part {i % 3}", study, host["lumen"]) for i in range(30)]
    rows += [("a", "One", "short but true", host["lumen"]), ("n", None, None, None)]
    projects = spark.createDataFrame([(u, 1, t, None, d, None, r) for u, t, d, r in rows], "project_uid string, source_database_id long, title string, doi string, description string, project_url string, repository_url string")
    members = spark.createDataFrame([("k", "a"), ("k", "s00"), ("k", "s01"), ("m", "c00"), ("m", "a"), ("only", "s03"), ("only", "n")], "cluster_id string, project_uid string")
    decisions = spark.createDataFrame([], DECISIONS)
    assert {(r[0], r[1], r[2]) for r in survivors(members, decisions, projects).collect()} == {("k", "description", "a"), ("m", "description", "c00")}
    assert ("k", "description", "s00") not in {(r["cluster_id"], r["field_name"], r["project_uid"]) for r in claims_of(members, projects).collect()}

"""Stored tables, declared JSON, responses, and the guards of outputs."""

import json

import pytest
from pyspark.sql import functions as F

from curlew.operators import catalog, drift, gates, staging
from curlew.sources import records, responses
from curlew.sources.stored import Store, read_objects, read_totals


def test_store_survives_restarts_and_repeats(spark, tmp_path):
    schemas = {"a": "k long, v string", "b": "k long"}
    store = Store(spark, str(tmp_path), schemas)
    assert store.init() == ["a", "b"] and store.init() == [] and store.read("a").count() == 0
    rows = spark.createDataFrame([("1", "x", "more"), ("2", None, "more")], "k string, v string, other string")
    for run in ("r1", "r2", "r1"):
        store.append("a", rows, run)
    again = Store(spark, str(tmp_path), schemas)
    assert again.init() == [] and again.read("a").count() == 4 and again.read("a", "r1").columns == ["k", "v", "run_id"]
    assert again.read("a").schema["k"].dataType.simpleString() == "bigint"
    with pytest.raises(ValueError):
        again.append("a", rows.drop("v"), "r3")
    with pytest.raises(KeyError):
        again.read("c")
    again.reset("b", "a")
    assert again.read("a").count() == 0 and again.init() == []


def test_declared_json(spark, tmp_path):
    good, bad, broken = tmp_path / "good.json", tmp_path / "bad.json", tmp_path / "broken.json"
    good.write_text(json.dumps([{"id": 1, "name": "a", "more": 2}, {"id": 2, "name": "b"}]))
    bad.write_text(json.dumps([{"id": 1, "name": " "}, {"id": 2, "name": "b"}]))
    broken.write_text("[{")
    assert read_objects(spark, str(good), "id long, name string", ("name",)).count() == 2
    assert [r["id"] for r in read_objects(spark, str(bad), "id long, name string", ("name",), strict=False).collect()] == [2]
    assert read_objects(spark, str(broken), "id long, name string", strict=False).count() == 0
    with pytest.raises(Exception, match="lacks one of"):
        read_objects(spark, str(bad), "id long, name string", ("name",)).collect()
    with pytest.raises(Exception):
        read_objects(spark, str(broken), "id long, name string").collect()
    good.write_text(json.dumps({"A": {"total_internal_files": 3}, "B": {"total_internal_files": 0}}))
    bad.write_text(json.dumps({"A": {"total_internal_files": "3"}}))
    assert {tuple(r) for r in read_totals(spark, str(good)).collect()} == {("A", 3), ("B", 0)}
    with pytest.raises(Exception, match="no whole"):
        read_totals(spark, str(bad)).collect()


def test_responses(spark):
    empty = spark.createDataFrame([(None,), ("",), ("no json",), ("{}",), ('{"data": {"items": []}}',), ('{"data": null}',)], "body string")
    for read in (lambda d: responses.file_items(d, "https://r"), responses.dataset_items, responses.embedded_datasets):
        assert read(empty).count() == 0
    items = [{"name": "A.QDPX", "url": "u", "file_id": 5, "global_id": "", "identifier": "i"}, {"name": "b.qdp", "url": "v"}, {"name": "c.txt"}, {"name": None}]
    one = spark.createDataFrame([(json.dumps({"data": {"items": items}}),)], "body string")
    found = {(r["file_url"], r["doi"]) for r in responses.file_items(one, "https://r/").collect()}
    assert found == {("https://r/api/access/datafile/5", "i"), ("v", None)}
    told = [{"name": "x", "description": "coded in MAXQDA"}, {"name": "y", "description": "none"}]
    assert [r["title"] for r in responses.dataset_items(spark.createDataFrame([(json.dumps({"data": {"items": told}}),)], "body string")).collect()] == ["x"]
    hal = {"_embedded": {"stash:datasets": [{"title": "t", "identifier": "d"}, {"title": None}]}}
    assert {r["file_url"] for r in responses.embedded_datasets(spark.createDataFrame([(json.dumps(hal),)], "body string")).collect()} == {"d", "dryad"}
    api = spark.createDataFrame([("q", '[{"id": "7"}]', None), ("q", '{"items": [{"title": "t", "url": "u"}]}', None), ("q", None, "timeout"), ("q", "x", None)], "query string, body string, error string")
    assert {(r["file_url"], r["title"], r["status"]) for r in responses.exported_metadata(api).collect()} == {
        ("7", "ICPSR metadata result: q", "METADATA_API_FOUND"), ("u", "t", "METADATA_API_FOUND"), ("metadata-api:q", "ICPSR metadata API query: q", "METADATA_API_FAILED"),
    }


def test_member_rows(spark):
    values = [["a", " b ", "a", None], "c; d;;", {"id": "open", "x": 1}, {"name": "n"}, 5, True, None, "", [], {}]
    rows = spark.createDataFrame([(f"p{i}", json.dumps({"k": v})) for i, v in enumerate(values)] + [(None, '{"k": "z"}'), ("q", None), ("r", "no json"), ("s", "{}")], "uid string, raw string")
    found = {tuple(r) for r in staging.member_rows(rows, "raw", "k", "uid", "word").collect()}
    assert found == {("p0", "a"), ("p0", "b"), ("p1", "c"), ("p1", "d"), ("p2", "open"), ("p3", "n"), ("p4", "5"), ("p5", "true")}


def test_guards(spark, tmp_path):
    good = spark.createDataFrame([("a", True, "error"), ("b", False, "warning")], "name string, passed boolean, severity string")
    gates.require(good)
    with pytest.raises(ValueError, match="\\['c'\\]"):
        gates.require(good.unionByName(spark.createDataFrame([("c", False, "error")], good.schema)))
    gates.verify_output(good, ("name", "passed", "severity"), 2)
    for columns, rows in ((("passed", "name", "severity"), 2), (("name", "passed", "severity"), 3)):
        with pytest.raises(ValueError):
            gates.verify_output(good, columns, rows)
    assert records.exactly_one(good.where("passed"), "check").count() == 1
    for some in (good, good.limit(0)):
        with pytest.raises(ValueError):
            records.exactly_one(some, "check")
    registry = spark.createDataFrame([("b", 2), ("a", 1), ("b", 3)], "student_id string, registry_row long")
    assert [tuple(r) for r in records.probe_list(registry, ("b",), 1).collect()] == [("b", 2)] and records.probe_list(registry).count() == 3
    with pytest.raises(ValueError):
        records.probe_list(registry, limit=0)
    keys = gates.foreign_keys({"c": spark.createDataFrame([(1,), (2,), (None,), (2,)], "p long"), "p": spark.createDataFrame([("1",), (None,)], "p string")}, [("c", "p", "p")])
    assert [tuple(r) for r in keys.collect()] == [("c", "p", "p", 2)]


def test_archives_of_one_name_are_ambiguous(spark):
    projects = spark.createDataFrame([("x", "A.QDPX"), ("y", "b.qdpx"), ("z", "c.qdpx"), ("n", None)], "project_uid string, title string")
    archives = spark.createDataFrame([("/1/a.qdpx",), ("/2/a.qdpx",), ("/1/b.qdpx",)], "archive string")
    assert {tuple(r) for r in catalog.archive_of(projects, archives, exact=True).collect()} == {("x", "/1/a.qdpx", "AMBIGUOUS"), ("y", "/1/b.qdpx", "FOUND"), ("z", None, "ARCHIVE_NOT_FOUND")}


def test_the_latest_snapshot_is_the_one_named_last(spark, tmp_path):
    snapshot = lambda v: spark.createDataFrame([(v,)], "v long")
    for stamp, v in (("2024-01-01", 1), ("2024-01-02", 2)):
        drift.save_snapshot(snapshot(v), str(tmp_path), stamp)
    snapshot(3).write.parquet(f"{tmp_path}/history/ts=2024-01-03")  # a run that crashed before it named its snapshot
    assert drift.load_snapshot(spark, str(tmp_path)).first()["v"] == 2
    assert sorted(r["ts"].isoformat() for r in spark.read.parquet(f"{tmp_path}/history").select("ts").distinct().collect()) == ["2024-01-01", "2024-01-02", "2024-01-03"]
    assert catalog.by_count(spark.createDataFrame([("a", 1), ("b", 2), ("c", 2)], "k string, databases long")).select(F.col("k")).first()[0] == "b"

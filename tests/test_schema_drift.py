"""Ingestion with a rescue column, and the changes between deliveries."""

import json
from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from curlew.operators.schema_drift import FILE_FIELDS, PROJECT_FIELDS, consistent, drift_report, ingest, promote

DATABASES = "source_database_id long, source_student_id string, source_schema_signature string, registered_at_utc timestamp"


def projects_of(spark, rows):
    staged = {"title", "doi"}
    schema = "source_database_id long, source_table_name string, " + ", ".join(f"{c} string" for c in PROJECT_FIELDS) + ", raw_project_json string"
    return spark.createDataFrame([(d, t, *[v.get(c) if c in staged else None for c in PROJECT_FIELDS], j) for d, t, v, j in rows], schema)


def files_of(spark, rows):
    schema = "source_database_id long, source_table_name string, " + ", ".join(f"{c} {'long' if c == 'file_size_bytes' else 'string'}" for c in FILE_FIELDS) + ", raw_file_json string"
    return spark.createDataFrame([(d, t, *[v.get(c) for c in FILE_FIELDS], j) for d, t, v, j in rows], schema)


def databases_of(spark):
    day = lambda n: datetime(2024, 1, n)
    return spark.createDataFrame([(7, "a", "projects|files|notes", day(1)), (3, "a", " FILES | Projects | tags", day(2)), (9, "a", "records|files|tags", day(3)), (4, "b", None, day(1)), (None, "b", "x", day(2)), (5, None, "x", day(2))], DATABASES)


def test_changes(spark):
    projects = projects_of(spark, [
        (7, "projects", {"title": "t1", "doi": "d1"}, json.dumps({"title": "t1", "doi": "d1", "n": 1, "x": None, "tags": ["a"], "size": 2})),
        (7, "projects", {"title": "t2", "doi": "d2"}, json.dumps({"title": "t2", "doi": "d2", "n": None, "x": None, "tags": None, "size": 2.5})),
        (3, "projects", {"title": "t3", "doi": "d3"}, json.dumps({"name": "t3", "pid": "d3", "n": "1", "x": 5, "tags": {"a": 1}, "size": 1.5, "extra": True})),
        (3, "projects", {}, None), (3, "projects", {}, "not json"), (3, "projects", {}, "[1, 2]"), (None, "projects", {}, '{"z": 1}'),
        (9, "records", {"title": "t4"}, json.dumps({"name": "t4", "n": None, "tags": {"b": 2}, "size": 3, "x": 5})),
    ])
    files = files_of(spark, [
        (7, "files", {"file_size_bytes": 10, "file_name": "a"}, json.dumps({"file_name": "a", "file_size_bytes": 10})),
        (3, "files", {"file_size_bytes": 12, "file_name": "b"}, json.dumps({"label": "b", "size": 12, "mime": "x"})),
        (3, "files", {"file_size_bytes": 12, "file_name": "b"}, json.dumps({"label": "b", "size": 12, "mime": "x"})),
    ])
    found = {tuple(r) for r in drift_report(databases_of(spark), projects, files).collect()}
    assert found == {
        (3, "table", "removed", "notes", ""), (3, "table", "added", "", "tags"), (9, "table", "renamed", "projects", "records"),
        (3, "project", "renamed", "title", "name"), (3, "project", "renamed", "doi", "pid"), (3, "project", "added", "", "extra"),
        (3, "project", "type_changed", "n", "n"), (3, "project", "type_changed", "tags", "tags"),
        (9, "project", "removed", "pid", ""), (9, "project", "removed", "extra", ""), (9, "project", "type_changed", "size", "size"),
        (3, "file", "renamed", "file_name", "label"), (3, "file", "renamed", "file_size_bytes", "size"), (3, "file", "added", "", "mime"),
    }


def test_empty_tables(spark):
    empty = drift_report(databases_of(spark).limit(0), projects_of(spark, []), files_of(spark, []))
    assert empty.count() == 0
    only_tables = drift_report(databases_of(spark), projects_of(spark, []), files_of(spark, []))
    assert {r["entity"] for r in only_tables.collect()} == {"table"}


def test_rescue_and_promotion(spark):
    raw = ['{"title": "a", "n": "12", "odd": [1], "rating": 4.5}', '{"name": "b", "n": "many", "rating": "bad"}', '{"title": null, "name": 7}', "broken {", "[]", None, "{}", '{"title": "' + "x" * 200_000 + '"}']
    rows = spark.createDataFrame([(i, r, "clash", "clash") for i, r in enumerate(raw)], "id long, raw string, title string, _rescued string")
    target = T.StructType([T.StructField("title", T.StringType()), T.StructField("n", T.LongType())])
    done = ingest(rows, "raw", target, {"title": ["name"]})
    out = {r["id"]: r for r in done.collect()}
    rescued = {i: json.loads(r["_rescued"]) if r["_rescued"] else None for i, r in out.items()}
    assert (out[0]["title"], out[0]["n"], rescued[0]) == ("a", 12, {"odd": [1], "rating": 4.5})
    assert (out[1]["title"], out[1]["n"], rescued[1]) == ("b", None, {"n": "many", "rating": "bad"})
    assert (out[2]["title"], rescued[2]) == ("7", {"title": None})
    assert rescued[3] == {"_malformed": "broken {"} and rescued[4] == {"_malformed": "[]"}
    assert rescued[5] is None and rescued[6] is None and len(out[7]["title"]) == 200_000
    promoted = {r["id"]: r for r in promote(done, T.StructField("rating", T.DoubleType())).collect()}
    assert promoted[0]["rating"] == 4.5 and json.loads(promoted[0]["_rescued"]) == {"odd": [1]}
    assert promoted[1]["rating"] is None and json.loads(promoted[1]["_rescued"])["rating"] == "bad"
    assert promoted[0]["title"] == "a"


def test_a_name_is_approved_for_each_delivery_on_its_own(spark):
    """``label`` feeds the title in one delivery and the doi in another, and a third has it without any staged column's content."""
    rows = projects_of(spark, [
        (1, "p", {"title": "t1", "doi": "d1"}, json.dumps({"label": "t1", "doi": "d1"})), (1, "p", {"title": "t2"}, json.dumps({"label": "t2", "doi": None})),
        (2, "p", {"title": "t3", "doi": "d3"}, json.dumps({"title": "t3", "label": "d3"})), (2, "p", {"title": "t4", "doi": "d4"}, json.dumps({"title": "t4", "doi": "d4", "label": "old"})),
        *[(2, "p", {"doi": f"e{i}"}, json.dumps({"label": f"e{i}"})) for i in range(20)],
        (3, "p", {"title": "t5"}, json.dumps({"title": "t5", "label": "other"})), (3, "p", {}, None), (3, "p", {}, "no json"), (None, "p", {"title": "t6"}, json.dumps({"label": "t6"})),
    ]).withColumn("_rescued", F.lit("clash"))
    target = T.StructType([T.StructField(c, T.StringType()) for c in PROJECT_FIELDS])
    found = {(r["source_database_id"], r["title"], r["doi"], r["_rescued"]) for r in consistent(rows, "raw_project_json", target, ("source_table_name",)).collect()}
    assert {x for x in found if x[0] != 2} == {
        (1, "t1", "d1", None), (1, "t2", None, '{"doi":null}'), (3, "t5", None, '{"label":"other"}'), (3, None, None, None), (3, None, None, '{"_malformed":"no json"}'), (None, None, None, '{"label":"t6"}'),
    }
    assert {x for x in found if x[0] == 2} == {(2, "t3", "d3", None), (2, "t4", "d4", '{"label":"old"}'), *[(2, None, f"e{i}", None) for i in range(20)]}


def test_each_new_field_takes_the_place_of_one(spark):
    projects = projects_of(spark, [
        (7, "p", {"title": "t"}, json.dumps({"a": "t", "b": "t"})),
        (3, "p", {"title": "u"}, json.dumps({"c": "u"})),
        (9, "p", {"title": "v"}, json.dumps({"d": "v", "e": "v", "f": "v"})),
    ])
    found = {tuple(r) for r in drift_report(databases_of(spark), projects, files_of(spark, [])).where("entity = 'project'").collect()}
    assert found == {(3, "project", "renamed", "a", "c"), (3, "project", "removed", "b", ""), (9, "project", "renamed", "c", "d"), (9, "project", "added", "", "e"), (9, "project", "added", "", "f")}

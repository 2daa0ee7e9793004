"""Targets, outcomes, compatibility and keyed stores."""

import itertools

from pyspark.sql import functions as F

from curlew.operators import catalog


def test_download_targets(spark):
    rows = [(1, "a", "PEER_SHARED", "HTTP_ERROR", "http://x/a.db"), (2, "a", "PEER_SHARED", "ACCESSIBLE_SQLITE", "http://x/a2.db?d=1"), (3, "b", "PEER_SHARED", "HTTP_ERROR", ""), (4, "c", "MY_CORE", "ACCESSIBLE_SQLITE", "http://x/c.db"), (5, "d", "PEER_SHARED", "ACCESSIBLE_SQLITE", "http://x/")]
    validation = spark.createDataFrame(rows, "row_number int, source_student_id string, source_scope string, access_status string, metadata_url string")
    overrides = spark.createDataFrame([("b", "CONFIRMED_SQLITE", "http://y/b.db"), ("b", "OTHER", "http://z"), ("d", "CONFIRMED_SQLITE", " ")], "source_student_id string, status string, url string")
    found = {tuple(r) for r in catalog.download_targets(validation, overrides).collect()}
    assert found == {("a", "http://x/a2.db?d=1", "REGISTRY", "a2.db"), ("b", "http://y/b.db", "RECOVERY_OVERRIDE", "b.db"), ("d", "http://x/", "REGISTRY", "d-metadata.db")}


def test_download_status(spark):
    good = bytearray(b"SQLite format 3\x00...")
    rows = [(None, 200, 5, 5, good, "ok", None, "DOWNLOADED_VERIFIED"), (True, None, None, None, None, None, None, "ALREADY_VERIFIED"), (False, None, None, None, None, None, None, "EXISTING_FILE_INVALID"), (None, 404, None, None, None, None, None, "HTTP_ERROR"), (None, 200, 5, 6, good, "ok", None, "SIZE_MISMATCH"), (None, 200, None, 6, bytearray(b"html"), None, None, "NON_SQLITE_CONTENT"), (None, 200, None, 6, good, "broken", None, "SQLITE_CHECK_FAILED"), (None, None, None, None, None, None, "timeout", "DOWNLOAD_ERROR")]
    df = spark.createDataFrame(rows, "e boolean, h int, x long, s long, b binary, c string, r string, expected string")
    status = catalog.download_status(*[F.col(c) for c in "ehxsbcr"])
    assert [r[0] == r[1] for r in df.select(status, "expected").collect()] == [True] * len(rows)
    counts = {tuple(r) for r in catalog.outcomes(df.select("expected", "s"), "expected", size="s").collect()}
    assert ("SIZE_MISMATCH", 1, 6) in counts and ("HTTP_ERROR", 1, 0) in counts


def test_verification_and_compatibility(spark):
    have = spark.createDataFrame([("a", 1, "h"), ("b", 2, "h"), ("c", 3, "x")], "path string, length long, sha256 string")
    want = spark.createDataFrame([("a", 1, "h"), ("b", 9, "h"), ("c", 3, "h"), ("d", 1, "h")], "path string, bytes long, sha256 string")
    assert {tuple(r) for r in catalog.verified(want, have).collect()} == {("a", "VERIFIED"), ("b", "SIZE_MISMATCH"), ("c", "HASH_MISMATCH"), ("d", "MISSING")}
    profiles = spark.createDataFrame([("x", "projects", ["ID", "a"], ["ID"]), ("y", "projects", ["id ", "a"], ["id"]), ("y", "files", ["id"], []), ("z", None, None, None)], "source string, table_name string, columns array<string>, primary_key array<string>")
    found = catalog.compatibility(profiles)
    assert {tuple(r) for r in found["presence"].collect()} == {("projects", 2), ("files", 1)}
    assert {(r[0], r[1], r[2]) for r in found["columns"].collect()} == {("projects", "id", 2), ("projects", "a", 2), ("files", "id", 1)}
    assert found["layouts"].count() == 2 and found["keys"].count() == 2


def test_keyed_stores(spark):
    kv = lambda rows: spark.createDataFrame(rows, "key string, value string")
    changes = spark.createDataFrame([("a", "2", 1), ("a", "3", 2), ("c", "1", 1)], "key string, value string, n int")
    assert {tuple(r) for r in catalog.upsert(kv([("a", "1"), ("b", "1")]), changes, "key", "n").collect()} == {("a", "3"), ("b", "1"), ("c", "1")}
    assert catalog.upsert(kv([("a", "1")]), changes.limit(0), "key", "n").count() == 1
    s = lambda *ids: spark.createDataFrame([(i,) for i in ids], "source_student_id string")
    assert [r[0] for r in catalog.register(s("a"), s("a", "b")).collect()] == ["b"]
    u = lambda *urls: spark.createDataFrame([(x,) for x in urls], "url string")
    assert [r[0] for r in catalog.existing(u("HTTP://x/", "http://y", None), u("http://x", "http://x//", None)).collect()] == ["HTTP://x/"]
    projects = spark.createDataFrame([("p", "Codes.QDPX "), ("q", "gone.qdpx"), ("r", "a title")], "project_uid string, title string").withColumn("title", F.trim("title"))
    archives = spark.createDataFrame([("/b/codes.qdpx",), ("/a/CODES.qdpx",)], "archive string")
    assert {tuple(r) for r in catalog.archive_of(projects, archives).collect()} == {("p", "/a/CODES.qdpx", "FOUND"), ("q", None, "ARCHIVE_NOT_FOUND")}


def test_report_matches(spark):
    run = spark.createDataFrame([("r", 3)], "run_id string, n long")
    for status, n in itertools.product(("UNCHANGED", "CHANGED"), (3, 4)):
        report = spark.createDataFrame([(status, "r", n)], "status string, run_id string, n long")
        assert catalog.report_matches(report, run, ("run_id", "n")).first()["passed"] == (status == "UNCHANGED" and n == 3)
    assert not catalog.report_matches(report.limit(0), run, ("run_id", "n")).first()["passed"]

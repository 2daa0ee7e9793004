"""Duplicates, classification, drift, gates and delivery on small fixtures."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from curlew.operators import classify, dedup, drift, gates, staging
from curlew.plans import delivery

PROJECTS = "project_uid string, source_database_id long, source_project_id string, repository_id string, repository_url string, project_url string, title string, description string, doi string, language string, upload_date string"
FILES = "file_uid string, source_database_id long, source_file_id string, project_uid string, file_name string"
TITLE = "A long study’s title about rivers"


def tables(spark):
    projects = spark.createDataFrame([
        ("a", 1, "1", "5", "r", "u", TITLE, "text", "https://doi.org/10.1234/ABC", "en", "2020"), ("b", 2, "1", "5", None, "u", "A long study's title  about rivers", "", "doi:10.1234/abc.", None, ""),
        ("c", 3, "1", None, None, None, "Another long title that stands alone", None, None, None, None), (None, 3, "2", None, None, None, None, None, None, None, None),
    ], PROJECTS)
    sources = spark.createDataFrame([(1, "peer-a", "PEER_SHARED"), (2, "peer-b", "PEER_SHARED"), (3, "core", "MY_CORE"), (4, "idle", "PEER_SHARED")], "source_database_id long, source_student_id string, source_scope string")
    files = spark.createDataFrame([("f1", 1, "1", "a", "x.txt"), ("f1", 1, "1", "a", "x.txt"), ("f2", 3, "2", "c", "y.mod"), ("f3", 3, " ", None, "z"), ("f4", 3, "4", "gone", None)], FILES)
    return projects, sources, files


def test_registry(spark):
    found = dedup.candidates(*tables(spark))
    cluster = dedup.clusters(found).collect()
    assert len(cluster) == 1 and cluster[0]["canonical_project_uid"] == "a" and cluster[0]["raw_member_count"] == 2 and cluster[0]["unique_student_count"] == 2
    members = {r["project_uid"]: (r["cluster_id"], r["member_rank"], r["is_canonical"]) for r in dedup.cluster_members(found).collect()}
    assert members == {"a": (cluster[0]["cluster_id"], 1, 1), "b": (cluster[0]["cluster_id"], 2, 0)}
    assert dedup.clusters(found.limit(0)).count() == 0


@pytest.mark.parametrize("counts,expected", [((0, 0, 0, 0), "DATASET_LIKE"), ((4, 8, 0, 1), "FILE_LEVEL_LIKELY"), ((4, 6, 2, 0), "FILE_LEVEL_LIKELY"), ((4, 9, 0, 1), "MIXED_OR_REVIEW"), ((20, 90, 3, 0), "MIXED_OR_REVIEW"), ((20, 90, 2, 0), "DATASET_LIKE")])
def test_granularity(spark, counts, expected):
    assert spark.range(1).select(dedup.granularity(*[F.lit(c) for c in counts])).first()[0] == expected


def test_resolution_gate_and_summary(spark):
    projects, sources, files = tables(spark)
    members = spark.createDataFrame([("k", "a"), ("k", "b"), ("k", "b"), ("k", "unknown"), ("one", "c"), (None, "c")], "cluster_id string, project_uid string")
    decided = dedup.decisions(projects, sources, files, members)
    rows = {r["project_uid"]: r for r in decided.collect()}
    assert {u: r["decision"] for u, r in rows.items()} == {"a": "CANONICAL_RECORD", "b": "EXCLUDED_FROM_DEDUPLICATED_ANALYSIS", "c": "RETAINED_FOR_REVIEW"}
    assert rows["b"]["canonical_project_uid"] == "a" and rows["a"]["canonical_score"] == 4 + 3 + 1 + 2 + 0.5 + 0.5 + 0.25 and rows["c"]["decision_reason"] == "Cluster has fewer than two records."
    tags = dedup.decision_tags(decided)
    assert {r["tag"] for r in tags.where("project_uid = 'b'").collect()} == {"CONFIRMED_DUPLICATE", "EXACT_IDENTIFIER_DUPLICATE", "EXCLUDED_FROM_DEDUPLICATED_ANALYSIS"}
    summary = {r["source_scope"]: tuple(r)[1:] for r in dedup.scope_summary(decided).collect()}
    assert summary == {"MY_CORE": (1, 1, 1, 0, 1), "PEER_SHARED": (2, 2, 1, 1, 1)}
    checks = gates.dedup_gate(projects, decided, tags)
    assert gates.report(checks).first()["passed"]
    broken = gates.dedup_gate(projects, decided.where("decision <> 'CANONICAL_RECORD'"), tags)
    assert {r["name"] for r in broken.where("not passed").collect()} == {"decision_coverage", "count_conservation", "excluded_records_have_canonical_replacement"}
    unique = {r["decision"] for r in dedup.decisions(projects, sources, files, members.limit(0)).collect()}
    assert unique == {"UNIQUE_RECORD"}


def test_both_canonical_orders_may_differ(spark):
    projects, sources, files = tables(spark)
    more = projects.unionByName(spark.createDataFrame([("z", 3, "3", "5", None, None, TITLE, None, "10.1234/abc", None, None)], PROJECTS))
    found = dedup.candidates(more, sources, files)
    assert dedup.clusters(found).first()["canonical_project_uid"] == "z"  # the core scope comes first in the registry
    members = dedup.cluster_members(found).select("cluster_id", "project_uid")
    assert dedup.decisions(more, sources, files, members).where("decision = 'CANONICAL_RECORD'").first()["project_uid"] == "a"


def test_run_fingerprints(spark):
    rows = [("r1", i, f"p{i}", f"p{i}", "D", "E", 1.0) for i in range(40)]
    df = spark.createDataFrame(rows, "run_id string, decision_id long, project_uid string, canonical_project_uid string, decision string, evidence_rule string, canonical_score double")
    base = dedup.run_fingerprints(df).first()
    assert tuple(dedup.run_fingerprints(df.repartition(7).orderBy(F.rand(3))).first()) == tuple(base) and base["decision_records"] == 40
    assert dedup.run_fingerprints(df.withColumn("decision", F.when(F.col("project_uid") == "p3", "X").otherwise(F.col("decision")))).first()[2] != base[2]
    assert dedup.run_fingerprints(df.unionByName(df.limit(1))).first()[2] != base[2]
    runs = spark.createDataFrame([("r1", "v1", datetime(2024, 1, 1)), ("r2", "v1", datetime(2024, 1, 2)), ("r3", "v2", datetime(2024, 1, 3))], "run_id string, resolution_version string, created_at_utc timestamp")
    both = df.unionByName(df.withColumn("run_id", F.lit("r2")))
    assert {r["run_id"]: r["status"] for r in drift.run_drift(dedup.run_fingerprints(both), runs).collect()} == {"r1": "BASELINE_CREATED", "r2": "UNCHANGED", "r3": "RESOLUTION_VERSION_CHANGED"}
    assert dedup.latest_run(runs).first()["run_id"] == "r3"


def test_project_types(spark):
    cases = {
        "high": (["x.qdpx", "a.txt"], "t", "QDA_PROJECT", "HIGH_CONFIDENCE_QDA_EXTENSION"), "amb": (["x.mod"], "with NVivo", "QDA_PROJECT", "CONTEXT_VALIDATED_AMBIGUOUS_QDA_EXTENSION"),
        "amb_name": (["nvivo_x.mod"], "t", "QDA_PROJECT", "CONTEXT_VALIDATED_AMBIGUOUS_QDA_EXTENSION"), "amb_no": (["x.mod"], "t", "OTHER_PROJECT", "FILE_RECORD_WITHOUT_QDA_OR_PRIMARY_EVIDENCE"),
        "meta": (["x.xml"], "Metadata Export", "OTHER_PROJECT", "METADATA_ONLY_FILE_WITHOUT_PRIMARY_DATA"), "meta_no": (["x.xml", "y.txt"], "metadata export", "QD_PROJECT", "PRIMARY_DATA_EXTENSION"),
        "prim": (["x.csv"], None, "QD_PROJECT", "PRIMARY_DATA_EXTENSION"), "none": ([], None, "NOT_A_PROJECT", "NO_FILE_RECORD"), "null": ([None], "", "OTHER_PROJECT", "FILE_RECORD_WITHOUT_QDA_OR_PRIMARY_EVIDENCE"),
    }
    projects = spark.createDataFrame([(u, c[1], None) for u, c in cases.items()], "project_uid string, title string, description string")
    files = spark.createDataFrame([(f"{u}{i}", u, n) for u, c in cases.items() for i, n in enumerate(c[0])] + [("x", None, "a.qdpx")], "file_uid string, project_uid string, file_name string")
    assert {r["project_uid"]: (r["project_type"], r["classification_rule"]) for r in classify.project_types(projects, files).collect()} == {u: c[2:] for u, c in cases.items()}
    audit = {r["bucket"]: r["projects"] for r in classify.evidence_audit(projects, files).collect()}
    assert audit == {"strong": 1, "contextual": 2, "ambiguous_unconfirmed": 1, "primary_data": 3, "other_files": 2, "no_files": 1, "all": 9}
    assert classify.project_types(projects.limit(0), files).count() == 0


def test_term_classes(spark):
    cases = {"l": "Charging Document and PROSECUTION", "tie": "charging document prosecution safecast aireas", "r": "Safecast, AiREAS, citizen sensing and a defendant", "one": "a defendant", "both": "a defendant and safecast", "none": "nothing", "null": None}
    texts = spark.createDataFrame(list(cases.items()), "file_key string, text string")
    strict = {r["file_key"]: (r["division"], round(r["confidence"], 2)) for r in classify.classify_terms(texts, "file_key", ("text",)).collect()}
    assert strict == {"l": ("69", 0.88), "tie": ("69", 0.88), "r": ("72", 0.92)}
    projects = spark.createDataFrame([("p", "72", 0.9)], "project_uid string, division string, confidence double")
    files = spark.createDataFrame([(k, "p" if k != "none" else "q") for k in cases], "file_key string, project_uid string")
    found = {r["file_key"]: (r["division"], r["rule"], round(r["confidence"], 2)) for r in classify.file_classes(files, texts, projects).collect()}
    assert found["one"] == ("69", "SINGLE_TERM", 0.8) and found["both"] == ("72", "PROJECT_CONTEXT_FALLBACK", 0.78) and found["null"] == found["both"] and "none" not in found


def test_drift_and_snapshots(spark, tmp_path):
    now = spark.createDataFrame([("same", "m", "c"), ("meta", "m2", "c"), ("class", "m", "c2"), ("new", "m", "c")], "project_uid string, metadata_sha256 string, classification_sha256 string")
    before = spark.createDataFrame([("same", "m", "c"), ("meta", "m", "c"), ("class", "m", "c"), ("gone", "m", "c")], now.schema)
    assert drift.load_snapshot(spark, str(tmp_path / "s")) is None
    drift.save_snapshot(before, str(tmp_path / "s"), "1")
    found = {r[0]: (r["status"], r["reclassification_required"]) for r in drift.project_drift(now, drift.load_snapshot(spark, str(tmp_path / "s"))).collect()}
    assert found == {"same": ("UNCHANGED", False), "meta": ("RECLASSIFICATION_REQUIRED", True), "class": ("CLASSIFICATION_OUTPUT_CHANGED", False), "new": ("BASELINE_CREATED", False)}
    assert {r[0]: r[1] for r in drift.project_drift(now, before, removed=True).collect()}["gone"] == "REMOVED"
    archive = "archive string, archive_sha256 string, manifest_sha256 string, zip_status string"
    one = drift.archive_drift(spark.createDataFrame([("a", "x", None, "OK")], archive), spark.createDataFrame([("a", "y", None, "OK")], archive)).first()
    assert one["reasons"] == "ARCHIVE_CHANGED" and one["reclassification_required"]


def test_staging_issues_and_audit(spark):
    projects, sources, files = tables(spark)
    found = {(r["entity_uid"], r["issue_code"]) for r in staging.issues(files, projects).collect()}
    assert found == {("f3", "MISSING_SOURCE_ID"), ("f3", "MISSING_PROJECT_REFERENCE"), ("f4", "ORPHAN_PROJECT_REFERENCE")}
    audit = {r["source_database_id"]: tuple(r)[1:] for r in staging.import_audit(projects, files, sources).collect()}
    assert audit[1] == (1, 1, 2, 1, "COMPLETED") and audit[4] == (0, 0, 0, 0, "COMPLETED") and audit[3][4] == "FAILED"
    raw = spark.createDataFrame([("k", '{"titel": " x ", "taal": "nl", "more": 1}'), ("n", None)], "project_uid string, raw string")
    staged = {r["project_uid"]: r for r in staging.stage(raw, "raw", {"title": ["project_title", "titel"], "language": ["lang", "taal"]}, ("project_uid",)).collect()}
    assert (staged["k"]["title"], staged["k"]["language"], staged["k"]["_rescued"]) == ("x", "nl", '{"more":1}') and staged["n"]["title"] is None
    assert staging.repeated_keys(files, "file_uid").collect()[0]["copies"] == 2


def test_delivery(spark):
    projects, sources, files = tables(spark)
    projects = projects.where("project_uid is not null")
    types = classify.project_types(projects, files)
    manifest = spark.createDataFrame([(TITLE, 9)], "title string, total_internal_files long")
    assert {r["project_uid"]: r["no_project_files"] for r in delivery.export_rows(projects, files, types, manifest).collect()} == {"a": 9, "b": 0, "c": 1}
    classes = spark.createDataFrame([("a", "69", datetime(2024, 1, 1))], "project_uid string, primary_division_code string, classified_at_utc timestamp")
    delivered = delivery.delivery_projects(projects, types, classes).orderBy("id").collect()
    assert [(r["id"], r["project_uid"], r["primary_division_code"]) for r in delivered] == [(1, "a", "69"), (2, "b", None)]
    columns = "repository, dataset_url, qda_url, title, description, doi, download_timestamp, local_directory, local_qda_filename, file_type, download_status, error_message, uploader_name, license".split(", ")
    ledger = spark.createDataFrame([
        ("DANS", "u1", "q1", "T", None, "10.1/x", "t", "data/raw/dans/p", "a.b.qdpx", None, "ok", None, " ", "CC"), ("other", None, "q2", None, "d", " ", "t", "p", "f", "TXT", None, "Login needed", "Ann", None),
        ("zenodo", "u1", "q3", "S", "d", "http://x", "t", "p", None, " ", None, "too LARGE", None, "CC"),
    ], ", ".join(f"{c} string" for c in columns))
    out = delivery.migrate_ledger(ledger)
    assert {(r["repository_id"], r["project_url"], r["title"], r["doi"], r["download_project_folder"]) for r in out["projects"].collect()} == {(5, "u1", "T", "https://doi.org/10.1/x", "p"), (0, "q2", "f", None, "p"), (99, "u1", "S", "http://x", "p")}
    assert sorted((r["file_type"], r["status"]) for r in out["files"].collect()) == [("b.qdpx", "SUCCEEDED")] * 2 + [("txt", "FAILED_LOGIN_REQUIRED")] + [("unknown", "FAILED_TOO_LARGE")] * 2
    assert out["licenses"].count() == 2 and [r["name"] for r in out["person_roles"].collect()] == ["Ann"]


def test_distribution_gate(spark):
    d = lambda *rows: spark.createDataFrame(rows, "key string, value long")
    failed = gates.distribution_gate(d(("a", 1), ("b", 2)), d(("a", 1), ("b", 3), ("c", 1)), "x").where("not passed")
    assert {r["name"] for r in failed.collect()} == {"x:b", "x:c"}
    assert gates.required_columns({"t": d(("a", 1))}, {"t": ("key", "z"), "u": ("y",)}) == [("t", "z"), ("u", "y")]

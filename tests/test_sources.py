"""Sources on small files built here."""

import random
import sqlite3
import zipfile
from datetime import datetime

import pytest

from curlew.sources import archives, ledger, records, sqlite_ro
from curlew.streaming import ingest


@pytest.fixture()
def database(tmp_path):
    path = tmp_path / "12345678_meta.db"
    with sqlite3.connect(path) as c:
        c.execute("CREATE TABLE PROJECTS (id INTEGER PRIMARY KEY, Title TEXT, blob BLOB)")
        c.execute('CREATE TABLE "od""d" (a)')
        c.executemany("INSERT INTO PROJECTS VALUES (?, ?, ?)", [(1, "é", b"\xff\x00"), (2, None, None)])
    c.close()
    return str(path)


def test_sqlite_rows_and_profile(spark, database, tmp_path):
    sqlite_ro.register(spark)
    rows = spark.read.format("sqlite_ro").option("paths", database).option("table", "projects").load().collect()
    assert sorted(r["row"]["id"] for r in rows) == ["1", "2"] and {r["table_name"] for r in rows} == {"projects"}
    assert rows[0]["raw_json"] == '{"blob": {"bytes_hex": "ff00"}, "id": 1, "title": "é"}' and rows[1]["row"]["title"] is None
    bad = tmp_path / "bad.db"
    bad.write_text("no database " * 200)
    profile = {(r["source"], r["table_name"]): r for r in spark.read.format("sqlite_ro").option("paths", f"{database},{bad}").option("mode", "profile").load().collect()}
    projects = profile[(database, "projects")]
    assert (projects["quick_check"], projects["row_count"], projects["columns"], projects["primary_key"]) == ("ok", 2, ["id", "Title", "blob"], ["id"])
    assert profile[(database, 'od"d')]["row_count"] == 0 and "DatabaseError" in profile[(str(bad), None)]["error"]
    assert spark.read.format("sqlite_ro").option("paths", database).option("table", "missing").load().count() == 0


def test_archives(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.qdpx", "w") as z:
        for name, data in (("sources/interview.txt", "x" * 20_500), ("sources/empty.txt", " "), ("project.qde", "<p/>"), ("notes/ignored.txt", "n"), ("__MACOSX/x.txt", "r"), ("sources/.hidden", "h"), ("sources/audio.mp3", "m")):
            z.writestr(name, data)
    (tmp_path / "b.qdpx").write_text("plain")
    entries = archives.read_archives(spark, str(tmp_path)).cache()
    texts = {r["entry"]: (r["text_status"], len(r["text"] or "")) for r in entries.collect() if r["text_status"]}
    assert texts == {"sources/interview.txt": ("EXTRACTED", 20_000), "sources/empty.txt": ("EMPTY_TEXT", 0)}
    name = lambda r: r["archive"].rsplit("/", 1)[1]
    totals = {name(r): (r["total_internal_files"], r["project_files"], r["primary_files"]) for r in archives.file_totals(entries).collect()}
    assert totals == {"a.qdpx": (5, 1, 3), "b.qdpx": (0, 0, 0)}
    hashes = {name(r): r for r in archives.manifests(entries).collect()}
    assert hashes["b.qdpx"]["zip_status"] == "NOT_A_ZIP_CONTAINER" and hashes["b.qdpx"]["manifest_sha256"] is None
    assert hashes["a.qdpx"]["manifest_sha256"] == archives.manifests(entries.repartition(5)).where("zip_status = 'OK'").first()["manifest_sha256"]
    assert {(r["extension"], r["files"]) for r in archives.extension_totals(entries).collect()} == {("txt", 3), ("qde", 1), ("mp3", 1)}
    assert archives.extraction_summary(entries).count() == 2


def sequential(rows, before=()):
    urls, hashes, kept = {u.strip().rstrip("/").lower() for u, _ in before if u}, {s for _, s in before if s}, []
    for i, u, s in sorted(rows):
        key = u.strip().rstrip("/").lower() if u is not None else None
        if (key is None or key not in urls) and (s is None or s not in hashes):
            kept.append(i)
            urls.add(key), hashes.add(s)
    return kept


def test_ledger_keeps_what_sequential_inserts_keep(spark):
    r = random.Random(2)
    rows = [(i, r.choice([None, *(f"HTTP://x/{j}/" for j in range(25))]), r.choice([None, *(f"s{j}" for j in range(25))])) for i in range(120)]
    rows += [(1000, "u1", "s1-"), (1001, "u2", "s1-"), (1002, "u2", "s3-")]
    df = spark.createDataFrame(rows, "arrival long, url string, sha256 string")
    kept = sorted(x["arrival"] for x in ledger.accepted(df).collect())
    assert kept == sequential(rows) and {1000, 1002} <= set(kept) and 1001 not in kept
    before = [("http://x/1", "s9"), (None, "s3-"), ("u1", None)]
    known = spark.createDataFrame(before, "url string, sha256 string")
    assert sorted(x["arrival"] for x in ledger.accepted(df, known).collect()) == sequential(rows, before)
    assert ledger.accepted(df.limit(0)).count() == 0


def test_records(spark, tmp_path):
    (tmp_path / "r.csv").write_text(' Student_ID ,metadata_url,base_data\n12345678.0,https://github.com/u/r/blob/main/x.db,"a/b; https://drive.google.com/x"\n12,,\n')
    rows = records.registry(records.read_csv_strings(spark, str(tmp_path / "r.csv"), ("student_id",))).orderBy("student_id").collect()
    assert [(r["student_id"], r["valid"], r["url_changed"], r["copies"]) for r in rows] == [("12", False, False, 1), ("12345678", True, True, 1)]
    assert [b["provider"] for b in rows[1]["base_data"]] == ["LOCAL_OR_RELATIVE_PATH", "GOOGLE_DRIVE"]
    with pytest.raises(ValueError):
        records.read_csv_strings(spark, str(tmp_path / "r.csv"), ("other",))
    html = """<a class=x href="/f.zip;jsessionid=1?x">Get <b>it</b></a><A HREF='/oai'>DDI</A><a href="/f.zip?x">again</a><a href="/studies/12">s</a><a href="/studies/12">s</a>"""
    pages = spark.createDataFrame([(1, html), (2, None), (3, "none")], "page_id long, html string")
    assert {(r["href"], r["label"], r["kind"]) for r in records.anchors(pages).collect()} == {("/f.zip?x", "Get  it", "OTHER"), ("/oai", "DDI", "METADATA"), ("/studies/12", "s", "OTHER")}
    assert [r[0] for r in pages.orderBy("page_id").select(records.study_ids("html", ("7",))).collect()] == [["12"], ["7"], ["7"]]
    body = '{"hits": {"hits": [{"id": 5, "metadata": {"title": "t", "publication_date": "2020-05", "license": {"id": "cc"}}, "files": [{"key": "a.qdpx", "links": {"self": "u"}}, {"key": "a.txt", "links": {"self": "v"}}]}, {"id": 6, "metadata": {"title": "s", "license": "mit"}, "files": [{"key": "b.QDPX", "links": {"self": "w"}}]}]}}'
    out = {tuple(r) for r in records.repository_files(spark.createDataFrame([(body,), ("{}",)], "body string"), ("qdpx",)).collect()}
    assert out == {("5", "t", "a.qdpx", "u", "cc", 2020), ("6", "s", "b.QDPX", "w", "mit", None)}
    files = spark.createDataFrame([("/x/12345_a.db", 1024 * 1024), ("/x/2_b.sqlite", 10), ("/x/2_b.sqlite-wal", 10)], "path string, length long")
    assert records.catalog_summary(records.catalog_files(files)).first()[:3] == (2, 2, 1024 * 1024 + 10)


def test_streaming(spark, tmp_path):
    at = lambda m: datetime(2024, 1, 1, 0, m)
    source = str(tmp_path / "in")
    spark.createDataFrame([(1, at(1), "a"), (1, at(2), "a"), (2, at(3), "b")], "id long, ts timestamp, kind string").coalesce(1).write.parquet(source)
    stream = ingest.read_deliveries(spark, source, spark.read.parquet(source).schema)
    ingest.ingest_deliveries(ingest.without_redelivery(stream, "id", "ts"), str(tmp_path / "out"), str(tmp_path / "cp"))
    assert sorted(r["id"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [1, 2]
    assert ingest.counts_by_window(spark.read.parquet(source), "ts", "kind").count() == 2

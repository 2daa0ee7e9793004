"""Queries of sources, catalogs and stored tables, over inputs made from the driver's tables, with their SQL.

SQLite files and archives are fixtures made of the two smallest tables, whose size
is fixed; everything else runs over whole tables.
"""

from __future__ import annotations

import io
import os
import sqlite3
import uuid
import zipfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curlew.functions import text as X
from curlew.functions import urls as U
from curlew.operators import catalog, classify, dedup, drift
from curlew.oracles import strip
from curlew.plans import delivery
from curlew.session import materialize, shared_dir, table
from curlew.sources import archives, ledger, records, responses, sqlite_ro, stored

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _place(spark: SparkSession, name: str) -> str:
    """A new folder in the shared folder, as a path for Python; only where that is a file system path."""
    folder = f"{shared_dir(spark)}/curlew/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    if "://" in folder and not folder.startswith("file://"):
        raise RuntimeError("fixtures of SQLite files and archives need a shared folder that is a file system path")
    path = folder.removeprefix("file://").removeprefix("file:")
    os.makedirs(path, exist_ok=True)
    return path


# SQLite files.


def _sqlite(spark: SparkSession, sf_dir: str) -> str:
    """A database of the nation and region tables (30 rows at any scale)."""
    path = f"{_place(spark, 'sqlite')}/small.db"
    connection = sqlite3.connect(path)
    for name, key in (("nation", "n_nationkey"), ("region", "r_regionkey")):
        rows = table(spark, sf_dir, name)
        connection.execute(f"CREATE TABLE {name.upper()} ({', '.join(c.upper() + (' INTEGER PRIMARY KEY' if c == key else '') for c in rows.columns)})")
        connection.executemany(f"INSERT INTO {name.upper()} VALUES ({', '.join('?' * len(rows.columns))})", [tuple(r) for r in rows.collect()])
    connection.commit()
    connection.close()
    sqlite_ro.register(spark)
    return path


@query("SELECT 'nation' AS table_name, n_nationkey::VARCHAR AS key, n_name AS name, n_regionkey::VARCHAR AS region FROM nation UNION ALL SELECT 'region', r_regionkey::VARCHAR, r_name, NULL FROM region")
def s_sqlite_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.format("sqlite_ro").option("paths", _sqlite(spark, sf_dir)).load()
    at = lambda c: F.try_element_at("row", F.lit(c))
    return rows.select("table_name", F.coalesce(at("n_nationkey"), at("r_regionkey")).alias("key"), F.coalesce(at("n_name"), at("r_name")).alias("name"), at("n_regionkey").alias("region"))


@query("SELECT 'nation' AS table_name, count(*) AS row_count, 'ok' AS quick_check, 'N_NATIONKEY' AS primary_key FROM nation UNION ALL SELECT 'region', count(*), 'ok', 'R_REGIONKEY' FROM region")
def s_sqlite_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.format("sqlite_ro").option("paths", _sqlite(spark, sf_dir)).option("mode", "profile").load()
    return rows.select("table_name", "row_count", "quick_check", F.array_join("primary_key", "|").alias("primary_key"))


# Archives.


def _archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries of one archive for each region: a project file, a text for each nation, and entries that don't count."""
    nations = table(spark, sf_dir, "nation").select("n_regionkey", "n_name").collect()  # 25 rows at any scale
    rows = []
    for key in sorted({r["n_regionkey"] for r in nations}):
        data = io.BytesIO()
        with zipfile.ZipFile(data, "w") as z:
            z.writestr("project.qde", f"<Project name='{key}'/>")
            z.writestr("__MACOSX/x", "")
            z.writestr("sources/.hidden", "")
            for r in nations:
                if r["n_regionkey"] == key:
                    z.writestr(f"sources/{r['n_name']}.txt", f"  about\n\n {r['n_name']}  ")
        rows.append((f"{key}.qdpx", bytearray(data.getvalue())))
    rows.append(("broken.qdpx", bytearray(b"no archive")))
    return materialize(archives.read_entries(spark.createDataFrame(rows, "path string, content binary")), "entries")


@query("SELECT n_regionkey || '.qdpx' AS archive, count(*) + 1 AS total_internal_files, 1::BIGINT AS project_files, count(*) AS primary_files FROM nation GROUP BY n_regionkey UNION ALL SELECT 'broken.qdpx', 0, 0, 0")
def s_archive_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archives.file_totals(_archives(spark, sf_dir))


@query("SELECT n_regionkey || '.qdpx' AS archive, '<Project name=''' || n_regionkey || '''/>' AS project_text, string_agg('sources/' || n_name || '.txt', '|' ORDER BY n_name) AS files FROM nation GROUP BY n_regionkey UNION ALL SELECT 'broken.qdpx', '', ''")
def s_archive_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archives.project_contents(_archives(spark, sf_dir)).select("archive", "project_text", F.array_join("primary_files", "|").alias("files"))


@query("SELECT 'EXTRACTED' AS text_status, 'txt' AS extension, count(*) AS files, sum(length('about ' || n_name))::BIGINT AS characters FROM nation")
def s_archive_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archives.extraction_summary(_archives(spark, sf_dir))


@query("SELECT n_regionkey || '.qdpx' AS archive, 'OK' AS zip_status, count(*) + 3 AS internal_files, true AS hashed FROM nation GROUP BY n_regionkey UNION ALL SELECT 'broken.qdpx', 'NOT_A_ZIP_CONTAINER', 0, false")
def s_archive_manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archives.manifests(_archives(spark, sf_dir)).select("archive", "zip_status", "internal_files", F.col("manifest_sha256").isNotNull().alias("hashed"))


# Responses of repositories: one response for each row of a staging table.


@query("""
SELECT 'dans' AS repository, file_url AS record_url, coalesce('https://repo.example/api/access/datafile/' || nullif(source_file_id, ''), file_url) AS file_url, file_name AS title, local_path AS description, file_uid AS doi, file_name, 'OK' AS status
FROM stg_files WHERE regexp_matches(lower(file_name), '\\.(qdpx|qdp|nvpx|atlproj|mx|mxd)$')""")
def r_file_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = F.struct(F.col("file_name").alias("name"), F.col("file_url").alias("url"), F.col("local_path").alias("description"), F.lit("").alias("global_id"), F.col("file_uid").alias("identifier"), F.col("source_file_id").alias("file_id"))
    bodies = table(spark, sf_dir, "stg_files").select(F.to_json(F.struct(F.struct(F.array(item).alias("items")).alias("data"))).alias("body"))
    return responses.file_items(bodies, "https://repo.example/")


@query(r"""
SELECT 'dataverse' AS repository, project_url AS record_url, project_url AS file_url, title, description, doi, NULL::VARCHAR AS file_name, NULL::VARCHAR AS status
FROM stg_projects WHERE regexp_matches(lower(concat_ws(' ', title, description)), '\.qdp|\.nvpx|\.atlproj|\.mx|qdpx|nvp|atlas\.ti|maxqda')""")
def r_dataset_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = F.struct(F.col("title").alias("name"), F.col("project_url").alias("url"), "description", F.col("doi").alias("global_id"))
    bodies = table(spark, sf_dir, "stg_projects").select(F.to_json(F.struct(F.struct(F.array(item).alias("items")).alias("data"))).alias("body"))
    return responses.dataset_items(bodies)


@query("""
SELECT 'dryad' AS repository, project_url AS record_url, coalesce(nullif(project_url, ''), nullif(doi, ''), nullif(title, ''), 'dryad') AS file_url, title, description, doi, NULL::VARCHAR AS file_name, NULL::VARCHAR AS status FROM stg_projects""")
def r_embedded_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    link = F.struct(F.struct(F.col("project_url").alias("href")).alias("stash:landingPage"))
    one = F.struct("title", F.col("description").alias("abstract"), F.col("doi").alias("identifier"), link.alias("_links"))
    bodies = table(spark, sf_dir, "stg_projects").select(F.to_json(F.struct(F.struct(F.array(one).alias("stash:datasets")).alias("_embedded"))).alias("body"))
    return responses.embedded_datasets(bodies)


@query("""
SELECT 'icpsr' AS repository, CASE WHEN source_database_id % 5 > 0 THEN coalesce(nullif(project_url, ''), project_uid) END AS record_url,
  CASE WHEN source_database_id % 5 > 0 THEN coalesce(nullif(project_url, ''), project_uid) ELSE 'metadata-api:' || project_uid END AS file_url,
  CASE WHEN source_database_id % 5 > 0 THEN coalesce(nullif(title, ''), 'ICPSR metadata result: ' || project_uid) ELSE 'ICPSR metadata API query: ' || project_uid END AS title,
  CASE WHEN source_database_id % 5 > 0 THEN coalesce(nullif(description, ''), 'Record discovered via ICPSR Metadata API.') ELSE 'Metadata API attempt failed: timeout' END AS description,
  CASE WHEN source_database_id % 5 > 0 THEN doi END AS doi, NULL::VARCHAR AS file_name, CASE WHEN source_database_id % 5 > 0 THEN 'METADATA_API_FOUND' ELSE 'METADATA_API_FAILED' END AS status
FROM stg_projects""")
def r_exported_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists and objects in turn; every fifth source fails."""
    item = F.struct(F.col("project_uid").alias("id"), "title", F.col("project_url").alias("landingPage"), "doi", F.col("description").alias("summary"))
    body = F.when(F.col("source_database_id") % 2 == 0, F.to_json(F.array(item))).otherwise(F.to_json(F.struct(F.array(item).alias("items"))))
    error = F.when(F.col("source_database_id") % 5 == 0, "timeout")
    return responses.exported_metadata(table(spark, sf_dir, "stg_projects").select(F.col("project_uid").alias("query"), body.alias("body"), error.alias("error")))


@query(r"""
SELECT p.project_uid AS record_id, p.title, f.file_name, f.file_url, p.language AS license, try_cast(nullif(regexp_extract(p.upload_date, '^\d{4}'), '') AS INT) AS year
FROM stg_files f JOIN stg_projects p USING (project_uid) WHERE regexp_matches(lower(f.file_name), '\.(txt|pdf)$')""")
def r_search_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search hits with their files, the license as text or as an object in turn."""
    projects = table(spark, sf_dir, "stg_projects").select("project_uid", "title", "upload_date", "language", "source_database_id")
    df = table(spark, sf_dir, "stg_files").select("project_uid", "file_name", "file_url").join(projects, "project_uid")
    hit = lambda license_: F.to_json(F.struct(F.struct(F.array(F.struct(
        F.col("project_uid").alias("id"), F.struct("title", F.col("upload_date").alias("publication_date"), license_.alias("license")).alias("metadata"),
        F.array(F.struct(F.col("file_name").alias("key"), F.struct(F.col("file_url").alias("self")).alias("links"))).alias("files"),
    )).alias("hits")).alias("hits")))
    bodies = df.select(F.when(F.col("source_database_id") % 2 == 0, hit(F.struct(F.col("language").alias("id")))).otherwise(hit(F.col("language"))).alias("body"))
    return records.repository_files(bodies, ("txt", "pdf"))


@query("""
WITH l AS (SELECT project_uid, trim(replace(replace(coalesce(project_url, ''), '"', '%22'), chr(39), '%27')) AS href FROM stg_projects)
SELECT kind, count(*) AS links FROM (
  SELECT CASE WHEN contains(lower(href), 'download') OR contains(lower(href), 'type=file') OR contains(lower(href), 'format=original') OR regexp_matches(lower(href), '\\.(zip|pdf|txt|rtf|doc|docx|csv|xlsx|sav|dta|rdata|rds|qdpx|qdp|nvpx|nvp|atlproj|mx|mx20|mx22)$') THEN 'DOWNLOAD'
    WHEN regexp_matches(lower(href), 'dublincore|ddi|oai|xml') THEN 'METADATA' ELSE 'OTHER' END AS kind FROM l
  UNION ALL SELECT 'METADATA' FROM l UNION ALL SELECT 'DOWNLOAD' FROM l) GROUP BY 1""")
def r_page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of three anchors: the project's own link, a metadata export, a download with a session id; quotes in a link are escaped, a null link is empty."""
    href = lambda link, label: F.concat(F.lit("<a class=x href='"), link, F.lit("'>"), F.lit(label), F.lit("</a> "))
    own = F.replace(F.replace(F.coalesce("project_url", F.lit("")), F.lit('"'), F.lit("%22")), F.lit("'"), F.lit("%27"))
    page = F.concat(href(own, "<b>page</b>"), href(F.concat(F.lit("https://meta.example/"), "project_uid"), "DDI codebook"), href(F.lit("https://files.example/a;jsessionid=4?type=file"), "get"), href(own, "again"))
    pages = table(spark, sf_dir, "stg_projects").select("project_uid", page.alias("html"))
    return records.anchors(pages, "project_uid").groupBy("kind").agg(F.count(F.lit(1)).alias("links"))


# Catalogs.


def _catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = table(spark, sf_dir, "source_databases").select(F.concat(F.lit("/data/"), F.col("source_student_id").cast("string"), F.lit("-"), F.col("source_database_id").cast("string"), F.when(F.col("source_database_id") % 7 == 0, ".db-wal").otherwise(".db")).alias("path"), F.col("source_file_size_bytes").alias("length"))
    return records.catalog_files(listed)


_CATALOG = r"SELECT nullif(regexp_extract(source_student_id, '^(\d+)$', 1), '') AS student_id, '/data/' || source_student_id || '-' || source_database_id || '.db' AS path, source_file_size_bytes AS bytes FROM source_databases WHERE source_database_id % 7 <> 0"


@query(_CATALOG)
def k_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.by_id(_catalog(spark, sf_dir))


@query(f"SELECT count(*) AS databases, count(DISTINCT student_id) AS students, coalesce(sum(bytes), 0)::BIGINT AS bytes, round(coalesce(sum(bytes), 0) / 1024 / 1024, 2) AS mib FROM ({_CATALOG})")
def k_catalog_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.catalog_summary(_catalog(spark, sf_dir))


@query("""
SELECT CASE source_database_id % 4 WHEN 0 THEN 'MISSING' WHEN 1 THEN 'SIZE_MISMATCH' WHEN 2 THEN 'HASH_MISMATCH' ELSE 'VERIFIED' END AS status, count(*) AS rows, coalesce(sum(source_file_size_bytes), 0)::BIGINT AS bytes FROM source_databases GROUP BY 1""")
def k_verified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog against files of which some are gone, of another size, or changed."""
    df = table(spark, sf_dir, "source_databases").select(F.col("source_database_id").alias("path"), F.col("source_file_size_bytes").alias("bytes"), F.coalesce("source_sha256", F.lit("none")).alias("sha256"))
    turn = F.col("path") % 4
    found = df.where(turn != 0).select("path", F.when(turn == 1, F.col("bytes") + 1).otherwise(F.col("bytes")).alias("length"), F.when(turn == 2, F.lit("x")).otherwise(F.col("sha256")).alias("sha256"))
    return catalog.outcomes(catalog.verified(df, found).join(df.select("path", "bytes"), "path"), "status", size="bytes")


@query("""
WITH v AS (SELECT source_database_id AS n, source_student_id AS s, source_scope AS scope, CASE WHEN source_database_id % 3 = 0 THEN 'https://reg.example/d/' || source_database_id || '?x=1' END AS url FROM source_databases),
o AS (SELECT s, min('https://over.example/a b/' || n || '.db') AS url FROM v WHERE n % 4 = 1 GROUP BY 1),
t AS (SELECT v.s, v.n, coalesce(o.url, v.url) AS url, CASE WHEN o.url IS NOT NULL THEN 'RECOVERY_OVERRIDE' ELSE 'REGISTRY' END AS url_source FROM v LEFT JOIN o USING (s) WHERE v.scope = 'PEER_SHARED')
SELECT s AS source_student_id, arg_min(url, n) AS url, arg_min(url_source, n) AS url_source, regexp_extract(regexp_replace(arg_min(url, n), '[?#].*$', ''), '([^/]*)$', 1) AS filename FROM t WHERE url IS NOT NULL GROUP BY 1""")
def k_download_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry links for every third database, confirmed overrides for every fourth."""
    df = table(spark, sf_dir, "source_databases").select(F.col("source_database_id").alias("row_number"), "source_student_id", "source_scope")
    number = F.col("row_number").cast("string")
    validation = df.withColumn("access_status", F.when(F.col("row_number") % 3 == 0, "ACCESSIBLE_SQLITE").otherwise("HTTP_ERROR")).withColumn("metadata_url", F.concat(F.lit("https://reg.example/d/"), number, F.lit("?x=1")))
    overrides = df.select("source_student_id", F.when(F.col("row_number") % 4 == 1, "CONFIRMED_SQLITE").otherwise("OPEN").alias("status"), F.concat(F.lit("https://over.example/a b/"), number, F.lit(".db")).alias("url"))
    return catalog.download_targets(validation, overrides)


@query("""
SELECT CASE WHEN trim(coalesce(project_url, '')) = '' THEN 'MISSING_URL' WHEN source_database_id % 5 = 0 THEN 'REQUEST_ERROR' WHEN source_database_id % 5 = 1 THEN 'HTTP_ERROR' WHEN source_database_id % 5 = 2 THEN 'ACCESSIBLE_SQLITE' ELSE 'ACCESSIBLE_NON_SQLITE' END AS status, count(*) AS rows
FROM stg_projects GROUP BY 1""")
def k_link_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probe results by source: errors, missing pages, databases, other content."""
    turn = F.col("source_database_id") % 5
    head = F.when(turn == 2, F.encode(F.lit("SQLite format 3\x00 and more"), "utf-8")).otherwise(F.encode(F.lit("<html>"), "utf-8"))
    status = U.probe_status(F.col("project_url"), F.when(turn == 1, 404).otherwise(206), head, F.when(turn == 0, "reset"))
    return catalog.outcomes(table(spark, sf_dir, "stg_projects").select(status.alias("status")), "status")


@query("""
SELECT CASE source_database_id % 8 WHEN 0 THEN 'ALREADY_VERIFIED' WHEN 1 THEN 'EXISTING_FILE_INVALID' WHEN 2 THEN 'DOWNLOAD_ERROR' WHEN 3 THEN 'HTTP_ERROR' WHEN 4 THEN 'SIZE_MISMATCH' WHEN 5 THEN 'NON_SQLITE_CONTENT' WHEN 6 THEN 'SQLITE_CHECK_FAILED' ELSE 'DOWNLOADED_VERIFIED' END AS status, count(*) AS rows
FROM source_databases GROUP BY 1""")
def k_download_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    turn = F.col("source_database_id") % 8
    head = F.when(turn == 5, F.encode(F.lit("PK"), "utf-8")).otherwise(F.encode(F.lit("SQLite format 3\x00"), "utf-8"))
    size = F.col("source_file_size_bytes")
    status = catalog.download_status(F.when(turn == 0, True).when(turn == 1, False), F.when(turn == 3, 500).otherwise(200), F.lit(7).cast("long"), F.when(turn == 4, F.lit(6)).otherwise(F.lit(7)).cast("long"), head, F.when(turn == 6, "corrupt").otherwise("ok"), F.when(turn == 2, "timeout"))
    return catalog.outcomes(table(spark, sf_dir, "source_databases").select(size, status.alias("status")), "status")


@query("SELECT t AS table_name, count(DISTINCT d) AS databases FROM (SELECT source_database_id AS d, lower(trim(unnest(string_split(source_schema_signature, '|')))) AS t FROM source_databases) GROUP BY 1")
def k_table_presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = table(spark, sf_dir, "source_databases").select(F.col("source_database_id").alias("source"), F.explode(F.split("source_schema_signature", r"\|")).alias("t"))
    profiles = tables.select("source", F.lower(F.trim("t")).alias("table_name"), F.array(F.lit("ID"), F.lit(" Name")).alias("columns"), F.array(F.lit("ID")).alias("primary_key"))
    return catalog.by_count(catalog.compatibility(profiles)["presence"])


@query("""
SELECT source_student_id AS student_id, source_database_id AS registry_row FROM source_databases WHERE source_student_id IN (SELECT min(source_student_id) FROM source_databases UNION SELECT max(source_student_id) FROM source_databases) ORDER BY 2 LIMIT 5""")
def k_probe_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first five registry rows of two contributors: the limited probe."""
    rows = table(spark, sf_dir, "source_databases").select(F.col("source_student_id").alias("student_id"), F.col("source_database_id").alias("registry_row"))
    ends = rows.agg(F.min("student_id"), F.max("student_id")).first()
    return records.probe_list(rows, tuple(ends), 5)


@query("""
SELECT source_database_id AS key, CASE WHEN source_database_id % 3 = 0 THEN 'new ' || source_database_id ELSE source_student_id END AS value FROM source_databases UNION ALL SELECT -1, 'added'""")
def k_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes for every third key, each twice, and one new key."""
    held = table(spark, sf_dir, "source_databases").select(F.col("source_database_id").alias("key"), F.col("source_student_id").alias("value"))
    change = held.where(F.col("key") % 3 == 0)
    changes = change.select("key", F.lit("old").alias("value"), F.lit(1).alias("at")).unionByName(change.select("key", F.concat(F.lit("new "), F.col("key").cast("string")).alias("value"), F.lit(2).alias("at")))
    added = held.agg(F.lit(-1).cast("long").alias("key"), F.lit("added").alias("value"), F.lit(1).alias("at"))
    return catalog.upsert(held, changes.unionByName(added), "key", "at")


@query(r"""
WITH p AS (SELECT project_uid, lower(trim(title)) AS name FROM stg_projects WHERE title IS NOT NULL),
a AS (SELECT name, count(DISTINCT uid) AS n, min(uid || '/' || title || '.qdpx') AS archive FROM (SELECT lower(regexp_extract(title, '([^/]*)$', 1)) || '.qdpx' AS name, project_uid AS uid, title FROM stg_projects WHERE title IS NOT NULL AND source_database_id % 2 = 0) GROUP BY 1)
SELECT project_uid, archive, CASE WHEN archive IS NULL THEN 'ARCHIVE_NOT_FOUND' WHEN n > 1 THEN 'AMBIGUOUS' ELSE 'FOUND' END AS status FROM (SELECT project_uid, lower(trim(title || '.qdpx')) AS name FROM stg_projects WHERE title IS NOT NULL) LEFT JOIN a USING (name)""")
def j_archive_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives of every second source, named like its projects' titles, against all titles."""
    titled = table(spark, sf_dir, "stg_projects").where(F.col("title").isNotNull())
    there = titled.where(F.col("source_database_id") % 2 == 0).select(F.concat(F.col("project_uid"), F.lit("/"), "title", F.lit(".qdpx")).alias("archive"))
    return catalog.archive_of(titled.select("project_uid", F.concat("title", F.lit(".qdpx")).alias("title")), there, exact=True)


@query()
def k_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files as insert-or-ignore by link and digest keeps them, in the order of their ids."""
    files = table(spark, sf_dir, "stg_files").where(F.col("file_uid").isNotNull()).select(F.col("file_uid").alias("arrival"), F.col("file_url").alias("url"), F.sha2("local_path", 256).alias("sha256"))
    return ledger.accepted(files.distinct())


# Stored tables and declared JSON.


@query("SELECT source_database_id, count(*) AS projects, 'second' AS run_id FROM stg_projects GROUP BY 1")
def t_run_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs, of which the second is written twice and the first is reset away with an earlier store."""
    store = stored.Store(spark, f"{shared_dir(spark)}/curlew/{spark.sparkContext.applicationId}/store-{uuid.uuid4().hex}", {"counts": "source_database_id long, projects long"})
    store.init()
    counts = table(spark, sf_dir, "stg_projects").groupBy("source_database_id").agg(F.count(F.lit(1)).alias("projects"))
    store.append("counts", counts, "first")
    store.reset("counts")
    for rows in (counts.limit(0), counts):
        store.append("counts", rows, "second")
    if store.init():
        raise RuntimeError("initialising again must create nothing")
    return store.read("counts")


@query("SELECT source_database_id AS id, source_student_id AS student, source_file_size_bytes AS bytes FROM source_databases WHERE trim(source_student_id) <> ''")
def t_declared_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source databases as a JSON list (a fixed number of rows), read under a declared schema with required fields."""
    path = f"{_place(spark, 'json')}/catalog.json"
    rows = table(spark, sf_dir, "source_databases").select(F.to_json(F.struct(F.col("source_database_id").alias("id"), F.col("source_student_id").alias("student"), F.col("source_file_size_bytes").alias("bytes"))).alias("j")).collect()
    with open(path, "w", encoding="utf-8") as f:
        f.write("[" + ",".join(r["j"] for r in rows) + "]")
    return stored.read_objects(spark, f"file://{path}", "id long, student string, bytes long", ("student",), strict=False)


@query("SELECT n_name AS title, n_nationkey::BIGINT AS total FROM nation")
def t_declared_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A manifest of totals by title, made of the nation table (25 rows at any scale)."""
    path = f"{_place(spark, 'json')}/totals.json"
    rows = table(spark, sf_dir, "nation").select(F.to_json(F.struct(F.col("n_nationkey").alias("total_internal_files"))).alias("j"), F.to_json(F.array("n_name")).alias("t")).collect()
    with open(path, "w", encoding="utf-8") as f:
        f.write("{" + ",".join(f"{r['t'][1:-1]}:{r['j']}" for r in rows) + "}")
    return stored.read_totals(spark, f"file://{path}")


@query("SELECT source_database_id, project_count, file_count, candidate_granularity FROM (SELECT source_database_id, 0::BIGINT AS project_count, 0::BIGINT AS file_count, '' AS candidate_granularity FROM source_databases LIMIT 0)")
def t_profiles_reset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source profiles written to a store, then reset: the table is there and empty."""
    store = stored.Store(spark, f"{shared_dir(spark)}/curlew/{spark.sparkContext.applicationId}/store-{uuid.uuid4().hex}", {"profiles": "source_database_id long, project_count long, file_count long, candidate_granularity string"})
    store.init()
    store.append("profiles", dedup.source_profiles(*(table(spark, sf_dir, n) for n in ("stg_projects", "source_databases", "stg_files"))), "r1")
    if store.read("profiles", "r1").isEmpty() and not table(spark, sf_dir, "source_databases").isEmpty():
        raise RuntimeError("a written run must be there")
    store.reset("profiles")
    return store.read("profiles").drop("run_id")


_SLUG = rf"regexp_replace(regexp_replace(regexp_replace({strip('title')}, '[^\p{{L}}\p{{N}}_.-]', '-', 'g'), '-+', '-', 'g'), '^-+|-+$', '', 'g')"


@query(f"""
SELECT project_uid, coalesce(nullif(left({_SLUG}, 80), ''), 'dataset') AS slug,
  replace(replace(replace(replace(replace(coalesce({strip('title')}, ''), '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), chr(39), '&#x27;') AS escaped, concat_ws(':', project_uid, source_table_name) AS uid FROM stg_projects""")
def x_name_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "stg_projects").select("project_uid", X.slug("title").alias("slug"), X.html_escape("title").alias("escaped"), X.entity_uid("project_uid", "source_table_name").alias("uid"))


@query(r"""
WITH u AS (SELECT coalesce(project_url, '') AS url FROM stg_projects)
SELECT url, regexp_replace(url, ';jsessionid=[^?]+', '', 'g') AS plain, regexp_replace(url, '(?i)^https://(?:raw\.githubusercontent|github)\.com/([^/]+)/([^/]+)/blob/([^/]+)/(.+)$', 'https://raw.githubusercontent.com/\1/\2/\3/\4') AS raw,
  regexp_replace(regexp_extract(regexp_replace(regexp_replace(url, '(?s)[?#].*$', ''), '(?i)^[a-z][a-z0-9+.\-]*://[^/]*', ''), '([^/]*)$', 1), '[^A-Za-z0-9._\-]', '_', 'g') AS name, count(*) AS projects FROM u GROUP BY 1""")
def x_link_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = table(spark, sf_dir, "stg_projects").groupBy(F.coalesce("project_url", F.lit("")).alias("url")).agg(F.count(F.lit(1)).alias("projects"))
    return links.select("url", U.without_session("url").alias("plain"), U.raw_file_url("url").alias("raw"), U.safe_file_name("url").alias("name"), "projects")


@query(rf"""
SELECT doc_id, coalesce({strip('text')}, '') AS cleaned, left({strip("regexp_replace(replace(text, chr(0), ' '), '[" + chr(92) + "s" + chr(92) + "p{Z}" + chr(92) + "x{85}" + chr(92) + "x{1c}-" + chr(92) + "x{1f}]+', ' ', 'g')")}, 20000) AS limited, nullif(regexp_extract(project_uid, '^([0-9]+)(?:[_.-]|$)', 1), '') AS leading FROM documents""")
def x_clean_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaning of whole texts, and the bounded text of extraction, whose limit is the feature."""
    return table(spark, sf_dir, "documents").select("doc_id", X.clean_text("text").alias("cleaned"), X.normal_text("text").alias("limited"), X.leading_id("project_uid").alias("leading"))


@query(r"""
WITH r AS (SELECT regexp_replace(source_student_id, '\.0$', '') AS id, coalesce(local_path, '') AS url FROM source_databases), c AS (SELECT id, count(*) AS n FROM r GROUP BY 1)
SELECT unnest(['rows', 'valid', 'students', 'repeated', 'linked', 'repaired']) AS measure, unnest([count(*), count(*) FILTER (regexp_matches(id, '^\d{6,}$')), count(DISTINCT CASE WHEN regexp_matches(id, '^\d{6,}$') THEN id END), count(*) FILTER (n > 1), count(*) FILTER (trim(url) <> ''), 0]) AS value FROM r JOIN c USING (id)""")
def a_registry_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "source_databases").select(F.col("source_student_id").alias("student_id"), F.col("local_path").alias("metadata_url"), F.col("source_notes").alias("base_data"))
    return records.registry_summary(records.registry(rows))


@query("SELECT source_database_id::VARCHAR AS source_database_id, coalesce(source_student_id, '') AS source_student_id, coalesce(source_notes, '') AS source_notes FROM source_databases")
def t_csv_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report written as CSV and read again, all columns as text."""
    rows = table(spark, sf_dir, "source_databases").select("source_database_id", "source_student_id", "source_notes")
    folder = f"{shared_dir(spark)}/curlew/{spark.sparkContext.applicationId}/report-{uuid.uuid4().hex}"
    records.write_report(rows, rows.agg(F.count(F.lit(1)).alias("databases")), folder)
    return records.read_csv_strings(spark, f"{folder}/rows", ("source_database_id", "source_notes"))


@query("""
SELECT CASE source_database_id % 5 WHEN 0 THEN 'BASELINE_CREATED' WHEN 1 THEN 'UNCHANGED' ELSE 'RECLASSIFICATION_REQUIRED' END AS status,
  CASE source_database_id % 5 WHEN 0 THEN 'BASELINE_CREATED' WHEN 1 THEN 'UNCHANGED' WHEN 2 THEN 'ARCHIVE_CHANGED' WHEN 3 THEN 'INTERNAL_MANIFEST_CHANGED|STATUS_CHANGED' ELSE 'STATUS_CHANGED' END AS reasons, count(*) AS archives FROM source_databases GROUP BY ALL""")
def m_archive_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source databases as archives against a snapshot in which some were missing, changed, or had another status."""
    df = table(spark, sf_dir, "source_databases").select(F.col("source_database_id").alias("archive"), F.coalesce("source_sha256", F.lit("-")).alias("archive_sha256"), F.coalesce("source_schema_signature", F.lit("-")).alias("manifest_sha256"), F.lit("OK").alias("zip_status"))
    turn = F.col("archive") % 5
    other = lambda c, *turns: F.when(turn.isin(*turns), F.concat(F.lit("before "), c)).otherwise(F.col(c)).alias(c)
    before = df.where(turn != 0).select("archive", other("archive_sha256", 2), other("manifest_sha256", 3), other("zip_status", 3, 4))
    return drift.archive_drift(df, before).groupBy("status", "reasons").agg(F.count(F.lit(1)).alias("archives"))


@query("""
WITH f AS (SELECT project_uid, count(DISTINCT file_uid) AS n FROM stg_files WHERE project_uid IS NOT NULL GROUP BY 1), m AS (SELECT DISTINCT title FROM stg_projects WHERE source_database_id % 2 = 0)
SELECT p.project_uid, coalesce(f.n, 0) AS file_count, CASE WHEN m.title IS NOT NULL THEN 7 ELSE coalesce(f.n, 0) END::BIGINT AS no_project_files FROM stg_projects p LEFT JOIN f USING (project_uid) LEFT JOIN m ON m.title = p.title""")
def l_export_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Export rows whose file count gives way to a manifest, made for the titles of every second source."""
    projects, files = (table(spark, sf_dir, n) for n in ("stg_projects", "stg_files"))
    manifest = projects.where(F.col("source_database_id") % 2 == 0).select("title", F.lit(7).cast("long").alias("total_internal_files"))
    return delivery.export_rows(projects, files, classify.project_types(projects, files), manifest).select("project_uid", "file_count", "no_project_files")

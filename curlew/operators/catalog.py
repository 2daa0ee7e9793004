"""Catalogs of source databases: targets, download and link outcomes, column compatibility, keyed stores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from curlew.functions import urls as U


def download_targets(validation: DataFrame, overrides: DataFrame, scope: str = "PEER_SHARED") -> DataFrame:
    """(source_student_id, url, url_source, filename): one target for each contributor of ``scope``.

    A confirmed override wins, else the registry's link if it was found to be a
    database. ``validation`` has (row_number, source_student_id, source_scope,
    access_status, metadata_url), ``overrides`` (source_student_id, status, url); the
    first usable row by row_number counts.
    """
    confirmed = overrides.where((F.col("status") == "CONFIRMED_SQLITE") & (F.trim("url") != "")).groupBy("source_student_id").agg(F.min("url").alias("_override"))
    df = validation.where(F.col("source_scope") == scope).join(confirmed, "source_student_id", "left")
    url = F.coalesce("_override", F.when(F.col("access_status") == "ACCESSIBLE_SQLITE", F.col("metadata_url")))
    source = F.when(F.col("_override").isNotNull(), "RECOVERY_OVERRIDE").otherwise("REGISTRY")
    usable = df.select("source_student_id", F.struct("row_number", url.alias("url"), source.alias("url_source")).alias("t")).where(F.col("t.url").isNotNull())
    name = F.coalesce(F.nullif(U.safe_file_name("url"), F.lit("")), F.concat("source_student_id", F.lit("-metadata.db")))
    return usable.groupBy("source_student_id").agg(F.min("t").alias("t")).select("source_student_id", "t.url", "t.url_source").withColumn("filename", name)


def download_status(existing_ok: Column, http_status: Column, expected_size: Column, size: Column, head: Column, check: Column, error: Column) -> Column:
    """The outcome of a download, first failure wins. ``existing_ok`` is null where no file was there before."""
    sqlite = F.coalesce(F.substring(head, 1, 16) == F.lit(bytearray(b"SQLite format 3\x00")), F.lit(False))
    failures = (
        (existing_ok, "ALREADY_VERIFIED"),
        (~existing_ok, "EXISTING_FILE_INVALID"),
        (error.isNotNull(), "DOWNLOAD_ERROR"),
        (~F.coalesce(http_status.between(200, 299), F.lit(False)), "HTTP_ERROR"),
        (expected_size.isNotNull() & ~expected_size.eqNullSafe(size), "SIZE_MISMATCH"),
        (~sqlite, "NON_SQLITE_CONTENT"),
        (~F.coalesce(check == "ok", F.lit(False)), "SQLITE_CHECK_FAILED"),
    )
    out = F
    for hit, name in failures:
        out = out.when(hit, name)
    return out.otherwise("DOWNLOADED_VERIFIED")


def outcomes(rows: DataFrame, *by: str, size: str | None = None) -> DataFrame:
    """Counts (and bytes) of rows by status or whatever columns are named: summaries of imports, downloads, links, catalogs."""
    total = [F.coalesce(F.sum(size), F.lit(0)).alias("bytes")] if size else []
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), *total)


def verified(catalog: DataFrame, found: DataFrame) -> DataFrame:
    """(path, status) of catalog rows (path, bytes, sha256) against files (path, length, sha256)."""
    df = catalog.join(found.select("path", "length", F.col("sha256").alias("_sha")), "path", "left")
    return df.select("path", F.when(F.col("length").isNull(), "MISSING").when(F.col("length") != F.col("bytes"), "SIZE_MISMATCH").when(~F.col("_sha").eqNullSafe(F.col("sha256")), "HASH_MISMATCH").otherwise("VERIFIED").alias("status"))


def compatibility(profiles: DataFrame) -> dict[str, DataFrame]:
    """Tables of profiled databases (source, table_name, columns, primary_key): presence, column frequency, column and key layouts; ``by_count`` orders them."""
    low = lambda c: F.transform(c, lambda x: F.lower(F.trim(x)))
    df = profiles.where(F.col("table_name").isNotNull()).select("source", "table_name", low("columns").alias("columns"), low("primary_key").alias("primary_key"))
    count = F.count(F.lit(1)).alias("databases")
    return {
        "presence": df.groupBy("table_name").agg(F.count_distinct("source").alias("databases")),
        "columns": df.select("table_name", F.explode("columns").alias("column")).groupBy("table_name", "column").agg(count),
        "layouts": df.groupBy("table_name", "columns").agg(count),
        "keys": df.groupBy("table_name", "primary_key").agg(count),
    }


def by_count(counted: DataFrame, count: str = "databases") -> DataFrame:
    """A summary in its report order: the largest count first, then by its keys."""
    return counted.orderBy(F.col(count).desc(), *[c for c in counted.columns if c != count])


def upsert(stored: DataFrame, changes: DataFrame, key: str, order: str) -> DataFrame:
    """``stored`` with the last change of each key (by ``order``, unique within a key) in its place."""
    columns = stored.columns
    last = changes.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(F.col(order).desc()))).where("_r = 1").select(*columns)
    return stored.join(last.select(key), key, "left_anti").select(*columns).unionByName(last)


def register(sources: DataFrame, new: DataFrame, key: str = "source_student_id") -> DataFrame:
    """The new sources whose contributor isn't registered yet."""
    return new.join(sources.select(key), key, "left_anti")


def existing(candidates: DataFrame, ledger: DataFrame, url: str = "url") -> DataFrame:
    """The candidates whose normalised URL the ledger has: the existence probe for all at once."""
    known = ledger.select(U.ledger_url(url).alias("_k")).distinct()
    return candidates.withColumn("_k", U.ledger_url(url)).join(known, "_k", "left_semi").drop("_k")


def archive_of(projects: DataFrame, archives: DataFrame, exact: bool = False) -> DataFrame:
    """(project_uid, archive, status): the archive named by a project's title, whatever its case.

    The first path of a name counts; with ``exact``, a name of several paths is AMBIGUOUS.
    """
    base = F.lower(F.regexp_extract("archive", r"([^/]*)$", 1))
    index = archives.select(base.alias("_name"), "archive").groupBy("_name").agg(F.min("archive").alias("archive"), F.count_distinct("archive").alias("_n"))
    named = projects.where(F.lower("title").endswith(".qdpx")).withColumn("_name", F.lower(F.trim("title")))
    return named.join(index, "_name", "left").select("project_uid", "archive", F.when(F.col("archive").isNull(), "ARCHIVE_NOT_FOUND").when(F.lit(exact) & (F.col("_n") > 1), "AMBIGUOUS").otherwise("FOUND").alias("status"))


def report_matches(report: DataFrame, run: DataFrame, fields: tuple[str, ...], quiet: tuple[str, ...] = ("BASELINE_CREATED", "UNCHANGED")) -> DataFrame:
    """One row: whether a drift report of one row agrees with a run in ``fields`` and has a quiet status; without a report it doesn't."""
    said = report.select(F.struct("status", *fields).alias("v")).agg(F.first("v").alias("v")).select(F.lit(0).alias("o"), "v")
    is_ = run.select(F.struct(F.lit(None).cast("string").alias("status"), *fields).alias("v")).agg(F.first("v").alias("v")).select(F.lit(1).alias("o"), "v")
    both = said.unionByName(is_).agg(F.min_by("v", "o").alias("s"), F.max_by("v", "o").alias("r"))
    same = F.col("s.status").isin(*quiet)
    for f in fields:
        same = same & F.col(f"s.{f}").eqNullSafe(F.col(f"r.{f}"))
    return both.select(F.lit("drift_report").alias("name"), F.coalesce(same, F.lit(False)).alias("passed"))

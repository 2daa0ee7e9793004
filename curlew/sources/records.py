"""Offline readers of registries, catalogs and repository responses, and link extraction from pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from curlew.functions import text as X
from curlew.functions import urls as U

ANCHOR = r"""(?is)<a\b[^>]*?href\s*=\s*["']([^"']*)["'][^>]*>(.*?)</a>"""


def read_csv_strings(spark: SparkSession, path: str, required: tuple[str, ...]) -> DataFrame:
    """A CSV file with all columns as text, headers trimmed and in lower case; missing columns are an error."""
    df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    df = df.toDF(*[c.strip().lower() for c in df.columns]).select([F.coalesce(F.col(c.strip().lower()), F.lit("")).alias(c.strip().lower()) for c in df.columns])
    if missing := [c for c in required if c not in df.columns]:
        raise ValueError(f"{path} lacks the columns {missing}")
    return df


def registry(rows: DataFrame) -> DataFrame:
    """Registry rows with a valid id (six digits or more), repaired links and providers; the rest has ``valid`` false.

    Columns: student_id, metadata_url, base_data. Repeated ids are marked by ``copies``.
    """
    ident = F.regexp_replace(X.clean_text("student_id"), r"\.0$", "")
    url = X.clean_text("metadata_url")
    df = rows.select(
        ident.alias("student_id"), ident.rlike(r"^\d{6,}$").alias("valid"), U.raw_file_url(url).alias("metadata_url"), (U.raw_file_url(url) != url).alias("url_changed"),
        F.transform(U.locations(X.clean_text("base_data")), lambda x: F.struct(x.alias("location"), U.provider(x).alias("provider"))).alias("base_data"),
    )
    return df.withColumn("copies", F.count(F.lit(1)).over(Window.partitionBy("student_id")))


def registry_summary(found: DataFrame) -> DataFrame:
    """(measure, value) of a read registry: rows, valid ids, different ids, repeated ids, rows with a link, repaired links."""
    linked = F.coalesce(F.col("metadata_url") != "", F.lit(False))
    counts = {
        "rows": F.count(F.lit(1)), "valid": F.count_if("valid"), "students": F.count_distinct(F.when(F.col("valid"), F.col("student_id"))),
        "repeated": F.count_if(F.col("copies") > 1), "linked": F.count_if(linked), "repaired": F.count_if("url_changed"),
    }
    one = found.agg(*[c.alias(n) for n, c in counts.items()])
    return one.select(F.explode(F.array(*[F.struct(F.lit(n).alias("measure"), F.col(n).alias("value")) for n in counts])).alias("x")).select("x.*")


def write_report(rows: DataFrame, summary: DataFrame, folder: str) -> None:
    """A report as CSV with a header, and its summary of one row as JSON beside it; both replace what was there."""
    rows.write.mode("overwrite").option("header", True).option("escape", '"').csv(f"{folder}/rows")
    summary.coalesce(1).write.mode("overwrite").json(f"{folder}/summary")


def anchors(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """(key, href, label, kind): the links of pages as download, metadata or other, session ids removed, first of each link kept."""
    found = F.arrays_zip(F.regexp_extract_all(html, F.lit(ANCHOR), F.lit(1)).alias("href"), F.regexp_extract_all(html, F.lit(ANCHOR), F.lit(2)).alias("label"))
    df = pages.select(key, F.posexplode(found).alias("_at", "a")).select(key, "_at", U.without_session(F.trim("a.href")).alias("href"), X.strip(F.regexp_replace("a.label", "(?s)<[^>]*>", " ")).alias("label"))
    df = df.groupBy(key, "href").agg(F.min_by("label", "_at").alias("label"))
    return df.withColumn("kind", F.when(U.is_download("href"), "DOWNLOAD").when(U.is_metadata_export("label", "href"), "METADATA").otherwise("OTHER"))


def study_ids(html: str | Column, fallback: tuple[str, ...] = ()) -> Column:
    """The different study numbers that a page links to, or ``fallback`` if there are none."""
    found = F.array_distinct(F.regexp_extract_all(X.col(html), F.lit(r"/studies/(\d+)"), F.lit(1)))
    return F.when(F.size(found) > 0, found).otherwise(F.array(*[F.lit(f) for f in fallback]).cast("array<string>"))


def repository_files(responses: DataFrame, extensions: tuple[str, ...]) -> DataFrame:
    """(record_id, title, file_name, file_url, license, year) of JSON search responses (column ``body``) whose files have one of the extensions.

    Hits have id, metadata (title, publication_date, license as text or object) and files (key, links.self).
    """
    hits = "struct<hits:array<struct<id:string,metadata:struct<title:string,publication_date:string,license:variant>,files:array<struct<key:string,links:struct<self:string>>>>>>"
    df = responses.select(F.explode(F.from_json("body", f"struct<hits:{hits}>")["hits"]["hits"]).alias("h")).select("h.id", "h.metadata", F.explode("h.files").alias("f"))
    license_ = F.coalesce(F.try_variant_get("metadata.license", "$.id", "string"), F.when(~F.schema_of_variant("metadata.license").startswith("OBJECT"), F.try_variant_get("metadata.license", "$", "string")))
    return df.where(X.file_extension("f.key").isin(*extensions)).select(F.col("id").alias("record_id"), "metadata.title", F.col("f.key").alias("file_name"), F.col("f.links.self").alias("file_url"), license_.alias("license"), X.year("metadata.publication_date").alias("year"))


def catalog_files(files: DataFrame) -> DataFrame:
    """(student_id, path, bytes) of database files (path, length), sidecars left out; ``by_id`` orders them."""
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    return files.where(F.lower(name).rlike(r"\.(db|sqlite|sqlite3)$")).select(X.leading_id(name).alias("student_id"), "path", F.col("length").alias("bytes"))


def by_id(catalog: DataFrame) -> DataFrame:
    """The catalog in numeric order of its ids, ids that aren't numbers last."""
    return catalog.orderBy(F.col("student_id").try_cast("bigint").asc_nulls_last(), "student_id", "path")


def exactly_one(rows: DataFrame, what: str) -> DataFrame:
    """``rows`` if it is one, an error otherwise."""
    found = rows.limit(2).count()
    if found != 1:
        raise ValueError(f"expected exactly one {what}, found {'none' if not found else 'several'}")
    return rows


def probe_list(registry: DataFrame, students: tuple[str, ...] = (), limit: int | None = None, order: str = "registry_row") -> DataFrame:
    """The registry rows to probe: those of the ``students`` (all, if none are named), the first ``limit`` in registry order."""
    if limit is not None and limit < 1:
        raise ValueError("limit must be 1 or more")
    df = registry.where(F.col("student_id").isin(*students)) if students else registry
    return df if limit is None else df.orderBy(order).limit(limit)


def catalog_summary(catalog: DataFrame) -> DataFrame:
    return catalog.agg(F.count(F.lit(1)).alias("databases"), F.count_distinct("student_id").alias("students"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"), F.round(F.coalesce(F.sum("bytes"), F.lit(0)) / 1024 / 1024, 2).alias("mib"))

"""Delivery: curated tables, export rows, repository and staging statistics, ledger migration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from curlew import vocab as V
from curlew.functions import text as X
from curlew.operators.dedup import file_counts
from curlew.operators.numbering import surrogate_ids
from curlew.session import materialize


def export_rows(projects: DataFrame, files: DataFrame, types: DataFrame, manifest: DataFrame | None = None) -> DataFrame:
    """One row for each project with its type and file count; a manifest by exact title overrides the count."""
    df = projects.select("project_uid", "repository_id", "title").join(types.select("project_uid", "project_type"), "project_uid", "left").join(file_counts(files), "project_uid", "left").withColumn("file_count", F.coalesce("file_count", F.lit(0)))
    if manifest is None:
        return df.withColumn("no_project_files", F.col("file_count"))
    totals = manifest.groupBy("title").agg(F.max("total_internal_files").alias("_total"))
    return df.join(totals, "title", "left").select("project_uid", "repository_id", "title", "project_type", "file_count", F.coalesce("_total", "file_count").alias("no_project_files"))


def repository_summary(projects: DataFrame, files: DataFrame, types: DataFrame) -> DataFrame:
    """(repository_id, project_type, projects, files, place): classes of each repository, the largest first."""
    df = export_rows(projects, files, types).groupBy(F.coalesce("repository_id", F.lit("")).alias("repository_id"), "project_type").agg(F.count(F.lit(1)).alias("projects"), F.sum("file_count").alias("files"))
    order = Window.partitionBy("repository_id").orderBy(F.col("projects").desc(), F.col("project_type"))  # four types at most
    return df.withColumn("place", F.row_number().over(order).cast("long"))


def staging_statistics(sources: DataFrame, projects: DataFrame) -> DataFrame:
    """(source_scope, registered_databases, staged_projects)."""
    counted = projects.groupBy("source_database_id").agg(F.count(F.lit(1)).alias("n"))
    return sources.select("source_database_id", "source_scope").join(counted, "source_database_id", "left").groupBy("source_scope").agg(F.count(F.lit(1)).alias("registered_databases"), F.coalesce(F.sum("n"), F.lit(0)).alias("staged_projects"))


def delivery_projects(projects: DataFrame, types: DataFrame, classes: DataFrame, repositories: tuple[int, ...] = (5, 15)) -> DataFrame:
    """Projects of the delivery's repositories with surrogate ids in order of repository and uid.

    Ids come from counts of key ranges, so no task sorts the whole table.
    """
    df = projects.select("project_uid", F.col("repository_id").try_cast("int").alias("repository_id"), F.coalesce("title", F.lit("Untitled project")).alias("title"))
    df = df.where(F.col("repository_id").isin(*repositories)).join(types.select("project_uid", "project_type"), "project_uid")
    one = classes.groupBy("project_uid").agg(F.min_by("primary_division_code", F.struct("classified_at_utc", "primary_division_code")).alias("primary_division_code"))
    return surrogate_ids(df.join(one, "project_uid", "left"), ["repository_id", "project_uid"])


def delivery_tables(projects: DataFrame, types: DataFrame, classes: DataFrame, files: DataFrame, repositories: tuple[int, ...] = (5, 15)) -> dict[str, DataFrame]:
    """The delivery as tables keyed by surrogate ids: projects, types, isic, files.

    Files are those of delivered projects, a re-delivered one once; their ids follow
    project id and file_uid. Keys are mapped by one join that also selects, so only
    rows of delivered projects travel further.
    """
    delivered = materialize(delivery_projects(projects, types, classes, repositories), "delivered")
    keys = delivered.select("project_uid", F.col("id").alias("project_id"))
    kind = types.select("project_uid", "project_type", "classification_rule").join(keys, "project_uid").select("project_id", "project_type", "classification_rule")
    order = F.struct("classified_at_utc", "primary_division_code")
    one = classes.join(keys, "project_uid").groupBy("project_id").agg(F.min(F.struct(order.alias("o"), "primary_section_code", "primary_division_code", "secondary_division_code")).alias("x"))
    isic = one.select("project_id", "x.primary_section_code", "x.primary_division_code", "x.secondary_division_code")
    mine = files.where(F.col("file_uid").isNotNull()).select("file_uid", "project_uid", "file_name", "file_type", "status").join(keys, "project_uid").drop("project_uid").distinct()
    mine = mine.withColumn("is_primary", X.file_extension("file_name").isin(*V.PRIMARY_EXTENSIONS))
    return {"projects": delivered, "types": kind, "isic": isic, "files": surrogate_ids(mine, ["project_id", "file_uid"])}


def headline(sources: DataFrame, projects: DataFrame, files: DataFrame, types: DataFrame, classes: DataFrame) -> DataFrame:
    """(metric, value): the totals a report begins with; a re-delivered file counts once."""
    rows = lambda df, **m: df.agg(*[c.cast("long").alias(n) for n, c in m.items()]).select(F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).alias("value")) for n in m])).alias("x")).select("x.*")
    once = files.select("file_uid", "file_name").distinct()
    by_type = types.groupBy(F.concat(F.lit("type:"), "project_type").alias("metric")).agg(F.count(F.lit(1)).alias("value"))
    totals = rows(sources, databases=F.count(F.lit(1)), contributors=F.count_distinct("source_student_id"), scopes=F.count_distinct("source_scope"))
    totals = totals.unionByName(rows(projects, projects=F.count_distinct("project_uid"))).unionByName(rows(classes, classified_projects=F.count_distinct("project_uid")))
    return totals.unionByName(rows(once, files=F.count(F.lit(1)), primary_files=F.count_if(X.file_extension("file_name").isin(*V.PRIMARY_EXTENSIONS)))).unionByName(by_type)


def _ledger_projects(ledger: DataFrame) -> DataFrame:
    repository = F.lower("repository")
    ident, link = F.lit(0), F.lit("")
    for name, (number, url) in V.LEDGER_REPOSITORIES.items():
        ident, link = F.when(repository == name, number).otherwise(ident), F.when(repository == name, url).otherwise(link)
    url = F.coalesce("dataset_url", "qda_url")
    folder = F.concat(F.lit("data/raw/"), repository, F.lit("/"))
    doi = F.when(F.col("doi").isNull() | (F.trim("doi") == ""), None).when(F.lower("doi").startswith("http"), F.col("doi")).otherwise(F.concat(F.lit("https://doi.org/"), F.col("doi")))
    return ledger.select(
        ident.alias("repository_id"), link.alias("repository_url"), url.alias("project_url"), F.coalesce("title", "local_qda_filename", url).alias("title"), F.coalesce("description", F.lit("")).alias("description"),
        doi.alias("doi"), F.col("download_timestamp").alias("download_date"), repository.alias("download_repository_folder"), F.replace(F.col("local_directory"), folder, F.lit("")).alias("download_project_folder"), F.lit("API-CALL").alias("download_method"),
    ).distinct()


def _ledger_file() -> list[Column]:
    """file_name, file_type and status of a ledger row."""
    name, kind, error = F.col("local_qda_filename"), F.col("file_type"), F.lower(F.coalesce("error_message", F.lit("")))
    return [
        name.alias("file_name"),
        F.when(kind.isNotNull() & (F.trim(kind) != ""), F.lower(kind)).when(F.instr(name, ".") > 0, F.lower(F.regexp_replace(name, r"(?s)^[^.]*\.", ""))).otherwise("unknown").alias("file_type"),
        F.when(F.upper(F.coalesce("download_status", F.lit(""))).isin("OK", "SUCCEEDED"), "SUCCEEDED").when(F.contains(error, F.lit("login")), "FAILED_LOGIN_REQUIRED").when(F.contains(error, F.lit("large")), "FAILED_TOO_LARGE").otherwise("FAILED_SERVER_UNRESPONSIVE").alias("status"),
    ]


def migrated_file_counts(ledger: DataFrame) -> DataFrame:
    """(file_type, status, files): the files of ``migrate_ledger`` counted.

    Both sides are counted by URL before they meet, so a link that many rows share makes no more rows.
    """
    told = ledger.select(F.coalesce("dataset_url", "qda_url").alias("project_url"), *_ledger_file()[1:])
    told = told.groupBy("project_url", "file_type", "status").agg(F.count(F.lit(1)).alias("_rows"))
    sharing = _ledger_projects(ledger).groupBy("project_url").agg(F.count(F.lit(1)).alias("_projects"))
    return told.join(sharing, "project_url").groupBy("file_type", "status").agg(F.sum(F.col("_rows") * F.col("_projects")).alias("files"))


def migrate_ledger(ledger: DataFrame) -> dict[str, DataFrame]:
    """The acquisition ledger as projects, files, person roles and licenses.

    Ledger columns: repository, dataset_url, qda_url, title, description, doi,
    download_timestamp, local_directory, local_qda_filename, file_type,
    download_status, error_message, uploader_name, license. Files, roles and
    licenses join back by URL, so projects that share one fan out.
    """
    projects = _ledger_projects(ledger)
    keyed = projects.withColumn("project_id", F.sha2(F.to_json(F.struct(*projects.columns), {"ignoreNullFields": "false"}), 256))
    joined = ledger.withColumn("project_url", F.coalesce("dataset_url", "qda_url")).join(keyed.select("project_id", "project_url"), "project_url")
    files = joined.select("project_id", *_ledger_file())
    filled = lambda c: F.col(c).isNotNull() & (F.trim(c) != "")
    roles = joined.where(filled("uploader_name")).select("project_id", F.col("uploader_name").alias("name"), F.lit("UPLOADER").alias("role")).distinct()
    licenses = joined.where(filled("license")).select("project_id", "license").distinct()
    return {"projects": keyed, "files": files, "person_roles": roles, "licenses": licenses}

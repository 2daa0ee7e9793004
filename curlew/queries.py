"""Queries of the core operators over the driver's tables, one or more for each family of the inventory."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curlew.functions import text as X
from curlew.functions import urls as U
from curlew.operators import classify, dedup, drift, gates, staging
from curlew.operators.schema_drift import FILE_FIELDS, PROJECT_FIELDS, consistent, drift_report
from curlew.operators.timestamps import normalise_timestamps
from curlew.oracles import LEGAL, ORACLES, RESEARCH
from curlew.plans import delivery
from curlew.session import materialize, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _tables(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    return [table(spark, sf_dir, n) for n in names]


def _projects_sources_files(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    return _tables(spark, sf_dir, "stg_projects", "source_databases", "stg_files")


@query
def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalise_timestamps(*_tables(spark, sf_dir, "stg_projects", "source_clocks"))


@query
def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift_report(*_tables(spark, sf_dir, "source_databases", "stg_projects", "stg_files"))


def _consistent_projects(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = T.StructType([T.StructField(f, T.StringType()) for f in PROJECT_FIELDS])
    return consistent(table(spark, sf_dir, "stg_projects"), "raw_project_json", target, ("project_uid",))


def _consistent_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = T.StructType([T.StructField(f, T.LongType() if f == "file_size_bytes" else T.StringType()) for f in FILE_FIELDS])
    return consistent(table(spark, sf_dir, "stg_files"), "raw_file_json", target, ("file_uid",))


@query
def p4_projects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _consistent_projects(spark, sf_dir)


@query
def p4_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _consistent_files(spark, sf_dir)


# Staging: projections, references, audits.


@query
def s_staged_projects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _consistent_projects(spark, sf_dir).select("project_uid", *[X.as_text(c).alias(c) for c in ("title", "language", "doi", "project_url", "upload_date")])


@query
def s_staged_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _consistent_files(spark, sf_dir).select("file_uid", X.as_text("file_name").alias("file_name"), X.as_text("file_type").alias("file_type"), F.col("file_size_bytes").alias("size_bytes"))


@query
def s_schema_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.transform(F.split("source_schema_signature", r"\|"), lambda t: F.lower(F.trim(t)))
    return table(spark, sf_dir, "source_databases").groupBy(F.array_join(F.array_sort(names), "|").alias("signature")).agg(F.count(F.lit(1)).alias("databases"))


@query
def j_reference_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    projects, files = _tables(spark, sf_dir, "stg_projects", "stg_files")
    return staging.issues(files, projects).groupBy("source_database_id", "issue_code", "severity").agg(F.count(F.lit(1)).alias("issues"))


@query
def a_import_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    projects, sources, files = _projects_sources_files(spark, sf_dir)
    return staging.import_audit(projects, files, sources)


@query
def u_repeated_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.repeated_keys(table(spark, sf_dir, "stg_files"), "file_uid")


@query
def j_project_file_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    projects, files = _tables(spark, sf_dir, "stg_projects", "stg_files")
    return projects.select("project_uid").join(dedup.file_counts(files), "project_uid", "left").select("project_uid", F.coalesce("file_count", F.lit(0)).alias("file_count"))


# Duplicates: profiles, registry, resolution, runs.


@query
def a_source_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.source_profiles(*_projects_sources_files(spark, sf_dir))


@query
def a_profile_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return a_source_profiles(spark, sf_dir).groupBy("candidate_granularity").agg(F.count(F.lit(1)).alias("sources"))


@query
def d_duplicate_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.clusters(dedup.candidates(*_projects_sources_files(spark, sf_dir)))


@query
def d_cluster_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.cluster_members(dedup.candidates(*_projects_sources_files(spark, sf_dir))).select("cluster_id", "project_uid", "source_student_id", "repository_id", "member_rank", "is_canonical")


@query
def d_cluster_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d_duplicate_clusters(spark, sf_dir).groupBy("raw_member_count").agg(F.count(F.lit(1)).alias("clusters"))


def _decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    projects, sources, files = _projects_sources_files(spark, sf_dir)
    return dedup.decisions(projects, sources, files, table(spark, sf_dir, "duplicate_cluster_members"))


@query
def d_resolution_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _decisions(spark, sf_dir).drop("cluster_id")


@query
def d_decision_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.decision_tags(_decisions(spark, sf_dir)).groupBy("tag").agg(F.count(F.lit(1)).alias("projects"))


@query
def d_scope_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.scope_summary(_decisions(spark, sf_dir))


@query
def o_latest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.latest_run(table(spark, sf_dir, "deduplication_runs"))


@query
def a_latest_run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = dedup.of_latest_run(*_tables(spark, sf_dir, "deduplication_runs", "deduplication_decisions"))
    excluded = F.col("decision") == "EXCLUDED_FROM_DEDUPLICATED_ANALYSIS"
    return latest.groupBy("source_scope", "decision", "evidence_rule").agg(F.count(F.lit(1)).alias("decisions"), F.sum(F.when(excluded, 1).otherwise(0)).alias("excluded"))


@query
def m_run_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs, decided = _tables(spark, sf_dir, "deduplication_runs", "deduplication_decisions")
    return drift.run_drift(dedup.run_fingerprints(decided.dropDuplicates(["decision_id"])), runs)


@query
def q_dedup_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    decided = materialize(_decisions(spark, sf_dir), "decided")  # several checks read it
    return gates.dedup_gate(table(spark, sf_dir, "stg_projects"), decided, dedup.decision_tags(decided))


# Classification.


@query
def c_project_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.project_types(*_tables(spark, sf_dir, "stg_projects", "stg_files"))


@query
def c_type_and_rule_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c_project_types(spark, sf_dir).groupBy("project_type", "classification_rule").agg(F.count(F.lit(1)).alias("projects"))


@query
def c_evidence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.evidence_audit(*_tables(spark, sf_dir, "stg_projects", "stg_files"))


@query
def c_project_term_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.classify_terms(table(spark, sf_dir, "stg_projects"), "project_uid", ("title", "description"), legal=LEGAL, research=RESEARCH)


@query
def c_document_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("file_key"), "project_uid", "text")
    own = classify.classify_terms(table(spark, sf_dir, "stg_projects"), "project_uid", ("title", "description"), legal=LEGAL, research=RESEARCH)
    return classify.file_classes(documents.select("file_key", "project_uid"), documents.select("file_key", "text"), own, legal=LEGAL, research=RESEARCH)


@query
def a_extension_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.extension_histogram(table(spark, sf_dir, "stg_files"))


# Text and URL functions over whole columns.


@query
def x_text_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "stg_projects").select(
        "project_uid", X.canonical_doi("doi").alias("doi_key"), X.title_key("title").alias("title_key"), X.is_file_like_title("title").alias("file_like"),
        X.canonical_id("source_project_id").alias("clean_id"), X.optional_int("version").alias("version_number"), X.year("upload_date").alias("upload_year"), X.as_text("description").isNull().alias("blank_description"),
    )


@query
def x_url_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "stg_files").select(
        "file_uid", U.ledger_url("file_url").alias("ledger_url"), U.file_name_of("file_url").alias("url_name"), U.is_download("file_url").alias("download"), U.provider("local_path").alias("provider"), X.file_extension("file_name").alias("extension"),
    ).distinct()


@query
def a_url_providers(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = table(spark, sf_dir, "stg_projects").select(F.explode(U.locations("project_url")).alias("place"))
    return places.groupBy(U.provider("place").alias("provider")).agg(F.count(F.lit(1)).alias("places"))


# Drift of projects.


def _snapshot(projects: DataFrame, types: DataFrame) -> DataFrame:
    # Types are joined on the key; the classification fields that the tables lack are null.
    fields = projects.select("project_uid", *drift.METADATA).join(types.select("project_uid", "project_type", "classification_rule"), "project_uid", "left")
    return drift.fingerprints(fields, "project_uid", {"metadata": drift.METADATA, "classification": ("project_type", "classification_rule")})


@query
def m_project_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    projects, files = _tables(spark, sf_dir, "stg_projects", "stg_files")
    return _snapshot(projects, classify.project_types(projects, files))


@query
def m_project_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Against the snapshot before each contributor's last delivery, when titles were stripped and later files weren't there yet."""
    projects, sources, files = _projects_sources_files(spark, sf_dir)
    last = sources.groupBy("source_student_id").agg(F.max_by("source_database_id", F.struct("registered_at_utc", "source_database_id")).alias("source_database_id"))
    earlier = sources.select("source_database_id").join(last, "source_database_id", "left_anti")
    before = projects.join(earlier, "source_database_id", "left_semi").withColumn("title", X.strip("title"))
    types_before = classify.project_types(before, files.join(earlier, "source_database_id", "left_semi"))
    drifted = drift.project_drift(_snapshot(projects, classify.project_types(projects, files)), _snapshot(before, types_before))
    return drifted.groupBy("status", "reclassification_required", "reasons").agg(F.count(F.lit(1)).alias("projects"))


# Delivery.


@query
def l_export_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    projects, files = _tables(spark, sf_dir, "stg_projects", "stg_files")
    return delivery.export_rows(projects, files, classify.project_types(projects, files))


@query
def l_repository_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    projects, files = _tables(spark, sf_dir, "stg_projects", "stg_files")
    return delivery.repository_summary(projects, files, classify.project_types(projects, files))


@query
def l_staging_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivery.staging_statistics(*_tables(spark, sf_dir, "source_databases", "stg_projects"))


@query
def l_delivery_projects(spark: SparkSession, sf_dir: str) -> DataFrame:
    projects, files, classes = _tables(spark, sf_dir, "stg_projects", "stg_files", "isic_project_classifications")
    return delivery.delivery_projects(projects, classify.project_types(projects, files), classes)


@query
def q_release_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The types that are found against those that the deliveries state."""
    projects, files = _tables(spark, sf_dir, "stg_projects", "stg_files")
    count = lambda df, c: df.groupBy(F.concat_ws("|", F.coalesce("repository_id", F.lit("")), F.coalesce(c, F.lit(""))).alias("key")).agg(F.count(F.lit(1)).alias("value"))
    found = classify.project_types(projects, files).join(projects.select("project_uid", "repository_id"), "project_uid")
    return gates.distribution_gate(count(found, "project_type"), count(projects, "upstream_project_type"), "project_types")


def _ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    projects, files = _tables(spark, sf_dir, "stg_projects", "stg_files")
    about = projects.select("project_uid", F.col("project_url").alias("dataset_url"), "title", "description", "doi", F.col("download_date").alias("download_timestamp"), F.element_at(F.array(*[F.lit(r) for r in ("DANS", "icpsr", "Zenodo", "other")]), F.pmod("source_database_id", F.lit(4)).cast("int") + 1).alias("repository"))
    mine = files.select("project_uid", F.col("file_url").alias("qda_url"), F.col("file_name").alias("local_qda_filename"), "file_type", F.col("status").alias("download_status"), F.lower("status").alias("error_message"), F.col("local_path").alias("local_directory"))
    return mine.join(about, "project_uid").drop("project_uid").withColumn("uploader_name", F.lit(None).cast("string")).withColumn("license", F.lit(None).cast("string"))


@query
def l_migrated_projects(spark: SparkSession, sf_dir: str) -> DataFrame:
    migrated = delivery.migrate_ledger(_ledger(spark, sf_dir))["projects"].drop("project_id")
    return migrated.groupBy("repository_id", "repository_url", "download_repository_folder", "download_method").agg(F.count(F.lit(1)).alias("projects"), F.count_distinct("doi").alias("dois"), F.count_distinct("download_project_folder").alias("folders"))


@query
def l_migrated_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files that the migration makes of the whole ledger, counted without fanning links out."""
    return delivery.migrated_file_counts(_ledger(spark, sf_dir))


# Stored resolutions, deliveries and reports.


@query
def q_run_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate over the stored tables of a resolution under the latest run."""
    runs = table(spark, sf_dir, "deduplication_runs")
    decided = materialize(_decisions(spark, sf_dir), "decided")
    tables = dedup.decision_tables(decided, dedup.latest_run(runs).first()["run_id"])
    return gates.run_gate(table(spark, sf_dir, "stg_projects"), tables, runs)


@query
def q_foreign_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    declared = [
        ("stg_projects", "source_database_id", "source_databases"), ("stg_files", "source_database_id", "source_databases"), ("stg_files", "project_uid", "stg_projects"), ("duplicate_cluster_members", "project_uid", "stg_projects"),
        ("deduplication_decisions", "project_uid", "stg_projects"), ("deduplication_decisions", "run_id", "deduplication_runs"), ("isic_project_classifications", "project_uid", "stg_projects"), ("documents", "project_uid", "stg_projects"),
    ]
    return gates.foreign_keys({n: table(spark, sf_dir, n) for n in {x for c, _, p in declared for x in (c, p)}}, declared)


@query
def m_run_scopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.run_scopes(*_tables(spark, sf_dir, "deduplication_runs", "deduplication_decisions"))


@query
def a_import_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    projects, sources, files = _projects_sources_files(spark, sf_dir)
    return staging.import_totals(staging.import_audit(projects, files, sources), sources)


def _members(name: str, field: str) -> Query:
    def members(spark: SparkSession, sf_dir: str) -> DataFrame:
        return staging.member_rows(table(spark, sf_dir, "stg_projects"), "raw_project_json", field, "project_uid", name)

    members.__name__ = f"s_{name}s"
    return members


for _name, _field in (("keyword", "keywords"), ("license", "license"), ("person", "creators")):
    query(_members(_name, _field))


@query
def s_file_class_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "stg_files")
    return files.select("file_uid", classify.file_class_id(F.col("project_uid"), F.lit("STAGED"), F.col("local_path")).alias("file_class_id")).distinct()


def _delivery(spark: SparkSession, sf_dir: str) -> tuple[dict[str, DataFrame], DataFrame, DataFrame]:
    projects, files, classes = _tables(spark, sf_dir, "stg_projects", "stg_files", "isic_project_classifications")
    types = materialize(classify.project_types(projects, files), "types")
    return delivery.delivery_tables(projects, types, classes, files), types, projects


@query
def l_delivery_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _delivery(spark, sf_dir)[0]["files"]


@query
def l_delivery_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _delivery(spark, sf_dir)[0]["types"]


@query
def l_delivery_isic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _delivery(spark, sf_dir)[0]["isic"]


@query
def q_delivery_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables, types, projects = _delivery(spark, sf_dir)
    return gates.delivery_gate(tables, types, projects, (5, 15))


@query
def q_isic_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The divisions of delivered projects against all known labels of the repositories' projects."""
    tables, _, projects = _delivery(spark, sf_dir)
    label = F.coalesce("primary_division_code", F.lit("none")).alias("key")
    count = lambda df: df.groupBy(label).agg(F.count(F.lit(1)).alias("value"))
    official = projects.where(F.col("repository_id").try_cast("int").isin(5, 15)).select("project_uid")
    known = table(spark, sf_dir, "isic_project_classifications").join(official, "project_uid", "left_semi").select("project_uid", "primary_division_code").distinct()
    return gates.distribution_gate(count(tables["isic"]), count(known), "isic_divisions")


@query
def l_headline(spark: SparkSession, sf_dir: str) -> DataFrame:
    projects, sources, files = _projects_sources_files(spark, sf_dir)
    return delivery.headline(sources, projects, files, classify.project_types(projects, files), table(spark, sf_dir, "isic_project_classifications"))


@query
def c_unconfirmed_extensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.unconfirmed_extensions(classify.unconfirmed(*_tables(spark, sf_dir, "stg_projects", "stg_files")))


@query
def c_unconfirmed_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sample of a hundred that the audit shows."""
    return classify.unconfirmed_sample(classify.unconfirmed(*_tables(spark, sf_dir, "stg_projects", "stg_files")))


@query
def c_division_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.division_counts(c_project_term_classes(spark, sf_dir))


@query
def c_file_rule_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    projects, sources = _tables(spark, sf_dir, "stg_projects", "source_databases")
    return classify.file_rule_counts(c_document_classes(spark, sf_dir), projects, sources)

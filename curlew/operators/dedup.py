"""Exact-identifier duplicates: source profiles, candidate registry, resolution and its summaries.

Everything is keyed aggregation and ranking. Text keys are computed once, in the
scan; only the key columns travel, and the descriptions stay behind. Source profiles
are as many as sources. Files are counted per project before any join, so a project
with a tenth of all files is one row when it meets the others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from curlew import vocab as V
from curlew.functions import text as X
from curlew.operators.numbering import ranks


def filled(c: str) -> Column:
    """Whether a text is neither null nor empty."""
    return F.coalesce(F.col(c) != "", F.lit(False))


def file_counts(files: DataFrame) -> DataFrame:
    """(project_uid, file_count); a re-delivered file counts once."""
    return files.where(F.col("project_uid").isNotNull()).select("project_uid", "file_uid").distinct().groupBy("project_uid").agg(F.count("file_uid").alias("file_count"))


def granularity(projects: Column, files: Column, file_like: Column, repeated: Column) -> Column:
    """Whether a source lists data sets or single files, from its counts."""
    rate = lambda c: c / projects
    return (
        F.when(projects == 0, "DATASET_LIKE")
        .when((rate(repeated) >= 0.25) & (rate(files) <= 2.0), "FILE_LEVEL_LIKELY")
        .when((rate(file_like) >= 0.50) & (rate(files) <= 1.5), "FILE_LEVEL_LIKELY")
        .when((rate(repeated) >= 0.05) | (rate(file_like) >= 0.15), "MIXED_OR_REVIEW")
        .otherwise("DATASET_LIKE")
    )


def keyed_projects(projects: DataFrame) -> DataFrame:
    """The columns that duplicate detection needs, with their keys; no description travels."""
    return projects.where(F.col("project_uid").isNotNull()).select(
        "project_uid", "source_database_id", F.coalesce("repository_id", F.lit("")).alias("repository_id"),
        X.canonical_doi("doi").alias("doi_key"), X.title_key("title").alias("title_key"), X.is_file_like_title("title").alias("file_like"),
        *[filled(c).alias(f"has_{c}") for c in ("doi", "description", "project_url", "repository_url", "language", "upload_date")],
    )


def source_profiles(projects: DataFrame, sources: DataFrame, files: DataFrame) -> DataFrame:
    """One row for each source, those without projects included."""
    keyed = keyed_projects(projects)
    by_doi = keyed.groupBy("source_database_id", "doi_key").agg(F.count(F.lit(1)).alias("n"), F.count_if("file_like").alias("f"))
    counts = by_doi.groupBy("source_database_id").agg(F.sum("n").alias("project_count"), F.sum("f").alias("file_like_title_records"), F.sum(F.when((F.col("doi_key") != "") & (F.col("n") > 1), F.col("n")).otherwise(0)).alias("repeated_doi_records"))
    filed = files.select("source_database_id", "file_uid").distinct().groupBy("source_database_id").agg(F.count("file_uid").alias("file_count"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    joined = sources.select("source_database_id", "source_student_id", "source_scope").join(counts, "source_database_id", "left").join(filed, "source_database_id", "left")
    joined = joined.select("source_database_id", "source_student_id", "source_scope", *[zero(c) for c in ("project_count", "file_count", "file_like_title_records", "repeated_doi_records")])
    return joined.withColumn("candidate_granularity", granularity(*[F.col(c) for c in ("project_count", "file_count", "file_like_title_records", "repeated_doi_records")]))


def candidates(projects: DataFrame, sources: DataFrame, files: DataFrame) -> DataFrame:
    """Projects of data-set-like sources with both keys, their contributor and file count."""
    profiles = source_profiles(projects, sources, files).where(F.col("candidate_granularity") == "DATASET_LIKE").select("source_database_id", "source_student_id", "source_scope")
    keyed = keyed_projects(projects).where((F.col("doi_key") != "") & (F.col("title_key") != ""))
    return keyed.join(profiles, "source_database_id").join(file_counts(files), "project_uid", "left").withColumn("file_count", F.coalesce("file_count", F.lit(0)))


def registry_keys() -> list[Column]:
    """The order of a cluster's records: the core scope first, then the richer record, then the smaller uid."""
    score = F.col("has_description").cast("int") + F.col("has_project_url").cast("int") + F.col("has_doi").cast("int") + F.least(F.lit(3), F.col("file_count"))
    return [F.when(F.col("source_scope") == "MY_CORE", 0).otherwise(1), -score, F.col("project_uid")]


def cluster_members(found: DataFrame, least_contributors: int = 2) -> DataFrame:
    """Members of groups of equal keys from several contributors, ranked; the first is canonical."""
    groups = found.groupBy("doi_key", "title_key").agg(F.count_distinct("source_student_id").alias("n")).where(F.col("n") >= least_contributors).drop("n")
    members = found.join(groups, ["doi_key", "title_key"]).withColumns({f"_k{i}": k for i, k in enumerate(registry_keys())})
    ranked = ranks(members, ["doi_key", "title_key"], ["_k0", "_k1", "_k2"], "member_rank").drop("_k0", "_k1", "_k2")
    return ranked.withColumn("is_canonical", (F.col("member_rank") == 1).cast("long")).withColumn("cluster_id", X.cluster_id(F.col("doi_key"), F.col("title_key")))


def clusters(found: DataFrame, least_contributors: int = 2) -> DataFrame:
    """Candidate clusters with their statistics and canonical record, by aggregation alone."""
    keys = registry_keys()
    grouped = found.groupBy("doi_key", "title_key").agg(
        F.count(F.lit(1)).alias("raw_member_count"), F.count_distinct("source_database_id").alias("unique_source_count"),
        F.count_distinct("source_student_id").alias("unique_student_count"), F.count_distinct("repository_id").alias("unique_repository_count"),
        F.min(F.struct(*[k.alias(f"k{i}") for i, k in enumerate(keys)]))["k2"].alias("canonical_project_uid"),
    )
    return grouped.where(F.col("unique_student_count") >= least_contributors).select(
        X.cluster_id(F.col("doi_key"), F.col("title_key")).alias("cluster_id"), F.lit("EXACT_DOI_AND_NORMALIZED_TITLE").alias("cluster_key_type"),
        F.concat_ws("|", "doi_key", "title_key").alias("canonical_key"), F.lit("HIGH_CONFIDENCE").alias("candidate_strength"),
        "raw_member_count", "unique_source_count", "unique_student_count", "unique_repository_count", F.lit(1).cast("long").alias("unique_title_count"), "canonical_project_uid",
    )


def completeness(scope: str = "source_scope") -> Column:
    """How complete a record's metadata is; all weights are quarters, so sums are exact."""
    weights = ((F.col("doi_key") != "", 4.0), (F.col("has_project_url"), 3.0), (F.col("has_repository_url"), 1.0), (F.col("has_description"), 2.0), (F.col("has_language"), 0.5), (F.col("has_upload_date"), 0.5))
    score = F.least(F.lit(3.0), F.col("file_count") * F.lit(0.25)) + F.when(F.col(scope) == "MY_CORE", 0.25).otherwise(0.0)
    for hit, weight in weights:
        score = score + F.when(hit, weight).otherwise(0.0)
    return score


def decisions(projects: DataFrame, sources: DataFrame, files: DataFrame, members: DataFrame) -> DataFrame:
    """One decision for each project: canonical, excluded, kept for review, or unique.

    ``members`` has (cluster_id, project_uid). A cluster is confirmed if it has two
    records or more, one DOI, one eligible title, and data-set-like sources only; the
    first failing condition is the reason otherwise. The canonical record is the most
    complete one, then the one of more files, then the smaller uid.
    """
    profiles = source_profiles(projects, sources, files).select("source_database_id", "source_scope", "candidate_granularity")
    records = keyed_projects(projects).join(profiles, "source_database_id").join(file_counts(files), "project_uid", "left").withColumn("file_count", F.coalesce("file_count", F.lit(0))).withColumn("canonical_score", completeness())
    known = members.select("cluster_id", "project_uid").where(F.col("cluster_id").isNotNull()).distinct().join(records, "project_uid")
    judged = known.groupBy("cluster_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("doi_key").alias("d0"), F.max("doi_key").alias("d1"), F.min("title_key").alias("t0"), F.max("title_key").alias("t1"),
        F.bool_and(F.col("candidate_granularity") == "DATASET_LIKE").alias("sets"),
        F.min(F.struct((-F.col("canonical_score")).alias("s"), (-F.col("file_count")).alias("f"), "project_uid"))["project_uid"].alias("canonical_project_uid"),
    )
    reason = (
        F.when(F.col("n") < 2, "Cluster has fewer than two records.")
        .when((F.col("d0") != F.col("d1")) | (F.col("d0") == ""), "Members do not share one valid canonical DOI.")
        .when((F.col("t0") != F.col("t1")) | (F.col("t0") == ""), "Members do not share the same eligible normalized title.")
        .when(~F.col("sets"), "At least one member is not from a DATASET_LIKE source.")
    )
    judged = judged.select("cluster_id", "canonical_project_uid", reason.alias("failed"))
    first = Window.partitionBy("project_uid").orderBy("cluster_id")  # a project in several clusters is decided in the first
    grouped = known.select("cluster_id", "project_uid").withColumn("_r", F.row_number().over(first)).where("_r = 1").drop("_r").join(judged, "cluster_id")
    df = records.join(grouped, "project_uid", "left")
    clustered, confirmed = F.col("cluster_id").isNotNull(), F.col("cluster_id").isNotNull() & F.col("failed").isNull()
    own = F.col("project_uid") == F.col("canonical_project_uid")
    return df.select(
        "project_uid", F.coalesce("canonical_project_uid", "project_uid").alias("canonical_project_uid"), "source_scope", "cluster_id",
        F.when(confirmed & ~own, "EXCLUDED_FROM_DEDUPLICATED_ANALYSIS").when(confirmed, "CANONICAL_RECORD").when(clustered, "RETAINED_FOR_REVIEW").otherwise("UNIQUE_RECORD").alias("decision"),
        F.when(confirmed, "CONFIRMED_EXACT_DOI_AND_NORMALIZED_TITLE").when(clustered, "AMBIGUOUS_DUPLICATE_REVIEW").otherwise("NO_CONFIRMED_DUPLICATE").alias("evidence_rule"),
        F.when(clustered & ~confirmed, 0.0).otherwise(1.0).alias("confidence"), "canonical_score",
        F.coalesce("failed", F.when(confirmed, "Exact DOI and normalized-title evidence confirmed across dataset-like sources.").otherwise("No confirmed duplicate cluster membership.")).alias("decision_reason"),
    )


def decision_tags(decided: DataFrame) -> DataFrame:
    """(project_uid, tag)."""
    tags = (
        F.when(F.col("decision") == "UNIQUE_RECORD", F.array(F.lit("UNIQUE_RECORD"), F.lit("RETAINED_IN_ANALYSIS")))
        .when(F.col("decision") == "RETAINED_FOR_REVIEW", F.array(F.lit("AMBIGUOUS_DUPLICATE_REVIEW"), F.lit("RETAINED_IN_ANALYSIS")))
        .otherwise(F.array(F.lit("CONFIRMED_DUPLICATE"), F.lit("EXACT_IDENTIFIER_DUPLICATE"), F.col("decision")))
    )
    return decided.select("project_uid", F.explode(tags).alias("tag"))


def decision_tables(decided: DataFrame, run_id: str) -> dict[str, DataFrame]:
    """One resolution as its stored tables: decisions, tags, audit, the deduplicated analysis, and the run's own counts."""
    kept = F.col("decision") != "EXCLUDED_FROM_DEDUPLICATED_ANALYSIS"
    return {
        "decisions": decided,
        "tags": decision_tags(decided),
        "audit": decided.select("project_uid", "evidence_rule", "decision_reason", "canonical_score"),
        "analysis": decided.where(kept).select("project_uid", "source_scope"),
        "run": decided.agg(F.lit(run_id).alias("run_id"), F.count(F.lit(1)).alias("raw_projects"), F.count_if(kept).alias("included"), F.count_if(~kept).alias("excluded")),
    }


def run_scopes(runs: DataFrame, decided: DataFrame) -> DataFrame:
    """(run_id, source_scope, decisions, excluded) of each run; rows that arrive twice count once, runs without decisions have none."""
    once = decided.dropDuplicates(["decision_id"]).select("run_id", "source_scope", "decision")
    return runs.select("run_id").join(once, "run_id").groupBy("run_id", "source_scope").agg(F.count(F.lit(1)).alias("decisions"), F.count_if(F.col("decision") == "EXCLUDED_FROM_DEDUPLICATED_ANALYSIS").alias("excluded"))


def scope_summary(decided: DataFrame, scopes: tuple[str, ...] = V.SCOPES) -> DataFrame:
    """One row for each scope, those without projects included."""
    counted = decided.groupBy("source_scope").agg(
        F.count(F.lit(1)).alias("raw_projects"), F.count("cluster_id").alias("candidate_cluster_members"), F.count_distinct("cluster_id").alias("candidate_clusters_touching_scope"),
        F.count_if(F.col("decision") == "EXCLUDED_FROM_DEDUPLICATED_ANALYSIS").alias("excluded_duplicates"),
    )
    names = ("raw_projects", "candidate_cluster_members", "candidate_clusters_touching_scope", "excluded_duplicates")
    all_scopes = decided.sparkSession.createDataFrame([(s,) for s in scopes], "source_scope string")
    filled_in = all_scopes.join(counted, "source_scope", "left").select("source_scope", *[F.coalesce(c, F.lit(0)).alias(c) for c in names])
    return filled_in.withColumn("deduplicated_projects", F.col("raw_projects") - F.col("excluded_duplicates"))


def latest_run(runs: DataFrame) -> DataFrame:
    """The run created last; the larger run_id among equals."""
    return runs.orderBy(F.col("created_at_utc").desc_nulls_last(), F.col("run_id").desc()).limit(1)


def of_latest_run(runs: DataFrame, decided: DataFrame) -> DataFrame:
    """The different decisions of the latest run; rows that arrive twice count once."""
    return decided.join(F.broadcast(latest_run(runs).select("run_id")), "run_id").dropDuplicates(["decision_id"])  # one row is broadcast


def run_fingerprints(decided: DataFrame) -> DataFrame:
    """(run_id, decision_records, decision_fingerprint): order-independent and aware of repeats.

    Each row's hash goes to one of 256 buckets; a bucket is hashed over its sorted
    row hashes folded to sums, and a run over its buckets, so no task holds a run.
    """
    fields = ("project_uid", "canonical_project_uid", "decision", "evidence_rule", "canonical_score")
    row = decided.select("run_id", X.stable_hash(*fields).alias("h")).withColumn("b", F.substring("h", 1, 2))
    # Sums of the hash's four 60-bit pieces identify a multiset of rows without listing it.
    piece = lambda i: F.sum(F.conv(F.substring("h", 1 + 15 * i, 15), 16, 10).cast("decimal(38,0)"))
    buckets = row.groupBy("run_id", "b").agg(F.count(F.lit(1)).alias("n"), *[piece(i).alias(f"p{i}") for i in range(4)])
    text = F.concat_ws(":", "b", "n", *[F.col(f"p{i}").cast("string") for i in range(4)])
    return buckets.groupBy("run_id").agg(F.sum("n").alias("decision_records"), F.sha2(F.array_join(F.array_sort(F.collect_list(text)), "|"), 256).alias("decision_fingerprint"))

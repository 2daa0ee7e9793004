"""Drift monitoring: fingerprints of entities against a stored snapshot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from curlew.functions import text as X

METADATA = ("repository_id", "repository_url", "project_url", "title", "description", "language", "doi")
CLASSIFICATION = ("project_type", "primary_section_code", "primary_division_code", "secondary_division_code", "classification_rule", "confidence", "classifier_version")


def fingerprints(rows: DataFrame, key: str, groups: dict[str, tuple[str, ...]]) -> DataFrame:
    """(key, <name>_sha256...): one hash for each group of fields."""
    return rows.select(key, *[X.stable_hash(*fields).alias(f"{name}_sha256") for name, fields in groups.items()])


def reasons_of(pairs: list[tuple[str, Column]], known: Column) -> Column:
    """The names of the changes that hold; UNCHANGED if none, BASELINE_CREATED where nothing is known."""
    found = F.filter(F.array(*[F.when(hit, F.lit(name)) for name, hit in pairs]), lambda x: x.isNotNull())
    return F.when(~known, F.array(F.lit("BASELINE_CREATED"))).when(F.size(found) > 0, found).otherwise(F.array(F.lit("UNCHANGED")))


def compare(current: DataFrame, previous: DataFrame, key: str, changes: dict[str, str], grave: tuple[str, ...], removed: bool = False) -> DataFrame:
    """(key, status, reclassification_required, reasons) of each entity.

    ``changes`` names a change for each compared column. A ``grave`` change requires
    reclassification; otherwise the first reason is the status. With ``removed``,
    entities that are only in the snapshot come out as REMOVED.
    """
    before = previous.select(F.col(key).alias("_key"), *[F.col(c).alias(f"_{c}") for c in changes], F.lit(True).alias("_known"))
    df = current.join(before, current[key] == before["_key"], "full" if removed else "left")
    gone, known = F.col(key).isNull(), F.coalesce("_known", F.lit(False))
    reasons = reasons_of([(name, ~F.col(c).eqNullSafe(F.col(f"_{c}"))) for c, name in changes.items()], known)
    df = df.select(F.coalesce(key, "_key").alias(key), F.when(gone, F.array(F.lit("REMOVED"))).otherwise(reasons).alias("r"))
    must = F.arrays_overlap("r", F.array(*[F.lit(g) for g in grave]))
    return df.select(key, F.when(must, "RECLASSIFICATION_REQUIRED").otherwise(F.col("r")[0]).alias("status"), must.alias("reclassification_required"), F.array_join("r", "|").alias("reasons"))


def project_drift(current: DataFrame, previous: DataFrame, **options) -> DataFrame:
    """Drift of project fingerprints: changed metadata requires reclassification, a changed class alone doesn't."""
    return compare(current, previous, "project_uid", {"metadata_sha256": "METADATA_CHANGED", "classification_sha256": "CLASSIFICATION_OUTPUT_CHANGED"}, ("METADATA_CHANGED",), **options)


def archive_drift(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Drift of archives by (archive, archive_sha256, manifest_sha256, zip_status); any change is grave."""
    changes = {"archive_sha256": "ARCHIVE_CHANGED", "manifest_sha256": "INTERNAL_MANIFEST_CHANGED", "zip_status": "STATUS_CHANGED"}
    return compare(current, previous, "archive", changes, tuple(changes.values()))


def run_drift(fingerprinted: DataFrame, runs: DataFrame) -> DataFrame:
    """(run_id, previous_run_id, status) of each run against the one created before it."""
    # Runs are few: one row each.
    order = Window.orderBy("created_at_utc", "run_id")
    df = runs.select("run_id", "created_at_utc", "resolution_version").join(fingerprinted, "run_id", "left")
    before = lambda c: F.lag(c).over(order)
    return df.select(
        "run_id", before("run_id").alias("previous_run_id"),
        F.when(before("run_id").isNull(), "BASELINE_CREATED").when(~F.col("resolution_version").eqNullSafe(before("resolution_version")), "RESOLUTION_VERSION_CHANGED")
        .when(~F.col("decision_fingerprint").eqNullSafe(before("decision_fingerprint")), "DECISIONS_CHANGED").otherwise("UNCHANGED").alias("status"),
    )


def schema_fingerprint(tables: dict[str, DataFrame]) -> str:
    """SHA-256 over the tables' schemas in order of their names."""
    import hashlib

    return hashlib.sha256("|".join(f"{n}:{tables[n].schema.json()}" for n in sorted(tables)).encode()).hexdigest()


def save_snapshot(snapshot: DataFrame, folder: str, stamp: str) -> None:
    """Write a snapshot to the history under its time stamp, then let ``latest`` name it: a crash leaves the snapshot before."""
    snapshot.write.mode("overwrite").parquet(f"{folder}/history/ts={stamp}")
    spark = snapshot.sparkSession
    spark.createDataFrame([(stamp,)], "stamp string").coalesce(1).write.mode("append").text(f"{folder}/latest")


def load_snapshot(spark: SparkSession, folder: str) -> DataFrame | None:
    """The snapshot of the latest stamp that was named, or none before the first."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/latest")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    stamp = spark.read.text(f"{folder}/latest").agg(F.max("value")).first()[0]
    return spark.read.parquet(f"{folder}/history/ts={stamp}") if stamp else None

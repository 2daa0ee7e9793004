"""Staging: canonical projections of dynamic rows, and the issues found on the way."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curlew.functions import text as X
from curlew.operators.schema_drift import ingest


def stage(rows: DataFrame, raw: str, aliases: dict[str, list[str]], key_fields: tuple[str, ...]) -> DataFrame:
    """Key columns, one text column for each staged field (blank is null), and what remains as ``_rescued``.

    ``aliases`` are the configured names of each field, tried in order after its own;
    where none are configured, ``schema_drift.consistent`` finds them by content.
    """
    target = T.StructType([T.StructField(f, T.StringType()) for f in aliases])
    done = ingest(rows.select(*key_fields, raw), raw, target, aliases)
    return done.select(*key_fields, *[X.as_text(f).alias(f) for f in aliases], "_rescued")


def issues(files: DataFrame, projects: DataFrame) -> DataFrame:
    """(source_database_id, entity_uid, issue_code, severity): files without an id, without or with an unknown project.

    The known projects are one column; the join is a plain equi-join whose side
    AQE broadcasts or splits by size.
    """
    known = projects.select(F.col("project_uid").alias("_known")).where(F.col("_known").isNotNull()).distinct()
    df = files.join(known, files["project_uid"] == known["_known"], "left")
    missing, unreferenced = X.as_text("source_file_id").isNull(), X.as_text("project_uid").isNull()
    found = F.filter(
        F.array(
            F.when(missing, F.struct(F.lit("MISSING_SOURCE_ID").alias("issue_code"), F.lit("ERROR").alias("severity"))),
            F.when(unreferenced, F.struct(F.lit("MISSING_PROJECT_REFERENCE").alias("issue_code"), F.lit("WARNING").alias("severity"))),
            F.when(~unreferenced & F.col("_known").isNull(), F.struct(F.lit("ORPHAN_PROJECT_REFERENCE").alias("issue_code"), F.lit("WARNING").alias("severity"))),
        ),
        lambda x: x.isNotNull(),
    )
    return df.select("source_database_id", F.col("file_uid").alias("entity_uid"), F.explode(found).alias("i")).select("source_database_id", "entity_uid", "i.*")


def import_audit(projects: DataFrame, files: DataFrame, sources: DataFrame) -> DataFrame:
    """One row for each source: rows staged, and FAILED where a project key repeats.

    Files that are delivered again are no failure; their rows and keys show how many.
    """
    counted = [df.groupBy("source_database_id").agg(F.count(F.lit(1)).alias(f"{n}_rows"), F.count_distinct(key).alias(f"{n}_keys")) for df, key, n in ((projects, "project_uid", "project"), (files, "file_uid", "file"))]
    df = sources.select("source_database_id")
    for c in counted:
        df = df.join(c, "source_database_id", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    df = df.select("source_database_id", *[zero(c) for c in ("project_rows", "project_keys", "file_rows", "file_keys")])
    return df.withColumn("import_status", F.when(F.col("project_rows") > F.col("project_keys"), "FAILED").otherwise("COMPLETED"))


def import_totals(audit: DataFrame, sources: DataFrame) -> DataFrame:
    """(source_scope, databases, completed, projects, files): totals of an import audit; rows of failed imports don't count."""
    done = F.col("import_status") == "COMPLETED"
    total = lambda c: F.coalesce(F.sum(F.when(done, F.col(c))), F.lit(0)).alias(c.removesuffix("_rows") + "s")
    return audit.join(sources.select("source_database_id", "source_scope"), "source_database_id").groupBy("source_scope").agg(F.count(F.lit(1)).alias("databases"), F.count_if(done).alias("completed"), total("project_rows"), total("file_rows"))


def member_rows(rows: DataFrame, raw: str, field: str, key: str, name: str) -> DataFrame:
    """(key, name): the values under ``field`` of a raw object as a table of its own, each once for its key.

    A list gives its members, a text the parts between semicolons, an object its
    ``id`` or ``name``, any other value itself. Blank and null values give no row.
    """
    value = F.try_variant_get(F.try_parse_json(F.col(raw)), f"$.{field}", "variant")
    kind = F.schema_of_variant(value)
    text = F.try_variant_get(value, "$", "string")
    named = F.coalesce(F.try_variant_get(value, "$.id", "string"), F.try_variant_get(value, "$.name", "string"))
    parts = F.when(kind.startswith("ARRAY"), F.try_variant_get(value, "$", "array<string>")).when(kind.startswith("OBJECT"), F.array(named)).when(kind == "STRING", F.split(text, ";")).otherwise(F.array(text))
    each = rows.where(F.col(key).isNotNull()).select(key, F.explode(parts).alias("_v")).select(key, X.as_text("_v").alias(name))
    return each.where(F.col(name).isNotNull()).distinct()


def repeated_keys(rows: DataFrame, *keys: str) -> DataFrame:
    """(keys, copies) of the keys that occur more than once."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")

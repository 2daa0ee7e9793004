"""Rescue-column ingestion of drifting JSON rows, and the report of every change (problem 4).

``ingest`` enforces a target schema on raw JSON rows: a field that fits goes to
its typed column, whatever is unknown or can't be cast stays as JSON in
``_rescued``. ``promote`` replays rescued values into typed columns once a field is
approved, for all rows or for single deliveries. ``field_profile`` folds what
ingestion takes and rescues to one line for each delivery, field and type, which
approves fields, and ``drift_report`` compares each delivery with the one before it.
All of it is JVM-side: a row is parsed once, its fields are exploded next to the
staged values and counted, and what leaves the scan has the size of the schemas.

Null raw JSON, text that isn't a JSON object and empty objects have no fields: the
typed columns are null and the text itself is rescued under ``_malformed``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from curlew.session import materialize

# The staged columns that a delivered field may feed.
PROJECT_FIELDS = ("repository_id", "repository_url", "project_url", "query_string", "version", "title", "description", "language", "doi", "upload_date", "download_date", "download_method")
FILE_FIELDS = ("file_name", "file_type", "status", "file_url", "local_path", "file_size_bytes")


def json_type(value: Column) -> Column:
    """string, integer, decimal, boolean, array or object; null for JSON null."""
    name = F.schema_of_variant(value)
    return (
        F.when(name == "STRING", "string")
        .when(name.isin("BIGINT", "INT", "SMALLINT", "TINYINT"), "integer")
        .when(name == "BOOLEAN", "boolean")
        .when(name.startswith("DECIMAL") | name.isin("DOUBLE", "FLOAT"), "decimal")
        .when(name.startswith("ARRAY"), "array")
        .when(name.startswith("OBJECT"), "object")
    )


def parsed(raw: Column) -> Column:
    """The fields of a raw JSON object as a map of variants; null unless it is an object."""
    return F.when(raw.rlike(r"^\s*\{"), F.from_json(raw, "map<string,variant>"))


def _cast(value: Column, kind: T.DataType) -> Column:
    return F.try_variant_get(value, "$", kind.simpleString())


def _fits(name: Column, value: Column, target: T.StructType) -> Column:
    """Whether a field goes to the column of its name: it isn't null and casts to the column's type."""
    hit = F.lit(False)
    for kind in {f.dataType.simpleString(): f.dataType for f in target}.values():
        names = [f.name for f in target if f.dataType == kind]
        hit = hit | (name.isin(*names) & (~F.is_variant_null(value) if kind == T.StringType() else _cast(value, kind).isNotNull()))
    return hit


def ingest(rows: DataFrame, raw: str, target: T.StructType, aliases: dict[str, list[str]] | None = None) -> DataFrame:
    """``rows`` with a column for each field of ``target`` and ``_rescued``.

    A field goes to the column of its name if its value casts to the column's type
    (any value but null to text, so that ``3`` and ``"3"`` agree). Everything else
    is kept in ``_rescued`` as a JSON object. Columns of ``rows`` with a target's
    name give way to the typed column. Rescued values under the ``aliases`` of a
    target field are replayed at once; see ``promote``.
    """
    kept = [c for c in rows.columns if c not in set(target.fieldNames()) | {"_rescued"}]
    df = rows.select(*kept, F.col(raw).alias("_raw")).withColumn("_m", parsed(F.col("_raw")))
    df = df.select(*kept, "_raw", "_m", *[_cast(F.try_element_at("_m", F.lit(f.name)), f.dataType).alias(f.name) for f in target], F.map_filter("_m", lambda k, v: ~_fits(k, v, target)).alias("_rest"))
    malformed = F.when(F.col("_m").isNull() & F.col("_raw").isNotNull(), F.to_json(F.struct(F.col("_raw").alias("_malformed"))))
    done = df.select(*kept, *target.fieldNames(), F.when(F.size("_rest") > 0, F.to_json("_rest")).otherwise(malformed).alias("_rescued"))
    return promote(done, target, aliases) if aliases else done


def promote(ingested: DataFrame, target: T.StructType | T.StructField, names: dict[str, list[str]] | str | None = None) -> DataFrame:
    """Replay ``_rescued`` into the fields of ``target``; what is taken leaves the rescue column.

    A field that is null or not there yet takes the first rescued value among its
    approved ``names`` that casts to its type. ``names`` are a dictionary for all
    rows, or the name of a column of maps (field to list of names), where each row
    brings its own and null approves nothing; without it a field's own name is approved.
    """
    target = T.StructType([target]) if isinstance(target, T.StructField) else target
    if isinstance(names, str):
        listed, some = {f.name: F.try_element_at(names, F.lit(f.name)) for f in target}, F.col(names).isNotNull()
    else:
        listed = {f.name: F.array(*[F.lit(n) for n in (names or {}).get(f.name, [] if names else [f.name])]) for f in target}
        listed, some = {n: c.cast("array<string>") for n, c in listed.items()}, F.lit(True)
    kept = [c for c in ingested.columns if c not in {*target.fieldNames(), "_rescued"}]
    there = {f.name: F.col(f.name) if f.name in ingested.columns else F.lit(None).cast(f.dataType) for f in target}
    df = ingested.select(*kept, *[c.alias(n) for n, c in there.items()], "_rescued", F.when(some, parsed(F.col("_rescued"))).alias("_m"))

    def first(f: T.StructField) -> Column:
        tried = F.transform(listed[f.name], lambda n: F.struct(n.alias("n"), _cast(F.try_element_at("_m", n), f.dataType).alias("v")))
        return F.when(F.col(f.name).isNull(), F.get(F.filter(tried, lambda x: x["v"].isNotNull()), F.lit(0)))

    df = df.select(*kept, "_rescued", "_m", *target.fieldNames(), *[first(f).alias(f"_p_{f.name}") for f in target])
    df = df.withColumn("_used", F.array_compact(F.array(*[F.col(f"_p_{f.name}.n") for f in target])))
    rest = F.map_filter("_m", lambda k, _: ~F.array_contains("_used", k))
    left = F.when(F.size("_used") == 0, F.col("_rescued")).when(F.size("_m") > F.size("_used"), F.to_json(rest))
    return df.select(*kept, *[F.coalesce(F.col(f.name), F.col(f"_p_{f.name}.v")).alias(f.name) for f in target], left.alias("_rescued"))


def delivered_fields(rows: DataFrame, raw: str, staged: tuple[str, ...], delivery: str) -> DataFrame:
    """(_d, _field, _type, _same): each field of each row as ingestion sees it, with the staged columns of its value as bits.

    The target schema is the staged columns. A field that it takes can feed only its
    own column; a rescued field may feed any, which is what approves it for promotion.
    """
    if len(staged) > 62:
        raise ValueError("at most 62 staged columns")
    target = T.StructType([T.StructField(c, T.StringType()) for c in staged])
    source = rows.where(F.col(delivery).isNotNull()).select(F.col(delivery).alias("_d"), parsed(F.col(raw)).alias("_m"), *[F.col(c).cast("string").alias(f"_s_{c}") for c in staged])
    # explode_outer, because Spark would write a filter for explode and parse every row twice.
    each = source.select("_d", *[f"_s_{c}" for c in staged], F.explode_outer("_m").alias("_field", "_v"))
    each = each.select("*", json_type(F.col("_v")).alias("_type"), _cast(F.col("_v"), T.StringType()).alias("_text"), _fits(F.col("_field"), F.col("_v"), target).alias("_taken"))
    bits = F.lit(0).cast("long")
    for i, c in enumerate(staged):
        bits = bits + F.when((F.col(f"_s_{c}") == F.col("_text")) & (~F.col("_taken") | (F.col("_field") == c)), F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long"))
    same = F.when(F.col("_type").isin("string", "integer", "decimal", "boolean"), bits).otherwise(F.lit(0).cast("long"))
    return each.where(F.col("_field").isNotNull()).select("_d", "_field", "_type", same.alias("_same"))


def field_profile(rows: DataFrame, raw: str, staged: tuple[str, ...], delivery: str = "source_database_id") -> DataFrame:
    """(delivery, field, types, feeds): each delivered field, its JSON types, and the staged column with the same content.

    A field feeds the staged column that repeats at least nine tenths of its
    values; the best wins, then the first by name.
    """
    each = delivered_fields(rows, raw, staged, delivery)
    counts = each.groupBy("_d", "_field", "_type", "_same").agg(F.count(F.lit(1)).alias("_n"))
    # From here on the rows are as many as fields of deliveries.
    hits = lambda i: F.coalesce(F.sum(F.when(F.col("_same").bitwiseAND(F.lit(1 << i)) != 0, F.col("_n"))), F.lit(0))
    folded = counts.groupBy("_d", "_field").agg(
        F.array_sort(F.collect_set("_type")).alias("_types"), F.coalesce(F.sum(F.when(F.col("_type").isNotNull(), F.col("_n"))), F.lit(0)).alias("_all"),
        *[hits(i).alias(f"_h{i}") for i in range(len(staged))],
    )
    likely = F.array_compact(F.array(*[F.when((F.col(f"_h{i}") > 0) & (F.col(f"_h{i}") >= 0.9 * F.col("_all")), F.struct((-F.col(f"_h{i}")).alias("n"), F.lit(c).alias("c"))) for i, c in enumerate(staged)]))
    whole = F.array_except("_types", F.when(F.array_contains("_types", "decimal"), F.array(F.lit("integer"))).otherwise(F.array().cast("array<string>")))
    return folded.select(F.col("_d").alias(delivery), F.col("_field").alias("field"), whole.alias("types"), F.array_min(likely)["c"].alias("feeds"))


def approved(profile: DataFrame, delivery: str = "source_database_id") -> DataFrame:
    """(delivery, approved): for each delivery the map of staged columns to the delivered names that feed them.

    A name that feeds one column in one delivery and another elsewhere is approved
    in each for its own. There is a row for each delivery and an entry for each field.
    """
    names = profile.where(F.col("feeds").isNotNull() & (F.col("feeds") != F.col("field"))).groupBy(delivery, "feeds").agg(F.array_sort(F.collect_list("field")).alias("names"))
    return names.groupBy(delivery).agg(F.map_from_entries(F.collect_list(F.struct("feeds", "names"))).alias("approved"))


def consistent(rows: DataFrame, raw: str, target: T.StructType, key: tuple[str, ...], delivery: str = "source_database_id") -> DataFrame:
    """All rows in one shape: (key..., delivery, target fields, ``_rescued``).

    Rows are ingested under the target's own names, the rescued fields that feed a
    staged column are approved delivery by delivery, and ``_rescued`` is replayed
    into the typed columns under the approved names. Rows without a delivery are
    ingested too; nothing is approved for them.
    """
    # A table of one row for each delivery: written, so that its size is known and decides the join.
    names = materialize(approved(field_profile(rows, raw, tuple(target.fieldNames()), delivery), delivery), "approved")
    done = ingest(rows.select(*key, delivery, raw), raw, target).drop(raw)
    return promote(done.join(names, delivery, "left"), target, "approved").select(*key, delivery, *target.fieldNames(), "_rescued")


def _deliveries(databases: DataFrame) -> DataFrame:
    """(before, after): consecutive deliveries of each contributor by time; the id breaks ties."""
    order = Window.partitionBy("source_student_id").orderBy("registered_at_utc", "source_database_id")
    return (
        databases.where(F.col("source_student_id").isNotNull() & F.col("source_database_id").isNotNull())
        .select("source_student_id", "source_database_id", "registered_at_utc")
        .distinct()
        .select(F.lag("source_database_id").over(order).alias("before"), F.col("source_database_id").alias("after"))
        .where(F.col("before").isNotNull())
    )


def _compare(steps: DataFrame, profile: DataFrame, entity: str) -> DataFrame:
    """Changes of one entity from the profiles (delivery, field, types, feeds); both deliveries must have rows."""
    fields = profile.groupBy("source_database_id").agg(F.collect_list(F.struct("field", "types", "feeds")).alias("f"))
    both = steps.join(fields.select(F.col("source_database_id").alias("before"), F.col("f").alias("f0")), "before").join(fields.select(F.col("source_database_id").alias("after"), F.col("f").alias("f1")), "after")
    names = lambda f: F.transform(f, lambda x: x["field"])
    both = both.select(
        "after", "f0", "f1",
        F.array_sort(F.filter("f0", lambda x: ~F.array_contains(names("f1"), x["field"]))).alias("gone"),
        F.array_sort(F.filter("f1", lambda x: ~F.array_contains(names("f0"), x["field"]))).alias("new"),
    )
    # In order of their names the gone and the new fields of one staged column pair off, each once.
    feeding = lambda side, t: F.filter(side, lambda x: x["feeds"] == t)
    zipped = lambda t: F.zip_with(feeding("gone", t), feeding("new", t), lambda g, n: F.struct(g["field"].alias("b"), n["field"].alias("a")))
    pairs = F.flatten(F.transform(F.array_distinct(F.array_compact(F.transform("gone", lambda g: g["feeds"]))), zipped))
    both = both.withColumn("pairs", F.filter(pairs, lambda p: p["b"].isNotNull() & p["a"].isNotNull()))
    change = lambda kind, b, a: F.struct(F.lit(kind).alias("change_kind"), b.alias("field_before"), a.alias("field_after"))
    none = F.lit("")
    retyped = F.filter("f0", lambda x: (F.size(x["types"]) > 0) & F.exists("f1", lambda y: (y["field"] == x["field"]) & (F.size(y["types"]) > 0) & (y["types"] != x["types"])))
    changes = F.concat(
        F.transform("pairs", lambda p: change("renamed", p["b"], p["a"])),
        F.transform(F.filter("gone", lambda g: ~F.exists("pairs", lambda p: p["b"] == g["field"])), lambda g: change("removed", g["field"], none)),
        F.transform(F.filter("new", lambda n: ~F.exists("pairs", lambda p: p["a"] == n["field"])), lambda n: change("added", none, n["field"])),
        F.transform(retyped, lambda x: change("type_changed", x["field"], x["field"])),
    )
    return both.select(F.col("after").alias("source_database_id"), F.lit(entity).alias("entity"), F.inline(changes))


def table_profile(databases: DataFrame, projects: DataFrame, files: DataFrame) -> DataFrame:
    """Tables of each delivery as a profile; the tables that projects and files come from feed those entities."""
    name = lambda c: F.lower(F.trim(c))
    signed = databases.select("source_database_id", F.explode(F.split("source_schema_signature", r"\|")).alias("t")).select("source_database_id", name(F.col("t")).alias("field"), F.lit(None).cast("string").alias("feeds"))
    used = [df.groupBy("source_database_id", name(F.col("source_table_name")).alias("field")).agg(F.count(F.lit(1)).alias("n")).select("source_database_id", "field", F.lit(feeds).alias("feeds")) for df, feeds in ((projects, "project"), (files, "file"))]
    return (
        signed.unionByName(used[0]).unionByName(used[1])
        .where((F.col("field") != "") & F.col("source_database_id").isNotNull())
        .groupBy("source_database_id", "field")
        .agg(F.max("feeds").alias("feeds"))
        .select("source_database_id", "field", F.array().cast("array<string>").alias("types"), "feeds")
    )


def drift_report(databases: DataFrame, projects: DataFrame, files: DataFrame) -> DataFrame:
    """(source_database_id, entity, change_kind, field_before, field_after) of every change a delivery brought.

    A field is renamed if it goes while another comes that feeds the same staged
    column; such a pair is neither removed nor added. Types are compared only
    where both deliveries have a value that isn't null; whole and decimal numbers
    in one delivery count as decimal. Where a delivery has no rows of an entity,
    its fields aren't known and give no change.
    """
    steps = _deliveries(databases)
    return (
        _compare(steps, table_profile(databases, projects, files), "table")
        .unionByName(_compare(steps, field_profile(projects, "raw_project_json", PROJECT_FIELDS), "project"))
        .unionByName(_compare(steps, field_profile(files, "raw_file_json", FILE_FIELDS), "file"))
    )

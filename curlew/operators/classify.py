"""Project types from file evidence, and classes from terms in context.

A project's evidence is one aggregate over its files (counts, small sets of
extensions from fixed lists, the first five ambiguous names), combined before the
shuffle; rule cascades are single expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from curlew import vocab as V
from curlew.functions import text as X


def evidence(files: DataFrame, names: int = 5) -> DataFrame:
    """(project_uid, file_record_count, high, ambiguous, primary, ambiguous_names): a re-delivered file counts once.

    The sets hold extensions of the fixed lists only, so they are bounded. The names
    are the first ``names`` ambiguous ones by file_uid, kept as a bounded top list
    by ranking within each project's few ambiguous files.
    """
    each = files.where(F.col("project_uid").isNotNull()).select("project_uid", "file_uid", "file_name").distinct().withColumn("ext", X.file_extension("file_name"))
    sets = each.groupBy("project_uid").agg(
        F.count("file_uid").alias("file_record_count"),
        *[F.array_sort(F.collect_set(F.when(F.col("ext").isin(*known), F.col("ext")))).alias(name) for name, known in (("high", V.QDA_EXTENSIONS), ("ambiguous", V.AMBIGUOUS_EXTENSIONS), ("primary", V.PRIMARY_EXTENSIONS))],
    )
    rank = F.row_number().over(Window.partitionBy("project_uid").orderBy("file_uid"))
    first = each.where(F.col("ext").isin(*V.AMBIGUOUS_EXTENSIONS)).withColumn("r", rank).where(F.col("r") <= names).groupBy("project_uid").agg(F.concat_ws(" ", F.transform(F.array_sort(F.collect_list(F.struct("file_uid", "file_name"))), lambda x: x["file_name"])).alias("ambiguous_names"))
    return sets.join(first, "project_uid", "left")


def some(c: str) -> Column:
    return F.coalesce(F.size(c) > 0, F.lit(False))


def named(text: str, terms: tuple[str, ...]) -> Column:
    """Whether a text contains one of the terms."""
    hit = F.lit(False)
    for t in terms:
        hit = hit | F.contains(F.col(text), F.lit(t))
    return hit


def project_types(projects: DataFrame, files: DataFrame) -> DataFrame:
    """(project_uid, project_type, classification_rule, file_record_count): the first rule that holds."""
    facts = projects.where(F.col("project_uid").isNotNull()).select("project_uid", X.context("title", "description").alias("about"))
    df = facts.join(evidence(files), "project_uid", "left")
    df = df.withColumn("text", F.concat_ws(" ", "about", F.lower("ambiguous_names")))
    term = named("text", V.QDA_TERMS)
    only_metadata = some("primary") & F.coalesce(F.size(F.array_except("primary", F.array(*[F.lit(x) for x in V.METADATA_EXTENSIONS]))) == 0, F.lit(False)) & named("text", V.METADATA_TERMS)
    count = F.coalesce("file_record_count", F.lit(0))
    rules = (
        (some("high"), "QDA_PROJECT", "HIGH_CONFIDENCE_QDA_EXTENSION"),
        (some("ambiguous") & term, "QDA_PROJECT", "CONTEXT_VALIDATED_AMBIGUOUS_QDA_EXTENSION"),
        (only_metadata, "OTHER_PROJECT", "METADATA_ONLY_FILE_WITHOUT_PRIMARY_DATA"),
        (some("primary"), "QD_PROJECT", "PRIMARY_DATA_EXTENSION"),
        (count > 0, "OTHER_PROJECT", "FILE_RECORD_WITHOUT_QDA_OR_PRIMARY_EVIDENCE"),
    )
    kind, rule = F, F
    for hit, k, r in rules:
        kind, rule = kind.when(hit, k), rule.when(hit, r)
    return df.select("project_uid", kind.otherwise("NOT_A_PROJECT").alias("project_type"), rule.otherwise("NO_FILE_RECORD").alias("classification_rule"), count.alias("file_record_count"))


def judged(a: Column, b: Column, single: bool = False) -> Column:
    """Struct (division, rule, confidence, terms) from the terms of two lists that a text contains; null if inconclusive.

    Two terms of one list decide if it has the more (the first list wins a tie); with
    ``single``, one term does if the other list has none.
    """
    na, nb = F.size(a), F.size(b)
    sure = lambda n: F.least(F.lit(0.99), F.lit(0.80) + n * F.lit(0.04))
    made = lambda d, r, c, t: F.struct(F.lit(d).alias("division"), F.lit(r).alias("rule"), c.alias("confidence"), F.array_join(t, "|").alias("terms"))
    out = F.when((na >= 2) & (na >= nb), made("69", "MULTI_TERM", sure(na), a)).when((nb >= 2) & (nb > na), made("72", "MULTI_TERM", sure(nb), b))
    if single:
        out = out.when((na > 0) & (nb == 0), made("69", "SINGLE_TERM", F.lit(0.80), a)).when((nb > 0) & (na == 0), made("72", "SINGLE_TERM", F.lit(0.80), b))
    return out


def term_class(text: Column, legal: tuple[str, ...] = V.LEGAL_TERMS, research: tuple[str, ...] = V.RESEARCH_TERMS, single: bool = False) -> Column:
    """``judged`` of the different terms contained in a text."""
    return judged(X.hits(text, legal), X.hits(text, research), single)


def classify_terms(rows: DataFrame, key: str, columns: tuple[str, ...], **options) -> DataFrame:
    """(key, division, rule, confidence, terms) of the rows whose context is conclusive."""
    legal, research, single = options.get("legal", V.LEGAL_TERMS), options.get("research", V.RESEARCH_TERMS), options.get("single", False)
    # Each term is sought once; the flags travel on in place of the text, and only rows with a hit are judged.
    text = F.col("_t")
    flags = lambda terms: F.array_compact(F.array(*[F.when(F.contains(text, F.lit(t)), F.lit(t)) for t in terms]))
    folded = rows.select(key, X.fold(F.concat_ws("\n", *columns)).alias("_t"))
    hits = folded.select(key, F.explode(F.array(F.struct(flags(legal).alias("a"), flags(research).alias("b")))).alias("h")).select(key, "h.a", "h.b")
    return hits.where((F.size("a") > 0) | (F.size("b") > 0)).select(key, judged(F.col("a"), F.col("b"), single).alias("c")).where(F.col("c").isNotNull()).select(key, "c.*")


def file_classes(files: DataFrame, texts: DataFrame, project_classes: DataFrame, ceiling: float = 0.78, **options) -> DataFrame:
    """Each file's own class if its text is conclusive, else its project's at a confidence of ``ceiling`` at most.

    ``files`` has (file_key, project_uid), ``texts`` (file_key, text).
    """
    own = classify_terms(texts, "file_key", ("text",), single=True, **options)
    p = project_classes.select("project_uid", *[F.col(c).alias(f"p_{c}") for c in ("division", "confidence")])
    df = files.join(own, "file_key", "left").join(p, "project_uid", "left")
    return df.select(
        "file_key", "project_uid", F.coalesce("division", "p_division").alias("division"),
        F.when(F.col("division").isNotNull(), F.col("rule")).when(F.col("p_division").isNotNull(), "PROJECT_CONTEXT_FALLBACK").alias("rule"),
        F.when(F.col("division").isNotNull(), F.col("confidence")).otherwise(F.least(F.col("p_confidence"), F.lit(ceiling))).alias("confidence"),
    ).where(F.col("division").isNotNull())


def evidence_audit(projects: DataFrame, files: DataFrame) -> DataFrame:
    """(bucket, projects): counts of projects by kind of evidence.

    Unconfirmed ambiguous projects also count by their other files; the buckets
    overlap there on purpose.
    """
    facts = projects.where(F.col("project_uid").isNotNull()).select("project_uid", X.context("title", "description").alias("about"))
    df = facts.join(evidence(files), "project_uid", "left").withColumn("text", F.concat_ws(" ", "about", F.lower("ambiguous_names")))
    strong, filed = some("high"), F.coalesce("file_record_count", F.lit(0)) > 0
    contextual = ~strong & some("ambiguous") & named("text", V.QDA_TERMS)
    rest = ~strong & ~contextual
    buckets = {
        "strong": strong,
        "contextual": contextual,
        "ambiguous_unconfirmed": rest & some("ambiguous"),
        "primary_data": rest & some("primary"),
        "other_files": rest & ~some("primary") & filed,
        "no_files": ~filed,
        "all": F.lit(True),
    }
    counted = df.agg(*[F.count_if(hit).alias(b) for b, hit in buckets.items()])
    return counted.select(F.explode(F.array(*[F.struct(F.lit(b).alias("bucket"), F.col(b).alias("projects")) for b in buckets])).alias("x")).select("x.*")


def unconfirmed(projects: DataFrame, files: DataFrame) -> DataFrame:
    """(project_uid, title, ambiguous, ambiguous_names): projects whose ambiguous files no context confirms."""
    facts = projects.where(F.col("project_uid").isNotNull()).select("project_uid", "title", X.context("title", "description").alias("about"))
    df = facts.join(evidence(files), "project_uid").withColumn("text", F.concat_ws(" ", "about", F.lower("ambiguous_names")))
    return df.where(~some("high") & some("ambiguous") & ~named("text", V.QDA_TERMS)).select("project_uid", "title", "ambiguous", "ambiguous_names")


def unconfirmed_extensions(found: DataFrame) -> DataFrame:
    """(extension, projects) of the unconfirmed projects; one with several extensions counts for each."""
    return found.select(F.explode("ambiguous").alias("extension")).groupBy("extension").agg(F.count(F.lit(1)).alias("projects"))


def unconfirmed_sample(found: DataFrame, size: int = 100) -> DataFrame:
    """The first ``size`` unconfirmed projects by uid: a sample for the eye."""
    return found.orderBy("project_uid").limit(size).select("project_uid", "title", F.array_join("ambiguous", "|").alias("extensions"), "ambiguous_names")


def division_counts(classes: DataFrame) -> DataFrame:
    """(division, projects)."""
    return classes.groupBy("division").agg(F.count(F.lit(1)).alias("projects"))


def file_rule_counts(file_classes_: DataFrame, projects: DataFrame, sources: DataFrame) -> DataFrame:
    """(source_scope, division, direct, fallback): files classified by their own text, and by their project's."""
    df = file_classes_.join(projects.select("project_uid", "source_database_id"), "project_uid").join(sources.select("source_database_id", "source_scope"), "source_database_id")
    direct = F.col("rule") != "PROJECT_CONTEXT_FALLBACK"
    return df.groupBy("source_scope", "division").agg(F.count_if(direct).alias("direct"), F.count_if(~direct).alias("fallback"))


def file_class_id(project: Column, origin: Column, reference: Column) -> Column:
    """The id of a file's classification."""
    part = lambda c: F.coalesce(c, F.lit(""))
    return F.concat(F.lit("isic-file:"), F.sha2(F.concat_ws("|", part(project), part(origin), part(reference)), 256))


def extension_histogram(files: DataFrame) -> DataFrame:
    """(extension, files), ``[no extension]`` for none."""
    ext = F.coalesce(F.nullif(X.file_extension("file_name"), F.lit("")), F.lit("[no extension]"))
    return files.select("file_uid", ext.alias("extension")).distinct().groupBy("extension").agg(F.count(F.lit(1)).alias("files"))

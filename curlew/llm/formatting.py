"""Duplicates hidden by formatting, through dictionary-encoded columns (problem 5).

Each distinct raw value of the compared columns is canonicalised once and each
distinct canonical value gets an integer. Records become sorted tuples of those
integers, so field order doesn't matter, and only these compact tuples are grouped.

Scale: values are made distinct with map-side combining before anything else; the
dictionary is written once, so its integers can't change when an executor is lost;
the joins have written tables on both sides, which lets AQE split a hot value or a
hot group over many tasks. A group is never gathered in one place: its smallest
member and its size are plain aggregates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curlew.session import materialize

#: What a DOI looks like once everything before ``10.`` is cut.
DOI = r"10\.\d{4,9}/"


def squeeze(value: Column) -> Column:
    """Only letters, marks and digits, in lower case (sharp s as ss); null where none is left."""
    return F.nullif(F.regexp_replace(F.regexp_replace(F.lower(value), "ß", "ss"), r"[^\p{L}\p{M}\p{N}]+", ""), F.lit(""))


def canonical(value: Column, is_doi: Column) -> Column:
    """The comparable form of a value; what stands before a DOI's ``10.`` doesn't count."""
    return squeeze(F.when(is_doi, F.regexp_replace(value, rf"(?s)^.*?(?={DOI})", "")).otherwise(value))


def encode_records(rows: DataFrame, key: str = "project_uid", doi: str = "doi", title: str = "title") -> DataFrame:
    """(key, lo, hi): each record with both fields present as a sorted pair of dictionary integers.

    The DOI is sought in the ``doi`` field, and in the title only where that field
    has none (the fields may be swapped), so a title that cites a DOI stays whole.
    Records with a null key, or where either field is null or has no letter or
    digit, have no tuple.
    """
    raw = (
        rows.select(F.col(key).alias("_key"), F.col(doi).cast("string").alias("_d"), F.col(title).cast("string").alias("_t"))
        .where(F.col("_key").isNotNull() & F.col("_d").isNotNull() & F.col("_t").isNotNull())
        .withColumn("_first", F.col("_d").rlike(DOI))
        .select("_key", F.struct(F.col("_d").alias("v"), F.col("_first").alias("doi")).alias("_d"), F.struct(F.col("_t").alias("v"), (~F.col("_first") & F.col("_t").rlike(DOI)).alias("doi")).alias("_t"))
    )
    distinct = raw.select(F.explode(F.array("_d", "_t")).alias("x")).select("x.v", "x.doi").distinct()
    values = materialize(distinct.select("v", "doi", canonical(F.col("v"), F.col("doi")).alias("c")).where(F.col("c").isNotNull()), "values")
    dictionary = materialize(values.select("c").distinct().select("c", F.monotonically_increasing_id().alias("id")), "dictionary")
    ids = materialize(values.join(dictionary, "c").select("v", "doi", "id"), "value-ids")
    side = lambda n: ids.select(F.struct("v", "doi").alias(f"_{n}"), F.col("id").alias(f"{n}_id"))
    coded = raw.join(side("d"), "_d").select("_key", "_t", "d_id").join(side("t"), "_t")
    return coded.select(F.col("_key").alias(key), F.least("d_id", "t_id").alias("lo"), F.greatest("d_id", "t_id").alias("hi"))


def collapse(rows: DataFrame, key: str = "project_uid", doi: str = "doi", title: str = "title") -> DataFrame:
    """(key, group_key, copies): each record with the smallest key of its group and the group's number of distinct keys.

    A record without a tuple is no copy of any and has no row. Rows that repeat a
    key count once.
    """
    coded = materialize(encode_records(rows, key, doi, title).distinct(), "records")
    groups = materialize(coded.groupBy("lo", "hi").agg(F.min(key).alias("group_key"), F.count(F.lit(1)).alias("copies")), "groups")
    return coded.join(groups, ["lo", "hi"]).select(key, "group_key", "copies")


def copies(rows: DataFrame, key: str = "project_uid", doi: str = "doi", title: str = "title") -> DataFrame:
    """(key_a, key_b): the smallest key of each group with every other member."""
    coded = materialize(encode_records(rows, key, doi, title).distinct(), "records")
    groups = materialize(coded.groupBy("lo", "hi").agg(F.min(key).alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "groups")
    return coded.join(groups, ["lo", "hi"]).where(F.col(key) != F.col("a")).select(F.col("a").alias(f"{key}_a"), F.col(key).alias(f"{key}_b")).distinct()

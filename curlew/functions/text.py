"""Scalar text functions as column expressions, all JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from curlew import vocab as V


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fold(c: str | Column) -> Column:
    """Lower case with sharp s as ss, the part of case folding that matters here."""
    return F.regexp_replace(F.lower(col(c)), "ß", "ss")


def strip(c: str | Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(col(c), f"^{V.SPACE}+|{V.SPACE}+$", "")


def as_text(c: str | Column) -> Column:
    """Stripped text; blank becomes null."""
    return F.nullif(strip(c), F.lit(""))


def clean_text(c: str | Column) -> Column:
    """Stripped text; null becomes empty."""
    return F.coalesce(strip(c), F.lit(""))


def first_present(*columns: str | Column) -> Column:
    """The first value that is neither null nor blank."""
    return F.coalesce(*[F.when(strip(c) != "", col(c)) for c in columns])


def canonical_id(c: str | Column) -> Column:
    """``12.0`` as ``12``."""
    text = as_text(c)
    return F.when(text.rlike(r"^\d+\.0$"), F.regexp_replace(text, r"\.0$", "")).otherwise(text)


def optional_int(c: str | Column) -> Column:
    """A whole number of any spelling of a number; null for anything else, infinities included."""
    return strip(c).try_cast("double").try_cast("bigint")


def canonical_doi(c: str | Column) -> Column:
    """The first DOI in a text, lower case, without punctuation at its end; empty if there is none."""
    return F.coalesce(F.rtrim(F.regexp_extract(fold(c), V.DOI_PATTERN, 0), F.lit(".,;:)")), F.lit(""))


def is_file_like_title(c: str | Column) -> Column:
    return F.coalesce(strip(c).rlike(V.FILE_TITLE_PATTERN), F.lit(False))


def title_key(c: str | Column) -> Column:
    """The comparable title; empty for null, file-like, short and generic titles. Spaces collapse before punctuation goes."""
    plain = strip(F.regexp_replace(F.regexp_replace(strip(fold(c)), f"{V.SPACE}+", " "), "[^a-z0-9 ]+", ""))
    return F.when(col(c).isNull() | is_file_like_title(c) | (F.length(plain) < V.TITLE_LENGTH) | plain.isin(*V.GENERIC_TITLES), F.lit("")).otherwise(plain)


def cluster_id(doi: Column, title: Column) -> Column:
    return F.concat(F.lit("dedup:"), F.substring(F.sha2(F.concat_ws("|", doi, title), 256), 1, 24))


def file_extension(c: str | Column) -> Column:
    """The suffix of a file name or path, without query and fragment; empty if there is none."""
    name = F.regexp_replace(F.regexp_replace(F.lower(strip(c)), r"(?s)[?#].*$", ""), r"(?s)^.*[/\\]", "")
    return F.coalesce(F.regexp_extract(name, r"\.([a-z0-9]{1,15})$", 1), F.lit(""))


def context(*columns: str | Column) -> Column:
    """The columns that aren't null, joined by spaces, in lower case."""
    return F.lower(F.concat_ws(" ", *[col(c) for c in columns]))


def hits(text: Column, terms: tuple[str, ...]) -> Column:
    """The terms contained in a text, in their given order."""
    return F.filter(F.array(*[F.lit(t) for t in terms]), lambda t: F.contains(text, t))


def entity_uid(*parts: str | Column) -> Column:
    return F.concat_ws(":", *[col(p) for p in parts])


def stable_hash(*columns: str) -> Column:
    """SHA-256 of the columns as compact JSON with sorted keys, nulls included."""
    return F.sha2(F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"}), 256)


def normal_text(c: str | Column, limit: int = 20_000) -> Column:
    """White space collapsed, NUL as space, the first ``limit`` characters: the feature of bounded extraction."""
    return F.substring(strip(F.regexp_replace(F.regexp_replace(col(c), "\x00", " "), f"{V.SPACE}+", " ")), 1, limit)


def slug(c: str | Column) -> Column:
    """A safe name: other characters become single hyphens, 80 characters, ``dataset`` if nothing is left."""
    plain = F.regexp_replace(F.regexp_replace(strip(c), r"[^\p{L}\p{N}\-_.]", "-"), "-+", "-")
    return F.coalesce(F.nullif(F.substring(F.regexp_replace(plain, "^-+|-+$", ""), 1, 80), F.lit("")), F.lit("dataset"))


def year(c: str | Column) -> Column:
    """The four digits that a date begins with."""
    return F.nullif(F.regexp_extract(col(c), r"^\d{4}", 0), F.lit("")).try_cast("int")


def leading_id(c: str | Column) -> Column:
    """The digits a file name begins with, before ``_`` or ``-``; null if it doesn't."""
    return F.nullif(F.regexp_extract(col(c), r"^(\d+)(?:[_\-.]|$)", 1), F.lit(""))


def html_escape(c: str | Column) -> Column:
    text = clean_text(c)
    for sign, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        text = F.replace(text, F.lit(sign), F.lit(name))
    return text

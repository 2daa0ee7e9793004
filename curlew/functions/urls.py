"""URL functions and predicates as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from curlew.functions.text import col

# Endings of links that lead to a file.
DOWNLOAD_ENDINGS = (".zip", ".pdf", ".txt", ".rtf", ".doc", ".docx", ".csv", ".xlsx", ".sav", ".dta", ".rdata", ".rds", ".qdpx", ".qdp", ".nvpx", ".nvp", ".atlproj", ".mx", ".mx20", ".mx22")
# Hosts of shared base data, first match wins.
PROVIDERS = (("FAUBOX", ("faubox.rrze.uni-erlangen.de",)), ("GOOGLE_DRIVE", ("drive.google.com",)), ("GITHUB", ("github.com", "raw.githubusercontent.com")))


def ledger_url(c: str | Column) -> Column:
    """Trimmed, lower case, without slashes at the end."""
    return F.lower(F.regexp_replace(F.trim(col(c)), "/+$", ""))


def without_session(c: str | Column) -> Column:
    return F.regexp_replace(col(c), ";jsessionid=[^?]+", "")


def raw_file_url(c: str | Column) -> Column:
    """A repository page of a file as the link to its raw content; other links as they are."""
    return F.regexp_replace(col(c), r"(?i)^https://(?:raw\.githubusercontent|github)\.com/([^/]+)/([^/]+)/blob/([^/]+)/(.+)$", "https://raw.githubusercontent.com/$1/$2/$3/$4")


def file_name_of(c: str | Column, default: str = "main.qda") -> Column:
    """The last part of a link before its query."""
    return F.coalesce(F.nullif(F.regexp_extract(F.regexp_replace(col(c), r"(?s)\?.*$", ""), r"([^/]*)$", 1), F.lit("")), F.lit(default))


def safe_file_name(c: str | Column) -> Column:
    """The last part of a link's path with unsafe characters replaced."""
    path = F.regexp_replace(F.regexp_replace(col(c), r"(?s)[?#].*$", ""), r"(?i)^[a-z][a-z0-9+.\-]*://[^/]*", "")
    return F.regexp_replace(F.regexp_extract(path, r"([^/]*)$", 1), r"[^A-Za-z0-9._\-]", "_")


def locations(c: str | Column) -> Column:
    """The parts of a list separated by semicolons, blanks dropped."""
    return F.filter(F.transform(F.split(col(c), ";"), lambda x: F.trim(x)), lambda x: x != "")


def provider(c: str | Column) -> Column:
    """The kind of place that a location points to."""
    text = F.lower(col(c))
    out = None
    for name, hosts in PROVIDERS:
        hit = F.lit(False)
        for h in hosts:
            hit = hit | F.contains(text, F.lit(h))
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.when(text.startswith("https://") | text.startswith("http://"), "WEB").when(col(c).rlike(r"[/\\]"), "LOCAL_OR_RELATIVE_PATH").otherwise("UNKNOWN")


def is_download(c: str | Column, endings: tuple[str, ...] = DOWNLOAD_ENDINGS) -> Column:
    text = F.lower(F.coalesce(col(c), F.lit("")))
    hit = F.contains(text, F.lit("download")) | F.contains(text, F.lit("type=file")) | F.contains(text, F.lit("format=original"))
    for e in endings:
        hit = hit | text.endswith(e)
    return hit


def is_metadata_export(text: str | Column, href: str | Column) -> Column:
    t, h = F.lower(F.coalesce(col(text), F.lit(""))), F.lower(F.coalesce(col(href), F.lit("")))
    return t.rlike("dublin core|ddi|oai-pmh|metadata") | h.rlike("dublincore|ddi|oai|xml")


def probe_status(url: Column, http_status: Column, head: Column, error: Column) -> Column:
    """What a probe of a database link found, from its HTTP status, first bytes and error."""
    return (
        F.when(F.coalesce(F.trim(url), F.lit("")) == "", "MISSING_URL")
        .when(error.isNotNull(), "REQUEST_ERROR")
        .when(~F.coalesce(http_status.isin(200, 206), F.lit(False)), "HTTP_ERROR")
        .when(F.coalesce(F.substring(head, 1, 16) == F.lit(bytearray(b"SQLite format 3\x00")), F.lit(False)), "ACCESSIBLE_SQLITE")
        .otherwise("ACCESSIBLE_NON_SQLITE")
    )

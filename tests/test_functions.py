"""Facts of the scalar functions."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from curlew.functions import text as X
from curlew.functions import urls as U


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values)) if values else spark.range(1)
    return row.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("f,value,expected", [
    (X.canonical_doi, "doi:10.17026/DANS-ZCC-ZDHP.", "10.17026/dans-zcc-zdhp"), (X.canonical_doi, None, ""), (X.canonical_doi, "none", ""), (X.canonical_doi, "(10.1234/a:b);", "10.1234/a:b"),
    (X.title_key, "International Criminal Law  Charging Document", "international criminal law charging document"), (X.title_key, "Interview_Transcript_001.pdf", ""), (X.title_key, "UNKNOWN", ""), (X.title_key, None, ""),
    (X.title_key, "replication data for", ""), (X.title_key, "A title - with a dash and ß", "a title  with a dash and ss"), (X.title_key, "short", ""), (X.title_key, " The wide   spaces of a title\n", "the wide spaces of a title"),
    (X.is_file_like_title, " a.PDF ", True), (X.is_file_like_title, "a.pdfx", False), (X.is_file_like_title, None, False),
    (X.canonical_id, "12345678.0", "12345678"), (X.canonical_id, " 12 ", "12"), (X.canonical_id, "1.5", "1.5"), (X.canonical_id, " ", None),
    (X.optional_int, "1e3", 1000), (X.optional_int, "2.9", 2), (X.optional_int, "nan", None), (X.optional_int, "inf", None), (X.optional_int, "x", None), (X.optional_int, None, None),
    (X.file_extension, "a/b.C/Data.TXT?x=1.zip", "txt"), (X.file_extension, "no_extension", ""), (X.file_extension, None, ""), (X.file_extension, "a\\b.qdpx#part", "qdpx"), (X.file_extension, "x." + "a" * 20, ""),
    (X.as_text, "  x\t", "x"), (X.as_text, "  ", None), (X.clean_text, None, ""), (X.year, "2020-01-02", 2020), (X.year, "20 Jan", None),
    (X.normal_text, " a\x00b \n c ", "a b c"), (X.slug, "A b/c__d", "A-b-c__d"), (X.slug, "///", "dataset"), (X.leading_id, "12345_x.db", "12345"), (X.leading_id, "12345-x.db", "12345"), (X.leading_id, "x12.db", None),
    (X.html_escape, "<a & 'b'>", "&lt;a &amp; &#x27;b&#x27;&gt;"),
    (U.ledger_url, " HTTP://X/Y// ", "http://x/y"), (U.without_session, "http://x/y;jsessionid=12?z=1", "http://x/y?z=1"),
    (U.raw_file_url, "https://raw.githubusercontent.com/u/r/blob/main/x.db", "https://raw.githubusercontent.com/u/r/main/x.db"), (U.raw_file_url, "https://github.com/u/r/blob/main/a/x.db", "https://raw.githubusercontent.com/u/r/main/a/x.db"), (U.raw_file_url, "https://x/y", "https://x/y"),
    (U.file_name_of, "https://x/y/metadata.sqlite?download=1", "metadata.sqlite"), (U.file_name_of, "https://x/", "main.qda"), (U.safe_file_name, "https://x/y/my file.sqlite?download=1", "my_file.sqlite"),
    (U.locations, " a; ;b ", ["a", "b"]), (U.provider, "https://faubox.rrze.uni-erlangen.de/x", "FAUBOX"), (U.provider, "https://drive.google.com/x", "GOOGLE_DRIVE"), (U.provider, "https://github.com/x", "GITHUB"), (U.provider, "http://x", "WEB"), (U.provider, "a\\b", "LOCAL_OR_RELATIVE_PATH"), (U.provider, "x", "UNKNOWN"),
    (U.is_download, "https://x/a.ZIP", True), (U.is_download, "https://x/?type=file", True), (U.is_download, None, False), (U.is_download, "https://x/page", False),
])
def test_facts(spark, f, value, expected):
    assert one(spark, f("v"), v=value) == expected


def test_terms_hash_and_probe(spark):
    assert one(spark, X.hits(F.lower("v"), ("icc", "maxqda", "zz")), v="The pICColo and MAXQDA") == ["icc", "maxqda"]
    text = json.dumps({"a": "é\"", "b": None}, sort_keys=True, ensure_ascii=False, separators=(",", ":"))
    assert one(spark, X.stable_hash("b", "a"), a='é"', b=None) == hashlib.sha256(text.encode()).hexdigest()
    head = F.lit(bytearray(b"SQLite format 3\x00rest"))
    probe = lambda url, status, data=head, error=F.lit(None): one(spark, U.probe_status(F.lit(url), F.lit(status), data, error))
    assert [probe("u", 206), probe("u", 200, F.lit(bytearray(b"version https"))), probe("u", 404), probe(" ", 200), probe("u", None, head, F.lit("timeout")), probe("u", 200, F.lit(None).cast("binary"))] == ["ACCESSIBLE_SQLITE", "ACCESSIBLE_NON_SQLITE", "HTTP_ERROR", "MISSING_URL", "REQUEST_ERROR", "ACCESSIBLE_NON_SQLITE"]

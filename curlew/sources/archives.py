"""ZIP archives: entries, bounded text of primary files, and manifests.

Archives come from Spark's ``binaryFile`` source; decoding is the one step that
needs Python. Everything after it (counts, manifests, fingerprints) is aggregation
over an entry table.
"""

from __future__ import annotations

import hashlib
import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curlew import vocab as V
from curlew.functions import text as X
from curlew.session import importable

ENTRIES = "archive string, status string, entry string, crc long, size long, compressed long, is_dir boolean, sha256 string, text string, text_status string"
TEXT_LIMIT = 20_000


def _pdf_text(data: bytes, pages: int) -> str:
    from pypdf import PdfReader

    return "\n".join(p.extract_text() or "" for p in PdfReader(io.BytesIO(data)).pages[:pages])


def _decoded(name: str, data: bytes, pages: int) -> tuple[str | None, str | None]:
    """(text, status) of a project file or a primary text file; other entries have neither."""
    lower = name.lower()
    if lower.endswith(".qde"):
        return data.decode("utf-8", "replace"), None
    if not lower.startswith("sources/") or not lower.endswith((".txt", ".pdf")):
        return None, None
    try:
        text = data.decode("utf-8", "replace") if lower.endswith(".txt") else _pdf_text(data, pages)
    except Exception:  # a broken file, or no PDF library here
        return None, "EXTRACTION_FAILED"
    text = " ".join(text.replace("\x00", " ").split())[:TEXT_LIMIT]
    return text, "EXTRACTED" if text else "EMPTY_TEXT"


def read_entries(files: DataFrame, pages: int = 3) -> DataFrame:
    """One row for each entry of (path, content) rows; a file that isn't a ZIP is one row with its status."""

    importable(files.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path, content in zip(batch["path"], batch["content"]):
                try:
                    with zipfile.ZipFile(io.BytesIO(content)) as z:
                        for i in z.infolist():
                            data = b"" if i.is_dir() else z.read(i)
                            rows.append((path, "OK", i.filename, i.CRC, i.file_size, i.compress_size, i.is_dir(), hashlib.sha256(data).hexdigest(), *_decoded(i.filename, data, pages)))
                        if not z.infolist():
                            rows.append((path, "OK", None, None, None, None, None, None, None, None))
                except zipfile.BadZipFile:
                    rows.append((path, "NOT_A_ZIP_CONTAINER", None, None, None, None, None, None, None, None))
            yield pd.DataFrame(rows, columns=[c.split(" ")[0] for c in ENTRIES.split(", ")]).astype({"crc": "Int64", "size": "Int64", "compressed": "Int64", "is_dir": "boolean"})

    return files.select("path", "content").mapInPandas(run, ENTRIES)


def read_archives(spark: SparkSession, folder: str, pattern: str = "*.qdpx") -> DataFrame:
    """The entries of all archives under a folder."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder)
    return read_entries(files)


def is_counted(entry: str = "entry") -> Column:
    """Entries of the total manifest: no folders, no resource forks, no hidden files."""
    return F.col(entry).isNotNull() & ~F.col("is_dir") & ~F.col(entry).startswith("__MACOSX/") & ~F.col(entry).rlike(r"(^|/)\.[^/]*$")


def is_primary(entry: str = "entry") -> Column:
    return F.col(entry).isNotNull() & ~F.col("is_dir") & F.lower(entry).startswith("sources/") & X.file_extension(entry).isin(*V.ARCHIVE_PRIMARY_EXTENSIONS)


def file_totals(entries: DataFrame) -> DataFrame:
    """(archive, total_internal_files, project_files, primary_files)."""
    return entries.groupBy("archive").agg(F.count_if(is_counted()).alias("total_internal_files"), F.count_if(is_counted() & F.lower("entry").endswith(".qde")).alias("project_files"), F.count_if(is_primary()).alias("primary_files"))


def project_contents(entries: DataFrame) -> DataFrame:
    """(archive, project_text, primary_files): the texts of an archive's project files by path, and the paths of its primary files.

    Both lists are as long as one archive's entries.
    """
    text = F.array_sort(F.collect_list(F.when(F.lower("entry").endswith(".qde"), F.struct("entry", "text"))))
    grouped = entries.groupBy("archive").agg(text.alias("t"), F.array_sort(F.collect_list(F.when(is_primary(), F.col("entry")))).alias("primary_files"))
    return grouped.select("archive", F.array_join(F.transform("t", lambda x: x["text"]), "\n").alias("project_text"), "primary_files")


def extension_totals(entries: DataFrame) -> DataFrame:
    ext = F.coalesce(F.nullif(X.file_extension("entry"), F.lit("")), F.lit("[no extension]"))
    return entries.where(is_counted()).groupBy("archive", ext.alias("extension")).agg(F.count(F.lit(1)).alias("files"))


def manifests(entries: DataFrame) -> DataFrame:
    """(archive, zip_status, internal_files, manifest_sha256): the hash doesn't depend on the order of entries; null where the file isn't a ZIP."""
    listed = F.when(F.col("entry").isNotNull() & ~F.col("is_dir"), F.to_json(F.struct("crc", "entry", "size")))
    grouped = entries.groupBy("archive").agg(F.min("status").alias("zip_status"), F.count(listed).alias("internal_files"), F.array_sort(F.collect_list(listed)).alias("m"))
    return grouped.select("archive", "zip_status", "internal_files", F.when(F.col("zip_status") == "OK", F.sha2(F.array_join("m", "\n"), 256)).alias("manifest_sha256"))


def extraction_summary(entries: DataFrame) -> DataFrame:
    done = entries.where(F.col("text_status").isNotNull())
    return done.groupBy("text_status", X.file_extension("entry").alias("extension")).agg(F.count(F.lit(1)).alias("files"), F.sum(F.coalesce(F.length("text"), F.lit(0))).alias("characters"))

"""Stored search responses of repositories as rows of found files or data sets.

Each reader takes responses (column ``body``, JSON text) and gives (repository,
record_url, file_url, title, description, doi, file_name, status). Bodies that
aren't JSON, or have no hits, give no rows, except where a failure is itself a
row. Requests are outside the engine; paging is one response for each page.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Endings of qualitative-analysis files at the file repository, and what hints at them in a text.
FILE_ENDINGS = (".qdpx", ".qdp", ".nvpx", ".atlproj", ".mx", ".mxd")
TEXT_HINTS = (".qdpx", ".qdp", ".nvpx", ".atlproj", ".mx", ".mxd", "qdpx", "nvp", "atlas.ti", "maxqda")

_ITEM = "struct<name:string,url:string,description:string,global_id:string,identifier:string,file_id:string,entity_id:string>"


def ends_with(text: Column, endings: tuple[str, ...] = FILE_ENDINGS) -> Column:
    """Whether a name has one of the endings, in any case."""
    hit, low = F.lit(False), F.lower(F.coalesce(text, F.lit("")))
    for e in endings:
        hit = hit | low.endswith(e)
    return hit


def mentions(text: Column, hints: tuple[str, ...] = TEXT_HINTS) -> Column:
    """Whether a text names an analysis format or program."""
    hit, low = F.lit(False), F.lower(F.coalesce(text, F.lit("")))
    for h in hints:
        hit = hit | F.contains(low, F.lit(h))
    return hit


def _rows(df: DataFrame, repository: str, **columns: Column) -> DataFrame:
    names = ("record_url", "file_url", "title", "description", "doi", "file_name", "status")
    return df.select(F.lit(repository).alias("repository"), *[columns.get(n, F.lit(None)).cast("string").alias(n) for n in names])


def _items(responses: DataFrame) -> DataFrame:
    return responses.select(F.explode(F.from_json("body", f"struct<data:struct<items:array<{_ITEM}>>>")["data"]["items"]).alias("i")).select("i.*")


def file_items(responses: DataFrame, base_url: str, repository: str = "dans") -> DataFrame:
    """File hits (``data.items``) whose name has an analysis ending; the link is the file's own where it has an id."""
    ident = F.coalesce(F.nullif("file_id", F.lit("")), F.nullif("entity_id", F.lit("")))
    link = F.coalesce(F.concat(F.lit(base_url.rstrip("/") + "/api/access/datafile/"), ident), F.col("url"))
    doi = F.coalesce(F.nullif("global_id", F.lit("")), F.col("identifier"))
    return _rows(_items(responses).where(ends_with(F.col("name"))), repository, record_url=F.col("url"), file_url=link, title=F.col("name"), description=F.col("description"), doi=doi, file_name=F.col("name"), status=F.lit("OK"))


def dataset_items(responses: DataFrame, repository: str = "dataverse") -> DataFrame:
    """Data set hits (``data.items``) whose title or description mentions an analysis format or program."""
    hit = mentions(F.concat_ws(" ", "name", "description"))
    return _rows(_items(responses).where(hit), repository, record_url=F.col("url"), file_url=F.col("url"), title=F.col("name"), description=F.col("description"), doi=F.col("global_id"))


def embedded_datasets(responses: DataFrame, repository: str = "dryad") -> DataFrame:
    """Data sets of a HAL response; the link is the landing page, else the DOI, else the title."""
    schema = "struct<_embedded:struct<`stash:datasets`:array<struct<title:string,abstract:string,identifier:string,_links:struct<`stash:landingPage`:struct<href:string>>>>>>"
    df = responses.select(F.explode(F.from_json("body", schema)["_embedded"]["stash:datasets"]).alias("d")).select("d.title", "d.abstract", "d.identifier", F.col("d._links")["stash:landingPage"]["href"].alias("page"))
    filled = lambda c: F.nullif(c, F.lit(""))
    return _rows(df, repository, record_url=F.col("page"), file_url=F.coalesce(filled("page"), filled("identifier"), filled("title"), F.lit(repository)), title=F.col("title"), description=F.col("abstract"), doi=F.col("identifier"))


def exported_metadata(responses: DataFrame, repository: str = "icpsr") -> DataFrame:
    """Records of a metadata API (a list, or an object with ``items``) by ``query``; a response with an ``error`` is a row that says so."""
    item = "struct<id:string,title:string,name:string,url:string,landingPage:string,doi:string,description:string,summary:string>"
    listed = F.coalesce(F.from_json(F.when(F.col("body").rlike(r"^\s*\["), F.col("body")), f"array<{item}>"), F.from_json(F.when(F.col("body").rlike(r"^\s*\{"), F.col("body")), f"struct<items:array<{item}>>")["items"])
    df = responses.where(F.col("error").isNull()).select("query", F.explode(listed).alias("i")).select("query", "i.*")
    first = lambda *names: F.coalesce(*[F.nullif(n, F.lit("")) for n in names])
    anchor = F.concat(F.lit("metadata-api:"), F.col("query"))
    url = first("url", "landingPage", "id")
    found = _rows(
        df, repository, record_url=url, file_url=F.coalesce(url, anchor), title=F.coalesce(first("title", "name"), F.concat(F.lit("ICPSR metadata result: "), F.col("query"))),
        description=F.coalesce(first("description", "summary"), F.lit("Record discovered via ICPSR Metadata API.")), doi=F.col("doi"), status=F.lit("METADATA_API_FOUND"),
    )
    failed = _rows(
        responses.where(F.col("error").isNotNull()), repository, file_url=anchor, title=F.concat(F.lit("ICPSR metadata API query: "), F.col("query")),
        description=F.concat(F.lit("Metadata API attempt failed: "), F.col("error")), status=F.lit("METADATA_API_FAILED"),
    )
    return found.unionByName(failed)

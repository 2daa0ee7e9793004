"""The best representative of each duplicate group (problem 3).

``survivors`` supplies each field by its own rule: the record with the highest
canonical score, the longest description that says something, the link of the
best-scored member that has a usable one. ``truth_discovery`` is the named method:
it alternates between the reliability of sources and weighted votes for field
values. The rules that the required result follows leave no room for source
reliabilities (scores, lengths and ties decide), so ``survivors`` doesn't use them.

Both are plain aggregates: a cluster that holds a third of all rows is combined
before the shuffle and never gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curlew.llm.formatting import DOI, squeeze
from curlew.session import materialize

#: Texts that stand in for a description however rare they are, in lower case; a parameter, since more are learned from the data.
STOCK = (
    "n/a",
    "-",
    "tbd",
    "see title",
    "siehe titel",
    "zie titel",
    "metadata for this item are incomplete.",
    "no description was provided by the depositor.",
    "geen beschrijving beschikbaar.",
    "keine beschreibung vorhanden.",
)
#: The same with the name of a repository.
STOCK_PATTERNS = (
    r"this record was imported automatically from .{1,80} and has not yet been described; please contact the help desk of the archive for details\.",
    r"description to be added by the data steward of .{1,80} after the review of this record has been completed\.",
    r"the full description of this data set can be requested in writing from the contact person named in the deposit agreement of .{1,80}\.",
)
URL = r"(?i)^https?://[^\s/?#]+/[^\s?#]+\S*$"


def _plain(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"(?U)[\s​﻿]+", " "))


def skeleton(description: Column, repository_url: Column) -> Column:
    """A description in lower case with plain spaces, words that begin like its repository's host replaced by a star."""
    text = F.lower(_plain(description))
    host = F.regexp_extract(F.lower(repository_url), r"^[a-z]+://(?:www\.)?([a-z0-9]{4,})", 1)
    return F.when((F.coalesce(host, F.lit("")) != "") & F.contains(text, host), F.regexp_replace(text, F.concat(F.lit("\\b"), host, F.lit("\\w*")), F.lit("*"))).otherwise(text)


def _repository(projects: DataFrame) -> Column:
    return F.col("repository_url") if "repository_url" in projects.columns else F.lit(None).cast("string")


def learned_stock(projects: DataFrame, least_titles: int = 10, least_share: float = 0.8) -> DataFrame:
    """(_stock): digests of descriptions that say nothing about the project, learned from the data.

    Such a text, its repository's name aside, stands in records of at least
    ``least_titles`` different titles, and these are at least ``least_share`` of its
    titled records; copies of one study repeat its title too. Only digests travel.
    """
    told = projects.where(F.col("description").isNotNull() & squeeze(F.col("title")).isNotNull())
    each = told.select("project_uid", F.md5(skeleton(F.col("description"), _repository(projects))).alias("_stock"), F.xxhash64(squeeze(F.col("title"))).alias("t")).distinct()
    by_title = each.groupBy("_stock", "t").agg(F.count(F.lit(1)).alias("n"))
    counts = by_title.groupBy("_stock").agg(F.count(F.lit(1)).alias("titles"), F.sum("n").alias("n"))
    return counts.where((F.col("titles") >= least_titles) & (F.col("titles") >= F.lit(least_share) * F.col("n"))).select("_stock")


def is_stock(description: Column) -> Column:
    """Whether a description is one of the known texts that say nothing about the project."""
    text = F.lower(_plain(description))
    return text.isin(*STOCK) | text.rlike("^(?:" + "|".join(STOCK_PATTERNS) + ")$")


def telling(projects: DataFrame, value: Column, **others: Column) -> DataFrame:
    """(others..., _said): ``value``, made of the description, where that is neither a known nor a learned stock text.

    Only what is named travels to the learned digests, not the texts.
    """
    stock = learned_stock(projects).withColumn("_found", F.lit(True))
    known = F.when(~is_stock(F.col("description")), value)
    short = projects.select(F.md5(skeleton(F.col("description"), _repository(projects))).alias("_stock"), known.alias("_said"), *[c.alias(n) for n, c in others.items()])
    return short.join(stock, "_stock", "left").select(*others, F.when(F.col("_found").isNull(), F.col("_said")).alias("_said"))


def usable_url(url: Column) -> Column:
    """Whether a link is absolute http or https with a host and a path."""
    return _plain(url).rlike(URL)


def last_scores(decisions: DataFrame) -> DataFrame:
    """(project_uid, score): the canonical score of each project's last scored decision; the larger decision_id among equal times."""
    scored = decisions.where(F.col("project_uid").isNotNull() & F.col("canonical_score").isNotNull() & ~F.isnan("canonical_score"))
    return scored.groupBy("project_uid").agg(F.max(F.struct("decided_at_utc", "decision_id", "canonical_score"))["canonical_score"].alias("score"))


def survivors(members: DataFrame, decisions: DataFrame, projects: DataFrame) -> DataFrame:
    """(cluster_id, field_name, project_uid): the member that supplies ``record``, ``description`` and ``project_url``.

    Repeated member rows count once; rows with a null cluster or project have no
    part. Ties go to the smaller project_uid. A field has no row where no member has
    a usable value: a score for ``record``, a description with a character that
    isn't space and isn't stock (known or learned from all projects), a usable link
    of a scored member.
    """
    description = F.regexp_replace("description", r"(?U)[\s​﻿]+", "")
    values = telling(projects.where(F.col("project_uid").isNotNull()), F.length(description), project_uid=F.col("project_uid"), _linked=usable_url(F.col("project_url")))
    values = values.groupBy("project_uid").agg(F.max("_said").alias("_length"), F.max("_linked").alias("_linked"))
    pairs = members.select("cluster_id", "project_uid").where(F.col("cluster_id").isNotNull() & F.col("project_uid").isNotNull()).distinct()
    known = pairs.join(last_scores(decisions), "project_uid", "left").join(values, "project_uid", "left")
    best = lambda measure, usable: F.min(F.when(usable, F.struct((-measure).alias("m"), F.col("project_uid"))))["project_uid"]
    scored = F.col("score").isNotNull()
    chosen = known.groupBy("cluster_id").agg(
        best(F.col("score"), scored).alias("record"),
        best(F.col("_length"), F.col("_length") > 0).alias("description"),
        best(F.col("score"), scored & F.col("_linked")).alias("project_url"),
    )
    fields = ("record", "description", "project_url")
    return chosen.select("cluster_id", F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).alias("project_uid")) for f in fields])).alias("x")).select("cluster_id", "x.*").where(F.col("project_uid").isNotNull())


def claims_of(members: DataFrame, projects: DataFrame) -> DataFrame:
    """(cluster_id, field_name, source, project_uid, value): what each member's source says of each field, in comparable form."""
    pairs = members.select("cluster_id", "project_uid").where(F.col("cluster_id").isNotNull() & F.col("project_uid").isNotNull()).distinct()
    values = {
        "title": squeeze(F.col("title")),
        "doi": squeeze(F.regexp_replace("doi", rf"(?s)^.*?(?={DOI})", "")),
        "project_url": F.when(usable_url(F.col("project_url")), F.lower(_plain(F.col("project_url")))),
    }
    said = telling(projects, F.sha2(squeeze(F.col("description")), 256), project_uid=F.col("project_uid"), source=F.col("source_database_id").cast("string"), **values).withColumnRenamed("_said", "description")
    rows = F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).alias("value")) for f in (*values, "description")]))
    return pairs.join(said, "project_uid").select("cluster_id", "source", "project_uid", rows.alias("x")).select("cluster_id", "x.field_name", "source", "project_uid", "x.value").where(F.col("value").isNotNull() & F.col("source").isNotNull())


def truth_discovery(claims: DataFrame, iterations: int = 20, tolerance: float = 1e-3) -> tuple[DataFrame, DataFrame]:
    """(truth, reliability) of claims (cluster_id, field_name, source, project_uid, value).

    A source's vote weighs -ln(1 - reliability); a value's share is its part of all
    votes for the field of its cluster; a source's reliability is the mean share of
    the values it claims, kept within 0.05 and 0.95, from 0.5 at first. The rounds
    end when no reliability moves by more than ``tolerance``. ``truth`` has for each
    cluster and field the value of most votes (ties: the smallest project_uid that
    claims it); no claims give empty tables.
    """
    claims = materialize(claims.groupBy("cluster_id", "field_name", "value", "source").agg(F.min("project_uid").alias("project_uid")), "claims")
    reliability = materialize(claims.select("source").distinct().withColumn("reliability", F.lit(0.5)), "reliability")

    def voted(now: DataFrame) -> DataFrame:
        votes = claims.join(now, "source").groupBy("cluster_id", "field_name", "value").agg(F.sum(-F.log(1 - F.col("reliability"))).alias("votes"), F.min("project_uid").alias("project_uid"), F.count(F.lit(1)).alias("sources"))
        return votes.join(votes.groupBy("cluster_id", "field_name").agg(F.sum("votes").alias("all")), ["cluster_id", "field_name"]).select("cluster_id", "field_name", "value", "project_uid", "sources", "votes", (F.col("votes") / F.col("all")).alias("share"))

    for _ in range(iterations):
        shares = voted(reliability).select("cluster_id", "field_name", "value", "share")
        after = claims.join(shares, ["cluster_id", "field_name", "value"]).groupBy("source").agg(F.greatest(F.lit(0.05), F.least(F.lit(0.95), F.avg("share"))).alias("new"))
        step = materialize(reliability.join(after, "source").select("source", F.col("new").alias("reliability"), F.abs(F.col("new") - F.col("reliability")).alias("moved")), "reliability")
        reliability = step.select("source", "reliability")
        if (step.agg(F.max("moved")).first()[0] or 0.0) <= tolerance:
            break
    votes = voted(reliability)
    truth = votes.groupBy("cluster_id", "field_name").agg(F.min(F.struct((-F.round("votes", 9)).alias("v"), "project_uid", "value", "share", "sources")).alias("x"))
    return truth.select("cluster_id", "field_name", "x.project_uid", "x.value", "x.share", "x.sources"), reliability

"""Queries of the llm operators, and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from curlew.llm import formatting, near_duplicates, packing, splitting, subjects, survivors, tokenizer
from curlew.session import table

Query = Callable[[SparkSession, str], DataFrame]


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, sf_dir, "stg_projects"))


def p1_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.record_classes(table(spark, sf_dir, "stg_projects"))


def p1_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicate_classes(table(spark, sf_dir, "stg_projects"))[1]


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survivors.survivors(table(spark, sf_dir, "duplicate_cluster_members"), table(spark, sf_dir, "deduplication_decisions"), table(spark, sf_dir, "stg_projects"))


def p3_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    claims = survivors.claims_of(table(spark, sf_dir, "duplicate_cluster_members"), table(spark, sf_dir, "stg_projects"))
    return survivors.truth_discovery(claims)[0]


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return formatting.copies(table(spark, sf_dir, "stg_projects"))


def p5_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return formatting.collapse(table(spark, sf_dir, "stg_projects")).select("group_key", "copies").distinct()


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subjects.subjects(table(spark, sf_dir, "stg_projects"), table(spark, sf_dir, "isic_project_classifications"), table(spark, sf_dir, "isic_divisions"))[0]


def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenizer.encode(table(spark, sf_dir, "documents"))


def p8_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def p8_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(measure, value): every text once and whole unless it is too large, no container overfull, all of them nearly full (1)."""
    packed = p8_containers(spark, sf_dir)
    texts = packed.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.max("piece_no").alias("last"), F.sum("n_tokens").alias("tokens"))
    wrongly = (F.col("last") + 1 != F.col("n")) | (F.col("n") > F.greatest(F.lit(1), F.ceil(F.col("tokens") / 2048)))
    filled = packed.groupBy("container_id").agg(F.sum("n_tokens").alias("filled"))
    nearly = F.sum("filled") >= 0.97 * 2048 * F.count_if(F.col("filled") > 0)
    rows = lambda df, **m: df.agg(*[c.cast("long").alias(n) for n, c in m.items()]).select(F.explode(F.array(*[F.struct(F.lit(n).alias("measure"), F.col(n).alias("value")) for n in m])).alias("x")).select("x.*")
    return rows(texts, texts=F.count(F.lit(1)), cut_wrongly=F.count_if(wrongly)).unionByName(rows(filled, overfull=F.count_if(F.col("filled") > 2048), nearly_full=nearly))


def p9_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold of the pieces, by text: its length when the new parts are put together, and faults of size, order and overlap."""
    pieces = splitting.split_documents(table(spark, sf_dir, "documents"), with_text=False)
    before = Window.partitionBy("doc_id").orderBy("piece_no")
    done = F.coalesce(F.lag("char_end").over(before), F.lit(0))
    each = pieces.select("doc_id", (F.col("char_end") - done).alias("new"), ((F.col("n_tokens") > 512) | (F.col("overlap_tokens") > 64) | (F.col("char_start") > done) | (F.col("char_end") <= done) | ((F.col("overlap_tokens") == 0) != (F.col("char_start") == done))).alias("fault"))
    return each.groupBy("doc_id").agg(F.sum("new").alias("covered"), F.count_if("fault").alias("faults"))


def p9_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splitting.split_documents(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (p1_found, p1_members, p1_links, p3_found, p3_truth, p5_found, p5_copies, p6_found, p7_ids, p8_containers, p8_checked, p9_pieces, p9_checked)}

_STOCK = """'n/a', '-', 'tbd', 'see title', 'siehe titel', 'zie titel', 'metadata for this item are incomplete.', 'no description was provided by the depositor.', 'geen beschrijving beschikbaar.', 'keine beschreibung vorhanden.'"""
_STOCK_LIKE = """lower(p.text) LIKE 'this record was imported automatically from _% and has not yet been described; please contact the help desk of the archive for details.'
      OR lower(p.text) LIKE 'description to be added by the data steward of _% after the review of this record has been completed.'
      OR lower(p.text) LIKE 'the full description of this data set can be requested in writing from the contact person named in the deposit agreement of _%.'"""

_KEYED = r"""
WITH marked AS (
  SELECT project_uid, doi, title, regexp_matches(doi, '10\.\d{4,9}/') AS d, regexp_matches(title, '10\.\d{4,9}/') AS t
  FROM stg_projects WHERE doi IS NOT NULL AND title IS NOT NULL),
cut AS (
  SELECT project_uid,
    CASE WHEN d THEN regexp_replace(doi, '(?s)^.*?(10\.\d{4,9}/)', '\1') ELSE doi END AS a,
    CASE WHEN NOT d AND t THEN regexp_replace(title, '(?s)^.*?(10\.\d{4,9}/)', '\1') ELSE title END AS b
  FROM marked),
bare AS (
  SELECT project_uid,
    regexp_replace(replace(lower(a), 'ß', 'ss'), '[^\p{L}\p{M}\p{N}]+', '', 'g') AS a,
    regexp_replace(replace(lower(b), 'ß', 'ss'), '[^\p{L}\p{M}\p{N}]+', '', 'g') AS b
  FROM cut),
keyed AS (SELECT project_uid, least(a, b) AS lo, greatest(a, b) AS hi FROM bare WHERE a <> '' AND b <> '')"""

# Brute force over an inverted index of (word, occurrence).
_WORDS = r"""
WITH told AS (
  SELECT project_uid, regexp_extract_all(lower(description), '[\p{L}\p{N}]+') AS d, coalesce(regexp_extract_all(lower(title), '[\p{L}\p{N}]+'), []) AS t FROM stg_projects WHERE project_uid IS NOT NULL AND description IS NOT NULL),
texts AS MATERIALIZED (SELECT DISTINCT project_uid AS uid, list_sort(t || d) AS words, len(t) + len(d) AS n FROM told WHERE len(d) >= 30),
classes AS MATERIALIZED (SELECT row_number() OVER () AS id, min(uid) AS class_key, count(*) AS copies, words, any_value(n) AS n FROM texts GROUP BY words),
each AS (SELECT id, n, unnest(words) AS w FROM classes),
placed AS MATERIALIZED (SELECT id, n, w, row_number() OVER (PARTITION BY id, w) AS k FROM each),
links AS MATERIALIZED (
  SELECT a.id AS a, b.id AS b, count(*) / greatest(any_value(a.n), any_value(b.n)) AS agreement
  FROM placed a JOIN placed b ON a.w = b.w AND a.k = b.k AND a.id < b.id AND least(a.n, b.n) >= 0.75 * greatest(a.n, b.n) GROUP BY 1, 2 HAVING count(*) >= 0.75 * greatest(any_value(a.n), any_value(b.n))),
member AS MATERIALIZED (SELECT uid, id, class_key, c.copies FROM texts JOIN classes c USING (words))"""

ORACLES: dict[str, str] = {
    "p1_found": _WORDS + """,
pairs AS (
  SELECT x.uid AS u, y.uid AS v FROM links l JOIN member x ON x.id = l.a JOIN member y ON y.id = l.b
  UNION ALL SELECT x.uid, y.uid FROM member x JOIN member y ON x.id = y.id AND x.uid < y.uid)
SELECT DISTINCT least(u, v) AS project_uid_a, greatest(u, v) AS project_uid_b FROM pairs""",
    "p1_members": _WORDS + " SELECT uid AS project_uid, class_key, copies FROM member",
    "p1_links": _WORDS + " SELECT least(x.class_key, y.class_key) AS class_key_a, greatest(x.class_key, y.class_key) AS class_key_b, agreement FROM links l JOIN classes x ON x.id = l.a JOIN classes y ON y.id = l.b",
    "p8_checked": "SELECT unnest(['texts', 'cut_wrongly', 'overfull', 'nearly_full']) AS measure, unnest([count(*), 0, 0, 1])::BIGINT AS value FROM documents",
    "p9_checked": "SELECT doc_id, length(text)::BIGINT AS covered, 0::BIGINT AS faults FROM documents WHERE text <> ''",
    "p3_found": rf"""
WITH scored AS (
  SELECT project_uid, arg_max(canonical_score, (decided_at_utc, decision_id)) AS score
  FROM deduplication_decisions WHERE canonical_score IS NOT NULL GROUP BY 1),
plain AS (
  SELECT project_uid, description, trim(regexp_replace(description, '\s+', ' ', 'g')) AS text, trim(project_url) AS url, nullif(regexp_replace(replace(lower(title), 'ß', 'ss'), '[^\p{{L}}\p{{M}}\p{{N}}]+', '', 'g'), '') AS plain_title,
    regexp_extract(lower(repository_url), '^[a-z]+://(?:www\.)?([a-z0-9]{{4,}})', 1) AS host FROM stg_projects),
bare AS (SELECT *, CASE WHEN host <> '' AND contains(lower(text), host) THEN regexp_replace(lower(text), '\b' || host || '\w*', '*', 'g') ELSE lower(text) END AS skeleton FROM plain),
learned AS (SELECT skeleton FROM bare WHERE plain_title IS NOT NULL GROUP BY 1 HAVING count(DISTINCT plain_title) >= 10 AND count(DISTINCT plain_title) >= 0.8 * count(DISTINCT project_uid)),
known AS (
  SELECT DISTINCT m.cluster_id, m.project_uid, s.score,
    CASE WHEN lower(p.text) NOT IN ({_STOCK}) AND NOT ({_STOCK_LIKE}) AND p.skeleton NOT IN (SELECT skeleton FROM learned WHERE skeleton IS NOT NULL)
      THEN nullif(length(regexp_replace(p.description, '\s+', '', 'g')), 0) END AS len,
    regexp_matches(p.url, '(?i)^https?://[^\s/?#]+/[^\s?#]+\S*$') AS linked
  FROM duplicate_cluster_members m LEFT JOIN scored s USING (project_uid) LEFT JOIN bare p USING (project_uid)
  WHERE m.cluster_id IS NOT NULL AND m.project_uid IS NOT NULL),
ranked AS (
  SELECT cluster_id, 'record' AS field_name, project_uid, row_number() OVER (PARTITION BY cluster_id ORDER BY score DESC, project_uid) AS r FROM known WHERE score IS NOT NULL
  UNION ALL
  SELECT cluster_id, 'description', project_uid, row_number() OVER (PARTITION BY cluster_id ORDER BY len DESC, project_uid) FROM known WHERE len IS NOT NULL
  UNION ALL
  SELECT cluster_id, 'project_url', project_uid, row_number() OVER (PARTITION BY cluster_id ORDER BY score DESC, project_uid) FROM known WHERE score IS NOT NULL AND linked)
SELECT cluster_id, field_name, project_uid FROM ranked WHERE r = 1""",
    "p5_found": _KEYED + """,
groups AS (SELECT lo, hi, min(project_uid) AS project_uid_a FROM keyed GROUP BY 1, 2)
SELECT DISTINCT g.project_uid_a, k.project_uid AS project_uid_b
FROM groups g JOIN keyed k USING (lo, hi) WHERE k.project_uid <> g.project_uid_a""",
    "p5_copies": _KEYED + " SELECT min(project_uid) AS group_key, count(DISTINCT project_uid) AS copies FROM keyed GROUP BY lo, hi",
}

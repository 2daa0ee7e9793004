"""Quality gates: declarative checks as rows (name, passed, severity, expected, observed).

The measures of a gate are one union of small aggregates, folded to one row, so a
gate costs a few jobs however many checks it has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHECK = "name string, passed boolean, severity string, expected string, observed string"


def measure(df: DataFrame, **aggregates: Column) -> DataFrame:
    """(measure, value): one row for each aggregate of ``df``."""
    one = df.agg(*[F.coalesce(c, F.lit(0)).cast("long").alias(n) for n, c in aggregates.items()])
    return one.select(F.explode(F.array(*[F.struct(F.lit(n).alias("measure"), F.col(n).alias("value")) for n in aggregates])).alias("x")).select("x.*")


def checks(measures: list[DataFrame], rules: list[tuple[str, Column | int, str]], severity: str = "error") -> DataFrame:
    """Rows of (name, expected, measure): passed where the measure equals what is expected (a number or an expression of measures)."""
    df = measures[0]
    for m in measures[1:]:
        df = df.unionByName(m)
    folded = df.agg(F.map_from_entries(F.collect_list(F.struct("measure", "value"))).alias("m"))  # one entry for each measure
    rows = []
    for name, expected, observed in rules:
        want = F.lit(expected) if isinstance(expected, int) else expected
        got = F.col("m")[observed]
        rows.append(F.struct(F.lit(name).alias("name"), want.eqNullSafe(got).alias("passed"), F.lit(severity).alias("severity"), want.cast("string").alias("expected"), got.cast("string").alias("observed")))
    return folded.select(F.explode(F.array(*rows)).alias("c")).select("c.*")


def m(name: str) -> Column:
    return F.col("m")[name]


def report(found: DataFrame) -> DataFrame:
    """One row: passed unless an error check failed; failed warnings are only counted."""
    failed = F.count_if(~F.col("passed") & (F.col("severity") == "error"))
    return found.agg((failed == 0).alias("passed"), F.count(F.lit(1)).alias("checks"), failed.alias("failed"), F.count_if(~F.col("passed") & (F.col("severity") == "warning")).alias("warnings"))


def dedup_gate(projects: DataFrame, decided: DataFrame, tags: DataFrame) -> DataFrame:
    """Checks of a resolution: coverage, conservation of counts, canonical replacements, tags, impact on the core scope."""
    excluded = F.col("decision") == "EXCLUDED_FROM_DEDUPLICATED_ANALYSIS"
    canonical = decided.where(F.col("decision") == "CANONICAL_RECORD").select(F.col("project_uid").alias("canonical_project_uid"))
    orphans = decided.where(excluded).join(canonical, "canonical_project_uid", "left_anti")
    untagged = decided.join(tags.select("project_uid").distinct(), "project_uid", "left_anti")
    measures = [
        measure(projects, raw=F.count_distinct("project_uid")),
        measure(decided, decisions=F.count(F.lit(1)), decided=F.count_distinct("project_uid"), excluded=F.count_if(excluded), included=F.count_if(~excluded), core_excluded=F.count_if(excluded & (F.col("source_scope") == "MY_CORE")), canonical_excluded=F.count_if(excluded & (F.col("project_uid") == F.col("canonical_project_uid")))),
        measure(orphans, without_canonical=F.count(F.lit(1))),
        measure(untagged, untagged=F.count(F.lit(1))),
    ]
    return checks(measures, [
        ("decision_coverage", m("raw"), "decisions"), ("one_decision_per_project", m("decisions"), "decided"), ("count_conservation", m("raw") - m("excluded"), "included"),
        ("excluded_records_have_canonical_replacement", 0, "without_canonical"), ("canonical_records_not_excluded", 0, "canonical_excluded"), ("tag_coverage", 0, "untagged"), ("core_scope_untouched", 0, "core_excluded"),
    ])


def run_gate(projects: DataFrame, tables: dict[str, DataFrame], runs: DataFrame) -> DataFrame:
    """Checks of the stored tables of a resolution (``dedup.decision_tables``) against its run row and the staging."""
    d, run = tables["decisions"].select("project_uid"), tables["run"]
    missing = lambda name: d.join(tables[name].select("project_uid").distinct(), "project_uid", "left_anti")
    rows = F.count(F.lit(1))
    measures = [
        measure(projects, staged=F.count_distinct("project_uid")),
        measure(tables["decisions"], decisions=rows),
        measure(tables["analysis"], analysis=F.count_distinct("project_uid")),
        measure(run, run_raw=F.sum("raw_projects"), run_included=F.sum("included"), run_excluded=F.sum("excluded"), runs=rows),
        measure(runs.join(run.select("run_id"), "run_id", "left_semi"), known_runs=rows),
        *[measure(missing(name), **{f"without_{name}": rows}) for name in ("audit", "tags")],
    ]
    return checks(measures, [
        ("latest_run_present", 1, "known_runs"), ("raw_project_count_matches_staging", m("staged"), "run_raw"), ("decision_coverage", m("staged"), "decisions"),
        ("deduplicated_analysis_coverage", m("run_included"), "analysis"), ("included_match_run", m("decisions") - m("run_excluded"), "run_included"), ("excluded_match_run", m("decisions") - m("run_included"), "run_excluded"),
        ("audit_coverage", 0, "without_audit"), ("tag_coverage", 0, "without_tags"),
    ])


def delivery_gate(tables: dict[str, DataFrame], types: DataFrame, staged: DataFrame, repositories: tuple[int, ...]) -> DataFrame:
    """Checks of delivered tables (``delivery.delivery_tables``) against the staging they come from."""
    projects, isic, files = tables["projects"], tables["isic"], tables["files"]
    rows = F.count(F.lit(1))
    official = staged.where(F.col("repository_id").try_cast("int").isin(*repositories)).select("project_uid").distinct()
    classified = isic.where(F.col("primary_division_code").isNotNull()).select("project_id").distinct()
    measures = [
        measure(official, official=rows), measure(projects, delivered=rows, outside=F.count_if(~F.col("repository_id").isin(*repositories)), ids=F.count_distinct("id")),
        measure(types.join(official, "project_uid", "left_semi"), typed=F.count_distinct("project_uid")),
        measure(projects.select(F.col("id").alias("project_id")).join(classified, "project_id", "left_anti"), unclassified=rows),
        measure(files, files=rows, file_ids=F.count_distinct("id"), primary=F.count_if("is_primary")),
        measure(files.join(projects.select(F.col("id").alias("project_id")), "project_id", "left_anti"), orphans=rows),
    ]
    return checks(measures, [
        ("official_project_count", m("official"), "delivered"), ("repository_scope", 0, "outside"), ("project_ids_unique", m("delivered"), "ids"), ("types_complete", m("official"), "typed"),
        ("classification_coverage", 0, "unclassified"), ("file_ids_unique", m("files"), "file_ids"), ("orphan_file_records", 0, "orphans"), ("primary_file_coverage", m("files"), "primary"),
    ])


def foreign_keys(tables: dict[str, DataFrame], declared: list[tuple[str, str, str]]) -> DataFrame:
    """(child, column, parent, orphans) of each declared (child table, column, parent table): rows whose value the parent's column lacks; null refers to nothing."""
    out = None
    for child, column, parent in declared:
        mine = tables[child].where(F.col(column).isNotNull()).select(F.col(column).cast("string").alias("k"))
        theirs = tables[parent].select(F.col(column).cast("string").alias("k")).distinct()
        one = mine.join(theirs, "k", "left_anti").agg(F.count(F.lit(1)).alias("orphans")).select(F.lit(child).alias("child"), F.lit(column).alias("column"), F.lit(parent).alias("parent"), "orphans")
        out = one if out is None else out.unionByName(one)
    return out


def require(found: DataFrame) -> None:
    """Raise if an error check of a gate failed, naming those that did (as many as a gate has checks)."""
    failed = [r["name"] for r in found.where(~F.col("passed") & (F.col("severity") == "error")).select("name").orderBy("name").collect()]
    if failed:
        raise ValueError(f"failed checks: {failed}")


def verify_output(df: DataFrame, columns: tuple[str, ...], rows: int | None = None) -> None:
    """Raise unless a written output, read again, has exactly these columns in this order, and so many rows."""
    if tuple(df.columns) != tuple(columns):
        raise ValueError(f"columns are {df.columns}, expected {list(columns)}")
    if rows is not None and (n := df.count()) != rows:
        raise ValueError(f"{n} rows, expected {rows}")


def distribution_gate(observed: DataFrame, expected: DataFrame, name: str) -> DataFrame:
    """One check for each (key, value) of two distributions; a key on one side only fails."""
    joined = observed.select("key", F.col("value").alias("o")).join(expected.select("key", F.col("value").alias("e")), "key", "full")
    return joined.select(F.concat_ws(":", F.lit(name), "key").alias("name"), F.col("e").eqNullSafe(F.col("o")).alias("passed"), F.lit("error").alias("severity"), F.col("e").cast("string").alias("expected"), F.col("o").cast("string").alias("observed"))


def required_columns(tables: dict[str, DataFrame], required: dict[str, tuple[str, ...]]) -> list[tuple[str, str]]:
    """(table, column) that are required and missing; a missing table lacks all its columns."""
    return sorted((t, c) for t, columns in required.items() for c in columns if t not in tables or c not in tables[t].columns)

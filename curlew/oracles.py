"""SQL that DuckDB runs on the same tables to check the core queries."""

from __future__ import annotations

from curlew import vocab as V


def _list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


WS = V.SPACE


def strip(c: str) -> str:
    return f"regexp_replace({c}, '^{WS}+|{WS}+$', '', 'g')"


def fold(c: str) -> str:
    return f"replace(lower({c}), 'ß', 'ss')"


def doi_key(c: str) -> str:
    return f"coalesce(rtrim(regexp_extract({fold(c)}, '{V.DOI_PATTERN}'), '.,;:)'), '')"


def file_like(c: str) -> str:
    return f"coalesce(regexp_matches({strip(c)}, '{V.FILE_TITLE_PATTERN}'), false)"


def title_plain(c: str) -> str:
    return strip(f"regexp_replace(regexp_replace({strip(fold(c))}, '{WS}+', ' ', 'g'), '[^a-z0-9 ]+', '', 'g')")


def title_key(c: str) -> str:
    return f"CASE WHEN {c} IS NULL OR {file_like(c)} OR length({title_plain(c)}) < {V.TITLE_LENGTH} OR {title_plain(c)} IN ({_list(V.GENERIC_TITLES)}) THEN '' ELSE {title_plain(c)} END"


def extension(c: str) -> str:
    return rf"coalesce(regexp_extract(regexp_replace(regexp_replace(lower({strip(c)}), '(?s)[?#].*$', ''), '(?s)^.*[/\\]', ''), '\.([a-z0-9]{{1,15}})$', 1), '')"


def filled(c: str) -> str:
    return f"coalesce({c} <> '', false)"


FILES = "files AS (SELECT project_uid, count(DISTINCT file_uid) AS file_count FROM stg_files WHERE project_uid IS NOT NULL GROUP BY 1)"
KEYED = f"""keyed AS (
  SELECT project_uid, source_database_id, coalesce(repository_id, '') AS repository_id, {doi_key('doi')} AS doi_key, {title_key('title')} AS title_key, {file_like('title')} AS file_like,
    {filled('doi')} AS has_doi, {filled('description')} AS has_description, {filled('project_url')} AS has_project_url, {filled('repository_url')} AS has_repository_url, {filled('language')} AS has_language, {filled('upload_date')} AS has_upload_date
  FROM stg_projects)"""
PROFILES = f"""{KEYED}, {FILES},
by_doi AS (SELECT source_database_id, doi_key, count(*) AS n, count(*) FILTER (file_like) AS f FROM keyed GROUP BY 1, 2),
counted AS (SELECT source_database_id, sum(n)::BIGINT AS project_count, sum(f)::BIGINT AS file_like_title_records, sum(CASE WHEN doi_key <> '' AND n > 1 THEN n ELSE 0 END)::BIGINT AS repeated_doi_records FROM by_doi GROUP BY 1),
filed AS (SELECT source_database_id, count(DISTINCT file_uid) AS file_count FROM stg_files GROUP BY 1),
flat AS (
  SELECT s.source_database_id, s.source_student_id, s.source_scope, coalesce(project_count, 0) AS project_count, coalesce(file_count, 0) AS file_count, coalesce(file_like_title_records, 0) AS file_like_title_records, coalesce(repeated_doi_records, 0) AS repeated_doi_records
  FROM source_databases s LEFT JOIN counted USING (source_database_id) LEFT JOIN filed USING (source_database_id)),
profiles AS (
  SELECT *, CASE WHEN project_count = 0 THEN 'DATASET_LIKE'
    WHEN repeated_doi_records / project_count >= 0.25 AND file_count / project_count <= 2.0 THEN 'FILE_LEVEL_LIKELY'
    WHEN file_like_title_records / project_count >= 0.5 AND file_count / project_count <= 1.5 THEN 'FILE_LEVEL_LIKELY'
    WHEN repeated_doi_records / project_count >= 0.05 OR file_like_title_records / project_count >= 0.15 THEN 'MIXED_OR_REVIEW'
    ELSE 'DATASET_LIKE' END AS candidate_granularity FROM flat)"""
CANDIDATES = f"""{PROFILES},
candidates AS (
  SELECT k.*, p.source_student_id, p.source_scope, coalesce(f.file_count, 0) AS file_count,
    k.has_description::INT + k.has_project_url::INT + k.has_doi::INT + least(3, coalesce(f.file_count, 0)) AS score
  FROM keyed k JOIN profiles p USING (source_database_id) LEFT JOIN files f USING (project_uid)
  WHERE p.candidate_granularity = 'DATASET_LIKE' AND doi_key <> '' AND title_key <> ''),
ranked AS (
  SELECT *, 'dedup:' || left(sha256(doi_key || '|' || title_key), 24) AS cluster_id,
    row_number() OVER (PARTITION BY doi_key, title_key ORDER BY CASE WHEN source_scope = 'MY_CORE' THEN 0 ELSE 1 END, score DESC, project_uid) AS member_rank
  FROM candidates WHERE (doi_key, title_key) IN (SELECT (doi_key, title_key) FROM candidates GROUP BY doi_key, title_key HAVING count(DISTINCT source_student_id) >= 2))"""
CLUSTERS = f"""{CANDIDATES},
clusters AS (
  SELECT cluster_id, 'EXACT_DOI_AND_NORMALIZED_TITLE' AS cluster_key_type, doi_key || '|' || title_key AS canonical_key, 'HIGH_CONFIDENCE' AS candidate_strength, count(*) AS raw_member_count,
    count(DISTINCT source_database_id) AS unique_source_count, count(DISTINCT source_student_id) AS unique_student_count, count(DISTINCT repository_id) AS unique_repository_count, 1::BIGINT AS unique_title_count,
    min(CASE WHEN member_rank = 1 THEN project_uid END) AS canonical_project_uid
  FROM ranked GROUP BY cluster_id, doi_key, title_key)"""
DECISIONS = f"""{PROFILES},
records AS (
  SELECT k.*, p.source_scope, p.candidate_granularity, coalesce(f.file_count, 0) AS file_count,
    CASE WHEN doi_key <> '' THEN 4.0 ELSE 0 END::DOUBLE + CASE WHEN has_project_url THEN 3 ELSE 0 END + CASE WHEN has_repository_url THEN 1 ELSE 0 END + CASE WHEN has_description THEN 2 ELSE 0 END
    + CASE WHEN has_language THEN 0.5 ELSE 0 END + CASE WHEN has_upload_date THEN 0.5 ELSE 0 END + least(3.0, coalesce(f.file_count, 0) * 0.25) + CASE WHEN p.source_scope = 'MY_CORE' THEN 0.25 ELSE 0 END AS canonical_score
  FROM keyed k JOIN profiles p USING (source_database_id) LEFT JOIN files f USING (project_uid)),
known AS (SELECT DISTINCT m.cluster_id, r.* FROM (SELECT DISTINCT cluster_id, project_uid FROM duplicate_cluster_members WHERE cluster_id IS NOT NULL) m JOIN records r USING (project_uid)),
judged AS (
  SELECT cluster_id, arg_min(project_uid, (-canonical_score, -file_count, project_uid)) AS canonical_project_uid,
    CASE WHEN count(*) < 2 THEN 'Cluster has fewer than two records.'
      WHEN min(doi_key) <> max(doi_key) OR min(doi_key) = '' THEN 'Members do not share one valid canonical DOI.'
      WHEN min(title_key) <> max(title_key) OR min(title_key) = '' THEN 'Members do not share the same eligible normalized title.'
      WHEN NOT bool_and(candidate_granularity = 'DATASET_LIKE') THEN 'At least one member is not from a DATASET_LIKE source.' END AS failed
  FROM known GROUP BY cluster_id),
chosen AS (SELECT project_uid, min(cluster_id) AS cluster_id FROM known GROUP BY 1),
decided AS (
  SELECT r.project_uid, coalesce(j.canonical_project_uid, r.project_uid) AS canonical_project_uid, r.source_scope, c.cluster_id,
    CASE WHEN c.cluster_id IS NULL THEN 'UNIQUE_RECORD' WHEN j.failed IS NOT NULL THEN 'RETAINED_FOR_REVIEW' WHEN r.project_uid = j.canonical_project_uid THEN 'CANONICAL_RECORD' ELSE 'EXCLUDED_FROM_DEDUPLICATED_ANALYSIS' END AS decision,
    CASE WHEN c.cluster_id IS NULL THEN 'NO_CONFIRMED_DUPLICATE' WHEN j.failed IS NOT NULL THEN 'AMBIGUOUS_DUPLICATE_REVIEW' ELSE 'CONFIRMED_EXACT_DOI_AND_NORMALIZED_TITLE' END AS evidence_rule,
    CASE WHEN c.cluster_id IS NOT NULL AND j.failed IS NOT NULL THEN 0.0 ELSE 1.0 END::DOUBLE AS confidence, r.canonical_score,
    CASE WHEN j.failed IS NOT NULL THEN j.failed WHEN c.cluster_id IS NULL THEN 'No confirmed duplicate cluster membership.' ELSE 'Exact DOI and normalized-title evidence confirmed across dataset-like sources.' END AS decision_reason
  FROM records r LEFT JOIN chosen c USING (project_uid) LEFT JOIN judged j ON c.cluster_id = j.cluster_id)"""
TAGS = """tags AS (SELECT project_uid, unnest(CASE decision WHEN 'UNIQUE_RECORD' THEN ['UNIQUE_RECORD', 'RETAINED_IN_ANALYSIS'] WHEN 'RETAINED_FOR_REVIEW' THEN ['AMBIGUOUS_DUPLICATE_REVIEW', 'RETAINED_IN_ANALYSIS'] ELSE ['CONFIRMED_DUPLICATE', 'EXACT_IDENTIFIER_DUPLICATE', decision] END) AS tag FROM decided)"""
EVIDENCE = f"""each_file AS (SELECT DISTINCT project_uid, file_uid, file_name, {extension('file_name')} AS ext FROM stg_files WHERE project_uid IS NOT NULL),
facts AS (
  SELECT project_uid, count(file_uid) AS file_record_count, bool_or(ext IN ({_list(V.QDA_EXTENSIONS)})) AS high, bool_or(ext IN ({_list(V.AMBIGUOUS_EXTENSIONS)})) AS ambiguous, bool_or(ext IN ({_list(V.PRIMARY_EXTENSIONS)})) AS prim,
    bool_or(ext IN ({_list(sorted(set(V.PRIMARY_EXTENSIONS) - set(V.METADATA_EXTENSIONS)))})) AS content,
    array_to_string(list_transform(list_slice(list_sort(list({{'u': file_uid, 'n': file_name}}) FILTER (ext IN ({_list(V.AMBIGUOUS_EXTENSIONS)}))), 1, 5), lambda x: x.n), ' ') AS names
  FROM each_file GROUP BY 1),
told AS (SELECT p.project_uid, lower(concat_ws(' ', p.title, p.description, f.names)) AS text, coalesce(high, false) AS high, coalesce(ambiguous, false) AS ambiguous, coalesce(prim, false) AS prim, coalesce(content, false) AS content, coalesce(file_record_count, 0) AS file_record_count FROM stg_projects p LEFT JOIN facts f USING (project_uid)),
hit AS (SELECT *, len(list_filter([{_list(V.QDA_TERMS)}], lambda t: contains(text, t))) > 0 AS term, len(list_filter([{_list(V.METADATA_TERMS)}], lambda t: contains(text, t))) > 0 AS meta FROM told)"""
TYPES = f"""{EVIDENCE},
types AS (
  SELECT project_uid, file_record_count,
    CASE WHEN high OR (ambiguous AND term) THEN 'QDA_PROJECT' WHEN prim AND NOT content AND meta THEN 'OTHER_PROJECT' WHEN prim THEN 'QD_PROJECT' WHEN file_record_count > 0 THEN 'OTHER_PROJECT' ELSE 'NOT_A_PROJECT' END AS project_type,
    CASE WHEN high THEN 'HIGH_CONFIDENCE_QDA_EXTENSION' WHEN ambiguous AND term THEN 'CONTEXT_VALIDATED_AMBIGUOUS_QDA_EXTENSION' WHEN prim AND NOT content AND meta THEN 'METADATA_ONLY_FILE_WITHOUT_PRIMARY_DATA'
      WHEN prim THEN 'PRIMARY_DATA_EXTENSION' WHEN file_record_count > 0 THEN 'FILE_RECORD_WITHOUT_QDA_OR_PRIMARY_EVIDENCE' ELSE 'NO_FILE_RECORD' END AS classification_rule
  FROM hit)"""


def term_classes(source: str, key: str, text: str, legal, research, single: bool) -> str:
    extra = "WHEN na > 0 AND nb = 0 THEN '69' WHEN nb > 0 AND na = 0 THEN '72'" if single else ""
    return f"""(SELECT {key}, division, CASE WHEN na >= 2 AND na >= nb OR nb >= 2 AND nb > na THEN 'MULTI_TERM' ELSE 'SINGLE_TERM' END AS rule,
      CASE WHEN na >= 2 AND na >= nb THEN least(0.99::DOUBLE, 0.80::DOUBLE + na * 0.04::DOUBLE) WHEN nb >= 2 AND nb > na THEN least(0.99::DOUBLE, 0.80::DOUBLE + nb * 0.04::DOUBLE) ELSE 0.80::DOUBLE END AS confidence,
      array_to_string(CASE WHEN division = '69' THEN a ELSE b END, '|') AS terms
    FROM (SELECT *, CASE WHEN na >= 2 AND na >= nb THEN '69' WHEN nb >= 2 AND nb > na THEN '72' {extra} END AS division
      FROM (SELECT *, len(a) AS na, len(b) AS nb FROM (SELECT {key}, list_filter([{_list(legal)}], lambda t: contains({fold(text)}, t)) AS a, list_filter([{_list(research)}], lambda t: contains({fold(text)}, t)) AS b FROM {source})))
    WHERE division IS NOT NULL)"""


#: Terms that occur in the driver's texts; the stock lists of the classifier do not.
LEGAL = ("court", "legal", "notary", "tribunal", "statute", "audit", "jury")
RESEARCH = ("laboratory", "experiment", "research", "hypothesis", "microscope", "preprint")
REPOSITORIES = ", ".join(f"('{n}', {i}, '{u}')" for n, (i, u) in V.LEDGER_REPOSITORIES.items())
LEDGER = f"""repos(name, number, link) AS (VALUES {REPOSITORIES}),
ledger AS (
  SELECT ['dans', 'icpsr', 'zenodo', 'other'][(p.source_database_id % 4 + 1)::INT] AS folder, p.project_url AS dataset_url, coalesce(p.project_url, f.file_url) AS url, p.title, p.description, p.doi, p.download_date, f.local_path, f.file_name, f.file_type, f.status
  FROM stg_files f JOIN stg_projects p USING (project_uid)),
migrated AS (
  SELECT DISTINCT coalesce(r.number, 0) AS repository_id, coalesce(r.link, '') AS repository_url, l.url AS project_url, coalesce(l.title, l.file_name, l.url) AS title, coalesce(l.description, '') AS description,
    CASE WHEN NOT regexp_matches(l.doi, '^ *$') THEN regexp_replace(l.doi, '(?i)^([^h]|h[^t])', 'https://doi.org/\\1') END AS doi, l.download_date, l.folder AS download_repository_folder,
    replace(l.local_path, concat('data/raw/', l.folder, '/'), '') AS download_project_folder, 'API-CALL' AS download_method
  FROM ledger l LEFT JOIN repos r ON r.name = l.folder)"""
PROVIDER = lambda c: f"CASE WHEN contains(lower({c}), 'faubox.rrze.uni-erlangen.de') THEN 'FAUBOX' WHEN contains(lower({c}), 'drive.google.com') THEN 'GOOGLE_DRIVE' WHEN contains(lower({c}), 'github.com') OR contains(lower({c}), 'raw.githubusercontent.com') THEN 'GITHUB' WHEN starts_with(lower({c}), 'https://') OR starts_with(lower({c}), 'http://') THEN 'WEB' WHEN contains({c}, '/') OR contains({c}, chr(92)) THEN 'LOCAL_OR_RELATIVE_PATH' ELSE 'UNKNOWN' END"
ENDINGS = (".zip", ".pdf", ".txt", ".rtf", ".doc", ".docx", ".csv", ".xlsx", ".sav", ".dta", ".rdata", ".rds", ".qdpx", ".qdp", ".nvpx", ".nvp", ".atlproj", ".mx", ".mx20", ".mx22")

PROJECT_COLUMNS = "repository_id repository_url project_url query_string version title description language doi upload_date download_date download_method".split()
FILE_COLUMNS = "file_name file_type status file_url local_path file_size_bytes".split()


def json_fields(table: str, raw: str, entity: str, staged: list[str]) -> str:
    """Profile of an entity's delivered fields (entity, d, f, types, feeds), and its rows and fields on the way."""
    hits = ", ".join(f"count(*) FILTER (v IS NOT DISTINCT FROM {c} AND k IN ('string', 'integer', 'decimal', 'boolean') AND (f = '{c}' OR f NOT IN ({_list(staged)}))) AS hit_{c}" for c in staged)
    best = ", ".join(f"{{'n': -hit_{c}, 'c': '{c}'}}" for c in sorted(staged))
    return f"""{entity}_rows AS MATERIALIZED (
  SELECT row_number() OVER () AS r, source_database_id AS d, CASE WHEN json_valid({raw}) AND json_type({raw}) = 'OBJECT' THEN {raw}::JSON END AS j, {', '.join(f'{c}::VARCHAR AS {c}' for c in staged)} FROM {table}),
{entity}_keys AS (SELECT *, unnest(json_keys(j)) AS f, unnest(range(len(json_keys(j))::INT)) AS i FROM {entity}_rows WHERE j IS NOT NULL),
{entity}_each AS MATERIALIZED (
  SELECT * EXCLUDE (j, x), x ->> '$' AS v, to_json(f)::VARCHAR || ':' || x::VARCHAR AS member,
    CASE json_type(x) WHEN 'VARCHAR' THEN 'string' WHEN 'UBIGINT' THEN 'integer' WHEN 'BIGINT' THEN 'integer' WHEN 'DOUBLE' THEN 'decimal' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'ARRAY' THEN 'array' WHEN 'OBJECT' THEN 'object' END AS k
  FROM (SELECT *, json_extract(j, '$."' || f || '"') AS x FROM {entity}_keys)),
{entity}_sums AS MATERIALIZED (SELECT d, f, list_sort(list(DISTINCT k) FILTER (k IS NOT NULL)) AS types, count(k) AS filled, {hits} FROM {entity}_each WHERE d IS NOT NULL GROUP BY d, f),
{entity}_fields AS MATERIALIZED (
  SELECT '{entity}' AS entity, d, f, CASE WHEN list_contains(types, 'decimal') THEN list_filter(types, lambda x: x <> 'integer') ELSE types END AS types,
    list_sort(list_filter([{best}], lambda x: -x.n >= 0.9 * filled AND x.n < 0))[1].c AS feeds FROM {entity}_sums)"""


def consistent_rows(table: str, raw: str, entity: str, key: str, staged: list[str]) -> str:
    """The staged columns as the staging tables have them, and the members of the raw object that feed none of them."""
    return f"""WITH {json_fields(table, raw, entity, staged)},
own AS (SELECT r, f AS t FROM {entity}_each WHERE f IN ({_list(staged)}) AND k IS NOT NULL),
alias AS (SELECT e.r, p.feeds AS t, min(e.f) AS f FROM {entity}_each e JOIN {entity}_fields p ON p.d = e.d AND p.f = e.f AND p.feeds <> p.f WHERE e.k IS NOT NULL AND (e.r, p.feeds) NOT IN (SELECT (r, t) FROM own) GROUP BY 1, 2),
took AS (SELECT r, t AS f FROM own UNION ALL SELECT r, f FROM alias),
kept AS (SELECT e.r, '{{' || string_agg(member, ',' ORDER BY i) || '}}' AS rescued FROM {entity}_each e LEFT JOIN took USING (r, f) WHERE took.f IS NULL GROUP BY 1)
SELECT s.{key}, s.source_database_id, {', '.join(f's.{c}' for c in staged)}, CASE WHEN j IS NULL AND {raw} IS NOT NULL THEN to_json({{'_malformed': {raw}}})::VARCHAR ELSE rescued END AS _rescued
FROM (SELECT *, row_number() OVER () AS r FROM {table}) s JOIN {entity}_rows USING (r) LEFT JOIN kept USING (r)"""


#: Spellings of a day with or without a clock, as kind, the groups that hold year, month and day, and the pattern of the day in RE2's spelling.
_DAYS = (
    ("t", "123", r"(\d{4})[-/.](\d\d?)[-/.](\d\d?)", r"(?:[Tt]|\s+)"),
    ("t", "321", r"(\d\d?)\.(\d\d?)\.(\d{4})", r",?(?:[Tt]|\s+)"),
    ("n", "321", r"(\d\d?)[-/](\d\d?)[-/](\d{4})", r",?(?:[Tt]|\s+)"),
    ("t", "321", r"(?:\p{L}{3,10}\.?,?\s+)?(\d\d?)(?:\.\s*|\s+|-)(\p{L}{3,10})\.?(?:\s+|-)(\d{4})", r",?\s+"),
    ("t", "312", r"(\p{L}{3,10})\.?\s+(\d\d?),?\s+(\d{4})", r",?\s+"),
)
_CLOCK = r"(\d\d?):(\d\d)(?::(\d\d)(?:[.,](\d+))?)?(?:\s*([AaPp])\.?[Mm]\.?)?"
_PLACE = r"(?:\s*(Z|z|[+-]\d\d:?\d\d(?::?\d\d)?|[+-]\d\d?|(?:UTC|GMT)[+-]\d\d?(?::?\d\d)?|[A-Z]{2,5}))?(?:\[[^\]]*\])?"
_MONTH_WORDS = "january jan januar januari jänner|february feb februar februari|march mar märz mär mrz maart mrt|april apr|may mai mei|june jun juni|july jul juli|august aug augustus|september sep sept|october oct oktober okt|november nov|december dec dezember dez"
_SUMMER = "^(?:[A-Z]*DT|CEST|EEST|WEST|MEST|BST)$"


def timestamps(fields: tuple[str, ...] = ("upload_date", "download_date")) -> str:
    """Spellings tried in order; zones and clock changes by the database's own calendar."""
    names = ("kind", "y", "mo", "d", "h", "mi", "s", "us", "half", "zone")

    def case(pattern: str, *parts: str) -> str:
        said = [f"regexp_extract(v, '{pattern}', {p})" if p.isdigit() else f"'{p}'" for p in parts]
        return f" WHEN regexp_matches(v, '{pattern}') THEN {{{', '.join(f'{chr(39)}{n}{chr(39)}: {x}' for n, x in zip(names, said))}}}"

    cases = case(r"^(\d{9,10}|\d{12,13}|\d{15,16}|\d{18,19})$", "e", "1", *[""] * 8)
    cases += case(rf"^(\d{{4}})(\d\d)(\d\d)(?:[Tt ]?(\d\d)(\d\d)(\d\d)?(?:[.,](\d+))?{_PLACE})?$", "t", "1", "2", "3", "4", "5", "6", "7", "", "8")
    for kind, order, day, gap in _DAYS:
        cases += case(f"^{day}(?:{gap}{_CLOCK}{_PLACE})?$", kind, *order, "4", "5", "6", "7", "8", "9")
    months = [m.split() for m in _MONTH_WORDS.split("|")]
    month = "coalesce(try_cast(mo AS INT), CASE " + " ".join(f"WHEN lower(mo) IN ({_list(forms)}) THEN {i + 1}" for i, forms in enumerate(months)) + " END)"
    number = lambda c: f"coalesce(try_cast(nullif({c}, '') AS BIGINT), 0)"
    values = " UNION ALL ".join(f"SELECT project_uid, source_database_id, '{f}' AS field_name, regexp_replace({f}, '^[\\s\\p{{Z}}\\x{{200b}}\\x{{feff}}]+|[\\s\\p{{Z}}\\x{{200b}}\\x{{feff}}]+$', '', 'g') AS v FROM stg_projects WHERE {f} IS NOT NULL AND project_uid IS NOT NULL" for f in fields)
    return f"""
WITH vals AS ({values}),
cut AS (SELECT * EXCLUDE (x), unnest(x) FROM (SELECT *, CASE{cases} END AS x FROM vals) WHERE x IS NOT NULL),
told AS (
  SELECT c.* REPLACE (CASE WHEN kind = 'n' AND k.numeric_date_order = 'MDY' THEN d ELSE mo END AS mo, CASE WHEN kind = 'n' AND k.numeric_date_order = 'MDY' THEN mo ELSE d END AS d, upper(zone) AS zone), k.time_zone AS tz
  FROM cut c LEFT JOIN source_clocks k USING (source_database_id) WHERE kind <> 'n' OR k.numeric_date_order IN ('MDY', 'DMY')),
dated AS (
  SELECT *, CASE WHEN half = '' THEN {number('h')} WHEN {number('h')} BETWEEN 1 AND 12 THEN {number('h')} % 12 + CASE WHEN lower(half) = 'p' THEN 12 ELSE 0 END END AS hh,
    try_cast(printf('%04d-%02d-%02d', try_cast(y AS INT), {month}, try_cast(d AS INT)) AS TIMESTAMP) AS day FROM told),
local AS (
  SELECT *, CASE WHEN hh <= 23 AND {number('mi')} <= 59 AND {number('s')} <= 59 THEN day + to_microseconds(((hh * 60 + {number('mi')}) * 60 + {number('s')}) * 1000000 + {number("rpad(left(us, 6), 6, '0')")}) END AS t FROM dated),
placed AS (
  SELECT *, timezone(tz, t) AS late, nullif(regexp_extract(zone, '([+-][0-9]{{1,2}}):?([0-9]{{2}})?$', 1), '') AS oh, nullif(regexp_extract(zone, '[+-][0-9]{{1,2}}:?([0-9]{{2}})$', 1), '') AS om,
    epoch_us(t) AS us0, epoch_us(timezone(tz, make_timestamp(year(t), 1, 15, 0, 0, 0.0))) - epoch_us(make_timestamp(year(t), 1, 15, 0, 0, 0.0)) AS w, epoch_us(timezone(tz, make_timestamp(year(t), 7, 15, 0, 0, 0.0))) - epoch_us(make_timestamp(year(t), 7, 15, 0, 0, 0.0)) AS u FROM local)
SELECT DISTINCT project_uid, field_name, CASE
    WHEN kind = 'e' THEN CASE WHEN length(y) <= 10 THEN y::BIGINT * 1000000 WHEN length(y) <= 13 THEN y::BIGINT * 1000 WHEN length(y) <= 16 THEN y::BIGINT ELSE y::BIGINT // 1000 END
    WHEN zone = '' THEN epoch_us(CASE WHEN timezone(tz, late - INTERVAL 1 HOUR) = t THEN late - INTERVAL 1 HOUR ELSE late END)
    WHEN zone IN ('Z', 'UTC', 'GMT', 'UT') THEN us0
    WHEN oh IS NOT NULL THEN us0 - (abs(oh::BIGINT) * 60 + coalesce(om::BIGINT, 0)) * 60000000 * CASE WHEN oh LIKE '-%' THEN -1 ELSE 1 END
    WHEN regexp_matches(zone, '{_SUMMER}') THEN us0 + least(w, u) ELSE us0 + greatest(w, u) END AS utc_us
FROM placed WHERE utc_us IS NOT NULL"""


DRIFT = f"""WITH {json_fields("stg_projects", "raw_project_json", "project", PROJECT_COLUMNS)}, {json_fields("stg_files", "raw_file_json", "file", FILE_COLUMNS)},
named AS (
  SELECT source_database_id AS d, lower(trim(unnest(string_split(source_schema_signature, '|')))) AS f, NULL AS feeds FROM source_databases
  UNION ALL SELECT DISTINCT source_database_id, lower(trim(source_table_name)), 'project' FROM stg_projects UNION ALL SELECT DISTINCT source_database_id, lower(trim(source_table_name)), 'file' FROM stg_files),
profile AS MATERIALIZED (
  SELECT * FROM project_fields UNION ALL SELECT * FROM file_fields
  UNION ALL SELECT 'table', d, f, []::VARCHAR[], max(feeds) FROM named WHERE f <> '' AND d IS NOT NULL GROUP BY d, f),
steps AS MATERIALIZED (SELECT lag(source_database_id) OVER (PARTITION BY source_student_id ORDER BY registered_at_utc, source_database_id) AS d0, source_database_id AS d1 FROM source_databases WHERE source_student_id IS NOT NULL),
pairs AS MATERIALIZED (SELECT DISTINCT s.d0, s.d1, a.entity FROM steps s JOIN profile a ON a.d = s.d0 JOIN profile b ON b.d = s.d1 AND b.entity = a.entity),
gone AS MATERIALIZED (SELECT p.d1, a.*, row_number() OVER (PARTITION BY p.d1, a.entity, a.feeds ORDER BY a.f) AS nth FROM pairs p JOIN profile a ON a.d = p.d0 AND a.entity = p.entity WHERE NOT EXISTS (SELECT 1 FROM profile b WHERE b.d = p.d1 AND b.entity = a.entity AND b.f = a.f)),
come AS MATERIALIZED (SELECT p.d1, b.*, row_number() OVER (PARTITION BY p.d1, b.entity, b.feeds ORDER BY b.f) AS nth FROM pairs p JOIN profile b ON b.d = p.d1 AND b.entity = p.entity WHERE NOT EXISTS (SELECT 1 FROM profile a WHERE a.d = p.d0 AND a.entity = b.entity AND a.f = b.f)),
moved AS MATERIALIZED (SELECT g.d1, g.entity, g.f AS f0, c.f AS f1 FROM gone g JOIN come c ON c.d1 = g.d1 AND c.entity = g.entity AND c.feeds = g.feeds AND c.nth = g.nth)
SELECT d1 AS source_database_id, entity, 'renamed' AS change_kind, f0 AS field_before, f1 AS field_after FROM moved
UNION ALL SELECT d1, entity, 'removed', f, '' FROM gone g WHERE NOT EXISTS (SELECT 1 FROM moved m WHERE m.d1 = g.d1 AND m.entity = g.entity AND m.f0 = g.f)
UNION ALL SELECT d1, entity, 'added', '', f FROM come c WHERE NOT EXISTS (SELECT 1 FROM moved m WHERE m.d1 = c.d1 AND m.entity = c.entity AND m.f1 = c.f)
UNION ALL SELECT p.d1, a.entity, 'type_changed', a.f, a.f FROM pairs p JOIN profile a ON a.d = p.d0 AND a.entity = p.entity JOIN profile b ON b.d = p.d1 AND b.entity = a.entity AND b.f = a.f WHERE len(a.types) > 0 AND len(b.types) > 0 AND a.types <> b.types"""

ORACLES: dict[str, str] = {
    "p2_found": timestamps(),
    "p4_found": DRIFT,
    "p4_projects": consistent_rows("stg_projects", "raw_project_json", "project", "project_uid", PROJECT_COLUMNS),
    "p4_files": consistent_rows("stg_files", "raw_file_json", "file", "file_uid", FILE_COLUMNS),
    "s_staged_projects": "SELECT project_uid, " + ", ".join(f"nullif({strip(c)}, '') AS {c}" for c in ("title", "language", "doi", "project_url", "upload_date")) + " FROM stg_projects",
    "s_staged_files": f"SELECT file_uid, nullif({strip('file_name')}, '') AS file_name, nullif({strip('file_type')}, '') AS file_type, file_size_bytes AS size_bytes FROM stg_files",
    "s_schema_signatures": "SELECT array_to_string(list_sort(list_transform(string_split(source_schema_signature, '|'), lambda t: lower(trim(t)))), '|') AS signature, count(*) AS databases FROM source_databases GROUP BY 1",
    "j_reference_issues": f"""
WITH f AS (SELECT source_database_id, nullif({strip('source_file_id')}, '') AS fid, nullif({strip('project_uid')}, '') AS pid, project_uid FROM stg_files),
i AS (
  SELECT source_database_id, 'MISSING_SOURCE_ID' AS issue_code, 'ERROR' AS severity FROM f WHERE fid IS NULL
  UNION ALL SELECT source_database_id, 'MISSING_PROJECT_REFERENCE', 'WARNING' FROM f WHERE pid IS NULL
  UNION ALL SELECT source_database_id, 'ORPHAN_PROJECT_REFERENCE', 'WARNING' FROM f WHERE pid IS NOT NULL AND project_uid NOT IN (SELECT project_uid FROM stg_projects WHERE project_uid IS NOT NULL))
SELECT source_database_id, issue_code, severity, count(*) AS issues FROM i GROUP BY ALL""",
    "a_import_audit": """
WITH p AS (SELECT source_database_id, count(*) AS project_rows, count(DISTINCT project_uid) AS project_keys FROM stg_projects GROUP BY 1),
f AS (SELECT source_database_id, count(*) AS file_rows, count(DISTINCT file_uid) AS file_keys FROM stg_files GROUP BY 1)
SELECT source_database_id, coalesce(project_rows, 0) AS project_rows, coalesce(project_keys, 0) AS project_keys, coalesce(file_rows, 0) AS file_rows, coalesce(file_keys, 0) AS file_keys,
  CASE WHEN coalesce(project_rows, 0) > coalesce(project_keys, 0) THEN 'FAILED' ELSE 'COMPLETED' END AS import_status
FROM source_databases LEFT JOIN p USING (source_database_id) LEFT JOIN f USING (source_database_id)""",
    "u_repeated_files": "SELECT file_uid, count(*) AS copies FROM stg_files GROUP BY 1 HAVING count(*) > 1",
    "j_project_file_counts": f"WITH {FILES} SELECT project_uid, coalesce(file_count, 0) AS file_count FROM stg_projects LEFT JOIN files USING (project_uid)",
    "a_source_profiles": f"WITH {PROFILES} SELECT * FROM profiles",
    "a_profile_categories": f"WITH {PROFILES} SELECT candidate_granularity, count(*) AS sources FROM profiles GROUP BY 1",
    "d_duplicate_clusters": f"WITH {CLUSTERS} SELECT * FROM clusters",
    "d_cluster_members": f"WITH {CANDIDATES} SELECT cluster_id, project_uid, source_student_id, repository_id, member_rank, CASE WHEN member_rank = 1 THEN 1 ELSE 0 END::BIGINT AS is_canonical FROM ranked",
    "d_cluster_sizes": f"WITH {CLUSTERS} SELECT raw_member_count, count(*) AS clusters FROM clusters GROUP BY 1",
    "d_resolution_decisions": f"WITH {DECISIONS} SELECT * EXCLUDE (cluster_id) FROM decided",
    "d_decision_tags": f"WITH {DECISIONS}, {TAGS} SELECT tag, count(*) AS projects FROM tags GROUP BY 1",
    "d_scope_summary": f"""WITH {DECISIONS}
SELECT s AS source_scope, count(project_uid) AS raw_projects, count(cluster_id) AS candidate_cluster_members, count(DISTINCT cluster_id) AS candidate_clusters_touching_scope,
  count(*) FILTER (decision = 'EXCLUDED_FROM_DEDUPLICATED_ANALYSIS') AS excluded_duplicates, count(project_uid) - count(*) FILTER (decision = 'EXCLUDED_FROM_DEDUPLICATED_ANALYSIS') AS deduplicated_projects
FROM (VALUES ('MY_CORE'), ('PEER_SHARED')) v(s) LEFT JOIN decided ON source_scope = s GROUP BY 1""",
    "o_latest_run": "SELECT * FROM deduplication_runs ORDER BY created_at_utc DESC NULLS LAST, run_id DESC LIMIT 1",
    "a_latest_run_summary": """
WITH l AS (SELECT run_id FROM deduplication_runs ORDER BY created_at_utc DESC NULLS LAST, run_id DESC LIMIT 1)
SELECT source_scope, decision, evidence_rule, count(*) AS decisions, sum(CASE WHEN decision = 'EXCLUDED_FROM_DEDUPLICATED_ANALYSIS' THEN 1 ELSE 0 END)::BIGINT AS excluded
FROM (SELECT DISTINCT ON (decision_id) * FROM deduplication_decisions WHERE run_id IN (SELECT run_id FROM l)) GROUP BY ALL""",
    "q_dedup_gate": f"""WITH {DECISIONS}, {TAGS},
m AS (SELECT (SELECT count(DISTINCT project_uid) FROM stg_projects) AS raw, count(*) AS decisions, count(DISTINCT project_uid) AS decided, count(*) FILTER (decision = 'EXCLUDED_FROM_DEDUPLICATED_ANALYSIS') AS excluded,
  count(*) FILTER (decision <> 'EXCLUDED_FROM_DEDUPLICATED_ANALYSIS') AS included, count(*) FILTER (decision = 'EXCLUDED_FROM_DEDUPLICATED_ANALYSIS' AND source_scope = 'MY_CORE') AS core_excluded,
  count(*) FILTER (decision = 'EXCLUDED_FROM_DEDUPLICATED_ANALYSIS' AND project_uid = canonical_project_uid) AS canonical_excluded,
  count(*) FILTER (decision = 'EXCLUDED_FROM_DEDUPLICATED_ANALYSIS' AND canonical_project_uid NOT IN (SELECT project_uid FROM decided WHERE decision = 'CANONICAL_RECORD')) AS without_canonical,
  count(*) FILTER (project_uid NOT IN (SELECT project_uid FROM tags)) AS untagged FROM decided),
c AS (SELECT unnest([
  {{'name': 'decision_coverage', 'e': raw, 'o': decisions}}, {{'name': 'one_decision_per_project', 'e': decisions, 'o': decided}}, {{'name': 'count_conservation', 'e': raw - excluded, 'o': included}},
  {{'name': 'excluded_records_have_canonical_replacement', 'e': 0, 'o': without_canonical}}, {{'name': 'canonical_records_not_excluded', 'e': 0, 'o': canonical_excluded}},
  {{'name': 'tag_coverage', 'e': 0, 'o': untagged}}, {{'name': 'core_scope_untouched', 'e': 0, 'o': core_excluded}}]) AS x FROM m)
SELECT x.name AS name, x.e = x.o AS passed, 'error' AS severity, x.e::VARCHAR AS expected, x.o::VARCHAR AS observed FROM c""",
    "c_project_types": f"WITH {TYPES} SELECT * FROM types",
    "c_type_and_rule_counts": f"WITH {TYPES} SELECT project_type, classification_rule, count(*) AS projects FROM types GROUP BY ALL",
    "c_evidence_audit": f"""WITH {EVIDENCE},
x AS (SELECT *, ambiguous AND term AND NOT high AS contextual FROM hit), y AS (SELECT *, NOT high AND NOT contextual AS rest FROM x)
SELECT unnest(['strong', 'contextual', 'ambiguous_unconfirmed', 'primary_data', 'other_files', 'no_files', 'all']) AS bucket,
  unnest([count(*) FILTER (high), count(*) FILTER (contextual), count(*) FILTER (rest AND ambiguous), count(*) FILTER (rest AND prim), count(*) FILTER (rest AND NOT prim AND file_record_count > 0), count(*) FILTER (file_record_count = 0), count(*)]) AS projects FROM y""",
    "c_project_term_classes": "SELECT * FROM " + term_classes("stg_projects", "project_uid", "concat_ws(chr(10), title, description)", LEGAL, RESEARCH, False),
    "c_document_classes": f"""
SELECT d.doc_id AS file_key, d.project_uid, coalesce(o.division, p.division) AS division, CASE WHEN o.division IS NOT NULL THEN o.rule ELSE 'PROJECT_CONTEXT_FALLBACK' END AS rule,
  CASE WHEN o.division IS NOT NULL THEN o.confidence ELSE least(p.confidence, 0.78::DOUBLE) END AS confidence
FROM documents d LEFT JOIN {term_classes('documents', 'doc_id', 'text', LEGAL, RESEARCH, True)} o USING (doc_id)
LEFT JOIN {term_classes('stg_projects', 'project_uid', 'concat_ws(chr(10), title, description)', LEGAL, RESEARCH, False)} p ON d.project_uid = p.project_uid
WHERE coalesce(o.division, p.division) IS NOT NULL""",
    "a_extension_histogram": f"SELECT extension, count(*) AS files FROM (SELECT DISTINCT file_uid, coalesce(nullif({extension('file_name')}, ''), '[no extension]') AS extension FROM stg_files) GROUP BY 1",
    "x_text_functions": f"""
SELECT project_uid, {doi_key('doi')} AS doi_key, {title_key('title')} AS title_key, {file_like('title')} AS file_like,
  regexp_replace(nullif({strip('source_project_id')}, ''), '^(\\d+)\\.0$', '\\1') AS clean_id, trunc(try_cast({strip('version')} AS DOUBLE))::BIGINT AS version_number, try_cast(nullif(regexp_extract(upload_date, '^\\d{{4}}'), '') AS INT) AS upload_year,
  nullif({strip('description')}, '') IS NULL AS blank_description FROM stg_projects""",
    "x_url_functions": f"""
SELECT DISTINCT file_uid, lower(regexp_replace(trim(file_url), '/+$', '')) AS ledger_url, coalesce(nullif(regexp_extract(regexp_replace(file_url, '(?s)\\?.*$', ''), '([^/]*)$', 1), ''), 'main.qda') AS url_name,
  coalesce(contains(lower(file_url), 'download') OR contains(lower(file_url), 'type=file') OR contains(lower(file_url), 'format=original') OR {' OR '.join(f"lower(file_url) LIKE '%{e}'" for e in ENDINGS)}, false) AS download,
  {PROVIDER('local_path')} AS provider, {extension('file_name')} AS extension FROM stg_files""",
    "a_url_providers": f"SELECT {PROVIDER('place')} AS provider, count(*) AS places FROM (SELECT trim(unnest(string_split(project_url, ';'))) AS place FROM stg_projects) WHERE place <> '' GROUP BY 1",
    "l_export_rows": f"WITH {FILES}, {TYPES} SELECT project_uid, repository_id, title, project_type, coalesce(file_count, 0) AS file_count, coalesce(file_count, 0) AS no_project_files FROM stg_projects LEFT JOIN types USING (project_uid) LEFT JOIN files USING (project_uid)",
    "l_repository_summary": f"""WITH {FILES}, {TYPES},
g AS (SELECT coalesce(repository_id, '') AS repository_id, project_type, count(*) AS projects, sum(coalesce(file_count, 0))::BIGINT AS files FROM stg_projects LEFT JOIN types USING (project_uid) LEFT JOIN files USING (project_uid) GROUP BY 1, 2)
SELECT *, row_number() OVER (PARTITION BY repository_id ORDER BY projects DESC, project_type) AS place FROM g""",
    "l_staging_statistics": "SELECT source_scope, count(*) AS registered_databases, coalesce(sum(n), 0)::BIGINT AS staged_projects FROM source_databases LEFT JOIN (SELECT source_database_id, count(*) AS n FROM stg_projects GROUP BY 1) USING (source_database_id) GROUP BY 1",
    "l_delivery_projects": f"""WITH {TYPES},
one AS (SELECT project_uid, arg_min(primary_division_code, (classified_at_utc, primary_division_code)) AS primary_division_code FROM isic_project_classifications GROUP BY 1)
SELECT p.project_uid, try_cast(repository_id AS INT) AS repository_id, coalesce(title, 'Untitled project') AS title, project_type, primary_division_code,
  row_number() OVER (ORDER BY try_cast(repository_id AS INT), p.project_uid) AS id
FROM stg_projects p JOIN types USING (project_uid) LEFT JOIN one USING (project_uid) WHERE try_cast(repository_id AS INT) IN (5, 15)""",
    "q_release_distribution": f"""WITH {TYPES},
o AS (SELECT concat_ws('|', coalesce(repository_id, ''), coalesce(project_type, '')) AS key, count(*) AS value FROM stg_projects JOIN types USING (project_uid) GROUP BY 1),
e AS (SELECT concat_ws('|', coalesce(repository_id, ''), coalesce(upstream_project_type, '')) AS key, count(*) AS value FROM stg_projects GROUP BY 1)
SELECT 'project_types:' || key AS name, e.value IS NOT DISTINCT FROM o.value AS passed, 'error' AS severity, e.value::VARCHAR AS expected, o.value::VARCHAR AS observed FROM o FULL JOIN e USING (key)""",
    "l_migrated_projects": f"WITH {LEDGER} SELECT repository_id, repository_url, download_repository_folder, download_method, count(*) AS projects, count(DISTINCT doi) AS dois, count(DISTINCT download_project_folder) AS folders FROM migrated GROUP BY ALL",
    "l_migrated_files": f"""WITH {LEDGER},
told AS (
  SELECT coalesce(lower(nullif(regexp_replace(l.file_type, '^ +$', ''), '')), nullif(lower(regexp_extract(l.file_name, '(?s)^[^.]*\\.(.*)$', 1)), ''), 'unknown') AS file_type,
    CASE WHEN regexp_matches(l.status, '(?i)^(ok|succeeded)$') THEN 'SUCCEEDED' WHEN regexp_matches(l.status, '(?i)login') THEN 'FAILED_LOGIN_REQUIRED' WHEN regexp_matches(l.status, '(?i)large') THEN 'FAILED_TOO_LARGE' ELSE 'FAILED_SERVER_UNRESPONSIVE' END AS status
  FROM ledger l JOIN migrated m ON m.project_url = l.url)
SELECT file_type, status, count(*) AS files FROM told GROUP BY ALL""",
    "q_run_gate": f"""WITH {DECISIONS},
n AS (SELECT (SELECT count(DISTINCT project_uid) FROM stg_projects) AS staged, count(*) AS decisions, count(*) FILTER (decision <> 'EXCLUDED_FROM_DEDUPLICATED_ANALYSIS') AS included, count(DISTINCT project_uid) FILTER (decision <> 'EXCLUDED_FROM_DEDUPLICATED_ANALYSIS') AS analysis FROM decided),
c AS (SELECT unnest([
  {{'name': 'latest_run_present', 'e': 1, 'o': (SELECT least(count(*), 1) FROM deduplication_runs)}}, {{'name': 'raw_project_count_matches_staging', 'e': staged, 'o': decisions}}, {{'name': 'decision_coverage', 'e': staged, 'o': decisions}},
  {{'name': 'deduplicated_analysis_coverage', 'e': included, 'o': analysis}}, {{'name': 'included_match_run', 'e': included, 'o': included}}, {{'name': 'excluded_match_run', 'e': decisions - included, 'o': decisions - included}},
  {{'name': 'audit_coverage', 'e': 0, 'o': 0}}, {{'name': 'tag_coverage', 'e': 0, 'o': 0}}]) AS x FROM n)
SELECT x.name AS name, x.e = x.o AS passed, 'error' AS severity, x.e::VARCHAR AS expected, x.o::VARCHAR AS observed FROM c""",
    "q_foreign_keys": " UNION ALL ".join(
        f"SELECT '{c}' AS child, '{k}' AS \"column\", '{p}' AS parent, count(*) AS orphans FROM {c} WHERE {k} IS NOT NULL AND {k}::VARCHAR NOT IN (SELECT {k}::VARCHAR FROM {p} WHERE {k} IS NOT NULL)"
        for c, k, p in (
            ("stg_projects", "source_database_id", "source_databases"), ("stg_files", "source_database_id", "source_databases"), ("stg_files", "project_uid", "stg_projects"), ("duplicate_cluster_members", "project_uid", "stg_projects"),
            ("deduplication_decisions", "project_uid", "stg_projects"), ("deduplication_decisions", "run_id", "deduplication_runs"), ("isic_project_classifications", "project_uid", "stg_projects"), ("documents", "project_uid", "stg_projects"),
        )
    ),
    "m_run_scopes": "SELECT run_id, source_scope, count(*) AS decisions, count(*) FILTER (decision = 'EXCLUDED_FROM_DEDUPLICATED_ANALYSIS') AS excluded FROM (SELECT DISTINCT ON (decision_id) * FROM deduplication_decisions) JOIN (SELECT run_id FROM deduplication_runs) USING (run_id) GROUP BY ALL",
    "m_run_drift": """WITH d AS (SELECT run_id, project_uid, canonical_project_uid, decision, evidence_rule, canonical_score, count(*) AS n FROM (SELECT DISTINCT ON (decision_id) * FROM deduplication_decisions) GROUP BY ALL),
r AS (SELECT run_id, resolution_version, lag(run_id) OVER w AS b, lag(resolution_version) OVER w AS v FROM deduplication_runs WINDOW w AS (ORDER BY created_at_utc, run_id))
SELECT run_id, b AS previous_run_id, CASE WHEN b IS NULL THEN 'BASELINE_CREATED' WHEN resolution_version IS DISTINCT FROM v THEN 'RESOLUTION_VERSION_CHANGED'
  WHEN EXISTS (SELECT * EXCLUDE (run_id) FROM d WHERE d.run_id = r.run_id EXCEPT SELECT * EXCLUDE (run_id) FROM d WHERE d.run_id = r.b) OR EXISTS (SELECT * EXCLUDE (run_id) FROM d WHERE d.run_id = r.b EXCEPT SELECT * EXCLUDE (run_id) FROM d WHERE d.run_id = r.run_id) THEN 'DECISIONS_CHANGED' ELSE 'UNCHANGED' END AS status FROM r""",
    "a_import_totals": """WITH p AS (SELECT source_database_id, count(*) AS n, count(*) > count(DISTINCT project_uid) AS bad FROM stg_projects GROUP BY 1), f AS (SELECT source_database_id, count(*) AS n FROM stg_files GROUP BY 1)
SELECT source_scope, count(*) AS databases, count(*) FILTER (NOT coalesce(bad, false)) AS completed, coalesce(sum(p.n) FILTER (NOT coalesce(bad, false)), 0)::BIGINT AS projects, coalesce(sum(f.n) FILTER (NOT coalesce(bad, false)), 0)::BIGINT AS files
FROM source_databases LEFT JOIN p USING (source_database_id) LEFT JOIN f USING (source_database_id) GROUP BY 1""",
    **{
        f"s_{name}s": f"""WITH v AS (SELECT project_uid, json_extract(raw_project_json, '$.{field}') AS x FROM stg_projects WHERE project_uid IS NOT NULL AND json_valid(raw_project_json)),
e AS (SELECT project_uid, unnest(CASE json_type(x) WHEN 'ARRAY' THEN json_extract_string(x, '$[*]') WHEN 'OBJECT' THEN [coalesce(json_extract_string(x, '$.id'), json_extract_string(x, '$.name'))] WHEN 'VARCHAR' THEN string_split(x ->> '$', ';') ELSE [x ->> '$'] END) AS t FROM v)
SELECT DISTINCT project_uid, {strip('t')} AS {name} FROM e WHERE {strip('t')} <> ''"""
        for name, field in (("keyword", "keywords"), ("license", "license"), ("person", "creators"))
    },
    "s_file_class_ids": "SELECT DISTINCT file_uid, 'isic-file:' || sha256(coalesce(project_uid, '') || '|STAGED|' || coalesce(local_path, '')) AS file_class_id FROM stg_files",
    "l_delivery_files": f"""WITH p AS (SELECT project_uid, row_number() OVER (ORDER BY try_cast(repository_id AS INT), project_uid) AS project_id FROM stg_projects WHERE try_cast(repository_id AS INT) IN (5, 15)),
f AS (SELECT DISTINCT project_id, file_uid, file_name, file_type, status, {extension('file_name')} IN ({_list(V.PRIMARY_EXTENSIONS)}) AS is_primary FROM stg_files JOIN p USING (project_uid) WHERE file_uid IS NOT NULL)
SELECT *, row_number() OVER (ORDER BY project_id, file_uid) AS id FROM f""",
    "l_delivery_types": f"WITH {TYPES}, p AS (SELECT project_uid, row_number() OVER (ORDER BY try_cast(repository_id AS INT), project_uid) AS project_id FROM stg_projects WHERE try_cast(repository_id AS INT) IN (5, 15)) SELECT project_id, project_type, classification_rule FROM p JOIN types USING (project_uid)",
    "l_delivery_isic": """WITH p AS (SELECT project_uid, row_number() OVER (ORDER BY try_cast(repository_id AS INT), project_uid) AS project_id FROM stg_projects WHERE try_cast(repository_id AS INT) IN (5, 15)),
c AS (SELECT project_id, primary_section_code, primary_division_code, secondary_division_code, row_number() OVER (PARTITION BY project_id ORDER BY classified_at_utc NULLS FIRST, primary_division_code NULLS FIRST, primary_section_code NULLS FIRST, secondary_division_code NULLS FIRST) AS r FROM isic_project_classifications JOIN p USING (project_uid))
SELECT * EXCLUDE (r) FROM c WHERE r = 1""",
    "q_delivery_gate": f"""WITH p AS (SELECT project_uid FROM stg_projects WHERE try_cast(repository_id AS INT) IN (5, 15)),
f AS (SELECT DISTINCT file_uid, {extension('file_name')} IN ({_list(V.PRIMARY_EXTENSIONS)}) AS prim FROM stg_files JOIN p USING (project_uid) WHERE file_uid IS NOT NULL),
n AS (SELECT (SELECT count(*) FROM p) AS projects, (SELECT count(*) FROM p WHERE project_uid NOT IN (SELECT project_uid FROM isic_project_classifications WHERE primary_division_code IS NOT NULL AND project_uid IS NOT NULL)) AS unclassified, (SELECT count(*) FROM f) AS files, (SELECT count(*) FILTER (prim) FROM f) AS prim),
c AS (SELECT unnest([{{'name': 'official_project_count', 'e': projects, 'o': projects}}, {{'name': 'repository_scope', 'e': 0, 'o': 0}}, {{'name': 'project_ids_unique', 'e': projects, 'o': projects}}, {{'name': 'types_complete', 'e': projects, 'o': projects}},
  {{'name': 'classification_coverage', 'e': 0, 'o': unclassified}}, {{'name': 'file_ids_unique', 'e': files, 'o': files}}, {{'name': 'orphan_file_records', 'e': 0, 'o': 0}}, {{'name': 'primary_file_coverage', 'e': files, 'o': prim}}]) AS x FROM n)
SELECT x.name AS name, x.e = x.o AS passed, 'error' AS severity, x.e::VARCHAR AS expected, x.o::VARCHAR AS observed FROM c""",
    "q_isic_distribution": """WITH p AS (SELECT project_uid FROM stg_projects WHERE try_cast(repository_id AS INT) IN (5, 15)),
c AS (SELECT project_uid, primary_division_code AS d, row_number() OVER (PARTITION BY project_uid ORDER BY classified_at_utc NULLS FIRST, primary_division_code NULLS FIRST) AS r FROM isic_project_classifications JOIN p USING (project_uid)),
o AS (SELECT coalesce(d, 'none') AS key, count(*) AS value FROM c WHERE r = 1 GROUP BY 1), e AS (SELECT coalesce(d, 'none') AS key, count(*) AS value FROM (SELECT DISTINCT project_uid, d FROM c) GROUP BY 1)
SELECT 'isic_divisions:' || key AS name, e.value IS NOT DISTINCT FROM o.value AS passed, 'error' AS severity, e.value::VARCHAR AS expected, o.value::VARCHAR AS observed FROM o FULL JOIN e USING (key)""",
    "l_headline": f"""WITH {TYPES}, f AS (SELECT DISTINCT file_uid, file_name FROM stg_files)
SELECT 'databases' AS metric, count(*) AS value FROM source_databases UNION ALL SELECT 'contributors', count(DISTINCT source_student_id) FROM source_databases UNION ALL SELECT 'scopes', count(DISTINCT source_scope) FROM source_databases
UNION ALL SELECT 'projects', count(DISTINCT project_uid) FROM stg_projects UNION ALL SELECT 'classified_projects', count(DISTINCT project_uid) FROM isic_project_classifications
UNION ALL SELECT 'files', count(*) FROM f UNION ALL SELECT 'primary_files', count(*) FILTER ({extension('file_name')} IN ({_list(V.PRIMARY_EXTENSIONS)})) FROM f UNION ALL SELECT 'type:' || project_type, count(*) FROM types GROUP BY 1""",
    "c_unconfirmed_extensions": f"WITH {EVIDENCE}, u AS (SELECT project_uid FROM hit WHERE ambiguous AND NOT high AND NOT term) SELECT ext AS extension, count(DISTINCT project_uid) AS projects FROM each_file JOIN u USING (project_uid) WHERE ext IN ({_list(V.AMBIGUOUS_EXTENSIONS)}) GROUP BY 1",
    "c_unconfirmed_sample": f"""WITH {EVIDENCE}, u AS (SELECT project_uid FROM hit WHERE ambiguous AND NOT high AND NOT term),
x AS (SELECT project_uid, array_to_string(list_sort(list(DISTINCT ext)), '|') AS extensions FROM each_file WHERE ext IN ({_list(V.AMBIGUOUS_EXTENSIONS)}) GROUP BY 1)
SELECT project_uid, p.title, x.extensions, f.names AS ambiguous_names FROM u JOIN stg_projects p USING (project_uid) JOIN x USING (project_uid) JOIN facts f USING (project_uid) ORDER BY project_uid LIMIT 100""",
    "c_division_counts": "SELECT division, count(*) AS projects FROM " + term_classes("stg_projects", "project_uid", "concat_ws(chr(10), title, description)", LEGAL, RESEARCH, False) + " GROUP BY 1",
}
ORACLES["c_file_rule_counts"] = f"""SELECT source_scope, division, count(*) FILTER (rule <> 'PROJECT_CONTEXT_FALLBACK') AS direct, count(*) FILTER (rule = 'PROJECT_CONTEXT_FALLBACK') AS fallback
FROM ({ORACLES['c_document_classes']}) JOIN stg_projects USING (project_uid) JOIN source_databases USING (source_database_id) GROUP BY ALL"""

_METADATA = ("description", "doi", "language", "project_url", "repository_id", "repository_url", "title")
_OLD_TYPES = TYPES.replace("stg_files", "old_files").replace("stg_projects", "old_projects")
ORACLES["m_project_fingerprints"] = f"""WITH {TYPES}
SELECT project_uid, sha256(to_json({{{', '.join(f"'{c}': p.{c}" for c in _METADATA)}}})::VARCHAR) AS metadata_sha256, sha256(to_json({{'classification_rule': t.classification_rule, 'project_type': t.project_type}})::VARCHAR) AS classification_sha256
FROM stg_projects p JOIN types t USING (project_uid)"""
ORACLES["m_project_drift"] = f"""WITH last AS (SELECT arg_max(source_database_id, (registered_at_utc, source_database_id)) AS d FROM source_databases GROUP BY source_student_id),
old_projects AS (SELECT * REPLACE ({strip('title')} AS title) FROM stg_projects WHERE source_database_id IN (SELECT source_database_id FROM source_databases) AND source_database_id NOT IN (SELECT d FROM last)),
old_files AS (SELECT * FROM stg_files WHERE source_database_id IN (SELECT source_database_id FROM source_databases) AND source_database_id NOT IN (SELECT d FROM last)),
types_now AS (WITH {TYPES} SELECT * FROM types), types_old AS (WITH {_OLD_TYPES} SELECT * FROM types),
x AS (SELECT n.project_uid, o.project_uid IS NOT NULL AS known, p.title IS DISTINCT FROM q.title AS meta, (n.project_type, n.classification_rule) IS DISTINCT FROM (o.project_type, o.classification_rule) AS class
  FROM types_now n JOIN stg_projects p USING (project_uid) LEFT JOIN types_old o USING (project_uid) LEFT JOIN old_projects q USING (project_uid)),
y AS (SELECT known AND meta AS reclassification_required, CASE WHEN NOT known THEN 'BASELINE_CREATED' WHEN meta AND class THEN 'METADATA_CHANGED|CLASSIFICATION_OUTPUT_CHANGED' WHEN meta THEN 'METADATA_CHANGED' WHEN class THEN 'CLASSIFICATION_OUTPUT_CHANGED' ELSE 'UNCHANGED' END AS reasons FROM x)
SELECT CASE WHEN reclassification_required THEN 'RECLASSIFICATION_REQUIRED' ELSE reasons END AS status, reclassification_required, reasons, count(*) AS projects FROM y GROUP BY ALL"""

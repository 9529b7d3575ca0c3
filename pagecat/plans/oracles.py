"""SQL that gives each query's rows straight from the base tables, without any page or parser."""

from __future__ import annotations

from pagecat import rules
from pagecat.schemas import BASE_FIELDS, ENRICHED_FIELDS, IMAGING_FIELDS, NEW_FIELDS

SITE = "https://catalog.example.com"
# White space as RE2 spells it.
WS = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def _with(*parts: str, query: str) -> str:
    return f"WITH {', '.join(parts)} {query}"


def _in(values: list[str]) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def _species(k: str) -> str:
    return f"CASE {k} % 3 WHEN 0 THEN 'Human' WHEN 1 THEN 'Mouse' ELSE 'Rat' END"


def _ffpe(k: str) -> str:
    return f"CASE {k} % 2 WHEN 0 THEN 'FFPE' ELSE 'Fresh Frozen' END"


def _size(b: str) -> str:
    return (
        f"CASE WHEN {b} >= 1000000000 THEN printf('%.2f GB', {b} / 1000000000.0::DOUBLE) "
        f"WHEN {b} >= 1000000 THEN printf('%.2f MB', {b} / 1000000.0::DOUBLE) "
        f"WHEN {b} >= 1000 THEN printf('%.2f KB', {b} / 1000.0::DOUBLE) ELSE {b} || ' B' END"
    )


def _label(text: str, label_rules, otherwise: str = "NULL") -> str:
    whens = " ".join(
        f"WHEN {' OR '.join(f'contains({text}, {_in([w])})' for w in words)} THEN '{label}'"
        for label, words in label_rules
    )
    return f"CASE {whens} ELSE {otherwise} END"


# ---- FX1 -------------------------------------------------------------------------------------

FX1 = f"""fx1 AS (
  SELECT p_partkey AS k, p_brand, p_type, p_name,
    CAST(p_partkey // 2000 AS VARCHAR) AS run,
    CAST((p_partkey // 50) % 40 AS INTEGER) AS page_num,
    CASE WHEN (p_partkey // 50) % 40 BETWEEN 20 AND 22
      THEN p_partkey - 50 * ((p_partkey // 50) % 40 - 19) ELSE p_partkey END AS j,
    CASE WHEN p_partkey % 97 = 0 THEN '' ELSE p_name || ' ' || p_partkey END AS name,
    CASE WHEN p_partkey % 10 <= 5 THEN 7 WHEN p_partkey % 10 = 6 THEN 5
      WHEN p_partkey % 10 = 7 THEN 6 WHEN p_partkey % 10 = 8 THEN 3 ELSE 1 END AS n_cells
  FROM part),
rows AS (
  SELECT *, '{SITE}/datasets/part-' || CASE WHEN j % 4 = 3 THEN j - 1 ELSE j END AS dataset_url,
    CAST(CASE WHEN page_num = 13 THEN 2 + k % 50 ELSE k % 50 END AS INTEGER) AS pos,
    page_num <> 13 AS in_table,
    {_species('k')} AS sp, {_ffpe('k')} AS pr,
    CASE k % 2 WHEN 0 THEN 'Cells' ELSE 'N/A' END AS ce
  FROM fx1)"""

FX1_FIELDS = """
    CASE WHEN NOT in_table OR n_cells = 3 THEN '' WHEN n_cells = 6 THEN 'Gene Expression ' || p_type
      ELSE 'Spatial ' || p_type END AS product,
    CASE WHEN in_table AND n_cells IN (5, 7) THEN sp ELSE '' END AS species,
    CASE WHEN in_table AND n_cells >= 5 THEN p_brand ELSE '' END AS sample_type,
    CASE WHEN in_table AND n_cells IN (6, 7) THEN ce ELSE '' END AS cells_or_nuclei,
    CASE WHEN in_table AND n_cells IN (5, 7) THEN pr ELSE '' END AS preservation"""

FX1_FIRST = f"""recs AS (
  SELECT run, page_num, pos, name AS dataset_name, dataset_url, {FX1_FIELDS}
  FROM rows WHERE name <> '' AND (n_cells >= 2 OR NOT in_table)
  QUALIFY row_number() OVER (PARTITION BY run, dataset_url ORDER BY page_num, pos) = 1)"""

FX1_COUNTS = """counts AS (
  SELECT p.run, p.page_num, count(r.dataset_url) AS new_records
  FROM (SELECT DISTINCT run, page_num FROM rows) p LEFT JOIN recs r USING (run, page_num)
  GROUP BY ALL)"""

# ---- FX2 -------------------------------------------------------------------------------------

ORD = f"""ord AS (
  SELECT *, o_orderkey AS k, o_orderkey % 37 <> 0 AS has_page,
    o_orderkey % 37 <> 0 AND o_orderkey % 29 <> 0 AND o_orderkey % 31 <> 0 AS has_doc,
    '{SITE}/datasets/o-' || o_orderkey AS dataset_url,
    strftime(o_orderdate, '%Y-%m-%d') AS day
  FROM orders)"""

ORD_RECORDS = f"""recs AS (
  SELECT k, 'Order ' || k AS dataset_name, dataset_url, 'Spatial ' || o_orderpriority AS product,
    {_species('o_custkey')} AS species,
    CASE WHEN o_custkey % 7 = 0 THEN '' ELSE o_orderstatus END AS sample_type,
    'N/A' AS cells_or_nuclei, {_ffpe('o_custkey')} AS preservation
  FROM ord)"""

_SAMPLE = {
    "anatomical_entity": "CASE WHEN o_custkey % 2 = 0 THEN o_orderpriority "
    "ELSE o_orderpriority || ', Second' END",
    "preservation_method": "CASE o_orderstatus WHEN 'O' THEN 'FFPE' WHEN 'F' THEN 'Fresh Frozen, FFPE' "
    "ELSE '' END",
    "disease_state": "CASE WHEN o_orderstatus = 'P' THEN 'Healthy' ELSE '' END",
    "biomaterial_type": "'Type ' || o_orderstatus",
    "donor_count": "CASE WHEN o_custkey % 5 = 0 THEN '' ELSE CAST(o_custkey % 5 AS VARCHAR) END",
    "date_published": "CASE WHEN k % 50 = 0 THEN 'unknown' ELSE day END",
}
_CAMERA = "CASE WHEN k % 2 = 0 THEN 'C' || o_custkey % 10 ELSE '' END"
_IMAGING = {
    "biomaterials": "'Tissue ' || o_orderpriority",
    "sample_preparation": "CASE WHEN k % 4 = 0 THEN '' ELSE 'Prep ' || o_orderstatus END",
    "image_type": "''",
    "microscope": "o_orderpriority || ': A'",
    "objective_magnification": "''",
    "numerical_aperture": "'LED'",
    "scopeled_light_source": "''",
    "camera": _CAMERA,
    "exposure": "CAST(o_custkey % 100 AS VARCHAR)",
}

FIELDS = (
    "fields AS (SELECT k, has_page, "
    + ", ".join(
        f"CASE WHEN has_doc THEN {value} ELSE '' END AS {name}"
        for name, value in (_IMAGING | _SAMPLE).items()
    )
    + " FROM ord)"
)

# Lines of the known sections: (pos, section, text).
LINES = """body AS (
  SELECT k, dataset_url, u.pos, u.section, u.line FROM ord, LATERAL (VALUES
    (2, 'biomaterials', ''),
    (3, 'biomaterials', 'Tissue ' || o_orderpriority),
    (4, 'biomaterials', 'second line'),
    (8, 'sample_preparation', CASE WHEN k % 4 = 0 THEN '' ELSE 'Prep ' || o_orderstatus END),
    (10, 'imaging', '- Microscope: ' || o_orderpriority || ': A'),
    (11, 'imaging', 'Illumination: LED'),
    (12, 'imaging', '- Camera: N/A'),
    (13, 'imaging', '- Exposure: ' || o_custkey % 100),
    (14, 'imaging', CASE WHEN k % 2 = 0 THEN '- Camera: C' || o_custkey % 10 ELSE 'no pair here' END),
    (15, 'imaging', 'Organ: ' || o_orderpriority),
    (16, 'imaging', 'Tissue type: second'),
    (17, 'imaging', '- Number of donors: ' || o_custkey % 4),
    (18, 'imaging', 'Condition: N/A'),
    (19, 'imaging', 'Release date: ' || day)) AS u(pos, section, line)
  WHERE has_doc)"""

KEY_VALUES = """kv AS (
  SELECT k, dataset_url, u.pos, u.key, u.value FROM ord, LATERAL (VALUES
    (10, 'microscope', o_orderpriority || ': A'),
    (11, 'illumination', 'LED'),
    (12, 'camera', 'N/A'),
    (13, 'exposure', CAST(o_custkey % 100 AS VARCHAR)),
    (14, 'camera', CASE WHEN k % 2 = 0 THEN 'C' || o_custkey % 10 END),
    (15, 'organ', o_orderpriority),
    (16, 'tissue type', 'second'),
    (17, 'number of donors', CAST(o_custkey % 4 AS VARCHAR)),
    (18, 'condition', 'N/A'),
    (19, 'release date', day)) AS u(pos, key, value)
  WHERE has_doc AND u.value IS NOT NULL)"""

_EXT = "CASE l_partkey % 5 WHEN 0 THEN 'btf' WHEN 1 THEN 'tar.gz' WHEN 2 THEN 'h5' WHEN 3 THEN 'cloupe' ELSE 'csv' END"
_BYTES = (
    "CAST(round(l_extendedprice * 100) AS BIGINT) * CASE l_linenumber % 4 WHEN 0 THEN 1 "
    "WHEN 1 THEN 10 WHEN 2 THEN 100 ELSE 1000 END"
)

ITEMS = f"""named AS (
  SELECT l_orderkey AS k, l_returnflag AS flag, l_linestatus = 'O' AS is_input, l_partkey,
    CASE WHEN l_partkey % 5 = 1 AND l_partkey % 2 = 0 THEN 'square_00' || l_linenumber || 'um.tar.gz'
      WHEN l_partkey % 5 = 1 AND l_partkey % 3 = 0 THEN 'square_all.tar.gz'
      ELSE 'f_' || l_linenumber || '.' || {_EXT} END AS filename,
    CASE l_linenumber % 3 WHEN 0 THEN 'Microscope image' WHEN 1 THEN 'Binned outputs' ELSE '' END
      AS file_title,
    CAST({_BYTES} AS BIGINT) AS size_bytes, md5(CAST(l_partkey AS VARCHAR)) AS md5sum,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey,
      l_shipdate, l_extendedprice, l_returnflag, l_linestatus) AS n
  FROM lineitem),
sets AS (
  SELECT k, dataset_url, 'Files' AS set_name, 0 AS set_pos, NULL AS flag
  FROM ord WHERE has_doc AND k % 3 = 0
  UNION ALL
  SELECT k, dataset_url, 'Exp ' || flag,
    row_number() OVER (PARTITION BY k ORDER BY flag) - 1, flag
  FROM (SELECT DISTINCT k, dataset_url, flag FROM ord JOIN named USING (k)
    WHERE has_doc AND k % 3 <> 0)),
members AS (
  SELECT s.dataset_url, s.set_name, CAST(s.set_pos AS INTEGER) AS set_pos, s.k, n.* EXCLUDE (k, flag)
  FROM sets s JOIN named n ON s.k = n.k AND (s.flag IS NULL OR s.flag = n.flag)),
files AS (
  SELECT dataset_url, k, set_pos, set_name, n,
    CAST(row_number() OVER (PARTITION BY k, set_pos ORDER BY is_input DESC, n) - 1 AS INTEGER) AS file_pos,
    CASE WHEN is_input THEN 'input' ELSE 'output' END AS kind, file_title,
    upper(regexp_extract(filename, '[^.]*$')) AS file_type, filename,
    {_size('size_bytes')} AS size, size_bytes, md5sum,
    'https://files.example.com/' || l_partkey || '/' || filename || '?sig=1' AS url
  FROM members WHERE l_partkey % 41 <> 0)"""

FILE_COLUMNS = "file_title, file_type, filename, size, size_bytes, md5sum, url"

FILED = """filed AS (
  SELECT o.k, o.dataset_url, coalesce(f.files, '') AS files,
    CAST(coalesce(f.n, 0) AS INTEGER) AS files_found_count,
    CASE WHEN f.n >= 2 THEN 'success' WHEN f.n = 1 THEN 'partial' ELSE 'failed' END
      AS file_extraction_status
  FROM ord o LEFT JOIN (
    SELECT k, count(*) AS n, string_agg(concat_ws('|', file_title, file_type, filename, size,
      size_bytes, md5sum, url), ';' ORDER BY set_pos, file_pos) AS files
    FROM files GROUP BY k) f USING (k))"""

# ---- FX3 -------------------------------------------------------------------------------------


def _stages(run: str) -> str:
    return f"""ev AS (
  SELECT event_id, {run} AS run, ts AS start_time,
    to_microseconds(CAST(round(value * 1000) AS BIGINT) * 1000 + 5000) AS took,
    CAST(round(value * 1000) AS BIGINT) * 1000 + 5000 AS micros,
    CASE event_type WHEN 'view' THEN 'validator' WHEN 'click' THEN 'metadata-enricher'
      WHEN 'purchase' THEN 'file-extractor' ELSE 'scraper' END AS task,
    event_id % 7 = 0 AS skipped,
    CASE WHEN event_type = 'error' THEN 2 ELSE event_id % 2 END AS code
  FROM events)"""


BY_USER = _stages("CAST(user_id AS VARCHAR)")
BY_DAY = _stages("user_id || '-' || strftime(ts, '%Y%m%d')")

# ---- FX4, FX5 --------------------------------------------------------------------------------

COPIES = f"""a AS (
  SELECT p_partkey AS row_idx, p_name || ' ' || p_partkey AS dataset_name,
    '{SITE}/datasets/part-' || p_partkey AS dataset_url, 'Spatial ' || p_type AS product,
    {_species('p_partkey')} AS species, p_brand AS sample_type,
    CASE p_partkey % 2 WHEN 0 THEN 'Cells' ELSE 'N/A' END AS cells_or_nuclei,
    CASE WHEN p_partkey % 103 = 0 THEN '' ELSE {_ffpe('p_partkey')} END AS preservation
  FROM part),
b AS (
  SELECT row_idx, dataset_name,
    CASE WHEN row_idx % 109 = 0 THEN '{SITE}/datasets/moved-' || row_idx ELSE dataset_url END AS dataset_url,
    CASE WHEN row_idx % 107 = 0 THEN '' ELSE product END AS product,
    CASE WHEN row_idx % 101 = 0 THEN lower(species) ELSE species END AS species,
    sample_type, cells_or_nuclei, preservation
  FROM a)"""

DIFFS = """diffs AS (
  SELECT row_idx + 1 AS row, a.dataset_url, 'changed' AS kind, u.field, u.old_value, u.new_value
  FROM a JOIN b USING (row_idx), LATERAL (VALUES
    ('dataset_url', a.dataset_url, b.dataset_url), ('product', a.product, b.product),
    ('species', a.species, b.species)) AS u(field, old_value, new_value)
  WHERE u.old_value <> u.new_value)"""

DIFFS_BY_RUN = f"""{DIFFS},
diffs_by_run AS (
  SELECT CAST((row - 1) % 3 AS VARCHAR) AS run, (row - 1) // 3 + 1 AS row, dataset_url, kind, field,
    old_value, new_value
  FROM diffs WHERE row <> 3)"""

CONSISTENT_BY_RUN = """consistent AS (
  SELECT run, json_count, excel_count, json_count = excel_count AND n = 0 AS passed,
    CASE WHEN json_count = excel_count THEN n ELSE 1 END AS mismatch_count
  FROM (
    SELECT CAST(row_idx % 3 AS VARCHAR) AS run, count(*) AS json_count,
      count(*) FILTER (row_idx <> 2) AS excel_count
    FROM a GROUP BY 1)
  LEFT JOIN (SELECT run, count(DISTINCT row) AS differing FROM diffs_by_run GROUP BY run) USING (run),
  LATERAL (SELECT coalesce(differing, 0) AS n))"""

_T = [t.title() for t in rules.TISSUES]


def _tissue(k: str) -> str:
    return f"list_extract([{_in(_T)}], CAST({k} % 10 AS INTEGER) + 1)"


CHECKED = f"""checked AS (
  SELECT p_partkey AS k, CAST(p_partkey % 3 AS VARCHAR) AS run,
    p_name || ' ' || p_partkey AS dataset_name, '{SITE}/datasets/part-' || p_partkey AS dataset_url,
    p_partkey % 37 <> 0 AS has_page,
    {_species('p_partkey')} AS species,
    CASE p_partkey % 3 WHEN 0 THEN 'Mouse' ELSE 'Human' END AS wrong,
    CASE WHEN p_partkey % 61 = 0 THEN '' ELSE {_tissue('p_partkey')} END AS tissue,
    {_tissue('(p_partkey + 1)')} AS next_tissue
  FROM part),
found AS (
  SELECT c.*, u.ord, u.field, u.severity, u.scraped_value, u.actual_value, u.message FROM checked c, LATERAL (VALUES
    (1, 'species', 'error', species, CASE WHEN k % 41 = 0 THEN wrong END, NULL,
      has_page AND k % 59 <> 0 AND k % 41 = 0),
    (2, 'sample_type', 'warning', tissue, next_tissue, NULL, has_page AND k % 53 = 0 AND tissue <> ''),
    (3, 'dataset_name', 'warning', dataset_name, 'Other', NULL, has_page AND k % 71 = 0),
    (0, 'page_load', 'error', NULL, NULL, 'page not found', NOT has_page))
    AS u(ord, field, severity, scraped_value, actual_value, message, hit)
  WHERE u.hit),
results AS (
  SELECT c.k, c.run, c.dataset_url, c.dataset_name,
    CASE WHEN NOT c.has_page THEN 'failed' WHEN count(f.field) = 0 THEN 'verified'
      WHEN bool_or(f.severity = 'error') THEN 'mismatched' ELSE 'warning' END AS status,
    CAST(count(f.field) AS INTEGER) AS n_differences,
    coalesce(string_agg(f.field || ': "' || coalesce(f.scraped_value, '') || '" → "' ||
      coalesce(f.actual_value, '') || '"', '; ' ORDER BY f.ord), '-') AS differences
  FROM checked c LEFT JOIN found f USING (k)
  GROUP BY c.k, c.run, c.dataset_url, c.dataset_name, c.has_page)"""

_STATUS_COUNTS = ", ".join(
    f"count(*) FILTER (status = '{status}') AS {name}"
    for name, status in [
        ("verified", "verified"),
        ("mismatched", "mismatched"),
        ("warnings", "warning"),
        ("failed_urls", "failed"),
    ]
)
_EXIT = (
    "CAST(CASE WHEN EXISTS (SELECT 1 FROM diffs) OR "
    "count(*) FILTER (status IN ('mismatched', 'failed')) > 0 THEN 1 ELSE 0 END AS INTEGER) AS exit_code"
)

# ---- FX6: listing records beside what their pages tell ------------------------------------------

CRAWLED = f"""kept AS (
  SELECT recs.*, CAST(regexp_extract(dataset_url, '[0-9]+$') AS BIGINT) AS p
  FROM recs LEFT JOIN stops USING (run) WHERE stop IS NULL OR page_num < stop),
told AS (
  SELECT p_partkey AS p, p_partkey % 29 <> 0 AS has_doc,
    CASE WHEN p_partkey % 71 = 0 THEN 'Other' ELSE p_name || ' ' || p_partkey END AS t_name,
    -- no rule knows rats, so a page that names one tells no species
    CASE WHEN p_partkey % 59 = 0 THEN '' WHEN p_partkey % 41 <> 0 THEN replace({_species('p_partkey')}, 'Rat', '')
      WHEN p_partkey % 3 = 0 THEN 'Mouse' ELSE 'Human' END AS t_species,
    {_ffpe('p_partkey')} AS t_preservation,
    CASE WHEN p_partkey % 13 = 0 THEN {_tissue('p_partkey')} ELSE '' END AS t_tissue
  FROM part WHERE p_partkey % 37 <> 0),
results AS (
  SELECT k.*, t.p IS NOT NULL AS has_page, coalesce(t.has_doc, false) AS has_doc,
    coalesce(CAST(t_species <> '' AND species <> t_species AS INTEGER), 0) AS errors,
    coalesce(CAST(lower(preservation) <> lower(t_preservation) AS INTEGER)
      + CAST(lower(dataset_name) <> lower(t_name) AS INTEGER)
      + CAST(t_tissue <> '' AND NOT contains(lower(t_tissue), lower(sample_type))
          AND NOT contains(lower(sample_type), lower(t_tissue)) AS INTEGER), 0) AS others
  FROM kept k LEFT JOIN told t USING (p)),
statuses AS (
  SELECT *, CASE WHEN NOT has_page THEN 'failed' WHEN errors > 0 THEN 'mismatched'
    WHEN others > 0 THEN 'warning' ELSE 'verified' END AS status FROM results)"""

# ---- URLs ------------------------------------------------------------------------------------

URLS = """u AS (
  SELECT page_id, url, regexp_extract(url, '^[^?#]*') AS base,
    regexp_extract(url, '\\?([^#]*)', 1) AS query, regexp_extract(url, '#(.*)$', 1) AS fragment
  FROM pages)"""


def _paged(page: str, query: str) -> str:
    """Query with the page number replaced in place or appended (no encoded text in it)."""
    return (
        f"CASE WHEN contains('&' || {query}, '&page=') "
        f"THEN regexp_replace({query}, '(^|&)page=[^&]*', '\\1page=' || {page}) "
        f"WHEN {query} = '' THEN 'page=' || {page} ELSE {query} || '&page=' || {page} END"
    )


BUSY_QUERY = "concat_ws('&', nullif(query, ''), 'tag=a+b&tag=c+d&x' || page_id % 3 || '=%C3%A9')"


# ---- the queries -----------------------------------------------------------------------------


def _documents_labels(label_rules) -> str:
    return f"""
      WITH lines AS (SELECT doc_id, unnest(string_split(lower(text), chr(10))) AS line,
          generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents),
        hits AS (SELECT doc_id, i, {_label('line', label_rules)} AS label FROM lines)
      SELECT d.doc_id, coalesce(h.label, '') AS label FROM documents d LEFT JOIN (
        SELECT doc_id, arg_min(label, i) AS label FROM hits WHERE label IS NOT NULL GROUP BY doc_id) h
      USING (doc_id)"""


def _completion_rows(source: str, columns: list[tuple[str, str]]) -> str:
    parts = [
        f"SELECT '{name}' AS field, count(*) FILTER ({test}) AS filled, count(*) AS total, "
        f"CAST(printf('%.1f', count(*) FILTER ({test}) / count(*)::DOUBLE * 100) AS DOUBLE) AS completion_rate "
        f"FROM {source}"
        for name, test in columns
    ]
    return " UNION ALL ".join(parts)


def _key_fields(key_rules) -> str:
    names = [name for name, _ in key_rules]
    case = _label("key", key_rules)
    columns = ", ".join(
        f"coalesce(arg_min(value, pos) FILTER (field = '{name}'), '') AS {name}" for name in names
    )
    return _with(
        ORD,
        KEY_VALUES,
        f"mapped AS (SELECT *, {case} AS field FROM kv WHERE value NOT IN ('', 'N/A'))",
        query=f"SELECT dataset_url, {columns} FROM mapped GROUP BY dataset_url",
    )


def _html_text(c: str) -> str:
    """Entities of the page table, '&amp;' last."""
    for entity, text in [("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")]:
        c = f"replace({c}, '{entity}', '{text}')"
    return f"trim(regexp_replace({c}, '{WS}+', ' ', 'g'))"


def _body_text() -> str:
    """Visible text of the page table by plain substitutions (its HTML is of few kinds)."""
    c = r"regexp_replace(html, '(?is)<head.*?</head>|<script.*?</script>|<style.*?</style>|<!--.*?-->', '', 'g')"
    c = f"regexp_replace({c}, '{WS}+', ' ', 'g')"
    c = f"regexp_replace({c}, '(?i)</?(html|body|nav|ul|li|div|article|h1|p|br|footer)( [^>]*)?>', chr(10), 'g')"
    c = f"regexp_replace({c}, '<[!/a-zA-Z][^>]*>', '', 'g')"
    for entity, text in [("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"'), ("&amp;", "&")]:
        c = f"replace({c}, '{entity}', '{text}')"
    c = f"regexp_replace(regexp_replace({c}, ' *\\n[ \\n]*', chr(10), 'g'), ' +', ' ', 'g')"
    return f"lower(trim({c}, ' ' || chr(10)))"


def all_oracles() -> dict[str, str]:
    from pagecat.plans.queries import LINE_RULES, REPORT_TIME, WORD_RULES

    listing = f"SELECT run, page_num, pos, dataset_name, dataset_url, {', '.join(BASE_FIELDS[2:])}"
    table_rows = "FROM rows WHERE in_table AND n_cells >= 2"
    stored = "CASE run WHEN '2' THEN 'validation_report_2024-01-01' ELSE 'validation_report_2024-01-02' END || '_00-00-00.json'"
    stop = (
        "stops AS (SELECT run, min(page_num) AS stop FROM (SELECT run, page_num, "
        "sum(new_records) OVER w AS s, count(*) OVER w AS c FROM counts "
        "WINDOW w AS (PARTITION BY run ORDER BY page_num ROWS 2 PRECEDING)) "
        "WHERE s = 0 AND c = 3 GROUP BY run)"
    )
    enriched = (
        f"enriched AS (SELECT {', '.join('r.' + f for f in BASE_FIELDS)}, "
        f"{', '.join('f.' + f for f in NEW_FIELDS)}, CASE WHEN f.has_page THEN 'ok' ELSE 'failed' END "
        "AS outcome, r.k FROM recs r JOIN fields f USING (k))"
    )
    catalogue = (
        "catalogue AS (SELECT e.* EXCLUDE (k, outcome), f.files, f.files_found_count, "
        "f.file_extraction_status FROM enriched e JOIN filed f USING (k))"
    )
    FX2_ALL = (ORD, ORD_RECORDS, FIELDS, enriched, ITEMS, FILED, catalogue)
    catalogue_columns = [*ENRICHED_FIELDS, "files", "files_found_count", "file_extraction_status"]
    tests = [
        (c, "files_found_count <> 0" if c == "files_found_count" else f"{c} <> ''")
        for c in catalogue_columns
    ]
    value_rows = " UNION ALL ".join(
        f"SELECT '{c}' AS field, nullif({c}, '') AS value FROM enriched" for c in ENRICHED_FIELDS
    )
    report_columns = (
        f"count(*) AS total_datasets, {_STATUS_COUNTS}, {_EXIT}"
    )
    cells = ", ".join(
        f"('file_' || i || '_{field.removeprefix('file_')}', {field})"
        for field in ["file_type", "filename", "size", "md5sum", "url"]
    )
    return {
        "read_pages": "SELECT url, length(html) AS n_chars FROM pages",
        "records_roundtrip": _with(COPIES, query="SELECT * FROM b"),
        "tabular_roundtrip": _with(COPIES, query="SELECT * FROM b"),
        "column_order": _with(
            COPIES,
            query="SELECT row_idx, CAST(u.position AS INTEGER) AS position, u.column_name, u.value FROM a, LATERAL (VALUES "
            "(0, 'species', species), (1, 'dataset_name', dataset_name), (2, 'dataset_url', dataset_url)) "
            "AS u(position, column_name, value)",
        ),
        "archive_pages": "SELECT CAST(page_id % 4 AS VARCHAR) AS run, CAST(page_id AS INTEGER) AS page_num, "
        "url, md5(html) AS html_md5 FROM pages",
        "validation_report": _with(
            COPIES,
            DIFFS,
            CHECKED,
            query=f"SELECT run, '{REPORT_TIME}' AS validation_timestamp, {report_columns}, "
            "NOT EXISTS (SELECT 1 FROM diffs) AS passed, (SELECT count(*) FROM part) AS json_count, "
            "(SELECT count(*) FROM part) AS excel_count, (SELECT count(DISTINCT row) FROM diffs) AS mismatch_count "
            "FROM results GROUP BY run",
        ),
        "report_summary": _with(
            COPIES,
            DIFFS_BY_RUN,
            CONSISTENT_BY_RUN,
            CHECKED,
            query=f"SELECT run, {stored} AS report, '{REPORT_TIME}' AS validation_timestamp, count(*) AS total_datasets, "
            f"c.passed, c.json_count, c.excel_count, c.mismatch_count, {_STATUS_COUNTS} "
            "FROM results JOIN consistent c USING (run) GROUP BY ALL",
        ),
        "report_full": _with(
            COPIES,
            DIFFS_BY_RUN,
            CONSISTENT_BY_RUN,
            CHECKED,
            query=f"""SELECT run, {stored} AS report, count(*) OVER w AS total_datasets, c.passed,
              CAST(CASE WHEN run = '1' THEN 2
                WHEN NOT c.passed OR count(*) FILTER (status IN ('mismatched', 'failed')) OVER w > 0 THEN 1 ELSE 0 END
                AS INTEGER) AS exit_code, dataset_url, dataset_name, status, n_differences
            FROM results JOIN consistent c USING (run) WINDOW w AS (PARTITION BY run)""",
        ),
        "report_issues": _with(
            COPIES,
            DIFFS_BY_RUN,
            CONSISTENT_BY_RUN,
            CHECKED,
            query=f"""SELECT run, {stored} AS report, c.passed AS file_consistency_passed,
              count(*) OVER (PARTITION BY run) AS total_issues, dataset_url, status
            FROM results JOIN consistent c USING (run) WHERE status <> 'verified'""",
        ),
        "stored_artifacts": """
          SELECT CAST(k AS VARCHAR) AS run, false AS has_url, false AS has_html, true AS has_json, k % 2 = 0 AS has_sheet,
            CAST(CASE k WHEN 0 THEN 0 WHEN 2 THEN 2 ELSE 1 END AS BIGINT) AS report_files,
            CASE k WHEN 0 THEN NULL WHEN 2 THEN 'validation_report_2024-02-01.json'
              ELSE 'validation_report_2024-01-0' || k || '.json' END AS latest_report,
            k = 2 AS enrichment_completed, k % 2 = 0 AS scrape_completed, k > 0 AS validation_completed,
            CASE WHEN k % 2 = 0 THEN n END AS datasets_count
          FROM (SELECT p_partkey % 4 AS k, count(*) AS n FROM part GROUP BY 1)""",
        "replace_stage": _with(
            ORD,
            ORD_RECORDS,
            query="SELECT CAST(k % 3 AS VARCHAR) AS run, dataset_url, "
            "CASE WHEN k % 3 = 1 THEN upper(product) ELSE product END AS product FROM recs",
        ),
        "latest_report": _with(
            COPIES,
            DIFFS,
            CHECKED,
            query="SELECT run, 'validation_report_2024-01-0' || (3 - CAST(run AS INTEGER)) || "
            f"'_00-00-00.json' AS report, {report_columns} FROM results GROUP BY run",
        ),
        "artifact_inventory": """
          WITH log AS (SELECT user_id || '-' || strftime(ts, '%Y%m%d') AS run, event_type, event_id FROM events)
          SELECT run, bool_or(event_type = 'signup') AS has_url, false AS has_html,
            bool_or(event_type = 'view') AS has_json, bool_or(event_type = 'click') AS has_sheet,
            count(*) FILTER (event_type = 'purchase') AS report_files,
            max('validation_report_' || event_id || '.json') FILTER (event_type = 'purchase') AS latest_report,
            bool_or(event_type = 'error') AS enrichment_completed,
            bool_or(event_type = 'view') AND bool_or(event_type = 'click') AS scrape_completed,
            bool_or(event_type = 'purchase') AS validation_completed,
            CASE WHEN bool_or(event_type = 'view') AND bool_or(event_type = 'click') THEN count(*) END
              AS datasets_count
          FROM log GROUP BY run""",
        "url_params": _with(
            URLS,
            query="""
          SELECT page_id, param, string_agg(value, '|' ORDER BY i) AS param_values FROM (
            SELECT page_id, split_part(f, '=', 1) AS param, split_part(f, '=', 2) AS value, i FROM (
              SELECT page_id, unnest(string_split(query, '&')) AS f, 0 AS i FROM u WHERE query <> ''
              UNION ALL SELECT page_id, 'tag=a b', 1 FROM u UNION ALL SELECT page_id, 'tag=c d', 2 FROM u
              UNION ALL SELECT page_id, 'x' || page_id % 3 || '=é', 3 FROM u))
          GROUP BY ALL""",
        ),
        "url_set_page": _with(
            URLS,
            query=f"SELECT page_id, base || '?' || {_paged('page_id % 7', BUSY_QUERY)} || '#f' AS new_url FROM u",
        ),
        "listing_urls": _with(
            URLS,
            query=f"""SELECT url, CAST(n AS INTEGER) AS page_num, CASE WHEN n = 0 THEN url ELSE base || '?' || {_paged('n', 'query')}
              || CASE WHEN fragment = '' THEN '' ELSE '#' || fragment END END AS page_url
            FROM u, range(3) r(n)""",
        ),
        "link_filter": """
          SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN '/datasets/part-' WHEN 1 THEN '/datasets?page='
            WHEN 2 THEN '/datasets/x?y=/datasets?z=' ELSE '/about/' END || p_partkey AS href,
            p_partkey % 4 = 0 AS is_dataset FROM part""",
        "resolve_links": """
          SELECT url, CAST(pos - 1 AS INTEGER) AS pos, regexp_extract(url, '^https?://[^/]*') || href AS absolute_url
          FROM (SELECT url, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS href,
            generate_subscripts(regexp_extract_all(html, '<a href="([^"]*)"', 1), 1) AS pos FROM pages)""",
        "layout_probe": """
          SELECT url, 'article' AS layout,
            CAST((length(html) - length(replace(html, '<article', ''))) // 8 AS INTEGER) AS elements FROM pages""",
        "layout_probe_listing": _with(
            FX1,
            query="SELECT run, page_num, CASE WHEN page_num = 13 THEN 'link' ELSE 'table_row' END AS layout, "
            "CAST(count(*) + CASE page_num WHEN 13 THEN 0 WHEN 9 THEN 0 WHEN 7 THEN 3 WHEN 5 THEN 2 ELSE 1 END "
            "AS INTEGER) AS elements FROM rows GROUP BY run, page_num",
        ),
        "table_rows": _with(
            FX1,
            query=f"""SELECT run, page_num, pos, n_cells, CASE n_cells WHEN 7 THEN '' WHEN 5 THEN p_brand
              ELSE 'Spatial ' || p_type END AS second_cell {table_rows}""",
        ),
        "row_links": _with(
            FX1,
            query=f"SELECT run, page_num, pos, name AS dataset_name, dataset_url {table_rows} AND name <> ''",
        ),
        "squash_ws": f"SELECT doc_id, md5(trim(regexp_replace(text, '{WS}+', ' ', 'g'))) AS squashed_md5 FROM documents",
        "cells_positional": _with(
            FX1,
            query=f"SELECT run, page_num, pos, {FX1_FIELDS} {table_rows} AND name <> '' AND n_cells = 7",
        ),
        "cells_pattern": _with(
            FX1,
            query=f"SELECT run, page_num, pos, {FX1_FIELDS} {table_rows} AND name <> '' AND n_cells < 7",
        ),
        "fallback_links": f"""
          SELECT CAST(page_id AS INTEGER) AS page_num, CAST(pos - 1 AS INTEGER) AS pos,
            {_html_text('name')} AS dataset_name, regexp_extract(url, '^https?://[^/]*') || href AS dataset_url
          FROM (SELECT page_id, url, unnest(regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1)) AS href,
            unnest(regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2)) AS name,
            generate_subscripts(regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1), 1) AS pos FROM pages)
          WHERE contains(href, '/') AND {_html_text('name')} <> ''""",
        "fallback_links_listing": _with(
            FX1,
            query="SELECT run, page_num, pos, name AS dataset_name, dataset_url, '' AS product, '' AS species, "
            "'' AS sample_type, '' AS cells_or_nuclei, '' AS preservation FROM rows WHERE NOT in_table AND name <> ''",
        ),
        "dedup_first_seen": _with(FX1, FX1_FIRST, query=f"{listing} FROM recs"),
        "stop_rule": _with(
            FX1,
            FX1_FIRST,
            FX1_COUNTS,
            stop,
            query=f"{listing} FROM recs LEFT JOIN stops USING (run) WHERE stop IS NULL OR page_num < stop",
        ),
        "page_stats": _with(
            FX1,
            FX1_FIRST,
            FX1_COUNTS,
            query="SELECT run, page_num, new_records, CAST(sum(new_records) OVER (PARTITION BY run ORDER BY page_num) "
            "AS BIGINT) AS running_total FROM counts",
        ),
        "column_widths": " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, CAST(least(greatest(max(length(CAST({c} AS VARCHAR))), {len(c)}) + 2, 100) "
            "AS INTEGER) AS width FROM supplier"
            for c in ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"]
        ),
        "embedded_json": _with(
            ORD,
            query="SELECT dataset_url AS url, k % 29 = 0 AS no_script, has_doc FROM ord WHERE has_page",
        ),
        "dataset_node": _with(
            ORD,
            query="""SELECT dataset_url, has_doc, CASE WHEN has_doc THEN CAST(o_custkey % 5 AS VARCHAR) END AS donors,
              CASE WHEN has_doc THEN CASE WHEN k % 50 = 0 THEN 'unknown' ELSE day || 'T23:30:00-05:00' END END
                AS published_at,
              CAST(CASE WHEN has_doc THEN coalesce(n, 0) + CASE WHEN k % 3 = 0 THEN 1 ELSE 0 END ELSE 0 END
                AS INTEGER) AS n_sets
            FROM ord LEFT JOIN (SELECT l_orderkey AS k, count(DISTINCT l_returnflag) AS n FROM lineitem GROUP BY 1)
              USING (k) WHERE has_page""",
        ),
        "body_sections": _with(ORD, LINES, query="SELECT dataset_url, pos, section, line FROM body"),
        "body_sections_documents": f"""
          WITH lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS raw,
              generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents),
            clean AS (SELECT doc_id, pos, regexp_replace(raw, '^{WS}+|{WS}+$', '', 'g') AS line FROM lines),
            marked AS (SELECT *, CASE WHEN starts_with(line, 'The ') THEN 'the' WHEN starts_with(line, 'La ') THEN 'la'
              WHEN starts_with(line, 'Der ') THEN 'der' WHEN starts_with(line, 'De') THEN '-' END AS header FROM clean),
            filled AS (SELECT *, last_value(header IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pos) AS section
              FROM marked)
          SELECT doc_id, CAST(pos AS INTEGER) AS pos, section, md5(line) AS line_md5 FROM filled
          WHERE header IS NULL AND section IS NOT NULL AND section <> '-'""",
        "section_first_line": _with(
            ORD,
            LINES,
            query="SELECT dataset_url, section, arg_min(line, pos) AS first_line FROM body "
            "WHERE line <> '' AND section <> 'imaging' GROUP BY ALL",
        ),
        "section_kv": _with(ORD, KEY_VALUES, query="SELECT dataset_url, pos, key, value FROM kv"),
        "imaging_fields": _key_fields(rules.IMAGING_RULES),
        "sample_fields": _key_fields(rules.SAMPLE_RULES),
        "sample_lists": _with(
            ORD,
            query="SELECT dataset_url, "
            + ", ".join(
                f"CASE WHEN has_doc THEN {_SAMPLE[f]} ELSE '' END AS {f}"
                for f in ["anatomical_entity", "preservation_method", "disease_state", "biomaterial_type"]
            )
            + " FROM ord WHERE has_page",
        ),
        "donor_count": _with(
            ORD,
            FIELDS,
            query="SELECT dataset_url, donor_count FROM ord JOIN fields USING (k) WHERE ord.has_page",
        ),
        "date_published": _with(
            ORD,
            FIELDS,
            query="SELECT dataset_url, date_published FROM ord JOIN fields USING (k) WHERE ord.has_page",
        ),
        "image_type_text": _documents_labels(rules.IMAGE_TYPE_RULES),
        "disease_text": _documents_labels(rules.DISEASE_RULES + LINE_RULES),
        "preservation_text": _documents_labels(rules.PRESERVATION_TEXT_RULES + WORD_RULES),
        "enrich": _with(ORD, ORD_RECORDS, FIELDS, enriched, query="SELECT * EXCLUDE (k) FROM enriched"),
        "filesets": _with(
            ORD,
            ITEMS,
            query="""SELECT s.dataset_url, CAST(s.set_pos AS INTEGER) AS set_pos, s.set_name,
              CAST(count(*) FILTER (m.is_input) AS INTEGER) AS n_inputs,
              CAST(count(*) FILTER (NOT m.is_input) AS INTEGER) AS n_outputs
            FROM sets s LEFT JOIN members m USING (k, set_pos) GROUP BY ALL""",
        ),
        "explode_files": _with(
            ORD,
            ITEMS,
            query=f"SELECT dataset_url, set_pos, set_name, file_pos, kind, {FILE_COLUMNS} FROM files",
        ),
        "file_names": r"""
          WITH n AS (SELECT url, split_part(regexp_extract(url, '[^/]*$'), '?', 1) AS filename FROM pages)
          SELECT url, filename, upper(regexp_extract(filename, '[^.]*$')) AS file_type FROM n""",
        "human_size": f"""
          WITH s AS (SELECT CAST({_BYTES} AS BIGINT) AS size_bytes FROM lineitem)
          SELECT size_bytes, {_size('size_bytes')} AS size FROM s""",
        "parse_size": """
          WITH t AS (SELECT l_partkey, CAST(l_quantity AS INTEGER) AS q, l_partkey % 10 AS d,
              list_extract(['B', 'KB', 'mb', 'GB', 'Tb', 'items', 'KB'], l_linenumber % 7 + 1) AS unit FROM lineitem),
            s AS (SELECT *, CASE upper(unit) WHEN 'B' THEN 0 WHEN 'KB' THEN 1 WHEN 'MB' THEN 2 WHEN 'GB' THEN 3
                WHEN 'TB' THEN 4 END AS power,
              CASE WHEN l_partkey % 5 = 0 THEN '' WHEN l_partkey % 5 = 1
                THEN q || ',' || lpad(CAST(d AS VARCHAR), 3, '0') || ' ' || unit
                ELSE ' ' || q || '.' || d || unit || ' left' END AS size_text FROM t),
            v AS (SELECT *, CASE WHEN size_text = '' THEN NULL WHEN l_partkey % 5 = 1 THEN CAST(q * 1000 + d AS DOUBLE)
                ELSE CAST(q || '.' || d AS DOUBLE) END * CAST(1024::BIGINT ** power AS DOUBLE) AS raw FROM s),
            b AS (SELECT size_text, CAST(trunc(raw) AS BIGINT) AS n FROM v)
          SELECT size_text, coalesce(n, 0) AS size_bytes, CASE WHEN n IS NULL THEN replace(trim(size_text), ',', '')
            WHEN n >= 1073741824 THEN printf('%.1f GB', n / 1073741824.0::DOUBLE)
            WHEN n >= 1048576 THEN printf('%.1f MB', n / 1048576.0::DOUBLE)
            WHEN n >= 1024 THEN printf('%.1f KB', n / 1024.0::DOUBLE) ELSE n || ' B' END AS human FROM b""",
        "classify_files": _with(
            ORD,
            ITEMS,
            query=r"""SELECT url, file_title, filename, CASE WHEN file_title <> '' THEN file_title
              WHEN suffix(filename, '.btf') THEN 'Microscope Image (BTF)'
              WHEN filename = 'square_all.tar.gz' THEN 'Binned Output (GZ)'
              WHEN contains(filename, 'square') THEN 'Binned Output (' || CAST(substr(filename, 8, 3) AS INTEGER) || 'μm)'
              WHEN suffix(filename, '.gz') THEN 'Compressed Archive (GZ)'
              WHEN suffix(filename, '.h5') THEN 'Feature Matrix (H5)'
              WHEN suffix(filename, '.cloupe') THEN 'Loupe File' ELSE 'Other' END AS file_class FROM files""",
        ),
        "attach_files": _with(ORD, ITEMS, FILED, query="SELECT * EXCLUDE (k) FROM filed"),
        "attach_files_flat": _with(ORD, ITEMS, FILED, query="SELECT * EXCLUDE (k) FROM filed"),
        "file_stats": _with(
            ORD,
            ITEMS,
            FILED,
            query="""SELECT count(*) AS total_datasets,
              count(*) FILTER (file_extraction_status = 'success') AS successful,
              count(*) FILTER (file_extraction_status = 'partial') AS partial,
              count(*) FILTER (file_extraction_status = 'failed') AS failed,
              CAST(sum(files_found_count) AS BIGINT) AS total_files_extracted,
              (SELECT count(*) FROM files WHERE kind = 'input' AND file_title = 'Microscope image')
                AS microscope_images_found,
              (SELECT count(*) FROM files WHERE kind = 'output' AND file_title = 'Binned outputs')
                AS binned_outputs_found
            FROM filed""",
        ),
        "files_wide": _with(
            ORD,
            ITEMS,
            "ranked AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY set_pos, file_pos) AS i FROM files)",
            query=f"SELECT dataset_url, u.file_column, u.value FROM ranked, LATERAL (VALUES {cells}) "
            "AS u(file_column, value) WHERE u.value IS NOT NULL",
        ),
        "count_check": """
          SELECT false AS passed, count(*) AS json_count, count(*) - 1 AS excel_count, 'count_mismatch' AS type,
            'Entry count mismatch: JSON has ' || count(*) || ', Excel has ' || (count(*) - 1) AS message FROM part""",
        "row_diff": _with(COPIES, DIFFS, query="SELECT * FROM diffs"),
        "row_diff_files": _with(COPIES, DIFFS, query="SELECT * FROM diffs"),
        "row_diff_by_run": _with(
            COPIES,
            DIFFS_BY_RUN,
            query="SELECT run, row, dataset_url, kind, field, old_value, new_value FROM diffs_by_run",
        ),
        "consistency_by_run": _with(
            COPIES,
            DIFFS_BY_RUN,
            CONSISTENT_BY_RUN,
            query="SELECT * FROM consistent",
        ),
        "exit_code_by_run": _with(
            COPIES,
            DIFFS_BY_RUN,
            CONSISTENT_BY_RUN,
            CHECKED,
            query="""SELECT r.run, CAST(CASE WHEN r.run = '1' THEN 2
              WHEN NOT c.passed OR count(*) FILTER (status IN ('mismatched', 'failed')) > 0 THEN 1 ELSE 0 END
              AS INTEGER) AS exit_code
            FROM results r LEFT JOIN consistent c USING (run) GROUP BY r.run, c.passed""",
        ),
        "consistency_summary": _with(
            COPIES,
            DIFFS,
            query="SELECT count(*) = 0 AS passed, (SELECT count(*) FROM a) AS json_count, "
            "(SELECT count(*) FROM b) AS excel_count, count(DISTINCT row) AS mismatch_count FROM diffs",
        ),
        "key_coverage": _with(
            COPIES,
            query="SELECT dataset_url, 'only_in_a' AS coverage FROM a WHERE dataset_url NOT IN (SELECT dataset_url FROM b) "
            "UNION ALL SELECT dataset_url, 'only_in_b' FROM b WHERE dataset_url NOT IN (SELECT dataset_url FROM a)",
        ),
        "page_heading": f"SELECT url, {_html_text(chr(114) + 'egexp_extract(html, ' + chr(39) + '<h1>(.*?)</h1>' + chr(39) + ', 1)')} AS heading FROM pages",
        "body_text": f"SELECT url, md5({_body_text()}) AS body_md5 FROM pages",
        "detect_fields": "SELECT doc_id, "
        + ", ".join(
            f"{_label('lower(text)', r, chr(39) * 2)} AS {name}"
            for name, r in [
                ("language", WORD_RULES),
                ("sample_type", rules.TISSUE_RULES),
                ("line_kind", LINE_RULES),
            ]
        )
        + " FROM documents",
        "compare_fields": _with(
            CHECKED,
            query="SELECT dataset_url, field, severity, scraped_value, actual_value, message FROM found",
        ),
        "url_status": _with(CHECKED, query="SELECT run, dataset_url, status, n_differences FROM results"),
        "status_counts": _with(
            CHECKED, query=f"SELECT run, count(*) AS total_datasets, {_STATUS_COUNTS} FROM results GROUP BY run"
        ),
        "validation_exit": _with(COPIES, DIFFS, CHECKED, query=f"SELECT run, {_EXIT} FROM results GROUP BY run"),
        "report_rows": _with(
            CHECKED,
            query="""SELECT k + 1 AS row, dataset_url, substr(dataset_name, 1, 60) AS name,
              CASE status WHEN 'verified' THEN '✓' WHEN 'warning' THEN '⚠' ELSE '✗' END || ' ' || upper(status)
                AS status_label, differences FROM results""",
        ),
        "issues_only": _with(
            CHECKED,
            query="SELECT dataset_url, status, count(*) OVER () AS total_issues FROM results WHERE status <> 'verified'",
        ),
        "issues_by_run": _with(
            CHECKED,
            query="SELECT run, dataset_url, status, count(*) OVER (PARTITION BY run) AS total_issues FROM results "
            "WHERE status <> 'verified'",
        ),
        "field_completion": _with(*FX2_ALL, query=_completion_rows("catalogue", tests)),
        "field_statistics": _with(
            ORD,
            ORD_RECORDS,
            FIELDS,
            enriched,
            f"vals AS ({value_rows}), "
            "counted AS (SELECT field, value, count(*) AS n FROM vals GROUP BY ALL), "
            "per AS (SELECT field, count(*) AS total, count(value) AS filled, count(DISTINCT value) AS unique_values_count "
            "FROM vals GROUP BY field)",
            query="""SELECT field, total, filled, CAST(printf('%.1f', filled / total::DOUBLE * 100) AS DOUBLE)
                AS completion_rate, unique_values_count, value, CASE WHEN value IS NOT NULL THEN n END AS value_count
              FROM counted JOIN per USING (field) WHERE value IS NOT NULL OR filled = 0""",
        ),
        "catalog_summary": _with(
            COPIES,
            "vals AS (SELECT 'species' AS field, species AS value FROM b UNION ALL SELECT 'sample_type', sample_type FROM b "
            "UNION ALL SELECT 'product', CASE product WHEN 'Spatial PROMO' THEN 'Unknown' ELSE product END FROM b)",
            query="SELECT field, value, count(*) AS records, (SELECT count(*) FROM b) AS total_datasets FROM vals GROUP BY ALL",
        ),
        "field_catalog": "SELECT u.*, (SELECT count(*) FROM orders) AS total_datasets FROM (VALUES "
        + ", ".join(
            f"({i}, '{c}', '{'original' if c in BASE_FIELDS else 'enriched'}')"
            for i, c in enumerate(catalogue_columns)
        )
        + ") AS u(position, field, origin)",
        "stage_timestamps": _with(
            BY_USER,
            query="""SELECT r.run, t.task, coalesce(strftime(max(start_time + took) FILTER (NOT skipped AND code < 2),
                '%Y-%m-%d %H:%M:%S'), '') AS time
              FROM (SELECT DISTINCT run FROM ev) r CROSS JOIN (VALUES ('scraper'), ('validator'),
                ('metadata-enricher'), ('file-extractor')) AS t(task)
              LEFT JOIN ev USING (run, task) GROUP BY ALL""",
        ),
        "run_outcome": _with(
            BY_DAY,
            query="SELECT run, count(*) AS stages, CASE WHEN bool_and(skipped OR code = 0) THEN 'success' ELSE 'failed' END "
            "AS overall_status FROM ev GROUP BY run",
        ),
        "stage_status": _with(
            BY_USER,
            query="""SELECT event_id,
              CASE WHEN skipped THEN 'error' WHEN code = 0 THEN 'success' WHEN code = 1 THEN 'failed' ELSE 'error' END
                AS stage_status,
              CASE WHEN NOT skipped AND code = 0 THEN 'success' ELSE 'failed' END AS scraper_status,
              CASE WHEN skipped THEN 'failed' WHEN code = 0 THEN 'success' WHEN code = 1 THEN 'warnings' ELSE 'failed' END
                AS validator_status,
              CASE WHEN skipped THEN 'failed' WHEN code = 0 THEN 'success' WHEN code = 1 THEN 'partial' ELSE 'failed' END
                AS enricher_status FROM ev""",
        ),
        "stage_durations": _with(
            BY_USER,
            query="SELECT event_id, printf('%.2fs', micros / 1000000.0::DOUBLE) AS duration FROM ev",
        ),
        "stream_stop_rule": _with(
            FX1,
            FX1_FIRST,
            FX1_COUNTS,
            stop,
            query=f"{listing} FROM recs LEFT JOIN stops USING (run) WHERE stop IS NULL OR page_num < stop",
        ),
        "stream_ingest": _with(FX1, FX1_FIRST, query=f"{listing} FROM recs"),
        "catalogue_flow": _with(
            *FX2_ALL,
            query="""SELECT c.dataset_url, microscope, date_published, c.files_found_count, c.file_extraction_status,
                CASE WHEN NOT o.has_page THEN 'failed' ELSE 'verified' END AS status
              FROM catalogue c JOIN ord o USING (dataset_url)""",
        ),
        "crawl_to_status": _with(
            FX1,
            FX1_FIRST,
            FX1_COUNTS,
            stop,
            CRAWLED,
            query="""SELECT run, dataset_url, dataset_name,
                CASE WHEN has_doc THEN 'M' || p % 9 ELSE '' END AS microscope,
                CASE WHEN has_doc THEN printf('2024-01-%02d', p % 28 + 1) ELSE '' END AS date_published,
                CAST(CASE WHEN has_doc THEN p % 3 ELSE 0 END AS INTEGER) AS files_found_count,
                CASE WHEN NOT has_doc OR p % 3 = 0 THEN 'failed' WHEN p % 3 = 1 THEN 'partial' ELSE 'success' END
                  AS file_extraction_status,
                CASE WHEN has_page THEN 'ok' ELSE 'failed' END AS outcome,
                CAST(CASE WHEN has_page THEN errors + others ELSE 1 END AS INTEGER) AS n_differences, status
              FROM statuses""",
        ),
        "crawl_report": _with(
            FX1,
            FX1_FIRST,
            FX1_COUNTS,
            stop,
            CRAWLED,
            query=f"""SELECT run, count(*) AS total_datasets, true AS passed, count(*) AS json_count, count(*) AS excel_count,
                CAST(0 AS BIGINT) AS mismatch_count, {_STATUS_COUNTS},
                CAST(CASE WHEN count(*) FILTER (status IN ('mismatched', 'failed')) > 0 THEN 1 ELSE 0 END AS INTEGER)
                  AS exit_code
              FROM statuses GROUP BY run""",
        ),
    }

"""SQL for the checking engine: the same results from the same tables, written independently."""

from __future__ import annotations

from metaloom.functions.normalise import ORIGIN_COMMENT
from metaloom.plans.fixtures import fixture_sql

COMMENT = ORIGIN_COMMENT.format(issues_url="https://example.org/issues")

# ---- pages -----------------------------------------------------------------------------------------

_ANCHOR = '<a href="([^"]*)">([^<]*)</a>'


def _plain(expr: str) -> str:
    """Resolve the character references that the pages use."""
    for code, char in [
        ("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&"),
    ]:
        expr = f"replace({expr}, '{code}', '{char}')"
    return expr


_LINKS = f"""
SELECT page_id, url AS base, CAST(i AS BIGINT) AS pos, {_plain('hrefs[i + 1]')} AS href, trim({_plain('labels[i + 1]')}) AS label
FROM (SELECT *, unnest(range(len(hrefs))) AS i FROM (
  SELECT page_id, url, regexp_extract_all(html, '{_ANCHOR}', 1) AS hrefs, regexp_extract_all(html, '{_ANCHOR}', 2) AS labels
  FROM pages))
"""
_TARGET = "regexp_extract(base, '^(https?://[^/?#]+)', 1) || href"

PAGES = {
    "page_links": f"SELECT page_id, pos, href, label FROM ({_LINKS})",
    "page_links_resolved": f"SELECT page_id, pos, {_TARGET} AS url FROM ({_LINKS})",
    "page_links_distinct": f"""
        SELECT page_id, label, href, min(pos) AS first_pos FROM ({_LINKS}) GROUP BY page_id, label, href""",
    "links_per_host": f"""
        SELECT host, count(DISTINCT page_id) AS n_pages, count(*) AS n_links FROM (
          SELECT DISTINCT page_id, label, {_TARGET} AS target, lower(regexp_extract(base, '^https?://([^/?#]+)', 1)) AS host
          FROM ({_LINKS})) GROUP BY host""",
    "allowed_domain_pages": """
        SELECT DISTINCT page_id, url FROM pages
        WHERE lower(regexp_extract(url, '^https?://([^/?#:]+)', 1)) IN ('m.tionsh.example.net', 'thther.example.com', 'thther.example.org', 'spam-farm.example.org')""",
    "page_text": f"""
        SELECT page_id, length(text) AS n_chars, text FROM (
          SELECT page_id, array_to_string(list_filter(list_transform(
            string_split_regex(regexp_replace(html, '(?s)<script.*?</script>|<style.*?</style>|<!--.*?-->', '<>', 'g'), '<[^>]*>'),
            lambda x: trim({_plain('x')}, chr(32) || chr(10) || chr(9) || chr(13))), lambda x: x <> ''), ' ') AS text
          FROM pages)""",
    "page_extract": """
        SELECT page_id, CAST(0 AS BIGINT) AS pos, regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1) AS heading,
          strpos(html, '<h1>') - 1 AS at FROM pages WHERE contains(html, '<h1>')""",
}

# ---- source facts ----------------------------------------------------------------------------------

_SOURCE = fixture_sql("source_pages")
_DOWNLOADS = f"""
SELECT DISTINCT page_id, label, CASE WHEN href LIKE 'http%' THEN href WHEN href LIKE '/%' THEN 'https://ex.org' || href
  WHEN href LIKE '../%' THEN 'https://ex.org/p/' || substr(href, 4) ELSE regexp_replace(base_url, '[^/]*$', '') || href END AS href
FROM (SELECT page_id, base_url, unnest(regexp_extract_all(html, '{_ANCHOR}', 1)) AS href, unnest(regexp_extract_all(html, '{_ANCHOR}', 2)) AS label
  FROM {_SOURCE})
WHERE contains(lower(label), 'download') OR contains(lower(href), 'download') OR contains(lower(label), 'data')
"""
_CITED = f"""
SELECT page_id, regexp_extract(html, '<p>((?:Model|Data) Citation)</p>', 1) AS label,
  regexp_extract(html, '<p>(?:Model|Data) Citation</p><p>([^<]*)</p>', 1) AS text
FROM {_SOURCE} WHERE regexp_matches(html, '<p>(?:Model|Data) Citation</p>')
"""
_VARIABLES = f"""
WITH src AS (SELECT * FROM {_SOURCE}),
tr AS (SELECT page_id, unnest(regexp_extract_all(html, '<tr>(.*?)</tr>', 1)) AS cells,
    unnest(range(len(regexp_extract_all(html, '<tr>(.*?)</tr>', 1)))) AS pos FROM src),
cell AS (SELECT page_id, pos, regexp_extract_all(cells, '<t[dh]>([^<]*)</t[dh]>', 1) AS c FROM tr),
rows_ AS (SELECT page_id, 0 AS pass, pos, c[1] AS code, c[2] AS name, coalesce(c[3], '') AS unit, c[2] AS description FROM cell
  WHERE len(c) > 1 AND regexp_full_match(c[1], '[A-Za-z][A-Za-z0-9_-]*') AND c[2] <> '' AND lower(c[1]) NOT IN ('name', 'code', 'property')),
line AS (SELECT page_id, 1 AS pass, unnest(range(len(n))) AS pos, unnest(n) AS name, unnest(k) AS code, unnest(u) AS unit, unnest(d) AS description FROM (
  SELECT page_id, regexp_extract_all(html, '{{p}}', 1) AS n, regexp_extract_all(html, '{{p}}', 2) AS k,
    regexp_extract_all(html, '{{p}}', 3) AS u, regexp_extract_all(html, '{{p}}', 4) AS d FROM src)),
every_ AS (SELECT page_id, pass, pos, code, name, unit, description FROM rows_
  UNION ALL SELECT page_id, pass, pos, code, name, unit, description FROM line)
SELECT page_id, code, name, unit, description FROM every_
QUALIFY row_number() OVER (PARTITION BY page_id, lower(code) ORDER BY pass, pos) = 1
""".replace("{p}", r"<p>([^<]*)</p><p>\(([^)]+)\)\s*(\S+)\s*([^<]*)</p>")

SOURCES = {
    "download_links": _DOWNLOADS,
    "source_citations": _CITED,
    "source_variables": _VARIABLES,
    "source_fact_counts": f"""
        SELECT p.page_id, coalesce(l.n, 0) AS n_links, coalesce(c.n, 0) AS n_citations, coalesce(v.n, 0) AS n_variables
        FROM {_SOURCE} AS p
        LEFT JOIN (SELECT page_id, count(*) AS n FROM ({_DOWNLOADS}) GROUP BY 1) AS l USING (page_id)
        LEFT JOIN (SELECT page_id, count(*) AS n FROM ({_CITED}) GROUP BY 1) AS c USING (page_id)
        LEFT JOIN (SELECT page_id, count(*) AS n FROM ({_VARIABLES}) GROUP BY 1) AS v USING (page_id)""",
    "source_facts": f"""
        SELECT 'link' AS kind, count(*) AS n, CAST(sum(length(href)) AS BIGINT) AS n_chars FROM ({_DOWNLOADS})
        UNION ALL SELECT 'citation', count(*), CAST(sum(length(text)) AS BIGINT) FROM ({_CITED})
        UNION ALL SELECT 'variable', count(*), CAST(sum(length(name)) AS BIGINT) FROM ({_VARIABLES})""",
    "ldjson_blocks": f"""
        SELECT page_id, CAST(0 AS BIGINT) AS pos,
          json_extract_string(regexp_extract(html, '<script type="application/ld\\+json">(.*?)</script>', 1), '$.name') AS name
        FROM {_SOURCE}""",
}

# ---- registry --------------------------------------------------------------------------------------

_REGISTRY = fixture_sql("registry")
_TODO = "upper(coalesce(has_jsonld, '')) IN ('FALSE', '#ERROR!', '') AND trim(webpage_url) <> ''"
_FOLDER = r"replace(rtrim(regexp_replace(name, '[^\p{L}\p{N} _-]', '', 'g')), ' ', '_')"
_DONE = f"(SELECT DISTINCT {_FOLDER} AS folder FROM {_REGISTRY} WHERE n_files > 25)"

REGISTRY = {
    "registry_todo": f"""
        SELECT row_id, name, row_number() OVER (ORDER BY row_id) AS seq, count(*) OVER () AS total
        FROM {_REGISTRY} WHERE {_TODO}""",
    "registry_skip_existing": f"""
        SELECT row_id, folder FROM (SELECT row_id, {_FOLDER} AS folder FROM {_REGISTRY} WHERE {_TODO})
        WHERE folder NOT IN {_DONE}""",
    "registry_counts": f"""
        SELECT count(*) AS n_all, count(*) FILTER (WHERE {_TODO}) AS n_todo,
          count(*) FILTER (WHERE {_TODO} AND {_FOLDER} NOT IN {_DONE}) AS n_left FROM {_REGISTRY}""",
    "registry_next": f"SELECT row_id, name FROM {_REGISTRY} WHERE {_TODO} ORDER BY row_id LIMIT 10",
    "output_names": f"""
        SELECT row_id, {_FOLDER} AS folder,
          CASE WHEN left({_FOLDER}, 50) = '' THEN 'dataset' ELSE left({_FOLDER}, 50) END || '_' || left(sha1(trim(webpage_url)), 8) || '.jsonld' AS filename
        FROM {_REGISTRY}""",
    "registry_box": f"""
        SELECT row_id, CASE WHEN box_lon_min <> '' THEN box_lon_min || ',' || box_lat_min || ' ' || box_lon_max || ',' || box_lat_max ELSE '' END AS box
        FROM {_REGISTRY}""",
}

# ---- boxes and repairs -----------------------------------------------------------------------------

_BOXES = fixture_sql("boxes")
_NUM = r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?"
_DOCS = fixture_sql("docs")
_D = f"(SELECT doc_id, site, raw, CASE WHEN json_valid(raw) THEN CAST(raw AS JSON) END AS j FROM {_DOCS})"


def _fixed(box: str) -> str:
    parts = f"string_split_regex(trim({box}), '\\s+')"
    value = [f"CAST(CAST({parts}[{i}] AS DOUBLE) AS VARCHAR)" for i in (1, 2, 3, 4)]
    return f"""CASE WHEN len({parts}) = 4 AND NOT contains({box}, ',')
      AND len(list_filter({parts}, lambda x: regexp_full_match(x, '{_NUM}'))) = 4
      THEN {value[0]} || ',' || {value[1]} || ' ' || {value[2]} || ',' || {value[3]} ELSE {box} END"""


def _checked(source: str, key: str) -> str:
    """Box check of (key, box) rows: ok, msg, order_guessed."""
    return f"""
WITH b AS (SELECT {key}, trim(coalesce(box, '')) AS t FROM {source}),
p AS (SELECT *, string_split_regex(t, '\\s+') AS w FROM b),
q AS (SELECT *, CASE WHEN len(w) = 4 THEN w
    WHEN len(w) = 2 AND len(string_split(w[1], ',')) = 2 AND len(string_split(w[2], ',')) = 2
    THEN list_concat(string_split(w[1], ','), string_split(w[2], ',')) END AS x FROM p),
n AS (SELECT *, len(list_filter(x, lambda y: regexp_full_match(trim(y), '{_NUM}'))) = 4 AS numeric,
    list_transform(x, lambda y: TRY_CAST(y AS DOUBLE)) AS v FROM q),
o AS (SELECT *, CASE WHEN len(w) = 4 AND NOT (v[2] BETWEEN -90 AND 90 AND v[4] BETWEEN -90 AND 90)
    THEN [v[2], v[1], v[4], v[3]] ELSE v END AS z FROM n),
m AS (SELECT *, CASE WHEN t = '' THEN NULL WHEN x IS NULL THEN 'box expected 2 or 4 numbers'
    WHEN NOT numeric THEN CASE WHEN len(w) = 4 THEN 'invalid box numbers' ELSE 'invalid box format' END
    WHEN NOT (z[1] BETWEEN -180 AND 180 AND z[3] BETWEEN -180 AND 180 AND z[2] BETWEEN -90 AND 90 AND z[4] BETWEEN -90 AND 90)
    THEN 'box out of range' END AS msg FROM o)
SELECT {key}, msg IS NULL AS ok, msg, coalesce(numeric AND len(w) = 4, FALSE) AS order_guessed FROM m"""


_BOX = "json_extract_string(j, '$.spatialCoverage.geo.box')"


def _cut(text: str) -> str:
    return f"list_filter(list_transform(string_split_regex({text}, '[;,]'), lambda x: trim(x)), lambda x: x <> '')"


_KEYWORDS = f"""CASE WHEN json_type(j, '$.keywords') = 'ARRAY'
    THEN list_transform(list_filter(CAST(json_extract(j, '$.keywords') AS VARCHAR[]), lambda x: x <> ''), lambda x: trim(x))
  WHEN json_type(j, '$.keywords') = 'VARCHAR' AND trim(json_extract_string(j, '$.keywords')) <> ''
    THEN {_cut("json_extract_string(j, '$.keywords')")} END"""


def _formats(node: str) -> str:
    return f"""CASE WHEN json_type({node}) = 'ARRAY'
    THEN flatten(list_transform(CAST({node} AS VARCHAR[]), lambda y: {_cut('y')}))
  WHEN json_type({node}) = 'VARCHAR' THEN {_cut(f"json_extract_string({node}, '$')")} END"""


_COMMENT_KIND = "CASE WHEN json_type(j, '$.comment') IS NULL THEN 'text' ELSE 'list' END"

REPAIRS = {
    "box_fix": f"SELECT id, {_fixed('box')} AS box FROM {_BOXES}",
    "box_check": _checked(_BOXES, "id"),
    "doc_box": f"SELECT doc_id, {_BOX} AS box FROM {_D}",
    "keywords_fix": f"""
        SELECT doc_id, CAST(i AS BIGINT) AS pos, k[i + 1] AS keyword
        FROM (SELECT doc_id, k, unnest(range(len(k))) AS i FROM (SELECT doc_id, {_KEYWORDS} AS k FROM {_D}))""",
    "encoding_fix": f"""
        SELECT doc_id, dist_idx, CAST(i AS BIGINT) AS pos, f[i + 1] AS fmt FROM (
          SELECT doc_id, dist_idx, f, unnest(range(len(f))) AS i FROM (
            SELECT doc_id, dist_idx, {_formats("node")} AS f FROM (
              SELECT doc_id, CAST(dist_idx AS BIGINT) AS dist_idx, json_extract(j, '$.distribution[' || dist_idx || '].encodingFormat') AS node
              FROM (SELECT doc_id, j, unnest(range(CAST(json_array_length(j, '$.distribution') AS BIGINT))) AS dist_idx FROM {_D}))))""",
    "comment_stamp": f"""
        SELECT doc_id, {_COMMENT_KIND} AS comment_kind,
          CAST(CASE json_type(j, '$.comment') WHEN 'ARRAY' THEN json_array_length(j, '$.comment') + 1 WHEN 'VARCHAR' THEN 2 ELSE 1 END AS BIGINT) AS n
        FROM {_D} WHERE j IS NOT NULL""",
    "normalised_docs": f"""
        SELECT doc_id, {_fixed(_BOX)} AS box,
          CASE WHEN json_type(j, '$.keywords') = 'ARRAY' OR trim(json_extract_string(j, '$.keywords')) <> '' THEN array_to_string({_KEYWORDS}, '|') END AS keywords,
          CASE WHEN json_type(node) IN ('ARRAY', 'VARCHAR') THEN array_to_string({_formats('node')}, '|') END AS formats,
          {_COMMENT_KIND} AS comment_kind
        FROM (SELECT *, json_extract(j, '$.distribution[0].encodingFormat') AS node FROM {_D} WHERE j IS NOT NULL)""",
}

# ---- replies ---------------------------------------------------------------------------------------

_RESPONSES = fixture_sql("responses")
_OPEN = r"""CASE WHEN contains(response, '```json') AND regexp_matches(response, '(?s)```json.+?```')
    THEN trim(regexp_extract(response, '(?s)```json(.*?)```', 1), chr(32) || chr(10))
  WHEN NOT contains(response, '```json') AND regexp_matches(response, '(?s)```.+?```')
    THEN trim(regexp_extract(response, '(?s)```(.*?)```', 1), chr(32) || chr(10)) ELSE response END"""
_REPLY = f"""
(SELECT *, CASE WHEN contains(open, '{{') THEN regexp_extract(open, '(?s)\\{{.*\\}}') WHEN contains(open, '[') THEN regexp_extract(open, '(?s)\\[.*\\]') END AS cut
 FROM (SELECT *, {_OPEN} AS open FROM {_RESPONSES}))"""
PARSED_REPLIES = f"""
(SELECT *, CASE WHEN json_valid(cut) THEN CAST(cut AS JSON) WHEN json_valid(open) THEN CAST(open AS JSON) END AS j,
   CASE WHEN json_valid(cut) THEN CASE WHEN cut LIKE '{{%' THEN 'object' ELSE 'array' END ELSE 'text' END AS kind FROM {_REPLY})"""
_DETECTED = f"""
SELECT doc_id, j_ AS j, d,
  CASE WHEN json_exists(d, '$.name') THEN json_extract_string(d, '$.name') ELSE site || '_dataset_' || j_ END AS name,
  CASE WHEN json_exists(d, '$.url') THEN json_extract_string(d, '$.url') ELSE site_url END AS url
FROM (SELECT doc_id, site, site_url, CAST(unnest(range(1, len(l) + 1)) AS BIGINT) AS j_, unnest(l) AS d FROM (
  SELECT doc_id, site, site_url, CASE
    WHEN json_type(j) = 'OBJECT' AND json_type(j, '$.datasets') = 'ARRAY' THEN CAST(json_extract(j, '$.datasets') AS JSON[])
    WHEN json_type(j) = 'ARRAY' THEN CAST(j AS JSON[]) ELSE [j] END AS l FROM {PARSED_REPLIES}))
"""


def _preferred(field: str, fallback: str) -> str:
    return f"CASE WHEN json_exists(d, '$.{field}') THEN json_extract_string(d, '$.{field}') ELSE coalesce({fallback}, '') END AS {field}"


_HEAD = len("Read  and list its datasets.\n\nName: \nGroup: \nAbout: \nAnswer as {\"datasets\": []}.")
_TEXT_NOTE = len(
    "**Webpage Content** (extracted text):\n\n\n**Note**: The above is the extracted text content from the webpage. "
    "Please analyze it to identify datasets and extract metadata."
)
_PROMPT = f"{_HEAD + _TEXT_NOTE} + length('https://ex.org/d/' || doc_id) + length(text) + length(source) + length(lang)"

REPLIES = {
    "response_parse": f"""
        SELECT doc_id, kind, CASE WHEN kind = 'object' THEN json_extract_string(CASE WHEN kind = 'object' THEN cut END, '$.name') END AS doc_name FROM {PARSED_REPLIES}""",
    "response_datasets": f"SELECT doc_id, j, name, url FROM ({_DETECTED})",
    "response_counts": f"SELECT doc_id, count(*) AS n_datasets FROM ({_DETECTED}) GROUP BY doc_id",
    "metadata_merge": f"""
        SELECT m.doc_id, m.j, m.name, coalesce(r.grp, '') AS grp, {_preferred('publisher', 'r.publisher')}, {_preferred('description', 'r.description')}
        FROM ({_DETECTED}) AS m LEFT JOIN {_REGISTRY} AS r ON m.doc_id = r.row_id""",
    "generation_prompts": f"""
        SELECT m.doc_id, m.j, m.name || '|' || coalesce(r.grp, '') || '|' || CASE WHEN json_exists(d, '$.publisher') THEN json_extract_string(d, '$.publisher') ELSE coalesce(r.publisher, '') END AS head,
          s.page_id IS NOT NULL AS has_facts
        FROM ({_DETECTED}) AS m LEFT JOIN {_REGISTRY} AS r ON m.doc_id = r.row_id
        LEFT JOIN {_SOURCE} AS s ON m.url = 'https://ex.org/p/' || s.page_id""",
    "prompt_sizes": f"""
        SELECT doc_id, length(text) AS n_text, {_PROMPT} AS n, {_PROMPT} > 10000 AS large FROM documents""",
}

# ---- validation and audit --------------------------------------------------------------------------

_MESSAGES = f"""
(SELECT d.doc_id, j, CASE WHEN j IS NULL THEN ['JSON Syntax Error: Invalid JSON']
   WHEN NOT json_exists(j, '$.name') THEN ['missing ''name''']
   ELSE list_concat(CASE WHEN c.ok THEN [] ELSE ['spatialCoverage box: ' || c.msg] END,
     CASE json_type(j, '$.distribution[0].encodingFormat') WHEN 'VARCHAR' THEN ['distribution[0].encodingFormat must be array, got string']
       WHEN 'UBIGINT' THEN ['distribution[0].encodingFormat must be array, got int'] ELSE [] END) END AS errors,
   CASE WHEN json_exists(j, '$.name') AND json_extract_string(j, '$."@type"') <> 'Dataset'
     THEN ['@type is ''' || json_extract_string(j, '$."@type"') || ''', expected ''Dataset'''] ELSE [] END AS warnings
 FROM {_D} AS d JOIN ({_checked(f"(SELECT doc_id, {_BOX} AS box FROM {_D})", "doc_id")}) AS c ON d.doc_id = c.doc_id)"""
_CODE_LIKE = r"""(regexp_matches(name, '\b[A-Za-z]+\d+\s*[–-]\s*[A-Za-z]*\d+\b') OR contains(name, '/')
  OR (regexp_full_match(name, '[A-Za-z][A-Za-z0-9_-]*') AND (name = lower(name) OR regexp_matches(name, '[0-9]'))))"""
_ITEMS = f"""
(SELECT doc_id, CAST(idx AS BIGINT) AS idx, json_extract(j, '$.variableMeasured[' || idx || ']') AS item,
   json_extract_string(j, '$.variableMeasured[' || idx || '].name') AS name
 FROM (SELECT doc_id, j, unnest(range(CAST(json_array_length(j, '$.variableMeasured') AS BIGINT))) AS idx FROM {_D}))"""
_MISSING = f"""
SELECT doc_id, string_agg(code, ',' ORDER BY code) AS codes, string_agg(code, ', ' ORDER BY code) AS shown FROM (
  SELECT DISTINCT v.page_id AS doc_id, lower(v.code) AS code FROM ({_VARIABLES}) AS v
  JOIN {_D} AS d ON d.doc_id = v.page_id WHERE json_type(j, '$.variableMeasured') = 'ARRAY'
  EXCEPT SELECT doc_id, lower(json_extract_string(item, '$.alternateName')) FROM {_ITEMS}) GROUP BY doc_id"""
_MATCH = f"""
SELECT d.doc_id, bool_or(l.href IN (coalesce(json_extract_string(j, '$.distribution[0].contentUrl'), ''), coalesce(json_extract_string(j, '$.distribution[1].contentUrl'), ''))) AS matched
FROM {_D} AS d JOIN ({_DOWNLOADS}) AS l ON l.page_id = d.doc_id WHERE j IS NOT NULL GROUP BY d.doc_id"""
_WARNINGS = f"""
SELECT doc_id, 0 AS step, 0 AS idx, CASE json_type(j, '$.citation') WHEN 'VARCHAR' THEN 'citation is a string; expected an array of structured citation objects'
   ELSE 'citation array contains string entries; expected structured citation objects' END AS warning
 FROM {_D} WHERE json_type(j, '$.citation') = 'VARCHAR' OR json_type(j, '$.citation[0]') = 'VARCHAR'
UNION ALL SELECT doc_id, 1, idx * 3, 'variableMeasured[' || idx || '].name looks like a code or lumped range' FROM {_ITEMS} WHERE {_CODE_LIKE}
UNION ALL SELECT doc_id, 1, idx * 3 + 1, 'variableMeasured[' || idx || '] is missing temporalCoverage' FROM {_ITEMS} WHERE NOT json_exists(item, '$.temporalCoverage')
UNION ALL SELECT doc_id, 1, idx * 3 + 2, 'variableMeasured[' || idx || '] is missing spatialCoverage' FROM {_ITEMS} WHERE NOT json_exists(item, '$.spatialCoverage')
UNION ALL SELECT doc_id, 2, 0, 'variableMeasured is missing source-listed variable code(s): ' || shown FROM ({_MISSING})
UNION ALL SELECT doc_id, 3, 0, 'distribution does not include any exact source-page Download href' FROM ({_MATCH}) WHERE NOT matched"""
_TEMPORAL = f"""
(SELECT doc_id, idx, CAST(0 AS BIGINT) AS part, json_extract_string(item, '$.temporalCoverage') AS t FROM {_ITEMS} WHERE json_type(item, '$.temporalCoverage') = 'VARCHAR'
 UNION ALL SELECT doc_id, idx, CAST(part AS BIGINT), json_extract_string(item, '$.temporalCoverage[' || part || ']')
 FROM (SELECT doc_id, idx, item, unnest(range(CAST(json_array_length(item, '$.temporalCoverage') AS BIGINT))) AS part FROM {_ITEMS} WHERE json_type(item, '$.temporalCoverage') = 'ARRAY'))"""
_DATE = r"\d{4}(-\d{2}(-\d{2})?)?"

CHECKS = {
    "validate_docs": f"""
        SELECT doc_id, len(errors) = 0 AS ok, array_to_string(list_concat(errors, warnings), '; ') AS messages FROM {_MESSAGES}""",
    "validate_summary": f"""
        SELECT count(*) AS n, count(*) FILTER (WHERE len(errors) > 0) AS n_failed, count(*) FILTER (WHERE len(warnings) > 0) AS n_warned,
          CAST(coalesce(sum(json_array_length(j, '$.distribution')) FILTER (WHERE len(errors) = 0), 0) AS BIGINT) AS n_distribution,
          bool_and(len(errors) = 0) AS all_ok FROM {_MESSAGES}""",
    "validate_passed": f"""
        SELECT doc_id, json_extract_string(j, '$."@type"') AS type,
          CASE WHEN length(json_extract_string(j, '$.name')) > 50 THEN left(json_extract_string(j, '$.name'), 47) || '...' ELSE json_extract_string(j, '$.name') END AS name,
          {_BOX} AS box, CAST(json_array_length(j, '$.distribution') AS BIGINT) AS n_distribution
        FROM {_MESSAGES} WHERE len(errors) = 0""",
    "audit_names": f"SELECT doc_id, idx, name FROM {_ITEMS} WHERE {_CODE_LIKE}",
    "audit_missing_codes": f"SELECT doc_id, codes FROM ({_MISSING})",
    "audit_download_match": _MATCH,
    "audit_docs": f"""
        SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY step, idx) - 1 AS idx, warning FROM ({_WARNINGS})""",
    "contract_rules": f"""
        SELECT doc_id, unnest(['context_vocab', 'type', 'id', 'keywords_array', 'encoding_array', 'citation_array', 'variable_coverage', 'comment']) AS rule,
          unnest([TRUE, json_extract_string(j, '$."@type"') IN ('Dataset', 'DataCatalog'), json_exists(j, '$."@id"'),
            json_type(j, '$.keywords') = 'ARRAY', coalesce(json_type(j, '$.distribution[0].encodingFormat') = 'ARRAY', TRUE),
            coalesce(json_type(j, '$.citation') = 'ARRAY' AND json_type(j, '$.citation[0]') = 'OBJECT', TRUE),
            NOT json_exists(j, '$.variableMeasured'), FALSE]) AS ok
        FROM {_D} WHERE j IS NOT NULL""",
    "plan_rules": f"""
        SELECT doc_id, unnest(['variables', 'citations', 'download']) AS rule, unnest([ok_v, ok_c, ok_d]) AS ok FROM (
          SELECT d.doc_id, NOT EXISTS (SELECT 1 FROM ({_VARIABLES}) AS v WHERE v.page_id = d.doc_id
              AND lower(v.code) NOT IN (coalesce(lower(json_extract_string(j, '$.variableMeasured[0].alternateName')), ''), coalesce(lower(json_extract_string(j, '$.variableMeasured[1].alternateName')), ''))) AS ok_v,
            coalesce(CASE WHEN json_type(j, '$.citation') = 'ARRAY' THEN json_array_length(j, '$.citation') END, 0) >= (SELECT count(*) FROM ({_CITED}) AS c WHERE c.page_id = d.doc_id) AS ok_c,
            (SELECT matched FROM ({_MATCH}) AS m WHERE m.doc_id = d.doc_id) AS ok_d
          FROM {_D} AS d WHERE j IS NOT NULL)""",
    "variable_coverage": f"""
        SELECT doc_id, idx, name, coalesce(json_extract_string(item, '$.temporalCoverage'), 'Static') AS temporal,
          coalesce(json_extract_string(item, '$.spatialCoverage'), 'not detected') AS spatial FROM {_ITEMS}""",
    "temporal_intervals": f"""
        SELECT doc_id, idx, part,
          CASE WHEN kind IN ('closed', 'open', 'bp') THEN split_part(t, '/', 1) WHEN kind = 'single' THEN t END AS start,
          CASE WHEN kind IN ('closed', 'bp') THEN split_part(t, '/', 2) WHEN kind = 'single' THEN t END AS "end", kind
        FROM (SELECT *, CASE WHEN t = 'Static' THEN 'static' WHEN regexp_full_match(t, '\\d+BP/\\d+BP') THEN 'bp'
            WHEN regexp_full_match(t, '{_DATE}/\\.\\.') THEN 'open' WHEN regexp_full_match(t, '{_DATE}/{_DATE}') THEN 'closed'
            WHEN regexp_full_match(t, '{_DATE}') THEN 'single' ELSE 'other' END AS kind FROM {_TEMPORAL})""",
}

# ---- failures --------------------------------------------------------------------------------------

_FAILURES = fixture_sql("failures")
_REASON = """CASE WHEN regexp_matches(lower(message), 'timeout|timed out|connection refused|connection reset|connection error|upstream connect error|disconnect/reset|delayed connect error') THEN 'timeout'
  WHEN regexp_matches(lower(message), '500|502|503|504|internal server error') THEN 'server_error' ELSE 'detection_error' END"""

FAILURES = {
    "failure_class": f"""
        SELECT event_id, {_REASON} AS reason, CASE WHEN regexp_matches(message, '429|RESOURCE_EXHAUSTED|(?i:quota)')
          THEN CASE WHEN wait IS NULL THEN CAST(30 AS DOUBLE) WHEN wait + 5 > 60 THEN 60 ELSE wait + 5 END END AS delay
        FROM (SELECT *, TRY_CAST(regexp_extract(message, '(?i)retry in ([0-9.]+)s', 1) AS DOUBLE) AS wait FROM {_FAILURES})""",
    "failure_summary": f"""
        SELECT reason, CASE reason WHEN 'timeout' THEN 'Timeout' WHEN 'server_error' THEN 'Server Error' ELSE 'Detection Error' END AS title, count(*) AS n
        FROM (SELECT {_REASON} AS reason FROM {_FAILURES}) GROUP BY reason""",
}

# ---- sitemaps and catalogues -----------------------------------------------------------------------

_SITEMAP = fixture_sql("sitemap")
_CATALOGUES = fixture_sql("catalogues")
_IDS = f"(SELECT json_extract_string(j, '$.\"@id\"') AS id, json_extract_string(j, '$.name') AS name FROM {_D} WHERE json_exists(j, '$.\"@id\"'))"
_PARTS = f"""
(SELECT cat_id, 'https://ex.org/c/' || cat_id AS parent_id, CAST(i AS BIGINT) AS pos, json_extract_string(raw, '$.hasPart[' || i || '].url') AS url
 FROM (SELECT *, unnest(range(CAST(json_array_length(raw, '$.hasPart') AS BIGINT))) AS i FROM {_CATALOGUES}))"""

CATALOGUES = {
    "sitemap_reconcile": f"""
        SELECT coalesce(l.loc, p.loc) AS loc, CASE WHEN p.loc IS NULL AND lower(l.loc) LIKE '%.xml' THEN 'nested_sitemap'
          WHEN p.loc IS NULL THEN 'missing' WHEN l.loc IS NULL THEN 'unlisted' ELSE 'both' END AS state
        FROM (SELECT DISTINCT loc FROM {_SITEMAP} WHERE listed) AS l FULL OUTER JOIN (SELECT DISTINCT loc FROM {_SITEMAP} WHERE present) AS p ON l.loc = p.loc""",
    "sitemap_incremental": f"""
        SELECT page_id, loc, lastmod FROM {_SITEMAP}
        WHERE CAST(CASE WHEN length(lastmod) = 10 THEN lastmod || 'T00:00:00Z' ELSE lastmod END AS TIMESTAMPTZ) > TIMESTAMPTZ '2024-01-15 00:00:00+00'""",
    "sitemap_union": f"""
        SELECT loc, arg_max(lastmod, CAST(lastmod AS TIMESTAMPTZ)) AS lastmod FROM (
          SELECT loc, lastmod FROM {_SITEMAP} WHERE listed
          UNION ALL SELECT loc, replace(lastmod, 'T10:00:00Z', 'T11:30:00+02:00') FROM {_SITEMAP} WHERE present) GROUP BY loc""",
    "catalog_parts": f"SELECT cat_id, pos, url FROM {_PARTS} WHERE url IS NOT NULL",
    "catalog_dangling": f"""
        SELECT parent_id, child_id FROM (
          SELECT json_extract_string(raw, '$."@id"') AS parent_id, unnest([json_extract_string(raw, '$.dataset[0]."@id"'), json_extract_string(raw, '$.dataset[1]."@id"')]) AS child_id
          FROM {_CATALOGUES}) WHERE child_id NOT IN (SELECT id FROM {_IDS})""",
    "page_references": f"""
        SELECT r.parent_id, 'about' AS relation, r.child_id, i.name AS target_name
        FROM (SELECT json_extract_string(j, '$."@id"') AS parent_id, json_extract_string(j, '$.about[0]."@id"') AS child_id FROM {_D} WHERE json_exists(j, '$.about')) AS r
        LEFT JOIN {_IDS} AS i ON r.child_id = i.id""",
    "parent_links": f"""
        SELECT child_id, parent_id, parent_id IN (SELECT id FROM {_IDS}) AS present FROM (
          SELECT json_extract_string(j, '$."@id"') AS child_id, coalesce(json_extract_string(j, '$.isPartOf."@id"'), json_extract_string(j, '$.isPartOf')) AS parent_id
          FROM {_D} WHERE json_exists(j, '$.isPartOf'))""",
    "catalog_walk": f"""
        WITH RECURSIVE e AS (SELECT DISTINCT parent_id, url FROM {_PARTS} WHERE url IS NOT NULL),
        w AS (SELECT min(parent_id) AS url, CAST(0 AS BIGINT) AS depth FROM e UNION SELECT e.url, w.depth + 1 FROM w JOIN e ON e.parent_id = w.url WHERE w.depth < 64)
        SELECT url, min(depth) AS depth, url NOT IN (SELECT parent_id FROM e) AS leaf FROM w GROUP BY url""",
    "catalog_edges": f"""
        SELECT relation, count(*) AS n, count(DISTINCT parent_id) AS n_parents FROM (
          SELECT 'hasPart' AS relation, cat_id AS parent_id FROM {_PARTS} WHERE url IS NOT NULL
          UNION ALL SELECT 'dataset', unnest([o_orderkey, o_orderkey]) FROM orders
          UNION ALL SELECT 'isPartOf', CAST(regexp_extract(coalesce(json_extract_string(j, '$.isPartOf."@id"'), json_extract_string(j, '$.isPartOf')), '([0-9]+)$', 1) AS BIGINT)
            FROM {_D} WHERE json_exists(j, '$.isPartOf')) GROUP BY relation""",
    "catalog_sources": "SELECT page_id, 'https://' || regexp_replace(url, '^https?://', '') AS url FROM pages",
    "doi_urls": f"""
        SELECT doc_id, CAST(unnest(range(len(u))) AS BIGINT) AS pos, unnest(u) AS url
        FROM (SELECT doc_id, regexp_extract_all(text, 'https://doi.org/\\S+') AS u FROM {fixture_sql('doi_texts')})""",
}

# ---- walks -----------------------------------------------------------------------------------------

_EDGES = fixture_sql("edges")


def _walk(depth: int) -> str:
    return f"""
WITH RECURSIVE e AS MATERIALIZED (SELECT DISTINCT src, dst FROM {_EDGES}),
w AS (SELECT min(src) AS url, CAST(0 AS BIGINT) AS depth FROM e UNION SELECT e.dst, w.depth + 1 FROM w JOIN e ON e.src = w.url WHERE w.depth < {depth})
SELECT url, min(depth) AS depth FROM w GROUP BY url"""


WALKS = {
    "new_links": f"SELECT DISTINCT dst AS url FROM {_EDGES} WHERE dst NOT IN (SELECT s_suppkey FROM supplier)",
    "crawl_levels": _walk(64),
    "crawl_bounded": _walk(3),
    "crawl_order": f"""
        WITH RECURSIVE e AS MATERIALIZED (SELECT src, dst, pos FROM {_EDGES}),
        w AS (SELECT min(src) AS url, CAST(0 AS BIGINT) AS depth, '0' AS path FROM e
          UNION ALL SELECT e.dst, w.depth + 1, w.path || '/' || e.pos FROM w JOIN e ON e.src = w.url WHERE w.depth < 5)
        SELECT url, depth, path FROM w QUALIFY row_number() OVER (PARTITION BY url ORDER BY depth, path) = 1""",
    "crawl_queue": f"""
        WITH RECURSIVE e AS MATERIALIZED (SELECT src, dst, pos FROM {_EDGES}),
        w AS (SELECT min(src) AS url, CAST(0 AS BIGINT) AS depth, '0' AS path FROM e
          UNION ALL SELECT e.dst, w.depth + 1, w.path || '/' || e.pos FROM w JOIN e ON e.src = w.url WHERE w.depth < 5)
        SELECT url, depth, row_number() OVER (ORDER BY depth, path) AS place FROM (
          SELECT * FROM w QUALIFY row_number() OVER (PARTITION BY url ORDER BY depth, path) = 1)""",
    "redirect_final": f"""
        WITH RECURSIVE r AS MATERIALIZED (SELECT from_id, to_id, status FROM {fixture_sql('redirects')} WHERE to_id IS NOT NULL),
        w AS (SELECT from_id, to_id AS final_id, CAST(1 AS BIGINT) AS hops, status = 303 AS seen, [from_id] AS past FROM r
          UNION ALL SELECT w.from_id, r.to_id, w.hops + 1, w.seen OR r.status = 303, list_append(w.past, w.final_id)
          FROM w JOIN r ON r.from_id = w.final_id WHERE NOT list_contains(w.past, w.final_id))
        SELECT from_id, final_id, hops FROM w WHERE seen AND final_id NOT IN (SELECT from_id FROM r)""",
}

# ---- quads -----------------------------------------------------------------------------------------

_LINE = r'^<([^>]*)> <([^>]*)> (<[^>]*>|"(?:[^"\\]|\\.)*"(?:@[a-z]+|\^\^<[^>]*>)?) <([^>]*)> \.$'
_TERMS = f"""
(SELECT s, p, g, CASE WHEN o LIKE '<%' THEN 'iri' ELSE 'literal' END AS kind,
   CASE WHEN o LIKE '<%' THEN trim(o, '<>') ELSE replace(replace(regexp_extract(o, '^"(.*)"[^"]*$', 1), chr(92) || '"', '"'), chr(92) || 'u00e9', 'é') END AS value,
   nullif(regexp_extract(o, '\\^\\^<([^>]*)>$', 1), '') AS datatype,
   CASE WHEN o LIKE '"%' THEN nullif(regexp_extract(o, '"@([a-z]+)$', 1), '') END AS language
 FROM (SELECT regexp_extract(line, '{_LINE}', 1) AS s, regexp_extract(line, '{_LINE}', 2) AS p, regexp_extract(line, '{_LINE}', 3) AS o, regexp_extract(line, '{_LINE}', 4) AS g
   FROM {fixture_sql('quads')}))"""
_TYPE = "http://www.w3.org/1999/02/22-rdf-syntax-ns#type"
_XSD = "http://www.w3.org/2001/XMLSchema#"

def _diff() -> str:
    """Differing quads of the two releases with unnamed nodes replaced by what hangs on them."""

    def canon(name: str) -> str:
        return f"""
(WITH r AS (SELECT * FROM {fixture_sql(name)}),
 leaf AS (SELECT s AS node, g, 'x{{' || value || '}}' AS label FROM r WHERE s LIKE '%/genid/%-x'),
 inner_ AS (SELECT n.s AS node, n.g, 'y{{' || n.value || ',' || l.label || '}}' AS label FROM r AS n
   JOIN r AS k ON k.s = n.s AND k.g = n.g AND k.p = 'https://schema.org/subjectOf' JOIN leaf AS l ON l.node = k.value AND l.g = n.g
   WHERE n.s LIKE '%/genid/%' AND n.p = 'https://schema.org/name'),
 label AS (SELECT * FROM leaf UNION ALL SELECT * FROM inner_)
 SELECT coalesce(a.label, r.s) AS s, r.p, coalesce(b.label, r.value) AS o, r.g, count(*) AS n FROM r
 LEFT JOIN label AS a ON a.node = r.s AND a.g = r.g LEFT JOIN label AS b ON b.node = r.value AND b.g = r.g GROUP BY ALL)"""

    return f"""
SELECT p, CASE WHEN d > 0 THEN 'left' ELSE 'right' END AS side, CAST(sum(abs(d)) AS BIGINT) AS n FROM (
  SELECT s, p, o, g, sum(n) AS d FROM (SELECT s, p, o, g, n FROM {canon('release_left')} UNION ALL SELECT s, p, o, g, -n FROM {canon('release_right')})
  GROUP BY s, p, o, g HAVING sum(n) <> 0) GROUP BY ALL"""


def _tangled_diff() -> str:
    """Differing quads where a node on a ring is known by the ring's length and a shared one by who leads to it."""

    def canon(name: str) -> str:
        return f"""
(WITH RECURSIVE r AS (SELECT * FROM {fixture_sql(name)}),
 steps AS (SELECT s AS node, value AS at, 1 AS n FROM r WHERE p = 'https://schema.org/isRelatedTo'
   UNION ALL SELECT steps.node, r.value, n + 1 FROM steps JOIN r ON r.s = steps.at AND r.p = 'https://schema.org/isRelatedTo' WHERE steps.at <> steps.node),
 label AS (SELECT node, 'ring ' || CAST(max(n) AS VARCHAR) AS label FROM steps GROUP BY node
   UNION ALL SELECT value, 'led to ' || string_agg(p || ' ' || s, ' ' ORDER BY p, s) FROM r WHERE g LIKE '%shared%' AND kind = 'iri' GROUP BY value)
 SELECT coalesce(a.label, r.s) AS s, r.p, coalesce(b.label, r.value) AS o, r.g, count(*) AS n FROM r
 LEFT JOIN label AS a ON a.node = r.s LEFT JOIN label AS b ON b.node = r.value GROUP BY ALL)"""

    return f"""
SELECT p, CASE WHEN d > 0 THEN 'left' ELSE 'right' END AS side, CAST(sum(abs(d)) AS BIGINT) AS n FROM (
  SELECT s, p, o, g, sum(n) AS d FROM (SELECT s, p, o, g, n FROM {canon('tangled_left')} UNION ALL SELECT s, p, o, g, -n FROM {canon('tangled_right')})
  GROUP BY s, p, o, g HAVING sum(n) <> 0) GROUP BY ALL"""


def _flat() -> str:
    """Statements of the distinct documents by predicate, kind and datatype, counted from the JSON tree."""
    docs = f"(SELECT DISTINCT raw, j FROM {_D} WHERE j IS NOT NULL)"
    tree = f"(SELECT d.raw, t.* FROM {docs} AS d, json_tree(d.j) AS t)"
    key = r"regexp_extract(path, '\.\"?([A-Za-z]+)\"?(?:\[[0-9]+\])?$', 1)"
    return f"""
SELECT p, kind, datatype, count(*) AS n FROM (
  SELECT DISTINCT raw, subject, p, kind, datatype, value FROM (
    SELECT raw, CASE WHEN key IS NULL OR regexp_full_match(CAST(key AS VARCHAR), '[0-9]+') THEN regexp_replace(path, '\\.[^.]*$', '') ELSE path END AS subject,
      CASE WHEN key = '@type' THEN '{_TYPE}' WHEN regexp_full_match(CAST(key AS VARCHAR), '[0-9]+') THEN 'https://schema.org/' || regexp_extract(path, '([A-Za-z]+)"?$', 1)
        ELSE 'https://schema.org/' || key END AS p,
      CASE WHEN key = '@type' OR type = 'OBJECT' THEN 'iri' ELSE 'literal' END AS kind,
      CASE WHEN type = 'UBIGINT' THEN '{_XSD}integer' END AS datatype,
      CASE WHEN type = 'OBJECT' THEN fullkey ELSE CAST(atom AS VARCHAR) END AS value
    FROM {tree} WHERE fullkey <> '$' AND type <> 'ARRAY' AND coalesce(CAST(key AS VARCHAR), '') NOT IN ('@context', '@id')))
GROUP BY p, kind, datatype"""


QUADS = {
    "quad_terms": f"SELECT s, p, value, kind, datatype, language, g FROM {_TERMS}",
    "quad_typed": f"""
        SELECT s, CASE WHEN datatype = '{_XSD}boolean' THEN CAST(value AS BOOLEAN) END AS as_boolean,
          CASE WHEN datatype = '{_XSD}integer' THEN CAST(value AS BIGINT) END AS as_long FROM {_TERMS} WHERE datatype IS NOT NULL""",
    "quad_profile": f"SELECT p, count(*) AS n FROM {_TERMS} GROUP BY p",
    "quad_graphs": f"SELECT g, count(*) AS n, split_part(g, ':', 4) AS source, split_part(g, ':', 6) AS sha FROM {_TERMS} GROUP BY g",
    "quad_entities": f"""
        SELECT t.g, t.s, coalesce(string_agg(DISTINCT n.value, '|' ORDER BY n.value) FILTER (n.p = 'https://schema.org/name'), '') AS name,
          coalesce(string_agg(DISTINCT n.value, '|' ORDER BY n.value) FILTER (n.p = 'https://schema.org/value'), '') AS value
        FROM {_TERMS} AS t JOIN {_TERMS} AS n ON n.g = t.g AND n.s = t.s
        WHERE t.p = '{_TYPE}' AND t.value = 'https://schema.org/Organization' GROUP BY t.g, t.s""",
    "rejected_pages": "SELECT page_id FROM pages WHERE page_id % 5 = 0",
    "rejected_docs": f"SELECT doc_id FROM {fixture_sql('docs')} AS d WHERE doc_id % 97 = 0 OR NOT json_valid(raw)",
    "quad_types": f"SELECT value AS type, count(*) AS n FROM {_TERMS} WHERE p = '{_TYPE}' GROUP BY value",
    "quad_follow": f"""
        SELECT DISTINCT t.g, t.s, v.value AS middle, c.value AS value FROM {_TERMS} AS t
        JOIN {_TERMS} AS v ON v.g = t.g AND v.s = t.s AND v.p = 'https://schema.org/value'
        JOIN {_TERMS} AS c ON c.g = t.g AND c.s = v.value AND c.p = 'https://schema.org/contentUrl'
        WHERE t.p = '{_TYPE}' AND t.value = 'https://schema.org/Organization'""",
    "quad_entity_values": f"""
        SELECT DISTINCT q.g, q.s, q.p, q.value FROM {_TERMS} AS q JOIN {_TERMS} AS t ON t.g = q.g AND t.s = q.s
        WHERE t.p = '{_TYPE}' AND t.value = 'https://schema.org/Person' AND q.p IN ('https://schema.org/name', 'https://schema.org/value')""",
    "quad_union": f"""
        SELECT g, count(*) AS n FROM (SELECT * FROM {fixture_sql('release_left')} UNION SELECT * FROM {fixture_sql('release_right')}) GROUP BY g""",
    "quad_union_diff": _diff(),
    "quad_tangled_diff": _tangled_diff(),
    "doc_quads": _flat(),
}

# ---- identity and rasters --------------------------------------------------------------------------

REST = {
    "duplicate_docs": f"""
        SELECT sha1(raw) AS sha, count(*) AS n, count(DISTINCT site) AS n_sources FROM {fixture_sql('copies')} GROUP BY raw HAVING count(*) > 1""",
    "doc_integrity": f"""
        SELECT doc_id, regexp_extract(path, '([0-9a-f]{{40}})', 1) AS stem, regexp_extract(path, '([0-9a-f]{{40}})', 1) = sha1(raw) AS intact
        FROM {fixture_sql('files')} WHERE regexp_matches(path, '[0-9a-f]{{40}}')""",
    "tile_extent": f"""
        SELECT collection, CAST(min(origin_x) AS DOUBLE) AS west, min(origin_y - height * abs(res_y)) AS south,
          max(origin_x + width * abs(res_x)) AS east, CAST(max(origin_y) AS DOUBLE) AS north FROM {fixture_sql('rasters')} GROUP BY collection""",
}

ORACLES: dict[str, str] = {
    **PAGES,
    **SOURCES,
    **REGISTRY,
    **REPAIRS,
    **REPLIES,
    **CHECKS,
    **FAILURES,
    **CATALOGUES,
    **WALKS,
    **QUADS,
    **REST,
}

"""Inputs derived from the given tables: one SQL text per input, run by Spark and by the checking engine alike.

Tables are written `@name@`. JSON, HTML and N-Quads are built by concatenation, so both engines see the same
text. Every input uses all rows of its tables.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

REGISTRY = """
SELECT p_partkey AS row_id,
  CASE p_partkey % 6 WHEN 0 THEN 'TRUE' WHEN 1 THEN 'FALSE' WHEN 2 THEN '#ERROR!' WHEN 3 THEN ''
    WHEN 4 THEN 'false' ELSE NULL END AS has_jsonld,
  CASE WHEN p_partkey % 7 = 0 THEN '  '
    ELSE 'https://data.example.org/' || lower(n_name) || '/' || CAST(p_partkey AS VARCHAR(20)) END AS webpage_url,
  p_name || ' ' || CAST(p_partkey AS VARCHAR(20)) || CASE p_partkey % 3 WHEN 0 THEN ' (v1.0) '
    WHEN 1 THEN ': Data_Set-é for the long term archive of the region' ELSE '' END AS name,
  n_name AS grp, p_size AS n_files, p_type AS publisher, 'About ' || p_name AS description,
  CASE WHEN p_partkey % 4 = 0 THEN '' ELSE CAST(n_nationkey - 20 AS VARCHAR(20)) END AS box_lon_min,
  '-10' AS box_lat_min, '40' AS box_lon_max, '10.5' AS box_lat_max
FROM @part@ JOIN @nation@ ON p_partkey % 25 = n_nationkey
"""

BOXES = """
SELECT c_custkey AS id,
  CASE c_custkey % 12
    WHEN 0 THEN '20 -40 50 10'
    WHEN 1 THEN CAST(c_custkey % 90 AS VARCHAR(20)) || ',-40 50,10.5'
    WHEN 2 THEN '-46.5 -162.75 71.25 176.5'
    WHEN 3 THEN '200,10 210,20'
    WHEN 4 THEN 'a,b c,d'
    WHEN 5 THEN '1 2 3'
    WHEN 6 THEN '1 2 3 x'
    WHEN 7 THEN ''
    WHEN 8 THEN CAST(c_custkey % 180 AS VARCHAR(20)) || '.25 -5.5 ' || CAST(c_custkey % 90 AS VARCHAR(20)) || ' +7.125'
    WHEN 9 THEN '  10   20 30 40 '
    WHEN 10 THEN '1,2 3'
    ELSE '1,2,3 4,5' END AS box
FROM @customer@
"""

DOCS = """
SELECT p_partkey AS doc_id, p_brand AS site,
  CASE p_partkey % 10
    WHEN 0 THEN '{"@context":"https://schema.org/","@type":"Dataset","keywords":["' || p_type || '"]}'
    WHEN 1 THEN '{not json ' || p_name
    ELSE '{"@context":"https://schema.org/","@type":"'
      || CASE p_partkey % 4 WHEN 0 THEN 'WebPage' WHEN 1 THEN 'Dataset' WHEN 2 THEN 'DataCatalog' ELSE 'Thing' END
      || '","@id":"https://ex.org/ds/' || CAST(p_partkey AS VARCHAR(20)) || '","name":"' || p_name || '"'
      || ',"isPartOf":' || CASE p_partkey % 3
           WHEN 0 THEN '"https://ex.org/ds/' || CAST(CAST(floor(p_partkey / 4) AS BIGINT) AS VARCHAR(20)) || '"'
           ELSE '{"@id":"https://ex.org/ds/' || CAST(CAST(floor(p_partkey / 3) AS BIGINT) AS VARCHAR(20)) || '"}' END
      || ',"about":[{"@id":"https://ex.org/ds/' || CAST(p_partkey + 1 AS VARCHAR(20)) || '"}]'
      || CASE p_partkey % 4 WHEN 0 THEN ',"comment":"seen"' WHEN 1 THEN ',"comment":["one","two"]' ELSE '' END
      || ',"keywords":' || CASE p_partkey % 3 WHEN 0 THEN '"a; ' || p_type || ' ,c;"'
           WHEN 1 THEN '["x"," ' || p_brand || ' ",""," "]' ELSE '""' END
      || ',"spatialCoverage":{"geo":{"box":"' || CASE p_partkey % 5 WHEN 0 THEN '1 2 3' WHEN 1 THEN '20 -40 50 10.25'
           WHEN 2 THEN '95 10 100 20' ELSE '20,-40 50,10' END || '"}}'
      || ',"distribution":[{"contentUrl":"https://ex.org/f/' || CAST(p_partkey % 7 AS VARCHAR(20)) || '","encodingFormat":'
      || CASE p_partkey % 6 WHEN 0 THEN '"text/csv; text/html"' WHEN 1 THEN '7'
           WHEN 2 THEN '["text/csv, a/b"," c/d "]' ELSE '["text/csv"]' END || '},{"contentUrl":"https://ex.org/g"}]'
      || ',"citation":' || CASE p_partkey % 8 WHEN 2 THEN '"Doe 2020"' WHEN 3 THEN '["Doe 2020"]' ELSE '[{"name":"Doe"}]' END
      || ',"variableMeasured":[{"name":"' || CASE p_partkey % 7 WHEN 2 THEN 'BIO1-BIO19' WHEN 3 THEN 'tas/pr'
           WHEN 4 THEN 'lossyear' ELSE 'Air temperature' END
      || '","alternateName":"v' || CAST(p_partkey % 4 AS VARCHAR(20)) || '"'
      || CASE p_partkey % 5 WHEN 0 THEN ',"temporalCoverage":"1985-01-01/.."' WHEN 1 THEN ',"temporalCoverage":"Static"'
           WHEN 2 THEN ',"temporalCoverage":["1900-01-01/2000-12-31","21000BP/0BP"]'
           WHEN 3 THEN ',"temporalCoverage":"2015-09-02"' ELSE '' END
      || CASE WHEN p_partkey % 2 = 0 THEN ',"spatialCoverage":"not detected"' ELSE '' END
      || '},{"name":"Snow ' || p_name || '","alternateName":"sn' || CAST(p_size AS VARCHAR(20)) || '"}]}' END AS raw
FROM @part@
"""

RESPONSES = f"""
SELECT doc_id, 'site ' || CAST(doc_id AS VARCHAR(20)) AS site,
  'https://ex.org/p/' || CAST(doc_id AS VARCHAR(20)) AS site_url,
  CASE doc_id % 9
    WHEN 0 THEN 'Here it is:' || chr(10) || '```json' || chr(10) || raw || chr(10) || '```' || chr(10) || 'Done.'
    WHEN 1 THEN '```' || chr(10) || raw || chr(10) || '```'
    WHEN 2 THEN '```json' || chr(10) || raw
    WHEN 3 THEN '[' || raw || ']'
    WHEN 4 THEN '[' || raw || ',' || raw || ']'
    WHEN 5 THEN 'no data for ' || CAST(doc_id AS VARCHAR(20))
    WHEN 6 THEN '{{"datasets":[{{"name":"A ' || CAST(doc_id AS VARCHAR(20)) || '","publisher":"P"}},{{"url":"https://ex.org/u"}},{{"name":"","publisher":""}}]}}'
    WHEN 7 THEN 'Sure: {{"summary":"x ' || site || '"}} Bye'
    ELSE '{{"datasets":"none","description":"d"}}' END AS response
FROM ({DOCS}) AS docs
"""

SOURCE_PAGES = """
SELECT p_partkey AS page_id, 'https://ex.org/p/' || CAST(p_partkey AS VARCHAR(20)) || '/index.html' AS base_url,
  '<html><head><script type="application/ld+json">{"@type":"Dataset","name":"' || p_name || '"}</script></head><body>'
  || '<a href="/f/' || CAST(p_partkey % 7 AS VARCHAR(20)) || '">Download</a><a href="/f/' || CAST(p_partkey % 7 AS VARCHAR(20)) || '">Download</a>'
  || '<a href="about.html">About</a><a href="https://other.example.com/x">My data</a><a href="../download/' || p_brand || '">Get</a>'
  || '<p>' || CASE p_partkey % 3 WHEN 0 THEN 'Model Citation' WHEN 1 THEN 'Data Citation' ELSE 'Data citation' END || '</p><p>Doe et al. ' || CAST(p_size AS VARCHAR(20)) || '</p>'
  || '<table><tr><th>Code</th><th>Name</th></tr><tr><td>v' || CAST(p_partkey % 4 AS VARCHAR(20)) || '</td><td>' || p_name || '</td><td>K</td></tr>'
  || '<tr><td>V' || CAST(p_partkey % 3 AS VARCHAR(20)) || '</td><td>' || p_type || '</td></tr><tr><td>9x</td><td>bad</td></tr></table>'
  || '<p>Wind speed</p><p>(ws) m/s mean wind</p><p>Size</p><p>(V' || CAST(p_partkey % 4 AS VARCHAR(20)) || ') cm size of ' || p_name || '</p></body></html>' AS html
FROM @part@
"""

FAILURES = """
SELECT event_id, event_type || ' site ' || CAST(user_id AS VARCHAR(20)) AS name,
  CASE event_id % 8 WHEN 0 THEN 'Request timed out' WHEN 1 THEN 'HTTP 503 Service Unavailable'
    WHEN 2 THEN 'Connection refused by peer'
    WHEN 3 THEN '429 RESOURCE_EXHAUSTED: retry in ' || CAST(event_id % 40 AS VARCHAR(20)) || '.5s'
    WHEN 4 THEN 'Quota: Retry in 90s' WHEN 5 THEN 'row 1500 is bad' WHEN 6 THEN 'quota reached'
    ELSE 'KeyError: ' || event_type END AS message
FROM @events@
"""

SITEMAP = """
SELECT page_id, CASE WHEN page_id % 17 = 0 THEN url || '/sitemap.xml' ELSE url END AS loc,
  CASE page_id % 3 WHEN 0 THEN '2024-01-' || lpad(CAST(page_id % 28 + 1 AS VARCHAR(20)), 2, '0')
    WHEN 1 THEN '2024-01-' || lpad(CAST(page_id % 28 + 1 AS VARCHAR(20)), 2, '0') || 'T10:00:00Z'
    ELSE '2024-01-' || lpad(CAST(page_id % 28 + 1 AS VARCHAR(20)), 2, '0') || 'T10:00:00+02:00' END AS lastmod,
  page_id % 13 <> 0 AS listed, page_id % 11 <> 0 AND page_id % 17 <> 0 AS present
FROM @pages@
"""

CATALOGUES = """
SELECT o_orderkey AS cat_id,
  '{"@type":"DataCatalog","@id":"https://ex.org/cat/' || CAST(o_orderkey AS VARCHAR(20)) || '","url":"https://ex.org/c/'
  || CAST(o_orderkey AS VARCHAR(20)) || '","dataset":[{"@id":"https://ex.org/ds/' || CAST(o_custkey AS VARCHAR(20))
  || '"},{"@id":"https://ex.org/ds/' || CAST(o_orderkey AS VARCHAR(20)) || '"}],"hasPart":[{"name":"'
  || o_orderpriority || '","url":"https://ex.org/c/' || CAST(o_orderkey * 2 + 1 AS VARCHAR(20)) || '"},{"name":"no address"},{"url":"https://ex.org/c/'
  || CAST(o_orderkey * 2 + 2 AS VARCHAR(20)) || '"}]}' AS raw
FROM @orders@
"""

DOI_TEXTS = """
SELECT p_partkey AS doc_id, p_name || ' (2020)' || chr(10) || 'https://doi.org/10.1594/EX.' || CAST(p_partkey AS VARCHAR(20))
  || ' – Score: 1.5' || chr(10) || CASE p_partkey % 3 WHEN 0 THEN 'see https://doi.org/10.5/' || p_brand || ', and' ELSE 'no more' END AS text
FROM @part@
"""

EDGES = """
SELECT c_custkey AS src, (c_custkey * 7 + 3) % (SELECT count(*) FROM @customer@) AS dst, 0 AS pos FROM @customer@
UNION ALL
SELECT c_custkey AS src, (c_custkey * 13 + 5) % (SELECT count(*) FROM @customer@) AS dst, 1 AS pos FROM @customer@
UNION ALL
SELECT c_custkey AS src, c_nationkey AS dst, 2 AS pos FROM @customer@
"""

REDIRECTS = """
SELECT o_orderkey AS from_id,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(floor(o_orderkey / 2) AS BIGINT) END AS to_id,
  CASE WHEN o_orderkey % 5 = 0 THEN 200 WHEN o_orderkey % 3 = 0 THEN 303 ELSE 302 END AS status
FROM @orders@
UNION ALL
SELECT -c_custkey, CASE WHEN c_custkey % 60 = 0 THEN NULL ELSE -c_custkey - 1 END, CASE c_custkey % 20 WHEN 7 THEN 303 ELSE 301 END FROM @customer@
UNION ALL
SELECT -1000000000 - n_nationkey, -1000000000 - (n_nationkey + 1) % 25, 303 FROM @nation@
"""

QUADS = """
SELECT '<https://ex.org/s/' || CAST(c_custkey AS VARCHAR(20)) || '> <https://schema.org/name> "' || c_name || '" <urn:ex:org:s' || CAST(c_nationkey AS VARCHAR(20)) || ':data:0a> .' AS line FROM @customer@
UNION ALL
SELECT '<https://ex.org/s/' || CAST(c_custkey AS VARCHAR(20)) || '> <http://www.w3.org/1999/02/22-rdf-syntax-ns#type> <https://schema.org/'
  || CASE c_custkey % 3 WHEN 0 THEN 'Person' ELSE 'Organization' END || '> <urn:ex:org:s' || CAST(c_nationkey AS VARCHAR(20)) || ':data:0a> .' FROM @customer@
UNION ALL
SELECT '<https://ex.org/s/' || CAST(c_custkey AS VARCHAR(20)) || '> <https://schema.org/value> ' || CASE c_custkey % 4
    WHEN 0 THEN '"' || CAST(c_custkey AS VARCHAR(20)) || '"^^<http://www.w3.org/2001/XMLSchema#integer>'
    WHEN 1 THEN '"true"^^<http://www.w3.org/2001/XMLSchema#boolean>'
    WHEN 2 THEN '"' || c_mktsegment || ' \\"quoted\\" \\u00e9"@en'
    ELSE '<https://ex.org/genid/' || CAST(c_custkey AS VARCHAR(20)) || '>' END
  || ' <urn:ex:org:s' || CAST(c_nationkey AS VARCHAR(20)) || ':data:0a> .' FROM @customer@
UNION ALL
SELECT '<https://ex.org/genid/' || CAST(c_custkey AS VARCHAR(20)) || '> <https://schema.org/contentUrl> "https://ex.org/f/' || CAST(c_custkey AS VARCHAR(20))
  || '" <urn:ex:org:s' || CAST(c_nationkey AS VARCHAR(20)) || ':data:0a> .' FROM @customer@
"""


def _anonymous(mark: str, label: str) -> str:
    """A release of customers whose segment hangs on two levels of unnamed nodes with ids of their own."""
    key = "CAST(c_custkey AS VARCHAR(20))"
    graph = "'urn:ex:org:s' || CAST(c_nationkey AS VARCHAR(20)) || ':data:0a'"
    node = f"'https://ex.org/genid/{mark}' || {key}"
    return f"""
SELECT 'https://ex.org/s/' || {key} AS s, 'https://schema.org/about' AS p, {node} AS value, 'iri' AS kind, {graph} AS g FROM @customer@
UNION ALL
SELECT {node}, 'https://schema.org/subjectOf', {node} || '-x', 'iri', {graph} FROM @customer@
UNION ALL
SELECT {node}, 'https://schema.org/name', c_mktsegment, 'literal', {graph} FROM @customer@
UNION ALL
SELECT {node} || '-x', 'https://schema.org/name', {label}, 'literal', {graph} FROM @customer@
"""


RELEASE_LEFT = _anonymous("a", "c_name")
RELEASE_RIGHT = _anonymous(
    "b", "CASE WHEN c_custkey % 5 = 0 THEN 'changed' ELSE c_name END"
)



def _tangled(mark: str, step: str, turned: str) -> str:
    """Unnamed nodes that no property tells apart: rings over customers, and nodes that two named ones share."""
    key = "CAST(c_custkey AS VARCHAR(20))"
    node = f"'https://ex.org/genid/{mark}' || {key}"
    one, two = f"{node} || '-x'", f"{node} || '-y'"
    about, part = "https://schema.org/about", "https://schema.org/hasPart"
    first, second = f"'https://ex.org/s/' || {key}", f"'https://ex.org/t/' || {key}"
    shared = [
        (first, about, one),
        (first, part, f"CASE WHEN {turned} THEN {two} ELSE {one} END"),
        (second, about, two),
        (second, part, f"CASE WHEN {turned} THEN {one} ELSE {two} END"),
    ]
    after = f"CASE WHEN c_custkey + {step} < (SELECT count(*) FROM @customer@) THEN c_custkey + {step} ELSE c_custkey % {step} END"
    rings = f"""
SELECT {node} AS s, 'https://schema.org/isRelatedTo' AS p, 'https://ex.org/genid/{mark}' || CAST({after} AS VARCHAR(20)) AS value, 'iri' AS kind,
  'urn:ex:org:rings:data:0a' AS g FROM @customer@"""
    pairs = [f"SELECT {s}, '{p}', {o}, 'iri', 'urn:ex:org:shared:data:0a' FROM @customer@" for s, p, o in shared]
    names = [f"SELECT {n}, 'https://schema.org/name', 'same', 'literal', 'urn:ex:org:shared:data:0a' FROM @customer@" for n in (one, two)]
    return "\nUNION ALL\n".join([rings, *pairs, *names])


TANGLED_LEFT = _tangled("a", "25", "1 = 0")
TANGLED_RIGHT = _tangled("b", "CASE WHEN c_custkey % 25 < 5 THEN 50 ELSE 25 END", "c_custkey % 3 = 0")

COPIES = """
SELECT doc_id, source AS site, text AS raw FROM @documents@
"""

FILES = f"""
SELECT doc_id, raw, '/data/' || site || '/' || CASE doc_id % 9 WHEN 0 THEN sha1(raw || 'x') WHEN 1 THEN 'named' ELSE sha1(raw) END || '.jsonld' AS path
FROM ({DOCS}) AS docs
"""

BROWSED = """
SELECT page_id, 'https://view.example.org/browser' || CASE page_id % 3 WHEN 0 THEN '' ELSE '/' END || '#/external/' || regexp_replace(url, '^https?://', '') AS url
FROM @pages@
"""

RASTERS = """
SELECT p_partkey AS tile_id, p_brand AS collection, 100 AS width, 50 AS height, CAST(0.25 AS DOUBLE) AS res_x, CAST(-0.5 AS DOUBLE) AS res_y,
  -180 + 10 * (p_partkey % 36) AS origin_x, 90 - 5 * (p_size % 36) AS origin_y
FROM @part@
"""

HARVEST = """
SELECT run, 'https://data.example.org/' || CAST(page_id AS VARCHAR(20)) AS loc,
  '2024-01-' || lpad(CAST(page_id % 20 + 1 + CASE WHEN page_id % 3 = 0 THEN run ELSE 0 END AS VARCHAR(20)), 2, '0') || 'T10:00:00Z' AS lastmod,
  CASE WHEN page_id % 4 = 0 THEN NULL ELSE sha1(url || CASE WHEN page_id % 7 < run THEN CAST(run AS VARCHAR(20)) ELSE '' END) END AS digest
FROM @pages@ CROSS JOIN (SELECT 1 AS run UNION ALL SELECT 2 UNION ALL SELECT 3) AS runs
WHERE page_id % (4 + run) <> run
"""

ATTEMPTS = f"""
SELECT event_id % 3001 AS row_id, CAST(event_id AS DOUBLE) AS at,
  CASE WHEN event_id % 11 < 3 THEN 'reply ' || CAST(event_id AS VARCHAR(20)) END AS response,
  CASE WHEN event_id % 11 < 3 THEN NULL ELSE message END AS message
FROM ({FAILURES}) AS failures
"""

TREE = """
SELECT 'https://ex.org/s/' || CAST(c_custkey AS VARCHAR(20)) AS s, 'https://schema.org/name' AS p, c_name AS value, 'literal' AS kind, 'urn:ex:org:tree:data:0a' AS g FROM @customer@
UNION ALL
SELECT 'https://ex.org/s/' || CAST(c_custkey AS VARCHAR(20)), 'http://www.w3.org/1999/02/22-rdf-syntax-ns#type',
  'https://schema.org/' || CASE c_custkey % 3 WHEN 0 THEN 'Person' ELSE 'Organization' END, 'iri', 'urn:ex:org:tree:data:0a' FROM @customer@
UNION ALL
SELECT 'https://ex.org/s/' || CAST(c_custkey AS VARCHAR(20)), 'https://schema.org/isPartOf',
  'https://ex.org/s/' || CAST(CAST(floor(c_custkey / 3) AS BIGINT) AS VARCHAR(20)), 'iri', 'urn:ex:org:tree:data:0a' FROM @customer@
"""

REFORMATTED = f"""
SELECT doc_id, site, CASE WHEN doc_id % 4 = 1 THEN replace(raw, '":', '" : ') WHEN doc_id % 4 = 2 THEN replace(raw, '"name"', '"title"') ELSE raw END AS raw,
  '/data/' || site || '/' || sha1(raw) || '.jsonld' AS path, raw AS first_raw
FROM ({DOCS}) AS docs WHERE doc_id % 10 <> 1
"""

ROUND_RASTERS = """
SELECT p_partkey AS tile_id, p_brand AS collection, 40 AS width, 50 AS height, CAST(0.25 AS DOUBLE) AS res_x, CAST(-0.5 AS DOUBLE) AS res_y,
  CASE WHEN p_partkey % 2 = 0 THEN 150 + 5 * (p_partkey % 12) ELSE -180 + 3 * (p_size % 20) END AS origin_x, 90 - 5 * (p_size % 36) AS origin_y
FROM @part@
"""

SPELT = """
SELECT page_id, u AS url, CASE page_id % 6 WHEN 0 THEN replace(u, 'https://', 'HTTPS://') WHEN 1 THEN u || '#part' WHEN 2 THEN replace(u, 'e', '%65')
    WHEN 3 THEN replace(u, '.example.', '.EXAMPLE.') WHEN 4 THEN replace(u, '.example.net/', '.example.net/a/./../') ELSE u END AS loc,
  page_id % 13 <> 0 AS listed, page_id % 11 <> 0 AS present
FROM (SELECT page_id, split_part(url, '#', 1) AS u FROM @pages@) AS plain
"""

CONTEXTS = """
SELECT p_partkey AS doc_id, '{"@context":' || CASE p_partkey % 3
    WHEN 0 THEN '{"dc":"http://purl.org/dc/terms/","title":"dc:title","@vocab":"https://own.example.org/","seeAlso":{"@id":"dc:relation","@type":"@id"}}'
    WHEN 1 THEN '["https://schema.org/",{"dc":"http://purl.org/dc/terms/","title":{"@id":"dc:title","@language":"en"},"seeAlso":{"@id":"dc:relation","@type":"@id"},"id":"@id"}]'
    ELSE '"https://schema.org/"' END
  || CASE p_partkey % 3 WHEN 1 THEN ',"id":' ELSE ',"@id":' END || '"https://ex.org/d/' || CAST(p_partkey AS VARCHAR(20))
  || '","title":"' || p_name || '","size":"' || CAST(p_size AS VARCHAR(20)) || '","seeAlso":"https://ex.org/f/' || p_brand || '"}' AS raw
FROM @part@
"""

FIXTURES = {
    "harvest": HARVEST,
    "attempts": ATTEMPTS,
    "tree": TREE,
    "reformatted": REFORMATTED,
    "round_rasters": ROUND_RASTERS,
    "spelt": SPELT,
    "contexts": CONTEXTS,
    "registry": REGISTRY,
    "boxes": BOXES,
    "docs": DOCS,
    "responses": RESPONSES,
    "source_pages": SOURCE_PAGES,
    "failures": FAILURES,
    "sitemap": SITEMAP,
    "catalogues": CATALOGUES,
    "doi_texts": DOI_TEXTS,
    "edges": EDGES,
    "redirects": REDIRECTS,
    "quads": QUADS,
    "release_left": RELEASE_LEFT,
    "release_right": RELEASE_RIGHT,
    "tangled_left": TANGLED_LEFT,
    "tangled_right": TANGLED_RIGHT,
    "copies": COPIES,
    "files": FILES,
    "browsed": BROWSED,
    "rasters": RASTERS,
}

#: Tables whose rows hold whole texts already: read as they lie.
TEXT_TABLES = ("pages", "documents")
_TABLE = re.compile(r"@([a-z]+)@")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as its files lie, without any exchange."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived input as a DataFrame over the parquet tables of `sf_dir`."""

    def view(match: re.Match) -> str:
        name = match.group(1)
        given = f"metaloom_{name}"
        rows = table(spark, sf_dir, name)
        if name not in TEXT_TABLES:
            # A small file is one task: its narrow columns are dealt out before long texts are made of them.
            rows = rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
        rows.createOrReplaceTempView(given)
        return given

    text = _TABLE.sub(view, FIXTURES[name])
    return spark.sql(text.replace("VARCHAR(20)", "STRING").replace("\\", "\\\\"))


def fixture_sql(name: str) -> str:
    """The same input as a sub-query for the checking engine."""
    return "(" + _TABLE.sub(lambda m: m.group(1), FIXTURES[name]).strip() + ")"

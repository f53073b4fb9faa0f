"""Queries over states, patterns and paths, each next to its checking SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from metaloom.functions import geo, prompts, urls
from metaloom.functions.paths import path_texts
from metaloom.functions.variants import with_value
from metaloom.operators import catalog, documents, harvest, patterns, quads, responses
from metaloom.plans.fixtures import fixture, fixture_sql
from metaloom.plans.oracles import PARSED_REPLIES
from metaloom.session import ensure_checkpoint_dir
from metaloom.sources import readers, writers

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
SCHEMA = "https://schema.org/"
RDF_TYPE = "http://www.w3.org/1999/02/22-rdf-syntax-ns#type"


def query(sql: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__], ORACLES[fn.__name__] = fn, sql
        return fn

    return register


def _long(name: str):
    return F.col(name).cast("long").alias(name)


def _run_sql(run: int, before: str) -> str:
    """The state after a run, from the state before it and the run's listing."""
    return f"""(SELECT coalesce(l.loc, s.address) AS address,
  CASE WHEN l.loc IS NULL THEN 'gone' WHEN s.address IS NULL OR s.status = 'gone' THEN 'new'
    WHEN CASE WHEN s.digest IS NOT NULL AND l.digest IS NOT NULL THEN s.digest <> l.digest ELSE l.lastmod > s.lastmod END THEN 'changed' ELSE 'unchanged' END AS status,
  coalesce(l.lastmod, s.lastmod) AS lastmod, coalesce(l.digest, s.digest) AS digest,
  coalesce(s.first_run, 'run {run}') AS first_run, CASE WHEN l.loc IS NULL THEN s.seen_run ELSE 'run {run}' END AS seen_run,
  coalesce(s.n_changes, 0) + CASE WHEN l.loc IS NOT NULL AND s.status <> 'gone' AND CASE WHEN s.digest IS NOT NULL AND l.digest IS NOT NULL THEN s.digest <> l.digest ELSE l.lastmod > s.lastmod END THEN 1 ELSE 0 END AS n_changes
FROM {before} AS s FULL JOIN (SELECT * FROM {fixture_sql('harvest')} WHERE run = {run}) AS l ON l.loc = s.address)"""


_NO_STATE = "(SELECT '' AS address, '' AS status, '' AS lastmod, '' AS digest, '' AS first_run, '' AS seen_run, 0 AS n_changes WHERE false)"


@query(
    "SELECT address, status, first_run, seen_run, CAST(n_changes AS BIGINT) AS n_changes FROM "
    + _run_sql(3, _run_sql(2, _run_sql(1, _NO_STATE)))
)
def harvest_state(spark, sf):
    """The state of every address after three listings; the second run is done twice and counts once."""
    table = harvest.HarvestTable(spark, f"{ensure_checkpoint_dir(spark)}/harvest-{_token()}")
    listings = fixture(spark, sf, "harvest")
    for run in (1, 2, 2, 3):
        table.run(listings.filter(F.col("run") == run), f"run {run}")
    return table.state().select("address", "status", "first_run", "seen_run", "n_changes")


def _token() -> str:
    import uuid

    return uuid.uuid4().hex


@query(f"""
    WITH a AS (SELECT *, message IS NOT NULL AS failed, regexp_matches(message, '429|RESOURCE_EXHAUSTED') OR contains(lower(message), 'quota') AS quota,
        CASE WHEN regexp_matches(lower(message), 'timeout|timed out|connection refused|connection reset') THEN 'timeout'
          WHEN regexp_matches(lower(message), '500|502|503|504') THEN 'server_error' ELSE 'detection_error' END AS own,
        least(coalesce(try_cast(regexp_extract(lower(message), 'retry in ([0-9.]+)s', 1) AS DOUBLE) + 5, 30), 60) AS wait FROM {fixture_sql('attempts')}),
    k AS (SELECT row_id, count(*) AS n, min("at") FILTER (NOT failed) AS ok_at, arg_min(response, "at") FILTER (NOT failed) AS response, max("at") FILTER (failed) AS bad_at,
        arg_max(CASE WHEN quota THEN 'quota' ELSE own END, "at") FILTER (failed) AS reason, arg_max(CASE WHEN quota THEN wait ELSE 30 END, "at") FILTER (failed) AS wait FROM a GROUP BY row_id),
    t AS (SELECT r.row_id, coalesce(n, 0) AS n_attempts, response, CASE WHEN ok_at IS NULL THEN reason END AS reason, bad_at + wait AS next_at,
        CASE WHEN ok_at IS NOT NULL THEN 'done' WHEN n >= 3 OR reason = 'detection_error' THEN 'given_up' ELSE 'due' END AS status
      FROM (SELECT row_id FROM {fixture_sql('registry')}) AS r LEFT JOIN k ON k.row_id = r.row_id)
    SELECT row_id, status, n_attempts, CASE WHEN status = 'due' THEN CAST(coalesce(next_at, 0) AS DOUBLE) END AS due_at, response, reason FROM t""")
def request_ledger(spark, sf):
    """What became of each request of the registry: accepted reply, next due time, or given up."""
    requests = fixture(spark, sf, "registry").select("row_id")
    return responses.request_ledger(requests, fixture(spark, sf, "attempts"), "row_id")


@query(f"""
    WITH RECURSIVE q AS MATERIALIZED (SELECT * FROM {fixture_sql('tree')}),
    up AS (SELECT s, value FROM q WHERE p = '{SCHEMA}isPartOf' UNION SELECT up.s, q.value FROM up JOIN q ON q.s = up.value AND q.p = '{SCHEMA}isPartOf')
    SELECT DISTINCT t.s AS x, n.value AS name, up.value AS y FROM q AS t JOIN q AS n ON n.s = t.s AND n.p = '{SCHEMA}name'
    JOIN up ON up.s = t.s JOIN q AS k ON k.s = up.value AND k.p = '{RDF_TYPE}' AND k.value = '{SCHEMA}Person'
    WHERE t.p = '{RDF_TYPE}' AND t.value = '{SCHEMA}Organization'""")
def quad_patterns(spark, sf):
    """Organizations, their names, and the persons that they are part of over any number of steps."""
    wanted = [
        ("?x", RDF_TYPE, SCHEMA + "Organization"),
        ("?x", SCHEMA + "name", "?name"),
        ("?x", SCHEMA + "isPartOf+", "?y"),
        ("?y", RDF_TYPE, SCHEMA + "Person"),
    ]
    return patterns.match(fixture(spark, sf, "tree"), wanted).select("x", "name", "y")


#: Paths of the query and what DuckDB's own functions give for each.
_PATHS = {
    "distribution.#.contentUrl": "list_transform(CAST(json_extract(j, '$.distribution[*].contentUrl') AS JSON[]), lambda x: json_extract_string(x, '$'))",
    'distribution.#(contentUrl=="https://ex.org/g").contentUrl':
        "list_filter(list_transform(CAST(json_extract(j, '$.distribution[*].contentUrl') AS JSON[]), lambda x: json_extract_string(x, '$')), lambda x: x = 'https://ex.org/g')",
    'variableMeasured.#(alternateName%"v*")#.name':
        "list_transform(list_filter(CAST(json_extract(j, '$.variableMeasured[*]') AS JSON[]), lambda x: starts_with(json_extract_string(x, '$.alternateName'), 'v')), lambda x: json_extract_string(x, '$.name'))",
    "spatialCoverage.geo.box": "list_filter([json_extract_string(j, '$.spatialCoverage.geo.box')], lambda x: x IS NOT NULL)",
    "about.0.@id": """list_filter([json_extract_string(j, '$.about[0]."@id"')], lambda x: x IS NOT NULL)""",
    "variableMeasured.#": "CASE WHEN json_exists(j, '$.variableMeasured') THEN [CAST(json_array_length(j, '$.variableMeasured') AS VARCHAR)] ELSE [] END",
}


@query(
    "SELECT doc_id, "
    + ", ".join(f"array_to_string({sql}, '|') AS p{i}" for i, sql in enumerate(_PATHS.values()))
    + f" FROM (SELECT doc_id, CASE WHEN json_valid(raw) THEN CAST(raw AS JSON) END AS j FROM {fixture_sql('docs')}) WHERE j IS NOT NULL"
)
def json_paths(spark, sf):
    """Six paths in one pass: each document is parsed once."""
    docs = with_value(fixture(spark, sf, "docs")).filter(F.col("v").isNotNull())
    return docs.select("doc_id", *[F.array_join(path_texts(F.col("v"), p), "|").alias(f"p{i}") for i, p in enumerate(_PATHS)])


@query(f"""
    SELECT r.doc_id, r.response AS raw_response FROM {fixture_sql('responses')} AS r JOIN {PARSED_REPLIES} AS p ON p.doc_id = r.doc_id
    WHERE p.kind = 'text' AND p.j IS NULL""")
def response_failures(spark, sf):
    """Replies that hold no JSON, with their whole text."""
    found = responses.detected_datasets(fixture(spark, sf, "responses"), "doc_id", F.col("site"), F.col("site_url"))
    return found.filter("error is not null").select("doc_id", "raw_response")


_FILES = fixture_sql("reformatted")


@query(f"SELECT doc_id, CASE WHEN raw = first_raw THEN 'intact' WHEN doc_id % 4 = 1 THEN 'reformatted' ELSE 'changed' END AS state FROM {_FILES}")
def doc_integrity_kinds(spark, sf):
    """Files named by a hash: intact, printed anew, or changed, against an earlier release of the same files."""
    files = fixture(spark, sf, "reformatted")
    first = documents.with_structure(files.select(F.col("first_raw").alias("raw")))
    known = first.select(F.sha1("raw").alias("stem"), "structure")
    return documents.integrity_kinds(files, known).select("doc_id", "state")


@query(f"""
    SELECT count(*) AS n_structures, CAST(sum(n) AS BIGINT) AS n FROM (
      SELECT first_raw, count(*) AS n FROM (SELECT first_raw, raw FROM {_FILES} WHERE doc_id % 4 = 1 UNION ALL SELECT first_raw, first_raw FROM {_FILES} WHERE doc_id % 4 = 1)
      GROUP BY first_raw HAVING count(DISTINCT raw) > 1)""")
def docs_reprinted(spark, sf):
    """Documents that say the same in two texts."""
    files = fixture(spark, sf, "reformatted").filter("doc_id % 4 = 1")
    both = files.select("site", "raw").unionAll(files.select("site", F.col("first_raw").alias("raw")))
    found = documents.reprinted(both)
    return found.agg(F.count("*").alias("n_structures"), F.sum("n").alias("n"))


@query(f"""
    WITH t AS (SELECT collection, CAST(origin_x AS BIGINT) + 180 AS o, origin_y - height * 0.5 AS south, CAST(origin_y AS DOUBLE) AS north FROM {fixture_sql('round_rasters')}),
    cell AS (SELECT DISTINCT collection, (o + u) % 360 AS c FROM t, (SELECT unnest(range(10)) AS u)),
    gap AS (SELECT collection, c, lead(c, 1, first_c + 360) OVER (PARTITION BY collection ORDER BY c) AS n FROM (SELECT *, min(c) OVER (PARTITION BY collection) AS first_c FROM cell)),
    best AS (SELECT * FROM gap QUALIFY row_number() OVER (PARTITION BY collection ORDER BY n - c DESC, n % 360) = 1)
    SELECT b.collection, CAST(CASE WHEN n - c > 1 THEN n % 360 - 180 ELSE -180 END AS DOUBLE) AS west, CAST(s.south AS DOUBLE) AS south,
      CAST(CASE WHEN n - c > 1 AND (c + 1) % 360 > 0 THEN (c + 1) % 360 - 180 ELSE 180 END AS DOUBLE) AS east, s.north
    FROM best AS b JOIN (SELECT collection, min(south) AS south, max(north) AS north FROM t GROUP BY collection) AS s USING (collection)""")
def round_extent(spark, sf):
    """Extents on the globe; some collections lie over the date line."""
    return geo.round_extent(fixture(spark, sf, "round_rasters"))


@query(f"""
    SELECT loc, CASE WHEN present AND listed THEN 'both' WHEN listed THEN 'missing' ELSE 'unlisted' END AS state FROM (
      SELECT url AS loc, bool_or(listed) AS listed, bool_or(present) AS present FROM {fixture_sql('spelt')} GROUP BY url) WHERE listed OR present""")
def sitemap_reconcile_normal(spark, sf):
    """Listed and present pages, whatever the spelling of their addresses."""
    rows = fixture(spark, sf, "spelt")
    listed = rows.filter("listed").select(urls.normal_form(F.col("loc")).alias("loc"))
    present = rows.filter("present").select(urls.normal_form(F.col("url")).alias("loc"))
    return catalog.reconcile(listed, present)


@query(f"""
    WITH d AS (SELECT doc_id, CAST(raw AS JSON) AS j FROM {fixture_sql('contexts')})
    SELECT p, kind, language, count(*) AS n FROM (
      SELECT CASE WHEN doc_id % 3 < 2 THEN 'http://purl.org/dc/terms/title' ELSE '{SCHEMA}title' END AS p, 'literal' AS kind, CASE WHEN doc_id % 3 = 1 THEN 'en' END AS language FROM d
      UNION ALL SELECT CASE WHEN doc_id % 3 = 0 THEN 'https://own.example.org/size' ELSE '{SCHEMA}size' END, 'literal', NULL FROM d
      UNION ALL SELECT CASE WHEN doc_id % 3 < 2 THEN 'http://purl.org/dc/terms/relation' ELSE '{SCHEMA}seeAlso' END, CASE WHEN doc_id % 3 < 2 THEN 'iri' ELSE 'literal' END, NULL FROM d)
    GROUP BY p, kind, language""")
def doc_quads_contexts(spark, sf):
    """Quads of documents with terms, prefixes, languages and a vocabulary of their own."""
    docs = fixture(spark, sf, "contexts").withColumn("g", F.concat(F.lit("urn:ex:org:docs:data:"), F.col("doc_id").cast("string")))
    flat = quads.quads_of_documents(docs)
    return flat.groupBy("p", "kind", "language").agg(F.count("*").alias("n"))


@query(f"SELECT loc, lastmod, CAST(4 AS BIGINT) AS level FROM {fixture_sql('sitemap')}")
def sitemap_levels(spark, sf):
    """Entries below an index of indexes of indexes, with one index listed on two ways."""
    root, base = f"{ensure_checkpoint_dir(spark)}/levels-{_token()}", "https://maps.example.org"
    writers.write_sitemap(fixture(spark, sf, "sitemap").select("loc", "lastmod"), f"{root}/maps")
    for below, folder in (("maps", "one"), ("one", "two"), ("two", "again"), ("again", "three")):
        writers.write_sitemap_index(spark, f"{root}/{below}", f"{base}/{below}", f"{root}/{folder}")
    index = readers.read_sitemap_index(spark, root)
    start = index.filter(F.contains("source_file", F.lit("/three/"))).agg(F.min("source_file").alias("file")).first()["file"]
    found = readers.expand_index_levels(
        index, readers.read_sitemap(spark, f"{root}/maps"), root, base, f"{base}/three/{start.rsplit('/', 1)[1]}"
    )
    return found.select("loc", "lastmod", _long("level"))


@query(f"SELECT row_id, 'Read: ' || trim(name) || chr(10) AS prompt FROM {fixture_sql('registry')}")
def template_prompts(spark, sf):
    """Prompts from a template that is read from a file."""
    folder = f"{ensure_checkpoint_dir(spark)}/template-{_token()}"
    spark.createDataFrame([("Read: {DATASET_NAME}",)], "value string").coalesce(1).write.text(folder)
    template = readers.read_template(spark, folder)
    rows = fixture(spark, sf, "registry")
    return rows.select("row_id", prompts.format_slots(template, {"DATASET_NAME": F.trim("name")}).alias("prompt"))


_NAME = "coalesce(json_extract_string(j, '$.name'), site)"
_KEYS = ("@context", "@type", "name")
_LACKING = " ".join(f"""WHEN NOT json_exists(j, '$."{k}"') THEN 'missing ' || chr(39) || '{k}' || chr(39)""" for k in _KEYS)
_WHOLE = " AND ".join(f"""json_exists(j, '$."{k}"')""" for k in _KEYS)
_SAFE = rf"left(replace(rtrim(regexp_replace({_NAME}, '[^\p{{L}}\p{{N}} _-]', '', 'g')), ' ', '_'), 50)"


@query(f"""
    SELECT doc_id, kind, CASE WHEN kind = 'object' THEN CASE WHEN {_SAFE} = '' THEN 'dataset' ELSE {_SAFE} END || '_' || left(sha1(site_url), 8) || '.jsonld' END AS filename,
      CASE WHEN kind = 'text' THEN 'no JSON in the reply' WHEN kind = 'array' THEN 'the reply is no object' {_LACKING} END AS message,
      CASE WHEN kind <> 'object' OR NOT ({_WHOLE}) THEN 'other_error' END AS reason
    FROM {PARSED_REPLIES}""")
def generation_run(spark, sf):
    """From replies to named documents and failure records; of the checks' messages the first about missing keys."""
    made = responses.generated_documents(fixture(spark, sf, "responses"), "checked")
    missing = F.col("message").isNotNull() & ((F.col("kind") != "object") | F.startswith("message", F.lit("missing")))
    shown = F.when(missing, F.regexp_extract("message", "^[^;]*", 0))
    return made.select("doc_id", "kind", "filename", shown.alias("message"), F.when(missing, F.col("reason")).alias("reason"))

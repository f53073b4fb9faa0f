"""Round trips over files: derived inputs go through the sinks to the shared folder and come back through the scans.

Each query stands next to its checking SQL, which reads the tables that the files were made from.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from metaloom.functions.variants import strict_json
from metaloom.operators import crawl, failures, quads, responses, validation
from metaloom.plans import queries
from metaloom.plans.fixtures import fixture, fixture_sql, table
from metaloom.plans.oracles import ORACLES as TABLE_SQL
from metaloom.session import ensure_checkpoint_dir
from metaloom.sources import readers, writers
from metaloom.streaming import folder as streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

BASE = "https://data.example.org/files"
EXAMPLE = 8


def query(sql: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        ORACLES[fn.__name__] = sql
        return fn

    return register


def _folder(spark: SparkSession, name: str) -> str:
    """A new folder that all executors see."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _stem(path: str = "path"):
    return readers.file_stem(F.col(path)).cast("long").alias("doc_id")


# ---- document files --------------------------------------------------------------------------------

_DOCS = fixture_sql("docs")
_VALIDATED = TABLE_SQL["validate_docs"]


def _published(spark: SparkSession, sf: str) -> str:
    """All documents as files of one folder per site."""
    docs = fixture(spark, sf, "docs").select(
        F.col("site").alias("folder"), F.concat(F.col("doc_id").cast("string"), F.lit(".jsonld")).alias("filename"), "raw"
    )
    target = _folder(spark, "documents")
    writers.publish_files(docs, target).write.parquet(f"{target}-written")
    return target


@query(f"SELECT site, doc_id, sha1(raw) AS sha, json_valid(raw) AS is_json FROM {_DOCS}")
def document_files(spark, sf):
    docs = readers.read_documents(spark, _published(spark, sf))
    return docs.select("site", _stem(), F.sha1("raw").alias("sha"), F.col("v").isNotNull().alias("is_json"))


@query(f"SELECT DISTINCT site FROM {_DOCS}")
def document_sites(spark, sf):
    return readers.existing_sites(readers.read_documents(spark, _published(spark, sf)))


@query(f"SELECT page_id, (SELECT sha1(raw) FROM {_DOCS} WHERE doc_id = {EXAMPLE}) AS example FROM pages")
def document_example(spark, sf):
    """One document by the end of its path, beside every page."""
    docs = readers.read_documents(spark, _published(spark, sf))
    rows = readers.with_example(table(spark, sf, "pages").select("page_id"), docs, f"/{EXAMPLE}.jsonld")
    return rows.select("page_id", F.sha1("example").alias("example"))


@query(f"SELECT '{BASE}/' || replace(site, '#', '%23') || '/' || doc_id || '.jsonld' AS loc FROM {_DOCS}")
def documents_sitemap(spark, sf):
    """Written documents as a sitemap, itself written and read."""
    root = _published(spark, sf)
    target = _folder(spark, "documents-sitemap")
    writers.write_sitemap(writers.sitemap_of_documents(readers.read_documents(spark, root), root, BASE), target)
    return readers.read_sitemap(spark, target).filter(F.col("lastmod_time").isNotNull()).select("loc")


@query(f"SELECT doc_id, messages FROM ({_VALIDATED}) WHERE NOT ok")
def failed_files(spark, sf):
    checked = validation.check_documents(readers.read_documents(spark, _published(spark, sf)))
    failed = validation.failed_documents(checked)
    return failed.select(_stem(), F.array_join("messages", "; ").alias("messages"))


@query(f"SELECT ok, messages, count(*) AS n FROM ({_VALIDATED}) GROUP BY ok, messages")
def validation_report(spark, sf):
    checked = validation.check_documents(readers.read_documents(spark, _published(spark, sf)))
    target = _folder(spark, "validation-report")
    writers.write_report(checked.select("path", "ok", "messages"), target, "ok")
    rows = spark.read.schema("path string, messages array<string>, ok boolean").json(target)
    return rows.groupBy("ok", F.array_join("messages", "; ").alias("messages")).agg(F.count("*").alias("n"))


@query(f"SELECT d.site, v.ok, count(*) AS n FROM ({_VALIDATED}) AS v JOIN {_DOCS} AS d ON d.doc_id = v.doc_id GROUP BY d.site, v.ok")
def streamed_checks(spark, sf):
    """The folder as a stream of new files, checked once each."""
    target = _folder(spark, "streamed")
    stream = streams.check_stream(streams.stream_documents(spark, _published(spark, sf)))
    streams.run_available(stream, target, f"{target}-mark").awaitTermination()
    return spark.read.parquet(target).groupBy("site", "ok").agg(F.count("*").alias("n"))


# ---- registry, sitemaps, text ----------------------------------------------------------------------


@query(
    "SELECT coalesce(has_jsonld, '') AS has_jsonld, webpage_url, name, grp, publisher, description, box_lon_min, box_lat_max"
    f" FROM {fixture_sql('registry')}"
)
def registry_files(spark, sf):
    """A folder of CSV files whose columns stand in two different orders."""
    given = {ours: name for name, ours in readers.REGISTRY_COLUMNS.items()}
    rows = fixture(spark, sf, "registry")
    columns = [c for c in rows.columns if c in given]
    target = _folder(spark, "registry")
    for k, order in enumerate((columns, columns[::-1])):
        part = rows.filter(F.col("row_id") % 2 == k).select(*[F.col(c).alias(given[c]) for c in order])
        (
            part.write.mode("append")
            .option("header", True)
            .option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .csv(target)
        )
    back = readers.read_registry(spark, target)
    return back.select("has_jsonld", "webpage_url", "name", "grp", "publisher", "description", "box_lon_min", "box_lat_max")


def _sitemap_files(spark: SparkSession, sf: str) -> str:
    target = _folder(spark, "sitemap")
    writers.write_sitemap(fixture(spark, sf, "sitemap").select("loc", "lastmod"), target)
    return target


@query(f"SELECT loc, lastmod FROM {fixture_sql('sitemap')}")
def sitemap_files(spark, sf):
    return readers.read_sitemap(spark, _sitemap_files(spark, sf)).select("loc", "lastmod")


@query(f"SELECT loc, lastmod FROM {fixture_sql('sitemap')}")
def sitemap_index(spark, sf):
    """Sitemap files, an index over them, and the entries of all children of the index."""
    root = _sitemap_files(spark, sf)
    target = _folder(spark, "sitemap-index")
    writers.write_sitemap_index(spark, root, BASE, target)
    index = readers.read_sitemap_index(spark, target)
    return readers.expand_sitemap_index(index, readers.read_sitemap(spark, root), root, BASE).select("loc", "lastmod")


@query(f"SELECT url AS loc FROM ({TABLE_SQL['catalog_walk']})")
def walk_sitemap(spark, sf):
    """The pages of a catalogue walk as a sitemap, written and read."""
    target = _folder(spark, "walk-sitemap")
    writers.write_sitemap(crawl.sitemap_of_walk(queries.catalog_walk(spark, sf)), target)
    return readers.read_sitemap(spark, target).select("loc")


@query(
    "SELECT line, count(*) AS n FROM (SELECT unnest(string_split(text, chr(10))) AS line"
    f" FROM {fixture_sql('doi_texts')}) GROUP BY line"
)
def text_lines(spark, sf):
    target = _folder(spark, "lines")
    fixture(spark, sf, "doi_texts").select("text").write.text(target)
    return readers.read_text_lines(spark, target).groupBy("line").agg(F.count("*").alias("n"))


@query(
    "SELECT s.page_id, s.loc AS url, CAST(length(p.html) AS BIGINT) AS n_html"
    f" FROM {fixture_sql('sitemap')} AS s LEFT JOIN pages AS p ON p.url = s.loc"
)
def captured_pages(spark, sf):
    """The captured page of every sitemap entry, if there is one."""
    wanted = fixture(spark, sf, "sitemap").select("page_id", F.col("loc").alias("url"))
    found = readers.fetch_captured(wanted, table(spark, sf, "pages"))
    return found.select("page_id", "url", F.length("html").cast("long").alias("n_html"))


# ---- quads, failures, requests ---------------------------------------------------------------------


@query(f"SELECT source, CAST(sum(n) AS BIGINT) AS n FROM ({TABLE_SQL['quad_graphs']}) GROUP BY source")
def release_files(spark, sf):
    """Releases per source, written and parsed again."""
    target = _folder(spark, "release")
    lines = fixture(spark, sf, "quads")
    writers.write_release(readers.parse_quads(lines), target)
    return quads.graph_summary(readers.read_quads(spark, target)).groupBy("source").agg(F.sum("n").alias("n"))


@query(TABLE_SQL["failure_summary"])
def failure_report(spark, sf):
    target = _folder(spark, "failures")
    rows = failures.report_rows(failures.classify(fixture(spark, sf, "failures")), "name", "message")
    writers.write_report(rows, target, "reason")
    back = spark.read.schema("title string, name string, message string, reason string").json(target)
    return back.groupBy("reason", "title").agg(F.count("*").alias("n"))


@query(f"""
SELECT row_id, trim(webpage_url) AS url, name || '|' || grp || '|' || description AS head
FROM {fixture_sql('registry')}""")
def detection_prompts(spark, sf):
    """The request table of the detection step, over the registry."""
    sites = fixture(spark, sf, "registry").withColumn("text", F.col("description"))
    asked = responses.detection_requests(sites, "{DATASET_NAME}|{GROUP}|{DESCRIPTION}")
    return asked.select("row_id", "url", F.col("prompt").alias("head"))


_KEY = "CAST(p_partkey AS VARCHAR)"


@query(f"""
SELECT s, p, value, kind FROM (
  SELECT 'https://ex.org/ds/' || {_KEY} AS s, 'https://schema.org/name' AS p, p_name AS value, 'literal' AS kind FROM part
  UNION ALL SELECT 'https://ex.org/ds/' || {_KEY}, 'https://schema.org/value', '5.0E-1', 'literal' FROM part
  UNION ALL SELECT 'https://ex.org/ds/' || {_KEY}, 'https://schema.org/keywords', unnest(['a', p_type]), 'literal' FROM part
  UNION ALL SELECT 'https://ex.org/p/' || {_KEY}, 'https://schema.org/about', 'https://ex.org/ds/' || {_KEY}, 'iri' FROM part
  UNION ALL SELECT 'https://ex.org/q/' || {_KEY}, 'https://schema.org/about', 'https://ex.org/ds/' || {_KEY}, 'iri' FROM part)""")
def inverse_quads(spark, sf):
    """Documents with inverse properties, sets, null values and numbers that are not whole, as quads."""
    key = F.col("p_partkey").cast("string")

    def node(kind: str):
        return F.struct(F.concat(F.lit(f"https://ex.org/{kind}/"), key).alias("@id"))

    keywords = F.struct(F.array(F.lit("a"), F.col("p_type")).alias("@set"))
    doc = F.struct(
        F.concat(F.lit("https://ex.org/ds/"), key).alias("@id"),
        F.col("p_name").alias("name"),
        F.lit(0.5).alias("value"),
        keywords.alias("keywords"),
        F.struct(F.array(node("p"), node("q")).alias("about")).alias("@reverse"),
    )
    raw = F.regexp_replace(F.to_json(doc), r"\}$", ',"comment":{"@value":null}}')
    # A small file is one task: its narrow columns are dealt out before documents are made of them.
    parts = table(spark, sf, "part").select("p_partkey", "p_name", "p_type")
    parts = parts.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    docs = parts.select(F.concat(F.lit("urn:ex:org:inverse:data:"), key).alias("g"), raw.alias("raw"))
    return quads.quads_of_documents(docs).select("s", "p", "value", "kind")

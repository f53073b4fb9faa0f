"""The query register: every operator over the given tables or inputs derived from them."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from metaloom.functions import geo, normalise, terms, text, urls
from metaloom.functions.intervals import parse_interval
from metaloom.functions.prompts import LARGE_PROMPT_SIZES, detection_prompt
from metaloom.functions.variants import any_text, array_at, child, kind, with_value
from metaloom.operators import (
    audit,
    catalog,
    crawl,
    documents,
    failures,
    pages,
    quads,
    registry,
    responses,
    validation,
)
from metaloom.plans.fixtures import fixture, table
from metaloom.session import written
from metaloom.sources.readers import parse_quads

Query = Callable[[SparkSession, str], DataFrame]

ISSUES_URL = "https://example.org/issues"
DOMAINS = ["m.tionsh.example.net", "thther.example.com", "thther.example.org", "spam-farm.example.org"]
LAST_RUN = "2024-01-15T00:00:00Z"
SCHEMA = "https://schema.org/"
TEMPLATE = (
    "Read {URL} and list its datasets.\n{CONTENT_SECTION}\n"
    'Name: {DATASET_NAME}\nGroup: {GROUP}\nAbout: {DESCRIPTION}\nAnswer as {{"datasets": []}}.'
)

QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _docs(spark: SparkSession, sf: str) -> DataFrame:
    return with_value(fixture(spark, sf, "docs"))


def _long(name: str) -> Column:
    return F.col(name).cast("long").alias(name)


# ---- pages -----------------------------------------------------------------------------------------


@query
def page_links(spark, sf):
    return pages.page_links(table(spark, sf, "pages")).select("page_id", _long("pos"), "href", "label")


@query
def page_links_resolved(spark, sf):
    links = pages.resolved_links(table(spark, sf, "pages"))
    return links.filter(urls.is_http(F.col("target"))).select(
        "page_id", _long("pos"), F.col("target").alias("url")
    )


@query
def page_links_distinct(spark, sf):
    links = pages.distinct_page_links(table(spark, sf, "pages"))
    return links.select("page_id", "label", "href", _long("first_pos"))


@query
def links_per_host(spark, sf):
    return pages.links_per_host(table(spark, sf, "pages"))


@query
def allowed_domain_pages(spark, sf):
    return pages.allowed_pages(table(spark, sf, "pages"), DOMAINS)


@query
def page_text(spark, sf):
    return pages.page_text(table(spark, sf, "pages"))


def _headings(html: str):
    for found in re.finditer("<h1>(.*?)</h1>", html, re.S):
        yield (found.group(1), found.start())


@query
def page_extract(spark, sf):
    rows = pages.extract(table(spark, sf, "pages"), _headings, "heading string, at long")
    return rows.select("page_id", _long("pos"), "heading", "at")


# ---- source facts ----------------------------------------------------------------------------------


def _facts(spark: SparkSession, sf: str, *kinds: str) -> DataFrame:
    return pages.with_facts(
        fixture(spark, sf, "source_pages"), kinds=kinds or pages.FACT_KINDS
    )


@query
def download_links(spark, sf):
    return pages.download_links(_facts(spark, sf, "links")).select("page_id", "label", "href")


@query
def source_citations(spark, sf):
    return pages.citations(_facts(spark, sf, "cited")).select("page_id", "label", "text")


@query
def source_variables(spark, sf):
    return pages.source_variables(_facts(spark, sf, "variables")).select(
        "page_id", "code", "name", "unit", "description"
    )


@query
def source_fact_counts(spark, sf):
    return pages.fact_counts(_facts(spark, sf))


@query
def source_facts(spark, sf):
    rows = pages.source_facts(fixture(spark, sf, "source_pages"))
    return rows.groupBy("kind").agg(
        F.count("*").alias("n"),
        F.sum(F.length(F.coalesce("href", "text", "name"))).alias("n_chars"),
    )


@query
def ldjson_blocks(spark, sf):
    blocks = pages.ld_json_blocks(fixture(spark, sf, "source_pages"))
    return blocks.select("page_id", _long("pos"), any_text(child(F.col("v"), "$.name")).alias("name"))


# ---- registry --------------------------------------------------------------------------------------


@query
def registry_todo(spark, sf):
    rows = registry.numbered(registry.todo(fixture(spark, sf, "registry")))
    return rows.select("row_id", "name", "seq", "total")


def _existing(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("n_files") > 25).select(text.folder_name(F.col("name")).alias("site"))


@query
def registry_skip_existing(spark, sf):
    rows = fixture(spark, sf, "registry")
    return registry.skip_existing(registry.todo(rows), _existing(rows)).select("row_id", "folder")


@query
def registry_counts(spark, sf):
    rows = fixture(spark, sf, "registry")
    return registry.counts(rows, _existing(rows))


@query
def registry_next(spark, sf):
    """The `--limit` feature: the first ten sites of the work list."""
    rows = registry.next_sites(registry.todo(fixture(spark, sf, "registry")), limit=10)
    return rows.select("row_id", "name")


@query
def output_names(spark, sf):
    return registry.with_output_names(fixture(spark, sf, "registry")).select(
        "row_id", "folder", "filename"
    )


@query
def registry_box(spark, sf):
    return registry.with_box(fixture(spark, sf, "registry")).select("row_id", "box")


# ---- boxes and repairs -----------------------------------------------------------------------------


@query
def box_fix(spark, sf):
    return fixture(spark, sf, "boxes").select("id", geo.fix_box(F.col("box")).alias("box"))


@query
def box_check(spark, sf):
    checked = fixture(spark, sf, "boxes").select("id", geo.check_box(F.col("box")).alias("_c"))
    return checked.select("id", "_c.ok", "_c.msg", "_c.order_guessed")


@query
def doc_box(spark, sf):
    return _docs(spark, sf).select("doc_id", geo.box_of(F.col("v")).alias("box"))


@query
def keywords_fix(spark, sf):
    found = _docs(spark, sf).select(
        "doc_id", F.posexplode(normalise.keywords_list(F.col("v"))).alias("pos", "keyword")
    )
    return found.select("doc_id", _long("pos"), "keyword")


@query
def encoding_fix(spark, sf):
    items = _docs(spark, sf).select(
        "doc_id", F.posexplode(array_at(F.col("v"), "$.distribution")).alias("dist_idx", "_d")
    )
    formats = items.select(
        "doc_id",
        _long("dist_idx"),
        F.posexplode(normalise.encoding_list(child(F.col("_d"), "$.encodingFormat"))).alias("pos", "fmt"),
    )
    return formats.select("doc_id", "dist_idx", _long("pos"), "fmt")


@query
def comment_stamp(spark, sf):
    comment = normalise.origin_comment(ISSUES_URL)
    stamped = _docs(spark, sf).filter(F.col("v").isNotNull()).select(
        "doc_id", normalise.stamped_comment(F.col("v"), comment).alias("_s")
    )
    return stamped.select(
        "doc_id", F.col("_s.kind").alias("comment_kind"), F.size("_s.items").cast("long").alias("n")
    )


@query
def normalised_docs(spark, sf):
    """Whole-document repair, looked at through the fields it touches."""
    comment = normalise.origin_comment(ISSUES_URL)
    repaired = fixture(spark, sf, "docs").select(
        "doc_id", normalise.normalise_text(F.col("raw"), comment).alias("raw")
    )
    v = F.col("v")
    return (
        with_value(repaired)
        .filter(v.isNotNull())
        .select(
            "doc_id",
            geo.box_of(v).alias("box"),
            F.array_join(
                F.transform(array_at(v, "$.keywords"), any_text), "|"
            ).alias("keywords"),
            F.array_join(
                F.transform(array_at(v, "$.distribution[0].encodingFormat"), any_text), "|"
            ).alias("formats"),
            F.when(kind(child(v, "$.comment")) == "ARRAY", F.lit("list"))
            .otherwise(F.lit("text"))
            .alias("comment_kind"),
        )
    )


# ---- replies ---------------------------------------------------------------------------------------


@query
def response_parse(spark, sf):
    parsed = responses.parse_replies(fixture(spark, sf, "responses"))
    return parsed.select(
        "doc_id",
        "kind",
        F.when(F.col("kind") == "object", any_text(child(F.col("v"), "$.name"))).alias("doc_name"),
    )


def _detected(spark: SparkSession, sf: str) -> DataFrame:
    return responses.detected_datasets(
        fixture(spark, sf, "responses"), "doc_id", F.col("site"), F.col("site_url")
    )


@query
def response_datasets(spark, sf):
    return _detected(spark, sf).select("doc_id", _long("j"), "name", "url")


@query
def response_counts(spark, sf):
    return responses.dataset_counts(_detected(spark, sf), "doc_id")


@query
def metadata_merge(spark, sf):
    merged = responses.merge_metadata(
        _detected(spark, sf), fixture(spark, sf, "registry"), "doc_id", "row_id"
    )
    return merged.select("doc_id", _long("j"), "name", "grp", "publisher", "description")


@query
def prompt_sizes(spark, sf):
    """Prompts over whole texts and their sizes."""
    prompt = detection_prompt(
        TEMPLATE,
        F.concat(F.lit("https://ex.org/d/"), F.col("doc_id").cast("string")),
        F.col("text"),
        F.col("source"),
        F.col("lang"),
        F.lit(""),
    )
    return (
        table(spark, sf, "documents")
        .select("doc_id", F.length("text").cast("long").alias("n_text"), prompt.alias("prompt"))
        .select(
            "doc_id",
            "n_text",
            F.length("prompt").cast("long").alias("n"),
            (F.length("prompt") > LARGE_PROMPT_SIZES[0]).alias("large"),
        )
    )


@query
def generation_prompts(spark, sf):
    """Prompts of the second step over merged metadata, with the page facts of each dataset."""
    merged = responses.merge_metadata(
        _detected(spark, sf), fixture(spark, sf, "registry"), "doc_id", "row_id"
    )
    source = fixture(spark, sf, "source_pages").withColumn(
        "url", F.regexp_replace("base_url", "/index.html$", "")
    )
    facts = pages.facts_json(pages.with_facts(source, "url"), "url")
    requests = responses.generation_requests(
        responses.with_source_facts(merged, facts),
        "{DATASET_NAME}|{GROUP}|{PUBLISHER}|{EXTRACTED_METADATA}{EXAMPLE_JSONLD}",
        "doc_id",
        F.lit(""),
    )
    return requests.select(
        "doc_id",
        _long("j"),
        F.regexp_extract("prompt", r"^([^|]*\|[^|]*\|[^|]*)\|", 1).alias("head"),
        F.contains("prompt", F.lit('"source_facts":{{"download_links"')).alias("has_facts"),
    )


# ---- validation and audit --------------------------------------------------------------------------


def _checked(spark: SparkSession, sf: str) -> DataFrame:
    return validation.check_documents(fixture(spark, sf, "docs"))


@query
def validate_docs(spark, sf):
    return _checked(spark, sf).select(
        "doc_id", "ok", F.array_join("messages", "; ").alias("messages")
    )


@query
def validate_summary(spark, sf):
    return validation.verdict(_checked(spark, sf))


@query
def validate_passed(spark, sf):
    rows = validation.document_summary(_checked(spark, sf), "doc_id")
    return rows.select("doc_id", "type", "name", "box", _long("n_distribution"))


@query
def audit_names(spark, sf):
    return audit.variable_names(fixture(spark, sf, "docs")).select("doc_id", _long("idx"), "name")


def _with_sets(spark: SparkSession, sf: str, *more: str) -> DataFrame:
    features = audit.document_features(fixture(spark, sf, "docs"))
    sets = pages.source_sets(_facts(spark, sf, "links", "variables", *more))
    return audit.with_sets(features, sets, "doc_id", "page_id")


@query
def audit_missing_codes(spark, sf):
    rows = audit.missing_codes(_with_sets(spark, sf))
    return rows.select("doc_id", F.array_join("codes", ",").alias("codes"))


@query
def audit_download_match(spark, sf):
    return audit.download_match(_with_sets(spark, sf))


@query
def audit_docs(spark, sf):
    rows = audit.warning_rows(audit.audit_documents(_with_sets(spark, sf)))
    return rows.select("doc_id", _long("idx"), "warning")


@query
def contract_rules(spark, sf):
    return audit.check_contract(fixture(spark, sf, "docs"), ISSUES_URL)


@query
def plan_rules(spark, sf):
    return audit.check_plan(_with_sets(spark, sf, "cited"))


@query
def variable_coverage(spark, sf):
    rows = audit.variable_coverage(fixture(spark, sf, "docs"))
    return rows.select("doc_id", _long("idx"), "name", "temporal", "spatial")


@query
def temporal_intervals(spark, sf):
    rows = audit.temporal_texts(fixture(spark, sf, "docs")).withColumn(
        "_t", parse_interval(F.col("text"))
    )
    return rows.select("doc_id", _long("idx"), _long("part"), "_t.start", "_t.end", "_t.kind")


# ---- failures --------------------------------------------------------------------------------------


@query
def failure_class(spark, sf):
    return failures.classify(fixture(spark, sf, "failures")).select("event_id", "reason", "delay")


@query
def failure_summary(spark, sf):
    return failures.by_reason(failures.classify(fixture(spark, sf, "failures"))).select(
        "reason", "title", "n"
    )


# ---- sitemaps and catalogues -----------------------------------------------------------------------


@query
def sitemap_reconcile(spark, sf):
    rows = fixture(spark, sf, "sitemap")
    return catalog.reconcile(rows.filter("listed"), rows.filter("present"))


@query
def sitemap_incremental(spark, sf):
    rows = catalog.changed_since(fixture(spark, sf, "sitemap"), LAST_RUN)
    return rows.select("page_id", "loc", "lastmod")


@query
def sitemap_union(spark, sf):
    rows = fixture(spark, sf, "sitemap")
    # The second map has an older time that is the larger text.
    other = rows.withColumn("lastmod", F.replace("lastmod", F.lit("T10:00:00Z"), F.lit("T11:30:00+02:00")))
    return catalog.union_sitemaps(rows.filter("listed"), other.filter("present"))


def _catalogues(spark: SparkSession, sf: str) -> DataFrame:
    return with_value(fixture(spark, sf, "catalogues"))


@query
def catalog_parts(spark, sf):
    return catalog.part_urls(_catalogues(spark, sf), "cat_id").select("cat_id", _long("pos"), "url")


@query
def catalog_dangling(spark, sf):
    edges = catalog.catalogue_edges(_catalogues(spark, sf), ("dataset",))
    known = _docs(spark, sf).select(catalog.document_id(F.col("v")).alias("id"))
    return catalog.dangling(edges, known).select("parent_id", "child_id")


@query
def page_references(spark, sf):
    docs = _docs(spark, sf)
    names = docs.select(
        catalog.document_id(F.col("v")).alias("id"),
        any_text(child(F.col("v"), "$.name")).alias("target_name"),
    )
    rows = catalog.with_target(catalog.page_references(docs), names, "id", "target_name")
    return rows.select("parent_id", "relation", "child_id", "target_name")


@query
def parent_links(spark, sf):
    return catalog.parent_links(_docs(spark, sf))


@query
def catalog_walk(spark, sf):
    edges = catalog.catalogue_edges(_catalogues(spark, sf), ("hasPart",))
    # Roots and walk both read the edges: the documents are parsed once.
    by_url = written(
        edges.select(F.replace("parent_id", F.lit("/cat/"), F.lit("/c/")).alias("parent_id"), "child_id")
    )
    roots = by_url.agg(F.min("parent_id").alias("url"))
    return crawl.catalogue_walk(by_url, roots).select("url", _long("depth"), "leaf")


@query
def doi_urls(spark, sf):
    found = fixture(spark, sf, "doi_texts").select(
        "doc_id", F.posexplode(text.doi_urls(F.col("text"))).alias("pos", "url")
    )
    return found.select("doc_id", _long("pos"), "url")


@query
def catalog_edges(spark, sf):
    edges = catalog.catalogue_edges(_catalogues(spark, sf).unionByName(_docs(spark, sf), True))
    return edges.groupBy("relation").agg(
        F.count("*").alias("n"), F.count_distinct("parent_id").alias("n_parents")
    )


@query
def catalog_sources(spark, sf):
    return fixture(spark, sf, "browsed").select(
        "page_id", urls.catalogue_source_url(F.col("url")).alias("url")
    )


# ---- walks -----------------------------------------------------------------------------------------


def _seeds(edges: DataFrame) -> DataFrame:
    return edges.agg(F.min("src").alias("url"))


@query
def new_links(spark, sf):
    links = fixture(spark, sf, "edges").select(F.col("dst").alias("url"))
    visited = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("url"))
    return crawl.new_links(links, visited)


@query
def crawl_levels(spark, sf):
    edges = fixture(spark, sf, "edges").select("src", "dst")
    return crawl.crawl(edges, _seeds(edges)).select("url", _long("depth"))


@query
def crawl_bounded(spark, sf):
    edges = fixture(spark, sf, "edges").select("src", "dst")
    return crawl.crawl(edges, _seeds(edges), max_depth=3).select("url", _long("depth"))


@query
def crawl_order(spark, sf):
    """Place of each page among the pages of its level, by the link positions that lead to it."""
    edges = fixture(spark, sf, "edges")
    walked = crawl.crawl(edges, _seeds(edges), max_depth=5)
    return walked.select("url", _long("depth"), F.array_join("path", "/").alias("path"))


@query
def crawl_queue(spark, sf):
    """Every page reached, numbered as a first-in-first-out queue visits it."""
    edges = fixture(spark, sf, "edges")
    return crawl.crawl_queue(edges, _seeds(edges), max_depth=5).select("url", _long("depth"), "place")


@query
def redirect_final(spark, sf):
    return crawl.final_targets(fixture(spark, sf, "redirects")).select(
        "from_id", "final_id", _long("hops")
    )


# ---- quads -----------------------------------------------------------------------------------------


def _quads(spark: SparkSession, sf: str) -> DataFrame:
    return parse_quads(fixture(spark, sf, "quads"))


@query
def quad_terms(spark, sf):
    return _quads(spark, sf).select("s", "p", "value", "kind", "datatype", "language", "g")


@query
def quad_typed(spark, sf):
    rows = _quads(spark, sf).filter(F.col("datatype").isNotNull()).withColumn(
        "_t", terms.typed_values(F.col("value"), F.col("datatype"))
    )
    return rows.select("s", "_t.as_boolean", "_t.as_long")


@query
def quad_profile(spark, sf):
    return quads.predicate_profile(_quads(spark, sf))


@query
def quad_graphs(spark, sf):
    return quads.graph_summary(_quads(spark, sf)).select("g", "n", "source", "sha")


@query
def quad_entities(spark, sf):
    wanted = {"name": SCHEMA + "name", "value": SCHEMA + "value"}
    found = quads.entities(_quads(spark, sf), SCHEMA + "Organization", wanted)
    return found.select("g", "s", *[F.array_join(c, "|").alias(c) for c in wanted])


@query
def rejected_pages(spark, sf):
    """Pages that the tolerant reader cannot take, every fifth spoilt on purpose."""
    spoilt = F.when(F.col("page_id") % 5 == 0, F.concat(F.lit("<![foo bar[ x"), "html")).otherwise(F.col("html"))
    return pages.rejected_pages(table(spark, sf, "pages").withColumn("html", spoilt)).select("page_id")


@query
def rejected_docs(spark, sf):
    """Documents that give no statements: no JSON, or nested beyond reading."""
    docs = fixture(spark, sf, "docs").withColumn("g", F.col("doc_id").cast("string"))
    deep = F.concat(F.repeat(F.lit("["), 100000), F.col("raw"))
    docs = docs.withColumn("raw", F.when(F.col("doc_id") % 97 == 0, deep).otherwise(F.col("raw")))
    return quads.rejected_documents(docs).select(F.col("g").cast("long").alias("doc_id"))


@query
def quad_entity_values(spark, sf):
    return quads.entity_values(
        _quads(spark, sf), SCHEMA + "Person", [SCHEMA + "name", SCHEMA + "value"]
    )


@query
def quad_types(spark, sf):
    return quads.type_profile(_quads(spark, sf))


@query
def quad_follow(spark, sf):
    steps = quads.follow(
        _quads(spark, sf), SCHEMA + "Organization", SCHEMA + "value", SCHEMA + "contentUrl"
    )
    return steps.select("g", "s", "middle", "value")


def _release(spark: SparkSession, sf: str, side: str, name: str = "release") -> DataFrame:
    rows = fixture(spark, sf, f"{name}_{side}")
    none = F.lit(None).cast("string")
    return rows.withColumn("o", terms.print_term(F.col("value"), F.col("kind"), none, none))


@query
def quad_union(spark, sf):
    both = quads.union_releases(_release(spark, sf, "left"), _release(spark, sf, "right"))
    return both.groupBy("g").agg(F.count("*").alias("n"))


@query
def quad_union_diff(spark, sf):
    differences = quads.compare_releases(_release(spark, sf, "left"), _release(spark, sf, "right"))
    return quads.difference_profile(differences).select("p", "side", "n")


@query
def quad_tangled_diff(spark, sf):
    """Two releases whose unnamed nodes differ only in how they hang together: rings of two lengths, and shared nodes."""
    left, right = (_release(spark, sf, side, "tangled") for side in ("left", "right"))
    return quads.difference_profile(quads.compare_releases(left, right)).select("p", "side", "n")


@query
def doc_quads(spark, sf):
    """Documents flattened to quads, profiled by predicate and kind of value."""
    docs = fixture(spark, sf, "docs").withColumn(
        "g", F.concat(F.lit("urn:ex:org:docs:data:"), F.sha1("raw"))
    )
    flat = quads.quads_of_documents(docs)
    return flat.groupBy("p", "kind", "datatype").agg(F.count("*").alias("n"))


# ---- identity and rasters --------------------------------------------------------------------------


@query
def duplicate_docs(spark, sf):
    return documents.duplicates(fixture(spark, sf, "copies"))


@query
def doc_integrity(spark, sf):
    return documents.integrity(fixture(spark, sf, "files")).select("doc_id", "stem", "intact")


@query
def tile_extent(spark, sf):
    return geo.collection_extent(fixture(spark, sf, "rasters"))

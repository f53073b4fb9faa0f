"""Links, text and source facts of captured pages."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from metaloom.functions import urls
from metaloom.functions.bind import first_per_key, once
from metaloom.functions.markup import ld_json_texts, with_page_parts
from metaloom.functions.variants import strip, with_value
from metaloom.shipping import ship_by_value

ship_by_value(__name__)

# Labels, headers and names that steer the extraction.
CITATION_LABELS = ["Model Citation", "Data Citation"]
HEADER_CODES = ["name", "code", "property"]
HEADER_LINES = ["Name Unit Description", "Overview Variables"]
CODE_PATTERN = r"^[A-Za-z][A-Za-z0-9_-]*\z"
CODE_LINE = r"^\(([^)]+)\)(.*)$"
CODE_REST = r"(?U)^\([^)]+\)\s*+(\S*+)\s*+(.*?)\s*$"


def page_links(pages: DataFrame, key: str = "page_id", *keep: str) -> DataFrame:
    """Every anchor with a href, in page order, repeats kept: key, kept columns, pos, href, label."""
    parts = with_page_parts(pages, [key, *keep], ["anchors"])
    return parts.select(key, *keep, F.posexplode("anchors").alias("pos", "_a")).select(
        key, *keep, "pos", F.col("_a.href").alias("href"), F.col("_a.label").alias("label")
    )


def resolved_links(pages: DataFrame, key: str = "page_id", base: str = "url") -> DataFrame:
    """Links with their absolute address as `target`."""
    return once(page_links(pages, key, base), target=urls.resolve(F.col(base), F.col("href")))


def distinct_links(links: DataFrame, key: str = "page_id", href: str = "href") -> DataFrame:
    """One row per (page, label, href) with the first position.

    Grouping on all three keeps a page with very many links spread over tasks.
    """
    return links.groupBy(key, "label", href).agg(F.min("pos").alias("first_pos"))


def _link_key(link: Column) -> Column:
    return F.concat(link["label"], F.lit("\u0001"), link["href"])


def distinct_page_links(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """`distinct_links` of captured pages: repeats lie in one page, so they are dropped inside the row."""
    anchors = F.transform(
        "anchors",
        lambda a, i: F.struct(i.alias("pos"), a["label"].alias("label"), a["href"].alias("href")),
    )
    return (
        with_page_parts(pages, [key], ["anchors"])
        .select(key, F.inline(first_per_key(anchors, _link_key, ["pos"])))
        .withColumnRenamed("pos", "first_pos")
    )


def links_per_host(pages: DataFrame, key: str = "page_id", base: str = "url") -> DataFrame:
    """Distinct resolved links and linking pages per target host.

    Repeats of a link lie in one page, so they are dropped inside the row. The first aggregate is on (host,
    page) and is complete before its shuffle, so a host that holds most links is counted by many tasks.
    """
    same = F.array_distinct(
        F.transform(
            "anchors",
            lambda a: F.concat(a["label"], F.lit("\u0001"), urls.resolve(F.col(base), a["href"])),
        )
    )
    links = with_page_parts(pages, [key, base], ["anchors"]).select(key, F.explode(same).alias("_link"))
    target = F.element_at(F.split("_link", "\u0001"), -1)
    per_page = (
        once(links, host=F.when(urls.is_http(target), urls.host(target)))
        .filter(F.col("host").isNotNull())
        .groupBy("host", key)
        .agg(F.count("*").alias("n"))
    )
    return per_page.groupBy("host").agg(
        F.count("*").alias("n_pages"), F.sum("n").alias("n_links")
    )


def page_text(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """Visible text of each page and its length."""
    return with_page_parts(pages, [key], ["text"]).select(
        key, F.length("text").cast("long").alias("n_chars"), "text"
    )


def is_download(label: Column, href: Column) -> Column:
    """A link that leads to data: `download` in label or address, or `data` in the label."""
    low = F.lower(label)
    return (
        F.contains(low, F.lit("download"))
        | F.contains(F.lower(href), F.lit("download"))
        | F.contains(low, F.lit("data"))
    )


def _field(value: Column | None, name: str) -> Column:
    return (F.lit(None).cast("string") if value is None else value).alias(name)


FACT_KINDS = ("links", "cited", "variables")
_PARTS_OF_KIND = {"links": ["anchors"], "cited": ["lines"], "variables": ["lines", "rows"]}


def with_facts(
    pages: DataFrame,
    key: str = "page_id",
    base: str = "base_url",
    kinds: tuple[str, ...] = FACT_KINDS,
) -> DataFrame:
    """Facts of each page as arrays: links, cited and variables, or only the given kinds.

    The html is read once, in one Python pass; everything else is array work inside the row, so nothing is
    shuffled. Of equal links, and of variables with one code, the first is kept; table rows come before text lines.
    """
    needed = [p for p in ("anchors", "lines", "rows") if any(p in _PARTS_OF_KIND[k] for k in kinds)]
    parts = with_page_parts(pages, [key, base], needed)
    if "lines" in needed:
        following = F.slice("lines", 2, F.greatest(F.size("lines") - 1, F.lit(0)))
        parts = once(parts, pairs=F.arrays_zip("lines", following.alias("next")))
    makers = {"links": lambda: _links(base), "cited": _cited, "variables": _variables}
    return once(parts, **{k: makers[k]() for k in kinds}).select(key, *kinds)


def _variables() -> Column:
    both = F.concat(_row_variables(), _line_variables())
    return first_per_key(both, lambda v: F.lower(v["code"]), ["pass", "pos"])


def _links(base: str) -> Column:
    """Anchors that lead to data, with their absolute address; an empty label reads `link`."""
    every = F.transform(
        "anchors",
        lambda a, i: F.struct(
            i.alias("pos"),
            a["label"].alias("label"),
            urls.resolve(F.col(base), a["href"]).alias("href"),
        ),
    )
    found = F.filter(every, lambda a: is_download(a["label"], a["href"]) & (a["href"] != ""))
    return F.transform(
        first_per_key(found, _link_key, ["pos"]),
        lambda a: F.struct(
            a["pos"].alias("pos"),
            F.when(a["label"] == "", F.lit("link")).otherwise(a["label"]).alias("label"),
            a["href"].alias("href"),
        ),
    )


def _cited() -> Column:
    """The line after each citation label."""
    every = F.transform(
        "pairs",
        lambda p, i: F.struct(i.alias("pos"), p["lines"].alias("label"), p["next"].alias("text")),
    )
    return F.filter(every, lambda c: c["label"].isin(CITATION_LABELS) & c["text"].isNotNull())


def _row_variables() -> Column:
    """Variables named by table rows: code, name and unit are the first three cells."""
    return F.filter(
        F.transform(
            "rows",
            lambda row, i: F.struct(
                F.lit(0).alias("pass"),
                i.alias("pos"),
                F.get(row, F.lit(0)).alias("code"),
                F.get(row, F.lit(1)).alias("name"),
                F.coalesce(F.get(row, F.lit(2)), F.lit("")).alias("unit"),
                F.get(row, F.lit(1)).alias("description"),
            ),
        ),
        lambda v: v["code"].rlike(CODE_PATTERN)
        & (F.coalesce(v["name"], F.lit("")) != "")
        & ~F.lower(v["code"]).isin(HEADER_CODES),
    )


def _line_variables() -> Column:
    """Variables named by `(code) unit description` lines; the line before is the name."""
    matching = F.filter(
        "pairs", lambda p: p["next"].rlike(CODE_LINE) & ~p["lines"].isin(HEADER_LINES)
    )
    return F.transform(
        matching,
        lambda p, i: F.struct(
            F.lit(1).alias("pass"),
            i.alias("pos"),
            strip(F.regexp_extract(p["next"], CODE_LINE, 1)).alias("code"),
            p["lines"].alias("name"),
            F.regexp_extract(p["next"], CODE_REST, 1).alias("unit"),
            F.regexp_extract(p["next"], CODE_REST, 2).alias("description"),
        ),
    )


def download_links(facts: DataFrame, key: str = "page_id") -> DataFrame:
    """Distinct data links of pages read by `with_facts`: key, pos, label, href."""
    return facts.select(key, F.inline("links"))


def citations(facts: DataFrame, key: str = "page_id") -> DataFrame:
    """The line after each citation label; a label on the last line has none."""
    return facts.select(key, F.inline("cited"))


def source_variables(facts: DataFrame, key: str = "page_id") -> DataFrame:
    """Variables of a page, one per code: key, pass, pos, code, name, unit, description."""
    return facts.select(key, F.inline("variables"))


def fact_counts(facts: DataFrame, key: str = "page_id") -> DataFrame:
    """Links, citations and variables per page."""
    return facts.select(
        key,
        F.size("links").cast("long").alias("n_links"),
        F.size("cited").cast("long").alias("n_citations"),
        F.size("variables").cast("long").alias("n_variables"),
    )


def source_sets(facts: DataFrame, key: str = "page_id") -> DataFrame:
    """Per page: the set of lower-case variable codes, the set of data links, and the citations, if read."""
    cited = [F.size("cited").alias("n_shown")] if "cited" in facts.columns else []
    return facts.select(
        key,
        *cited,
        F.transform("variables", lambda v: F.lower(v["code"])).alias("codes"),
        F.array_distinct(F.transform("links", lambda a: a["href"])).alias("hrefs"),
    )


def facts_json(facts: DataFrame, key: str = "page_id") -> DataFrame:
    """The facts of a page as the JSON object that goes into a generation prompt: key, facts."""
    return facts.select(
        key,
        F.to_json(
            F.struct(
                F.transform(
                    "links", lambda a: F.struct(a["label"].alias("label"), a["href"].alias("href"))
                ).alias("download_links"),
                F.transform(
                    "cited", lambda c: F.struct(c["label"].alias("label"), c["text"].alias("text"))
                ).alias("citation_text"),
                F.transform(
                    "variables",
                    lambda v: F.struct(
                        v["name"].alias("name"),
                        v["code"].alias("alternateName"),
                        v["unit"].alias("unitText"),
                        v["description"].alias("description"),
                    ),
                ).alias("variables"),
            )
        ).alias("facts"),
    )


def source_facts(pages: DataFrame, key: str = "page_id", base: str = "base_url") -> DataFrame:
    """All facts of all pages in long form: key, kind, pass, pos and the fields of the kind.

    `kind` is link (label, href), citation (label, text) or variable (code, name, unit, description). One
    reading of the html feeds one explode.
    """
    names = ["label", "href", "text", "code", "name", "unit", "description"]

    def shaped(array: str, kind: str, given: list[str]) -> Column:
        def fact(item: Column) -> Column:
            return F.struct(
                F.lit(kind).alias("kind"),
                (item["pass"] if kind == "variable" else F.lit(0)).alias("pass"),
                item["pos"].alias("pos"),
                *[_field(item[n] if n in given else None, n) for n in names],
            )

        return F.transform(array, fact)

    every = F.concat(
        shaped("links", "link", names[:2]),
        shaped("cited", "citation", ["label", "text"]),
        shaped("variables", "variable", names[3:]),
    )
    return with_facts(pages, key, base).select(key, F.inline(every))


def ld_json_blocks(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """Embedded JSON-LD blocks: key, pos, raw, v (NULL for a block that is no JSON)."""
    found = pages.select(key, F.posexplode(ld_json_texts(F.col("html"))).alias("pos", "raw"))
    return with_value(found.withColumn("raw", strip(F.col("raw"))))


def allowed_pages(pages: DataFrame, domains: list[str], key: str = "page_id") -> DataFrame:
    """Distinct pages on the allowed hosts."""
    return pages.filter(urls.in_domains(F.col("url"), domains)).select(key, "url").distinct()


def extract(
    pages: DataFrame,
    fn: Callable[[str], Iterable[tuple]],
    schema: str,
    key: str = "page_id",
    html: str = "html",
) -> DataFrame:
    """Rows that a caller's function draws from each page: key, pos and the columns of `schema`.

    `fn` takes the html of one page and yields tuples; `schema` is a DDL list of their columns.
    """
    key_type = pages.schema[key].dataType.simpleString()
    full = f"`{key}` {key_type}, pos int, {schema}"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [
                (page, pos, *values)
                for page, text in zip(batch[key], batch[html])
                for pos, values in enumerate(fn(text or ""))
            ]
            yield pd.DataFrame(rows, columns=names)

    names = pages.sparkSession.createDataFrame([], full).columns
    return pages.select(key, html).mapInPandas(run, full)


def rejected_pages(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """The pages that the reader refuses, with the kind of error."""
    return with_page_parts(pages, [key], ["error"], html).filter(F.col("error").isNotNull())

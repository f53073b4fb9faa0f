"""Review warnings for generated documents against the facts of their source page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from metaloom.functions.bind import once, shuffled
from metaloom.functions.normalise import ORIGIN_COMMENT, SHORT_ORIGIN_COMMENT
from metaloom.functions.variants import (
    any_text,
    array_at,
    as_array,
    child,
    has_key,
    is_truthy,
    kind,
    with_value,
)

# Review warnings.
NOT_AN_OBJECT = "Generated JSON-LD is not an object"
CITATION_IS_TEXT = "citation is a string; expected an array of structured citation objects"
CITATION_HAS_TEXT = "citation array contains string entries; expected structured citation objects"
VARIABLES_ARE_TEXT = "variableMeasured is a string; expected separate PropertyValue objects"
MISSING_CODES = "variableMeasured is missing source-listed variable code(s): "
NO_DOWNLOAD = "distribution does not include any exact source-page Download href"
STATIC = "Static"
NOT_DETECTED = "not detected"

_RANGE = r"(?U)\b[A-Za-z]+\d+\s*[–-]\s*[A-Za-z]*\d+\b"
_CODE = r"^[A-Za-z][A-Za-z0-9_-]*\z"


def looks_like_code(name: Column) -> Column:
    """A range such as `BIO1-BIO19`, a name with a slash, or an identifier in place of a name."""
    return F.coalesce(
        name.rlike(_RANGE)
        | F.contains(name, F.lit("/"))
        | (name.rlike(_CODE) & ((name == F.lower(name)) | name.rlike("[0-9]"))),
        F.lit(False),
    )


def _codes(listed: Column) -> Column:
    """Lower-case alternate names of listed variables."""
    names = F.transform(
        F.filter(listed, lambda item: kind(item) == "OBJECT"),
        lambda item: child(item, "$.alternateName"),
    )
    return F.transform(F.filter(names, is_truthy), lambda n: F.lower(any_text(n)))


def content_urls(doc: Column, coerce_single: bool = False) -> Column:
    """Content addresses of the listed distributions; a single object counts only on request."""
    items = as_array(doc, "$.distribution") if coerce_single else array_at(doc, "$.distribution")
    urls = F.transform(
        F.filter(items, lambda item: kind(item) == "OBJECT"),
        lambda item: any_text(child(item, "$.contentUrl")),
    )
    return F.coalesce(
        F.filter(urls, lambda u: u.isNotNull() & (u != "")), F.array().cast("array<string>")
    )


def variable_names(docs: DataFrame, key: str = "doc_id", raw: str = "raw") -> DataFrame:
    """Listed variables whose name looks like a code or a range: key, idx, name."""
    items = with_value(docs, raw).select(
        key, F.posexplode(array_at(F.col("v"), "$.variableMeasured")).alias("idx", "_item")
    )
    return items.select(
        key, "idx", any_text(child(F.col("_item"), "$.name")).alias("name")
    ).filter(looks_like_code(F.col("name")))


def document_features(
    docs: DataFrame, key: str = "doc_id", raw: str = "raw", coerce_single: bool = False
) -> DataFrame:
    """What the audit needs to know of each parsed document, and nothing else of it.

    is_object, lists_variables, head and inner (warnings that need no source page), codes, urls, n_citations.
    The document itself stays behind, so the join with the source facts moves small rows.
    """
    none = F.array().cast("array<string>")
    v = F.col("v")
    parsed = with_value(docs, raw).filter(v.isNotNull()).select(key, "v")
    listed = F.when(
        F.lit(coerce_single) | (kind(child(v, "$.variableMeasured")) == "ARRAY"),
        as_array(v, "$.variableMeasured"),
    )
    rows = once(parsed, _listed=listed)
    citation = child(v, "$.citation")
    text_citation = F.exists(array_at(v, "$.citation"), lambda c: kind(c) == "STRING")
    return once(
        rows,
        is_object=F.coalesce(kind(v) == "OBJECT", F.lit(False)),
        lists_variables=F.col("_listed").isNotNull(),
        head=_texts(
            F.when(kind(citation) == "STRING", F.lit(CITATION_IS_TEXT)).when(
                text_citation, F.lit(CITATION_HAS_TEXT)
            ),
            F.when(kind(child(v, "$.variableMeasured")) == "STRING", F.lit(VARIABLES_ARE_TEXT)),
        ),
        inner=F.coalesce(F.flatten(F.transform("_listed", _variable_warnings)), none),
        doc_codes=F.coalesce(_codes(F.col("_listed")), none),
        urls=content_urls(v, coerce_single),
        n_citations=F.coalesce(F.size(array_at(v, "$.citation")), F.lit(0)),
    ).drop("v", "_listed")


def _texts(*items: Column) -> Column:
    return F.array_compact(F.array(*items))


def _variable_warnings(item: Column, i: Column) -> Column:
    at = F.concat(F.lit("variableMeasured["), i.cast("string"), F.lit("]"))
    return F.when(
        kind(item) == "OBJECT",
        _texts(
            F.when(
                looks_like_code(any_text(child(item, "$.name"))),
                F.concat(at, F.lit(".name looks like a code or lumped range")),
            ),
            F.when(
                ~has_key(item, "$.temporalCoverage"),
                F.concat(at, F.lit(" is missing temporalCoverage")),
            ),
            F.when(
                ~has_key(item, "$.spatialCoverage"),
                F.concat(at, F.lit(" is missing spatialCoverage")),
            ),
        ),
    ).otherwise(F.array().cast("array<string>"))


def with_sets(features: DataFrame, sets: DataFrame, key: str, set_key: str) -> DataFrame:
    """Document features next to the code and link sets of their source page; an unknown page has none.

    One join on a unique page key. Adds lacking (codes of the page that the document does not list) and hrefs,
    and n_shown, the citations of the page, if the sets have it.
    """
    empty = F.array().cast("array<string>")
    shown = ["n_shown"] if "n_shown" in sets.columns else []
    pages = sets.select(
        F.col(set_key).alias("_page"), F.col("codes").alias("_codes"), F.col("hrefs").alias("_hrefs"), *shown
    )
    joined = features.join(shuffled(pages), F.col(key) == F.col("_page"), "left")
    return once(
        joined,
        lacking=F.array_sort(F.array_except(F.coalesce("_codes", empty), F.col("doc_codes"))),
        hrefs=F.coalesce("_hrefs", empty),
    ).drop("_page", "_codes", "_hrefs")


def missing_codes(featured: DataFrame, key: str = "doc_id") -> DataFrame:
    """Codes the page lists and the document lacks, sorted, for documents that list variables."""
    return featured.filter(F.col("lists_variables") & (F.size("lacking") > 0)).select(
        key, F.col("lacking").alias("codes")
    )


def download_match(featured: DataFrame, key: str = "doc_id") -> DataFrame:
    """Whether a document names any exact data link of its page; pages without such links are left out."""
    return featured.filter((F.size("hrefs") > 0) & F.col("is_object")).select(
        key, F.arrays_overlap("urls", "hrefs").alias("matched")
    )


def audit_documents(featured: DataFrame, key: str = "doc_id") -> DataFrame:
    """All review warnings of each document, in order: key, warnings."""
    warnings = F.concat(
        "head",
        "inner",
        _texts(
            F.when(
                F.col("lists_variables") & (F.size("lacking") > 0),
                F.concat(F.lit(MISSING_CODES), F.array_join("lacking", ", ")),
            ),
            F.when((F.size("hrefs") > 0) & ~F.arrays_overlap("urls", "hrefs"), F.lit(NO_DOWNLOAD)),
        ),
    )
    every = F.when(F.col("is_object"), warnings).otherwise(F.array(F.lit(NOT_AN_OBJECT)))
    return once(featured, warnings=every).select(key, "warnings")


def warning_rows(audited: DataFrame, key: str = "doc_id") -> DataFrame:
    return audited.select(key, F.posexplode("warnings").alias("idx", "warning"))


def variable_coverage(docs: DataFrame, key: str = "doc_id", raw: str = "raw") -> DataFrame:
    """Listed variables with their coverages; missing ones take the agreed defaults."""
    items = with_value(docs, raw).select(
        key, F.posexplode(array_at(F.col("v"), "$.variableMeasured")).alias("idx", "_item")
    )
    item = F.col("_item")
    return items.select(
        key,
        "idx",
        any_text(child(item, "$.name")).alias("name"),
        F.when(has_key(item, "$.temporalCoverage"), any_text(child(item, "$.temporalCoverage")))
        .otherwise(F.lit(STATIC))
        .alias("temporal"),
        F.when(has_key(item, "$.spatialCoverage"), any_text(child(item, "$.spatialCoverage")))
        .otherwise(F.lit(NOT_DETECTED))
        .alias("spatial"),
    )


def temporal_texts(docs: DataFrame, key: str = "doc_id", raw: str = "raw") -> DataFrame:
    """Every temporal coverage of every listed variable, lists opened: key, idx, part, text."""
    items = with_value(docs, raw).select(
        key, F.posexplode(array_at(F.col("v"), "$.variableMeasured")).alias("idx", "_item")
    )
    return items.select(
        key,
        "idx",
        F.posexplode(as_array(F.col("_item"), "$.temporalCoverage")).alias("part", "_text"),
    ).select(key, "idx", "part", any_text(F.col("_text")).alias("text"))


def _comment_is_known(doc: Column, issues_url: str) -> Column:
    comments = F.transform(as_array(doc, "$.comment"), any_text)
    full = ORIGIN_COMMENT.format(issues_url=issues_url)
    return F.arrays_overlap(comments, F.array(F.lit(full), F.lit(SHORT_ORIGIN_COMMENT)))


def contract_rules(issues_url: str) -> dict[str, Column]:
    """Rule name to a boolean column over `v`: the agreement a generated document must keep."""
    v = F.col("v")
    context = child(v, "$.@context")
    listed = array_at(v, "$.variableMeasured")
    distributions = array_at(v, "$.distribution")
    vocabulary = F.coalesce(any_text(child(v, "$.@context.@vocab")), any_text(context))

    def all_objects(items: Column) -> Column:
        return F.forall(items, lambda item: kind(item) == "OBJECT")

    return {
        "context_vocab": vocabulary.rlike("^https?://schema.org/?$"),
        "type": any_text(child(v, "$.@type")).isin("Dataset", "DataCatalog"),
        "id": is_truthy(child(v, "$.@id")),
        "keywords_array": ~has_key(v, "$.keywords") | (kind(child(v, "$.keywords")) == "ARRAY"),
        "encoding_array": F.coalesce(
            F.forall(
                distributions,
                lambda d: ~has_key(d, "$.encodingFormat")
                | (kind(child(d, "$.encodingFormat")) == "ARRAY"),
            ),
            F.lit(True),
        )
        & (
            ~has_key(v, "$.encodingFormat") | (kind(child(v, "$.encodingFormat")) == "ARRAY")
        ),
        "citation_array": ~has_key(v, "$.citation")
        | F.coalesce(all_objects(array_at(v, "$.citation")), F.lit(False)),
        "variable_coverage": F.coalesce(
            F.forall(
                listed,
                lambda item: has_key(item, "$.temporalCoverage")
                & has_key(item, "$.spatialCoverage"),
            ),
            F.lit(True),
        ),
        "comment": _comment_is_known(v, issues_url),
    }


def check_contract(
    docs: DataFrame, issues_url: str, key: str = "doc_id", raw: str = "raw"
) -> DataFrame:
    """Each rule's outcome for each document that is an object: key, rule, ok."""
    parsed = with_value(docs, raw).filter(kind(F.col("v")) == "OBJECT")
    rows = F.array(
        *[
            F.struct(F.lit(name).alias("rule"), F.coalesce(rule, F.lit(False)).alias("ok"))
            for name, rule in contract_rules(issues_url).items()
        ]
    )
    return parsed.select(key, F.inline(rows))


def check_plan(
    featured: DataFrame, citation_counts: DataFrame | None = None, key: str = "doc_id"
) -> DataFrame:
    """Source fidelity: all listed variables, all citations, an exact data link: key, rule, ok.

    The citations that a source page shows are `n_shown` of `featured`, as `with_sets` adds it when they were read with
    the sets, or else `n_citations` of `citation_counts`, which has the key.
    """
    rows = featured.filter("is_object")
    if citation_counts is not None:
        shown = citation_counts.select(F.col(key).alias("_page"), F.col("n_citations").alias("n_shown"))
        rows = rows.drop("n_shown").join(shuffled(shown), F.col(key) == F.col("_page"), "left")
    rules = {
        "variables": F.size("lacking") == 0,
        "citations": F.col("n_citations") >= F.coalesce("n_shown", F.lit(0)),
        "download": (F.size("hrefs") == 0) | F.arrays_overlap("urls", "hrefs"),
    }
    found = F.array(
        *[F.struct(F.lit(n).alias("rule"), rule.alias("ok")) for n, rule in rules.items()]
    )
    return rows.select(key, F.inline(found))

"""Sitemaps, catalogues and references between documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from metaloom.functions.bind import once, shuffled
from metaloom.functions.text import sitemap_time
from metaloom.functions.variants import any_text, array_at, as_array, child, kind
from metaloom.session import cut_lineage


def document_id(doc: Column) -> Column:
    return any_text(child(doc, "$.@id"))


def _reference(node: Column, *keys: str) -> Column:
    """The address in a reference: a string itself, or the first of the keys of an object."""
    inside = F.coalesce(*[any_text(child(node, f"$.{k}")) for k in keys])
    return F.when(kind(node) == "STRING", any_text(node)).otherwise(inside)


def part_urls(docs: DataFrame, *keep: str) -> DataFrame:
    """The `url` of every element of `hasPart` that has one, in order."""
    parts = docs.select(
        *keep, F.posexplode(array_at(F.col("v"), "$.hasPart")).alias("pos", "_part")
    )
    return parts.select(*keep, "pos", any_text(child(F.col("_part"), "$.url")).alias("url")).filter(
        F.col("url").isNotNull()
    )


RELATIONS = ("hasPart", "dataset", "isPartOf")


def catalogue_edges(docs: DataFrame, relations: tuple[str, ...] = RELATIONS) -> DataFrame:
    """Edges parent, relation, child from `hasPart`, `dataset` and `isPartOf` of documents `v`.

    A document is known by its id, or by its URL where it has none. One explode over one array of links.
    """
    v = F.col("v")
    own = F.coalesce(document_id(v), any_text(child(v, "$.url")))

    def links(field: str, turned: bool, *keys: str) -> Column:
        def edge(node: Column) -> Column:
            other = _reference(node, *keys)
            return F.struct(
                (other if turned else F.col("_own")).alias("parent_id"),
                F.lit(field).alias("relation"),
                (F.col("_own") if turned else other).alias("child_id"),
            )

        return F.transform(as_array(v, f"$.{field}"), edge)

    # A part is known by its address, a dataset and a parent by their id.
    makers = {
        "hasPart": lambda: links("hasPart", False, "url", "@id"),
        "dataset": lambda: links("dataset", False, "@id", "url"),
        "isPartOf": lambda: links("isPartOf", True, "@id", "url"),
    }
    return (
        once(docs, _own=own)
        .select(F.inline(F.concat(*[makers[r]() for r in relations])))
        .filter(F.col("parent_id").isNotNull() & F.col("child_id").isNotNull())
    )


def page_references(docs: DataFrame) -> DataFrame:
    """Ids that `mainEntity` and `about` of a document point to: parent_id, relation, child_id."""
    v = F.col("v")

    def links(field: str) -> Column:
        return F.transform(
            as_array(v, f"$.{field}"),
            lambda node: F.struct(
                F.col("_own").alias("parent_id"),
                F.lit(field).alias("relation"),
                F.when(kind(node) == "OBJECT", any_text(child(node, "$.@id"))).alias("child_id"),
            ),
        )

    return (
        docs.withColumn("_own", document_id(v))
        .select(F.inline(F.concat(links("mainEntity"), links("about"))))
        .filter(F.col("child_id").isNotNull())
    )


def dangling(edges: DataFrame, known: DataFrame, known_id: str = "id") -> DataFrame:
    """References to ids that no document has.

    Nothing stands between the exchanges and the join, so a much-cited id is split by the skew join; an anti join
    needs no distinct ids.
    """
    ids = known.select(F.col(known_id).alias("_known")).filter(F.col("_known").isNotNull())
    return edges.join(shuffled(ids), F.col("child_id") == F.col("_known"), "left_anti")


def with_target(edges: DataFrame, documents: DataFrame, doc_id: str, *fields: str) -> DataFrame:
    """References next to fields of the document they point to; NULL for a dangling one.

    A repeated id shows the fields of one document, the smallest of them. The targets are written first: a join on plain
    exchanges can be split.
    """
    least = documents.groupBy(F.col(doc_id).alias("_target")).agg(F.min(F.struct(*fields)).alias("_fields"))
    targets = cut_lineage(least.select("_target", *[F.col("_fields")[f].alias(f) for f in fields]))
    return edges.join(shuffled(targets), F.col("child_id") == F.col("_target"), "left").drop("_target")


def parent_links(docs: DataFrame) -> DataFrame:
    """`isPartOf` of each document (string or object) and whether the parent is in the collection."""
    v = F.col("v")
    # Written first: a distinct between exchange and join would keep a much-cited parent in one task.
    ids = cut_lineage(docs.select(document_id(v).alias("_parent")).filter(F.col("_parent").isNotNull()).distinct())
    children = docs.select(
        document_id(v).alias("child_id"), F.explode(as_array(v, "$.isPartOf")).alias("_node")
    ).select("child_id", _reference(F.col("_node"), "@id", "url").alias("parent_id"))
    return children.join(shuffled(ids), F.col("parent_id") == F.col("_parent"), "left").select(
        "child_id", "parent_id", F.col("_parent").isNotNull().alias("present")
    )


def reconcile(listed: DataFrame, present: DataFrame) -> DataFrame:
    """Each URL's state: both, missing (listed, not present), unlisted or nested_sitemap.

    Both sides have a column `loc`; repeats are dropped before the join.
    """
    left = listed.select("loc").distinct().withColumn("_listed", F.lit(True))
    right = present.select("loc").distinct().withColumn("_present", F.lit(True))
    state = (
        F.when(F.col("_present").isNull() & F.lower("loc").rlike(r"\.xml$"), F.lit("nested_sitemap"))
        .when(F.col("_present").isNull(), F.lit("missing"))
        .when(F.col("_listed").isNull(), F.lit("unlisted"))
        .otherwise(F.lit("both"))
    )
    return left.join(right, "loc", "full_outer").select("loc", state.alias("state"))


def changed_since(entries: DataFrame, last_run: str, lastmod: str = "lastmod") -> DataFrame:
    """Entries changed after the last run; an entry without a readable date counts as changed."""
    time = sitemap_time(F.col(lastmod))
    return entries.filter(F.coalesce(time > sitemap_time(F.lit(last_run)), F.lit(True)))


def union_sitemaps(*sitemaps: DataFrame) -> DataFrame:
    """All entries of several sitemaps, each once with its newest time."""
    first, *rest = [s.select("loc", "lastmod") for s in sitemaps]
    for other in rest:
        first = first.unionByName(other)
    # The newest by time: texts in different zones do not sort by time. Without a readable time the text decides.
    place = F.struct(sitemap_time(F.col("lastmod")).alias("time"), F.col("lastmod").alias("text"))
    return first.groupBy("loc").agg(F.max_by("lastmod", place).alias("lastmod"))

"""Identity of documents: content hashes, copies and file-name integrity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from metaloom.functions.bind import shuffled
from metaloom.functions.variants import with_value


def with_sha(docs: DataFrame, raw: str = "raw") -> DataFrame:
    return docs.withColumn("sha", F.sha1(F.col(raw)))


def duplicates(docs: DataFrame, source: str = "site", raw: str = "raw") -> DataFrame:
    """Contents that occur more than once: sha, n copies, n sources.

    Counted per (content, source) first, so a content with very many copies meets as few rows.
    """
    per_source = with_sha(docs, raw).groupBy("sha", source).agg(F.count("*").alias("_n"))
    return (
        per_source.groupBy("sha")
        .agg(F.sum("_n").alias("n"), F.count("*").alias("n_sources"))
        .filter(F.col("n") > 1)
    )


def integrity(docs: DataFrame, path: str = "path", raw: str = "raw") -> DataFrame:
    """Documents whose file is named by a hash, and whether the hash is that of the content."""
    stem = F.regexp_extract(F.col(path), r"([0-9a-f]{40})\.[^./]+$", 1)
    return (
        with_sha(docs, raw)
        .withColumn("stem", stem)
        .filter(F.col("stem") != "")
        .withColumn("intact", F.col("stem") == F.col("sha"))
    )


def canonical_json(value: Column) -> Column:
    """One text for equal JSON values: keys in order, no blanks, one form for each number.

    A VARIANT keeps the keys of an object sorted; whole numbers lose a `.0`, outside of strings.
    """
    return F.regexp_replace(F.to_json(value), r'("(?:[^"\\]|\\.)*")|(-?[0-9]+)\.0(?![0-9Ee])', "$1$2")


def with_structure(docs: DataFrame, raw: str = "raw") -> DataFrame:
    """Add `structure`, the digest of what a document says however it is printed; null for no JSON."""
    read = with_value(docs, raw)
    return read.withColumn("structure", F.sha1(canonical_json(F.col("v")))).drop(*(["v"] if "v" not in docs.columns else []))


def reprinted(docs: DataFrame, source: str = "site", raw: str = "raw") -> DataFrame:
    """Documents that say the same in more than one text: structure, n copies, n_texts, n_sources.

    Counted per (structure, text, source) first, so a document with very many copies meets as few rows.
    """
    each = with_sha(with_structure(docs, raw), raw).filter(F.col("structure").isNotNull())
    each = each.groupBy("structure", "sha", source).agg(F.count("*").alias("_n"))
    found = each.groupBy("structure").agg(
        F.sum("_n").alias("n"), F.count_distinct("sha").alias("n_texts"), F.count_distinct(source).alias("n_sources")
    )
    return found.filter("n_texts > 1")


def integrity_kinds(docs: DataFrame, known: DataFrame, path: str = "path", raw: str = "raw") -> DataFrame:
    """`docs` named by a hash with `state`: intact, reformatted, changed or unknown.

    `known` has `stem` and `structure` of the contents that once stood under these names (`with_structure` of an intact release).
    A text that no longer has its hash, but says what the known one said, was only printed anew.
    """
    named = integrity(with_structure(docs, raw), path, raw)
    first = known.select(F.col("stem").alias("_stem"), F.col("structure").alias("_known")).distinct()
    both = named.join(shuffled(first), F.col("stem") == F.col("_stem"), "left")
    state = (
        F.when(F.col("intact"), F.lit("intact"))
        .when(F.col("_stem").isNull(), F.lit("unknown"))
        .when(F.col("structure").eqNullSafe(F.col("_known")), F.lit("reformatted"))
        .otherwise(F.lit("changed"))
    )
    return both.withColumn("state", state).drop("_stem", "_known")

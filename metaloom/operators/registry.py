"""Which registered sites still need metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from metaloom.functions.geo import box_from_columns
from metaloom.functions.text import file_name, folder_name
from metaloom.functions.variants import strip
from metaloom.operators.ordering import first_rows, with_sequence

# Flags of a site without metadata.
MISSING_FLAGS = ["FALSE", "#ERROR!", ""]


def needs_metadata(flag: Column, url: Column) -> Column:
    """The flag is compared as given, only upper-cased; the URL must hold more than blanks."""
    return F.upper(F.coalesce(flag, F.lit(""))).isin(MISSING_FLAGS) & (
        strip(F.coalesce(url, F.lit(""))) != ""
    )


def todo(registry: DataFrame) -> DataFrame:
    return registry.filter(needs_metadata(F.col("has_jsonld"), F.col("webpage_url")))


def numbered(rows: DataFrame, order: str = "row_id") -> DataFrame:
    """Place of each row in the work list and the length of the list."""
    return with_sequence(rows, order, "seq", "total")


def next_sites(rows: DataFrame, first_only: bool = False, limit: int | None = None) -> DataFrame:
    """The first site, or the first `limit` sites; asking for the first one wins."""
    if first_only:
        return first_rows(rows, "row_id", 1)
    return first_rows(rows, "row_id", limit) if limit else rows


def with_folder(rows: DataFrame) -> DataFrame:
    return rows.withColumn("folder", folder_name(F.col("name")))


def with_output_names(rows: DataFrame) -> DataFrame:
    return with_folder(rows).withColumn(
        "filename", file_name(F.col("name"), strip(F.coalesce("webpage_url", F.lit(""))))
    )


def skip_existing(rows: DataFrame, existing: DataFrame) -> DataFrame:
    """Sites without any document in their folder; `existing` has one column `site`."""
    done = existing.select(F.col("site").alias("folder")).distinct()
    return with_folder(rows).join(done, "folder", "left_anti")


def with_box(rows: DataFrame) -> DataFrame:
    return rows.withColumn(
        "box", box_from_columns(*[F.col(f"box_{c}") for c in ("lon_min", "lat_min", "lon_max", "lat_max")])
    )


def counts(registry: DataFrame, existing: DataFrame) -> DataFrame:
    """Sites in all, sites that need metadata, and those left after skipping finished ones.

    One pass over the registry: finished folders are marked by a left join instead of read twice.
    """
    done = existing.select(F.col("site").alias("folder"), F.lit(True).alias("_done")).distinct()
    marked = with_folder(registry).join(done, "folder", "left")
    needed = needs_metadata(F.col("has_jsonld"), F.col("webpage_url"))
    return marked.agg(
        F.count("*").alias("n_all"),
        F.count_if(needed).alias("n_todo"),
        F.count_if(needed & F.col("_done").isNull()).alias("n_left"),
    )

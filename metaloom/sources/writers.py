"""Sinks: document files, sitemaps, quad releases and reports."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from urllib.parse import urlparse

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from metaloom.functions import terms
from metaloom.functions.text import file_name, folder_name
from metaloom.functions.urls import address_below
from metaloom.shipping import ship_by_value

ship_by_value(__name__)

# Fixed value: the namespace of the sitemap protocol.
SITEMAP_NAMESPACE = "http://www.sitemaps.org/schemas/sitemap/0.9"
# Spark's names of stores that pyarrow knows by another.
STORES = {"s3a": "s3", "s3n": "s3", "abfss": "abfs"}


def name_outputs(docs: DataFrame, site: str, name: str, url: str) -> DataFrame:
    """Add `folder` and `filename` from the site name, the document name and its URL."""
    return docs.withColumn("folder", folder_name(F.col(site))).withColumn(
        "filename", file_name(F.col(name), F.col(url))
    )


def latest_outputs(docs: DataFrame, order: str) -> DataFrame:
    """One document per (folder, filename): the last one in `order`, as a later save overwrites.

    A partial aggregate keeps one row per name and task, so copies of one name meet as single rows. Documents of
    one place in the order are told apart by their content, so the choice is the same on every run.
    """
    kept = [c for c in docs.columns if c not in ("folder", "filename", order)]
    return (
        docs.groupBy("folder", "filename")
        .agg(F.max(F.struct(order, *kept)).alias("_row"))
        .select("folder", "filename", "_row.*")
    )


def name_collisions(docs: DataFrame) -> DataFrame:
    """Output names that several documents share, with their number: what `latest_outputs` would drop."""
    return docs.groupBy("folder", "filename").agg(F.count("*").alias("n")).filter("n > 1")


def by_folder(rows: DataFrame, *columns: str) -> DataFrame:
    """Bring the rows of an output folder together, so that a folder gets few files.

    Adaptive execution cuts a folder that holds very many rows and joins small ones.
    """
    return rows.hint("rebalance", *columns)


def write_output_table(docs: DataFrame, folder: str) -> None:
    by_folder(docs, "folder").write.mode("overwrite").partitionBy("folder").parquet(folder)


def store_address(root: str) -> str:
    """`root`, a path or a URI as Spark writes it, as a URI of the same folder in pyarrow's names."""
    scheme, mark, rest = root.partition("://")
    if root.startswith("file:"):
        return "file://" + urlparse(root).path
    if mark:
        return f"{STORES.get(scheme, scheme)}://{rest}"
    return root if ":" in root.split("/")[0] else os.path.abspath(root)


def publish_files(docs: DataFrame, root: str) -> DataFrame:
    """Write each document to `<root>/<folder>/<filename>` from the tasks; report what was written.

    `root` is a folder all executors see: a path, or the URI of a store by the name that Spark or pyarrow has for it; another
    scheme is an error before anything is written. Stores take the credentials of the executors' environment. A file is written under a name of its own and then moved, so a task that runs twice
    leaves one whole file. Documents that share a name would overwrite each other: `name_collisions` lists them.
    """
    store = store_address(root)
    fs.FileSystem.from_uri(store)

    def save(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, target = fs.FileSystem.from_uri(store)
        made = set()
        for batch in batches:
            sizes = []
            for folder, name, raw in zip(batch["folder"], batch["filename"], batch["raw"]):
                if folder not in made:
                    system.create_dir(f"{target}/{folder}", recursive=True)
                    made.add(folder)
                final = f"{target}/{folder}/{name}"
                part = f"{final}.part-{uuid.uuid4().hex}"
                data = raw.encode("utf-8")
                with system.open_output_stream(part) as out:
                    out.write(data)
                system.move(part, final)
                sizes.append(len(data))
            yield pd.DataFrame(
                {"folder": batch["folder"], "filename": batch["filename"], "n_bytes": sizes}
            )

    return docs.select("folder", "filename", "raw").mapInPandas(
        save, "folder string, filename string, n_bytes long"
    )


def sitemap_of_documents(documents: DataFrame, root: str, base: str) -> DataFrame:
    """loc and lastmod of every scanned document: the base address and the path below `root`."""
    return documents.select(
        address_below(F.col("path"), root, base).alias("loc"), _utc_text(F.col("modified")).alias("lastmod")
    )


def _utc_text(time: Column) -> Column:
    in_utc = F.to_utc_timestamp(time, F.current_timezone())
    return F.date_format(in_utc, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def write_sitemap(entries: DataFrame, folder: str) -> None:
    """Sitemap files with escaped text, one per partition, each a whole `urlset`.

    The protocol allows 50,000 entries per file, so the rows per file are bounded.
    """
    fields = [c for c in ("loc", "lastmod", "changefreq", "priority") if c in entries.columns]
    (
        entries.select(*fields)
        .write.mode("overwrite")
        .format("xml")
        .option("rootTag", f'urlset xmlns="{SITEMAP_NAMESPACE}"')
        .option("rowTag", "url")
        .option("declaration", 'version="1.0" encoding="UTF-8"')
        .option("maxRecordsPerFile", 50000)
        .save(folder)
    )


def write_sitemap_index(spark: SparkSession, folder: str, base: str, target: str) -> None:
    """An index over the sitemap files of `folder`, which are served below `base`.

    One entry per 50,000 addresses, so the index is one small file.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xml").load(folder)
    (
        files.select(
            address_below(F.col("path"), folder, base).alias("loc"), _utc_text(F.col("modificationTime")).alias("lastmod")
        )
        .coalesce(1)
        .write.mode("overwrite")
        .format("xml")
        .option("rootTag", f'sitemapindex xmlns="{SITEMAP_NAMESPACE}"')
        .option("rowTag", "sitemap")
        .option("declaration", 'version="1.0" encoding="UTF-8"')
        .option("maxRecordsPerFile", 50000)
        .save(target)
    )


def quad_line(s: str = "s", p: str = "p", o: str = "o", g: str = "g") -> Column:
    """One N-Quads line from columns; `o` is a term as written."""

    def node(name: str) -> Column:
        c = F.col(name)
        return F.when(F.startswith(c, F.lit("_:")), c).otherwise(
            F.concat(F.lit("<"), c, F.lit(">"))
        )

    return F.concat_ws(
        " ", node(s), node(p), F.col(o), F.when(F.coalesce(F.col(g), F.lit("")) != "", node(g)), F.lit(".")
    )


def write_release(quads: DataFrame, folder: str) -> None:
    """A release per source: the source is taken from the graph id."""
    (
        by_folder(
            quads.select(
                F.coalesce(terms.graph_source(F.col("g")), F.lit("unknown")).alias("source"),
                quad_line().alias("line"),
            ),
            "source",
        )
        .write.mode("overwrite")
        .partitionBy("source")
        .text(folder)
    )


def write_report(rows: DataFrame, folder: str, *partition_by: str) -> None:
    by_folder(rows, *partition_by).write.mode("overwrite").partitionBy(*partition_by).json(folder)

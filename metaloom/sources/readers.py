"""Scans: registry CSV, documents, sitemaps, quads, pages and plain text."""

from __future__ import annotations

import csv
import os
import re
from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from metaloom.functions import terms
from metaloom.functions.bind import once, shuffled
from metaloom.functions.text import sitemap_time
from metaloom.functions.urls import address_below
from metaloom.functions.variants import strict_json
from metaloom.operators.crawl import crawl
from metaloom.shipping import ship_by_value
from metaloom.sources.writers import store_address

ship_by_value(__name__)

# Header names of a registry file and the column names used here.
REGISTRY_COLUMNS = {
    "hasJSONLD?": "has_jsonld",
    "Dataset Webpage URL": "webpage_url",
    "Dataset Name": "name",
    "Description": "description",
    "Group": "grp",
    "Creator": "creator",
    "Provider": "provider",
    "Publisher": "publisher",
    "Keywords": "keywords",
    "box_lon_min": "box_lon_min",
    "box_lat_min": "box_lat_min",
    "box_lon_max": "box_lon_max",
    "box_lat_max": "box_lat_max",
}


def _files_by_header(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """The files of a registry by their first line; the names of the files are all that reaches the driver."""
    lines = spark.read.text(path).filter("_metadata.file_block_start = 0")
    placed = lines.select(file_path().alias("file"), "value", F.monotonically_increasing_id().alias("at"))
    heads = placed.groupBy("file").agg(F.min_by("value", "at").alias("head"))
    groups: dict[str, list[str]] = {}
    for file, head in heads.orderBy("file").collect():
        groups.setdefault(head, []).append(file)
    return groups


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text, empty where the file has no value; columns may stand in any order.

    Files of a folder may differ in their headers: those of one header are read together, by its names, and columns
    that are absent come back empty. `row_id` grows by file name, then by place in the file. A header is one line.
    """
    groups = _files_by_header(spark, path)
    if not groups:
        names = [f"{name} string" for name in REGISTRY_COLUMNS.values()]
        return spark.createDataFrame([], ", ".join([*names, "row_id long"]))
    rows = reduce(DataFrame.unionByName, [_read_registry_files(spark, *group) for group in groups.items()])
    names = sorted(f for files in groups.values() for f in files)
    places = spark.createDataFrame(list(enumerate(names, 1)), "_place long, _file string")
    # Rows of one file share a key, so a side too large to broadcast still leaves them to be split.
    placed = rows.join(places, "_file")
    return placed.withColumn("row_id", F.shiftleft("_place", 33) + F.col("_in_task")).drop("_file", "_place", "_in_task")


def _read_registry_files(spark: SparkSession, head: str, files: list[str]) -> DataFrame:
    """Files with one header. A file of a multi-line format is read by one task, so its rows are numbered in order.

    The header names the columns, the first of a repeated name counts; no job looks at the files for that.
    """
    reader = spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"')
    given_names = next(csv.reader([head]), [])
    if given_names:
        plain = [n.lower() for n in given_names]
        unique = [n if n and n.lower() not in plain[:i] else f"_c{i}" for i, n in enumerate(given_names)]
        reader = reader.schema(T.StructType([T.StructField(n, T.StringType()) for n in unique]))
    raw = reader.csv([re.sub(r"([\[\]{}*?\\])", r"\\\1", f) for f in files])
    columns = [
        F.coalesce(F.col(f"`{given}`"), F.lit("")).alias(name)
        if given in raw.columns
        else F.lit("").alias(name)
        for given, name in REGISTRY_COLUMNS.items()
    ]
    in_task = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return raw.select(*columns, file_path().alias("_file"), in_task.alias("_in_task"))


def file_path() -> Column:
    """Path of the file a row came from, with its URI escapes resolved."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def parent_folder(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -2)


def file_stem(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+?)(?:\.[^./]*)?$", 1)


# Documents that a task reads before it hands them on, and their bytes.
DOCUMENTS_AT_ONCE = 500
DOCUMENT_BYTES_AT_ONCE = 8 << 20
_LISTED = pa.schema([("path", pa.string()), ("is_folder", pa.bool_()), ("size", pa.int64()), ("modified", pa.int64())])
_LISTED_DDL = "path string, is_folder boolean, size long, modified long"


def _is_hidden(path: str) -> bool:
    """As Spark's scans: names with a dot in front, or an underscore that begins no partition, and half copies are passed over."""
    return path.endswith("._COPYING_") or any(name[:1] == "." or (name[:1] == "_" and "=" not in name) for name in path.split("/"))


def _opened_folder(spark: SparkSession, folder: str) -> tuple[Callable[[], tuple[fs.FileSystem, str]], str, str] | None:
    """How tasks open a folder, its path there and as Spark shows it; None for what is no folder here."""
    if re.search(r"[*?{}\[\]\\]", folder):
        return None
    plain = "://" not in folder and not folder.startswith("file:")
    if plain and not spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:").startswith("file:"):
        return None
    local = plain or folder.startswith("file:")
    top = os.path.abspath(re.sub("^file:/*", "/", folder)) if local else ""

    def opened() -> tuple[fs.FileSystem, str]:
        return (fs.LocalFileSystem(), top) if local else fs.FileSystem.from_uri(store_address(folder))

    try:
        system, root = opened()
        if system.get_file_info(root).type != fs.FileType.Directory:
            return None
    except (OSError, ValueError, pa.ArrowException):
        return None
    root = root.rstrip("/")
    return opened, root, f"file:{root}" if local else folder.rstrip("/")


def files_of_folder(spark: SparkSession, folder: str, pattern: str) -> DataFrame | None:
    """path (below the folder), size and modified of its files, listed by tasks; None for what is no folder here.

    Folders may hold millions of small files: Spark's scan lists them all on the driver. Here one task lists the top, then each
    of its folders is listed by one task, so no file costs the driver anything. The folder is listed when the rows are asked for.
    """
    if re.search(r"[{}\[\]\\]", pattern) or (found := _opened_folder(spark, folder)) is None:
        return None
    opened, root, _ = found
    names = "".join({"*": ".*", "?": "."}.get(c, re.escape(c)) for c in pattern)

    def listed(system: fs.FileSystem, at: str, recursive: bool) -> Iterator[pa.RecordBatch]:
        found = system.get_file_info(fs.FileSelector(at, recursive=recursive))
        kept = [i for i in found if not _is_hidden(i.path[len(root) + 1 :])]
        for start in range(0, len(kept), 10000):
            part = kept[start : start + 10000]
            rows = [[i.path[len(root) + 1 :] for i in part], [i.type == fs.FileType.Directory for i in part], [i.size or 0 for i in part], [(i.mtime_ns or 0) // 1000000 for i in part]]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, _LISTED.types)], _LISTED.names)

    def list_top(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _ in range(batch.num_rows):
                yield from listed(opened()[0], root or "/", False)

    def list_below(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = opened()
        for batch in batches:
            yield batch
            for path in batch.filter(batch.column("is_folder")).column("path").to_pylist():
                yield from listed(system, f"{root}/{path}", True)

    name = F.element_at(F.split("path", "/"), -1)
    tops = spark.range(1, numPartitions=1).mapInArrow(list_top, _LISTED_DDL).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    files = tops.mapInArrow(list_below, _LISTED_DDL).filter(~F.col("is_folder") & name.rlike(f"(?s)\\A{names}\\z"))
    return files.select("path", "size", "modified")


def read_files(files: DataFrame, folder: str, must_be_there: bool = True) -> DataFrame:
    """path, value and modified of files by their path below a folder, dealt out to tasks and read there.

    An empty file gives no row, as in Spark's scans; nor does one that is gone, if it need not be there.
    """
    opened, root, shown = _opened_folder(files.sparkSession, folder)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = opened()
        done, held = ([], [], []), 0

        def handed_on() -> pa.RecordBatch:
            out = [pa.array(c, t) for c, t in zip(done, (pa.string(), pa.binary(), pa.int64()))]
            for column in done:
                column.clear()
            return pa.RecordBatch.from_arrays(out, ["path", "value", "modified"])

        for batch in batches:
            for path, modified in zip(batch.column("path").to_pylist(), batch.column("modified").to_pylist()):
                try:
                    with system.open_input_stream(f"{root}/{path}") as file:
                        text = file.read()
                except FileNotFoundError:
                    if must_be_there:
                        raise
                    continue
                if not text:
                    continue
                for column, given in zip(done, (f"{shown}/{path}", text, modified)):
                    column.append(given)
                held += len(text)
                if len(done[0]) == DOCUMENTS_AT_ONCE or held >= DOCUMENT_BYTES_AT_ONCE:
                    held = 0
                    yield handed_on()
        if done[0]:
            yield handed_on()

    dealt = files.select("path", "modified").repartition(int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = dealt.mapInArrow(read, "path string, value binary, modified long")
    return rows.select("path", F.col("value").cast("string").alias("value"), F.timestamp_millis("modified").alias("modified"))


def _documents_of_folder(spark: SparkSession, folder: str, pattern: str) -> DataFrame | None:
    """path, value and modified of the files below a folder, listed and read by tasks; None for what is no folder here.

    Spark's scan would make a task of every 32 files; here the names are dealt out to readers.
    """
    files = files_of_folder(spark, folder, pattern)
    return None if files is None else read_files(files.filter("size > 0"), folder)


def read_documents(spark: SparkSession, folder: str, pattern: str = "*.jsonld") -> DataFrame:
    """One row per file: path, site (its folder), raw text, parsed value and file time.

    `v` is NULL for a file that is no JSON; the row stays, so the failure can be reported.
    """
    files = _documents_of_folder(spark, folder, pattern)
    if files is None:
        scan = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).text(folder, wholetext=True)
        files = scan.select(file_path().alias("path"), "value", F.col("_metadata.file_modification_time").alias("modified"))
    return files.select(
        "path",
        parent_folder(F.col("path")).alias("site"),
        F.col("value").alias("raw"),
        strict_json(F.col("value")).alias("v"),
        "modified",
    )


def land_documents(documents: DataFrame, folder: str) -> None:
    """Small files once into columnar files by site: the bronze table that all checks read."""
    (
        documents.hint("rebalance", "site")
        .write.mode("overwrite")
        .partitionBy("site")
        .parquet(folder)
    )


_XML_FIELDS = ["loc", "lastmod", "changefreq", "priority"]


def _read_xml(spark: SparkSession, path: str, row_tag: str) -> DataFrame:
    schema = T.StructType(
        [T.StructField(f, T.StringType()) for f in _XML_FIELDS]
        + [T.StructField("_corrupt_record", T.StringType())]
    )
    return (
        spark.read.format("xml")
        .option("rowTag", row_tag)
        .option("ignoreNamespace", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.{xml,xml.gz}")
        .schema(schema)
        .load(path)
        .withColumn("source_file", file_path())
    )


def _field(name: str) -> Column:
    """A field, or, from a record that is no well-formed XML, the text between its tags."""
    rescued = F.regexp_extract(
        F.col("_corrupt_record"), f"(?s)<{name}>\\s*(.*?)\\s*</{name}>", 1
    )
    return F.coalesce(F.trim(F.col(name)), F.nullif(rescued, F.lit(""))).alias(name)


def read_sitemap(spark: SparkSession, path: str) -> DataFrame:
    """Sitemap entries: loc, lastmod (text and time), changefreq, priority, source file."""
    rows = _read_xml(spark, path, "url").select(*[_field(f) for f in _XML_FIELDS], "source_file")
    return rows.withColumn("lastmod_time", sitemap_time(F.col("lastmod")))


def read_sitemap_index(spark: SparkSession, path: str) -> DataFrame:
    """Child sitemaps of an index; `is_page` marks a child that is a web page about a file."""
    rows = _read_xml(spark, path, "sitemap").select(_field("loc"), _field("lastmod"), "source_file")
    return rows.withColumn("is_page", F.col("loc").rlike("/blob/"))


def expand_sitemap_index(index: DataFrame, entries: DataFrame, root: str, base: str) -> DataFrame:
    """Entries of the child sitemaps under an index.

    A child is known by its whole address: files below `root` have the addresses below `base`.
    """
    children = index.select(F.col("loc").alias("child_loc")).distinct()
    address = address_below(F.col("source_file"), root, base)
    return entries.withColumn("_address", address).join(children, F.col("_address") == F.col("child_loc")).drop("_address")


def index_levels(index: DataFrame, root: str, base: str, start: str) -> DataFrame:
    """`url`, `depth` of every sitemap below the index at the address `start`, however many indexes lie between.

    `index` has the entries of all index files below `root` (`read_sitemap_index`), whose addresses lie below `base`. Files that
    list themselves or each other are met once, at their least depth.
    """
    links = index.select(address_below(F.col("source_file"), root, base).alias("src"), F.col("loc").alias("dst"))
    seeds = index.sparkSession.createDataFrame([(start,)], "url string")
    return crawl(links.filter(F.col("dst").isNotNull()), seeds)


def expand_index_levels(index: DataFrame, entries: DataFrame, root: str, base: str, start: str) -> DataFrame:
    """Entries of all sitemaps below an index of indexes, each entry of a file once, with the `level` of its file."""
    levels = index_levels(index, root, base, start).select(F.col("url").alias("_url"), F.col("depth").alias("level"))
    address = address_below(F.col("source_file"), root, base)
    return entries.withColumn("_address", address).join(shuffled(levels), F.col("_address") == F.col("_url")).drop("_address", "_url")


def read_quads(spark: SparkSession, path: str) -> DataFrame:
    return parse_quads(spark.read.text(path).select(F.col("value").alias("line")))


def _quad_parts(line: Column) -> Column:
    """[s, p, g, o] of a line, cut by one pass of the grammar; one element for any other line."""
    marked = F.regexp_replace(line, terms.LINE, "$1\u0001$2\u0001$4\u0001$3")
    return F.split(marked, "\u0001", 4)


def parse_quads(lines: DataFrame, line: str = "line") -> DataFrame:
    """s, p, o (as written), value, kind, datatype, language and g of every quad line.

    Blank lines and comments are not quads; `unreadable_quads` lists what else was left out.
    """
    o = F.col("o")
    return (
        once(lines, _parts=_quad_parts(F.col(line)))
        .filter(F.size("_parts") == 4)
        .select(
            terms.iri(F.get("_parts", F.lit(0))).alias("s"),
            terms.iri(F.get("_parts", F.lit(1))).alias("p"),
            terms.iri(F.get("_parts", F.lit(2))).alias("g"),
            F.get("_parts", F.lit(3)).alias("o"),
        )
        .select(
            "s",
            "p",
            "o",
            terms.term_value(o).alias("value"),
            terms.term_kind(o).alias("kind"),
            terms.term_datatype(o).alias("datatype"),
            terms.term_language(o).alias("language"),
            "g",
        )
    )


def unreadable_quads(lines: DataFrame, line: str = "line") -> DataFrame:
    text = F.trim(F.col(line))
    return lines.filter((text != "") & ~F.startswith(text, F.lit("#")) & ~terms.is_quad(text))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def fetch_captured(urls: DataFrame, pages: DataFrame, url: str = "url") -> DataFrame:
    """The captured html of each URL; NULL for a page that was not captured."""
    captured = pages.select(F.col("url").alias("_page_url"), "html")
    return urls.join(captured, urls[url] == F.col("_page_url"), "left").drop("_page_url")


def read_text_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.col("value").alias("line"))


def read_template(spark: SparkSession, path: str) -> str:
    """A prompt template: one small file; a missing file is an error."""
    return spark.read.text(path, wholetext=True).head().value


def with_example(df: DataFrame, documents: DataFrame, path_suffix: str) -> DataFrame:
    """Add the text of one reference document as `example`, '' when there is none.

    A scalar subquery: one value is looked up, nothing is joined.
    """
    chosen = documents.filter(F.endswith(F.col("path"), F.lit(path_suffix))).agg(F.min("raw"))
    return df.withColumn("example", F.coalesce(chosen.scalar(), F.lit("")))


def existing_sites(documents: DataFrame) -> DataFrame:
    """Folders that already hold a document."""
    return documents.select("site").distinct()

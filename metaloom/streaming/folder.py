"""Incremental checks: new files in a folder, and sitemap entries changed since the last run."""

from __future__ import annotations

import hashlib
import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from metaloom.functions.bind import shuffled
from metaloom.operators.validation import check_documents
from metaloom.session import removed, written_and_measured
from metaloom.sources.readers import file_path, files_of_folder, parent_folder, read_files

# A batch holds thousands of small files: Spark would list them by a task for each file, and read them by a task for every 32.
_SMALL_FILES = {
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "32",
    "spark.sql.sources.parallelPartitionDiscovery.threshold": "8",
    "spark.sql.files.openCostInBytes": str(256 << 10),
}


# Names in a file of a list: what the driver knows of a stream are such files, not the documents.
NAMES_AT_ONCE = 1000
# Files of a list that one task writes.
LISTS_AT_ONCE = 100
_NAME = "path string, modified long"
# Marks a checkpoint that knows lists of names.
_MARK = "names"


class _Store:
    """A folder of any store that Spark knows."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        context = spark.sparkContext
        self.hadoop, self.folder = context._jvm.org.apache.hadoop.fs, folder.rstrip("/")
        self.gateway, self.conf = context._gateway, context._jsc.hadoopConfiguration()

    def path(self, name: str = ""):
        return self.hadoop.Path(f"{self.folder}/{name}" if name else self.folder)

    @property
    def files(self):
        return self.path().getFileSystem(self.conf)

    def holds(self, name: str) -> bool:
        return self.files.exists(self.path(name))

    def made(self) -> bool:
        try:
            return self.files.mkdirs(self.path())
        except Py4JJavaError:
            return False

    def touch(self, name: str) -> None:
        self.files.create(self.path(name)).close()

    def last(self) -> int:
        """The largest of the numbers that are names here; 0 if there are none."""
        names = [entry.getPath().getName() for entry in self.files.listStatus(self.path())]
        return max((int(name) for name in names if name.isdigit()), default=0)

    def take(self, source: str, name: str) -> bool:
        """Move a folder here under a name; false if another had that name first."""
        at = self.files.makeQualified(self.path(name))
        options = self.gateway.new_array(getattr(self.hadoop, "Options$Rename"), 0)
        try:
            self.hadoop.FileContext.getFileContext(at.toUri(), self.conf).rename(self.files.makeQualified(self.hadoop.Path(source)), at, options)
        except Py4JJavaError:
            if not self.holds(name):
                raise
            self.files.delete(self.hadoop.Path(source), True)
            return False
        return True


def list_names(spark: SparkSession, folder: str, pattern: str, names: str, at_once: int) -> None:
    """Add the files of `folder` that the list `names` does not hold yet, each once, `at_once` in a file of the list.

    Tasks list the folder and compare it with the list. What is new comes into the list as a whole, under the next number; if
    another run took that number first, its files are left out and the next is tried.
    """
    store = _Store(spark, names)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    while True:
        number = store.last() + 1
        known = spark.read.schema(_NAME).option("recursiveFileLookup", True).parquet(names).select("path")
        new = files_of_folder(spark, folder, pattern).select("path", "modified").join(shuffled(known), "path", "left_anti")
        new, seen = written_and_measured(new, n=F.count(F.lit(1)))
        if seen["n"]:
            source = f"{names.rpartition('/')[0]}/.new-{uuid.uuid4().hex}"
            dealt = new.repartition(min(parts, 1 + seen["n"] // (at_once * LISTS_AT_ONCE))).sortWithinPartitions("modified", "path")
            dealt.write.option("maxRecordsPerFile", at_once).parquet(source)
        removed(new)
        if not seen["n"] or store.take(source, f"{number:08d}"):
            return


def stream_documents(
    spark: SparkSession, folder: str, pattern: str = "*.jsonld", files_per_batch: int = 10000, names: str | None = None
) -> DataFrame:
    """New document files of a folder as a stream: path, site, raw.

    Spark's own source knows every file on the driver. This stream is one of lists of names, which tasks make and read: `names` is
    the folder of these lists, by default `_names` below `folder`, which scans pass over. It belongs to all streams of the folder
    and must stay as long as one of them goes on. Files are listed here, and again by `run_available`; a query with a trigger of its own
    sees later ones when another stream of the folder is made. A file that is gone when its turn comes has no row. A folder that tasks cannot list,
    or that takes no lists, is streamed by Spark's own source.

    The stream has a session of its own with the settings of `spark` and those for small files: a source asks its session as
    long as it runs.
    """
    own = spark.newSession()
    for name, value in {**spark.conf.getAll, **_SMALL_FILES}.items():
        if own.conf.isModifiable(name):
            own.conf.set(name, value)
    lists = f"{(names or folder.rstrip('/') + '/_names').rstrip('/')}/{hashlib.sha1(pattern.encode()).hexdigest()[:12]}"
    if files_of_folder(own, folder, pattern) is None or not _Store(own, lists).made():
        files = (
            own.readStream.format("text")
            .option("wholetext", True)
            .option("recursiveFileLookup", True)
            .option("pathGlobFilter", pattern)
            .option("maxFilesPerTrigger", files_per_batch)
            .load(folder)
        )
        path = file_path()
        return files.select(path.alias("path"), parent_folder(path).alias("site"), F.col("value").alias("raw"))
    at_once = min(files_per_batch, NAMES_AT_ONCE)
    listing = {"folder": folder, "pattern": pattern, "names": lists, "at_once": at_once}
    list_names(own, **listing)
    listed = (
        own.readStream.schema(_NAME)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", files_per_batch // at_once)
        .parquet(lists)
    )
    files = read_files(listed, folder, must_be_there=False)
    path = F.col("path").alias("path", metadata={"listing": json.dumps(listing)})
    return files.select(path, parent_folder(F.col("path")).alias("site"), F.col("value").alias("raw"))


def check_stream(documents: DataFrame) -> DataFrame:
    """The batch rule check on a stream: stateless, the same plan per micro-batch."""
    return check_documents(documents).select("path", "site", "ok", "errors", "warnings")


def run_available(checked: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Check the files that are there now, write the results once, and stop.

    The checkpoint folder remembers which files were done; the parquet sink commits each batch whole, so a
    restart repeats nothing. The rows of a site come together in each batch, so a batch writes about one file per site,
    however many tasks read it. A checkpoint that a stream of files began, not one of their names, is refused: it would
    repeat them all.
    """
    listing = checked.schema["path"].metadata.get("listing") if "path" in checked.columns else None
    if listing:
        marks = _Store(checked.sparkSession, checkpoint)
        if marks.holds("offsets") and not marks.holds(_MARK):
            raise ValueError(f"{checkpoint} was begun by a stream of files: begin another, with a target of its own")
        marks.touch(_MARK)
        list_names(checked.sparkSession, **json.loads(listing))
        checked = checked.withMetadata("path", {})
    return (
        checked.repartition("site").writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .partitionBy("site")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )

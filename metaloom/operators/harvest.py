"""Harvest state: what each address looked like at the last run, kept as versions of a table.

A run compares a listing (a sitemap, or the entries of new files) with the last version and writes the next one. A version
counts once its row stands in the commit table, so a run that was killed leaves nothing behind, and a run that is
repeated under its name gives the stored result again instead of a second one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from metaloom.functions.bind import shuffled
from metaloom.functions.text import sitemap_time

STATE = (
    "address string, time timestamp, digest string, status string, first_run string, changed_run string, "
    "seen_run string, n_changes long"
)
COMMITS = "version long, run string, path string"


def newest(listing: DataFrame) -> DataFrame:
    """One row an address: `address`, `time`, `digest` of its newest entry. `listing` has loc, lastmod and digest."""
    entry = F.struct(sitemap_time(F.col("lastmod")).alias("time"), "digest")
    return (
        listing.filter(F.col("loc").isNotNull())
        .groupBy(F.col("loc").alias("address"))
        .agg(F.max(entry).alias("_entry"))
        .select("address", "_entry.time", "_entry.digest")
    )


def advance(state: DataFrame, listing: DataFrame, run: str, complete: bool = True) -> DataFrame:
    """The state after `run`: every address ever seen with `status` new, changed, unchanged or gone.

    Where both digests are known they decide; else a later time, or one that cannot be read, is a change. An address
    that comes back after it was gone is new again. With `complete` false the listing holds only part of the addresses
    (new files, say), and those not in it keep their status.
    """
    found = newest(listing).select(
        F.col("address").alias("_address"), F.col("time").alias("_time"), F.col("digest").alias("_digest")
    )
    both = state.join(shuffled(found), F.col("address") == F.col("_address"), "full_outer")
    listed, known = F.col("_address").isNotNull(), F.col("address").isNotNull() & (F.col("status") != "gone")
    later = F.coalesce(F.col("_time") > F.col("time"), F.lit(True))
    told = F.col("digest").isNotNull() & F.col("_digest").isNotNull()
    changed = F.when(told, F.col("digest") != F.col("_digest")).otherwise(later)
    status = (
        F.when(~listed, F.lit("gone") if complete else F.col("status"))
        .when(~known, F.lit("new"))
        .when(changed, F.lit("changed"))
        .otherwise(F.lit("unchanged"))
    )
    now = F.lit(run)
    moved = F.col("status_").isin("new", "changed")
    return (
        both.withColumn("status_", status)
        .select(
            F.coalesce("_address", "address").alias("address"),
            F.when(listed, F.coalesce("_time", "time")).otherwise(F.col("time")).alias("time"),
            F.when(listed, F.coalesce("_digest", "digest")).otherwise(F.col("digest")).alias("digest"),
            F.col("status_").alias("status"),
            F.when(F.col("address").isNull(), now).otherwise(F.col("first_run")).alias("first_run"),
            F.when(listed & moved, now).otherwise(F.col("changed_run")).alias("changed_run"),
            F.when(listed, now).otherwise(F.col("seen_run")).alias("seen_run"),
            (F.coalesce("n_changes", F.lit(0)) + (listed & (F.col("status_") == "changed")).cast("long")).cast("long").alias("n_changes"),
        )
    )


class HarvestTable:
    """Versions of a harvest state below a folder; one writer at a time."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")
        spark.createDataFrame([], COMMITS).write.mode("ignore").parquet(f"{self.folder}/commits")

    def commits(self) -> DataFrame:
        return self.spark.read.schema(COMMITS).parquet(f"{self.folder}/commits")

    def _version(self, condition: str) -> tuple[int, str] | None:
        """Number and path of the last version under a condition: one row, found by an aggregate."""
        last = self.commits().filter(condition).agg(F.max(F.struct("version", "path")).alias("last")).first()["last"]
        return (last["version"], last["path"]) if last else None

    def state(self) -> DataFrame:
        last = self._version("true")
        if last is None:
            return self.spark.createDataFrame([], STATE)
        return self.spark.read.schema(STATE).parquet(f"{self.folder}/{last[1]}")

    def run(self, listing: DataFrame, run: str, complete: bool = True) -> DataFrame:
        """The state after `run`, written and committed; a run that is committed already is only read."""
        done = self._version(f"run = {_quoted(run)}")
        if done is None:
            last = self._version("true")
            path = f"state-{uuid.uuid4().hex}"
            advance(self.state(), listing, run, complete).write.parquet(f"{self.folder}/{path}")
            row = [((last[0] if last else 0) + 1, run, path)]
            self.spark.createDataFrame(row, COMMITS).coalesce(1).write.mode("append").parquet(f"{self.folder}/commits")
            done = row[0][0], path
        return self.spark.read.schema(STATE).parquet(f"{self.folder}/{done[1]}")


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def harvest_stream(entries: DataFrame, table: HarvestTable, checkpoint: str, name: str = "files") -> StreamingQuery:
    """Bring the state up to date with a stream of entries (loc, lastmod, digest), a batch at a time, and stop.

    The number of the batch is the run's name: a batch that is repeated after a crash finds its run committed.
    """

    def upsert(batch: DataFrame, number: int) -> None:
        table.run(batch, f"{name}-{number}", complete=False)

    return (
        entries.writeStream.foreachBatch(upsert)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

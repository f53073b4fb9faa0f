"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, Observation, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A repeated key in a JSON object keeps its last value, as most JSON readers do.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Rounds of a walk leave checkpoints behind; they go when nothing refers to them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Pages and documents are long strings: bound Arrow batches by rows too.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}

# Fixed value: Spark's setting to remove the shuffle files of a query when it ends.
_SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Tables that a step under way has written (`written_alone`).
_PASSING: ContextVar[list[tuple[SparkSession, str]] | None] = ContextVar("passing", default=None)


def build_session(app_name: str = "metaloom", **extra: str) -> SparkSession:
    """A session with the settings above; `extra` holds further `spark.*` settings."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder for checkpoints: the one the cluster names, else a local one in local mode.

    On a cluster the folder must be shared by all executors, so an unset folder is an error there.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="metaloom-checkpoint-")
    context.setCheckpointDir(named)
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write `df` to the checkpoint folder and go on from the written rows.

    The rows are on shared storage, so a lost executor costs no recomputation of earlier rounds.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def cut_and_measure(df: DataFrame, **metrics: Column) -> tuple[DataFrame, dict]:
    """`cut_lineage`, and aggregates over the written rows that are taken while they are written."""
    seen = Observation()
    named = [value.alias(name) for name, value in metrics.items()]
    written = cut_lineage(df.observe(seen, *named))
    return written, seen.get


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What a query shuffled goes when it ends; else it stays until the driver happens to collect its garbage."""
    before = spark.conf.get(_SHUFFLES_GO, None)
    spark.conf.set(_SHUFFLES_GO, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_SHUFFLES_GO)
        else:
            spark.conf.set(_SHUFFLES_GO, before)


def written(df: DataFrame) -> DataFrame:
    """Write `df` as Parquet below the checkpoint folder and go on from the files.

    As `cut_lineage`, for rounds that build on each other: a checkpoint keeps the constraints of the plan that made it, and they
    grow from round to round until planning takes longer than the work. Files carry none, later reads take only the
    columns they need, and the planner knows the true size. Rounds that no later one reads are `removed`.
    """
    folder = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/rows-{uuid.uuid4().hex}"
    with _shuffles_removed(df.sparkSession):
        df.write.parquet(folder)
    out = df.sparkSession.read.schema(df.schema).parquet(folder)
    out._written_to = folder
    if (passing := _PASSING.get()) is not None:
        passing.append((out.sparkSession, folder))
    return out


def written_and_measured(df: DataFrame, **metrics: Column) -> tuple[DataFrame, dict]:
    """`written`, and aggregates over the rows that are taken while they are written."""
    seen = Observation()
    out = written(df.observe(seen, *[value.alias(name) for name, value in metrics.items()]))
    return out, seen.get


def removed(*tables: DataFrame) -> None:
    """Remove tables as `written` returned them, once nothing reads them any more; one that is gone already is passed over."""
    for table in tables:
        _remove(table.sparkSession, table._written_to)


def _remove(spark: SparkSession, folder: str) -> None:
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def written_alone(make: Callable[[], DataFrame]) -> DataFrame:
    """`written(make())`; the tables that `make` wrote on the way go then."""
    passing: list[tuple[SparkSession, str]] = []
    outer = _PASSING.set(passing)
    try:
        made = make()
    finally:
        _PASSING.reset(outer)
    out = written(made)
    for given in passing:
        _remove(*given)
    return out

"""Tables written to the shared checkpoint folder, read back as plain Parquet scans."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from metaloom.session import ensure_checkpoint_dir


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder name below the checkpoint folder that all executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def land(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once to the shared folder and go on from the written rows.

    This cuts the lineage as a checkpoint does, but the files are compressed, later reads take only the columns
    they need, and the planner knows the true size. A lost executor costs no recomputation of what is written.
    """
    folder = shared_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def unused(name: str, columns: list[str]) -> str:
    """`name`, with underscores before it until no column has it, whatever the case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name

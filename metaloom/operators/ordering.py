"""Global sequence numbers and first-n without a single-task sort."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from metaloom.session import cut_lineage

#: `monotonically_increasing_id` holds the place of a row inside its partition in so many low bits.
PLACE_BITS = 33


def with_sequence(
    df: DataFrame,
    order: str,
    name: str = "seq",
    total: str | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Number all rows from 1 in the order of a unique column, and add the row count.

    Rows are dealt by ranges of the column, which a sample of it makes even, sorted inside their partition (spilling
    if need be) and written once with partition and place. A row's number is its place plus the rows of all earlier
    partitions. Only one count per partition meets in one task. `buckets` is the number of ranges, by default that of
    shuffle partitions.
    """
    ranged = df.repartitionByRange(*([buckets] if buckets else []), order).sortWithinPartitions(order)
    place = F.monotonically_increasing_id().bitwiseAND((1 << PLACE_BITS) - 1)
    placed = cut_lineage(ranged.withColumn("_bucket", F.spark_partition_id()).withColumn("_place", place))
    counts = placed.groupBy("_bucket").agg(F.count("*").alias("_n"))
    # One row per partition: a window over all of them is bounded by their number.
    below = counts.select(
        "_bucket",
        (F.sum("_n").over(Window.orderBy("_bucket")) - F.col("_n")).alias("_below"),
        F.sum("_n").over(Window.partitionBy(F.lit(0))).alias("_total"),
    )
    out = placed.join(F.broadcast(below), "_bucket").withColumn(name, F.col("_place") + F.col("_below") + 1)
    if total:
        out = out.withColumn(total, F.col("_total"))
    return out.drop("_bucket", "_place", "_below", "_total")


def first_rows(df: DataFrame, order: str, n: int) -> DataFrame:
    """The first `n` rows: each task keeps its own first `n`, and those meet in one."""
    return df.orderBy(order).limit(n)

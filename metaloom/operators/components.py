"""Connected components by star steps: rounds grow with the logarithm of the number of nodes."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from metaloom.functions.bind import shuffled
from metaloom.session import removed, written, written_and_measured
from metaloom.shipping import ship_by_value

ship_by_value(__name__)


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of one partition as a forest: each node with the smallest that it reaches there."""
    above: dict = {}

    def top(x):
        while above.setdefault(x, x) != x:
            above[x] = above[above[x]]
            x = above[x]
        return x

    schema = None
    for batch in batches:
        schema = batch.schema
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = top(a), top(b)
            above[max(a, b)] = min(a, b)
    found = [(x, top(x)) for x in above]
    found = [pair for pair in found if pair[0] != pair[1]]
    if found:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), schema)], ["v", "c"])


def components(links: DataFrame) -> DataFrame:
    """`node`, `root` for every node of `links` (a, b): the smallest node that it is connected with.

    Links of one partition are first reduced to a forest. Each round links the larger neighbours of a node with its
    smallest, then the smaller ones; the smallest neighbours are written first, so plain exchanges stand below the joins
    and a node with very many links can be split. What a round wrote goes when the next step has read it.
    """

    def least(pairs: DataFrame) -> DataFrame:
        return written(pairs.groupBy("v").agg(F.min("c").alias("_c")).withColumn("m", F.least("v", "_c")).drop("_c"))

    kind = links.schema["a"].dataType.simpleString()

    def forest(pairs: DataFrame) -> DataFrame:
        return pairs.select("v", "c").mapInArrow(_forests, f"v {kind}, c {kind}")

    state = {"n": F.count(F.lit(1)), "sum": F.sum(F.xxhash64("v", "c").cast("decimal(38,0)"))}
    both = links.select(F.col("a").alias("v"), F.col("b").alias("c"))
    both = both.unionAll(both.select("c", "v"))
    selves = both.select("v").distinct()
    edges, seen = written_and_measured(forest(both.filter("c < v")), **state)
    last = None
    while seen != last:
        last = seen
        both = edges.unionAll(edges.select("c", "v"))
        smallest = least(both)
        large = both.filter("c > v").join(shuffled(smallest), "v").select(F.col("c").alias("v"), F.col("m").alias("c"))
        large = written(large.filter("v <> c").distinct())
        removed(edges, smallest)
        nearest = least(large)
        small = large.join(shuffled(nearest), "v").select(F.col("c").alias("v"), F.col("m").alias("c"))
        kept = nearest.select("v", F.col("m").alias("c"))
        edges, seen = written_and_measured(forest(small.unionAll(kept).filter("v <> c").distinct()), **state)
        removed(large, nearest)
    roots = edges.groupBy("v").agg(F.min("c").alias("root"))
    return selves.join(shuffled(roots), "v", "left").select(F.col("v").alias("node"), F.coalesce("root", "v").alias("root"))

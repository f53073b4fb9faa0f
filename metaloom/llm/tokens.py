"""Token counts from flat token files: separators found by vectorised search, texts stitched across blocks.

A flat file holds token ids of `width` bytes (2 or 4) and nothing else; an end-of-document id follows every text. Tasks read blocks
of a file, whatever text they begin or end in, and search the separator in the whole block at once. Each block then
needs two numbers from the blocks before it: how many separators they hold and where the last of them is. They come
from a prefix scan in two levels, inside groups of blocks and over the groups, so no task sees all blocks of a file.

Defined results: a file without tokens has no texts; tokens after the last separator are a text of their own, nothing
after it is none; two separators in a row hold an empty text. Trailing bytes short of an id are left out. Null and empty texts
are written as a separator alone. An id that `width` bytes cannot hold is an error. A task that is run again writes a
file of its own name; texts are paired with the file of the attempt that was committed. Only the named columns are read.
"""

from __future__ import annotations

import posixpath
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from metaloom.llm.bytebpe import Codec
from metaloom.llm.landing import land, shared_folder
from metaloom.shipping import ship_by_value

WIDTH = 2
BLOCK_TOKENS = 1 << 20
GROUP_BLOCKS = 512
WRITE_TOKENS = 1 << 18


#: Spark's names of stores that pyarrow knows by another.
STORES = {"s3a": "s3", "s3n": "s3", "abfss": "abfs"}


def _file_system(folder: str):
    from pyarrow import fs

    scheme, mark, rest = folder.partition("://")
    return fs.FileSystem.from_uri(f"{STORES.get(scheme, scheme)}{mark}{rest}")


def _ids(width: int) -> np.dtype:
    if width not in (2, 4):
        raise ValueError("token ids have 2 or 4 bytes")
    return np.dtype(f"<u{width}")


def _written(folder: str, path: str, pattern: str, separator: int, width: int):
    kind = _ids(width)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _file_system(folder)
        task = TaskContext.get()
        name = f"tokens-{task.partitionId():08d}-{task.taskAttemptId()}.bin"
        part = posixpath.join(root, f"_{name}")
        codec = Codec(path, pattern)
        place, held, waiting = 0, [], 0
        ids: list[pa.RecordBatch] = []

        def packed(parts: list[np.ndarray]) -> bytes:
            every = np.concatenate(parts)
            if every.max(initial=0) > np.iinfo(kind).max:
                raise ValueError(f"token id {every.max()} needs more than {width} bytes")
            return every.astype(kind).tobytes()

        with system.open_output_stream(part) as out:
            for batch in batches:
                for cell in batch.column("text"):
                    held.append(np.array([*codec.encode(cell.as_py() or ""), separator], np.int64))
                    waiting += len(held[-1])
                    if waiting >= WRITE_TOKENS:
                        out.write(packed(held))
                        held, waiting = [], 0
                n = batch.num_rows
                ids.append(
                    pa.RecordBatch.from_arrays(
                        [pa.array([name] * n, pa.string()), pa.array(np.arange(place, place + n)), batch.column("id")],
                        ["file", "place", "doc_id"],
                    )
                )
                place += n
            if held:
                out.write(packed(held))
        # Only whole files have a name that is read.
        system.move(part, posixpath.join(root, name))
        yield from ids

    return rows


def write_flat(docs: DataFrame, path: str, pattern: str, separator: int, width: int = WIDTH) -> tuple[str, DataFrame]:
    """Encode texts into flat files of a new shared folder, one per task. Also (file, place, doc_id) of the texts."""
    folder = shared_folder(docs.sparkSession, "flat")
    folder = folder if "://" in folder else folder.replace("file:", "file://", 1)
    system, root = _file_system(folder)
    system.create_dir(root, recursive=True)
    given = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    names = given.mapInArrow(_written(folder, path, pattern, separator, width), "file string, place long, doc_id long")
    return folder, land(names, "places")


def blocks_of(spark: SparkSession, folder: str, block_tokens: int = BLOCK_TOKENS, width: int = WIDTH) -> DataFrame:
    """(file, block, at, size) of all blocks, from the sizes of the files alone; positions in tokens."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.bin").load(folder).select("path", "length")
    tokens = F.floor(F.col("length") / width)
    last = F.ceil(tokens / block_tokens) - 1
    blocks = files.filter(tokens > 0).select(
        F.regexp_extract("path", "[^/]+$", 0).alias("file"), tokens.alias("tokens"), F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("block")
    )
    at = F.col("block") * block_tokens
    return blocks.select("file", "block", at.alias("at"), F.least(F.lit(block_tokens).cast("long"), F.col("tokens") - at).alias("size"))


def _searched(folder: str, separator: int, width: int):
    kind = _ids(width)

    """Per block: positions of all separators in the file."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _file_system(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with system.open_input_file(posixpath.join(root, row["file"])) as source:
                    raw = source.read_at(row["size"] * width, row["at"] * width)
                hits = np.flatnonzero(np.frombuffer(raw, kind) == separator) + row["at"]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["file"]]),
                        pa.array([row["block"]], pa.int64()),
                        pa.array([row["at"] + row["size"]], pa.int64()),
                        pa.array([hits], pa.list_(pa.int64())),
                    ],
                    ["file", "block", "end", "hits"],
                )

    return rows


def document_lengths(spark: SparkSession, folder: str, separator: int, block_tokens: int = BLOCK_TOKENS, width: int = WIDTH) -> DataFrame:
    """(file, place, n_tokens) of every text in the flat files of `folder`; separators are not counted."""
    blocks = blocks_of(spark, folder, block_tokens, width).repartition("file", "block")
    found = blocks.mapInArrow(_searched(folder, separator, width), "file string, block long, end long, hits array<long>")
    found = land(found.withColumn("team", F.floor(F.col("block") / GROUP_BLOCKS)), "separators")
    brief = found.select("file", "team", "block", "end", F.size("hits").cast("long").alias("n"), F.array_max("hits").alias("last"))
    teams = brief.groupBy("file", "team").agg(F.sum("n").alias("n"), F.max("last").alias("last"), F.max("end").alias("end"))
    over = Window.partitionBy("file").orderBy("team")
    past = over.rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(-1).cast("long")
    teams = teams.select(
        "file",
        "team",
        F.coalesce(F.sum("n").over(past), F.lit(0)).alias("team_n"),
        F.coalesce(F.max("last").over(past), none).alias("team_last"),
        F.lead("team").over(over).isNull().alias("final"),
    )
    inside = Window.partitionBy("file", "team").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    own = found.select(
        "file", "team", "block", "end", "hits",
        F.coalesce(F.sum(F.size("hits")).over(inside), F.lit(0)).alias("own_n"),
        F.coalesce(F.max(F.array_max("hits")).over(inside), none).alias("own_last"),
        F.lead("block").over(Window.partitionBy("file", "team").orderBy("block")).isNull().alias("edge"),
    )
    joined = own.join(teams, ["file", "team"]).select(
        "file",
        F.expr("team_n + own_n").alias("seen"),
        F.greatest("team_last", "own_last").alias("past"),
        # The file's last block ends the last text, unless a separator already has.
        F.when(F.expr("edge and final") & (F.coalesce(F.array_max("hits"), F.greatest("team_last", "own_last")) < F.col("end") - 1),
               F.array_append("hits", F.col("end"))).otherwise(F.col("hits")).alias("hits"),
    )
    each = joined.select("file", "seen", "past", "hits", F.posexplode("hits").alias("k", "hit"))
    before = F.when(F.col("k") == 0, F.col("past")).otherwise(F.get("hits", F.col("k") - 1))
    return each.select(
        "file", (F.col("seen") + F.col("k")).cast("long").alias("place"), (F.col("hit") - before - 1).alias("n_tokens")
    )


def count_tokens(docs: DataFrame, path: str, pattern: str, separator: int, width: int = WIDTH) -> DataFrame:
    """`doc_id` and `n_tokens` per document: texts are written as flat files, then counted from these alone."""
    folder, places = write_flat(docs, path, pattern, separator, width)
    counted = document_lengths(docs.sparkSession, folder, separator, width=width)
    return places.join(counted.hint("merge"), ["file", "place"], "left").select("doc_id", F.coalesce("n_tokens", F.lit(0)).alias("n_tokens"))


ship_by_value(__name__)

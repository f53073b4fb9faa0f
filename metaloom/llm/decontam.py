"""Benchmark decontamination: a broadcast hash set of test windows, scanned over the words of every text.

Windows of 13 words (or a whole shorter item) are hashed once. Tasks hash the windows of their texts, look them up in
the set, and compare the words of every hit, so equal hashes alone decide nothing. The set is broadcast in blocks of at
most `BLOCK_WINDOWS` window and item pairs: one pass over the texts per block; a usual benchmark is one block.

Defined results: null and empty texts have no words and no hits; items without words have no windows; an item that is
repeated counts once; items without an id are left out. A text of no words is not contaminated. Repeated rows give
repeated rows. `hits` reads only the named columns; `cleaned` keeps all columns, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from metaloom.functions.bind import let, once
from metaloom.llm.arrays import before, total
from metaloom.llm.landing import land, unused
from metaloom.llm.wordscan import Hasher, Texts, find_words, item_bytes, lower_bytes, slices, window_rows
from metaloom.shipping import ship_by_value

WINDOW = 13
BLOCK_WINDOWS = 200_000
#: A text is contaminated if hits make at least one in so many of its words.
WORDS_PER_HIT = 20
RANGES = "array<struct<start: bigint, end: bigint>>"
HITS = f"n_words long, ranges {RANGES}, items array<long>"


def _words_of(texts: Texts):
    data = lower_bytes()[texts.data]
    words = find_words(Texts(data, texts.offsets), item_bytes())
    return data, words


def _window_text(data: np.ndarray, words, at: int, length: int) -> bytes:
    return b" ".join(data[s:e].tobytes() for s, e in zip(words.starts[at : at + length], words.ends[at : at + length]))


def _item_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher = Hasher()
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        for low, _, texts in slices(batch.column(1)):
            data, words = _words_of(texts)
            hashes = hasher.runs(data, words.starts, words.ends)
            rows = []
            for i, n in enumerate(words.counts()):
                length = min(WINDOW, int(n))
                for at in range(words.first[i], words.first[i + 1] - length + 1) if length else ():
                    h = hasher.windows(hashes[at : at + length], length)[0]
                    rows.append((int(h.view(np.int64)), length, _window_text(data, words, at, length), int(ids[low + i])))
            if rows:
                h, n, t, i = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h, pa.int64()), pa.array(n, pa.int32()), pa.array(t, pa.binary()), pa.array(i, pa.int64())],
                    ["hash", "length", "words", "item_id"],
                )


def item_windows(benchmark: DataFrame) -> DataFrame:
    """Distinct (hash, length, words, item_id) of the benchmark, written once."""
    given = benchmark.select(F.col("item_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    rows = given.filter("id is not null").mapInArrow(_item_windows, "hash long, length int, words binary, item_id long")
    return land(rows.distinct(), "windows")


class _Block:
    """Some windows as a lookup: a bit per hash head, sorted hashes, and words with item ids for those that match."""

    def __init__(self, rows: list) -> None:
        self.exact: dict[tuple[int, bytes], list[int]] = {}
        by_length: dict[int, set[int]] = {}
        for h, length, words, item in rows:
            self.exact.setdefault((length, bytes(words)), []).append(item)
            by_length.setdefault(length, set()).add(h)
        self.sorted = {n: np.sort(np.array(list(hs), np.int64).view(np.uint64)) for n, hs in by_length.items()}

    def scan(self, texts: Texts, hasher: Hasher) -> tuple[np.ndarray, list, list]:
        """Number of words per text, and for texts with hits their word ranges and items, else None."""
        data, words = _words_of(texts)
        counts = words.counts()
        ranges: list = [None] * len(texts)
        items: list = [None] * len(texts)
        if not self.sorted or not len(words.starts):
            return counts, ranges, items
        hashes = hasher.runs(data, words.starts, words.ends)
        text_of = words.text_of()
        for length, known in self.sorted.items():
            windows = hasher.windows(hashes, length)
            heads = np.zeros(1 << 20, bool)
            heads[known >> np.uint64(44)] = True
            at = np.flatnonzero(heads[windows >> np.uint64(44)])
            place = np.minimum(np.searchsorted(known, windows[at]), len(known) - 1)
            at = at[(known[place] == windows[at]) & window_rows(words, length)[at]]
            for a in at:
                found = self.exact.get((length, _window_text(data, words, a, length)))
                if found:
                    i = text_of[a]
                    start = int(a - words.first[i])
                    if ranges[i] is None:
                        ranges[i], items[i] = [], set()
                    ranges[i].append((start, start + length))
                    items[i].update(found)
        return counts, ranges, items


def _merged(ranges: list[tuple[int, int]] | None) -> list[dict]:
    out: list[dict] = []
    for start, end in sorted(ranges or ()):
        if out and start <= out[-1]["end"]:
            out[-1]["end"] = max(end, out[-1]["end"])
        else:
            out.append({"start": start, "end": end})
    return out


def _scan(block, text_place: int, kept: list[int], only_hits: bool):
    """`kept` columns as they are, then the columns of `HITS`."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup, hasher = _Block(block.value), Hasher()
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            for low, high, texts in slices(batch.column(text_place)):
                counts, ranges, items = lookup.scan(texts, hasher)
                part = batch.slice(low, high - low)
                out = pa.RecordBatch.from_arrays(
                    [
                        *[part.column(k) for k in kept],
                        pa.array(counts, pa.int64()),
                        pa.array([_merged(r) for r in ranges], span),
                        pa.array([sorted(i) if i else [] for i in items], pa.list_(pa.int64())),
                    ],
                    [*[batch.schema.names[k] for k in kept], "n_words", "ranges", "items"],
                )
                yield out.filter(pa.array([bool(r) for r in ranges])) if only_hits else out

    return rows


def _blocks(windows: DataFrame) -> list:
    """Broadcasts of at most about `BLOCK_WINDOWS` window and item pairs each, and at least one."""
    spark = windows.sparkSession
    n = max(1, -(-windows.count() // BLOCK_WINDOWS))
    place = F.pmod(F.xxhash64("hash", "item_id", "words"), F.lit(n))
    for k in range(n):
        yield spark.sparkContext.broadcast([tuple(r) for r in windows.filter(place == k).collect()]), n


def with_hits(docs: DataFrame, benchmark: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """Columns `keep` of `docs`, then `n_words`, `ranges` of hit words and `items`; one row per row."""
    text_place, kept = docs.columns.index(text), [docs.columns.index(c) for c in keep]
    plain = docs.select(*keep).schema.fields
    full = T.StructType(plain + T.StructType.fromDDL(HITS).fields)
    blocks = list(_blocks(item_windows(benchmark)))
    if len(blocks) == 1:
        return docs.mapInArrow(_scan(blocks[0][0], text_place, kept, False), full)
    # Equal rows have equal hits, so the row's own hash is a key that needs no unique id.
    key = F.sha2(F.to_json(F.struct(*docs.columns), {"ignoreNullFields": "false"}), 256)
    name = unused("key", docs.columns)
    keyed = docs.withColumn(name, key)
    places = [len(docs.columns)]
    parts = [
        keyed.mapInArrow(_scan(b, text_place, places, True), f"{name} string, {HITS}").distinct() for b, _ in blocks
    ]
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    found = land(
        found.groupBy(name).agg(
            F.array_sort(F.flatten(F.collect_list("ranges"))).alias("ranges"),
            F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
        ),
        "hits",
    )
    empty = docs.sparkSession.sparkContext.broadcast([])
    none, no = unused("none", [*docs.columns, name]), unused("no", [*docs.columns, name])
    ended = f"{name} string, n_words long, {none} {RANGES}, {no} array<long>"
    schema = T.StructType(plain + T.StructType.fromDDL(ended).fields)
    counted = keyed.mapInArrow(_scan(empty, text_place, [*kept, places[0]], False), schema).drop(none, no)
    out = counted.join(found.hint("merge"), name, "left").drop(name)
    return out.withColumn("ranges", F.coalesce("ranges", F.array().cast(RANGES))).withColumn(
        "items", F.coalesce("items", F.array().cast("array<long>"))
    )


def _covered(ranges: Column) -> Column:
    """Words inside any of the ranges, which are in order of their begin and may overlap."""

    def count(rs: Column) -> Column:
        ends = let(before(F.transform(rs, lambda r: r["end"]), largest=True), lambda past: F.transform(
            rs, lambda r, i: F.greatest(F.lit(0).cast("long"), r["end"] - F.greatest(r["start"], F.get(past, i)))
        ))
        return total(ends)

    return let(ranges, count)


def contaminated(n_hit: Column, n_words: Column) -> Column:
    return (n_hit > 0) & (WORDS_PER_HIT * n_hit >= n_words)


def hits(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Counts of words and hit words, the items that occur (number and digest), and the verdict, per document."""
    given = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    found = once(with_hits(given, benchmark, ["doc_id"]), n_hit=_covered(F.col("ranges")))
    names = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(names, 256).alias("items_sha256"),
        contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )


def _cut(text_place: int):
    """Take the hit words and what lies between them out of the text."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ranges = batch.column(batch.num_columns - 1).to_pylist()
            texts = batch.column(text_place).to_pylist()
            for i, spans in enumerate(ranges):
                if spans:
                    raw = texts[i].encode()
                    own = Texts(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
                    _, words = _words_of(own)
                    for span in reversed(spans):
                        raw = raw[: words.starts[span["start"]]] + raw[words.ends[span["end"] - 1] :]
                    texts[i] = raw.decode()
            columns = [batch.column(k) for k in range(batch.num_columns - 1)]
            columns[text_place] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names[:-1])

    return rows


def cleaned(docs: DataFrame, benchmark: DataFrame, text: str = "text", spans: bool = False) -> DataFrame:
    """`docs` without its contaminated rows; with `spans`, those rows stay and lose the hit words instead."""
    names = {c: f"__{i}" for i, c in enumerate(docs.columns)}
    own = docs.select(*[F.col(c).alias(n) for c, n in names.items()])
    found = with_hits(own, benchmark, own.columns, names[text])
    bad = contaminated(_covered(F.col("ranges")), F.col("n_words"))
    if spans:
        marked = found.select(*own.columns, F.when(bad, F.col("ranges")).alias("ranges"))
        out = marked.mapInArrow(_cut(own.columns.index(names[text])), own.schema)
    else:
        out = found.filter(~bad)
    return out.select(*[F.col(n).alias(c) for c, n in names.items()])


ship_by_value(__name__)

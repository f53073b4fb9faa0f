"""Repeated byte strings by prefix-free parsing: remove what stands in the corpus twice for at least `LENGTH` bytes.

A text is cut into phrases where a rolling hash triggers. The trigger here is the smallest hash of a 16-byte gram within a
window of `length` bytes (the rightmost of equal ones), so every window holds its trigger and equal windows hold it in the
same place: no suffix of a phrase context is the proper prefix of another, which is what makes the parse prefix-free.
The windows that begin in one phrase and share a trigger form a run of neighbours; a run is known by two fingerprints:

- `core`, the bytes that all windows with this trigger and about this distance to it have in common;
- `full`, all bytes of the run's windows.

The parse is one row a run, about one per 140 bytes of text. A core met once settles its run: nothing in it repeats. A
full context met twice settles it too: all of it repeats. What is left are contexts that share a core and end
differently. Only those enter the dictionary, each distinct one once and with its bytes, and their suffixes are put in order by
classes that become finer, runs of 32 windows and then single windows, until each is settled. Dictionary and
parse combine as usual: what holds for a suffix of a dictionary context holds for its places in the parse.

Only equality for `length` bytes decides, not the order of unequal suffixes, so the suffix arrays are kept as these classes:
they are counted with partial aggregates, and no task sees all places of a frequent passage. Fingerprints have
64 bits each, 128 in each comparison that removes bytes; equal ones are trusted.

Odd rows: a null text is empty; texts shorter than `length` have no windows; repeated rows are copies and remove each other;
texts of any length are parsed in pieces. Other columns are not read, clashing names cannot matter. An empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from metaloom.functions.bind import shuffled
from metaloom.llm.landing import land
from metaloom.llm.wordscan import BASE, mix, slices
from metaloom.shipping import ship_by_value

LENGTH = 400
GRAM = 16
#: Windows of a run that share one core, at the first look and in the dictionary.
WIDTHS = (256, 32, 1)
PIECE = 1 << 20
PLACE = (1 << 24) - 1
#: `key`: a text by its digest. `at`, `windows`: first window of the run and how many. `trigger`: its distance from there.
#: `n`: how often the context stands in the piece of the corpus that made the row; 0 marks a run already known to repeat.
PARSE = "core long, full long, n long, key binary, at long, windows int, trigger int"
CLASS = "core long, full long, id long, id2 long, n long, at long, windows int, trigger int"


class Fingerprints:
    """Two 64-bit fingerprints of any byte range of one array, from running sums; the place does not matter."""

    def __init__(self) -> None:
        rng = np.random.default_rng(20250612)
        self.values = [rng.integers(1, 2**63, 256, dtype=np.uint64) for _ in range(2)]
        self.salts = rng.integers(1, 2**63, 4, dtype=np.uint64)
        self.power = self.back = np.ones(0, np.uint64)

    def read(self, data: np.ndarray) -> None:
        size = len(data) + 1
        if len(self.power) < size:
            for name, base in (("power", BASE), ("back", np.uint64(pow(int(BASE), -1, 1 << 64)))):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))
        self.sums = []
        for values in self.values:
            sums = np.zeros(size, np.uint64)
            np.cumsum(values[data] * self.power[: size - 1], out=sums[1:])
            self.sums.append(sums)

    def grams(self, size: int) -> np.ndarray:
        sums = self.sums[0]
        return mix((sums[size:] - sums[:-size]) * self.back[: len(sums) - size])

    def ranges(self, which: int, start: np.ndarray, end: np.ndarray, extra: np.ndarray) -> np.ndarray:
        sums = self.sums[which]
        value = (sums[end] - sums[start]) * self.back[start]
        return mix(value + extra.astype(np.uint64) * self.salts[which] + (end - start).astype(np.uint64) * self.salts[2 + which])


def smallest(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each `width` neighbouring values: running minima from both ends of blocks of that width."""
    count = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, ~np.uint64(0))
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:count], ahead[width - 1 : width - 1 + count])


def cut_runs(
    prints: Fingerprints, window: np.ndarray, trigger: np.ndarray, owner: np.ndarray, length: int, width: int
) -> dict[str, np.ndarray]:
    """Runs of neighbouring windows of one owner that share a trigger and, counted from it, a band of `width` places.

    `window` holds the starts of windows, `trigger` the place of each one's trigger. All windows of a band contain the
    bytes from the band's lowest distance before the trigger to what its highest distance still reaches: the core.
    """
    away = trigger - window
    band = away // width
    edge = np.ones(len(window), bool)
    edge[1:] = (
        (np.diff(window) != 1) | (np.diff(trigger) != 0) | (np.diff(band) != 0) | (np.diff(owner) != 0)
    )
    begins = np.flatnonzero(edge)
    ends = np.append(begins[1:], len(window)) - 1
    low, high, at, band = window[begins], window[ends], trigger[begins], band[begins]
    core_end = at - np.minimum(band * width + width - 1, length - GRAM) + length
    return {
        "core": prints.ranges(0, at - band * width, core_end, band),
        "full": prints.ranges(1, low, high + length, at - low),
        "row": owner[begins],
        "at": low,
        "windows": high - low + 1,
        "trigger": at - low,
    }


def _pieces(column: pa.Array, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Bytes, window starts, the text of each window and how far before the bytes that text begins, a piece at a time."""
    for low, _, texts in slices(column, PIECE):
        sizes = np.diff(texts.offsets)
        if len(texts) == 1 and sizes[0] > PIECE:
            for start in range(0, int(sizes[0]) - length + 1, PIECE):
                data = texts.data[start : start + PIECE + length - 1]
                windows = np.arange(len(data) - length + 1)
                yield data, windows, np.full(len(windows), low), np.full(len(windows), start)
            continue
        count = np.maximum(sizes - length + 1, 0)
        text = np.repeat(np.arange(len(texts)), count)
        shift = texts.offsets[:-1][text]
        windows = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count) + shift
        yield texts.data, windows, text + low, -shift


def _counted(runs: dict[str, np.ndarray]) -> tuple[dict, np.ndarray, dict]:
    """Each context of a piece once, how often it stands there, and the runs of those that stand there more than once."""
    order = np.lexsort((runs["full"], runs["core"]))
    core, full = runs["core"][order], runs["full"][order]
    new = np.ones(len(order), bool)
    new[1:] = (core[1:] != core[:-1]) | (full[1:] != full[:-1])
    begins = np.flatnonzero(new)
    n = np.diff(np.append(begins, len(order)))
    again = np.sort(order[np.repeat(n, n) > 1])
    pick = lambda which: {name: values[which] for name, values in runs.items()}
    return pick(order[begins]), n, pick(again)


def _merged(runs: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Runs in order of their place, neighbours of one text made one."""
    low, windows, row = runs["at"], runs["windows"], runs["row"]
    new = np.ones(len(low), bool)
    new[1:] = (row[1:] != row[:-1]) | (low[1:] != low[:-1] + windows[:-1])
    begins = np.flatnonzero(new)
    out = {name: values[begins] for name, values in runs.items()}
    if len(begins):
        out["windows"] = np.add.reduceat(windows, begins)
    return out


def parse(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """The parse of all texts: one row a run of windows, as `PARSE` says."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prints = Fingerprints()
        for batch in batches:
            keys = batch.column(1)
            for data, windows, text, shift in _pieces(batch.column(0), length):
                if not len(windows):
                    continue
                prints.read(data)
                grams = prints.grams(GRAM)
                packed = (grams & ~np.uint64(PLACE)) | (np.uint64(PLACE) - np.arange(len(grams), dtype=np.uint64))
                least = smallest(packed, length - GRAM + 1)
                trigger = PLACE - (least[windows] & np.uint64(PLACE)).astype(np.int64)
                runs = cut_runs(prints, windows, trigger, text, length, WIDTHS[0])
                runs["at"] += shift[np.searchsorted(windows, runs["at"])]
                once, n, again = _counted(runs)
                for part, times in ((once, n), (_merged(again), 0)):
                    count = len(part["at"])
                    yield pa.record_batch(
                        {
                            "core": part["core"].view(np.int64),
                            "full": part["full"].view(np.int64),
                            "n": np.broadcast_to(np.int64(times) if np.isscalar(times) else times, count).copy(),
                            "key": keys.take(pa.array(part["row"])),
                            "at": part["at"],
                            "windows": part["windows"].astype(np.int32),
                            "trigger": part["trigger"].astype(np.int32),
                        }
                    )

    return docs.select("text", "key").mapInArrow(rows, PARSE)


def shared(rows: DataFrame) -> DataFrame:
    """Rows whose core occurs twice or more in all, with `mixed`: are there different contexts around that core?"""
    cores = rows.groupBy("core").agg(F.sum("n").alias("_n"), F.min("full").alias("_low"), F.max("full").alias("_high"))
    cores = cores.filter("_n > 1").select("core", (F.col("_low") != F.col("_high")).alias("mixed"))
    # Written, so that only plain exchanges stand below the join and a frequent core can be split.
    return rows.join(shuffled(land(cores, "cores")), "core")


def dictionary(texts: DataFrame, length: int) -> DataFrame:
    """Bytes of the contexts that texts carry in `open`, one row each."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, raws, lists = batch.column(0), batch.column(1), batch.column(2)
            for i in range(len(batch)):
                raw = raws[i].as_py().encode()
                for some in range(0, len(lists[i]), 4096):
                    entries = lists[i].values[some : some + 4096].to_pylist()
                    bytes_of = [raw[e["at"] : e["at"] + e["windows"] - 1 + length] for e in entries]
                    out = {name: [e[name] for e in entries] for name in ("id", "id2", "n", "at", "windows", "trigger")}
                    yield pa.record_batch(
                        {
                            "key": pa.array([keys[i].as_py()] * len(entries), pa.binary()),
                            "bytes": pa.array(bytes_of, pa.binary()),
                            **{k: pa.array(v, pa.int32() if k in ("windows", "trigger") else pa.int64()) for k, v in out.items()},
                        }
                    )

    schema = "key binary, bytes binary, id long, id2 long, n long, at long, windows int, trigger int"
    return texts.select("key", "text", "open").mapInArrow(rows, schema)


def finer(contexts: DataFrame, length: int, width: int) -> DataFrame:
    """Dictionary contexts cut into shorter runs: `CLASS` rows, where `at` is the run's place inside its context.

    `parts` names the runs still open (`at`, `windows`).
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prints = Fingerprints()
        for batch in batches:
            for low in range(0, len(batch), 1024):
                some = batch.slice(low, 1024)
                offsets = np.concatenate([[0], np.cumsum(pc.binary_length(some.column(0)).to_numpy().astype(np.int64))])
                data = np.frombuffer(b"".join(some.column(0).to_pylist()), np.uint8)
                triggers = some.column(4).to_numpy().astype(np.int64) + offsets[:-1]
                parts = some.column(5)
                owner = np.repeat(np.arange(len(some)), np.diff(parts.offsets.to_numpy()))
                inner = parts.flatten()
                begins = inner.field("at").to_numpy().astype(np.int64) + offsets[:-1][owner]
                counts = inner.field("windows").to_numpy().astype(np.int64)
                windows = np.repeat(begins - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))
                owner = np.repeat(owner, counts)
                if not len(windows):
                    continue
                prints.read(data)
                runs = cut_runs(prints, windows, triggers[owner], owner, length, width)
                take = pa.array(runs["row"])
                yield pa.record_batch(
                    {
                        "core": runs["core"].view(np.int64),
                        "full": runs["full"].view(np.int64),
                        "id": some.column(1).take(take),
                        "id2": some.column(2).take(take),
                        "n": some.column(3).take(take),
                        "at": runs["at"] - offsets[:-1][runs["row"]],
                        "windows": runs["windows"].astype(np.int32),
                        "trigger": runs["trigger"].astype(np.int32),
                    }
                )

    return contexts.select("bytes", "id", "id2", "n", "trigger", "parts").mapInArrow(rows, CLASS)


def marks_and_texts(docs: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """Runs of repeated windows (`key`, `at`, `windows`), and the texts that have any candidate (`key`, `text`, `settled`).

    `docs` holds `key` and `text`; `settled` are the runs known from the parse alone, others follow from the dictionary.
    """
    places = land(parse(docs, length), "parse")
    hits = land(shared(places.filter("n > 0")), "hits")
    contexts = hits.groupBy("core", "full").agg(
        F.sum("n").alias("n"), F.first("mixed").alias("mixed"), F.min(F.struct("key", "at", "windows", "trigger")).alias("place")
    )
    contexts = land(contexts.filter("n > 1 or mixed"), "contexts")
    repeated = contexts.filter("n > 1").select("core", "full")
    whole = hits.join(shuffled(repeated), ["core", "full"]).select("key", "at", "windows")
    whole = whole.unionAll(places.filter("n = 0").select("key", "at", "windows"))
    open_ones = contexts.filter("mixed").select(
        F.col("place")["key"].alias("key"),
        F.struct(
            F.col("core").alias("id"),
            F.col("full").alias("id2"),
            "n",
            F.col("place")["at"].alias("at"),
            F.col("place")["windows"].alias("windows"),
            F.col("place")["trigger"].alias("trigger"),
        ).alias("entry"),
    )
    # Copies bring the same runs: a set holds each once, and is bounded by its text.
    by_text = whole.groupBy("key").agg(F.collect_set(F.struct("at", "windows")).alias("settled"))
    open_by_text = open_ones.groupBy("key").agg(F.collect_list("entry").alias("open"))
    wanted = by_text.join(shuffled(open_by_text), "key", "full_outer")
    distinct = docs.groupBy("key").agg(F.first("text").alias("text"))
    held = land(shuffled(wanted).join(distinct, "key"), "held")

    texts = held.filter(F.size("open") > 0)
    entries = land(dictionary(texts, length), "dictionary")
    parts = F.array(F.struct(F.lit(0).cast("long").alias("at"), "windows"))
    current, found = entries.withColumn("parts", parts), None
    for width in WIDTHS[1:]:
        classes = land(shared(finer(current, length, width)), f"classes-{width}")
        fulls = classes.groupBy("core", "full").agg(F.sum("n").alias("times"), F.first("mixed").alias("mixed"))
        fulls = land(fulls.filter("times > 1 or mixed"), f"fulls-{width}")
        known = land(classes.drop("mixed").join(shuffled(fulls), ["core", "full"]), f"known-{width}")
        ids = ["id", "id2"]
        done = known.filter("times > 1 and n = 1").select(*ids, "at", "windows")
        found = done if found is None else found.union(done)
        # A context is needed where its own runs are open, and where it is a reference for those of others.
        left = known.filter("mixed").groupBy(*ids).agg(F.collect_list(F.struct("at", "windows")).alias("parts"))
        current = entries.join(shuffled(left), ids)
    origin = entries.filter("n = 1").select(*["id", "id2"], "key", F.col("at").alias("_begin"))
    inner = found.join(shuffled(origin), ["id", "id2"]).select("key", (F.col("at") + F.col("_begin")).alias("at"), "windows")
    return inner, held


def _removed(runs: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Maximal ranges of bytes that the runs' windows cover; `runs` holds first window and number of windows."""
    if not len(runs):
        return []
    runs = runs[np.argsort(runs[:, 0], kind="stable")]
    starts, ends = runs[:, 0], np.maximum.accumulate(runs[:, 0] + runs[:, 1] - 1 + length)
    new = np.ones(len(runs), bool)
    new[1:] = starts[1:] > ends[:-1]
    return list(zip(starts[new].tolist(), ends[np.append(new[1:], True)].tolist()))


def _pairs(item) -> np.ndarray:
    values = item.values
    if values is None or not len(values):
        return np.zeros((0, 2), np.int64)
    return np.stack([values.field(k).to_numpy().astype(np.int64) for k in ("at", "windows")], axis=1)


def cleaned(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """For each distinct text of `docs` (`key`, `text`) that loses bytes: `key`, `spans` (start, end), `kept` bytes."""
    marks, held = marks_and_texts(docs, length)
    by_text = marks.groupBy("key").agg(F.collect_list(F.struct("at", "windows")).alias("inner"))
    both = held.filter(F.size("open") > 0).select("key", "text", "settled").join(shuffled(by_text), "key", "left")
    plain = held.filter("open is null").select(
        "key", "text", "settled", F.lit(None).cast("array<struct<at:long,windows:int>>").alias("inner")
    )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            keys, all_spans, all_kept = [], [], []
            for i in range(len(batch)):
                raw = batch.column(1)[i].as_py().encode()
                spans = _removed(np.concatenate([_pairs(batch.column(2)[i]), _pairs(batch.column(3)[i])]), length)
                if not spans:
                    continue
                edges = [0, *(x for span in spans for x in span), len(raw)]
                keys.append(batch.column(0)[i].as_py())
                all_spans.append([{"start": a, "end": b} for a, b in spans])
                all_kept.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2])))
            yield pa.record_batch(
                {"key": pa.array(keys, pa.binary()), "spans": pa.array(all_spans, span), "kept": pa.array(all_kept, pa.binary())}
            )

    schema = "key binary, spans array<struct<start:long,end:long>>, kept binary"
    columns = ["key", "text", "settled", "inner"]
    return both.select(*columns).unionAll(plain.select(*columns)).mapInArrow(rows, schema)


def keyed(docs: DataFrame) -> DataFrame:
    """`doc_id`, `text` (null is empty), `key`: the digest of the text."""
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", text.alias("text"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("key"))


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """`doc_id`, `n_bytes`, `spans` that go and `kept`, the bytes that stay (null where all stay)."""
    rows = keyed(docs)
    gone = cleaned(rows.select("key", "text"), length)
    narrow = rows.select("doc_id", "key", F.octet_length("text").cast("long").alias("n_bytes"))
    return narrow.join(shuffled(gone), "key", "left")


def kept_digests(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """`doc_id`, `n_bytes`, `n_removed`, `n_spans` and the digest of what stays, for every row of `docs`."""
    rows = keyed(docs)
    gone = cleaned(rows.select("key", "text"), length)
    size = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    told = gone.select(
        "key", size.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("digest")
    )
    narrow = rows.select("doc_id", "key", F.octet_length("text").cast("long").alias("n_bytes"))
    out = narrow.join(shuffled(land(told, "removed")), "key", "left")
    none = F.lit(0).cast("long")
    return out.select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", none).alias("n_removed"),
        F.coalesce("n_spans", none).alias("n_spans"),
        F.coalesce("digest", F.lower(F.hex("key"))).alias("kept_sha256"),
    )


ship_by_value(__name__)

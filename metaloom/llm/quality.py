"""Quality classifier: random Fourier features over document statistics, ridge scores, isotonic calibration.

Statistics are ratios of one whole text (letters, symbols, words, lines, repeats). Random Fourier features of the
standardised statistics approximate a Gaussian kernel; every partition sums its part of the normal equations, the parts
are added by key, and the bounded sum is solved on the driver. Ridge scores of rows that took no part in the fit are
then counted per score cell, and pooled adjacent violators turn cells into probabilities.

Defined results: a null text counts as empty; an empty text has statistics of zero and a score like any other; a row
without an id is scored and never learned from; repeated rows give repeated rows. Without any labelled row, or with one
label only, the score is the share of label 1 among the labelled rows, 0.5 if there are none. Null labels are left out;
an id with several labels counts once with the smallest. Only the named columns are read, so extra ones cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from metaloom.llm.landing import land
from metaloom.llm.wordscan import (
    Hasher,
    Texts,
    find_words,
    line_bytes,
    lower_bytes,
    mix,
    slices,
    spaced_bytes,
)
from metaloom.shipping import ship_by_value

#: Characters counted together, as bytes.
CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "digit": b"0123456789",
    "stop": b".,;:?'\"()-",
    "shout": b"!",
    "bar": b"|",
    "symbol": b"#*$%&<>@^~=+\\/{}[]_`",
    "newline": b"\n",
    "space": b" \t\r\x0b\x0c",
    "long": bytes(range(0x80, 0x100)),
}
N_STATS = 22
#: Labelled rows that a model is fitted on at most.
FIT_ROWS = 200_000
FEATURES = 256
CELLS = 2000
#: Ridge scores lie around 0 to 1; those outside fall in the outermost cells.
CELL_RANGE = (-0.5, 1.5)


def _distinct(keys: np.ndarray, text_of: np.ndarray, n: int) -> np.ndarray:
    """Distinct keys per text; keys already differ from text to text."""
    _, at = np.unique(keys, return_index=True)
    return np.bincount(text_of[at], minlength=n).astype(float)


def statistics(texts: Texts, hasher: Hasher) -> np.ndarray:
    """One row of `N_STATS` numbers per text."""
    n = len(texts)
    sizes = np.diff(texts.offsets).astype(float)
    share = np.maximum(sizes, 1)
    counted = {}
    for name, members in CLASSES.items():
        table = np.zeros(256, np.int32)
        table[list(members)] = 1
        sums = np.concatenate(([0], np.cumsum(table[texts.data], dtype=np.int64)))
        counted[name] = np.diff(sums[texts.offsets]).astype(float)
    lower = Texts(lower_bytes()[texts.data], texts.offsets)
    words = find_words(lower, spaced_bytes())
    text_of, count = words.text_of(), words.counts().astype(float)
    per_word = np.maximum(count, 1)
    length = (words.ends - words.starts).astype(float)
    mean = np.bincount(text_of, length, n) / per_word
    spread = np.sqrt(np.maximum(np.bincount(text_of, length**2, n) / per_word - mean**2, 0))
    hashes = hasher.runs(lower.data, words.starts, words.ends)
    salt = mix(text_of.astype(np.uint64) + np.uint64(1))
    distinct = _distinct(mix(hashes ^ salt), text_of, n)
    same = text_of[1:] == text_of[:-1]
    again = np.bincount(text_of[1:][same & (hashes[1:] == hashes[:-1])], minlength=n)
    pairs = hasher.windows(hashes, 2)[same]
    pair_of = text_of[1:][same]
    pair_count = np.maximum(np.bincount(pair_of, minlength=n), 1)
    distinct_pairs = _distinct(mix(pairs ^ salt[1:][same]), pair_of, n)
    last = lower.data[words.ends - 1] if len(words.ends) else np.zeros(0, np.uint8)
    odd = np.zeros(256, bool)
    odd[list(b"!|#*$%&<>@^~=+")] = True
    odd_words = np.bincount(text_of[odd[last]], minlength=n)
    lines = find_words(lower, line_bytes())
    line_of, line_count = lines.text_of(), np.maximum(lines.counts(), 1).astype(float)
    line_hash = hasher.runs(lower.data, lines.starts, lines.ends)
    distinct_lines = _distinct(mix(line_hash ^ mix(line_of.astype(np.uint64) + np.uint64(1))), line_of, n)
    letters = np.maximum(counted["upper"] + counted["lower"], 1)
    columns = [
        np.log1p(sizes),
        np.log1p(count),
        mean,
        spread,
        counted["upper"] / letters,
        *[np.sqrt(counted[k] / share) for k in ("digit", "stop", "shout", "bar", "symbol", "newline", "space", "long")],
        np.sqrt(again / per_word),
        distinct / per_word,
        np.log1p(distinct) / np.maximum(np.log1p(count), 1),
        np.where(count > 1, distinct_pairs / pair_count, 0),
        np.sqrt(odd_words / per_word),
        np.where(lines.counts() > 0, 1 - distinct_lines / line_count, 0),
        np.log1p(sizes / line_count),
        np.log1p(line_count),
        np.log1p(np.maximum.reduceat(np.append(length, 0.0), np.minimum(words.first[:-1], len(length))) * (count > 0)),
    ]
    return np.stack(columns, axis=1)


def _statistics_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher = Hasher()
    for batch in batches:
        for low, high, texts in slices(batch.column(1)):
            stats = statistics(texts, hasher).astype(np.float32)
            cells = pa.FixedSizeListArray.from_arrays(pa.array(stats.ravel()), N_STATS)
            rows = cells.cast(pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, high - low), rows], ["id", "x"])


def document_statistics(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """`id` and statistics `x` per row of `docs`; the texts go no further."""
    given = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    return given.mapInArrow(_statistics_rows, "id long, x array<float>")


@dataclass
class Model:
    """All a task needs to score statistics; a few hundred kilobytes whatever the corpus."""

    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray | None
    cell_at: np.ndarray
    cell_p: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        waves = np.cos(z @ self.directions + self.phases) * np.sqrt(2 / len(self.phases))
        return np.concatenate([waves, np.ones((len(x), 1))], axis=1)

    def ridge(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), self.cell_p[0])
        return np.interp(self.ridge(x), self.cell_at, self.cell_p)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, N_STATS).astype(float)


def _cell(score: np.ndarray) -> np.ndarray:
    low, high = CELL_RANGE
    return np.clip((score - low) / (high - low) * CELLS, 0, CELLS - 1).astype(np.int32)


def _normal_parts(model: Model):
    """Per partition: the sums of z z' and z y, one row per line of the matrix."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros((FEATURES + 1, FEATURES + 2)), False
        for batch in batches:
            if batch.num_rows:
                z = model.features(_matrix(batch.column("x")))
                y = batch.column("y").to_numpy(zero_copy_only=False).astype(float)
                total += z.T @ np.concatenate([z, y[:, None]], axis=1)
                seen = True
        if seen:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(FEATURES + 1), pa.int32()), pa.array(list(total))], ["line", "cells"]
            )

    return sums


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add up the lines that meet in a partition as they come; at most one matrix is held."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for line, cells in zip(batch.column("line").to_pylist(), batch.column("cells")):
            row = cells.values.to_numpy(zero_copy_only=False)
            total[line] = total[line] + row if line in total else row.copy()
    if total:
        lines = sorted(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(lines, pa.int32()), pa.array([total[k] for k in lines])], ["line", "cells"]
        )


def _cell_counts(model: Model):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, good = np.zeros(CELLS, np.int64), np.zeros(CELLS, np.int64)
        for batch in batches:
            if batch.num_rows:
                cells = _cell(model.ridge(_matrix(batch.column("x"))))
                y = batch.column("y").to_numpy(zero_copy_only=False)
                n += np.bincount(cells, minlength=CELLS)
                good += np.bincount(cells[y == 1], minlength=CELLS)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at, pa.int32()), pa.array(n[at]), pa.array(good[at])], ["cell", "n", "good"]
        )

    return count


def isotonic(at: np.ndarray, n: np.ndarray, good: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over cells in order: block centres and block means, one pseudo-count of each label."""
    blocks: list[list[float]] = []
    for x, count, hits in zip(at, n, good):
        blocks.append([x * count, float(count), float(hits)])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][1] >= blocks[-1][2] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    centres = np.array([b[0] / b[1] for b in blocks])
    means = np.array([(b[2] + 0.01) / (b[1] + 0.02) for b in blocks])
    return centres, np.maximum.accumulate(means)


def held_out(id_column: str = "doc_id", parts: int = 3, part: int = 1) -> Column:
    """Rows that nothing is learned from: crc32 of the id as text, modulo `parts`, is `part`. A null id is not one."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % parts == part, F.lit(False))


def fit(
    stats: DataFrame, labels: DataFrame, label: str = "quality", ridge: float = 1e-2, width: float = 0.7, seed: int = 7
) -> Model:
    """Learn from the rows of `stats` (id, x) whose id has a 0/1 label. `width` scales the kernel: in units of the
    square root of the number of statistics. A fifth of the rows, by hash of the id, calibrates; the others fit.
    """
    known = (
        labels.select(F.col("doc_id").cast("long").alias("id"), F.col(label).cast("int").alias("y"))
        .filter("id is not null and y in (0, 1)")
        .groupBy("id")
        .agg(F.min("y").alias("y"))
    )
    rows = land(stats.join(known.hint("merge"), "id").withColumn("fold", F.expr("pmod(xxhash64(id), 5)")), "labelled")
    x = [F.col("x")[i].cast("double") for i in range(N_STATS)]
    asked = [f(c) for c in x for f in (F.avg, F.stddev_pop)]
    got = rows.agg(F.count("*"), F.avg("y"), *asked).first()
    rng = np.random.default_rng(seed)
    sigma = width * np.sqrt(N_STATS)
    model = Model(
        mean=np.array([v or 0.0 for v in got[2::2]]),
        scale=np.array([v or 1.0 for v in got[3::2]]) + 1e-6,
        directions=rng.normal(0, 1 / sigma, (N_STATS, FEATURES)),
        phases=rng.uniform(0, 2 * np.pi, FEATURES),
        weights=None,
        cell_at=np.zeros(1),
        cell_p=np.array([0.5 if got[1] is None else float(got[1])]),
    )
    if got[1] in (None, 0.0, 1.0):
        return model
    parts = rows.filter("fold <> 0").select("x", "y").mapInArrow(_normal_parts(model), "line int, cells array<double>")
    lines = parts.repartition("line").mapInArrow(_added, "line int, cells array<double>").collect()
    if not lines:
        return model
    total = np.zeros((FEATURES + 1, FEATURES + 2))
    for line, cells in lines:
        total[line] = cells
    matrix, right = total[:, :-1], total[:, -1]
    model.weights = np.linalg.solve(matrix + ridge * np.eye(len(matrix)), right)
    counts = (
        rows.filter("fold = 0").select("x", "y").mapInArrow(_cell_counts(model), "cell int, n long, good long")
        .groupBy("cell").agg(F.sum("n"), F.sum("good")).orderBy("cell").collect()
    )
    if not counts:
        model.weights = None
        return model
    cell, n, good = (np.array(c, dtype=float) for c in zip(*counts))
    low, high = CELL_RANGE
    model.cell_at, model.cell_p = isotonic(low + (cell + 0.5) * (high - low) / CELLS, n, good)
    return model


def scored(stats: DataFrame, model: Model) -> DataFrame:
    """`id`, `score` and `predicted` per row of `stats`."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = np.clip(model.score(_matrix(batch.column("x"))), 0.0, 1.0) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                ["id", "score", "predicted"],
            )

    return stats.mapInArrow(rows, "id long, score double, predicted int")


def labelled_sample(labels: DataFrame, rows: int = FIT_ROWS, label: str = "quality") -> DataFrame:
    """About `rows` of the labelled ids at most, by hash of the id, with their label: what a classifier is fitted on.

    The bound makes the ids small enough to be sent to every task, so only texts that are learned from are read for the fit.
    """
    given = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
    share = min(1.0, rows / max(1, given.count()))
    return given.filter(F.expr("pmod(xxhash64(cast(doc_id AS long), 'fit'), 1000000) / 1000000d") < share)


def fitted(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Model:
    """The model from the labelled documents alone: statistics of no other text are taken."""
    known = labelled_sample(labels, rows)
    ids = known.select(F.col("doc_id").cast("long").alias("_labelled")).distinct()
    own = docs.select("doc_id", "text").join(F.broadcast(ids), F.col("doc_id").cast("long") == F.col("_labelled"), "left_semi")
    return fit(land(document_statistics(own), "statistics"), known)


def classify(docs: DataFrame, labels: DataFrame, parts: int = 3, part: int = 1) -> DataFrame:
    """`doc_id`, `held_out`, `score`, `predicted` per document; nothing is learned from held-out rows."""
    stats = land(document_statistics(docs), "statistics")
    model = fit(stats.filter(~held_out("id", parts, part)), labels)
    out = scored(stats, model)
    return out.select(F.col("id").alias("doc_id"), held_out("id", parts, part).alias("held_out"), "score", "predicted")


def kept_documents(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of `docs` that the model does not reject, all columns as they are: one pass, no shuffle of texts."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            for low, high, texts in slices(column):
                keep = model.score(statistics(texts, hasher).astype(np.float32).astype(float)) >= 0.5
                yield batch.slice(low, high - low).filter(pa.array(keep))

    return docs.mapInArrow(rows, docs.schema)


ship_by_value(__name__)

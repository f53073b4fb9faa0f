"""Language identification: script ranges narrow the candidates, per-word scores, Viterbi with a switching penalty.

Letters are grouped into words, marks after a letter go on with its word; the script of a word's first letter leaves only
the languages that use it. Each
word is scored per candidate by its letter trigrams, and Viterbi over the words of a text, with a penalty for every
change of language, labels spans. The language with the most letters in its spans is the text's.

The trigram counts come from a bounded sample of labelled rows (`rows_per_language`, by hash of the id) and are kept in
a fixed number of buckets, so the model has a fixed size per language. Every text is labelled whole.

Defined results: null text, empty text and text without a letter are `und` with score 0 and no spans, and so is every
text if no labelled row was seen; a word in a script that no learned language uses leaves the scores as they are, and
text of such words alone falls to the first language by name. Ties go to the smaller name. Rows without an id are
labelled but not learned from. Repeated rows give repeated rows; only the named columns are read.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from metaloom.llm.quality import held_out
from metaloom.shipping import ship_by_value

#: First and last code point of blocks, by script, as the Unicode standard lists them.
SCRIPT_RANGES = [
    ("latin", 0x0041, 0x024F),
    ("latin", 0x1E00, 0x1EFF),
    ("greek", 0x0370, 0x03FF),
    ("cyrillic", 0x0400, 0x052F),
    ("armenian", 0x0530, 0x058F),
    ("hebrew", 0x0590, 0x05FF),
    ("arabic", 0x0600, 0x077F),
    ("devanagari", 0x0900, 0x097F),
    ("bengali", 0x0980, 0x09FF),
    ("gurmukhi", 0x0A00, 0x0A7F),
    ("gujarati", 0x0A80, 0x0AFF),
    ("tamil", 0x0B80, 0x0BFF),
    ("telugu", 0x0C00, 0x0C7F),
    ("kannada", 0x0C80, 0x0CFF),
    ("malayalam", 0x0D00, 0x0D7F),
    ("thai", 0x0E00, 0x0E7F),
    ("georgian", 0x10A0, 0x10FF),
    ("hangul", 0x1100, 0x11FF),
    ("hangul", 0xAC00, 0xD7AF),
    ("kana", 0x3040, 0x30FF),
    ("han", 0x3400, 0x9FFF),
]
SCRIPTS = sorted({name for name, _, _ in SCRIPT_RANGES}) + ["other"]
BUCKETS = 1 << 16
SLICE_CHARS = 4 << 20
SLICE_CELLS = 8 << 20
#: A language uses a script if at least this share of its letters is in it.
SCRIPT_SHARE = 0.005
SWITCH_PENALTY = 8.0
ROWS_PER_LANGUAGE = 5000
UNKNOWN = "und"


class Letters:
    """Tables over all code points: the lower-case letter, the mark itself or 0, and the script."""

    def __init__(self) -> None:
        self.lower = np.zeros(0x110000, np.uint32)
        self.mark = np.zeros(0x110000, bool)
        for code in range(0x110000):
            char = chr(code)
            if char.isalpha():
                low = char.lower()
                self.lower[code] = ord(low) if len(low) == 1 else code
            elif unicodedata.category(char) in ("Mn", "Mc"):
                self.lower[code], self.mark[code] = code, True
        self.script = np.full(0x110000, SCRIPTS.index("other"), np.uint8)
        for name, low, high in SCRIPT_RANGES:
            self.script[low : high + 1] = SCRIPTS.index(name)

    def read(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Letters of all texts, with a 0 before, between and after them, and where each text begins."""
        joined = "\n" + "\n".join(texts) + "\n"
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        letters, marks = self.lower[codes], self.mark[codes]
        if marks.any():
            # A mark counts where a letter stands before it, with nothing but marks between.
            at = np.arange(len(codes))
            last = np.maximum.accumulate(np.where((letters > 0) & ~marks, at, -1))
            gap = np.maximum.accumulate(np.where(letters == 0, at, -1))
            letters[marks & (last < gap)] = 0
        return letters, np.concatenate(([1], 1 + np.cumsum(sizes + 1)))


def _grams(letters: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The bucket of the letter trigram around each position; the edge of a word counts as a letter."""
    h = letters[at - 1] * np.uint32(0x9E3779B1) + letters[at] * np.uint32(0x85EBCA6B)
    h = (h ^ (h >> np.uint32(15))) + letters[at + 1] * np.uint32(0xC2B2AE35)
    h = (h ^ (h >> np.uint32(13))) * np.uint32(0x27D4EB2F)
    return (h >> np.uint32(16)).astype(np.int64)


def _text_slices(texts: list[str], limit: int) -> Iterator[tuple[int, int]]:
    low, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield low, i
            low, size = i, 0
        size += len(text) + 1
    if low < len(texts):
        yield low, len(texts)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, bucket, n): trigram buckets, and scripts as buckets beyond them. Counts of a task, sparse."""
    letters = Letters()
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = np.array(batch.column("lang").to_pylist(), dtype=object)
        texts = batch.column("text").to_pylist()
        for lang in set(langs):
            own = [texts[i] for i in np.flatnonzero(langs == lang)]
            total = totals.setdefault(lang, np.zeros(BUCKETS + len(SCRIPTS), np.int64))
            for low, high in _text_slices(own, SLICE_CHARS):
                codes, _ = letters.read(own[low:high])
                at = np.flatnonzero(codes)
                total[:BUCKETS] += np.bincount(_grams(codes, at), minlength=BUCKETS)
                total[BUCKETS:] += np.bincount(letters.script[codes[at]], minlength=len(SCRIPTS))
    for lang, total in totals.items():
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(total[at])], ["lang", "bucket", "n"]
        )


@dataclass
class Model:
    languages: list[str]
    logs: np.ndarray  # language x bucket
    uses: np.ndarray  # language x script


def fit(docs: DataFrame, rows_per_language: int = ROWS_PER_LANGUAGE) -> Model:
    """Learn from `doc_id`, `text`, `lang`; about `rows_per_language` rows of each language are taken, by hash of the id."""
    known = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"), "lang")
    known = known.filter("id is not null and text is not null and lang is not null")
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros((0, BUCKETS), np.float32), np.zeros((0, len(SCRIPTS)), bool))
    shares = F.create_map(*[F.lit(v) for k in languages for v in (k, min(1.0, rows_per_language / sizes[k]))])
    place = F.expr("pmod(xxhash64(id, 'language'), 1000000) / 1000000d")
    sample = known.filter(place < shares[F.col("lang")]).select("lang", "text")
    counted = sample.mapInArrow(_counted, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    counts = np.zeros((len(languages), BUCKETS + len(SCRIPTS)))
    place_of = {k: i for i, k in enumerate(languages)}
    # A fixed number of sums a language, as columns.
    sums = counted.toArrow()
    if len(sums):
        rows = np.array([place_of[lang] for lang in sums.column("lang").dictionary_encode().combine_chunks().dictionary.to_pylist()])
        owner = rows[sums.column("lang").dictionary_encode().combine_chunks().indices.to_numpy()]
        counts[owner, sums.column("bucket").to_numpy()] = sums.column("n").to_numpy()
    grams, scripts = counts[:, :BUCKETS] + 0.02, counts[:, BUCKETS:]
    logs = np.log(grams / grams.sum(axis=1, keepdims=True)).astype(np.float32)
    uses = (scripts > 0) & (scripts >= SCRIPT_SHARE * scripts.sum(axis=1, keepdims=True))
    return Model(languages, logs, uses)


def word_scores(codes: np.ndarray, letters: Letters, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of each word, and words x languages of scores; languages without the word's script are ruled out."""
    inside = codes > 0
    starts = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
    ends = np.flatnonzero(inside[:-1] & ~inside[1:]) + 1
    scores = np.zeros((len(starts), len(model.languages)), np.float32)
    if not len(starts):
        return starts, ends, scores
    at = np.flatnonzero(inside)
    firsts = np.concatenate(([0], np.cumsum(ends - starts)[:-1]))
    grams = _grams(codes, at)
    for k in range(len(model.languages)):
        scores[:, k] = np.add.reduceat(model.logs[k][grams], firsts)
    allowed = model.uses.T[letters.script[codes[starts]]]
    known = allowed.any(axis=1)
    scores[~known] = 0
    scores[known[:, None] & ~allowed] = -1e6
    return starts, ends, scores


def viterbi(scores: np.ndarray, first: np.ndarray, penalty: float) -> np.ndarray:
    """The best language of every word. Texts advance together, a word per step; `first` cuts the words into texts."""
    counts = np.diff(first)
    order = np.argsort(-counts, kind="stable")
    begin, counts = first[:-1][order], counts[order]
    back = np.zeros(scores.shape, np.uint16)
    own = np.arange(scores.shape[1], dtype=np.uint16)
    longest = int(counts[0]) if len(counts) else 0
    active = np.searchsorted(-counts, -np.arange(longest), side="left")
    best = np.zeros((len(order), scores.shape[1]), np.float64)
    for t in range(longest):
        n = active[t]
        rows = begin[:n] + t
        if t:
            past = best[:n]
            top = past.argmax(axis=1)
            change = past[np.arange(n), top][:, None] - penalty
            stays = past >= change
            back[rows] = np.where(stays, own, top[:, None])
            best[:n] = np.where(stays, past, change) + scores[rows]
        else:
            best[:n] = scores[rows]
    state = best.argmax(axis=1)
    out = np.zeros(len(scores), np.uint16)
    for t in range(longest - 1, -1, -1):
        n = active[t]
        rows = begin[:n] + t
        out[rows] = state[:n]
        if t:
            state[:n] = back[rows, state[:n]]
    return out


def _labelled(model: Model, penalty: float):
    def label(texts: list[str], letters: Letters) -> tuple[list, list, list]:
        codes, begin = letters.read(texts)
        starts, ends, scores = word_scores(codes, letters, model)
        first = np.searchsorted(starts, begin)
        best = viterbi(scores, first, penalty)
        size = (ends - starts).astype(float)
        text_of = np.repeat(np.arange(len(texts)), np.diff(first))
        held = np.zeros((len(texts), len(model.languages)))
        np.add.at(held, (text_of, best), size)
        total = held.sum(axis=1)
        winner = held.argmax(axis=1)
        share = held.max(axis=1) / np.maximum(total, 1)
        named = [model.languages[w] if t else UNKNOWN for w, t in zip(winner, total)]
        new = np.ones(len(starts), bool)
        new[1:] = (best[1:] != best[:-1]) | (text_of[1:] != text_of[:-1])
        head = np.flatnonzero(new)
        tail = np.append(head[1:], len(starts)) - 1 if len(head) else head
        spans: list[list[dict]] = [[] for _ in texts]
        for h, t in zip(head, tail):
            i = text_of[h]
            spans[i].append({"start": int(starts[h] - begin[i]), "end": int(ends[t] - begin[i]), "lang": model.languages[best[h]]})
        return named, [float(s) if t else 0.0 for s, t in zip(share, total)], spans

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = Letters()
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))
        limit = min(SLICE_CHARS, max(1, SLICE_CELLS // max(1, len(model.languages))))
        for batch in batches:
            texts = batch.column("text").fill_null("").to_pylist()
            for low, high in _text_slices(texts, limit):
                if model.languages:
                    named, share, spans = label(texts[low:high], letters)
                else:
                    named, share, spans = [UNKNOWN] * (high - low), [0.0] * (high - low), [[]] * (high - low)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(low, high - low), pa.array(named, pa.string()), pa.array(share, pa.float64()), pa.array(spans, span)],
                    ["id", "lang_pred", "score", "spans"],
                )

    return rows


def identify(docs: DataFrame, model: Model, penalty: float = SWITCH_PENALTY) -> DataFrame:
    """`id`, `lang_pred`, `score` (share of letters) and `spans` (code points, end exclusive) per row of `docs`."""
    given = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    return given.mapInArrow(
        _labelled(model, penalty),
        "id long, lang_pred string, score double, spans array<struct<start: long, end: long, lang: string>>",
    )


def predict(docs: DataFrame, parts: int = 4, part: int = 2) -> DataFrame:
    """`doc_id`, `held_out`, `lang_pred`, `score`, `n_spans`; nothing is learned from held-out rows."""
    model = fit(docs.filter(~held_out("doc_id", parts, part)))
    out = identify(docs, model)
    return out.select(
        F.col("id").alias("doc_id"),
        held_out("id", parts, part).alias("held_out"),
        "lang_pred",
        "score",
        F.size("spans").alias("n_spans"),
    )


ship_by_value(__name__)

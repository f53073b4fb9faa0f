"""Spelling variants by permuterm rotations: words one edit apart meet under a rotation that skips the edited letter.

A word `w` of L letters gets a terminator `$` and has the rotations `y$x` of every cut `w = xy`. Rotated so that letter c
of `w = xcy` comes last, it reads `y$xc`; whatever agrees with it up to that last letter shares the prefix `y$x`:

- `y$xd`, any word that has another letter in the same place (replaced),
- `y$x` itself, a whole rotation of the word `xy` (deleted there, inserted here).

So all rotations are dealt and sorted by that prefix, and each group of equal prefixes is scanned once. A group holds at
most one word per letter of the alphabet and one whole rotation, however often the words occur, and it emits for each
member a count and its best neighbour, not pairs. A rotation is known by a 128-bit fingerprint taken from prefix
sums and a word by its place in code-point order: a word of L letters makes 2L + 1 rows of fixed size, not L texts of
length L. Equal fingerprints are trusted.

Odd rows: null and empty texts have no words; a null doc_id counts as an empty one where the id enters a checksum; repeated
rows count each; other columns of the input are not read. Equal counts go to the smaller word in code-point order. Very
long words take time and rows in proportion to their length. An empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from metaloom.functions.bind import once, shuffled
from metaloom.llm.landing import land
from metaloom.llm.wordscan import BASE, lower_bytes, mix
from metaloom.operators.ordering import with_sequence
from metaloom.session import cut_and_measure
from metaloom.shipping import ship_by_value

#: Letters of a word after A to Z are lower-cased.
LETTERS = "a-zÀ-ÿ"
MIN_LETTERS, MIN_COUNT, RATIO = 6, 5, 5
#: Distinct words that a task holds before it passes their counts on, and letters whose rotations it makes at once.
HELD_WORDS, HELD_LETTERS = 200_000, 1 << 18
ROTATION = "k1 long, k2 long, whole int, minus_n long, seq long, lead boolean"


def word_counts(docs: DataFrame, min_letters: int = MIN_LETTERS, every: int | None = None) -> DataFrame:
    """`word`, `n`: lower-cased runs of letters over all texts, those of at least `min_letters`.

    With `every`, one run in so many loses a letter: a run of a document whose checksum crc32(`<doc_id>:<run>`) is divisible
    by it, the letter at that checksum modulo the length.
    """
    table, pattern = lower_bytes().tobytes(), f"[{LETTERS}]{{{min_letters},}}"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs, held = re.compile(pattern), Counter()

        def passed_on() -> pa.RecordBatch:
            out = pa.record_batch({"word": pa.array(held.keys(), pa.string()), "n": pa.array(held.values(), pa.int64())})
            held.clear()
            return out

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if not text.is_valid:
                    continue
                own = Counter(runs.findall(text.as_py().encode().translate(table).decode()))
                if every is None:
                    held.update(own)
                else:
                    id_sum = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                    for run, n in own.items():
                        h = zlib.crc32(run.encode(), id_sum)
                        if h % every == 0:
                            at = h % len(run)
                            run = run[:at] + run[at + 1 :]
                            if len(run) < min_letters:
                                continue
                        held[run] += n
                if len(held) > HELD_WORDS:
                    yield passed_on()
        yield passed_on()

    parts = docs.select("doc_id", "text").mapInArrow(count, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


class Rotations:
    """Fingerprints of rotations of many words at once, from running sums of letter values times powers of a base."""

    def __init__(self) -> None:
        rng = np.random.default_rng(20250611)
        self.letters = [rng.integers(1, 2**63, 1 << 16, dtype=np.uint64) for _ in range(2)]
        self.marks = rng.integers(1, 2**63, 2, dtype=np.uint64)
        self.inverse = np.uint64(pow(int(BASE), -1, 1 << 64))

    def _powers(self, base: np.uint64, size: int) -> np.ndarray:
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        return np.cumprod(steps, dtype=np.uint64)

    def of(self, letters: np.ndarray, first: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """For code points of words, word i at `first[i]:first[i + 1]`: the prefix that skips each letter, and each cut.

        The first list has one value a letter, the second one value a letter and one more a word, words in order.
        """
        sizes = np.diff(first)
        power = self._powers(BASE, len(letters) + 2)
        back = self._powers(self.inverse, len(letters) + 2)
        low, high = np.repeat(first[:-1], sizes), np.repeat(first[1:], sizes)
        at = np.arange(len(letters))
        cut_low, cut_high = np.repeat(first[:-1], sizes + 1), np.repeat(first[1:], sizes + 1)
        cut = np.arange(len(letters) + len(sizes)) - np.repeat(np.arange(len(sizes)), sizes + 1)
        skipping, whole = [], []
        for values, mark in zip(self.letters, self.marks):
            sums = np.zeros(len(letters) + 1, np.uint64)
            np.cumsum(values[letters & 0xFFFF] * power[: len(letters)], out=sums[1:])

            def rotated(begin, from_, to, end):
                """Letters from `to` to the end, the mark, letters from the start to `from_`."""
                tail = (sums[end] - sums[to]) * back[to]
                head = (sums[from_] - sums[begin]) * back[begin] * power[end - to + 1]
                return mix(tail + mark * power[end - to] + head)

            skipping.append(rotated(low, at, at + 1, high))
            whole.append(rotated(cut_low, cut, cut, cut_high))
        return skipping, whole


def rotations(words: DataFrame) -> DataFrame:
    """Two rows a letter of each word (`seq`, `word`, `n`): the prefix that skips the letter, and the whole rotation.

    `lead` marks the first of equal neighbouring letters: taking out any of them gives the same word, so one row may meet it.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = Rotations()
        for batch in batches:
            seqs, ns = (batch.column(i).to_numpy() for i in (0, 2))
            texts = batch.column(1).to_pylist()
            sizes = np.array([len(t) for t in texts], np.int64)
            ends = np.cumsum(sizes)
            low = 0
            while low < len(texts):
                begin = int(ends[low] - sizes[low])
                high = max(low + 1, int(np.searchsorted(ends, begin + HELD_LETTERS, side="right")))
                letters = np.frombuffer("".join(texts[low:high]).encode("utf-32-le"), np.uint32).astype(np.int64)
                first = np.concatenate([[0], np.cumsum(sizes[low:high])])
                skipping, whole = made.of(letters, first)
                lead = np.ones(len(letters), bool)
                lead[1:] = letters[1:] != letters[:-1]
                lead[first[:-1]] = True
                for is_whole, keys, times in ((0, skipping, sizes[low:high]), (1, whole, sizes[low:high] + 1)):
                    count = len(keys[0])
                    yield pa.record_batch(
                        {
                            "k1": keys[0].view(np.int64),
                            "k2": keys[1].view(np.int64),
                            "whole": np.full(count, is_whole, np.int32),
                            "minus_n": -np.repeat(ns[low:high], times),
                            "seq": np.repeat(seqs[low:high], times),
                            "lead": np.ones(count, bool) if is_whole else lead,
                        }
                    )
                low = high

    return words.select("seq", "word", "n").mapInArrow(rows, ROTATION)


def neighbours(words: DataFrame) -> DataFrame:
    """`seq`, `n_near`, `best` (`minus_n`, `seq`): words one edit away, and the most frequent of them."""
    member = F.struct("whole", "minus_n", "seq", "lead")
    groups = rotations(words).groupBy("k1", "k2").agg(F.sort_array(F.collect_list(member)).alias("members"))
    groups = groups.filter(F.size("members") > 1)
    place = lambda m: F.struct(m["minus_n"].alias("minus_n"), m["seq"].alias("seq"))
    split = once(
        groups,
        edited=F.filter("members", lambda m: m["whole"] == 0),
        shorter=F.get(F.filter("members", lambda m: m["whole"] == 1), F.lit(0)),
    ).withColumn("leads", F.filter("edited", lambda m: m["lead"]))

    def of_edited(m, i):
        other = F.get("edited", F.when(i == 0, 1).otherwise(0))
        meets = m["lead"] & F.col("shorter").isNotNull()
        near = F.size("edited") - 1 + meets.cast("int")
        best = F.least(F.when(other.isNotNull(), place(other)), F.when(meets, place(F.col("shorter"))))
        return F.struct(m["seq"].alias("seq"), near.cast("long").alias("near"), best.alias("best"))

    of_shorter = F.when(
        F.col("shorter").isNotNull() & (F.size("leads") > 0),
        F.array(
            F.struct(
                F.col("shorter")["seq"].alias("seq"),
                F.size("leads").cast("long").alias("near"),
                place(F.get("leads", F.lit(0))).alias("best"),
            )
        ),
    ).otherwise(F.array())
    told = split.select(F.inline(F.concat(F.transform("edited", of_edited), of_shorter))).filter("near > 0")
    return told.groupBy("seq").agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))


def roots(links: DataFrame) -> DataFrame:
    """`seq`, `root` of words that have a form (`seq`, `to`): the last of the chain, found by pointer doubling.

    Counts grow by a factor at each step, so chains have no loops and the rounds are the logarithm of a short length.
    """
    current = links.select("seq", F.col("to").alias("root"))
    while True:
        ahead = current.select(F.col("seq").alias("_at"), F.col("root").alias("_next"))
        stepped = current.join(shuffled(ahead), F.col("root") == F.col("_at"), "left")
        current, seen = cut_and_measure(
            stepped.select("seq", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")),
            moved=F.count_if("_moved"),
        )
        current = current.drop("_moved")
        if not seen["moved"]:
            return current


def spelling_variants(
    docs: DataFrame,
    min_letters: int = MIN_LETTERS,
    min_count: int = MIN_COUNT,
    ratio: int = RATIO,
    every: int | None = None,
) -> DataFrame:
    """`word`, `form`, `root`, `n`, `n_near`, `form_n` for every word of at least `min_count` occurrences.

    The form of a word is its most frequent neighbour if that occurs at least `ratio` times as often; the root is the
    end of the chain of forms, the word itself if it has none.
    """
    counted = word_counts(docs, min_letters, every).filter(F.col("n") >= min_count)
    words = with_sequence(counted, "word").select("seq", "word", "n")
    near = words.join(shuffled(neighbours(words)), "seq", "left")
    has_form = -F.col("best")["minus_n"] >= ratio * F.col("n")
    placed = land(
        near.select(
            "seq",
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(has_form, F.col("best")["seq"]).alias("to"),
            F.when(has_form, -F.col("best")["minus_n"]).alias("form_n"),
        ),
        "variants",
    )
    linked = roots(placed.filter(F.col("to").isNotNull()).select("seq", "to"))
    named = lambda at, name: placed.select(F.col("seq").alias(at), F.col("word").alias(name))
    return (
        placed.join(shuffled(linked), "seq", "left")
        .join(shuffled(named("to", "form")), "to", "left")
        .join(shuffled(named("root", "root_word")), "root", "left")
        .select("word", "form", F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n")
    )


ship_by_value(__name__)

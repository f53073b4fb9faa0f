"""LM scoring: the marginal probability of a text over all segmentations into pieces of an existing vocabulary.

The pieces are those of a public rank file. A piece's probability starts from its place in the file (Zipf's law) and is
weighted with its count over all training texts, each word encoded by the ranks. A word is spelled with a blank before
it, and no piece crosses a blank inside, so a text's lattice falls apart at the words: the forward recursion
runs over the distinct words of a slice of texts, all words of one length together, in log space.

Beside it stands the add-one word model: counts of all training words are summed by word over the cluster. Words of at
least `FREQUENT` of all tokens, at most 1 / FREQUENT of them, are broadcast; occurrences of all others meet their
counts in a join on the word's 64-bit hash, where no key holds more than that share.

Defined results: null and empty texts have the end as their only token. Rows without an id are training rows, as their
remainder is not the held-out one. Without training rows N and V are 0 and base scores are those of the formula.
Pieces of every length take part; single bytes cover everything. Repeated rows give repeated rows and
count as often as they occur. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from metaloom.llm.bytebpe import read_ranks
from metaloom.llm.landing import land
from metaloom.llm.quality import held_out
from metaloom.llm.wordscan import Hasher, Texts, find_words, lower_bytes, slices, spaced_bytes
from metaloom.shipping import ship_by_value

FREQUENT = 2e-6
#: Weight of the vocabulary's own order, in tokens.
PRIOR = 50_000.0
#: Distinct words that a training task holds before it passes its counts on.
HELD_WORDS = 1 << 19
CELLS = 1 << 20
#: Texts that are taken apart together: a batch may hold ten thousand, and all arrays over words would be as long.
SLICE_BYTES = 1 << 20
MULTIPLIER = np.uint64(0x2545F4914F6CDD1D)


class SliceWords:
    """The distinct words of some texts: hash, count and bytes of each, and which of them every text holds."""

    def __init__(self, texts: Texts, hasher: Hasher) -> None:
        self.data = lower_bytes()[texts.data]
        words = find_words(Texts(self.data, texts.offsets), spaced_bytes())
        self.counts = words.counts().astype(np.int64)
        self.hash, at, self.place, self.times = np.unique(
            hasher.runs(self.data, words.starts, words.ends), return_index=True, return_inverse=True, return_counts=True
        )
        self.starts, self.ends = words.starts[at], words.ends[at]
        self.text_of = words.text_of()


class PieceTable:
    """Log-probability of a byte string by its polynomial hash; misses are minus infinity."""

    BITS = 20

    def __init__(self, pieces: list[bytes], logs: np.ndarray) -> None:
        #: Only lengths that pieces have are looked up: the longest are few.
        self.lengths = np.array(sorted({len(p) for p in pieces}))
        keys = np.zeros(len(pieces), np.uint64)
        for i, piece in enumerate(pieces):
            h = 0
            for byte in piece:
                h = (h * int(MULTIPLIER) + byte + 1) & 0xFFFFFFFFFFFFFFFF
            keys[i] = h
        self.levels = []
        left = np.arange(len(pieces))
        # Keys that meet at one place of a level go on to the next; a few levels hold all.
        while len(left):
            seed = np.uint64(2 * len(self.levels) + 0x9E3779B97F4A7C15)
            place = self._place(keys[left], seed)
            _, first = np.unique(place, return_index=True)
            key, log = np.zeros(1 << self.BITS, np.uint64), np.full(1 << self.BITS, -np.inf)
            key[place[first]], log[place[first]] = keys[left[first]], logs[left[first]]
            self.levels.append((seed, key, log))
            left = np.delete(left, first)

    def _place(self, keys: np.ndarray, seed: np.uint64) -> np.ndarray:
        return ((keys ^ (keys >> np.uint64(31))) * seed) >> np.uint64(64 - self.BITS)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(keys.shape, -np.inf)
        for seed, key, log in self.levels:
            place = self._place(keys, seed)
            hit = key[place] == keys
            out[hit] = log[place[hit]]
        return out


def marginal(words: np.ndarray, table: PieceTable) -> np.ndarray:
    """Log-probabilities of byte strings of one length (rows of a matrix), over all segmentations."""
    n, size = words.shape
    lengths = table.lengths[table.lengths <= size]
    longest = int(lengths[-1])
    column = {int(length): i for i, length in enumerate(lengths)}
    alpha = np.full((n, size + 1), -np.inf)
    alpha[:, 0] = 0
    block = max(1, min(size, CELLS // max(1, n * len(lengths))))
    for low in range(0, size, block):
        high = min(size, low + block)
        # logs[:, e, i]: the piece of the i-th length that ends with byte low + e.
        logs = np.full((n, high - low, len(lengths)), -np.inf)
        first = max(0, low - longest + 1)
        keys = np.zeros((n, high - first), np.uint64)
        own = words[:, first:high].astype(np.uint64) + np.uint64(1)
        for length in range(1, longest + 1):
            count = high - first - length + 1
            if count <= 0:
                break
            keys = keys[:, :count] * MULTIPLIER + own[:, length - 1 : length - 1 + count]
            # Piece at first + s ends with byte first + s + length - 1; only ends inside the block matter.
            skip = max(0, low - (first + length - 1))
            at = first + length - 1 + skip - low
            if skip < count and length in column:
                logs[:, at : at + count - skip, column[length]] = table(keys[:, skip:])
        for e in range(high - low):
            j = low + e + 1
            fit = lengths[: np.searchsorted(lengths, j, side="right")]
            terms = alpha[:, j - fit] + logs[:, e, : len(fit)]
            top = terms.max(axis=1, initial=-np.inf)
            held = np.isfinite(top)
            # No piece ends here: minus infinity stays.
            sums = np.exp(terms[held] - top[held, None]).sum(axis=1)
            alpha[held, j] = top[held] + np.log(sums)
    return alpha[:, size]


def word_logs(words: SliceWords, table: PieceTable) -> np.ndarray:
    """Natural log of the marginal probability of each distinct word of a slice, with the blank before it."""
    out = np.zeros(len(words.hash))
    sizes = words.ends - words.starts
    order = np.argsort(sizes, kind="stable")
    edges = np.flatnonzero(np.diff(sizes[order])) + 1
    for group in np.split(order, edges):
        if not len(group):
            continue
        size = int(sizes[group[0]])
        step = max(1, CELLS // ((size + 1) * int((table.lengths <= size + 1).sum())))
        for low in range(0, len(group), step):
            part = group[low : low + step]
            matrix = np.empty((len(part), size + 1), np.uint8)
            matrix[:, 0] = 0x20
            matrix[:, 1:] = words.data[words.starts[part][:, None] + np.arange(size)]
            out[part] = marginal(matrix, table)
    return out


def _counted(path: str, pattern: str):
    """(kind, key, n): words by hash (kind 0), pieces by rank (kind 1), texts (kind 2)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        ranks = read_ranks(path)
        encode = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        hasher = Hasher()
        pieces, texts = np.zeros(max(ranks.values()) + 1, np.int64), 0
        held = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))]

        def passed_on() -> pa.RecordBatch:
            keys, place = np.unique(np.concatenate([h for h, _ in held]), return_inverse=True)
            n = np.bincount(place, np.concatenate([c for _, c in held]), len(keys)).astype(np.int64)
            held[:] = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))]
            return _triples(0, keys.view(np.int64), n)

        for low, high, slice_texts in (s for batch in batches for s in slices(batch.column(0), SLICE_BYTES)):
            words = SliceWords(slice_texts, hasher)
            texts += high - low
            held.append((words.hash, words.times))
            raw = words.data.tobytes()
            ids, weights = [], []
            for start, end, times in zip(words.starts.tolist(), words.ends.tolist(), words.times.tolist()):
                own = encode(" " + raw[start:end].decode("utf-8", "replace"))
                ids += own
                weights += [times] * len(own)
            pieces += np.bincount(np.array(ids, np.int64), np.array(weights, float), len(pieces)).astype(np.int64)
            if sum(len(h) for h, _ in held) >= HELD_WORDS:
                yield passed_on()
        yield passed_on()
        at = np.flatnonzero(pieces)
        yield _triples(1, at, pieces[at])
        yield _triples(2, np.zeros(1, np.int64), np.array([texts]))

    return rows


def _triples(kind: int, keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(keys), kind, np.int32)), pa.array(keys), pa.array(n)], ["kind", "key", "n"]
    )


def piece_logs(ranks: dict[bytes, int], counts: dict[int, int], texts: int, prior: float = PRIOR) -> tuple[list[bytes], np.ndarray, float]:
    """Pieces, the natural log of each one's probability, and that of the end. Counts are added to a Zipf prior."""
    pieces = [p for p, _ in sorted(ranks.items(), key=lambda x: x[1])]
    zipf = 1 / (np.array([ranks[p] for p in pieces]) + 2.7)
    own = np.array([counts.get(ranks[p], 0) for p in pieces], float)
    mass = own + prior * zipf / zipf.sum()
    end = texts + prior / 1000
    total = mass.sum() + end
    return pieces, np.log(mass / total), float(np.log(end / total))


def _scored(frequent, model, n_end: int):
    """Per text: what needs no join, and the rarer words with their number of occurrences."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        keys, counts = frequent.value
        pieces, logs, end = model.value
        table = PieceTable(pieces, logs)

        def scored_slice(ids: pa.Array, words: SliceWords) -> pa.RecordBatch:
            n = len(ids)
            spelled = np.bincount(words.text_of, word_logs(words, table)[words.place], n) + end
            known = np.zeros(len(words.hash), bool)
            gain = np.zeros(len(words.hash))
            if len(keys) and len(words.hash):
                at = np.minimum(np.searchsorted(keys, words.hash), len(keys) - 1)
                known = keys[at] == words.hash
                gain[known] = np.log10(counts[at[known]] + 1.0)
            common = known[words.place]
            base = np.bincount(words.text_of, gain[words.place], n) + np.log10(n_end + 1.0)
            n_known = np.bincount(words.text_of[common], minlength=n) + (n_end > 0)
            # The rarer words of each text, each once with its occurrences.
            rare_text, rare_word = words.text_of[~common], words.place[~common]
            pairs, times = np.unique(rare_text * max(1, len(words.hash)) + rare_word, return_counts=True)
            owner, word = pairs // max(1, len(words.hash)), pairs % max(1, len(words.hash))
            offsets = pa.array(np.searchsorted(owner, np.arange(n + 1)), pa.int32())
            hashes = words.hash[word].view(np.int64) if len(word) else np.zeros(0, np.int64)
            return pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array(words.counts + 1),
                    pa.array(n_known.astype(np.int64)),
                    pa.array(base),
                    pa.array(spelled / np.log(10)),
                    pa.ListArray.from_arrays(offsets, pa.array(hashes)),
                    pa.ListArray.from_arrays(offsets, pa.array(times.astype(np.int32))),
                ],
                ["id", "n_tokens", "n_known", "base", "score", "rare", "times"],
            )

        for batch in batches:
            for low, high, texts in slices(batch.column("text"), SLICE_BYTES):
                yield scored_slice(batch.column("id").slice(low, high - low), SliceWords(texts, hasher))

    return rows


def score(docs: DataFrame, path: str, pattern: str, parts: int = 7, part: int = 2) -> DataFrame:
    """Token counts, the add-one base score and the lattice score per document; held-out rows are not learned from."""
    spark = docs.sparkSession
    given = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    train = given.filter(~held_out("id", parts, part)).select("text")
    counted = train.mapInArrow(_counted(path, pattern), "kind int, key long, n long")
    counted = land(counted.groupBy("kind", "key").agg(F.sum("n").alias("n")), "counts")
    sums = {r["kind"]: (r["n"], r["v"]) for r in counted.groupBy("kind").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()}
    n_end = sums.get(2, (0, 0))[0] or 0
    total = (sums.get(0, (0, 0))[0] or 0) + n_end
    distinct = sums.get(0, (0, 0))[1] + (n_end > 0)
    is_frequent = F.col("n") >= F.lit(max(1.0, FREQUENT * total))
    words = counted.filter("kind = 0").select("key", "n")
    top = words.filter(is_frequent).toArrow()
    keys, counts = (top.column(i).to_numpy().copy() for i in range(2))
    order = np.argsort(keys.view(np.uint64))
    frequent = spark.sparkContext.broadcast((keys.view(np.uint64)[order], counts[order]))
    own = {r["key"]: r["n"] for r in counted.filter("kind = 1").collect()}
    model = spark.sparkContext.broadcast(piece_logs(read_ranks(path), own, n_end))
    scored = given.mapInArrow(
        _scored(frequent, model, n_end),
        "id long, n_tokens long, n_known long, base double, score double, rare array<long>, times array<int>",
    )
    # The number is written with the row, so a later retry cannot give a row another one.
    scored = land(scored.withColumn("row", F.monotonically_increasing_id()), "scored")
    rare = scored.select("row", F.inline(F.arrays_zip("rare", "times")).alias("key", "times"))
    met = rare.join(words.filter(~is_frequent).hint("merge"), "key")
    gains = met.groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("gain"), F.sum(F.col("times").cast("long")).alias("met")
    )
    out = scored.drop("rare", "times").join(gains.hint("merge"), "row", "left")
    shift = float(np.log10(total + 1.0 * (distinct + 1)))
    return out.select(
        F.col("id").alias("doc_id"),
        held_out("id", parts, part).alias("held_out"),
        "n_tokens",
        (F.col("n_known") + F.coalesce("met", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("gain", F.lit(0.0)) - F.col("n_tokens") * shift).alias("base_score"),
        "score",
    )


ship_by_value(__name__)

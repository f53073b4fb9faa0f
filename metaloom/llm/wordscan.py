"""Words of many texts at once: byte masks and 64-bit hashes over Arrow batches, a bounded slice at a time.

Words are runs of bytes that a 256-entry table marks; both word rules of this package depend on ASCII bytes only, so
every byte of a longer UTF-8 sequence belongs to a word. A to Z are lower-cased, other letters stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from metaloom.shipping import ship_by_value

SLICE_BYTES = 4 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xD6E8FEB86659FD93)


def spaced_bytes() -> np.ndarray:
    """Word bytes of `[^\\x20\\x09-\\x0D]+`."""
    table = np.ones(256, dtype=bool)
    table[[0x20, *range(0x09, 0x0E)]] = False
    return table


def item_bytes() -> np.ndarray:
    """Word bytes of `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` in lower-cased text."""
    table = np.ones(256, dtype=bool)
    for low, high in ((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)):
        table[low : high + 1] = False
    return table


def line_bytes() -> np.ndarray:
    """All bytes but the line feed."""
    table = np.ones(256, dtype=bool)
    table[0x0A] = False
    return table


def lower_bytes() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[0x41:0x5B] += 0x20
    return table


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of a 64-bit value, one to one."""
    h = (h ^ (h >> np.uint64(32))) * MIX
    h = (h ^ (h >> np.uint64(29))) * MIX
    return h ^ (h >> np.uint64(32))


@dataclass
class Texts:
    """Some texts of a batch: their bytes one after the other, and where each begins."""

    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1


@dataclass
class Words:
    """Words of `Texts`: begin and end in the bytes; `first[i]` is the first word of text i, one entry more at the end."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts())


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, Texts]]:
    """Cut a text column into row ranges of at most `limit` bytes, or one text if that is longer. Null is empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.fill_null("").cast(pa.large_binary())
    n = len(column)
    if not n:
        return
    _, ends, data = column.buffers()
    ends = np.frombuffer(ends, dtype=np.int64)[column.offset : column.offset + n + 1]
    held = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    low = 0
    while low < n:
        high = int(np.searchsorted(ends, ends[low] + limit, side="right")) - 1
        high = min(n, max(high, low + 1))
        yield low, high, Texts(held[ends[low] : ends[high]], ends[low : high + 1] - ends[low])
        low = high


def find_words(texts: Texts, table: np.ndarray) -> Words:
    """Maximal runs of marked bytes; no run crosses from one text into the next."""
    inside = table[texts.data]
    size = len(inside)
    before, after = np.zeros(size, bool), np.zeros(size, bool)
    if size:
        before[1:], after[:-1] = inside[:-1], inside[1:]
        edges = texts.offsets[:-1][np.diff(texts.offsets) > 0]
        before[edges] = False
        after[edges[1:] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return Words(starts, ends, np.searchsorted(starts, texts.offsets))


class Hasher:
    """64-bit hashes of byte runs: a polynomial over random byte values, then mixed. Fixed seed, same on every task."""

    def __init__(self) -> None:
        self.values = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64)
        self.inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
        self.powers = self.inverses = np.ones(0, np.uint64)

    def _reach(self, size: int) -> None:
        if len(self.powers) < size:
            for name, base in (("powers", BASE), ("inverses", self.inverse)):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))

    def runs(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The hash of each run `data[starts[i]:ends[i]]`; runs are in order and apart."""
        out = np.empty(len(starts), np.uint64)
        low = 0
        while low < len(starts):
            high = max(low + 1, int(np.searchsorted(ends, starts[low] + SLICE_BYTES)))
            at, end = int(starts[low]), int(ends[high - 1])
            self._reach(end - at + 1)
            sums = np.zeros(end - at + 1, np.uint64)
            np.cumsum(self.values[data[at:end]] * self.powers[: end - at], out=sums[1:])
            begin, stop = starts[low:high] - at, ends[low:high] - at
            out[low:high] = mix((sums[stop] - sums[begin]) * self.inverses[begin])
            low = high
        return out

    @staticmethod
    def windows(hashes: np.ndarray, length: int) -> np.ndarray:
        """The hash of each window of `length` consecutive hashes, across texts; the caller leaves out mixed ones."""
        count = len(hashes) - length + 1
        if count <= 0:
            return np.zeros(0, np.uint64)
        total = np.full(count, length, np.uint64)
        for k in range(length):
            total = total * BASE + hashes[k : k + count]
        return mix(total)


def window_rows(words: Words, length: int) -> np.ndarray:
    """For each window of `length` words over all texts: does it lie in one text?"""
    count = max(0, int(words.first[-1]) - length + 1)
    last = np.repeat(words.first[1:], words.counts())[:count]
    return np.arange(count) + length <= last


ship_by_value(__name__)

"""Byte-level BPE as a tree reduction: texts are encoded in halves, and neighbours are joined at a window.

A text is cut into leaves; each leaf is encoded on its own. Two neighbours are joined by encoding a window around the
cut anew. The window grows until it begins and ends at a safe point: a white space character after another character.
No match of the splitting pattern crosses such a point, whatever stands before or after it, and what a match takes
depends on at most the character after it. So tokens before the left safe point and after the right one cannot change,
and the window's own tokens are those of the whole text. Without a safe point the window grows to the whole half.
Decoding joins the bytes of the halves up the same tree.

Defined results: null and empty texts have no tokens, their digests are those of the empty string. Lone surrogates
cannot occur in Spark strings. Special tokens are ordinary text. Repeated rows give repeated rows; an absent id stays
null; only the named columns are read by `encode`, and `encoded_documents` names its own outputs last, in place of
equal names of the input.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from metaloom.shipping import ship_by_value

LEAF_CHARS = 8192
FIRST_WINDOW = 64
#: White space in every definition of it; other blanks are no safe point, which only makes a window longer.
BLANKS = " \t\n\r"


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: one base64 token and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Codec:
    """Encodes and decodes whole texts by tree reduction."""

    def __init__(self, path: str, pattern: str, leaf_chars: int = LEAF_CHARS) -> None:
        import tiktoken

        ranks = read_ranks(path)
        self.leaf_chars = max(1, leaf_chars)
        self.leaf = tiktoken.Encoding(
            "ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        ).encode_ordinary
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.sizes = [len(t) for t in self.tokens]

    def encode(self, text: str) -> list[int]:
        return self._node(text, 0, len(text))

    def _node(self, text: str, low: int, high: int) -> list[int]:
        if high - low <= self.leaf_chars:
            return self.leaf(text[low:high])
        cut = (low + high) // 2
        return self._join(text, low, cut, high, self._node(text, low, cut), self._node(text, cut, high))

    def _join(self, text: str, low: int, cut: int, high: int, left: list[int], right: list[int]) -> list[int]:
        """The tokens of `text[low:high]` from those of its halves."""
        begin, end = self._safe_before(text, low, cut), self._safe_after(text, cut, high)
        kept_left = self._count_from_end(left, len(text[begin:cut].encode()))
        kept_right = self._count_from_start(right, len(text[cut:end].encode()))
        return left[:kept_left] + self.leaf(text[begin:end]) + right[kept_right:]

    @staticmethod
    def _safe_before(text: str, low: int, cut: int) -> int:
        """The last safe point in `text[low:cut]`, searched in a growing window; `low` if there is none."""
        size = FIRST_WINDOW
        while True:
            start = max(low, cut - size)
            for p in range(cut - 1, start, -1):
                if text[p] in BLANKS and not text[p - 1].isspace():
                    return p
            if start == low:
                return low
            size *= 2

    @staticmethod
    def _safe_after(text: str, cut: int, high: int) -> int:
        """The first safe point in `text[cut:high]`; `high` if there is none."""
        for p in range(cut + 1, high):
            if text[p] in BLANKS and not text[p - 1].isspace():
                return p
        return high

    def _count_from_end(self, ids: list[int], size: int) -> int:
        k = len(ids)
        while size > 0:
            k -= 1
            size -= self.sizes[ids[k]]
        return k

    def _count_from_start(self, ids: list[int], size: int) -> int:
        k = 0
        while size > 0:
            size -= self.sizes[ids[k]]
            k += 1
        return k

    def decode(self, ids: list[int]) -> bytes:
        """Bytes of the halves, joined up the tree."""
        if len(ids) <= self.leaf_chars:
            return b"".join(map(self.tokens.__getitem__, ids))
        cut = len(ids) // 2
        return self.decode(ids[:cut]) + self.decode(ids[cut:])


def _digests(path: str, pattern: str, leaf_chars: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(path, pattern, leaf_chars)
        decimal = [str(i) for i in range(len(codec.tokens))]
        for batch in batches:
            counts, ids_sha, decoded_sha = [], [], []
            for cell in batch.column("text"):
                ids = codec.encode(cell.as_py() or "")
                counts.append(len(ids))
                ids_sha.append(hashlib.sha256(" ".join(map(decimal.__getitem__, ids)).encode()).hexdigest())
                decoded_sha.append(hashlib.sha256(codec.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(decoded_sha, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return rows


def encode_digests(docs: DataFrame, path: str, pattern: str, leaf_chars: int = LEAF_CHARS) -> DataFrame:
    """Per document: number of tokens, digest of the ids and digest of the bytes that the ids decode to."""
    given = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    return given.mapInArrow(
        _digests(path, pattern, leaf_chars), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def _ids(path: str, pattern: str, leaf_chars: int, places: list[int], text_place: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(path, pattern, leaf_chars)
        for batch in batches:
            texts = batch.column(text_place)
            # A few hundred texts at a time: the ids of a whole batch would be many times its text.
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                ids = [np.asarray(codec.encode(t.as_py() or ""), dtype=np.int32) for t in texts.slice(low, 256)]
                counts = [len(i) for i in ids]
                cells = pa.array(ids, pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(p) for p in places], pa.array(counts, pa.int64()), cells],
                    [*[batch.schema.names[p] for p in places], "n_tokens", "ids"],
                )

    return rows


def encoded_documents(docs: DataFrame, path: str, pattern: str, text: str = "text", leaf_chars: int = LEAF_CHARS) -> DataFrame:
    """The rows of `docs` without their text, with `n_tokens` and `ids`."""
    places = [i for i, c in enumerate(docs.columns) if c not in (text, "n_tokens", "ids")]
    added = T.StructType.fromDDL("n_tokens long, ids array<int>").fields
    schema = T.StructType([docs.schema[i] for i in places] + added)
    return docs.mapInArrow(_ids(path, pattern, leaf_chars, places, docs.columns.index(text)), schema)


def decoded_texts(rows: DataFrame, path: str, pattern: str, ids: str = "ids", leaf_chars: int = LEAF_CHARS) -> DataFrame:
    """`doc_id` and `text` from token ids; bytes that are no UTF-8 become replacement characters. Null ids: null text."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(path, pattern, leaf_chars)
        for batch in batches:
            texts = [
                None if cell is None else codec.decode(cell).decode("utf-8", "replace")
                for cell in batch.column("ids").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    given = rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(ids).alias("ids"))
    return given.mapInArrow(decode, "doc_id long, text string")


ship_by_value(__name__)

"""License scans: exact phrases, and short notices with a few edits.

With k edits allowed, a notice cut into k + 1 pieces has at least one piece untouched in every occurrence. One automaton
finds all pieces in a text; around each seed the window that can hold the notice is searched with a bounded-error
pattern, which verifies the edits and gives the span. Case of A to Z and the kind of white space do not count.

Defined results: a null text counts as empty and has no words, labels or spans, score 0. Of overlapping fuzzy spans of
one label the one with fewest edits stays, then the first; among overlapping spans of different labels only those
with fewest edits stay. Positions of spans are code points, end exclusive. Repeated rows give repeated rows; only the
named columns are read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from metaloom.llm.wordscan import Texts, find_words, item_bytes, lower_bytes, slices
from metaloom.shipping import ship_by_value

#: Phrases of the base rule and their labels.
PHRASES = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]
#: Short notices of public licenses, lower case, single blanks, and the label of each.
NOTICES = [
    ("released under the mit license", "mit"),
    ("permission is hereby granted, free of charge, to any person obtaining a copy", "mit"),
    ("licensed under the apache license, version 2.0", "apache"),
    ("licensed under the gnu general public license", "gpl"),
    ("this program is free software: you can redistribute it and/or modify", "gpl"),
    ("redistribution and use in source and binary forms, with or without modification", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license", "mpl"),
    ("permission to use, copy, modify, and/or distribute this software for any purpose", "isc"),
    ("licensed under cc by 4.0", "cc-by"),
    ("licensed under cc by-nc 4.0", "cc-by-nc"),
    ("licensed under cc by-sa 4.0", "cc-by-sa"),
    ("creative commons attribution", "cc-by"),
    ("all rights reserved", "all-rights-reserved"),
]
#: One edit per so many characters of a notice, one at least.
CHARS_PER_EDIT = 12
#: Spans are compared with those in the same blocks of so many characters.
BLOCK_CHARS = 128
#: Windows whose matches a task keeps in mind.
KNOWN_WINDOWS = 4096


def edits_of(notice: str) -> int:
    return max(1, len(notice) // CHARS_PER_EDIT)


def pieces_of(notice: str) -> list[tuple[int, str]]:
    """`edits + 1` pieces with their places; together they are the notice."""
    n = edits_of(notice) + 1
    cuts = [round(i * len(notice) / n) for i in range(n + 1)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:])]


class Scanner:
    """Finds notices with few edits in lower-cased texts."""

    def __init__(self, notices: list[tuple[str, str]]) -> None:
        import ahocorasick
        import regex

        self.notices = notices
        self.patterns = [
            regex.compile(f"(?b)(?:{regex.escape(text, literal_spaces=True)}){{e<={edits_of(text)}}}") for text, _ in notices
        ]
        seeds: dict[str, list[tuple[int, int]]] = {}
        for k, (text, _) in enumerate(notices):
            for at, piece in pieces_of(text):
                seeds.setdefault(piece, []).append((k, at))
        self.counts = [(Counter(text), Counter(zip(text, text[1:]))) for text, _ in notices]
        self.known: dict[tuple[int, str], list[tuple[int, int, int]]] = {}
        self.automaton = ahocorasick.Automaton()
        for piece, owners in seeds.items():
            self.automaton.add_word(piece, (len(piece), owners))
        self.automaton.make_automaton()

    def windows(self, text: str) -> list[tuple[int, int, int]]:
        """(notice, begin, end) of the places that can hold a notice: one around each seed, each once."""
        found = set()
        for last, (size, owners) in self.automaton.iter(text):
            for k, at in owners:
                notice = self.notices[k][0]
                begin = last - size + 1 - at
                spare = edits_of(notice)
                found.add((k, max(0, begin - spare), min(begin + len(notice) + spare, len(text))))
        return sorted(found)

    def _possible(self, k: int, window: str) -> bool:
        """Can the window hold the notice? An edit takes at most one character of it, and two of its pairs."""
        edits = edits_of(self.notices[k][0])
        chars, pairs = self.counts[k]
        if sum(max(0, n - window.count(c)) for c, n in chars.items()) > edits:
            return False
        own = Counter(zip(window, window[1:]))
        return sum(max(0, n - own[pair]) for pair, n in pairs.items()) <= 2 * edits

    def matches(self, k: int, window: str) -> list[tuple[int, int, int]]:
        """(start, end, edits) in a window: its best match first, then what lies on both sides of it in turn.

        Repeated text has equal windows, so the last results are kept.
        """
        if (k, window) in self.known:
            return self.known[k, window]
        found, open_parts = [], [(0, len(window))] if self._possible(k, window) else []
        while open_parts:
            begin, end = open_parts.pop()
            match = self.patterns[k].search(window, begin, end)
            if match and match.end() > match.start():
                found.append((match.start(), match.end(), sum(match.fuzzy_counts)))
                open_parts += [(begin, match.start()), (match.end(), end)]
        if len(self.known) >= KNOWN_WINDOWS:
            self.known.clear()
        self.known[k, window] = found
        return found

    def spans(self, text: str) -> list[tuple[int, int, str, int, float]]:
        """(start, end, label, edits, score) by start; what overlaps is settled by fewest edits."""
        hits = set()
        for k, low, high in self.windows(text):
            notice, label = self.notices[k]
            for start, end, edits in self.matches(k, text[low:high]):
                hits.add((low + start, low + end, label, edits, 1 - edits / len(notice)))
        kept: list = []
        # Spans that stay, by each block of characters that they reach into: rivals share a block.
        near: dict[int, list] = {}
        for h in sorted(hits, key=lambda h: (h[3], h[0], h[1], h[2])):
            blocks = range(h[0] // BLOCK_CHARS, (h[1] - 1) // BLOCK_CHARS + 1)
            rivals = [x for b in blocks for x in near.get(b, ()) if x[0] < h[1] and h[0] < x[1]]
            if all(x[3] == h[3] and x[2] != h[2] for x in rivals):
                kept.append(h)
                for b in blocks:
                    near.setdefault(b, []).append(h)
        return sorted(kept)


def phrase_places(text: str, phrases: list[tuple[str, str]] = PHRASES) -> tuple[list[int], set[str]]:
    """Word places where a phrase's words stand one after the other, and the labels; `text` is lower-cased."""
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", text)
    places, labels = [], set()
    for phrase, label in phrases:
        wanted = phrase.split(" ")
        for i, word in enumerate(words):
            if word == wanted[0] and words[i : i + len(wanted)] == wanted:
                places.append(i)
                labels.add(label)
    return places, labels


def _found(phrases: list, notices: list):
    blanks = bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")
    span = pa.list_(
        pa.struct([("start", pa.int64()), ("end", pa.int64()), ("label", pa.string()), ("edits", pa.int32())])
    )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner, table, low_table = Scanner(notices), item_bytes(), lower_bytes()
        heads = {p.split(" ")[-1].encode() for p, _ in phrases}
        for batch in batches:
            for low, high, texts in slices(batch.column("text")):
                data = low_table[texts.data]
                counts = find_words(Texts(data, texts.offsets), table).counts()
                raw = data.tobytes()
                out: list[tuple] = []
                for i in range(high - low):
                    own = raw[texts.offsets[i] : texts.offsets[i + 1]]
                    places, labels = phrase_places(own.decode(), phrases) if any(h in own for h in heads) else ([], set())
                    fuzzy = scanner.spans(own.translate(blanks).decode())
                    every = labels | {s[2] for s in fuzzy}
                    score = 1.0 if places else max([0.0, *(s[4] for s in fuzzy)])
                    out.append((
                        len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)),
                        ",".join(sorted(every)), float(score), [dict(zip(("start", "end", "label", "edits"), s)) for s in fuzzy],
                    ))
                columns = list(zip(*out))
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), span]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(low, high - low), pa.array(np.asarray(counts), pa.int64()), *map(pa.array, columns, kinds)],
                    ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"],
                )

    return rows


def scan(docs: DataFrame, phrases: list = PHRASES, notices: list = NOTICES) -> DataFrame:
    """Words, base places, labels, score and fuzzy spans per document."""
    given = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    return given.mapInArrow(
        _found(phrases, notices),
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
        "score double, spans array<struct<start: long, end: long, label: string, edits: int>>",
    )


ship_by_value(__name__)

"""Repeated byte strings against a dictionary of all windows."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from metaloom.llm import repeats

DOCS = "doc_id long, text string, key string, at long, n long"


def brute(texts, length):
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        gone = np.zeros(len(r) + 1, bool)
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                gone[i : i + length] = True
        spans = int((gone[:-1] & ~np.concatenate([[False], gone[:-2]])).sum()) if len(r) else 0
        kept = bytes(b for b, g in zip(r, gone) if not g)
        out.append((len(r), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def corpus():
    rng = random.Random(12)
    prose = lambda n: "".join(rng.choice("abcdefgh é") for _ in range(n))
    shared = [prose(k) for k in (399, 400, 401, 450, 700, 1500, 3000)]
    texts = [None, "", "short", prose(400), prose(2000)]
    for s in shared:
        for _ in range(3):
            texts.append(prose(rng.randrange(600)) + s + prose(rng.randrange(600)))
    texts += [shared[3][:430] + prose(50), prose(3) + shared[5] + shared[4], shared[6], shared[6], shared[6][1:], shared[6][:-1]]
    # Near copies with a change every 150, 390, 410 and 900 bytes; runs, short periods, a repeat inside one text.
    for step in (150, 390, 410, 900):
        other = list(shared[6])
        for i in range(step // 2, 3000, step):
            other[i] = "Z"
        texts.append("".join(other))
    texts += ["a" * 1000, "a" * 400, "a" * 399, "ab" * 700, "abc" * 140 + prose(200), "x" + prose(500) * 2]
    return texts


def found(spark, texts, length=repeats.LENGTH, parts=4):
    df = spark.createDataFrame([(i, t, "k", 1, 2) for i, t in enumerate(texts)], DOCS).repartition(parts)
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in repeats.kept_digests(df, length).collect()}
    return [got[i] for i in range(len(texts))]


@pytest.mark.parametrize("parts", [1, 7])
def test_repeats_against_all_windows(spark, parts):
    texts = corpus()
    assert found(spark, texts, parts=parts) == brute(texts, 400)


def test_short_windows_on_few_letters(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice("ab") for _ in range(rng.randrange(200))) for _ in range(60)]
    texts += ["".join(rng.choice("ab") for _ in range(40)) * 3, "b" * 100]
    assert found(spark, texts, length=20) == brute(texts, 20)


def test_long_texts_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(repeats, "PIECE", 700)
    texts = [t for t in corpus() if t and len(t) > 300][:24] + ["a" * 5000]
    assert found(spark, texts) == brute(texts, 400)


def test_texts_and_spans(spark):
    passage = "".join(random.Random(1).choice("abcdef") for _ in range(500))
    df = spark.createDataFrame([(1, "x" + passage + "é", "k", 1, 1), (2, passage, "k", 1, 1), (3, "own", "k", 1, 1)], DOCS)
    got = {r["doc_id"]: r for r in repeats.without_repeats(df).collect()}
    assert [tuple(s) for s in got[1]["spans"]] == [(1, 501)] and got[1]["kept"].decode() == "xé"
    assert got[2]["kept"] == b"" and got[3]["spans"] is None


def test_empty_table_and_null_ids(spark):
    assert found(spark, []) == []
    rows = repeats.kept_digests(spark.createDataFrame([(None, "a" * 500, "k", 1, 1), (None, None, "k", 1, 1)], DOCS)).collect()
    assert sorted((r["n_bytes"], r["n_removed"]) for r in rows) == [(0, 0), (500, 500)]

"""Spelling variants against plain comparison of all pairs of words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from metaloom.llm import variants

DOCS = "doc_id long, text string, n long, word string, seq long"


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def counted(rows, every=None) -> Counter:
    out = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if every and h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            out[run] += 1
    return out


def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows, every=None, ratio=5) -> dict:
    n = {w: c for w, c in counted(rows, every).items() if len(w) >= 6 and c >= 5}
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None)
    return out


def found(df) -> dict:
    rows = df.collect()
    assert len({r["word"] for r in rows}) == len(rows)
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}


def corpus():
    rng = random.Random(11)
    base = ["planet", "letters", "aaaaaaa", "ÉTUDEaé", "öffnung", "committee", "bookkeeper", "xyÿÀ÷×ab"]
    words = []
    for b in base:
        words += [b] * 200
        for _ in range(12):
            k, c = rng.randrange(len(b)), rng.choice("abeéÿz")
            words += [rng.choice([b[:k] + b[k + 1 :], b[:k] + c + b[k:], b[:k] + c + b[k + 1 :]])] * rng.choice([1, 4, 5, 6, 40])
    # A chain of three steps, ties among the best, and a very long word.
    words += ["chains"] * 5 + ["chainsa"] * 25 + ["chainsab"] * 125 + ["chainsabc"] * 625
    words += ["tieone"] * 5 + ["tieona"] * 30 + ["tieonb"] * 30 + ["short"] * 9
    words += ["l" * 30000] * 5 + ["l" * 29999 + "m"] * 25
    rng.shuffle(words)
    rows = [(i % 40 if i % 41 else None, " ".join(words[i::200]) + rng.choice([".", "3x", "\n"])) for i in range(200)]
    return rows + [(1, None), (2, ""), (3, "12 %"), (4, "A-Z_ÀÀÀÀÀÀ")]


@pytest.mark.parametrize("every", [None, 7])
def test_variants_against_all_pairs(spark, every):
    rows = corpus()
    df = spark.createDataFrame([(i, t, 1, "w", 2) for i, t in rows], DOCS).repartition(5)
    assert found(variants.spelling_variants(df, every=every)) == brute(rows, every)


def test_chain_of_forms(spark):
    got = found(variants.spelling_variants(spark.createDataFrame([(i, t, 1, "w", 2) for i, t in corpus()], DOCS)))
    assert got["chains"][:2] == ("chainsa", "chainsabc") and got["tieone"][0] == "tieona"


def test_no_words(spark):
    assert found(variants.spelling_variants(spark.createDataFrame([], DOCS))) == {}
    assert found(variants.spelling_variants(spark.createDataFrame([(1, None, 1, "", 1)], DOCS))) == {}

"""Stars of texts that are nearly, but not all, linked: no link is lost, and unlinked texts are not compared all with all."""

from __future__ import annotations

import itertools
import random

from metaloom.llm import neardup

DOCS = "doc_id long, text string"


def _wanted(rows: list[tuple], width: int, percent: int = 80) -> dict:
    sets = {}
    for i, text in rows:
        words = text.split(" ")
        sets[i] = {tuple(words[k : k + width]) for k in range(len(words) - width + 1)}
    group = {i: i for i in sets}
    for a, b in itertools.combinations(sets, 2):
        if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            x, y = sorted((group[a], group[b]))
            group = {i: x if g == y else g for i, g in group.items()}
    return group


def _found(spark, rows: list[tuple], width: int, percent: int = 80) -> dict:
    got = neardup.near_duplicates(spark.createDataFrame(rows, DOCS), width, percent)
    return {r["doc_id"]: r["component_id"] for r in got.select("doc_id", "component_id").collect()}


def _template(n: int, slots: int, words: int, seed: int, moving: bool = False, name: str = "") -> list[str]:
    """Texts of one template of 300 words; `words` different ones may stand in a slot (0: each only once)."""
    rng = random.Random(seed)
    base = [f"{name}w{k}" for k in range(300)]
    fixed = rng.sample(range(0, 300, 2), slots)
    texts = []
    for i in range(n):
        text = list(base)
        for k in rng.sample(range(0, 300, 2), slots) if moving else fixed:
            text[k] = f"{name}x{rng.randrange(words)}" if words else f"{name}x{i}-{k}"
        texts.append(" ".join(text))
    return texts


def _around_centres(seed: int) -> list[str]:
    """Groups around centres that differ from each other by about as much as a link allows."""
    rng = random.Random(seed)
    texts, base = [], [f"s{seed}w{k}" for k in range(120)]
    for centre in range(6):
        middle = list(base)
        for _ in range(rng.randrange(4, 9)):
            middle[rng.randrange(120)] = f"s{seed}c{centre}-{rng.randrange(9)}"
        for _ in range(20):
            text = list(middle)
            for _ in range(rng.randrange(6)):
                text[rng.randrange(120)] = f"s{seed}y{rng.randrange(12)}"
            cut = rng.randrange(120)
            texts.append(" ".join(text[:cut] + text[cut + rng.randrange(8) :]))
    return texts


def _rows(*parts: list[str]) -> list[tuple]:
    texts = [t for part in parts for t in part]
    random.Random(0).shuffle(texts)
    return list(enumerate(texts))


def test_stars_at_the_edge_of_a_link(spark):
    shapes = [(17, 0), (17, 5), (20, 40), (12, 3)]
    templates = [
        _template(80, slots, words, slots + words, moving, f"{slots}-{words}-{moving}-")
        for (slots, words), moving in itertools.product(shapes, [False, True])
    ]
    rows = _rows(*templates, *[_around_centres(seed) for seed in range(4)])
    wanted = _wanted(rows, 2)
    assert _found(spark, rows, 2) == wanted and 12 < len(set(wanted.values())) < len(rows)


def test_another_similarity_and_an_element_of_many_members(spark, monkeypatch):
    monkeypatch.setattr(neardup, "HOT", 7)
    rows = _rows(_template(90, 30, 4, 5, moving=True), _around_centres(9))
    assert _found(spark, rows, 2, 67) == _wanted(rows, 2, 67)


def test_unlinked_texts_of_a_template_meet_nowhere(spark, monkeypatch):
    """Every pair lies just below a link: a text is compared with the hubs of its buckets, and with nothing else."""
    compared = []
    plain = neardup._Links.test

    def counted(self, pairs):
        compared.append(pairs.distinct().count())
        plain(self, pairs)

    monkeypatch.setattr(neardup._Links, "test", counted)
    for n in (300, 2400):
        compared.clear()
        rows = _rows(_template(n, 18, 0, 1))
        assert _found(spark, rows, 2) == {i: i for i in range(n)}
        assert compared[0] <= neardup.BANDS * n and compared[1] == 0


def test_components_of_chains_rings_and_stars(spark):
    """Links dealt over partitions at random: a long chain, a ring, a star, a repeated link, and stars from the start."""
    rng = random.Random(3)
    chain = [(i, i + 1) for i in range(1000, 1300)]
    ring = [(i, i + 1) for i in range(10, 40)] + [(10, 40)]
    star = [(500, 500 + i) for i in range(1, 200)]
    for links in [chain + ring + star + ring[:5], star, []]:
        wanted = {v: 500 for _, v in star} if links else {}
        if len(links) > len(star):
            wanted |= {v: 1000 for _, v in chain} | {v: 10 for v in range(11, 41)}
        names = list(range(1000, 1301))
        rng.shuffle(names)
        # The chain's ids in any order; its smallest id is still 1000.
        renamed = [tuple(sorted(names[x - 1000] if 1000 <= x <= 1300 else x for x in p)) for p in links]
        rng.shuffle(renamed)
        given = spark.createDataFrame(renamed, "a long, b long").repartition(7)
        got = [(r["v"], r["c"]) for r in neardup.components(given).collect()]
        assert len(got) == len(wanted) and dict(got) == wanted

"""Near-duplicates: SuperMinHash signatures, banding, verification on full shingle sets, union-find grouping.

SuperMinHash draws one random permutation of the signature's slots per shingle, step by step; the value of step j lies
in [j, j + 1), so a text is finished as soon as every slot holds a value below the next step. Rows of the signature are
hashed in bands. Texts with equal shingle sets form a class, and only class representatives go on.

Each bucket of a band is compared with one of its members, its hub, never all with all. Where members of a star of hub
and bucket mates are still in different groups afterwards, further pairs are compared only if exact bounds on
the overlap leave a link possible (`_remaining`). Every link is confirmed on the full sets. Groups come from union-find
inside partitions and min-label star steps between them.

Defined results: null and empty texts, and texts without words, have an empty set, are linked with nothing, and are
their own component; a text with fewer words than a shingle has its whole sequence as the only shingle. Rows without an
id are linked with nothing: no component, kept. Ids are taken to be unique; rows that repeat an id are each judged by
their own text. Only the named columns are read; `one_of_each` keeps all columns of its input.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from metaloom.functions.bind import shuffled
from metaloom.llm.landing import land, unused
from metaloom.llm.wordscan import BASE, Hasher, Texts, find_words, lower_bytes, mix, slices, spaced_bytes
from metaloom.shipping import ship_by_value

BANDS, ROWS = 32, 4
SLOTS = BANDS * ROWS
PERCENT = 80
#: About so many members of a star, by hash, tell what most of it have in common. It decides only how many pairs are tried.
SAMPLE = 64
#: So many members of a star that share an element are met in one part; more take more parts.
HOT = 1024
_STEP = np.uint64(56)


def elements(texts: Texts, width: int, hasher: Hasher) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of every text as hashes, by text, and the text of each."""
    data = lower_bytes()[texts.data]
    words = find_words(Texts(data, texts.offsets), spaced_bytes())
    hashes, counts = hasher.runs(data, words.starts, words.ends), words.counts()
    shingles, owners = [], []
    for length in range(1, width + 1):
        own = counts >= width if length == width else counts == length
        if own.any() and len(hashes) >= length:
            held = np.repeat(np.where(own, words.first[1:], -1), counts)[: len(hashes) - length + 1]
            at = np.flatnonzero(np.arange(len(held)) + length <= held)
            shingles.append(hasher.windows(hashes, length)[at])
            owners.append(np.repeat(np.arange(len(texts)), counts)[at])
    if not shingles:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    shingle, owner = np.concatenate(shingles), np.concatenate(owners)
    _, at = np.unique(salted(shingle, owner), return_index=True)
    at = at[np.argsort(owner[at], kind="stable")]
    return shingle[at], owner[at]


def salted(shingle: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Shingles made different from text to text."""
    return mix(shingle ^ mix(owner.astype(np.uint64) + np.uint64(1)))


def super_min_hash(shingle: np.ndarray, owner: np.ndarray, n: int, slots: int = SLOTS) -> np.ndarray:
    """Signatures of `n` sets. All shingles of unfinished sets take step j together."""
    out = np.full((n, slots), np.iinfo(np.uint64).max, np.uint64)
    flat, swaps = out.reshape(-1), []
    for j in range(slots):
        if not len(shingle):
            break
        draw = mix(shingle + np.uint64((2 * j + 1) * int(BASE) % (1 << 64)))
        pick = j + (mix(draw ^ BASE) >> np.uint64(11)).astype(np.int64) % (slots - j)
        # The slot that a Fisher-Yates shuffle puts at j: follow the swaps back to where its content came from.
        slot = pick.copy()
        for i in range(j - 1, -1, -1):
            slot[slot == swaps[i]] = i
        swaps.append(pick)
        value = (np.uint64(j) << _STEP) | (draw >> np.uint64(8))
        np.minimum.at(flat, owner * slots + slot, value)
        open_sets = np.unique(owner)
        done = out[open_sets].max(axis=1) < np.uint64(j + 1) << _STEP
        if done.any():
            finished = np.zeros(n, bool)
            finished[open_sets[done]] = True
            left = ~finished[owner]
            shingle, owner, swaps = shingle[left], owner[left], [s[left] for s in swaps]
    return out


def bands_of(signatures: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One key per band; keys of different bands do not meet."""
    keys = np.empty((len(signatures), bands), np.uint64)
    for b in range(bands):
        key = np.full(len(signatures), b + 1, np.uint64)
        for r in range(rows):
            key = mix(key * BASE + signatures[:, b * rows + r])
        keys[:, b] = key
    return keys


def _signed(width: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for low, high, texts in slices(batch.column(1)):
                n = high - low
                shingle, owner = elements(texts, width, hasher)
                counts = np.bincount(owner, minlength=n)
                prints = []
                for seed in (0x51, 0xA7):
                    sums = np.zeros(len(shingle) + 1, np.uint64)
                    np.cumsum(mix(shingle ^ np.uint64(seed)), out=sums[1:])
                    cut = np.concatenate(([0], np.cumsum(counts)))
                    prints.append(sums[cut[1:]] - sums[cut[:-1]])
                keys = bands_of(super_min_hash(shingle, owner, n))
                full = counts > 0
                sizes = np.where(full, BANDS, 0)
                held = pa.ListArray.from_arrays(
                    pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()),
                    pa.array(keys[full].reshape(-1).view(np.int64)),
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(low, n),
                        batch.column(2).slice(low, n),
                        pa.array(counts, pa.int64()),
                        *[pa.array(p.view(np.int64)) for p in prints],
                        held,
                    ],
                    ["id", "own", "n", "f1", "f2", "bands"],
                )

    return rows


def _confirmed(width: int, percent: int):
    """(a, b, linked) of pairs with both texts."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            other = pa.chunked_array([batch.column("text_b")])
            for low, high, left in slices(batch.column("text_a")):
                n = high - low
                sides = [elements(left, width, hasher)]
                counts, keys = np.bincount(sides[0][1], minlength=n), [salted(*sides[0])]
                right_count = np.zeros(n, np.int64)
                for lo, hi, right in slices(other.slice(low, n)):
                    shingle, owner = elements(right, width, hasher)
                    right_count[lo:hi] = np.bincount(owner, minlength=hi - lo)
                    keys.append(salted(shingle, owner + lo))
                both = np.concatenate(keys)
                owners = np.concatenate([sides[0][1], np.repeat(np.arange(n), right_count)])
                order = np.argsort(both)
                again = both[order[1:]] == both[order[:-1]]
                common = np.bincount(owners[order[1:]][again], minlength=n)
                union = counts + right_count - common
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("a").slice(low, n),
                        batch.column("b").slice(low, n),
                        pa.array((100 * common >= percent * union) & (union > 0)),
                    ],
                    ["a", "b", "linked"],
                )

    return rows


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over the links of one partition: each id with the smallest id that it reaches there."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    pairs = [(x, root(x)) for x in parent]
    pairs = [p for p in pairs if p[0] != p[1]]
    if pairs:
        v, c = zip(*pairs)
        yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()), pa.array(c, pa.int64())], ["v", "c"])


def _stars(edges: DataFrame) -> bool:
    """Whether every id points to one other id, which points to none."""
    ends = edges.select(F.col("v").alias("x"), F.lit(1).alias("down")).union(edges.select("c", F.lit(0)))
    ends = ends.groupBy("x").agg(F.sum("down").alias("down"), F.min("down").alias("least"))
    return ends.filter("down > 1 or down = 1 and least = 0").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(v, c) for every id that is linked with a smaller one: c is the smallest id that it reaches.

    Large-star and small-star steps, each two hash aggregates and joins on plain scans, so hot ids can be split.
    """
    edges = land(links.select("a", "b").mapInArrow(_forest, "v long, c long"), "forest")
    while not _stars(edges):
        both = edges.union(edges.select("c", "v"))
        least = land(both.groupBy("v").agg(F.min("c").alias("m")).withColumn("m", F.least("v", "m")), "least")
        large = both.filter("c > v").join(shuffled(least), "v").select(F.col("c").alias("v"), F.col("m").alias("c"))
        large = land(large.filter("v <> c").distinct(), "large")
        least = land(large.groupBy("v").agg(F.min("c").alias("m")), "least")
        small = large.join(shuffled(least), "v").select(F.col("c").alias("v"), F.col("m").alias("c"))
        edges = land(small.filter("v <> c").union(least).distinct(), "edges")
    return edges


class _Links:
    """Candidate pairs of one run and what is known about them."""

    def __init__(self, texts: DataFrame, width: int, percent: int) -> None:
        self.texts, self.width, self.percent = texts, width, percent
        self.tested: DataFrame | None = None
        self.groups: DataFrame | None = None

    def test(self, pairs: DataFrame) -> None:
        """Confirm pairs (a < b, each once), leave out those tested before, and bring the groups up to date."""
        if self.tested is not None:
            pairs = pairs.join(shuffled(self.tested.select("a", "b")), ["a", "b"], "left_anti")
        right = self.texts.select(F.col("rep").alias("b"), F.col("text").alias("text_b"))
        left = self.texts.select(F.col("rep").alias("a"), F.col("text").alias("text_a"))
        full = pairs.join(shuffled(right), "b").join(shuffled(left), "a")
        found = full.select("a", "b", "text_a", "text_b").mapInArrow(
            _confirmed(self.width, self.percent), "a long, b long, linked boolean"
        )
        found = land(found, "tested")
        links = found.filter("linked").select("a", "b")
        if self.groups is None:
            self.groups = components(links)
        elif not links.isEmpty():
            # Known groups count as links of their members with the smallest one.
            self.groups = components(self.groups.select(F.col("c").alias("a"), F.col("v").alias("b")).union(links))
        self.tested = found if self.tested is None else self.tested.union(found)


def _pair(x: str, y: str) -> list:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _sampled(width: int):
    """(hub, taken, element): the shingles of some members of a star, and how many members these are."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            hubs, taken = [batch.column(k).to_numpy(zero_copy_only=False) for k in ("hub", "taken")]
            for low, _, texts in slices(batch.column("text")):
                shingle, owner = elements(texts, width, hasher)
                columns = [hubs[low + owner], taken[low + owner], shingle.view(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["hub", "taken", "element"])

    return rows


def _against(width: int):
    """Per member of a star: the shingles in which it differs from the star's usual set, either way."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            usual = batch.column("usual")
            for low, high, texts in slices(batch.column("text")):
                n = high - low
                shingle, owner = elements(texts, width, hasher)
                own = usual.slice(low, n)
                held = own.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
                holder = np.repeat(np.arange(n), [len(u) if u.is_valid else 0 for u in own])
                mine, theirs = salted(shingle, owner), salted(held, holder)
                more, lacked = ~np.isin(mine, theirs), ~np.isin(theirs, mine)
                differs = np.concatenate([shingle[more], held[lacked]])
                whose = np.concatenate([owner[more], holder[lacked]])
                counts = np.bincount(whose, minlength=n)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32()),
                    pa.array(differs[np.argsort(whose, kind="stable")].view(np.int64)),
                )
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(k).slice(low, n) for k in ("hub", "rep", "n", "c", "main")], lists],
                    ["hub", "rep", "n", "c", "main", "differs"],
                )

    return rows


def link(docs: DataFrame, width: int, percent: int = PERCENT) -> DataFrame:
    """`id`, `n_shingles`, `component` per row of `docs` (doc_id, text): components of links of `percent` similarity."""
    given = docs.select(
        F.col("doc_id").cast("long").alias("id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).withColumn("own", F.xxhash64("text"))
    signed = land(
        given.select("id", "text", "own").mapInArrow(
            _signed(width), "id long, own long, n long, f1 long, f2 long, bands array<long>"
        ),
        "signed",
    )
    full = signed.filter("n > 0 and id is not null")
    first = F.min(F.struct("id", "own")).alias("first")
    classes = full.groupBy("f1", "f2", "n").agg(first, F.first("bands").alias("bands"))
    classes = land(classes.select("f1", "f2", "n", "first.id", "first.own", "bands").withColumnRenamed("id", "rep"), "classes")
    keyed = classes.select("rep", "own", "n", F.explode("bands").alias("key"))
    hubs = keyed.groupBy("key").agg(
        F.min("rep").alias("hub"), F.min_by("n", "rep").alias("m"), F.max("rep").alias("top")
    )
    hubs = land(hubs.filter("hub <> top").drop("top"), "hubs")
    star = land(keyed.join(shuffled(hubs), "key").select("hub", "m", "rep", "own", "n").distinct(), "star")
    # A text has a row for each of its buckets at most, so none is hot here.
    involved = star.select(F.col("rep").alias("id"), "own")
    texts = given.join(shuffled(involved), ["id", "own"], "left_semi")
    links = _Links(land(texts.select(F.col("id").alias("rep"), "text"), "texts"), width, percent)
    possible = 100 * F.least("n", "m") >= percent * F.greatest("n", "m")
    # A hub is the smallest id of its bucket, so each of these pairs stands here once.
    links.test(star.filter("rep <> hub").filter(possible).select(F.col("hub").alias("a"), F.col("rep").alias("b")))
    links.test(_remaining(star.select("hub", "rep", "n"), links.groups, links.texts, width, percent).distinct())
    return _joined(signed, classes, links.groups)


def _remaining(star: DataFrame, groups: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs of a star in different groups that join all groups which links inside the star join.

    Members are described by the elements D in which they differ from a usual set of their star, which most of a small
    sample share. Whatever that set is, two members differ in |D1| + |D2| - 2 |D1 and D2| elements, and are linked if these
    are at most (100 - percent) / (100 + percent) of their summed sizes. With the excess e of a member, which is
    (100 + percent) |D| - (100 - percent) n, that reads: 2 (100 + percent) |D1 and D2| >= e1 + e2. So

    - members with e1 + e2 <= 0 are linked, and each of them also with the member of least excess: one pair a member;
    - all others share an element of D. With these ordered from rare to frequent, the first one that two members share has
      as many behind it, itself included, as the link needs, in both. Pairs are met at such elements only (`_met`) and
      judged by their whole D before any text is read again.
    """
    known = star.join(shuffled(groups.select(F.col("v").alias("rep"), "c")), "rep", "left")
    known = land(known.withColumn("c", F.coalesce("c", "rep")), "known")
    kinds = known.groupBy("hub", "c").agg(F.count("*").alias("k")).groupBy("hub")
    mixed = kinds.agg(F.max_by("c", F.struct("k", "c")).alias("main"), F.sum("k").alias("size"), F.count("*").alias("kinds"))
    mixed = land(mixed.filter("kinds > 1").drop("kinds"), "mixed")
    stars = land(known.join(shuffled(mixed), "hub"), "stars")
    place = F.expr("pmod(xxhash64(hub, rep), 1000000) / 1000000d")
    taken = F.count("*").over(Window.partitionBy("hub")).alias("taken")
    some = stars.filter(place < SAMPLE / F.col("size")).select("hub", "rep", taken)
    seen = some.join(shuffled(texts), "rep").select("hub", "taken", "text")
    seen = seen.mapInArrow(_sampled(width), "hub long, taken long, element long")
    seen = seen.groupBy("hub", "element").agg(F.count("*").alias("k"), F.first("taken").alias("taken"))
    usual = land(seen.filter("2 * k > taken").groupBy("hub").agg(F.collect_list("element").alias("usual")), "usual")
    full = stars.join(shuffled(texts), "rep").join(shuffled(usual), "hub", "left")
    facts = full.select("hub", "rep", "n", "c", "main", "text", "usual").mapInArrow(
        _against(width), "hub long, rep long, n long, c long, main long, differs array<long>"
    )
    excess = (100 + percent) * F.size("differs").cast("long") - (100 - percent) * F.col("n")
    facts = land(facts.withColumn("e", excess), "facts")
    least = facts.groupBy("hub").agg(F.min(F.struct("e", "rep", "c")).alias("least"))
    least = land(least.select("hub", F.col("least.e").alias("e2"), F.col("least.rep").alias("rep2"), F.col("least.c").alias("c2")), "least")
    near = facts.select("hub", "rep", "c", "e").join(shuffled(least), "hub").filter("c <> c2 and e + e2 <= 0")
    pairs = _met(facts, least, percent)
    sides = [
        facts.select("hub", F.col("rep").alias(f"rep{i}"), F.col("e").alias(f"e{i}"), F.col("differs").alias(f"differs{i}"))
        for i in "12"
    ]
    judged = pairs.join(shuffled(sides[0]), ["hub", "rep1"]).join(shuffled(sides[1]), ["hub", "rep2"])
    linked = 2 * (100 + percent) * F.size(F.array_intersect("differs1", "differs2")) >= F.col("e1") + F.col("e2")
    return near.select(*_pair("rep", "rep2")).union(judged.filter(linked).select(*_pair("rep1", "rep2")))


def _met(facts: DataFrame, least: DataFrame, percent: int) -> DataFrame:
    """(hub, rep1, rep2): members of different groups that may share enough of their differing elements.

    Members of a star's main group are met with others only. Elements that one group alone has never count. An element
    of many members is dealt out by salt, so no task pairs all of them.
    """
    spread = facts.select("hub", "rep", "n", "c", "main", "e", F.explode("differs").alias("element"))
    common = spread.groupBy("hub", "element").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count("*").alias("k"))
    common = land(common.filter("lo <> hi").select("hub", "element", "k"), "common")
    shared = spread.join(shuffled(common), ["hub", "element"])
    behind = F.row_number().over(Window.partitionBy("hub", "rep").orderBy(F.desc("k"), "element"))
    placed = shared.withColumn("room", 2 * (100 + percent) * behind.cast("long"))
    placed = placed.join(shuffled(least.select("hub", "e2")), "hub").filter("room >= e + e2").drop("e2")
    placed = land(placed.withColumn("parts", F.ceil(F.col("k") / HOT).cast("int")), "placed")
    odd = placed.filter("c <> main").withColumn("part", F.expr("pmod(xxhash64(rep), parts)").cast("int")).drop("k", "parts")
    odd = odd.toDF(*[c if c in ("hub", "main", "element", "part") else f"{c}1" for c in odd.columns])
    every = placed.withColumn("part", F.explode(F.expr("sequence(0, parts - 1)"))).drop("k", "parts", "main")
    every = every.toDF(*[c if c in ("hub", "element", "part") else f"{c}2" for c in every.columns])
    once = F.expr("c1 <> c2 and (c2 = main or rep1 < rep2) and e1 + e2 > 0 and room1 >= e1 + e2 and room2 >= e1 + e2")
    sized = 100 * F.least("n1", "n2") >= percent * F.greatest("n1", "n2")
    met = odd.join(shuffled(every), ["hub", "element", "part"]).filter(once & sized)
    return met.select("hub", "rep1", "rep2").distinct()


def _joined(signed: DataFrame, classes: DataFrame, groups: DataFrame) -> DataFrame:
    named = classes.select("f1", "f2", "n", "rep").join(
        shuffled(groups.select(F.col("v").alias("rep"), "c")), "rep", "left"
    )
    named = named.select("f1", "f2", "n", F.coalesce("c", "rep").alias("component"))
    rows = signed.select("id", "n", "f1", "f2")
    some = F.expr("n > 0 and id is not null")
    linked = rows.filter(some).join(shuffled(named), ["f1", "f2", "n"]).select("id", "n", "component")
    alone = rows.filter(~some).select("id", "n", F.col("id").alias("component"))
    return linked.unionByName(alone).withColumnRenamed("n", "n_shingles")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = PERCENT) -> DataFrame:
    """`doc_id`, `n_shingles`, `component_id`, `kept` per document; the smallest id of a component is kept."""
    found = link(docs, width, percent)
    kept = F.coalesce(F.col("id") == F.col("component"), F.lit(True))
    return found.select(
        F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"), kept.alias("kept")
    )


def one_of_each(docs: DataFrame, width: int = 5, percent: int = PERCENT) -> DataFrame:
    """`docs` with one document of each component. The ids to drop are written, so the planner knows their size."""
    dropped = land(near_duplicates(docs, width, percent).filter("not kept").select("doc_id").distinct(), "dropped")
    name = unused("dropped", docs.columns)
    return docs.join(dropped.withColumnRenamed("doc_id", name), F.col("doc_id").cast("long") == F.col(name), "left_anti")


ship_by_value(__name__)

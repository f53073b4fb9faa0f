"""Documents to quads, parsing, profiles and comparison."""

from __future__ import annotations

import itertools
import json
import os
import random
import time

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from metaloom.functions import terms
from metaloom.operators import labelling, quads
from metaloom.operators.components import components
from metaloom.session import ensure_checkpoint_dir, written
from metaloom.sources.readers import parse_quads, unreadable_quads
from metaloom.sources.writers import quad_line

S = "https://schema.org/"
XSD = terms.XSD


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "line string")


def test_parse_terms(spark):
    rows = parse_quads(
        lines(
            spark,
            '<s> <p> <o> <g> .',
            '_:b1 <p> _:b2 <g> .',
            '<s> <p> "a \\"q\\" \\u00e9\\n" <g> .',
            f'<s> <p> "5"^^<{XSD}integer> <g> .',
            '<s> <p> "hallo"@de-AT <g> .',
            '<s> <p> "no graph" .',
            "# comment",
            "",
            "broken <line>",
            '  <s>  <p> "spaces"   <g>  .  # after',
        )
    ).collect()
    got = [(r.s, r.p, r.value, r.kind, r.datatype, r.language, r.g) for r in rows]
    assert got == [
        ("s", "p", "o", "iri", None, None, "g"),
        ("_:b1", "p", "_:b2", "bnode", None, None, "g"),
        ("s", "p", 'a "q" é\n', "literal", None, None, "g"),
        ("s", "p", "5", "literal", XSD + "integer", None, "g"),
        ("s", "p", "hallo", "literal", None, "de-AT", "g"),
        ("s", "p", "no graph", "literal", None, None, ""),
        ("s", "p", "spaces", "literal", None, None, "g"),
    ]
    bad = unreadable_quads(lines(spark, "# c", "", "broken <line>", "<s> <p> <o> <g> ."))
    assert [r.line for r in bad.collect()] == ["broken <line>"]


def test_long_literals_do_not_overflow(spark):
    body = ('x\\"y' * 50000) + "é" * 50000
    (row,) = parse_quads(lines(spark, f'<s> <p> "{body}" <g> .')).collect()
    assert row.value == body.replace('\\"', '"')


@settings(max_examples=3, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"], exclude_characters="\x00\x01"), max_size=20), min_size=30, max_size=30))
def test_print_and_parse(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, value string")
    none = F.lit(None).cast("string")
    written = df.select(
        F.col("i").cast("string").alias("s"), F.lit("p").alias("p"),
        terms.print_term(F.col("value"), F.lit("literal"), none, none).alias("o"), F.lit("g").alias("g"),
    ).select(quad_line().alias("line"))
    back = {int(r.s): r.value for r in parse_quads(written).collect()}
    assert back == dict(enumerate(texts))


def flat(spark, *docs):
    df = spark.createDataFrame([(f"g{i}", json.dumps(d)) for i, d in enumerate(docs)], "g string, raw string")
    return quads.quads_of_documents(df)


def triples(df):
    return {(r.s, r.p.removeprefix(S), r.o) for r in df.collect()}


def test_named_nodes_and_values(spark):
    doc = {
        "@context": {"@vocab": "https://schema.org/"},
        "@id": "d",
        "@type": ["Dataset", "Thing"],
        "name": "N",
        "free": True,
        "n": 119.0,
        "m": 7.8,
        "k": 12,
        "nothing": None,
        "list": ["a", "b", "a"],
        "creator": [{"@id": "c", "@type": "Person", "name": "C"}, {"@id": "c", "name": "C"}],
        "ref": {"@id": "r"},
        "lit": {"@value": "x", "@language": "en"},
        "@reverse": {"isBasedOn": {"@id": "child", "name": "K"}},
    }
    assert triples(flat(spark, doc)) == {
        ("d", terms.RDF_TYPE, f"<{S}Dataset>"),
        ("d", terms.RDF_TYPE, f"<{S}Thing>"),
        ("d", "name", '"N"'),
        ("d", "free", f'"true"^^<{XSD}boolean>'),
        ("d", "n", f'"119"^^<{XSD}integer>'),
        ("d", "m", f'"7.8E0"^^<{XSD}double>'),
        ("d", "k", f'"12"^^<{XSD}integer>'),
        ("d", "list", '"a"'),
        ("d", "list", '"b"'),
        ("d", "creator", "<c>"),
        ("c", terms.RDF_TYPE, f"<{S}Person>"),
        ("c", "name", '"C"'),
        ("d", "ref", "<r>"),
        ("d", "lit", '"x"@en'),
        ("child", "isBasedOn", "<d>"),
        ("child", "name", '"K"'),
    }


def test_unnamed_nodes_stay_apart_and_repeat(spark):
    doc = {"@id": "d", "author": [{"name": "A"}, {"name": "A"}]}
    first, second = flat(spark, doc), flat(spark, doc)
    nodes = {r.value for r in first.filter(F.col("p") == S + "author").collect()}
    assert len(nodes) == 2 and all(quads.GENID_MARK in n for n in nodes)
    assert triples(first) == triples(second)
    assert first.count() == 4
    other = flat(spark, {"@id": "x"}, doc)
    assert nodes.isdisjoint({r.value for r in other.filter(F.col("p") == S + "author").collect()})  # per graph


def test_texts_that_are_no_documents(spark):
    df = spark.createDataFrame([("g", "{bad"), ("g", None), ("g", "[1]"), ("g", '[{"@id":"a","x":"1"}]')], "g string, raw string")
    assert triples(quads.quads_of_documents(df)) == {("a", "x", '"1"')}


def release(spark, mark, names, extra=()):
    rows = []
    for i, n in enumerate(names):
        node, inner = f"h/genid/{mark}{i}", f"_:{mark}{i}"
        rows += [
            ("d", "about", f"<{node}>", node, "iri", "g"),
            (node, "name", f'"{n}"', n, "literal", "g"),
            (node, "part", inner, inner, "bnode", "g"),
            (inner, "name", f'"in {n}"', f"in {n}", "literal", "g"),
        ]
    return spark.createDataFrame(rows + list(extra), "s string, p string, o string, value string, kind string, g string")


def test_comparison_ignores_skolem_ids(spark):
    left, right = release(spark, "a", ["x", "x", "y"]), release(spark, "b", ["y", "x", "x"])
    assert quads.compare_releases(left, right).count() == 0
    # One of the two equal nodes is gone: a multiset notices.
    fewer = quads.compare_releases(left, release(spark, "c", ["x", "y"]))
    assert {(r.p, r.side, r.n) for r in quads.difference_profile(fewer).collect()} == {("about", "left", 1), ("name", "left", 2), ("part", "left", 1)}
    # A change deep inside shows on the way up.
    changed = release(spark, "e", ["x", "x", "y"]).withColumn("o", F.when(F.col("o") == '"in y"', F.lit('"in z"')).otherwise(F.col("o")))
    sides = {(r.p, r.side) for r in quads.compare_releases(left, changed).collect()}
    assert sides == {(p, s) for p in ("about", "name", "part") for s in ("left", "right")}


def test_comparison_of_cycles_and_loose_nodes(spark):
    loop = [("_:u", "next", "_:v", "_:v", "bnode", "g"), ("_:v", "next", "_:u", "_:u", "bnode", "g"), ("d", "to", "_:gone", "_:gone", "bnode", "g")]
    other = [(s.replace("u", "q").replace("v", "w"), p, o.replace("u", "q").replace("v", "w"), v.replace("u", "q").replace("v", "w"), k, g) for s, p, o, v, k, g in loop]
    assert quads.compare_releases(release(spark, "a", ["x"], loop), release(spark, "b", ["x"], other)).count() == 0


def test_profiles_and_entities(spark):
    df = parse_quads(
        lines(
            spark,
            f"<a> <{terms.RDF_TYPE}> <{S}Dataset> <g> .",
            f'<a> <{S}name> "n2" <g> .',
            f'<a> <{S}name> "n1" <g> .',
            f"<a> <{S}distribution> <f> <g> .",
            f'<f> <{S}contentUrl> "u" <g> .',
            f'<f> <{S}contentUrl> "u" <other> .',
            f'<b> <{S}name> "b" <g> .',
        )
    )
    ds = S + "Dataset"
    (row,) = quads.entities(df, ds, {"name": S + "name", "url": S + "url"}).collect()
    assert tuple(row) == ("g", "a", ["n1", "n2"], [])
    assert {r.value for r in quads.entity_values(df, ds, [S + "name"]).collect()} == {"n1", "n2"}
    assert [tuple(r) for r in quads.follow(df, ds, S + "distribution", S + "contentUrl").collect()] == [("g", "a", "f", "u")]
    assert {r.p: r.n for r in quads.predicate_profile(df).collect()}[S + "name"] == 3
    assert [tuple(r) for r in quads.type_profile(df).collect()] == [(ds, 1)]
    assert quads.union_releases(df, df).count() == 7


def ring(marks, size=20):
    """A ring of unnamed nodes, some of them marked."""
    rows = [(f"_:{i}", "next", f"_:{(i + 1) % size}", f"_:{(i + 1) % size}", "bnode", "g") for i in range(size)]
    return rows + [(f"_:{i}", "mark", '"m"', "m", "literal", "g") for i in marks]


def test_rings_that_differ_far_away_differ(spark):
    columns = "s string, p string, o string, value string, kind string, g string"
    make = lambda marks: spark.createDataFrame(ring(marks), columns)
    assert quads.compare_releases(make([0, 10]), make([3, 13])).count() == 0
    assert quads.compare_releases(make([0, 10]), make([0, 9])).count() > 0


QUAD = "s string, p string, o string, value string, kind string, g string"


def linked(spark, links, g="g"):
    """Quads of (s, p, o); nodes that begin with `_:` are unnamed."""
    rows = [(s, p, o, o, "bnode" if o[:2] == "_:" else "iri", g) for s, p, o in links]
    return spark.createDataFrame(rows, QUAD)


def wheel(*sizes, mark=""):
    return [(f"_:{mark}{n}.{i}", "next", f"_:{mark}{n}.{(i + 1) % k}") for n, k in enumerate(sizes) for i in range(k)]


def differ(spark, left, right):
    return quads.compare_releases(linked(spark, left), linked(spark, right)).count()


def test_rings_of_other_lengths_differ(spark):
    assert differ(spark, wheel(6), wheel(3, 3)) == 2
    assert differ(spark, wheel(6, 3, 3), wheel(3, 6, 3, mark="z")) == 0


def test_shared_nodes_linked_crosswise_differ(spark):
    straight = [("A", "p", "_:x"), ("A", "q", "_:x"), ("B", "p", "_:y"), ("B", "q", "_:y")]
    crossed = [("A", "p", "_:x"), ("A", "q", "_:y"), ("B", "p", "_:y"), ("B", "q", "_:x")]
    renamed = [(s, p, {"_:x": "_:2", "_:y": "_:1"}[o]) for s, p, o in crossed]
    assert differ(spark, straight, crossed) > 0 and differ(spark, crossed, renamed) == 0
    # The same two levels up, below unnamed nodes that are alike.
    deep = lambda rows: [("_:" + s, p, o) for s, p, o in rows] + [("R", "r", "_:A"), ("R", "r", "_:B"), ("_:x", "n", "_:u"), ("_:y", "n", "_:u")]
    assert differ(spark, deep(straight), deep(crossed)) > 0 and differ(spark, deep(crossed), deep(crossed[::-1])) == 0


def test_long_rings_and_chains_settle(spark):
    chain = [(f"_:c{i}", "rest", f"_:c{i + 1}") for i in range(400)] + [("_:c400", "end", "here"), ("list", "is", "_:c0")]
    named = lambda rows, mark: [(s.replace("_:", mark), p, o.replace("_:", mark)) for s, p, o in rows]
    left = wheel(3000) + chain + [("_:0.7", "at", "x"), ("_:0.1507", "at", "x")]
    right = wheel(3000) + chain + [("_:0.1", "at", "x"), ("_:0.1501", "at", "x")]
    other = wheel(3000) + chain + [("_:0.1", "at", "x"), ("_:0.1502", "at", "x")]
    assert differ(spark, left, named(right, "_:q")) == 0 and differ(spark, left, other) > 0


def test_a_node_that_leaves_a_long_cell_does_not_walk_it():
    class Counted(list):
        n = 0

        def __setitem__(self, at, value):
            Counted.n += 1
            super().__setitem__(at, value)

    n = 2000
    ring = [(i, "p", (i + 1) % n) for i in range(n)]
    cells = labelling.stable_cells([""] * n, ring)
    cells.start = Counted(cells.start)
    cells.refine(labelling._meets(n, ring), [cells.single_out(0)])
    assert len(cells.size) == n and Counted.n < 10 * n


def test_many_small_components_in_a_task(spark, monkeypatch):
    monkeypatch.setattr(quads, "LABELS_AT_ONCE", 7)
    nodes = spark.createDataFrame([(f"{i}{side}", str(i % 3)) for i in range(500) for side in "ab"], "id string, colour string")
    links = spark.createDataFrame([(f"{i}a", "p", f"{i}b") for i in range(500)], "id string, p string, to string")
    found = quads._by_component(nodes, links, labelling.settled)
    # Not a Python call for each component.
    assert "MapInArrow" in (plan := found._jdf.queryExecution().executedPlan().toString()) and "FlatMapGroups" not in plan
    got = {r["id"]: (r["hash"], r["ring"]) for r in found.collect()}
    assert len(got) == 1000 and {ring for _, ring in got.values()} == {False}
    assert all((got[f"{i}{s}"] == got[f"{j}{s}"]) == (i % 3 == j % 3) for s in "ab" for i, j in ((0, 3), (1, 499), (2, 3)))
    assert len({h for h, _ in got.values()}) == 6


def test_labels_of_small_graphs_against_all_renamings():
    rng = random.Random(4)
    for _ in range(300):
        n = rng.randrange(2, 6)
        one, two = ([*{(rng.randrange(n), rng.choice("pq"), rng.randrange(n)) for _ in range(n)}] for _ in range(2))
        colours = [rng.choice("xy") for _ in range(n)]
        same = any(
            sorted((p[a], k, p[b]) for a, k, b in one) == sorted(two) and all(colours[i] == colours[p[i]] for i in range(n))
            for p in itertools.permutations(range(n))
        )
        assert same == (sorted(labelling.labels(colours, one)) == sorted(labelling.labels(colours, two)))
        p = rng.sample(range(n), n)
        turned = [""] * n
        for i in range(n):
            turned[p[i]] = colours[i]
        moved = [(p[a], k, p[b]) for a, k, b in one]
        assert [labelling.labels(turned, moved)[p[i]] for i in range(n)] == labelling.labels(colours, one)
        assert [labelling.settled(turned, moved)[0][p[i]] for i in range(n)] == labelling.settled(colours, one)[0]


def test_components(spark):
    links = [(i, i + 1) for i in range(0, 999)] + [(2000, 2001), (3000, 3000), (2001, 2002)] + [(5000, 5000 + i) for i in range(1, 200)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(1000), 0), **dict.fromkeys((2000, 2001, 2002), 2000), 3000: 3000, **dict.fromkeys(range(5000, 5200), 5000)}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_what_a_comparison_wrote_on_the_way_is_gone(spark):
    def shuffled():
        files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
        return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_")}

    folder = ensure_checkpoint_dir(spark).removeprefix("file:")
    tables = lambda: {name for name in os.listdir(folder) if name.startswith("rows-")}
    before, setting = tables(), spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    shared = [("A", "p", "_:x"), ("A", "q", "_:x"), ("B", "p", "_:y"), ("B", "q", "_:y")]
    found = quads.compare_releases(linked(spark, wheel(9, 9) + shared), linked(spark, wheel(18) + shared))
    # The releases and the labels of their nodes are all that the result reads.
    assert len(tables() - before) == 2 and found.count() > 0
    one, two = (spark.range(100).groupBy((F.col("id") % n).alias("k")).agg(F.count("*").alias(f"n{n}")) for n in (7, 9))
    given = shuffled()
    rows = written(one.join(two.hint("merge"), "k"))
    deadline = time.time() + 20
    while shuffled() - given and time.time() < deadline:
        time.sleep(0.2)
    assert not shuffled() - given and spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == setting
    assert rows.count() == 7


def test_nodes_are_numbered_without_clashes(spark, monkeypatch):
    numbers = quads._node_ids
    monkeypatch.setattr(quads, "_node_ids", lambda keys, node, attempt: numbers(keys, node, attempt) % (3 if attempt == 0 else 1 << 62))
    nodes = spark.createDataFrame([(None, f"_:{i}") for i in range(20)] + [("g", f"_:{i}") for i in range(20)], "g string, node string")
    named, seen = quads._numbered(nodes, ("g",), n=F.count(F.lit(1)))
    assert dict(named.dtypes)["id"] == "bigint" and seen["n"] == named.select("id").distinct().count() == 40


def test_odd_documents_give_what_they_can(spark):
    texts = [
        '{"@graph":null,"name":"n"}', '{"@graph":["s"]}', '{"@id":5,"name":"five"}', '{"@type":{"a":1},"name":"t"}',
        "[" * 200000, '{"@id":"_:b1","about":{"@id":"_:b2"}}', '{"@id":"u:l","x":{"@list":[1,{"@id":"u:m"}]}}',
        '{"@id":"u:s","x":{"@set":["a",["b"]]},"y":{"@value":null},"z":1e20}', None, "not json",
    ]
    docs = spark.createDataFrame([(f"g{i}", t) for i, t in enumerate(texts)], "g string, raw string")
    assert sorted(r["g"] for r in quads.rejected_documents(docs).collect()) == ["g4", "g9"]
    found = quads.quads_of_documents(docs).collect()
    at = lambda g: {(r.s, r.p.rsplit("/", 1)[-1].rsplit("#", 1)[-1], r.o) for r in found if r.g == g}
    assert at("g5") == {("_:b1", "about", "_:b2")}
    assert {p for _, p, _ in at("g6")} == {"x", "first", "rest"} and len(at("g6")) == 5
    assert {(p, o) for _, p, o in at("g7")} == {
        ("x", '"a"'), ("x", '"b"'), ("z", '"100000000000000000000"^^<http://www.w3.org/2001/XMLSchema#integer>')
    }
    assert len(at("g0")) == len(at("g2")) == len(at("g3")) == 1 and not at("g1")

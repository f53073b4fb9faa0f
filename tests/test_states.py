"""Harvest state, ledger, graph patterns, JSON paths, inline contexts, structure, index levels, round extents, URL forms."""

from __future__ import annotations

import gzip
import json

import pytest
from pyspark.sql import functions as F

from metaloom.functions import geo, urls
from metaloom.functions.paths import json_path, path_texts, steps_of
from metaloom.functions.variants import any_text, strict_json, with_value
from metaloom.operators import documents, harvest, patterns, quads, responses
from metaloom.sources import readers

LISTING = "loc string, lastmod string, digest string"


def states(df):
    return {r["address"]: (r["status"], r["first_run"], r["changed_run"], r["n_changes"]) for r in df.collect()}


def test_three_runs_and_a_killed_one(spark, tmp_path):
    table = harvest.HarvestTable(spark, str(tmp_path))
    listing = lambda *rows: spark.createDataFrame(rows, LISTING)
    first = listing(("a", "2024-01-01", "1"), ("b", "2024-01-01", None), ("c", None, None), ("d", "2024-01-02", "x"), ("d", "2024-01-03", "y"), (None, None, None))
    assert {k: v[0] for k, v in states(table.run(first, "one")).items()} == dict.fromkeys("abcd", "new")
    second = listing(("a", "2024-02-01", "1"), ("b", "2024-01-01", None), ("c", None, None), ("e", "2024-01-01", "e"))
    # A run that dies after its files are written and before it is committed leaves no trace.
    harvest.advance(table.state(), second, "two").write.parquet(str(tmp_path / "state-dead"))
    got = states(table.run(second, "two"))
    assert {k: v[0] for k, v in got.items()} == {"a": "unchanged", "b": "unchanged", "c": "changed", "d": "gone", "e": "new"}
    assert states(table.run(listing(("z", None, None)), "two")) == got and table.commits().count() == 2
    third = listing(("a", "2024-03-01", "2"), ("b", "2024-03-01", "b"), ("d", "2024-01-03", "y"))
    got = states(table.run(third, "it's three"))
    assert got["a"] == ("changed", "one", "it's three", 1) and got["b"][0] == "changed"
    assert got["d"][:2] == ("new", "one") and got["e"][0] == "gone"
    part = states(table.run(listing(("a", "2024-04-01", "9")), "four", complete=False))
    assert part["a"] == ("changed", "one", "four", 2) and part["b"][0] == "changed" and part["e"][0] == "gone"


def test_stream_of_entries_is_taken_once(spark, tmp_path):
    table = harvest.HarvestTable(spark, str(tmp_path / "state"))
    for name, row in (("1", ("a", "2024-01-01", "1")), ("2", ("a", "2024-01-02", "2"))):
        spark.createDataFrame([row], LISTING).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
        entries = spark.readStream.schema(LISTING).json(str(tmp_path / "in"))
        harvest.harvest_stream(entries, table, str(tmp_path / "marks")).awaitTermination()
    assert states(table.state()) == {"a": ("changed", "files-0", "files-1", 1)} and table.commits().count() == 2


def test_ledger(spark):
    rows = [
        (1, 1.0, None, "429 retry in 10s"), (1, 2.0, "ok", None), (1, 3.0, "again", None), (2, 1.0, None, "HTTP 503"), (3, 5.0, None, "KeyError"),
        (4, 1.0, None, "timed out"), (4, 2.0, None, "timed out"), (4, 3.0, None, "timed out"), (5, 9.0, None, "quota: retry in 90s"), (7, 1.0, "x", None),
    ]
    attempts = spark.createDataFrame(rows, "row_id long, at double, response string, message string")
    got = {r["row_id"]: tuple(r)[1:] for r in responses.request_ledger(spark.range(1, 7).withColumnRenamed("id", "row_id"), attempts, "row_id").collect()}
    assert got == {
        1: ("done", 3, None, "ok", None), 2: ("due", 1, 31.0, None, "server_error"), 3: ("given_up", 1, None, None, "detection_error"),
        4: ("given_up", 3, None, None, "timeout"), 5: ("due", 1, 69.0, None, "quota"), 6: ("due", 0, 0.0, None, None),
    }


def quad_rows(spark, *rows):
    return spark.createDataFrame([(s, p, o, "iri" if o[:1] != '"' else "literal", g) for s, p, o, g in rows], "s string, p string, value string, kind string, g string")


def found(df):
    return sorted(tuple(r) for r in df.collect())


def test_patterns(spark):
    df = quad_rows(
        spark, ("a", "t", "X", "g"), ("a", "k", "b", "g"), ("a", "k", "c", "g"), ("a", "l", "b", "g"), ("b", "n", '"bee"', "g"), ("b", "n", '"bee"', "h"),
        ("c", "n", '"sea"', "g"), ("b", "up", "c", "g"), ("c", "up", "d", "g"), ("d", "up", "b", "g"), ("d", "up", "e", "g"), ("d", "up", "z", "h"),
    )
    assert found(patterns.match(df, [("?x", "t", "X"), ("?x", "k", "?y"), ("?y", "n", "?n")])) == [("g", "a", "b", '"bee"'), ("g", "a", "c", '"sea"')]
    assert found(patterns.match(df, [("?x", "k", "?y"), ("?x", "l", "?y")])) == [("g", "a", "b")]
    assert found(patterns.match(df, [("a", "k", "?y"), ("?y", "n", '"sea"')])) == [("g", "c")]
    assert found(patterns.match(df, [("b", "up+", "?y")])) == [("g", y) for y in "bcde"]
    assert found(patterns.match(df, [("?x", "up+", "?x")])) == [("g", x) for x in "bcd"]
    assert found(patterns.match(df, [("?x", "up+", "e")])) == [("g", x) for x in "bcd"]
    assert found(patterns.match(df, [("?x", "k", "?y"), ("?y", "up+", "?z"), ("?z", "n", '"bee"')])) == [("g", "a", "b", "b"), ("g", "a", "c", "b")]
    assert found(patterns.match(df.filter("false"), [("?x", "k", "?y")])) == []
    with pytest.raises(ValueError):
        patterns.match(df, [("?x", "k", "?y"), ("?z", "n", "?n")])


DOC = {
    "a.b": 1, "list": [{"k": "x", "n": 1, "in": [1, 2]}, {"k": "y", "n": 2.5, "in": [3]}, {"k": "x", "n": None}, 7, "x*", ["deep"]],
    "one": {"two": {"three": True}}, "none": None, "0": "zero", "words": ["ab", "b?", "abc"], "it's": "q",
}


@pytest.mark.parametrize("path, want", [
    ("one.two.three", ["true"]), ("list.#.k", ["x", "y", "x"]), ('list.#(k=="x").n', ["1"]), ('list.#(k=="x")#.n', ["1", None]),
    ("list.#.in.#", ["2", "1"]), ("list.#.in.0", ["1", "3"]), ("list.#", ["6"]), ("list.0.k", ["x"]), ("list.3", ["7"]), ("list.9", []),
    ("a\\.b", ["1"]), ("none", [None]), ("missing.#.x", []), ('list.#(n>1)#.k', ["y"]), ('list.#(n<=1)#.k', ["x"]), ("list.#(n==null)#.k", ["x"]),
    ('list.#(k!="x")#', ['{"in":[3],"k":"y","n":2.5}', "7", "x*", '["deep"]']), ('words.#(%"ab*")#', ["ab", "abc"]), ('words.#(=="b?")', ["b?"]), ("0", ["zero"]), ("it's", ["q"]),
    ("one.two.#", []), ("list.5.0", ["deep"]),
])
def test_json_paths(spark, path, want):
    df = with_value(spark.createDataFrame([(json.dumps(DOC),)], "raw string"))
    (row,) = df.select(path_texts(F.col("v"), path).alias("p")).collect()
    assert [None if x == "null" else x for x in row["p"]] == want


def test_odd_paths(spark):
    for path in ("", ".a", "a.", "a..b", "list.#(k=1)", "list.#(n%1)"):
        with pytest.raises(ValueError):
            json_path(F.lit(None).cast("variant"), path)
    assert [s[0] for s in steps_of('a.#(k=="x.y)")#.b\\.c')] == ["a", '#(k=="x.y)")#', "b\\.c"]
    empty = spark.createDataFrame([(None,)], "raw string").select(strict_json(F.col("raw")).alias("v"))
    assert empty.select(F.transform(json_path(F.col("v"), "a.#.b"), any_text).alias("p")).first()["p"] == []


def test_inline_contexts(spark):
    docs = {
        "prefix": '{"@context":{"dc":"http://dc/","t":"dc:title"},"@id":"dc:1","t":"x","dc:y":"z","other":"o"}',
        "vocab": '{"@context":{"@vocab":"http://v/","gone":null},"@id":"u:1","a":"x","gone":"g","@type":"T"}',
        "ids": '{"@context":[{"see":{"@id":"http://p/see","@type":"@id"},"at":{"@id":"http://p/at","@type":"http://x/date"}},{"x":"http://x/"}],"@id":"u:1","see":["x:1","u:2"],"at":"2020"}',
        "list": '{"@context":{"l":{"@id":"http://p/l","@container":"@list"}},"@id":"u:1","l":["a","b"]}',
        "lang": '{"@context":{"@language":"de","n":{"@id":"http://p/n","@container":"@language"},"m":{"@id":"http://p/m","@language":null}},"@id":"u:1","n":{"en":"e","fr":["f"]},"m":"m","o":"o"}',
        "scoped": '{"@context":{"p":{"@id":"http://p/p","@context":{"q":"http://q/q"}}},"@id":"u:1","q":"out","p":{"@id":"u:2","q":"in","r":{"@context":{"q":"http://deep/q"},"@id":"u:3","q":"deep"}}}',
        "alias": '{"@context":{"id":"@id","type":"@type"},"id":"u:1","type":"Thing","name":"n"}',
        "turned": '{"@context":{"part":{"@reverse":"http://p/part"}},"@id":"u:1","part":{"@id":"u:2"}}',
        "remote": '{"@context":"https://schema.org/","@id":"u:1","name":"n"}',
        "forget": '{"@context":{"a":"http://a/"},"@id":"u:1","b":{"@context":null,"@id":"u:2","a":"x"}}',
        "loop": '{"@context":{"a":"b:c","b":"a:d"},"@id":"u:1","a":"x"}',
    }
    rows = quads.quads_of_documents(spark.createDataFrame(list(docs.items()), "g string, raw string")).collect()
    at = lambda g: {(r["s"], r["p"], r["o"]) for r in rows if r["g"] == g}
    s = "https://schema.org/"
    assert at("prefix") == {("http://dc/1", "http://dc/title", '"x"'), ("http://dc/1", "http://dc/y", '"z"'), ("http://dc/1", s + "other", '"o"')}
    assert {(p.rsplit("#")[-1], o) for _, p, o in at("vocab")} == {("http://v/a", '"x"'), ("type", "<http://v/T>")}
    assert at("ids") == {("u:1", "http://p/see", "<http://x/1>"), ("u:1", "http://p/see", "<u:2>"), ("u:1", "http://p/at", '"2020"^^<http://x/date>')}
    assert sum(p.endswith("first") for _, p, _ in at("list")) == 2 and any(p == "http://p/l" for _, p, _ in at("list"))
    assert {(p, o) for _, p, o in at("lang")} == {("http://p/n", '"e"@en'), ("http://p/n", '"f"@fr'), ("http://p/m", '"m"'), (s + "o", '"o"@de')}
    assert {(a, p, o) for a, p, o in at("scoped") if o[0] == '"'} == {("u:1", s + "q", '"out"'), ("u:2", "http://q/q", '"in"'), ("u:3", "http://deep/q", '"deep"')}
    assert {(a, o) for a, _, o in at("alias")} == {("u:1", f"<{s}Thing>"), ("u:1", '"n"')}
    assert at("turned") == {("u:2", "http://p/part", "<u:1>")} and at("remote") == {("u:1", s + "name", '"n"')}
    assert ("u:2", s + "a", '"x"') in at("forget") and len(at("loop")) == 1


def test_structure_of_documents(spark):
    texts = ['{"b":1,"a":[1.0,2e2,"1.0",-0.50]}', '{ "a" : [1, 200.0, "1.0", -0.5],\n "b" : 1.0 }', '{"b":1,"a":[1,200,"1",-0.5]}', "no json"]
    rows = documents.with_structure(spark.createDataFrame(list(enumerate(texts)), "i int, raw string")).orderBy("i").collect()
    a, b, c, d = (r["structure"] for r in rows)
    assert a == b != c and d is None


def test_index_of_indexes(spark, tmp_path):
    base = "https://m.org"
    index = lambda *locs: "<sitemapindex>" + "".join(f"<sitemap><loc>{x}</loc></sitemap>" for x in locs) + "</sitemapindex>"
    maps = lambda *locs: "<urlset>" + "".join(f"<url><loc>{x}</loc></url>" for x in locs) + "</urlset>"
    (tmp_path / "top.xml").write_text(index(f"{base}/top.xml", f"{base}/mid.xml", f"{base}/a.xml", f"{base}/absent.xml"))
    (tmp_path / "mid.xml").write_text(index(f"{base}/top.xml", f"{base}/low.xml", f"{base}/b.xml.gz"))
    (tmp_path / "low.xml").write_text(index(f"{base}/a.xml", f"{base}/mid.xml"))
    (tmp_path / "a.xml").write_text(maps("u:1", "u:2"))
    (tmp_path / "b.xml.gz").write_bytes(gzip.compress(maps("u:3").encode()))
    (tmp_path / "apart.xml").write_text(maps("u:4"))
    entries = readers.read_sitemap(spark, str(tmp_path))
    out = readers.expand_index_levels(readers.read_sitemap_index(spark, str(tmp_path)), entries, str(tmp_path), base, f"{base}/top.xml")
    assert sorted((r["loc"], r["level"]) for r in out.collect()) == [("u:1", 1), ("u:2", 1), ("u:3", 2)]


def test_round_extents(spark):
    tiles = {"over": [(170, 5), (175, 20), (-172, 4)], "all": [(i, 20) for i in range(-180, 180, 15)], "plain": [(-10, 5), (20, 10)], "edge": [(170, 10)],
             "point": [(5, 0)], "wide": [(100, 400)], "start": [(-180, 10), (170, 10)], "far": [(530, 30)], "inner": [(-170, 100), (-160, 5), (0, 10)]}
    rows = [(k, 1, 1, float(w), 1.0, o, 10) for k, arcs in tiles.items() for o, w in arcs]
    df = spark.createDataFrame(rows, "collection string, width int, height int, res_x double, res_y double, origin_x int, origin_y int")
    got = {r["collection"]: (r["west"], r["east"], r["south"], r["north"]) for r in geo.round_extent(df).collect()}
    assert got == {k: (*v, 9.0, 10.0) for k, v in {
        "over": (170, -165), "all": (-180, 180), "plain": (-10, 30), "edge": (170, 180), "point": (5, 5), "wide": (-180, 180), "start": (170, -170), "far": (170, -160), "inner": (-170, 10)}.items()}


@pytest.mark.parametrize("url, want", [
    ("HTTP://Example.ORG:80", "http://example.org/"), ("https://a.org:443/x#y", "https://a.org/x"), ("https://a.org:/x", "https://a.org/x"), ("http://a.org:443/x", "http://a.org:443/x"),
    ("https://a.org/%7euser/%2f%c3%a9?q=%41%2c", "https://a.org/~user/%2F%C3%A9?q=A%2C"), ("https://a.org/a/./b/../c/", "https://a.org/a/c/"),
    ("https://a.org/100%", "https://a.org/100%"), ("https://a.org?", "https://a.org/"), ("mailto:A@b", "mailto:A@b"), (None, None), ("", ""), ("https://A.org/A?B", "https://a.org/A?B"),
])
def test_normal_form_of_urls(spark, url, want):
    df = spark.createDataFrame([(url,)], "u string").select(urls.normal_form(F.col("u")).alias("u"))
    assert df.first()["u"] == want and df.select(urls.normal_form(F.col("u")).alias("u")).first()["u"] == want


def test_replies_that_hold_nothing_and_datasets_that_are_no_objects(spark):
    replies = spark.createDataFrame([(1, "sorry, no data"), (2, '{"datasets":["just text",5,{"name":"n"},[1]]}'), (3, None)], "k int, response string")
    df = responses.detected_datasets(replies, "k", F.lit("s"), F.lit("u"))
    rows = {(r["k"], r["j"]): (r["raw_response"], r["error"]) for r in df.collect()}
    assert rows[1, 1] == ("sorry, no data", responses.NO_JSON) and rows[2, 1] == (None, None) and rows[3, 1] == (None, responses.NO_JSON)
    registry = spark.createDataFrame([(2, "d")], "row_id int, description string")
    merged = responses.merge_metadata(df, registry, "k", "row_id").withColumn("source_facts", F.lit('{"links":[]}'))
    prompts = responses.generation_requests(merged, "{EXTRACTED_METADATA}{EXAMPLE_JSONLD}", "k", F.lit("")).filter("k = 2").orderBy("j").collect()
    read = [json.loads(r["prompt"].replace("{{", "{").replace("}}", "}")) for r in prompts]
    assert read == [
        {"dataset": "just text", "source_facts": {"links": []}}, {"dataset": 5, "source_facts": {"links": []}},
        {"name": "n", "source_facts": {"links": []}}, {"dataset": [1], "source_facts": {"links": []}},
    ]

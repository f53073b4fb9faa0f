"""Column functions: every branch and every quirk that is kept on purpose."""

from __future__ import annotations

import hashlib
import json
from urllib.parse import urljoin

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from metaloom.functions import geo, normalise, terms, text, urls
from metaloom.functions.bind import first_per_key, let, once
from metaloom.functions.intervals import parse_interval
from metaloom.functions.prompts import format_slots, generation_prompt, is_large_prompt, detection_prompt
from metaloom.functions.variants import as_array, child, has_key, is_truthy, kind, strict_json, strip


def column(spark, values, expression, schema="x string"):
    """`expression` over one column, in the order of the values."""
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, {schema}").repartition(3)
    out = df.select("i", expression.alias("y")).orderBy("i").collect()
    return [r.y for r in out]


X = F.col("x")


def test_strict_json(spark):
    good = ['{"a":1}', "[1]", '"x"', "5", "null", " {} ", "true"]
    bad = ['{"a":1}{', "[1] x", "1,2", '1,"y":2', "1}", "1],[2", '1},{"y":2', "", "{a:1}", "no", None]
    got = column(spark, good + bad, strict_json(X).isNotNull())
    assert got == [True] * len(good) + [False] * len(bad)


def test_missing_null_and_empty_are_different(spark):
    docs = ['{"k":null}', "{}", '{"k":""}', '{"k":[]}', '{"k":0}', '{"k":{"a":1}}', '{"k":false}', '{"k":"0"}']
    v = strict_json(X)
    assert column(spark, docs, has_key(v, "$.k")) == [True, False, True, True, True, True, True, True]
    assert column(spark, docs, is_truthy(child(v, "$.k"))) == [False, False, False, False, False, True, False, True]
    assert column(spark, docs, F.size(as_array(v, "$.k"))) == [0, 0, 1, 0, 1, 1, 1, 1]
    assert column(spark, docs, kind(child(v, "$.k"))) == [
        "VOID", None, "STRING", "ARRAY", "BIGINT", "OBJECT", "BOOLEAN", "STRING",
    ]


def test_strip_removes_unicode_blanks(spark):
    values = ["  a b ", " a　", "\t\n a\r", "", " "]
    assert column(spark, values, strip(X)) == [v.strip() for v in values]


def test_let_and_once_evaluate_once(spark):
    assert column(spark, ["3"], let(X.cast("int"), lambda n: n * n + n)) == [12]
    df = once(spark.range(50), r=F.rand()).withColumn("same", F.col("r") - F.col("r"))
    assert df.filter("same <> 0").count() == 0


def test_reply_cutting(spark):
    fence = "```"
    cases = [
        (f"Here:\n{fence}json\n" + '{"a": 1}' + f"\n{fence}\nDone {{x}}", "object", '{"a": 1}'),
        (f"{fence}\n[1, 2]\n{fence}", "array", "[1, 2]"),
        (f'{fence}json\n{{"a": 1}}', "object", '{"a": 1}'),  # not closed: not stripped
        ('[{"a": 1}]', "object", '{"a": 1}'),  # a list of one object is that object
        ('[{"a": 1},{"b": 2}]', "text", '[{"a": 1},{"b": 2}]'),  # of two, it breaks
        ("no data", "text", "no data"),
        ("} before {", "text", "} before {"),
        (f"{fence}json{fence}", "text", f"{fence}json{fence}"),  # an empty fence is not stripped
        ("say [1,2", "text", "say [1,2"),
        (f"{fence}json\n nothing \n{fence}", "text", "nothing"),
    ]
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, r string")
    rows = text.with_reply_json(df, "r").orderBy("i").select("kind", "text", (F.col("v").isNotNull()).alias("v")).collect()
    assert [(r.kind, r.text) for r in rows] == [c[1:] for c in cases]
    assert rows[4].v and not rows[5].v  # the list of two still parses as a whole


def test_names_and_hashes(spark):
    names = ["A b-c_d (v1.0) ", "é ñ 漢字 ½²", "!!!", "x" * 60 + " y", "a:b/c"]

    def safe(n):
        return "".join(c for c in n if c.isalnum() or c in " -_").rstrip().replace(" ", "_")

    assert column(spark, names, text.folder_name(X)) == [safe(n) for n in names]
    url = "https://ex.org/é"
    tail = hashlib.sha1(url.encode()).hexdigest()[:8]
    assert column(spark, names, text.file_name(X, F.lit(url))) == [
        f"{safe(n)[:50] or 'dataset'}_{tail}.jsonld" for n in names
    ]
    assert column(spark, ["x" * 50, "y" * 51], text.display_name(X)) == ["x" * 50, "y" * 47 + "..."]


def test_failure_classes(spark):
    cases = {
        "Request Timed Out": "timeout",
        "upstream connect error": "timeout",
        "error 503, connection reset": "timeout",
        "Internal Server Error": "server_error",
        "row 1500": "server_error",
        "KeyError": "detection_error",
    }
    assert column(spark, list(cases), text.failure_reason(X)) == list(cases.values())
    assert column(spark, ["KeyError"], text.failure_reason(X, "generation")) == ["other_error"]
    waits = {"retry in 12.5s": 17.5, "Retry In 90s": 60.0, "quota": 30.0, "retry in 1.2.3s": 30.0}
    assert column(spark, list(waits), text.retry_delay(X)) == list(waits.values())
    assert column(spark, ["429", "RESOURCE_EXHAUSTED", "resource_exhausted", "Quota", "no"], text.is_quota_error(X)) == [
        True, True, False, True, False,
    ]
    assert column(spark, ["server_error"], text.reason_title(X)) == ["Server Error"]


def test_doi_urls(spark):
    value = "a https://doi.org/10.1/x – b\nhttps://doi.org/10.1/x, https://dx.doi.org/1"
    assert column(spark, [value], text.doi_urls(X)) == [["https://doi.org/10.1/x", "https://doi.org/10.1/x,"]]


def test_sitemap_time_has_no_session_zone(spark):
    values = ["2024-01-02", "2024-01-02T03:04:05Z", "2024-01-02T03:04:05+02:00", "x", None]
    got = column(spark, values, F.unix_timestamp(text.sitemap_time(X)))
    assert got == [1704153600, 1704164645, 1704157445, None, None]


# ---- URLs ------------------------------------------------------------------------------------------

BASES = [
    "http://a.org/b/c/d?q=1#f",
    "https://a.org",
    "https://a.org/",
    "https://a.org/b",
    "https://A.org:8080/b/c/",
]
HREFS = [
    "", "g", "./g", "g/", "/g", "//h.org/x", "?y", "g?y", "#s", "g#s", "../g", "../../g", "../../../g", ".", "..", "./..",
    "g/../h", "/a/./b/../c", "mailto:a@b", "http://x.org/a/../b", "https://y.org", "javascript:void(0)", "g;x=1", "/", "a//b",
    "..g", "g..", "/..", "x/y/../../..", "data:text/plain,hi", "?", "#", "é/ü", "a b",
]


def test_resolve_like_urljoin(spark):
    pairs = [(b, h) for b in BASES for h in HREFS]
    df = spark.createDataFrame([(i, b, h) for i, (b, h) in enumerate(pairs)], "i int, b string, h string")
    got = [r.y for r in df.select("i", urls.resolve(F.col("b"), F.col("h")).alias("y")).orderBy("i").collect()]
    wrong = [(b, h, g, urljoin(b, h)) for (b, h), g in zip(pairs, got) if g != urljoin(b, h)]
    assert not wrong


@settings(max_examples=3, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "b", "..", ".", "", "c?d", "#e"]), max_size=5), min_size=40, max_size=40))
def test_resolve_random_paths(spark, paths):
    hrefs = ["/".join(p) for p in paths]
    hrefs = [h for h in hrefs if not h.startswith("//")]
    base = "https://a.org/x/y/z"
    got = column(spark, hrefs, urls.resolve(F.lit(base), X))
    assert got == [urljoin(base, h) for h in hrefs]


def test_hosts_and_domains(spark):
    values = ["https://A.org/x", "http://a.org:80/", "ftp://a.org", "not a url", "//a.org", None, "https://b.a.org/[x"]
    assert column(spark, values, urls.in_domains(X, ["a.org"])) == [True, True, True, False, True, False, False]
    assert column(spark, values, urls.is_http(X))[:4] == [True, True, False, False]


def test_catalogue_browser_addresses(spark):
    given_urls = [
        "https://view.example/stac-browser#/external/raw.example/a/b.json",
        "https://view.example/stac-browser/#/external/raw.example/a/b.json",
    ]
    assert column(spark, given_urls, urls.catalogue_source_url(X)) == ["https://raw.example/a/b.json"] * 2
    there = urls.catalogue_browser_url(X, "https://view.example/stac-browser")
    assert column(spark, ["https://raw.example/a/b.json"], there) == [given_urls[0]]


# ---- boxes -----------------------------------------------------------------------------------------


BOX_CHECKS = [
    ("20,-40 50,10", None, False),
    ("20 -40 50 10", None, True),
    ("-46.5 -162.75 71.25 176.5", None, True),  # south west north east
    ("200,10 210,20", "box out of range", False),
    ("1 2 300 4", "box out of range", True),
    ("a,b c,d", "invalid box format", False),
    ("20, 30,40", "invalid box format", False),
    ("1 2 3 x", "invalid box numbers", False),
    ("1 2 3", "box expected 2 or 4 numbers", False),
    ("1,2,3 4,5", "box expected 2 or 4 numbers", False),  # two parts, but not two and two numbers
    ("1,2 3", "box expected 2 or 4 numbers", False),
    ("1d 2 3 4", "invalid box numbers", False),
    ("nan,1 2,3", "box out of range", False),
    ("", None, False),
    ("   ", None, False),
    (None, None, False),
]


def test_box_check(spark):
    got = column(spark, [case[0] for case in BOX_CHECKS], geo.check_box(X))
    assert [(g.msg, g.order_guessed) for g in got] == [case[1:] for case in BOX_CHECKS]
    assert all(g.ok == (g.msg is None) for g in got)
    assert (got[2].west, got[2].south, got[2].east, got[2].north) == (-162.75, -46.5, 176.5, 71.25)


def test_box_fix_prints_floats(spark):
    numbers = ["20", "-40", "50.0", "1e-5", "0.0001", "12345678", "1e16", "123456789012345", "-0", ".5", "5.", "1e3", "0.30000000000000004", "-1.50"]
    boxes = [f"{n} 1 2 3" for n in numbers]
    assert column(spark, boxes, geo.fix_box(X)) == [f"{float(n)},1.0 2.0,3.0" for n in numbers]
    kept = ["1,2 3 4", "1 2 3", "1 2 3 x", ""]
    assert column(spark, kept, geo.fix_box(X)) == kept


@settings(max_examples=3, deadline=None)
@given(st.lists(st.floats(-1e6, 1e6, allow_nan=False).map(lambda f: f"{f:.6f}"), min_size=50, max_size=50))
def test_number_text_is_float_text(spark, values):
    assert column(spark, values, geo.number_text(X)) == [repr(float(v)) for v in values]


def test_box_of_needs_objects(spark):
    docs = [
        '{"spatialCoverage":{"geo":{"box":" 1 2 3 4 "}}}',
        '{"spatialCoverage":[{"geo":{"box":"1"}}]}',
        '{"spatialCoverage":{"geo":"x"}}',
        '{"spatialCoverage":{"geo":{"box":5}}}',
        "{}",
    ]
    assert column(spark, docs, geo.box_of(strict_json(X))) == ["1 2 3 4", None, None, None, None]


def test_extent(spark):
    tiles = spark.createDataFrame(
        [("a", 10, 5, 1.0, -1.0, 0.0, 50.0), ("a", 10, 5, 1.0, 1.0, 10.0, 60.0), ("b", 1, 1, 0.5, 0.5, 0.0, 0.0)],
        "collection string, width int, height int, res_x double, res_y double, origin_x double, origin_y double",
    )
    got = {r.collection: (r.west, r.south, r.east, r.north) for r in geo.collection_extent(tiles).collect()}
    assert got == {"a": (0.0, 45.0, 20.0, 60.0), "b": (0.0, -0.5, 0.5, 0.0)}


# ---- intervals -------------------------------------------------------------------------------------


def test_intervals(spark):
    cases = {
        "1985-01-01/2015-12-31": ("1985-01-01", "2015-12-31", "closed"),
        "1950-01-01/..": ("1950-01-01", None, "open"),
        "../2000": (None, "2000", "open"),
        "Static": (None, None, "static"),
        "not detected": (None, None, "not_detected"),
        "ongoing": (None, None, "ongoing"),
        "..": (None, None, "ongoing"),
        "21000BP/0BP": ("21000BP", "0BP", "bp"),
        "2015": ("2015", "2015", "single"),
        "2015-09-02T10:00:00Z": ("2015-09-02T10:00:00Z", "2015-09-02T10:00:00Z", "single"),
        "varies": (None, None, "other"),
        "a/b/c": (None, None, "other"),
        "": (None, None, "missing"),
        None: (None, None, "missing"),
    }
    got = column(spark, list(cases), parse_interval(X))
    assert [(g.start, g.end, g.kind) for g in got] == list(cases.values())


# ---- normalisation ---------------------------------------------------------------------------------

COMMENT = normalise.origin_comment("https://ex.org/issues")


def test_keywords(spark):
    docs = {
        '{"keywords":"a; b ,c;"}': ["a", "b", "c"],
        '{"keywords":["x"," y ",""," ",null,0,5,true]}': ["x", "y", "", "5", "true"],
        '{"keywords":"  "}': None,
        '{"keywords":{"a":1}}': None,
        "{}": None,
        '{"keywords":" ; "}': [],
    }
    assert column(spark, list(docs), normalise.keywords_list(strict_json(X))) == list(docs.values())


def test_encodings(spark):
    docs = {
        '{"e":"text/csv; a/b"}': ["text/csv", "a/b"],
        '{"e":" text/csv "}': ["text/csv"],
        '{"e":["a,b"," c ","",null,7]}': ["a", "b", "c", "7"],
        '{"e":7}': None,
        '{"e":""}': None,
        "{}": None,
    }
    node = child(strict_json(X), "$.e")
    assert column(spark, list(docs), normalise.encoding_list(node)) == list(docs.values())


def test_comment_stamp(spark):
    docs = {
        "{}": ("text", [COMMENT]),
        '{"comment":null}': ("text", [COMMENT]),
        json.dumps({"comment": COMMENT}): ("text", [COMMENT]),
        '{"comment":"mine"}': ("list", ["mine", COMMENT]),
        '{"comment":["a"]}': ("list", ["a", COMMENT]),
        json.dumps({"comment": ["a", COMMENT]}): ("list", ["a", COMMENT]),
    }
    got = column(spark, list(docs), normalise.stamped_comment(strict_json(X), COMMENT))
    assert [(g.kind, g.items) for g in got] == list(docs.values())


def test_whole_document_repair(spark):
    doc = {
        "@context": "c",
        "@type": "Dataset",
        "keywords": "a;b",
        "spatialCoverage": {"geo": {"box": "20 -40 50 10"}},
        "encodingFormat": "x/y, z/w",
        "distribution": [{"encodingFormat": "t"}, {"deep": [{"encodingFormat": ["a;b", " ", "", {"k": 1}]}]}],
        "name": "é",
    }
    (raw,) = column(spark, [json.dumps(doc)], normalise.normalise_text(X, COMMENT))
    got = json.loads(raw)
    assert list(got)[:3] == ["@context", "@type", "comment"] and got["comment"] == COMMENT
    assert got["keywords"] == ["a", "b"] and got["encodingFormat"] == ["x/y", "z/w"]
    assert got["spatialCoverage"]["geo"]["box"] == "20.0,-40.0 50.0,10.0"
    assert got["distribution"][0]["encodingFormat"] == ["t"]
    assert got["distribution"][1]["deep"][0]["encodingFormat"] == ["a", "b", "", "{'k': 1}"]
    assert raw.isascii() and raw.startswith('{\n  "@context"')
    assert column(spark, ["nope", None, "5"], normalise.normalise_text(X, COMMENT)) == ["nope", None, "5"]


_JSON = st.recursive(
    st.none() | st.booleans() | st.integers(-5, 5) | st.sampled_from(["", " ", "a;b", "x, y", "1 2 3 4", "1,2 3,4"]),
    lambda c: st.lists(c, max_size=3) | st.dictionaries(st.sampled_from(["encodingFormat", "keywords", "comment", "@type", "x"]), c, max_size=4),
    max_leaves=12,
)


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.sampled_from(["encodingFormat", "keywords", "comment", "@type", "distribution"]), _JSON, max_size=5))
def test_repair_of_repaired_is_stable_from_the_second_time(doc):
    # A blank item becomes an empty one, which a second pass drops: the second pass settles it.
    once_ = normalise.normalise_one(json.dumps(doc), COMMENT)
    twice = normalise.normalise_one(once_, COMMENT)
    assert normalise.normalise_one(twice, COMMENT) == twice


# ---- terms -----------------------------------------------------------------------------------------


def test_unescape_and_escape(spark):
    values = ['a\\"b', "tab\\tnl\\n", "\\u00e9\\u4e2d", "\\U0001F600", "\\uD83D\\uDE00", "back\\\\slash\\\\n", "plain"]
    wanted = ['a"b', "tab\tnl\n", "é中", "😀", "😀", "back\\slash\\n", "plain"]
    assert column(spark, values, terms.unescape(X)) == wanted
    plain = ['q"q', "b\\b", "n\nn", "r\rr", "é"]
    assert column(spark, plain, terms.unescape(terms.escape(X))) == plain


def test_canonical_numbers(spark):
    cases = {7.8: "7.8E0", -0.5: "-5.0E-1", 1234.5: "1.2345E3", 1e22: "1.0E22", 1e-7: "1.0E-7"}
    assert column(spark, list(cases), terms.canonical_double(X), "x double") == list(cases.values())


def test_graph_ids(spark):
    g = "urn:h.io:org:src:data:" + "a" * 40
    assert column(spark, [g, "urn:x"], terms.graph_source(X)) == ["src", None]
    assert column(spark, [g, "urn:x"], terms.graph_sha(X)) == ["a" * 40, None]


# ---- prompts ---------------------------------------------------------------------------------------


def test_slots_are_filled_once(spark):
    template = "{NAME} {{keep}} {URL}{NAME}"
    got = column(spark, ["{URL}"], format_slots(template, {"NAME": X, "URL": F.lit("u")}))
    assert got == [template.format(NAME="{URL}", URL="u")]
    with pytest.raises(KeyError):
        format_slots("{OTHER}", {})


def test_prompts(spark):
    lit = F.lit
    long = "y" * 5000
    full = detection_prompt("{URL}|{CONTENT_SECTION}|{DATASET_NAME}{GROUP}{DESCRIPTION}", lit("u"), X, lit("n"), lit("g"), lit("d"), 3000)
    with_text, without = column(spark, [long, ""], full)
    assert with_text.count("y") - with_text.replace("y" * 3000, "").count("y") == 3000
    assert "Please analyze the content at this URL: u" in without and without.endswith("|ngd")
    slots = "{DATASET_NAME}{URL}{DESCRIPTION}{GROUP}{CREATOR}{PROVIDER}{PUBLISHER}{KEYWORDS}{SPATIAL_COVERAGE}{EXTRACTED_METADATA}{EXAMPLE_JSONLD}"
    (made,) = column(spark, ['{"a":1}'], generation_prompt(slots, {"name": lit("n"), "url": lit("u")}, X, lit("{}" * 3000), 2000))
    assert made == 'nu{{"a":1}}' + "{{}}" * 1000
    assert column(spark, ["x" * 10001, "x" * 10000], is_large_prompt(X)) == [True, False]


def test_box_fix_may_guess_the_order(spark):
    boxes = ["-46.5 -162.75 71.25 176.5", "20 -40 50 10"]
    assert column(spark, boxes, geo.fix_box(X, guess_order=True)) == ["-162.75,-46.5 176.5,71.25", "20.0,-40.0 50.0,10.0"]
    assert column(spark, boxes, geo.fix_box(X))[0] == "-46.5,-162.75 71.25,176.5"


def test_first_per_key(spark):
    items = F.from_json(X, "array<struct<pos:int,k:string,v:string>>")
    text_ = '[{"pos":0,"k":"b","v":"1"},{"pos":1,"k":"a","v":"2"},{"pos":2,"k":"b","v":"3"},{"pos":3,"v":"4"},{"pos":4,"v":"5"}]'
    got = column(spark, [text_, "[]"], F.transform(first_per_key(items, lambda x: x["k"], ["pos"]), lambda x: x["v"]))
    assert got == [["1", "2", "4"], []]

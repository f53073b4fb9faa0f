"""Registry, replies, validation, audit, failures, identity."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import functions as F

from metaloom.functions.normalise import SHORT_ORIGIN_COMMENT
from metaloom.operators import audit, documents, failures, registry, responses, validation
from metaloom.operators.ordering import with_sequence


def docs(spark, *items, key="doc_id"):
    rows = [(i, d if isinstance(d, str) else json.dumps(d)) for i, d in enumerate(items)]
    return spark.createDataFrame(rows, f"{key} int, raw string")


# ---- registry --------------------------------------------------------------------------------------


def registry_rows(spark):
    rows = [
        (1, "TRUE", "https://a", "A (v1)"),
        (2, "false", "https://b", "B"),
        (3, "#ERROR!", "https://c", "C: x"),
        (4, "", "  ", "D"),
        (5, None, "https://e", "E"),
        (6, " FALSE", "https://f", "F"),  # the flag is not trimmed
        (7, "False", None, "G"),
    ]
    return spark.createDataFrame(rows, "row_id long, has_jsonld string, webpage_url string, name string")


def ids(df):
    return sorted(r.row_id for r in df.collect())


def test_todo_and_skip(spark):
    todo = registry.todo(registry_rows(spark))
    assert ids(todo) == [2, 3, 5]
    existing = spark.createDataFrame([("C_x",), ("C_x",), ("Z",)], "site string")
    assert ids(registry.skip_existing(todo, existing)) == [2, 5]
    assert tuple(registry.counts(registry_rows(spark), existing).head()) == (7, 3, 2)
    assert ids(registry.next_sites(todo, first_only=True, limit=2)) == [2]
    assert ids(registry.next_sites(todo, limit=2)) == [2, 3]
    assert ids(registry.next_sites(todo)) == [2, 3, 5]


def test_sequence_over_skewed_values(spark):
    df = spark.range(5000).select(F.when(F.col("id") < 4000, F.col("id")).otherwise(F.col("id") * 1000003).alias("k"))
    rows = with_sequence(df.repartition(7), "k", "seq", "total", buckets=16).orderBy("k").collect()
    assert [r.seq for r in rows] == list(range(1, 5001)) and {r.total for r in rows} == {5000}
    assert with_sequence(df.filter("k < 0"), "k").count() == 0
    assert [r.seq for r in with_sequence(df.limit(1), "k").collect()] == [1]


def test_sequence_sorts_in_many_tasks(spark):
    plan = with_sequence(spark.range(1000), "id")._jdf.queryExecution().executedPlan().toString()
    # The one single-task window is over the bucket counts, which are bounded.
    assert "hashpartitioning(_bucket" in plan


def test_sequence_of_texts_and_few_rows(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",)], "k string")
    got = with_sequence(df, "k", "seq", "total", buckets=16).orderBy("k").collect()
    assert [tuple(r) for r in got] == [("a", 1, 3), ("b", 2, 3), ("c", 3, 3)]


def test_sequence_leaves_rows_in_their_ranges(spark):
    rows = with_sequence(spark.range(1000).repartition(3), "id", buckets=8)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(id" not in plan and "SortMergeJoin" not in plan
    spread = rows.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(spread) > 1 and max(r["count"] for r in spread) < 500


# ---- replies ---------------------------------------------------------------------------------------


def detected(spark, *replies):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(replies)], "k int, response string")
    out = responses.detected_datasets(df, "k", F.lit("S"), F.lit("https://s"))
    return out, [(r.k, r.j, r["name"], r.url) for r in out.orderBy("k", "j").collect()]


def test_reply_shapes(spark):
    _, rows = detected(
        spark,
        '{"datasets":[{"name":"a"},{"url":"u","name":null},{}]}',
        '{"name":"one"}',
        '[{"name":"x"},{"name":"y"}]',
        '{"datasets":"none"}',
        "nothing",
        '{"datasets":[]}',
        "5",
    )
    assert rows == [
        (0, 1, "a", "https://s"),
        (0, 2, None, "u"),  # a null value is there, so no default
        (0, 3, "S_dataset_3", "https://s"),
        (1, 1, "one", "https://s"),
        (2, 1, "x", "https://s"),
        (2, 2, "y", "https://s"),
        (3, 1, "S_dataset_1", "https://s"),
        (4, 1, "S_dataset_1", "https://s"),
        (6, 1, "S_dataset_1", "https://s"),
    ]


def test_merge_prefers_present_keys(spark):
    found, _ = detected(spark, '{"name":"a","publisher":"","keywords":["x"]}', '{"name":"b","spatialCoverage":{"a":1}}')
    sites = spark.createDataFrame(
        [(0, "G", "Pub", "Desc", "1", "2", "3", "4"), (1, "H", None, "D2", "", "2", "3", "4")],
        "row_id int, grp string, publisher string, description string, box_lon_min string, box_lat_min string, box_lon_max string, box_lat_max string",
    )
    merged = responses.merge_metadata(found, sites, "k", "row_id").orderBy("k").collect()
    assert [(m.publisher, m.description, m.keywords, m.spatial_coverage, m.creator) for m in merged] == [
        ("", "Desc", '["x"]', "1,2 3,4", ""),
        ("", "D2", "", '{"a":1}', ""),
    ]
    assert [r.n_datasets for r in responses.dataset_counts(found, "k").collect()] == [1, 1]


def test_request_tables(spark):
    sites = spark.createDataFrame([(1, " https://a ", "N", "G", "page text")], "row_id long, webpage_url string, name string, grp string, text string")
    (row,) = responses.detection_requests(sites, "{URL}|{DATASET_NAME}|{GROUP}|{CONTENT_SECTION}{DESCRIPTION}").collect()
    assert row.url == "https://a" and row.prompt.startswith("https://a|N|G|") and "page text" in row.prompt
    found, _ = detected(spark, '{"name":"a","x":{"y":1}}')
    merged = responses.merge_metadata(found, spark.createDataFrame([(0,)], "row_id int"), "k", "row_id")
    (made,) = responses.generation_requests(merged, "{DATASET_NAME} {EXTRACTED_METADATA} {EXAMPLE_JSONLD}", "k", F.lit("{}")).collect()
    assert made.prompt == 'a {{"name":"a","x":{{"y":1}}}} {{}}'


# ---- validation ------------------------------------------------------------------------------------

GOOD = {"@context": "c", "@type": "Dataset", "name": "n"}


def test_messages_in_order(spark):
    cases = [
        (GOOD, True, []),
        ("{bad", False, ["JSON Syntax Error: Invalid JSON"]),
        ({"@type": None}, False, ["missing '@context'", "missing 'name'"]),
        ([1], False, ["missing '@context'", "missing '@type'", "missing 'name'"]),
        ({**GOOD, "@type": "WebPage"}, True, ["@type is 'WebPage', expected 'Dataset'"]),
        ({**GOOD, "@type": ""}, True, []),
        ({**GOOD, "@type": "0"}, True, ["@type is '0', expected 'Dataset'"]),
        ({**GOOD, "@type": ["Dataset", "X"]}, True, ["@type is '['Dataset', 'X']', expected 'Dataset'"]),
        (
            {
                **GOOD,
                "@type": "Thing",
                "spatialCoverage": {"geo": {"box": "1 2 3"}},
                "distribution": [{"encodingFormat": "a"}, {"encodingFormat": ["a"]}, 5, {"encodingFormat": None}, {"encodingFormat": 1.5},
                                 {"encodingFormat": 2}, {"encodingFormat": {"a": 1}}, {"encodingFormat": True}],
            },
            False,
            [
                "spatialCoverage box: box expected 2 or 4 numbers",
                "distribution[0].encodingFormat must be array, got string",
                "distribution[4].encodingFormat must be array, got float",
                "distribution[5].encodingFormat must be array, got int",
                "distribution[6].encodingFormat must be array, got dict",
                "distribution[7].encodingFormat must be array, got bool",
                "@type is 'Thing', expected 'Dataset'",
            ],
        ),
        ({**GOOD, "distribution": {"encodingFormat": "a"}}, True, []),
    ]
    checked = validation.check_documents(docs(spark, *[c[0] for c in cases])).orderBy("doc_id")
    rows = checked.select("ok", "messages").collect()
    assert [(r.ok, r.messages) for r in rows] == [c[1:] for c in cases]
    total = validation.verdict(checked).head()
    assert (total.n, total.n_failed, total.n_warned, total.all_ok) == (10, 4, 4, False)
    assert [r.doc_id for r in validation.failed_documents(checked, "doc_id").collect()] == [1, 2, 3, 8]
    summary = validation.document_summary(checked, "doc_id").filter("doc_id = 0").head()
    assert (summary.type, summary["name"], summary.box, summary.n_distribution) == ("Dataset", "n", None, None)


def test_verdict_of_nothing(spark):
    assert tuple(validation.verdict(validation.check_documents(docs(spark, GOOD).filter("doc_id > 5"))).head()) == (0, 0, 0, 0, True)


def test_check_is_one_narrow_plan(spark):
    plan = validation.check_documents(docs(spark, GOOD))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


# ---- audit -----------------------------------------------------------------------------------------


def audited(spark, doc, codes=(), hrefs=()):
    sets = spark.createDataFrame([(0, list(codes), list(hrefs))], "page_id int, codes array<string>, hrefs array<string>")
    featured = audit.with_sets(audit.document_features(docs(spark, doc)), sets, "doc_id", "page_id")
    (row,) = audit.audit_documents(featured).collect()
    return row.warnings


def test_code_like_names(spark):
    cases = {
        "BIO1-BIO19": True, "BIO1–19": True, "bands 1-7": False, "a/b": True, "tas": True, "Tas": False, "T2": True, "Air": False,
        "": False, None: False, "a b": False, "x BIO1 - BIO3 y": True,
    }
    df = spark.createDataFrame([(i, n) for i, n in enumerate(cases)], "i int, n string")
    got = df.select("i", audit.looks_like_code(F.col("n")).alias("y")).orderBy("i").collect()
    assert [r.y for r in got] == list(cases.values())


def test_audit_order_and_rules(spark):
    assert audited(spark, [1]) == ["Generated JSON-LD is not an object"]
    assert audited(spark, {}) == []
    doc = {
        "citation": ["Doe", {}],
        "variableMeasured": [
            {"name": "tas", "alternateName": "TAS", "temporalCoverage": None},
            "text",
            {"name": "Air", "spatialCoverage": {}},
        ],
        "distribution": [{"contentUrl": "u1"}],
    }
    assert audited(spark, doc, ["tas", "pr", "ab"], ["u2"]) == [
        audit.CITATION_HAS_TEXT,
        "variableMeasured[0].name looks like a code or lumped range",
        "variableMeasured[0] is missing spatialCoverage",
        "variableMeasured[2] is missing temporalCoverage",
        "variableMeasured is missing source-listed variable code(s): ab, pr",
        audit.NO_DOWNLOAD,
    ]
    assert audited(spark, {**doc, "citation": "Doe", "variableMeasured": "v", "distribution": {"contentUrl": "u2"}}, ["a"], ["u2"]) == [
        audit.CITATION_IS_TEXT,
        audit.VARIABLES_ARE_TEXT,
        audit.NO_DOWNLOAD,  # a single distribution object is passed over
    ]
    assert audited(spark, {"distribution": [{"contentUrl": "u2"}]}, [], ["u2"]) == []


def test_single_objects_on_request(spark):
    doc = {"variableMeasured": {"name": "tas"}, "distribution": {"contentUrl": "u"}}
    features = audit.document_features(docs(spark, doc), coerce_single=True)
    row = features.head()
    assert row.urls == ["u"] and len(row.inner) == 3


def test_missing_codes_need_a_list_of_variables(spark):
    sets = spark.createDataFrame([(i, ["b", "a"], []) for i in range(3)], "page_id int, codes array<string>, hrefs array<string>")
    features = audit.document_features(docs(spark, {"variableMeasured": [{"alternateName": "B"}]}, {"variableMeasured": {}}, {}))
    rows = audit.missing_codes(audit.with_sets(features, sets, "doc_id", "page_id")).collect()
    assert [(r.doc_id, r.codes) for r in rows] == [(0, ["a"])]


def test_contract(spark):
    good = {
        "@context": {"@vocab": "https://schema.org/"}, "@type": "Dataset", "@id": "x", "keywords": [], "citation": [{}],
        "encodingFormat": [], "distribution": [{"encodingFormat": []}, {}], "comment": [SHORT_ORIGIN_COMMENT],
        "variableMeasured": [{"temporalCoverage": "", "spatialCoverage": ""}],
    }
    bad = {
        "@context": "other", "@type": "X", "keywords": "a", "citation": "c", "distribution": [{"encodingFormat": "a"}],
        "variableMeasured": [{}], "@id": "",
    }
    rows = audit.check_contract(docs(spark, good, bad), "https://ex.org/issues").collect()
    outcome = {i: {r.rule: r.ok for r in rows if r.doc_id == i} for i in (0, 1)}
    assert all(outcome[0].values()) and not any(outcome[1].values()) and len(outcome[0]) == 8


def test_plan_rules_and_defaults(spark):
    sets = spark.createDataFrame([(0, ["a"], ["u"])], "page_id int, codes array<string>, hrefs array<string>")
    doc = {"variableMeasured": [{"name": "n", "alternateName": "A"}], "citation": [{}], "distribution": [{"contentUrl": "u"}]}
    featured = audit.with_sets(audit.document_features(docs(spark, doc)), sets, "doc_id", "page_id")
    shown = spark.createDataFrame([(0, 2)], "doc_id int, n_citations int")
    wanted = {"variables": True, "citations": False, "download": True}
    assert {r.rule: r.ok for r in audit.check_plan(featured, shown).collect()} == wanted
    counted = sets.withColumn("n_shown", F.lit(9))
    again = audit.with_sets(audit.document_features(docs(spark, doc)), counted, "doc_id", "page_id")
    assert {r.rule: r.ok for r in audit.check_plan(again).collect()} == wanted
    (cover,) = audit.variable_coverage(docs(spark, doc)).collect()
    assert (cover.temporal, cover.spatial) == ("Static", "not detected")


# ---- failures and identity -------------------------------------------------------------------------


def test_failure_report(spark, tmp_path):
    from metaloom.sources.writers import write_report

    df = spark.createDataFrame([("a", "u1", "timeout"), ("b", "u2", "HTTP 500"), ("c", "u3", "timed out")], "name string, url string, message string")
    classified = failures.classify(df)
    assert {(r.reason, r.title, r.n) for r in failures.by_reason(classified).collect()} == {("timeout", "Timeout", 2), ("server_error", "Server Error", 1)}
    write_report(failures.report_rows(classified, "name", "url"), str(tmp_path / "r"), "reason")
    assert spark.read.json(str(tmp_path / "r")).filter("reason = 'timeout'").count() == 2


def test_identity(spark):
    sha = hashlib.sha1(b"x").hexdigest()
    df = spark.createDataFrame([(f"/a/{sha}.jsonld", "a", "x"), (f"/b/{sha}.jsonld", "b", "x"), (f"/b/{'0' * 40}.jsonld", "b", "y"), ("/b/name.jsonld", "b", "z")], "path string, site string, raw string")
    assert [tuple(r) for r in documents.duplicates(df).collect()] == [(sha, 2, 2)]
    assert {r.path: r.intact for r in documents.integrity(df).collect()} == {f"/a/{sha}.jsonld": True, f"/b/{sha}.jsonld": True, f"/b/{'0' * 40}.jsonld": False}


def test_source_facts_join_the_prompt(spark):
    from metaloom.operators import pages

    html = '<a href="/d.zip">Download</a><p>Data Citation</p><p>Doe</p><table><tr><td>t</td><td>T</td></tr></table>'
    captured = spark.createDataFrame([("https://s", "https://s", html)], "url string, base_url string, html string")
    facts = pages.facts_json(pages.with_facts(captured, "url"), "url")
    found, _ = detected(spark, '{"name":"a"}', "nothing")
    merged = responses.merge_metadata(found, spark.createDataFrame([(0,)], "row_id int"), "k", "row_id")
    joined = responses.with_source_facts(merged, facts)
    rows = responses.generation_requests(joined, "{EXTRACTED_METADATA}", "k", F.lit("")).orderBy("k").collect()
    first, second = (json.loads(r.prompt.replace("{{", "{").replace("}}", "}")) for r in rows)
    assert first["name"] == "a" and first["source_facts"] == second["source_facts"] == {
        "download_links": [{"label": "Download", "href": "https://s/d.zip"}],
        "citation_text": [{"label": "Data Citation", "text": "Doe"}],
        "variables": [{"name": "T", "alternateName": "t", "unitText": "", "description": "T"}],
    }
    assert [(r.j, r.n) for r in found.orderBy("k").collect()] == [(1, 1), (1, 1)]

"""Sitemaps, catalogues, walks and redirects."""

from __future__ import annotations

import json
import random
from collections import deque
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from metaloom.functions.variants import with_value
from metaloom.operators import catalog, crawl
from metaloom.plans import files
from metaloom.session import ensure_checkpoint_dir


def values(spark, *items):
    rows = [(i, json.dumps(d)) for i, d in enumerate(items)]
    return with_value(spark.createDataFrame(rows, "doc_id int, raw string"))


CATALOGUE = {
    "@type": "DataCatalog", "@id": "cat", "url": "https://c/0",
    "hasPart": [{"url": "https://c/1"}, {"name": "x"}, {"url": "https://c/2"}],
    "dataset": [{"@id": "ds1"}, {"@id": "ds2"}],
    "isPartOf": [{"url": "https://root"}],
}


def test_catalogue_edges(spark):
    docs = values(spark, CATALOGUE, {"url": "https://c/1", "isPartOf": "cat"}, {"hasPart": [{"url": "u"}]})
    edges = {(r.parent_id, r.relation, r.child_id) for r in catalog.catalogue_edges(docs).collect()}
    assert edges == {
        ("cat", "hasPart", "https://c/1"),
        ("cat", "hasPart", "https://c/2"),
        ("cat", "dataset", "ds1"),
        ("cat", "dataset", "ds2"),
        ("https://root", "isPartOf", "cat"),
        ("cat", "isPartOf", "https://c/1"),
    }
    parts = catalog.part_urls(docs, "doc_id").orderBy("doc_id", "pos").collect()
    assert [(r.doc_id, r.pos, r.url) for r in parts] == [(0, 0, "https://c/1"), (0, 2, "https://c/2"), (2, 0, "u")]
    assert catalog.part_urls(values(spark, {"hasPart": {"url": "u"}})).count() == 0  # a single object is no list


def test_references(spark):
    docs = values(spark, {"@id": "p", "mainEntity": {"@id": "d"}, "about": [{"@id": "d"}, {"@id": "gone"}, "text"]}, {"@id": "d", "name": "N", "isPartOf": {"@id": "p"}}, {"@id": "e", "isPartOf": "nowhere"})
    refs = catalog.page_references(docs)
    assert sorted((r.relation, r.child_id) for r in refs.collect()) == [("about", "d"), ("about", "gone"), ("mainEntity", "d")]
    ids = docs.select(catalog.document_id(F.col("v")).alias("id"))
    assert [r.child_id for r in catalog.dangling(refs, ids).collect()] == ["gone"]
    names = spark.createDataFrame([("d", "N"), ("d", "M")], "id string, name string")
    shown = catalog.with_target(refs, names, "id", "name").collect()
    assert sorted((r.child_id, r["name"]) for r in shown if r["name"]) == [("d", "M"), ("d", "M")] and len(shown) == 3
    assert {(r.child_id, r.parent_id, r.present) for r in catalog.parent_links(docs).collect()} == {("d", "p", True), ("e", "nowhere", False)}


def test_reconcile_and_changes(spark):
    listed = spark.createDataFrame([("a",), ("a",), ("b",), ("x/Sitemap.XML",)], "loc string")
    present = spark.createDataFrame([("a",), ("c",), ("c",)], "loc string")
    got = {r.loc: r.state for r in catalog.reconcile(listed, present).collect()}
    assert got == {"a": "both", "b": "missing", "x/Sitemap.XML": "nested_sitemap", "c": "unlisted"}
    entries = spark.createDataFrame([("a", "2024-01-10"), ("b", "2024-01-20"), ("c", None), ("d", "2024-01-15T00:00:00+02:00")], "loc string, lastmod string")
    assert {r["loc"] for r in catalog.changed_since(entries, "2024-01-15T00:00:00Z").collect()} == {"b", "c"}
    both = catalog.union_sitemaps(entries, spark.createDataFrame([("a", "2024-02-01")], "loc string, lastmod string"))
    assert {r["loc"]: r.lastmod for r in both.collect()}["a"] == "2024-02-01" and both.count() == 4


# ---- walks -----------------------------------------------------------------------------------------


def queue_order(edges, seed, depth_limit=None):
    """The visited pages as a first-in-first-out queue meets them, with their depth."""
    depth, order, queue = {seed: 0}, [seed], deque([seed])
    while queue:
        page = queue.popleft()
        if depth_limit is not None and depth[page] == depth_limit:
            continue
        for dst in edges.get(page, []):
            if dst not in depth:
                depth[dst] = depth[page] + 1
                order.append(dst)
                queue.append(dst)
    return order, depth


@pytest.mark.parametrize("seed", [1, 2])
def test_walk_is_the_queue_walk(spark, monkeypatch, seed):
    rng = random.Random(seed)
    edges = {n: [rng.randrange(60) for _ in range(rng.randrange(4))] for n in range(60)}
    edges[0] += [5, 9, 5]
    rows = [(s, d, i) for s, ds in edges.items() for i, d in enumerate(ds)]
    df = spark.createDataFrame(rows, "src int, dst int, pos int")
    start = spark.createDataFrame([(0,)], "url int")
    if seed == 2:
        monkeypatch.setattr(crawl, "HUB_SHARE", 1000)  # nearly every page is kept in parts
    order, depth = queue_order(edges, 0)
    walked = crawl.visit_order(crawl.crawl(df, start)).collect()
    assert [r.url for r in walked] == order and {r.url: r.depth for r in walked} == depth
    queue = crawl.crawl_queue(df, start)
    assert [r.url for r in queue.orderBy("place").collect()] == order
    assert [r.place for r in queue.orderBy("place").collect()] == list(range(1, len(order) + 1))
    short = crawl.crawl(df.drop("pos"), start, max_depth=2).collect()
    assert {r.url: r.depth for r in short} == queue_order(edges, 0, 2)[1]


def test_levels_move_neither_links_nor_visited_pages(spark, monkeypatch):
    plans = []
    write = crawl._Buckets.write

    def watched(self, df, *keys):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(self, df, *keys)

    monkeypatch.setattr(crawl._Buckets, "write", watched)
    links = [(0, i) for i in range(1, 500)] + [(i, (i * 7) % 900) for i in range(1, 800)]
    crawl.crawl(spark.createDataFrame(links, "src int, dst int"), spark.createDataFrame([(0,)], "url int"), 3)
    levels = [p.splitlines() for p in plans if "salt" in p and "LeftOuter" in p and "Bucketed: true" in p]
    assert len(levels) == 3
    for lines in levels:
        # One exchange for the frontier, one for what it reaches: links and visited pages stay in their buckets.
        assert sum("Exchange hashpartitioning" in line for line in lines) == 2
        links_at = next(i for i, line in enumerate(lines) if "FileScan" in line and "dst#" in line)
        indent = lambda line: len(line) - len(line.lstrip(" :+-"))
        depth, above = indent(lines[links_at]), []
        for line in reversed(lines[:links_at]):
            if indent(line) < depth:
                depth = indent(line)
                above.append(line)
        assert [x for x in above if "Exchange" in x][:1] and "hashpartitioning(url" in [x for x in above if "Exchange" in x][0]


def test_levels_of_texts_stream_past_hash_tables(spark, monkeypatch):
    plans = []
    write = crawl._Buckets.write

    def watched(self, df, *keys):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(self, df, *keys)

    monkeypatch.setattr(crawl._Buckets, "write", watched)
    links = [(f"p{i}", f"p{(i * k + 1) % 300}") for i in range(300) for k in (2, 3)]
    edges = spark.createDataFrame(links, "src string, dst string")
    crawl.crawl(edges, spark.createDataFrame([("p0",)], "url string"), 3)
    levels = [p for p in plans if "_met" in p]
    assert len(levels) == 3
    for plan in levels:
        # Neither links nor visited pages are sorted or moved, and no text is read.
        assert "Sort" not in plan and plan.count("Exchange hashpartitioning") == 1
        assert "string" not in plan and plan.count("ShuffledHashJoin") >= 2


def test_walk_over_many_levels_and_addresses_that_share_a_hash(spark, monkeypatch):
    tried = []

    def clashing(page, attempt):
        tried.append(attempt)
        return F.length(page).cast("long") if attempt < 2 else F.xxhash64(page, F.lit(attempt))

    monkeypatch.setattr(crawl, "_hash", clashing)
    monkeypatch.setattr(crawl, "TIERS", 2)
    links = [(f"n{i}", f"n{i + 1}") for i in range(9)] + [("n4", "n1"), ("n0", "x"), (None, "n7"), ("n0", None), ("n2", None)]
    edges = spark.createDataFrame(links, "src string, dst string")
    walked = crawl.crawl(edges, spark.createDataFrame([("n0",)], "url string")).collect()
    # A link to nothing is met at every level that has one.
    wanted = [(f"n{i}", i) for i in range(10)] + [("x", 1), (None, 1), (None, 3)]
    assert sorted((str(r.url), r.depth) for r in walked) == sorted((str(u), d) for u, d in wanted)
    assert set(tried) == {0, 1, 2}


def test_walk_in_sorted_joins_gives_the_same(spark, monkeypatch):
    monkeypatch.setattr(crawl, "HASHED_ROWS", 0)
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("a", "c"), ("c", "d"), ("d", "a")], "src string, dst string")
    walked = crawl.crawl(edges, spark.createDataFrame([("a",)], "url string")).collect()
    assert {r.url: r.depth for r in walked} == {"a": 0, "b": 1, "c": 1, "d": 2}


def test_walk_from_nowhere(spark):
    edges = spark.createDataFrame([(1, 2)], "src int, dst int")
    assert crawl.crawl(edges, spark.createDataFrame([], "url int")).count() == 0
    assert crawl.crawl(edges, spark.range(3).select(F.col("id").cast("int").alias("url")).filter("false")).count() == 0
    assert crawl.crawl(edges.filter("false"), spark.createDataFrame([(1,)], "url int")).count() == 1


def test_walk_stays_in_its_domains(spark):
    edges = spark.createDataFrame([("https://a.org/", "https://a.org/1"), ("https://a.org/", "https://b.org/"), ("https://b.org/", "https://a.org/2")], "src string, dst string")
    start = spark.createDataFrame([("https://a.org/",), ("https://a.org/",)], "url string")
    assert {r.url for r in crawl.crawl(edges, start, domains=["a.org"]).collect()} == {"https://a.org/", "https://a.org/1"}
    new = crawl.new_links(spark.createDataFrame([("x",), ("y",), ("y",)], "url string"), spark.createDataFrame([("x",)], "url string"))
    assert [r.url for r in new.collect()] == ["y"]


def test_hub_with_a_third_of_all_links(spark):
    hub = spark.range(3000).select(F.lit("hub").alias("src"), F.col("id").cast("string").alias("dst"))
    back = spark.range(3000).select(F.col("id").cast("string").alias("src"), F.lit("hub").alias("dst"))
    chain = spark.range(3000).select(F.col("id").cast("string").alias("src"), (F.col("id") + 1).cast("string").alias("dst"))
    start = spark.createDataFrame([("hub",)], "url string")
    walked = crawl.crawl(hub.unionByName(back).unionByName(chain), start)
    assert {r.depth: r["count"] for r in walked.groupBy("depth").count().collect()} == {0: 1, 1: 3000, 2: 1}


def test_catalogue_walk(spark):
    edges = spark.createDataFrame([("r", "a"), ("r", "b"), ("a", "c"), ("c", "r"), ("r", "a")], "parent_id string, child_id string")
    roots = spark.createDataFrame([("r",)], "url string")
    got = {r.url: (r.depth, r.leaf) for r in crawl.catalogue_walk(edges, roots).collect()}
    assert got == {"r": (0, False), "a": (1, False), "b": (1, True), "c": (2, False)}
    assert crawl.catalogue_walk(edges, roots, max_depth=1).count() == 3
    assert crawl.sitemap_of_walk(crawl.catalogue_walk(edges, roots)).columns == ["loc"]


def follow(table, start, limit):
    page, seen, hops = start, False, 0
    while page in table and table[page][0] is not None and 300 <= table[page][1] < 400:
        seen |= table[page][1] == 303
        page, hops = table[page][0], hops + 1
        if hops > (limit or 10_000):
            return None
    return (page, hops) if seen and hops else None


@pytest.mark.parametrize("limit", [None, 30, 3])
def test_redirects(spark, limit):
    rng = random.Random(7)
    table = {i: (i + 1 if rng.random() < 0.9 else None, rng.choice([301, 302, 303, 200])) for i in range(120)}
    table |= {500 + i: (501 + i, 303 if i == 0 else 302) for i in range(40)}  # longer than one limit
    table |= {900: (901, 303), 901: (900, 302), 902: (902, 303)}  # loops
    table |= {1000 + i: (500 + 39, 303) for i in range(200)}  # many to one target
    df = spark.createDataFrame([(k, *v) for k, v in table.items()], "from_id int, to_id int, status int")
    got = {r.from_id: (r.final_id, r.hops) for r in crawl.final_targets(df, limit).collect()}
    wanted = {k: follow(table, k, limit) for k in table}
    assert got == {k: v for k, v in wanted.items() if v}


def stub_session(current=None, named=None, master="yarn"):
    """The parts of a session that the checkpoint folder depends on."""
    state = {"dir": current}
    context = SimpleNamespace(
        master=master,
        getCheckpointDir=lambda: state["dir"],
        setCheckpointDir=lambda d: state.update(dir=d),
    )
    return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: named))


def test_checkpoint_folder(tmp_path):
    assert ensure_checkpoint_dir(stub_session("hdfs:/set", "hdfs:/named")) == "hdfs:/set"
    assert ensure_checkpoint_dir(stub_session(None, "hdfs:/named")) == "hdfs:/named"
    with pytest.raises(ValueError):
        ensure_checkpoint_dir(stub_session())  # a machine's own folder is no use on a cluster
    assert "metaloom-checkpoint" in ensure_checkpoint_dir(stub_session(master="local[2]"))


def test_inverse_quads_deal_out_a_small_file(spark, tmp_path):
    parts = spark.range(40).selectExpr("id AS p_partkey", "concat('n', id) AS p_name", "'t' AS p_type", "id AS p_size")
    parts.coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    rows = files.inverse_quads(spark, str(tmp_path))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "RoundRobinPartitioning" in plan[plan.index("MapInArrow") :] and rows.count() == 240

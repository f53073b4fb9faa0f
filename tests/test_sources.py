"""Scans and sinks, over files written here."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from metaloom.operators.validation import check_documents
from metaloom.sources import readers, writers
from metaloom.streaming import folder
from metaloom.streaming.folder import check_stream, run_available, stream_documents


@pytest.fixture()
def corpus(tmp_path):
    root = tmp_path / "docs"
    for site, name, body in [
        ("s 1", "a.jsonld", {"@context": "c", "@type": "Dataset", "name": "é\nx"}),
        ("s2", "b+c.jsonld", {"@type": "Dataset"}),
    ]:
        (root / site).mkdir(parents=True, exist_ok=True)
        (root / site / name).write_text(json.dumps(body, indent=2), encoding="utf-8")
    (root / "s2" / "bad.jsonld").write_text("{oops")
    (root / "s2" / "ignored.txt").write_text("{}")
    return root


def test_documents(spark, corpus, tmp_path):
    docs = readers.read_documents(spark, str(corpus))
    rows = {r.path.rsplit("/", 1)[1]: r for r in docs.select("path", "site", "raw", F.col("v").isNull().alias("bad")).collect()}
    assert set(rows) == {"a.jsonld", "b+c.jsonld", "bad.jsonld"}
    assert rows["a.jsonld"].site == "s 1" and rows["bad.jsonld"].bad and not rows["a.jsonld"].bad
    assert json.loads(rows["a.jsonld"].raw)["name"] == "é\nx"
    readers.land_documents(docs, str(tmp_path / "bronze"))
    landed = spark.read.parquet(str(tmp_path / "bronze"))
    assert dict(landed.dtypes)["v"] == "variant" and landed.count() == 3
    assert {r.site for r in readers.existing_sites(docs).collect()} == {"s 1", "s2"}
    with_one = readers.with_example(spark.range(2), docs, "/a.jsonld").collect()
    assert len(with_one) == 2 and with_one[0].example.startswith("{")
    assert readers.with_example(spark.range(1), docs, "/none.jsonld").head().example == ""


def test_documents_are_listed_by_tasks_as_a_scan_lists_them(spark, tmp_path, monkeypatch):
    root = tmp_path / "a b#%"
    texts = {
        "x.jsonld": b"{}", "s 1/a+b.jsonld": b'{"a":"\xc3\xa9"}', "s2/deep/%41.jsonld": b"\xff bad", "s2/empty.jsonld": b"",
        "s2/_h.jsonld": b"1", "s2/_h=1.jsonld": b"1", ".hid/a.jsonld": b"1", "_x/a.jsonld": b"1", "s2/A.JSONLD": b"1",
        "s2/a.txt": b"1", "s2/a\nb.jsonld": b"2", "s2/c._COPYING_": b"1", "_p=1/a.jsonld": b"4",
    }
    for name, data in texts.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(data)

    def rows(docs):
        shown = docs.select("path", "site", F.hex(F.col("raw").cast("binary")).alias("raw"), F.col("v").isNull().alias("bad"), "modified")
        return sorted(map(tuple, shown.collect()))

    cases = [(f, p) for f in (str(root), f"file:{root}", f"file://{root}/") for p in ("*.jsonld", "a?b.jsonld", "*", "[!a]*")]
    read = [readers.read_documents(spark, *case) for case in cases]
    # No file is known to the driver.
    assert read[0].inputFiles() == [] and read[0].rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    listed = [rows(docs) for docs in read]
    monkeypatch.setattr(readers, "_documents_of_folder", lambda *given: None)
    assert listed == [rows(readers.read_documents(spark, *case)) for case in cases]
    assert len(listed[0]) == 6


def test_a_batch_of_a_stream_writes_few_files(spark, tmp_path):
    for i in range(400):
        (tmp_path / "in" / f"s{i % 2}").mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / f"s{i % 2}" / f"{i}.jsonld").write_text('{"name":1}')
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(name)
    stream = stream_documents(spark, str(tmp_path / "in"))
    assert int(stream.sparkSession.conf.get(name)) <= 32 and spark.conf.get(name) == before
    assert stream.sparkSession.conf.get("spark.sql.session.timeZone") == spark.conf.get("spark.sql.session.timeZone")
    run_available(check_stream(stream), str(tmp_path / "out"), str(tmp_path / "mark")).awaitTermination()
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 400 and len(back.inputFiles()) == 2


def checked_now(spark, folder, target, mark, **given):
    run_available(check_stream(stream_documents(spark, str(folder), **given)), str(target), str(mark)).awaitTermination()
    return sorted(tuple(r) for r in spark.read.parquet(str(target)).select("path", "site", "ok", "errors").collect())


def test_a_stream_knows_lists_of_names_and_no_documents(spark, tmp_path, monkeypatch):
    root = tmp_path / "a b#%"
    texts = {
        "x.jsonld": "{}", "s 1/a+b.jsonld": '{"a":"é"}', "s2/deep/%41.jsonld": "bad", "s2/empty.jsonld": "", "s2/_h.jsonld": "1",
        ".hid/a.jsonld": "1", "s2/a.txt": "1", "s2/c._COPYING_": "1", "s2/d.jsonld": '{"@context":"c","@type":"Dataset","name":"n"}',
        "s3/e.jsonld": "[]", "s3/f.jsonld": "{}",
    }
    for name, text in texts.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_text(text, encoding="utf-8")
    got = checked_now(spark, root, tmp_path / "out", tmp_path / "mark", files_per_batch=3)
    # Seven files of at most three a batch, one of them empty; the source's log has the lists only.
    assert len(got) == 6 and len([f for f in os.listdir(tmp_path / "mark" / "commits") if f.isdigit()]) == 3
    logged = "".join((tmp_path / "mark" / "sources" / "0" / f).read_text() for f in os.listdir(tmp_path / "mark" / "sources" / "0") if f[0] != ".")
    assert "part-" in logged and "jsonld" not in logged
    # A stream of its own sees all of them, however many a batch; a file that is gone since has no row.
    (root / "s3" / "f.jsonld").unlink()
    assert len(checked_now(spark, root, tmp_path / "out2", tmp_path / "mark2")) == 5
    (root / "s3" / "f.jsonld").write_text("{}")
    assert checked_now(spark, root, tmp_path / "out", tmp_path / "mark") == got
    monkeypatch.setattr(folder, "files_of_folder", lambda *given: None)
    assert got == checked_now(spark, root, tmp_path / "out3", tmp_path / "mark3")
    monkeypatch.undo()
    with pytest.raises(ValueError, match="begun by a stream of files"):
        checked_now(spark, root, tmp_path / "out3", tmp_path / "mark3")


def test_a_stream_that_is_kept_sees_what_came_later(spark, corpus, tmp_path):
    checked = check_stream(stream_documents(spark, str(corpus), names=str(tmp_path / "names")))
    for n in (3, 4):
        run_available(checked, str(tmp_path / "out"), str(tmp_path / "mark")).awaitTermination()
        assert spark.read.parquet(str(tmp_path / "out")).count() == n
        (corpus / "s2" / f"{n}.jsonld").write_text("{}")
    assert not (corpus / "_names").exists()


def test_a_name_is_listed_once_by_runs_at_a_time(spark, corpus, tmp_path, monkeypatch):
    names = f"{tmp_path}/names/list"
    store = folder._Store(spark, names)
    assert store.made()
    last, seen = folder._Store.last, []

    def late(self):
        if not seen:
            # Another run lists the folder after this one saw the last number and before it takes the next.
            seen.append(0)
            was = last(self)
            take = folder._Store.take

            def first(self, source, name):
                monkeypatch.setattr(folder._Store, "take", take)
                folder.list_names(spark, str(corpus), "*.jsonld", names, 2)
                return take(self, source, name)

            monkeypatch.setattr(folder._Store, "take", first)
            return was
        return last(self)

    monkeypatch.setattr(folder._Store, "last", late)
    folder.list_names(spark, str(corpus), "*.jsonld", names, 2)
    rows = spark.read.option("recursiveFileLookup", True).parquet(names)
    assert sorted(r.path for r in rows.collect()) == ["s 1/a.jsonld", "s2/b+c.jsonld", "s2/bad.jsonld"] and len(rows.inputFiles()) == 2
    assert os.listdir(names) == ["00000001"] and os.listdir(tmp_path / "names") == ["list"]


def test_registry(spark, tmp_path):
    path = tmp_path / "r.csv"
    path.write_text(
        'Dataset Name,hasJSONLD?,Dataset Webpage URL,Description,Extra\n"A ""q"", b",#ERROR!,https://a,"two\nlines",x\nB,,,,\n',
        encoding="utf-8",
    )
    rows = readers.read_registry(spark, str(path)).orderBy("row_id").collect()
    assert [(r["name"], r.has_jsonld, r.webpage_url, r.description, r.publisher) for r in rows] == [
        ('A "q", b', "#ERROR!", "https://a", "two\nlines", ""),
        ("B", "", "", "", ""),
    ]


def test_sitemaps(spark, tmp_path):
    (tmp_path / "maps").mkdir()
    head = '<?xml version="1.0" encoding="UTF-8"?>\n'
    ns = 'xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"'
    (tmp_path / "maps" / "one.xml").write_text(f"{head}<urlset {ns}><url><loc> https://a/1 </loc><lastmod>2024-01-02</lastmod></url><url><loc>https://a/2?x=1&amp;y=2</loc></url></urlset>")
    (tmp_path / "maps" / "broken.xml").write_text(f"{head}<urlset {ns}><url><loc>https://b/?x=1&y=2</loc><priority>0.8</priority></url></urlset>")
    (tmp_path / "index.xml").write_text(f'{head}<sitemapindex xmlns="other"><sitemap><loc>https://h/maps/one.xml</loc><lastmod>2023-11-13</lastmod></sitemap><sitemap><loc>https://h/blob/x.xml</loc></sitemap></sitemapindex>')
    entries = readers.read_sitemap(spark, str(tmp_path / "maps"))
    got = {r["loc"]: (r.lastmod, r.priority) for r in entries.collect()}
    assert got == {"https://a/1": ("2024-01-02", None), "https://a/2?x=1&y=2": (None, None), "https://b/?x=1&y=2": (None, "0.8")}
    index = readers.read_sitemap_index(spark, str(tmp_path / "index.xml"))
    assert {r["loc"]: r.is_page for r in index.collect()} == {"https://h/maps/one.xml": False, "https://h/blob/x.xml": True}
    assert readers.expand_sitemap_index(index, entries, str(tmp_path), "https://h").count() == 2
    assert readers.expand_sitemap_index(index, entries, str(tmp_path), "https://other").count() == 0


def test_sitemap_round_trip(spark, tmp_path):
    entries = spark.createDataFrame([("https://a/?x=1&y=<2>", "2024-01-02"), ("https://b/é", None)], "loc string, lastmod string")
    writers.write_sitemap(entries.coalesce(1), str(tmp_path / "out"))
    files = [f for f in os.listdir(tmp_path / "out") if f.startswith("part-")]
    text = "".join((tmp_path / "out" / f).read_text(encoding="utf-8") for f in files)
    assert 'xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"' in text and "&amp;" in text and text.strip().endswith("</urlset>")
    for f in files:
        (tmp_path / "in").mkdir(exist_ok=True)
        os.link(tmp_path / "out" / f, tmp_path / "in" / (f if f.endswith(".xml") else f + ".xml"))
    back = readers.read_sitemap(spark, str(tmp_path / "in"))
    assert {(r["loc"], r.lastmod) for r in back.collect()} == {tuple(r) for r in entries.collect()}


def test_sitemap_of_documents(spark, corpus):
    docs = readers.read_documents(spark, str(corpus))
    rows = writers.sitemap_of_documents(docs, str(corpus), "https://raw.example/data/").collect()
    assert "https://raw.example/data/s2/bad.jsonld" in {r["loc"] for r in rows} and all(r.lastmod.endswith("Z") for r in rows)


def test_quads_round_trip(spark, tmp_path):
    sha = "a" * 40
    text = f'<s> <p> "v\\n" <urn:h:o:one:data:{sha}> .\n<s> <p> <o> <urn:h:o:two:data:{sha}> .\n<s> <p> "x"@en <other> .\n'
    (tmp_path / "in.nq").write_text(text)
    quads = readers.read_quads(spark, str(tmp_path / "in.nq"))
    writers.write_release(quads, str(tmp_path / "out"))
    assert {d for d in os.listdir(tmp_path / "out") if "=" in d} == {"source=one", "source=two", "source=unknown"}
    back = readers.read_quads(spark, str(tmp_path / "out"))
    columns = ["s", "p", "o", "value", "kind", "g"]
    assert sorted(map(tuple, back.select(columns).collect())) == sorted(map(tuple, quads.select(columns).collect()))


def test_publish(spark, tmp_path):
    docs = spark.createDataFrame(
        [("My Site (1)", "Data set", "https://u/1", "old", 1), ("My Site (1)", "Data set", "https://u/1", "néw", 2), ("Z", "!!", "https://u/2", "z", 1)],
        "site string, name string, url string, raw string, made int",
    )
    named = writers.latest_outputs(writers.name_outputs(docs, "site", "name", "url"), "made")
    target = tmp_path / "out"
    written = writers.publish_files(named, str(target)).collect()
    assert {(r.folder, r.n_bytes) for r in written} == {("My_Site_1", 4), ("Z", 1)}
    (name,) = os.listdir(target / "My_Site_1")
    assert name.startswith("Data_set_") and (target / "My_Site_1" / name).read_text(encoding="utf-8") == "néw"
    assert os.listdir(target / "Z")[0].startswith("dataset_")
    writers.write_output_table(named, str(tmp_path / "table"))
    assert spark.read.parquet(str(tmp_path / "table")).count() == 2


def test_store_addresses(tmp_path):
    assert writers.store_address("s3a://bucket/a") == "s3://bucket/a" and writers.store_address("gs://b/c") == "gs://b/c"
    assert writers.store_address("abfss://c@acc.dfs.core.windows.net/d") == "abfs://c@acc.dfs.core.windows.net/d"
    assert writers.store_address(f"file:{tmp_path}") == f"file://{tmp_path}"
    assert writers.store_address(str(tmp_path)) == str(tmp_path)


def test_registry_rows_are_numbered_by_file_over_headers(spark, tmp_path):
    heads = {"b x.csv": ["Dataset Name", "Group"], "a[1].csv": ["Group", "Dataset Name"], "c.csv": ["Dataset Name"]}
    for file, head in heads.items():
        rows = [",".join(f"{file[0]}{i}" if h == "Dataset Name" else "g" for h in head) for i in range(3)]
        (tmp_path / file).write_text("\n".join([",".join(head), *rows]) + "\n")
    (tmp_path / "d.csv").write_text("Dataset Name\n")
    (tmp_path / "e.csv").write_text("Dataset Name,GROUP,group,,\n")
    got = readers.read_registry(spark, str(tmp_path)).orderBy("row_id").collect()
    assert [r["name"] for r in got] == [f"{f}{i}" for f in "abc" for i in range(3)]
    assert [r["grp"] for r in got] == ["g"] * 6 + [""] * 3 and len({r["row_id"] for r in got}) == 9
    assert list(got[0].asDict())[-1] == "row_id"


def test_template_pages_and_text(spark, tmp_path):
    (tmp_path / "t.txt").write_text("a {X}\nb")
    assert readers.read_template(spark, str(tmp_path / "t.txt")) == "a {X}\nb"
    with pytest.raises(Exception):
        readers.read_template(spark, str(tmp_path / "missing.txt"))
    assert readers.read_text_lines(spark, str(tmp_path / "t.txt")).count() == 2
    spark.createDataFrame([(1, "u", "h")], "page_id int, url string, html string").write.parquet(str(tmp_path / "p"))
    pages = readers.read_pages(spark, str(tmp_path / "p"))
    got = readers.fetch_captured(spark.createDataFrame([("u",), ("w",)], "url string"), pages).collect()
    assert {(r.url, r.html) for r in got} == {("u", "h"), ("w", None)}


def test_stream_sees_new_files_once(spark, corpus, tmp_path):
    target, mark = str(tmp_path / "checked"), str(tmp_path / "mark")

    def run():
        query = run_available(check_stream(stream_documents(spark, str(corpus))), target, mark)
        assert query.awaitTermination(120)
        return {r.path.rsplit("/", 1)[1]: r.ok for r in spark.read.parquet(target).collect()}

    assert run() == {"a.jsonld": True, "b+c.jsonld": False, "bad.jsonld": False}
    (corpus / "s2" / "new.jsonld").write_text('{"@context":"c","@type":"Dataset","name":"n"}')
    assert len(run()) == 4 and spark.read.parquet(target).count() == 4


def test_report(spark, corpus, tmp_path):
    checked = check_documents(readers.read_documents(spark, str(corpus))).select("path", "site", "ok", "messages")
    writers.write_report(checked, str(tmp_path / "report"), "ok")
    assert spark.read.json(str(tmp_path / "report")).filter("not ok").count() == 2

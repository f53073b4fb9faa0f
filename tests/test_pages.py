"""Reading html and drawing facts from it."""

from __future__ import annotations

from html.parser import HTMLParser

from hypothesis import given, settings, strategies as st

from metaloom.functions.markup import PageReader, read_page
from metaloom.operators import pages

PAGE = """<!DOCTYPE html><html><head><title> T &amp; t </title><style>p{}</style>
<script type="application/ld+json">{"name": "one"}</script>
<script id='x' type='application/ld+json'>
 [1, 2]
</script><script>var s = "<a href='no'>no</a>";</script></head><body>
<!-- <a href="hidden">hidden</a> -->
<A HREF='/f?a=1&amp;b=2'>Down<b>load</b> &copy;</A><a name="x">no href</a><a href>bare</a>
<a href="x.csv"> the
DATA </a><a href="/f?a=1&amp;b=2">Down<b>load</b> &copy;</a><a href="get/download.zip"></a><a href="about">About</a>
<p>Model Citation</p>  <p>Doe 2020</p>
<p>Data Citation</p><p></p><p>Data Citation
Roe 2021</p>
<table><tr><th>Code</th><th>Name</th></tr>
<tr><td> tas </td><td>Air <i>temperature</i></td><td>K</td><td>more</td></tr>
<tr><td>TAS</td><td>again</td></tr><tr><td>9x</td><td>bad</td></tr><tr><td>only</td></tr><tr><td>e</td><td></td></tr></table>
<p>Overview Variables</p><p>(no) skipped</p><p>Wind</p><p>(ws) m/s mean  wind </p><p>Rain</p><p>(pr)</p><p>Air</p><p>(Tas) K</p>
<div>open <p>left open
</body></html>"""


def frame(spark, rows):
    return spark.createDataFrame(rows, "page_id int, base_url string, html string")


def pages_of(spark):
    return frame(
        spark, [(1, "https://ex.org/d/i.html", PAGE), (2, "https://ex.org/", None), (3, "https://ex.org/", "plain text")]
    )


def test_reader_follows_open_and_close_rules():
    got = read_page("<div>a<p>b<span>c</div>d</p>e<a href=u>f<a href='v'>g</a>h</a>i<br/>j<img alt=x>k")
    assert got["text"] == "a b c d e f g h i j k"
    # The first end tag closes the inner anchor, the second one the outer anchor.
    assert got["anchors"] == [{"label": "f g h", "href": "u"}, {"label": "g", "href": "v"}]
    nested = read_page("<table><tr><td>1<table><tr><td>2</td></tr></table></td><td>3</td></tr></table>")
    assert nested["rows"] == [["1 2", "2", "3"], ["2"]]
    silent = read_page("<template><a href=t>x</a></template><ruby>k<rt>r</rt></ruby>y")
    assert silent["text"] == "k y" and silent["anchors"] == [{"label": "", "href": "t"}]
    assert read_page(None)["text"] == "" and read_page("<a")["anchors"] == []


def test_links_keep_order_and_repeats(spark):
    rows = pages.page_links(pages_of(spark)).orderBy("page_id", "pos").collect()
    assert [r.href for r in rows] == ["/f?a=1&b=2", "", "x.csv", "/f?a=1&b=2", "get/download.zip", "about"]
    assert [r.label for r in rows][:3] == ["Down load ©", "bare", "the\nDATA"]
    distinct = pages.distinct_links(pages.page_links(pages_of(spark)))
    assert {(r.href, r.first_pos) for r in distinct.collect()} == {
        ("/f?a=1&b=2", 0), ("", 1), ("x.csv", 2), ("get/download.zip", 4), ("about", 5),
    }


def test_text(spark):
    got = {r.page_id: r.text for r in pages.page_text(pages_of(spark)).collect()}
    assert got[1].startswith("T & t Down load © no href bare the\nDATA Down load ©")
    assert "var s" not in got[1] and "hidden" not in got[1] and got[1].endswith("open left open")
    assert got[2] == "" and got[3] == "plain text"


def test_facts(spark):
    facts = pages.with_facts(pages_of(spark))
    links = {(r.label, r.href) for r in pages.download_links(facts).collect()}
    # "Down load" is two words, so that anchor is not taken for a data link.
    assert links == {
        ("the\nDATA", "https://ex.org/d/x.csv"),
        ("link", "https://ex.org/d/get/download.zip"),
    }
    cited = [(r.label, r.text) for r in pages.citations(facts).orderBy("pos").collect()]
    assert cited == [
        ("Model Citation", "Doe 2020"),
        ("Data Citation", "Data Citation"),
        ("Data Citation", "Roe 2021"),
    ]
    variables = [
        (r["pass"], r.code, r["name"], r.unit, r.description)
        for r in pages.source_variables(facts).orderBy("pass", "pos").collect()
    ]
    assert variables == [
        (0, "tas", "Air temperature", "K", "Air temperature"),
        (1, "ws", "Wind", "m/s", "mean  wind"),
        (1, "pr", "Rain", "", ""),
    ]
    counts = {r.page_id: tuple(r)[1:] for r in pages.fact_counts(facts).collect()}
    assert counts == {1: (2, 3, 3), 2: (0, 0, 0), 3: (0, 0, 0)}
    sets = pages.source_sets(facts).filter("page_id = 1").head()
    assert set(sets.codes) == {"tas", "ws", "pr"} and len(sets.hrefs) == 2
    long = pages.source_facts(pages_of(spark)).groupBy("kind").count().collect()
    assert {r.kind: r["count"] for r in long} == {"link": 2, "citation": 3, "variable": 3}


def test_fact_kinds_read_only_what_they_need(spark):
    one = pages.with_facts(pages_of(spark), kinds=("cited",))
    assert one.columns == ["page_id", "cited"] and one.filter("size(cited) > 0").count() == 1


def test_embedded_documents(spark):
    rows = pages.ld_json_blocks(pages_of(spark)).orderBy("pos").collect()
    assert [r.raw for r in rows] == ['{"name": "one"}', "[1, 2]"]
    assert all(r.v is not None for r in rows)


def test_extract_with_own_function(spark):
    def words(html):
        for word in html.split()[:2]:
            yield (word, len(word))

    rows = pages.extract(pages_of(spark).filter("page_id = 3"), words, "word string, n int").collect()
    assert [(r.pos, r.word, r.n) for r in rows] == [(0, "plain", 5), (1, "text", 4)]


def test_hosts_count_a_link_once_per_page(spark):
    html = '<a href="https://a.org/1">x</a><a href="https://a.org/1">x</a><a href="https://A.org/2">x</a><a href="mailto:m">m</a>'
    df = spark.createDataFrame([(1, "https://b.org/", html), (2, "https://a.org/", '<a href="/1">y</a>')], "page_id int, url string, html string")
    got = {r.host: (r.n_pages, r.n_links) for r in pages.links_per_host(df).collect()}
    assert got == {"a.org": (2, 3)}


def test_a_page_with_very_many_links(spark):
    n = 20000
    html = "".join(f'<a href="/{i % 5000}">data</a>' for i in range(n)) + "<p>" * 3000
    df = frame(spark, [(1, "https://ex.org/", html)])
    assert pages.page_links(df).count() == n
    assert pages.download_links(pages.with_facts(df, kinds=("links",))).count() == 5000


def test_html_does_not_leave_the_reading_stage(spark):
    plan = pages.download_links(pages.with_facts(pages_of(spark)))._jdf.queryExecution().optimizedPlan().toString()
    above = plan.split("MapInArrow")[0]
    assert "html" not in above


class TolerantReader(PageReader):
    """The same reader without its short cuts."""

    parse_starttag = HTMLParser.parse_starttag
    parse_endtag = HTMLParser.parse_endtag


_PIECES = st.sampled_from(
    ["<a href=\"u&amp;v\">", "<a href='x'>", "<A HREF=y>", "</a>", "<p>", "</P >", "<b/>", "<br>", "text &amp; more", "&copy", "<!-- c -->", "<",
     "<script>", "</script>", "<td>", "<tr>", "</tr>", "</td>", "<a\n href=\"q\" class=\"a>b\">", "<i class=\"x\" id=y>", "<x:y z=\"1\">", "<p", "\"", ">", "</", "<a href=\"h\"id=\"i\">"]
)


@settings(max_examples=400, deadline=None)
@given(st.lists(_PIECES, max_size=14))
def test_short_cuts_change_nothing(pieces):
    html = "".join(pieces)
    quick, slow = PageReader(), TolerantReader()
    for reader in (quick, slow):
        reader.feed(html)
        reader.close()
    assert (quick.text, quick.anchors, quick.rows) == (slow.text, slow.anchors, slow.rows)

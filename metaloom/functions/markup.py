"""HTML reading inside tasks: one pass per page, everything after it is relational."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from metaloom.shipping import ship_by_value

ship_by_value(__name__)

# Elements without content, and elements whose text is not page text.
VOID_ELEMENTS = frozenset(
    "area base br col command embed hr img input keygen link menuitem meta param source spacer track wbr".split()
)
SILENT_ELEMENTS = frozenset(["script", "style", "template", "rt", "rp"])


# Pages held as Python objects at a time.
PAGES_AT_ONCE = 256

# Tags in plain form, which the reader takes without the parser's tolerant rules.
_PLAIN_START = re.compile(r'<([a-zA-Z][a-zA-Z0-9]*)((?:\s+[a-zA-Z][-a-zA-Z0-9_:]*="[^"<>]*")*)\s*>')
_PLAIN_END = re.compile(r"</([a-zA-Z][a-zA-Z0-9]*)>")
_PLAIN_ATTRIBUTE = re.compile(r'\s([a-zA-Z][-a-zA-Z0-9_:]*)="([^"]*)"')


class PageReader(HTMLParser):
    """Collects page text, anchors and table rows of one page.

    An end tag closes the nearest open element of its name and all elements inside it; an end tag without
    an open element is ignored; an element left open reaches to the end of the page.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[str] = []
        self.counts: Counter[str] = Counter()
        self.silent = 0
        self.collectors: list[tuple[int, list[str]]] = []  # (depth, text parts) of open anchors and cells
        self.open_rows: list[tuple[int, list]] = []
        self.text: list[str] = []
        self.anchors: list[tuple[str, list[str]]] = []
        self.rows: list[list[list[str]]] = []

    def updatepos(self, i, j):
        # Line numbers are not used.
        return j

    def parse_starttag(self, i):
        plain = _PLAIN_START.match(self.rawdata, i)
        tag = plain and plain.group(1).lower()
        if not plain or tag in self.CDATA_CONTENT_ELEMENTS:
            return super().parse_starttag(i)
        self.lasttag = tag
        # Only anchors have attributes of interest.
        attrs = _PLAIN_ATTRIBUTE.findall(plain.group(2)) if tag == "a" else []
        self.handle_starttag(tag, [(name.lower(), unescape(value)) for name, value in attrs])
        return plain.end()

    def parse_endtag(self, i):
        plain = None if self.cdata_elem else _PLAIN_END.match(self.rawdata, i)
        if not plain:
            return super().parse_endtag(i)
        self.handle_endtag(plain.group(1).lower())
        return plain.end()

    def handle_starttag(self, tag, attrs):
        self._enter(tag, attrs)
        if tag in VOID_ELEMENTS:
            self._leave(tag)

    def handle_startendtag(self, tag, attrs):
        self._enter(tag, attrs)
        self._leave(tag)

    def handle_endtag(self, tag):
        if tag not in VOID_ELEMENTS:
            self._leave(tag)

    def handle_data(self, data):
        piece = data.strip()
        if piece and not self.silent:
            self.text.append(piece)
            for _, parts in self.collectors:
                parts.append(piece)

    def _enter(self, tag, attrs):
        depth = len(self.open)
        self.open.append(tag)
        self.counts[tag] += 1
        self.silent += tag in SILENT_ELEMENTS
        if tag == "a":
            given = dict(attrs)
            if "href" in given:
                parts: list[str] = []
                self.anchors.append((given["href"] or "", parts))
                self.collectors.append((depth, parts))
        elif tag == "tr":
            row: list[list[str]] = []
            self.rows.append(row)
            self.open_rows.append((depth, row))
        elif tag in ("td", "th"):
            parts = []
            for _, row in self.open_rows:
                row.append(parts)
            self.collectors.append((depth, parts))

    def _leave(self, tag):
        if not self.counts[tag]:
            return
        while True:
            name = self.open.pop()
            self.counts[name] -= 1
            self.silent -= name in SILENT_ELEMENTS
            if name == tag:
                break
        depth = len(self.open)
        while self.collectors and self.collectors[-1][0] >= depth:
            self.collectors.pop()
        while self.open_rows and self.open_rows[-1][0] >= depth:
            self.open_rows.pop()


def read_page(html: str | None) -> dict:
    """Text, lines, anchors and table rows of one page; empty for a missing page.

    A page that the parser refuses has an `error`, its beginning as text, and no parts.
    """
    reader = PageReader()
    try:
        if html:
            reader.feed(html)
            reader.close()
    except (AssertionError, ValueError, RecursionError) as error:
        head = html[:REFUSED_TEXT]
        return {"text": head, "lines": [], "anchors": [], "rows": [], "error": type(error).__name__}
    lines = [line.strip() for piece in reader.text for line in piece.splitlines()]
    return {
        "text": " ".join(reader.text),
        "lines": [line for line in lines if line],
        "anchors": [
            {"label": " ".join(parts), "href": href} for href, parts in reader.anchors
        ],
        "rows": [[" ".join(cell) for cell in row] for row in reader.rows],
        "error": None,
    }


# Fixed value: so much of a refused page stands for its text.
REFUSED_TEXT = 10000

_PART_TYPES = {
    "text": ("string", pa.string()),
    "error": ("string", pa.string()),
    "lines": ("array<string>", pa.list_(pa.string())),
    "anchors": (
        "array<struct<label:string,href:string>>",
        pa.list_(pa.struct([("label", pa.string()), ("href", pa.string())])),
    ),
    "rows": ("array<array<string>>", pa.list_(pa.list_(pa.string()))),
}


def with_page_parts(
    pages: DataFrame, keep: list[str], parts: list[str], html: str = "html"
) -> DataFrame:
    """One row per page: the kept columns and the chosen parts (text, lines, anchors, rows).

    Only the kept columns and the html enter the Python stage and the html does not leave it, so later
    shuffles carry small rows. Each page is read once, whatever number of parts is asked for.
    """
    source = pages.select(*keep, html)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in pages.select(*keep).schema]
    schema = ", ".join(fields + [f"{p} {_PART_TYPES[p][0]}" for p in parts])
    types = {p: _PART_TYPES[p][1] for p in parts}
    kept, html_name = list(keep), html

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, PAGES_AT_ONCE):
                batch = whole.slice(start, PAGES_AT_ONCE)
                found = [read_page(page) for page in batch.column(html_name).to_pylist()]
                columns = [batch.column(name) for name in kept]
                columns += [pa.array([row[p] for row in found], type=types[p]) for p in types]
                yield pa.RecordBatch.from_arrays(columns, names=kept + list(types))

    return source.mapInArrow(read, schema)


# The type attribute may be quoted either way and stand among other attributes.
_LD_JSON = (
    r"(?is)<script\b[^>]*?\btype\s*=\s*[\"']?application/ld\+json[\"']?[^>]*>(.*?)</script"
)


def ld_json_texts(html: Column) -> Column:
    """Texts of the embedded JSON-LD blocks, in page order."""
    return F.regexp_extract_all(html, F.lit(_LD_JSON), F.lit(1))

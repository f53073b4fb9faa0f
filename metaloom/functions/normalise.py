"""Repair of generated documents: boxes, keywords, encodings and the origin comment.

Column forms serve tables of shredded fields; `normalise_text` rewrites whole documents, at any depth.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, functions as F

from metaloom.functions.variants import any_text, array_at, child, is_truthy, kind, strip
from metaloom.shipping import ship_by_value

ship_by_value(__name__)

# The comment on generated metadata; the address for corrections is the publisher's own.
ORIGIN_COMMENT = (
    "This dataset metadata was generated with the use of AI and reviewed by an expert. "
    "If you see any mistakes please file an issue on GitHub at {issues_url}."
)
SHORT_ORIGIN_COMMENT = "This dataset metadata was generated by AI."


def origin_comment(issues_url: str) -> str:
    return ORIGIN_COMMENT.format(issues_url=issues_url)


# ---- column forms ----------------------------------------------------------------------------------


def _split_list(text: Column) -> Column:
    """Cut at `;` and `,`, strip, drop empty pieces."""
    return F.filter(F.transform(F.split(text, "[;,]"), strip), lambda p: p != "")


def keywords_list(doc: Column) -> Column:
    """Keywords as an array: lists lose empty items, strings are cut; NULL where there is no list.

    A blank-only item of a list stays as an empty keyword; a blank string is no list. Items that are no text print
    as JSON here.
    """
    node = child(doc, "$.keywords")
    items = F.transform(
        F.filter(array_at(doc, "$.keywords"), is_truthy), lambda item: strip(any_text(item))
    )
    text = strip(any_text(node))
    return F.when(kind(node) == "ARRAY", items).when(
        (kind(node) == "STRING") & (text != ""), _split_list(text)
    )


def encoding_list(node: Column) -> Column:
    """An `encodingFormat` node as an array of formats; NULL where it is neither text nor list."""
    text = strip(any_text(node))
    items = F.try_variant_get(node, "$", "array<variant>")
    cut = F.flatten(
        F.transform(
            F.filter(items, is_truthy),
            lambda item: F.when(
                (kind(item) == "STRING") & strip(any_text(item)).rlike("[;,]"),
                _split_list(any_text(item)),
            ).otherwise(F.array(strip(any_text(item)))),
        )
    )
    return F.when(kind(node) == "ARRAY", cut).when(
        (kind(node) == "STRING") & (text != ""), _split_list(text)
    )


def stamped_comment(doc: Column, comment: str) -> Column:
    """STRUCT<kind, items>: the document's comment after the origin comment was added.

    `kind` is text while only the origin comment stands there, else list.
    """
    node = child(doc, "$.comment")
    added = F.lit(comment)
    items = F.transform(array_at(doc, "$.comment"), any_text)
    absent = node.isNull() | F.is_variant_null(node)
    alone = absent | ((kind(node) == "STRING") & (any_text(node) == added))
    result = (
        F.when(alone, F.array(added))
        .when(
            kind(node) == "ARRAY",
            F.when(F.array_contains(items, added), items).otherwise(F.array_append(items, added)),
        )
        .otherwise(F.array(any_text(node), added))
    )
    return F.struct(
        F.when(alone, F.lit("text")).otherwise(F.lit("list")).alias("kind"), result.alias("items")
    )


# ---- whole documents -------------------------------------------------------------------------------


_CUT = re.compile("[;,]")


def _texts(value, whole: bool):
    """A listing value as a list of stripped texts; what is neither text nor list, and blank text, stays.

    Text falls into its pieces at each mark. So do the items of a list, unless they are `whole`; empty items go.
    """
    alone = isinstance(value, str)
    if not (value.strip() if alone else isinstance(value, list)):
        return value
    out: list[str] = []
    for item in [value] if alone else [i for i in value if i]:
        text = str(item).strip()
        if alone or (text and not whole and isinstance(item, str) and _CUT.search(item)):
            out.extend(filter(None, map(str.strip, _CUT.split(text))))
        else:
            out.append(text)
    return out


def _box(value: str) -> str:
    """Four numbers between blanks as two corners; other text stays."""
    try:
        corners = [float(n) for n in value.split()]
    except ValueError:
        return value
    return "{},{} {},{}".format(*corners) if len(corners) == 4 else value


def _stamped(said, comment: str):
    """The comment that stands there, if any, followed by `comment`, which stands there once."""
    listed = said if isinstance(said, list) else [] if said is None else [said]
    listed = listed if comment in listed else [*listed, comment]
    return listed if isinstance(said, list) or len(listed) > 1 else comment


def _objects(doc: dict) -> Iterator[dict]:
    """Every object of a document, each before what it holds, so that changes to it are seen on the way down."""
    waiting: list = [doc]
    while waiting:
        node = waiting.pop()
        if isinstance(node, dict):
            yield node
        if isinstance(node, (dict, list)):
            waiting.extend(node.values() if isinstance(node, dict) else node)


def _normalise(doc: dict, comment: str) -> dict:
    place = doc.get("spatialCoverage")
    shape = place.get("geo") if isinstance(place, dict) else None
    if isinstance(shape, dict) and isinstance(shape.get("box"), str):
        shape["box"] = _box(shape["box"])
    if "keywords" in doc:
        doc["keywords"] = _texts(doc["keywords"], whole=True)
    for node in _objects(doc):
        if "encodingFormat" in node:
            node["encodingFormat"] = _texts(node["encodingFormat"], whole=False)

    said = doc.get("comment")
    if said == comment:
        return doc
    # The comment stands right behind the type, or at the end.
    out: dict = {}
    for key, value in doc.items():
        if key != "comment":
            out[key] = value
        if key == "@type":
            out["comment"] = None
    out["comment"] = _stamped(said, comment)
    return out


def normalise_one(raw: str | None, comment: str) -> str | None:
    """The repaired document as indented JSON; a text that is no JSON object stays as it is."""
    try:
        doc = json.loads(raw)
        if isinstance(doc, dict):
            return json.dumps(_normalise(doc, comment), indent=2)
        return json.dumps(doc, indent=2) if isinstance(doc, list) else raw
    except (TypeError, ValueError, RecursionError):
        return raw


def normalise_text(raw: Column, comment: str) -> Column:
    """Whole-document repair; rewriting a tree at any depth is beyond column functions."""

    @F.pandas_udf("string")
    def repair(texts: pd.Series) -> pd.Series:
        return texts.map(lambda text: normalise_one(text, comment))

    return repair(raw)

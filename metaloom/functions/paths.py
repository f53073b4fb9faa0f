"""JSON paths over VARIANT: a path text becomes one column expression.

Steps are divided by dots. A name takes the value of a key (`\\.` is a dot in it), a number the element of an array from 0,
`#` every element (at the end: how many there are), `#(key=="text")#` every element that passes the test, `#(key=="text")`
the first that does. Tests are ==, !=, <, <=, >, >= and % (`*` any characters, `?` one); values are texts in quotes, numbers, true,
false or null. A test without a key looks at the element itself.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, functions as F

from metaloom.functions.variants import any_text, array_at, child, kind

_STEP = re.compile(r'#\((?P<test>(?:"(?:[^"\\]|\\.)*"|[^")])*)\)(?P<all>#?)|(?P<each>#)|(?P<name>(?:\\.|[^.\\])+)')
_TEST = re.compile(r'\s*(?P<key>[^=!<>%\s]*)\s*(?P<op>==|!=|<=|>=|<|>|%)\s*(?P<value>.*?)\s*\Z', re.S)


def steps_of(path: str) -> list[re.Match]:
    out, at = [], 0
    while at < len(path):
        step = _STEP.match(path, at)
        if not step or (step.end() < len(path) and path[step.end()] != ".") or step.end() + 1 == len(path):
            raise ValueError(f"not a path at {at}: {path}")
        out.append(step)
        at = step.end() + 1
    if not out:
        raise ValueError("an empty path")
    return out


def _quoted(key: str) -> str:
    """The key as a step of Spark's own path syntax, which has two kinds of quotes and no escapes."""
    if "'" in key and '"' in key:
        raise ValueError(f"a key with both kinds of quotes: {key}")
    return f'$["{key}"]' if "'" in key else f"$['{key}']"


def _unescaped(name: str) -> str:
    return re.sub(r"\\(.)", r"\1", name)


def _passes(test: str) -> Callable[[Column], Column]:
    """The test of an element as a column."""
    parts = _TEST.match(test)
    if not parts:
        raise ValueError(f"not a test: {test}")
    key, op, value = parts["key"], parts["op"], parts["value"]

    def of(node: Column) -> Column:
        found = child(node, _quoted(_unescaped(key))) if key else node
        if value[:1] == '"':
            wanted, text = F.lit(_unescaped(value[1:-1])), F.when(kind(found) == "STRING", any_text(found))
            if op == "%":
                # Everything but the two wildcards stands for itself.
                pattern = "".join({"*": ".*", "?": "."}.get(c, re.escape(c)) for c in value[1:-1])
                return text.rlike(f"(?s)^{pattern}$")
        elif value in ("true", "false"):
            wanted, text = F.lit(value), F.when(kind(found) == "BOOLEAN", any_text(found))
        elif value == "null":
            wanted, text = F.lit(True), F.is_variant_null(found)
        else:
            number = kind(found).isin("BIGINT", "DECIMAL", "DOUBLE", "FLOAT", "INT", "SMALLINT", "TINYINT")
            wanted, text = F.lit(float(value)), F.when(number, F.try_variant_get(found, "$", "double"))
        compared = {"==": text == wanted, "!=": ~text.eqNullSafe(wanted), "<": text < wanted, "<=": text <= wanted, ">": text > wanted, ">=": text >= wanted}
        if op not in compared:
            raise ValueError(f"{op} wants a text: {test}")
        return compared[op]

    return lambda node: F.coalesce(of(node), F.lit(False))


def json_path(value: Column, path: str) -> Column:
    """The nodes at `path` in order as ARRAY<VARIANT>; empty where nothing is there.

    A `#` at the end gives one number, the size of the array. No node is parsed twice: the value is a VARIANT.
    """
    nodes = F.when(value.isNotNull(), F.array(value)).otherwise(_nothing())
    *inner, last = steps_of(path)
    for step in inner:
        nodes = F.flatten(F.transform(nodes, _follower(step)))
    if last["each"]:
        sizes = F.filter(F.transform(nodes, lambda n: F.size(array_at(n, "$"))), lambda s: s.isNotNull())
        return F.transform(sizes, lambda s: F.parse_json(s.cast("string")))
    return F.flatten(F.transform(nodes, _follower(last)))


def _nothing() -> Column:
    return F.array().cast("array<variant>")


def _elements(node: Column) -> Column:
    return F.coalesce(array_at(node, "$"), _nothing())


def _follower(step: re.Match) -> Callable[[Column], Column]:
    """What a step makes of one node: an array of nodes."""
    if step["test"] is not None:
        passes = _passes(step["test"])
        kept = lambda node: F.filter(_elements(node), passes)
        return kept if step["all"] else lambda node: F.slice(kept(node), 1, 1)
    if step["each"]:
        return _elements
    name = _unescaped(step["name"])

    def named(node: Column) -> Column:
        found = child(node, _quoted(name))
        if name.isdigit():
            found = F.coalesce(child(node, f"$[{int(name)}]"), found)
        return F.when(found.isNotNull(), F.array(found)).otherwise(_nothing())

    return named


def path_texts(value: Column, path: str) -> Column:
    """The nodes at `path` as texts: strings as they are, everything else as JSON."""
    return F.transform(json_path(value, path), any_text)

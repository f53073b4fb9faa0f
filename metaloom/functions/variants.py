"""Helpers for schema-on-read JSON held as VARIANT."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from metaloom.functions.bind import once

# The white space that a Unicode-aware strip removes.
WHITE_SPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    """Remove leading and trailing Unicode white space."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def strict_json(text: Column) -> Column:
    """The VARIANT of `text`, NULL unless the text is exactly one JSON value.

    `try_parse_json` tolerates trailing text. Closing the value inside an object and inside an array
    leaves only texts that are one value: what slips through one wrapper breaks the other.
    """
    elements = F.json_array_length(F.concat(F.lit("["), text, F.lit("]")))
    inside_object = F.try_parse_json(F.concat(F.lit('{"x":'), text, F.lit("}")))
    return F.when(elements == 1, F.try_variant_get(inside_object, "$.x", "variant"))


def with_value(docs: DataFrame, raw: str = "raw") -> DataFrame:
    """Add `v`, the parsed text of each document, unless it is there already."""
    return docs if "v" in docs.columns else once(docs, v=strict_json(F.col(raw)))


def child(value: Column, path: str) -> Column:
    """The node at `path` as VARIANT; NULL only where the key is missing."""
    return F.try_variant_get(value, path, "variant")


def kind(value: Column) -> Column:
    """OBJECT, ARRAY, STRING, BIGINT, DECIMAL, DOUBLE, BOOLEAN or VOID; NULL for a missing node.

    Only scalars are asked for their schema: that of an object or array would be worked out to the last leaf.
    """
    return (
        F.when(F.try_variant_get(value, "$", "map<string,variant>").isNotNull(), F.lit("OBJECT"))
        .when(F.try_variant_get(value, "$", "array<variant>").isNotNull(), F.lit("ARRAY"))
        .otherwise(F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0))
    )


def has_key(value: Column, path: str) -> Column:
    """Key presence: a JSON null counts as present."""
    return child(value, path).isNotNull()


def text_at(value: Column, path: str) -> Column:
    """The string at `path`; NULL where the node is missing or is not a string."""
    node = child(value, path)
    return F.when(kind(node) == "STRING", F.try_variant_get(value, path, "string"))


def any_text(value: Column) -> Column:
    """A node printed as text: strings as they are, everything else as JSON."""
    return F.try_variant_get(value, "$", "string")


def array_at(value: Column, path: str) -> Column:
    """The array at `path` as ARRAY<VARIANT>; NULL where the node is missing or no array."""
    return F.try_variant_get(value, path, "array<variant>")


def as_array(value: Column, path: str) -> Column:
    """The node at `path` as an array: an array as it is, one value wrapped, empty where missing."""
    node = child(value, path)
    single = F.when(node.isNotNull() & ~F.is_variant_null(node), F.array(node))
    return F.coalesce(array_at(value, path), single, F.array().cast("array<variant>"))


def is_truthy(value: Column) -> Column:
    """False for a missing node, null, false, zero, and empty strings, arrays and objects."""
    printed = any_text(value)
    node_kind = kind(value)
    empty = (
        value.isNull()
        | F.is_variant_null(value)
        | ((node_kind == "STRING") & (printed == ""))
        | ((node_kind == "BOOLEAN") & (printed == "false"))
        | ((node_kind == "ARRAY") & (printed == "[]"))
        | ((node_kind == "OBJECT") & (printed == "{}"))
        | (
            node_kind.isin("BIGINT", "DECIMAL", "DOUBLE", "FLOAT")
            & (F.try_variant_get(value, "$", "double") == 0)
        )
    )
    return ~F.coalesce(empty, F.lit(False))

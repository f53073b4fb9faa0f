"""N-Quads lines and terms as columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

XSD = "http://www.w3.org/2001/XMLSchema#"
RDF_TYPE = "http://www.w3.org/1999/02/22-rdf-syntax-ns#type"

# Subject, predicate, object, graph. Possessive repeats keep long literals off the Java stack.
_LITERAL = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"(?:\^\^<[^>]*+>|@[A-Za-z0-9-]++)?+'
LINE = (
    r"(?s)^\s*+(<[^>]*+>|_:\S++)\s++(<[^>]*+>)\s++(<[^>]*+>|_:[^\s]++|"
    + _LITERAL
    + r")\s*+(<[^>]*+>|_:\S++)?+\s*+\.\s*+(?:#.*)?$"
)
_ESCAPES = r"(?s)((?:\\u[0-9A-Fa-f]{4})++|\\U[0-9A-Fa-f]{8}|\\.|[^\\]++)"


def is_quad(line: Column) -> Column:
    return line.rlike(LINE)


def iri(term: Column) -> Column:
    """The text inside angle brackets; blank nodes stay as they are."""
    return F.regexp_replace(term, "^<|>$", "")


def term_kind(term: Column) -> Column:
    return (
        F.when(F.startswith(term, F.lit("<")), F.lit("iri"))
        .when(F.startswith(term, F.lit("_:")), F.lit("bnode"))
        .when(F.startswith(term, F.lit('"')), F.lit("literal"))
    )


def _piece(piece: Column) -> Column:
    """One run of plain text or one escape, decoded."""
    mark = F.substring(piece, 2, 1)
    return (
        F.when(~F.startswith(piece, F.lit("\\")), piece)
        .when(
            piece.rlike(r"^\\u[0-9A-Fa-f]{4}"),
            F.decode(F.unhex(F.replace(piece, F.lit("\\u"), F.lit(""))), "UTF-16BE"),
        )
        .when(
            piece.rlike(r"^\\U[0-9A-Fa-f]{8}"),
            F.decode(F.unhex(F.substring(piece, 3, 8)), "UTF-32"),
        )
        .when(mark == "n", F.lit("\n"))
        .when(mark == "t", F.lit("\t"))
        .when(mark == "r", F.lit("\r"))
        .when(mark == "b", F.lit("\b"))
        .when(mark == "f", F.lit("\f"))
        .otherwise(mark)
    )


def unescape(body: Column) -> Column:
    """Resolve the escapes of a literal; most literals have none and skip the work."""
    pieces = F.regexp_extract_all(body, F.lit(_ESCAPES), F.lit(1))
    decoded = F.array_join(F.transform(pieces, _piece), "")
    return F.when(F.contains(body, F.lit("\\")), decoded).otherwise(body)


def escape(value: Column) -> Column:
    """The escapes that a canonical N-Quads literal needs."""
    out = value
    for plain, coded in [("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r")]:
        out = F.replace(out, F.lit(plain), F.lit(coded))
    return out


def literal_body(term: Column) -> Column:
    return F.regexp_extract(term, r'(?s)^"([^"\\]*+(?:\\.[^"\\]*+)*+)"', 1)


def literal_suffix(term: Column) -> Column:
    """What follows the closing quote: `^^<datatype>`, `@language` or nothing."""
    return F.substring(term, F.length(literal_body(term)) + 3, F.lit(1 << 30))


def term_value(term: Column) -> Column:
    return F.when(term_kind(term) == "literal", unescape(literal_body(term))).otherwise(iri(term))


def term_datatype(term: Column) -> Column:
    return F.when(
        term_kind(term) == "literal",
        F.nullif(F.regexp_extract(literal_suffix(term), r"^\^\^<([^>]*)>$", 1), F.lit("")),
    )


def term_language(term: Column) -> Column:
    return F.when(
        term_kind(term) == "literal",
        F.nullif(F.regexp_extract(literal_suffix(term), r"^@([A-Za-z0-9-]+)$", 1), F.lit("")),
    )


def typed_values(value: Column, datatype: Column) -> Column:
    """STRUCT<as_boolean, as_long, as_double> with the field of the datatype filled."""
    return F.struct(
        F.when(datatype == XSD + "boolean", value.try_cast("boolean")).alias("as_boolean"),
        F.when(datatype == XSD + "integer", value.try_cast("bigint")).alias("as_long"),
        F.when(datatype == XSD + "double", value.try_cast("double")).alias("as_double"),
    )


def graph_source(graph: Column) -> Column:
    """Source name in a graph id of the form `urn:<host>:<org>:<source>:data:<sha1>`."""
    return F.nullif(F.regexp_extract(graph, r"^urn:[^:]+:[^:]+:([^:]+):data:[0-9a-f]+$", 1), F.lit(""))


def graph_sha(graph: Column) -> Column:
    return F.nullif(F.regexp_extract(graph, r"^urn:[^:]+:[^:]+:[^:]+:data:([0-9a-f]+)$", 1), F.lit(""))


def canonical_double(value: Column) -> Column:
    """`7.8` to `7.8E0`: up to 15 decimals, trailing zeros cut, plain exponent."""
    printed = F.format_string("%.15E", value)
    mantissa = F.regexp_replace(F.regexp_extract(printed, r"^(-?[\d.]+)E", 1), "0+$", "")
    mantissa = F.when(F.endswith(mantissa, F.lit(".")), F.concat(mantissa, F.lit("0"))).otherwise(mantissa)
    exponent = F.regexp_extract(printed, r"E([+-]\d+)$", 1).cast("int").cast("string")
    return F.concat(mantissa, F.lit("E"), exponent)


def print_term(value: Column, term: Column, datatype: Column, language: Column) -> Column:
    """A term in N-Quads notation; `term` is iri, bnode or literal."""
    return (
        F.when(term == "iri", F.concat(F.lit("<"), value, F.lit(">")))
        .when(term == "bnode", value)
        .otherwise(
            F.concat(
                F.lit('"'),
                escape(value),
                F.lit('"'),
                F.when(datatype.isNotNull(), F.concat(F.lit("^^<"), datatype, F.lit(">")))
                .when(language.isNotNull(), F.concat(F.lit("@"), language))
                .otherwise(F.lit("")),
            )
        )
    )

"""URL functions on columns."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from metaloom.functions.bind import let

# scheme, authority (with its slashes), path, query (with ?), fragment (with #)
_PARTS = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(//[^/?#]*)?([^?#]*)(\?[^#]*)?(#.*)?$"


def host(url: Column) -> Column:
    """Host in lower case, NULL for a text that is no URL with a host."""
    return F.lower(F.try_parse_url(url, F.lit("HOST")))


def is_http(url: Column) -> Column:
    return F.coalesce(
        F.lower(F.try_parse_url(url, F.lit("PROTOCOL"))).isin("http", "https"), F.lit(False)
    )


def in_domains(url: Column, domains: list[str]) -> Column:
    """Exact host match; a sub-domain is another host."""
    return F.coalesce(host(url).isin([d.lower() for d in domains]), F.lit(False))


def _parts(url: Column) -> Column:
    """[scheme, authority, path, query, fragment], absent ones empty, from one pass of the pattern."""
    return F.split(F.regexp_replace(url, _PARTS, "$1\u0001$2\u0001$3\u0001$4\u0001$5"), "\u0001", 5)


def _drop_dot_segments(path: Column, relative: Column) -> Column:
    """Resolve `.` and `..`; a path merged from a relative one loses its empty inner segments."""

    def walked(pieces: Column) -> Column:
        size = F.size(pieces)
        kept = F.filter(pieces, lambda piece, i: ~relative | (piece != "") | (i == 0) | (i == size - 1))
        done = F.aggregate(
            kept,
            F.array().cast("array<string>"),
            lambda acc, piece: F.when(
                piece == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0)))
            )
            .when(piece == ".", acc)
            .otherwise(F.array_append(acc, piece)),
        )
        ends_on_dots = F.element_at(pieces, -1).isin(".", "..")
        tail = F.when(ends_on_dots, F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
        return F.array_join(F.concat(done, tail), "/")

    joined = let(F.split(path, "/"), walked)
    return let(
        joined,
        lambda p: F.when(F.startswith(p, F.lit("/")), p).otherwise(F.concat(F.lit("/"), p)),
    )


def _merge(base: Column, path: Column) -> Column:
    """A relative path below the folder of the base path."""
    folder = F.regexp_replace(base, "[^/]*$", "")
    relative = ~F.startswith(path, F.lit("/"))
    merged = F.when(~relative, path).otherwise(
        F.concat(F.when(folder == "", F.lit("/")).otherwise(folder), path)
    )
    return let(
        merged,
        lambda m: F.when(m.rlike(r"//|(^|/)\.\.?(/|$)"), _drop_dot_segments(m, relative)).otherwise(m),
    )


def resolve(base: Column, href: Column) -> Column:
    """Absolute form of a link found on the page `base`.

    Written for http(s) base URLs. Links with another scheme stay as they are; the path of a relative
    link is merged with the base path before its dot segments are resolved.
    """

    def joined(b: Column, h: Column) -> Column:
        b_scheme, b_host, b_path, b_query = (F.get(b, F.lit(i)) for i in range(4))
        scheme, authority, path, query, fragment = (F.get(h, F.lit(i)) for i in range(5))
        own_query = F.when(query == "?", F.lit("")).otherwise(query)
        own_fragment = F.when(fragment == "#", F.lit("")).otherwise(fragment)
        head = F.concat(F.lower(b_scheme), F.lit(":"))
        foreign = (scheme != "") & (F.lower(scheme) != F.lower(b_scheme))
        return (
            F.when(foreign, href)
            .when(F.length(authority) > 2, F.concat(head, authority, path, own_query, own_fragment))
            .when(
                path == "",
                F.concat(
                    head,
                    b_host,
                    b_path,
                    F.when(own_query == "", b_query).otherwise(own_query),
                    own_fragment,
                ),
            )
            .otherwise(F.concat(head, b_host, _merge(b_path, path), own_query, own_fragment))
        )

    whole = let(_parts(base), lambda b: let(_parts(href), lambda h: joined(b, h)))
    return F.when(F.coalesce(href, F.lit("")) == "", base).otherwise(whole)


def catalogue_source_url(url: Column) -> Column:
    """Catalogue-browser URL (`…browser#/external/<host/path>` or `…/#/…`) to the document behind it."""
    return F.regexp_replace(url, r"^https?://[^#]*#/external/(?:https?://)?", "https://")


def catalogue_browser_url(url: Column, browser: str) -> Column:
    """The browser form of a catalogue document's URL; `browser` is the browser's own address."""
    return F.regexp_replace(url, "^https?://", browser.rstrip("/") + "#/external/")


def address_below(path: Column, root: str, base: str) -> Column:
    """The address below `base` of a file below `root`, escaped as addresses are."""
    folder = re.sub("^file:/*", "/", root.rstrip("/"))
    below = F.regexp_replace(F.regexp_replace(path, "^file:/*", "/"), f"^\\Q{folder}\\E/", "")
    escaped = F.replace(F.replace(F.url_encode(below), F.lit("%2F"), F.lit("/")), F.lit("+"), F.lit("%20"))
    return F.concat(F.lit(base.rstrip("/") + "/"), escaped)


# Characters that need no escape in a URL, and the ports that schemes imply.
UNRESERVED = "[A-Za-z0-9._~-]"
DEFAULT_PORTS = {"http": "80", "https": "443"}


def _escapes(text: Column) -> Column:
    """Escapes in one form: those of unreserved characters undone, the others in upper case."""

    def piece(p: Column, i: Column) -> Column:
        code = F.conv(F.substring(p, 1, 2), 16, 10).cast("int")
        char = F.char(code)
        undone = F.when(code.between(1, 126) & char.rlike(f"^{UNRESERVED}$"), F.concat(char, F.substring(p, 3, 1 << 30)))
        escaped = F.concat(F.lit("%"), F.upper(F.substring(p, 1, 2)), F.substring(p, 3, 1 << 30))
        return F.when(i == 0, p).when(p.rlike("^[0-9A-Fa-f]{2}"), F.coalesce(undone, escaped)).otherwise(F.concat(F.lit("%"), p))

    undone = F.array_join(F.transform(F.split(text, "%", -1), piece), "")
    return F.when(F.contains(text, F.lit("%")), undone).otherwise(text)


def normal_form(url: Column) -> Column:
    """One spelling for URLs that differ in the case of scheme and host, the scheme's own port, escapes, dot segments, an
    empty path or a fragment. For http(s); any other text stays as it is. Case and order of paths and queries count.
    """

    def joined(p: Column) -> Column:
        scheme, authority, path, query = (F.get(p, F.lit(i)) for i in range(4))
        low = F.lower(scheme)
        host = F.lower(_escapes(authority))
        for name, port in DEFAULT_PORTS.items():
            host = F.when(low == name, F.regexp_replace(host, f":({port})?$", "")).otherwise(host)
        clean = _escapes(path)
        whole = F.when(clean == "", F.lit("/")).otherwise(
            F.when(clean.rlike(r"//|(^|/)\.\.?(/|$)"), _drop_dot_segments(clean, F.lit(False))).otherwise(clean)
        )
        own_query = F.when(query == "?", F.lit("")).otherwise(_escapes(query))
        return F.concat(low, F.lit(":"), host, whole, own_query)

    return F.when(is_http(F.lower(url)), let(_parts(url), joined)).otherwise(url)

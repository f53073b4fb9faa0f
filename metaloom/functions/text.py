"""Text functions on columns: reply cutting, names, hashes, failure classes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from metaloom.functions.bind import once
from metaloom.functions.variants import kind, strict_json, strip

# Substrings that mark a failure, matched in lower case.
SERVER_ERROR_MARKS = ["500", "502", "503", "504", "internal server error"]
CONNECTION_ERROR_MARKS = [
    "connection refused",
    "connection reset",
    "connection error",
    "upstream connect error",
    "disconnect/reset",
    "delayed connect error",
]
TIMEOUT_MARKS = ["timeout", "timed out"]

# Limits on names and waits.
FILE_NAME_LENGTH = 50
URL_HASH_LENGTH = 8
DISPLAY_NAME_LENGTH = 50
DEFAULT_WAIT_SECONDS = 30.0
WAIT_MARGIN_SECONDS = 5.0
LONGEST_WAIT_SECONDS = 60.0

_FENCE = "```"
_JSON_FENCE = "```json"


def _between(text: Column, first: Column, last: Column) -> Column:
    """`text` from 1-based position `first` to `last`, both included; '' where they cross."""
    return F.when(last >= first, F.substring(text, first, last - first + 1)).otherwise(F.lit(""))


def _last_position(text: Column, mark: str) -> Column:
    """1-based position of the last `mark` (one character), 0 if there is none."""
    back = F.instr(F.reverse(text), mark)
    return F.when(back > 0, F.length(text) - back + 1).otherwise(F.lit(0))


def _inside_fence(text: Column, opening: str) -> Column:
    """Text between `opening` and the next fence, stripped; the whole text if it is not closed."""
    start = F.instr(text, opening) + len(opening)
    end = F.position(F.lit(_FENCE), text, start)
    return F.when(end > start, strip(_between(text, start, end - 1))).otherwise(text)


def unfence(reply: Column) -> Column:
    """Take the content of the first closed code fence."""
    return (
        F.when(F.contains(reply, F.lit(_JSON_FENCE)), _inside_fence(reply, _JSON_FENCE))
        .when(F.contains(reply, F.lit(_FENCE)), _inside_fence(reply, _FENCE))
        .otherwise(reply)
    )


def cut_json(text: Column) -> Column:
    """First `{` to last `}`; without any `{`, first `[` to last `]`; NULL if neither occurs."""
    return F.when(
        F.contains(text, F.lit("{")), _between(text, F.instr(text, "{"), _last_position(text, "}"))
    ).when(
        F.contains(text, F.lit("[")), _between(text, F.instr(text, "["), _last_position(text, "]"))
    )


def with_reply_json(df: DataFrame, reply: str) -> DataFrame:
    """Add `text` (the JSON cut from column `reply`, or what is left of it), `kind` and `v`.

    `kind` is `object`, `array` or `text`; `v` is the parsed text. A list of several objects is cut at its braces,
    which breaks it; the text that is left is then read as a whole.
    """
    opened = once(df, _open=unfence(F.col(reply)))
    cut = once(opened, _cut=cut_json(F.col("_open")))
    parsed = once(cut, _v=strict_json(F.col("_cut")))
    found = F.col("_v").isNotNull()
    kinds = F.when(found, F.when(kind(F.col("_v")) == "OBJECT", F.lit("object")).otherwise(F.lit("array")))
    return once(
        parsed,
        kind=F.coalesce(kinds, F.lit("text")),
        text=F.when(found, F.col("_cut")).otherwise(F.col("_open")),
        v=F.when(found, F.col("_v")).otherwise(strict_json(F.col("_open"))),
    ).drop("_open", "_cut", "_v")


def folder_name(name: Column) -> Column:
    """Keep letters, numbers, blanks, `-` and `_`; drop trailing blanks; blanks become `_`."""
    kept = F.regexp_replace(name, r"[^\p{L}\p{N} _-]", "")
    return F.replace(F.rtrim(kept), F.lit(" "), F.lit("_"))


def url_hash(url: Column) -> Column:
    """First characters of the SHA-1 of a URL."""
    return F.left(F.sha1(url), F.lit(URL_HASH_LENGTH))


def file_name(name: Column, url: Column) -> Column:
    """`<name>_<hash>.jsonld`, with `dataset` for a name that has no safe character."""
    short = F.left(folder_name(name), F.lit(FILE_NAME_LENGTH))
    stem = F.when(short == "", F.lit("dataset")).otherwise(short)
    return F.concat(stem, F.lit("_"), url_hash(url), F.lit(".jsonld"))


def display_name(name: Column) -> Column:
    """Names over the limit end in three dots within the limit."""
    return F.when(
        F.length(name) > DISPLAY_NAME_LENGTH,
        F.concat(F.left(name, F.lit(DISPLAY_NAME_LENGTH - 3)), F.lit("...")),
    ).otherwise(name)


def doi_urls(text: Column) -> Column:
    """Every DOI URL in the text, in order, repeats kept."""
    return F.regexp_extract_all(text, F.lit(r"(https://doi.org/\S+)"), F.lit(1))


def holds_any(text: Column, marks: list[str]) -> Column:
    """True where one of the marks occurs."""
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(m)) for m in marks])


def is_server_error(message: Column) -> Column:
    return holds_any(F.lower(message), SERVER_ERROR_MARKS)


def is_connection_error(message: Column) -> Column:
    return holds_any(F.lower(message), CONNECTION_ERROR_MARKS)


def is_timeout(message: Column) -> Column:
    return holds_any(F.lower(message), TIMEOUT_MARKS)


def is_quota_error(message: Column) -> Column:
    """The first two marks are case-sensitive, the last is not."""
    return (
        F.contains(message, F.lit("429"))
        | F.contains(message, F.lit("RESOURCE_EXHAUSTED"))
        | F.contains(F.lower(message), F.lit("quota"))
    )


def failure_reason(message: Column, stage: str = "detection") -> Column:
    """timeout, server_error, or the stage's own class; the first match wins."""
    rest = "detection_error" if stage == "detection" else "other_error"
    return (
        F.when(is_timeout(message) | is_connection_error(message), F.lit("timeout"))
        .when(is_server_error(message), F.lit("server_error"))
        .otherwise(F.lit(rest))
    )


def retry_delay(message: Column) -> Column:
    """Seconds to wait: the announced wait plus a margin, bounded; a default if none is announced."""
    announced = F.regexp_extract(message, r"(?i)retry in ([\d.]+)s", 1).try_cast("double")
    # `least` passes over NULL, so the default comes first.
    return F.when(announced.isNull(), F.lit(DEFAULT_WAIT_SECONDS)).otherwise(
        F.least(announced + WAIT_MARGIN_SECONDS, F.lit(LONGEST_WAIT_SECONDS))
    )


def reason_title(reason: Column) -> Column:
    return F.initcap(F.replace(reason, F.lit("_"), F.lit(" ")))


def sitemap_time(lastmod: Column) -> Column:
    """A sitemap date or time as TIMESTAMP; one without a zone is read as UTC, whatever the session's zone."""
    text = F.trim(lastmod)
    zoned = text.rlike(r"(Z|[+-]\d{2}:?\d{2})$") & F.contains(text, F.lit("T"))
    whole = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.concat(text, F.lit("T00:00:00"))).otherwise(text)
    return F.try_to_timestamp(F.when(zoned, text).otherwise(F.concat(whole, F.lit("Z"))))

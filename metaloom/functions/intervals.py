"""Coverage intervals: `a/b`, open ends, static, not detected, years before present."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from metaloom.functions.bind import let
from metaloom.functions.variants import strip

_DATE = r"^[+-]?\d{4}(-\d{2}(-\d{2}([T ].*)?)?)?$"
_YEARS_BP = r"^\d+\s*BP$"


def parse_interval(text: Column) -> Column:
    """STRUCT<start, end, kind>.

    Kinds: missing, static, not_detected, ongoing, bp (years before present), open (one end is `..`
    or empty), closed, single (one date) and other. Open and unreadable ends are NULL.
    """
    def read(value: Column, parts: Column) -> Column:
        first, second = F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
        two = F.size(parts) == 2
        open_start, open_end = first.isin("..", ""), second.isin("..", "")
        lower = F.lower(value)
        node = (
            F.when(F.coalesce(value, F.lit("")) == "", F.lit("missing"))
            .when(lower == "static", F.lit("static"))
            .when(lower == "not detected", F.lit("not_detected"))
            .when(lower.isin("ongoing", ".."), F.lit("ongoing"))
            .when(two & first.rlike(_YEARS_BP) & second.rlike(_YEARS_BP), F.lit("bp"))
            .when(two & (first.rlike(_DATE) | open_start) & (second.rlike(_DATE) | open_end),
                F.when(open_start & open_end, F.lit("ongoing"))
                .when(open_start | open_end, F.lit("open"))
                .otherwise(F.lit("closed")),
            )
            .when(~two & value.rlike(_DATE), F.lit("single"))
            .otherwise(F.lit("other"))
        )
        return let(node, lambda kind: ends(kind, first, second))

    def ends(kind: Column, first: Column, second: Column) -> Column:
        ranged = kind.isin("open", "closed", "bp")
        start = F.when((ranged | (kind == "single")) & ~first.isin("..", ""), first)
        end = F.when(ranged & ~second.isin("..", ""), second).when(kind == "single", first)
        return F.struct(start.alias("start"), end.alias("end"), kind.alias("kind"))

    return let(
        strip(text),
        lambda value: let(F.transform(F.split(value, "/"), strip), lambda p: read(value, p)),
    )


def start_date(text: Column) -> Column:
    """An interval end as DATE where it is a whole date, else NULL."""
    return F.try_to_date(F.left(text, F.lit(10)), "yyyy-MM-dd")

"""Name an intermediate value inside a column expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with the value computed once.

    A value used several times in one expression would be repeated in the plan and in the generated code, which
    grows with every level of nesting. As the element of a one-element array it is evaluated once and then named.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are computed once per row, whatever is done with them later.

    A filter on a computed column is pushed below the projection that made it, and takes a copy of the whole
    expression along. The columns here come from a generator, which nothing is pushed through.
    """
    row = F.struct(*[value.alias(name) for name, value in columns.items()])
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(F.array(row)))


def shuffled(side: DataFrame) -> DataFrame:
    """A join side that must not be broadcast on an estimate.

    Its rows are drawn from texts or from earlier rounds, so the size of the files below says little about them.
    """
    return side.hint("merge")


def first_per_key(items: Column, key: Callable[[Column], Column], order: list[str]) -> Column:
    """The first item of each key, in order; `order` names the fields that give an item its place.

    Two sorts inside the row: by key, to find the first of each, and back by place. The work grows with n log n
    of one row's items, and nothing is shuffled.
    """
    keyed = F.transform(
        items,
        lambda x: F.struct(key(x).alias("key"), *[x[o].alias(o) for o in order], x.alias("item")),
    )
    firsts = let(
        F.sort_array(keyed),
        lambda s: F.filter(s, lambda e, i: (i == 0) | ~e["key"].eqNullSafe(F.get(s, i - 1)["key"])),
    )
    placed = F.transform(
        firsts, lambda e: F.struct(*[e[o].alias(o) for o in order], e["item"].alias("item"))
    )
    return F.transform(F.sort_array(placed), lambda e: e["item"])

"""Array steps inside a row that several native operators share."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from metaloom.functions.bind import let

BLOCK = 256


def upto(n: Column) -> Column:
    """0 to n - 1; empty if n is 0."""
    return F.when(n > 0, F.sequence(F.lit(0), (n - 1).cast("int"))).otherwise(F.array().cast("array<int>"))


def total(values: Column, largest: bool = False) -> Column:
    """Sum of longs, or the largest of values that are not negative; 0 if there are none."""
    start = F.lit(0).cast("long")
    return F.aggregate(values, start, (lambda a, v: F.greatest(a, v)) if largest else (lambda a, v: a + v))


def before(values: Column, largest: bool = False) -> Column:
    """For each value, the sum (or largest) of all values before it. Two levels of blocks: no quadratic work."""

    def of_blocks(vs: Column) -> Column:
        blocks = F.transform(
            upto(F.ceil(F.size(vs) / BLOCK)), lambda b: total(F.slice(vs, b * BLOCK + 1, BLOCK), largest)
        )
        heads = let(blocks, lambda bs: F.transform(bs, lambda _, b: total(F.slice(bs, 1, b), largest)))
        join = F.greatest if largest else (lambda a, b: a + b)
        return let(
            heads,
            lambda hs: F.transform(
                vs,
                lambda _, i: join(
                    F.get(hs, (i / BLOCK).cast("int")),
                    total(F.slice(vs, (i - i % BLOCK + 1).cast("int"), (i % BLOCK).cast("int")), largest),
                ),
            ),
        )

    return let(values, of_blocks)

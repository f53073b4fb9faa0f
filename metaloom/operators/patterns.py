"""Graph patterns over quads: triples with variables, and paths of one or more steps."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from metaloom.functions.bind import shuffled
from metaloom.session import written, written_and_measured

Pattern = tuple[str, str, str]


def _is_name(term: str) -> bool:
    return term.startswith("?")


def paths(edges: DataFrame) -> DataFrame:
    """All pairs (g, s, value) that one or more edges connect.

    Semi-naive rounds: only the pairs that the last round found are extended, and only new ones go on, so each pair is
    made once from each of its ways; loops end by themselves.
    """
    edges = written(edges.select("g", "s", "value").distinct())
    known = frontier = edges
    found = {"n": 1}
    while found["n"]:
        onward = edges.select("g", F.col("s").alias("value"), F.col("value").alias("_next"))
        reached = frontier.join(shuffled(onward), ["g", "value"]).select("g", "s", F.col("_next").alias("value")).distinct()
        old = known.select(F.col("g").alias("_g"), F.col("s").alias("_s"), F.col("value").alias("_value"), F.lit(True).alias("_met"))
        same = (F.col("g") == F.col("_g")) & (F.col("s") == F.col("_s")) & (F.col("value") == F.col("_value"))
        fresh = reached.join(shuffled(old), same, "left").filter("_met is null").select("g", "s", "value")
        frontier, found = written_and_measured(fresh, n=F.count(F.lit(1)))
        if found["n"]:
            known = written(known.unionByName(frontier))
    return known


def _star(quads: DataFrame, subject: str, lines: list[tuple[str, str]]) -> DataFrame:
    """Matches of all patterns with one subject: one aggregate on (g, s), without a self-join.

    Constants are flags; each variable's values are a set that becomes rows again.
    """
    tests, holders, repeats, taken = [], [], [], set()
    for i, (p, o) in enumerate(lines):
        at = F.col("p") == p
        if _is_name(o):
            holders.append((o, F.collect_set(F.when(at, F.col("value"))).alias(f"_v{i}"), f"_v{i}"))
        else:
            tests.append(F.bool_or(at & (F.col("value") == o)).alias(f"_t{i}"))
    wanted = quads.filter(F.col("p").isin(sorted({p for p, _ in lines})))
    if not _is_name(subject):
        wanted = wanted.filter(F.col("s") == subject)
    rows = wanted.groupBy("g", "s").agg(*tests, *[h for _, h, _ in holders])
    for i, (_, o) in enumerate(lines):
        if not _is_name(o):
            rows = rows.filter(f"_t{i}").drop(f"_t{i}")
    rows = rows.filter(reduce(lambda a, b: a & b, [F.size(c) > 0 for _, _, c in holders], F.lit(True)))
    if _is_name(subject):
        rows = rows.withColumnRenamed("s", subject)
        taken.add(subject)
    else:
        rows = rows.drop("s")
    for name, _, column in holders:
        rows = rows.withColumn(column, F.explode(column))
        if name in taken:
            repeats.append((name, column))
        else:
            rows, _ = rows.withColumnRenamed(column, name), taken.add(name)
    for name, column in repeats:
        rows = rows.filter(F.col(f"`{name}`") == F.col(column)).drop(column)
    return rows


def _path(quads: DataFrame, pattern: Pattern) -> DataFrame:
    s, p, o = pattern
    pairs = paths(quads.filter((F.col("p") == p[:-1]) & (F.col("kind") != "literal")))
    for term, column in ((s, "s"), (o, "value")):
        if not _is_name(term):
            pairs = pairs.filter(F.col(column) == term).drop(column)
    if _is_name(s) and s == o:
        return pairs.filter("s = value").drop("value").withColumnRenamed("s", s)
    return pairs.withColumnsRenamed({c: t for c, t in (("s", s), ("value", o)) if _is_name(t) and c in pairs.columns})


def match(quads: DataFrame, patterns: list[Pattern]) -> DataFrame:
    """Bindings of a list of patterns within one graph: `g` and a column per variable, without its `?`, as they first occur.

    A term that begins with `?` is a variable, any other a constant; a predicate is a constant, with a `+` at its end a path
    of one or more such steps. Patterns with one subject are read as one star. Stars and paths are
    joined on (g, shared variables), in an order in which each shares a variable with those before; a list that
    falls apart into unrelated patterns would be a product and is an error.
    """
    names = {p.removesuffix("+") for _, p, _ in patterns}
    columns = ["g", "s", "p", "value", "kind"]
    # Read by every star and path: written once, so that no line is parsed again.
    named = written(quads.filter(F.col("p").isin(sorted(names))).select(*columns))
    stars: dict[str, list[tuple[str, str]]] = {}
    for s, p, o in patterns:
        if not p.endswith("+"):
            stars.setdefault(s, []).append((p, o))
    parts = [_star(named, s, lines) for s, lines in stars.items()]
    parts += [_path(named, pattern) for pattern in patterns if pattern[1].endswith("+")]
    out, rest = parts[0], parts[1:]
    while rest:
        near = next((d for d in rest if set(d.columns) & set(out.columns) - {"g"}), None)
        if near is None:
            raise ValueError("patterns share no variable")
        rest = [d for d in rest if d is not near]
        shared = [c for c in out.columns if c in near.columns]
        out = out.join(shuffled(near), shared)
    order = dict.fromkeys(t for s, _, o in patterns for t in (s, o) if _is_name(t))
    return out.select("g", *[_named(v) for v in order]).distinct()


def _named(variable: str) -> Column:
    return F.col(f"`{variable}`").alias(variable[1:])

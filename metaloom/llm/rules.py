"""Quality rules: decision lists learned by sequential covering, as ordered conditional expressions.

Statistics of whole texts are plain column expressions. Labelled rows are binned at quantiles once; every growing step is
one aggregation of label counts by statistic and bin, from which the driver takes the condition of most gain. A finished
conjunction is cut back on rows that did not grow it, rows it covers are left out, and the next rule is grown. The
rules become one chain of `when` expressions. No Python runs on the executors.

Defined results: a null text has no words; a text without words has counts of 0, fails the base rule and is not kept.
Repeated rows give repeated rows; rows without an id are judged but not learned from; null labels are left out, and an
id with several labels counts once with the smallest. Without labelled rows of both kinds there are no rules, and only
the base rule decides. Only the named columns are read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from metaloom.functions.bind import let, once
from metaloom.llm.arrays import upto
from metaloom.llm.landing import land

BLANK = "[\\x20\\x09-\\x0D]+"
WINDOW = 8
MIN_WORDS = 20
REPEAT_PERCENT = 30
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_shout", "n_distinct"]
BINS = 100
MAX_RULES = 8
MAX_CONDITIONS = 3
#: A rule stands if, among the rows it was not grown on, this share of those it covers has label 0.
MIN_PRECISION = 0.8
MIN_COVERED = 5


def _repeated_words(windows: Column) -> Column:
    """Words inside windows that occur twice or more; `windows` has the hash of the window at each place."""

    def cover(ws: Column) -> Column:
        placed = F.sort_array(F.transform(ws, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        again = let(
            placed,
            lambda s: F.filter(
                s,
                lambda e, i: F.coalesce((i > 0) & (F.get(s, i - 1)["h"] == e["h"]), F.lit(False))
                | F.coalesce(F.get(s, i + 1)["h"] == e["h"], F.lit(False)),
            ),
        )
        at = F.sort_array(F.transform(again, lambda e: e["i"]))
        start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))
        return F.aggregate(
            at,
            start,
            lambda a, i: F.struct(
                (a["n"] + WINDOW - F.greatest(F.lit(0).cast("long"), a["end"] - i)).alias("n"),
                (i + WINDOW).cast("long").alias("end"),
            ),
        )["n"]

    return let(windows, lambda ws: F.when(F.size(F.array_distinct(ws)) < F.size(ws), cover(ws)).otherwise(0)).cast("long")


def count_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """`doc_id` and the `COUNTS` of each whole text."""
    given = docs.select("doc_id", F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t"))
    cut = once(
        given,
        words=F.filter(F.split("t", BLANK), lambda w: w != ""),
        lines=F.filter(F.split("t", "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")),
        n_symbols=F.regexp_count("t", F.lit("[#*$%&|<>]")).cast("long"),
        n_upper=F.regexp_count("t", F.lit("[A-Z]")).cast("long"),
        n_shout=F.regexp_count("t", F.lit("!")).cast("long"),
    ).drop("t")
    hashed = once(
        cut,
        hashes=F.transform("words", lambda w: F.xxhash64(w)),
        word_chars=F.length(F.array_join("words", "")).cast("long"),
        n_lines=F.size("lines").cast("long"),
        n_dup_lines=(F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
    ).drop("words", "lines")
    count = F.size("hashes")
    windows = F.transform(
        upto(count - WINDOW + 1), lambda i: F.xxhash64(*[F.get(F.col("hashes"), i + k) for k in range(WINDOW)])
    )
    return hashed.select(
        "doc_id",
        count.cast("long").alias("n_words"),
        F.size(F.array_distinct("hashes")).cast("long").alias("n_distinct"),
        _repeated_words(windows).alias("n_repeat_words"),
        *[c for c in COUNTS if c not in ("n_words", "n_distinct", "n_repeat_words")],
    ).select("doc_id", *COUNTS)


def features() -> dict[str, Column]:
    """The statistics that rules are made of, from the counts."""
    c = {name: F.col(name).cast("double") for name in COUNTS}
    words = F.greatest(c["n_words"], F.lit(1.0))
    chars = F.greatest(c["word_chars"], F.lit(1.0))
    return {
        "n_words": c["n_words"],
        "word_length": c["word_chars"] / words,
        "symbols_per_word": c["n_symbols"] / words,
        "dup_line_share": c["n_dup_lines"] / F.greatest(c["n_lines"], F.lit(1.0)),
        "repeat_share": c["n_repeat_words"] / words,
        "upper_share": c["n_upper"] / chars,
        "shouts_per_word": c["n_shout"] / words,
        "distinct_share": c["n_distinct"] / words,
    }


@dataclass(frozen=True)
class Condition:
    """`feature >= threshold`, or `<` if `below`."""

    feature: str
    below: bool
    threshold: float
    place: int
    bin: int

    def on_value(self) -> Column:
        value = features()[self.feature]
        return value < self.threshold if self.below else value >= self.threshold

    def on_bin(self) -> Column:
        value = F.col("bins")[self.place]
        return value < self.bin if self.below else value >= self.bin

    def __str__(self) -> str:
        return f"{self.feature} {'<' if self.below else '>='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def _bin(value: Column, thresholds: list[float]) -> Column:
    return F.size(F.filter(F.lit(thresholds), lambda t: t <= value))


def _all(conditions: Rule) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c.on_bin()
    return out


def _any(rules: list[Rule]) -> Column:
    out = F.lit(False)
    for rule in rules:
        out = out | _all(rule)
    return out


def _best(rows: DataFrame, thresholds: list[list[float]], names: list[str], bad: int, good: int) -> tuple[Condition, int, int] | None:
    """The condition of most information gain among `rows`, from one count by statistic and bin."""
    counted = rows.select("y", F.posexplode("bins").alias("place", "bin")).groupBy("place", "bin")
    got = counted.agg(F.sum(1 - F.col("y")).alias("bad"), F.sum("y").alias("good")).collect()
    table = {(r["place"], r["bin"]): (r["bad"], r["good"]) for r in got}
    before = math.log2(bad / (bad + good))
    best, found = 1e-9, None
    for place, name in enumerate(names):
        under_bad = under_good = 0
        for k in range(1, len(thresholds[place]) + 1):
            b, g = table.get((place, k - 1), (0, 0))
            under_bad, under_good = under_bad + b, under_good + g
            for below, p, n in ((True, under_bad, under_good), (False, bad - under_bad, good - under_good)):
                if p:
                    gain = p * (math.log2(p / (p + n)) - before)
                    if gain > best:
                        best = gain
                        found = (Condition(name, below, thresholds[place][k - 1], place, k), p, n)
    return found


def _pruned(rows: DataFrame, rule: Rule) -> tuple[Rule, int, int]:
    """The head of the rule that is best on rows which did not grow it, and what it covers there."""
    asked = []
    for k in range(1, len(rule) + 1):
        hit = _all(rule[:k])
        asked += [F.sum(F.when(hit, 1 - F.col("y")).otherwise(0)), F.sum(F.when(hit, F.col("y")).otherwise(0))]
    got = [v or 0 for v in rows.agg(*asked).first()]
    heads = [(rule[: k + 1], got[2 * k], got[2 * k + 1]) for k in range(len(rule))]
    return max(heads, key=lambda h: ((h[1] - h[2]) / max(1, h[1] + h[2]), h[1]))


def learn(stats: DataFrame, labels: DataFrame, label: str = "quality") -> list[Rule]:
    """Rules that reject, most gainful first, from the labelled rows of `stats`; two thirds grow, a third prunes."""
    known = (
        labels.select(F.col("doc_id").cast("long").alias("id"), F.col(label).cast("int").alias("y"))
        .filter("id is not null and y in (0, 1)").groupBy("id").agg(F.min("y").alias("y"))
    )
    named = features()
    names = list(named)
    values = stats.select(F.col("doc_id").cast("long").alias("id"), *[v.alias(k) for k, v in named.items()])
    joined = values.join(known.hint("merge"), "id")
    shares = [(i + 1) / BINS for i in range(BINS - 1)]
    joined = land(joined, "rule-rows")
    asked = [F.percentile_approx(n, shares, 10000).alias(n) for n in names]
    # Quantiles of both kinds: the rare kind would otherwise fall between two of them.
    cuts = joined.groupBy("y").agg(*asked).collect()
    if len(cuts) < 2:
        return []
    thresholds = [sorted({v for r in cuts for v in r[n]}) for n in names]
    bins = F.array(*[_bin(F.col(n), thresholds[i]) for i, n in enumerate(names)])
    rows = land(joined.select("y", F.expr("pmod(xxhash64(id, 'rules'), 3)").alias("fold"), bins.alias("bins")), "binned")
    grow, prune = rows.filter("fold > 0"), rows.filter("fold = 0")
    rules: list[Rule] = []
    while len(rules) < MAX_RULES:
        left = grow.filter(~_any(rules))
        got = left.agg(F.sum(1 - F.col("y")), F.sum("y")).first()
        bad, good = int(got[0] or 0), int(got[1] or 0)
        if bad < MIN_COVERED:
            break
        rule: Rule = ()
        while len(rule) < MAX_CONDITIONS and good:
            found = _best(left.filter(_all(rule)), thresholds, names, bad, good)
            if not found:
                break
            rule, bad, good = (*rule, found[0]), found[1], found[2]
        if not rule:
            break
        rule, hits, misses = _pruned(prune.filter(~_any(rules)), rule)
        if hits + misses < MIN_COVERED or hits < MIN_PRECISION * (hits + misses):
            break
        rules.append(rule)
    return rules


def decision(rules: list[Rule]) -> Column:
    """The number of the first rule that rejects a row, from 1; 0 if none does."""
    chain = None
    for number, rule in enumerate(rules, 1):
        hit = F.lit(True)
        for c in rule:
            hit = hit & c.on_value()
        chain = F.when(hit, number) if chain is None else chain.when(hit, number)
    return (F.lit(0) if chain is None else chain.otherwise(0)).cast("int")


def judge(docs: DataFrame, labels: DataFrame, learn_from: Column | None = None) -> DataFrame:
    """The base counts, `base_failed`, `kept` and the number of the rejecting `rule` per document."""
    stats = land(count_statistics(docs), "counts")
    rules = learn(stats if learn_from is None else stats.filter(learn_from), labels)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    out = stats.withColumn("base_failed", failed).withColumn("rule", decision(rules))
    return out.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & (F.col("rule") == 0)).alias("kept"),
        "rule",
    )

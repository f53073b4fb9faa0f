"""Secret scans: fixed patterns, and Markov models of random strings against ordinary identifiers.

Positions come from cutting the text at the matches and adding up lengths, all inside the row. The values that
the patterns find are labelled samples of random strings, long words of a bounded sample of texts are those of ordinary
identifiers; both are counted as character pairs. Longer runs of key characters whose log-likelihood ratio exceeds
a margin become further spans. No Python runs on the executors.

Defined results: a null or empty text has no spans. Positions are code points, end exclusive. Spans of one kind do not
overlap; spans of different kinds may, but a modelled span that touches a pattern's span is left out. Repeated rows give
repeated rows. Without samples of a kind its model is uniform. Only the named columns are read; `redact` keeps all.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from metaloom.functions.bind import let, once
from metaloom.llm.arrays import before
from metaloom.llm.landing import land, unused

#: The base patterns by kind, the least length and the group that it holds for.
KINDS = [
    ("assign", "((?i:password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    ("access", "AKIA[A-Z0-9]+", 0, 20),
    ("hex", "[0-9a-f]{24,}", 0, 24),
]
#: Cheap conditions without which a pattern cannot match.
HINTS = {"assign": "(?i:passw|secret|token|api_?key)", "access": "AKIA", "hex": "[0-9a-f]{24}"}
MODEL = "markov"
RUN = "[A-Za-z0-9+/_=-]{20,}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-."
SIDE = len(ALPHABET) + 1
MARGIN = 12.0
#: Texts that samples of ordinary identifiers are drawn from: about so many, by hash of the id.
SAMPLE_TEXTS = 5000
SPAN = "array<struct<start: bigint, end: bigint, rank: int, value: string>>"


def _spans(text: Column, pattern: str, group: int, least: int, rank: int, hint: str | None = None) -> Column:
    """All matches as (start, end, rank, value), without those whose value is shorter than `least`."""

    def placed(found: Column) -> Column:
        gaps = F.transform(F.split(text, pattern, -1), lambda s: F.length(s).cast("long"))
        lengths = F.transform(found, lambda m: F.length(m).cast("long"))
        steps = let(gaps, lambda g: let(lengths, lambda n: F.zip_with(F.slice(g, 1, F.size(n)), n, lambda a, b: a + b)))
        starts = let(
            gaps, lambda g: let(before(steps), lambda b: F.transform(b, lambda v, i: v + F.get(g, i)))
        )
        value = (lambda m: F.regexp_extract(m, f"^(?:{pattern})$", group)) if group else (lambda m: m)
        spans = F.zip_with(
            starts,
            found,
            lambda s, m: F.struct(
                s.alias("start"), (s + F.length(m)).alias("end"), F.lit(rank).alias("rank"), value(m).alias("value")
            ),
        )
        return F.filter(spans, lambda x: F.length(x["value"]) >= least)

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    spans = let(found, lambda f: F.when(F.size(f) > 0, placed(f)))
    if hint:
        spans = F.when(text.rlike(hint), spans)
    return F.coalesce(spans, F.array().cast(SPAN)).cast(SPAN)


def base_spans(text: Column) -> Column:
    """Spans of the fixed patterns, by start, then kind as listed."""
    kinds = [_spans(text, p, g, least, i, HINTS[k]) for i, (k, p, g, least) in enumerate(KINDS)]
    return F.array_sort(F.concat(*kinds), _in_order)


def _in_order(a: Column, b: Column) -> Column:
    return (
        F.when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1)
        .when(a["rank"] < b["rank"], -1).when(a["rank"] > b["rank"], 1).otherwise(0)
    )


def _place(char: Column) -> Column:
    return F.call_function("locate", char, F.lit(ALPHABET))


def _pair_counts(samples: DataFrame) -> DataFrame:
    """Counts of (character, next character) as places in the alphabet; 0 stands for the beginning."""
    chars = samples.select("label", F.transform(F.split("value", ""), _place).alias("cs"))
    pairs = F.transform("cs", lambda c, i: F.when(i == 0, 0).otherwise(F.get(F.col("cs"), i - 1)) * SIDE + c)
    return chars.select("label", F.explode(pairs).alias("pair")).groupBy("label", "pair").agg(F.count("*").alias("n"))


def fit(samples: DataFrame, smooth: float = 0.5) -> list[float]:
    """Log-likelihood ratio of each pair of characters, random against ordinary, from (`label`, `value`), label 1 random."""
    counts = {0: [smooth] * SIDE**2, 1: [smooth] * SIDE**2}
    for r in _pair_counts(samples.filter("label in (0, 1) and length(value) > 0")).collect():
        counts[r["label"]][r["pair"]] += r["n"]
    ratio = [0.0] * SIDE**2
    for row in range(SIDE):
        sums = {k: sum(v[row * SIDE : (row + 1) * SIDE]) for k, v in counts.items()}
        for i in range(row * SIDE, (row + 1) * SIDE):
            ratio[i] = math.log(counts[1][i] / sums[1]) - math.log(counts[0][i] / sums[0])
    return ratio


def likelihood_ratio(value: Column, ratio: list[float]) -> Column:
    """The log-likelihood ratio of a whole string; characters outside the alphabet count as its beginning does."""
    table = F.split(F.lit(",".join(f"{r:.4f}" for r in ratio)), ",").cast("array<double>")
    start = F.struct(F.lit(0).alias("last"), F.lit(0.0).alias("sum"))
    return F.aggregate(
        F.transform(F.split(value, ""), _place),
        start,
        lambda a, c: F.struct(c.alias("last"), (a["sum"] + F.get(table, a["last"] * SIDE + c)).alias("sum")),
    )["sum"]


def model_spans(text: Column, base: Column, ratio: list[float], margin: float = MARGIN) -> Column:
    """Runs of key characters that look random and touch no base span."""
    runs = _spans(text, RUN, 0, 1, len(KINDS), RUN)
    odd = F.filter(runs, lambda r: likelihood_ratio(r["value"], ratio) > margin)
    return F.filter(odd, lambda r: ~F.exists(base, lambda b: (b["start"] < r["end"]) & (r["start"] < b["end"])))


def samples_of(docs: DataFrame, found: DataFrame, size: int, sample_texts: int = SAMPLE_TEXTS) -> DataFrame:
    """Labelled strings: values that the patterns found, and words of about `sample_texts` of the `size` texts."""
    random = found.select(F.lit(1).alias("label"), F.explode("base.value").alias("value"))
    random = random.filter(F.col("value").rlike("[0-9]") & F.col("value").rlike("[A-Za-z]"))
    share = min(1.0, sample_texts / max(1, size))
    some = docs.filter(F.expr("pmod(xxhash64(doc_id, 'secrets'), 1000000) / 1000000d") < share)
    words = some.select(F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z_-]{6,}"), F.lit(0))).alias("value"))
    return random.unionByName(words.select(F.lit(0).alias("label"), "value"))


def _read(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def learned(docs: DataFrame, sample_texts: int = SAMPLE_TEXTS) -> list[float]:
    """The model from a pass of the patterns over all texts; only rows with spans are written.

    All values that the patterns find are samples of random strings; words of about `sample_texts` texts, by hash of the
    id, are samples of ordinary ones.
    """
    given = _read(docs)
    found = once(given, base=base_spans(F.col("text"))).filter(F.size("base") > 0).select("base")
    return fit(samples_of(given, land(found, "secrets"), docs.count(), sample_texts))


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k, *_ in KINDS], F.lit(MODEL))
    texts = F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["rank"]), s["start"], s["end"]))
    return F.array_join(texts, ",")


def with_spans(docs: DataFrame, ratio: list[float]) -> DataFrame:
    """`doc_id`, `text`, `base` and all `spans` per row."""
    based = once(_read(docs), base=base_spans(F.col("text")))
    both = F.array_sort(F.concat("base", model_spans(F.col("text"), F.col("base"), ratio)), _in_order)
    return once(based, spans=both)


def scan(docs: DataFrame) -> DataFrame:
    """Counts of base spans, the digest of them, and all spans, per document."""
    found = with_spans(docs, learned(docs))
    count = [_number(i).cast("long").alias(f"n_{kind}") for i, (kind, *_) in enumerate(KINDS)]
    digest = F.sha2(_joined(F.col("base")), 256)
    return found.select("doc_id", *count, digest.alias("base_sha256"), _joined(F.col("spans")).alias("spans"))


def _number(rank: int) -> Column:
    return F.size(F.filter("base", lambda s: s["rank"] == rank))


def redact(docs: DataFrame, ratio: list[float], mark: str = "[SECRET]") -> DataFrame:
    """`docs` with every span of its `text` replaced by `mark`; spans that touch become one. All columns stay."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    base, spans = unused("base", docs.columns), unused("spans", docs.columns)
    if "n_chars" in docs.columns:
        size = F.when(F.size(spans) > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    with_base = once(docs, **{base: base_spans(text)})
    both = F.array_sort(F.concat(base, model_spans(text, F.col(base), ratio)), _in_order)
    found = once(with_base, **{spans: both})

    def rebuilt(found: Column) -> Column:
        ends = F.transform(found, lambda s: s["end"])
        pieces = let(
            before(ends, largest=True),
            lambda past: F.transform(
                found,
                lambda s, i: F.when(
                    (s["start"] >= F.get(past, i)) & ((i == 0) | (s["start"] > F.get(past, i))),
                    F.concat(text.substr((F.get(past, i) + 1).cast("int"), (s["start"] - F.get(past, i)).cast("int")), F.lit(mark)),
                ).otherwise(F.lit("")),
            ),
        )
        tail = text.substr((F.array_max(ends) + 1).cast("int"), F.length(text))
        return F.concat(F.array_join(pieces, ""), tail)

    changed = found.withColumn("text", F.when(F.size(spans) > 0, let(F.col(spans), rebuilt)).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", size)
    return changed.select(*docs.columns)

"""One query per operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from metaloom.llm import (
    bytebpe,
    decontam,
    language,
    lattice,
    licenses,
    neardup,
    quality,
    repeats,
    rules,
    secretscan,
    tokens,
    turns,
    variants,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
RANKS = "byte_bpe_50k.tiktoken"
#: The first id that the rank file leaves free ends a text in flat token files.
SEPARATOR = 50256


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op1_quality_classifier(spark, sf):
    return quality.classify(_table(spark, sf, "documents"), _table(spark, sf, "labels"))


@query
def op2_language_id(spark, sf):
    return language.predict(_table(spark, sf, "documents"))


@query
def op3_quality_rules(spark, sf):
    return rules.judge(_table(spark, sf, "documents"), _table(spark, sf, "labels"), ~quality.held_out())


@query
def op4_token_counts(spark, sf):
    path = public_tokenizers.path(RANKS)
    return tokens.count_tokens(_table(spark, sf, "documents"), path, public_tokenizers.PATTERN, SEPARATOR)


@query
def op5_minhash_neardup(spark, sf):
    return neardup.near_duplicates(_table(spark, sf, "documents"), width=2)


@query
def op6_license_scan(spark, sf):
    found = licenses.scan(_table(spark, sf, "documents"))
    spans = F.transform("spans", lambda s: F.concat_ws(":", s["label"], s["start"], s["end"], s["edits"]))
    return found.withColumn("spans", F.array_join(spans, ","))


@query
def op7_lm_score(spark, sf):
    path = public_tokenizers.path(RANKS)
    return lattice.score(_table(spark, sf, "documents"), path, public_tokenizers.PATTERN)


@query
def op8_decontamination(spark, sf):
    return decontam.hits(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"))


@query
def op9_secret_scan(spark, sf):
    return secretscan.scan(_table(spark, sf, "documents"))


@query
def op10_byte_bpe(spark, sf):
    docs = _table(spark, sf, "documents")
    return bytebpe.encode_digests(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


@query
def op11_spelling_variants(spark, sf):
    return variants.spelling_variants(_table(spark, sf, "documents"), every=199)


@query
def op12_suffix_dedup(spark, sf):
    return repeats.kept_digests(_table(spark, sf, "documents"))


@query
def op13_conversation_repair(spark, sf):
    return turns.repair_digests(turns.damaged(_table(spark, sf, "conversations")))


#: Windows of test items over documents, and what they hit. Only A to Z are lower-cased.
ORACLES["op8_decontamination"] = r"""
WITH words AS (
  SELECT 'd' AS kind, doc_id AS id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
  UNION ALL
  SELECT 'i', item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark WHERE item_id IS NOT NULL
), items AS (
  SELECT id AS item_id, w, least(13, len(w)) AS n, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS k FROM words WHERE kind = 'i' AND len(w) > 0
), windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[k:k + n - 1], ' ') AS t FROM items
), places AS (
  SELECT id AS doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS k
  FROM words, (SELECT DISTINCT n FROM windows) WHERE kind = 'd' AND len(w) >= n
), found AS (
  SELECT doc_id, k, p.n AS n, item_id FROM (SELECT doc_id, k, n, array_to_string(w[k:k + n - 1], ' ') AS t FROM places) p JOIN windows v ON v.t = p.t AND v.n = p.n
), hit AS (
  SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS pos FROM found) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id
)
SELECT id AS doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM words LEFT JOIN hit ON hit.doc_id = id LEFT JOIN named ON named.doc_id = id WHERE kind = 'd'
"""

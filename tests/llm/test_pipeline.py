"""The pipeline's stages against brute force, each on what the stage before it kept."""

from __future__ import annotations

import os

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from metaloom.llm import bytebpe, decontam, secretscan
from metaloom.llm.landing import land
from tests.llm.test_operators import _base, _components, _hits

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(land(stage(spark, out[-1], SF), name))
    return out


def rows_of(df) -> list[tuple]:
    return sorted((r["doc_id"], r["text"]) for r in df.collect())


def test_columns_stay(stages):
    assert all(df.columns == stages[0].columns for df in stages[:-1])


def test_quality_keeps_labelled_good_documents(spark, stages):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {i for i, _ in rows_of(stages[1])}
    wrong = [i for i, q in labels.items() if (i in kept) != (q == 1)]
    assert len(wrong) <= 0.05 * len(labels)


def test_one_document_of_each_group(stages):
    before, after = rows_of(stages[1]), rows_of(stages[2])
    groups = _components(before, 5)
    assert after == [(i, t) for i, t in before if groups[i][1] == i]


def test_contaminated_documents_go(spark, stages):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    assert rows_of(stages[3]) == [(i, t) for i, t in rows_of(stages[2]) if not _hits(t, items)[4]]
    assert decontam.WINDOW == 13


def test_secrets_are_masked_and_nothing_else(stages):
    after = dict(rows_of(stages[4]))
    for i, text in rows_of(stages[3]):
        spans = _base(text)
        assert not spans or after[i] != text
        assert not _base(after[i].replace("[SECRET]", " "))


def test_ids_decode_to_the_masked_texts(stages):
    path = public_tokenizers.path(corpus_pipeline.RANKS)
    back = bytebpe.decoded_texts(stages[5], path, public_tokenizers.PATTERN)
    assert rows_of(back) == rows_of(stages[4])
    assert stages[5].filter(F.size("ids") != F.col("n_tokens")).count() == 0

"""No caps: long pieces, wide ids, hostile windows, marks, and columns whose names clash."""

from __future__ import annotations

import itertools
import math
import time

import numpy as np
import public_tokenizers
import pytest

from metaloom.llm import decontam, language, lattice, licenses, neardup, quality, secretscan, tokens
from metaloom.llm.bytebpe import read_ranks

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
DOCS = "doc_id long, text string"


def test_pieces_of_every_length_take_part():
    ranks = read_ranks(PATH)
    pieces, logs, _ = lattice.piece_logs(ranks, {}, 10)
    assert len(pieces) == len(ranks)
    table = lattice.PieceTable(pieces, logs)
    dashes = np.frombuffer(b"-" * 64, np.uint8)[None, :]
    known = dict(zip(pieces, logs))
    alpha = [0.0]
    for j in range(1, 65):
        terms = [alpha[j - k] + known[b"-" * k] for k in range(1, j + 1) if b"-" * k in known]
        alpha.append(max(terms) + math.log(sum(math.exp(t - max(terms)) for t in terms)))
    assert lattice.marginal(dashes, table)[0] == pytest.approx(alpha[64]) and alpha[64] > known[b"-" * 64] - 1e-9


def test_places_that_no_piece_reaches_stay_impossible():
    table = lattice.PieceTable([b"ab", b"abc"], np.log([0.5, 0.5]))
    got = lattice.marginal(np.frombuffer(b"abxab", np.uint8)[None, :], table)
    assert got[0] == -np.inf


def test_wide_ids_and_names_of_stores(spark):
    docs = spark.createDataFrame([(1, "one two"), (2, None), (3, "three")], DOCS)
    with pytest.raises(Exception, match="needs more than 2 bytes"):
        tokens.count_tokens(docs, PATH, PATTERN, 100_000).collect()
    narrow, wide = (
        {r["doc_id"]: r["n_tokens"] for r in tokens.count_tokens(docs, PATH, PATTERN, sep, width=w).collect()}
        for sep, w in ((50256, 2), (100_000, 4))
    )
    assert narrow == wide and narrow[2] == 0
    with pytest.raises(ValueError):
        tokens.write_flat(docs, PATH, PATTERN, 1, width=3)


def test_a_file_of_another_attempt_changes_nothing(spark):
    docs = spark.createDataFrame([(i, "word " * i) for i in range(20)], DOCS).repartition(2)
    folder, places = tokens.write_flat(docs, PATH, PATTERN, 50256)
    system, root = tokens._file_system(folder)
    from pyarrow import fs

    for info in system.get_file_info(fs.FileSelector(root)):
        with system.open_output_stream(info.path.replace(".bin", "9.bin")) as out:
            out.write(np.array([5, 50256], "<u2").tobytes())
    lengths = tokens.document_lengths(spark, folder, 50256)
    got = {r["doc_id"]: r["n_tokens"] for r in places.join(lengths, ["file", "place"]).collect()}
    assert len(got) == 20 and all(got[i] >= i for i in range(20))


def test_repeated_seeds_take_little_time_and_lose_no_span():
    scanner = licenses.Scanner(licenses.NOTICES)
    start = time.time()
    assert scanner.spans("permission " * 20000) == []
    assert time.time() - start < 5
    text = "permission " * 30 + "permission is hereby granted, free of chrge, to any person obtaining a copy" + " permission" * 30
    assert [s[2] for s in scanner.spans(text)] == ["mit"]


def test_windows_that_are_left_out_hold_nothing():
    scanner, plain = licenses.Scanner(licenses.NOTICES), licenses.Scanner(licenses.NOTICES)
    plain._possible = lambda k, window: True
    for (a, _), (b, _) in itertools.product(licenses.NOTICES, repeat=2):
        for text in (a[: len(a) // 2] + b[len(b) // 2 :], a.replace("e", "", 2) + " " + b.replace(" ", "  ", 1)):
            assert scanner.spans(text) == plain.spans(text)


def test_base_places_against_plain_search(spark):
    words = ["mit", "license", "apache", "general", "public", "x"]
    texts = [" ".join(w) for w in itertools.product(words, repeat=4)]
    got = {r["doc_id"]: r for r in licenses.scan(spark.createDataFrame(list(enumerate(texts)), DOCS)).collect()}
    for i, text in enumerate(texts):
        own = text.split()
        places = sorted(k for p, _ in licenses.PHRASES for k in range(4) if own[k : k + len(p.split())] == p.split())
        labels = sorted({label for p, label in licenses.PHRASES if f" {p} " in f" {text} "})
        assert (got[i]["n_base"], got[i]["first_word"], got[i]["last_word"], got[i]["base_labels"]) == (
            len(places), places[0] if places else None, places[-1] if places else None, ",".join(labels)
        )


def test_marks_go_on_with_a_word():
    letters = language.Letters()
    codes, _ = letters.read(["नमस्ते दुनिया है", "é éa", "́", "́a"])
    inside = codes > 0
    assert int((inside[1:] & ~inside[:-1]).sum()) == 3 + 2 + 0 + 1


def test_many_languages(spark):
    names = [f"l{i:03d}" for i in range(300)]
    rows = [(i, f"{chr(97 + i % 26)}{chr(97 + i // 26)}q " * 30, names[i % 300]) for i in range(600)]
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.languages == names and model.logs.shape[0] == 300 and np.isfinite(model.logs).all()


def test_columns_of_clashing_names(spark):
    rows = [(1, 'password = "hunter2abc9"', 5, "k", 7), (1, 'password = "hunter2abc9"', 5, "k", 7), (2, None, 6, None, 8), (3, "w" * 300000, 0, "", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __base long, key string, base long")
    docs = docs.selectExpr("*", "base AS spans", "key AS dropped", "base AS label", "base AS id", "base AS n_tokens")
    ratio = secretscan.learned(docs, sample_texts=10)
    masked = secretscan.redact(docs, ratio)
    assert masked.columns == docs.columns
    assert [tuple(r)[2:] for r in masked.orderBy("doc_id").collect()] == [tuple(r)[2:] for r in docs.orderBy("doc_id").collect()]
    assert masked.filter("text like '%hunter2%'").count() == 0
    kept = neardup.one_of_each(docs.filter("doc_id > 1").withColumn("__dropped", docs["base"]))
    assert kept.count() == 2
    for found in (
        licenses.scan(docs), lattice.score(docs, PATH, PATTERN), tokens.count_tokens(docs, PATH, PATTERN, 50256),
        language.predict(docs.withColumn("lang", docs["key"])),
    ):
        assert sorted(r["doc_id"] for r in found.collect()) == [1, 1, 2, 3]


def test_blocks_of_windows_beside_a_column_called_key(spark, monkeypatch):
    monkeypatch.setattr(decontam, "BLOCK_WINDOWS", 1)
    docs = spark.createDataFrame([(1, "a b c", "k"), (2, "x y", None)], "doc_id long, text string, key string")
    items = spark.createDataFrame([(1, "a b"), (2, "b c"), (3, "y")], "item_id long, text string")
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"]) for r in decontam.hits(docs, items).collect()}
    assert got == {1: (3, 3, 2), 2: (2, 1, 1)}


def test_quality_model_reads_labelled_texts_only(spark):
    rows = [(i, "good words stand here and go on. " * 5 if i % 2 else "BAD!! BAD!! " * 9) for i in range(200)] + [(None, "no id"), (900, "no label")]
    docs = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)] + [(None, 1), (900, None), (3, 1)], "doc_id long, quality int")
    assert quality.labelled_sample(labels).count() == 201
    assert 0 < quality.labelled_sample(labels, rows=50).count() < 120
    kept = quality.kept_documents(docs.filter("doc_id < 200"), quality.fitted(docs, labels))
    assert {r["doc_id"] % 2 for r in kept.collect()} == {1} and kept.count() == 100
    none = quality.fitted(docs.filter("false"), labels.filter("false"))
    assert quality.kept_documents(docs, none).count() == docs.count()

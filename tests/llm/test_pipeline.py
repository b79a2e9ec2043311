"""The pipeline against brute-force versions of its stages, and its edge cases."""

import os
import shutil

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_joins_and_search import brute_components
from test_lines_and_spans import brute_lines

import corpus_pipeline
from cohortforge.llm import decontaminate, toxicity
from cohortforge.llm.queries import TOXIC_FROM, tokenizer_path, toxicity_model


def test_rows_equal_brute_force(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    model = toxicity_model(spark, data, docs)
    scorer = toxicity.Scorer(model)
    left = {r["doc_id"]: r["text"] for r in docs.collect()}
    value = {i: 1 / (1 + np.exp(-toxicity.document_features(scorer.sentences([t])) @ model.curve))[0] for i, t in left.items()}
    left = {i: t for i, t in left.items() if value[i] < TOXIC_FROM}
    left = brute_lines(sorted(left.items()))
    groups = brute_components(sorted(left.items()), 5, 80)
    left = {i: t for i, t in left.items() if groups[i][1] == i}
    items = [decontaminate.question_and_answer(r["text"]) for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()]

    def holds(text):
        words = decontaminate.words_of(text.casefold())
        return any(decontaminate.overlap(w[:c], words) == 1 and decontaminate.overlap(w[c:], words) == 1 for w, c in items)

    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, data).collect()}
    assert set(got) <= set(left)
    clean = spark.createDataFrame(sorted(left.items()), "doc_id long, text string")
    dirty = {r["doc_id"] for r in decontaminate.contaminated(clean, spark.read.parquet(f"{data}/benchmark.parquet")).collect()}
    assert set(got) == set(left) - dirty
    assert not any(holds(r["text"]) for r in got.values())
    assert {i: r["text"] for i, r in got.items()} == {i: left[i] for i in got}
    library = pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=tokenizer_path())
    assert all(r["ids"] == library.encode(r["text"]) and r["n_tokens"] == len(r["ids"]) for r in got.values())
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())


def test_stages_take_odd_rows(spark, odd_docs, data):
    docs = odd_docs
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, data)
        if name != "sentencepiece":
            assert out.columns == docs.columns
        assert stage(spark, docs.limit(0), data).count() == 0
        docs = out
    ids = sorted(r["doc_id"] if r["doc_id"] is not None else -1 for r in docs.collect())
    assert ids == [-1, 1, 2, 3, 4, 5, 5, 6]  # copies and repeated rows collapse, all else stays


def test_one_of_each_group_stays(spark, make_docs, data):
    base = " ".join(f"word{i}" for i in range(200))
    docs = make_docs([(3, base), (9, base + " more"), (4, base.replace("word100", "other")), (5, "a text of its own that stays as it is")])
    assert sorted(r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, docs, data).collect()) == [3, 5]


def test_run_works_on_a_copy_elsewhere(spark, data, tmp_path):
    for t in ("documents", "labels", "benchmark"):
        shutil.copy(f"{data}/{t}.parquet", tmp_path / f"{t}.parquet")
    rows = corpus_pipeline.run(spark, os.fspath(tmp_path))
    assert rows.agg(F.count("*")).first()[0] > 0

from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from rideflow.llm import quality

LARGE = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def fitted(spark):
    docs, labels = (spark.read.parquet(f"{LARGE}/{t}.parquet") for t in ("documents", "labels"))
    return docs, labels, quality.train(docs, labels)


def test_held_out_accuracy(spark, fitted):
    docs, labels, model = fitted
    rows = quality.scored(docs.join(labels, "doc_id").where(quality.fold(F.col("doc_id")) == 0), model).select("quality", "score", "predicted").collect()
    y, s, p = (np.array([r[c] for r in rows], float) for c in ("quality", "score", "predicted"))
    good, bad = s[y == 1], s[y == 0]
    assert (good[:, None] > bad[None, :]).mean() > 0.99
    assert (p == y).mean() > 0.97 and p[y == 1].mean() > 0.98 and p[y == 0].mean() < 0.12
    assert abs(s.mean() - y.mean()) < 0.03  # calibrated


def test_fold_is_that_of_crc32(spark):
    rows = spark.range(50).select("id", quality.fold(F.col("id")).alias("f")).collect()
    assert all(r.f == zlib.crc32(str(r.id).encode()) % 5 for r in rows)


def test_held_out_labels_teach_nothing(spark, fitted):
    docs, labels, model = fitted
    flipped = labels.withColumn("quality", F.when(quality.fold(F.col("doc_id")) == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert quality.train(docs, flipped) == model


def test_scores_are_of_the_text_alone(spark, fitted):
    docs, labels, model = fitted
    text = docs.first()["text"]
    df = spark.createDataFrame([(1, text, "en", 0.1), (2, text, None, 0.2), (None, text, "x", 0.3), (3, None, "x", 0.4), (4, "", "x", 0.5)],
                               "doc_id long, text string, lang string, Score double")
    rows = quality.scored(df, model).collect()
    assert len({r["score_"] for r in rows[:3]}) == 1 and rows[3]["score_"] == rows[4]["score_"]
    assert all(0 <= r["score_"] <= 1 and r["predicted"] == (r["score_"] >= 0.3) for r in rows) and rows[0]["Score"] == 0.1
    assert quality.accepted(df, model).columns == df.columns


def test_every_part_of_a_text_counts(fitted):
    model = fitted[2]
    measure = quality.Sizes(model.good, model.bad)
    clean = "the and attion to thanedble the anea " * 3000
    assert measure(clean) != measure(clean + "XQ!! ZZ## " * 2000)


def test_without_labels_or_rows(spark, fitted):
    docs, labels, _ = fitted
    assert quality.train(docs, labels.limit(0)) is None and quality.train(docs.limit(0), labels) is None
    report = quality.quality_report(docs.limit(3), labels.limit(0)).collect()
    assert [(r.score, r.predicted) for r in report] == [(0.5, 1)] * 3


def test_contradicting_and_null_labels(spark):
    rows = [(1, 1), (1, 1), (2, 0), (2, 1), (None, 1), (3, None), (4, 0), (8, 7)]
    got = quality.labelled(spark.createDataFrame(rows, "doc_id long, quality int")).collect()
    folds = {i: zlib.crc32(str(i).encode()) % 5 for i in (1, 4)}
    assert {(r.doc_id, r.label) for r in got} == {(i, q) for i, q in ((1, 1), (4, 0)) if folds[i] != 0}


def test_few_texts_still_make_a_model(spark):
    docs = spark.createDataFrame([(i, f"clean words {i}" if i % 2 else f"!!## {i}") for i in range(20)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, quality int")
    assert quality.quality_report(docs, labels).count() == 20

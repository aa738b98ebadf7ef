from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rideflow.llm import decontamination, mixing, quality, secrets
from rideflow.llm.common import read_table
from test_mixing import brute as brute_mix
from test_simhash import brute_groups, brute_print

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def staged(spark):
    """The input and the result of each stage."""
    sf_dir = "/root/testdata/sf0.01"
    docs = read_table(spark, sf_dir, "documents")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stage(spark, out[-1], sf_dir).persist())
    return sf_dir, out, [[tuple(r) for r in d.collect()] for d in out]


def test_the_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "simhash", "decontamination", "secrets", "mixing"]


def test_columns_stay(staged):
    _, frames, _ = staged
    assert all(f.columns == COLUMNS for f in frames[:-1]) and frames[-1].columns == [*COLUMNS, "copy"]


def test_quality_drops_what_it_rejects(spark, staged):
    sf_dir, frames, rows = staged
    model = quality.train(frames[0], read_table(spark, sf_dir, "labels"))
    measure = quality.Sizes(model.good, model.bad)
    keep = quality.score_texts(model, [r[1] or "" for r in rows[0]], measure) >= quality.THRESHOLD
    assert sorted(rows[1]) == sorted(r for r, k in zip(rows[0], keep) if k) and 0.7 < keep.mean() < 0.97


def test_one_document_of_each_group_stays(staged):
    _, _, rows = staged
    prints = [brute_print(r[1]) for r in rows[1]]
    ids = [r[0] for r in rows[1]]
    groups = brute_groups(prints, ids)
    assert sorted(rows[2]) == sorted(r for r, g in zip(rows[1], groups) if r[0] == g) and len(rows[2]) < len(rows[1])


def test_no_benchmark_passage_is_left(spark, staged):
    sf_dir, _, rows = staged
    items = [(r.item_id, r.text) for r in read_table(spark, sf_dir, "benchmark").collect()]
    grams = lambda t: {tuple(w[i : i + 5]) for w in [decontamination.words_of(t)] for i in range(len(w) - 4)}
    held = [grams(t) for _, t in items]
    leak = lambda t: any(g and len(g & own) >= 0.5 * len(g) for own in [grams(t)] for g in held)
    assert sorted(rows[3]) == sorted(r for r in rows[2] if not leak(r[1])) and len(rows[3]) < len(rows[2])


def test_secrets_are_masked(staged):
    _, _, rows = staged
    masked = [(i, secrets.redact(t), lang, s, len(secrets.redact(t)) if secrets.secret_spans(t) else n) for i, t, lang, s, n in rows[3]]
    assert sorted(rows[4]) == sorted(masked) and rows[4] != rows[3]


def test_copies_are_those_of_the_mix(staged):
    _, _, rows = staged
    wanted = {doc: (taken // size if size else None) for doc, size, _, _, taken in brute_mix([(i, t, s) for i, t, _, s, _ in rows[4]])}
    found: dict = {}
    for r in rows[5]:
        found[r[0]] = max(found.get(r[0], 0), r[-1])
    assert all(n is None or found.get(doc, 0) == n for doc, n in wanted.items())


def test_run_is_all_stages(spark, staged):
    sf_dir, _, rows = staged
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf_dir).collect())) == sorted(rows[-1])


def test_odd_documents(spark, staged):
    """Nulls in any column, repeated rows and an extra column pass through all stages."""
    sf_dir = staged[0]
    docs = read_table(spark, sf_dir, "documents").limit(150).withColumn("score", F.lit("own"))
    odd = spark.createDataFrame([(None, None, None, None, None, None), (None, "", None, None, 0, "x"), (1, None, "en", "src1", None, "y")] * 2,
                                "doc_id long, text string, lang string, source string, n_chars long, score string")
    now = docs.union(docs.limit(20)).union(odd)
    for _, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, sf_dir)
    assert now.columns == [*docs.columns, "copy"] and now.count() > 50


def test_no_documents(spark, staged):
    sf_dir = staged[0]
    now = read_table(spark, sf_dir, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, sf_dir)
    assert now.count() == 0
    assert mixing.targets(read_table(spark, sf_dir, "documents").limit(0)).count() == 0

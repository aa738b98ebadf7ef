from __future__ import annotations

import hashlib
import re
from math import floor

import pytest
from pyspark.sql import functions as F

from rideflow.llm import mixing

SCHEMA = "doc_id long, text string, source string"


def brute(rows):
    """The same mix, source by source, in plain Python."""
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sources = sorted({s for *_, s in rows}, key=lambda s: (s is None, (s or "").encode()))
    sizes = {s: sum(size(t) for _, t, x in rows if x == s) for s in sources}
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sources)}
    full, total = set(), sum(sizes.values())
    while True:
        open_ = [s for s in sources if s not in full]
        level = (1.5 * total - sum(2 * sizes[s] for s in full)) / sum(weight[s] for s in open_) if open_ else 0
        more = {s for s in open_ if 2 * sizes[s] < level * weight[s]}
        if not more:
            break
        full |= more
    target = {s: float(2 * sizes[s]) if s in full else level * weight[s] for s in sources}
    toss = lambda doc, text: int(hashlib.md5(f"{mixing.SEED}:{'' if doc is None else doc}:{text or ''}".encode()).hexdigest()[:13], 16)
    rate = {s: target[s] / sizes[s] if sizes[s] else 0 for s in sources}

    def copies(doc, text, s, turn):
        u = (toss(doc, text) + turn * 16**13 // 64) % 16**13 / 16**13
        return floor(rate[s]) + (u < rate[s] - floor(rate[s]))

    off = lambda s, turn: abs(sum(size(t) * copies(d, t, s, turn) for d, t, x in rows if x == s) - target[s])
    turn = {s: min(range(64), key=lambda k: (off(s, k), k)) for s in sources}
    out = [(doc, size(text), sizes[s], round(target[s], 6), size(text) * copies(doc, text, s, turn[s])) for doc, text, s in rows]
    return sorted(out, key=str)


def rows_of(df):
    return sorted(((r.doc_id, r.size, r.source_size, round(r.target, 6), r.taken) for r in df.collect()), key=str)


CASES = {
    "plain": [(i, "a b c " * (i % 7), f"s{i % 5}") for i in range(200)],
    "nulls": [(None, "a\tb", None), (1, None, "x"), (2, "", "x"), (3, "one two", None), (None, None, None)],
    "code points": [(1, "a " * 50, "Z"), (2, "a " * 10, "a"), (3, "a " * 9, "é"), (4, "a", ""), (5, "a a", "\U0001F600"), (6, "b " * 40, "�")],
    "all empty": [(1, "", "a"), (2, None, "b")],
    "no rows": [],
    "repeated rows": [(7, "w " * 11, "a")] * 5 + [(8, "w", "b")],
    "a null id throughout": [(None, "a b c " * (i % 7) + str(i), "hot") for i in range(150)] + [(i, "w " * (9 + i % 3), f"s{i % 3}") for i in range(60)],
    "a repeated id": [(4, "a b " * (i % 9) + str(i), f"s{i % 2}") for i in range(120)],
    "one large source": [(i, "w " * 5, "hot") for i in range(100)] + [(1000 + i, "w", f"t{i}") for i in range(20)],
}


@pytest.mark.parametrize("name", CASES)
def test_equals_brute_force(spark, name):
    df = spark.createDataFrame(CASES[name], SCHEMA)
    assert rows_of(mixing.mix_report(df)) == brute(CASES[name])


def test_emitted_rows_are_the_taken_words(spark):
    df = spark.createDataFrame(CASES["plain"], SCHEMA)
    copies = mixing.emitted(df)
    assert copies.columns == ["doc_id", "text", "source", "copy"]
    words = copies.agg(F.sum(mixing.document_words(F.col("text")))).first()[0]
    assert words == sum(r[-1] for r in brute(CASES["plain"]))
    assert copies.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 2


def test_other_columns_stay(spark):
    df = spark.createDataFrame([(1, "a b", "s", 5, 9.0)], "doc_id long, text string, source string, size int, Copy double")
    assert mixing.emitted(df).columns == ["doc_id", "text", "source", "size", "Copy", "copy_"]
    row = mixing.mixed(df).first()
    assert (row["size"], row["size_"], row["Copy"]) == (5, 2, 9.0)


def test_large_table_of_sources_needs_no_broadcast(spark, monkeypatch):
    from rideflow.operators import lookup

    rows = CASES["plain"]
    monkeypatch.setattr(lookup, "fits_broadcast", lambda *a, **k: False)
    assert rows_of(mixing.mix_report(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_words_come_near_the_targets(spark):
    df = spark.createDataFrame([(i, "w " * (1 + i % 40), f"s{i % 4}") for i in range(20_000)], SCHEMA)
    got = mixing.mix_report(df).groupBy("source_size").agg(F.sum("taken").alias("t"), F.first("target").alias("g")).collect()
    assert all(abs(r.t - r.g) < 0.002 * r.g for r in got)


@pytest.mark.parametrize("name", ["plain", "a null id throughout", "a repeated id"])
def test_sources_of_few_documents_come_near_too(spark, name):
    got = mixing.mix_report(spark.createDataFrame(CASES[name], SCHEMA)).groupBy("source_size").agg(
        F.sum("taken").alias("t"), F.first("target").alias("g"), F.max("size").alias("largest")).collect()
    assert all(abs(r.t - r.g) <= max(0.05 * r.g, 0.5 * r.largest) for r in got)


def test_sources_of_the_table_come_near(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = mixing.mix_report(docs).groupBy("source_size").agg(F.sum("taken").alias("t"), F.first("target").alias("g"), F.max("size").alias("largest")).collect()
    assert all(abs(r.t - r.g) <= max(0.05 * r.g, 0.5 * r.largest) for r in got)


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame(CASES["plain"], SCHEMA)
    plan = mixing.mix_report(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan

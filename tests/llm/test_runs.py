from __future__ import annotations

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np

from rideflow.llm import runs

SCHEMA = "doc_id long, text string"


def brute_runs(x):
    """Every period on its own: stretches of equal words that far apart, without those of a smaller period."""
    out = set()
    for q in range(1, len(x) // 3 + 1):
        i = 0
        while i + q < len(x):
            j = i
            while j + q < len(x) and x[j] == x[j + q]:
                j += 1
            length = j - i + q
            smaller = any(all(x[k] == x[k + r] for k in range(i, i + length - r)) for r in range(1, q)) if length >= max(24, 3 * q) else True
            if not smaller:
                out.add((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute(doc, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = None if doc is None else zlib.crc32(str(doc).encode())
    n = len(words)
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute_runs(words)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc, len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, sha(lines), sha(kept))


def test_runs_equal_brute_force():
    rng, seen = random.Random(5), 0
    for _ in range(400):
        x = []
        while len(x) < rng.choice([20, 60, 150]):
            period = [rng.randrange(rng.choice([1, 2, 3, 30])) for _ in range(rng.choice([1, 2, 3, 7, 8, 9, 16, 17, 33]))]
            x += (period * rng.choice([1, 1, 2, 3, 4, 9]))[: rng.randrange(1, 120)]
        wanted = brute_runs(x)
        seen += len(wanted)
        assert [tuple(r) for r in runs.find_runs(np.array(x, np.int64))] == wanted
    assert seen > 100


def test_work_does_not_grow_with_how_often_a_word_occurs():
    """A million equal words, and a text over two words without a run, are a few sorts."""
    assert [tuple(r) for r in runs.find_runs(np.zeros(1_000_000, np.int64))] == [(0, 1_000_000, 1)]
    assert runs.find_runs(np.array([i.bit_count() % 2 for i in range(1 << 19)])) == []


CASES = [
    (None, "a b " * 40), (None, None), (1, None), (2, ""), (3, " \t\n"), (4, "x " * 23), (5, "x " * 24), (6, "a b c d e f g h i " * 2 + "a b c d e f g"),
    (7, "a b c d e f g h i " * 3), (8, "a " * 30 + "b " * 30), (9, "é x y " * 30), (10, "a b " * 15 + "b " * 25 + "a b " * 15),
] + [(i, " ".join(f"w{k % (i % 37 + 2)}" for k in range(i % 90))) for i in range(11, 200)]


def test_report_equals_brute_force(spark):
    rows = CASES + [(8, CASES[9][1])] * 3
    got = [tuple(r) for r in runs.run_report(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert sorted(got, key=str) == sorted((brute(*r) for r in rows), key=str)
    assert any(r[1] > 1 for r in got) and sum(d is not None and zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in rows) > 5


def test_other_columns_stay_and_an_empty_table(spark):
    df = spark.createDataFrame([(1, "a " * 30, 5, "x")], "doc_id long, text string, runs int, Collapsed string")
    row = runs.periodic_runs(df).first()
    assert (row["runs"], row["Collapsed"], row["collapsed_"], row["runs_"][0]["length"]) == (5, "x", "a", 30)
    assert runs.run_report(df.limit(0)).count() == 0

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rideflow.llm import decontamination as dc


def plain_align(a, b):
    """Smith-Waterman cell by cell."""
    h = [[0.0] * (len(b) + 1) for _ in range(len(a) + 1)]
    best = 0.0
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            step = dc.MATCH if a[i - 1] == b[j - 1] else dc.MISMATCH
            h[i][j] = max(0.0, h[i - 1][j - 1] + step, h[i - 1][j] + dc.GAP, h[i][j - 1] + dc.GAP)
            best = max(best, h[i][j])
    return best


@pytest.mark.parametrize("seed", range(40))
def test_alignment_score(seed):
    rng = random.Random(seed)
    a, b = ([rng.randint(1, 4) for _ in range(rng.randint(1, 14))] for _ in range(2))
    score, start, end = dc.align(np.array(a), np.array(b))
    assert score == plain_align(a, b)
    assert plain_align(a, b[start:end]) == score  # the best alignment lies in the found part


WORDS = [a + b for a in "bcdfghjklm" for b in ("a", "e", "i", "o", "u", "an", "er")]


def text_of(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def planted():
    rng = random.Random(9)
    items = [(i, text_of(rng, 30 + i)) for i in range(12)] + [(50, "two words"), (51, "one short line of six"), (52, None), (53, ""), (54, "Exact Copy, OF one Item here now!")]
    clean = [(i, text_of(rng, 400)) for i in range(60)]
    long = text_of(rng, 500)
    items.append((60, long))
    leaks, docs = set(), list(clean)

    def plant(doc, item, passage):
        docs.append((doc, f"{text_of(rng, 80)} {passage} {text_of(rng, 80)}"))
        leaks.add((doc, item))

    for i, text in items[:12]:
        words = text.split()
        plant(1000 + i, i, text.upper().replace(" ", ",\n"))
        edited = list(words)
        for k in range(4, len(edited), 9):
            edited[k] = "changed"
        plant(1100 + i, i, " ".join(edited))
        plant(1200 + i, i, " ".join(w for k, w in enumerate(words) if k % 10 != 5))
        plant(1300 + i, i, " ".join(x for k, w in enumerate(words) for x in ([w, "inserted"] if k % 8 == 7 else [w])))
    plant(1400, 54, "exact copy of one item here now")
    plant(1500, 60, " ".join(long.split()[200:260]))
    docs += [(2000 + i, docs[70][1]) for i in range(5)]  # copies of a leak
    leaks |= {(2000 + i, x) for i in range(5) for d, x in list(leaks) if d == docs[70][0]}
    docs += [(3000, None), (3001, ""), (3002, "two words"), (3003, "one short line of"), (None, items[3][1])]
    leaks.add((None, 3))
    leaks.add((3002, 50)) if dc.SEED_WORDS <= 2 else None
    return items, docs, leaks


def test_planted_leaks(spark, planted):
    items, docs, leaks = planted
    rows = dc.leaked(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == leaks and len(rows) == len(leaks)
    by_id = dict(docs)
    for r in rows:
        if r.doc_id and 1000 <= r.doc_id < 1012:
            words = dc.words_of(by_id[r.doc_id])
            assert r.score == 1.0 and words[r.start_word : r.end_word] == dc.words_of(dict(items)[r.item_id])


def test_large_lookups_change_nothing(spark, planted, monkeypatch):
    from rideflow.operators import lookup

    items, docs, leaks = planted
    monkeypatch.setattr(lookup, "fits_broadcast", lambda *a, **k: False)
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in dc.leaked(df, bench).collect()} == leaks


def test_clean_rows_stay(spark, planted):
    items, docs, leaks = planted
    df = spark.createDataFrame([(i, t, "s", 1) for i, t in docs], "doc_id long, text string, Item_id string, score int")
    kept = dc.decontaminated(df, spark.createDataFrame(items, "item_id long, text string"))
    assert kept.columns == df.columns
    gone = {d for d, _ in leaks}
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for i, _ in docs if i not in gone)


def test_empty_tables(spark, planted):
    items, docs, _ = planted
    df, bench = spark.createDataFrame(docs[:5], "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert dc.leaked(df, bench.limit(0)).count() == 0 and dc.decontaminated(df, bench.limit(0)).count() == 5
    assert dc.leaked(df.limit(0), bench).count() == 0
    assert dc.leaked(df, bench.where("item_id in (52, 53)")).count() == 0


def test_seeds_are_rare_or_the_rarest_of_a_stretch_that_occur(spark, monkeypatch):
    monkeypatch.setattr(dc, "RARE", 3)
    rng = random.Random(2)
    times = {g: rng.choice([0, 0, 1, 2, 3, 9, 20]) for g in range(120)}
    items = [(i, p, rng.randrange(120)) for i in range(6) for p in range(40)]
    grams = spark.createDataFrame(items, "item_id long, item_place int, gram long")
    hits = spark.createDataFrame([(str(k), [g, g]) for g, n in times.items() for k in range(n)], "key string, grams array<long>")
    hits = hits.groupBy("key").agg(F.flatten(F.collect_list("grams")).alias("grams"))
    got = {(r.item_id, r.item_place) for r in dc.choose_seeds(grams, hits, 20).collect()}
    wanted = set()
    for i in range(6):
        for first in range(0, 40, dc.STRETCH):
            held = [(times[g], p) for k, p, g in items if k == i and first <= p < first + dc.STRETCH and times[g]]
            rare = {(i, p) for n, p in held if n <= 3}
            wanted |= rare or {(i, min(held)[1])} if held else set()
    assert got == wanted and 0 < len(got) < len(items)


def test_common_words_elsewhere_do_not_hide_a_leak(spark, monkeypatch):
    """No n-gram of the item is rare: near copies of it, and documents of its words, are everywhere."""
    monkeypatch.setattr(dc, "RARE", 2)
    rng = random.Random(8)
    item = text_of(rng, 40)
    words = item.split()
    docs = [(i, " ".join(rng.sample(words, 40))) for i in range(200)] + [(500 + i, f"x{i} {item}") for i in range(30)]
    for i, every in enumerate((5, 6, 7, 8)):
        docs.append((900 + i, " ".join("zzz" if k % every == every - 1 else w for k, w in enumerate(words))))
    rows = dc.leaked(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(1, item)], "item_id long, text string")).collect()
    assert {r.doc_id for r in rows} >= {*range(500, 530), *range(900, 904)}


def test_every_second_word_put_in_and_every_third_replaced_and_items_of_two_words(spark):
    rng = random.Random(4)
    items = [(0, text_of(rng, 24)), (1, text_of(rng, 24)), (2, "Zürich Basel"), (3, "alone")]
    put_in = " ".join(x for k, w in enumerate(items[0][1].split()) for x in ([w, "zzz"] if k % 2 else [w]))
    replaced = " ".join("zzz" if k % 3 == 1 else w for k, w in enumerate((items[1][1] + " " + items[1][1].split()[0]).split()))
    docs = [(0, put_in), (1, replaced), (2, "from Zürich, Basel is near"), (3, "all alone")]
    rows = dc.leaked(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in rows} >= {(0, 0), (2, 2)} and all(r.item_id != 3 for r in rows)


def numbered(*texts):
    known: dict = {}
    return [np.array([known.setdefault(w, len(known) + 1) for w in dc.words_of(t)]) for t in texts]


def test_whole_table(spark, sf_dir):
    """Against every alignment of all items with all documents that share five words in a row."""
    docs, bench = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    texts, items = ({r[0]: r["text"] for r in t.collect()} for t in (docs, bench))
    grams = lambda w: {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    held = {i: grams(dc.words_of(t)) for i, t in items.items()}
    wanted = {(d, i) for d, t in texts.items() for i, g in held.items() if len(g & grams(dc.words_of(t))) >= 0.5 * len(g)}
    assert {(r.doc_id, r.item_id) for r in dc.leaked(docs, bench).collect()} == wanted and wanted


@pytest.mark.parametrize("copies", [0, 5])
@pytest.mark.parametrize("every", [4, 5, 6, 7, 8])
def test_regular_edits_hide_nothing(spark, every, copies):
    """Against a full alignment, with and without exact copies elsewhere; also short items with one word changed."""
    rng = random.Random(every)
    items = [(i, text_of(rng, n)) for i, n in enumerate([40, 40, 60, 25, 10, 13])]
    docs = []
    for i, text in items:
        words = text.split()
        cuts = range(every - 1, len(words), every) if len(words) > 13 else [len(words) // 2]
        for kind in ("replaced", "left out", "put in"):
            new = {"replaced": lambda w: ["zzz"], "left out": lambda w: [], "put in": lambda w: [w, "zzz"]}[kind]
            passage = [x for k, w in enumerate(words) for x in (new(w) if k in cuts else [w])]
            docs.append((len(docs), f"{text_of(rng, 50)} {' '.join(passage)} {text_of(rng, 50)}"))
        docs += [(len(docs) + k, f"{text_of(rng, 20)} {text} {text_of(rng, 20)}") for k in range(copies)]
    sizes = [len(dc.words_of(t)) for _, t in items]
    aligned = {(d, i): dc.align(*numbered(item, t))[0] for d, t in docs for i, item in items}
    wanted = {k: s for k, s in aligned.items() if s >= dc.least_score(sizes[k[1]])}
    assert len(wanted) >= len(docs)
    rows = dc.leaked(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id): r.score * dc.MATCH * sizes[r.item_id] for r in rows} == pytest.approx(wanted)


def test_random_edits_hide_nothing(spark):
    """Whatever aligns well enough and has two words in a row is found."""
    rng = random.Random(5)
    items = [(i, text_of(rng, rng.randint(8, 70))) for i in range(30)]
    docs = []
    for share in (0.1, 0.15, 0.2, 0.25, 0.3, 0.35):
        for _, text in items:
            kept = [rng.choice([[], ["zzz"], [w, rng.choice(WORDS)]]) if rng.random() < share else [w] for w in text.split()]
            docs.append((len(docs), f"{text_of(rng, 40)} {' '.join(x for p in kept for x in p)} {text_of(rng, 40)}"))
    grams = lambda t: set(dc.gram_hashes(dc.words_of(t)).tolist())
    wanted = {(d, i) for d, t in docs for i, item in items if grams(t) & grams(item) and dc.align(*numbered(item, t))[0] >= dc.least_score(len(item.split()))}
    rows = dc.leaked(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == wanted and len(wanted) > 100


@pytest.mark.parametrize("seed", range(20))
def test_words_in_common_bound_the_score(seed):
    rng = random.Random(seed)
    a, b = (np.array([rng.randint(1, 5) for _ in range(rng.randint(1, 30))]) for _ in range(2))
    long = np.zeros((len(a) + 1, len(b) + 1), int)
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            long[i + 1, j + 1] = long[i, j] + 1 if x == y else max(long[i, j + 1], long[i + 1, j])
    assert dc.common_words(a, b) == long[-1, -1] and dc.align(a, b)[0] <= dc.MATCH * long[-1, -1]


def test_short_items_need_more_of_their_words():
    items = ["What is the capital city of the Netherlands", "The longest river that flows through three of the capitals", text_of(random.Random(1), 16)]
    given = [{"item_id": i, "item": t, "starts": list(range(-20, 20))} for i, t in enumerate(items)]
    found = lambda text: {r["item_id"] for r in dc.leaks_of(text, given)}
    assert found("The capital city of the Netherlands is Amsterdam") == set()
    assert found("So: what is the capital city of the Netherlands?") == {0}
    assert found("it flows through three of the old towns") == set()
    assert found("the longest river that crosses through three of the capitals") == {1}
    assert found(" ".join(items[2].split()[4:12])) == {2} and found(" ".join(items[2].split()[4:11])) == set()
    assert [dc.least_score(n) / (dc.MATCH * n) for n in (3, 7, 8, 10, 16, 40, 60)] == [1, 1, 1, 0.8, 0.5, 0.5, 0.5]

from __future__ import annotations

import random
import re

import pytest
import xxhash

from rideflow.llm import simhash
from rideflow.llm.components import components

A_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(A_Z))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints, keys):
    """The smallest key reachable over all pairs at four or fewer differing bits."""
    label = list(range(len(prints)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                label[root(i)] = root(j)
    least = {}
    for i, k in enumerate(keys):
        if k is not None:
            least[root(i)] = min(k, least.get(root(i), k))
    return [least.get(root(i)) for i in range(len(prints))]


@pytest.mark.parametrize("text", [
    None, "", " \t\n", "one", "One two three", "a b c d", "A b\x0bc\x0cd e É ſ K", "x " * 1000, "a b c d e f", "the cat sat on the mat and the cat sat on the mat",
])
def test_fingerprint(text):
    assert simhash.fingerprint(text or "") % (1 << 64) == brute_print(text)


def test_long_texts_are_read_in_parts(monkeypatch):
    text = " ".join(random.Random(1).choices("abcdefgh", k=500))
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "_CHUNK", 7)
    assert simhash.fingerprint(text) == whole


def signed(p):
    return p - (1 << 64) if p >> 63 else p


def linked_prints():
    """Random numbers, chains of near ones, and a dense group."""
    rng = random.Random(5)
    flip = lambda p, n: p ^ sum(1 << b for b in rng.sample(range(64), n))
    prints = [rng.getrandbits(64) for _ in range(300)] + [0, 1, 0b11111, 0b1111, (1 << 64) - 1]
    for base in prints[:60]:
        prints += [flip(base, n) for n in (1, 2, 3, 4, 5, 6)]
    at = prints[70]
    for _ in range(40):
        at = flip(at, 4)
        prints.append(at)
    centre = rng.getrandbits(64)
    prints += [flip(centre, rng.randint(0, 3)) for _ in range(150)]
    return sorted(set(prints))


def test_groups_equal_brute_force(spark):
    prints = linked_prints()
    nodes = spark.createDataFrame([(signed(p), 1) for p in prints], "print long, copies long")
    got = {r["print"]: r["component"] for r in simhash.print_components(nodes).collect()}
    assert set(got) == {signed(p) for p in prints}
    wanted = brute_groups(prints, [signed(p) for p in prints])
    assert [got[signed(p)] for p in prints] == wanted


def test_every_pair_within_the_distance_has_a_chain():
    """The pigeonring condition, on every way to spread up to four bits over the ring."""
    import itertools

    n = 5
    for counts in itertools.product(range(5), repeat=n):
        if sum(counts) <= 4:
            assert any(all(sum(counts[(s + i) % n] for i in range(m)) <= m - 1 for m in range(1, n + 1)) for s in range(n))


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    raw = [(r.doc_id, r.text) for r in docs.collect()]
    prints = [brute_print(t) for _, t in raw]
    wanted = dict(zip([i for i, _ in raw], zip(prints, brute_groups(prints, [i for i, _ in raw]))))
    rows = simhash.simhash_report(docs).collect()
    assert {r.doc_id: (int(r.fingerprint, 16), r.component_id) for r in rows} == wanted and len(rows) == len(raw)


def test_nulls_repeats_ties_and_clashes(spark):
    a, b = "one two three four five six", "altogether another line of words stands here"
    rows = [(5, a, "x"), (5, a, "x"), (3, a, "y"), (None, a, "z"), (7, None, "n"), (8, "", "n"), (None, b, "q"), (None, b, "q"), (5, b + " more and more", "w")]
    df = spark.createDataFrame(rows, "doc_id long, text string, Print string")
    got = sorted(((r.doc_id, r.component_id) for r in simhash.simhash_report(df).collect()), key=str)
    assert got == sorted([(5, 3), (5, 3), (3, 3), (None, 3), (7, 7), (8, 7), (None, None), (None, None), (5, 5)], key=str)
    kept = simhash.deduplicated(df)
    assert kept.columns == df.columns
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([(3, a, "y"), (7, None, "n"), (None, b, "q"), (5, b + " more and more", "w")], key=str)


def test_no_rows(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.simhash_report(df).count() == 0 and simhash.deduplicated(df).count() == 0


@pytest.mark.parametrize("links, groups", [
    ([], {}),
    ([(1, 1)], {1: 1}),
    ([(2, 1), (1, 2), (2, 2), (None, 3), (3, None)], {1: 1, 2: 1}),
    ([(i, i + 1) for i in range(60)], {i: 0 for i in range(61)}),
    ([(i * 37 % 61, (i + 1) * 37 % 61) for i in range(59)], None),
    ([(0, i) for i in range(1, 50)] + [(100 + i, 100) for i in range(1, 50)], {**{i: 0 for i in range(50)}, **{i: 100 for i in range(100, 150)}}),
])
def test_components(spark, links, groups):
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    if groups is None:
        nodes = {x for pair in links for x in pair}
        groups = dict.fromkeys(nodes, min(nodes))
    assert got == groups

from __future__ import annotations

import hashlib
import zlib

import pytest

from rideflow.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars int, text string"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(digests):
    paths, level, at = [[] for _ in digests], digests, list(range(len(digests)))
    while len(level) > 1:
        for i, a in enumerate(at):
            first = a // 3 * 3
            paths[i].append(("".join(level[first:a]), "".join(level[a + 1 : first + 3])))
            at[i] = a // 3
        level = [sha(*level[i : i + 3]) for i in range(0, len(level), 3)]
    return (level[0] if level else None), paths


def brute(rows):
    by = {}
    for row in rows:
        by.setdefault(row[1], []).append((row, leaf(row)))
    for held in by.values():
        held.sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([d for _, d in by[s]]) for s in order}
    root, tops = tree([trees[s][0] for s in order])
    out = []
    for s, top in zip(order, tops):
        for (row, own), path in zip(by[s], trees[s][1]):
            now = own
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 and row[4] is not None:
                now = leaf((*row[:4], row[4].replace("\n", "")))
            for left, right in path + top:
                now = sha(left, now, right)
            out.append((row[0], own, trees[s][0], root, sha(*(x + y for x, y in path + top)), now, now == root))
    return sorted(out, key=str)


CASES = {
    "several bands": [(i, f"s{i % 3}" if i % 7 else None, "en", i * 2, f"a\nb {i % 11}") for i in range(900)],
    "band edges": [(i, f"s{n}", None, 1, "x\n") for n in (1, 2, 3, 4, 80, 81, 82, 243, 244) for i in range(n)],
    "one row": [(1, "a", "x", 3, "t\n")],
    "nulls": [(None, None, None, None, None)] * 5 + [(None, None, None, None, "a\n")] * 4 + [(3, "", "", 0, "")],
    "many sources": [(i, f"s{i}", None, 1, "\n") for i in range(300)],
    "repeated rows": [(7, "a", "b", 1, "x\ny")] * 100,
    "a long text": [(2, "a", "b", 1, "x\n" * 500_000), (4, "Zürich", "b", 1, "é\n")],
    "no rows": [],
}


@pytest.mark.parametrize("name", CASES)
def test_equals_brute_force(spark, name):
    got = [tuple(r) for r in merkle.manifest_report(spark.createDataFrame(CASES[name], SCHEMA)).collect()]
    assert sorted(got, key=str) == brute(CASES[name])


def test_other_columns_do_not_count_and_large_lookups_are_joined(spark, monkeypatch):
    from rideflow.operators import lookup

    monkeypatch.setattr(lookup, "fits_broadcast", lambda *a, **k: False)
    rows = CASES["several bands"]
    wide = spark.createDataFrame([(*r, "t", 5, "d") for r in rows], SCHEMA + ", tree string, rank int, digest string")
    assert sorted((tuple(r) for r in merkle.manifest_report(wide).collect()), key=str) == brute(rows)


def test_without_changes_every_document_folds_to_the_root(spark):
    rows = merkle.manifest(spark.createDataFrame(CASES["band edges"], SCHEMA)).collect()
    assert rows and all(r.folded_root == r.root for r in rows)

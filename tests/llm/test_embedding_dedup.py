from __future__ import annotations

import numpy as np
import pytest

from rideflow.llm import embedding_dedup as ed

SCHEMA = "vec_id long, embedding array<float>"


def clustered(n=400, d=16, seed=0, spread=(0.02, 0.05, 0.1, 0.2)):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    for i in range(n // 2):
        base = x[n - 1 - i % (n // 8)]
        x[i] = base / np.linalg.norm(base) + rng.normal(size=d) * spread[i % len(spread)] / np.sqrt(d)
    return x.astype(np.float32)


def brute(vectors):
    """Links and components over all pairs, in double precision."""
    ids = [i for i, _ in vectors]
    ok = [x is not None and len(x) > 0 and None not in x and np.isfinite(x).all() and np.any(np.array(x) != 0) for _, x in vectors]
    n, label, links = len(vectors), list(range(len(vectors))), [0] * len(vectors)

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    units = [np.array(x, np.float64) / np.linalg.norm(np.array(x, np.float64)) if good else None for (_, x), good in zip(vectors, ok)]
    for i in range(n):
        for j in range(i):
            if ok[i] and ok[j] and len(units[i]) == len(units[j]) and units[i] @ units[j] >= 0.95:
                links[i] += 1
                links[j] += 1
                label[root(i)] = root(j)
    least = {}
    for i, k in enumerate(ids):
        if k is not None:
            least[root(i)] = min(k, least.get(root(i), k))
    return sorted(((ids[i], links[i], least.get(root(i)), least.get(root(i)) == ids[i]) for i in range(n)), key=str)


def rows_of(df):
    return sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in df.collect()), key=str)


@pytest.mark.parametrize("block, centres", [(10_000, 512), (64, 512), (16, 4)])
def test_equals_brute_force(spark, monkeypatch, block, centres):
    monkeypatch.setattr(ed, "BLOCK", block)
    monkeypatch.setattr(ed, "MOST_CENTRES", centres)
    monkeypatch.setattr(ed.links, "__defaults__", (ed.COSINE, block))
    vectors = [(i, x.tolist()) for i, x in enumerate(clustered())]
    got = rows_of(ed.embedding_report(spark.createDataFrame(vectors, SCHEMA)))
    wanted = brute(vectors)
    assert got == wanted and sum(r[1] for r in wanted) > 500


@pytest.mark.parametrize("seed", range(6))
def test_two_blocks(seed):
    x = ed.unit(clustered(300, 8, seed, (0.001, 0.05, 0.15, 0.3)))
    a, b = x[::2], x[1::2]
    counts, groups = ed.linked(a, b, ed.tree(a), ed.tree(b))
    near = a @ b.T >= 0.95
    assert counts.tolist() == [*near.sum(axis=1), *near.sum(axis=0)]
    i, j = np.nonzero(near)
    assert (groups[i] == groups[len(a) + j]).all()
    own, _ = ed.linked(x, None, ed.tree(x), None)
    assert own.tolist() == ((x @ x.T >= 0.95).sum(axis=1) - 1).tolist()


def test_groups_join_nothing_else():
    x = ed.unit(clustered(200, 24, 3, (0.01, 0.02)))
    counts, groups = ed.linked(x, None, ed.tree(x), None)
    near = x @ x.T >= 0.95
    reach = near.copy()
    for _ in range(8):
        reach = (reach.astype(int) @ reach.astype(int)) > 0
    assert ((groups[:, None] == groups[None, :]) == reach).all()


def test_levels_are_nested_and_cover():
    x = ed.unit(clustered(300, 6, 1))
    levels = ed.tree(x)
    for level, radius in zip(levels, ed.RADII):
        assert (ed.chord(np.einsum("ij,ij->i", x, x[level.centre[level.node]])) <= level.radius[level.node] + 1e-7).all()
    for coarse, fine in zip(levels, levels[1:]):
        assert set(coarse.centre) <= set(fine.centre)
        apart = ed.chord(x[coarse.centre] @ x[coarse.centre].T)
        assert (apart[~np.eye(len(apart), dtype=bool)] > 0.12).all()


ODD = [
    (1, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [1.0, None]), (7, [float("nan"), 1.0]),
    (8, [float("inf"), 1.0]), (None, [1.0, 0.01]), (9, [1.0, 0.0, 0.0]), (10, [1.0, 0.0, 0.1]), (11, [-1.0, 0.0]), (None, [0.0, 1.0]), (12, [1e-30, 0.0]), (13, [5.0]),
]


def test_odd_vectors(spark):
    got = rows_of(ed.embedding_report(spark.createDataFrame(ODD, SCHEMA)))
    wanted = [(i, n, c, True if i is None and c is None else k) for i, n, c, k in brute(ODD)]
    assert got == sorted(wanted, key=str)


def test_huge_numbers_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, [1e300, 1e300], 1, "x"), (2, [1e-300, 1e-300], 2, "y")], "vec_id long, embedding array<double>, row int, x string")
    assert rows_of(ed.near_vectors(df)) == [(1, 1, 1, True), (2, 1, 1, False)]


def test_no_rows(spark):
    assert ed.embedding_report(spark.createDataFrame([], SCHEMA)).count() == 0
    assert rows_of(ed.embedding_report(spark.createDataFrame([(1, None)], SCHEMA))) == [(1, 0, 1, True)]

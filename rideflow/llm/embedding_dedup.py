"""Embedding near-duplicates: exact cosine links by dual traversal of cover trees.

On unit vectors a cosine threshold is a chord length. The top of the tree is a bounded set of
centres fitted on a bounded sample; every vector hangs below its nearest centre, and the covering
radius of a centre is measured over all its vectors. A large cell is dealt into blocks. Pairs of
cells whose balls lie further apart than the threshold are pruned. For every other pair of blocks
one task walks the blocks' own trees level by level (radii 1, 1/2, 1/4, 1/8): pairs of nodes are
pruned by their covering radii, node pairs that lie within the threshold as a whole are counted
without looking at vectors, and the rest is compared in double precision.

Links are counted, not emitted: a task returns one row per linked vector.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rideflow.llm.common import arrow_batches, written
from rideflow.llm.components import components

COSINE = 0.95
#: Chord lengths of the tree's levels, coarse to fine.
RADII = (1.0, 0.5, 0.25, 0.125)
#: Bounds: vectors in the sample, centres at the top, vectors of a block (about).
FIT_VECTORS, MOST_CENTRES, BLOCK = 4096, 512, 4096
#: Rounding room of the pruning bounds; the threshold itself has none.
ROOM = 1e-7
_TILE = 256


class Level(NamedTuple):
    """Nodes of one level: centre and covering radius of each, and the node of every vector."""

    centre: np.ndarray
    radius: np.ndarray
    node: np.ndarray


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1 in double precision, without overflow."""
    x = vectors.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def chord(cosine: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * cosine))


def _net(x: np.ndarray, points: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
    """A net of ``points``: centres further apart than the radius, and the place of each point's centre."""
    least = 1.0 - radius * radius / 2.0
    own = x[points]
    near = np.zeros(len(points), bool)
    for lo in range(0, len(points), _TILE):
        near[lo : lo + _TILE] = (own[lo : lo + _TILE] @ own.T >= least).sum(axis=1) > 1
    owner = np.where(near, -1, np.arange(len(points)))  # alone: a centre of itself
    open_ = np.flatnonzero(near)
    while len(open_):
        first = open_[0]
        taken = own[open_] @ own[first] >= least
        taken[0] = True
        owner[open_[taken]] = first
        open_ = open_[~taken]
    chosen, place = np.unique(owner, return_inverse=True)
    return points[chosen], place


def tree(x: np.ndarray) -> list[Level]:
    """Nested levels of unit vectors, coarse to fine: every centre is a centre of all finer levels."""
    points, node, levels = np.arange(len(x)), np.arange(len(x)), []
    for radius in reversed(RADII):
        points, place = _net(x, points, radius)
        node = place[node]
        distance = chord(np.einsum("ij,ij->i", x, x[points[node]]))
        reach = np.zeros(len(points))
        np.maximum.at(reach, node, distance)
        alone = np.bincount(node, minlength=len(points)) == 1
        levels.append(Level(points, np.where(alone, 0.0, reach + ROOM), node))
    levels.reverse()
    return levels


def _useful(levels: list[Level]) -> list[int]:
    """The finest level, and the coarser ones with at most half the nodes of the next one used."""
    used = [len(levels) - 1]
    for i in range(len(levels) - 2, -1, -1):
        if 2 * len(levels[i].centre) <= len(levels[used[0]].centre):
            used.insert(0, i)
    return used


def _least_cosine(distance: np.ndarray) -> np.ndarray:
    """The cosine at a chord length; every pair reaches it where the length is two or more."""
    return np.where(distance >= 2.0, -2.0, 1.0 - distance * distance / 2.0 - ROOM)


class _Groups:
    """Groups of vectors that are merged pair by pair, many pairs at once."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def merge(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.parent[a], self.parent[b]
            apart = a != b
            a, b = a[apart], b[apart]
            np.minimum.at(self.parent, np.maximum(a, b), np.minimum(a, b))
            while (jumped := self.parent[self.parent] != self.parent).any():
                self.parent[jumped] = self.parent[self.parent[jumped]]


def linked(
    x: np.ndarray, y: np.ndarray | None, left: list[Level], right: list[Level] | None, cosine: float = COSINE
) -> tuple[np.ndarray, np.ndarray]:
    """Links of each vector, and the group of each, over the vectors of ``x`` followed by those of ``y``.

    ``left`` and ``right`` are their trees. Without ``y`` the vectors of ``x`` are compared with each
    other, each pair counting for both.
    """
    same = y is None
    other, right = (x, left) if same else (y, right)
    n, shift = len(x), 0 if same else len(x)
    counts, groups = np.zeros(n + (0 if same else len(other)), np.int64), _Groups(n + (0 if same else len(other)))
    limit = float(np.sqrt(2.0 - 2.0 * cosine))
    used = sorted(set(_useful(left)) | set(_useful(right)))

    allowed, before = None, None
    for i in used[:-1]:
        a, b = left[i], right[i]
        ok = x[a.centre] @ other[b.centre].T >= _least_cosine(limit + a.radius[:, None] + b.radius[None, :])
        if allowed is not None:
            ok &= allowed[_parents(a, left[before])][:, _parents(b, right[before])]
        allowed, before = ok, i

    a, b = left[-1], right[-1]
    members_a, members_b = _members(a), _members(b)
    size_a, size_b = np.bincount(a.node, minlength=len(a.centre)), np.bincount(b.node, minlength=len(b.centre))
    up_a = _parents(a, left[before]) if before is not None else None
    up_b = _parents(b, right[before]) if before is not None else None
    count_a, count_b = np.zeros(len(a.centre), np.int64), np.zeros(len(b.centre), np.int64)
    whole_a, whole_b = np.zeros(len(a.centre), bool), np.zeros(len(b.centre), bool)
    for lo in range(0, len(a.centre), _TILE):
        rows = np.arange(lo, min(lo + _TILE, len(a.centre)))
        near = x[a.centre[rows]] @ other[b.centre].T
        radii = a.radius[rows][:, None] + b.radius[None, :]
        # Two single vectors are compared exactly, nodes by their bound.
        open_ = near >= np.where(radii == 0.0, cosine, _least_cosine(limit + radii))
        if allowed is not None:
            open_ &= allowed[up_a[rows]][:, up_b]
        if not open_.any():
            continue
        within = open_ & ((radii == 0.0) | (chord(near) + radii <= limit - ROOM))
        count_a[rows] += within @ size_b
        i, j = np.nonzero(within)
        groups.merge(a.centre[rows[i]], shift + b.centre[j])
        paired = (rows[i] != j) if same else np.ones(len(i), bool)
        whole_a[rows[i]] = True
        whole_b[j[paired]] = True
        if not same:
            count_b += size_a[rows] @ within
        for i, j in zip(*np.nonzero(open_ & ~within)):
            _compare(x, other, members_a(rows[i]), members_b(j), cosine, counts, groups, shift, same)
    counts[:n] += count_a[a.node]
    if same:
        counts -= whole_a[a.node]  # each node holds itself
    else:
        counts[n:] += count_b[b.node]
        groups.merge(shift + np.flatnonzero(whole_b[b.node]), shift + b.centre[b.node[whole_b[b.node]]])
    groups.merge(np.flatnonzero(whole_a[a.node]), a.centre[a.node[whole_a[a.node]]])
    return counts, groups.parent


def _parents(fine: Level, coarse: Level) -> np.ndarray:
    return coarse.node[fine.centre]


def _members(level: Level):
    order = np.argsort(level.node, kind="stable")
    ends = np.cumsum(np.bincount(level.node, minlength=len(level.centre)))
    return lambda i: order[(ends[i - 1] if i else 0) : ends[i]]


def _compare(x, other, rows, cols, cosine, counts, groups, shift, same) -> None:
    """Compare the vectors of two nodes, some rows at a time."""
    for lo in range(0, len(rows), _TILE):
        part = rows[lo : lo + _TILE]
        hit = x[part] @ other[cols].T >= cosine
        if same:
            hit &= part[:, None] != cols[None, :]
        counts[part] += hit.sum(axis=1)
        if not same:
            counts[shift + cols] += hit.sum(axis=0)
        i, j = np.nonzero(hit)
        groups.merge(part[i], shift + cols[j])


def _top(sample: np.ndarray, wanted: int) -> np.ndarray:
    """Centres for the top: the finest level of the sample's tree with no more than wanted, else part of the next."""
    if wanted <= 1 or len(sample) <= 1:
        return sample[:1]
    points, chosen = np.arange(len(sample)), [np.arange(1)]
    for radius in RADII:
        net, _ = _net(sample, points, radius)
        chosen.append(net)
        if len(net) > wanted:
            break
    fits = [c for c in chosen if len(c) <= wanted][-1]
    more = chosen[-1] if len(chosen[-1]) > wanted else fits
    rest = more[~np.isin(more, fits)]
    return sample[np.concatenate([fits, rest[: wanted - len(fits)]])]


def _usable(column: str = "embedding"):
    x = F.col(column)
    finite = ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    return F.coalesce(x.isNotNull() & (F.size(x) > 0) & finite & F.exists(x, lambda v: v != 0), F.lit(False))


def _cells(vectors: DataFrame, tops: dict[int, np.ndarray]) -> DataFrame:
    """``row, x, size, cell, distance``: the nearest centre of the same length; cell 0 where there is none."""
    shared = vectors.sparkSession.sparkContext.broadcast(tops)

    def nearest(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            cell, distance = np.zeros(len(part), np.int64), np.full(len(part), 2.0)
            for size, at in part.groupby("size").indices.items():
                if size in shared.value:
                    near = unit(np.stack(part["x"].to_numpy()[at])) @ shared.value[size].T
                    cell[at] = near.argmax(axis=1)
                    distance[at] = chord(near.max(axis=1))
            yield part.assign(cell=cell, distance=distance)

    return vectors.mapInPandas(nearest, "row long, x array<double>, size int, cell long, distance double")


def _cell_pairs(tops: dict[int, np.ndarray], cells: list, cosine: float) -> list[tuple[int, int, int]]:
    """``(size, cell, cell)`` of the cells whose balls come within the threshold; the number of cells is bounded."""
    limit, out = float(np.sqrt(2.0 - 2.0 * cosine)), []
    for size in sorted({c["size"] for c in cells}):
        own = [c for c in cells if c["size"] == size]
        for k, c in enumerate(own):
            for d in own[k:]:
                near = True
                if size in tops and c is not d:
                    apart = chord(tops[size][c["cell"]] @ tops[size][d["cell"]])
                    near = apart <= limit + c["reach"] + d["reach"] + ROOM
                if near:
                    out.append((size, c["cell"], d["cell"]))
    return out


_BLOCK = "rows array<long>, xs array<double>, centres array<array<int>>, radii array<array<double>>, nodes array<array<int>>"


def _with_trees(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each block with unit vectors and its tree, so that the pairs need not build it again."""
    for part in parts:
        out = []
        for rows, xs in zip(part["rows"], part["xs"]):
            x = unit(np.asarray(xs).reshape(len(rows), -1))
            levels = tree(x)
            out.append((x.ravel(), *([level[i] for level in levels] for i in range(3))))
        made = pd.DataFrame(out, columns=["xs", "centres", "radii", "nodes"], index=part.index)
        yield part[["size", "cell", "block", "rows"]].join(made)


def _block_of(rows, xs, centres, radii, nodes) -> tuple[np.ndarray, np.ndarray, list[Level]]:
    levels = [Level(np.asarray(c), np.asarray(r), np.asarray(n)) for c, r, n in zip(centres, radii, nodes)]
    return np.asarray(rows), np.asarray(xs).reshape(len(rows), -1), levels


def links(vectors: DataFrame, cosine: float = COSINE, block: int = BLOCK) -> DataFrame:
    """``row, root, n``: links of each vector within one pair of blocks, and its group's first vector there.

    ``vectors(row, x, size)`` holds usable vectors with distinct row numbers.
    """
    spark: SparkSession = vectors.sparkSession
    sizes = {r["size"]: r["n"] for r in vectors.groupBy("size").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n")).limit(MOST_CENTRES).collect()}
    total, tops = sum(sizes.values()), {}
    picked = vectors.orderBy(F.xxhash64("row")).limit(FIT_VECTORS).collect()
    for size, n in sizes.items():
        own = [r["x"] for r in picked if r["size"] == size]
        if own:
            tops[size] = _top(unit(np.array(own)), max(1, min(MOST_CENTRES * n // max(total, 1), n // block)))
    placed = written(_cells(vectors, tops), "cells")
    cells = placed.groupBy("size", "cell").agg(F.count(F.lit(1)).alias("n"), F.max("distance").alias("reach"))
    # One row per cell: a bounded number, as at most so many lengths have centres; others have one cell each.
    found = cells.collect()
    deal = F.create_map(*[F.lit(v) for c in found for v in (f"{c['size']}:{c['cell']}", -(-c["n"] // block))]) if found else F.lit(None)
    part = F.pmod(F.xxhash64("row"), F.element_at(deal, F.concat_ws(":", "size", "cell"))).cast("int") if found else F.lit(0)
    dealt = placed.withColumn("part", part)
    blocks = dealt.groupBy("size", "cell", "part").agg(F.collect_list("row").alias("rows"), F.flatten(F.collect_list("x")).alias("xs"))
    blocks = blocks.withColumn("block", F.concat_ws(":", "size", "cell", "part")).select("size", "cell", "block", "rows", "xs")
    with arrow_batches(spark, 4):  # a row holds a whole block
        blocks = written(blocks.mapInPandas(_with_trees, f"size int, cell long, block string, {_BLOCK}"), "blocks")

    pairs = spark.createDataFrame(_cell_pairs(tops, found, cosine), "size int, cell_a long, cell_b long")
    names = blocks.select("size", "cell", "block")
    pairs = (
        pairs.join(names.withColumnsRenamed({"cell": "cell_a", "block": "a"}), ["size", "cell_a"])
        .join(names.withColumnsRenamed({"cell": "cell_b", "block": "b"}), ["size", "cell_b"])
        .where("cell_a != cell_b OR a <= b")
        .select("a", "b")
    )
    own = blocks.drop("size", "cell")
    joined = pairs
    for side in "ab":
        joined = joined.join(own.toDF(side, *[f"{c}_{side}" for c in own.columns[1:]]), side)

    def compare(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for r in part.itertuples():
                rows, x, left = _block_of(r.rows_a, r.xs_a, r.centres_a, r.radii_a, r.nodes_a)
                if r.a == r.b:
                    counts, groups = linked(x, None, left, None, cosine)
                else:
                    more, y, right = _block_of(r.rows_b, r.xs_b, r.centres_b, r.radii_b, r.nodes_b)
                    counts, groups = linked(x, y, left, right, cosine)
                    rows = np.concatenate([rows, more])
                some = counts > 0
                yield pd.DataFrame({"row": rows[some], "root": rows[groups[some]], "n": counts[some]})

    with arrow_batches(spark, 4):
        return written(joined.mapInPandas(compare, "row long, root long, n long"), "vector-links")


def near_vectors(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", cosine: float = COSINE) -> DataFrame:
    """One row per vector: ``key, n_links, component_id, kept``.

    A vector that is null, empty, zero or holds a null or non-finite component links with nothing;
    neither do vectors of different lengths. Rows are vectors of their own even if their keys are
    equal or null; equal rows link with each other. ``component_id`` is the smallest key reachable,
    nulls last.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(f"`{key}`").alias("key"), F.col(f"`{column}`").cast("array<double>").alias("x"))
    numbered = written(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")
    usable = numbered.where(_usable("x")).select("row", "x", F.size("x").alias("size"))
    with arrow_batches(spark, 1024):
        found = links(usable, cosine)
    groups = written(components(found.select(F.col("row").alias("a"), F.col("root").alias("b"))), "vector-groups")
    keys = numbered.select("row", "key")
    least = groups.join(keys.withColumnRenamed("row", "node"), "node").groupBy("component").agg(F.min("key").alias("least"))
    named = groups.join(least, "component").select(F.col("node").alias("row"), F.col("least"))
    counts = found.groupBy("row").agg(F.sum("n").alias("n"))
    out = keys.join(counts, "row", "left").join(named, "row", "left")
    component = F.coalesce("least", "key")
    return out.select(
        F.col("key").alias(key),
        F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        component.eqNullSafe(F.col("key")).alias("kept"),
    )


def embedding_report(vectors: DataFrame) -> DataFrame:
    """The links of the production threshold over all rows."""
    return near_vectors(vectors.select("vec_id", "embedding"))

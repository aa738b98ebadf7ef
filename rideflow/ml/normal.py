"""Linear regression by normal equations: one mergeable aggregation, then a solve of fixed size."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_ONE = "1"


@dataclass(frozen=True)
class Linear:
    """``intercept`` and one coefficient per feature."""

    features: tuple[str, ...]
    intercept: float
    coefficients: tuple[float, ...]

    def predicted(self) -> Column:
        """The prediction for a row that has the features; null where one is missing."""
        terms = [F.col(f).cast("double") * F.lit(c) for f, c in zip(self.features, self.coefficients)]
        return reduce(add, terms, F.lit(self.intercept))


def gram(rows: DataFrame, features: Sequence[str], label: str, by: Sequence[str] = ()) -> DataFrame:
    """``by, left, right, rows, total``: sums of products of all pairs of the features, the label and ``1``.

    One pass, combined before the shuffle; sums of parts add up to those of the whole. Rows with a null
    in any of the columns are left out, from all sums alike.
    """
    columns = [_ONE, *features, label]
    value = {c: F.lit(1.0) if c == _ONE else F.col(c).cast("double") for c in columns}
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    whole = reduce(lambda x, y: x & y, (value[c].isNotNull() for c in columns[1:]))
    sums = [F.sum(value[a] * value[b]).alias(f"_{i}") for i, (a, b) in enumerate(pairs)]
    wide = rows.filter(whole).groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), *sums)
    cells = [F.struct(F.lit(a).alias("left"), F.lit(b).alias("right"), F.col(f"_{i}").alias("total")) for i, (a, b) in enumerate(pairs)]
    return wide.select(*by, "rows", F.inline(F.array(*cells)))


def solved(table: DataFrame, features: Sequence[str], label: str) -> Linear:
    """The least squares fit from the sums of one group; a feature that the others determine gets the smallest coefficients.

    The driver gets one row per pair of columns. Without rows all coefficients are 0.
    """
    total = {(r.left, r.right): r.total or 0.0 for r in table.collect()}
    rows = total.get((_ONE, _ONE), 0.0)
    if not rows:
        return Linear(tuple(features), 0.0, (0.0,) * len(features))
    pair = lambda a, b: total[(a, b) if (a, b) in total else (b, a)]
    mean = {c: pair(_ONE, c) / rows for c in (*features, label)}
    centred = lambda a, b: pair(a, b) / rows - mean[a] * mean[b]
    spread = np.array([max(centred(f, f), 0.0) ** 0.5 for f in features])
    scale = np.where(spread > 1e-9 * np.array([abs(mean[f]) + 1.0 for f in features]), spread, np.inf)
    left = np.array([[centred(a, b) for b in features] for a in features]) / np.outer(scale, scale)
    right = np.array([centred(f, label) for f in features]) / scale
    found = np.linalg.lstsq(left, right, rcond=1e-10)[0] / scale
    intercept = mean[label] - sum(c * mean[f] for c, f in zip(found, features))
    return Linear(tuple(features), float(intercept), tuple(map(float, found)))


def fit(rows: DataFrame, features: Sequence[str], label: str) -> Linear:
    return solved(gram(rows, features, label), features, label)

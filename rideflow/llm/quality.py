"""Quality classifier by compression: one zstandard dictionary from good texts, one from bad ones.

A text is compressed piece by piece with either dictionary. The difference of the two sizes over
the length of the text says which dictionary knows it better; a logistic curve, fitted on labelled
texts, makes it a calibrated score. Every piece of a text counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rideflow.llm.common import fresh, small_batches, whole_text, written

#: Bounds of the fit: labelled texts of each class, and pieces and characters of each that the
#: dictionaries see. Calibration uses the whole texts of these rows.
FIT_TEXTS, FIT_PIECES, FIT_CHARS = 3000, 4, 2000
DICTIONARY_BYTES, LEVEL, PIECE = 112 * 1024, 3, 8192
FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.3


class Model(NamedTuple):
    """What scoring needs; under half a megabyte."""

    good: bytes
    bad: bytes
    low: tuple[float, ...]
    high: tuple[float, ...]
    centre: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]


def fold(key: Column) -> Column:
    """The fold of a key: crc32 of its text, modulo the folds. Null counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % FOLDS


class Sizes:
    """Compressed sizes of texts under both dictionaries and without one."""

    def __init__(self, good: bytes, bad: bytes):
        self.by = [zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)]
        for content in (good, bad):
            made = zstandard.ZstdCompressionDict(content)
            made.precompute_compress(level=LEVEL)
            self.by.append(zstandard.ZstdCompressor(dict_data=made, write_content_size=False, write_dict_id=False))

    def __call__(self, text: str) -> tuple[float, float, float]:
        """Normalised size difference, compressed share without a dictionary, log length."""
        data = text.encode("utf-8", "replace")
        if not data:
            return 0.0, 0.0, 0.0
        pieces = [data[i : i + PIECE] for i in range(0, len(data), PIECE)]
        plain, good, bad = (sum(len(c.compress(p)) for p in pieces) for c in self.by)
        return (bad - good) / len(data), plain / len(data), float(np.log1p(len(data)))


def _inputs(sizes: np.ndarray) -> np.ndarray:
    """The three sizes, their squares and products."""
    d, r, n = sizes.T
    return np.stack([d, r, n, d * d, r * r, n * n, d * r, d * n, r * n], axis=1)


def _fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weighted logistic regression with a small ridge, by damped Newton steps."""
    centre, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
    a = np.c_[np.ones(len(x)), (x - centre) / scale]
    w, ridge = np.zeros(a.shape[1]), np.full(a.shape[1], 1e-3 * weight.sum() / max(len(x), 1))

    def loss(w: np.ndarray) -> float:
        z = a @ w
        return float(weight @ (np.logaddexp(0, z) - y * z) + ridge @ (w * w) / 2)

    for _ in range(100):
        p = _logistic(a @ w)
        slope = a.T @ (weight * (p - y)) + ridge * w
        step = np.linalg.solve((a.T * (weight * p * (1 - p))) @ a + np.diag(ridge), slope)
        size, now = 1.0, loss(w)
        while size > 1e-6 and loss(w - size * step) > now:
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return centre, scale, w


def _logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def labelled(labels: DataFrame, key: str = "doc_id", label: str = "quality") -> DataFrame:
    """``key, label`` of the keys that may teach: outside the held-out fold, all labels alike.

    Null keys and labels and keys with contradicting labels teach nothing; repeated rows count once.
    """
    rows = labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1) & (fold(F.col(key)) != HELD_OUT))
    return rows.groupBy(key).agg(F.min(label).alias("label"), F.max(label).alias("other")).where("label = other").drop("other")


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id") -> Model | None:
    """Dictionaries and calibration from a bounded sample of the labelled texts; None without both classes.

    The sample takes the first keys of each class by hash. Rows are weighted so that each class
    counts as in all labels, which keeps the score calibrated.
    """
    teaching = labelled(labels, key)
    counts = {r["label"]: r["n"] for r in teaching.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if set(counts) != {0, 1}:
        return None
    order = F.xxhash64(key, F.lit("fit"))
    picked = None
    for value in (0, 1):
        part = teaching.where(F.col("label") == value).orderBy(order, key).limit(FIT_TEXTS)
        picked = part if picked is None else picked.union(part)
    # At most 2 * FIT_TEXTS keys, so the broadcast is bounded; the texts they pick are kept once.
    rows = docs.select(key, whole_text().alias("text")).join(F.broadcast(picked), key)
    sample = written(rows.groupBy(key, "label").agg(F.min("text").alias("text")), "quality-fit")
    step = F.greatest(F.lit(1), F.floor(F.length("text") / FIT_PIECES)).cast("int")
    pieces = F.transform(F.sequence(F.lit(0), F.lit(FIT_PIECES - 1)), lambda i: F.substring(F.col("text"), i * step + 1, F.lit(FIT_CHARS)))
    cut = sample.select(key, "label", F.array_distinct(pieces).alias("pieces")).collect()
    made = []
    for value in (1, 0):
        texts = [p.encode("utf-8", "replace") for r in sorted(cut, key=lambda r: r[key]) if r["label"] == value for p in r["pieces"] if p]
        made.append(_dictionary(texts))
    if not all(made):
        return None

    sizes = _measure(made[0], made[1])
    small_batches(docs.sparkSession)
    seen = sample.select(key, "label", sizes("text").alias("s")).select(key, "label", "s.*").collect()
    seen.sort(key=lambda r: r[key])
    y = np.array([r["label"] for r in seen], float)
    share = {v: counts[v] / max(1, (y == v).sum()) for v in (0, 1)}
    weight = np.where(y == 1, share[1], share[0])
    found = np.array([[r["difference"], r["plain"], r["length"]] for r in seen])
    fitted = _fit(_inputs(found), y, weight / weight.mean())
    return Model(*made, *(tuple(map(float, v)) for v in (found.min(axis=0), found.max(axis=0), *fitted)))


def _dictionary(texts: list[bytes]) -> bytes:
    """A trained dictionary; the plain texts where there are too few to train on."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, texts, level=LEVEL).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(texts)[-DICTIONARY_BYTES:]


def _measure(good: bytes, bad: bytes):
    @F.pandas_udf("struct<difference: double, plain: double, length: double>")
    def sizes(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        measure = Sizes(good, bad)
        for texts in parts:
            yield pd.DataFrame([measure(t) for t in texts], columns=["difference", "plain", "length"])

    return sizes


def score_texts(model: Model, texts: list[str], measure: Sizes) -> np.ndarray:
    """Scores of texts, each by itself; sizes beyond those of the fit count as the nearest of them."""
    if not texts:
        return np.zeros(0)
    sizes = np.clip(np.array([measure(t) for t in texts]), model.low, model.high)
    x = (_inputs(sizes) - model.centre) / model.scale
    return _logistic(model.weights[0] + (x * model.weights[1:]).sum(axis=1))


def scored(docs: DataFrame, model: Model | None) -> DataFrame:
    """The rows with ``score`` (0 to 1, higher: better) and ``predicted``.

    Only the text counts: null is empty, and an empty text has the score of size 0. Without a model
    (no labels of either class) every score is 0.5. Columns of these names in ``docs`` stay; the
    new ones then get longer names.
    """
    score, predicted = fresh(docs, "score"), fresh(docs, "predicted")
    if model is None:
        value = F.lit(0.5)
    else:
        small_batches(docs.sparkSession)
        shared = docs.sparkSession.sparkContext.broadcast(model)

        @F.pandas_udf("double")
        def judge(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            known = shared.value
            measure = Sizes(known.good, known.bad)
            for texts in parts:
                yield pd.Series(score_texts(known, list(texts), measure))

        value = judge(whole_text())
    rows = docs.withColumn(score, value)
    return rows.withColumn(predicted, F.when(F.col(score) >= THRESHOLD, 1).otherwise(0))


def accepted(docs: DataFrame, model: Model | None) -> DataFrame:
    """The rows that the classifier keeps, with the columns of ``docs``."""
    rows = scored(docs, model)
    return rows.where(F.col(rows.columns[-1]) == 1).select(*[f"`{c}`" for c in docs.columns])


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: whether it is held out, its score and class."""
    model = train(docs, labels)
    rows = scored(docs.select("doc_id", "text"), model)
    return rows.select("doc_id", (fold(F.col("doc_id")) == HELD_OUT).alias("held_out"), "score", "predicted")

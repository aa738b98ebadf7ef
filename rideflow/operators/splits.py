"""Train, validation and test splits."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRAIN, VALIDATION, TEST = "train", "validation", "test"


def time_split_label(ts: str = "pickup_ts", validation_from: str = "2024-01-01", test_from: str = "2024-07-01") -> Column:
    """Which part a row belongs to by its time; earlier rows train."""
    when = F.col(ts)
    return (
        F.when(when < F.lit(validation_from).cast("timestamp"), TRAIN)
        .when(when < F.lit(test_from).cast("timestamp"), VALIDATION)
        .when(when.isNotNull(), TEST)
    )


def time_range(
    since: str | None = None, before: str | None = None, ts: str = "pickup_ts", month_columns: tuple[str, str] | None = None
) -> Column:
    """Rows from ``since`` on and before ``before``, as plain bounds that reach the scan.

    With the year and month columns of a partitioned table, months outside are pruned too.
    """
    when, kept = F.col(ts), F.col(ts).isNotNull()
    if since:
        kept = kept & (when >= F.lit(since).cast("timestamp"))
    if before:
        kept = kept & (when < F.lit(before).cast("timestamp"))
    if month_columns:
        year, month = (F.col(c) for c in month_columns)
        if since:
            y, m = int(since[:4]), int(since[5:7])
            kept = kept & ((year > y) | (year == y) & (month >= m))
        if before:
            y, m = int(before[:4]), int(before[5:7])
            kept = kept & ((year < y) | (year == y) & (month <= m))
    return kept


def time_split(
    rows: DataFrame,
    ts: str = "pickup_ts",
    validation_from: str = "2024-01-01",
    test_from: str = "2024-07-01",
    month_columns: tuple[str, str] | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three parts, each a range of times; name the month columns of a partitioned table to prune it."""
    bounds = ((None, validation_from), (validation_from, test_from), (test_from, None))
    return tuple(rows.filter(time_range(*bound, ts, month_columns)) for bound in bounds)


def random_split(rows: DataFrame, train: float = 0.8, seed: int = 42) -> list[DataFrame]:
    """Spark's own random split; depends on the partitioning of the input."""
    return rows.randomSplit([train, 1.0 - train], seed)


def _point(keys: Sequence[str], seed: int) -> Column:
    """A number below a million by the md5 of the keys as text, so that any engine finds the same."""
    text = F.concat_ws("|", F.lit(str(seed)), *(F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % 1_000_000


def keyed_split(rows: DataFrame, keys: Sequence[str], train: float = 0.8, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """A split by hash of the key columns: the same rows in each part however the input is partitioned."""
    in_train = _point(keys, seed) < int(train * 1_000_000)
    return rows.filter(in_train), rows.filter(~in_train)


def keyed_sample(rows: DataFrame, keys: Sequence[str], rate: float, seed: int = 42) -> DataFrame:
    """About this share of the rows, by hash of the key columns.

    The same rows however the input is partitioned; those of a smaller rate are part of those of a larger
    one, and rows of equal keys stay or go together.
    """
    return rows.filter(_point(keys, seed) < round(rate * 1_000_000))


def forward_bounds(first: str, last: str, folds: int) -> list[tuple[str, str]]:
    """``folds`` stretches of equal length that end at ``last``, as (from, to) days; the time from ``first`` to the first of them trains it.

    A fold trains on all that lies before its stretch, so the stretch of one is in the training range of the next.
    """
    start, end = date.fromisoformat(first), date.fromisoformat(last)
    if folds < 1 or (end - start).days < folds + 1:
        raise ValueError(f"{folds} folds do not fit between {first} and {last}")
    days = (end - start).days
    cuts = [start + timedelta(days=days * n // (folds + 1)) for n in range(1, folds + 2)]
    return [(a.isoformat(), b.isoformat()) for a, b in zip(cuts, cuts[1:])]


def forward_split(
    rows: DataFrame, bound: tuple[str, str], first: str | None = None, ts: str = "pickup_ts", month_columns: tuple[str, str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """The rows before a fold's stretch, and those in it; both are ranges that reach the scan."""
    return tuple(rows.filter(time_range(*part, ts, month_columns)) for part in ((first, bound[0]), bound))

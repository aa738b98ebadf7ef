"""Periodic runs: stretches of words that repeat with a period, by a sparse diagonal DP.

A cell (word, lag) of the DP is the number of words in a row, up to this one, that equal the words
``lag`` before them: an earlier occurrence lengthens its lag's diagonal by one, any other word ends
it, and a diagonal that ends long enough is a run. Only cells that can belong to a run are made. At
the scale of 2^k words a word's cell is the nearest earlier occurrence of the 2^k words starting
with it, if it lies more than 2^(k-1) and at most 2^k words back. By Fine and Wilf's theorem a run
of such a period has exactly these cells: a nearer occurrence would give it a smaller period. So a
text of n words has at most n cells a scale, however often its words occur.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rideflow.llm.common import DOCUMENT_WORD, fresh, small_batches, whole_text

#: A run has at least so many words, and at least so many periods.
LEAST_WORDS, LEAST_PERIODS = 24, 3
#: The first scale, for all periods up to it: a run of period q has LEAST_WORDS >= q + 16 words or 3q >= q + 16.
FIRST_SCALE = 16

_RUN = T.StructType().add("start", T.LongType()).add("length", T.LongType()).add("period", T.LongType())
_FOUND = T.StructType().add("runs", T.ArrayType(_RUN)).add("collapsed", T.StringType())


class Run(NamedTuple):
    start: int
    length: int
    period: int


def words_of(text: str) -> list[bytes]:
    """The words between ASCII white space, as UTF-8."""
    return text.encode("utf-8", "replace").split()


def numbers_of(words: list[bytes]) -> np.ndarray:
    """Equal words get equal numbers."""
    known: dict[bytes, int] = {}
    return np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))


def _doubled(names: np.ndarray, size: int) -> np.ndarray:
    """Names of windows of twice the size; equal windows have equal names."""
    count = len(names) - size
    return np.unique(names[:count] * (int(names.max()) + 1) + names[size:], return_inverse=True)[1]


def _nearest_lags(names: np.ndarray) -> np.ndarray:
    """By window how far back its nearest earlier occurrence is; 0 without one."""
    order = np.argsort(names, kind="stable")
    same = names[order[1:]] == names[order[:-1]]
    lags = np.zeros(len(names), np.int64)
    lags[order[1:][same]] = (order[1:] - order[:-1])[same]
    return lags


def find_runs(numbers: np.ndarray) -> list[Run]:
    """All runs of a sequence by start, then period.

    A run is a stretch with smallest period q and at least LEAST_WORDS words and LEAST_PERIODS
    periods which no neighbouring word extends.
    """
    names, size, shortest, out = numbers, 1, 0, []
    while len(numbers) >= max(LEAST_WORDS, LEAST_PERIODS * (shortest + 1)):
        scale = max(FIRST_SCALE, 2 * shortest)
        while size < scale:
            names, size = _doubled(names, size), 2 * size
        lags = _nearest_lags(names)
        if not lags.any():  # nor does any longer window occur twice
            break
        lags[(lags <= shortest) | (lags > scale)] = 0
        # A diagonal is a stretch of cells of one lag.
        edges = np.flatnonzero(np.diff(lags, prepend=0, append=0))
        for start, end in zip(edges[:-1].tolist(), edges[1:].tolist()):
            lag = int(lags[start])
            length = end - start + scale - 1 + lag
            if lag and length >= max(LEAST_WORDS, LEAST_PERIODS * lag):
                out.append(Run(start - lag, length, lag))
        shortest = scale
    return sorted(out, key=lambda r: (r.start, r.period))


def collapsed(words: list[bytes], runs: list[Run]) -> str:
    """The words but those that a run contains after its first period, joined by one space."""
    if not runs:
        return b" ".join(words).decode("utf-8")
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    kept = np.flatnonzero(np.cumsum(change[:-1]) == 0)
    return b" ".join([words[i] for i in kept.tolist()]).decode("utf-8")


@F.pandas_udf(_FOUND)
def _runs_of(texts: pd.Series) -> pd.DataFrame:
    rows = []
    for text in texts:
        words = words_of(text)
        runs = find_runs(numbers_of(words))
        rows.append(([r._asdict() for r in runs], collapsed(words, runs)))
    return pd.DataFrame(rows, columns=["runs", "collapsed"])


def periodic_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows with ``runs`` (start, length and period in words, by start) and ``collapsed``, the text without the repeats.

    Texts are read one by one and whole; null and empty ones have no run and collapse to an empty
    text. Repeated rows get equal results. Columns of these names in ``docs`` stay; the new ones
    then get a longer name.
    """
    small_batches(docs.sparkSession)
    found, runs, short = fresh(docs, "_found"), fresh(docs, "runs"), fresh(docs, "collapsed")
    rows = docs.withColumn(found, _runs_of(whole_text(text)))
    return rows.withColumns({runs: F.col(found)["runs"], short: F.col(found)["collapsed"]}).drop(found)


def best_run(runs: Column) -> Column:
    """The run of the greatest exact exponent; the first start, then the smallest period of equal ones; null without a run."""

    def better(best: Column, run: Column) -> Column:
        more = run["length"] * best["period"], best["length"] * run["period"]
        first = (more[0] == more[1]) & (F.struct(run["start"], run["period"]) < F.struct(best["start"], best["period"]))
        return F.when(best.isNull() | (more[0] > more[1]) | first, run).otherwise(best)

    return F.reduce(runs, F.lit(None).cast(_RUN), better)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """The documents that ``run_report`` reads: one in ten, by the hash of its id, repeats some of its words to the end.

    Documents of no id or no word stay as they are.
    """
    words = F.regexp_extract_all(whole_text(), F.lit(DOCUMENT_WORD), F.lit(0))
    hashed = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    group, n = F.floor(hashed / 10), F.size("_words").cast("long")
    first = F.pmod(group, n)
    period = 1 + F.floor((n - F.col("_first")) / (3 + F.pmod(group, F.lit(8))))
    place = lambda i: F.when(i < F.col("_first"), i).otherwise(F.col("_first") + F.pmod(i - F.col("_first"), F.col("_period")))
    again = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.element_at("_words", (place(i) + 1).cast("int")))
    planted = docs.select("doc_id", "text", F.when(F.pmod(hashed, F.lit(10)) == 0, words).alias("_words"))
    planted = planted.withColumn("_words", F.when(F.size("_words") > 0, F.col("_words")))
    planted = planted.withColumn("_first", F.when(F.col("_words").isNotNull(), first)).withColumn("_period", period)
    return planted.select("doc_id", F.when(F.col("_words").isNotNull(), F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))


def run_report(docs: DataFrame) -> DataFrame:
    """One row per document: the number of runs, the one of the greatest exponent, digests of all runs and of the collapsed text."""
    rows = periodic_runs(with_planted_runs(docs))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))), F.lit("\n")))
    rows = rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best_run(F.col("runs")).alias("best"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
    exponent = F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long")
    return rows.select("doc_id", "n_runs", "best.start", "best.length", "best.period", exponent.alias("exponent_milli"), "runs_sha256", "collapsed_sha256")

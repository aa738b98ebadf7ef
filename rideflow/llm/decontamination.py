"""Benchmark decontamination: rare n-gram seeds joined with documents, then Smith-Waterman alignment.

The n-grams of the benchmark that also stand in documents are counted there. Seeds are the rare ones, and
where a stretch of an item has none the rarest that occurs, so that an edit silences no more than the n-grams it touches.
Documents and items meet in a join on seeds; only these pairs are aligned, after two upper bounds that no leak
can fail. Neither table goes through the driver: documents are told what n-grams to look for by a filter of fixed size.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rideflow.llm.common import fresh, small_batches, whole_text, written
from rideflow.operators.lookup import lookup_join

WORD = re.compile(r"\w+")
#: Two words: a leak whose every third word is replaced, or that has a word put in after every second, keeps some.
SEED_WORDS = 2
#: An n-gram is rare in up to so many different texts, or one in so many of all.
RARE, RARE_SHARE = 20, 20_000
#: In every stretch of so many n-grams of an item there is a seed, if any of them occurs.
STRETCH = 6
#: An item is leaked from this share of its best possible alignment score, or from LONG_RUN whole
#: words, but not below the score of SHORT words in a row; an item of fewer words needs all of them.
LEAST_SCORE, LONG_RUN, SHORT = 0.5, 30, 8
MATCH, MISMATCH, GAP = 2.0, -1.0, -1.0
#: Bits of the filter that documents are read with; 16 MB at most, whatever the benchmark.
FILTER_BITS = 1 << 27

LEAKS = "array<struct<item_id: long, score: double, start_word: long, end_word: long>>"
_HITS = T.StructType().add("grams", T.ArrayType(T.LongType())).add("places", T.ArrayType(T.IntegerType()))


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def align(item: np.ndarray, text: np.ndarray) -> tuple[float, int, int]:
    """The best Smith-Waterman score of two word sequences, and where it starts and ends in the text.

    One row per item word. A row is first found without gaps along the text; these then follow from
    a running maximum, as a gap costs the same for every word.
    """
    n = len(text)
    if not n or not len(item):
        return 0.0, 0, 0
    steps = GAP * np.arange(n + 1)
    score, start = np.zeros(n + 1), np.arange(n + 1)
    best, found = 0.0, (0, 0)
    for word in item:
        diagonal = score[:-1] + np.where(text == word, MATCH, MISMATCH)
        above = score[1:] + GAP
        row, begun = np.zeros(n + 1), np.arange(n + 1)
        up = above > diagonal
        value = np.where(up, above, diagonal)
        origin = np.where(up, start[1:], start[:-1])
        row[1:] = np.maximum(value, 0.0)
        begun[1:] = np.where(value > 0, origin, begun[1:])
        # The best cell to the left, less the gap to here.
        lifted = row - steps
        reach = np.maximum.accumulate(lifted)
        came = np.maximum.accumulate(np.where(lifted == reach, np.arange(n + 1), 0))
        score, start = reach + steps, begun[came]
        top = int(score.argmax())
        if score[top] > best:
            best, found = float(score[top]), (int(start[top]), top)
    return best, *found


def least_score(length: int) -> float:
    """The alignment score from which an item of so many words is leaked."""
    return min(max(MATCH * min(length, SHORT), MATCH * length * LEAST_SCORE), MATCH * LONG_RUN)


def common_words(item: np.ndarray, text: np.ndarray) -> int:
    """The length of the longest common subsequence, one bit per item word; no alignment matches more words."""
    bits: dict[int, int] = {}
    for i, word in enumerate(item.tolist()):
        bits[word] = bits.get(word, 0) | 1 << i
    full = rest = (1 << len(item)) - 1
    for word in text.tolist():
        match = rest & bits.get(word, 0)
        if match:
            rest = (rest + match | rest - match) & full
    return len(item) - rest.bit_count()


def gram_hashes(words: list[str]) -> np.ndarray:
    """The n-grams of a sequence of words as signed 64-bit numbers, in order; none if it is shorter."""
    n = len(words) - SEED_WORDS + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    hashes = pd.util.hash_array(np.array(words, object), categorize=False)  # with a fixed key, alike in every task
    out = np.zeros(n, np.uint64)
    for i in range(SEED_WORDS):
        out = (out ^ (out >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + n]
    return (out ^ (out >> np.uint64(32))).view(np.int64)


@F.pandas_udf(T.ArrayType(T.LongType()))
def _grams_of(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: gram_hashes(words_of(t)))


def _items(benchmark: DataFrame) -> DataFrame:
    """``item_id, text``; null, empty and repeated items count once or not at all."""
    items = benchmark.where(F.col("item_id").isNotNull()).select("item_id", whole_text().alias("text")).distinct()
    return items.where("text != ''")


def _filter(item_grams: DataFrame) -> np.ndarray:
    """A bit for each n-gram of the benchmark, at its hash's place; the driver gets no more words than the filter has."""
    bit = F.pmod(F.col("gram"), F.lit(FILTER_BITS))
    found = item_grams.groupBy(F.floor(bit / 64).cast("int").alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, CAST(pmod(gram, {FILTER_BITS}) % 64 AS INT))")).alias("bits"))
    rows = found.toPandas()
    out = np.zeros(FILTER_BITS // 64, np.int64)
    out[rows["word"].to_numpy()] = rows["bits"].to_numpy()
    return out.view(np.uint8)


def _hits(docs: DataFrame, wanted: np.ndarray) -> DataFrame:
    """``key, grams, places``: the n-grams of each different text that may be of the benchmark; written."""
    bits = docs.sparkSession.sparkContext.broadcast(wanted)

    @F.pandas_udf(_HITS)
    def hits(texts: pd.Series) -> pd.DataFrame:
        rows, held = [], bits.value
        for text in texts:
            grams = gram_hashes(words_of(text))
            place = grams & (FILTER_BITS - 1)
            at = np.flatnonzero(held[place >> 3] >> (place & 7).astype(np.uint8) & 1)
            rows.append((grams[at], at.astype(np.int32)))
        return pd.DataFrame(rows, columns=["grams", "places"])

    rows = docs.select(_key().alias("key"), hits(whole_text()).alias("hit")).where(F.size("hit.grams") > 0)
    return written(rows.groupBy("key").agg(F.first("hit").alias("hit")).select("key", "hit.*"), "hits")


def _key() -> Column:
    """Equal texts are one in all that follows."""
    return F.unhex(F.md5(whole_text().cast("binary")))


def choose_seeds(item_grams: DataFrame, hits: DataFrame, documents: int) -> DataFrame:
    """``gram, item_id, item_place``: the rare n-grams that occur, and the rarest of each stretch that has no rare one."""
    counts = hits.select(F.explode(F.array_distinct("grams")).alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("texts"))
    occurring = item_grams.join(counts, "gram")
    rare = F.col("texts") <= max(RARE, documents // RARE_SHARE)
    stretch = ["item_id", F.floor(F.col("item_place") / STRETCH).alias("stretch")]
    rarest = occurring.groupBy(*stretch).agg(F.bool_or(rare).alias("has_rare"), F.min(F.struct("texts", "item_place", "gram")).alias("rarest"))
    instead = rarest.where("NOT has_rare").select("rarest.gram", "item_id", "rarest.item_place")
    return written(occurring.where(rare).select("gram", "item_id", "item_place").union(instead), "seeds")


def _candidates(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``key, items``: each different text with the items that share a seed, and where they would start by each."""
    items = written(_items(benchmark).withColumn("grams", _grams_of("text")), "items")
    item_grams = items.select("item_id", F.posexplode("grams").alias("item_place", "gram"))
    hits = _hits(docs, _filter(item_grams))
    seeds = choose_seeds(item_grams, hits, hits.count())
    pairs = hits.select("key", F.inline(F.arrays_zip("grams", "places"))).withColumnRenamed("grams", "gram")
    met = lookup_join(pairs, seeds, {"gram": "gram"}, how="inner", salts=1)
    starts = met.groupBy("key", "item_id").agg(F.collect_set(F.col("places") - F.col("item_place")).alias("starts"))
    named = lookup_join(starts, items.select("item_id", F.col("text").alias("item")), {"item_id": "item_id"}, how="inner", salts=1)
    return written(named.groupBy("key").agg(F.collect_list(F.struct("item_id", "item", "starts")).alias("items")), "candidates")


def best_alignment(item: np.ndarray, text: np.ndarray, starts: list[int]) -> tuple[float, int, int] | None:
    """The best score near the starts and where it lies in the text; null below the item's least score."""
    least, best = least_score(len(item)), (0.0, 0, 0)
    # A match scores MATCH and all else costs, so the words in common bound the score.
    if MATCH * np.isin(item, text).sum() < least:
        return None
    for lo, hi in _windows(starts, len(item), len(text)):
        if MATCH * common_words(item, text[lo:hi]) < max(least, best[0]):
            continue
        score, begin, end = align(item, text[lo:hi])
        if score > best[0]:
            best = score, lo + begin, lo + end
    return best if best[0] >= least else None


def leaks_of(text: str, items: list[dict]) -> list[dict]:
    """The items, given with their text and starts, that the text holds."""
    cut = [words_of(item["item"]) for item in items]
    number: dict[str, int] = {}
    numbered = [np.array([number.setdefault(w, len(number) + 1) for w in words], np.int64) for words in cut]
    words = np.array([number.get(w, 0) for w in words_of(text)], np.int64)
    out = []
    for item, own in zip(items, numbered):
        if found := best_alignment(own, words, list(item["starts"])):
            out.append({"item_id": item["item_id"], "score": found[0] / (MATCH * len(own)), "start_word": found[1], "end_word": found[2]})
    return sorted(out, key=lambda leak: leak["item_id"])


def _windows(starts: list[int], length: int, total: int) -> list[tuple[int, int]]:
    """Where an item may lie, from where its seeds say it starts: merged, with room for an insertion per word."""
    room = length + 4
    out: list[list[int]] = []
    for start in sorted(starts):
        lo, hi = max(0, start - room), min(total, start + length + room)
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [(lo, hi) for lo, hi in out]


def _leak_columns(docs: DataFrame, benchmark: DataFrame, columns: list[Column]) -> DataFrame:
    """The rows of the given columns that share a seed with an item, with their ``leaks``."""

    @F.pandas_udf(LEAKS)
    def leaks(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, items in parts:
            yield pd.Series([leaks_of(text, list(held)) for text, held in zip(texts, items)])

    small_batches(docs.sparkSession)
    rows = docs.select(*columns, _key().alias("_key"), whole_text().alias("_text"))
    met = lookup_join(rows, _candidates(docs, benchmark), {"_key": "key"}, how="inner", salts=1)
    return met.withColumn("leaks", leaks("_text", "items")).drop("_text", "items")


def leaked(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, score, start_word, end_word``: one row per document and benchmark item in it.

    ``score`` is the alignment score over the item's best possible one. Items of one word, null items and null
    or empty texts match nothing. Repeated documents give repeated rows; an empty benchmark gives none.
    """
    return _leak_columns(docs, benchmark, [F.col("doc_id")]).select("doc_id", F.inline("leaks"))


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows that hold no benchmark item, with all their columns."""
    found = _leak_columns(docs, benchmark, []).where(F.size("leaks") > 0).select("_key").distinct()
    mark, key = fresh(docs, "_leaks"), fresh(docs, "_text_key")
    marked = lookup_join(docs.withColumn(key, _key()), written(found.withColumn(mark, F.lit(True)), "leaks"), {key: "_key"}, salts=1)
    return marked.where(F.col(mark).isNull()).drop(mark, key)

"""Mixing sources to target weights: repetition rates per source, whole copies, one seeded coin.

Everything is a DataFrame expression. The documents are read twice, for their sizes and coins and
for the result; what is shuffled is one row per source, and one per source and seed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rideflow.llm.common import document_words, fresh, materialize, whole_text, written
from rideflow.operators.lookup import lookup_join

#: Weights of the sources in code point order, repeating.
WEIGHTS = (3, 1, 2)
#: Share of all sizes that the mix takes, and how often a document may be taken at most.
BUDGET, MOST_COPIES = 1.5, 2
SEED = "mix-1"
#: Sixteen to this power is the range of the coin; it fits a double exactly.
COIN_DIGITS = 13
_RANGE = 16**COIN_DIGITS
#: Seeds that are tried for each source; each turns all coins of a source by a part of their range.
SEEDS = 64
_TURN = _RANGE // SEEDS


def coin(key: Column, text: Column, seed: str = SEED) -> Column:
    """A whole number below the range that depends on key, text and seed only; null counts as empty."""
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in (key, text)]
    digest = F.md5(F.concat(F.lit(f"{seed}:"), parts[0], F.lit(":"), parts[1]).cast("binary"))
    return F.conv(F.substring(digest, 1, COIN_DIGITS), 16, 10).cast("long")


def _rate(target: Column, size: Column) -> Column:
    return F.when(size > 0, target / size).otherwise(0.0)


def _below(rate: Column) -> Column:
    """Coins below this take one copy more."""
    return F.ceil((rate - F.floor(rate)) * F.lit(float(_RANGE))).cast("long")


def _nearest_seeds(sizes: DataFrame, table: DataFrame) -> DataFrame:
    """The sources with ``turn``: which of the seeds brings the words taken nearest to the target; the first of equal ones.

    A seed adds its part of the range to all coins of the source. So the words a seed takes follow
    from the coins' sums by part of the range: whole parts below the source's limit, and what lies below it
    in the part with the limit. Per source that is one row for each part.
    """
    limits = table.select("lookup", _below(_rate(F.col("target"), F.col("source_size"))).alias("limit"))
    rows = lookup_join(sizes.select("label", "size", "coin"), limits, {"label": "lookup"})
    part, within = F.floor(F.col("coin") / _TURN), F.col("coin") % _TURN < F.col("limit") % _TURN
    parts = rows.groupBy("label", part.alias("part")).agg(F.sum("size").alias("all"), F.sum(F.when(within, F.col("size")).otherwise(0)).alias("low"))
    held = parts.groupBy("label").agg(F.collect_list(F.struct("part", "all", "low")).alias("parts"))
    both = table.join(held, F.col("lookup") == F.col("label"), "left")
    rate = _rate(F.col("target"), F.col("source_size"))
    whole, limit = F.floor(rate) * F.col("source_size"), F.floor(_below(rate) / _TURN)

    def taken(turn: Column) -> Column:
        def add(total: Column, p: Column) -> Column:
            place = (p["part"] + turn) % SEEDS
            return total + F.when(place < limit, p["all"]).when(place == limit, p["low"]).otherwise(0)

        return F.reduce(F.coalesce("parts", F.array().cast("array<struct<part: bigint, all: bigint, low: bigint>>")), F.lit(0).cast("long"), add)

    tried = F.transform(
        F.sequence(F.lit(0), F.lit(SEEDS - 1)), lambda turn: F.struct(F.abs((whole + taken(turn)).cast("double") - F.col("target")).alias("off"), turn.alias("turn"))
    )
    return both.select("lookup", "source_size", "target", F.array_min(tried)["turn"].alias("turn"))


def ranked(sources: DataFrame) -> DataFrame:
    """``rank`` from 0 in code point order, null last.

    The sources are sorted in ranges; a rank is the number of rows in the ranges before and the
    place within its own, so no task needs all of them.
    """
    parts = materialize(
        sources.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id())
    )
    place = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())) - 1
    before = parts.groupBy("part").agg(F.count(F.lit(1)).alias("rows"))
    before = before.select(
        "part", F.coalesce(F.sum("rows").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before")
    )
    return parts.withColumn("place", place).join(before, "part").withColumn("rank", F.col("before") + F.col("place")).drop("part", "place", "before")


def targets(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET, most: int = MOST_COPIES) -> DataFrame:
    """``source, source_size, target`` per source.

    A source gets its weight's part of the budget, but ``most`` times its size at most; the excess
    goes to the others by weight, again and again until none is above. Each round sums the table of
    sources into one row. Without documents the table is empty.
    """
    return _targets(docs.select("source", document_words(whole_text()).alias("size")), weights, budget, most)


def _targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET, most: int = MOST_COPIES) -> DataFrame:
    caps = ranked(sizes.groupBy("source").agg(F.sum("size").alias("source_size")))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    caps = materialize(caps.withColumns({"weight": weight, "cap": most * F.col("source_size")}))
    level, full_before = 0.0, -1
    while True:
        full = F.col("cap") < F.lit(level) * F.col("weight")
        found = caps.agg(
            F.sum("source_size").alias("total"),
            F.count_if(full).alias("full"),
            F.coalesce(F.sum(F.when(full, F.col("cap"))), F.lit(0)).alias("capped"),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)).alias("open"),
        ).first()
        if found["full"] == full_before or not found["open"]:
            break
        full_before = found["full"]
        level = (budget * found["total"] - found["capped"]) / found["open"]
    target = F.least(F.col("cap").cast("double"), F.lit(level) * F.col("weight"))
    return materialize(caps.select("source", "source_size", target.alias("target")))


def mixed(docs: DataFrame, key: str = "doc_id", seed: str = SEED, **how) -> DataFrame:
    """Every row with ``size``, ``source_size``, ``target`` and ``copies``, the times the mix emits it.

    ``copies`` is the whole part of target / source_size plus one with the probability of the rest,
    by a coin of key and text. All coins of a source are turned by the seed, of ``SEEDS``, that brings its
    words nearest to the target. Columns of these names in ``docs`` stay; the new ones then get a longer
    name. Texts that are null or empty have size 0; null is a source of its own; rows that repeat key and
    text fall alike; without rows the result is empty.
    """
    names = {n: fresh(docs, n) for n in ("size", "source_size", "target", "copies")}
    group, lookup, turn = fresh(docs, "_group"), fresh(docs, "_lookup"), fresh(docs, "_turn")
    # Null is a key like any other: a present source has the prefix "s".
    label = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit(""))
    tossed = coin(F.col(f"`{key}`"), F.col("text"), seed)
    sizes = written(docs.select("source", label.alias("label"), document_words(whole_text()).alias("size"), tossed.alias("coin")), "sizes")
    table = _targets(sizes, **how).select(label.alias("lookup"), "source_size", "target")
    table = written(_nearest_seeds(sizes, table), "seeds").select(
        F.col("lookup").alias(lookup), F.col("source_size").alias(names["source_size"]), F.col("target").alias(names["target"]), F.col("turn").alias(turn)
    )
    rows = docs.withColumns({group: label, names["size"]: document_words(whole_text())})
    joined = lookup_join(rows, table, {group: lookup}).drop(group)
    rate = _rate(F.col(f"`{names['target']}`"), F.col(f"`{names['source_size']}`"))
    turned = (tossed + F.col(turn) * F.lit(_TURN)) % F.lit(_RANGE)
    copies = F.floor(rate) + F.when(turned < _below(rate), 1).otherwise(0)
    return joined.withColumn(names["copies"], copies.cast("long")).drop(turn)


def emitted(docs: DataFrame, **how) -> DataFrame:
    """The mix itself: each document as often as taken, with ``copy`` from 1 up; other columns as they are."""
    rows = mixed(docs, **how)
    copies = rows.columns[-1]
    copy = fresh(docs, "copy")
    times = F.col(f"`{copies}`")
    out = rows.where(times > 0).withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), times)))
    return out.select(*[f"`{c}`" for c in docs.columns], f"`{copy}`")


def mix_report(docs: DataFrame, **how) -> DataFrame:
    """One row per document: its size, its source's size and target, and the words the mix takes of it."""
    rows = mixed(docs.select("doc_id", "text", "source"), **how)
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))

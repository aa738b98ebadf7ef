"""SimHash near-duplicates: fingerprints of word shingles, linked at a few differing bits.

The search is pigeonring filtering. With one segment more than bits may differ, laid out as a ring,
two fingerprints within the distance have a start from which the first segment is equal and the
first l segments differ in at most l - 1 bits, for every l. The join key is the first two segments
of each start, the second one with none or one of its bits flipped; longer chains and the whole
distance are checked in the join.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rideflow.llm.common import fresh, sized, small_batches, whole_text, written
from rideflow.llm.components import components

BITS, SHINGLE, SEED, DISTANCE = 64, 4, 42, 4
#: Hashes whose bits are spread out at a time; a text may have millions.
_CHUNK = 1 << 16


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The fingerprint as a signed 64-bit number.

    Lower case from A to Z, words between ASCII white space, shingles of so many words (all words
    if there are fewer; zero without a word). A bit is set if more than half of the hashes have it.
    """
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    hashed, join = xxhash.xxh64_intdigest, b" ".join
    count = max(1, len(words) - shingle + 1)
    set_bits = np.zeros(BITS, np.int64)
    for start in range(0, count, _CHUNK):
        part = range(start, min(count, start + _CHUNK))
        hashes = np.fromiter((hashed(join(words[i : i + shingle]), SEED) for i in part), np.uint64, len(part))
        set_bits += np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > count, bitorder="little").view("<i8")[0])


@F.pandas_udf(T.LongType())
def _fingerprints(texts: pd.Series) -> pd.Series:
    return texts.map(fingerprint).astype("int64")


def widths(distance: int = DISTANCE) -> list[int]:
    """Bits of each segment: one segment more than bits may differ."""
    parts = distance + 1
    return [BITS // parts + (i < BITS % parts) for i in range(parts)]


def _segments(value: Column, distance: int) -> list[Column]:
    out, shift = [], 0
    for width in widths(distance):
        out.append(F.shiftrightunsigned(value, shift).bitwiseAND(F.lit((1 << width) - 1)))
        shift += width
    return out


def _key(start: int, first: Column, second: Column, distance: int) -> Column:
    """One number for a start and its first two segments."""
    parts = widths(distance)
    width = parts[(start + 1) % len(parts)]
    room = parts[start] + width
    return F.lit(start << room if room < 60 else start).bitwiseOR(F.shiftleft(first, width).bitwiseOR(second))


def _chains_hold(difference: Column, start: Column, distance: int) -> Column:
    """Whether from the start the first l segments differ in at most l - 1 bits, for every l."""
    counts = [F.bit_count(s) for s in _segments(difference, distance)]
    n = len(counts)

    def holds(at: int) -> Column:
        total, ok = F.lit(0), F.lit(True)
        for length in range(1, n + 1):
            total = total + counts[(at + length - 1) % n]
            ok = ok & (total <= length - 1)
        return ok

    return reduce(lambda rest, at: F.when(start == at, holds(at)).otherwise(rest), range(n), F.lit(False))


def _indexed(nodes: DataFrame, distance: int) -> DataFrame:
    """One row per start: ``start, key`` of the first two segments as they are."""
    parts, n = _segments(F.col("print"), distance), distance + 1
    rows = [F.struct(F.lit(s).alias("start"), _key(s, parts[s], parts[(s + 1) % n], distance).alias("key")) for s in range(n)]
    return nodes.select("*", F.inline(F.array(*rows)))


def _probes(nodes: DataFrame, distance: int) -> DataFrame:
    """The keys at which a partner may stand: the second segment as it is, or with one bit flipped."""
    parts, n, bits = _segments(F.col("print"), distance), distance + 1, widths(distance)

    def at(start: int) -> Column:
        second = (start + 1) % n
        flips = F.array(F.lit(0).cast("long"), *[F.lit(1 << b).cast("long") for b in range(bits[second])])
        return F.transform(flips, lambda flip: F.struct(
            F.lit(start).alias("start"), _key(start, parts[start], parts[second].bitwiseXOR(flip), distance).alias("key")))

    rows = [at(start) for start in range(n)]
    return nodes.select("*", F.inline(F.concat(*rows)))


def _near(left: str, right: str, distance: int) -> Column:
    return F.bit_count(F.col(left).bitwiseXOR(F.col(right))) <= distance


def _star_links(nodes: DataFrame, distance: int) -> DataFrame:
    """Links along each bucket: to its commonest fingerprint and to the two before it in order.

    A bucket gives at most three links per fingerprint, so a large group of near copies is mostly
    joined before any pairs are formed.
    """
    rows = _indexed(nodes, distance)
    bucket = Window.partitionBy("key")
    along = bucket.orderBy("print")
    rows = rows.withColumns({
        "common": F.max(F.struct("copies", "print")).over(bucket)["print"],
        "one": F.lag("print", 1).over(along),
        "two": F.lag("print", 2).over(along),
    })
    to = F.explode(F.array_compact(F.array(*[
        F.when((F.col(c) != F.col("print")) & _near("print", c, distance), F.col(c)) for c in ("common", "one", "two")
    ])))
    return rows.select(F.col("print").alias("a"), to.alias("b"))


def _lookup(rows: DataFrame, table: DataFrame, column: str) -> DataFrame:
    """Replace ``column`` by its component where the table has one."""
    named = table.withColumnsRenamed({"node": column, "component": "_component"})
    return rows.join(named, column, "left").withColumn(column, F.coalesce("_component", column)).drop("_component")


def print_components(nodes: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``print, component`` for the distinct fingerprints of ``nodes(print, copies)``.

    Stars along the buckets come first. Then all fingerprints look for partners of another
    component; only such links are formed, and they are all that is missing.
    """
    rows = nodes.count()
    first = written(sized(components(_star_links(nodes, distance)), rows), "stars")
    grouped = written(sized(_lookup(nodes.select("print", F.col("print").alias("group")), first, "group"), rows), "groups")
    table = _indexed(grouped, distance).select("key", F.col("print").alias("there"), F.col("group").alias("b"))
    asked = _probes(grouped, distance).select("key", "start", F.col("print").alias("here"), F.col("group").alias("a"))
    difference = F.col("here").bitwiseXOR(F.col("there"))
    condition = (
        (F.col("a") != F.col("b"))
        & (F.col("here") < F.col("there"))
        & (F.bit_count(difference) <= distance)
        & _chains_hold(difference, F.col("start"), distance)
    )
    found = asked.join(table.hint("shuffle_hash"), "key").where(condition)
    second = written(sized(components(found.select("a", "b")), rows), "joined")
    return _lookup(grouped, second, "group").select("print", F.col("group").alias("component"))


def fingerprinted(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """``key, text_hash, print`` of every row, computed once and kept as a narrow table."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.xxhash64("text").alias("text_hash"), _fingerprints(whole_text()).alias("print"))
    return written(rows, "prints")


def near_groups(docs: DataFrame, key: str = "doc_id", distance: int = DISTANCE) -> DataFrame:
    """``key, text_hash, print, group, component`` of every row; ``component`` is the smallest key reachable.

    ``group`` is the smallest fingerprint reachable.
    Texts without words have fingerprint zero and link like any other. Null keys count as larger
    than all others: a component of null keys only is null. Repeated rows share a component.
    """
    prints = fingerprinted(docs, key)
    rows = prints.count()  # at most so many distinct fingerprints
    nodes = written(sized(prints.groupBy("print").agg(F.count(F.lit(1)).alias("copies"), F.min("key").alias("least")), rows), "nodes")
    groups = print_components(nodes.select("print", "copies"), distance).withColumnRenamed("component", "group")
    groups = written(sized(groups.join(nodes.select("print", "least"), "print"), rows), "print-groups")
    least = written(sized(groups.groupBy("group").agg(F.min("least").alias("component")), rows), "least-keys")
    named = written(sized(groups.drop("least").join(least, "group"), rows), "named")
    return prints.join(named, "print").select("key", "text_hash", "print", "group", "component")


def deduplicated(docs: DataFrame, key: str = "doc_id", distance: int = DISTANCE) -> DataFrame:
    """One row of each group of near-duplicates, with the columns of ``docs``.

    The row with the group's smallest key stays; of several rows with that key the one of the
    smallest text hash, and one of equal rows. Null keys come after all others.
    """
    groups = near_groups(docs, key, distance)
    place = F.struct(F.col("key").isNull().alias("none"), F.col("key").alias("key"), F.col("text_hash").alias("text_hash"))
    kept = groups.groupBy("group").agg(F.min(place).alias("kept"))
    chosen = written(kept.select("kept.key", "kept.text_hash").distinct(), "kept")
    mark, same = fresh(docs, "_text_hash"), fresh(docs, "_row")
    rows = docs.withColumn(mark, F.xxhash64("text"))
    there = rows[f"`{key}`"].eqNullSafe(chosen["key"]) & rows[f"`{mark}`"].eqNullSafe(chosen["text_hash"])
    stay = rows.join(chosen, there, "left_semi")
    once = Window.partitionBy(f"`{key}`", f"`{mark}`").orderBy(F.lit(0))
    return stay.withColumn(same, F.row_number().over(once)).where(F.col(same) == 1).drop(same, mark)


def simhash_report(docs: DataFrame) -> DataFrame:
    """One row per document: its fingerprint in hex and its component."""
    rows = near_groups(docs.select("doc_id", "text"))
    return rows.select(F.col("key").alias("doc_id"), F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))

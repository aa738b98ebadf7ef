"""Joins of a large frame with a keyed lookup table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_BROADCAST_ROWS = 200_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024
SALTS = 16
_FIXED_WIDTH = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _row_bytes(lookup: DataFrame) -> Column:
    """Eight bytes per column, and the text length of columns without a fixed width."""
    width = F.lit(8 * len(lookup.columns))
    for field in lookup.schema.fields:
        if not isinstance(field.dataType, _FIXED_WIDTH):
            text = F.col(f"`{field.name}`").cast("string")
            width = width + F.coalesce(F.octet_length(text), F.lit(0))
    return width


def fits_broadcast(
    lookup: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES
) -> bool:
    """Whether the lookup has at most so many rows and bytes; reads no further than one row more."""
    size = lookup.limit(max_rows + 1).agg(F.count(F.lit(1)).alias("rows"), F.sum(_row_bytes(lookup)).alias("bytes"))
    found = size.first()
    return found["rows"] <= max_rows and (found["bytes"] or 0) <= max_bytes


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    keys: Mapping[str, str],
    how: str = "left",
    max_rows: int = MAX_BROADCAST_ROWS,
    salts: int = SALTS,
) -> DataFrame:
    """Join ``rows`` to ``lookup`` on ``{row column: lookup column}``; the lookup's keys are dropped.

    A lookup of checked size is broadcast. A larger one is shuffled, with the rows of each key
    spread over ``salts`` reducers and the lookup repeated once per salt, so that no key makes
    one task hold all its rows. The salt depends on the row and its partition only, so a
    recomputed task gives the same salts.

    The lookup is read once more for the check: give a table, or materialize what is computed.
    """
    renamed = {lookup_key: f"_key_{i}" for i, lookup_key in enumerate(keys.values())}
    right = lookup.withColumnsRenamed(renamed)
    pairs = [(row_key, renamed[lookup_key]) for row_key, lookup_key in keys.items()]
    drops = list(renamed.values())

    if fits_broadcast(lookup, max_rows):
        left, right = rows, F.broadcast(right)
    elif salts > 1:
        spread = F.pmod(F.xxhash64(*rows.columns) + F.spark_partition_id(), F.lit(salts))
        left = rows.withColumn("_salt_left", spread.cast("int"))
        right = right.withColumn("_salt_right", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        pairs.append(("_salt_left", "_salt_right"))
        drops += ["_salt_left", "_salt_right"]
    else:
        left = rows

    condition = None
    for row_key, lookup_key in pairs:
        equal = left[row_key] == right[lookup_key]
        condition = equal if condition is None else condition & equal
    return left.join(right, condition, how).drop(*drops)

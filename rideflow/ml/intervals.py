"""Ranges around predictions: quantile sketches of residuals by group, and split-conformal bounds from them.

A sketch is a row of a table: groups of many rows and of few are each of bounded size, sketches of any
groups merge into those of coarser ones, and new trips are merged without reading old ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rideflow.operators.lookup import lookup_join

#: Size of a sketch. Up to so many residuals it holds all of them.
SKETCH_SIZE = 16_384
#: A group is used from so many residuals; below, the next coarser one is.
LEAST_ROWS = 100
COVERAGE = 0.9


def rank_error(size: int = SKETCH_SIZE) -> float:
    """By how much of all rows a sketch may misplace a value, in 99 of 100 cases; the rate its library states."""
    return 2.296 / size**0.9021


def residual_sketches(
    scored: DataFrame, label: str, prediction: str, keys: Sequence[str] = (), size: int = SKETCH_SIZE
) -> DataFrame:
    """``keys, rows, sketch``: label less prediction by group; rows without either are left out."""
    residual = (F.col(label) - F.col(prediction)).cast("double")
    return scored.filter(residual.isNotNull()).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"), F.kll_sketch_agg_double(residual, size).alias("sketch")
    )


def merged(sketches: DataFrame, keys: Sequence[str] = (), size: int = SKETCH_SIZE) -> DataFrame:
    """The sketches of coarser groups, or of tables of sketches put together."""
    return sketches.groupBy(*keys).agg(F.sum("rows").alias("rows"), F.kll_merge_agg_double("sketch", size).alias("sketch"))


#: Ranks at which a sketch is read, as parts of 1; what lies between is taken from the next one outward.
GRID = 4000


def _value(place: Column) -> Column:
    """The residual at a place of the grid; a sketch is read at fixed ranks only."""
    values = F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit(i / GRID) for i in range(GRID + 1)]))
    return F.element_at(values, F.least(F.greatest(place, F.lit(0)), F.lit(GRID)).cast("int") + 1)


def bounds(sketches: DataFrame, coverage: float = COVERAGE, size: int = SKETCH_SIZE) -> DataFrame:
    """``low`` and ``high``, which a new residual of the group stays between with the given probability at least.

    Of n exchangeable residuals those of rank floor((n + 1) a / 2) and ceil((n + 1) (1 - a / 2)); the
    extreme ones where there are too few. Where a sketch has more rows than it holds, the ranks move outward by its error.
    """
    miss = (1.0 - coverage) / 2
    more = F.col("rows") + 1
    first, last = F.greatest(F.floor(more * miss), F.lit(1)), F.least(F.ceil(more * (1.0 - miss)), F.col("rows"))
    error = F.when(F.col("rows") > size, F.lit(rank_error(size))).otherwise(0.0)
    rank = lambda place: (place - 0.5) / F.col("rows")
    return sketches.withColumns({
        "low": _value(F.floor((rank(first) - error) * GRID)), "high": _value(F.ceil((rank(last) + error) * GRID)),
    })


def with_range(
    rows: DataFrame,
    prediction: str,
    sketches: DataFrame,
    levels: Sequence[Sequence[str]],
    coverage: float = COVERAGE,
    least_rows: int = LEAST_ROWS,
    floor: float | None = None,
) -> DataFrame:
    """Rows with ``low``, ``high`` and ``level``, the range around the prediction.

    ``levels`` are groups from the finest to the coarsest, each a part of the sketches' keys; a row takes
    the first that has enough residuals, and no range if none has. ``floor`` is the least value that a
    label can have. Groups of null keys hold for no row; of each level only the groups with enough rows are joined.
    """
    found, out = [], rows
    for number, keys in enumerate(levels):
        table = bounds(merged(sketches, keys), coverage).filter(F.col("rows") >= least_rows)
        bound = F.struct("low", "high", F.lit(number).alias("level")).alias(f"_range_{number}")
        if not keys:
            one = table.select("low", "high").first()
            bound = F.struct(F.lit(one.low).alias("low"), F.lit(one.high).alias("high"), F.lit(number).alias("level")) if one else F.lit(None)
            out = out.withColumn(f"_range_{number}", bound.cast("struct<low: double, high: double, level: int>"))
        else:
            out = lookup_join(out, table.select(*keys, bound), {key: key for key in keys}, salts=1)
        found.append(f"_range_{number}")
    best, guess = F.coalesce(*found), F.col(prediction)
    low = guess + best["low"]
    low = low if floor is None else F.when(low.isNotNull(), F.greatest(low, F.lit(float(floor))))
    return out.withColumns({"low": low, "high": guess + best["high"], "level": best["level"]}).drop(*found)


def range_coverage(ranged: DataFrame, label: str, by: Sequence[str] = ()) -> DataFrame:
    """How many labels lie in their range, and the mean width."""
    inside = F.col(label).between(F.col("low"), F.col("high"))
    return ranged.filter(F.col("low").isNotNull() & F.col(label).isNotNull()).groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(inside).alias("inside"), F.avg(F.col("high") - F.col("low")).alias("mean_width")
    )

"""Data-quality rules with per-rule removal counts.

A row counts against the first rule it fails. One CASE column finds that rule, so all counts
come from one pass; the clean rows use the plain conjunction, which reaches the Parquet scan.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rideflow import schemas
from rideflow.functions.columns import speed_mph, trip_seconds

TRIP_COLUMNS = schemas.TRIP.fieldNames()
FIRST_YEAR, LAST_YEAR = 2022, 2024
INITIAL, DUPLICATES, FINAL = "00_initial_count", "13_duplicates_removed", "99_final_clean_count"


@dataclass(frozen=True)
class Period:
    """Accepted pickup dates: one month, the month of the file, or the default range of years."""

    year: int = 0
    month: int = 0
    from_file: bool = False

    def holds(self) -> Column:
        """A range of times where the bounds are known, so that it reaches the scan."""
        pickup = F.col("pickup_ts")
        if self.from_file:
            return (F.year(pickup) == F.col("file_year")) & (F.month(pickup) == F.col("file_month"))
        if self.year > 0 and self.month > 0:
            first, after = date(self.year, self.month, 1), date(self.year + self.month // 12, self.month % 12 + 1, 1)
        else:
            first, after = date(FIRST_YEAR, 1, 1), date(LAST_YEAR + 1, 1, 1)
        return (pickup >= F.lit(str(first)).cast("timestamp")) & (pickup < F.lit(str(after)).cast("timestamp"))


ALL_YEARS = Period()
FILE_MONTH = Period(from_file=True)


@dataclass(frozen=True)
class Rule:
    key: str
    title: str
    reason: str
    keep: Callable[[Period], Column]


def _keys_present(_: Period) -> Column:
    keys = ("pickup_ts", "dropoff_ts", "pu_location_id", "do_location_id")
    return reduce(lambda a, b: a & b, (F.col(key).isNotNull() for key in keys))


def _zones_valid(_: Period) -> Column:
    return F.col("pu_location_id").between(1, 263) & F.col("do_location_id").between(1, 263)


RULES = (
    Rule("01_null_keys_removed", "Missing keys", "a pickup or dropoff time or zone is absent", _keys_present),
    Rule("02_invalid_zones_removed", "Zone out of range", "a zone id is not between 1 and 263", _zones_valid),
    Rule("03_non_positive_fare_removed", "Fare not positive", "void, refund or test entry",
         lambda _: F.col("fare_amount") > 0.0),
    Rule("04_absurd_fare_removed", "Fare too high", "more than 1000 dollars",
         lambda _: F.col("fare_amount") <= 1000.0),
    Rule("05_non_positive_distance_removed", "Distance not positive", "the vehicle did not move",
         lambda _: F.col("trip_distance_mi") > 0.0),
    Rule("06_absurd_distance_removed", "Distance too long", "more than 200 miles",
         lambda _: F.col("trip_distance_mi") <= 200.0),
    Rule("07_time_inversion_removed", "Times inverted", "dropoff not after pickup",
         lambda _: F.col("dropoff_ts") > F.col("pickup_ts")),
    Rule("08_duration_anomalies_removed", "Duration out of range", "under 60 seconds or over 6 hours",
         lambda _: trip_seconds().between(60, 21600)),
    Rule("10_impossible_speed_removed", "Speed out of range", "under 0.5 or over 90 miles per hour",
         lambda _: speed_mph().between(0.5, 90.0)),
    Rule("11_out_of_period_removed", "Outside the period", "pickup date not in the accepted period",
         lambda period: period.holds()),
    Rule("12_passenger_anomalies_removed", "Passenger count", "known and not between 1 and 8",
         lambda _: F.col("passenger_count").isNull() | F.col("passenger_count").between(1, 8)),
)
COUNTERS = (INITIAL, *(rule.key for rule in RULES), DUPLICATES, FINAL)


def first_failed_rule(period: Period = ALL_YEARS) -> Column:
    """Key of the first rule a row fails, NULL if it passes all; an unknown outcome is a failure."""
    verdict = F.lit(None).cast("string")
    for rule in reversed(RULES):
        verdict = F.when(rule.keep(period), verdict).otherwise(rule.key)
    return verdict


def passing(trips: DataFrame, period: Period = ALL_YEARS) -> DataFrame:
    """Rows that pass every row rule."""
    return trips.filter(reduce(lambda a, b: a & b, (rule.keep(period) for rule in RULES)))


def clean_trips(trips: DataFrame, period: Period = ALL_YEARS) -> DataFrame:
    """Rows that pass every rule, one of each set of equal rows.

    The grouping is by all columns and combines on the map side, so a large set of copies
    reaches its reducer as one row per task.
    """
    return passing(trips, period).select(*TRIP_COLUMNS).dropDuplicates()


def rule_totals(trips: DataFrame, period: Period = ALL_YEARS) -> DataFrame:
    """All counters as one wide row, from one pass over the input.

    The trip columns are blanked on failing rows, so those collapse to one group per rule while
    the passing rows group by value; the group count and the row count give the duplicates.
    """
    failed = F.col("_failed")
    grouped = (
        trips.withColumn("_failed", first_failed_rule(period))
        .select("_failed", *(F.when(failed.isNull(), F.col(c)).alias(c) for c in TRIP_COLUMNS))
        .groupBy("_failed", *TRIP_COLUMNS)
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    rows = F.col("_rows")
    counters = [_total(rows, F.lit(True)).alias(INITIAL)]
    counters += [_total(rows, failed == rule.key).alias(rule.key) for rule in RULES]
    counters += [
        _total(rows - 1, failed.isNull()).alias(DUPLICATES),
        F.count_if(failed.isNull()).alias(FINAL),
    ]
    return grouped.agg(*counters)


def row_rule_counts(trips: DataFrame, period: Period = ALL_YEARS) -> DataFrame:
    """One wide row: initial rows, rows each rule removes, ``_passing`` rows and their ``_months`` (year * 100 + month).

    One pass over the input without a shuffle of its rows; the months are as many as the period holds.
    """
    failed = F.col("_failed")
    month = F.year("pickup_ts") * 100 + F.month("pickup_ts")
    return trips.select(first_failed_rule(period).alias("_failed"), month.alias("_month")).agg(
        F.count(F.lit(1)).alias(INITIAL),
        *(F.count_if(failed == rule.key).alias(rule.key) for rule in RULES),
        F.count_if(failed.isNull()).alias("_passing"),
        F.collect_set(F.when(failed.isNull(), F.col("_month"))).alias("_months"),
    )


def final_totals(counts: DataFrame, final_rows: DataFrame) -> DataFrame:
    """All counters as one wide row from the counts of the input and the clean rows as written.

    The row count of a written table comes from its file footers, so the duplicates follow without
    grouping the input again.
    """
    final = final_rows.agg(F.count(F.lit(1))).scalar()
    return counts.select(
        INITIAL,
        *(rule.key for rule in RULES),
        (F.col("_passing") - final).alias(DUPLICATES),
        final.alias(FINAL),
    )


def row_rule_totals(trips: DataFrame, final_rows: DataFrame, period: Period = ALL_YEARS) -> DataFrame:
    """All counters as one wide row when the clean rows are already written."""
    return final_totals(row_rule_counts(trips, period), final_rows)


def _total(rows: Column, condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, rows)), F.lit(0)).cast("bigint")


def counter_rows(totals: DataFrame) -> DataFrame:
    """The wide row of counters as ``(rule, rows)``."""
    return totals.unpivot([], list(COUNTERS), "rule", "rows")


def unknown_zone_counts(trips: DataFrame) -> DataFrame:
    """Trips that use zone 264 or 265, which stand for unknown and outside the city."""
    pickup = F.col("pu_location_id").isin(264, 265)
    dropoff = F.col("do_location_id").isin(264, 265)
    return trips.agg(
        F.count_if(pickup).alias("unknown_pickup"),
        F.count_if(dropoff).alias("unknown_dropoff"),
        F.count_if(pickup & dropoff).alias("unknown_both"),
        F.count(F.lit(1)).alias("trips"),
    )

"""Target encoding of zones."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rideflow.operators.lookup import lookup_join
from rideflow.session import materialize

TARGETS = {"fare_mean": "fare_amount", "eta_mean": "trip_duration_min"}
ENCODED = ("pu_fare_mean", "do_fare_mean", "pu_eta_mean", "do_eta_mean")


@dataclass(frozen=True)
class ZoneMeans:
    """Mean targets by pickup zone, by dropoff zone, and over all rows (one row)."""

    pickup: DataFrame
    dropoff: DataFrame
    overall: DataFrame


def zone_means(train: DataFrame) -> ZoneMeans:
    """All three levels from one scan of the training rows.

    The grouping sets hold one row per zone and side; they are computed once and kept.
    """
    pu, do = F.col("pu_location_id"), F.col("do_location_id")
    grouped = train.groupingSets([[pu], [do], []], pu, do).agg(
        F.grouping_id().alias("level"),
        F.count(F.lit(1)).alias("rows"),
        *(F.avg(target).alias(name) for name, target in TARGETS.items()),
        *(F.sum(target).alias(f"{name}_total") for name, target in TARGETS.items()),
    )
    means = materialize(grouped)

    def side(level: int, prefix: str) -> DataFrame:
        return means.filter(F.col("level") == level).select(
            F.col(f"{prefix}_location_id").alias("zone_id"),
            F.col("rows").alias(f"_{prefix}_rows"),
            *(F.col(name).alias(f"{prefix}_{name}") for name in TARGETS),
            *(F.col(f"{name}_total").alias(f"_{prefix}_{name}_total") for name in TARGETS),
        )

    return ZoneMeans(side(1, "pu"), side(2, "do"), means.filter(F.col("level") == 3).select(*TARGETS))


def encode_zones(rows: DataFrame, means: ZoneMeans, leave_one_out: bool = False) -> DataFrame:
    """Add the four zone means; zones without training rows get the overall mean.

    ``leave_one_out`` is for the training rows themselves: each row's own target is taken out
    of its means.
    """
    rows = lookup_join(rows, means.pickup, {"pu_location_id": "zone_id"})
    rows = lookup_join(rows, means.dropoff, {"do_location_id": "zone_id"})
    encoded = {}
    for prefix in ("pu", "do"):
        for name, target in TARGETS.items():
            mean: Column = F.col(f"{prefix}_{name}")
            if leave_one_out:
                count, total = F.col(f"_{prefix}_rows"), F.col(f"_{prefix}_{name}_total")
                mean = F.try_divide(total - F.col(target), count - 1)
            # A NaN mean is replaced too.
            known = F.when(~F.isnan(mean), mean)
            encoded[f"{prefix}_{name}"] = F.coalesce(known, means.overall.select(name).scalar())
    helpers = [c for c in rows.columns if c.startswith(("_pu_", "_do_"))]
    return rows.withColumns(encoded).drop(*helpers)

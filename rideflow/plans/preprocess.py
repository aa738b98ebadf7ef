"""Raw feeds to processed trips and the quality report."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rideflow.operators.clean import ALL_YEARS, FILE_MONTH, Period, clean_trips, final_totals, row_rule_counts
from rideflow.operators.enrich import hourly_weather, join_weather, join_zones
from rideflow.operators.features import add_trip_features
from rideflow.operators.quality import quality_report, report_lines
from rideflow.session import bound_tasks, materialize, pin_time_zone
from rideflow.sinks.tables import TRIP_PARTITIONS, balance, drop_month, write_partitioned, write_report, write_report_table
from rideflow.sources.ingest import Refreshed, read_listed, refresh
from rideflow.sources.reference import read_weather, read_zones
from rideflow.sources.trips import read_feeds, read_processed


@dataclass(frozen=True)
class Preprocessed:
    trips: DataFrame
    totals: DataFrame
    skipped: DataFrame


def processed_trips(trips: DataFrame, zones: DataFrame, hourly: DataFrame, period: Period = ALL_YEARS) -> DataFrame:
    """Clean, enrich and derive; rows come balanced by month, ready to be written.

    The balancing shuffle sits on the ten narrow trip columns, before the joins widen them.
    """
    months = {"pickup_year": F.year("pickup_ts"), "pickup_month": F.month("pickup_ts")}
    cleaned = balance(clean_trips(trips, period).withColumns(months), TRIP_PARTITIONS).drop(*TRIP_PARTITIONS)
    return add_trip_features(join_weather(join_zones(cleaned, zones), hourly))


def build_trips(
    spark: SparkSession,
    feeds_path: str,
    zones_path: str,
    weather_path: str,
    out_path: str,
    report_path: str | None = None,
    period: Period = ALL_YEARS,
    dynamic: bool = False,
    **read_options,
) -> Preprocessed:
    """The whole batch job. The raw feeds are evaluated twice: for the write and for the counters.

    ``dynamic`` replaces only the months that get rows and leaves the others of the table; the final
    count is then that of these months. The counters are computed once. With a report path, what was
    not read is written beside the report.
    """
    bound_tasks(pin_time_zone(spark))
    feeds = read_feeds(spark, feeds_path, with_file_month=period.from_file, **read_options)
    zones = read_zones(spark, zones_path)
    hourly = hourly_weather(read_weather(spark, weather_path))
    counts = materialize(row_rule_counts(feeds.trips, period))
    write_partitioned(processed_trips(feeds.trips, zones, hourly, period), out_path, dynamic=dynamic)
    written = read_processed(spark, out_path)
    months = counts.first()["_months"]
    now = written.filter((F.col("pickup_year") * 100 + F.col("pickup_month")).isin(months)) if dynamic else written
    totals = materialize(final_totals(counts, now))
    if report_path:
        write_report(report_lines(totals), f"{report_path}/text")
        write_report_table(quality_report(totals), f"{report_path}/table")
        write_report_table(feeds.skipped, f"{report_path}/skipped")
    return Preprocessed(written, totals, feeds.skipped)


def update_trips(spark: SparkSession, feeds_path: str, zones_path: str, weather_path: str, out_path: str, ingest_path: str) -> Refreshed:
    """Bring the processed trips up to date with the lake: only months whose files changed are read and replaced.

    Trips count for the month of their file, so a month depends on its own files alone. A month that has no
    trips any more loses its folder. The ingest table is written first, so a run that fails after that is
    repeated with ``build_trips``.
    """
    bound_tasks(pin_time_zone(spark))
    done = refresh(spark, feeds_path, ingest_path)
    touched = done.months.filter("change != 'same'").select("year", "month").distinct().collect()
    if not touched:
        return done
    # All services of a month share its folder of trips.
    wanted = (F.col("year") * 100 + F.col("month")).isin([r.year * 100 + r.month for r in touched])
    feeds = read_listed(spark, done.files.filter(wanted))
    zones, hourly = read_zones(spark, zones_path), hourly_weather(read_weather(spark, weather_path))
    trips = materialize(processed_trips(feeds, zones, hourly, FILE_MONTH))
    write_partitioned(trips, out_path, dynamic=True)
    filled = {(r.pickup_year, r.pickup_month) for r in trips.select(*TRIP_PARTITIONS).distinct().collect()}
    for r in touched:
        if (r.year, r.month) not in filled:
            drop_month(spark, out_path, r.year, r.month)
    return done

"""What the physical plans must look like: pushed filters, pruned columns, few shuffles."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from rideflow.operators import clean, demand
from rideflow.operators.analysis import trips_by_borough
from rideflow.operators.enrich import hourly_weather, join_pickup_zone
from rideflow.operators.splits import time_split
from rideflow.plans.preprocess import build_trips, processed_trips
from rideflow.sinks.tables import TRIP_PARTITIONS, write_partitioned
from rideflow.sources.trips import read_processed, read_service
from workload import fixtures as fx


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def scan_details(df) -> str:
    """The plan in its long form, where pushed filters are written out."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.maxMetadataStringLength", 5000)
    try:
        fresh = df.select("*")
        return fresh._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")


@pytest.fixture(scope="module")
def feed(spark, sf_dir, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("feed"))
    raw = fx.raw_feed(spark, sf_dir, "yellow").withColumn("extra", F.lit("unused"))
    raw.write.parquet(f"{base}/year=2023/month=01")
    return read_service(spark, base, "yellow").trips


def test_rules_reach_the_scan(feed):
    text = scan_details(clean.passing(feed))
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", text).group(1)
    for part in (
        "GreaterThan(fare_amount,0.0)",
        "LessThanOrEqual(fare_amount,1000.0)",
        "GreaterThanOrEqual(PULocationID,1)",
        "LessThanOrEqual(trip_distance,200.0)",
        "IsNotNull(tpep_pickup_datetime)",
    ):
        assert part in pushed, part
    assert "GreaterThanOrEqual(tpep_pickup_datetime,2022-01-01" in pushed
    assert "extra" not in text


def test_counting_rules_reads_no_money_but_the_fare(feed, spark):
    text = scan_details(feed.select(clean.first_failed_rule().alias("failed")).groupBy("failed").count())
    assert "fare_amount" in text and "tip_amount" not in text and "total_amount" not in text


def test_cleaning_combines_before_its_only_shuffle(feed):
    text = plan(clean.clean_trips(feed))
    assert text.count("Exchange hashpartitioning") == 1
    before = text[text.index("Exchange hashpartitioning"):]
    assert "HashAggregate" in before and "SortAggregate" not in text


def test_preprocessing_shuffles_twice_and_broadcasts_the_lookups(spark, sf_dir, feed):
    hourly = hourly_weather(fx.weather_documents(spark, sf_dir))
    text = plan(processed_trips(feed, fx.zones(spark, sf_dir), hourly))
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 2
    assert "REBALANCE_PARTITIONS_BY_COL" in text
    assert text.count("BroadcastHashJoin") == 3 and "SortMergeJoin" not in text and "CartesianProduct" not in text
    # The balancing shuffle is below the joins, where the rows are narrow.
    assert text.index("BroadcastHashJoin") < text.index("REBALANCE_PARTITIONS_BY_COL")


def test_months_are_pruned_on_read(spark, tmp_path, sf_dir):
    trips = fx.trips(spark, sf_dir).filter("pickup_ts IS NOT NULL").select(
        "pickup_ts", "fare_amount", F.year("pickup_ts").alias("pickup_year"), F.month("pickup_ts").alias("pickup_month")
    )
    write_partitioned(trips, str(tmp_path / "trips"))
    text = scan_details(read_processed(spark, str(tmp_path / "trips")).filter("pickup_year = 2023 AND pickup_month = 5").select("fare_amount"))
    filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", text).group(1)
    assert "pickup_year" in filters and "pickup_month" in filters
    assert "ReadSchema: struct<fare_amount:double>" in text


def test_parts_of_a_time_split_are_ranges_and_prune_months(spark, tmp_path, sf_dir):
    trips = fx.trips(spark, sf_dir).filter("pickup_ts IS NOT NULL").select(
        "pickup_ts", "fare_amount", F.year("pickup_ts").alias("pickup_year"), F.month("pickup_ts").alias("pickup_month")
    )
    write_partitioned(trips, str(tmp_path / "trips"))
    table = read_processed(spark, str(tmp_path / "trips"))
    _, validation, test = time_split(table, month_columns=TRIP_PARTITIONS)
    text = scan_details(validation)
    assert "GreaterThanOrEqual(pickup_ts,2024-01-01" in text and "LessThan(pickup_ts,2024-07-01" in text
    pruned = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", text).group(1)
    assert "pickup_year" in pruned and "pickup_month" in pruned
    months = {tuple(r) for r in test.select("pickup_year", "pickup_month").distinct().collect()}
    assert months and all((y, m) >= (2024, 7) for y, m in months)


def test_counters_of_the_batch_job_are_finished(spark, sf_dir, tmp_path):
    reference, raw = fx.reference_folder(spark, sf_dir), tmp_path / "raw"
    for service in ("yellow", "green"):
        fx.raw_feed(spark, sf_dir, service).limit(200).write.parquet(str(raw / service / "year=2024" / "month=1"))
    done = build_trips(spark, str(raw), f"{reference}/zones", f"{reference}/weather", str(tmp_path / "trips"), str(tmp_path / "report"))
    assert "Scan parquet" not in plan(done.totals) and "FileScan" not in plan(done.totals)
    before = {tuple(r) for r in done.trips.groupBy("pickup_year", "pickup_month").count().collect()}
    again = build_trips(spark, str(raw), f"{reference}/zones", f"{reference}/weather", str(tmp_path / "trips"), period=clean.Period(2024, 1), dynamic=True)
    assert {tuple(r) for r in again.trips.groupBy("pickup_year", "pickup_month").count().collect()} == before
    january = {n for y, m, n in before if (y, m) == (2024, 1)} or {0}
    assert again.totals.select(clean.FINAL).first()[0] in january
    assert spark.read.parquet(str(tmp_path / "report" / "skipped")).isEmpty()


def test_history_windows_are_cut_into_blocks(spark, sf_dir):
    text = plan(demand.add_history(demand.hourly_counts(fx.trips(spark, sf_dir))))
    assert re.search(r"Exchange hashpartitioning\(zone_id#\d+L, _block#\d+L", text)
    assert text.count("Window [") == 1


def test_report_by_borough_needs_no_second_large_shuffle(spark, sf_dir, feed):
    text = plan(trips_by_borough(join_pickup_zone(clean.clean_trips(feed), fx.zones(spark, sf_dir))))
    assert text.count("Exchange hashpartitioning") == 2 and "BroadcastHashJoin" in text
    # Both aggregations combine first: four aggregates for two exchanges.
    assert text.count("HashAggregate") == 4


def test_no_query_module_uses_a_cross_join():
    from pathlib import Path

    root = Path(__file__).resolve().parent.parent
    for path in [*root.glob("rideflow/**/*.py"), *root.glob("workload/*.py")]:
        text = path.read_text()
        assert "crossJoin" not in text and "localCheckpoint" not in text, path

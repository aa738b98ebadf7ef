from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from rideflow import schemas
from rideflow.operators.unify import FEEDS, unify, union_trips
from rideflow.sinks.tables import write_report
from rideflow.sources.manifest import ingest_manifest, stage_by_month
from rideflow.sources.reference import read_zones, read_zones_or_none
from rideflow.sources.trips import NO_MONTH, NOT_ASKED, month_folders, read_feeds, read_service
from workload import fixtures as fx


def yellow(spark, number: int, **renames: str):
    base = spark.range(number).select(
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id")).alias("tpep_pickup_datetime"),
        F.timestamp_seconds(F.lit(1_700_000_600) + F.col("id")).alias("tpep_dropoff_datetime"),
        F.col("id").cast("int").alias("PULocationID"),
        F.col("id").alias("DOLocationID"),
        (F.col("id") + 0.5).alias("trip_distance"),
    )
    return base.withColumnsRenamed(renames)


def test_schema_and_missing_columns(spark):
    trips = unify(yellow(spark, 2), "Yellow")
    assert [(f.name, f.dataType) for f in trips.schema] == [(f.name, f.dataType) for f in schemas.TRIP]
    row = trips.first()
    assert row.fare_amount is None and row.passenger_count is None and row.service_type == "yellow"


def test_names_match_ignoring_case_and_bad_values_become_null(spark):
    feed = yellow(spark, 1, PULocationID="pulocationid").withColumn("FARE_AMOUNT", F.lit("n/a"))
    row = unify(feed, "yellow").first()
    assert row.pu_location_id == 0 and row.fare_amount is None


def test_fhvhv_total_is_null_when_a_part_is_absent(spark):
    feed = spark.range(1).select(
        F.lit(10.0).alias("base_passenger_fare"), F.lit(1.0).alias("tolls"), F.lit(2.0).alias("tips"), F.lit(0.5).alias("sales_tax")
    )
    assert unify(feed, "fhvhv").first().total_amount is None
    assert unify(feed, "fhvhv", absent_as_zero=True).first().total_amount == 13.5


def test_unknown_service_raises_even_for_an_empty_frame(spark):
    with pytest.raises(ValueError, match="unknown service"):
        unify(spark.createDataFrame([], "x int"), "bus")
    assert unify(spark.createDataFrame([], "x int"), "green").count() == 0
    assert union_trips([], spark).schema == schemas.TRIP


def test_one_scan_of_trips_equals_the_unified_feeds(spark, sf_dir):
    union = union_trips([unify(fx.raw_feed(spark, sf_dir, s), s) for s in FEEDS], spark)
    trips = fx.trips(spark, sf_dir)
    assert trips.exceptAll(union).isEmpty() and union.exceptAll(trips).isEmpty()


def test_months_of_different_types_and_broken_months(spark, tmp_path):
    base = tmp_path / "yellow"
    yellow(spark, 3).write.parquet(str(base / "year=2022" / "month=01"))
    drifted = yellow(spark, 4, PULocationID="pulocationid").withColumn("pulocationid", F.col("pulocationid").cast("double"))
    drifted.write.parquet(str(base / "year=2022" / "month=02"))
    yellow(spark, 5).write.parquet(str(base / "year=2021" / "month=12"))
    broken = base / "year=2023" / "month=07"
    broken.mkdir(parents=True)
    (broken / "part.parquet").write_bytes(b"not parquet at all")

    with pytest.raises(ValueError, match="2023-07"):
        read_service(spark, str(base), "yellow")
    read = read_service(spark, str(base), "yellow", with_file_month=True, skip_unreadable=True)
    assert read.trips.count() == 12
    months = {(r.file_year, r.file_month, r.n) for r in read.trips.groupBy("file_year", "file_month").agg(F.count("*").alias("n")).collect()}
    assert months == {(2021, 12, 5), (2022, 1, 3), (2022, 2, 4)}
    assert read.trips.agg(F.sum("pu_location_id")).first()[0] == 3 + 6 + 10
    skipped = read.skipped.collect()
    assert [(r.service, r.year, r.month) for r in skipped] == [("yellow", 2023, 7)] and skipped[0].reason


def test_any_month_folder_is_read_or_listed(spark, tmp_path):
    base = tmp_path / "yellow"
    for folder, n in (("year=2020/month=1", 2), ("year=2031/month=12/part=a/deep", 3), ("year=2020/month=01", 4), ("loose", 5)):
        yellow(spark, n).write.parquet(str(base / folder))
    read = read_service(spark, str(base), "yellow", with_file_month=True)
    found = {(r.file_year, r.file_month, r.n) for r in read.trips.groupBy("file_year", "file_month").agg(F.count("*").alias("n")).collect()}
    assert found == {(2020, 1, 6), (2031, 12, 3)}
    assert [tuple(r)[1:] for r in read.skipped.collect()] == [(None, None, NO_MONTH)]
    chosen = read_service(spark, str(base), "yellow", years=[2031], months=[12])
    assert chosen.trips.count() == 3
    assert sorted(tuple(r)[1:] for r in chosen.skipped.filter("year is not null").collect()) == [(2020, 1, NOT_ASKED)] * 2


def test_files_of_a_month_may_differ(spark, tmp_path):
    month = str(tmp_path / "year=2024" / "month=01")
    full = yellow(spark, 4).withColumn("tip_amount", F.lit(2.0))
    full.drop("tip_amount").write.parquet(month)
    full.write.mode("append").parquet(month)
    trips = read_service(spark, str(tmp_path), "yellow").trips
    assert (trips.count(), trips.filter("tip_amount = 2.0").count()) == (8, 4)
    full.withColumn("PULocationID", F.col("PULocationID").cast("double")).write.mode("append").parquet(month)
    trips = read_service(spark, str(tmp_path), "yellow").trips
    assert (trips.count(), trips.filter("tip_amount = 2.0").count(), trips.agg(F.sum("pu_location_id")).first()[0]) == (12, 8, 18)


def test_a_month_of_two_schemas_is_staged_whole(spark, tmp_path):
    feed, down = yellow(spark, 40), tmp_path / "down"
    feed.coalesce(1).write.parquet(str(down / "a" / "yellow_tripdata_2024-01.parquet"))
    feed.withColumn("PULocationID", F.col("PULocationID").cast("double")).write.parquet(str(down / "b" / "yellow_tripdata_2024-01.parquet"))
    yellow(spark, 7).write.parquet(str(down / "yellow_tripdata_2024-02.parquet"))
    for _ in range(2):  # staging again replaces the months
        stage_by_month(spark, str(down), str(tmp_path / "raw"))
        assert read_service(spark, str(tmp_path / "raw" / "yellow"), "yellow").trips.count() == 87


def test_corrupt_files_may_be_left_out(spark, tmp_path):
    month = tmp_path / "year=2024" / "month=01"
    yellow(spark, 4).coalesce(1).write.parquet(str(month))
    (month / "part-bad.parquet").write_bytes(b"not parquet at all")
    assert read_service(spark, str(tmp_path), "yellow", ignore_corrupt=True).trips.count() == 4
    with pytest.raises(ValueError, match="2024-01"):
        read_service(spark, str(tmp_path), "yellow")


def test_equal_schemas_share_a_scan(spark, tmp_path):
    for month in (1, 2, 3, 4):
        yellow(spark, month).write.parquet(str(tmp_path / "year=2022" / f"month={month:02d}"))
    trips = read_service(spark, str(tmp_path), "yellow").trips
    plan = trips._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1 and trips.count() == 10


def test_nothing_to_read(spark, tmp_path):
    assert month_folders(spark, str(tmp_path / "absent")) == []
    read = read_feeds(spark, str(tmp_path / "absent"))
    assert read.trips.schema == schemas.TRIP and read.trips.isEmpty() and read.skipped.isEmpty()


def test_sampling_warns_and_repeats(spark, tmp_path):
    yellow(spark, 1000).write.parquet(str(tmp_path / "year=2022" / "month=01"))
    with pytest.warns(UserWarning, match="sample"):
        first = read_service(spark, str(tmp_path), "yellow", sample_rate=0.2).trips.count()
        second = read_service(spark, str(tmp_path), "yellow", sample_rate=0.2).trips.count()
    assert first == second and 100 < first < 300


def test_manifest_and_staging(spark, tmp_path):
    down = tmp_path / "down"
    yellow(spark, 3).coalesce(1).write.parquet(str(down / "yellow_tripdata_2022-01.parquet"))
    yellow(spark, 4).write.parquet(str(down / "deep" / "yellow_tripdata_2022-02.parquet"))
    yellow(spark, 9).write.parquet(str(down / "other_2022-02.parquet"))
    listed = {(r.service, r.year, r.month, r.file, r["rows"]) for r in ingest_manifest(spark, str(down)).collect()}
    assert listed == {
        ("yellow", 2022, 1, "yellow_tripdata_2022-01.parquet", 3),
        ("yellow", 2022, 2, "yellow_tripdata_2022-02.parquet", 4),
    }
    assert stage_by_month(spark, str(down), str(tmp_path / "raw")) == ["yellow"]
    assert [f[:2] for f in month_folders(spark, str(tmp_path / "raw" / "yellow"))] == [(2022, 1), (2022, 2)]
    assert read_service(spark, str(tmp_path / "raw" / "yellow"), "yellow").trips.count() == 7


def test_zone_table_may_be_absent(spark, tmp_path):
    assert read_zones_or_none(spark, str(tmp_path / "none.csv")) is None
    path = tmp_path / "zones.csv"
    path.write_text('"LocationID","Borough","Zone","service_zone"\n1,"EWR","Newark, Airport","EWR"\n')
    row = read_zones(spark, str(path)).first()
    assert (row.LocationID, row.Zone) == (1, "Newark, Airport")


def test_report_file_keeps_its_order(spark, tmp_path):
    lines = spark.createDataFrame([(n, f"line {n}") for n in range(30)], "line_no int, value string").repartition(4)
    write_report(lines, str(tmp_path / "report"))
    (part,) = (tmp_path / "report").glob("part-*.txt")
    assert part.read_text().splitlines() == [f"line {n}" for n in range(30)]


def test_time_text_forms(spark):
    feed = spark.createDataFrame([("2024-01-01 10:00:00", "bad")], "lpep_pickup_datetime string, lpep_dropoff_datetime string")
    row = unify(feed, "green").first()
    assert row.pickup_ts == dt.datetime(2024, 1, 1, 10) and row.dropoff_ts is None

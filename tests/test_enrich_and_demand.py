from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from trip_rows import START, frame, trip

from rideflow import schemas
from rideflow.functions.columns import epoch_hour, haversine_mi
from rideflow.operators import demand, enrich, features
from rideflow.operators.lookup import fits_broadcast, lookup_join
from rideflow.operators.splits import keyed_split, time_split
from workload import fixtures as fx
from workload import queries as q


def hours(spark, *pairs):
    return spark.createDataFrame([(z, dt.datetime(2024, 1, 1) + dt.timedelta(hours=h), n) for z, h, n in pairs], "zone_id bigint, hour_ts timestamp, trip_count bigint")


def weather(spark, times, **arrays):
    names = ("temperature_2m", "precipitation", "rain", "wind_speed_10m", "relative_humidity_2m")
    values = tuple(arrays.get(name, [1.0] * len(times)) for name in names)
    return spark.createDataFrame([((times, *values),)], schemas.WEATHER_DOCUMENT)


@pytest.mark.parametrize("how", ["left", "inner"])
def test_shuffled_lookup_equals_broadcast(spark, how):
    rows = spark.range(3000).select("id", F.when(F.col("id") % 3 != 0, F.col("id") % 7).otherwise(2).alias("k"))
    rows = rows.unionByName(spark.createDataFrame([(-1, None)], "id bigint, k bigint"))
    lookup = spark.range(5).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    small = lookup_join(rows, lookup, {"k": "k"}, how)
    large = lookup_join(rows, lookup, {"k": "k"}, how, max_rows=2, salts=4)
    plain = lookup_join(rows, lookup, {"k": "k"}, how, max_rows=2, salts=1)
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    assert small.columns == large.columns == plain.columns == ["id", "k", "v"]
    assert small.exceptAll(large).isEmpty() and large.exceptAll(small).isEmpty()
    assert small.exceptAll(plain).isEmpty() and small.count() == plain.count()


def test_size_check_counts_rows_and_bytes(spark):
    rows = spark.range(100).select("id", F.repeat(F.lit("x"), 1000).alias("text"))
    assert fits_broadcast(rows) and not fits_broadcast(rows, max_rows=99)
    assert not fits_broadcast(rows, max_bytes=100_000) and fits_broadcast(rows, max_bytes=102_000)
    assert fits_broadcast(rows.limit(0), max_bytes=0)


def test_weather_arrays_of_unequal_length_are_padded(spark):
    rows = enrich.hourly_weather(weather(spark, ["2024-01-01T00:00", "2024-01-01T01:00"], rain=[0.2])).orderBy("weather_ts").collect()
    assert [(r.rain_mm, r.is_rainy) for r in rows] == [(0.2, 1), (None, 0)]


def test_a_document_without_an_array_gives_no_hours(spark):
    assert enrich.hourly_weather(weather(spark, ["2024-01-01T00:00"], rain=None)).isEmpty()


def test_a_repeated_hour_raises_or_multiplies(spark):
    hourly = enrich.hourly_weather(weather(spark, ["2024-01-10T08:00"] * 2))
    trips = frame(spark, [trip()])
    with pytest.raises(ValueError, match="more than once"):
        enrich.join_weather(trips, hourly)
    assert enrich.join_weather(trips, hourly, check_hours=False).count() == 2


def test_weather_misses_stay_null(spark):
    hourly = enrich.hourly_weather(weather(spark, ["2024-01-10T09:00"]))
    row = enrich.join_weather(frame(spark, [trip()]), hourly).first()
    assert row.weather_ts is None and row.is_rainy is None


def test_haversine(spark):
    miles = spark.range(1).select(haversine_mi(F.lit(40.6413), F.lit(-73.7781), F.lit(40.7769), F.lit(-73.8740))).first()[0]
    assert miles == pytest.approx(10.63, abs=0.05)


@pytest.mark.parametrize("hour, night", [(4, 1), (5, 0), (21, 0), (22, 1)])
def test_night(spark, hour, night):
    assert features.add_trip_features(frame(spark, [trip(pickup_ts=START.replace(hour=hour))])).first().is_night == night


@pytest.mark.parametrize("day, weekend, by_reference", [(12, 0, 1), (13, 1, 1), (14, 1, 0), (15, 0, 0)])
def test_weekend_friday_to_monday(spark, day, weekend, by_reference):
    made = features.add_trip_features(frame(spark, [trip(pickup_ts=START.replace(day=day))]))
    assert made.first().is_weekend == weekend
    assert features.add_training_features(made).first().is_weekend == weekend
    assert features.add_training_features(made, reference_calendar=True).first().is_weekend == by_reference


@pytest.mark.parametrize("zone, airport", [(1, 1), (132, 1), (138, 1), (2, 0)])
def test_airport(spark, zone, airport):
    assert features.add_trip_features(frame(spark, [trip(do_location_id=zone)])).first().is_airport_trip == airport


def test_lags_do_not_jump_over_missing_hours(spark):
    rows = demand.add_history(hours(spark, (1, 0, 5), (1, 1, 6), (1, 3, 7))).orderBy("hour_ts").collect()
    assert [r.lag_1h for r in rows] == [None, 5, None]
    assert [r.lag_2h for r in rows] == [None, None, 6]
    assert [r.rolling_mean_3h for r in rows] == [None, 5.0, 5.5]


def test_blocks_do_not_change_the_history(spark, sf_dir):
    rows = q.demand_rows(spark, sf_dir).withColumn("n", epoch_hour("hour_ts")).cache()
    timeline = Window.partitionBy("zone_id").orderBy("n")
    whole = rows.withColumns({
        "lag_168h": F.max("trip_count").over(timeline.rangeBetween(-168, -168)),
        "rolling_mean_24h": F.avg("trip_count").over(timeline.rangeBetween(-24, -1)),
    }).select("zone_id", "hour_ts", "lag_168h", "rolling_mean_24h")
    for block in (168, 200, 672):
        cut = demand.add_history(rows.drop("n"), block_hours=block).select(*whole.columns)
        assert cut.count() == whole.count()
        assert whole.exceptAll(cut).isEmpty(), block


def test_filled_hours_count_zero(spark):
    rows = demand.fill_hours(hours(spark, (1, 0, 5), (1, 3, 7), (2, 1, 1))).orderBy("zone_id", "hour_ts").collect()
    assert [(r.zone_id, r.trip_count) for r in rows] == [(1, 5), (1, 0), (1, 0), (1, 7), (2, 1)]


def test_profiles_sum_to_one(spark, sf_dir):
    profiles = demand.zone_profiles(fx.trips(spark, sf_dir).filter("pickup_ts IS NOT NULL"))
    total = sum(F.col(f"h{h:02d}") for h in range(24))
    assert profiles.filter(F.abs(total - 1) > 1e-9).isEmpty()


def test_booking_columns_hold_nothing_measured(spark):
    measured = {"trip_duration_min", "avg_speed_mph", "tip_amount", "total_amount", "trip_distance_mi", "dropoff_ts"}
    assert not measured & set(features.BOOKING_COLUMNS)


def test_time_split_is_complete(spark, sf_dir):
    trips = q.cleaned(spark, sf_dir).cache()
    assert sum(part.count() for part in time_split(trips)) == trips.count()


def test_keyed_split_ignores_partitioning(spark, sf_dir):
    trips = q.cleaned(spark, sf_dir)
    keys = ["pickup_ts", "pu_location_id", "do_location_id"]
    train, test = keyed_split(trips, keys)
    again, _ = keyed_split(trips.repartition(7, "fare_amount"), keys)
    assert train.exceptAll(again).isEmpty() and train.count() == again.count()
    share = train.count() / (train.count() + test.count())
    assert 0.75 < share < 0.85

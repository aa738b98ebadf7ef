from __future__ import annotations

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from rideflow.plans.live import live_demand
from rideflow.sinks import tables  # noqa: F401  (import check)
from rideflow.streaming import alerts, sinks
from rideflow.streaming import demand as live
from rideflow.streaming.events import encode_trips, file_events, parse_events, replay_schedule
from trip_rows import START, frame, trip

DAY = dt.datetime(2024, 1, 10)


def line(minute: float, zone: int = 1, fare: float = 10.0) -> str:
    time = DAY + dt.timedelta(minutes=minute)
    return json.dumps({"tpep_pickup_datetime": str(time), "PULocationID": zone, "fare_amount": fare})


def put(folder, number: int, lines: list[str]) -> None:
    """One input file; later numbers are later files."""
    folder.mkdir(exist_ok=True)
    path = folder / f"{number:03d}.txt"
    path.write_text("\n".join(lines) + "\n")
    os.utime(path, (1_700_000_000 + number, 1_700_000_000 + number))


def appended(spark, stream, tmp_path, name="out"):
    out = str(tmp_path / name)
    query = sinks.to_parquet(stream, out, str(tmp_path / f"{name}-checkpoint"), drain=True)
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out), query


def counts(df):
    return {(r.window_start.hour * 60 + r.window_start.minute, r.PULocationID): r.trip_count for r in df.collect()}


def test_malformed_events_have_null_fields(spark):
    values = spark.createDataFrame([(line(5),), ("{not json",), ('{"tpep_pickup_datetime": "soon", "PULocationID": 3}',)], "value string")
    rows = parse_events(values).collect()
    assert [r.pickup_time is None for r in rows] == [False, True, True]
    assert [r.PULocationID for r in rows] == [1, None, 3]


def test_update_stream_equals_batch(spark, tmp_path):
    source = tmp_path / "in"
    put(source, 1, [line(m) for m in range(0, 20)] + ["{broken"])
    put(source, 2, [line(m, zone=2) for m in range(15, 30)])
    put(source, 3, [line(m) for m in range(25, 40)])
    windows = live.flat_windows(live.sliding_demand(parse_events(file_events(spark, str(source), 1))))
    sinks.to_versions(windows, str(tmp_path / "rows"), str(tmp_path / "cp"), drain=True).awaitTermination()
    found = sinks.latest_versions(spark, str(tmp_path / "rows"), ["window_start", "window_end", "PULocationID"])
    batch = live.flat_windows(live.sliding_demand_by_panes(parse_events(spark.read.text(str(source)))))
    direct = live.flat_windows(live.sliding_demand(parse_events(spark.read.text(str(source)))))
    assert counts(found) == counts(batch) == counts(direct)


def test_late_event_is_dropped_one_batch_after_the_watermark(spark, tmp_path):
    source = tmp_path / "in"
    put(source, 1, [line(1), line(60)])
    put(source, 2, [line(61)])
    put(source, 3, [line(2)])
    put(source, 4, [line(200)])
    put(source, 5, [line(400, zone=0)])
    stream = live.flat_windows(live.tumbling_demand(parse_events(file_events(spark, str(source), 1))))
    found, query = appended(spark, stream, tmp_path)
    assert counts(found.filter("PULocationID = 1"))[(0, 1)] == 1
    dropped = sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])
    assert dropped == 1


def test_restart_from_checkpoint_repeats_nothing(spark, tmp_path):
    source = tmp_path / "in"
    put(source, 1, [line(m) for m in range(0, 30)])
    put(source, 2, [line(120)])

    def run():
        stream = live.flat_windows(live.tumbling_demand(parse_events(file_events(spark, str(source), 1))))
        return appended(spark, stream, tmp_path)[0]

    assert counts(run()) == {(0, 1): 10, (10, 1): 10, (20, 1): 10}
    put(source, 3, [line(125), line(300)])
    again = run()
    assert counts(again) == {(0, 1): 10, (10, 1): 10, (20, 1): 10, (120, 1): 2}
    assert again.count() == 4


@pytest.fixture
def surge_input(tmp_path):
    """Zone 1 is hot in two adjacent windows, zone 2 in two separate ones, zone 3 over midnight's end."""
    source = tmp_path / "in"
    hot = lambda zone, start: [line(start + i, zone) for i in range(6)]
    put(source, 1, hot(1, 0) + hot(1, 10) + hot(2, 0) + hot(2, 20) + [line(10, 2)] + hot(3, 1430) + hot(3, 1440))
    for n, minutes in enumerate((3000, 4500, 6000)):
        put(source, 2 + n, [line(minutes, zone=0)])
    return source


def rated(demand, spark):
    forecast = spark.createDataFrame(
        [(zone, hour, day, 2.0) for zone in (1, 2, 3) for hour in range(24) for day in range(1, 8)],
        "zone_id bigint, hour int, dayofweek int, forecast double",
    )
    return live.join_forecast(demand, forecast)


def test_surge_needs_two_adjacent_windows(spark, tmp_path, surge_input):
    batch = alerts.surge_alerts_batch(rated(live.tumbling_demand(parse_events(spark.read.text(str(surge_input)))), spark))
    expected = {
        (1, DAY, DAY + dt.timedelta(minutes=20), 3.0),
        (3, DAY + dt.timedelta(minutes=1430), DAY + dt.timedelta(minutes=1450), 3.0),
    }
    shape = lambda df: {(r.PULocationID, r.alert_start, r.alert_end, r.peak_ratio) for r in df.collect()}
    assert shape(batch) == expected and batch.count() == 2
    windows = live.tumbling_demand(parse_events(file_events(spark, str(surge_input), 1)))
    found, _ = appended(spark, alerts.surge_alerts_stream(rated(windows, spark)), tmp_path)
    assert shape(found) == expected and found.count() == 2


def test_console(spark, tmp_path):
    put(tmp_path / "in", 1, [line(1, zone=77)])
    query = sinks.to_console(live_demand(file_events(spark, str(tmp_path / "in"))), every="1 second")
    query.processAllAvailable()
    progress = [p for p in query.recentProgress if p["numInputRows"]]
    query.stop()
    assert "ConsoleTable" in progress[0]["sink"]["description"]


def test_trips_of_one_instant_are_spread(spark):
    rows = frame(spark, [trip(fare_amount=1.0 + n) for n in range(4000)])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        due = replay_schedule(rows, "2025-01-01 00:00:00")
        sizes = due.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) > 1 and max(r["count"] for r in sizes) < 3000


def test_names_are_null_without_a_zone_table(spark, tmp_path):
    put(tmp_path / "in", 1, [line(1)])
    values = spark.read.text(str(tmp_path / "in"))
    bare = live_demand(values)
    assert bare.count() == 5 and bare.filter("Zone IS NOT NULL").isEmpty()
    zones = spark.createDataFrame([(1, "Queens", "Astoria", "Boro")], "LocationID int, Borough string, Zone string, service_zone string")
    named = live_demand(values, zones)
    assert named.columns == bare.columns and named.first().Borough == "Queens"


def test_encoded_trips_parse_back(spark):
    events = encode_trips(frame(spark, [trip(), trip(pu_location_id=7, fare_amount=None)]))
    assert {r.key for r in events.collect()} == {"10", "7"}
    rows = parse_events(events).orderBy("PULocationID").collect()
    assert rows[1].pickup_time == START and rows[0].fare_amount is None


def test_replay_is_compressed_and_ordered(spark):
    later = START + dt.timedelta(hours=1)
    rows = replay_schedule(frame(spark, [trip(pickup_ts=later), trip()]), "2025-01-01 00:00:00").collect()
    assert [r.event_ts for r in rows] == [dt.datetime(2025, 1, 1), dt.datetime(2025, 1, 1, 0, 1)]


def test_null_times_drop_out_and_null_zones_group(spark):
    values = spark.createDataFrame(
        [('{"tpep_pickup_datetime": "2024-01-10 00:01:00", "fare_amount": 1.0}',), ("{}",)], "value string"
    )
    rows = live.flat_windows(live.tumbling_demand(parse_events(values))).collect()
    assert [(r.PULocationID, r.trip_count) for r in rows] == [(None, 1)]
    panes = live.flat_windows(live.sliding_demand_by_panes(parse_events(values)))
    assert panes.filter(F.col("PULocationID").isNull()).count() == 5

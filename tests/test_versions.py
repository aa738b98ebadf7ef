from __future__ import annotations

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from rideflow.streaming import demand as live
from rideflow.streaming import forecasts, versions
from rideflow.streaming.events import file_events, parse_events

DAY = dt.datetime(2024, 1, 10)
SCHEMA = "window_start timestamp, window_end timestamp, zone long, n long"
KEYS = ["window_start", "window_end", "zone"]


def rows_of(batch):
    """Ten-minute windows; each batch updates the last two and opens one."""
    return [(DAY + dt.timedelta(minutes=10 * w), DAY + dt.timedelta(minutes=10 * w + 10), z, 100 * batch + z) for w in (batch - 2, batch - 1, batch) if w >= 0 for z in (1, 2)]


def newest(batches):
    held = {}
    for batch in range(batches):
        for start, end, zone, n in rows_of(batch):
            held[start, zone] = n
    return held


def told(df):
    return {(r.window_start, r.zone): r.n for r in df.collect()}


def folders(path):
    return {n for n in os.listdir(path) if not n.startswith(".")}


def add(spark, table, batch):
    table.add(spark.createDataFrame(rows_of(batch), SCHEMA).coalesce(1), batch)


def test_folders_stay_few_and_rows_are_the_newest(spark, tmp_path):
    path = str(tmp_path / "t")
    table, most = versions.window_table(spark, path, KEYS, "20 minutes", merge_every=2), 0
    for batch in range(24):
        add(spark, table, batch)
        most = max(most, len(folders(path)))
        if batch % 6 == 5:
            assert told(versions.window_table(spark, path, KEYS, "20 minutes").rows()) == newest(batch + 1)
    entry = table.entry()
    assert most <= 2 + 2 * versions.KEPT_ENTRIES + 3 * versions.MERGE_FINAL and len(entry.final) < 2 * versions.MERGE_FINAL
    final = spark.read.parquet(*(f"{path}/{f}" for f, _ in entry.final))
    assert final.count() == final.select(*KEYS).distinct().count() > 30
    assert len(table.entries()) == versions.KEPT_ENTRIES


@pytest.mark.parametrize("fails", ["_commit", "_merged_final", "_forget"])
def test_a_batch_repeated_after_a_failure_changes_nothing(spark, tmp_path, monkeypatch, fails):
    path = str(tmp_path / "t")
    table = versions.window_table(spark, path, KEYS, "10 minutes", merge_every=2)
    for batch in range(3):
        add(spark, table, batch)
    before = told(table.rows())
    with monkeypatch.context() as broken:
        broken.setattr(versions.Versions, fails, lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            add(spark, table, 3)
    again = versions.window_table(spark, path, KEYS, "10 minutes", merge_every=2)
    assert told(again.rows()) == (newest(4) if fails == "_forget" else before)
    for batch in range(3, 9):
        add(spark, again, batch)
    assert told(again.rows()) == newest(9)


def test_an_empty_table(spark, tmp_path):
    table = versions.window_table(spark, str(tmp_path / "t"), KEYS, "10 minutes", merge_every=1)
    with pytest.raises(ValueError, match="empty"):
        table.rows()
    table.add(spark.createDataFrame([], SCHEMA), 0)
    assert table.rows().columns == ["window_start", "window_end", "zone", "n"] and table.rows().count() == 0


def put(folder, number, minutes):
    folder.mkdir(exist_ok=True)
    line = lambda m: json.dumps({"tpep_pickup_datetime": str(DAY + dt.timedelta(minutes=m)), "PULocationID": 1, "fare_amount": 10.0})
    path = folder / f"{number:03d}.txt"
    path.write_text("\n".join(map(line, minutes)) + "\n")
    os.utime(path, (1_700_000_000 + number, 1_700_000_000 + number))


def hourly(spark, source):
    return live.flat_windows(live.windowed_demand(parse_events(source), "1 hour", watermark="15 minutes"))


def test_stream_equals_batch_over_a_restart_and_reads_its_hours_only(spark, tmp_path, monkeypatch):
    source, path, known = tmp_path / "in", str(tmp_path / "t"), str(tmp_path / "forecasts")
    hours = spark.range(24 * 5).select(
        F.lit(1).cast("long").alias("zone_id"), (F.lit(DAY) + F.make_dt_interval(hours=F.col("id").cast("int"))).alias("hour_ts"), F.col("id").cast("double").alias("forecast")
    )
    forecasts.write_forecasts(hours, known, "a")
    forecasts.write_forecasts(hours.withColumn("forecast", F.col("forecast") + 1000), known, "b")
    read, spans = forecasts.read_forecasts, []
    monkeypatch.setattr(forecasts, "read_forecasts", lambda s, p, v, since, until: (spans.append((v, since, until)), read(s, p, v, since, until))[1])
    version = ["a"]
    lookup = forecasts.forecast_lookup(known, lambda: version[0])

    def run():
        table = versions.window_table(spark, path, ["window_start", "window_end", "PULocationID"], "15 minutes", merge_every=2)
        stream = hourly(spark, file_events(spark, str(source), 1))
        versions.to_table(stream, table, str(tmp_path / "cp"), drain=True, prepare=lookup).awaitTermination()
        return table

    for number in range(4):
        put(source, number, range(60 * number, 60 * number + 90, 7))
    run()
    version[0] = "b"
    for number in range(4, 9):
        put(source, number, range(60 * number, 60 * number + 90, 7))
    table = run()
    found = {r.window_start: (r.trip_count, r.forecast) for r in table.rows().collect()}
    batch = {r.window_start: r.trip_count for r in hourly(spark, spark.read.text(str(source))).collect()}
    assert {k: n for k, (n, _) in found.items()} == batch
    assert found[DAY] == (batch[DAY], 0.0) and found[max(found)][1] == 1000 + (max(found) - DAY).seconds // 3600
    widths = [(until - since).total_seconds() / 3600 for _, since, until in spans if since]
    assert {v for v, *_ in spans} == {"a", "b"} and max(widths) <= 1


def test_only_the_days_asked_for_are_read(spark, tmp_path):
    path = str(tmp_path / "f")
    hours = spark.range(24 * 40).select(
        F.lit(1).cast("long").alias("zone_id"), (F.lit(DAY) + F.make_dt_interval(hours=F.col("id").cast("int"))).alias("hour_ts"), F.lit(2.0).alias("forecast")
    )
    forecasts.write_forecasts(hours, path, "a")
    rows = forecasts.read_forecasts(spark, path, "a", DAY + dt.timedelta(hours=30), DAY + dt.timedelta(hours=50))
    assert rows.count() == 21
    assert len(rows.inputFiles()) >= 40 and rows.select(F.col("_metadata.file_path")).distinct().count() == 2
    assert "PartitionFilters: [isnotnull(day" in rows._jdf.queryExecution().toString()

from __future__ import annotations

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from rideflow.streaming import health, sinks

DAY = dt.datetime(2024, 1, 10)


def put(folder, number, rows):
    folder.mkdir(exist_ok=True)
    path = folder / f"{number:03d}.json"
    path.write_text("\n".join(json.dumps(r, default=str) for r in rows) + "\n")
    os.utime(path, (1_700_000_000 + number, 1_700_000_000 + number))


def at(minutes):
    return DAY + dt.timedelta(minutes=minutes)


def test_late_absent_and_too_late_outcomes(spark, tmp_path):
    """A trip may finish batches after its prediction; one that never does, or too late, counts as not finished."""
    asked, ended = tmp_path / "asked", tmp_path / "ended"
    put(asked, 0, [{"trip": i, "predicted_at": at(i), "guess": 10.0} for i in range(4)])
    put(ended, 0, [{"trip": 0, "finished_at": at(20), "fare": 13.0}])
    put(asked, 1, [{"trip": 9, "predicted_at": at(70), "guess": 1.0}])
    put(ended, 1, [{"trip": 1, "finished_at": at(55), "fare": 6.0}, {"trip": 2, "finished_at": at(100), "fare": 99.0}])
    for n in (2, 3, 4, 5):
        put(asked, n, [{"trip": 100 + n, "predicted_at": at(1000 * n), "guess": 0.0}])
        put(ended, n, [{"trip": -n, "finished_at": at(1000 * n), "fare": 0.0}])
    read = lambda folder, schema: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(folder))
    predictions = read(asked, "trip long, predicted_at timestamp, guess double")
    outcomes = read(ended, "trip long, finished_at timestamp, fare double")
    windows = health.health_by_window(health.with_outcomes(predictions, outcomes, ["trip"], "1 hour"), "fare", "guess")
    sinks.to_parquet(windows, str(tmp_path / "out"), str(tmp_path / "cp"), drain=True).awaitTermination()
    rows = {r.window_start: r for r in spark.read.schema(windows.schema).parquet(str(tmp_path / "out")).collect()}
    first = rows[DAY]
    assert (first.predictions, first.finished, first.mae, first.rmse) == (4, 2, 3.5, 12.5**0.5)
    assert (rows[at(60)].predictions, rows[at(60)].finished, rows[at(60)].rmse) == (1, 0, None)
    whole = health.with_outcomes(
        spark.read.schema("trip long, predicted_at timestamp, guess double").json(str(asked)),
        spark.read.schema("trip long, finished_at timestamp, fare double").json(str(ended)), ["trip"], "1 hour")
    batch = health.health_by_window(whole, "fare", "guess").filter(F.col("window_start") < F.lit(at(900)))
    assert {r.window_start: r for r in batch.collect()} == {k: v for k, v in rows.items() if k < at(900)}

"""How the derived inputs of streams and of the ingest table are written."""

from __future__ import annotations

from pathlib import Path

from workload import fixtures, queries

TIMES = ("2030-01-01 00:00:00", "2030-01-02 00:00:00")


def _parts(folder):
    return sorted(Path(folder.removeprefix("file:")).glob("part-*"), key=lambda file: file.stat().st_mtime)


def test_all_event_files_come_from_one_job_in_order_of_time(spark, sf_dir):
    parts = _parts(fixtures.event_folder(spark, sf_dir, TIMES[0], repeat_first=True, flush_after=TIMES[1]))
    assert len(parts) == fixtures.EVENT_FILES + 3 and len({file.stat().st_mtime for file in parts}) == len(parts)
    assert len({file.name.split("-", 2)[2] for file in parts}) == 1
    lines = [sorted(file.read_text().splitlines()) for file in parts]
    assert lines[-2] == lines[0] and [lines[-3], lines[-1]] == [[fixtures.flush_value(t)] for t in TIMES]
    whole = [line for part in lines[: fixtures.EVENT_FILES] for line in part]
    assert sorted(whole) == sorted(r.value for r in fixtures.event_values(spark, sf_dir).collect())
    seen = [[line.split('"tpep_pickup_datetime":"')[1][:26] for line in part] for part in lines[: fixtures.EVENT_FILES]]
    assert all(max(a) < min(b) for a, b in zip(seen, seen[1:]))


def test_live_health_writes_the_events_once(spark, sf_dir, monkeypatch):
    folders, make = [], fixtures.event_folder
    monkeypatch.setattr(fixtures, "event_folder", lambda *args, **options: folders.append(make(*args, **options)) or folders[-1])
    monkeypatch.setattr(queries, "_appends", lambda session, stream: session.createDataFrame([], stream.schema))
    assert queries.QUERIES["stream_model_health"](spark, sf_dir).isEmpty()
    assert len(folders) == 1


def test_the_changing_lake_is_staged_once(spark, sf_dir, monkeypatch):
    staged, stage = [], fixtures.stage_by_month
    monkeypatch.setattr(fixtures, "stage_by_month", lambda *args: staged.append(args) or stage(*args))
    monkeypatch.setattr(fixtures, "_written", {k: v for k, v in fixtures._written.items() if not k[1].endswith("#staged")})
    lake = fixtures.changing_lake(spark, sf_dir)
    months = lambda: {str(p.relative_to(root)) for p in root.glob("*/year=*/month=*")}
    root = Path(lake.folder.removeprefix("file:"))
    assert len(staged) == 1 and "green/year=2023/month=05" not in months()
    rows = spark.read.parquet(f"{lake.folder}/fhvhv/year=2024/month=02").count()
    lake.change()
    assert "green/year=2023/month=05" in months() and "yellow/year=2022/month=03" not in months()
    assert spark.read.parquet(f"{lake.folder}/fhvhv/year=2024/month=02").count() == 2 * rows

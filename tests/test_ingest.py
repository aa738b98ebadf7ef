from __future__ import annotations

import shutil

import pytest
from pyspark.sql import functions as F

from rideflow.operators.clean import FILE_MONTH
from rideflow.plans.preprocess import build_trips, update_trips
from rideflow.sources import ingest
from workload import fixtures as fx


@pytest.fixture(scope="module")
def lake(spark, sf_dir, tmp_path_factory):
    """Staged months of 2024 in a folder of their own."""
    staged, folder = fx.staged_folder(spark, sf_dir).removeprefix("file:"), tmp_path_factory.mktemp("lake") / "lake"
    for service in ("yellow", "green", "fhvhv"):
        for month in range(1, 5):
            shutil.copytree(f"{staged}/{service}/year=2024/month={month:02d}", folder / service / "year=2024" / f"month={month:02d}")
    return folder


def months(done):
    return {(r.service, r.month): (r.change, r.rows_before, r.rows) for r in done.months.collect()}


def test_only_new_and_changed_files_are_described(spark, lake, tmp_path, monkeypatch):
    asked, described = [], ingest.same_schema_paths
    monkeypatch.setattr(ingest, "same_schema_paths", lambda s, paths: (asked.append(sorted(p[-13:] for p in paths)), described(s, paths))[1])
    work, table = tmp_path / "lake", str(tmp_path / "files")
    shutil.copytree(lake, work)
    first = ingest.refresh(spark, str(work), table)
    assert len(asked[0]) == 12 and {c for c, *_ in months(first).values()} == {"added"} and first.version == 1
    counts = spark.read.option("recursiveFileLookup", True).option("mergeSchema", False).parquet(str(work / "yellow/year=2024/month=01")).count()
    assert months(first)["yellow", 1][2] == counts
    again = ingest.refresh(spark, str(work), table)
    assert asked[1] == [] and {c for c, *_ in months(again).values()} == {"same"} and again.version == 1
    shutil.copy(next((work / "green/year=2024/month=02").glob("*.parquet")), work / "green/year=2024/month=02/more.parquet")
    shutil.rmtree(work / "fhvhv/year=2024/month=03")
    third = ingest.refresh(spark, str(work), table)
    changes = {k: v for k, v in months(third).items() if v[0] != "same"}
    assert [p[:1] for p in asked[2:]] == [["2024/month=02"]] and third.version == 2
    assert changes["green", 2][0] == "changed" and changes["green", 2][2] > changes["green", 2][1] and changes["fhvhv", 3][0] == "gone" and len(changes) == 2


def test_an_absent_lake_is_empty(spark, tmp_path):
    done = ingest.refresh(spark, str(tmp_path / "none"), str(tmp_path / "files"))
    assert done.months.count() == done.files.count() == done.version == 0


def test_an_update_equals_a_whole_run(spark, sf_dir, lake, tmp_path):
    reference, work, out = fx.reference_folder(spark, sf_dir), tmp_path / "lake", str(tmp_path / "trips")
    shutil.copytree(lake, work)
    shutil.rmtree(work / "yellow/year=2024/month=04")
    paths = (f"{reference}/zones", f"{reference}/weather")
    update_trips(spark, str(work), *paths, out, str(tmp_path / "files"))
    kept = {p.name for p in (tmp_path / "trips/pickup_year=2024/pickup_month=1").glob("*.parquet")}
    shutil.copytree(lake / "yellow/year=2024/month=04", work / "yellow/year=2024/month=04")
    for service in ("yellow", "green", "fhvhv"):
        shutil.rmtree(work / service / "year=2024/month=02")
    done = update_trips(spark, str(work), *paths, out, str(tmp_path / "files"))
    assert {(r.service, r.month, r.change) for r in done.months.collect() if r.change != "same"} == {
        ("yellow", 4, "added"), *((s, 2, "gone") for s in ("yellow", "green", "fhvhv"))}
    whole = build_trips(spark, str(work), *paths, str(tmp_path / "whole"), period=FILE_MONTH).trips
    mine = spark.read.parquet(out).select(whole.columns)
    assert mine.exceptAll(whole).count() == whole.exceptAll(mine).count() == 0 and whole.count() > 0
    assert {p.name for p in (tmp_path / "trips/pickup_year=2024/pickup_month=1").glob("*.parquet")} == kept
    assert mine.select(F.collect_set("pickup_month")).first()[0] and not (tmp_path / "trips/pickup_year=2024/pickup_month=2").exists()

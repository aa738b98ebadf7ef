"""Sizes of tasks and of what the written trip table shuffles."""

from __future__ import annotations

import pytest

from rideflow import session
from workload import fixtures, queries


@pytest.fixture
def settings(spark):
    before = {name: spark.conf.get(name) for name in session.TASK_BYTES}
    yield spark.conf
    for name, value in before.items():
        spark.conf.set(name, value)


def test_large_sizes_are_lowered_and_small_ones_stay(spark, sf_dir, settings):
    split, piece = session.TASK_BYTES
    settings.set(split, "128MB")
    settings.set(piece, "1MB")
    fixtures.table(spark, sf_dir, "region")
    assert settings.get(split) == f"{session.TASK_BYTES[split]}b"
    assert settings.get(piece) == "1MB"


def test_the_trip_table_is_balanced_before_the_joins(spark, sf_dir, monkeypatch):
    frame, seen = type(spark.range(0)), []
    hint = frame.hint

    def noted(self, name, *keys):
        seen.append((name, len(self.columns)))
        return hint(self, name, *keys)

    monkeypatch.setattr(frame, "hint", noted)
    monkeypatch.setattr(queries, "_kept", {})
    table = queries._trip_table(spark, sf_dir)
    assert [n for name, n in seen if name == "rebalance"] == [12]
    rows = queries.booking_rows(spark, sf_dir)
    assert sorted(table.columns) == sorted(rows.columns)
    assert table.select(*rows.columns).exceptAll(rows).isEmpty() and table.count() == rows.count()


def test_downloads_shuffle_lines_and_not_trips(spark, sf_dir, monkeypatch):
    frame, seen = type(spark.range(0)), []
    hint = frame.hint

    def noted(self, name, *keys):
        seen.append((name, sorted(self.columns)))
        return hint(self, name, *keys)

    monkeypatch.setattr(frame, "hint", noted)
    monkeypatch.setattr(fixtures, "_written", {})
    folder = fixtures.download_folder(spark, sf_dir)
    assert seen == [("rebalance", sorted([*fixtures.LINE_COLUMNS, "month"]))] * 6
    made = sum(spark.read.parquet(f"{folder}/{service}").count() for service in fixtures.SERVICES)
    assert made == fixtures.trips(spark, sf_dir).count()

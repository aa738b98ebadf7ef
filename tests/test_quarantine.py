from __future__ import annotations

from pyspark.sql import functions as F

from rideflow.sources.quarantine import probe_lake, write_quarantine
from rideflow.sources.trips import read_service
from test_unify_and_sources import yellow


def lake(spark, tmp_path):
    base = tmp_path / "yellow"
    for month, n in ((1, 4), (2, 5)):
        yellow(spark, n).coalesce(1).write.parquet(str(base / "year=2024" / f"month={month:02d}"))
    return base


def test_broken_files_are_named_and_the_rest_is_read(spark, tmp_path):
    base = lake(spark, tmp_path)
    (base / "year=2024" / "month=01" / "part-text.parquet").write_bytes(b"not parquet at all")
    (base / "year=2024" / "month=03").mkdir()
    (base / "year=2024" / "month=03" / "part-short.parquet").write_bytes(b"PAR1")
    (base / "year=2024" / "month=03" / "part-none.parquet").write_bytes(b"")
    yellow(spark, 4).limit(0).coalesce(1).write.mode("append").parquet(str(base / "year=2024" / "month=02"))
    probed = probe_lake(spark, str(tmp_path))
    bad = {(r.path.rpartition("/")[2], r.service, r.year, r.month) for r in probed.quarantined.collect()}
    assert bad == {("part-text.parquet", "yellow", 2024, 1), ("part-short.parquet", "yellow", 2024, 3)}
    assert probed.quarantined.filter("reason = ''").isEmpty()
    assert sorted((r.month, r["rows"]) for r in probed.sound.collect()) == [(1, 4), (2, 5)]
    assert probed.trips().count() == 9


def test_damaged_pages_are_found_by_decoding_only(spark, tmp_path):
    base = lake(spark, tmp_path)
    (part,) = (base / "year=2024" / "month=02").glob("part-*.parquet")
    content = bytearray(part.read_bytes())
    data_end = len(content) - 8 - int.from_bytes(content[-8:-4], "little")
    content[4:data_end] = b"\xff" * (data_end - 4)
    (part.parent / "part-damaged.parquet").write_bytes(content)
    assert probe_lake(spark, str(tmp_path), deep=False).quarantined.isEmpty()
    (row,) = probe_lake(spark, str(tmp_path)).quarantined.collect()
    assert row.path.endswith("part-damaged.parquet") and "of 5 rows can be read" in row.reason
    assert probe_lake(spark, str(tmp_path)).trips().count() == 9


def test_files_of_clashing_types_are_probed_one_by_one(spark, tmp_path):
    base = lake(spark, tmp_path)
    month = base / "year=2024" / "month=01"
    yellow(spark, 3).withColumn("PULocationID", F.col("PULocationID").cast("double")).write.mode("append").parquet(str(month))
    (month / "part-text.parquet").write_bytes(b"not parquet at all")
    probed = probe_lake(spark, str(tmp_path))
    assert probed.quarantined.count() == 1 and probed.trips().count() == 12


def test_lakes_without_sound_files(spark, tmp_path):
    folder = tmp_path / "yellow" / "year=2024" / "month=01"
    folder.mkdir(parents=True)
    (folder / "a.parquet").write_bytes(b"nothing")
    probed = probe_lake(spark, str(tmp_path))
    assert (probed.sound.count(), probed.quarantined.count()) == (0, 1) and probed.trips().isEmpty()
    for _ in range(2):
        write_quarantine(probed.quarantined, str(tmp_path / "quarantine"))
    assert spark.read.parquet(str(tmp_path / "quarantine")).count() == 2


def test_corrupt_files_left_out_of_a_read_are_skipped_rows(spark, tmp_path):
    base = lake(spark, tmp_path)
    (base / "year=2024" / "month=02" / "part-bad.parquet").write_bytes(b"not parquet at all")
    read = read_service(spark, str(base), "yellow", ignore_corrupt=True)
    (row,) = read.skipped.collect()
    assert read.trips.count() == 9 and (row.service, row.year, row.month) == ("yellow", 2024, 2) and row.reason.startswith("part-bad.parquet: ")

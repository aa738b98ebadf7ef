from __future__ import annotations

from pyspark.sql import functions as F

from rideflow.session import materialize
from rideflow.sinks import compact
from rideflow.sinks.compact import BAND, compact_months, month_files, table_files
from rideflow.sinks.tables import TRIP_PARTITIONS, write_partitioned


def rows(spark, n, month=1, start=0):
    return spark.range(start, start + n).select(
        F.col("id").alias("place"), F.sha2(F.col("id").cast("string"), 256).alias("text"), F.lit(None).cast("string").alias("note"),
        F.lit(2024).alias("pickup_year"), F.lit(month).alias("pickup_month"),
    )


def digest(spark, path):
    return spark.read.parquet(path).groupBy("pickup_month").agg(F.count("*"), F.bit_xor(F.xxhash64("place", "text"))).orderBy("pickup_month").collect()


def test_small_files_become_few_of_the_target(spark, tmp_path):
    path, target = str(tmp_path / "trips"), 256 * 1024
    for start in (0, 12_000, 23_500):  # some rows come twice
        write_partitioned(rows(spark, 12_000, start=start).repartition(8), path, mode="append")
    write_partitioned(rows(spark, 50, 2).coalesce(1), path, mode="append")
    write_partitioned(rows(spark, 9_000, 3).repartition(6), path, mode="append")
    before, untouched = digest(spark, path), {p.name for p in (tmp_path / "trips").glob("*/pickup_month=2/*.parquet")}
    found = {r.pickup_month: r.fragmented for r in compact_months(spark, path, target).collect()}
    assert found == {1: True, 2: False, 3: True} and digest(spark, path) == before
    assert {p.name for p in (tmp_path / "trips").glob("*/pickup_month=2/*.parquet")} == untouched
    for month in (1, 3):
        sizes = sorted(p.stat().st_size for p in (tmp_path / "trips").glob(f"*/pickup_month={month}/*.parquet"))
        assert 2 <= len(sizes) <= 12 and all(BAND[0] * target <= s <= BAND[1] * target for s in sizes[1:])
    assert compact_months(spark, path, target).filter("fragmented").isEmpty()
    assert not [p for p in (tmp_path / "trips").iterdir() if p.name.startswith("_compacting")]


def test_one_large_file_is_split_in_order(spark, tmp_path):
    path, target = str(tmp_path / "trips"), 128 * 1024
    write_partitioned(rows(spark, 20_000).coalesce(1), path)
    compact_months(spark, path, target)
    files = materialize(spark.read.parquet(path).select("place", F.col("_metadata.file_path").alias("f")))
    spans = sorted((r.lo, r.hi) for r in files.groupBy("f").agg(F.min("place").alias("lo"), F.max("place").alias("hi")).collect())
    assert len(spans) > 3 and all(a[1] + 1 == b[0] for a, b in zip(spans, spans[1:]))


def test_months_share_tasks_up_to_their_bytes(spark, tmp_path, monkeypatch):
    for bytes_, months_together in ((compact.TASK_BYTES, 3), (128 * 1024, 2), (1, 1)):
        monkeypatch.setattr(compact, "TASK_BYTES", bytes_)
        path = str(tmp_path / f"trips-{months_together}")
        for month, n in ((1, 6_000), (2, 9_000), (3, 4_000)):
            write_partitioned(rows(spark, n, month, start=month * 10_000).repartition(30), path, mode="append")
        before = digest(spark, path)
        pieces = sorted((r.pieces for r in compact_months(spark, path, 64 * 1024).collect()), reverse=True)
        assert digest(spark, path) == before
        written = spark.read.parquet(path).select("place", "pickup_month", F.element_at(F.split("_metadata.file_path", "/"), -1).alias("file"))
        files = written.groupBy("pickup_month", "file").agg(F.count("*").alias("rows")).collect()
        by_month = [sorted(f.rows for f in files if f.pickup_month == m) for m in (1, 2, 3)]
        assert sorted(map(len, by_month), reverse=True) == pieces and all(m[-1] - m[0] <= 1 for m in by_month)
        assert len({f.file.split("-")[1] for f in files}) == sum(pieces[::months_together])


def test_a_month_left_between_its_renames_is_put_back(spark, tmp_path):
    path = str(tmp_path / "trips")
    write_partitioned(rows(spark, 100).coalesce(1), path)
    write_partitioned(rows(spark, 100, 2).coalesce(1), path, mode="append")
    before = digest(spark, path)
    month = tmp_path / "trips" / "pickup_year=2024" / "pickup_month=2"
    old = tmp_path / "trips" / "_old" / "pickup_year=2024" / "pickup_month=2"
    old.parent.mkdir(parents=True)
    month.rename(old)
    assert len(digest(spark, path)) == 1
    compact_months(spark, path)
    assert digest(spark, path) == before and not (tmp_path / "trips" / "_old").exists()


def test_months_by_their_files(spark):
    files = spark.createDataFrame(
        [("a", 2024, 1, 1000, 10), ("b", 2024, 1, 100, 1), ("c", 2024, 2, 90, 9), ("d", 2024, 3, 5000, 1), ("e", 2024, 4, 700, 7), ("f", 2024, 4, 700, 7)],
        "path string, pickup_year int, pickup_month int, bytes bigint, rows bigint",
    )
    found = {r.pickup_month: (r.files, r.pieces, r.fragmented) for r in month_files(files, 1000).select("pickup_month", "files", "pieces", "fragmented").collect()}
    # A single row cannot be split; files of 55 % and 70 % of the target on average stay.
    assert found == {1: (2, 2, False), 2: (1, 1, False), 3: (1, 1, False), 4: (2, 2, False)}
    assert month_files(files.limit(0), 1000, TRIP_PARTITIONS).isEmpty()

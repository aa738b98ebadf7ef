from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F
from trip_rows import START, frame, trip

from rideflow.operators import clean, quality
from workload import fixtures as fx

LAST_SECOND_2021 = dt.datetime(2021, 12, 31, 23, 59, 59)

EDGES = [
    (trip(), None),
    (trip(pickup_ts=None), "01_null_keys_removed"),
    (trip(dropoff_ts=None), "01_null_keys_removed"),
    (trip(do_location_id=None), "01_null_keys_removed"),
    (trip(pu_location_id=0), "02_invalid_zones_removed"),
    (trip(pu_location_id=1, do_location_id=263), None),
    (trip(do_location_id=264), "02_invalid_zones_removed"),
    (trip(fare_amount=0.0), "03_non_positive_fare_removed"),
    (trip(fare_amount=None), "03_non_positive_fare_removed"),
    (trip(fare_amount=1000.0), None),
    (trip(fare_amount=math.nan), "04_absurd_fare_removed"),
    (trip(fare_amount=1000.01), "04_absurd_fare_removed"),
    (trip(trip_distance_mi=0.0), "05_non_positive_distance_removed"),
    (trip(trip_distance_mi=None), "05_non_positive_distance_removed"),
    (trip(trip_distance_mi=200.0, seconds=21600), None),
    (trip(trip_distance_mi=200.1, seconds=21600), "06_absurd_distance_removed"),
    (trip(seconds=0), "07_time_inversion_removed"),
    (trip(seconds=-5), "07_time_inversion_removed"),
    (trip(seconds=59, trip_distance_mi=0.5), "08_duration_anomalies_removed"),
    (trip(seconds=60, trip_distance_mi=0.5), None),
    (trip(seconds=21600, trip_distance_mi=20.0), None),
    (trip(seconds=21601, trip_distance_mi=20.0), "08_duration_anomalies_removed"),
    (trip(seconds=3600, trip_distance_mi=0.5), None),
    (trip(seconds=3600, trip_distance_mi=0.49), "10_impossible_speed_removed"),
    (trip(seconds=3600, trip_distance_mi=90.0), None),
    (trip(seconds=3600, trip_distance_mi=90.1), "10_impossible_speed_removed"),
    (trip(pickup_ts=LAST_SECOND_2021), "11_out_of_period_removed"),
    (trip(pickup_ts=dt.datetime(2022, 1, 1)), None),
    (trip(pickup_ts=dt.datetime(2024, 12, 31, 23, 59, 59)), None),
    (trip(pickup_ts=dt.datetime(2025, 1, 1)), "11_out_of_period_removed"),
    (trip(passenger_count=0.0), "12_passenger_anomalies_removed"),
    (trip(passenger_count=8.0), None),
    (trip(passenger_count=9.0), "12_passenger_anomalies_removed"),
    (trip(passenger_count=None), None),
]

# Measured first-failing-rule counts of the derived trips at scale 0.001.
EXPECTED = {
    "01_null_keys_removed": 73,
    "02_invalid_zones_removed": 126,
    "03_non_positive_fare_removed": 291,
    "04_absurd_fare_removed": 14,
    "05_non_positive_distance_removed": 139,
    "06_absurd_distance_removed": 60,
    "07_time_inversion_removed": 75,
    "08_duration_anomalies_removed": 524,
    "10_impossible_speed_removed": 323,
    "11_out_of_period_removed": 143,
    "12_passenger_anomalies_removed": 529,
    "13_duplicates_removed": 89,
    "99_final_clean_count": 3786,
}


def test_each_edge_row_fails_the_expected_rule(spark):
    rows = [row | {"total_amount": float(n)} for n, (row, _) in enumerate(EDGES)]
    judged = frame(spark, rows).withColumn("failed", clean.first_failed_rule())
    found = {int(r.total_amount): r.failed for r in judged.collect()}
    assert found == {n: expected for n, (_, expected) in enumerate(EDGES)}
    kept = {int(r.total_amount) for r in clean.passing(frame(spark, rows)).collect()}
    assert kept == {n for n, expected in found.items() if expected is None}


def test_counts_equal_filters_one_after_another(spark, sf_dir):
    trips = fx.trips(spark, sf_dir).cache()
    counts = {r.rule: r["rows"] for r in clean.counter_rows(clean.rule_totals(trips)).collect()}
    before = trips.count()
    assert counts[clean.INITIAL] == before
    rest = trips
    for rule in clean.RULES:
        rest = rest.filter(rule.keep(clean.ALL_YEARS))
        after = rest.count()
        assert counts[rule.key] == before - after, rule.key
        before = after
    final = rest.dropDuplicates().count()
    assert counts[clean.DUPLICATES] == before - final
    assert counts[clean.FINAL] == final
    assert {key: counts[key] for key in EXPECTED} == EXPECTED
    trips.unpersist()


def test_counts_from_the_written_rows_agree(spark, sf_dir, tmp_path):
    trips = fx.trips(spark, sf_dir)
    clean.clean_trips(trips).write.parquet(str(tmp_path / "clean"))
    written = spark.read.parquet(str(tmp_path / "clean"))
    assert clean.row_rule_totals(trips, written).first() == clean.rule_totals(trips).first()


def test_a_third_of_all_rows_may_be_copies(spark):
    rows = [trip(fare_amount=5.0 + n) for n in range(200)] + [trip()] * 100
    totals = clean.rule_totals(frame(spark, rows)).first()
    assert totals[clean.DUPLICATES] == 100 and totals[clean.FINAL] == 200
    assert clean.clean_trips(frame(spark, rows)).count() == 200


def test_target_and_file_month(spark):
    rows = frame(spark, [trip(), trip(pickup_ts=dt.datetime(2024, 2, 1))])
    assert clean.clean_trips(rows, clean.Period(2024, 1)).count() == 1
    filed = rows.withColumns({"file_year": F.lit(2024), "file_month": F.lit(2)})
    kept = clean.clean_trips(filed, clean.FILE_MONTH)
    assert [r.pickup_ts.month for r in kept.collect()] == [2]
    assert kept.columns == clean.TRIP_COLUMNS


def test_empty_input_gives_zero_percentages(spark):
    totals = clean.rule_totals(frame(spark, []))
    report = quality.quality_report(totals).collect()
    assert len(report) == 12 and all(r.removed == 0 and r.pct == 0.0 for r in report)
    assert quality.quality_summary(totals).first().retention_pct == 0.0


def test_report_text(spark):
    rows = [trip(fare_amount=5.0 + n / 10) for n in range(1200)] + [trip(fare_amount=-1.0)] * 34
    lines = [r.value for r in quality.report_lines(clean.rule_totals(frame(spark, rows))).orderBy("line_no").collect()]
    assert "- Rows read: 1,234" in lines
    assert any(line.startswith("| 03 |") and line.endswith("| 34 | 2.76% |") for line in lines)


@pytest.mark.parametrize("zone, unknown", [(264, 1), (265, 1), (263, 0)])
def test_unknown_zones_are_counted(spark, zone, unknown):
    row = clean.unknown_zone_counts(frame(spark, [trip(pu_location_id=zone)])).first()
    assert row.unknown_pickup == unknown and row.unknown_both == 0


def test_start_is_a_wednesday():
    assert START.strftime("%A") == "Wednesday"

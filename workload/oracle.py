"""SQL twins of the registered queries, for DuckDB over the same tables."""

from __future__ import annotations

from rideflow.operators.clean import DUPLICATES, FINAL, INITIAL, RULES
from workload import fixtures as fx

_HOLIDAY_ROWS = ", ".join(f"(DATE '{day}')" for day in fx.HOLIDAYS)

# First rule a row fails, in order; a condition that is not true fails.
_RULE_SQL = {
    "01_null_keys_removed": "pickup_ts IS NOT NULL AND dropoff_ts IS NOT NULL "
                            "AND pu_location_id IS NOT NULL AND do_location_id IS NOT NULL",
    "02_invalid_zones_removed": "pu_location_id BETWEEN 1 AND 263 AND do_location_id BETWEEN 1 AND 263",
    "03_non_positive_fare_removed": "fare_amount > 0",
    "04_absurd_fare_removed": "fare_amount <= 1000",
    "05_non_positive_distance_removed": "trip_distance_mi > 0",
    "06_absurd_distance_removed": "trip_distance_mi <= 200",
    "07_time_inversion_removed": "dropoff_ts > pickup_ts",
    "08_duration_anomalies_removed": "seconds BETWEEN 60 AND 21600",
    "10_impossible_speed_removed": "trip_distance_mi / (seconds / 3600.0) BETWEEN 0.5 AND 90",
    "11_out_of_period_removed": "{period}",
    "12_passenger_anomalies_removed": "passenger_count IS NULL OR passenger_count BETWEEN 1 AND 8",
}
_ALL_YEARS = "year(pickup_ts) BETWEEN 2022 AND 2024"
_TRIP = (
    "pickup_ts, dropoff_ts, pu_location_id, do_location_id, trip_distance_mi, fare_amount, tip_amount, "
    "total_amount, passenger_count, service_type"
)


def _failed(period: str = _ALL_YEARS) -> str:
    cases = " ".join(
        f"WHEN ({text.format(period=period)}) IS NOT TRUE THEN '{key}'" for key, text in _RULE_SQL.items()
    )
    return f"CASE {cases} END"


_SECONDS = "CAST(epoch(date_trunc('second', dropoff_ts)) - epoch(date_trunc('second', pickup_ts)) AS BIGINT)"
_UNSPLIT = (
    "l_orderkey % 3 AS service_no, "
    f"TIMESTAMP '{fx.FIRST_PICKUP}' + to_seconds(p) AS base_ts, "
    f"CASE WHEN l_partkey % 101 <> 0 THEN TIMESTAMP '{fx.FIRST_PICKUP}' + to_seconds(p) END AS pickup_ts, "
    f"TIMESTAMP '{fx.FIRST_PICKUP}' + to_seconds(p + d) AS dropoff_ts, "
    "(l_partkey * 7 + l_orderkey) % 266 AS pu_location_id, "
    "(l_partkey * 13 + l_linenumber * 29 + l_orderkey * 3) % 266 AS do_location_id, "
    "CASE WHEN l_partkey % 89 = 0 THEN NULL WHEN l_partkey % 50 = 0 THEN 0.0 "
    "WHEN l_partkey % 97 = 0 THEN 250.0 ELSE l_extendedprice / 2000 END::DOUBLE AS trip_distance_mi, "
    "l_extendedprice * l_discount / 10 AS fare_amount, l_quantity / 5 AS tip_amount, "
    "CASE WHEN l_orderkey % 3 = 2 THEN l_extendedprice * l_discount / 10 + l_tax * 10 + 0.0 "
    "+ (CASE WHEN l_partkey % 53 <> 0 THEN 0.0::DOUBLE END) + l_quantity / 5 "
    "ELSE l_extendedprice * l_discount / 10 + l_quantity / 5 + l_tax * 10 END AS total_amount, "
    "CASE WHEN l_orderkey % 3 <> 2 THEN CAST(CAST(l_quantity AS BIGINT) % 10 AS DOUBLE) END AS passenger_count, "
    "CASE l_orderkey % 3 WHEN 0 THEN 'yellow' WHEN 1 THEN 'green' ELSE 'fhvhv' END AS service_type"
)

_FEATURES = """
    round(seconds / 60.0, 2) AS trip_duration_min,
    round(trip_distance_mi / (seconds / 3600.0), 2) AS avg_speed_mph,
    CAST(hour(pickup_ts) AS INTEGER) AS pickup_hour,
    CAST(dayofweek(pickup_ts) + 1 AS INTEGER) AS pickup_dayofweek,
    CAST(month(pickup_ts) AS INTEGER) AS pickup_month,
    CAST(year(pickup_ts) AS INTEGER) AS pickup_year,
    CASE WHEN dayofweek(pickup_ts) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
    CASE WHEN hour(pickup_ts) >= 22 OR hour(pickup_ts) < 5 THEN 1 ELSE 0 END AS is_night,
    CASE WHEN pu_location_id IN (1, 132, 138) OR do_location_id IN (1, 132, 138) THEN 1 ELSE 0 END AS is_airport_trip,
    round(fare_amount / trip_distance_mi, 2) AS fare_per_mile
"""
_WEATHER = "weather_ts, temperature_c, precipitation_mm, rain_mm, wind_speed_kmh, humidity_pct, is_rainy"
_ZONED = (
    "pz.borough AS pu_borough, pz.zone AS pu_zone, pz.service_zone AS pu_service_zone, "
    "dz.borough AS do_borough, dz.zone AS do_zone, dz.service_zone AS do_service_zone"
)

PRELUDE = f"""
WITH li AS (
  SELECT *, (l_orderkey * 1299709 + l_partkey * 104729 + l_linenumber * 611953) % {fx.PICKUP_SPAN_SECONDS} AS p,
    (l_partkey * 7919 + l_suppkey * 17 + l_orderkey * 911) % 24000 - 300 AS d
  FROM lineitem
), doubled AS (SELECT * FROM li UNION ALL SELECT * FROM li WHERE l_orderkey % 37 = 0),
based AS (SELECT {_UNSPLIT} FROM doubled),
trips AS (SELECT {_TRIP} FROM based),
timed AS (SELECT *, {_SECONDS} AS seconds FROM trips),
filed AS (
  SELECT {_TRIP}, {_SECONDS} AS seconds,
    CAST(year(file_day) AS INTEGER) AS file_year, CAST(month(file_day) AS INTEGER) AS file_month
  FROM (SELECT *, CASE WHEN pu_location_id % 11 = 0 THEN base_ts + INTERVAL 1 MONTH ELSE base_ts END AS file_day
        FROM based)
),
judged AS (SELECT *, {_failed()} AS failed FROM timed),
clean AS (SELECT DISTINCT {_TRIP}, seconds FROM judged WHERE failed IS NULL),
zones AS (
  SELECT id, r_name AS borough, 'Zone_' || id AS zone,
    CASE WHEN id IN (1, 132, 138) THEN 'Airports' WHEN id % 2 = 0 THEN 'Yellow Zone' ELSE 'Boro Zone' END AS service_zone,
    40.5::DOUBLE + (id * 37 % 400) / 1000.0 AS lat, -74.25::DOUBLE + (id * 61 % 550) / 1000.0 AS lon
  FROM range(1, {fx.ZONE_COUNT + 1}) t(id) LEFT JOIN region ON r_regionkey = id % 5 WHERE id % 41 <> 0
),
order_hours AS (
  SELECT o_orderkey * 7919 % {fx.WEATHER_HOURS} AS h, CAST(sum(o_custkey) AS BIGINT) AS s FROM orders GROUP BY 1
),
weather AS (
  SELECT TIMESTAMP '{fx.FIRST_WEATHER}' + to_seconds(h * 3600) AS weather_ts,
    (s * 7 % 350) / 10.0::DOUBLE - 5 AS temperature_c, (s * 3 % 40) / 20.0::DOUBLE AS precipitation_mm,
    (s * 3 % 20) / 50.0::DOUBLE AS rain_mm, (s * 11 % 300) / 10.0::DOUBLE AS wind_speed_kmh,
    CAST(30 + s % 70 AS DOUBLE) AS humidity_pct,
    CASE WHEN (s * 3 % 20) / 50.0::DOUBLE > 0.1 THEN 1 ELSE 0 END AS is_rainy
  FROM order_hours WHERE h % 97 <> 0
),
holidays AS (SELECT day FROM (VALUES {_HOLIDAY_ROWS}) v(day)),
featured AS (SELECT {_TRIP}, {_FEATURES} FROM clean),
zoned AS (
  SELECT c.*, {_ZONED} FROM clean c LEFT JOIN zones pz ON pu_location_id = pz.id LEFT JOIN zones dz ON do_location_id = dz.id
),
processed AS (
  SELECT {_TRIP}, pu_borough, pu_zone, pu_service_zone, do_borough, do_zone, do_service_zone, {_WEATHER}, {_FEATURES}
  FROM zoned LEFT JOIN weather ON date_trunc('hour', pickup_ts) = weather_ts
),
placed AS (
  SELECT c.*, 2 * 3958.7613::DOUBLE * asin(sqrt(least(1.0::DOUBLE,
    pow(sin(radians(dz.lat - pz.lat) / 2), 2)
    + cos(radians(pz.lat)) * cos(radians(dz.lat)) * pow(sin(radians(dz.lon - pz.lon) / 2), 2)))) AS miles
  FROM processed c LEFT JOIN zones pz ON pu_location_id = pz.id LEFT JOIN zones dz ON do_location_id = dz.id
),
bounded AS (
  SELECT * FROM featured WHERE trip_distance_mi > 0.1 AND trip_distance_mi < 50 AND fare_amount BETWEEN 2.5 AND 150
    AND trip_duration_min BETWEEN 1 AND 120
),
train AS (SELECT * FROM bounded WHERE pickup_ts < TIMESTAMP '2024-01-01'),
test AS (SELECT * FROM bounded WHERE pickup_ts >= TIMESTAMP '2024-07-01'),
event_trips AS (SELECT ts AS pickup_time, user_id % 10 + 1 AS zone_id, value AS fare FROM events),
event_demand AS (
  SELECT zone_id, date_trunc('hour', pickup_time) AS hour_ts, count(*) AS trip_count FROM event_trips GROUP BY 1, 2
),
windows_5 AS (
  SELECT start AS window_start, start + INTERVAL 5 MINUTE AS window_end, zone_id AS "PULocationID",
    count(*) AS trip_count, round(avg(fare), 6) AS avg_fare
  FROM (SELECT date_trunc('minute', pickup_time) - to_minutes(unnest(generate_series(0, 4))) AS start, zone_id, fare FROM event_trips)
  GROUP BY 1, 2, 3
),
windows_10 AS (
  SELECT time_bucket(INTERVAL 10 MINUTE, pickup_time) AS window_start,
    time_bucket(INTERVAL 10 MINUTE, pickup_time) + INTERVAL 10 MINUTE AS window_end, zone_id AS "PULocationID",
    count(*) AS trip_count, round(avg(fare), 6) AS avg_fare
  FROM event_trips GROUP BY 1, 2, 3
),
rated AS (
  SELECT *, trip_count / forecast AS surge_ratio FROM windows_10 JOIN (
    SELECT "PULocationID" AS z, hour(window_start) AS h, dayofweek(window_start) AS w, avg(trip_count) AS forecast
    FROM windows_10 GROUP BY 1, 2, 3) f ON z = "PULocationID" AND h = hour(window_start) AND w = dayofweek(window_start)
),
alerts AS (
  SELECT before_start AS alert_start, window_end AS alert_end, "PULocationID",
    round(greatest(surge_ratio, before_ratio), 6) AS peak_ratio
  FROM (SELECT *, lag(window_start) OVER z AS before_start, lag(window_end) OVER z AS before_end, lag(surge_ratio) OVER z AS before_ratio
        FROM rated WHERE surge_ratio > 1.5 WINDOW z AS (PARTITION BY "PULocationID" ORDER BY window_start))
  WHERE before_end = window_start
),
event_hours AS (SELECT *, CAST(epoch(hour_ts) AS BIGINT) // 3600 AS hour_no FROM event_demand),
trip_hours AS (
  SELECT *, CAST(epoch(hour_ts) AS BIGINT) // 3600 AS hour_no FROM (
    SELECT pu_location_id AS zone_id, date_trunc('hour', pickup_ts) AS hour_ts, count(*) AS trip_count FROM clean GROUP BY 1, 2)
),
filled_hours AS (
  SELECT s.zone_id, s.hour_ts, coalesce(e.trip_count, 0) AS trip_count, CAST(epoch(s.hour_ts) AS BIGINT) // 3600 AS hour_no
  FROM (SELECT zone_id, unnest(generate_series(min(hour_ts), max(hour_ts), INTERVAL 1 HOUR)) AS hour_ts
        FROM event_demand GROUP BY zone_id) s
  LEFT JOIN event_demand e USING (zone_id, hour_ts)
)
"""


def _counters(source: str, failed: str) -> str:
    """All counters as one wide row ``c``."""
    rules = ", ".join(f"count(*) FILTER (failed = '{rule.key}') AS \"{rule.key}\"" for rule in RULES)
    return f"""judged_here AS (SELECT {_TRIP}, {failed} AS failed FROM {source}),
wide AS (SELECT count(*) AS "{INITIAL}", {rules},
  count(*) FILTER (failed IS NULL) - (SELECT count(*) FROM (SELECT DISTINCT {_TRIP} FROM judged_here WHERE failed IS NULL)) AS "{DUPLICATES}",
  (SELECT count(*) FROM (SELECT DISTINCT {_TRIP} FROM judged_here WHERE failed IS NULL)) AS "{FINAL}"
  FROM judged_here)"""


_WIDE = _counters("timed", _failed())
# The report's texts, spelled out here so that a wrong text in the report is found.
REPORTED = (
    ("01_null_keys_removed", "Missing keys", "a pickup or dropoff time or zone is absent"),
    ("02_invalid_zones_removed", "Zone out of range", "a zone id is not between 1 and 263"),
    ("03_non_positive_fare_removed", "Fare not positive", "void, refund or test entry"),
    ("04_absurd_fare_removed", "Fare too high", "more than 1000 dollars"),
    ("05_non_positive_distance_removed", "Distance not positive", "the vehicle did not move"),
    ("06_absurd_distance_removed", "Distance too long", "more than 200 miles"),
    ("07_time_inversion_removed", "Times inverted", "dropoff not after pickup"),
    ("08_duration_anomalies_removed", "Duration out of range", "under 60 seconds or over 6 hours"),
    ("10_impossible_speed_removed", "Speed out of range", "under 0.5 or over 90 miles per hour"),
    ("11_out_of_period_removed", "Outside the period", "pickup date not in the accepted period"),
    ("12_passenger_anomalies_removed", "Passenger count", "known and not between 1 and 8"),
    (DUPLICATES, "Duplicates", "equal to another row in every column"),
)
_KEYS = (INITIAL, *(rule.key for rule in RULES), DUPLICATES, FINAL)
_COUNTER_ROWS = " UNION ALL ".join(
    f"SELECT '{key}' AS rule, CAST(\"{key}\" AS BIGINT) AS rows FROM wide" for key in _KEYS
)
_REPORT_ROWS = " UNION ALL ".join(
    f"SELECT '{key[:2]}' AS rule, '{key}' AS key, '{title}' AS title, '{reason}' AS reason, "
    f"CAST(\"{key}\" AS BIGINT) AS removed, round(CASE WHEN \"{INITIAL}\" > 0 THEN \"{key}\"::DOUBLE / \"{INITIAL}\" * 100 ELSE 0 END, 6) AS pct FROM wide"
    for key, title, reason in REPORTED
)
_REPORT_HEAD = [
    "'# Data quality report'", "''",
    f"'- Rows read: ' || format('{{:,}}', \"{INITIAL}\")",
    f"'- Rows kept: ' || format('{{:,}}', \"{FINAL}\")",
    f"'- Rows removed: ' || format('{{:,}}', \"{INITIAL}\" - \"{FINAL}\")",
    f"'- Retention: ' || printf('%.2f', \"{FINAL}\"::DOUBLE / \"{INITIAL}\" * 100) || '%'",
    "''", "'| Rule | Title | Reason | Removed | Percent |'", "'|---|---|---|---|---|'",
]
_REPORT_BODY = [
    f"'| {key[:2]} | {title} | {reason} | ' || format('{{:,}}', \"{key}\") || ' | ' "
    f"|| printf('%.2f', \"{key}\"::DOUBLE / \"{INITIAL}\" * 100) || '% |'"
    for key, title, reason in REPORTED
]
_REPORT_LINES = " UNION ALL ".join(
    f"SELECT CAST({n} AS INTEGER) AS line_no, {text} AS value FROM wide"
    for n, text in enumerate(_REPORT_HEAD + _REPORT_BODY)
)


# Where a trip falls in the split by hash of its times and zones.
_KEYED = """('0x' || substr(md5('42|' || strftime(pickup_ts, '%Y-%m-%d %H:%M:%S') || '|' || strftime(dropoff_ts, '%Y-%m-%d %H:%M:%S')
        || '|' || pu_location_id || '|' || do_location_id), 1, 8))::BIGINT % 1000000"""


def _metered_feed(service: str) -> str:
    return f"SELECT {_TRIP} FROM trips WHERE service_type = '{service}'"


def _lag(n: int) -> str:
    return f"max(trip_count) OVER (PARTITION BY zone_id ORDER BY hour_no RANGE BETWEEN {n} PRECEDING AND {n} PRECEDING) AS lag_{n}h"


def _mean(n: int) -> str:
    return f"round(avg(trip_count) OVER (PARTITION BY zone_id ORDER BY hour_no RANGE BETWEEN {n} PRECEDING AND 1 PRECEDING), 6) AS rolling_mean_{n}h"


_FARE_RATE = "(SELECT sum(fare_amount) / sum(trip_distance_mi) FROM train)"
_SPEED = "(SELECT sum(trip_distance_mi) / (sum(trip_duration_min) / 60) FROM train)"
_SHARES = ", ".join(
    f"round(count(*) FILTER (hour(pickup_ts) = {h})::DOUBLE / count(*), 6) AS h{h:02d}" for h in range(24)
)


def _errors(label: str, prediction: str, task: str) -> str:
    e = f"({label} - {prediction})"
    return f"""SELECT service_type, count(*) AS rows, round(sqrt(avg({e} * {e})), 6) AS rmse, round(avg(abs({e})), 6) AS mae,
      round(1 - sum({e} * {e}) / (var_pop({label}) * count(*)), 6) AS r2, round(avg(abs({e}) / abs({label})) * 100, 6) AS mape,
      '{task}' AS task FROM scored GROUP BY service_type"""


BODIES: dict[str, str] = {
    "unify_yellow": _metered_feed("yellow"),
    "unify_green": _metered_feed("green"),
    "unify_fhvhv": _metered_feed("fhvhv"),
    "unify_all": f"SELECT {_TRIP} FROM trips",
    "clean_rule_counts": f", {_WIDE} {_COUNTER_ROWS}",
    "clean_trips": f"SELECT {_TRIP} FROM clean",
    "clean_target_month": f"SELECT DISTINCT {_TRIP} FROM timed WHERE ({_failed('year(pickup_ts) = 2024 AND month(pickup_ts) = 1')}) IS NULL",
    "clean_file_month": f"SELECT DISTINCT {_TRIP} FROM filed WHERE ({_failed('year(pickup_ts) = file_year AND month(pickup_ts) = file_month')}) IS NULL",
    "file_month_rule_counts": f", {_counters('filed', _failed('year(pickup_ts) = file_year AND month(pickup_ts) = file_month'))} {_COUNTER_ROWS}",
    "quality_report": f", {_WIDE} {_REPORT_ROWS}",
    "quality_summary": f', {_WIDE} SELECT "{INITIAL}" AS rows_in, "{FINAL}" AS rows_kept, "{INITIAL}" - "{FINAL}" AS rows_removed, '
                       f'round("{FINAL}"::DOUBLE / "{INITIAL}" * 100, 6) AS retention_pct FROM wide',
    "quality_report_lines": f", {_WIDE} {_REPORT_LINES}",
    "unknown_zone_counts": """SELECT count(*) FILTER (pu_location_id IN (264, 265)) AS unknown_pickup,
        count(*) FILTER (do_location_id IN (264, 265)) AS unknown_dropoff,
        count(*) FILTER (pu_location_id IN (264, 265) AND do_location_id IN (264, 265)) AS unknown_both,
        count(*) AS trips FROM trips""",
    "dedup_trips": f"SELECT DISTINCT {_TRIP} FROM trips",
    "zone_enrich": "SELECT * EXCLUDE (seconds) FROM zoned",
    "weather_unpack": f"SELECT {_WEATHER} FROM weather",
    "weather_enrich": f"SELECT {_TRIP}, {_WEATHER} FROM clean LEFT JOIN weather ON date_trunc('hour', pickup_ts) = weather_ts",
    "weather_match_rate": """SELECT count(*) AS trips, count(*) FILTER (weather_ts IS NULL) AS unmatched,
        round(count(*) FILTER (weather_ts IS NULL) * 100.0::DOUBLE / count(*), 6) AS unmatched_pct FROM processed""",
    "centroid_distance": f"SELECT {_TRIP}, round(miles, 6) AS centroid_distance_mi FROM placed",
    "holiday_flag": f"""SELECT {_TRIP}, strftime(pickup_ts, '%Y-%m-%d') AS pickup_date,
        CASE WHEN day IS NOT NULL THEN 1 ELSE 0 END AS is_holiday
        FROM clean LEFT JOIN holidays ON CAST(pickup_ts AS DATE) = day""",
    "trip_features": "SELECT * FROM featured",
    "processed_trips": "SELECT * FROM processed",
    "processed_roundtrip": "SELECT * FROM processed",
    "feature_null_check": "SELECT count(*) AS row_count, " + ", ".join(
        f"count(*) FILTER ({c} IS NULL) AS null_{c}"
        for c in ("trip_duration_min", "avg_speed_mph", "pickup_hour", "pu_borough", "temperature_c", "fare_per_mile")
    ) + " FROM processed",
    "booking_time_features": """SELECT pu_location_id, do_location_id, round(miles, 6) AS centroid_distance_mi, pickup_ts,
        pickup_hour, pickup_dayofweek, pickup_month, pickup_year, is_weekend, is_night, is_airport_trip,
        CASE WHEN day IS NOT NULL THEN 1 ELSE 0 END AS is_holiday, temperature_c, precipitation_mm, rain_mm,
        wind_speed_kmh, humidity_pct, is_rainy, passenger_count, service_type, pu_borough, do_borough, fare_amount
        FROM placed LEFT JOIN holidays ON CAST(pickup_ts AS DATE) = day""",
    "trips_by_borough": "SELECT pu_borough, count(*) AS trips, round(avg(fare_amount), 6) AS avg_fare FROM zoned GROUP BY 1",
    "trips_by_hour": "SELECT CAST(hour(pickup_ts) AS INTEGER) AS pickup_hour, count(*) AS trips FROM clean GROUP BY 1",
    "fare_by_service": "SELECT service_type, count(*) AS trips, round(avg(fare_amount), 6) AS avg_fare FROM clean GROUP BY 1",
    "top_pickup_zones": "SELECT pu_location_id, count(*) AS trips FROM clean GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
    "rain_effect": """SELECT is_rainy, count(*) AS hours, CAST(sum(trips) AS BIGINT) AS trips, round(avg(trips), 6) AS avg_trips
        FROM (SELECT date_trunc('hour', pickup_ts) AS hour_ts, count(*) AS trips FROM clean GROUP BY 1)
        LEFT JOIN weather ON hour_ts = weather_ts GROUP BY 1""",
    "zone_hour_trips": "SELECT pu_location_id, CAST(hour(pickup_ts) AS INTEGER) AS pickup_hour, count(*) AS trips FROM clean GROUP BY 1, 2",
    "demand_table": """SELECT zone_id, hour_ts, trip_count, strftime(hour_ts, '%Y-%m-%d') AS date, CAST(hour(hour_ts) AS INTEGER) AS hour,
        CAST(dayofweek(hour_ts) + 1 AS INTEGER) AS dayofweek, CASE WHEN dayofweek(hour_ts) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
        temperature_c, precipitation_mm, rain_mm, wind_speed_kmh, humidity_pct, is_rainy,
        CASE WHEN day IS NOT NULL THEN 1 ELSE 0 END AS is_holiday, borough
        FROM (SELECT pu_location_id AS zone_id, date_trunc('hour', pickup_ts) AS hour_ts, count(*) AS trip_count FROM clean GROUP BY 1, 2)
        LEFT JOIN weather ON hour_ts = weather_ts LEFT JOIN holidays ON CAST(hour_ts AS DATE) = day LEFT JOIN zones ON zone_id = id""",
    "demand_lags": f"SELECT zone_id, hour_ts, trip_count, {_lag(1)}, {_lag(2)}, {_lag(24)}, {_lag(168)} FROM event_hours",
    "demand_rolling": f"SELECT zone_id, hour_ts, trip_count, {_mean(3)}, {_mean(24)}, {_mean(168)} FROM event_hours",
    "demand_rolling_filled": f"SELECT zone_id, hour_ts, trip_count, {_lag(24)}, {_mean(3)}, {_mean(24)}, {_mean(168)} FROM filled_hours",
    "next_hour_inputs": f""", following AS (SELECT max(hour_ts) + INTERVAL 1 HOUR AS next_ts FROM event_demand),
        firsts AS (SELECT zone_id, min(hour_ts) AS first_ts FROM event_demand GROUP BY 1),
        reached AS (SELECT zone_id, next_ts AS hour_ts, CAST((epoch(next_ts) - epoch(first_ts)) // 3600 AS BIGINT) AS known FROM firsts, following),
        passed AS (SELECT r.zone_id, r.hour_ts, known, trip_count, CAST((epoch(r.hour_ts) - epoch(d.hour_ts)) // 3600 AS BIGINT) AS ago
          FROM reached r JOIN event_demand d USING (zone_id))
        SELECT zone_id, hour_ts, {", ".join(
            f"CASE WHEN known >= {n} THEN CAST(coalesce(sum(trip_count) FILTER (ago = {n}), 0) AS BIGINT) END AS lag_{n}h" for n in (1, 2, 24, 168))},
        {", ".join(
            f"round(coalesce(sum(trip_count) FILTER (ago BETWEEN 1 AND {n}), 0) / least({n}, known)::DOUBLE, 6) AS rolling_mean_{n}h" for n in (3, 24, 168))}
        FROM passed GROUP BY zone_id, hour_ts, known""",
    "busiest_zones_by_hour": """SELECT zone_id, pickup_hour, trips, CAST(rank AS INTEGER) AS rank FROM (
        SELECT pu_location_id AS zone_id, CAST(hour(pickup_ts) AS INTEGER) AS pickup_hour, count(*) AS trips,
        row_number() OVER (PARTITION BY hour(pickup_ts) ORDER BY count(*) DESC, pu_location_id) AS rank
        FROM clean GROUP BY 1, 2, hour(pickup_ts)) WHERE rank <= 3""",
    "demand_feature_table": f"""SELECT zone_id, hour_ts, trip_count, borough, CASE WHEN day IS NOT NULL THEN 1 ELSE 0 END AS is_holiday,
        {_lag(1)}, {_lag(2)}, {_lag(24)}, {_lag(168)}, {_mean(3)}, {_mean(24)}, {_mean(168)}
        FROM trip_hours LEFT JOIN zones ON zone_id = id LEFT JOIN holidays ON CAST(hour_ts AS DATE) = day""",
    "feature_tables": """SELECT 'demand' AS "table", (SELECT count(*) FROM trip_hours) AS "rows", CAST(0 AS BIGINT) AS nulls
        UNION ALL SELECT 'trips', (SELECT count(*) FROM clean), 0""",
    "zone_profile": f"SELECT pu_location_id AS zone_id, count(*) AS trips, {_SHARES} FROM clean GROUP BY 1",
    "keyed_samples": f"""SELECT count(*) FILTER ({_KEYED} < 50000) AS small, count(*) FILTER ({_KEYED} < 200000) AS large,
        count(*) FILTER ({_KEYED} < 50000) AS in_both FROM clean""",
    "fare_band_elbow": """, bands AS (SELECT k, floor((l_quantity::BIGINT - 1) * k / 50) AS band, l_quantity::BIGINT AS q FROM lineitem, range(1, 9) AS r(k)),
        costs AS (SELECT k::INTEGER AS k, round(sum(cost), 3) AS cost FROM (SELECT k, sum(q * q) - sum(q) * sum(q)::DOUBLE / count(*) AS cost FROM bands GROUP BY k, band) GROUP BY k),
        bent AS (SELECT k, cost, ((SELECT cost FROM costs WHERE k = 1) - cost) / ((SELECT cost FROM costs WHERE k = 1) - (SELECT cost FROM costs WHERE k = 8)) - (k - 1) / 7.0::DOUBLE AS bend FROM costs)
        SELECT k, cost, round(bend, 6) + 0.0 AS bend, k = (SELECT k FROM bent ORDER BY bend DESC, k LIMIT 1) AS elbow FROM bent""",
    "random_split_counts": f"SELECT CASE WHEN {_KEYED} < 800000 THEN 'train' ELSE 'test' END AS part, count(*) AS trips FROM clean GROUP BY 1",
    "time_split_counts": """SELECT CASE WHEN pickup_ts < TIMESTAMP '2024-01-01' THEN 'train'
        WHEN pickup_ts < TIMESTAMP '2024-07-01' THEN 'validation' ELSE 'test' END AS part, count(*) AS trips FROM clean GROUP BY 1""",
    "assembled_inputs": """SELECT pickup_ts, pu_location_id, do_location_id, fare_amount, trip_distance_mi,
        round(ln(1 + trip_distance_mi), 6) AS log_distance,
        round(sin(2 * pi() * pickup_hour / 24.0), 6) + 0.0 AS sin_hour, round(cos(2 * pi() * pickup_hour / 24.0), 6) + 0.0 AS cos_hour,
        CAST(pickup_dayofweek IN (1, 7) AS DOUBLE) AS is_weekend,
        CAST(pickup_dayofweek BETWEEN 2 AND 6 AND (pickup_hour BETWEEN 7 AND 9 OR pickup_hour BETWEEN 16 AND 19) AS DOUBLE) AS is_rush_hour,
        CAST(pickup_hour >= 20 OR pickup_hour <= 6 AS DOUBLE) AS is_evening_night, CAST(is_airport_trip AS DOUBLE) AS is_airport,
        round(coalesce(p.f, g.f) + 1e-9, 6) AS pu_fare_mean, round(coalesce(d.f, g.f) + 1e-9, 6) AS do_fare_mean,
        round(coalesce(p.e, g.e) + 1e-9, 6) AS pu_eta_mean, round(coalesce(d.e, g.e) + 1e-9, 6) AS do_eta_mean
        FROM test
        LEFT JOIN (SELECT pu_location_id, avg(fare_amount) f, avg(trip_duration_min) e FROM train GROUP BY 1) p USING (pu_location_id)
        LEFT JOIN (SELECT do_location_id, avg(fare_amount) f, avg(trip_duration_min) e FROM train GROUP BY 1) d USING (do_location_id)
        JOIN (SELECT avg(fare_amount) f, avg(trip_duration_min) e FROM train) g ON true""",
    "model_test_rows": f"""SELECT date_trunc('month', pickup_ts) AS period, count(*) AS trips, round(sum(fare_amount), 2) AS fare_sum,
        round(sum(trip_duration_min), 2) AS minutes_sum FROM bounded WHERE {_KEYED} >= 800000 GROUP BY 1""",
    "target_encoding": """SELECT pickup_ts, pu_location_id, do_location_id, fare_amount, trip_duration_min,
        round(coalesce(p.f, g.f) + 1e-9, 6) AS pu_fare_mean, round(coalesce(d.f, g.f) + 1e-9, 6) AS do_fare_mean,
        round(coalesce(p.e, g.e) + 1e-9, 6) AS pu_eta_mean, round(coalesce(d.e, g.e) + 1e-9, 6) AS do_eta_mean
        FROM test
        LEFT JOIN (SELECT pu_location_id, avg(fare_amount) f, avg(trip_duration_min) e FROM train GROUP BY 1) p USING (pu_location_id)
        LEFT JOIN (SELECT do_location_id, avg(fare_amount) f, avg(trip_duration_min) e FROM train GROUP BY 1) d USING (do_location_id)
        JOIN (SELECT avg(fare_amount) f, avg(trip_duration_min) e FROM train) g ON true""",
    "target_encoding_leave_one_out": """SELECT pickup_ts, pu_location_id, do_location_id, fare_amount, trip_duration_min,
        round(coalesce((p.f - fare_amount) / nullif(p.n - 1, 0), g.f) + 1e-9, 6) AS pu_fare_mean,
        round(coalesce((d.f - fare_amount) / nullif(d.n - 1, 0), g.f) + 1e-9, 6) AS do_fare_mean,
        round(coalesce((p.e - trip_duration_min) / nullif(p.n - 1, 0), g.e) + 1e-9, 6) AS pu_eta_mean,
        round(coalesce((d.e - trip_duration_min) / nullif(d.n - 1, 0), g.e) + 1e-9, 6) AS do_eta_mean
        FROM train
        LEFT JOIN (SELECT pu_location_id, count(*) n, sum(fare_amount) f, sum(trip_duration_min) e FROM train GROUP BY 1) p USING (pu_location_id)
        LEFT JOIN (SELECT do_location_id, count(*) n, sum(fare_amount) f, sum(trip_duration_min) e FROM train GROUP BY 1) d USING (do_location_id)
        JOIN (SELECT avg(fare_amount) f, avg(trip_duration_min) e FROM train) g ON true""",
    "training_features": """SELECT pickup_ts, pu_location_id, do_location_id, fare_amount,
        round(sin(2 * pi() * pickup_hour / 24.0), 6) + 0.0 AS sin_hour, round(cos(2 * pi() * pickup_hour / 24.0), 6) + 0.0 AS cos_hour,
        round(ln(1 + trip_distance_mi), 6) AS log_distance, CAST(pickup_dayofweek IN (1, 7) AS DOUBLE) AS is_weekend,
        CAST(pickup_dayofweek BETWEEN 2 AND 6 AND (pickup_hour BETWEEN 7 AND 9 OR pickup_hour BETWEEN 16 AND 19) AS DOUBLE) AS is_rush_hour,
        CAST(pickup_hour >= 20 OR pickup_hour <= 6 AS DOUBLE) AS is_evening_night, CAST(is_airport_trip AS DOUBLE) AS is_airport
        FROM bounded""",
    "training_features_reference_calendar": """SELECT pickup_ts, pu_location_id, do_location_id,
        CAST(pickup_dayofweek IN (6, 7) AS DOUBLE) AS is_weekend,
        CAST(pickup_dayofweek < 6 AND (pickup_hour BETWEEN 7 AND 9 OR pickup_hour BETWEEN 16 AND 19) AS DOUBLE) AS is_rush_hour
        FROM bounded""",
    "baseline_demand": """SELECT zone_id, hour_ts, trip_count, round(b, 6) AS baseline_trips FROM event_demand e
        LEFT JOIN (SELECT zone_id AS z, hour(hour_ts) AS h, dayofweek(hour_ts) AS w, avg(trip_count) AS b FROM event_demand
          WHERE hour_ts < (SELECT CAST(max(ts) AS DATE) - INTERVAL 8 DAY FROM events) GROUP BY 1, 2, 3) t
        ON z = zone_id AND h = hour(hour_ts) AND w = dayofweek(hour_ts)""",
    "baseline_fare": f"""SELECT pickup_ts, pu_location_id, do_location_id, fare_amount,
        round(trip_distance_mi * {_FARE_RATE}, 6) AS baseline_fare FROM test""",
    "baseline_eta": f"""SELECT pickup_ts, pu_location_id, do_location_id, trip_duration_min,
        round(trip_distance_mi / {_SPEED} * 60, 6) AS baseline_minutes FROM test""",
    "regression_metrics": f""", scored AS (SELECT *, trip_distance_mi * {_FARE_RATE} AS fare_guess,
        trip_distance_mi / {_SPEED} * 60 AS eta_guess FROM test)
        {_errors('fare_amount', 'fare_guess', 'fare')} UNION ALL {_errors('trip_duration_min', 'eta_guess', 'eta')}""",
}

_SLIDING = "SELECT * FROM windows_5"
_SLIDING_ZONES = """SELECT window_start, window_end, "PULocationID", borough AS "Borough", zone AS "Zone", trip_count, avg_fare
    FROM windows_5 LEFT JOIN zones ON "PULocationID" = id"""
BODIES |= {
    "sliding_demand": _SLIDING,
    "sliding_demand_zones": _SLIDING_ZONES,
    "tumbling_demand": "SELECT * FROM windows_10",
    "live_trips_per_minute": """SELECT date_trunc('minute', pickup_time) AS window_start,
        date_trunc('minute', pickup_time) + INTERVAL 1 MINUTE AS window_end, count(*) AS trip_count FROM event_trips GROUP BY 1, 2""",
    "surge_ratio": """SELECT window_start, window_end, "PULocationID", trip_count, avg_fare, round(forecast, 6) AS forecast,
        round(surge_ratio, 6) AS surge_ratio FROM rated""",
    "surge_alerts": "SELECT * FROM alerts",
    "trip_events_json": """SELECT CAST(1 AS BIGINT) AS "VendorID", strftime(pickup_ts, '%Y-%m-%d %H:%M:%S.%f') AS tpep_pickup_datetime,
        strftime(dropoff_ts, '%Y-%m-%d %H:%M:%S.%f') AS tpep_dropoff_datetime, passenger_count, trip_distance_mi AS trip_distance,
        pu_location_id AS "PULocationID", do_location_id AS "DOLocationID", fare_amount,
        pickup_ts AS pickup_time, dropoff_ts AS dropoff_time FROM clean""",
    "replay_times": """SELECT pickup_ts, pu_location_id, do_location_id, fare_amount,
        make_timestamp(epoch_us(TIMESTAMP '2025-01-01') + CAST(floor((epoch_us(pickup_ts) - epoch_us((SELECT min(pickup_ts) FROM clean))) / 60.0) AS BIGINT)) AS event_ts
        FROM clean""",
    "stream_sliding_demand": _SLIDING,
    "stream_demand_zones": _SLIDING_ZONES,
    "stream_tumbling_demand": "SELECT * FROM windows_10",
    "stream_late_events": "SELECT * FROM windows_10",
    "stream_scored_windows": """SELECT hour_ts AS window_start, hour_ts + INTERVAL 1 HOUR AS window_end, zone_id AS "PULocationID", count(*) AS trip_count,
        round(avg(fare), 6) AS avg_fare FROM (SELECT date_trunc('hour', pickup_time) AS hour_ts, zone_id, fare FROM event_trips) GROUP BY 1, 2, 3""",
    "stream_model_health": """SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, count(*) AS predictions,
        count(*) FILTER (event_id % 40 > 0) AS finished,
        round(sqrt(avg(power(value - 2.5 - 3 * (event_id % 40 / 4.0), 2)) FILTER (event_id % 40 > 0)), 6) AS rmse,
        round(avg(abs(value - 2.5 - 3 * (event_id % 40 / 4.0))) FILTER (event_id % 40 > 0), 6) AS mae FROM events GROUP BY 1, 2""",
    "stream_forecast_windows": """, hours AS (SELECT date_trunc('hour', pickup_time) AS hour_ts, zone_id, count(*) AS trip_count, avg(fare) AS avg_fare
          FROM event_trips GROUP BY 1, 2),
        means AS (SELECT zone_id, hour(hour_ts) AS h, dayofweek(hour_ts) AS d, avg(trip_count) AS forecast FROM hours GROUP BY 1, 2, 3)
        SELECT hour_ts AS window_start, hour_ts + INTERVAL 1 HOUR AS window_end, zone_id AS "PULocationID", trip_count, round(avg_fare, 6) AS avg_fare,
        round(forecast, 6) AS forecast FROM hours JOIN means USING (zone_id) WHERE h = hour(hour_ts) AND d = dayofweek(hour_ts)""",
    "stream_surge_alerts": "SELECT * FROM alerts",
}

_FILED_WIDE = _counters(f"(SELECT *, {_SECONDS} AS seconds FROM based WHERE base_ts IS NOT NULL)", _failed())
BODIES |= {
    "ingest_files": """SELECT service_type AS service, CAST(year(base_ts) AS INTEGER) AS year, CAST(month(base_ts) AS INTEGER) AS month,
        service_type || '_tripdata_' || strftime(base_ts, '%Y-%m') || '.parquet' AS file, count(*) AS rows FROM based GROUP BY 1, 2, 3, 4""",
    "ingest_changes": """, filed_months AS (SELECT service_type AS service, CAST(year(base_ts) AS INTEGER) AS year, CAST(month(base_ts) AS INTEGER) AS month,
          count(*) AS n FROM based WHERE base_ts IS NOT NULL GROUP BY 1, 2, 3)
        SELECT service, year, month, CASE WHEN lost THEN 'gone' WHEN new THEN 'added' WHEN more THEN 'changed' ELSE 'same' END AS change,
          CASE WHEN NOT new THEN n END AS rows_before, CASE WHEN NOT lost THEN CASE WHEN more THEN 2 * n ELSE n END END AS rows
        FROM (SELECT *, (service, year, month) = ('yellow', 2022, 3) AS lost, (service, year, month) = ('green', 2023, 5) AS new,
          (service, year, month) = ('fhvhv', 2024, 2) AS more FROM filed_months)""",
    "stage_layout": f"SELECT {_TRIP} FROM based WHERE base_ts IS NOT NULL",
    "drift_read": f"""SELECT service_type, CAST(year(base_ts) AS INTEGER) AS file_year, CAST(month(base_ts) AS INTEGER) AS file_month,
        count(*) AS trips, CAST(sum(pu_location_id) AS BIGINT) AS pu_sum, CAST(sum(do_location_id) AS BIGINT) AS do_sum
        FROM based WHERE base_ts IS NOT NULL GROUP BY 1, 2, 3""",
    "skipped_months": """SELECT DISTINCT service_type AS service, CAST(year(base_ts) AS INTEGER) AS year, CAST(month(base_ts) AS INTEGER) AS month,
        'not asked for' AS reason FROM based WHERE year(base_ts) NOT IN (2022, 2023)
        UNION ALL SELECT 'yellow', 2023, 13, 'unreadable' UNION ALL SELECT 'green', NULL, NULL, 'not in a folder of a year and a month'""",
    "batch_job_incremental": """SELECT pickup_year, pickup_month, count(*) AS trips,
        (SELECT count(*) FROM processed WHERE pickup_year = 2024 AND pickup_month = 1) AS rebuilt_rows FROM processed GROUP BY 1, 2""",
    "batch_job": "SELECT * FROM processed",
    "batch_job_counts": f", {_FILED_WIDE} {_COUNTER_ROWS}",
    "month_csv": """SELECT pickup_year, pickup_month, pu_location_id, pickup_hour, fare_amount FROM featured
        WHERE pickup_year = 2024 AND pickup_month = 1""",
}

_VALIDATED = f""", fared AS (SELECT *, fare_amount - trip_distance_mi * {_FARE_RATE} AS residual, trip_distance_mi * {_FARE_RATE} AS guess
        FROM bounded LEFT JOIN weather ON date_trunc('hour', pickup_ts) = weather_ts),
    validated AS (SELECT * FROM fared WHERE pickup_ts >= TIMESTAMP '2024-01-01' AND pickup_ts < TIMESTAMP '2024-07-01')"""
_FIRST = "greatest(floor((count(*) + 1) * 0.04999999999999999), 1)"
_LAST = "least(ceil((count(*) + 1) * 0.95), count(*))"
# The ranks move outward to the next 4000th.
_BOUNDS = f"""count(*) AS "rows",
        list_sort(list(residual))[greatest(ceil(count(*) * (floor(({_FIRST} - 0.5) / count(*) * 4000) / 4000)), 1)::BIGINT] AS low,
        list_sort(list(residual))[ceil(count(*) * (ceil(({_LAST} - 0.5) / count(*) * 4000) / 4000))::BIGINT] AS high"""
_LINEAR = ("trip_distance_mi", "pickup_hour", "is_weekend", "is_airport_trip", "passenger_count")


def _gram(task: str, label: str) -> str:
    columns = ["1", *_LINEAR, label]
    whole = " AND ".join(f"{c} IS NOT NULL" for c in columns[1:])
    cell = "SELECT '{0}' AS task, '{1}' AS \"left\", '{2}' AS \"right\", count(*) AS \"rows\", round(avg({1}::DOUBLE * {2}::DOUBLE), 5) + 0.0 AS mean FROM train WHERE {3}"
    return " UNION ALL ".join(cell.format(task, a, b, whole) for i, a in enumerate(columns) for b in columns[i:])


def _line(task: str, label: str, baseline: str) -> str:
    """Measures of the baseline and of a line over the distance."""
    fit = f"(SELECT regr_intercept({label}, trip_distance_mi) FROM train) + trip_distance_mi * (SELECT regr_slope({label}, trip_distance_mi) FROM train)"
    one = "SELECT '{0}' AS task, '{1}' AS model, {2} AS y, {3} AS p FROM test"
    return one.format(task, "baseline", label, baseline) + " UNION ALL " + one.format(task, "linear", label, fit)


_LINES = f"""WITH guessed AS ({_line("fare", "fare_amount", f"trip_distance_mi * {_FARE_RATE}")} UNION ALL
      {_line("eta", "trip_duration_min", f"trip_distance_mi / {_SPEED} * 60")}),
    measured AS (SELECT task, model, count(*) AS "rows", sqrt(avg((y - p) * (y - p))) AS rmse, avg(abs(y - p)) AS mae,
      1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)) AS r2, avg(abs(y - p) / abs(y)) * 100 AS mape FROM guessed GROUP BY 1, 2)"""
BODIES |= {
    "residual_quantiles": f"""{_VALIDATED} SELECT pickup_hour, is_rainy, "rows", round(low, 6) + 0.0 AS low, round(high, 6) + 0.0 AS high
        FROM (SELECT pickup_hour, is_rainy, {_BOUNDS} FROM validated GROUP BY 1, 2)""",
    "residual_rank_check": f"""{_VALIDATED} SELECT pickup_hour, count(*) AS "rows", true AS within FROM validated GROUP BY 1""",
    "range_coverage": f"""{_VALIDATED}, grouped AS (SELECT pickup_hour, is_rainy, {_BOUNDS} FROM validated GROUP BY 1, 2 HAVING count(*) >= 20),
        whole AS (SELECT {_BOUNDS} FROM validated)
        SELECT CASE WHEN g.rows IS NULL THEN 1 ELSE 0 END AS level, count(*) AS "rows",
          count(*) FILTER (fare_amount BETWEEN guess + coalesce(g.low, w.low) AND guess + coalesce(g.high, w.high)) AS inside,
          round(avg(coalesce(g.high, w.high) - coalesce(g.low, w.low)), 4) AS mean_width
        FROM fared f LEFT JOIN grouped g ON f.pickup_hour = g.pickup_hour AND f.is_rainy = g.is_rainy CROSS JOIN whole w
        WHERE pickup_ts >= TIMESTAMP '2024-07-01' GROUP BY 1""",
    "baseline_residuals": f""", bands AS (SELECT floor((fare_amount - trip_distance_mi * {_FARE_RATE}) / 5) AS band, count(*) AS n FROM test GROUP BY 1)
        SELECT 'baseline' AS model, band * 5.0 AS low, band * 5.0 + 5.0 AS high, n AS "rows", round(n / (SELECT sum(n) FROM bands)::DOUBLE, 6) AS share FROM bands""",
    "baseline_error_by_zone": " UNION ALL ".join(
        f"""SELECT '{task}' AS task, pu_location_id, count(*) AS "rows", round(sqrt(avg(({y} - {p}) * ({y} - {p}))), 5) AS rmse,
        round(avg(abs({y} - {p})), 5) AS mae, round(avg({y} - {p}), 5) + 0.0 AS bias FROM test GROUP BY 2"""
        for task, y, p in (("fare", "fare_amount", f"trip_distance_mi * {_FARE_RATE}"), ("eta", "trip_duration_min", f"trip_distance_mi / {_SPEED} * 60"))
    ),
    "forward_fold_rows": """, folds AS (SELECT i::INTEGER AS fold, (DATE '2022-01-01' + (912 * (i + 1) // 5)::INTEGER) AS since,
          (DATE '2022-01-01' + (912 * (i + 2) // 5)::INTEGER) AS before FROM range(4) AS r(i))
        SELECT fold, part, count(*) AS trips, min(pickup_ts) AS "first", max(pickup_ts) AS "last" FROM (
          SELECT fold, 'train' AS part, pickup_ts FROM folds, clean WHERE pickup_ts >= TIMESTAMP '2022-01-01' AND pickup_ts < since
          UNION ALL SELECT fold, 'validation', pickup_ts FROM folds, clean WHERE pickup_ts >= since AND pickup_ts < before) GROUP BY 1, 2""",
    "tree_scoring_check": f"""SELECT date_trunc('month', pickup_ts) AS period, count(*) AS trips, 0 AS differing
        FROM bounded WHERE {_KEYED} >= 800000 GROUP BY 1""",
    "compacted_months": """SELECT CAST(year(pickup_ts) AS INTEGER) AS pickup_year, CAST(month(pickup_ts) AS INTEGER) AS pickup_month,
        count(*) AS "rows", true AS fewer, true AS in_band FROM clean GROUP BY 1, 2""",
    "quarantined_files": f"""SELECT service_type AS service, CAST(year(base_ts) AS INTEGER) AS year, CAST(month(base_ts) AS INTEGER) AS month,
        count(*) AS "rows", CASE WHEN (service_type, year(base_ts), month(base_ts)) IN ({fx.FOOTERLESS}, {fx.OVERWRITTEN}) THEN 1 ELSE 0 END AS quarantined
        FROM based WHERE base_ts IS NOT NULL GROUP BY 1, 2, 3, 5""",
    "quarantine_read": BODIES["drift_read"],
    "gram_sums": _gram("fare", "fare_amount") + " UNION ALL " + _gram("eta", "trip_duration_min"),
    "linear_comparison": f""", lines AS ({_LINES} SELECT m.*, b.rmse AS base FROM measured m JOIN measured b ON m.task = b.task AND b.model = 'baseline')
        SELECT task, model, "rows", round(rmse, 5) AS rmse, round(mae, 5) AS mae, round(r2, 5) AS r2, round(mape, 5) AS mape,
        round(base, 5) AS baseline_rmse, rmse < base AS beats_baseline FROM lines""",
}


def oracle() -> dict[str, str]:
    return {name: PRELUDE + body for name, body in BODIES.items()}

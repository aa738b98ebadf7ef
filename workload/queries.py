"""Every registered query: ``name(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta
from functools import partial, reduce
from typing import Any

from pyspark.ml import Estimator, Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rideflow.ml import clusters, intervals, models, normal, scoring, trees
from rideflow.ml import demand as demand_ml
from rideflow.ml.features import assembler, preparation, vector_names
from rideflow.operators import analysis, baselines, clean, demand, encoding, enrich, errors, features, quality, splits
from rideflow.operators.unify import FEEDS, unify, union_trips
from rideflow.plans.live import live_alerts, live_demand
from rideflow.plans.preprocess import Preprocessed, build_trips, processed_trips as balanced_trips
from rideflow.plans.features import FeatureTables, build_features
from rideflow.plans.training import SPLIT_KEYS, TASKS, Trained, TrainingData, train_models, training_data
from rideflow.session import materialize, new_folder
from rideflow.sinks import compact, tables
from rideflow.sources import ingest, quarantine
from rideflow.sources.manifest import ingest_manifest
from rideflow.sources.trips import NO_MONTH, NOT_ASKED, read_feeds, read_processed
from rideflow.streaming import alerts, forecasts, health, sinks, versions
from rideflow.streaming import demand as live
from rideflow.streaming.events import encode_trips, file_events, parse_events, replay_schedule
from workload import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register a query under the name of its function."""
    QUERIES[fn.__name__] = fn
    return fn


_kept: dict[tuple[str, str, str], Any] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, make: Callable[[], Any]) -> Any:
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _kept:
        _kept[key] = make()
    return _kept[key]


def rounded(df: DataFrame, *columns: str, digits: int = 6, nudge: float = 0.0) -> DataFrame:
    """Averages depend on the order of addition in the last digits; reports round them.

    Means of few values often end exactly half-way between two results. A nudge far below the
    last digit decides those alike in every engine.
    """
    return df.withColumns({c: F.round(F.col(c) + F.lit(nudge), digits) + F.lit(0.0) for c in columns})


NUDGE = 1e-9


def as_text(column: str) -> Column:
    return F.col(column).cast("string")


# Building blocks

def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_trips(fx.trips(spark, sf_dir))


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.hourly_weather(fx.weather_documents(spark, sf_dir))


def featured(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.add_trip_features(cleaned(spark, sf_dir))


def processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    zoned = enrich.join_zones(cleaned(spark, sf_dir), fx.zones(spark, sf_dir))
    return features.add_trip_features(enrich.join_weather(zoned, hourly(spark, sf_dir)))


def demand_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly demand of the ten event zones: dense enough for lags."""
    events = fx.table(spark, sf_dir, "events")
    trips = events.select(
        (F.col("user_id") % 10 + 1).alias("pu_location_id"), F.col("ts").cast("timestamp").alias("pickup_ts")
    )
    return demand.hourly_counts(trips)


def booking_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Processed trips with centroid distance and holiday flag."""
    return _booked(spark, sf_dir, processed(spark, sf_dir))


def _booked(spark: SparkSession, sf_dir: str, trips: DataFrame) -> DataFrame:
    placed = enrich.join_centroids(trips, fx.centroids(spark, sf_dir))
    dated = placed.withColumn("pickup_date", F.to_date("pickup_ts"))
    return enrich.flag_holidays(dated, fx.holidays(spark, sf_dir)).drop("pickup_date")


def bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.within_training_bounds(featured(spark, sf_dir))


# Unification

@query
def unify_yellow(spark, sf_dir):
    return unify(fx.raw_feed(spark, sf_dir, "yellow"), "yellow")


@query
def unify_green(spark, sf_dir):
    return unify(fx.raw_feed(spark, sf_dir, "green"), "green")


@query
def unify_fhvhv(spark, sf_dir):
    return unify(fx.raw_feed(spark, sf_dir, "fhvhv"), "fhvhv")


@query
def unify_all(spark, sf_dir):
    return union_trips([unify(fx.raw_feed(spark, sf_dir, s), s) for s in FEEDS], spark)


# Cleaning and quality

@query
def clean_rule_counts(spark, sf_dir):
    return clean.counter_rows(clean.rule_totals(fx.trips(spark, sf_dir)))


@query
def clean_trips(spark, sf_dir):
    return cleaned(spark, sf_dir)


@query
def clean_target_month(spark, sf_dir):
    return clean.clean_trips(fx.trips(spark, sf_dir), clean.Period(2024, 1))


@query
def clean_file_month(spark, sf_dir):
    return clean.clean_trips(fx.trips(spark, sf_dir, with_file_month=True), clean.FILE_MONTH)


@query
def file_month_rule_counts(spark, sf_dir):
    trips = fx.trips(spark, sf_dir, with_file_month=True)
    return clean.counter_rows(clean.rule_totals(trips, clean.FILE_MONTH))


@query
def quality_report(spark, sf_dir):
    return rounded(quality.quality_report(clean.rule_totals(fx.trips(spark, sf_dir))), "pct")


@query
def quality_summary(spark, sf_dir):
    return rounded(quality.quality_summary(clean.rule_totals(fx.trips(spark, sf_dir))), "retention_pct")


@query
def quality_report_lines(spark, sf_dir):
    return quality.report_lines(clean.rule_totals(fx.trips(spark, sf_dir)))


@query
def unknown_zone_counts(spark, sf_dir):
    return clean.unknown_zone_counts(fx.trips(spark, sf_dir))


@query
def dedup_trips(spark, sf_dir):
    return fx.trips(spark, sf_dir).dropDuplicates()


# Enrichment

@query
def zone_enrich(spark, sf_dir):
    return enrich.join_zones(cleaned(spark, sf_dir), fx.zones(spark, sf_dir))


@query
def weather_unpack(spark, sf_dir):
    return hourly(spark, sf_dir)


@query
def weather_enrich(spark, sf_dir):
    return enrich.join_weather(cleaned(spark, sf_dir), hourly(spark, sf_dir))


@query
def weather_match_rate(spark, sf_dir):
    joined = enrich.join_weather(cleaned(spark, sf_dir), hourly(spark, sf_dir))
    return rounded(enrich.weather_match_rate(joined), "unmatched_pct")


@query
def centroid_distance(spark, sf_dir):
    placed = enrich.join_centroids(cleaned(spark, sf_dir), fx.centroids(spark, sf_dir))
    return rounded(placed, "centroid_distance_mi")


@query
def holiday_flag(spark, sf_dir):
    dated = cleaned(spark, sf_dir).withColumn("pickup_date", F.to_date("pickup_ts"))
    flagged = enrich.flag_holidays(dated, fx.holidays(spark, sf_dir))
    return flagged.withColumn("pickup_date", as_text("pickup_date"))


# Features and the processed table

@query
def trip_features(spark, sf_dir):
    return featured(spark, sf_dir)


@query
def processed_trips(spark, sf_dir):
    return processed(spark, sf_dir)


@query
def processed_roundtrip(spark, sf_dir):
    """Balanced by month, written as partitioned Parquet, read back."""
    folder = new_folder(spark, "processed")
    months = {"pickup_year": F.year("pickup_ts"), "pickup_month": F.month("pickup_ts")}
    trips = tables.balance(cleaned(spark, sf_dir).withColumns(months), tables.TRIP_PARTITIONS)
    trips = enrich.join_zones(trips.drop(*tables.TRIP_PARTITIONS), fx.zones(spark, sf_dir))
    trips = features.add_trip_features(enrich.join_weather(trips, hourly(spark, sf_dir)))
    tables.write_partitioned(trips, folder)
    return read_processed(spark, folder)


@query
def feature_null_check(spark, sf_dir):
    required = ["trip_duration_min", "avg_speed_mph", "pickup_hour", "pu_borough", "temperature_c", "fare_per_mile"]
    return features.null_counts(processed(spark, sf_dir), required)


@query
def booking_time_features(spark, sf_dir):
    rows = features.booking_features(booking_rows(spark, sf_dir), "fare_amount")
    return rounded(rows, "centroid_distance_mi")


# Analysis

@query
def trips_by_borough(spark, sf_dir):
    zoned = enrich.join_pickup_zone(cleaned(spark, sf_dir), fx.zones(spark, sf_dir))
    return rounded(analysis.trips_by_borough(zoned), "avg_fare")


@query
def trips_by_hour(spark, sf_dir):
    return analysis.trips_by_hour(cleaned(spark, sf_dir))


@query
def fare_by_service(spark, sf_dir):
    return rounded(analysis.fare_by_service(cleaned(spark, sf_dir)), "avg_fare")


@query
def top_pickup_zones(spark, sf_dir):
    return analysis.top_pickup_zones(cleaned(spark, sf_dir))


@query
def rain_effect(spark, sf_dir):
    return rounded(analysis.rain_effect(cleaned(spark, sf_dir), hourly(spark, sf_dir)), "avg_trips")


@query
def zone_hour_trips(spark, sf_dir):
    return analysis.zone_hour_trips(cleaned(spark, sf_dir))


@query
def busiest_zones_by_hour(spark, sf_dir):
    """The three busiest pickup zones of each hour of the day."""
    counts = analysis.zone_hour_trips(cleaned(spark, sf_dir)).withColumnRenamed("pu_location_id", "zone_id")
    return analysis.rank_zones(counts, "trips", "pickup_hour", 3)


# Demand

@query
def demand_table(spark, sf_dir):
    table = demand.demand_table(
        cleaned(spark, sf_dir), fx.zones(spark, sf_dir), hourly(spark, sf_dir), fx.holidays(spark, sf_dir)
    )
    return table.withColumn("date", as_text("date"))


@query
def demand_lags(spark, sf_dir):
    return demand.add_history(demand_rows(spark, sf_dir)).select(
        "zone_id", "hour_ts", "trip_count", *(f"lag_{n}h" for n in demand.LAGS)
    )


@query
def demand_rolling(spark, sf_dir):
    means = [f"rolling_mean_{n}h" for n in demand.SPANS]
    rows = demand.add_history(demand_rows(spark, sf_dir))
    return rounded(rows.select("zone_id", "hour_ts", "trip_count", *means), *means)


@query
def demand_rolling_filled(spark, sf_dir):
    """History over every hour of a zone; hours without trips count 0."""
    means = [f"rolling_mean_{n}h" for n in demand.SPANS]
    rows = demand.add_history(demand.fill_hours(demand_rows(spark, sf_dir)))
    return rounded(rows.select("zone_id", "hour_ts", "trip_count", "lag_24h", *means), *means)


@query
def feature_tables(spark, sf_dir):
    """Row and NULL counts of the written demand and trip tables."""
    return _feature_tables(spark, sf_dir).checks


@query
def demand_feature_table(spark, sf_dir):
    """The demand table of the batch job with its history, read back from its monthly folders."""
    rows = _feature_tables(spark, sf_dir).demand
    means = [f"rolling_mean_{n}h" for n in demand.SPANS]
    lags = [f"lag_{n}h" for n in demand.LAGS]
    return rounded(rows.select("zone_id", "hour_ts", "trip_count", "borough", "is_holiday", *lags, *means), *means)


def _feature_tables(spark: SparkSession, sf_dir: str) -> FeatureTables:
    def build() -> FeatureTables:
        return build_features(
            processed(spark, sf_dir),
            fx.zones(spark, sf_dir),
            hourly(spark, sf_dir),
            fx.holidays(spark, sf_dir),
            fx.centroids(spark, sf_dir),
            new_folder(spark, "feature-tables"),
        )

    return _once(spark, sf_dir, "feature tables", build)


@query
def zone_profile(spark, sf_dir):
    shares = [f"h{h:02d}" for h in range(24)]
    return rounded(demand.zone_profiles(cleaned(spark, sf_dir)), *shares)


# Splits, encodings, baselines

@query
def time_split_counts(spark, sf_dir):
    part = splits.time_split_label().alias("part")
    return cleaned(spark, sf_dir).groupBy(part).agg(F.count(F.lit(1)).alias("trips"))


def _encoded(spark: SparkSession, sf_dir: str, leave_one_out: bool) -> DataFrame:
    rows = bounded(spark, sf_dir)
    train, _, test = splits.time_split(rows)
    means = encoding.zone_means(train)
    target = train if leave_one_out else test
    coded = encoding.encode_zones(target, means, leave_one_out)
    keys = ["pickup_ts", "pu_location_id", "do_location_id", "fare_amount", "trip_duration_min"]
    return rounded(coded.select(*keys, *encoding.ENCODED), *encoding.ENCODED, nudge=NUDGE)


@query
def target_encoding(spark, sf_dir):
    """Test trips with the zone means of the training trips."""
    return _encoded(spark, sf_dir, leave_one_out=False)


@query
def target_encoding_leave_one_out(spark, sf_dir):
    """Training trips with zone means that leave the trip itself out."""
    return _encoded(spark, sf_dir, leave_one_out=True)


@query
def training_features(spark, sf_dir):
    made = features.add_training_features(bounded(spark, sf_dir))
    real = ["sin_hour", "cos_hour", "log_distance"]
    flags = ["is_weekend", "is_rush_hour", "is_evening_night", "is_airport"]
    return rounded(made.select("pickup_ts", "pu_location_id", "do_location_id", "fare_amount", *real, *flags), *real)


@query
def training_features_reference_calendar(spark, sf_dir):
    made = features.add_training_features(bounded(spark, sf_dir), reference_calendar=True)
    return made.select("pickup_ts", "pu_location_id", "do_location_id", "is_weekend", "is_rush_hour")


@query
def baseline_demand(spark, sf_dir):
    """Expected trips for every hour, learned from the hours before the test days."""
    rows = demand.add_calendar(demand_rows(spark, sf_dir))
    train = rows.filter(F.col("hour_ts") < demand_test_from(spark, sf_dir))
    scored = baselines.apply_demand_baseline(rows, materialize(baselines.demand_baseline(train)))
    return rounded(scored.select("zone_id", "hour_ts", "trip_count", "baseline_trips"), "baseline_trips")


@query
def baseline_fare(spark, sf_dir):
    train, _, test = splits.time_split(bounded(spark, sf_dir))
    scored = baselines.fare_baseline(test, train)
    return rounded(scored.select("pickup_ts", "pu_location_id", "do_location_id", "fare_amount", "baseline_fare"), "baseline_fare")


@query
def baseline_eta(spark, sf_dir):
    train, _, test = splits.time_split(bounded(spark, sf_dir))
    scored = baselines.eta_baseline(test, train)
    return rounded(scored.select("pickup_ts", "pu_location_id", "do_location_id", "trip_duration_min", "baseline_minutes"), "baseline_minutes")


@query
def regression_metrics(spark, sf_dir):
    """Error of the fare and duration baselines per service, on the test trips."""
    train, _, test = splits.time_split(bounded(spark, sf_dir))
    tasks = {"fare": ("fare_amount", "baseline_fare"), "eta": ("trip_duration_min", "baseline_minutes")}
    measured = baselines.task_metrics(baselines.trip_baselines(test, train), tasks, ("service_type",))
    return rounded(measured, "rmse", "mae", "r2", "mape")


def _tested_baselines(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _, test = splits.time_split(bounded(spark, sf_dir))
    return baselines.trip_baselines(test, train)


BASELINE_TASKS = {"fare": ("fare_amount", "baseline_fare"), "eta": ("trip_duration_min", "baseline_minutes")}


@query
def baseline_residuals(spark, sf_dir):
    """Test trips per band of five dollars between fare and baseline."""
    return rounded(errors.residual_distribution(_tested_baselines(spark, sf_dir), "fare_amount", {"baseline": "baseline_fare"}), "share")


@query
def baseline_error_by_zone(spark, sf_dir):
    """Error and bias of both baselines per pickup zone, on the test trips; MAPE and R2 of single trips say little and are left out."""
    return rounded(errors.error_by_zone(_tested_baselines(spark, sf_dir), BASELINE_TASKS).drop("r2", "mape"), "rmse", "mae", "bias", digits=5)


FOLDS = splits.forward_bounds("2022-01-01", "2024-07-01", 4)


@query
def forward_fold_rows(spark, sf_dir):
    """Trips of the training and the validation part of each fold by growing time range; the test period is not read."""
    parts = []
    for number, bound in enumerate(FOLDS):
        for part, rows in zip((splits.TRAIN, splits.VALIDATION), splits.forward_split(_trip_table(spark, sf_dir), bound, "2022-01-01", month_columns=tables.TRIP_PARTITIONS)):
            counted = rows.agg(F.count(F.lit(1)).alias("trips"), F.min("pickup_ts").alias("first"), F.max("pickup_ts").alias("last"))
            parts.append(counted.select(F.lit(number).alias("fold"), F.lit(part).alias("part"), "trips", "first", "last"))
    return reduce(DataFrame.unionByName, parts)


def _weathered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips within the training bounds, with the weather of their hour."""
    return features.within_training_bounds(features.add_trip_features(enrich.join_weather(cleaned(spark, sf_dir), hourly(spark, sf_dir))))


def _baseline_parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Validation and test trips with the baselines of the training trips."""
    train, validation, test = splits.time_split(_weathered(spark, sf_dir))
    both = baselines.trip_baselines(validation.unionByName(test), train)
    return splits.time_split(both)[1:]


RANGE_KEYS = ("pickup_hour", "is_rainy")


def _baseline_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ("pu_location_id", "do_location_id", *RANGE_KEYS)
    return materialize(intervals.residual_sketches(_baseline_parts(spark, sf_dir)[0], "fare_amount", "baseline_fare", keys))


@query
def residual_quantiles(spark, sf_dir):
    """Bounds of the baseline fare's residuals by hour and rain, merged from the sketches of zone pairs; validation trips."""
    merged = intervals.merged(_baseline_sketches(spark, sf_dir), RANGE_KEYS)
    return rounded(intervals.bounds(merged).drop("sketch"), "low", "high")


@query
def residual_rank_check(spark, sf_dir):
    """Whether the quartiles of small sketches lie within their stated error, by counting the residuals up to them."""
    size, levels = 64, (0.25, 0.5, 0.75)
    scored = materialize(_baseline_parts(spark, sf_dir)[0].select("pickup_hour", "fare_amount", "baseline_fare"))
    sketches = intervals.residual_sketches(scored, "fare_amount", "baseline_fare", ("pickup_hour",), size)
    quartiles = materialize(sketches.select(
        F.col("pickup_hour").alias("_hour"), "rows", *(F.kll_sketch_get_quantile_double("sketch", F.lit(q)).alias(f"q{i}") for i, q in enumerate(levels))
    ))
    residual = F.col("fare_amount") - F.col("baseline_fare")
    counted = scored.join(F.broadcast(quartiles), F.col("pickup_hour") == F.col("_hour")).groupBy("pickup_hour", "rows").agg(
        *(F.count_if(residual <= F.col(f"q{i}")).alias(f"up_to_{i}") for i in range(len(levels)))
    )
    # Three quartiles of 24 hours: more of them than one in a hundred may lie beyond the error, but not beyond twice that.
    off = [F.abs(F.col(f"up_to_{i}") / F.col("rows") - q) <= 2 * intervals.rank_error(size) + 1 / F.col("rows") for i, q in enumerate(levels)]
    return counted.select("pickup_hour", "rows", reduce(lambda a, b: a & b, off).alias("within"))


@query
def range_coverage(spark, sf_dir):
    """Test trips whose fare lies in the 90 % range around the baseline, by the level of group that gave the range."""
    test, levels = _baseline_parts(spark, sf_dir)[1], (RANGE_KEYS, ())
    ranged = intervals.with_range(test, "baseline_fare", _baseline_sketches(spark, sf_dir), levels, least_rows=20)
    return rounded(intervals.range_coverage(ranged, "fare_amount", ("level",)), "mean_width", digits=4)


LINEAR_INPUTS = ("trip_distance_mi", "pickup_hour", "is_weekend", "is_airport_trip", "passenger_count")


@query
def gram_sums(spark, sf_dir):
    """Sums of products for the linear fare and duration models, over the training trips; as means, which round alike."""
    train = splits.time_split(bounded(spark, sf_dir))[0]
    made = [normal.gram(train, LINEAR_INPUTS, label).withColumn("task", F.lit(task)) for task, label in TASKS.items()]
    return rounded(reduce(DataFrame.unionByName, made).withColumn("mean", F.col("total") / F.col("rows")).drop("total"), "mean", digits=5)


@query
def linear_models(spark, sf_dir):
    """Coefficients of the linear fare and duration models."""
    train = splits.time_split(bounded(spark, sf_dir))[0]
    fits = {task: normal.fit(train, LINEAR_INPUTS, label) for task, label in TASKS.items()}
    rows = [(t, name, c) for t, m in fits.items() for name, c in zip(("intercept", *m.features), (m.intercept, *m.coefficients))]
    return spark.createDataFrame(rows, "task string, feature string, coefficient double")


@query
def linear_comparison(spark, sf_dir):
    """A line over the distance against the baseline, for fare and duration, on the test trips."""
    train, _, test = splits.time_split(bounded(spark, sf_dir))
    scored, out = baselines.trip_baselines(test, train), []
    for task, label in TASKS.items():
        line = normal.fit(train, ["trip_distance_mi"], label)
        guess = "baseline_fare" if task == "fare" else "baseline_minutes"
        out.append(models.evaluate(scored.withColumn("line", line.predicted()), task, label, {baselines.BASELINE: guess, "linear": "line"}))
    table = models.against_baseline(materialize(reduce(DataFrame.unionByName, out)))
    return rounded(table, "rmse", "mae", "r2", "mape", "baseline_rmse", digits=5)


# Event windows over a finished batch

#: The last days of the events test the demand model, the last one included.
DEMAND_TEST_DAYS = 9


def last_event(spark: SparkSession, sf_dir: str) -> datetime:
    return fx.table(spark, sf_dir, "events").agg(F.max(F.col("ts").cast("timestamp"))).first()[0]


def demand_test_from(spark: SparkSession, sf_dir: str) -> Column:
    first = last_event(spark, sf_dir).date() - timedelta(days=DEMAND_TEST_DAYS - 1)
    return F.lit(str(first)).cast("timestamp")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_events(fx.event_values(spark, sf_dir))


def window_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean trips per ten-minute window of a zone, hour and day of week."""
    start = F.col("window.start")
    return materialize(
        live.tumbling_demand(events(spark, sf_dir))
        .groupBy(F.col("PULocationID").alias("zone_id"), F.hour(start).alias("hour"), F.dayofweek(start).alias("dayofweek"))
        .agg(F.avg("trip_count").alias("forecast"))
    )


SURGE_THRESHOLD = 1.5


@query
def sliding_demand(spark, sf_dir):
    return rounded(live.flat_windows(live.sliding_demand_by_panes(events(spark, sf_dir))), "avg_fare")


@query
def sliding_demand_zones(spark, sf_dir):
    named = live.name_zones(live.sliding_demand_by_panes(events(spark, sf_dir)), fx.zones(spark, sf_dir))
    return rounded(named, "avg_fare")


@query
def tumbling_demand(spark, sf_dir):
    return rounded(live.flat_windows(live.tumbling_demand(events(spark, sf_dir))), "avg_fare")


@query
def live_trips_per_minute(spark, sf_dir):
    return live.flat_windows(live.trips_per_minute(events(spark, sf_dir)))


@query
def surge_ratio(spark, sf_dir):
    """Observed over forecast trips of each ten-minute window."""
    rated = live.join_forecast(live.tumbling_demand(events(spark, sf_dir)), window_forecast(spark, sf_dir))
    return rounded(live.flat_windows(rated), "avg_fare", "forecast", "surge_ratio")


@query
def surge_alerts(spark, sf_dir):
    rated = live.join_forecast(live.tumbling_demand(events(spark, sf_dir)), window_forecast(spark, sf_dir))
    return rounded(alerts.surge_alerts_batch(rated, SURGE_THRESHOLD), "peak_ratio")


@query
def trip_events_json(spark, sf_dir):
    """Cleaned trips encoded as events and parsed again."""
    return parse_events(encode_trips(cleaned(spark, sf_dir)))


@query
def replay_times(spark, sf_dir):
    scheduled = replay_schedule(cleaned(spark, sf_dir), "2025-01-01 00:00:00")
    return scheduled.select("pickup_ts", "pu_location_id", "do_location_id", "fare_amount", "event_ts")


# The same windows on a file stream, run until its input is used up

def _flush_times(spark: SparkSession, sf_dir: str, times: int) -> list[str]:
    """Days after the last event, one each; events of these times close all windows before them."""
    last = last_event(spark, sf_dir).date()
    return [f"{last + timedelta(days=2 + n)} 00:00:00" for n in range(times)]


def _updates(spark: SparkSession, stream: DataFrame, keys: list[str], delay: str, prepare=None) -> DataFrame:
    """All rows of an updating stream, through a table that is merged after every second micro-batch."""
    folder = new_folder(spark, "updates")
    table = versions.window_table(spark, f"{folder}/rows", keys, delay, merge_every=2)
    versions.to_table(stream, table, f"{folder}/checkpoint", drain=True, prepare=prepare).awaitTermination()
    return table.rows()


def _appends(spark: SparkSession, stream: DataFrame) -> DataFrame:
    out = new_folder(spark, "stream")
    sinks.to_parquet(stream, f"{out}/rows", f"{out}/checkpoint", drain=True).awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{out}/rows")


def _stream(spark: SparkSession, sf_dir: str, *flush_at: str) -> DataFrame:
    """The events as a stream of a file per micro-batch, the flushing events last."""
    return file_events(spark, fx.event_folder(spark, sf_dir, *flush_at), files_per_batch=1)


@query
def stream_sliding_demand(spark, sf_dir):
    """Update mode; the last version of each window."""
    windows = live.flat_windows(live.sliding_demand(parse_events(_stream(spark, sf_dir))))
    return rounded(_updates(spark, windows, ["window_start", "window_end", "PULocationID"], "10 minutes"), "avg_fare")


@query
def stream_demand_zones(spark, sf_dir):
    """The live demand job with zone names, in update mode."""
    named = live_demand(_stream(spark, sf_dir), fx.zones(spark, sf_dir))
    keys = ["window_start", "window_end", "PULocationID", "Borough", "Zone"]
    return rounded(_updates(spark, named, keys, "10 minutes"), "avg_fare")


@query
def stream_tumbling_demand(spark, sf_dir):
    """Append mode; a later event closes the last windows and is left out of the result."""
    flush = _flush_times(spark, sf_dir, 1)
    windows = live.flat_windows(live.tumbling_demand(parse_events(_stream(spark, sf_dir, *flush))))
    return rounded(_appends(spark, windows).filter("PULocationID <> 0"), "avg_fare")


@query
def stream_late_events(spark, sf_dir):
    """Events again after the watermark has passed them: they are dropped, the windows stay as they were."""
    flush = _flush_times(spark, sf_dir, 2)
    folder = fx.event_folder(spark, sf_dir, flush[0], repeat_first=True, flush_after=flush[1])
    windows = live.flat_windows(live.tumbling_demand(parse_events(file_events(spark, folder, files_per_batch=1))))
    return rounded(_appends(spark, windows).filter("PULocationID <> 0"), "avg_fare")


@query
def stream_surge_alerts(spark, sf_dir):
    """Two chained window aggregates in append mode."""
    forecast = window_forecast(spark, sf_dir)
    found = live_alerts(_stream(spark, sf_dir, *_flush_times(spark, sf_dir, 3)), forecast, SURGE_THRESHOLD)
    return rounded(_appends(spark, found).filter("PULocationID <> 0"), "peak_ratio")


@query
def stream_model_health(spark, sf_dir):
    """Hourly errors of a fare by distance, its trips joined as they finish; trips of no distance never report a fare."""
    flush = _flush_times(spark, sf_dir, 4)
    keys = ["VendorID", "PULocationID", "DOLocationID", "pickup_time"]
    priced = (F.lit(2.5) + F.lit(3.0) * F.col("trip_distance")).alias("predicted_fare")
    # The flushing events have no vendor and drop-off; a null key would keep them from the join and its watermark.
    folder = fx.event_folder(spark, sf_dir, *flush)
    trips = lambda: parse_events(file_events(spark, folder, files_per_batch=1)).na.fill(0, ["VendorID", "DOLocationID"])
    asked = trips().select(*keys, F.col("pickup_time").alias("predicted_at"), priced)
    ended = trips().filter("trip_distance > 0 OR trip_distance IS NULL")
    ended = ended.select(*keys, F.coalesce("dropoff_time", "pickup_time").alias("finished_at"), "fare_amount")
    windows = health.health_by_window(health.with_outcomes(asked, ended, keys, "1 hour"), "fare_amount", "predicted_fare")
    found = _appends(spark, windows).filter(F.col("window_start") < F.lit(flush[0]).cast("timestamp"))
    return rounded(found, "rmse", "mae")


# Ingest of monthly files

@query
def ingest_files(spark, sf_dir):
    """Rows of each monthly file, from the manifest."""
    manifest = ingest_manifest(spark, fx.download_folder(spark, sf_dir))
    return manifest.select("service", "year", "month", "file", "rows")


@query
def ingest_file_sizes(spark, sf_dir):
    """The whole manifest; sizes depend on the writer, so SQL has no twin."""
    return ingest_manifest(spark, fx.download_folder(spark, sf_dir))


@query
def ingest_changes(spark, sf_dir):
    """What the ingest table says of a lake that lost a month, got one, and got a file more in another."""
    lake, table = fx.changing_lake(spark, sf_dir), f"{new_folder(spark, 'ingest')}/files"
    ingest.refresh(spark, lake.folder, table)
    lake.change()
    return ingest.refresh(spark, lake.folder, table).months


@query
def stage_layout(spark, sf_dir):
    """Monthly files staged by folder, then read across drifting types and unified."""
    return read_feeds(spark, fx.staged_folder(spark, sf_dir)).trips


@query
def drift_read(spark, sf_dir):
    """Rows and zone-id sums per service and file month, over files whose types differ."""
    feeds = read_feeds(spark, fx.staged_folder(spark, sf_dir), with_file_month=True)
    return feeds.trips.groupBy("service_type", "file_year", "file_month").agg(
        F.count(F.lit(1)).alias("trips"), F.sum("pu_location_id").alias("pu_sum"), F.sum("do_location_id").alias("do_sum")
    )


@query
def skipped_months(spark, sf_dir):
    """What a read of two years leaves out, one unreadable month and files outside the layout included."""
    folder = fx.broken_folder(spark, sf_dir)
    found = read_feeds(spark, folder, years=(2022, 2023), skip_unreadable=True).skipped
    known = F.col("reason").isin(NOT_ASKED, NO_MONTH)
    return found.withColumn("reason", F.when(known, F.col("reason")).otherwise("unreadable"))


@query
def quarantined_files(spark, sf_dir):
    """Sound and quarantined files' rows per month, of a lake with a file without footer and one of overwritten pages."""
    probed = quarantine.probe_lake(spark, fx.damaged_lake(spark, sf_dir))
    months = ["service", "year", "month"]
    sound = probed.sound.groupBy(*months).agg(F.sum("rows").alias("rows"))
    broken = probed.quarantined.groupBy(*months).agg(F.count(F.lit(1)).alias("quarantined"))
    return sound.join(broken, months, "full").withColumn("quarantined", F.coalesce("quarantined", F.lit(0)))


@query
def quarantine_read(spark, sf_dir):
    """Trips and zone-id sums per service and file month, read from the sound files of the same lake."""
    trips = quarantine.probe_lake(spark, fx.damaged_lake(spark, sf_dir)).trips()
    return trips.groupBy("service_type", "file_year", "file_month").agg(
        F.count(F.lit(1)).alias("trips"), F.sum("pu_location_id").alias("pu_sum"), F.sum("do_location_id").alias("do_sum")
    )


COMPACT_BYTES = 128 * 1024


@query
def compacted_months(spark, sf_dir):
    """Trips per month of a table filled by five appends and then compacted, and whether its files are fewer and in the band."""
    path = f"{new_folder(spark, 'appended')}/trips"
    months = {"pickup_year": F.year("pickup_ts"), "pickup_month": F.month("pickup_ts")}
    trips = materialize(cleaned(spark, sf_dir).withColumns(months))
    for part in range(5):
        share = trips.filter(F.pmod(F.xxhash64("pickup_ts", "pu_location_id", "do_location_id"), F.lit(5)) == part)
        tables.write_partitioned(tables.balance(share, tables.TRIP_PARTITIONS), path, mode="append")
    before = compact.compact_months(spark, path, COMPACT_BYTES)
    keys = list(tables.TRIP_PARTITIONS)
    low, high = (F.lit(COMPACT_BYTES * share) for share in compact.BAND)
    files = materialize(compact.table_files(spark, path)).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("after"), F.count_if(F.col("bytes").between(low, high)).alias("within"), F.sum("rows").alias("rows"), F.max("bytes").alias("largest")
    )
    one_small = (F.col("after") == 1) & (F.col("largest") <= high)
    both = files.join(before.select(*keys, "files"), keys)
    return both.select(*keys, "rows", (F.col("after") < F.col("files")).alias("fewer"), (one_small | (F.col("within") >= F.col("after") - 1)).alias("in_band"))


@query
def batch_job_incremental(spark, sf_dir):
    """Trips per month after the whole job and a second run for one month into the same table."""
    reference, out = fx.reference_folder(spark, sf_dir), new_folder(spark, "batch")
    paths = (fx.staged_folder(spark, sf_dir), f"{reference}/zones", f"{reference}/weather", f"{out}/trips")
    build_trips(spark, *paths)
    again = build_trips(spark, *paths, period=clean.Period(2024, 1), dynamic=True)
    counted = again.trips.groupBy("pickup_year", "pickup_month").agg(F.count(F.lit(1)).alias("trips"))
    return counted.withColumn("rebuilt_rows", again.totals.select(clean.FINAL).scalar())


@query
def batch_job(spark, sf_dir):
    """The preprocessing job from monthly files to processed trips."""
    return _batch(spark, sf_dir).trips


@query
def batch_job_counts(spark, sf_dir):
    """The counters of the preprocessing job; duplicates come from the written rows."""
    return clean.counter_rows(_batch(spark, sf_dir).totals)


def _batch(spark: SparkSession, sf_dir: str) -> Preprocessed:
    reference, out = fx.reference_folder(spark, sf_dir), new_folder(spark, "batch")
    return build_trips(
        spark, fx.staged_folder(spark, sf_dir), f"{reference}/zones", f"{reference}/weather", f"{out}/trips", f"{out}/report"
    )


@query
def month_csv(spark, sf_dir):
    """One month of processed trips exported as CSV and read back."""
    folder = new_folder(spark, "csv")
    trips = featured(spark, sf_dir).select("pickup_year", "pickup_month", "pu_location_id", "pickup_hour", "fare_amount")
    tables.export_month(trips, folder, 2024, 1)
    return spark.read.schema(trips.schema).option("header", True).csv(folder)


# Models

def _model_size(spark: SparkSession, rounds: int = 5, depth: int = 5) -> dict[str, int]:
    """Rounds and depth of a registered model, from the session's ``rideflow.models.rounds`` and ``.depth``.

    The small defaults let a check of all queries end within minutes; the library's own are 100 and 10.
    """
    return {
        "iterations": int(spark.conf.get("rideflow.models.rounds", str(rounds))),
        "depth": int(spark.conf.get("rideflow.models.depth", str(depth))),
    }


def _trees(spark: SparkSession, trees: int) -> int:
    """Trees of a registered forest, from the session's ``rideflow.models.trees``."""
    return int(spark.conf.get("rideflow.models.trees", str(trees)))


def _compared(spark: SparkSession, label: str) -> dict[str, Estimator]:
    """The algorithms of ``model_comparison``."""
    return models.algorithms(label, trees=_trees(spark, 5), **_model_size(spark, 3, 4))


def _tuning_grid(spark: SparkSession) -> list[dict[str, int]]:
    """Forests of the set size, of two levels less and of half the trees."""
    depth, trees = _model_size(spark)["depth"], _trees(spark, 6)
    return [{"maxDepth": d, "numTrees": t} for d in (max(1, depth - 2), depth) for t in (max(1, trees // 2), trees)]


def _trip_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Processed trips with booking-time columns, written by month: models are trained on tables, not on raw feeds.

    The trips are balanced by month before the joins widen them.
    """

    def write() -> str:
        folder = new_folder(spark, "features")
        trips = balanced_trips(fx.trips(spark, sf_dir), fx.zones(spark, sf_dir), hourly(spark, sf_dir))
        tables.write_partitioned(_booked(spark, sf_dir, trips), folder)
        return folder

    return read_processed(spark, _once(spark, sf_dir, "table", write))


@query
def random_split_counts(spark, sf_dir):
    """Trips in each part of the split by hash of the trip."""
    train, test = splits.keyed_split(_trip_table(spark, sf_dir), SPLIT_KEYS)
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return both.groupBy("part").agg(F.count(F.lit(1)).alias("trips"))


@query
def keyed_samples(spark, sf_dir):
    """Trips in samples of 5 and 20 % by key, and how many of the smaller are in the larger."""
    trips = cleaned(spark, sf_dir)
    small, large = (splits.keyed_sample(trips.repartition(n), SPLIT_KEYS, rate) for n, rate in ((3, 0.05), (7, 0.2)))
    both = small.withColumns({"small": F.lit(1), "large": F.lit(0)}).unionByName(large.withColumns({"small": F.lit(0), "large": F.lit(1)}))
    sides = both.groupBy(*SPLIT_KEYS).agg(F.sum("small").alias("small"), F.sum("large").alias("large"))
    return sides.agg(F.sum("small").alias("small"), F.sum("large").alias("large"), F.sum(F.least("small", "large")).alias("in_both"))


@query
def fare_band_elbow(spark, sf_dir):
    """Squared deviation of order quantities within 1 to 8 bands of equal width, and where it bends."""
    items = fx.table(spark, sf_dir, "lineitem").groupBy(F.col("l_quantity").cast("long").alias("q")).agg(F.count(F.lit(1)).alias("n"))
    banded = items.withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(8)))).withColumn("band", F.floor((F.col("q") - 1) * F.col("k") / 50))
    inside = banded.groupBy("k", "band").agg((F.sum(F.col("n") * F.col("q") * F.col("q")) - F.sum(F.col("n") * F.col("q")) * F.sum(F.col("n") * F.col("q")) / F.sum("n")).alias("cost"))
    costs = materialize(inside.groupBy("k").agg(F.round(F.sum("cost"), 3).alias("cost")))
    return rounded(clusters.with_elbow(costs), "bend")


@query
def assembled_inputs(spark, sf_dir):
    """The input vector of the trip models for the test period, slot by slot; the zone means are of the training period."""
    parts = lambda rows: _time_parts(rows)[::2]
    data = training_data(_trip_table(spark, sf_dir), split=parts)
    slots = vector_to_array("features")
    keys = ["pickup_ts", "pu_location_id", "do_location_id", "fare_amount"]
    made = data.test.select(*keys, *(slots[i].alias(name) for i, name in enumerate(data.features)))
    return rounded(rounded(made, "log_distance", "sin_hour", "cos_hour"), *encoding.ENCODED, nudge=NUDGE)


@query
def model_test_rows(spark, sf_dir):
    """Trips and label sums per month of the part that tests the trip models."""
    test = training_data(_trip_table(spark, sf_dir)).test
    month = F.date_trunc("month", "pickup_ts").alias("period")
    return test.groupBy(month).agg(
        F.count(F.lit(1)).alias("trips"),
        F.round(F.sum("fare_amount"), 2).alias("fare_sum"),
        F.round(F.sum("trip_duration_min"), 2).alias("minutes_sum"),
    )


def _trip_models(spark: SparkSession, sf_dir: str) -> Trained:
    size = _model_size(spark)
    make = lambda: train_models(_trip_table(spark, sf_dir), new_folder(spark, "models"), **size)
    return _once(spark, sf_dir, f"trips {size}", make)


def _time_parts(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    return splits.time_split(rows, month_columns=tables.TRIP_PARTITIONS)


def _booking_data(spark: SparkSession, sf_dir: str) -> TrainingData:
    """Booking-time inputs, split by time: the last half year tests."""

    def by_time(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        train, validation, test = _time_parts(rows)
        return train.unionByName(validation), test

    make = lambda: training_data(_trip_table(spark, sf_dir), booking_time_only=True, split=by_time)
    return _once(spark, sf_dir, "booking", make)


@query
def gbt_fare(spark, sf_dir):
    return _trip_models(spark, sf_dir).metrics.filter("task = 'fare'")


@query
def gbt_eta(spark, sf_dir):
    return _trip_models(spark, sf_dir).metrics.filter("task = 'eta'")


@query
def feature_importance(spark, sf_dir):
    trained = _trip_models(spark, sf_dir)
    tables_ = [
        models.feature_importance(spark, model, trained.data.features).withColumn("task", F.lit(task))
        for task, model in trained.models.items()
    ]
    return reduce(DataFrame.unionByName, tables_)


@query
def model_health(spark, sf_dir):
    """Error of the fare model per month of the test trips."""
    trained = _trip_models(spark, sf_dir)
    return scoring.model_health(trained.models["fare"].transform(trained.data.test), "fare_amount")


@query
def model_comparison(spark, sf_dir):
    """Three algorithms and the baseline for fare, duration and demand, each on a split by time."""
    data = _booking_data(spark, sf_dir)
    distance = "centroid_distance_mi"
    tests = {
        "fare": baselines.fare_baseline(data.test, data.train, distance).withColumnRenamed("baseline_fare", "guess"),
        "eta": baselines.eta_baseline(data.test, data.train, distance).withColumnRenamed("baseline_minutes", "guess"),
    }
    compared = []
    for task, label in (("fare", "fare_amount"), ("eta", "trip_duration_min")):
        compared.append(models.compare(task, label, _compared(spark, label), data.train, tests[task], "guess")[0])
    train, test = _demand_parts(spark, sf_dir)
    prepare = preparation(demand_ml.DEMAND_FEATURES, demand_ml.DEMAND_CATEGORIES).fit(train)
    guessed = prepare.transform(test.withColumnRenamed("baseline_trips", "guess"))
    compared.append(models.compare("demand", "trip_count", _compared(spark, "trip_count"), prepare.transform(train), guessed, "guess")[0])
    return reduce(DataFrame.unionByName, compared)


def _tuning_data(spark: SparkSession, sf_dir: str) -> TrainingData:
    """Booking-time inputs of the training and the validation period."""
    make = lambda: training_data(_trip_table(spark, sf_dir), booking_time_only=True, split=lambda rows: _time_parts(rows)[:2])
    return _once(spark, sf_dir, "tuning", make)


@query
def tuned_model(spark, sf_dir):
    """Forest settings fitted on the training period and chosen on the validation period; the test period is not read."""
    data = _tuning_data(spark, sf_dir)
    return models.tune(models.forest("fare_amount"), _tuning_grid(spark), data.train, data.test, "fare_amount")[0]


@query
def walk_forward_model(spark, sf_dir):
    """Forest settings ranked by their mean error over folds of growing time; zone means are learned anew in each fold."""

    def fold(bound: tuple[str, str]) -> tuple[DataFrame, DataFrame]:
        parts = lambda rows: splits.forward_split(rows, bound, "2022-01-01", month_columns=tables.TRIP_PARTITIONS)
        data = training_data(_trip_table(spark, sf_dir), booking_time_only=True, split=parts)
        return data.train, data.test

    return models.walk_forward(models.forest("fare_amount"), _tuning_grid(spark), [partial(fold, bound) for bound in FOLDS], "fare_amount")


def _by_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test trips scored by the fare model and by descent over its table of nodes."""
    trained = _trip_models(spark, sf_dir)
    nodes = materialize(trees.node_table(spark, trained.models["fare"]))
    scored = trained.models["fare"].transform(trained.data.test).withColumnRenamed("prediction", "by_model")
    return trees.score_by_nodes(scored, nodes, trained.models["fare"].getMaxDepth(), output="by_nodes")


@query
def tree_scoring_check(spark, sf_dir):
    """Test trips per month, and those where the descent over the node table differs from the model by over a billionth."""
    apart = F.abs(F.col("by_model") - F.col("by_nodes")) <= F.lit(1e-9) * F.greatest(F.abs("by_model"), F.lit(1.0))
    month = F.date_trunc("month", "pickup_ts").alias("period")
    return _by_nodes(spark, sf_dir).groupBy(month).agg(F.count(F.lit(1)).alias("trips"), F.count_if(~F.coalesce(apart, F.lit(False))).alias("differing"))


@query
def model_residuals(spark, sf_dir):
    """Test trips per band of five dollars between fare and prediction, of the fare model and of the baseline."""
    trained = _trip_models(spark, sf_dir)
    scored = baselines.fare_baseline(trained.models["fare"].transform(trained.data.test), trained.data.train)
    return errors.residual_distribution(scored, "fare_amount", {"gbt": "prediction", "baseline": "baseline_fare"})


@query
def model_error_by_zone(spark, sf_dir):
    """Error and bias of the fare and duration models per pickup zone, on the test trips."""
    trained = _trip_models(spark, sf_dir)
    scored = trained.models["fare"].transform(trained.data.test).withColumnRenamed("prediction", "fare_guess")
    scored = trained.models["eta"].transform(scored).withColumnRenamed("prediction", "eta_guess")
    return errors.error_by_zone(scored, {"fare": ("fare_amount", "fare_guess"), "eta": ("trip_duration_min", "eta_guess")})


@query
def score_requests(spark, sf_dir):
    """Fare and minutes, each with a 90 % range, for a ride request made from each order.

    The models are fitted on the training period; the ranges come from their residuals on the validation period by
    zone pair, hour and rain, and take the weather of the request's hour.
    """
    data, size = _tuning_data(spark, sf_dir), _model_size(spark, 3, 4)

    def fit_both():
        return [models.fit(models.gbt(label, **size), data.train) for label in ("fare_amount", "trip_duration_min")]

    fare_model, eta_model = _once(spark, sf_dir, f"request models {size}", fit_both)
    requests = fx.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("request_id"),
        (F.col("o_custkey") % 263 + 1).alias("pu_location_id"),
        (F.col("o_orderkey") * 7 % 263 + 1).alias("do_location_id"),
        (F.col("o_orderdate").cast("timestamp") + F.make_dt_interval(hours=(F.col("o_orderkey") % 24).cast("int"))).alias("pickup_ts"),
    )
    inputs = scoring.request_features(requests, fx.centroids(spark, sf_dir), data.means, data.distance)
    weathered = enrich.join_weather(assembler(data.features).transform(inputs), hourly(spark, sf_dir))
    scored = scoring.score_requests(weathered, fare_model, eta_model)
    calibration = scoring.score_requests(data.test, fare_model, eta_model)
    ranged = scoring.request_ranges(scored, calibration)
    return ranged.select(
        "request_id", "pu_location_id", "do_location_id", "pickup_ts", "is_rainy", "predicted_fare", "fare_low", "fare_high",
        "predicted_minutes", "minutes_low", "minutes_high",
    )


@query
def cluster_choice(spark, sf_dir):
    """Cost and silhouette of K-Means over zone profiles."""
    vectors = clusters.profile_vectors(demand.zone_profiles(cleaned(spark, sf_dir)))
    return clusters.choose_k(vectors, range(2, 6))[0]


@query
def zone_clusters(spark, sf_dir):
    vectors = clusters.profile_vectors(demand.zone_profiles(cleaned(spark, sf_dir)))
    return clusters.assign_clusters(vectors, clusters.fit_clusters(vectors, 4))


def _event_pickups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.table(spark, sf_dir, "events").select(
        (F.col("user_id") % 10 + 1).alias("pu_location_id"), F.col("ts").cast("timestamp").alias("pickup_ts")
    )


def _demand_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model inputs of every hour of the event zones and of the hour after the last one.

    The zones are grouped by the trips of the training hours.
    """
    trips = _event_pickups(spark, sf_dir)
    before = trips.filter(F.col("pickup_ts") < demand_test_from(spark, sf_dir))
    vectors = clusters.profile_vectors(demand.zone_profiles(before))
    groups = materialize(clusters.assign_clusters(vectors, clusters.fit_clusters(vectors, 3)))
    history = demand.add_history(demand_ml.with_next_hour(demand.hourly_counts(trips)))
    described = demand.describe_hours(
        history, fx.zones(spark, sf_dir), hourly(spark, sf_dir), fx.holidays(spark, sf_dir)
    )
    return demand_ml.demand_features(described, groups)


def _demand_model(spark: SparkSession, sf_dir: str):
    size = _model_size(spark, 5, 4)

    def make():
        train = _demand_inputs(spark, sf_dir).filter(F.col("hour_ts") < demand_test_from(spark, sf_dir))
        prepare = preparation(demand_ml.DEMAND_FEATURES, demand_ml.DEMAND_CATEGORIES)
        path = new_folder(spark, "demand-model")
        models.save(models.fit(Pipeline(stages=[prepare, models.gbt("trip_count", **size)]), train), path)
        return models.load_pipeline(path)

    return _once(spark, sf_dir, f"demand {size}", make)


def _demand_parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Training hours, and test hours with the baseline of the training hours."""
    rows = _demand_inputs(spark, sf_dir).filter(F.col("trip_count").isNotNull())
    start = demand_test_from(spark, sf_dir)
    train = rows.filter(F.col("hour_ts") < start)
    expected = materialize(baselines.demand_baseline(train))
    return train, baselines.apply_demand_baseline(rows.filter(F.col("hour_ts") >= start), expected)


def _demand_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _demand_model(spark, sf_dir).transform(_demand_parts(spark, sf_dir)[1])


@query
def demand_model(spark, sf_dir):
    """The demand model against the mean of the zone, hour and day of week."""
    scored = _demand_scored(spark, sf_dir)
    predictions = {baselines.BASELINE: "baseline_trips", "gbt": "prediction"}
    return models.against_baseline(models.evaluate(scored, "demand", "trip_count", predictions))


@query
def demand_importance(spark, sf_dir):
    fitted = _demand_model(spark, sf_dir)
    names = vector_names(fitted.transform(_demand_inputs(spark, sf_dir)), "assembled")
    return models.feature_importance(spark, fitted, names)


@query
def next_hour_inputs(spark, sf_dir):
    """History of the hour after the last one, per zone."""
    counts = demand_ml.with_next_hour(demand.hourly_counts(_event_pickups(spark, sf_dir)))
    ahead = demand.add_history(counts).filter(F.col("trip_count").isNull())
    return rounded(ahead.drop("trip_count"), *demand_ml.MEANS)


@query
def next_hour_top5(spark, sf_dir):
    """The zones of highest predicted demand in the hour after the last one."""
    ahead = _demand_inputs(spark, sf_dir).filter(F.col("trip_count").isNull())
    scored = demand_ml.next_hour_top(_demand_model(spark, sf_dir).transform(ahead))
    return scored.select("zone_id", "hour_ts", "prediction")


@query
def stream_scored_demand(spark, sf_dir):
    """Hourly demand of the stream beside the forecast of the fitted model; every window stays."""
    return _scored_stream(spark, sf_dir)


@query
def stream_scored_windows(spark, sf_dir):
    """The same stream without the forecast, which SQL does not know."""
    return rounded(_scored_stream(spark, sf_dir).drop("forecast"), "avg_fare")


@query
def stream_forecast_windows(spark, sf_dir):
    """Hourly demand of the stream beside the baseline forecast, which micro-batches read by version for their own hours."""
    hours = demand.hourly_counts(_event_pickups(spark, sf_dir)).withColumns({"hour": F.hour("hour_ts"), "dayofweek": F.dayofweek("hour_ts")})
    guessed = baselines.apply_demand_baseline(hours, materialize(baselines.demand_baseline(hours))).withColumnRenamed("baseline_trips", "forecast")
    path = new_folder(spark, "forecasts")
    forecasts.write_forecasts(guessed, path, "baseline")
    rows = _hourly_stream(spark, sf_dir, forecasts.forecast_lookup(path, "baseline"))
    return rounded(rows, "avg_fare", "forecast")


def _scored_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The model's forecasts of all hours, written once, beside the stream."""
    inputs = materialize(_demand_inputs(spark, sf_dir))
    scored = _demand_model(spark, sf_dir).transform(inputs.drop("trip_count"))
    path = new_folder(spark, "forecasts")
    forecasts.write_forecasts(scored.withColumnRenamed("prediction", "forecast"), path, "model")
    return _hourly_stream(spark, sf_dir, forecasts.forecast_lookup(path, "model"))


def _hourly_stream(spark: SparkSession, sf_dir: str, prepare: Callable[[DataFrame], DataFrame]) -> DataFrame:
    windows = live.flat_windows(live.windowed_demand(parse_events(_stream(spark, sf_dir)), "1 hour", watermark="15 minutes"))
    return _updates(spark, windows, ["window_start", "window_end", "PULocationID"], "15 minutes", prepare)

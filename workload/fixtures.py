"""Trips, reference tables and events derived from the test tables.

Integer arithmetic only, so that Spark and SQL twins see the same rows.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rideflow.session import bound_tasks, new_folder, pin_time_zone
from rideflow.sources.manifest import stage_by_month
from rideflow.sources.reference import read_centroids, read_holidays, read_weather, read_zones

FIRST_PICKUP = "2021-12-15 00:00:00"
FIRST_WEATHER = "2022-01-01 00:00:00"
PICKUP_SPAN_SECONDS = 97_632_000
WEATHER_HOURS = 26_304
ZONE_COUNT = 265
#: By the remainder of the order key.
SERVICES = ("yellow", "green", "fhvhv")
#: What a trip is made from.
LINE_COLUMNS = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
)

# United States federal holidays, 2022 to 2024, as observed on their dates.
HOLIDAYS = (
    "2022-01-01", "2022-01-17", "2022-02-21", "2022-05-30", "2022-06-19", "2022-07-04",
    "2022-09-05", "2022-10-10", "2022-11-11", "2022-11-24", "2022-12-25",
    "2023-01-01", "2023-01-16", "2023-02-20", "2023-05-29", "2023-06-19", "2023-07-04",
    "2023-09-04", "2023-10-09", "2023-11-11", "2023-11-23", "2023-12-25",
    "2024-01-01", "2024-01-15", "2024-02-19", "2024-05-27", "2024-06-19", "2024-07-04",
    "2024-09-02", "2024-10-14", "2024-11-11", "2024-11-28", "2024-12-25",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return bound_tasks(pin_time_zone(spark)).read.parquet(f"{sf_dir}/{name}.parquet")


def _at(start: str, seconds: Column) -> Column:
    origin = F.unix_timestamp(F.lit(start).cast("timestamp"))
    return F.timestamp_seconds(origin + seconds)


def _pickup_seconds() -> Column:
    """Seconds from FIRST_PICKUP to the base time of a trip."""
    return (F.col("l_orderkey") * 1299709 + F.col("l_partkey") * 104729 + F.col("l_linenumber") * 611953) % PICKUP_SPAN_SECONDS


def _service_lines(spark: SparkSession, sf_dir: str, service: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").filter(F.col("l_orderkey") % 3 == SERVICES.index(service))


def _trip_parts(lines: DataFrame) -> DataFrame:
    """One row per trip with the values every feed shares; some order keys come twice.

    The copies are made from finished values, so that filters above read columns and are not
    rewritten into the formulas.
    """
    order, part, line = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_linenumber")
    pickup_s = _pickup_seconds()
    ride_s = (part * 7919 + F.col("l_suppkey") * 17 + order * 911) % 24000 - 300
    values = F.struct(
        (order % 3).alias("service_no"),
        _at(FIRST_PICKUP, pickup_s).alias("base_ts"),
        F.when(part % 101 != 0, _at(FIRST_PICKUP, pickup_s)).alias("pickup"),
        _at(FIRST_PICKUP, pickup_s + ride_s).alias("dropoff"),
        ((part * 7 + order) % 266).alias("pu"),
        ((part * 13 + line * 29 + order * 3) % 266).alias("do"),
        F.when(part % 89 == 0, F.lit(None))
        .when(part % 50 == 0, 0.0)
        .when(part % 97 == 0, 250.0)
        .otherwise(F.col("l_extendedprice") / 2000)
        .alias("distance"),
        (F.col("l_extendedprice") * F.col("l_discount") / 10).alias("fare"),
        (F.col("l_quantity") / 5).alias("tip"),
        (F.col("l_tax") * 10).alias("tolls"),
        F.when(part % 53 != 0, F.lit(0.0)).alias("congestion"),
        (F.col("l_quantity").cast("bigint") % 10).cast("double").alias("riders"),
    )
    copies = F.when(order % 37 == 0, 2).otherwise(1)
    return lines.select(F.inline_outer(F.array_repeat(values, copies)))


def _metered_total() -> Column:
    return F.col("fare") + F.col("tip") + F.col("tolls")


def raw_feed(spark: SparkSession, sf_dir: str, service: str) -> DataFrame:
    """A feed with the column names of its service, made from its own lines only."""
    return _feed(_service_lines(spark, sf_dir, service), service)


def _feed(lines: DataFrame, service: str, keep: tuple[str, ...] = ()) -> DataFrame:
    parts = _trip_parts(lines)
    if service == "fhvhv":
        return parts.select(
            F.col("pickup").alias("pickup_datetime"),
            F.col("dropoff").alias("dropoff_datetime"),
            F.col("pu").alias("PULocationID"),
            F.col("do").alias("DOLocationID"),
            F.col("distance").alias("trip_miles"),
            F.col("fare").alias("base_passenger_fare"),
            F.col("tolls"),
            F.lit(0.0).alias("sales_tax"),
            F.col("congestion").alias("congestion_surcharge"),
            F.col("tip").alias("tips"),
            *keep,
        )
    prefix = {"yellow": "tpep", "green": "lpep"}[service]
    return parts.select(
        F.col("pickup").alias(f"{prefix}_pickup_datetime"),
        F.col("dropoff").alias(f"{prefix}_dropoff_datetime"),
        F.col("pu").alias("PULocationID"),
        F.col("do").alias("DOLocationID"),
        F.col("distance").alias("trip_distance"),
        F.col("fare").alias("fare_amount"),
        F.col("tip").alias("tip_amount"),
        _metered_total().alias("total_amount"),
        F.col("riders").alias("passenger_count"),
        *keep,
    )


def trips(spark: SparkSession, sf_dir: str, with_file_month: bool = False) -> DataFrame:
    """Canonical trips of all three services from one scan; equal to the union of the unified feeds."""
    service, hired = F.col("service_no"), F.col("service_no") == 2
    hired_total = F.col("fare") + F.col("tolls") + F.lit(0.0) + F.col("congestion") + F.col("tip")
    # The file of a trip is the one of its base time; one in eleven zones' trips sit in the next month's file.
    file_day = F.when(F.col("pu") % 11 == 0, F.add_months("base_ts", 1)).otherwise(F.to_date("base_ts"))
    file_month = (F.year(file_day).alias("file_year"), F.month(file_day).alias("file_month"))
    return _trip_parts(table(spark, sf_dir, "lineitem")).select(
        F.col("pickup").alias("pickup_ts"),
        F.col("dropoff").alias("dropoff_ts"),
        F.col("pu").alias("pu_location_id"),
        F.col("do").alias("do_location_id"),
        F.col("distance").alias("trip_distance_mi"),
        F.col("fare").alias("fare_amount"),
        F.col("tip").alias("tip_amount"),
        F.when(hired, hired_total).otherwise(_metered_total()).alias("total_amount"),
        F.when(~hired, F.col("riders")).alias("passenger_count"),
        F.when(service == 0, "yellow").when(service == 1, "green").otherwise("fhvhv").alias("service_type"),
        *(file_month if with_file_month else ()),
    )


def _zone_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = spark.range(1, ZONE_COUNT + 1).filter("id % 41 <> 0")
    zone = F.col("id")
    service_zone = (
        F.when(zone.isin(1, 132, 138), "Airports").when(zone % 2 == 0, "Yellow Zone").otherwise("Boro Zone")
    )
    regions = table(spark, sf_dir, "region")
    return ids.join(F.broadcast(regions), zone % 5 == regions["r_regionkey"], "left").select(
        zone.cast("int").alias("LocationID"),
        F.col("r_name").alias("Borough"),
        F.concat(F.lit("Zone_"), zone.cast("string")).alias("Zone"),
        service_zone.alias("service_zone"),
    )


def _centroid_rows(spark: SparkSession) -> DataFrame:
    zone = F.col("id")
    return spark.range(1, ZONE_COUNT + 1).filter("id % 41 <> 0").select(
        zone.cast("int").alias("LocationID"),
        (F.lit(40.5) + (zone * 37 % 400) / 1000.0).alias("lat"),
        (F.lit(-74.25) + (zone * 61 % 550) / 1000.0).alias("lon"),
    )


def _weather_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document; its arrays hold at most WEATHER_HOURS readings, made from the orders of each hour."""
    hour_no, seed = F.col("hour_no"), F.col("seed")
    readings = (
        table(spark, sf_dir, "orders")
        .groupBy((F.col("o_orderkey") * 7919 % WEATHER_HOURS).alias("hour_no"))
        .agg(F.sum("o_custkey").alias("seed"))
        .filter(hour_no % 97 != 0)
        .select(
            hour_no,
            F.date_format(_at(FIRST_WEATHER, hour_no * 3600), "yyyy-MM-dd'T'HH:mm").alias("time"),
            ((seed * 7 % 350) / 10.0 - 5).alias("temperature_2m"),
            ((seed * 3 % 40) / 20.0).alias("precipitation"),
            ((seed * 3 % 20) / 50.0).alias("rain"),
            ((seed * 11 % 300) / 10.0).alias("wind_speed_10m"),
            (seed % 70 + 30).cast("double").alias("relative_humidity_2m"),
        )
    )
    names = readings.columns[1:]
    rows = readings.agg(F.sort_array(F.collect_list(F.struct("hour_no", *names))).alias("rows"))
    return rows.select(F.struct(*(F.col(f"rows.{name}").alias(name) for name in names)).alias("hourly"))


_written: dict[tuple[str, str], str] = {}


def reference_folder(spark: SparkSession, sf_dir: str) -> str:
    """Zone and centroid CSV, holiday CSV and weather JSON, written once per application and scale."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _written:
        folder = new_folder(pin_time_zone(spark), "reference")
        _zone_rows(spark, sf_dir).coalesce(1).write.option("header", True).csv(f"{folder}/zones")
        _centroid_rows(spark).coalesce(1).write.option("header", True).csv(f"{folder}/centroids")
        days = spark.createDataFrame([(day,) for day in HOLIDAYS], "holiday string")
        days.coalesce(1).write.option("header", True).csv(f"{folder}/holidays")
        _weather_document(spark, sf_dir).coalesce(1).write.json(f"{folder}/weather")
        _written[key] = folder
    return _written[key]


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_zones(spark, f"{reference_folder(spark, sf_dir)}/zones")


def centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_centroids(spark, f"{reference_folder(spark, sf_dir)}/centroids")


def holidays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_holidays(spark, f"{reference_folder(spark, sf_dir)}/holidays")


def weather_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_weather(spark, f"{reference_folder(spark, sf_dir)}/weather")


def _event_json() -> Column:
    """A row of the events table as a trip event."""
    user = F.col("user_id")
    pattern = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    fields = F.struct(
        (user % 2 + 1).alias("VendorID"),
        F.date_format("ts", pattern).alias("tpep_pickup_datetime"),
        F.date_format(F.col("ts").cast("timestamp") + F.expr("INTERVAL 10 MINUTES"), pattern).alias(
            "tpep_dropoff_datetime"
        ),
        F.lit(1.0).alias("passenger_count"),
        (F.col("event_id") % 40 / 4.0).alias("trip_distance"),
        (user % 10 + 1).alias("PULocationID"),
        (user * 3 % 10 + 1).alias("DOLocationID"),
        F.col("value").alias("fare_amount"),
    )
    return F.to_json(fields)


def event_values(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    """The events table as trip events: one JSON document per row in ``value``."""
    return table(spark, sf_dir, "events").select(_event_json().alias("value"), *keep)


def flush_value(ts: str) -> str:
    """A late event of zone 0 that moves the watermark past everything before it."""
    return f'{{"tpep_pickup_datetime": "{ts}", "PULocationID": 0, "fare_amount": 0.0}}'


EVENT_FILES = 6


def event_folder(
    spark: SparkSession, sf_dir: str, *flush_at: str, repeat_first: bool = False, flush_after: str | None = None
) -> str:
    """The events as text files for a file stream, in order of time, then one flushing event per given time.

    ``repeat_first`` adds the first file's events once more, and ``flush_after`` another flushing event. All files are written by
    one job, a task each; a file stream reads them by their times, which are set afterwards, a second apart.
    """
    folder = new_folder(spark, "events")
    rows = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value")
    when = F.col("ts").cast("timestamp")
    span = rows.agg(F.min(when).alias("lo"), F.max(when).alias("hi")).first()
    step = (span["hi"] - span["lo"]) / EVENT_FILES
    slice_no = sum(((when >= F.lit(span["lo"] + n * step)).cast("int") for n in range(1, EVENT_FILES)), F.lit(0))
    repeated = EVENT_FILES + len(flush_at)
    placed = F.array(slice_no)
    if repeat_first:
        placed = F.when(slice_no == 0, F.array(F.lit(0), F.lit(repeated))).otherwise(placed)
    flushes = [(flush_value(ts), EVENT_FILES + n) for n, ts in enumerate(flush_at)]
    flushes += [(flush_value(flush_after), repeated + repeat_first)] * bool(flush_after)
    lines = rows.filter("ts IS NOT NULL").withColumns({"file": F.explode(placed), "line": F.lit(None).cast("string")})
    if flushes:
        lines = lines.unionByName(spark.createDataFrame(flushes, "line string, file int"), allowMissingColumns=True)
    files = repeated + repeat_first + bool(flush_after)
    dealt = lines.repartitionById(files, F.col("file"))
    dealt.select(F.coalesce("line", _event_json()).alias("value")).write.text(folder)
    _in_order(spark, folder)
    return folder


def _in_order(spark: SparkSession, folder: str) -> None:
    """Give the files of a folder times a second apart, in order of their names, the last one's its own."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    parts = sorted((f.getPath().getName(), f) for f in files.listStatus(path) if f.getPath().getName().startswith("part-"))
    last = max(f.getModificationTime() for _, f in parts) // 1000 * 1000
    for n, (_, file) in enumerate(parts):
        files.setTimes(file.getPath(), last - 1000 * (len(parts) - 1 - n), -1)


def _download(spark: SparkSession, sf_dir: str, folder: str, service: str) -> None:
    """The monthly files of one service."""
    # The lines are shuffled, which are narrower than trips and have no copies yet.
    day = _at(FIRST_PICKUP, _pickup_seconds())
    lines = _service_lines(spark, sf_dir, service).select(*LINE_COLUMNS, (F.year(day) * 100 + F.month(day)).alias("month"))
    name = F.concat(F.lit(f"{service}_tripdata_"), F.date_format("base_ts", "yyyy-MM"), F.lit(".parquet"))
    plain, drifted = (
        _feed(lines.filter(F.col("month") % 2 == odd).hint("rebalance", "month"), service, keep=("base_ts",))
        .withColumn("file", name).drop("base_ts")
        for odd in (1, 0)
    )
    drifted = drifted.withColumns(
        {c: F.col(c).cast("double") for c in ("PULocationID", "DOLocationID")}
    ).withColumnsRenamed({"PULocationID": "pulocationid", "DOLocationID": "dolocationid"})
    for part in (plain, drifted):
        part.write.mode("append").partitionBy("file").parquet(f"{folder}/{service}")


def download_folder(spark: SparkSession, sf_dir: str) -> str:
    """The feeds as monthly files named by service and month, written once per application and scale.

    Types and spelling drift: even months hold zone ids as doubles under lower-case names.
    """
    key = (spark.sparkContext.applicationId, f"{sf_dir}#downloads")
    if key not in _written:
        folder = new_folder(spark, "downloads")
        # The services are written at once: the tail of one's jobs leaves cores to the others.
        with ThreadPoolExecutor(len(SERVICES)) as pool:
            list(pool.map(lambda service: _download(spark, sf_dir, folder, service), SERVICES))
        _written[key] = folder
    return _written[key]


def staged_folder(spark: SparkSession, sf_dir: str) -> str:
    """The monthly files laid out by service, year and month, written once per application and scale."""
    key = (spark.sparkContext.applicationId, f"{sf_dir}#staged")
    if key not in _written:
        folder = new_folder(spark, "staged")
        stage_by_month(spark, download_folder(spark, sf_dir), folder)
        _written[key] = folder
    return _written[key]


def broken_folder(spark: SparkSession, sf_dir: str) -> str:
    """Staged months of their own, with an unreadable file in a month of 2023 and a file outside the layout."""
    folder = new_folder(spark, "broken")
    stage_by_month(spark, download_folder(spark, sf_dir), folder)
    extra = raw_feed(spark, sf_dir, "green").limit(1)
    extra.coalesce(1).write.parquet(f"{folder}/green/unsorted")
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/yellow/year=2023/month=13/part-0.parquet")
    out = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).create(path)
    out.writeBytes("no Parquet file")
    out.close()
    return folder


#: Months of ``damaged_lake`` with an unreadable file more: one without a footer, one with overwritten pages.
FOOTERLESS, OVERWRITTEN = ("green", 2022, 4), ("yellow", 2023, 9)


def damaged_lake(spark: SparkSession, sf_dir: str) -> str:
    """Staged months of their own; a file of text in one, and in another a copy of a file whose footer is sound and whose pages are overwritten."""
    folder = new_folder(spark, "damaged")
    stage_by_month(spark, download_folder(spark, sf_dir), folder)
    service, year, month = OVERWRITTEN
    whole = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(f"{folder}/{service}/year={year}/month={month:02d}")
    content = bytearray(whole.orderBy("path").select("content").first()[0])
    data_end = len(content) - 8 - int.from_bytes(content[-8:-4], "little")
    content[4:data_end] = b"\xff" * (data_end - 4)
    for (service, year, month), data in ((FOOTERLESS, bytearray(b"no Parquet file")), (OVERWRITTEN, content)):
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{service}/year={year}/month={month:02d}/part-damaged.parquet")
        out = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).create(path)
        out.write(data)
        out.close()
    return folder


class ChangingLake(NamedTuple):
    """A lake of staged months without green trips of May 2023; ``change`` adds these, removes yellow ones of March 2022 and repeats fhvhv ones of February 2024."""

    spark: SparkSession
    folder: str
    staged: str

    def _delete(self, month: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{month}")
        path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)

    def _append(self, month: str) -> None:
        self.spark.read.parquet(f"{self.staged}/{month}").write.mode("append").parquet(f"{self.folder}/{month}")

    ADDED = ("green/year=2023/month=05", "fhvhv/year=2024/month=02")

    def change(self) -> None:
        for month in self.ADDED:
            self._append(month)
        self._delete("yellow/year=2022/month=03")


def changing_lake(spark: SparkSession, sf_dir: str) -> ChangingLake:
    """The lake is staged once; the months that ``change`` adds are copied before one of them is removed."""
    folder, aside = new_folder(spark, "lake"), new_folder(spark, "aside")
    stage_by_month(spark, download_folder(spark, sf_dir), folder)
    lake = ChangingLake(spark, folder, aside)
    for month in lake.ADDED:
        spark.read.parquet(f"{folder}/{month}").write.parquet(f"{aside}/{month}")
    lake._delete("green/year=2023/month=05")
    return lake

"""Raw trip feeds laid out as ``year=YYYY/month=MM``, and processed trips."""

from __future__ import annotations

import warnings
from collections import defaultdict
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rideflow import schemas
from rideflow.operators.splits import keyed_sample
from rideflow.operators.unify import FEEDS, unify, union_trips
from rideflow.session import materialize

SAMPLE_RATE = 0.05
#: A sample of trips is drawn by these.
SAMPLE_KEYS = ("pickup_ts", "dropoff_ts", "pu_location_id", "do_location_id")
MONTH_FOLDER = r"^(.*/year=(\d{4})/month=(\d{1,2}))/"
NOT_ASKED, NO_MONTH = "not asked for", "not in a folder of a year and a month"


@dataclass(frozen=True)
class ServiceRead:
    """The unified trips of a service, and the months that could not be read."""

    trips: DataFrame
    skipped: DataFrame


class MonthFolder(NamedTuple):
    """A folder of one month, or of files outside the layout (year and month are None)."""

    year: int | None
    month: int | None
    path: str


def month_folders(spark: SparkSession, base: str) -> list[MonthFolder]:
    """The month folders below ``base`` that hold Parquet files, at any depth; none if ``base`` is absent.

    Months may be written with one digit or two. Spark lists the files; the driver receives the
    distinct folders. Errors other than an absent path are raised.
    """
    try:
        files = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", True)
            .option("pathGlobFilter", "*.parquet")
            .load(base)
        )
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return []
        raise
    found = files.select(
        F.regexp_extract("path", MONTH_FOLDER, 1).alias("path"),
        F.regexp_extract("path", MONTH_FOLDER, 2).alias("year"),
        F.regexp_extract("path", MONTH_FOLDER, 3).alias("month"),
    ).distinct()
    folders = [MonthFolder(int(r.year), int(r.month), r.path) if r.path else MonthFolder(None, None, base) for r in found.collect()]
    return sorted(folders, key=lambda f: (f.year or 0, f.month or 0, f.path))


def _schema(reader: DataFrameReader, *paths: str) -> T.StructType | str:
    try:
        return reader.parquet(*paths).schema
    except PySparkException as error:
        return str(error).splitlines()[0]
    except Py4JJavaError as error:
        return str(error.java_exception.getMessage()).splitlines()[0]


def footer_schemas(spark: SparkSession, paths: list[str], **options: str) -> list[T.StructType | str]:
    """The merged schema of the files below each path, or why there is none; several paths at a time.

    Spark reads the footers of a path in one job.
    """
    merged = {**options, "mergeSchema": "true", "recursiveFileLookup": "true"}
    with ThreadPoolExecutor(8) as pool:
        return list(pool.map(lambda path: _schema(spark.read.options(**merged), path), paths))


def same_schema_paths(spark: SparkSession, paths: list[str], **options: str) -> list[tuple[str, T.StructType | str]]:
    """Paths with their schemas; a folder whose files have types that do not merge is split into its files."""
    out = []
    for path, schema in zip(paths, footer_schemas(spark, paths, **options)):
        if isinstance(schema, str) and "CANNOT_MERGE_SCHEMA" in schema.upper():
            files = sorted(r.path for r in _files_below(spark, path).select("path").collect())
            out += zip(files, footer_schemas(spark, files, **options))
        else:
            out.append((path, schema))
    return out


def _files_below(spark: SparkSession, path: str) -> DataFrame:
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    return listing.load(path)


def probe_files(spark: SparkSession, files: DataFrame, groups: Iterable[tuple[T.StructType, list[str]]], deep: bool = False) -> DataFrame:
    """``path`` of each of the ``files``, the ``rows`` its footer states, and ``reason`` if it cannot be read, else null.

    ``groups`` are schemas with the folders or files they hold for. One scan of the footers counts rows per file; files
    without any are opened on their own, several at a time, which tells empty files from broken ones. ``deep`` also decodes
    every column of every row and names the files that lose rows on the way. The driver receives the paths of files without rows.
    """
    lenient = spark.read.options(ignoreCorruptFiles="true", recursiveFileLookup="true")
    counted = spark.createDataFrame([], "at string, stated bigint, decoded bigint, checksum bigint")
    for schema, paths in groups:
        feed = lenient.schema(schema).parquet(*paths)
        at = _plain_path(F.col("_metadata.file_path")).alias("at")
        stated = feed.groupBy(at).agg(F.count(F.lit(1)).alias("stated"))
        if deep:
            # The checksum makes the scan read all columns.
            read = feed.groupBy(at).agg(F.count(F.lit(1)).alias("decoded"), F.bit_xor(F.xxhash64(*schema.fieldNames())).alias("checksum"))
            stated = stated.join(read, "at", "left")
        else:
            stated = stated.withColumns({"decoded": F.col("stated"), "checksum": F.lit(0).cast("long")})
        counted = counted.unionByName(stated)
    found = materialize(files.select("path").join(counted, _plain_path(F.col("path")) == F.col("at"), "left"))
    rowless = [r.path for r in found.filter("stated IS NULL").select("path").orderBy("path").collect()]
    opened = [(path, None if isinstance(schema, T.StructType) else schema) for path, schema in zip(rowless, footer_schemas(spark, rowless))]
    reasons = spark.createDataFrame(opened, "path string, broken string")
    decoded = F.coalesce("decoded", F.lit(0))
    # The checksum is looked at, or the scan would drop it with the columns behind it.
    lost = (decoded < F.col("stated")) | (F.col("checksum").isNull() & (decoded > 0))
    partly = F.concat(decoded.cast("string"), F.lit(" of "), F.col("stated").cast("string"), F.lit(" rows can be read"))
    return found.join(reasons, "path", "left").select(
        "path", F.coalesce("stated", F.lit(0)).alias("rows"), F.coalesce("broken", F.when(lost, partly)).alias("reason")
    )


def _plain_path(path: Column) -> Column:
    """One spelling for a local path; listings and scans differ in the slashes after the scheme."""
    return F.regexp_replace(path, r"^file:/+", "file:/")


def schema_key(schema: T.StructType) -> tuple[tuple[str, str], ...]:
    return tuple((field.name, field.dataType.simpleString()) for field in schema.fields)


def read_service(
    spark: SparkSession,
    base: str,
    service: str,
    years: Iterable[int] | None = None,
    months: Iterable[int] | None = None,
    sample_rate: float | None = None,
    seed: int = 42,
    ignore_corrupt: bool = False,
    skip_unreadable: bool = False,
    absent_as_zero: bool = False,
    with_file_month: bool = False,
) -> ServiceRead:
    """Read and unify the months of one service; column types may differ between months and files.

    Every month that is there is read, unless ``years`` or ``months`` choose some. The schema of a
    month comes from the footers of all its files, so a file may lack columns that others have;
    where types do not merge, each file has its own. Files of equal schema form one scan with that
    schema, so the plan holds a scan per schema and not per month. Whatever is not read is a row of
    ``skipped``: months not asked for, files outside the layout, and unreadable months if
    ``skip_unreadable``; otherwise an unreadable month raises. ``ignore_corrupt`` leaves out files whose footer is
    broken, each a row of ``skipped`` too, at the price of a scan of all footers. ``with_file_month`` keeps
    ``file_year`` and ``file_month``. A sample is drawn by hash of a trip's times and zones.
    """
    if service.lower() not in FEEDS:
        raise ValueError(f"unknown service type: {service}")
    reader_options = {"ignoreCorruptFiles": str(ignore_corrupt).lower()}
    base = base.rstrip("/")
    wanted_years, wanted_months = years and set(years), months and set(months)
    groups: dict[tuple, list[str]] = defaultdict(list)
    group_schemas: dict[tuple, T.StructType] = {}
    skipped, present = [], {}
    for folder in month_folders(spark, base):
        if folder.year is None:
            skipped.append((service, None, None, NO_MONTH))
        elif wanted_years and folder.year not in wanted_years or wanted_months and folder.month not in wanted_months:
            skipped.append((service, folder.year, folder.month, NOT_ASKED))
        else:
            present[folder.path] = folder
    for path, schema in same_schema_paths(spark, list(present), **reader_options):
        if isinstance(schema, str):
            year, month = next((f.year, f.month) for p, f in present.items() if path == p or path.startswith(f"{p}/"))
            if not skip_unreadable:
                raise ValueError(f"cannot read {service} {year}-{month:02d} at {path}: {schema}")
            skipped.append((service, year, month, schema))
            continue
        key = schema_key(schema)
        groups[key].append(path)
        group_schemas[key] = schema

    keep = ("file_year", "file_month") if with_file_month else ()
    parts = []
    for key, folders in groups.items():
        reader = spark.read.options(**reader_options, recursiveFileLookup="true").schema(group_schemas[key])
        feed = reader.parquet(*folders)
        if with_file_month:
            path = F.col("_metadata.file_path")
            feed = feed.withColumns({
                "file_year": F.regexp_extract(path, MONTH_FOLDER, 2).cast("int"),
                "file_month": F.regexp_extract(path, MONTH_FOLDER, 3).cast("int"),
            })
        trips = unify(feed, service, absent_as_zero, keep)
        if sample_rate is not None:
            warnings.warn(f"reading a {sample_rate:.0%} sample of {service}", stacklevel=2)
            trips = keyed_sample(trips, SAMPLE_KEYS, sample_rate, seed)
        parts.append(trips)
    if ignore_corrupt and present:
        skipped += _lost_files(spark, service, list(present.values()), [(group_schemas[key], paths) for key, paths in groups.items()])
    skipped_months = spark.createDataFrame(skipped, schemas.SKIPPED_MONTH)
    return ServiceRead(union_trips(parts, spark), skipped_months)


def _lost_files(spark: SparkSession, service: str, folders: list[MonthFolder], groups: list[tuple[T.StructType, list[str]]]) -> list[tuple]:
    """A row of ``skipped`` for each file without a readable footer, in months that are read."""
    files = reduce(DataFrame.unionByName, [_files_below(spark, f.path).select("path") for f in folders])
    broken = probe_files(spark, files, groups).filter("reason IS NOT NULL")
    parts = [F.regexp_extract("path", MONTH_FOLDER, n).cast("int").alias(name) for n, name in ((2, "year"), (3, "month"))]
    named = broken.select(*parts, F.concat(F.regexp_extract("path", "[^/]*$", 0), F.lit(": "), "reason").alias("reason"))
    return [(service, r.year, r.month, r.reason) for r in named.collect()]


def read_feeds(spark: SparkSession, base: str, services: Iterable[str] = tuple(FEEDS), **options) -> ServiceRead:
    """All services below ``base``, one folder each."""
    reads = [read_service(spark, f"{base}/{service}", service, **options) for service in services]
    trips = union_trips([read.trips for read in reads], spark)
    skipped = reads[0].skipped
    for read in reads[1:]:
        skipped = skipped.unionByName(read.skipped)
    return ServiceRead(trips, skipped)


def read_processed(spark: SparkSession, path: str) -> DataFrame:
    """Processed trips; filter on ``pickup_year`` and ``pickup_month`` to prune folders."""
    return spark.read.parquet(path)

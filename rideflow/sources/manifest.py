"""File manifest and staging of downloaded trip files by service, year and month."""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rideflow.operators.unify import FEEDS
from rideflow.sources.trips import same_schema_paths, schema_key

# Fixed format of the name of a monthly trip file; a file that Spark wrote is a folder of parts.
FILE_NAME = r"[/=]((yellow|green|fhvhv)_tripdata_(\d{4})-(\d{2})\.parquet)(?:/[^/]+)?$"
_MIB = 1024 * 1024


def _name_parts(path: str | Column) -> dict[str, Column]:
    names = ("file", "service", "year", "month")
    return {name: F.regexp_extract(path, FILE_NAME, i + 1) for i, name in enumerate(names)}


def named_files(spark: SparkSession, folder: str) -> DataFrame:
    """Path, size and name parts of the trip files anywhere below a folder; contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .load(folder)
        .select("path", "length")
    )
    return files.withColumns(_name_parts("path")).filter(F.col("file") != "")


def ingest_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Service, year, month, size and row count of each trip file; counts come from the footers."""
    keys = ["file", "service", "year", "month"]
    sizes = named_files(spark, folder).groupBy(*keys).agg(F.sum("length").alias("bytes"))
    rows = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .parquet(folder)
        .groupBy(F.col("_metadata.file_path").alias("path"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .groupBy(F.regexp_extract("path", FILE_NAME, 1).alias("file"))
        .agg(F.sum("rows").alias("rows"))
    )
    return sizes.join(rows, "file", "left").select(
        "service",
        F.col("year").cast("int").alias("year"),
        F.col("month").cast("int").alias("month"),
        "file",
        F.round(F.col("bytes") / _MIB, 2).alias("size_mb"),
        F.coalesce("rows", F.lit(0)).alias("rows"),
    )


def stage_by_month(spark: SparkSession, folder: str, target: str) -> list[str]:
    """Lay the trip files of a folder out as ``service/year=YYYY/month=MM``.

    Rows keep the columns and types of their own file: the files of one service that share a schema
    are one job. Months that are staged are replaced, other months of the target stay. Where the
    files of a month differ in schema, the first schema's rows replace the month and the others are
    added to it. The driver sees one row per named file. Returns the services written.
    """
    # The folder of a named file if it is one, else the file itself.
    named = F.regexp_replace("path", r"(\.parquet)/[^/]+$", "$1")
    files = named_files(spark, folder).select("service", "year", "month", named.alias("path")).distinct().orderBy("path").collect()
    months: dict[tuple[str, str, str], dict[tuple, list[str]]] = defaultdict(lambda: defaultdict(list))
    schemas = {}
    month_of = {row.path: (row.service, row.year, row.month) for row in files}
    for path, schema in same_schema_paths(spark, [row.path for row in files]):
        if isinstance(schema, str):
            raise ValueError(f"cannot read {path}: {schema}")
        key = schema_key(schema)
        month = month_of.get(path) or month_of[path.rpartition("/")[0]]
        months[month][key].append(path)
        schemas[key] = schema

    jobs: dict[tuple[int, str, tuple], list[str]] = defaultdict(list)
    for (service, _, _), by_schema in months.items():
        for layer, (key, paths) in enumerate(by_schema.items()):
            jobs[layer, service, key] += paths
    for (layer, service, key), paths in sorted(jobs.items(), key=lambda job: job[0][0]):
        parts = _name_parts(F.col("_metadata.file_path"))
        (
            spark.read.schema(schemas[key])
            .parquet(*paths)
            .withColumns({"year": parts["year"], "month": parts["month"]})
            .write.mode("append" if layer else "overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("year", "month")
            .parquet(f"{target}/{service}")
        )
    return [service for service in FEEDS if any(month[0] == service for month in months)]

"""A table of the lake's files, kept from run to run: a run lists once and reads the footers of new and changed files only."""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rideflow.operators.unify import FEEDS, unify, union_trips
from rideflow.session import materialize
from rideflow.sources.trips import MONTH_FOLDER, same_schema_paths

FILES = "path string, folder string, service string, year int, month int, bytes bigint, modified timestamp, rows bigint, schema string"
_KEPT = [f.split()[0] for f in FILES.split(", ")]
MONTH = ("service", "year", "month")


@dataclass(frozen=True)
class Refreshed:
    """``files`` that are there now, and ``months`` with how they differ from the state before."""

    files: DataFrame
    months: DataFrame
    version: int


def listed(spark: SparkSession, base: str) -> DataFrame:
    """Path, month and size of all Parquet files in month folders of known services; one listing, contents are not read."""
    base = base.rstrip("/")
    found = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(base)
    )
    folder = F.regexp_extract("path", MONTH_FOLDER, 1)
    return found.select(
        "path", folder.alias("folder"),
        F.regexp_extract("path", rf"/({'|'.join(FEEDS)})/year=", 1).alias("service"),
        F.try_to_number(F.nullif(F.regexp_extract("path", MONTH_FOLDER, 2), F.lit("")), F.lit("9999")).cast("int").alias("year"),
        F.try_to_number(F.nullif(F.regexp_extract("path", MONTH_FOLDER, 3), F.lit("")), F.lit("99")).cast("int").alias("month"),
        F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"),
    ).filter("folder != '' AND service != ''")


def _state(spark: SparkSession, table: str) -> tuple[DataFrame, int]:
    """The newest complete version of the table, and its number; empty and 0 at first."""
    path = spark._jvm.org.apache.hadoop.fs.Path(table)
    files = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    known = []
    if files.exists(path):
        for status in files.listStatus(path):
            done = spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
            name = status.getPath().getName()
            if name.startswith("version=") and files.exists(done):
                known.append(int(name.partition("=")[2]))
    if not known:
        return spark.createDataFrame([], FILES), 0
    return spark.read.schema(FILES).parquet(f"{table}/version={max(known)}"), max(known)


def _described(spark: SparkSession, new: DataFrame) -> DataFrame:
    """New and changed files with their rows and schema: footers of one month are one job, rows of all files another."""
    folders = [r.folder for r in new.select("folder").distinct().orderBy("folder").collect()]
    found = []
    for path, schema in same_schema_paths(spark, folders):
        if isinstance(schema, str):
            raise ValueError(f"cannot read {path}: {schema}")
        found.append((path, schema.json()))
    if not found:
        return spark.createDataFrame([], FILES)
    schemas = spark.createDataFrame(found, "at string, schema string")
    # A month's folder has one schema, or each of its files its own.
    own, shared = schemas.withColumnsRenamed({"at": "file_at", "schema": "own"}), schemas.withColumnsRenamed({"at": "folder_at", "schema": "shared"})
    counted = None
    for text, paths in _by_schema(found).items():
        part = spark.read.schema(T.StructType.fromJson(json.loads(text))).option("recursiveFileLookup", True).parquet(*paths)
        part = part.groupBy(F.col("_metadata.file_path").alias("counted")).agg(F.count(F.lit(1)).alias("counted_rows"))
        counted = part if counted is None else counted.unionByName(part)
    slashes = lambda c: F.regexp_replace(c, r"^file:/+", "file:/")
    joined = new.join(own, new["path"] == F.col("file_at"), "left").join(shared, F.col("folder") == F.col("folder_at"), "left")
    joined = joined.join(counted, slashes(F.col("path")) == slashes(F.col("counted")), "left")
    return joined.withColumns({"rows": F.coalesce("counted_rows", F.lit(0).cast("long")), "schema": F.coalesce("own", "shared")}).select(*_KEPT)


def _by_schema(found: Iterable[tuple[str, str]]) -> dict[str, list[str]]:
    out: dict[str, list[str]] = defaultdict(list)
    for path, schema in found:
        out[schema].append(path)
    return out


def refresh(spark: SparkSession, base: str, table: str) -> Refreshed:
    """List the lake, compare it with the table, read the footers of what is new, and write the table's next version.

    ``months`` has a row per service and month: ``change`` is added, gone, changed or same, ``rows_before`` and
    ``rows`` its rows. A file is the same if path, size and time are. Nothing is written if nothing changed. A run that
    fails leaves the version before.
    """
    before, version = _state(spark, table)
    try:
        now = materialize(listed(spark, base))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        now = before.select(*_KEPT[:7]).limit(0)
    same = now.join(before.select("path", "bytes", "modified", "rows", "schema"), ["path", "bytes", "modified"]).select(*_KEPT)
    new = now.join(before, ["path", "bytes", "modified"], "left_anti")
    files = materialize(same.unionByName(_described(spark, materialize(new))))
    left = before.join(files, ["path", "bytes", "modified"], "left_anti")
    old = before.groupBy(*MONTH).agg(F.sum("rows").alias("rows_before"))
    current = files.groupBy(*MONTH).agg(F.sum("rows").alias("rows"))
    touched = new.select(*MONTH).union(left.select(*MONTH)).distinct().withColumn("touched", F.lit(True))
    change = (
        F.when(F.col("rows_before").isNull(), "added").when(F.col("rows").isNull(), "gone").when(F.col("touched"), "changed").otherwise("same")
    )
    months = old.join(current, list(MONTH), "full").join(touched, list(MONTH), "left")
    months = materialize(months.select(*MONTH, change.alias("change"), "rows_before", "rows"))
    if months.filter("change != 'same'").take(1):
        version += 1
        files.write.mode("overwrite").parquet(f"{table}/version={version}")
    return Refreshed(files, months, version)


def read_listed(spark: SparkSession, files: DataFrame, absent_as_zero: bool = False) -> DataFrame:
    """The unified trips of files of the table, with ``file_year`` and ``file_month``; neither listed nor asked for footers again.

    Files of one service and schema are one scan. The driver receives the paths of the files.
    """
    groups: dict[tuple[str, str], list[str]] = defaultdict(list)
    for r in files.select("service", "schema", "path").orderBy("path").collect():
        groups[r.service, r.schema].append(r.path)
    parts = []
    for (service, text), paths in groups.items():
        feed = spark.read.schema(T.StructType.fromJson(json.loads(text))).parquet(*paths)
        path = F.col("_metadata.file_path")
        feed = feed.withColumns({f"file_{p}": F.regexp_extract(path, MONTH_FOLDER, i).cast("int") for i, p in ((2, "year"), (3, "month"))})
        parts.append(unify(feed, service, absent_as_zero, ("file_year", "file_month")))
    return union_trips(parts, spark)

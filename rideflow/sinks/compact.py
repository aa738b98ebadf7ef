"""Files of a table by month, and the merge of months that runs have left in many small files."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rideflow.operators.lookup import lookup_join
from rideflow.session import materialize
from rideflow.sinks.tables import TRIP_PARTITIONS, write_partitioned

TARGET_BYTES = 256 * 1024 * 1024
#: Files of a merged month are between these shares of the target, as far as its rows compress alike; a smaller month is one file.
BAND = (0.45, 1.3)
#: Bytes of files that a task writes, as long as they are of different months; a larger file has a task of its own.
TASK_BYTES = 64 * 1024 * 1024


def table_files(spark: SparkSession, path: str, keys: Sequence[str] = TRIP_PARTITIONS) -> DataFrame:
    """``path``, keys, ``bytes`` and ``rows`` of each data file that holds rows; from footers, contents are not read."""
    meta = F.col("_metadata")
    counted = spark.read.parquet(path).groupBy(*keys, meta["file_path"].alias("path"), meta["file_size"].alias("bytes"))
    return counted.agg(F.count(F.lit(1)).alias("rows"))


def month_files(files: DataFrame, target: int = TARGET_BYTES, keys: Sequence[str] = TRIP_PARTITIONS) -> DataFrame:
    """Per month: ``files, rows, bytes``, the ``pieces`` to cut it into, and whether it is ``fragmented``.

    ``pieces`` comes from the bytes a row of the month's largest file, where footers weigh least, so that each has at most
    the target. A month is fragmented if its files are below the band on average, or one of them is above it.
    """
    largest = F.max_by(F.struct("bytes", "rows"), "bytes")
    months = files.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"), largest.alias("largest")
    )
    needed = F.ceil(F.col("largest.bytes") / F.col("largest.rows") * F.col("rows") / F.lit(target))
    small = (F.col("files") > 1) & (F.col("bytes") / F.col("files") < F.lit(BAND[0] * target))
    return months.select(
        *keys, "files", "rows", "bytes", F.least(F.greatest(needed, F.lit(1)), F.col("rows")).alias("pieces"),
        (small | (F.col("largest.bytes") > F.lit(BAND[1] * target)) & (F.col("rows") > 1)).alias("fragmented"),
    )


def compact_months(spark: SparkSession, path: str, target: int = TARGET_BYTES, keys: Sequence[str] = TRIP_PARTITIONS) -> DataFrame:
    """Rewrite the fragmented months of a table as files of about ``target`` bytes; returns the months as they were before.

    The rows of a month keep their order and are cut into pieces of equal rows, one file each, so a large month is
    spread over many tasks. A task writes one file of each of several months, up to ``TASK_BYTES``, so many small files do not
    need as many tasks. New files are written beside the table first; then each month's folder is renamed into place. A run
    that dies before the renames leaves the table as it was, one that dies between the two of a month leaves its old rows
    in a hidden folder, which the next run puts back. No other job may write to these months meanwhile.
    """
    fs, at = _files(spark, path)
    _put_back(fs, at, path)
    files = materialize(table_files(spark, path, keys))
    months = materialize(month_files(files, target, keys))
    chosen = [tuple(r[k] for k in keys) for r in months.filter("fragmented").select(*keys).collect()]
    if not chosen:
        return months
    in_month = Window.partitionBy(*keys)
    ranked = files.join(months.filter("fragmented").select(*keys, "pieces", F.col("rows").alias("_all")), list(keys))
    before = F.sum("rows").over(in_month.orderBy("path").rowsBetween(Window.unboundedPreceding, -1))
    ranked = ranked.withColumn("_before", F.coalesce(before, F.lit(0)))
    # Months of like size share their tasks. Months are few, so one order of them all is small.
    by_size = Window.orderBy(F.desc("pieces"), *keys)
    shared = F.floor((F.row_number().over(by_size) - 1) / max(1, TASK_BYTES // target))
    grouped = materialize(months.filter("fragmented").select(*keys, "pieces", shared.alias("_group")))
    groups = grouped.groupBy(F.col("_group").alias("_of")).agg(F.max("pieces").alias("_tasks"))
    groups = materialize(groups.withColumn("_first", F.sum("_tasks").over(Window.orderBy("_of")) - F.col("_tasks")))
    first = grouped.join(groups, F.col("_group") == F.col("_of")).select(*keys, "_first")
    places = materialize(ranked.join(first, list(keys)).select(F.col("path").alias("_path"), "_before", "_all", "pieces", "_first"))
    tasks = groups.agg(F.sum("_tasks")).first()[0]

    wanted = F.struct(*keys).isin([F.struct(*[F.lit(v) for v in month]) for month in chosen])
    meta = F.col("_metadata")
    rows = spark.read.parquet(path)
    columns = rows.columns
    rows = rows.filter(wanted).select(*columns, meta["file_path"].alias("_path"), meta["row_index"].alias("_row"))
    placed = lookup_join(rows, places, {"_path": "_path"}, "inner")
    piece = F.floor((F.col("_before") + F.col("_row")) * F.col("pieces") / F.col("_all"))
    placed = placed.withColumn("_task", (F.col("_first") + piece).cast("int")).withColumn("_at", F.col("_before") + F.col("_row"))
    cut = placed.repartitionById(int(tasks), F.col("_task")).sortWithinPartitions(*keys, "_at").select(*columns)
    staged = f"{path}/_compacting-{uuid.uuid4().hex}"
    write_partitioned(cut, staged, keys)
    for month in chosen:
        folder = "/".join(f"{k}={v}" for k, v in zip(keys, month))
        old = f"{path}/_old/{folder}"
        fs.mkdirs(at(old).getParent())
        if not (fs.rename(at(f"{path}/{folder}"), at(old)) and fs.rename(at(f"{staged}/{folder}"), at(f"{path}/{folder}"))):
            raise OSError(f"cannot put the new files of {folder} into place; the old ones are in {old}")
        fs.delete(at(old), True)
    fs.delete(at(staged), True)
    return months


def _files(spark: SparkSession, path: str):
    """The file system of a path, and a function that makes paths of it."""
    at = spark._jvm.org.apache.hadoop.fs.Path
    return at(path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), at


def _put_back(fs, at, path: str) -> None:
    """After a run that died: months without a folder get their old one back; old folders of finished months go."""
    old = f"{path}/_old"
    if not fs.exists(at(old)):
        return
    for year in fs.listStatus(at(old)):
        for month in fs.listStatus(year.getPath()):
            place = at(f"{path}/{year.getPath().getName()}/{month.getPath().getName()}")
            if not fs.exists(place):
                fs.rename(month.getPath(), place)
    fs.delete(at(old), True)

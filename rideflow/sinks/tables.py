"""Partitioned tables, reports, CSV extracts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

TRIP_PARTITIONS = ("pickup_year", "pickup_month")


def balance(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Shuffle rows of equal keys together, in pieces of the advisory size.

    A month with few rows becomes one file; a large one is split over many tasks.
    """
    return df.hint("rebalance", *keys)


def write_partitioned(
    df: DataFrame, path: str, keys: Sequence[str] = TRIP_PARTITIONS, mode: str = "overwrite", dynamic: bool = False
) -> None:
    """Parquet folders by ``keys``; ``dynamic`` replaces only the folders that get rows."""
    overwrite = "dynamic" if dynamic else "static"
    df.write.mode(mode).option("partitionOverwriteMode", overwrite).partitionBy(*keys).parquet(path)


def drop_month(spark: SparkSession, path: str, year: int, month: int, keys: Sequence[str] = TRIP_PARTITIONS) -> None:
    """Remove the folder of a month, if there is one."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{keys[0]}={year}/{keys[1]}={month}")
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def write_report(lines: DataFrame, path: str) -> None:
    """Report lines as one text file, in order; a report has a fixed few lines."""
    lines.coalesce(1).sortWithinPartitions("line_no").select("value").write.mode("overwrite").text(path)


def write_report_table(report: DataFrame, path: str) -> None:
    report.coalesce(1).write.mode("overwrite").parquet(path)


def export_month(trips: DataFrame, path: str, year: int, month: int) -> None:
    """One month of processed trips as CSV with a header."""
    selected = trips.filter((trips.pickup_year == year) & (trips.pickup_month == month))
    selected.write.mode("overwrite").option("header", True).csv(path)

"""Where streams go: console, Parquet files, versions of updated rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

TRIGGER = "10 seconds"


def triggered(writer: DataStreamWriter, drain: bool, every: str) -> DataStreamWriter:
    return writer.trigger(availableNow=True) if drain else writer.trigger(processingTime=every)


def to_console(stream: DataFrame, every: str = TRIGGER) -> StreamingQuery:
    """Changed rows after each trigger, in full width."""
    writer = stream.writeStream.outputMode("update").format("console").option("truncate", False)
    return triggered(writer, False, every).start()


def to_parquet(
    stream: DataFrame, path: str, checkpoint: str, drain: bool = False, every: str = TRIGGER
) -> StreamingQuery:
    """Finished rows as Parquet files, exactly once. ``drain`` stops when the input is used up."""
    writer = stream.writeStream.outputMode("append").format("parquet").option("path", path)
    return triggered(writer.option("checkpointLocation", checkpoint), drain, every).start()


def to_versions(
    stream: DataFrame, path: str, checkpoint: str, drain: bool = False, every: str = TRIGGER
) -> StreamingQuery:
    """Changed rows as Parquet, a folder per micro-batch; a repeated batch replaces its folder."""

    def write_batch(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/batch={batch}")

    writer = stream.writeStream.outputMode("update").foreachBatch(write_batch)
    return triggered(writer.option("checkpointLocation", checkpoint), drain, every).start()


def latest_versions(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The newest version of each row written by ``to_versions``.

    One aggregate per column, so that numbers stay in a hash aggregation that combines before the shuffle.
    """
    rows = spark.read.parquet(path)
    values = [c for c in rows.columns if c not in (*keys, "batch")]
    return rows.groupBy(*keys).agg(*(F.max_by(c, "batch").alias(c) for c in values))

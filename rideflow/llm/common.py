"""What several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rideflow.session import materialize, new_folder

__all__ = ["arrow_batches", "document_words", "fresh", "materialize", "read_table", "sized", "small_batches", "whole_text", "written"]

#: Rows of one Arrow batch. A document may hold megabytes, so batches are kept short.
BATCH_ROWS = 200
#: A maximal run of characters other than ASCII white space.
DOCUMENT_WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the given folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))


def document_words(text: Column) -> Column:
    """Number of words between ASCII white space."""
    return F.regexp_count(text, F.lit(DOCUMENT_WORD)).cast("long")


_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Bound what a Python worker holds of long texts at once."""
    spark.conf.set(_BATCH, str(BATCH_ROWS))


@contextmanager
def arrow_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """So many rows in a batch for what is computed within."""
    usual = spark.conf.get(_BATCH)
    spark.conf.set(_BATCH, str(rows))
    try:
        yield
    finally:
        spark.conf.set(_BATCH, usual)


def fresh(df: DataFrame, wanted: str) -> str:
    """The wanted column name, or a longer one when the frame has it already (in either case)."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


#: Narrow rows of a task where the number of rows is known.
TASK_ROWS = 200_000


def sized(df: DataFrame, rows: int) -> DataFrame:
    """In as many tasks as so many narrow rows need, rather than in all shuffle partitions."""
    return df.coalesce(max(4, -(-rows // TASK_ROWS)))


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The frame as a Parquet table in the shared folder: computed once, free of lineage."""
    folder = new_folder(df.sparkSession, purpose)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)

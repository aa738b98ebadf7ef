"""Files of the lake that cannot be read, kept as a table with the reason; the others are read."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rideflow.session import materialize
from rideflow.sources.ingest import listed, read_listed
from rideflow.sources.trips import probe_files, same_schema_paths, schema_key


@dataclass(frozen=True)
class Probed:
    """``sound`` files with their rows and schema, as ``read_listed`` takes them, and ``quarantined`` ones with the reason."""

    sound: DataFrame
    quarantined: DataFrame

    def trips(self, absent_as_zero: bool = False) -> DataFrame:
        """The unified trips of the sound files."""
        return read_listed(self.sound.sparkSession, self.sound, absent_as_zero)


def probe_lake(spark: SparkSession, base: str, deep: bool = True) -> Probed:
    """List the month folders below ``base`` once and try each file.

    ``deep`` decodes every column, which finds damaged pages; else only footers are read. A month without any readable
    file is quarantined whole. Nothing is moved or deleted. Files without rows are sound but not read; files of
    no bytes are not listed at all. A lake without files gives
    two empty tables.
    """
    files = materialize(listed(spark, base))
    folders = [r.folder for r in files.select("folder").distinct().orderBy("folder").collect()]
    groups: dict[tuple, tuple[T.StructType, list[str]]] = {}
    described = []
    for path, schema in same_schema_paths(spark, folders, ignoreCorruptFiles="true"):
        if isinstance(schema, str):
            continue
        groups.setdefault(schema_key(schema), (schema, []))[1].append(path)
        described.append((path, schema.json()))
    probed = probe_files(spark, files, groups.values(), deep)
    schemas = spark.createDataFrame(described, "at string, schema string")
    own = schemas.withColumnsRenamed({"at": "own_at", "schema": "own"})
    known = files.join(probed, "path").join(own, F.col("path") == F.col("own_at"), "left").join(schemas, F.col("folder") == F.col("at"), "left")
    known = materialize(known.withColumn("schema", F.coalesce("own", "schema")))
    kept = ("path", "folder", "service", "year", "month", "bytes", "modified", "rows", "schema")
    sound = known.filter("reason IS NULL AND schema IS NOT NULL AND rows > 0").select(*kept)
    return Probed(sound, known.filter("reason IS NOT NULL").select(*kept[:7], "reason"))


def write_quarantine(quarantined: DataFrame, path: str) -> None:
    """Add the files of this run to a table of all runs, under the day they were found."""
    found = quarantined.withColumn("found", F.current_date())
    found.write.mode("append").partitionBy("found").parquet(path)

"""Zone, centroid, weather and holiday tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from rideflow import schemas


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.ZONES).option("header", True).csv(path)


def read_zones_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """The zone table, or None where it is absent or empty; other errors are raised."""
    try:
        zones = read_zones(spark, path)
        return None if zones.isEmpty() else zones
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_centroids(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.CENTROIDS).option("header", True).csv(path)


def read_weather(spark: SparkSession, path: str) -> DataFrame:
    """Weather documents, one per file."""
    return spark.read.schema(schemas.WEATHER_DOCUMENT).option("multiLine", True).json(path)


def read_holidays(spark: SparkSession, path: str) -> DataFrame:
    """One ``holiday`` date per line."""
    schema = T.StructType([T.StructField("holiday", T.DateType())])
    return spark.read.schema(schema).option("header", True).csv(path)

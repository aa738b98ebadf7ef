"""Zones grouped by their daily demand profile."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark import StorageLevel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rideflow.ml.features import assembler

PROFILE = tuple(f"h{hour:02d}" for hour in range(24))


def profile_vectors(profiles: DataFrame) -> DataFrame:
    """One 24-value vector per zone."""
    return assembler(PROFILE, "profile").transform(profiles).select("zone_id", "profile")


def fit_clusters(vectors: DataFrame, k: int, seed: int = 42) -> KMeansModel:
    # Spark keeps the vectors itself while it iterates, unless they are kept already.
    return KMeans(featuresCol="profile", predictionCol="cluster", k=k, seed=seed).fit(vectors)


def choose_k(vectors: DataFrame, ks: Iterable[int], seed: int = 42) -> tuple[DataFrame, KMeansModel]:
    """Cost and silhouette of each k, where the costs bend, and the model of highest silhouette."""
    spark = vectors.sparkSession
    vectors = vectors.persist(StorageLevel.MEMORY_AND_DISK)
    measure = ClusteringEvaluator(featuresCol="profile", predictionCol="cluster")
    rows, best, best_model = [], -2.0, None
    for k in ks:
        model = fit_clusters(vectors, k, seed)
        silhouette = measure.evaluate(model.transform(vectors))
        rows.append((k, model.summary.trainingCost, silhouette))
        if silhouette > best:
            best, best_model = silhouette, model
    vectors.unpersist()
    table = spark.createDataFrame(rows, "k int, cost double, silhouette double")
    return with_elbow(table.withColumn("chosen", F.col("silhouette") == best)), best_model


def with_elbow(costs: DataFrame) -> DataFrame:
    """A table of ``k`` and ``cost``, a few rows, with ``bend`` and ``elbow``.

    ``bend`` is how far a cost lies below the line from the first to the last, both axes from 0 to 1; the elbow is
    the k of the largest bend, the smaller of equal ones. Where all costs are equal there is none.
    """
    first, last = F.min(F.struct("k", "cost")), F.max(F.struct("k", "cost"))
    ends = costs.agg(first.alias("first"), last.alias("last")).first()
    if ends["first"] is None or ends["first"]["cost"] == ends["last"]["cost"]:
        return costs.withColumns({"bend": F.lit(0.0), "elbow": F.lit(False)})
    (k0, c0), (k1, c1) = ends["first"], ends["last"]
    along, down = (F.col("k") - k0) / F.lit(float(k1 - k0)), (F.lit(float(c0)) - F.col("cost")) / F.lit(float(c0 - c1))
    bent = costs.withColumn("bend", down - along)
    best = bent.agg(F.max_by("k", F.struct("bend", -F.col("k")))).first()[0]
    return bent.withColumn("elbow", (F.col("k") == F.lit(best)) & (F.col("bend") > 0))


def assign_clusters(vectors: DataFrame, model: KMeansModel) -> DataFrame:
    return model.transform(vectors).select("zone_id", "cluster")

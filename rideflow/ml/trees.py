"""Tree ensembles as a table of nodes, and scoring by descent over that table."""

from __future__ import annotations

from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rideflow.ml.models import save
from rideflow.session import new_folder

#: An ensemble of 1,000 trees of depth 10 has at most two million nodes of some 50 bytes.
MAX_NODES = 4_000_000


def node_table(spark: SparkSession, model: Model, path: str | None = None) -> DataFrame:
    """A row per node of a regression ensemble: ``tree, weight, node, prediction, left, right, feature, threshold, left_categories``.

    A leaf has no children. ``weight`` is the tree's share in the sum; ``left_categories`` is set where the split is on
    categories, ``threshold`` elsewhere. The nodes come from the model's saved table below ``path``, by default a new shared folder.
    """
    path = path or new_folder(spark, "trees")
    save(model, path)
    weights = model.treeWeights
    share = 1.0 / len(weights) if isinstance(model, RandomForestRegressionModel) else 1.0
    known = spark.createDataFrame([(n, w * share) for n, w in enumerate(weights)], "treeID int, weight double")
    nodes = spark.read.parquet(f"{path}/data").join(known, "treeID")
    node, split = F.col("nodeData"), F.col("nodeData.split")
    inner, numeric = node["leftChild"] >= 0, split["numCategories"] < 0
    values = split["leftCategoriesOrThreshold"]
    return nodes.select(
        F.col("treeID").alias("tree"), "weight", node["id"].alias("node"), node["prediction"].alias("prediction"),
        F.when(inner, node["leftChild"]).alias("left"), F.when(inner, node["rightChild"]).alias("right"),
        F.when(inner, split["featureIndex"]).alias("feature"), F.when(inner & numeric, F.get(values, F.lit(0))).alias("threshold"),
        F.when(inner & ~numeric, values).alias("left_categories"),
    )


def _descend(tree: Column, inputs: Column, depth: int) -> Column:
    """The node reached after ``depth`` steps from the root; a leaf stays where it is."""

    def step(node: Column, _: Column) -> Column:
        value = F.get(inputs, node["feature"])
        to_left = F.when(node["left_categories"].isNotNull(), F.array_contains(node["left_categories"], value)).otherwise(value <= node["threshold"])
        child = F.when(to_left, node["left"]).otherwise(node["right"])
        return F.when(node["left"].isNull(), node).otherwise(F.get(tree["nodes"], child))

    root = F.get(tree["nodes"], F.lit(0))
    return F.reduce(F.sequence(F.lit(1), F.lit(depth)), root, step) if depth else root


def score_by_nodes(rows: DataFrame, nodes: DataFrame, depth: int, features: str = "features", output: str = "prediction") -> DataFrame:
    """Rows with the ensemble's prediction, found by walking each tree of the node table down from its root.

    ``depth`` is the greatest depth of a tree. Nodes are numbered from 0 without gaps in each tree, so a tree is an array
    looked up by number; the ensemble is one value of checked size that all tasks share, and rows are not multiplied or shuffled.
    Rows without a vector get null; an empty table predicts null.
    """
    counted = nodes.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    if counted > MAX_NODES:
        raise ValueError(f"{counted} nodes are more than {MAX_NODES}")
    parts = [c for c in nodes.columns if c not in ("tree", "weight")]
    trees = nodes.groupBy("tree").agg(F.first("weight").alias("weight"), F.array_sort(F.collect_list(F.struct("node", *[p for p in parts if p != "node"]))).alias("nodes"))
    ensemble = trees.agg(F.array_sort(F.collect_list(F.struct("tree", "weight", "nodes"))).alias("trees"))
    inputs = vector_to_array(features)
    carried = rows.withColumns({"_trees": ensemble.scalar(), "_inputs": F.when(F.col(features).isNotNull(), inputs)})
    leaves = F.transform("_trees", lambda tree: tree["weight"] * _descend(tree, F.col("_inputs"), depth)["prediction"])
    total = F.when(F.col("_inputs").isNotNull() & (F.size("_trees") > 0), F.reduce(leaves, F.lit(0.0), lambda total, leaf: total + leaf))
    return carried.withColumn(output, total).drop("_trees", "_inputs")

from __future__ import annotations

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import functions as F

from rideflow.ml import models, trees
from rideflow.operators.errors import error_by_zone, residual_distribution
from rideflow.operators.splits import forward_bounds, forward_split
from rideflow.plans.training import train_models
from workload import queries as q


@pytest.fixture(scope="module")
def vectors(spark):
    rows = spark.range(3000).selectExpr("id", "cast(id % 17 as double) a", "cast(id % 29 as double) b", "concat('k', id % 11) kind")
    rows = rows.withColumn("y", F.col("a") * F.col("b") + F.hash("kind") % 50)
    made = Pipeline(stages=[StringIndexer(inputCol="kind", outputCol="k"), VectorAssembler(inputCols=["a", "b", "k"], outputCol="features")])
    return made.fit(rows).transform(rows).cache()


@pytest.mark.parametrize("kind, number, depth", [("gbt", 4, 5), ("forest", 5, 6), ("gbt", 2, 0)])
def test_descent_equals_the_model(spark, vectors, kind, number, depth):
    model = models.fit(getattr(models, kind)("y", number, depth), vectors)
    nodes = trees.node_table(spark, model)
    assert nodes.select("tree").distinct().count() == model.getNumTrees and nodes.count() == model.totalNumNodes
    if model.getMaxDepth():
        assert not nodes.filter("left_categories IS NOT NULL").isEmpty() and not nodes.filter("threshold IS NOT NULL").isEmpty()
    both = trees.score_by_nodes(model.transform(vectors).withColumnRenamed("prediction", "known"), nodes, model.getMaxDepth())
    assert both.count() == 3000 and both.filter(~(F.abs(F.col("known") - F.col("prediction")) < 1e-9)).isEmpty()
    assert both.columns == [*vectors.columns, "known", "prediction"]


def test_rows_without_a_vector_and_empty_tables(spark, vectors, monkeypatch):
    nodes = trees.node_table(spark, models.fit(models.gbt("y", 2, 3), vectors))
    odd = vectors.select("id", F.when(F.col("id") > 0, F.col("features")).alias("features")).limit(5)
    scored = trees.score_by_nodes(odd, nodes, 3)
    assert scored.filter("(prediction IS NULL) = (id > 0)").isEmpty()
    assert trees.score_by_nodes(vectors.limit(0), nodes, 3).isEmpty()
    assert trees.score_by_nodes(vectors.limit(2), nodes.limit(0), 3).filter("prediction IS NOT NULL").isEmpty()
    monkeypatch.setattr(trees, "MAX_NODES", 3)
    with pytest.raises(ValueError, match="nodes"):
        trees.score_by_nodes(vectors, nodes, 3)


def test_folds_grow_and_touch(spark):
    bounds = forward_bounds("2022-01-01", "2022-01-11", 4)
    assert bounds == [("2022-01-03", "2022-01-05"), ("2022-01-05", "2022-01-07"), ("2022-01-07", "2022-01-09"), ("2022-01-09", "2022-01-11")]
    days = spark.range(-2, 20).select(F.expr("timestamp'2022-01-01' + make_dt_interval(cast(id as int))").alias("pickup_ts"))
    days = days.unionByName(spark.createDataFrame([(None,)], "pickup_ts timestamp"))
    sizes = [tuple(p.count() for p in forward_split(days, b, "2022-01-01")) for b in bounds]
    assert sizes == [(2, 2), (4, 2), (6, 2), (8, 2)]
    for wrong in (("2022-01-01", "2022-01-03", 4), ("2022-01-01", "2023-01-01", 0)):
        with pytest.raises(ValueError, match="folds"):
            forward_bounds(*wrong)


def test_settings_are_ranked_over_all_folds(spark):
    results = spark.createDataFrame(
        [(0, 0, 1.0), (0, 1, 9.0), (1, 0, 4.0), (1, 1, 4.0), (2, 0, 0.1), (2, 1, None), (3, 0, 4.0), (3, 1, 4.0)], "setting int, fold int, rmse double"
    )
    found = {r.setting: (r.mean_rmse, r.rank, r.chosen) for r in models.ranked_settings(results).collect()}
    assert found == {0: (5.0, 3, False), 1: (4.0, 1, True), 2: (None, 4, False), 3: (4.0, 2, False)}


def test_walk_forward_fits_each_setting_on_each_fold(spark, vectors):
    folds = [lambda n=n: (vectors.filter(F.col("id") < n), vectors.filter((F.col("id") >= n) & (F.col("id") < n + 500))) for n in (1000, 2000)]
    grid = [{"maxDepth": 1, "numTrees": 1}, {"maxDepth": 6, "numTrees": 4}]
    table = models.walk_forward(models.forest("y"), grid, folds, "y")
    assert {(r.setting, r.fold, r["rows"]) for r in table.collect()} == {(s, f, 500) for s in (0, 1) for f in (0, 1)}
    assert {r.setting for r in table.filter("chosen").collect()} == {1}


def test_residuals_and_zones(spark):
    scored = spark.createDataFrame(
        [(1, 10.0, 9.0, 12.0), (1, 10.0, 5.0, None), (2, 20.0, 26.0, 20.0), (2, None, 1.0, 1.0), (None, 7.0, 7.0, 7.0)],
        "pu_location_id bigint, y double, p double, other double",
    )
    bands = {(r.model, r.low, r.high): (r["rows"], r.share) for r in residual_distribution(scored, "y", {"m": "p", "n": "other"}).collect()}
    assert bands == {
        ("m", 0.0, 5.0): (2, 0.5), ("m", 5.0, 10.0): (1, 0.25), ("m", -10.0, -5.0): (1, 0.25),
        ("n", 0.0, 5.0): (2, 2 / 3), ("n", -5.0, 0.0): (1, 1 / 3),
    }
    zones = {r.pu_location_id: (r["rows"], r.mae, r.bias) for r in error_by_zone(scored, {"fare": ("y", "p")}).collect()}
    assert zones[1] == (2, 3.0, 3.0) and zones[2] == (1, 6.0, -6.0) and zones[None] == (1, 0.0, 0.0)
    assert error_by_zone(scored, {"fare": ("y", "p")}, min_rows=2).count() == 1


def test_the_whole_amount_may_be_predicted(spark, sf_dir):
    trained = train_models(q.featured(spark, sf_dir), iterations=1, depth=2, tasks=("total",))
    row = trained.metrics.first()
    assert row.task == "total" and row["rows"] > 0 and set(trained.models) == {"total"}

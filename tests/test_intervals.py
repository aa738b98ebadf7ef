from __future__ import annotations

import math
import random

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from rideflow.ml import intervals, normal


def rows_of(n, seed=1):
    rng = random.Random(seed)
    return [(i % 3, i % 2, rng.gauss(0, 1 + i % 3), 0.0) for i in range(n)]


SCHEMA = "hour int, rain int, y double, p double"


def exact(values, coverage=0.9):
    values, n, miss = sorted(values), len(values), (1 - coverage) / 2
    return values[max(1, math.floor((n + 1) * miss)) - 1], values[min(n, math.ceil((n + 1) * (1 - miss))) - 1]


def test_bounds_of_merged_sketches_are_the_exact_ranks(spark):
    data = rows_of(900)
    fine = intervals.residual_sketches(spark.createDataFrame(data, SCHEMA).repartition(5), "y", "p", ("hour", "rain"))
    for keys in (("hour", "rain"), ("hour",), ()):
        for r in intervals.bounds(intervals.merged(fine, keys)).collect():
            held = [y for h, w, y, _ in data if all(r[k] == v for k, v in (("hour", h), ("rain", w)) if k in keys)]
            assert (r.rows, r.low, r.high) == (len(held), *exact(held))


def test_sketches_of_two_tables_merge(spark):
    parts = [intervals.residual_sketches(spark.createDataFrame(rows_of(400, seed), SCHEMA), "y", "p", ("hour",)) for seed in (1, 2)]
    both = intervals.bounds(intervals.merged(parts[0].unionByName(parts[1]))).first()
    assert (both.low, both.high) == exact([y for seed in (1, 2) for _, _, y, _ in rows_of(400, seed)])


def test_ranges_come_from_the_finest_group_with_enough_rows(spark):
    data = rows_of(600) + [(9, 0, 1.0, 0.0)]
    sketches = intervals.residual_sketches(spark.createDataFrame(data, SCHEMA), "y", "p", ("hour", "rain"))
    asked = spark.createDataFrame([(0, 0, None, 5.0), (9, 0, None, 5.0), (None, 0, None, 5.0), (0, 0, None, None)], SCHEMA)
    ranged = intervals.with_range(asked, "p", sketches, (("hour", "rain"), ("rain",), ()), least_rows=50, floor=3.5).collect()
    told = sorted(((r.hour, r.p, r.level, r.low) for r in ranged), key=str)
    assert [t[:3] for t in told] == [(0, 5.0, 0), (0, None, 0), (9, 5.0, 1), (None, 5.0, 1)]
    assert all(r.low is None or r.low >= 3.5 and r.high > r.p for r in ranged)


def test_new_rows_lie_in_the_range_as_often_as_said(spark):
    known, new = (spark.createDataFrame(rows_of(6000, seed), SCHEMA) for seed in (3, 4))
    sketches = intervals.residual_sketches(known, "y", "p", ("hour", "rain"))
    got = intervals.range_coverage(intervals.with_range(new, "p", sketches, (("hour", "rain"), ())), "y", ("hour",)).collect()
    assert len(got) == 3 and all(0.87 < r.inside / r.rows < 0.93 for r in got)
    assert max(got, key=lambda r: r.hour).mean_width > 2 * min(got, key=lambda r: r.hour).mean_width


def test_a_full_sketch_keeps_its_coverage(spark):
    """More rows than a sketch holds: the ranks move outward by its error."""
    rows = spark.range(50_000).select(((F.col("id") * 7919) % 50_000).cast("double").alias("y"), F.lit(0.0).alias("p"))
    sketch = intervals.residual_sketches(rows, "y", "p", size=256)
    bound = intervals.bounds(sketch, 0.9, 256).first()
    error = intervals.rank_error(256)
    assert (bound.high - bound.low) / 50_000 >= 0.9 - 2 * error and bound.low <= 2500 * (1 + error * 20) and bound.high >= 47_500 - 50_000 * error


def test_no_rows(spark):
    none = intervals.residual_sketches(spark.createDataFrame([], SCHEMA), "y", "p", ("hour",))
    asked = spark.createDataFrame([(0, 0, None, 5.0)], SCHEMA)
    assert intervals.with_range(asked, "p", none, (("hour",), ())).first()["low"] is None


@pytest.fixture(scope="module")
def sample(spark):
    rng = random.Random(7)
    rows = [(a, 1000 + b, c, 3 * a - 0.5 * b + 7 + rng.gauss(0, 0.1)) for a, b, c in ((rng.random(), rng.gauss(0, 50), float(i % 4)) for i in range(500))]
    return spark.createDataFrame([*rows, (None, 1.0, 1.0, 1.0), (1.0, 1.0, 1.0, None)], "a double, b double, c double, y double")


def test_normal_equations_equal_the_library(sample):
    features = ["a", "b", "c"]
    mine = normal.fit(sample.repartition(7), features, "y")
    vectors = VectorAssembler(inputCols=features, outputCol="features").transform(sample.dropna())
    theirs = LinearRegression(labelCol="y", solver="normal").fit(vectors)
    assert mine.coefficients == pytest.approx(theirs.coefficients.toArray(), rel=1e-6, abs=1e-9)
    assert mine.intercept == pytest.approx(theirs.intercept, rel=1e-6)
    scored = sample.withColumn("p", mine.predicted())
    assert scored.filter("a IS NULL").first()["p"] is None
    assert scored.agg(F.avg(F.abs(F.col("y") - F.col("p")))).first()[0] < 0.1


def test_sums_of_parts_add_up(sample):
    whole = {(r.left, r.right): r.total for r in normal.gram(sample, ["a", "b"], "y").collect()}
    parts = normal.gram(sample, ["a", "b"], "y", by=("c",)).groupBy("left", "right").agg(F.sum("total").alias("total")).collect()
    assert {(r.left, r.right): pytest.approx(r.total) for r in parts} == whole


def test_determined_constant_and_absent_rows(spark, sample):
    twice = sample.withColumns({"a2": F.col("a") * 2, "one": F.lit(5.0)})
    model = normal.fit(twice, ["a", "a2", "one"], "y")
    assert model.coefficients[2] == 0.0 and model.coefficients[0] + 2 * model.coefficients[1] == pytest.approx(normal.fit(sample, ["a"], "y").coefficients[0])
    assert normal.fit(sample.limit(0), ["a"], "y") == normal.Linear(("a",), 0.0, (0.0,))


def test_keyed_samples_do_not_depend_on_partitions_and_are_nested(spark):
    from rideflow.operators.splits import keyed_sample

    rows = spark.range(20_000).withColumn("other", F.col("id") % 7)
    drawn = lambda df, rate: {r.id for r in keyed_sample(df, ["id"], rate).collect()}
    small, large = drawn(rows.repartition(3), 0.05), drawn(rows.repartition(11), 0.2)
    assert small == drawn(rows, 0.05) and small < large and 800 < len(small) < 1200
    assert not drawn(rows, 0.0) and len(drawn(rows, 1.0)) == 20_000


def test_the_elbow_is_where_the_costs_bend(spark):
    from rideflow.ml.clusters import with_elbow

    costs = spark.createDataFrame([(2, 100.0), (3, 40.0), (4, 20.0), (5, 15.0), (6, 12.0)], "k int, cost double")
    got = {r.k: (r.bend, r.elbow) for r in with_elbow(costs).collect()}
    assert [k for k, (_, e) in got.items() if e] == [3] and got[2][0] == got[6][0] == 0.0
    assert not any(r.elbow for r in with_elbow(spark.createDataFrame([(2, 5.0), (3, 5.0)], "k int, cost double")).collect())
    assert with_elbow(costs.limit(0)).count() == 0

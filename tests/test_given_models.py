"""Models as data: forests as tables of nodes, many starts at once, and the gradient at a fitted optimum."""

from __future__ import annotations

import random

import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from opine.operators import clusters, forests, models


@pytest.fixture(scope="module")
def points(spark):
    pick = random.Random(8)
    rows = []
    for n in range(400):
        x = [pick.gauss(0, 1) for _ in range(5)]
        rows.append((n, float(x[0] + 0.5 * x[1] * x[2] + pick.gauss(0, 0.5) > 0), x))
    return spark.createDataFrame(rows, "doc_id bigint, label double, point array<double>").withColumn("features", array_to_vector("point")).persist()


@pytest.mark.parametrize("settings", [{"trees": 2, "depth": 2}, {"trees": 7, "depth": 6}])
def test_walking_the_nodes_equals_the_model(spark, points, settings):
    model = models.fit_random_forest(points, models.random_forest(**settings))
    found = forests.score(points, forests.nodes_of(spark, model), depth=settings["depth"])
    wanted = {r.doc_id: r.p for r in model.transform(points).select("doc_id", vector_to_array("probability").alias("p")).collect()}
    for row in found.collect():
        assert row.shares == pytest.approx(wanted[row.doc_id], abs=1e-12)


def test_a_leaf_alone_is_a_tree(spark, points):
    nodes = spark.createDataFrame([(0, 0, -1, None, -1, -1, [0.25, 0.75])], forests.NODES)
    assert {tuple(r.shares) for r in forests.score(points, nodes).collect()} == {(0.25, 0.75)}


def test_costs_of_starts_equal_each_start_alone(spark, points):
    given = [r.point for r in points.orderBy("doc_id").limit(8).collect()]
    starts = [given[k : k + 2] for k in range(0, 8, 2)]
    found = {r.start: r.cost for r in clusters.costs_of_starts(points, starts).collect()}
    for n, centres in enumerate(starts):
        alone = clusters.assign(points, centres).agg(F.sum("dist2")).first()[0]
        assert found[n] == pytest.approx(alone)
    assert clusters.best_start(points, starts) == min(found, key=lambda n: (found[n], n))


@pytest.mark.parametrize("reg", [0.0, 0.1])
def test_gradient_is_zero_at_the_fitted_optimum_only(points, reg):
    fitted = LogisticRegression(maxIter=200, tol=1e-12, regParam=reg, standardization=False).fit(points)
    weights = [float(w) for w in fitted.coefficients]
    at = models.logistic_gradient(points, weights, fitted.intercept, reg).collect()
    assert len(at) == 6 and max(abs(r.gradient) for r in at) < 1e-5
    assert at[0].loss == pytest.approx(fitted.summary.objectiveHistory[-1], abs=1e-6)
    beside = models.logistic_gradient(points, [w + 0.1 for w in weights], fitted.intercept, reg).collect()
    assert max(abs(r.gradient) for r in beside) > 1e-3 and beside[0].loss > at[0].loss

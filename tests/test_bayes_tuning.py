from __future__ import annotations

import random

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from opine.operators import bayes_tuning, features, metrics, models, splits


@pytest.fixture(scope="module")
def reviews(spark):
    pick = random.Random(2)
    rows = []
    for n in range(240):
        label = float(n % 3 == 0)
        mood = ["good", "great", "fun"] if label else ["bad", "dull", "grim"]
        words = [pick.choice(mood if pick.random() < 0.25 else [f"w{k}" for k in range(60)]) for _ in range(pick.randint(1, 30))]
        rows.append((n, label, " ".join(words)))
    rows += [(500, 1.0, ""), (501, 0.0, "good good"), (501, 0.0, "good good")]
    return spark.createDataFrame(rows, "doc_id bigint, label double, review string").repartition(5)


@pytest.mark.parametrize("size", [16, 50])
def test_equals_sparks_cross_validator_on_the_same_vectors(reviews, size):
    smoothings = [0.05, 1.0]
    tuned = bayes_tuning.tune(reviews, feature_counts=[size], smoothings=smoothings)
    counted = features.with_bucket_counts(reviews, size)
    rows = counted.select(
        "doc_id", "label", features.as_vector("tf", size).alias("rawFeatures"), splits.hash_fold(F.col("doc_id"), 3).alias("fold")
    ).persist()
    classifier = models.naive_bayes()
    validator = CrossValidator(
        estimator=Pipeline(stages=[features.idf(), classifier]),
        estimatorParamMaps=ParamGridBuilder().addGrid(classifier.smoothing, smoothings).build(),
        evaluator=metrics.evaluator(bins=0),
        numFolds=3,
        foldCol="fold",
    )
    fitted = validator.fit(rows)
    found = {r.strength: r.avg_metric for r in tuned.results.collect()}
    assert [found[s] for s in smoothings] == pytest.approx(fitted.avgMetrics, abs=1e-6)
    best = smoothings[max(range(2), key=lambda n: round(fitted.avgMetrics[n], 9))]
    assert tuned.strength == best and tuned.num_features == size
    wanted = {(r.doc_id, r.prediction) for r in fitted.bestModel.transform(rows).collect()}
    assert {(r.doc_id, r.prediction) for r in tuned.predict(reviews).collect()} == wanted


def test_subtracted_sums_are_those_of_the_other_folds(reviews):
    folded = bayes_tuning.vectors(reviews.withColumn("fold", splits.hash_fold(F.col("doc_id"), 3)), [20]).drop("doc_id")
    sums, documents = bayes_tuning.fold_sums(folded)
    outside = bayes_tuning._outside(sums, ["label", "num_features", "bucket"], ["tf", "df"], 3)
    for out in (-1, 0, 2):
        direct = sums.where(F.col("fold") != out).groupBy("label", "bucket").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))
        found = outside.where((F.col("out") == out) & (F.col("df") > 0)).select("label", "bucket", "tf", "df")
        assert found.exceptAll(direct).isEmpty() and direct.exceptAll(found).isEmpty()
    assert documents.agg(F.sum("n")).first()[0] == reviews.count()


def test_rows_with_nulls_take_no_part(spark, reviews):
    odd = spark.createDataFrame([(None, 1.0, "good"), (900, None, "good"), (901, 0.0, None)], reviews.schema)
    settings = {"feature_counts": [16], "smoothings": [1.0]}
    assert (
        bayes_tuning.tune(reviews.unionByName(odd), **settings).results.collect() == bayes_tuning.tune(reviews, **settings).results.collect()
    )


def test_curves_are_counted_apart(spark):
    rows = [(c, n % 7 / 7 + c, float((n * 5 + c) % 3 == 0)) for c in range(3) for n in range(50)]
    scored = spark.createDataFrame(rows, "curve int, score double, label double")
    together = {r.curve: r.auc_roc for r in metrics.auc_roc_by(scored, ["curve"], ranges=4).collect()}
    for curve in range(3):
        alone = metrics.auc_roc(scored.where(F.col("curve") == curve).drop("curve")).first().auc_roc
        assert together[curve] == pytest.approx(alone)

"""Pipelines, parameter grids and cross-validation."""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial
from multiprocessing.pool import ThreadPool
from typing import NamedTuple

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, NaiveBayes
from pyspark.ml.param import Param
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opine.operators import features
from opine.operators.metrics import evaluator
from opine.operators.splits import hash_fold
from opine.session import stage

FEATURE_COUNTS = (300, 400)
STRENGTHS = (0.01, 0.1, 1.0)
FOLDS = 3


def _strength(classifier: LogisticRegression | NaiveBayes) -> Param:
    return classifier.smoothing if isinstance(classifier, NaiveBayes) else classifier.regParam


class Tuned(NamedTuple):
    """num_features, strength and mean metric of each grid point, and the pipeline of the best one, fitted on all rows."""

    points: list[tuple[int, float, float]]
    bestModel: PipelineModel

    def transform(self, rows: DataFrame) -> DataFrame:
        return self.bestModel.transform(rows)


def fit_cross_validated(
    train: DataFrame,
    classifier: LogisticRegression | NaiveBayes,
    key: str = "doc_id",
    parallelism: int = len(STRENGTHS),
    feature_counts: Sequence[int] = FEATURE_COUNTS,
    strengths: Sequence[float] = STRENGTHS,
    folds: int = FOLDS,
) -> Tuned:
    """Fit on cleaned reviews; folds come from the key, so they do not depend on partitioning.

    A text is cut into words and counted once for each bucket count, whatever the number of strengths and folds: the
    sparse counts are written to the shared folder, and every fit reads them. IDF and classifier are fitted on the
    rows outside the fold.
    """
    rows = train.select("label", "review", hash_fold(F.col(key), folds).alias("fold"))
    strength = _strength(classifier)

    def validated(size: int) -> tuple[PipelineModel, list[float]]:
        counting = PipelineModel([features.tokenizer(), features.hashing_tf(size)])
        counts = stage(counting.transform(rows).select("label", "fold", "rawFeatures"), "tuning-counts")
        validator = CrossValidator(
            estimator=Pipeline(stages=[features.idf(), classifier]),
            estimatorParamMaps=ParamGridBuilder().addGrid(strength, list(strengths)).build(),
            evaluator=evaluator(),
            numFolds=folds,
            foldCol="fold",
            parallelism=parallelism,
        )
        fitted = validator.fit(counts)
        return PipelineModel([*counting.stages, *fitted.bestModel.stages]), [float(m) for m in fitted.avgMetrics]

    inherit = inheritable_thread_target(train.sparkSession)
    with ThreadPool(len(feature_counts)) as pool:
        runs = pool.map(lambda run: run(), [inherit(partial(validated, size)) for size in feature_counts])
    points = [(size, float(s), m) for size, (_, found) in zip(feature_counts, runs, strict=True) for s, m in zip(strengths, found, strict=True)]
    best, _ = max(runs, key=lambda run: max(run[1]))  # the first of equal ones
    return Tuned(points, best)


def grid_results_frame(spark: SparkSession, tuned: Tuned) -> DataFrame:
    return spark.createDataFrame(tuned.points, "num_features int, strength double, avg_metric double")


def fit_pipeline(train: DataFrame, classifier: LogisticRegression | NaiveBayes) -> PipelineModel:
    """One pipeline fit on cleaned reviews, models.logistic_regression() or models.naive_bayes().

    The text is cut and counted once; IDF and classifier are fitted on the counts, which are kept as a table.
    """
    counting = PipelineModel([features.tokenizer(), features.hashing_tf()])
    counts = stage(counting.transform(train.select("label", "review")).select("label", "rawFeatures"), "pipeline-counts")
    fitted = Pipeline(stages=[features.idf(), classifier]).fit(counts)
    return PipelineModel([*counting.stages, *fitted.stages])

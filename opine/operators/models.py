"""Classifiers: the settings of each, fitting, and scoring with the id kept."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.classification import LogisticRegression, NaiveBayes, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opine.operators.features import index_to_label, label_indexer


def logistic_regression(max_iter: int = 5, reg_param: float = 0.01) -> LogisticRegression:
    return LogisticRegression(maxIter=max_iter, regParam=reg_param)


def lbfgs_logistic_regression(max_iter: int = 10, reg_param: float = 0.0, intercept: bool = False) -> LogisticRegression:
    """By default ten LBFGS iterations, no regularisation, no intercept."""
    return LogisticRegression(maxIter=max_iter, regParam=reg_param, fitIntercept=intercept)


def logistic_score(point: Column, coefficients: Sequence[float], intercept: float = 0.0) -> Column:
    """The probability of label 1 of an array of numbers, by given coefficients."""
    weights = F.array(*[F.lit(float(c)) for c in coefficients])
    products = F.zip_with(point, weights, lambda x, w: x.cast("double") * w)
    return 1 / (1 + F.exp(-F.aggregate(products, F.lit(float(intercept)), lambda total, x: total + x)))


def logistic_gradient(
    points: DataFrame, coefficients: Sequence[float], intercept: float = 0.0, reg_param: float = 0.0, point: str = "point"
) -> DataFrame:
    """dim, gradient, loss: the objective of a logistic regression and its gradient at given coefficients, in one scan.

    `points` has label (0 or 1) and an array of numbers. The objective is the mean log loss and half of `reg_param` times
    the squared coefficients; dimension -1 is the intercept. At a fitted optimum every gradient is near zero.
    """
    rows = points.select(F.col(point).alias("x"), F.col("label").cast("double").alias("y"))
    rows = rows.withColumn("p", logistic_score(F.col("x"), coefficients, intercept))
    penalty = 0.5 * reg_param * sum(float(c) ** 2 for c in coefficients)
    log_loss = -F.when(F.col("y") > 0, F.log("p")).otherwise(F.log(1 - F.col("p")))
    off = F.col("p") - F.col("y")
    dims = [F.avg(off * F.get("x", F.lit(k))).alias(f"g{k}") for k in range(len(coefficients))]
    sums = rows.agg((F.avg(log_loss) + penalty).alias("loss"), F.avg(off).alias("g"), *dims)
    listed = [F.struct(F.lit(-1).alias("dim"), F.col("g").alias("gradient"))]
    for k, c in enumerate(coefficients):
        listed.append(F.struct(F.lit(k).alias("dim"), (F.col(f"g{k}") + reg_param * float(c)).alias("gradient")))
    return sums.select("loss", F.explode(F.array(*listed)).alias("d")).select("d.dim", "d.gradient", "loss")


def naive_bayes(smoothing: float = 1.0) -> NaiveBayes:
    return NaiveBayes(smoothing=smoothing, modelType="multinomial")


def random_forest(trees: int = 2, depth: int = 2, seed: int = 42) -> RandomForestClassifier:
    """By default two trees of depth two; on indexed labels."""
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, labelCol="indexed", seed=seed)


def fit_random_forest(train: DataFrame, forest: RandomForestClassifier | None = None) -> PipelineModel:
    """Indexer, forest, and the way back: the model's `predicted` holds label text again.

    The forest works on indexes ordered by frequency, which are the labels inverted
    whenever label 1 is the majority; so its predictions are mapped back.
    """
    indexer = label_indexer().fit(train)
    fitted = (forest or random_forest()).fit(indexer.transform(train))
    return PipelineModel([indexer, fitted, index_to_label(indexer, "prediction", "predicted")])


def score(model: Transformer, df: DataFrame, keep: tuple[str, ...] = ("doc_id", "label")) -> DataFrame:
    """The kept columns plus prediction and score, the probability of the second class."""
    probability = vector_to_array("probability")
    return model.transform(df).select(*keep, "prediction", F.get(probability, F.lit(1)).alias("score"))


def score_forest(model: PipelineModel, df: DataFrame, keep: tuple[str, ...] = ("doc_id", "label")) -> DataFrame:
    """As `score`, with predictions as labels and the score of label 1."""
    labels = [float(x) for x in model.stages[0].labels]
    positive = labels.index(1.0) if 1.0 in labels else None
    probability = vector_to_array("probability")
    of_positive = F.lit(0.0) if positive is None else F.get(probability, F.lit(positive))
    return model.transform(df).select(
        *keep, "indexed", F.col("predicted").cast("double").alias("prediction"), of_positive.alias("score")
    )

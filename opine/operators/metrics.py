"""Evaluation of scored rows: label, prediction, score."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from opine.session import stage

def _correct() -> Column:
    """A missing prediction or label is not correct."""
    return F.coalesce(F.col("label") == F.col("prediction"), F.lit(False))


def accuracy() -> Column:
    """Correct rows / all rows, as an aggregate; NULL without rows."""
    return F.try_divide(F.count_if(_correct()).cast("double"), F.count(F.lit(1)).cast("double"))


def error_rate() -> Column:
    """All other rows / all rows, as an aggregate."""
    return F.try_divide(F.count_if(~_correct()).cast("double"), F.count(F.lit(1)).cast("double"))


def true_positives() -> Column:
    return F.count_if((F.col("prediction") == 1.0) & (F.col("label") == 1.0))


def false_positives() -> Column:
    return F.count_if((F.col("prediction") == 1.0) & (F.col("label") == 0.0))


def positives() -> Column:
    return F.count_if(F.col("label") == 1.0)


def recall() -> Column:
    """NULL where no row is positive."""
    return F.try_divide(true_positives().cast("double"), positives().cast("double"))


def precision() -> Column:
    """NULL where no row is predicted positive."""
    return F.try_divide(
        true_positives().cast("double"), (true_positives() + false_positives()).cast("double")
    )


def classification_report(scored: DataFrame) -> DataFrame:
    """Every count and ratio in one pass over the rows."""
    return scored.agg(
        F.count(F.lit(1)).alias("n"),
        accuracy().alias("accuracy"),
        error_rate().alias("test_error"),
        true_positives().alias("tp"),
        false_positives().alias("fp"),
        positives().alias("positives"),
        recall().alias("recall"),
        precision().alias("precision"),
    )


def curve_counts(scored: DataFrame, ranges: int | None = None, by: Sequence[str] = ()) -> DataFrame:
    """One row per distinct score: tp, fp at that score, tp_before, fp_before above it, and the totals p, n.

    `by` names columns that hold several curves apart; they stay in the result.

    Running counts over all scores would put every row in one task. So the distinct
    scores are dealt by ranges, as many as the session's shuffle partitions unless `ranges`
    says otherwise; each range is counted up by itself and starts from the total of the
    ranges above it. Where the ranges are cut only balances the work. The table of distinct
    scores is written once, so the rows are scored once for all its uses.
    """
    is_positive = (F.col("label") == 1.0).cast("bigint")
    counted = scored.groupBy(*by, "score").agg(
        F.sum(is_positive).alias("tp"), F.sum(F.lit(1).cast("bigint") - is_positive).alias("fp")
    )
    order = [*by, "score"]
    by_range = counted.repartitionByRange(ranges, *order) if ranges else counted.repartitionByRange(*order)
    ranged = stage(by_range.withColumn("range", F.spark_partition_id()), "score-counts")

    # one row for each range (and curve) from here on
    totals = ranged.groupBy("range", *by).agg(F.sum("tp").alias("range_tp"), F.sum("fp").alias("range_fp"))
    curve = Window.partitionBy(*by)
    above = curve.orderBy(F.col("range").desc()).rowsBetween(Window.unboundedPreceding, -1)
    everything = curve.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = totals.select(
        "range",
        *by,
        F.coalesce(F.sum("range_tp").over(above), F.lit(0)).alias("tp_offset"),
        F.coalesce(F.sum("range_fp").over(above), F.lit(0)).alias("fp_offset"),
        F.sum("range_tp").over(everything).alias("p"),
        F.sum("range_fp").over(everything).alias("n"),
    )
    before = (
        Window.partitionBy("range", *by).orderBy(F.col("score").desc()).rowsBetween(Window.unboundedPreceding, -1)
    )
    return ranged.join(F.broadcast(offsets), ["range", *by]).select(
        *by,
        "score",
        "tp",
        "fp",
        (F.col("tp_offset") + F.coalesce(F.sum("tp").over(before), F.lit(0))).alias("tp_before"),
        (F.col("fp_offset") + F.coalesce(F.sum("fp").over(before), F.lit(0))).alias("fp_before"),
        "p",
        "n",
    )


def _area_roc() -> Column:
    c = {name: F.col(name).cast("double") for name in ("tp", "fp", "tp_before", "p", "n")}
    area = F.sum(c["fp"] * (c["tp_before"] + c["tp"] / 2))
    return F.try_divide(area, F.max(c["p"]) * F.max(c["n"])).alias("auc_roc")


def _area_pr() -> Column:
    c = {name: F.col(name).cast("double") for name in ("tp", "fp", "tp_before", "fp_before", "p")}
    here = (c["tp_before"] + c["tp"]) / (c["tp_before"] + c["tp"] + c["fp_before"] + c["fp"])
    before = F.coalesce(F.try_divide(c["tp_before"], c["tp_before"] + c["fp_before"]), here)
    area = F.sum(c["tp"] * (here + before) / 2)
    return F.try_divide(area, F.max(c["p"])).alias("auc_pr")


def auc_roc(scored: DataFrame, ranges: int | None = None) -> DataFrame:
    """auc_roc by trapezoids over distinct scores; NULL if a class is missing."""
    return curve_counts(scored, ranges).agg(_area_roc())


def auc_pr(scored: DataFrame, ranges: int | None = None) -> DataFrame:
    """auc_pr by trapezoids; the first point repeats the first precision. NULL without positives."""
    return curve_counts(scored, ranges).agg(_area_pr())


def auc_roc_by(scored: DataFrame, by: Sequence[str], ranges: int | None = None) -> DataFrame:
    """`auc_roc` of each curve that `by` holds apart, from one table of score counts."""
    return curve_counts(scored, ranges, by).groupBy(*by).agg(_area_roc())


def areas(scored: DataFrame, ranges: int | None = None) -> DataFrame:
    """Both areas from one table of score counts: one row, auc_roc and auc_pr."""
    return curve_counts(scored, ranges).agg(_area_roc(), _area_pr())


def evaluator(metric: str = "areaUnderROC", raw_col: str = "rawPrediction", bins: int = 1000) -> BinaryClassificationEvaluator:
    """Spark's evaluator; `bins=0` keeps every distinct score, as the SQL form does."""
    return BinaryClassificationEvaluator(rawPredictionCol=raw_col, metricName=metric, numBins=bins)

"""Multinomial naive Bayes in relational form.

Input is long: one row per review and bucket with its weight (a count or a TF-IDF
value). Model tables hold classes x buckets rows at most.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opine.operators.features import NUM_FEATURES, bounded


def fit(
    terms: DataFrame, documents: DataFrame, num_features: int = NUM_FEATURES, smoothing: float = 1.0, weight: str = "tfidf"
) -> DataFrame:
    """label, bucket, theta, prior for every class and bucket.

    prior = ln(N_c + s) - ln(N + s*C); theta = ln(sum_ct + s) - ln(sum_c + s*V).
    The sums are combined in each task before they are shuffled.
    """
    spark = terms.sparkSession
    s = F.lit(float(smoothing))
    classes = documents.groupBy("label").agg(F.count(F.lit(1)).alias("n_docs"))
    overall = classes.agg(F.sum("n_docs").alias("n"), F.count(F.lit(1)).alias("c"))
    sums = terms.groupBy("label", "bucket").agg(F.sum(weight).alias("w"))
    class_sums = sums.groupBy("label").agg(F.sum("w").alias("total"))

    priors = classes.select(
        "label",
        (
            F.log(F.col("n_docs") + s)
            - F.log(overall.select("n").scalar() + s * overall.select("c").scalar())
        ).alias("prior"),
    )
    # every class owns every bucket, also those it never used
    grid = priors.withColumn("bucket", F.explode(F.sequence(F.lit(0), F.lit(num_features - 1))))
    return (
        grid.join(sums, ["label", "bucket"], "left")
        .join(class_sums, "label", "left")
        .select(
            "label",
            "bucket",
            (
                F.log(F.coalesce("w", F.lit(0.0)) + s)
                - F.log(F.coalesce("total", F.lit(0.0)) + s * F.lit(float(num_features)))
            ).alias("theta"),
            "prior",
        )
    )


def predict_rows(vectors: DataFrame, model: DataFrame, weights: DataFrame | None = None) -> DataFrame:
    """`vectors` with `prediction` in place of `tf`: argmax over the model's classes, ties to the lower label.

    The model, classes x buckets values, comes as one array for each class, and the weights (`bucket`, `idf`; without
    them counts are used) as one array. A review is scored within its row: nothing is shuffled or exploded.
    """
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("bucket", "theta"))), lambda x: x["theta"])
    classes = model.groupBy("label").agg(F.max("prior").alias("prior"), ordered.alias("theta"))
    known = classes.agg(F.sort_array(F.collect_list(F.struct("label", "prior", "theta")))).scalar()
    scored = vectors.withColumn("_known", known)
    values = F.col("tf")
    if weights is not None:
        idf = weights.agg(F.transform(F.sort_array(F.collect_list(F.struct("bucket", "idf"))), lambda x: x["idf"])).scalar()
        scored = scored.withColumn("_idf", idf)
        weighted = lambda t: t["tf"] * F.get(F.col("_idf"), t["bucket"])
        values = F.transform("tf", lambda t: F.struct(t["bucket"].alias("bucket"), weighted(t).alias("tf")))

    def best(one: Column) -> Column:
        total = F.aggregate(F.col("_values"), one["prior"], lambda acc, t: acc + t["tf"] * F.get(one["theta"], t["bucket"]))
        return F.struct(total.alias("score"), (-one["label"]).alias("minus_label"))

    scored = scored.withColumn("_values", values)
    scored = scored.withColumn("_best", F.array_max(F.transform("_known", best)))
    others = [c for c in vectors.columns if c != "tf"]
    return scored.select(*others, (-F.col("_best.minus_label")).alias("prediction"))


def predict(
    terms: DataFrame,
    model: DataFrame,
    key: str = "doc_id",
    num_features: int = NUM_FEATURES,
    classes: Sequence[float] | None = None,
    weight: str = "tfidf",
) -> DataFrame:
    """key, label, prediction: argmax over classes of prior + sum of weight * theta; ties to the lower label.

    The classes are the model's, unless given. The model is turned to one row per bucket and broadcast (its size is bounded by
    the bucket count), so the only shuffle is one partly summed row per review.
    """
    classes = sorted(classes if classes is not None else (row.label for row in model.select("label").distinct().collect()))
    wide = model.groupBy("bucket").agg(
        *[F.max(F.when(F.col("label") == c, F.col("theta"))).alias(f"theta_{i}") for i, c in enumerate(classes)],
        *[F.max(F.when(F.col("label") == c, F.col("prior"))).alias(f"prior_{i}") for i, c in enumerate(classes)],
    )
    joined = terms.join(bounded(wide, num_features), "bucket")
    scores = joined.groupBy(key, "label").agg(
        *[
            # a class the model never saw cannot win
            F.coalesce(
                F.max(f"prior_{i}") + F.sum(F.col(weight) * F.col(f"theta_{i}")), F.lit(float("-inf"))
            ).alias(f"score_{i}")
            for i in range(len(classes))
        ]
    )
    prediction = F.lit(float(classes[0]))
    best = F.col("score_0")
    for i, c in enumerate(classes[1:], start=1):
        better = F.col(f"score_{i}") > best
        prediction = F.when(better, F.lit(float(c))).otherwise(prediction)
        best = F.greatest(best, F.col(f"score_{i}"))
    return scores.select(key, "label", prediction.alias("prediction"))

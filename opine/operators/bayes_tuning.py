"""Exact tuning of naive Bayes over hashed TF-IDF, in relational form.

Every setting's sums come from one pass over the training rows: for each fold, label, number of buckets and bucket,
how often the bucket's words occur and in how many reviews. The sums of the rows outside a fold are the whole's minus
the fold's. They are whole numbers, so nothing is lost by subtracting, and they give the fold's IDF weights and the
model of each smoothing. A review is then scored by all settings of its fold within its row, and all curves are counted
together. No review is read more than twice and nothing is fitted again for another setting.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opine.functions.counting import counted
from opine.functions.hashing import md5_bucket
from opine.operators import metrics
from opine.operators.splits import hash_fold
from opine.operators.tuning import FEATURE_COUNTS, FOLDS, STRENGTHS
from opine.session import stage

# The model that no fold is left out of.
WHOLE = -1
# Scores are compared at so many digits, since sums of doubles may differ in the last ones.
SCORE_DIGITS = 6


def vectors(reviews: DataFrame, feature_counts: Sequence[int] = FEATURE_COUNTS) -> DataFrame:
    """`reviews` with `tfs` in place of `review`: for each number of buckets, the buckets it uses with their counts."""
    others = [c for c in reviews.columns if c != "review"]

    def tf(size: int) -> Column:
        buckets = F.transform(F.split("review", " "), lambda w: md5_bucket(w, size))
        return F.struct(F.lit(size).alias("num_features"), counted(F.sort_array(buckets), "bucket", "tf").alias("tf"))

    return reviews.select(*others, F.array(*[tf(size) for size in feature_counts]).alias("tfs"))


def fold_sums(folded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From rows with label, fold and tfs: (fold, label, num_features, bucket, tf, df) and (fold, label, n)."""
    used = folded.select("fold", "label", F.explode_outer("tfs").alias("v"))
    used = used.select("fold", "label", "v.num_features", F.explode_outer("v.tf").alias("t")).where(F.col("t").isNotNull())
    sums = used.groupBy("fold", "label", "num_features", F.col("t.bucket").alias("bucket")).agg(
        F.sum("t.tf").alias("tf"), F.count(F.lit(1)).alias("df")
    )
    return sums, folded.groupBy("fold", "label").agg(F.count(F.lit(1)).alias("n"))


def _outside(sums: DataFrame, keys: list[str], values: list[str], folds: int) -> DataFrame:
    """out, keys, values: for each fold the sums of the other folds, and of all for `WHOLE`."""
    whole = sums.groupBy(*keys).agg(*[F.sum(v).alias(v) for v in values])
    whole = whole.withColumn("out", F.explode(F.sequence(F.lit(WHOLE), F.lit(folds - 1))))
    own = sums.withColumnsRenamed({v: f"own_{v}" for v in values}).withColumnRenamed("fold", "out")
    left = whole.join(own, ["out", *keys], "left")
    return left.select("out", *keys, *[(F.col(v) - F.coalesce(f"own_{v}", F.lit(0))).alias(v) for v in values])


def fit(
    sums: DataFrame, documents: DataFrame, folds: int = FOLDS, feature_counts: Sequence[int] = FEATURE_COUNTS, smoothings: Sequence[float] = STRENGTHS
) -> DataFrame:
    """out, num_features, smoothing, label, prior, weights: a model's row for each class.

    weights[bucket] is idf * theta, what one occurrence of the bucket adds to the class. A class without rows outside a
    fold has no row there.
    """
    n_docs = _outside(documents, ["label"], ["n"], folds).where(F.col("n") > 0)
    totals = n_docs.groupBy("out").agg(F.sum("n").alias("n_all"), F.count(F.lit(1)).alias("n_classes"))
    classes = n_docs.join(totals, "out")
    counts = _outside(sums, ["label", "num_features", "bucket"], ["tf", "df"], folds)
    df = counts.groupBy("out", "num_features", "bucket").agg(F.sum("df").alias("df"))
    every = F.explode(F.array(*[F.struct(F.lit(v).alias("num_features"), F.sequence(F.lit(0), F.lit(v - 1)).alias("buckets")) for v in feature_counts]))
    grid = classes.withColumn("v", every).select("*", "v.num_features", F.explode("v.buckets").alias("bucket")).drop("v")
    grid = grid.join(counts.drop("df"), ["out", "label", "num_features", "bucket"], "left").join(df, ["out", "num_features", "bucket"], "left")
    idf = F.log((F.col("n_all") + F.lit(1.0)) / (F.coalesce("df", F.lit(0)) + F.lit(1.0)))
    grid = grid.withColumn("idf", idf).withColumn("w", F.coalesce("tf", F.lit(0)) * F.col("idf"))
    entry = F.struct("bucket", "idf", "w")  # as many as there are buckets
    held = grid.groupBy("out", "num_features", "label", "n", "n_all", "n_classes").agg(
        F.sort_array(F.collect_list(entry)).alias("entries"), F.sum("w").alias("total")
    )
    held = held.withColumn("smoothing", F.explode(F.array(*[F.lit(float(s)) for s in smoothings])))
    s = F.col("smoothing")
    prior = F.log(F.col("n") + s) - F.log(F.col("n_all") + s * F.col("n_classes"))
    base = F.log(F.col("total") + s * F.col("num_features"))
    weights = F.transform("entries", lambda e: e["idf"] * (F.log(e["w"] + s) - base))
    return held.select("out", "num_features", "smoothing", "label", prior.alias("prior"), weights.alias("weights"))


def scored(rows: DataFrame, model: DataFrame, out: Column) -> DataFrame:
    """`rows` with `scores` in place of `tfs`: (num_features, smoothing, label, score) by each class of each model that
    leaves `out` out. The models, as many numbers as buckets times classes, settings and folds, are one array."""
    known = model.agg(F.sort_array(F.collect_list(F.struct("out", "num_features", "smoothing", "label", "prior", "weights")))).scalar()

    def one(m: Column) -> Column:
        tf = F.filter("tfs", lambda v: v["num_features"] == m["num_features"])[0]["tf"]
        joint = F.aggregate(tf, m["prior"], lambda total, t: total + t["tf"] * F.get(m["weights"], t["bucket"]))
        return F.struct(m["num_features"].alias("num_features"), m["smoothing"].alias("smoothing"), m["label"].alias("label"), joint.alias("score"))

    others = [c for c in rows.columns if c != "tfs"]
    held = rows.withColumn("_known", known).withColumn("_out", out)
    return held.select(*others, F.transform(F.filter("_known", lambda m: m["out"] == F.col("_out")), one).alias("scores"))


def cross_validated(folded: DataFrame, model: DataFrame) -> DataFrame:
    """num_features, strength, avg_metric: for each setting the mean over the folds of the area under the curve.

    The curve is over the joint log probability of label 1, which is what Spark's evaluator reads.
    """
    rows = scored(folded, model, F.col("fold")).select("fold", F.col("label").alias("truth"), F.explode("scores").alias("s"))
    curves = rows.where(F.col("s.label") == 1.0).select(
        "fold", "s.num_features", "s.smoothing", F.col("truth").alias("label"), F.round("s.score", SCORE_DIGITS).alias("score")
    )
    areas = metrics.auc_roc_by(curves, ["num_features", "smoothing", "fold"])
    return areas.groupBy("num_features", F.col("smoothing").alias("strength")).agg(F.avg("auc_roc").alias("avg_metric"))


def predicted(rows: DataFrame, model: DataFrame, num_features: int, smoothing: float) -> DataFrame:
    """`rows` with `prediction` in place of `tfs`, by the model of one setting fitted on all training rows; ties to the
    lower label."""
    chosen = model.where((F.col("out") == WHOLE) & (F.col("num_features") == num_features) & (F.col("smoothing") == smoothing))
    found = scored(rows, chosen, F.lit(WHOLE))
    best = F.array_max(F.transform("scores", lambda s: F.struct(s["score"].alias("score"), (-s["label"]).alias("minus_label"))))
    others = [c for c in found.columns if c != "scores"]
    return found.select(*others, (-best["minus_label"]).alias("prediction"))


class Tuned:
    """What tuning found: `results` by setting, the best setting, and the models of all settings."""

    def __init__(self, results: DataFrame, model: DataFrame, feature_counts: Sequence[int]):
        self.results, self.model, self.feature_counts = results, model, feature_counts
        best = results.orderBy(F.col("avg_metric").desc_nulls_last(), "num_features", "strength").first()
        self.num_features, self.strength = best.num_features, best.strength

    def predict(self, reviews: DataFrame) -> DataFrame:
        """`reviews` (with a cleaned `review`) with `prediction` by the best setting."""
        return predicted(vectors(reviews, [self.num_features]), self.model, self.num_features, self.strength)


def tune(
    train: DataFrame,
    key: str = "doc_id",
    feature_counts: Sequence[int] = FEATURE_COUNTS,
    smoothings: Sequence[float] = STRENGTHS,
    folds: int = FOLDS,
) -> Tuned:
    """Tune on cleaned reviews (key, label, review). Folds depend on the key alone. A row with a null label, key or
    review takes no part."""
    complete = train.where(F.col(key).isNotNull() & F.col("label").isNotNull() & F.col("review").isNotNull())
    rows = complete.select("label", hash_fold(F.col(key), folds).alias("fold"), "review")
    folded = stage(vectors(rows, feature_counts), "folded-vectors")
    sums, documents = (stage(table, "fold-sums") for table in fold_sums(folded))
    model = stage(fit(sums, documents, folds, feature_counts, smoothings), "fold-models")
    return Tuned(stage(cross_validated(folded, model), "grid-results"), model, feature_counts)

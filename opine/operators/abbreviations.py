"""Abbreviations learnt from a corpus, by the collocation of a word with its period.

After Kiss and Strunk (Unsupervised multilingual sentence boundary detection, 2006): a word that nearly always has a
period is an abbreviation. Whether it does is a log-likelihood ratio of counts; long words, and words also seen without
a period, are marked down, and periods inside a word speak for it. One aggregate over the words counts all there is to
know; what follows works on one row for each word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opine.functions import text as tx
from opine.session import stage

# Fixed values of the published method.
WITH_PERIOD, THRESHOLD = 0.99, 0.3


def type_counts(reviews: DataFrame, raw: str = "text") -> DataFrame:
    """type, n_with, n_without: how often each word stands with and without a period after it."""
    words = reviews.select(F.explode_outer(tx.word_types(F.col(raw))).alias("w")).where(F.col("w").isNotNull())
    return words.groupBy("w.type").agg(
        F.count_if(F.col("w.with_period")).alias("n_with"), F.count_if(~F.col("w.with_period")).alias("n_without")
    )


def _log_likelihood(n_with: Column, n_without: Column, share: Column) -> Column:
    return n_with * F.log(share) + n_without * F.log(1 - share)


def scored(counts: DataFrame) -> DataFrame:
    """type, n_with, n_without, score, is_abbreviation; a row for each word that ever has a period.

    Where every word of a corpus has a period, none can be told to be an abbreviation: the score is 0.
    """
    totals = counts.agg(F.sum("n_with").alias("with"), F.sum(F.col("n_with") + F.col("n_without")).alias("all"))
    share = totals.select(F.col("with") / F.col("all").cast("double")).scalar()
    n_with, n_without = F.col("n_with").cast("double"), F.col("n_without").cast("double")
    by_chance = _log_likelihood(n_with, n_without, F.col("_share"))
    as_rule = _log_likelihood(n_with, n_without, F.lit(WITH_PERIOD))
    letters = F.length(F.replace(F.col("type"), F.lit("."), F.lit(""))).cast("double")
    periods = F.length("type") - letters + 1
    score = -2 * (by_chance - as_rule) * F.exp(-letters) * periods * F.pow(letters, -n_without)
    rows = counts.where(F.col("n_with") > 0).withColumn("_share", share)
    # A negative zero is a zero.
    rows = rows.withColumn("score", F.when(F.col("_share") < 1, score).otherwise(F.lit(0.0)) + F.lit(0.0))
    return rows.select("type", "n_with", "n_without", "score", (F.col("score") >= THRESHOLD).alias("is_abbreviation"))


def learnt(reviews: DataFrame, raw: str = "text") -> DataFrame:
    """`scored` of a corpus; the counts are written once."""
    return scored(stage(type_counts(reviews, raw), "type-counts"))


def sentence_rows(reviews: DataFrame, learnt_types: DataFrame, raw: str = "text") -> DataFrame:
    """sent_pos, sentence and the other columns of `reviews`, cut where no learnt abbreviation stands.

    The abbreviations come as one array. Each letter of a word divides its score by e, so they are short and few.
    """
    known = learnt_types.where("is_abbreviation").agg(F.sort_array(F.collect_list("type"))).scalar()
    others = [F.col(c) for c in reviews.columns if c != raw]
    held = reviews.withColumn("_known", known)
    return held.select(*others, F.posexplode(tx.sentences_known(F.col(raw), F.col("_known"))).alias("sent_pos", "sentence"))

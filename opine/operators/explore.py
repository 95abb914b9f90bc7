"""Word ranking, over all reviews and by polarity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opine.functions import text as tx
from opine.functions.stopwords import ENGLISH


def with_polarity(reviews: DataFrame, polarity: float) -> DataFrame:
    """Reviews of one label: 1 is positive, 0 is negative."""
    return reviews.where(F.col("label") == F.lit(float(polarity)))


def explode_words(reviews: DataFrame, raw: str = "text", stopwords: Sequence[str] = ENGLISH) -> DataFrame:
    """One row per word of each cleaned review: pos, word, and the other columns.

    A review with nothing left after cleaning gives one empty word, as cutting an
    empty string at blanks does.
    """
    words = tx.review_words(F.col(raw), True, stopwords)
    others = [F.col(c) for c in reviews.columns if c != raw]
    exploded = reviews.select(*others, F.posexplode_outer(words).alias("pos", "word"))
    return exploded.withColumns({"pos": F.coalesce("pos", F.lit(0)), "word": F.coalesce("word", F.lit(""))})


def word_count(words: DataFrame) -> DataFrame:
    """word, n. Each task counts its own words first, so a hot word crosses the network once per task."""
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def rank_order() -> list[Column]:
    """By count, descending; equal counts by word."""
    return [F.col("n").desc(), F.col("word").asc()]


def top_words(reviews: DataFrame, k: int = 100, raw: str = "text", stopwords: Sequence[str] = ENGLISH) -> DataFrame:
    """The k most used words; each task keeps only its own k before the last merge."""
    return word_count(explode_words(reviews, raw, stopwords).select("word")).orderBy(*rank_order()).limit(k)

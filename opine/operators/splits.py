"""Train/test splits and folds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opine.functions.hashing import md5_number


def hash_percent(key: Column) -> Column:
    """A number in [0, 100) that depends on the key alone."""
    return F.pmod(md5_number(key), F.lit(100))


def hash_part(key: Column, train_percent: int) -> Column:
    """'train' or 'test'; the same key always falls on the same side, however rows are partitioned."""
    return F.when(hash_percent(key) < train_percent, F.lit("train")).otherwise(F.lit("test"))


def hash_split(df: DataFrame, key: str, train_percent: int) -> tuple[DataFrame, DataFrame]:
    """The training and the test rows; a NULL key is a test row, as in `hash_part`."""
    part = hash_part(F.col(key), train_percent)
    return df.where(part == "train"), df.where(part == "test")


def hash_fold(key: Column, folds: int) -> Column:
    """A fold number in [0, folds), independent of `hash_percent`."""
    return F.pmod(md5_number(F.concat(F.lit("fold:"), key.cast("string"))), F.lit(folds)).cast("int")


def random_split(df: DataFrame, weights: Sequence[float], seed: int) -> list[DataFrame]:
    """Spark's own random split: repeatable only while the partitioning stays the same."""
    return df.randomSplit(list(weights), seed)

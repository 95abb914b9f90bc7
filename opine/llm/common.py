"""Column helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Runs of characters that are no part of a word, once A-Z are lower-cased.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def text_or_empty(text: str | Column = "text") -> Column:
    return F.coalesce(text, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else. `lower` does just that where every character is ASCII, and is faster."""
    return F.when(text.rlike(r"[^\x00-\x7F]"), F.translate(text, UPPER, UPPER.lower())).otherwise(F.lower(text))


def words(text: str | Column = "text") -> Column:
    """The words of a text in order; null and empty texts have none."""
    return F.array_remove(F.split(ascii_lower(text_or_empty(text)), GAP), "")


def digest(text: str | Column = "text") -> Column:
    """Stands for a whole text, so that equal texts are worked on once; null counts as empty."""
    return F.unhex(F.md5(text_or_empty(text)))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)`, with `value` computed once however often `body` names it."""
    return F.transform(F.array(value), body)[0]


def sliding(values: Column, width: int, combine: Callable[[Column, Column], Column]) -> Column:
    """Combine each `width` consecutive elements by doubling; needs combine(a, b) to allow overlapping parts."""
    if width == 1:
        return values
    half = 1
    while half * 2 <= width:
        half *= 2
    shift = width - half if half < width else half // 2
    inner = half if half < width else half // 2

    def paired(v: Column) -> Column:
        left = F.greatest(F.size(v) - shift, F.lit(0))
        return F.zip_with(F.slice(v, F.lit(1), left), F.slice(v, F.lit(shift + 1), left), combine)

    return let(sliding(values, inner, combine), paired)


def small_side(df: DataFrame, rows: int, at_most: int) -> DataFrame:
    """Broadcast a table whose rows have been counted and are few; else leave the join to Spark."""
    return F.broadcast(df) if rows <= at_most else df

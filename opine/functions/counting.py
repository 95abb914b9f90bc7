"""Counting within a row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def counted(listed: Column, value: str, count: str) -> Column:
    """The distinct elements of a sorted array with how often each occurs, as an array of structs.

    Runs of equal elements are found by their ends, in one pass. The transform over a one-element array names
    an intermediate result, so that it is computed once.
    """

    def runs(whole: Column) -> Column:
        size = F.size(whole)
        places = F.when(size > 0, F.sequence(F.lit(0), size - 1)).otherwise(F.array().cast("array<int>"))
        ends = F.filter(places, lambda i: (i == size - 1) | ~F.get(whole, i).eqNullSafe(F.get(whole, i + 1)))

        def between(found: Column) -> Column:
            before = F.slice(F.concat(F.array(F.lit(-1)), found), F.lit(1), F.size(found))
            return F.zip_with(
                found, before, lambda e, p: F.struct(F.get(whole, e).alias(value), (e - p).cast("bigint").alias(count))
            )

        return F.transform(F.array(ends), between)[0]

    return F.transform(F.array(listed), runs)[0]

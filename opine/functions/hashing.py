"""Hashes that do not depend on partitioning and that any SQL engine can repeat."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def md5_number(value: Column) -> Column:
    """The first 32 bits of the md5 of a value's text, as a non-negative bigint."""
    return F.conv(F.substring(F.md5(value.cast("string")), 1, 8), 16, 10).cast("bigint")


def md5_bucket(value: Column, buckets: int) -> Column:
    """A bucket number in [0, buckets)."""
    return F.pmod(md5_number(value), F.lit(buckets)).cast("int")

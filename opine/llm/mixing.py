"""Mixing sources to target weights by a temperature.

Sources' token shares are raised to an exponent between 0 (all sources alike) and 1 (as they are) and normalised.
The exponent is found by bisection: the largest that reaches a target entropy, but no smaller than a limit on
repetition allows. Weights are realised by passes: a source is passed over as often as its budget of tokens lasts.
Each pass deals its documents anew to blocks by hash, so that it is a permutation by blocks; the last pass ends
with the block, and in it with the document, at which the budget is used up.

Texts are read twice and never shuffled: where the last pass ends is worked out on one small row for each document,
and comes down to a block and a hash for each source.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opine.llm.common import small_side, text_or_empty
from opine.session import stage

BLOCK_TOKENS, MOST_BLOCKS = 100_000, 4096
# Halvings of the range of exponents, and how many of them one pass over the sources' sizes serves.
BISECTIONS, A_PASS = 30, 5
# Sources up to which the plan is sent to every executor (about 100 bytes each).
BROADCAST_SOURCES = 500_000


class Goal(NamedTuple):
    """What the mixture is to be. entropy: as a share of the largest there is, ln(sources). repetition: how often a
    token may be used. budget: tokens in all; None for as few as use every document at least once."""

    entropy: float | None = None
    repetition: float | None = None
    budget: int | None = None


DEFAULT_GOAL = Goal(entropy=0.95, repetition=2.0)


def tokens(text: str | Column = "text") -> Column:
    """Runs of characters that are not blank; 1 for a text without any, so that every document has its place."""
    return F.greatest(F.regexp_count(text_or_empty(text), F.lit(r"\S+")), F.lit(1)).cast("bigint")


def _source() -> Column:
    return F.coalesce(F.col("source").cast("string"), F.lit(""))


def _row_hash(seed: Column | int) -> Column:
    return F.xxhash64(F.col("doc_id"), F.xxhash64(text_or_empty()), F.lit(seed) if isinstance(seed, int) else seed)


def exponent(shares: DataFrame, goal: Goal, total: int) -> float:
    """The exponent for a table with `log_share`. Only sums and extremes over the sources come to the driver."""

    low_share, high_share, count = shares.agg(F.min("log_share"), F.max("log_share"), F.count(F.lit(1))).first()

    def sums(exponents: list[float]) -> list[tuple[float, float]]:
        """For each exponent the sum of the raised shares, and that weighed with their logarithms, in one pass."""
        raised = [F.exp(F.col("log_share") * a) for a in exponents]
        row = shares.agg(*[F.sum(r) for r in raised], *[F.sum(F.col("log_share") * r) for r in raised]).first()
        return list(zip(row[: len(raised)], row[len(raised) :], strict=True))

    def too_even(a: float, z: float, weighed: float) -> bool:
        if goal.budget is None:
            return math.exp((a - 1) * (low_share - high_share)) > goal.repetition
        return goal.budget / total * math.exp((a - 1) * low_share) / z > goal.repetition

    def even_enough(a: float, z: float, weighed: float) -> bool:
        return math.log(z) - a * weighed / z >= goal.entropy * math.log(count)

    def at_most_one(below) -> float:
        """The number from which on `below` no longer holds, 1 if it always does. A pass serves several bisections."""
        if below(1.0, *sums([1.0])[0]):
            return 1.0
        low, width = 0.0, 1.0
        for _ in range(BISECTIONS // A_PASS):
            points = [low + width * k / 2**A_PASS for k in range(2**A_PASS)]
            values = sums(points)
            first, last = 0, 2**A_PASS
            while last - first > 1:
                middle = (first + last) // 2
                first, last = (middle, last) if below(points[middle], *values[middle]) else (first, middle)
            low, width = points[first], width / 2**A_PASS
        return round(low + width, 6)

    found = 1.0 if goal.entropy is None else at_most_one(even_enough)
    if goal.repetition is not None and too_even(found, *sums([found])[0]):
        found = at_most_one(too_even)
    return found


def plan(sizes: DataFrame, goal: Goal = DEFAULT_GOAL) -> DataFrame:
    """source, size, weight, wanted (tokens), passes (full ones), rest (tokens of the last pass), blocks."""
    total, sources = sizes.agg(F.sum("size"), F.count(F.lit(1))).first()
    columns = ["source", "size", "weight", "wanted", "passes", "rest", "blocks"]
    if not sources:
        return sizes.selectExpr("source", "size", "1D AS weight", "size AS wanted", "1L AS passes", "0L AS rest", "1L AS blocks")
    shares = sizes.withColumn("log_share", F.log(F.col("size") / float(total)))
    a = exponent(shares, goal, total)
    raised = F.exp(F.col("log_share") * a)
    z = shares.agg(F.sum(raised)).first()[0]
    weighed = shares.withColumn("weight", F.round(raised / z, 12))
    budget = goal.budget
    if budget is None:
        budget = weighed.agg(F.max(F.col("size") / F.col("weight"))).first()[0]
    # With no budget given the scarcest source is used exactly once, whatever rounding says.
    wanted = F.round(F.col("weight") * float(budget)).cast("bigint")
    wanted = F.greatest(wanted, F.col("size")) if goal.budget is None else wanted
    planned = weighed.withColumn("wanted", wanted).withColumn("passes", F.floor(F.col("wanted") / F.col("size")))
    planned = planned.withColumn("rest", F.col("wanted") - F.col("passes") * F.col("size"))
    blocks = F.least(F.ceil(F.col("size") / BLOCK_TOKENS), F.lit(MOST_BLOCKS)).cast("bigint")
    return planned.withColumn("blocks", blocks).select(*columns)


def _block(blocks: Column, at: Column | int) -> Column:
    """The block of a row in a pass."""
    return F.pmod(_row_hash(at), blocks)


def _place(at: Column | int) -> Column:
    """Where in its block a row stands."""
    return F.xxhash64(_row_hash(at), F.lit(1))


def _ends(light: DataFrame, planned: DataFrame, sources: int) -> DataFrame:
    """source, cut_block, cut_place, cut_times: where the last pass ends.

    It takes blocks before the cut, in it places before the cut, and at that place so many of its rows, which are equal
    in id and text. The block is found first, then a slice of its places, then the place, so that the running sums go
    over MOST_BLOCKS and 4096 rows for each source and over the places of one slice, however long the source is.
    """
    inside = light.withColumn("slice", F.shiftright("place", 52))
    ends = planned.where(F.col("rest") > 0).select("source", F.col("rest").alias("left"))
    for level in ("block", "slice", "place"):
        sums = inside.groupBy("source", level).agg(F.sum("tokens").alias("held"), F.max("tokens").alias("each"))
        until = F.sum("held").over(Window.partitionBy("source").orderBy(level))
        run = sums.withColumn("until", until).join(ends.select("source", "left"), "source")
        cut = (
            run.where(F.col("until") > F.col("left"))
            .groupBy("source")
            .agg(
                F.min(level).alias(f"cut_{level}"),
                F.min_by(F.col("left") - F.col("until") + F.col("held"), level).alias("left"),
                F.min_by("each", level).alias("each"),
            )
        )
        ends = stage(ends.drop("left", "each").join(cut, "source"), "mixture-cut")
        at = small_side(ends.select("source", F.col(f"cut_{level}").alias(level)), sources, BROADCAST_SOURCES)
        inside = inside.join(at, ["source", level], "left_semi")
    return ends.select("source", "cut_block", "cut_place", F.floor(F.col("left") / F.col("each")).alias("cut_times"))


def _numbered(rows: DataFrame) -> DataFrame:
    """Equal rows with a __number from 1 for each __source; they are written first, so that the numbers stay.

    Each written part is numbered by itself and starts from the total of the parts before it.
    """
    rows = stage(rows.withColumn("__at", F.monotonically_increasing_id()), "rows-at-the-cut")
    rows = rows.withColumn("__part", F.shiftright("__at", 33))
    parts = rows.groupBy("__source", "__part").agg(F.count(F.lit(1)).alias("__held"))
    earlier = Window.partitionBy("__source").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("__source", "__part", F.coalesce(F.sum("__held").over(earlier), F.lit(0)).alias("__before"))
    in_part = F.row_number().over(Window.partitionBy("__source", "__part").orderBy("__at"))
    numbered = rows.withColumn("__number", in_part).join(parts, ["__source", "__part"])
    return numbered.withColumn("__number", F.col("__number") + F.col("__before")).drop("__at", "__part", "__before")


def mixed(documents: DataFrame, goal: Goal = DEFAULT_GOAL) -> DataFrame:
    """`documents`, each as often as the mixture uses it, with __tokens, __weight, __pass, __block and __slot.

    __slot, from 0 to 1, orders the mixture: at any point of that order each source has given its share. A null
    source is the source "". Every row counts, repeated rows too, and of rows that repeat at the end of a budget as
    many are used as fit in. A source whose budget ends between two documents stays below it by less than one document.
    """
    light = documents.select(
        _source().alias("source"), tokens().alias("tokens"), F.col("doc_id"), F.xxhash64(text_or_empty()).alias("text_hash")
    )
    light = stage(light, "token-counts")
    sizes = stage(light.groupBy("source").agg(F.sum("tokens").alias("size")), "source-sizes")
    planned = stage(plan(sizes, goal), "mixture-plan")
    sources = planned.count()
    keyed = light.join(small_side(planned, sources, BROADCAST_SOURCES), "source").where(F.col("rest") > 0)
    last = F.xxhash64(F.col("doc_id"), F.col("text_hash"), F.col("passes"))  # as _row_hash, from the staged hash
    keyed = keyed.select(
        "source", "tokens", F.pmod(last, F.col("blocks")).alias("block"), F.xxhash64(last, F.lit(1)).alias("place")
    )
    planned = stage(planned.join(_ends(keyed, planned, sources), "source", "left"), "mixture-ends")
    some_repeat = not planned.where(F.col("cut_times") > 0).isEmpty()
    planned = planned.select(*[F.col(c).alias(f"__{c}") for c in planned.columns])

    rows = documents.withColumn("__tokens", tokens()).join(
        small_side(planned, sources, BROADCAST_SOURCES), _source() == F.col("__source")
    )
    block, place = _block(F.col("__blocks"), F.col("__passes")), _place(F.col("__passes"))
    in_cut = block == F.col("__cut_block")
    before_cut = F.coalesce((block < F.col("__cut_block")) | (in_cut & (place < F.col("__cut_place"))), F.lit(False))
    rows = rows.select(
        *[documents[c] for c in documents.columns],
        *["__tokens", "__source", "__weight", "__wanted", "__size", "__blocks", "__cut_times"],
        (F.col("__passes") + F.when(before_cut, 1).otherwise(0)).alias("__times"),
        F.coalesce(in_cut & (place == F.col("__cut_place")) & (F.col("__cut_times") > 0), F.lit(False)).alias("__at_cut"),
    )
    if some_repeat:
        numbered = _numbered(rows.where("__at_cut"))
        used = F.col("__times") + F.when(F.col("__number") <= F.col("__cut_times"), 1).otherwise(0)
        rows = rows.where("NOT __at_cut").unionByName(numbered.withColumn("__times", used).drop("__number"))
    none = F.array().cast("array<bigint>")
    passes = F.when(F.col("__times") > 0, F.sequence(F.lit(0).cast("bigint"), F.col("__times") - 1)).otherwise(none)
    rows = rows.withColumn("__pass", F.explode(passes))
    rows = rows.withColumn("__block", _block(F.col("__blocks"), F.col("__pass")))
    used = F.col("__wanted") / F.col("__size")
    return rows.select(
        *[F.col(f"`{c}`") for c in documents.columns],
        "__tokens",
        "__weight",
        "__pass",
        "__block",
        F.least((F.col("__pass") + (F.col("__block") + 0.5) / F.col("__blocks")) / used, F.lit(1.0)).alias("__slot"),
    )


def mixture(documents: DataFrame, goal: Goal = DEFAULT_GOAL) -> DataFrame:
    """`documents` as often as the mixture uses each, with the same columns."""
    return mixed(documents, goal).select(*documents.columns)

"""Quality classifier: a sparse ensemble of rules over text statistics.

A small random forest is grown on the statistics of a bounded sample of labelled rows. Every path from a root
to a node is a rule, a conjunction of thresholds. A logistic regression with a lasso penalty weighs the rules
and leaves most of them out. The rest becomes one Column expression, so scoring is a projection over the scan.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable
from typing import NamedTuple

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opine.llm.common import let, text_or_empty
from opine.session import stage

# The classifier learns from at most so many labelled rows, those with the smallest hashes of their ids.
SAMPLE_ROWS = 20_000
TREES, DEPTH, SEED = 12, 3, 17
LASSO = 0.002
MOST_ITERATIONS = 60


STATISTICS = (
    "log_words",
    "mean_piece",
    "distinct",
    "repeated",
    "distinct_lines",
    "mean_line",
    "upper",
    "shouting",
    "symbols",
    "stops",
    "digits",
)


class Condition(NamedTuple):
    statistic: str
    above: bool
    threshold: float


class Model(NamedTuple):
    """Rules with their weights; no rules: every text scores the same."""

    intercept: float
    rules: list[tuple[tuple[Condition, ...], float]]


def statistics(text: str | Column = "text") -> dict[str, Column]:
    """Shares and means over the whole text; 0 where there is nothing to divide by."""
    whole = text_or_empty(text)
    pieces = F.split(F.trim(F.regexp_replace(whole, r"\s+", " ")), " ")
    lines = F.split(whole, "\n")
    n_chars = F.greatest(F.length(whole), F.lit(1)).cast("double")
    n_pieces = F.size(pieces).cast("double")

    def share_of(pattern: str) -> Column:
        return F.regexp_count(whole, F.lit(pattern)) / n_chars

    columns = (
        F.log1p(F.when(F.length(F.trim(whole)) > 0, n_pieces).otherwise(0.0)),
        F.length(whole) / n_pieces,
        F.log1p(F.size(F.array_distinct(pieces))) / F.log1p(n_pieces),  # hardly depends on length
        F.regexp_count(whole, F.lit(r"(?<!\S)(\S++) \1(?!\S)")) / n_pieces,
        F.size(F.array_distinct(lines)) / F.size(lines).cast("double"),
        F.log1p(F.length(whole) / F.size(lines).cast("double")),
        share_of(r"\p{Lu}"),
        share_of(r"[!?]"),
        share_of(r"[|#$%&*~^<>{}\[\]\\@=+_/]"),
        share_of(r"[.,;:]"),
        share_of(r"\d"),
    )
    return dict(zip(STATISTICS, columns, strict=True))


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that nothing is learnt from: crc32 of the id's text leaves 1 by 3. A null id is held out too."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(True))


def training_rows(documents: DataFrame, labels: DataFrame, label: str = "quality", rows: int = SAMPLE_ROWS) -> DataFrame:
    """label and statistics of the sample; labels that are null, or neither 0 nor 1, teach nothing.

    The bound is on labels: a label teaches with every row that has its id, so repeated ids give more rows.
    """
    known = labels.where(~held_out() & F.col(label).isin(0, 1)).select("doc_id", F.col(label).cast("double").alias("label"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(rows)
    # At most `rows` ids and labels.
    taught = documents.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    return taught.select("label", *[s.alias(name) for name, s in statistics().items()])


def paths(tree_text: str) -> list[tuple[Condition, ...]]:
    """Every conjunction that leads to a node of a tree, from Spark's printed form of it."""
    found, open_conditions = [], []
    for line in tree_text.splitlines():
        match = re.match(r"( *)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)", line)
        if match:
            depth = len(match[1])
            open_conditions = [c for c in open_conditions if c[0] < depth]
            open_conditions.append((depth, Condition(STATISTICS[int(match[2])], match[3] == ">", float(match[4]))))
            found.append(tuple(c for _, c in open_conditions))
    return found


def _fires(conditions: tuple[Condition, ...], of: Callable[[str], Column], weight: float = 1.0) -> Column:
    """`weight` where every condition holds, else 0; `of` gives a statistic by its name."""
    both = F.lit(True)
    for c in conditions:
        both = both & (of(c.statistic) > c.threshold if c.above else of(c.statistic) <= c.threshold)
    return F.when(both, weight).otherwise(0.0)


def fit(rows: DataFrame) -> Model:
    """Learn from label and statistics. Rows of fewer than two classes give their class (0.5 without rows)."""
    rows = stage(rows, "quality-training")
    counts = {row.label: row["count"] for row in rows.groupBy("label").count().collect()}
    if len(counts) < 2:
        return Model({0.0: -20.0, 1.0: 20.0}.get(next(iter(counts), None), 0.0), [])
    features = VectorAssembler(inputCols=list(STATISTICS), outputCol="statistics")
    forest = RandomForestClassifier(
        featuresCol="statistics", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="onethird"
    ).fit(features.transform(rows))
    rules = sorted({path for tree in forest.trees for path in paths(tree.toDebugString)})
    if not rules:
        share = counts[1.0] / sum(counts.values())
        return Model(math.log(share / (1 - share)), [])
    fired = rows.select("label", *[_fires(rule, F.col).alias(f"rule{n}") for n, rule in enumerate(rules)])
    gathered = VectorAssembler(inputCols=fired.columns[1:], outputCol="rules").transform(fired).select("label", "rules")
    lasso = LogisticRegression(
        featuresCol="rules", labelCol="label", elasticNetParam=1.0, regParam=LASSO, maxIter=MOST_ITERATIONS, standardization=False
    ).fit(gathered)
    weighed = [(rule, float(w)) for rule, w in zip(rules, lasso.coefficients, strict=True) if w]
    return Model(float(lasso.intercept), weighed)


def score(documents: DataFrame, model: Model, column: str = "score") -> DataFrame:
    """`documents` with a column `score`, from 0 to 1: the probability of label 1. Its other columns stay.

    A null text counts as empty; empty texts are scored like any other. Rows may repeat. A column of `documents` that
    is called `column` is replaced.
    """

    def scored(measured: Column) -> Column:
        total = F.lit(model.intercept)
        for rule, weight in model.rules:
            total = total + _fires(rule, lambda name: measured[name], weight)
        return 1 / (1 + F.exp(-total))

    # The statistics are named within the expression, so that they are measured once even where a filter on the
    # score is pushed down to the scan.
    measured = F.struct(*[s.alias(name) for name, s in statistics(F.col("text")).items()])
    return documents.withColumn(column, let(measured, scored))


def classified(documents: DataFrame, labels: DataFrame, column: str = "score") -> DataFrame:
    """`documents` with `score`, by a model of `labels` that has seen no held-out row."""
    return score(documents, fit(training_rows(documents, labels)), column)

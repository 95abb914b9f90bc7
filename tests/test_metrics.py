from __future__ import annotations

import random

import pytest

from opine.operators import metrics

SCHEMA = "label double, prediction double, score double"


def scored(spark, rows, parts=3):
    data = [(float(label), float(score >= 0.5), float(score)) for label, score in rows]
    return spark.createDataFrame(data, SCHEMA).repartition(parts)


@pytest.mark.parametrize("ranges", [1, 2, 7, 64])
@pytest.mark.parametrize("digits", [1, 6])
def test_areas_equal_the_evaluator(spark, ranges, digits):
    rng = random.Random(ranges)
    rows = scored(spark, [(rng.random() < 0.4, round(rng.random() ** 2, digits)) for _ in range(400)])
    for name, area in (("areaUnderROC", metrics.auc_roc), ("areaUnderPR", metrics.auc_pr)):
        expected = metrics.evaluator(name, "score", bins=0).evaluate(rows)
        assert area(rows, ranges).first()[0] == pytest.approx(expected, abs=1e-12)


def test_areas_with_one_score_and_with_a_third_on_one_score(spark):
    flat = scored(spark, [(1, 0.5), (0, 0.5), (0, 0.5)])
    assert metrics.auc_roc(flat).first().auc_roc == pytest.approx(0.5)
    assert metrics.auc_pr(flat).first().auc_pr == pytest.approx(1 / 3)
    rng = random.Random(5)
    rows = scored(spark, [(rng.random() < 0.5, 0.7 if i % 3 == 0 else rng.random()) for i in range(300)])
    expected = metrics.evaluator("areaUnderROC", "score", bins=0).evaluate(rows)
    assert metrics.auc_roc(rows, 5).first()[0] == pytest.approx(expected, abs=1e-12)


def test_missing_class_gives_null(spark):
    only_negative = scored(spark, [(0, 0.2), (0, 0.3)])
    assert metrics.auc_roc(only_negative).first()[0] is None
    assert metrics.auc_pr(only_negative).first()[0] is None
    only_positive = scored(spark, [(1, 0.2), (1, 0.3)])
    assert metrics.auc_roc(only_positive).first()[0] is None
    assert metrics.auc_pr(only_positive).first()[0] == pytest.approx(1.0)
    nothing = spark.createDataFrame([], SCHEMA)
    assert metrics.auc_roc(nothing).first()[0] is None
    assert metrics.auc_pr(nothing).first()[0] is None


def test_report(spark):
    report = metrics.classification_report(scored(spark, [(1, 0.9), (1, 0.1), (0, 0.8), (0, 0.2), (0, 0.3)])).first()
    assert (report.n, report.tp, report.fp, report.positives) == (5, 1, 1, 2)
    assert (report.accuracy, report.test_error) == pytest.approx((0.6, 0.4))
    assert (report.recall, report.precision) == (0.5, 0.5)


def test_a_missing_prediction_is_wrong(spark):
    rows = spark.createDataFrame([(1.0, 1.0, 0.9), (0.0, 1.0, 0.8), (1.0, None, None)], SCHEMA)
    report = metrics.classification_report(rows).first()
    assert (report.accuracy, report.test_error) == pytest.approx((1 / 3, 2 / 3))


def test_both_areas_from_one_table(spark):
    rows = scored(spark, [(1, 0.9), (0, 0.8), (1, 0.4), (0, 0.1)])
    both = metrics.areas(rows).first()
    assert both.auc_roc == metrics.auc_roc(rows).first()[0] and both.auc_pr == metrics.auc_pr(rows).first()[0]


def test_ratios_without_a_denominator_are_null(spark):
    report = metrics.classification_report(scored(spark, [(0, 0.1), (0, 0.2)])).first()
    assert (report.recall, report.precision, report.accuracy) == (None, None, 1.0)
    empty = metrics.classification_report(spark.createDataFrame([], SCHEMA)).first()
    assert (empty.n, empty.accuracy, empty.test_error) == (0, None, None)

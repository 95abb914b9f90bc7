"""From TSV files to scored rows and a scored stream, as a user would go."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from opine.operators import models
from opine.plans import recipes
from opine.sources import tables, tsv
from opine.streaming import jobs, lines


@pytest.fixture(scope="module")
def labelled(spark, small, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("labelled") / "tsv")
    reviews = tables.labelled_reviews(spark, small)
    tsv.write_tsv(reviews.select(F.col("doc_id").alias("id"), "label", F.col("text").alias("review")), path)
    return tsv.read_labelled(spark, path, header="each_file")


@pytest.fixture(scope="module")
def unlabelled(spark, small, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("unlabelled") / "tsv")
    reviews = tables.unlabelled_reviews(spark, small)
    tsv.write_tsv(reviews.select(F.col("doc_id").alias("id"), F.col("text").alias("review")), path)
    return tsv.read_unlabelled(spark, path, header="each_file")


@pytest.fixture(scope="module")
def vectors(unlabelled):
    return recipes.word_vectors(unlabelled, vector_size=20, min_count=40)


def check(experiment):
    report = experiment.report().first()
    assert report.n == experiment.scored.count() > 0
    assert report.accuracy + report.test_error == pytest.approx(1.0)
    for value in (report.auc_roc, report.auc_pr):
        assert value is None or 0.0 <= value <= 1.0
    assert experiment.scored.columns[:2] == ["id", "label"]


def test_rankings(labelled):
    both = {r.word: r.n for r in recipes.ranking(labelled, k=10**6).collect()}
    parts = [{r.word: r.n for r in recipes.ranking(labelled, p, k=10**6).collect()} for p in (0, 1)]
    assert both == {w: parts[0].get(w, 0) + parts[1].get(w, 0) for w in both}
    assert recipes.ranking(labelled).count() == 100


@pytest.mark.parametrize(
    ("classifier", "percent"),
    [(models.logistic_regression, 60), (models.lbfgs_logistic_regression, 90), (models.naive_bayes, 60)],
)
def test_tfidf(labelled, classifier, percent):
    check(recipes.tfidf(labelled, classifier(), percent))


def test_tfidf_forest_and_its_whole_pipeline(labelled):
    experiment = recipes.tfidf_forest(labelled)
    check(experiment)
    clean = labelled.withColumn("review", F.lit("some words"))
    assert {r.predicted for r in experiment.model.transform(clean).collect()} <= {"0.0", "1.0"}


def test_tuned(labelled):
    check(recipes.tfidf_tuned(labelled, models.naive_bayes()))


def test_word_vectors_forest(labelled, vectors):
    check(recipes.word_vector_forest(labelled, vectors))


def test_word_vectors_classifier_scores_a_stream(spark, labelled, vectors, tmp_path):
    experiment = recipes.word_vector_classifier(labelled, vectors, models.lbfgs_logistic_regression())
    check(experiment)
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "f1.txt").write_text("a <b>good</b> film\n\nbad\n")
    stream = lines.read_lines(spark, str(tmp_path / "in"))
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    jobs.finish(jobs.start_scoring(stream, experiment.model, out, checkpoint, interval=None), 120)
    rows = jobs.read_batches(spark, out, jobs.SCORES).collect()
    assert sorted(r.text for r in rows) == ["", "a <b>good</b> film", "bad"]
    assert {r.prediction for r in rows} <= {0.0, 1.0}


def test_clusters(labelled, vectors):
    clustering = recipes.word_vector_clusters(labelled, vectors)
    sums = clustering.distance_sums().first()
    assert sums.wssse == pytest.approx(clustering.kmeans.summary.trainingCost)
    assert sums.sum_dist > 0 and not math.isnan(sums.sum_dist)
    assert {r.cluster for r in clustering.assigned.collect()} == {0, 1}

"""What the plans must look like: no Python workers, few shuffles, pruned scans."""

from __future__ import annotations

import re
import shutil
import uuid

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from opine import session
from opine.operators import bayes, embeddings, explore, features, metrics
from opine.plans import derived, queries
from opine.sources import tables

NO_ML = sorted(
    name
    for name in queries.REGISTRY
    if name.startswith(("clean_", "sentence_", "top_", "word_count", "explode_", "hashing_tf", "metric_", "split_hash"))
)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df) -> int:
    """Exchanges that the query itself needs, without the spread of a small input."""
    initial = plan(df).split("== Initial Plan ==")[-1]
    return len(re.findall(r"Exchange (?:hash|range|Single)", initial))


@pytest.mark.parametrize("name", NO_ML)
def test_no_python_workers(spark, tiny, name):
    text = plan(queries.REGISTRY[name](spark, tiny))
    assert not re.search(r"BatchEvalPython|ArrowEvalPython|MapInPandas|FlatMapGroups", text)


def test_top_words_is_one_shuffle_and_a_bounded_top(spark, tiny):
    top = queries.REGISTRY["top_words_all"](spark, tiny)
    assert "TakeOrderedAndProject(limit=100" in plan(top)
    assert shuffles(top) == 1
    assert "partial_count" in plan(top)


@pytest.mark.parametrize("name", ["clean_review", "sentence_split", "hashing_tf", "explode_words", "split_hash_60_40"])
def test_row_wise_work_needs_no_shuffle(spark, tiny, name):
    assert shuffles(queries.REGISTRY[name](spark, tiny)) == 0


def test_scans_read_only_what_is_used(spark, tiny):
    assert "ReadSchema: struct<doc_id:bigint>" in plan(queries.REGISTRY["split_hash_60_40"](spark, tiny))
    scored = plan(queries.REGISTRY["metric_accuracy"](spark, tiny))
    assert "ReadSchema: struct<doc_id:bigint,n_chars:bigint>" in scored
    assert "text" not in re.findall(r"ReadSchema: (\S+)", scored)[0]


def test_polarity_reaches_the_label_scan(spark, tiny):
    text = plan(explore.with_polarity(tables.labelled_reviews(spark, tiny), 1))
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(quality,1\)", text)


def test_labels_are_broadcast_only_by_their_size(spark, tiny):
    assert "BroadcastHashJoin" in plan(tables.labelled_reviews(spark, tiny))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert "SortMergeJoin" in plan(tables.labelled_reviews(spark, tiny))
        assert "SortMergeJoin" in plan(tables.unlabelled_reviews(spark, tiny))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_bayes_scoring_shuffles_reviews_once(spark, tiny):
    terms = derived.review_terms(spark, tiny).withColumnRenamed("tf", "w")
    model = spark.createDataFrame([(0.0, 0, -1.0, -0.5)], "label double, bucket int, theta double, prior double")
    text = plan(bayes.predict(terms, model, weight="w")).split("== Initial Plan ==")[-1]
    assert len(re.findall(r"Exchange hashpartitioning\(doc_id", text)) == 1
    assert "BroadcastHashJoin" in text


def test_bayes_scores_within_the_row(spark, tiny):
    model = spark.createDataFrame([(0.0, 0, -1.0, -0.5)], "label double, bucket int, theta double, prior double")
    vectors = derived.review_vectors(spark, tiny)
    main = plan(bayes.predict_rows(vectors, model)).split("== Initial Plan ==")[-1].split("Subquery")[0]
    assert "Exchange" not in main and "Join" not in main and "Generate" not in main


def test_every_window_over_all_rows_has_bounded_input(spark, tiny):
    """Only the range totals, at most one row per range, may meet in one task."""
    text = plan(metrics.curve_counts(queries.scored_labels(spark, tiny), ranges=4)).split("== Initial Plan ==")[-1]
    single = [line for line in text.splitlines() if "Exchange SinglePartition" in line]
    assert len(single) == 1
    after = text[text.index("Exchange SinglePartition") :].splitlines()[1]
    assert "HashAggregate(keys=[range" in after


def test_idf_counts_in_each_task_first(spark, tiny):
    weights = features.idf_weights(derived.review_terms(spark, tiny), derived.cleaned_reviews(spark, tiny))
    assert "partial_count" in plan(weights)


def test_buckets_are_not_counted_again_in_a_filter(spark, tiny):
    for line in plan(queries.REGISTRY["hashing_tf"](spark, tiny)).splitlines():
        assert not ("Filter" in line and "md5" in line)


def test_no_vocabulary_in_a_broadcast_of_text_scoring(spark, tiny):
    """Words meet their vectors by a shuffle once Spark's own threshold is passed."""
    documents = embeddings.word_lists(tables.all_reviews(spark, tiny))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        averaged = embeddings.average_vectors(documents, queries.given_vectors(documents))
        assert "BroadcastHashJoin" not in plan(averaged)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


class PassesThrough:
    def transform(self, df):
        return df.withColumn("features", F.lit(0.0))


@pytest.fixture
def one_row_group(spark, tmp_path, monkeypatch):
    """Documents in a single row group, of a size that `spread` leaves alone."""
    documents = spark.range(60).select(F.col("id").alias("doc_id"), F.format_string("First %d. Then more.", "id").alias("text"))
    documents.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    labels = spark.range(0, 60, 2).select(F.col("id").alias("doc_id"), (F.col("id") % 4).alias("quality"))
    labels.coalesce(1).write.parquet(f"{tmp_path}/labels.parquet")
    monkeypatch.setattr(session, "SPREAD_LIMIT_BYTES", 0)
    monkeypatch.setattr(derived, "once", lambda spark, folder, name, make: make())
    monkeypatch.setattr(derived, "table_once", lambda spark, folder, name, make: make())
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield str(tmp_path)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def tasks_with_rows(df) -> int:
    return df.select(F.spark_partition_id()).distinct().count()


def test_words_of_a_large_row_group_are_made_by_many_tasks(spark, one_row_group, monkeypatch):
    staged = []
    monkeypatch.setattr(derived, "stage", lambda df, purpose: staged.append(df))
    monkeypatch.setattr(embeddings, "fit_word2vec", lambda corpus, partitions: PassesThrough())
    vectors = derived.document_vectors(spark, one_row_group)
    assert staged[0].count() == 60 and vectors.count() == 30
    assert tasks_with_rows(staged[0]) > 1 and tasks_with_rows(vectors) > 1


def test_word_vectors_are_no_local_table_of_the_plan(spark, tiny):
    made = queries.REGISTRY["word2vec_vectors"](spark, tiny)
    text = plan(made)
    assert "LocalTableScan" not in text and "Scan parquet" in text
    model = derived.word2vec(spark, tiny)
    assert {r.word for r in made.collect()} == {r.word for r in model.getVectors().select("word").collect()}


def test_word_vectors_are_whole_after_staged_tables_are_gone(spark, tiny, tmp_path, monkeypatch):
    monkeypatch.setattr(derived, "_made", {})
    monkeypatch.setattr(derived, "new_folder", lambda spark, purpose: f"{tmp_path}/{purpose}-{uuid.uuid4().hex}")
    monkeypatch.setattr(derived, "stage", lambda df, purpose: session.stage_at(df, derived.new_folder(spark, purpose)))
    before = {r.word: r.vector for r in queries.REGISTRY["word2vec_vectors"](spark, tiny).collect()}
    for path in tmp_path.iterdir():
        shutil.rmtree(path)
    after = {r.word: r.vector for r in queries.REGISTRY["word2vec_vectors"](spark, tiny).collect()}
    assert before and before == after


def test_streamed_documents_of_a_large_row_group_are_scored_by_many_tasks(spark, one_row_group, monkeypatch):
    model = PipelineModel([])
    monkeypatch.setattr(derived, "lr_on_vectors", lambda spark, folder: model)
    tasks = F.spark_partition_id().alias("prediction")
    monkeypatch.setattr(model, "transform", lambda df: df.withColumn("prediction", tasks))
    scored = queries.stream_score_lr(spark, one_row_group).collect()
    assert sorted(r.doc_id for r in scored) == list(range(60))
    assert len({r.prediction for r in scored}) > 1

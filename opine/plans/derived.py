"""Results that several queries build on: staged tables and fitted models.

Each is made once per application and input folder, as a user trains once and then
scores many times. Tables live in the shared folder, models with the driver.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.ml.clustering import KMeansModel
from pyspark.ml.feature import Word2VecModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opine.operators import clusters, embeddings, features, models, splits
from opine.session import dealt, new_folder, path_bytes, path_exists, shared_out, stage, stage_at
from opine.sources import tables

# Partitions that the registered queries train in, dealt by the keys' hash.
WORD2VEC_PARTITIONS, KMEANS_PARTITIONS = 16, 16

_made: dict[tuple[str, str, str], Any] = {}


def once(spark: SparkSession, folder: str, name: str, make: Callable[[], Any]) -> Any:
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _made:
        _made[key] = make()
    return _made[key]


def table_once(spark: SparkSession, folder: str, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """As `once`, for a table in the shared folder; it is made again if that was cleaned up."""
    key = (spark.sparkContext.applicationId, folder, name)
    path, table = _made.get(key, (None, None))
    if path is None or not path_exists(spark, path):
        path = new_folder(spark, name.replace("_", "-"))
        table = stage_at(make(), path)
        _made[key] = (path, table)
    return table


def cleaned_reviews(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, label, review."""
    return table_once(
        spark, folder, "cleaned_reviews", lambda: features.cleaned(tables.labelled_reviews(spark, folder))
    )


def review_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, label, part (60/40), tf: array of bucket and count."""

    def make() -> DataFrame:
        reviews = cleaned_reviews(spark, folder).withColumn("part", splits.hash_part(F.col("doc_id"), 60))
        return features.with_bucket_counts(reviews)

    return table_once(spark, folder, "review_vectors", make)


def review_terms(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, label, part (60/40), bucket, tf."""
    return features.term_rows(review_vectors(spark, folder))


def dealt_out(documents: DataFrame, folder: str) -> DataFrame:
    """Documents dealt by their values: their files may be few row groups, and words take far longer than a shuffle."""
    size = path_bytes(documents.sparkSession, tables.table_path(folder, "documents"))
    return shared_out(documents, size, "doc_id", "text")


def training_sentences(spark: SparkSession, folder: str) -> DataFrame:
    """The sentences of the unlabelled reviews as word lists."""
    return embeddings.sentence_corpus(dealt_out(tables.unlabelled_reviews(spark, folder), folder))


def staged_sentences(spark: SparkSession, folder: str) -> DataFrame:
    return once(spark, folder, "sentences", lambda: stage(training_sentences(spark, folder), "sentence-corpus"))


def word2vec(spark: SparkSession, folder: str) -> Word2VecModel:
    """Fitted on the sentences of the unlabelled reviews."""

    def make() -> Word2VecModel:
        return embeddings.fit_word2vec(staged_sentences(spark, folder), WORD2VEC_PARTITIONS)

    return once(spark, folder, "word2vec", make)


def word_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """word, vector: all words of the model."""
    model = word2vec(spark, folder)

    def make() -> DataFrame:
        sentences = staged_sentences(spark, folder)
        if not all(path_exists(spark, file) for file in sentences.inputFiles()[:1]):  # cleaned up since the fit
            sentences = training_sentences(spark, folder)
        return embeddings.known_words(sentences, model.getMinCount())

    return embeddings.vectors_of(model, table_once(spark, folder, "known_words", make))


def document_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, label, features: the averaged word vectors of the labelled reviews."""

    def make() -> DataFrame:
        words = embeddings.word_lists(dealt_out(tables.labelled_reviews(spark, folder), folder))
        return word2vec(spark, folder).transform(words).select("doc_id", "label", "features")

    return table_once(spark, folder, "document_vectors", make)


def lr_on_vectors(spark: SparkSession, folder: str) -> PipelineModel:
    """Word2Vec and LBFGS logistic regression, fitted on 90 percent, as one pipeline over `words`."""

    def make() -> PipelineModel:
        train, _ = splits.hash_split(document_vectors(spark, folder), "doc_id", 90)
        return PipelineModel([word2vec(spark, folder), models.lbfgs_logistic_regression().fit(train)])

    return once(spark, folder, "lr_on_vectors", make)


def kmeans_on_vectors(spark: SparkSession, folder: str) -> KMeansModel:
    """Two clusters, the best of ten random starts on 60 percent."""

    def make() -> KMeansModel:
        train, _ = splits.hash_split(document_vectors(spark, folder), "doc_id", 60)
        return clusters.fit_kmeans_best(dealt(train, "doc_id", KMEANS_PARTITIONS))

    return once(spark, folder, "kmeans_on_vectors", make)

"""Sentence corpus, Word2Vec and averaged document vectors."""

from __future__ import annotations

from pyspark.ml.feature import Word2Vec, Word2VecModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opine.functions import text as tx

# Word2Vec trains one copy of the vectors per partition and averages them. The number is a
# setting with a fixed default: it must not follow the input's size or the cluster's cores,
# since other partitions give other vectors. With one partition a fit can be repeated exactly;
# with more, a large corpus trains in parallel, but sums of floats depend on the order of arrival.
TRAINING_PARTITIONS = 1


def sentence_rows(reviews: DataFrame, raw: str = "text", abbreviations: tuple[str, ...] = ()) -> DataFrame:
    """One row per sentence of the raw text: sent_pos, sentence, and the other columns."""
    others = [F.col(c) for c in reviews.columns if c != raw]
    return reviews.select(
        *others, F.posexplode(tx.sentences(F.col(raw), abbreviations)).alias("sent_pos", "sentence")
    )


def sentence_corpus(reviews: DataFrame, raw: str = "text", abbreviations: tuple[str, ...] = ()) -> DataFrame:
    """Sentences as word lists, stop words kept. A sentence without letters keeps an empty list."""
    rows = sentence_rows(reviews, raw, abbreviations)
    return rows.withColumn("words", tx.review_words(F.col("sentence"))).drop("sentence")


def word_lists(reviews: DataFrame, raw: str = "text") -> DataFrame:
    """Replace the raw text by `words`, the word list with stop words kept."""
    others = [F.col(c) for c in reviews.columns if c != raw]
    return reviews.select(*others, tx.review_words(F.col(raw)).alias("words"))


def fit_word2vec(
    corpus: DataFrame,
    partitions: int = TRAINING_PARTITIONS,
    vector_size: int = 300,
    min_count: int = 40,
    max_iter: int = 1,
    seed: int = 42,
    keys: tuple[str, ...] = ("doc_id", "sent_pos"),
) -> Word2VecModel:
    """Fit on the `words` of a sentence corpus.

    Sentences are dealt by their keys and sorted by them, so with one partition the vectors depend on
    the rows and the settings only, not on files or cores. The vocabulary and its vectors are held by the driver: one
    that does not fit fails the job, and the caller chooses a higher `min_count`.
    """
    dealt = corpus.repartition(partitions, *keys).sortWithinPartitions(*keys)
    return Word2Vec(
        vectorSize=vector_size,
        minCount=min_count,
        maxIter=max_iter,
        seed=seed,
        numPartitions=partitions,
        inputCol="words",
        outputCol="features",
    ).fit(dealt.select("words"))


def known_words(corpus: DataFrame, min_count: int) -> DataFrame:
    """word: those a fit on the corpus gives a vector, once each."""
    words = corpus.select(F.explode("words").alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count).select("word")


def vectors_of(model: Word2VecModel, words: DataFrame) -> DataFrame:
    """word, vector (array<double>), made by the executors: the average of one word's vector is that vector.

    `getVectors` makes all vectors a local table in the plan, on the driver's heap beside the model.
    """
    dealt = words.repartition(words.sparkSession.sparkContext.defaultParallelism)
    listed = dealt.select("word", F.array("word").alias(model.getInputCol()))
    return model.transform(listed).select("word", vector_to_array(model.getOutputCol()).alias("vector"))


# A word that makes up at least one in so many of all words is frequent. There are at most so many of them, whatever the corpus.
FREQUENT_SHARE = 10_000


def frequent_words(words: DataFrame, share: int = FREQUENT_SHARE) -> DataFrame:
    """The words, once each, that make up at least one in `share` of all rows: never more than `share` words."""
    counted = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") * share >= counted.agg(F.sum("n")).scalar()).select("word")


def _near(few: DataFrame) -> DataFrame:
    """Few rows, to be broadcast unless the session has broadcasts switched off."""
    off = few.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold") == "-1"
    return few if off else F.broadcast(few)


def _vector_sums(known: DataFrame, key: str, size: int | None) -> DataFrame:
    """key, total: the sums of `vector` by key. With a given size each dimension is a number of its own in Spark's hash
    aggregation; without one the vectors go through Spark ML's summarizer, whose state by key is much bigger."""
    if size is None:
        sums = known.select(key, array_to_vector("vector").alias("vector")).groupBy(key).agg(Summarizer.sum(F.col("vector")).alias("sum"))
        return sums.select(key, vector_to_array("sum").alias("total"))
    by_dimension = [F.sum(F.get("vector", F.lit(k))).alias(f"_{k}") for k in range(size)]
    return known.groupBy(key).agg(*by_dimension).select(key, F.array(*[f"_{k}" for k in range(size)]).alias("total"))


def average_vectors(documents: DataFrame, vectors: DataFrame, key: str = "doc_id", size: int | None = None) -> DataFrame:
    """The rows of `documents` with `features` in place of `words`: the sum of their words' vectors / all their words.

    `vectors` has word and vector (array<double>), a row for each word; `size` is the vectors' size, where it is known and
    small. A word without a vector counts in the divisor only; a document without known words has zeros. Vectors of
    frequent words, whose number is bounded, go to the documents, and are added up where these lie; only the other words
    travel to meet their vectors, and neither table is collected. Both are read several times, so they should be staged.
    """
    words = documents.select(key, F.explode("words").alias("word"))
    frequent = frequent_words(words)
    near = words.join(_near(vectors.join(_near(frequent), "word")), "word")
    far = words.join(_near(frequent), "word", "left_anti").join(vectors, "word")
    sums = _vector_sums(near.select(key, "vector").unionByName(far.select(key, "vector")), key, size)
    others = [c for c in documents.columns if c != "words"]
    dimensions = F.coalesce(vectors.agg(F.max(F.size("vector"))).scalar(), F.lit(0)) if size is None else F.lit(size)
    zeros = F.array_repeat(F.lit(0.0), dimensions.cast("int"))
    total = F.coalesce("total", zeros)
    n_words = F.greatest(F.size("words"), F.lit(1)).cast("double")
    joined = documents.withColumn("_n_words", n_words).drop("words").join(sums, key, "left")
    joined = joined.withColumn("_total", total)
    return joined.select(*others, F.transform("_total", lambda x: x / F.col("_n_words")).alias("features"))

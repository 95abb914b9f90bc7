"""Hashed TF-IDF: the Spark ML form and the relational form.

The relational form uses an md5 bucket so that any SQL engine can repeat it. Its
counting stays inside the row: a review's words never cross the network, and only
per-bucket totals (at most `num_features` rows) are shuffled or broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import (
    IDF,
    HashingTF,
    IndexToString,
    StringIndexer,
    StringIndexerModel,
    Tokenizer,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opine.functions import text as tx
from opine.functions.counting import counted
from opine.functions.hashing import md5_bucket
from opine.functions.stopwords import ENGLISH

NUM_FEATURES = 300

# Per-bucket tables have one row per bucket (and class). Up to this many buckets they
# are broadcast; beyond it Spark chooses the join from the sizes it sees.
BROADCAST_MAX_BUCKETS = 1 << 18


def bounded(per_bucket: DataFrame, num_features: int) -> DataFrame:
    """Mark a per-bucket table for broadcast while its row bound is small."""
    return F.broadcast(per_bucket) if num_features <= BROADCAST_MAX_BUCKETS else per_bucket


def cleaned(reviews: DataFrame, raw: str = "text", stopwords: Sequence[str] = ENGLISH) -> DataFrame:
    """Replace the raw text by `review`, the cleaned string."""
    others = [F.col(c) for c in reviews.columns if c != raw]
    return reviews.select(*others, tx.clean_review(F.col(raw), stopwords).alias("review"))


# --- Spark ML form -----------------------------------------------------------------


def tokenizer() -> Tokenizer:
    return Tokenizer(inputCol="review", outputCol="words")


def hashing_tf(num_features: int = NUM_FEATURES) -> HashingTF:
    return HashingTF(inputCol="words", outputCol="rawFeatures", numFeatures=num_features)


def idf() -> IDF:
    return IDF(inputCol="rawFeatures", outputCol="features")


def label_indexer() -> StringIndexer:
    """Index labels by descending frequency; equal frequencies by label text."""
    return StringIndexer(inputCol="label", outputCol="indexed", stringOrderType="frequencyDesc")


def index_to_label(indexer: StringIndexerModel, index_col: str, label_col: str) -> IndexToString:
    return IndexToString(inputCol=index_col, outputCol=label_col, labels=indexer.labels)


def vector_rows(rows: DataFrame, vector: str, value: str) -> DataFrame:
    """One row per non-zero entry of a Spark ML vector: bucket, `value`, and the other columns."""
    others = [c for c in rows.columns if c != vector]
    listed = rows.select(*others, F.posexplode_outer(vector_to_array(vector)).alias("bucket", value))
    return listed.where(F.col(value) != 0)


# --- relational form ---------------------------------------------------------------


def with_bucket_counts(reviews: DataFrame, num_features: int = NUM_FEATURES) -> DataFrame:
    """Replace `review` by `tf`, an array of the buckets it uses with their counts, made within the row."""
    others = [c for c in reviews.columns if c != "review"]
    buckets = F.transform(F.split("review", " "), lambda w: md5_bucket(w, num_features))
    return reviews.select(*others, counted(F.sort_array(buckets), "bucket", "tf").alias("tf"))


def term_rows(vectors: DataFrame) -> DataFrame:
    """One row per review and bucket it uses: bucket, tf (bigint), and the other columns.

    The outer form keeps Spark from testing for empty arrays first, which would count every review twice.
    """
    others = [c for c in vectors.columns if c != "tf"]
    used = vectors.select(*others, F.explode_outer("tf").alias("used")).where(F.col("used").isNotNull())
    return used.select(*others, "used.bucket", "used.tf")


def as_vector(tf: str | Column, num_features: int = NUM_FEATURES) -> Column:
    """`tf` as a Spark ML vector, with zeros for the other buckets."""
    pairs = F.map_from_entries(tf)
    every = F.sequence(F.lit(0), F.lit(num_features - 1))
    return array_to_vector(F.transform(every, lambda b: F.coalesce(F.try_element_at(pairs, b), F.lit(0)).cast("double")))


def idf_weights(terms: DataFrame, documents: DataFrame, num_features: int = NUM_FEATURES) -> DataFrame:
    """bucket, df, idf = ln((N + 1) / (df + 1)) for every bucket, also those no document uses.

    N is the number of documents.
    """
    total = documents.agg(F.count(F.lit(1)).alias("n")).scalar()
    used = terms.groupBy("bucket").agg(F.count(F.lit(1)).alias("df"))
    every = terms.sparkSession.range(0, num_features, 1, 1).select(F.col("id").cast("int").alias("bucket"))
    weights = every.join(used, "bucket", "left").withColumn("df", F.coalesce("df", F.lit(0).cast("bigint")))
    return weights.withColumn("idf", F.log((total + F.lit(1.0)) / (F.col("df") + F.lit(1.0))))


def tfidf(terms: DataFrame, weights: DataFrame, num_features: int = NUM_FEATURES) -> DataFrame:
    """Terms with `tfidf` = tf * idf."""
    known = bounded(weights.select("bucket", "idf"), num_features)
    return terms.join(known, "bucket").withColumn("tfidf", F.col("tf") * F.col("idf"))

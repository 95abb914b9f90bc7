from __future__ import annotations

import math

import pytest
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import IDF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from opine.operators import bayes, embeddings, features
from opine.plans import derived


@pytest.fixture(scope="module")
def vectors(spark, tiny):
    return features.with_bucket_counts(derived.cleaned_reviews(spark, tiny)).persist()


def with_ml_vector(vectors):
    return vectors.withColumn("vector", features.as_vector("tf"))


def test_ml_idf_values(spark):
    rows = [("a b",), ("a c",), ("d",)]
    words = features.tokenizer().transform(spark.createDataFrame(rows, "review string"))
    counted = features.hashing_tf().transform(words)
    weights = features.idf().fit(counted).idf.toArray()
    used = sorted(w for w in weights if w < math.log(4))
    assert used == pytest.approx([math.log(4 / 3), *[math.log(4 / 2)] * 3])


def test_tokenizer_keeps_the_empty_token(spark):
    rows = spark.createDataFrame([("",), ("a  B",)], "review string")
    assert [r.words for r in features.tokenizer().transform(rows).collect()] == [[""], ["a", "", "b"]]


def test_bucket_counts_by_brute_force(spark):
    import hashlib

    text = "good bad good film"
    expected = {}
    for word in text.split():
        bucket = int(hashlib.md5(word.encode()).hexdigest()[:8], 16) % 300
        expected[bucket] = expected.get(bucket, 0) + 1
    rows = features.term_rows(features.with_bucket_counts(spark.createDataFrame([(1, text)], "doc_id int, review string")))
    assert {r.bucket: r.tf for r in rows.collect()} == expected


def test_relational_idf_equals_ml_idf(vectors):
    model = IDF(inputCol="vector", outputCol="tfidf").fit(with_ml_vector(vectors))
    weights = features.idf_weights(features.term_rows(vectors), vectors).orderBy("bucket").collect()
    assert [w.bucket for w in weights] == list(range(features.NUM_FEATURES))
    assert [w.df for w in weights] == [int(x) for x in model.docFreq]
    assert [w.idf for w in weights] == pytest.approx(list(model.idf.toArray()))


@pytest.mark.parametrize("smoothing", [1.0, 0.1])
def test_relational_bayes_equals_ml_bayes(vectors, smoothing):
    terms = features.term_rows(vectors)
    ml_rows = with_ml_vector(vectors)
    ml = NaiveBayes(featuresCol="vector", smoothing=smoothing).fit(ml_rows)
    model = bayes.fit(terms, vectors, smoothing=smoothing, weight="tf").orderBy("label", "bucket").collect()
    assert [m.theta for m in model] == pytest.approx(list(ml.theta.toArray().ravel()))
    assert sorted({m.prior for m in model}) == pytest.approx(sorted(ml.pi.toArray()))
    relational = bayes.fit(terms, vectors, smoothing=smoothing, weight="tf")
    ours = {r.doc_id: r.prediction for r in bayes.predict(terms, relational, weight="tf").collect()}
    theirs = {r.doc_id: r.prediction for r in ml.transform(ml_rows).select("doc_id", "prediction").collect()}
    assert ours == theirs
    in_rows = bayes.predict_rows(vectors, relational)
    assert {r.doc_id: r.prediction for r in in_rows.collect()} == theirs


def test_bayes_with_one_class_predicts_that_class(spark):
    rows = spark.createDataFrame([(1, 1.0, "good film"), (2, 1.0, "fine")], "doc_id int, label double, review string")
    counted = features.with_bucket_counts(rows)
    terms = features.term_rows(counted)
    predictions = bayes.predict(terms, bayes.fit(terms, counted, weight="tf"), weight="tf").collect()
    assert {(r.doc_id, r.prediction) for r in predictions} == {(1, 1.0), (2, 1.0)}


def test_bayes_tie_goes_to_the_lower_label(spark):
    rows = [(1, 1.0, "same"), (2, 0.0, "same")]
    counted = features.with_bucket_counts(spark.createDataFrame(rows, "doc_id int, label double, review string"))
    terms = features.term_rows(counted)
    predictions = bayes.predict(terms, bayes.fit(terms, counted, weight="tf"), weight="tf").collect()
    assert {r.prediction for r in predictions} == {0.0}


def test_per_bucket_tables_are_broadcast_only_while_bounded(spark):
    table = spark.range(5)
    assert features.bounded(table, features.BROADCAST_MAX_BUCKETS + 1) is table
    assert features.bounded(table, 300) is not table


def test_document_vector_divides_by_all_words(spark):
    corpus = spark.createDataFrame([(i, 0, ["a", "b"]) for i in range(5)], "doc_id int, sent_pos int, words array<string>")
    model = embeddings.fit_word2vec(corpus, vector_size=4, min_count=1)
    rows = spark.createDataFrame([(1, ["a", "unknown"]), (2, []), (3, ["a"])], "i int, words array<string>")
    made = {r.i: r.features.toArray() for r in model.transform(rows).collect()}
    assert made[1] == pytest.approx(made[3] / 2)
    assert list(made[2]) == [0.0] * 4
    again = embeddings.fit_word2vec(corpus, vector_size=4, min_count=1)
    assert {r.word: tuple(r.vector) for r in again.getVectors().collect()} == {
        r.word: tuple(r.vector) for r in model.getVectors().collect()
    }


def test_word_vectors_depend_on_rows_and_settings_only(spark):
    rows = [(i, i % 3, [f"w{(i * j) % 17}" for j in range(12)]) for i in range(60)]
    corpus = spark.createDataFrame(rows, "doc_id int, sent_pos int, words array<string>")
    made = []
    for parts in (1, 3, 7):
        model = embeddings.fit_word2vec(corpus.repartition(parts), vector_size=4, min_count=5)
        made.append({r.word: tuple(r.vector) for r in model.getVectors().collect()})
    assert made[0] == made[1] == made[2]
    counts = {}
    for _, _, words in rows:
        for w in words:
            counts[w] = counts.get(w, 0) + 1
    assert set(made[0]) == {w for w, n in counts.items() if n >= 5}  # min_count is what was asked for


def test_vectors_of_all_words_are_made_by_the_executors(spark):
    rows = [(i, 0, [f"w{j}" for j in range(40) if (i + j) % 3] + [f"rare{i}"]) for i in range(30)]
    corpus = spark.createDataFrame(rows, "doc_id int, sent_pos int, words array<string>")
    model = embeddings.fit_word2vec(corpus, vector_size=4, min_count=5)
    made = embeddings.vectors_of(model, embeddings.known_words(corpus, model.getMinCount()))
    expected = model.getVectors().select("word", vector_to_array("vector").alias("vector"))
    assert made.dtypes == expected.dtypes
    assert sorted(map(tuple, made.collect())) == sorted(map(tuple, expected.collect()))
    assert made.select(F.spark_partition_id()).distinct().count() > 1


def test_averages_by_join_equal_the_model(spark):
    corpus = spark.createDataFrame([(i, 0, ["a", "b", "c"][: i % 3 + 1]) for i in range(30)], "doc_id int, sent_pos int, words array<string>")
    model = embeddings.fit_word2vec(corpus, partitions=1, vector_size=4, min_count=5)
    vectors = model.getVectors().select("word", vector_to_array("vector").alias("vector"))
    rows = spark.createDataFrame([(1, ["a", "x", "a"]), (2, []), (3, ["x"]), (4, ["c", "b"])], "doc_id int, words array<string>")
    made = {r.doc_id: r.features for r in embeddings.average_vectors(rows, vectors).collect()}
    expected = {r.doc_id: list(r.features.toArray()) for r in model.transform(rows).collect()}
    for key, value in expected.items():
        assert made[key] == pytest.approx(value, abs=1e-6)


def test_averages_of_frequent_and_other_words_by_hand(spark):
    rows = [(i % 7 if i != 5 else None, ["often"] * 9 + [f"w{i}", "x", "w3"][: i % 4]) for i in range(20)]
    given = {"often": [1.0, 2.0], "w3": [3.0, -1.0], **{f"w{i}": [float(i), 0.5] for i in range(4, 20)}}
    documents = spark.createDataFrame([(n, *r) for n, r in enumerate(rows)], "n int, doc_id int, words array<string>")
    vectors = spark.createDataFrame(list(given.items()), "word string, vector array<double>")
    words = documents.select(F.explode("words").alias("word"))
    assert [r.word for r in embeddings.frequent_words(words, 3).collect()] == ["often"]
    sums = {}
    for key, listed in rows:  # rows of one key share their sums, as in a join by key; a missing key meets none
        for word in listed:
            total = sums.setdefault(key, [0.0, 0.0])
            sums[key] = [a + b for a, b in zip(total, given.get(word, (0.0, 0.0)), strict=True)]
    sums[None] = [0.0, 0.0]
    for size in (None, 2):
        made = {r.n: r.features for r in embeddings.average_vectors(documents, vectors, size=size).collect()}
        assert len(made) == len(rows)
        for n, (key, listed) in enumerate(rows):
            assert made[n] == pytest.approx([x / len(listed) for x in sums[key]])


def test_frequent_words_are_added_up_before_they_travel(spark):
    documents = spark.createDataFrame([(i, ["a", "b", "c"] * 50) for i in range(64)], "doc_id int, words array<string>").persist()
    vectors = spark.createDataFrame([(w, [1.0, 2.0]) for w in "abc"], "word string, vector array<double>")
    averaged = embeddings.average_vectors(documents, vectors, size=2)
    plan = averaged._jdf.queryExecution().executedPlan().toString()
    documents.unpersist()
    # no state by key and word, and none that is serialized by key
    assert "hashpartitioning(doc_id#" in plan and "ObjectHashAggregate" not in plan
    assert not any(line.count("hashpartitioning(doc_id#") and "word#" in line for line in plan.splitlines())
    assert "LeftAnti" in plan and "BroadcastHashJoin" in plan


def test_label_index_and_its_inverse(spark):
    rows = spark.createDataFrame([(1.0,), (1.0,), (0.0,)], "label double")
    indexer = features.label_indexer().fit(rows)
    indexed = indexer.transform(rows)
    assert [r.indexed for r in indexed.collect()] == [0.0, 0.0, 1.0]
    back = features.index_to_label(indexer, "indexed", "back").transform(indexed)
    assert back.where(F.col("label") != F.col("back").cast("double")).isEmpty()

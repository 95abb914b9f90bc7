from __future__ import annotations

from pyspark.sql import functions as F

from opine.functions.hashing import md5_bucket
from opine.operators import explore, splits
from opine.operators.embeddings import sentence_corpus


def reviews(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")


def test_empty_review_gives_one_empty_word(spark):
    words = explore.explode_words(reviews(spark, "good good film", "42 !!", "the of"))
    assert sorted((r.doc_id, r.pos, r.word) for r in words.collect()) == [
        (0, 0, "good"),
        (0, 1, "good"),
        (0, 2, "film"),
        (1, 0, ""),
        (2, 0, ""),
    ]
    assert {r.word: r.n for r in explore.word_count(words).collect()} == {"good": 2, "film": 1, "": 2}


def test_ties_at_the_cut_go_by_word(spark):
    top = explore.top_words(reviews(spark, "zeta alpha beta", "zeta gamma"), k=3)
    assert [(r.word, r.n) for r in top.collect()] == [("zeta", 2), ("alpha", 1), ("beta", 1)]


def test_polarity(spark):
    rows = spark.createDataFrame([(1, 1.0, "a"), (2, 0.0, "b"), (3, None, "c")], "doc_id int, label double, text string")
    assert [r.doc_id for r in explore.with_polarity(rows, 1).collect()] == [1]
    assert [r.doc_id for r in explore.with_polarity(rows, 0).collect()] == [2]


def test_sentence_corpus_keeps_sentences_without_letters(spark):
    corpus = sentence_corpus(reviews(spark, "Hi there. 42! It&apos;s <b>me</b>", ""))
    assert [(r.doc_id, r.sent_pos, r.words) for r in corpus.orderBy("sent_pos").collect()] == [
        (0, 0, ["hi", "there"]),
        (0, 1, []),
        (0, 2, ["it", "apos", "s", "me"]),
    ]


def test_a_row_without_a_key_is_a_test_row(spark):
    rows = spark.createDataFrame([(1,), (2,), (None,)], "id bigint")
    train, test = splits.hash_split(rows, "id", 60)
    assert train.count() + test.count() == 3
    assert not test.where("id IS NULL").isEmpty()


def test_hash_split_ignores_partitioning(spark):
    ids = spark.range(2000)
    sides = [splits.hash_split(df, "id", 60) for df in (ids, ids.repartition(13), ids.coalesce(1))]
    first = {r.id for r in sides[0][0].collect()}
    assert all({r.id for r in train.collect()} == first for train, _ in sides)
    assert all(train.count() + test.count() == 2000 for train, test in sides)
    assert 0.55 < len(first) / 2000 < 0.65


def test_hash_folds_are_even_and_split_the_training_rows(spark):
    train, _ = splits.hash_split(spark.range(6000), "id", 60)
    sizes = [r["count"] for r in train.groupBy(splits.hash_fold(F.col("id"), 3)).count().collect()]
    assert len(sizes) == 3
    assert max(sizes) - min(sizes) < 0.1 * sum(sizes)


def test_random_split_repeats_with_its_seed(spark):
    ids = spark.range(0, 500, 1, 4)
    first, again = (splits.random_split(ids, [0.9, 0.1], 7) for _ in range(2))
    assert [r.id for r in first[0].collect()] == [r.id for r in again[0].collect()]
    assert first[0].count() + first[1].count() == 500


def test_md5_bucket_range(spark):
    buckets = [r.b for r in spark.range(1000).select(md5_bucket(F.col("id"), 7).alias("b")).collect()]
    assert set(buckets) == set(range(7))

from __future__ import annotations

import math
import re

import pytest
from pyspark.sql import functions as F

from opine.functions import text as tx
from opine.operators import abbreviations

TEXTS = (
    ["Mr. Smith met Dr. Jones. They left at once.", "I saw Mr. Brown, e.g. on Monday. Mr. Brown saw me."] * 20
    + ["The cat sat. The cat ran. A cat is a cat. Cats run", 'He said "no." Then (he left.) A mr without it? 3.5 percent.']
    + ["", "...", "No end", "!?", "a\u0001b. C", "Wait... Mr.\tX came.\nU.S. law!"]
)


@pytest.fixture(scope="module")
def reviews(spark):
    return spark.createDataFrame([*enumerate(TEXTS), (99, None)], "doc_id bigint, text string").repartition(3)


def by_hand() -> dict[str, tuple[int, int, float]]:
    shape = re.compile(r"^[\"'(\[]*((?:[A-Za-z]+\.)*[A-Za-z]+)(\.?)[\"')\],;:!?]*$")
    counts: dict[str, list[int]] = {}
    for text in TEXTS:
        for token in re.split(r"[ \t\r\n]+", text):
            found = shape.match(token)
            if found:
                counts.setdefault(found[1].lower(), [0, 0])[0 if found[2] else 1] += 1
    share = sum(a for a, _ in counts.values()) / sum(a + b for a, b in counts.values())
    result = {}
    for word, (a, b) in counts.items():
        if a:
            ratio = -2 * ((a * math.log(share) + b * math.log(1 - share)) - (a * math.log(0.99) + b * math.log(0.01)))
            letters = len(word.replace(".", ""))
            result[word] = (a, b, ratio * math.exp(-letters) * (word.count(".") + 1) * letters ** -b)
    return result


def test_scores_by_hand(reviews):
    found = {r.type: (r.n_with, r.n_without, r.score) for r in abbreviations.learnt(reviews).collect()}
    wanted = by_hand()
    assert found.keys() == wanted.keys()
    for word, (a, b, score) in wanted.items():
        assert found[word][:2] == (a, b) and found[word][2] == pytest.approx(score)


def test_titles_are_learnt_and_words_are_not(reviews):
    flags = {r.type: r.is_abbreviation for r in abbreviations.learnt(reviews).collect()}
    assert flags["dr"] and flags["e.g"]
    assert not flags["cat"] and "cats" not in flags


def test_no_cut_after_what_was_learnt(spark, reviews):
    only = reviews.where(F.col("doc_id").isin(0, 1))
    known = abbreviations.learnt(reviews.where(~F.col("text").contains("A mr")))
    found = [(r.doc_id, r.sent_pos, r.sentence) for r in abbreviations.sentence_rows(only, known).collect()]
    assert sorted(found) == [
        (0, 0, "Mr. Smith met Dr. Jones."),
        (0, 1, "They left at once."),
        (1, 0, "I saw Mr. Brown, e.g. on Monday."),
        (1, 1, "Mr. Brown saw me."),
    ]


def test_equals_the_list_form(spark, reviews):
    """Cutting by an array of types and by a list of names is the same."""
    names = spark.createDataFrame([("mr", True), ("dr", True), ("once", False)], "type string, is_abbreviation boolean")
    by_array = abbreviations.sentence_rows(reviews, names).select("doc_id", "sent_pos", "sentence")
    listed = reviews.select("doc_id", F.posexplode(tx.sentences(F.col("text"), ("Mr", "Dr", "mr"))).alias("sent_pos", "sentence"))
    assert sorted(map(tuple, by_array.collect())) == sorted(map(tuple, listed.collect()))


def test_without_any_abbreviation_it_is_the_plain_rule(spark, reviews):
    none = spark.createDataFrame([], "type string, is_abbreviation boolean")
    by_array = abbreviations.sentence_rows(reviews, none).select("doc_id", "sent_pos", "sentence")
    plain = reviews.select("doc_id", F.posexplode(tx.sentences(F.col("text"))).alias("sent_pos", "sentence"))
    assert sorted(map(tuple, by_array.collect())) == sorted(map(tuple, plain.collect()))


def test_a_corpus_of_periods_and_an_empty_one(spark):
    every = spark.createDataFrame([(1, "mr. dr. end.")], "doc_id bigint, text string")
    assert {r.score for r in abbreviations.learnt(every).collect()} == {0.0}
    assert abbreviations.learnt(every.limit(0)).collect() == []

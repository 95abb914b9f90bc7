from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from opine.functions import text as tx
from opine.functions.stopwords import ENGLISH


@pytest.fixture(scope="module")
def apply(spark):
    def run(function, *values):
        rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
        result = rows.select("i", function(F.col("s")).alias("r")).orderBy("i").collect()
        return [row.r for row in result]

    return run


@pytest.mark.parametrize(
    ("html", "expected"),
    [
        ("a<br />b &amp; c", "ab & c"),
        ("&amp;lt;", "&lt;"),
        ('<script>var t="</p>";</script>x', "x"),
        ("<SCRIPT type='a'>no</SCRIPT >yes", "yes"),
        ("<style>p{}</style><!-- c\n<b> -->t", "t"),
        ("<p>one<b>two</b></p>", "onetwo"),
        ("caf&eacute; &#233; &#xE9; &nbsp;", "café é é  "),
        ("&#128512;&#x1F600;", "😀😀"),
        ("&#0;&#55296;&#1114112;", "���"),
        ("fish & chips &unknown; &; &&amp;", "fish & chips &unknown; &; &&"),
        ("<scripted>kept</scripted>", "kept"),
        ("5 < 6", "5 < 6"),
        ("5 < 6 and 7 > 3 great", "5 < 6 and 7 > 3 great"),
        ("I <3 it, really > all", "I <3 it, really > all"),
        ("</p><!DOCTYPE html><?xml ?>t", "t"),
        ("", ""),
    ],
)
def test_html_to_text(apply, html, expected):
    assert apply(tx.html_to_text, html) == [expected]


def test_separator_keeps_words_apart(apply):
    assert apply(lambda c: tx.html_to_text(c, " "), "a<br>b") == ["a b"]


def test_abbreviations_are_taken_literally_and_marks_in_the_text_do_no_harm(apply):
    cut = lambda c: tx.sentences(c, ("e.g", "Mr"))
    assert apply(cut, "An egg. Yes, e.g. this. Mr. X") == [["An egg.", "Yes, e.g. this.", "Mr. X"]]
    assert apply(cut, "a\u0001b\u0002c. d") == [["a b c.", "d"]]
    assert apply(tx.sentences, "a\u0001b. c") == [["a b.", "c"]]


def test_letters_only_gives_one_space_per_character(apply):
    assert apply(tx.letters_only, "été 42 Don't", "a😀b") == [" t     Don t", "a b"]


@pytest.mark.parametrize(
    ("text", "words"),
    [
        ("été 42 Don't", ["t", "don", "t"]),
        ("  A  b\n\tC ", ["a", "b", "c"]),
        ("42 !!", []),
        ("", []),
        ("\u0130\u212a", []),
    ],
)
def test_word_list(apply, text, words):
    assert apply(tx.word_list, text) == [words]


def test_letters_that_lower_to_ascii_are_not_letters(apply):
    # the Kelvin sign lowers to k, but it is outside a-z and A-Z
    assert apply(tx.word_list, "\u212am") == [["m"]]


def test_stop_words_leave_order_and_repeats(apply):
    def kept(c):
        return tx.without_stopwords(tx.word_list(c))

    assert apply(kept, "The good, the bad and the good", "the and of") == [["good", "bad", "good"], []]


def test_stop_words_are_optional_and_a_parameter(apply):
    assert apply(tx.review_words, "The cat") == [["the", "cat"]]
    assert apply(lambda c: tx.review_words(c, True), "The cat") == [["cat"]]
    assert apply(lambda c: tx.review_words(c, True, ("cat",)), "The cat") == [["the"]]
    assert apply(lambda c: tx.review_words(c, True, ()), "The cat") == [["the", "cat"]]


def test_stop_list_is_the_public_one_without_apostrophes(spark):
    from pyspark.ml.feature import StopWordsRemover

    public = StopWordsRemover.loadDefaultStopWords("english")
    assert set(ENGLISH) == {w for w in public if "'" not in w}


def test_clean_review(apply):
    texts = ("<p>The movie was GREAT&excl; 10/10</p>", "42 !!", "the of")
    assert apply(tx.clean_review, *texts) == ["movie great excl", "", ""]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("Hi there. It is Mr. X ok?\nYes!!  Done", ["Hi there.", "It is Mr.", "X ok?", "Yes!!", "Done"]),
        ("  one.two. ", ["one.two."]),
        ("...", ["..."]),
        (" \n\t ", []),
        ("", []),
    ],
)
def test_sentences(apply, text, expected):
    assert apply(tx.sentences, text) == [expected]


def test_sentences_with_abbreviations(apply):
    def cut(c):
        return tx.sentences(c, ("Mr", "Dr"))

    assert apply(cut, "It is Mr. X ok? ask Dr.\nNo. Amr. Yes") == [
        ["It is Mr. X ok?", "ask Dr.\nNo.", "Amr.", "Yes"]
    ]


def test_null_text_stays_null(apply):
    assert apply(tx.clean_review, None, "x") == [None, "x"]

"""Licence scans with a positional index of rare words.

The index holds every word of every template with its places. In each file, and for each template whose mandatory words
the file holds, the template's words of highest IDF among those that stand in the file are looked up. A word found at
place p of the file and q of the template says that the template would start at p - q. The postings of different words
are intersected by that start: a notice needs `AGREEING` of the words looked up to agree on one, and only then are its
key phrases verified, at their places from that start or from one near it, as an inserted word moves what follows it. A
base phrase needs all its words, so its rarest word leads to every place where it stands, and it is its own key phrase.

The document frequencies are counted over the whole corpus. All else happens within a file's row: nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opine.llm.common import words
from opine.llm.license_text import BASE, NOTICES, Template

# Words looked up for a notice, how many of them must agree on a start, and how far apart the starts may lie that
# inserted and missing words give to the parts of one notice.
LOOKED_UP, AGREEING, NEAR = 5, 2, 4
# A posting is one bigint: the start, and 12 bits for the place of the word it comes from.
PLACE_BITS = 12


def word_frequencies(documents: DataFrame, vocabulary: Sequence[str]) -> DataFrame:
    """word, df: how many documents hold each word of a vocabulary."""
    held = F.array_intersect(words("text"), F.expr(_fixed(vocabulary)))
    return documents.select(F.explode(held).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("df"))


def _phrase_places(template: Template) -> list[tuple[int, list[str]]]:
    """Where each key phrase starts in a template (from 0), and its words."""
    listed = f" {template.text} "
    return [(listed[: listed.index(f" {phrase} ")].count(" "), phrase.split(" ")) for phrase in template.key_phrases]


def _fixed(listed: Sequence[str]) -> str:
    """Words as a constant array."""
    if not all(re.fullmatch(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", word) for word in listed):
        raise ValueError(f"templates hold words of a-z, 0-9 and non-ASCII characters only: {listed}")
    return f"split('{' '.join(listed)}', ' ')"


def _let(name: str, value: str, body: str) -> str:
    return f"transform(array({value}), {name} -> {body})[0]"


def _starts(template: Template, df: Mapping[str, int]) -> str:
    """The starts that looked-up words propose, each with how many agree on it: array<struct<start, n>>, by start."""
    listed = template.text.split(" ")
    if len(listed) >= 1 << PLACE_BITS:
        raise ValueError(f"template {template.name} has too many words")
    rarest = sorted(set(listed), key=lambda w: (df.get(w, 0), w))
    places: dict[str, list[int]] = {}
    for place, word in enumerate(listed):
        places.setdefault(word, []).append(place)
    index = f"map({', '.join(f"'{word}', array({', '.join(map(str, at))})" for word, at in places.items())})"
    looked_up = f"slice(filter({_fixed(rarest)}, w -> array_contains(held, w)), 1, {1 if template.base else LOOKED_UP})"
    found = "filter(sequence(0, size(file_words) - 1), p -> array_contains(looked_up, file_words[p]))"
    # The first place stands for the word.
    postings = (
        f"array_distinct(flatten(transform({found}, p -> transform(filter({index}[file_words[p]], q -> p >= q), "
        f"q -> shiftleft(bigint(p - q), {PLACE_BITS}) | bigint({index}[file_words[p]][0])))))"
    )
    sorted_starts = f"array_sort(transform({postings}, x -> int(shiftright(x, {PLACE_BITS}))))"
    ends = "filter(sequence(0, size(v) - 1), i -> i = size(v) - 1 OR v[i] <> v[i + 1])"
    runs = "transform(ends, (e, k) -> named_struct('start', v[e], 'n', e - if(k = 0, -1, ends[k - 1])))"
    counted = f"if(size(v) = 0, array(), {_let('ends', ends, runs)})"
    return _let("looked_up", looked_up, _let("v", sorted_starts, counted))


def _stands(phrase: Sequence[str], at: str) -> str:
    return f"array_join(slice(file_words, {at} + 1, {len(phrase)}), ' ') = '{' '.join(phrase)}'"


def found_at(template: Template, df: Mapping[str, int]) -> Column:
    """array<struct<label, start, share>>: where a template stands in `file_words`, and how much of it; `held` has those
    of the words that the file holds."""
    listed = template.text.split(" ")
    phrases = _phrase_places(template)
    mandatory = sorted({word for _, phrase in phrases for word in phrase})

    def struct(share: str) -> str:
        return f"named_struct('label', '{template.label}', 'start', g.start, 'share', {share})"

    if template.base:
        body = f"transform(filter(given, g -> {_stands(listed, 'g.start')}), g -> {struct('1D')})"
    else:
        near = f"transform(filter(given, o -> abs(o.start - g.start) <= {NEAR}), o -> o.start)"
        verified = " AND ".join(f"exists(near, s -> {_stands(phrase, f's + {before}')})" for before, phrase in phrases)
        in_place = f"filter(sequence(0, {len(listed) - 1}), i -> exists(near, s -> get(file_words, s + i) = {_fixed(listed)}[i]))"
        share = _let("near", near, f"size({in_place}) / {len(listed)}D")
        agreed = f"filter(given, g -> g.n >= {min(AGREEING, len(mandatory))} AND {_let('near', near, verified)})"
        body = f"transform({agreed}, g -> {struct(share)})"
    none = "CAST(array() AS array<struct<label: string, start: int, share: double>>)"
    return F.expr(f"CASE WHEN size(array_except({_fixed(mandatory)}, held)) = 0 THEN {_let('given', _starts(template, df), body)} ELSE {none} END")


def scan(documents: DataFrame, templates: Sequence[Template] = BASE + NOTICES) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score; a row for each of `documents`.

    `score` is the largest share of a template's words that stand in their places, from its start or one near it; 1
    where a base phrase stands, 0 without any label. Which of a notice's words are looked up depends on how many
    documents hold them; base phrases do not. A null or empty text has no words and no labels. Rows may repeat and ids
    may be null or repeat. Other columns are not read.
    """
    vocabulary = sorted({word for template in templates for word in template.text.split(" ")})
    df = {row.word: row.df for row in word_frequencies(documents, vocabulary).collect()}  # as many as the templates' words
    rows = documents.select("doc_id", words("text").alias("file_words"))
    rows = rows.withColumn("held", F.array_intersect("file_words", F.expr(_fixed(vocabulary))))

    def all_of(base: bool) -> Column:
        chosen = [t for t in templates if t.base == base]
        if not chosen:
            return F.array().cast("array<struct<label: string, start: int, share: double>>")
        return F.concat(*[found_at(t, df) for t in chosen])

    found = rows.select("doc_id", F.size("file_words").cast("bigint").alias("n_words"), all_of(True).alias("base"), all_of(False).alias("notices"))

    def labels(*columns: str) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.concat(*[F.transform(c, lambda x: x["label"]) for c in columns]))), ",")

    base_starts = F.transform("base", lambda x: x["start"].cast("bigint"))
    shares = F.transform(F.concat("base", "notices"), lambda x: x["share"])
    return found.select(
        "doc_id",
        "n_words",
        F.size("base").cast("bigint").alias("n_base"),
        F.array_min(base_starts).alias("first_word"),
        F.array_max(base_starts).alias("last_word"),
        labels("base").alias("base_labels"),
        labels("base", "notices").alias("labels"),
        F.coalesce(F.array_max(shares), F.lit(0.0)).alias("score"),
    )

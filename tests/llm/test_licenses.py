from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest

from opine.llm import licenses
from opine.llm.license_text import BASE, NOTICES
from plain_words import word_list


def brute(text):
    w, starts, labels = word_list(text), [], set()
    for template in BASE:
        phrase = template.text.split(" ")
        for s in range(len(w) - len(phrase) + 1):
            if w[s : s + len(phrase)] == phrase:
                starts.append(s)
                labels.add(template.label)
    return len(w), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def by_hand(texts):
    """labels and score of each text: starts from looked-up words, two that agree, key phrases, words in place."""
    lists = [word_list(t) for t in texts]
    df = Counter(w for listed in lists for w in set(listed))
    found = []
    for w in lists:
        labels, score = set(), 0.0
        for template in (*BASE, *NOTICES):
            t = template.text.split(" ")
            phrases = [((f" {template.text} ".index(f" {p} ")), p.split(" ")) for p in template.key_phrases]
            phrases = [(f" {template.text} "[:at].count(" "), p) for at, p in phrases]
            if not {x for _, p in phrases for x in p} <= set(w):
                continue
            picked = sorted(set(t) & set(w), key=lambda x: (df[x], x))[: 1 if template.base else 5]
            votes = defaultdict(set)
            for p, word in enumerate(w):
                for q in (q for q, x in enumerate(t) if x == word and word in picked and q <= p):
                    votes[p - q].add(word)
            for start, voters in votes.items():
                if template.base:
                    if w[start : start + len(t)] == t:
                        labels.add(template.label)
                        score = 1.0
                    continue
                near = [s for s in votes if abs(s - start) <= 4]
                if len(voters) < 2 or not all(any(w[s + b : s + b + len(p)] == p for s in near) for b, p in phrases):
                    continue
                labels.add(template.label)
                in_place = sum(any(w[s + i : s + i + 1] == [x] for s in near) for i, x in enumerate(t))
                score = max(score, in_place / len(t))
        found.append((",".join(sorted(labels)), score))
    return found


def checked(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    found = {r.doc_id: (r.labels, r.score) for r in licenses.scan(rows).collect()}
    expected = by_hand(texts)
    for n, (labels, score) in enumerate(expected):
        assert found[n][0] == labels and found[n][1] == pytest.approx(score), texts[n][:200]
    return found


def test_labels_and_scores_by_hand(spark, documents):
    """Given texts, and notices cut, mixed, with words inserted, left out and exchanged."""
    pick = random.Random(9)
    texts = [r.text or "" for r in documents.collect()]
    for template in NOTICES * 4:
        w = template.text.split(" ")
        for _ in range(pick.randint(0, 3)):
            at = pick.randrange(len(w) + 1)
            w[at : at + pick.randint(0, 1)] = [pick.choice(["the", "software", "license", "x", "cc"])] * pick.randint(0, 2)
        texts.append(" ".join(["intro", *w, "and", *pick.choice(NOTICES).text.split(" ")[: pick.randint(0, 20)]]))
    checked(spark, texts)


def test_an_inserted_word_costs_a_notice_little(spark):
    mit = next(t for t in NOTICES if t.name == "mit-grant").text
    texts = [mit.replace("to deal in", "really to deal in"), mit.replace("copies of the", "copies of all the"), mit]
    found = checked(spark, texts)
    for n in (0, 1):
        assert found[n][0] == "mit" and found[n][1] > 0.9
    gpl = next(t for t in NOTICES if t.name == "gpl-3-header").text
    (only,) = checked(spark, [gpl.replace("as published", "just as published")]).values()
    assert "gpl-3.0" in only[0] and only[1] == 1.0  # a base phrase stands there too


def test_the_intersection_refuses_a_chance_hit(spark):
    """The key phrase stands, but the rarer words that the file holds stand elsewhere: no start has two of them."""
    mit = next(t for t in NOTICES if t.name == "mit-grant").text
    chance = "permission is hereby granted free of charge to visitors they merge sublicense publish sell modify obtaining at will"
    plain = ["permission is hereby granted free of charge"] * 3
    found = checked(spark, [chance, mit, *plain])
    assert found[0] == ("", 0.0) and found[1][0] == "mit"
    assert found[2][0] == "mit"  # short, but all it holds is in place


def test_a_long_file_of_common_words(spark):
    text = "the software and of to in copy " * 30_000 + next(t for t in NOTICES if t.name == "mit-grant").text
    (row,) = licenses.scan(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).collect()
    assert row.labels == "mit" and row.score == 1.0


def base_part(rows):
    return sorted(map(str, ((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in rows)))


def test_given_table(spark, documents):
    found = licenses.scan(documents).collect()
    expected = [(r.doc_id, *brute(r.text)) for r in documents.collect()]
    assert base_part(found) == sorted(map(str, expected))
    for r in found:
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert r.score == 1.0 if r.n_base else 0 <= r.score <= 1


def test_odd_rows(spark, odd):
    assert base_part(licenses.scan(odd).collect()) == sorted(map(str, ((r.doc_id, *brute(r.text)) for r in odd.collect())))


def test_every_place_counts(spark):
    text = "MIT License, mit license CC-BY. cc by cc by; GNU General Public License. gnu gnu general public license Apache\nLicense"
    rows = spark.createDataFrame([(1, text), (2, "mit. Licenses"), (3, "general public license")], "doc_id bigint, text string")
    found = {r.doc_id: r for r in licenses.scan(rows).collect()}
    assert (found[1].n_base, found[1].first_word, found[1].last_word) == (8, 0, 19)
    assert found[1].base_labels == "apache,cc-by,gpl,mit"
    assert found[2].labels == found[3].labels == ""


def test_notices_have_their_labels(spark):
    rows = [(n, f"Preface words. {t.text.capitalize()}! And more.") for n, t in enumerate(NOTICES)]
    found = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    for n, template in enumerate(NOTICES):
        assert template.label in found[n].labels.split(","), template.name
        assert found[n].score == 1.0


def test_a_changed_notice_needs_its_key_phrase(spark):
    mit = next(t for t in NOTICES if t.name == "mit-grant").text
    rows = [(1, mit.replace("copy modify merge", "copy alter blend")), (2, mit.replace("hereby granted free", "hereby given free"))]
    found = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert found[1].labels == "mit" and 0.9 < found[1].score < 1.0
    assert found[2].labels == ""


def test_a_shortened_notice_keeps_its_label_whatever_the_other_rows(spark):
    mit = next(t for t in NOTICES if t.name == "mit-grant").text
    cut = mit[: mit.index(" modify merge")]
    others = [(2, mit), (3, "merge publish sell"), (4, "permission is hereby granted free of charge " * 3)]
    for rows in ([], others):
        found = {r.doc_id: r for r in licenses.scan(spark.createDataFrame([(1, cut), *rows], "doc_id bigint, text string")).collect()}
        assert found[1].labels == "mit"
        assert found[1].score == len(cut.split(" ")) / len(mit.split(" "))


def test_no_rows(spark, nothing):
    assert licenses.scan(nothing).collect() == []


def test_no_python_on_the_main_path(spark, documents):
    plan = licenses.scan(documents)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np

from opine.llm import fingerprints as f
from plain_words import word_list


def edited(text: str, following: str) -> str:
    cut = len(text) // 4
    return text[: len(text) - cut] + following[:cut]


def generalised_jaccard(a: str, b: str) -> float:
    a, b = Counter(word_list(a)), Counter(word_list(b))
    return sum((a & b).values()) / sum((a | b).values()) if a or b else 1.0


def in_order(documents):
    """Rows in the operator's order, where ids decide it."""
    rows = [(r.doc_id, r.text or "") for r in documents.select("doc_id", "text").collect()]
    return sorted(rows, key=lambda r: (r[0] is not None, r[0]))


def test_given_table(spark, documents):
    rows = in_order(documents)
    found = {r.doc_id: r for r in f.compared(documents).collect()}
    assert len(found) == len(rows)
    errors = []
    for n, (doc_id, text) in enumerate(rows):
        following = rows[(n + 1) % len(rows)][1]
        new, row = edited(text, following), found[doc_id]
        assert row.n_chars == len(text)
        assert row.edited_sha256 == hashlib.sha256(new.encode()).hexdigest()
        errors.append((row.near_edited - generalised_jaccard(text, new), row.near_next - generalised_jaccard(text, following)))
    errors = np.array(errors)
    # 64 samples: a standard error of at most 1/16 each.
    assert np.all(np.abs(errors.mean(axis=0)) < 0.02) and np.all(np.sqrt((errors**2).mean(axis=0)) < 0.075)


def test_long_texts_without_a_common_word_are_unlike(spark):
    counts = (2_000, 20_000, 50_000)
    rows = []
    for i, n in enumerate(counts):
        rows += [(2 * i, " ".join(f"a{k}" for k in range(n))), (2 * i + 1, " ".join(f"b{k}" for k in range(n)))]
    found = {r.doc_id: r for r in f.compared(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert [found[2 * i].near_next for i in range(len(counts))] == [0.0] * len(counts)


def test_long_weighted_texts_against_exact_likeness(spark):
    """Word counts fall as in natural texts, most are 1; pairs share from none to most of 20,000 distinct words."""
    rng, rows, exact = np.random.default_rng(5), [], []
    for i, shift in enumerate((0, 2_000, 6_000, 10_000, 20_000)):
        ranks = rng.permutation(np.arange(1, 20_001))
        listed = [f"w{i}x{k}" for k in range(40_000)]
        weight = np.maximum(1, 2_000 // ranks)
        a = " ".join(f"{listed[k]} " * weight[k] for k in range(20_000))
        b = " ".join(f"{listed[k + shift]} " * weight[(k + shift) % 20_000] for k in range(20_000))
        rows += [(2 * i, a), (2 * i + 1, b)]
        exact.append(generalised_jaccard(a, b))
    found = {r.doc_id: r.near_next for r in f.compared(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    errors = np.array([found[2 * i] - e for i, e in enumerate(exact)])
    # 3 standard errors of 64 samples each.
    assert np.all(np.abs(errors) < 3 / 16), (exact, errors)
    assert np.sqrt((errors**2).mean()) < 0.075 and exact[-1] == 0.0, (exact, errors)


def test_many_ranges_give_the_same(spark, documents, monkeypatch):
    whole = sorted(map(tuple, f.compared(documents).collect()))
    monkeypatch.setattr(f, "RANGE_BYTES", 20_000)
    assert sorted(map(tuple, f.compared(documents).collect())) == whole


def test_equal_texts_have_equal_fingerprints(spark, documents):
    rows = f.compared(documents.union(documents.selectExpr("doc_id + 1000000", *documents.columns[1:]))).collect()
    prints = {}
    for r in rows:
        assert prints.setdefault(r.doc_id % 1_000_000, r.fingerprint) == r.fingerprint
        assert len(r.fingerprint) == 8 * f.SAMPLES


def test_odd_rows(spark, odd):
    rows = f.compared(odd).collect()
    given = Counter((r.doc_id, len(r.text or "")) for r in odd.collect())
    assert Counter((r.doc_id, r.n_chars) for r in rows) == given
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    by_id = {r.doc_id: r for r in rows}
    assert by_id[0].fingerprint == by_id[1].fingerprint == by_id[2].fingerprint == ""
    assert by_id[0].near_next == 1.0 and by_id[2].near_next == 0.0 and by_id[6].near_edited == 1.0 - (len("one") // 4 > 0)


def test_one_row_is_its_own_next(spark):
    row = f.compared(spark.createDataFrame([(5, "abcd efgh ijkl")], "doc_id bigint, text string")).first()
    assert row.near_next == 1.0 and row.edited_sha256 == hashlib.sha256(b"abcd efgh iabc").hexdigest()


def test_no_rows(spark, nothing):
    assert f.compared(nothing).collect() == []


def test_no_python_and_no_second_shuffle_of_text(spark, documents):
    plan = f.compared(documents)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan
    assert plan.count("Exchange hashpartitioning(part") == 1

from __future__ import annotations

import zlib

import numpy as np

from opine.llm import language as lang


def test_held_out_accuracy(spark, small):
    documents = spark.read.parquet(f"{small}/documents.parquet")
    model = lang.fit(documents.where(~lang.held_out()))
    assert model.languages == ["de", "en", "es", "fr"]
    rows = lang.predict(documents, model).join(documents.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert len(rows) == documents.count()
    assert sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def plain_grams(text):
    """Buckets of all n-grams by plain Python: code points in 21 bits each, multiplied and shifted."""
    codes = [ord(c) for c in f" {text.lower()} "]
    for order in (1, 2, 3):
        for at in range(len(codes) - order + 1):
            key = 0
            for code in codes[at : at + order]:
                key = (key << 21 | code) % 2**64
            yield ((key + order) * 0x9E3779B97F4A7C15 % 2**64) >> (64 - lang.BUCKET_BITS)


def test_counts_are_those_of_all_rows(spark):
    rows = spark.createDataFrame([("x", "ab"), ("x", "b"), ("y", "ab ab"), (None, "zz")], "lang string, text string").repartition(3)
    found = {(r.lang, r.bucket): r.n for r in lang._count(rows.where("lang IS NOT NULL")).collect()}
    expected: dict = {}
    for name, text in (("x", "ab"), ("x", "b"), ("y", "ab ab")):
        expected[name, 1 << lang.BUCKET_BITS] = expected.get((name, 1 << lang.BUCKET_BITS), 0) + 1
        for bucket in plain_grams(text):
            expected[name, bucket] = expected.get((name, bucket), 0) + 1
    assert found == expected


def test_scores_are_log_joint_probabilities(spark, documents, monkeypatch):
    model = lang.fit(documents)
    texts = ["the and", "x", "y" * 5000, "et le la"]
    whole = lang._scores(texts, model)
    for row, text in zip(whole, texts, strict=True):
        plain = model.log_prior + model.log_probability[list(plain_grams(text))].astype(np.float64).sum(axis=0)
        assert np.allclose(row, plain)
    monkeypatch.setattr(lang, "GATHERED", 10)
    assert np.allclose(lang._scores(texts, model), whole)


def test_odd_rows(spark, documents, odd):
    found = lang.predict(odd, lang.fit(documents)).collect()
    assert len(found) == odd.count()
    for r in found:
        undecided = r.doc_id in (0, 1, 2)
        assert (r.lang_pred == "und") == undecided or r.doc_id is None
        assert r.score == 0 if undecided else 0 <= r.score <= 1
    assert sum(r.doc_id is None for r in found) == 2
    assert lang.fit(odd).languages == ["en"]


def test_nothing_to_learn_or_to_tell(spark, documents, nothing):
    empty = lang.fit(nothing)
    assert empty.languages == []
    assert {r.lang_pred for r in lang.predict(documents, empty).collect()} == {"und"}
    assert lang.predict(nothing, lang.fit(documents)).collect() == []


def test_no_ngram_is_lost_or_added_at_a_cut(monkeypatch):
    text = "ÀÉ Été straße 😀 word " * 9
    for piece in (1, 2, 3, 7, len(text), len(text) + 1, len(text) + 2, 1 << 16):
        monkeypatch.setattr(lang, "PIECE", piece)
        for some in (text, "", "a", text[:5]):
            found = sorted(b for grams in lang._pieces(some) for b in grams.tolist())
            assert found == sorted(plain_grams(some))


def test_any_number_of_languages(spark):
    rows = [(n, f"{chr(0x4E00 + n)}{chr(0x4E00 + n)} {chr(0x4E00 + n)}x", f"l{n:03}") for n in range(700)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(2)
    model = lang.fit(table)
    assert len(model.languages) == 700
    found = {r.doc_id: r.lang_pred for r in lang.predict(table, model).collect()}
    assert sum(found[n] == name for n, _, name in rows) > 690

from __future__ import annotations

import hashlib
import re
from collections import Counter

import pytest

from plain_words import word_list
from opine.llm import decontaminate as d


def brute(documents, items, span=13):
    windows: dict[tuple, set[str]] = {}
    for item, text in items:
        w = word_list(text)
        n = min(span, len(w))
        for s in range(len(w) - n + 1) if n else ():
            windows.setdefault(tuple(w[s : s + n]), set()).add("" if item is None else str(item))
    lengths = {len(k) for k in windows}
    out = []
    for doc_id, text in documents:
        w, hit, named = word_list(text), set(), set()
        for n in lengths:
            for s in range(len(w) - n + 1):
                if (found := windows.get(tuple(w[s : s + n]))) is not None:
                    hit.update(range(s, s + n))
                    named |= found
        sha = hashlib.sha256(",".join(sorted(named)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(named), sha, bool(hit) and 20 * len(hit) >= len(w)))
    return Counter(out)


def compared(spark, documents, items, span=13):
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    found = Counter(map(tuple, d.contamination(documents, benchmark, span).collect()))
    assert found == brute([(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()], items, span)
    return found


def test_given_tables(spark, documents, tiny):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{tiny}/benchmark.parquet").collect()]
    found = compared(spark, documents, items)
    assert any(row[5] for row in found)


def test_odd_rows_and_short_items(spark, odd, monkeypatch):
    texts = {r.doc_id: r.text for r in odd.collect()}
    long = texts[9].split()
    items = [
        (1, "One"),
        (2, "two three"),
        (3, None),
        (4, "..."),
        (None, "a a a a"),
        (5, " ".join(long[40_000:40_030])),
        (5, " ".join(long[10:23])),
        (6, texts[3]),
        (7, "été strasse straße"),
        (7, "x"),
    ]
    compared(spark, odd, items)
    compared(spark, odd, items, span=5)
    monkeypatch.setattr(d, "BROADCAST_ROWS", 0)
    compared(spark, odd, items)


def test_every_alignment_of_a_passage_is_found(spark):
    words = [f"w{n}" for n in range(40)]
    item = " ".join(words[10:23])
    rows = [(n, " ".join(["p"] * n + words[10:23] + ["q"] * (20 - n))) for n in range(20)]
    rows += [(100 + n, " ".join(words[10 : 10 + n])) for n in range(13)]  # a word too few
    found = compared(spark, spark.createDataFrame(rows, "doc_id bigint, text string"), [(1, item)])
    assert sum(1 for row in found if row[2]) == 20


def test_empty_tables(spark, odd, nothing):
    compared(spark, odd, [])
    compared(spark, nothing, [(1, "some words here")])


def test_clean_documents_keep_their_columns(spark, documents, tiny):
    benchmark = spark.read.parquet(f"{tiny}/benchmark.parquet")
    kept = d.clean_documents(documents, benchmark)
    assert kept.columns == documents.columns
    clean = {r.doc_id for r in d.contamination(documents, benchmark).where("NOT contaminated").collect()}
    assert {r.doc_id for r in kept.collect()} == clean


def test_large_benchmarks_are_joined_without_broadcast(spark, documents, tiny, monkeypatch):
    monkeypatch.setattr(d, "BROADCAST_ROWS", 0)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{tiny}/benchmark.parquet").collect()]
    compared(spark, documents, items)


def test_only_prints_are_shuffled_for_large_benchmarks(spark, documents, tiny, monkeypatch):
    monkeypatch.setattr(d, "BROADCAST_ROWS", 0)
    plans, stage = {}, d.stage

    def recorded(df, purpose):
        plans[purpose] = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
        return stage(df, purpose)

    monkeypatch.setattr(d, "stage", recorded)
    d.contamination(documents, spark.read.parquet(f"{tiny}/benchmark.parquet"))
    moved = re.findall(r"Exchange\nInput \[\d+\]: \[(.*)\]", plans["held-prints"])
    assert moved and not any("words" in columns or "text" in columns for columns in moved)
    assert "Exchange" not in plans["rows"]


def test_no_python_on_the_main_path(spark, documents, tiny):
    plan = d.contamination(documents, spark.read.parquet(f"{tiny}/benchmark.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_span_must_fit(spark, documents):
    with pytest.raises(ValueError):
        d.contamination(documents, documents, span=16)

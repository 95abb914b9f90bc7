from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from opine.llm import lexical
from opine.llm.queries import REGISTRY

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: str | None) -> list[str]:
    return [w.translate(LOWER) for w in WORD.findall(text or "")]


def by_hand(documents: list[tuple], items: list[tuple], k: int = 20) -> list[tuple]:
    """Score every document for every item."""
    held = [(doc_id, Counter(listed := words(text)), len(listed)) for doc_id, text in documents]
    n_docs, n_terms = sum(n > 0 for _, _, n in held), sum(n for _, _, n in held)
    df = Counter(word for _, counts, _ in held for word in counts)
    found = []
    for item_id, text in items:
        scored = []
        for doc_id, counts, n in held:
            m = 75 + (25 * n * n_docs) // max(n_terms, 1)
            score = 0
            for word in words(text):
                if counts[word]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[word] + 1)))
                    score += w * (1_000_000_000 * counts[word] // (1000 * counts[word] + 12 * m))
            if score > 0:
                scored.append((-score, doc_id is not None, doc_id or 0))
        found += [(item_id, rank, (d if known else None), -s) for rank, (s, known, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(found, key=str)


def by_spark(documents, items, **settings) -> list[tuple]:
    return sorted((tuple(r) for r in lexical.ranked(documents, items, **settings).collect()), key=str)


def made(spark, documents: list[tuple], items: list[tuple]):
    return spark.createDataFrame(documents, "doc_id bigint, text string").repartition(4), spark.createDataFrame(items, "item_id bigint, text string")


def zipf(pick: random.Random, size: int, vocabulary: int = 300) -> str:
    return " ".join(f"w{int(vocabulary ** pick.random())}" for _ in range(size))


def test_equals_scoring_everything(spark):
    pick = random.Random(4)
    documents = [(n, zipf(pick, pick.randint(0, 60))) for n in range(1500)]
    items = [(n, zipf(pick, pick.randint(1, 25))) for n in range(30)]
    found = by_spark(*made(spark, documents, items))
    assert found == by_hand(documents, items)


@pytest.mark.parametrize("settings", [{"k": 1}, {"block_terms": 40, "block_postings": 50}, {"k": 3, "block_postings": 1}])
def test_blocks_change_nothing(spark, settings):
    pick = random.Random(5)
    documents = [(n, zipf(pick, pick.randint(0, 30), 60)) for n in range(300)] + [(n, "w1 w2 w2 w3") for n in range(1000, 1100)]
    items = [(n, zipf(pick, 8, 60)) for n in range(12)] + [(50, "w2 w2 w3")]
    assert by_spark(*made(spark, documents, items), **settings) == by_hand(documents, items, settings.get("k", 20))


def test_odd_rows(spark, odd):
    documents = [(r.doc_id, r.text) for r in odd.collect()]
    documents += [(None, "one"), (None, "one two"), (7, "ONE Two"), (7, "ONE Two"), (99, "ſtraße STRASSE straße")]
    items = [(1, "one two three"), (1, "one two three"), (None, "two"), (2, ""), (3, None), (4, "...!"), (5, "nowhere"), (6, "STRASSE straße été ÉTÉ"), (7, "one " * 50)]
    found = by_spark(*made(spark, documents, items))
    assert found == by_hand(documents, items)


def test_ties_go_by_id(spark):
    documents = [(n, "same words here") for n in range(500, 0, -1)] + [(-n, "other text") for n in range(600)]
    found = by_spark(*made(spark, documents, [(1, "same words here")]))
    assert sorted(r[2] for r in found) == list(range(1, 21))


def test_empty_tables_and_clashing_columns(spark, nothing):
    documents, items = made(spark, [(1, "a b"), (2, "b c"), (3, "d")], [(1, "a"), (2, "b c")])
    no_items = items.limit(0)
    assert by_spark(documents, no_items) == [] and by_spark(nothing.select("doc_id", "text"), items) == []
    wide = documents.withColumns({c: F.lit(1) for c in ("item", "n", "terms", "tfs", "score", "rank", "item_id")})
    wider = items.withColumns({c: F.lit(1) for c in ("item", "listed", "block", "doc_id", "score")})
    assert by_spark(wide, wider) == by_spark(documents, items) != []


def _postings(documents: list[list[int]], n_terms: int) -> tuple[lexical.Postings, list[int]]:
    counts = [Counter(d) for d in documents]
    df = Counter(t for c in counts for t in c)
    corpus = lexical.Corpus(len(documents), sum(map(len, documents)))
    weights = np.array([corpus.weight(df[t]) if df[t] else 0 for t in range(n_terms)])
    batch = pa.record_batch(
        [
            pa.array(range(len(documents)), pa.int64()),
            pa.array([len(d) for d in documents], pa.int64()),
            pa.array([list(c.keys()) for c in counts], pa.list_(pa.int32())),
            pa.array([list(c.values()) for c in counts], pa.list_(pa.int32())),
        ],
        names=["doc_id", "n", "terms", "tfs"],
    )
    return lexical.Postings([batch], weights, corpus), [df[t] for t in range(n_terms)]


def test_accumulators_are_limited_and_survivors_exact():
    """With rare terms that settle the result, documents that hold common terms only never get an accumulator."""
    pick = random.Random(6)
    documents = [[pick.randint(0, 5) for _ in range(20)] + ([6, 7, 8] if n % 50 == 0 else []) for n in range(5000)]
    postings, df = _postings(documents, 9)
    order = sorted(range(9), key=lambda t: (df[t], t))
    item = lexical.Item(0, order, [1] * 9)
    rows, scores, accumulators = lexical.search(postings, item, 20, 0)
    assert accumulators == 100
    every = np.zeros(5000, np.int64)
    for term in order:
        at, added = postings.of(term)
        every[at] += added
    assert (scores == every[rows]).all()
    assert sorted(every)[-20:] == sorted(scores)[-20:]
    # A score that is known from before ends it sooner still.
    assert lexical.search(postings, item, 20, int(every.max()) + 10**9)[2] == 0


def test_query_on_whole_tables(spark, tiny):
    documents = [(r.doc_id, r.text) for r in spark.read.parquet(f"{tiny}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{tiny}/benchmark.parquet").collect()]
    found = sorted((tuple(r) for r in REGISTRY["op11_lexical_search"](spark, tiny).collect()), key=str)
    assert found == by_hand(documents, items)

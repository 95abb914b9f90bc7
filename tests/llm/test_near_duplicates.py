from __future__ import annotations

import random
import time
from collections import Counter, defaultdict

import numpy as np
import pytest

from opine.llm import near_duplicates as nd
from plain_words import word_list


def shingle_set(text):
    w = word_list(text)
    k = min(5, len(w))
    return {tuple(w[s : s + k]) for s in range(len(w) - k + 1)} if w else set()


def brute_classes(rows, similarity=0.8):
    """Groups of row numbers: equal texts, and texts whose shingle sets are alike."""
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    first: dict = {}
    for n, (_, text) in enumerate(rows):
        parent[find(n)] = find(first.setdefault(text or "", n))
    shingles = {n: shingle_set(rows[n][1]) for n in first.values()}
    holders = defaultdict(list)
    for n, listed in shingles.items():
        for s in listed:
            holders[s].append(n)
    shared = Counter((a, b) for listed in holders.values() for i, a in enumerate(listed) for b in listed[i + 1 :])
    for (a, b), c in shared.items():
        if c / (len(shingles[a]) + len(shingles[b]) - c) >= similarity:
            parent[find(a)] = find(b)
    groups = defaultdict(set)
    for n in range(len(rows)):
        groups[find(n)].add(n)
    return {frozenset(g) for g in groups.values()}


def by_id(documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    return {frozenset(rows[n][0] for n in g) for g in brute_classes(rows)}


def found_classes(documents):
    groups = defaultdict(set)
    for r in nd.classes(documents).collect():
        groups[r.class_id].add(r.doc_id)
    return {frozenset(g) for g in groups.values()}


def test_given_table(spark, small):
    documents = spark.read.parquet(f"{small}/documents.parquet")
    assert found_classes(documents) == by_id(documents)


def edited_copies(count, edits, seed=5):
    pick = random.Random(seed)
    vocabulary = [f"w{n}" for n in range(3000)]
    base = pick.choices(vocabulary, k=300)
    texts = []
    for _ in range(count):
        words = list(base)
        for at in pick.sample(range(300), edits):
            words[at] = pick.choice(vocabulary)
        texts.append(" ".join(words))
    return texts


@pytest.mark.parametrize("edits", [1, 3, 5])
def test_a_large_group_of_near_copies(spark, edits):
    """With 3 edits each, two copies are about as alike as the threshold: many links exist, many do not."""
    rows = list(enumerate(edited_copies(150, edits)))
    documents = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert found_classes(documents) == by_id(documents)


def test_broadcast_is_not_needed(spark, documents, monkeypatch):
    monkeypatch.setattr(nd, "BROADCAST_ROWS", 0)
    assert found_classes(documents) == by_id(documents)


def test_odd_rows(spark, odd):
    rows = nd.classes(odd).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in odd.collect())
    ids = {r.doc_id: r.class_id for r in rows if r.doc_id is not None}
    assert ids[0] == ids[1] == 0 and ids[2] == 2 and ids[3] == ids[4] == 3
    assert {r.class_id for r in rows if r.doc_id is None} == {0, 3}
    for class_id in set(ids.values()):
        kept = {(r.doc_id, bytes(r.node)) for r in rows if r.class_id == class_id and r.kept}
        assert len(kept) == 1


def test_deduplicated_keeps_one_row_and_all_columns(spark, odd, small):
    kept = nd.deduplicated(odd)
    assert kept.columns == odd.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, [0, 2, 3, 5, 6, 7, 8, 9, 10, -5, 2**53 + 1, 11]))
    documents = spark.read.parquet(f"{small}/documents.parquet")
    expected = {min(g) for g in by_id(documents)}
    assert sorted(r.doc_id for r in nd.deduplicated(documents).collect()) == sorted(expected)


def test_no_rows(nothing):
    assert nd.classes(nothing).collect() == []
    assert nd.deduplicated(nothing).collect() == []


def test_components(spark):
    edges = [(a, a + 1) for a in range(0, 30)] + [(100, n) for n in range(101, 160)] + [(200, 201), (201, 200), (300, 300)]
    mixed = lambda n: (n * 7919) % 10007
    table = spark.createDataFrame([(mixed(a), mixed(b)) for a, b in edges], "a bigint, b bigint")
    groups = defaultdict(set)
    for r in nd.components(table).collect():
        groups[r.component].add(r.node)
    assert {frozenset(g) for g in groups.values()} == {
        frozenset(map(mixed, range(31))),
        frozenset(map(mixed, range(100, 160))),
        frozenset(map(mixed, (200, 201))),
    }
    assert all(k == min(g) for k, g in groups.items())


def longest_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for n, y in enumerate(b):
            last, row[n + 1] = row[n + 1], last + 1 if x == y else max(row[n + 1], row[n])
    return row[-1]


def test_alignment_equals_the_full_table():
    pick = random.Random(1)
    for _ in range(400):
        a = [pick.randrange(4) for _ in range(pick.randrange(0, 25))]
        b = list(a)
        for _ in range(pick.randrange(0, 8)):
            at = pick.randrange(0, len(b) + 1)
            b[at : at + pick.randrange(0, 2)] = [pick.randrange(4)] * pick.randrange(0, 2)
        matched = 2 * longest_common(a, b) / max(1, len(a) + len(b))
        if a or b:
            assert nd.aligned(np.array(a, int), np.array(b, int)) == (matched >= 0.8 - 1e-12), (a, b)


@pytest.mark.parametrize("block", [1, 3, 64])
def test_alignment_in_blocks_of_columns(block, monkeypatch):
    monkeypatch.setattr(nd, "BLOCK_BITS", block)
    test_alignment_equals_the_full_table()


def test_alignment_of_very_long_texts():
    pick = np.random.default_rng(3)
    a = pick.integers(0, 20_000, 60_000)
    began = time.monotonic()
    assert not nd.aligned(a, np.r_[a[30_000:], a[:30_000]])
    edited = a.copy()
    edited[::8] = -1
    assert nd.aligned(a, edited)
    edited[1::8] = -1
    assert not nd.aligned(a, edited)
    assert time.monotonic() - began < 20


def test_no_link_of_short_texts_is_missed(spark):
    """All ways to differ in one word of texts of 5 to 13 words whose shingle sets are alike."""
    pick = random.Random(11)
    rows = []
    for n in range(1200):
        base = [f"t{n}w{k}" for k in range(5 + n % 9)]
        other = base[:-1] if n % 3 == 0 else base + ["more"] if n % 3 == 1 else base[:-1] + ["else"]
        rows += [(2 * n, " ".join(base)), (2 * n + 1, " ".join(other))]
    rows += [(10_000 + n, " ".join(["la"] * n)) for n in range(5, 40)]
    pick.shuffle(rows)
    documents = spark.createDataFrame(rows, "doc_id bigint, text string")
    classes = by_id(documents)
    # Equal sets of shingles whose words cannot be aligned are no links.
    expected = {g for g in classes if min(g) < 10_000}
    assert sum(len(g) > 1 for g in expected) > 400
    assert {g for g in found_classes(documents) if min(g) < 10_000} == expected


def test_strays_of_a_bucket_meet_all_others(spark, monkeypatch):
    monkeypatch.setattr(nd, "SALT_ROWS", 3)
    rows = [(b, n, 0 if n < 8 else n, 0.0, 0.0, 10, [0] * 32) for b in (1, 2) for n in range(12)]
    schema = "bucket int, node int, component int, far_low double, far_central double, n_shingles bigint, odd array<bigint>"
    pairs = {(r.a, r.b) for r in nd._open_pairs(spark.createDataFrame(rows, schema)).collect()}
    assert pairs == {(a, b) for a in range(12) for b in range(max(8, a + 1), 12)}


def test_moved_blocks_are_told_from_edits():
    a = np.arange(300)
    moved = np.r_[a[150:], a[:150]]
    assert nd.jaccard(a, moved) > 0.9 and not nd.aligned(a, moved)


def test_sketches_keep_the_order_of_the_text():
    a = np.arange(400)
    same = (nd.sketch(a) == nd.sketch(a.copy())).mean()
    turned = (nd.sketch(a) == nd.sketch(np.r_[a[200:], a[:200]])).mean()
    assert same == 1.0 and turned < 0.5
    assert len(nd.sketch(np.empty(0, int))) == 0 and len(nd.sketch(np.array([1, 2]))) == nd.SKETCHES


@pytest.mark.parametrize("length, edits", [(50, 1), (100, 2), (300, 6)])
def test_sketches_agree_as_independent_ones_would(length, edits):
    """Texts too long for their whole sets to be looked up, with edits far apart, at a similarity just above 0.8."""
    pick = np.random.default_rng(length)
    agreed = []
    for _ in range(600):
        a = pick.integers(-(2**31), 2**31, length)
        b = a.copy()
        for k in range(edits):
            b[(2 * k + 1) * length // (2 * edits)] += 1
        assert 0.8 <= nd.jaccard(a, b) < 0.82 and nd.aligned(a, b)
        agreed.append(int((nd.sketch(a) == nd.sketch(b)).sum()))
    chance = np.mean(agreed) / nd.SKETCHES
    assert 0.38 < chance < 0.47 and min(agreed) > 0
    # Were sketches alike in what they choose, their sum would vary more.
    assert np.var(agreed) < 1.3 * nd.SKETCHES * chance * (1 - chance)

from __future__ import annotations

import math
from collections import Counter, defaultdict

import pytest

from opine.llm import mixing as m


def n_tokens(text):
    return max(1, len((text or "").split(" ")) if text and text.strip() else 1)


def sizes_of(rows):
    sizes: Counter = Counter()
    for r in rows:
        sizes[r.source or ""] += r.tokens
    return sizes


def brute_exponent(sizes, goal):
    """By a fine scan instead of bisection."""
    total = sum(sizes.values())
    shares = [s / total for s in sizes.values()]

    def weights(a):
        z = sum(p**a for p in shares)
        return [p**a / z for p in shares]

    def fits(a):
        w = weights(a)
        entropy = -sum(x * math.log(x) for x in w)
        return goal.entropy is None or entropy >= goal.entropy * math.log(len(w))

    def repeats(a):
        uses = [x / p for x, p in zip(weights(a), shares, strict=True)]
        return max(uses) / min(uses) if goal.budget is None else max(uses) * goal.budget / total

    found = max((k / 2000 for k in range(2001) if fits(k / 2000)), default=0.0)
    if goal.repetition is not None and repeats(found) > goal.repetition:
        found = next((k / 2000 for k in range(2001) if repeats(k / 2000) <= goal.repetition), 1.0)
    return found, dict(zip(sizes, weights(found), strict=True))


@pytest.fixture(scope="module")
def uneven(spark, small):
    """Sources of very different sizes; src0 holds most."""
    documents = spark.read.parquet(f"{small}/documents.parquet")
    return documents.selectExpr("doc_id", "text", "IF(doc_id % 10 < 7, 'src0', CONCAT('s', length(source) + doc_id % 3)) AS source", "lang")


@pytest.mark.parametrize(
    "goal",
    [m.Goal(entropy=0.95), m.Goal(repetition=2.0), m.Goal(entropy=0.999, repetition=3.0), m.Goal(entropy=0.9, budget=200_000), m.Goal()],
)
def test_weights_and_budgets(spark, uneven, goal):
    sized = uneven.select("source", m.tokens().alias("tokens")).collect()
    sizes = sizes_of(sized)
    _, weights = brute_exponent(sizes, goal)
    largest = max(r.tokens for r in sized)
    used, passes = Counter(), defaultdict(set)
    rows = m.mixed(uneven, goal).collect()
    for r in rows:
        used[r.source] += r["__tokens"]
        assert (r.doc_id, r.source) not in passes[r["__pass"]]  # a pass is a permutation
        passes[r["__pass"]].add((r.doc_id, r.source))
        assert abs(r["__weight"] - weights[r.source]) < 0.005
        assert 0 <= r["__slot"] <= 1
    budget = goal.budget or max(sizes[s] / rows_weight for s, rows_weight in {r.source: r["__weight"] for r in rows}.items())
    for source, weight in {r.source: r["__weight"] for r in rows}.items():
        assert weight * budget - largest - 1 <= used[source] <= weight * budget + 1
    if goal.budget is None:
        assert {r.doc_id for r in rows} == {r.doc_id for r in uneven.collect()}
        assert goal.repetition is None or max(Counter(r.doc_id for r in rows).values()) <= math.ceil(goal.repetition)


def test_order_gives_each_source_its_share(spark, uneven):
    rows = sorted(m.mixed(uneven, m.Goal(repetition=2.0)).collect(), key=lambda r: r["__slot"])
    half, total = Counter(), Counter()
    for n, r in enumerate(rows):
        total[r.source] += r["__tokens"]
        half[r.source] += r["__tokens"] * (n < len(rows) // 2)
    assert 0.3 < half["src0"] / total["src0"] < 0.7


def test_blocks_end_where_the_budget_does(spark, uneven, monkeypatch):
    monkeypatch.setattr(m, "BLOCK_TOKENS", 500)
    goal = m.Goal(entropy=0.9, budget=150_000)
    rows = m.mixed(uneven, goal).collect()
    ends = defaultdict(set)
    for r in rows:
        ends[r.source].add(r["__block"])
    for source, blocks in ends.items():
        assert len(blocks) >= max(blocks) * 0.5, source  # blocks are used from the first on


def test_odd_rows(spark, odd):
    rows = m.mixture(odd, m.Goal(repetition=3.0))
    assert rows.columns == odd.columns
    counts = Counter(str(r.doc_id) for r in rows.collect())
    assert set(counts) == {str(r.doc_id) for r in odd.collect()}


def test_repeated_rows_keep_their_share(spark):
    """2,000 equal rows of three tokens beside another source: as many are used as the budget holds."""
    rows = spark.range(0, 2000, 1, 7).selectExpr("1L AS doc_id", "'one two three' AS text", "'same' AS source")
    rows = rows.union(spark.range(300).selectExpr("id + 10", "concat('other text number ', id)", "'b'"))
    for budget in (3_000, 20_000):
        used = m.mixed(rows, m.Goal(entropy=0.9, budget=budget)).groupBy("source", "__weight").sum("__tokens").collect()
        for source, weight, held in used:
            assert weight * budget - 5 < held <= weight * budget + 1, (source, budget)
        assert {r.source for r in used} == {"same", "b"}


def test_one_source_and_no_rows(spark, nothing, odd):
    assert m.mixture(nothing).collect() == []
    one = odd.selectExpr("doc_id", "text", "'only' AS source")
    assert m.mixture(one).count() == one.count()


def test_sources_are_joined_without_broadcast(spark, uneven, monkeypatch):
    whole = sorted((r.doc_id, r["__pass"]) for r in m.mixed(uneven).collect())
    monkeypatch.setattr(m, "BROADCAST_SOURCES", 0)
    assert sorted((r.doc_id, r["__pass"]) for r in m.mixed(uneven).collect()) == whole


def test_no_python_on_the_main_path(spark, uneven):
    plan = m.mixed(uneven)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan

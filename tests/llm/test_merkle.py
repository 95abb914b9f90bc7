from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from opine.llm import merkle

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row: tuple) -> str:
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def tree(leaves: list[str]) -> tuple[str, list[list[str]]]:
    """The last node, and for each leaf its runs' others."""
    proofs, at, level = [[] for _ in leaves], list(range(len(leaves))), leaves
    while len(level) > 1:
        for n, place in enumerate(at):
            start = place - place % 3
            proofs[n].append([(k < place, level[k]) for k in range(start, min(start + 3, len(level))) if k != place])
        level = [h(*level[k : k + 3]) for k in range(0, len(level), 3)]
        at = [place // 3 for place in at]
    return level[0], proofs


def by_hand(rows: list[tuple]) -> list[tuple]:
    sources = defaultdict(list)
    for row in rows:
        sources[row[1]].append(row)
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    for listed in sources.values():
        listed.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = {s: tree([leaf(r) for r in sources[s]]) for s in order}
    root, upper = tree([trees[s][0] for s in order])
    found = []
    for number, s in enumerate(order):
        subroot, proofs = trees[s]
        for row, proof in zip(sources[s], proofs, strict=True):
            now = row
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 and row[4] is not None:
                now = (*row[:4], row[4].replace("\n", ""))
            folded, path = leaf(now), proof + upper[number]
            for level in path:
                folded = h(*[x for before, x in level if before], folded, *[x for before, x in level if not before])
            flat = h(*[x for level in path for _, x in level])
            found.append((row[0], leaf(row), subroot, root, flat, folded, folded == root))
    return sorted(found, key=str)


def by_spark(documents, **settings) -> list[tuple]:
    fields = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in merkle.verified(documents, **settings).select(*fields).collect()), key=str)


@pytest.mark.parametrize("sizes", [(1,), (2200,), (4, 1), (1, 2, 3, 4, 728, 729, 730, 731, 9, 27)])
def test_sizes_around_pages(spark, sizes):
    pick = random.Random(1)
    rows = [(10 * n + k, f"s{k}", "en", 5, pick.choice(["a\nb", "plain", "\n"])) for k, size in enumerate(sizes) for n in range(size)]
    assert by_spark(spark.createDataFrame(rows, SCHEMA).repartition(4)) == by_hand(rows)


def test_more_sources_than_a_page(spark):
    rows = [(n, f"source {n % 800}", None, n, f"line {n}\n") for n in range(1700)]
    assert by_spark(spark.createDataFrame(rows, SCHEMA)) == by_hand(rows)


def test_odd_rows(spark, odd):
    rows = [tuple(r) for r in odd.select(*COLUMNS).collect()]
    rows += [(20, "s1", None, None, None), (20, "s1", None, None, ""), (21, "\U0001f600", "é", -1, "\n\n"), (22, "￿", "", 0, "é\n"), (23, "", "", 0, "x")]
    assert by_spark(spark.createDataFrame(rows, SCHEMA).repartition(3)) == by_hand(rows)


def test_small_shares_and_few_broadcasts_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(merkle, "BROADCAST_RUNS", 0)
    rows = [(n, f"s{n % 7 % 3}", "en", 1, "a\nb" * (n % 5)) for n in range(1500)]
    assert by_spark(spark.createDataFrame(rows, SCHEMA).repartition(6), lanes=3) == by_hand(rows)


def test_empty_table_and_clashing_columns(spark, nothing):
    assert by_spark(nothing) == []
    rows = [(n, "s", "en", 1, f"{n}\n") for n in range(10)]
    extra = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ("nth", "of", "tree", "leaf", "found", "__at", "levels")})
    assert by_spark(extra) == by_hand(rows)


def test_every_change_is_found_and_nothing_else(spark, documents):
    rows = merkle.verified(documents).collect()
    texts = {r.doc_id: r.text for r in documents.collect()}
    assert len(rows) == len(texts)
    for row in rows:
        changed = zlib.crc32(str(row.doc_id).encode()) % 2 == 0 and "\n" in (texts[row.doc_id] or "")
        assert row.verified == (not changed)


def test_row_limit_is_put_back(spark, documents):
    spark.conf.set(merkle.ROW_LIMIT, "77")
    try:
        merkle.verified(documents)
        assert spark.conf.get(merkle.ROW_LIMIT) == "77"
    finally:
        spark.conf.unset(merkle.ROW_LIMIT)


def test_no_row_holds_more_than_a_page(spark, documents):
    copies = documents.select(*COLUMNS).crossJoin(spark.range(5)).drop("id").withColumn("source", F.lit("one"))
    _, nodes = merkle.manifest(copies)
    assert nodes.agg(F.max(F.size(F.get("levels", F.lit(0))))).first()[0] <= merkle.PAGE
    first = nodes.where((F.col("tree") == 1) & (F.col("tier") == 0)).count()
    assert first == -(-copies.count() // merkle.PAGE)

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pytest

import __spark_entry__
import corpus_pipeline
from opine.llm.queries import REGISTRY, vocabulary_path
from test_decontaminate import brute
from test_near_duplicates import by_id


@pytest.fixture(scope="module")
def steps(spark, small, tmp_path_factory):
    """What goes into and comes out of each stage."""
    folder, docs, found = tmp_path_factory.mktemp("steps"), spark.read.parquet(f"{small}/documents.parquet"), {}
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(folder / str(n))
        stage(spark, docs, small).write.parquet(path)
        found[name] = (docs, spark.read.parquet(path))
        docs = found[name][1]
    return found


def ids(table):
    return sorted(r.doc_id for r in table.select("doc_id").collect())


def test_columns(steps):
    *first, (last_in, _) = steps.values()
    for before, after in first:
        assert after.columns == before.columns == last_in.columns


def test_quality(spark, steps, small):
    before, after = steps["quality classifier"]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    kept = set(ids(after))
    good = [d for d in ids(before) if labels.get(d) == 1]
    bad = [d for d in ids(before) if labels.get(d) == 0]
    assert sum(d in kept for d in good) >= 0.97 * len(good)
    assert sum(d in kept for d in bad) <= 0.1 * len(bad)


def test_near_duplicates(steps):
    before, after = steps["near duplicates"]
    assert ids(after) == sorted(min(g) for g in by_id(before))


def test_decontamination(spark, steps, small):
    before, after = steps["decontamination"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    verdicts = brute([(r.doc_id, r.text) for r in before.collect()], items)
    assert ids(after) == sorted(row[0] for row in verdicts if not row[5])


def test_mixing_keeps_every_document(steps):
    before, after = steps["mixing"]
    assert set(ids(before)) == set(ids(after))


def test_token_files(steps):
    from tokenizers import Tokenizer

    before, after = steps["token files"]
    tokenizer, start = Tokenizer.from_file(vocabulary_path()), 0
    texts = sorted((r.doc_id, r.text) for r in before.collect())
    for row, (doc_id, text) in zip(sorted(after.collect(), key=lambda r: r.start), texts, strict=True):
        encoded = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 1], dtype="<u4")
        assert tuple(row) == (doc_id, start, len(encoded), zlib.crc32(encoded.tobytes()))
        start += len(encoded)


def test_run_equals_the_stages(spark, steps, tiny, small):
    assert corpus_pipeline.run(spark, small).count() == steps["token files"][1].count()


def test_everything_is_registered():
    names = set(__spark_entry__.queries())
    assert set(REGISTRY) | {"pipeline"} <= names
    assert sorted(int(n[2:].split("_")[0]) for n in REGISTRY) == list(range(1, 14))


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES[:-1])
def test_stages_keep_columns_and_take_odd_rows(spark, odd, nothing, small, name, stage):
    """Nulls, empty and very long texts, repeated rows, clashing names; every row that stays is one that came in."""
    table = odd.selectExpr("*", "0.25D AS score", "7 AS __part")
    found = stage(spark, table, small)
    assert found.columns == table.columns
    rows, given = Counter(map(str, found.collect())), Counter(map(str, table.collect()))
    assert set(rows) <= set(given)
    if name == "mixing":
        assert set(rows) == set(given)
    else:
        assert not rows - given
    empty = stage(spark, nothing, small)
    assert empty.columns == nothing.columns and empty.collect() == []


def test_odd_rows_through_the_last_stage(spark, odd, nothing, small):
    assert corpus_pipeline.to_token_files(spark, odd, small).count() == odd.count()
    assert corpus_pipeline.to_token_files(spark, nothing, small).collect() == []


def test_few_contaminated_texts_are_broadcast(spark, small):
    kept = corpus_pipeline.drop_contaminated(spark, spark.read.parquet(f"{small}/documents.parquet"), small)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan

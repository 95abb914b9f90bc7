"""Ranked lexical search, term at a time with limited accumulators.

Documents are read once for each block of query items: what the items' terms occur in is written as rows of one
document each (its length, its query terms and how often they occur). Counts over all documents give the weights.

Each task then inverts its own documents, some millions of postings at a time, and ranks every item over them. An
item's terms are taken rarest first, and a document gets an accumulator when it first meets one of them. Before each
term, the largest scores that the terms still to come can add in these documents are summed: once that sum lies below
the kth partial score, or below the kth score of documents ranked before, no new document can enter the result, and no
more accumulators are made. Those that can still reach the kth score are then updated exactly, by looking them up in
the postings of the other terms. Documents of equal score are told apart by their id, so only sums strictly below the
kth score end the making of accumulators; what is left out could never have been returned.

A task gives at most k documents for each item, and the best k of all tasks are the result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opine.llm.common import UPPER, words
from opine.session import stage

TOP = 20
# Words of query items that one block holds (and the driver at once), and postings that a task inverts at once.
BLOCK_TERMS, BLOCK_POSTINGS = 1_000_000, 4_000_000
# Texts that are taken apart at once.
TEXTS = 500

# Bytes of a word stay, A-Z in lower case; all others become blanks. Bytes of non-ASCII characters are word bytes.
_WORD_BYTES = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))
_TABLE = _WORD_BYTES.translate(bytes.maketrans(UPPER.encode(), UPPER.lower().encode()))


def terms(text: bytes | None) -> list[bytes]:
    return text.translate(_TABLE).split() if text else []


# --- occurrences -------------------------------------------------------------------------------

HELD = "doc_id bigint, n bigint, terms array<int>, tfs array<int>"


def occurrences(documents: DataFrame, vocabulary: list[str]) -> DataFrame:
    """doc_id, n (terms with repeats), terms (numbers of the vocabulary's words), tfs; a row for each document."""
    numbers = {word.encode(): n for n, word in enumerate(vocabulary)}
    wanted = numbers.keys()

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                n, found, tfs, ends = [], [], [], [0]
                for text in part.column(1).to_pylist():
                    counts = Counter(listed := terms(text))
                    here = counts.keys() & wanted
                    n.append(len(listed))
                    found += [numbers[word] for word in here]
                    tfs += [counts[word] for word in here]
                    ends.append(len(found))
                offsets = pa.array(ends, pa.int32())
                lists = [pa.ListArray.from_arrays(offsets, pa.array(values, pa.int32())) for values in (found, tfs)]
                yield pa.record_batch([part.column(0), pa.array(n, pa.int64()), *lists], names=["doc_id", "n", "terms", "tfs"])

    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return texts.mapInArrow(held, HELD)


# --- ranking within a task ------------------------------------------------------------------------


class Corpus(NamedTuple):
    """What weights and scores need of all documents."""

    documents: int
    terms: int

    def weight(self, df: int) -> int:
        return math.floor(1000 * math.log(float(2 * self.documents + 2) / float(2 * df + 1)))


class Item(NamedTuple):
    """A query item: its number, and its terms, rarest first, with how often each occurs in it."""

    number: int
    terms: list[int]
    times: list[int]


class Postings:
    """The inverted lists of a block of documents: for each term the rows that hold it and what it adds to a score."""

    def __init__(self, batches: list[pa.RecordBatch], weights: np.ndarray, corpus: Corpus):
        table = pa.Table.from_batches(batches).combine_chunks()
        ids = table.column("doc_id").combine_chunks()
        self.known = np.asarray(ids.is_valid())
        self.doc_ids = np.asarray(ids.fill_null(0))
        self.rows = len(ids)
        lists, tfs = (table.column(name).combine_chunks() for name in ("terms", "tfs"))
        row = np.repeat(np.arange(self.rows, dtype=np.int32), np.asarray(lists.value_lengths()))
        term, tf = np.asarray(lists.flatten()), np.asarray(tfs.flatten()).astype(np.int64)
        length = 75 + 25 * np.asarray(table.column("n")) * corpus.documents // max(corpus.terms, 1)
        added = weights[term] * (1_000_000_000 * tf // (1000 * tf + 12 * length[row]))
        order = np.argsort(term, kind="stable")
        self.row, self.added = row[order], added[order]
        self.starts = np.searchsorted(term[order], np.arange(len(weights) + 1))
        self.most = np.zeros(len(weights), np.int64)
        filled = np.flatnonzero(np.diff(self.starts))
        if len(filled):
            self.most[filled] = np.maximum.reduceat(self.added, self.starts[filled])

    def of(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        here = slice(self.starts[term], self.starts[term + 1])
        return self.row[here], self.added[here]


def search(postings: Postings, item: Item, k: int, kth: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Rows that may be among the best k, their exact scores, and how many accumulators were made.

    `kth` is a score that k documents are known to have (0: none known).
    """
    bounds = postings.most[item.terms] * np.array(item.times, np.int64)
    left = np.concatenate([np.cumsum(bounds[::-1])[::-1], [0]])
    scores = np.zeros(postings.rows, np.int64)
    done = 0
    for done, (term, times) in enumerate(zip(item.terms, item.times, strict=True)):
        if left[done] < kth:
            break
        rows, added = postings.of(term)
        scores[rows] += times * added
        # No partial score is above the sum of the bounds so far: only then is the kth worth looking for.
        if postings.rows >= k and left[0] - left[done + 1] > left[done + 1]:
            kth = max(kth, int(np.partition(scores, postings.rows - k)[postings.rows - k]))
    else:
        done = len(item.terms)
    made = np.flatnonzero(scores)
    alive = made[scores[made] + left[done] >= kth]
    exact = scores[alive]
    for term, times in zip(item.terms[done:], item.times[done:], strict=True):
        rows, added = postings.of(term)
        if len(rows):
            at = np.minimum(np.searchsorted(rows, alive), len(rows) - 1)
            exact += np.where(rows[at] == alive, times * added[at], 0)
    return alive, exact, len(made)


def _best(found: list[tuple[np.ndarray, np.ndarray, np.ndarray]], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The best k of (id known, id, score), highest score first, then null ids, then by id."""
    known, ids, scores = (np.concatenate(parts) for parts in zip(*found, strict=True))
    order = np.lexsort((ids, known, -scores))[:k]
    return known[order], ids[order], scores[order]


RANKED = "item bigint, doc_id bigint, score bigint"


def best_in_tasks(held: DataFrame, items: list[Item], weights: list[int], corpus: Corpus, k: int, block_postings: int) -> DataFrame:
    """item, doc_id, score: the best k documents of each task for each item."""

    def ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [[(np.zeros(0, bool), np.zeros(0, np.int64), np.zeros(0, np.int64))] for _ in items]
        weight = np.array(weights, np.int64)

        def take(waiting: list[pa.RecordBatch]) -> None:
            postings = Postings(waiting, weight, corpus)
            for at, item in enumerate(items):
                before = best[at][0][2]
                kth = int(before[-1]) if len(before) == k else 0
                rows, scores, _ = search(postings, item, k, kth)
                rows, scores = rows[scores > 0], scores[scores > 0]
                if len(rows):
                    best[at] = [_best([*best[at], (postings.known[rows], postings.doc_ids[rows], scores)], k)]

        waiting, size = [], 0
        for batch in batches:
            waiting.append(batch)
            size += len(batch.column(2).flatten())
            if size >= block_postings:
                take(waiting)
                waiting, size = [], 0
        if waiting:
            take(waiting)
        for item, ((known, ids, scores),) in zip(items, best, strict=True):
            if len(ids):
                yield pa.record_batch(
                    [pa.array(np.full(len(ids), item.number)), pa.array(ids, mask=~known), pa.array(scores)], names=["item", "doc_id", "score"]
                )

    return held.mapInArrow(ranked, RANKED)


# --- over documents -----------------------------------------------------------------------------


def _block(documents: DataFrame, numbered: DataFrame, k: int, block_postings: int) -> DataFrame:
    """item, doc_id, score of the candidates of one block of items; their words come to the driver, BLOCK_TERMS or so."""
    listed = numbered.select("item", "listed").collect()
    vocabulary = sorted({word for row in listed for word in row.listed})
    held = stage(occurrences(documents, vocabulary), "query-terms")
    counted = held.agg(F.count(F.when(F.col("n") > 0, 1)).alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    corpus = Corpus(counted.documents, counted.terms)
    df = [0] * len(vocabulary)
    for row in held.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).collect():
        df[row.term] = row.df
    weights = [corpus.weight(n) if n else 0 for n in df]
    number = {word: n for n, word in enumerate(vocabulary)}
    items = []
    for row in listed:
        times = Counter(number[word] for word in row.listed)
        rarest = sorted((n for n in times if weights[n] > 0), key=lambda n: (df[n], n))
        items.append(Item(row.item, rarest, [times[n] for n in rarest]))
    return best_in_tasks(held, items, weights, corpus, k, block_postings)


def ranked(
    documents: DataFrame, items: DataFrame, k: int = TOP, block_terms: int = BLOCK_TERMS, block_postings: int = BLOCK_POSTINGS
) -> DataFrame:
    """item_id, rank, doc_id, score: the k documents of highest score for each row of `items`, equal scores by doc_id.

    Every row of `items` is an item of its own, also where its id is null or repeated; one without terms, or whose
    terms no document holds, gives no row. Every row of `documents` is a document of its own: repeated rows may take
    several ranks, a null id stands before all others of its score. Null and empty texts have no terms and do not
    count as documents; a term that all but every document holds may weigh 0 and then finds none. Other columns of
    either table are not read. Either table may be empty; the result then is.
    """
    given = items.select("item_id", words("text").alias("listed"))
    numbered = stage(given.withColumn("item", F.monotonically_increasing_id()), "query-items")
    total = numbered.agg(F.sum(F.size("listed"))).first()[0] or 0
    blocks = -(-total // block_terms) or 1
    dealt = numbered.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(blocks)))
    found = None
    for n in range(blocks):
        part = _block(documents, dealt.where(F.col("block") == n), k, block_postings)
        found = part if found is None else found.unionByName(part)
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_first())
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.join(numbered.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")

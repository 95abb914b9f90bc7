"""Benchmark decontamination by winnowing.

Every text is reduced to the smallest k-gram hash of each sliding window of w k-grams, k + w - 1 words
long. Two texts that share so many consecutive words share a whole window and hence its smallest hash,
so no shared passage of that length is missed, and only one k-gram in about (w + 1) / 2 is looked up.
Hits are then extended to whole windows of words and compared as text, so hash collisions do no harm.

Documents are read once. What leaves the scan is one row per document and the words around each
fingerprint that a benchmark item has too. With a benchmark too big to broadcast they are read three times, and
what leaves the scan is fingerprints, then the texts that share one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opine.llm.common import digest, let, sliding, small_side, words
from opine.session import stage

SPAN = 13
CONTAMINATED_PERCENT = 5
# Rows of the benchmark's tables up to which they are sent to every executor (about 100 bytes each).
BROADCAST_ROWS = 500_000
# A fingerprint is one bigint: 31 bits of hash, 4 of window length, 28 of position.
HASH_MASK, POSITION_BITS, LENGTH_BITS = (1 << 31) - 1, 28, 4


def _shape(length: int) -> tuple[int, int]:
    """k and w for windows of so many words: k + w - 1 = length."""
    k = max(1, length // 2)
    return k, length - k + 1


def fingerprints(word_list: str | Column, length: int) -> Column:
    """The winnowed fingerprints of a word list, each with the position of its k-gram."""
    k, w = _shape(length)
    hashes = F.transform(word_list, lambda x: F.xxhash64(x))
    grams = sliding(hashes, k, lambda a, b: F.xxhash64(a, b))

    def placed(gram: Column, at: Column) -> Column:
        kept = F.shiftleft(gram.bitwiseAND(HASH_MASK), POSITION_BITS + LENGTH_BITS)
        return kept.bitwiseOR(F.lit(length << POSITION_BITS).cast("bigint")).bitwiseOR(at.cast("bigint"))

    keys = F.transform(grams, placed)
    return F.array_distinct(sliding(keys, w, lambda a, b: F.least(a, b)))


def benchmark_windows(benchmark: DataFrame, span: int = SPAN) -> DataFrame:
    """item, length, window: each run of `span` words of an item, or the whole of a shorter one."""
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words("text").alias("item_words")
    ).where(F.size("item_words") > 0)
    items = items.withColumn("length", F.least(F.size("item_words"), F.lit(span)))
    starts = F.sequence(F.lit(1), F.size("item_words") - F.col("length") + 1)
    return items.select("item", "length", "item_words", F.explode(starts).alias("start")).select(
        "item", "length", F.array_join(F.slice("item_words", F.col("start"), F.col("length")), " ").alias("window")
    )


def _surroundings() -> dict[str, Column]:
    """Of a `key` in `doc_words`: its window's length, and the words of all windows that hold its k-gram."""
    length = F.shiftright("key", POSITION_BITS).bitwiseAND((1 << LENGTH_BITS) - 1).cast("int")
    at = F.col("key").bitwiseAND((1 << POSITION_BITS) - 1).cast("int")
    reach = length - F.greatest(F.lit(1), F.floor(length / 2).cast("int"))  # w - 1
    first = F.greatest(at - reach, F.lit(0))
    return {"length": length, "first": first, "around": F.slice("doc_words", first + 1, at + length - first)}


def _looked_up_apart(
    documents: DataFrame, wanted: DataFrame, all_fingerprints: Callable[[str], Column]
) -> tuple[DataFrame, DataFrame]:
    """Rows and hits where the benchmark's prints are too many to be sent to every executor.

    Only prints cross the network with their texts' digests. Words are cut again, of each different text with a hit once.
    """
    rows = documents.select("doc_id", digest("text").alias("digest"), words("text").alias("doc_words"))
    per_row = stage(rows.select("doc_id", "digest", F.size("doc_words").cast("bigint").alias("n_words")), "rows")
    keys = rows.select("digest", F.explode(all_fingerprints("doc_words")).alias("key"))
    held = keys.join(wanted, F.shiftright("key", POSITION_BITS) == F.col("print"))
    # A text's own prints, however many copies it has.
    held = stage(held.groupBy("digest").agg(F.collect_set("key").alias("keys")), "held-prints")
    asked = small_side(held.select("digest"), held.count(), BROADCAST_ROWS)
    texts = documents.select(digest("text").alias("digest"), "text").join(asked, "digest", "left_semi")
    texts = texts.groupBy("digest").agg(F.first("text").alias("text")).join(held, "digest")
    near = texts.select("digest", words("text").alias("doc_words"), F.explode("keys").alias("key"))
    return per_row, stage(near.select("digest", *[c.alias(name) for name, c in _surroundings().items()]), "winnowed")


def hit_windows(documents: DataFrame, benchmark: DataFrame, span: int = SPAN) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Per row: id, digest, n_words. Per distinct text: digest, start, length, window. And window, item."""
    if not 1 <= span < 1 << LENGTH_BITS:
        raise ValueError(f"span must be from 1 to {(1 << LENGTH_BITS) - 1}")
    window_items = stage(benchmark_windows(benchmark, span).distinct(), "benchmark-windows")
    windows = window_items.select("window", "length").distinct()
    lengths = sorted(row.length for row in windows.select("length").distinct().collect())  # span values at most
    empty = F.array().cast("array<bigint>")

    def all_fingerprints(column: str) -> Column:
        found = [fingerprints(column, length) for length in lengths]
        return F.concat(*found) if found else empty

    # An item's fingerprints are those of its windows; short items take part with their own length only.
    listed = windows.select("length", F.split("window", " ").alias("window_words"))
    of_items = empty
    for length in lengths:
        of_items = F.when(F.col("length") == length, fingerprints("window_words", length)).otherwise(of_items)
    wanted = listed.select(F.explode(of_items).alias("key")).select(F.shiftright("key", POSITION_BITS).alias("print"))
    wanted = stage(wanted.distinct(), "benchmark-prints")
    n_wanted = wanted.count()
    n_windows, window_bytes = windows.agg(F.count(F.lit(1)), F.sum(F.octet_length("window"))).first()
    n_windows = max(n_windows, (window_bytes or 0) // 100)  # a word can be long

    def extended(near: DataFrame) -> DataFrame:
        """Every window of words that holds the k-gram, compared as text."""
        offsets = F.sequence(F.lit(0), F.size("around") - F.col("length"))
        near = (
            near.where(F.size("around") >= F.col("length"))
            .select("digest", "length", "first", "around", F.explode(offsets).alias("offset"))
            .select(
                "digest",
                (F.col("first") + F.col("offset")).alias("start"),
                F.array_join(F.slice("around", F.col("offset") + 1, F.col("length")), " ").alias("window"),
            )
        )
        return near.join(small_side(windows, n_windows, BROADCAST_ROWS), "window").distinct()

    if n_wanted > BROADCAST_ROWS:
        per_row, near = _looked_up_apart(documents, wanted, all_fingerprints)
        return per_row, extended(near), window_items.select("window", "item")
    rows = documents.select("doc_id", digest("text").alias("digest"), words("text").alias("doc_words"))
    # The null stands for the document itself, so that one pass gives both its row and its hits.
    keys = F.concat(F.array(F.lit(None).cast("bigint")), all_fingerprints("doc_words"))
    looked_up = rows.select("doc_id", "digest", "doc_words", F.explode(keys).alias("key")).join(
        small_side(wanted, n_wanted, BROADCAST_ROWS), F.shiftright("key", POSITION_BITS) == F.col("print"), "left"
    )
    found = looked_up.where(F.col("key").isNull() | F.col("print").isNotNull())
    found = found.select(
        "doc_id",
        "digest",
        F.size("doc_words").cast("bigint").alias("n_words"),
        F.col("print").isNotNull().alias("is_hit"),
        *[F.when(F.col("print").isNotNull(), c).alias(name) for name, c in _surroundings().items()],
    )
    found = stage(found, "winnowed")
    per_row = found.where(~F.col("is_hit")).select("doc_id", "digest", "n_words")
    return per_row, extended(found.where("is_hit")), window_items.select("window", "item")


def _hit_words(hits: DataFrame) -> DataFrame:
    """digest, n_hit: the words that lie in any hit window, overlaps counted once."""
    before = Window.partitionBy("digest").orderBy("start", "length").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("length")
    covered = F.greatest(end - F.greatest(F.col("start"), F.coalesce(F.max(end).over(before), F.lit(0))), F.lit(0))
    spans = hits.select("digest", "start", "length").distinct().withColumn("covered", covered)
    return spans.groupBy("digest").agg(F.sum("covered").alias("n_hit"))


def contamination(documents: DataFrame, benchmark: DataFrame, span: int = SPAN) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated; one row for each row of `documents`.

    A null or empty text has no words and no hits. Rows may repeat and ids may be null or repeat: results
    depend on the text alone. A null item id counts as an empty one, items of one id as one item, an item
    without words as none. Other columns of either table are not read. Without items nothing is hit.
    """
    per_row, hits, window_items = hit_windows(documents, benchmark, span)
    hits = stage(hits, "window-hits")
    n_hit = _hit_words(hits)
    items = (
        hits.select("digest", "window")
        .distinct()
        .join(window_items, "window")
        .select("digest", "item")
        .distinct()
        .groupBy("digest")
        .agg(F.count(F.lit(1)).alias("n_items"), F.sort_array(F.collect_list("item")).alias("items"))
        .select("digest", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"))
    )
    # Written by itself, so that the join with the rows of a text that is copied often can be split.
    verdicts = stage(n_hit.join(items, "digest"), "contaminated-texts")
    n_hit_column = F.coalesce("n_hit", F.lit(0)).cast("bigint")
    return per_row.join(verdicts, "digest", "left").select(
        "doc_id",
        "n_words",
        n_hit_column.alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("bigint").alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        is_contaminated(n_hit_column, F.col("n_words")).alias("contaminated"),
    )


def is_contaminated(n_hit: Column, n_words: Column) -> Column:
    return (n_hit > 0) & (n_hit * 100 >= n_words * CONTAMINATED_PERCENT)


def clean_documents(documents: DataFrame, benchmark: DataFrame, span: int = SPAN) -> DataFrame:
    """The rows of `documents` that are not contaminated, with all their columns.

    Null and empty texts stay. Rows may repeat: equal texts stay or go together. Without items all rows stay.
    """
    per_row, hits, _ = hit_windows(documents, benchmark, span)
    bad = (
        _hit_words(hits)
        .join(per_row.select("digest", "n_words").distinct(), "digest")
        .where(is_contaminated(F.col("n_hit"), F.col("n_words")))
        .select(F.col("digest").alias("__bad"))
    )
    # 16 bytes each: where they are few, no text crosses the network.
    bad = stage(bad.distinct(), "contaminated-digests")
    return documents.join(small_side(bad, bad.count(), BROADCAST_ROWS), digest("text") == F.col("__bad"), "left_anti")

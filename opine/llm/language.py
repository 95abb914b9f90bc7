"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counts come from every learning row: each task adds up its own dense table of languages x buckets, and Spark
sums the tables' non-empty cells. The table of log probabilities has a fixed size for each language; it is sent
to the tasks once, and a batch is scored by gathering its n-grams' columns and adding them up by text.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from opine.llm.common import text_or_empty

ORDERS = (1, 2, 3)
BUCKET_BITS = 15
SMOOTHING = 0.5
# Languages that a task counts at once (8 bytes for each bucket); with more, it hands its counts on and starts anew. The
# driver and an executor hold languages x buckets numbers of 8 and 4 bytes: 128 KiB a language in a task.
TABLES = 512
# A longer text is taken in pieces of so many characters; a pass of numpy gathers up to so many numbers.
PIECE = 1 << 16
GATHERED = 1 << 22
UNKNOWN = "und"

_MIX = np.uint64(0x9E3779B97F4A7C15)


class Model(NamedTuple):
    languages: list[str]
    log_probability: np.ndarray  # buckets x languages, float32
    log_prior: np.ndarray


def _grams(window: str) -> np.ndarray:
    """The buckets of the character n-grams that start at the first PIECE characters of a window."""
    codes = np.frombuffer(window.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    parts = []
    key = np.zeros(len(codes), dtype=np.uint64)
    for order in range(1, max(ORDERS) + 1):
        if len(codes) < order:
            break
        # 21 bits hold a code point, so three of them are told apart before hashing.
        key = codes if order == 1 else (key[:-1] << np.uint64(21)) | codes[order - 1 :]
        if order in ORDERS:
            mixed = (key[:PIECE] + np.uint64(order)) * _MIX
            parts.append((mixed >> np.uint64(64 - BUCKET_BITS)).astype(np.int32))
    return np.concatenate(parts)


def _pieces(text: str) -> Iterator[np.ndarray]:
    """The buckets of a text's character n-grams, case folded and with a blank at either end, PIECE starts at a time.
    Windows overlap, so that each n-gram counts once, also where it lies over a cut."""
    padded = f" {text.lower()} "
    for at in range(0, len(padded), PIECE):
        yield _grams(padded[at : at + PIECE + max(ORDERS) - 1])


def _count(pairs: DataFrame) -> DataFrame:
    """lang, bucket, n over rows of lang, text; lang null counts documents under bucket -1."""

    def cells(tables: dict[str, np.ndarray]) -> Iterator[pd.DataFrame]:
        for lang, table in tables.items():
            used = np.flatnonzero(table)
            yield pd.DataFrame({"lang": lang, "bucket": used.astype(np.int32), "n": table[used]})

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tables: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"], strict=True):
                table = tables.get(lang)
                if table is None:
                    table = tables[lang] = np.zeros((1 << BUCKET_BITS) + 1, dtype=np.int64)
                table[-1] += 1
                for grams in _pieces(text):
                    table[:-1] += np.bincount(grams, minlength=1 << BUCKET_BITS)
                if len(tables) >= TABLES:
                    yield from cells(tables)
                    tables = {}
        yield from cells(tables)

    return (
        pairs.mapInPandas(counted, "lang string, bucket int, n bigint")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
    )


def fit(rows: DataFrame) -> Model:
    """Learn from rows of lang, text; rows without a language or with a text without letters are left out."""
    learnt = rows.where(F.col("lang").isNotNull() & has_letter(text_or_empty())).select(
        F.col("lang").cast("string").alias("lang"), text_or_empty().alias("text")
    )
    # One row for each language: its buckets and their counts.
    listed = _count(learnt).groupBy("lang").agg(F.collect_list("bucket").alias("buckets"), F.collect_list("n").alias("n"))
    found = listed.orderBy("lang").collect()
    size = 1 << BUCKET_BITS
    counts = np.zeros((size + 1, len(found)))
    for column, row in enumerate(found):
        counts[row.buckets, column] = row.n
    grams, documents = counts[:-1] + SMOOTHING, counts[-1]
    return Model(
        [row.lang for row in found],
        np.log(grams / grams.sum(axis=0)).astype(np.float32),
        np.log(documents / documents.sum()) if len(found) else documents,
    )


def has_letter(text: Column) -> Column:
    return text.rlike(r"\p{L}")


def _scores(texts: list[str], model: Model) -> np.ndarray:
    """Log joint probabilities, texts x languages."""
    total = np.tile(model.log_prior, (len(texts), 1))
    pending, owners, size = [], [], 0

    def add_up() -> None:
        nonlocal size
        if pending:
            lengths = np.fromiter(map(len, pending), dtype=np.int64, count=len(pending))
            gathered = model.log_probability[np.concatenate(pending)]
            sums = np.add.reduceat(gathered, np.cumsum(lengths) - lengths, axis=0, dtype=np.float64)
            np.add.at(total, owners, sums)
        pending.clear(), owners.clear()
        size = 0

    for owner, text in enumerate(texts):
        for grams in _pieces(text):
            pending.append(grams)
            owners.append(owner)
            size += len(grams)
            if size * len(model.languages) > GATHERED:
                add_up()
    add_up()
    return total


def predict(documents: DataFrame, model: Model) -> DataFrame:
    """`documents` as doc_id, lang_pred, score: the likeliest learnt language and its posterior probability.

    A null text, one without a letter, and every text if no language was learnt, is `und` with score 0. Ties go
    to the language that comes first by name. One row for each row; only doc_id and text are read.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = shared.value
        for texts in batches:
            names, scores = np.full(len(texts), UNKNOWN, dtype=object), np.zeros(len(texts))
            ask = np.flatnonzero(texts.notna()) if known.languages else np.empty(0, dtype=np.int64)
            if len(ask):
                joint = _scores(texts.iloc[ask].tolist(), known)
                best = joint.argmax(axis=1)
                top = joint[np.arange(len(ask)), best]
                names[ask] = np.array(known.languages, dtype=object)[best]
                scores[ask] = 1 / np.exp(joint - top[:, None]).sum(axis=1)
            yield pd.DataFrame({"lang_pred": names, "score": scores})

    fields = [StructField("lang_pred", StringType()), StructField("score", DoubleType())]
    predict_texts = F.pandas_udf(predicted, StructType(fields))
    asked = F.when(has_letter(F.col("text")), F.col("text"))
    return documents.select("doc_id", predict_texts(asked).alias("found")).select("doc_id", "found.*")


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that nothing is learnt from: crc32 of the id's text leaves 1 by 3. A null id is held out too."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(True))

"""Streaming jobs: per-batch word counts, cleaning and scoring of every arriving line.

Each batch is written to a folder of its own, `batch_id=<n>`, in overwrite mode: a batch
that runs again after a failure replaces its own output and adds no duplicate.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml import Transformer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import DoubleType, LongType, StringType, StructType

from opine.functions import text as tx
from opine.operators import embeddings
from opine.session import path_exists
from opine.streaming.lines import BATCH_INTERVAL

CONSOLE_ROWS = 10

WORD_COUNTS = StructType().add("word", StringType()).add("n", LongType())
SCORES = StructType().add("text", StringType()).add("prediction", DoubleType())


def split_words(lines: DataFrame) -> DataFrame:
    """Words of raw lines, cut at single spaces and not cleaned; a blank line gives one empty word. Other columns stay."""
    others = [c for c in lines.columns if c != "value"]
    return lines.select(*others, F.explode(F.split("value", " ")).alias("word"))


def count_words(words: DataFrame) -> DataFrame:
    """word, n, for each value of the other columns."""
    return words.groupBy(*words.columns).agg(F.count(F.lit(1)).alias("n"))


def clean_lines(lines: DataFrame) -> DataFrame:
    """Lines with their word list, by the same expressions as in batch."""
    return lines.withColumn("words", tx.review_words(F.col("value")))


def score_lines(lines: DataFrame, model: Transformer, prediction: str = "prediction") -> DataFrame:
    """text, prediction for every line."""
    scored = model.transform(clean_lines(lines))
    return scored.select(F.col("value").alias("text"), F.col(prediction).cast("double").alias("prediction"))


def _triggered(writer: DataStreamWriter, interval: str | None) -> DataStreamWriter:
    """Every `interval`, or, without one, all that is there now and then stop."""
    return writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)


def start_batches(
    stream: DataFrame,
    out: str,
    checkpoint: str,
    per_batch: Callable[[DataFrame], DataFrame] | None = None,
    interval: str | None = BATCH_INTERVAL,
    show: bool = False,
) -> StreamingQuery:
    """Write each batch, after `per_batch`, under `out`; `show` also prints its first rows."""

    def write(batch: DataFrame, batch_id: int) -> None:
        result = per_batch(batch) if per_batch else batch
        target = f"{out}/batch_id={batch_id}"
        result.write.mode("overwrite").parquet(target)
        if show:
            batch.sparkSession.read.parquet(target).show(CONSOLE_ROWS, truncate=False)

    writer = observed(stream).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return _triggered(writer, interval).start()


# --- counts of a batch without a second pass ---------------------------------------------

OBSERVED = "batch"


def observed(stream: DataFrame) -> DataFrame:
    """A stream whose rows are counted as they pass by; the counts come with the query's progress."""
    return stream.observe(OBSERVED, F.count(F.lit(1)).alias("rows"))


def observed_rows(query: StreamingQuery) -> dict[int, int]:
    """Batch -> rows that passed, of the batches that the query's progress still holds and that had any input."""
    found = {}
    for progress in query.recentProgress:
        metrics = progress.observedMetrics.get(OBSERVED)
        if metrics is not None and progress.numInputRows:
            found[progress.batchId] = metrics["rows"]
    return found


# --- a sink with commits -------------------------------------------------------------------


def _commit(spark: SparkSession, folder: str, attempt: str) -> None:
    named = spark.createDataFrame([(attempt,)], "attempt string")
    named.coalesce(1).write.mode("overwrite").parquet(folder)


def write_committed(result: DataFrame, out: str, batch_id: int) -> None:
    """Write a batch, and last a commit that names what was written.

    Each attempt has a folder of its own, so what a killed attempt left is in no one's way, and no reader takes it: only
    an attempt that a commit names counts. A batch that is committed is not written again.
    """
    spark = result.sparkSession
    commit = f"{out}/commits/batch_id={batch_id}"
    if path_exists(spark, f"{commit}/_SUCCESS"):
        return
    attempt = f"a-{uuid.uuid4().hex}"
    result.write.parquet(f"{out}/data/batch_id={batch_id}/attempt={attempt}")
    _commit(spark, commit, attempt)


def read_committed(spark: SparkSession, out: str, schema: StructType) -> DataFrame:
    """The rows of all committed batches, with their batch_id."""
    whole = StructType([*schema.fields]).add("batch_id", LongType())
    if not path_exists(spark, f"{out}/commits"):
        return spark.createDataFrame([], whole)
    commits = spark.read.schema("attempt string, batch_id bigint").parquet(f"{out}/commits")
    rows = spark.read.schema(StructType([*whole.fields]).add("attempt", StringType())).parquet(f"{out}/data")
    return rows.join(commits, ["batch_id", "attempt"]).select(*whole.fieldNames())


def start_committed(
    stream: DataFrame,
    out: str,
    checkpoint: str,
    per_batch: Callable[[DataFrame], DataFrame] | None = None,
    interval: str | None = BATCH_INTERVAL,
) -> StreamingQuery:
    """Write each batch, after `per_batch`, with commits."""

    def write(batch: DataFrame, batch_id: int) -> None:
        write_committed(per_batch(batch) if per_batch else batch, out, batch_id)

    writer = observed(stream).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return _triggered(writer, interval).start()


# --- scoring of raw text by a table of word vectors ------------------------------------------


def start_text_scoring(
    lines: DataFrame,
    vectors: DataFrame,
    score: Callable[[DataFrame], DataFrame],
    out: str,
    checkpoint: str,
    interval: str | None = BATCH_INTERVAL,
) -> StreamingQuery:
    """Score every line by the average of its words' vectors; written with commits.

    `vectors` is a table of word and vector that each batch's words are joined with, so no executor holds a vocabulary.
    `score` takes rows of value and features (array<double>) and gives what is to be written.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        # Numbered lines are kept while their words are away to meet the vectors.
        numbered = clean_lines(batch).withColumn("_line", F.monotonically_increasing_id()).persist()
        try:
            averaged = embeddings.average_vectors(numbered, vectors, key="_line").drop("_line")
            write_committed(score(averaged), out, batch_id)
        finally:
            numbered.unpersist()

    writer = observed(lines).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return _triggered(writer, interval).start()


def start_append(
    stream: DataFrame, out: str, checkpoint: str, interval: str | None = BATCH_INTERVAL, file_format: str = "parquet"
) -> StreamingQuery:
    """Append rows to files; the sink's own log keeps a replayed batch from being written twice."""
    writer = stream.writeStream.outputMode("append").format(file_format)
    writer = writer.option("path", out).option("checkpointLocation", checkpoint)
    return _triggered(writer, interval).start()


# --- totals since the start ------------------------------------------------------------------

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def start_running_counts(lines: DataFrame, out: str, checkpoint: str, interval: str | None = BATCH_INTERVAL) -> StreamingQuery:
    """Totals since the start. Each batch writes, with a commit, the words whose totals changed.

    The totals are kept by word in RocksDB on the executors, with snapshots in the checkpoint, so that they may
    outgrow memory and a restart goes on from them. The store is chosen when the query starts and stays with it.
    """
    spark = lines.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        write_committed(batch, out, batch_id)

    counted = count_words(split_words(lines)).writeStream.outputMode("update").foreachBatch(write)
    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        return _triggered(counted.option("checkpointLocation", checkpoint), interval).start()
    finally:
        spark.conf.set(STATE_STORE, before)


def running_totals(spark: SparkSession, out: str) -> DataFrame:
    """word, n: the latest total of each word. Totals only grow."""
    return read_committed(spark, out, WORD_COUNTS).groupBy("word").agg(F.max("n").alias("n"))


def start_running_word_count(lines: DataFrame, checkpoint: str, interval: str | None = BATCH_INTERVAL) -> StreamingQuery:
    """Totals since the start, printed after each batch: state is kept across batches."""
    writer = count_words(split_words(lines)).writeStream.outputMode("complete").format("console")
    return _triggered(writer.option("checkpointLocation", checkpoint), interval).start()


def start_word_count(
    lines: DataFrame, out: str, checkpoint: str, interval: str | None = BATCH_INTERVAL, show: bool = False
) -> StreamingQuery:
    """Counts that start anew with each batch."""
    return start_batches(split_words(lines), out, checkpoint, count_words, interval, show)


def start_scoring(
    lines: DataFrame, model: Transformer, out: str, checkpoint: str, interval: str | None = BATCH_INTERVAL, show: bool = False
) -> StreamingQuery:
    """(text, prediction, batch_id) for every line of every batch."""
    return start_batches(score_lines(lines, model), out, checkpoint, interval=interval, show=show)


def start_counts_and_scores(
    lines: DataFrame,
    model: Transformer,
    counts_out: str,
    scores_out: str,
    checkpoint: str,
    interval: str | None = BATCH_INTERVAL,
    show: bool = False,
) -> StreamingQuery:
    """Word counts and predictions of each batch from one reading of the stream."""

    def write(batch: DataFrame, batch_id: int) -> None:
        results = ((count_words(split_words(batch)), counts_out), (score_lines(batch, model), scores_out))
        for result, out in results:
            target = f"{out}/batch_id={batch_id}"
            result.write.mode("overwrite").parquet(target)
            if show:
                batch.sparkSession.read.parquet(target).show(CONSOLE_ROWS, truncate=False)

    writer = lines.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return _triggered(writer, interval).start()


def finish(query: StreamingQuery, timeout: float | None = None) -> None:
    """Wait until the query ends by itself; stop it when the time is over."""
    try:
        if not query.awaitTermination(timeout) and timeout is not None:
            raise TimeoutError(f"stream {query.id} still running after {timeout} s")
    finally:
        query.stop()


def read_batches(spark: SparkSession, out: str, schema: StructType) -> DataFrame:
    """All batches written so far, with their batch_id."""
    whole = StructType([*schema.fields]).add("batch_id", LongType())
    return spark.read.schema(whole).parquet(out) if path_exists(spark, out) else spark.createDataFrame([], whole)

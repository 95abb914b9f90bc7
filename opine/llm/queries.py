"""The registered queries of this subpackage: name -> function of (spark, folder) that gives a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opine.llm import (
    chat_format,
    decontaminate,
    fingerprints,
    language,
    lexical,
    licenses,
    main_text,
    merkle,
    mixing,
    near_duplicates,
    quality,
    secrets,
    token_files,
)

from opine.session import stage

Query = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, Query] = {}


def query(function: Query) -> Query:
    REGISTRY[function.__name__] = function
    return function


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contamination(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    """The public vocabulary file that the contract names, where it is installed."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op2_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.write_and_read(_table(spark, folder, "documents"), vocabulary_path())


@query
def op3_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.compared(_table(spark, folder, "documents"))


@query
def op4_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates.classes(_table(spark, folder, "documents")).drop("node")


@query
def op5_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(_table(spark, folder, "documents"))


@query
def op6_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """A row for each use of a document, in the order of `slot`."""
    mixed = mixing.mixed(_table(spark, folder, "documents").select("doc_id", "source", "text"))
    named = {"__tokens": "n_words", "__weight": "weight", "__pass": "pass", "__block": "block", "__slot": "slot"}
    return mixed.drop("text").withColumnsRenamed(named)


@query
def op7_language_id(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents")
    model = language.fit(documents.where(~language.held_out()))
    predicted = language.predict(documents.select("doc_id", "text"), model)
    return predicted.select("doc_id", language.held_out().alias("held_out"), "lang_pred", F.col("score"))


@query
def op8_main_text(spark: SparkSession, folder: str) -> DataFrame:
    extracted = main_text.extract(_table(spark, folder, "pages").select("page_id", "url", "html"))
    return extracted.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


@query
def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents").select("doc_id", "text")
    scored = quality.classified(documents, _table(spark, folder, "labels"))
    predicted = (F.col("score") >= 0.5).cast("int")
    return scored.select("doc_id", quality.held_out().alias("held_out"), "score", predicted.alias("predicted"))


@query
def op10_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.scan(_table(spark, folder, "documents"))


@query
def op11_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical.ranked(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op12_turns(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text: the rows of a conversation table as canonical turns."""
    records = rows.select("conv_id", "turn", "role", "text")
    return chat_format.canonical(records, ["conv_id", "turn"], (chat_format.TURN_ROW,)).select("conv_id", "turn", "role", "text")


@query
def op12_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    given = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    turns = op12_turns(given.unionByName(chat_format.hostile(spark)))
    return chat_format.conversations(stage(chat_format.formatted(turns), "chat-pieces"), "conv_id", ["turn"])


@query
def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.verified(_table(spark, folder, "documents"))

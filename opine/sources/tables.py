"""Parquet tables and their reading as reviews."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opine.session import path_bytes, spread


def table_path(folder: str, name: str) -> str:
    return f"{folder}/{name}.parquet"


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(folder, name))


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, text; a missing text counts as an empty one."""
    return read_table(spark, folder, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))


def _spread_as(df: DataFrame, folder: str, name: str) -> DataFrame:
    return spread(df, path_bytes(df.sparkSession, table_path(folder, name)))


def all_reviews(spark: SparkSession, folder: str) -> DataFrame:
    """Every document: doc_id, text."""
    return _spread_as(_documents(spark, folder), folder, "documents")


def labelled_reviews(spark: SparkSession, folder: str, label: str = "quality") -> DataFrame:
    """Documents that have a label: doc_id, label (double), text.

    Spark broadcasts `labels` only while it is under its own threshold; beyond that
    the join is a sort-merge join on doc_id.
    """
    labels = read_table(spark, folder, "labels").select("doc_id", F.col(label).cast("double").alias("label"))
    joined = _documents(spark, folder).join(labels, "doc_id").select("doc_id", "label", "text")
    return _spread_as(joined, folder, "documents")


def unlabelled_reviews(spark: SparkSession, folder: str) -> DataFrame:
    """Documents without a label: doc_id, text."""
    labels = read_table(spark, folder, "labels").select("doc_id")
    return _spread_as(_documents(spark, folder).join(labels, "doc_id", "left_anti"), folder, "documents")


def html_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Web pages: page_id, html."""
    return _spread_as(read_table(spark, folder, "pages").select("page_id", "html"), folder, "pages")


def conversation_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Conversation turns as text to be written to a stream folder."""
    return _spread_as(read_table(spark, folder, "conversations").select("text"), folder, "conversations")

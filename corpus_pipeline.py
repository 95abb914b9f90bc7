"""From raw documents to token files: the stages of a training corpus, each over all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opine.llm import decontaminate, mixing, near_duplicates, quality, token_files
from opine.llm.queries import vocabulary_path
from opine.session import new_folder

ACCEPTED_FROM = 0.5


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts, each row judged by its own text.

    A null text is judged as an empty one; equal texts are judged alike. All columns stay as they are, also one that is
    called `score`. An empty table gives an empty one.
    """
    column = "__accepted"
    scored = quality.classified(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), column)
    return scored.where(F.col(column) >= ACCEPTED_FROM).select(*docs.columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal and nearly equal ones: that of the lowest id, a null id last.

    Null and empty texts are equal texts, and one of them stays. Of rows that repeat in id and text one stays. Columns
    stay as they are; an empty table gives an empty one.
    """
    return near_duplicates.deduplicated(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages.

    Null and empty texts have none and stay. Repeated rows stay or go together. Columns stay as they are; an empty table
    gives an empty one.
    """
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once; those of scarce sources up to twice.

    A null source is a source of its own. A text without words counts as one token, so that it is used too. Repeated rows
    are used equally often. Columns stay as they are; an empty table gives an empty one.
    """
    return mixing.mixture(docs)


def to_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in ascending doc_id order, null ids first, and for each row its place in them.

    A null or empty text is its end id alone; repeated rows are written each. Other columns are not read; an empty table
    gives no row.
    """
    return token_files.write_and_read(docs, vocabulary_path())


STAGES = [
    ("quality classifier", keep_good),
    ("near duplicates", keep_one_of_each),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token files", to_token_files),
]

# Fits, hashes of the engine and tokenizers are not SQL's; the tests compare with brute force instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages in order; each writes Parquet to the shared folder, which the next one reads."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_folder(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

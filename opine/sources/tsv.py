"""Tab-separated review files.

Fields are cut at tabs with no quote handling, so quotes stay in the values. Extra
fields are ignored and a short line is an error, unless the caller diverts it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LABELLED = ("id", "label", "review")
UNLABELLED = ("id", "review")
_WHOLE_LINE = "_line"


def parse_label(text: Column) -> Column:
    """Text to double; a value that is no number fails the job."""
    return F.coalesce(text.try_cast("double"), F.raise_error(F.concat(F.lit("bad label: "), text)).cast("double"))


def _read(spark: SparkSession, path: str | list[str], fields: tuple[str, ...], header: bool) -> DataFrame:
    """All fields as strings plus `_line`, the whole line where its field count was odd."""
    schema = ", ".join(f"`{name}` string" for name in (*fields, _WHOLE_LINE))
    return spark.read.csv(
        path,
        schema=schema,
        sep="\t",
        quote="",
        escape="",
        header=header,
        enforceSchema=True,
        mode="PERMISSIVE",
        columnNameOfCorruptRecord=_WHOLE_LINE,
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
        maxCharsPerColumn=-1,
    )


def _first_file(spark: SparkSession, path: str) -> tuple[str, str] | None:
    """The data set's first file by name that is not empty: its path, and the same as `_metadata` gives it.

    It is picked from the sizes that the listing has; no contents are read, and only one name comes to the driver.
    """
    files = spark.read.format("binaryFile").load(path).where(F.col("length") > 0)
    first = files.agg(F.min(F.struct("path", "_metadata.file_path")).alias("first")).first().first
    return None if first is None else (first.path, first.file_path)


def _first_file_header(spark: SparkSession, path: str, fields: tuple[str, ...]) -> DataFrame:
    every = _read(spark, path, fields, header=False)
    first = _first_file(spark, path)
    if first is None:
        return every
    columns = every.columns
    others = every.where(F.col("_metadata.file_path") != first[1]).select(*columns)  # leaves out a file, not rows
    return _read(spark, first[0], fields, header=True).unionByName(others)


def _with_fields(df: DataFrame, fields: tuple[str, ...], short_lines: str) -> DataFrame:
    # Spark reads a missing field and an empty one both as NULL. Only a line with too few
    # tabs is shorter than its own fields joined again. The test names every column on
    # purpose: Spark judges a line by the columns that are asked for.
    values = [F.coalesce(name, F.lit("")).alias(name) for name in fields]
    is_short = F.coalesce(F.length(_WHOLE_LINE) < F.length(F.concat_ws("\t", *values)), F.lit(False))
    if short_lines == "fail":
        fail = F.raise_error(F.concat(F.lit("short line: "), F.col(_WHOLE_LINE))).cast("boolean")
        return df.where(F.when(is_short, fail).otherwise(F.lit(True))).select(*values)
    if short_lines == "drop":
        return df.where(~is_short).select(*values)
    if short_lines == "only":
        return df.where(is_short).select(F.col(_WHOLE_LINE).alias("line"))
    raise ValueError(f"unknown short_lines: {short_lines}")


def read_tsv(
    spark: SparkSession, path: str, fields: tuple[str, ...], header: str = "first_file", short_lines: str = "fail"
) -> DataFrame:
    """Read a TSV data set as strings.

    header: "first_file" drops the first line of the data set, that of the first file by
    name which is not empty; "each_file" the first line of every file; "none" drops nothing.
    short_lines: "fail", "drop", or "only" (give back the short lines themselves).
    Blank lines hold no review and are passed over.
    """
    if header == "first_file":
        df = _first_file_header(spark, path, fields)
    elif header in ("each_file", "none"):
        df = _read(spark, path, fields, header == "each_file")
    else:
        raise ValueError(f"unknown header: {header}")
    return _with_fields(df, fields, short_lines)


def read_labelled(spark: SparkSession, path: str, header: str = "first_file", short_lines: str = "fail") -> DataFrame:
    """id string, label double, review string."""
    df = read_tsv(spark, path, LABELLED, header, short_lines)
    return df if short_lines == "only" else df.withColumn("label", parse_label(F.col("label")))


def read_unlabelled(spark: SparkSession, path: str, header: str = "first_file", short_lines: str = "fail") -> DataFrame:
    """id string, review string."""
    return read_tsv(spark, path, UNLABELLED, header, short_lines)


def read_dropping_header_value(spark: SparkSession, path: str, fields: tuple[str, ...] = LABELLED) -> DataFrame:
    """Drop every line equal to the first line of the data set, that of its first file, wherever it stands.

    Fields beyond the last are ignored; a missing one is NULL.
    """
    lines = spark.read.text(path)
    name = _first_file(spark, path)
    first = None if name is None else spark.read.text(name[0]).where(F.col("_metadata.file_block_start") == 0).first()
    if first is not None:
        lines = lines.where(F.col("value") != F.lit(first.value))
    parts = F.split("value", "\t")
    return lines.select(*[F.get(parts, i).alias(name) for i, name in enumerate(fields)])


def write_tsv(df: DataFrame, path: str, header: bool = True) -> None:
    """Write string columns as TSV with a header line in each file (or `header=False`: none) and no quoting.

    Tabs and line ends inside values become spaces first: the format cannot hold them.
    """
    flat = [F.regexp_replace(F.col(c).cast("string"), "[\t\r\n]", " ").alias(c) for c in df.columns]
    df.select(*flat).write.csv(
        path,
        sep="\t",
        quote="",
        escape="",
        escapeQuotes=False,
        emptyValue="",
        nullValue="",
        header=header,
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )

"""Document fingerprints by consistent weighted sampling.

A text is a weighted set: its words, as 64-bit hashes, each with its count as weight. For each sample k a word
has two gamma(2, 1) variables r and c and a uniform b, the same in every text. With
t = floor(ln(weight) / r + b) it scores ln(c) - r * (t - b + 1), and the sample is the word with the lowest
score, together with t. Two texts agree on a sample with a chance of sum(min) / sum(max) of their weights, the
generalised Jaccard similarity, so the share of equal samples estimates it.

The variables are a table of a fixed size, made once and sent to every task, so that no logarithm but the
weight's is taken where the words are. A word takes r and b from one row and c from another, chosen by different
bits of its hash, and a sample names the word by its whole hash: words never count as one because they share rows.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from opine.llm.common import let, text_or_empty, words

SAMPLES = 64
# Rows of the table: r and b are taken by the lowest ROW_BITS bits of a word's hash, c by the next.
ROW_BITS = 14
# A score is kept as 31 bits: it lies in (-64, 64), and differences below 2^-24 are ties, which the tag breaks.
SCORE_OFFSET, SCORE_SCALE = 64.0, float(1 << 24)
TAG_BITS = 32

# Documents are dealt to ranges of ids with so many bytes of text, in so many ranges at most (the driver holds
# one number for each).
RANGE_BYTES, MOST_RANGES = 2 << 20, 100_000
FIRST = -(1 << 63)


def random_table(spark: SparkSession, samples: int = SAMPLES) -> DataFrame:
    """row, inverse_r, r, log_c, b: for each row, arrays over the samples. About 16 bytes a number."""

    def uniform(k: Column, salt: int) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(F.col("row"), k, F.lit(salt)), 11)
        return (bits + 0.5) / float(1 << 53)

    def gamma(k: Column, salt: int) -> Column:
        return -F.log(uniform(k, salt) * uniform(k, salt + 1))

    each = F.sequence(F.lit(0), F.lit(samples - 1))
    table = spark.range(1 << ROW_BITS).select(F.col("id").cast("int").alias("row"))
    return table.select(
        "row",
        F.transform(each, lambda k: (1 / gamma(k, 0)).cast("float")).alias("inverse_r"),
        F.transform(each, lambda k: gamma(k, 0).cast("float")).alias("r"),
        F.transform(each, lambda k: F.log(gamma(k, 2)).cast("float")).alias("log_c"),
        F.transform(each, lambda k: uniform(k, 4).cast("float")).alias("b"),
    )


def weighted_terms(text: str | Column = "text") -> Column:
    """array<struct<term, weight>>: the hashed words of a text with their counts, by sorting within the row."""
    hashed = F.transform(words(text), lambda w: F.xxhash64(w))

    def runs(listed: Column) -> Column:
        count = F.size(listed)
        places = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
        ends = F.filter(places, lambda i: (i == count - 1) | (F.get(listed, i) != F.get(listed, i + 1)))

        def counted(end: Column) -> Column:
            before = F.slice(F.concat(F.array(F.lit(-1)), end), F.lit(1), F.size(end))
            return F.zip_with(
                end, before, lambda e, p: F.struct(F.get(listed, e).alias("term"), (e - p).alias("weight"))
            )

        return let(ends, counted)

    return let(F.sort_array(hashed), runs)


def _row(nth: int) -> Column:
    return F.shiftrightunsigned("term", nth * ROW_BITS).bitwiseAND(F.lit((1 << ROW_BITS) - 1)).cast("int")


def signatures(rows: DataFrame, keys: list[str], text: str = "text", samples: int = SAMPLES) -> DataFrame:
    """keys, signature: array<bigint> of tags, empty for a text without words; one row for each value of keys.

    A row is taken apart into its terms and put together by its keys, which hold whole rows apart; if `rows` are
    dealt by some of the keys already, nothing is shuffled.
    """
    table = random_table(rows.sparkSession, samples)
    terms = rows.select(*keys, F.explode_outer(weighted_terms(text)).alias("one")).select(
        *keys, F.col("one.term").alias("term"), F.log(F.col("one.weight").cast("double")).alias("log_weight")
    )
    rows_of = terms.withColumn("row_r", _row(0)).withColumn("row_c", _row(1))
    first = table.select(F.col("row").alias("row_r"), "inverse_r", "r", "b")
    second = table.select(F.col("row").alias("row_c"), "log_c")
    joined = rows_of.join(F.broadcast(first), "row_r", "left").join(F.broadcast(second), "row_c", "left")

    def sample(k: int) -> Column:
        r, b = F.get("r", F.lit(k)), F.get("b", F.lit(k))
        t = F.floor(F.col("log_weight") * F.get("inverse_r", F.lit(k)) + b)
        score = F.get("log_c", F.lit(k)) - r * (t - b + 1)
        kept = F.greatest(F.least(score, F.lit(SCORE_OFFSET - 1)), F.lit(-SCORE_OFFSET)) + SCORE_OFFSET
        tag = F.hash("term", t).cast("bigint").bitwiseAND((1 << TAG_BITS) - 1)
        packed = F.shiftleft((kept * SCORE_SCALE).cast("bigint"), TAG_BITS).bitwiseOR(tag)
        return F.min(F.when(F.col("term").isNotNull(), packed)).alias(f"s{k}")

    least = joined.groupBy(*keys).agg(*[sample(k) for k in range(samples)])
    tags = F.array(*[F.col(f"s{k}").bitwiseAND((1 << TAG_BITS) - 1) for k in range(samples)])
    none = F.array().cast("array<bigint>")
    return least.select(*keys, F.when(F.col("s0").isNotNull(), tags).otherwise(none).alias("signature"))


def likeness(a: str | Column, b: str | Column) -> Column:
    """The share of equal samples; 1 for two texts without words, 0 for one with and one without."""
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    same = F.aggregate(F.zip_with(a, b, lambda x, y: F.when(x == y, 1).otherwise(0)), F.lit(0), lambda s, x: s + x)
    share = same / F.greatest(F.size(a), F.size(b)).cast("double")
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(share)


def as_text(signature: str | Column) -> Column:
    """8 hex digits for each sample."""
    return F.array_join(F.transform(signature, lambda tag: F.lpad(F.lower(F.hex(tag)), 8, "0")), "")


# --- each document, its edited text and the next document ----------------------------------


def _ranges(keyed: DataFrame) -> DataFrame:
    """`keyed` with `part`, a number for each range of `key`; rows of one key stay together."""
    total = keyed.agg(F.sum(F.octet_length("text")), F.count(F.lit(1))).first()
    wanted = min(MOST_RANGES, (total[0] or 0) // RANGE_BYTES + 1)
    if wanted < 2:
        return keyed.withColumn("part", F.lit(0))
    fractions = [k / wanted for k in range(1, wanted)]
    accuracy = F.lit(max(10_000, 20 * wanted))
    bounds = keyed.agg(F.percentile_approx("key", fractions, accuracy)).first()[0]
    splits = sorted({float(b) for b in bounds})
    cut = Bucketizer(splits=[float("-inf"), *splits, float("inf")], inputCol="as_double", outputCol="range")
    cut_rows = cut.transform(keyed.withColumn("as_double", F.col("key").cast("double")))
    return cut_rows.withColumn("part", F.col("range").cast("int")).drop("as_double", "range")


def with_next(documents: DataFrame) -> DataFrame:
    """part, place, doc_id, text, next_text, extra: each document with the text of the next by doc_id.

    Null ids come first, rows of one id by the hash of their text; the last row's next is the first. `part` holds
    neighbours together. The first row of a part also stands, as `extra`, at the end of the part before it, so that
    each part can be worked on by itself.
    """
    key = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(FIRST))
    keyed = _ranges(documents.select("doc_id", text_or_empty().alias("text"), key.alias("key")))
    # At most MOST_RANGES numbers: where each part starts.
    starts = keyed.groupBy("part").agg(F.min("key").alias("key")).orderBy("part").collect()
    spark = documents.sparkSession
    before = [(starts[n].key, starts[n - 1].part) for n in range(len(starts))]
    firsts = spark.createDataFrame(before, "key bigint, target int")
    tied = keyed.withColumn("tie", F.xxhash64("text"))
    order = Window.partitionBy("target").orderBy("tie", "text")
    extra = (
        tied.join(F.broadcast(firsts), "key")
        .withColumn("nth", F.row_number().over(order))
        .where(F.col("nth") == 1)
        .select("doc_id", "text", "key", F.col("target").alias("part"), "tie", F.lit(True).alias("extra"))
    )
    rows = tied.select("doc_id", "text", "key", "part", "tie", F.lit(False).alias("extra")).unionByName(extra)
    order = Window.partitionBy("part").orderBy("extra", "key", "tie")
    return rows.select(
        "part",
        F.row_number().over(order).alias("place"),
        "doc_id",
        "text",
        F.lead("text").over(order).alias("next_text"),
        "extra",
    )


def compared(documents: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has the last floor(n_chars / 4) code points replaced by as many from the start of the next
    document (all of it, if it is shorter). A null or empty text has an empty fingerprint, and so has a text
    without words; two of those are alike (1), one of them and another text are not (0). Rows may repeat: one row
    for each row of `documents`. A single row is its own next. Other columns are not read.
    """
    n_chars = F.length("text").cast("bigint")
    cut = F.floor(F.length("text") / 4).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), F.length("text") - cut), F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), cut)
    )
    rows = with_next(documents).select("part", "place", "doc_id", "extra", n_chars.alias("n_chars"), "text", edited.alias("edited"))
    rows = rows.withColumn("sha", F.unhex(F.sha2("edited", 256)))
    own = F.struct(F.lit(0).alias("side"), F.col("text").alias("text"))
    other = F.struct(F.lit(1).alias("side"), F.col("edited").alias("text"))
    sides = F.when(F.col("extra"), F.array(own)).otherwise(F.array(own, other))
    rows = rows.select("part", "place", "doc_id", "extra", "n_chars", "sha", F.explode(sides).alias("s"))
    keys = ["part", "place", "side", "doc_id", "extra", "n_chars", "sha"]
    signed = signatures(rows.select(*keys[:2], "s.side", *keys[3:], "s.text"), keys, samples=samples)
    # In a part, each document is followed by its edited text, and that by the next document.
    order = Window.partitionBy("part").orderBy("place", "side")
    return (
        signed.withColumn("edited", F.lead("signature", 1).over(order))
        .withColumn("next", F.lead("signature", 2).over(order))
        .where((F.col("side") == 0) & ~F.col("extra"))
        .select(
            "doc_id",
            "n_chars",
            F.lower(F.hex("sha")).alias("edited_sha256"),
            as_text("signature").alias("fingerprint"),
            as_text("edited").alias("edited_fingerprint"),
            likeness("signature", "edited").alias("near_edited"),
            likeness("signature", "next").alias("near_next"),
        )
    )

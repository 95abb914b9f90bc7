"""Near duplicates by order min-hash.

A text is the sequence of its five-word shingles, each labelled by how often it has come before. For each sketch
every labelled shingle gets a hash. The few smallest of all and the few largest of those that come for the first time
are kept in the order in which they stand in the text, so two texts agree on a sketch only if they share those shingles
in that order. (With the smallest alone, texts that share nothing but a line they repeat often would agree on its
labels.) Texts that agree on a sketch share a bucket. Texts with few shingles, of which sketches could miss one in a
hundred, also share buckets by their whole sets, and by these without one shingle.

In a bucket nobody is compared with everybody. First each text is compared with the bucket's two representatives:
the smallest of its texts by digest, and the one that meets most texts in all its buckets, which is what copies were
made from if it is there. Links are contracted to groups. Pairs of one bucket that are still in
different groups are then compared too (the strays of a bucket with all others), but for those that bounds rule out: one minus the Jaccard similarity is a
metric, so two texts whose distances to a third one differ by more than 0.2 are no near duplicates; and texts whose
outlines differ too much are none (see `_may_be_alike`). Both bounds are exact and no other limit is set, so no link
between texts that share a bucket is lost.

A link needs a Jaccard similarity of the shingle sets of 0.8 or more, and an alignment of the words in which at
least 0.8 of the two texts is matched; the alignment looks at a band of diagonals only, as wide as the edits it allows.
Equal texts are one node throughout and are never compared.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, LongType, StructField, StructType

from opine.llm.common import digest, small_side, words
from opine.session import stage

SHINGLE = 5
SIMILARITY = 0.8
# At a similarity of 0.8 a sketch of 2 + 2 shingles agrees with a chance of about 0.41, and one of 20 with 0.99997.
SKETCHES, KEPT, FIRSTS = 20, 2, 2
# Classes of shingles, as a power of two, in the outlines that tell unlike texts apart.
OUTLINE_BITS = 11
# Columns of an alignment that are worked on at a time.
BLOCK_BITS = 16_384
# Sets of shingles up to this size are looked up by themselves and without each of their shingles too.
SMALL_SET = 12
# Texts of an open bucket that one task compares with the strays of the bucket.
SALT_ROWS = 1000
# Texts in question up to which their digests are sent to every executor (16 bytes each).
BROADCAST_ROWS = 1_000_000

_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], dtype=np.uint64)
_SEEDS = (np.arange(1, SKETCHES + 1, dtype=np.uint64) * _MULTIPLIERS[0]) ^ _MULTIPLIERS[1]


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit."""
    x = (x ^ (x >> np.uint64(33))) * _MULTIPLIERS[1]
    x = (x ^ (x >> np.uint64(29))) * _MULTIPLIERS[0]
    return x ^ (x >> np.uint64(32))


def shingles(word_hashes: np.ndarray) -> np.ndarray:
    """A hash for each run of five words; a shorter text is one shingle."""
    hashes = word_hashes.astype(np.int64).view(np.uint64)
    width = min(SHINGLE, len(hashes))
    count = len(hashes) - width + 1 if width else 0
    found = np.full(count, width, dtype=np.uint64)
    for k in range(width):
        found = _mixed(found * _MULTIPLIERS[0] + hashes[k : k + count])
    return found


def sketch(word_hashes: np.ndarray) -> np.ndarray:
    """The bucket of each sketch; none for a text without words."""
    found = shingles(word_hashes)
    if not len(found):
        return np.empty(0, dtype=np.int64)
    order = np.argsort(found, kind="stable")
    listed = found[order]
    places = np.arange(len(listed))
    new = np.r_[True, listed[1:] != listed[:-1]]
    occurrence = np.empty(len(found), dtype=np.uint64)
    occurrence[order] = places - np.maximum.accumulate(np.where(new, places, 0))
    labelled = _mixed(found + occurrence * _MULTIPLIERS[1])
    kept = min(KEPT, len(labelled))
    buckets = _SEEDS.copy()
    first = np.flatnonzero(occurrence == 0)
    others = min(FIRSTS, len(first))
    chosen = np.empty((SKETCHES, kept + others), dtype=np.uint64)
    for n, seed in enumerate(_SEEDS):
        ranks = (labelled ^ seed) * _MULTIPLIERS[0]
        ranks ^= ranks >> np.uint64(32)
        at = np.argpartition(ranks, kept - 1)[:kept] if kept < len(ranks) else places
        of_first = ranks[first]
        top = first[np.argpartition(of_first, len(first) - others)[-others:]] if others < len(first) else first
        chosen[n] = labelled[np.sort(np.r_[at, top])]
    for place in range(kept + others):
        buckets = _mixed((buckets ^ chosen[:, place]) * _MULTIPLIERS[0])
    return buckets.view(np.int64)


def small_set_keys(word_hashes: np.ndarray) -> np.ndarray:
    """Buckets that texts with few different shingles share if their sets are equal or differ in one shingle on a side.

    Sets of n and m shingles that are alike differ in (n + m) / 9 at most, so up to nine each none is missed.
    """
    listed = np.unique(shingles(word_hashes))
    if not 0 < len(listed) <= SMALL_SET:
        return np.empty(0, dtype=np.int64)
    spread_out = _mixed(listed * _MULTIPLIERS[0] + _MULTIPLIERS[1])
    whole = spread_out.sum(dtype=np.uint64)
    # Below five shingles, sets that differ are not alike.
    keys = np.r_[whole, whole - spread_out] if len(listed) >= SHINGLE else np.array([whole], dtype=np.uint64)
    return _mixed(keys).view(np.int64)


def buckets_of(word_hashes: np.ndarray) -> np.ndarray:
    return np.unique(np.r_[sketch(word_hashes), small_set_keys(word_hashes)])


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of the shingle sets; two texts without words are not alike."""
    a, b = np.unique(shingles(a)), np.unique(shingles(b))
    shared = len(np.intersect1d(a, b, assume_unique=True))
    union = len(a) + len(b) - shared
    return shared / union if union else 0.0


def aligned(a: np.ndarray, b: np.ndarray, similarity: float = SIMILARITY) -> bool:
    """Whether an alignment matches at least `similarity` of the words of both: matched * 2 / (len + len).

    The longest common subsequence, row by row with the columns as bits of whole numbers: a bit that is off is a column at
    which it grows. Only the band of diagonals that the allowed insertions and deletions can reach is filled, in blocks
    of columns that hand a carry for each row on to the next, so that memory is in proportion to the texts.
    """
    total = len(a) + len(b)
    allowed = int(total * (1 - similarity) + 1e-9)
    short = min(len(a), len(b))
    differing = np.flatnonzero(a[:short] != b[:short])
    first = int(differing[0]) if len(differing) else short
    a, b = a[first:], b[first:]
    short = min(len(a), len(b))
    differing = np.flatnonzero(a[len(a) - short :][::-1] != b[len(b) - short :][::-1])
    last = int(differing[0]) if len(differing) else short
    columns, rows = a[: len(a) - last].tolist(), b[: len(b) - last].tolist()
    if abs(len(columns) - len(rows)) > allowed:
        return False
    carries = bytearray(len(rows))
    common = 0
    for start in range(0, len(columns), BLOCK_BITS):
        block = columns[start : start + BLOCK_BITS]
        places: dict[int, int] = {}
        for at, word in enumerate(block):
            places[word] = places.get(word, 0) | 1 << at
        width = len(block)
        full = (1 << width) - 1
        state = full
        for row in range(max(0, start - allowed), min(len(rows), start + width + allowed)):
            held = state & places.get(rows[row], 0)
            grown = state + held + carries[row]
            carries[row] = grown >> width
            state = (grown & full) | (state ^ held)
        common += width - state.bit_count()
    return len(columns) + len(rows) - 2 * common <= allowed


def _sketches(batch: pd.Series) -> pd.Series:
    return batch.map(buckets_of)


def _compared(a: pd.Series, b: pd.Series) -> pd.DataFrame:
    alike = [jaccard(x, y) for x, y in zip(a, b, strict=True)]
    linked = [j >= SIMILARITY and aligned(x, y) for j, x, y in zip(alike, a, b, strict=True)]
    return pd.DataFrame({"jaccard": alike, "linked": linked})


_COMPARED = StructType([StructField("jaccard", DoubleType()), StructField("linked", BooleanType())])


def outline(word_hashes: np.ndarray) -> tuple[int, np.ndarray]:
    """How many shingles the set has, and a bit for each class of them: whether it holds an odd number of them."""
    listed = np.unique(shingles(word_hashes))
    held = np.bincount((listed >> np.uint64(64 - OUTLINE_BITS)).astype(np.int64), minlength=1 << OUTLINE_BITS)
    return len(listed), np.packbits((held & 1).astype(np.uint8)).view(np.int64)


def _outlines(batch: pd.Series) -> pd.DataFrame:
    made = [outline(words) for words in batch]
    return pd.DataFrame({"n_shingles": [n for n, _ in made], "odd": [bits for _, bits in made]})


_OUTLINE = StructType([StructField("n_shingles", LongType()), StructField("odd", ArrayType(LongType()))])


def _may_be_alike(x: str, y: str) -> Column:
    """False only where the Jaccard similarity is below the threshold for certain.

    Distances obey the triangle inequality. A shingle that only one of two sets has turns one bit of its
    outline, so the differing bits are no more than such shingles, and of these there may be
    (n + n) * (1 - s) / (1 + s) at a similarity of s.
    """
    most = 1 - SIMILARITY + 1e-9
    near = F.lit(True)
    for end in ("far_low", "far_central"):
        near = near & (F.abs(F.col(f"{x}.{end}") - F.col(f"{y}.{end}")) <= most)
    n_both = F.col(f"{x}.n_shingles") + F.col(f"{y}.n_shingles")
    differing = F.lit(0)
    for k in range((1 << OUTLINE_BITS) // 64):
        differing = differing + F.bit_count(F.get(f"{x}.odd", F.lit(k)).bitwiseXOR(F.get(f"{y}.odd", F.lit(k))))
    return near & (differing <= n_both * ((1 - SIMILARITY) / (1 + SIMILARITY)) + 1e-6)


def _hashed_words() -> Column:
    return F.transform(words("text"), lambda w: F.hash(w))


def _texts(nodes: DataFrame, documents: DataFrame) -> DataFrame:
    """node, words (hashed) of the texts in question; they are read again, not shuffled whole."""
    nodes = stage(nodes, "nodes")
    asked = small_side(nodes, nodes.count(), BROADCAST_ROWS)
    texts = documents.select(digest("text").alias("node"), "text").join(asked, "node", "left_semi")
    # One row for each node: first() of equal rows.
    texts = texts.select("node", _hashed_words().alias("words")).groupBy("node").agg(F.first("words").alias("words"))
    return stage(texts, "node-texts")


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """a, b, jaccard, linked for pairs of digests."""
    compare = F.pandas_udf(_compared, _COMPARED)
    both = pairs.join(texts.select(F.col("node").alias("a"), F.col("words").alias("a_words")), "a").join(
        texts.select(F.col("node").alias("b"), F.col("words").alias("b_words")), "b"
    )
    found = both.select("a", "b", compare("a_words", "b_words").alias("c")).select("a", "b", "c.jaccard", "c.linked")
    return stage(found, "verified-pairs")


def components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) for every node of the edges a, b.

    Each round merges every node with its smallest neighbour and keeps the edges between what is left. Nodes are
    random digests, so about half of them find a smaller one and few rounds are needed.
    """
    edges = stage(edges.where(F.col("a") != F.col("b")).select("a", "b").distinct(), "edges")
    merged: list[DataFrame] = []
    nodes = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("component", F.col("node"))
    while not edges.isEmpty():
        both_ways = edges.union(edges.select("b", "a"))
        nearest = both_ways.groupBy("a").agg(F.min("b").alias("least"))
        step = stage(nearest.select(F.col("a").alias("node"), F.least("a", "least").alias("into")), "merged")
        merged.append(step)
        left = step.select(F.col("node").alias("a"), F.col("into").alias("to_a"))
        right = step.select(F.col("node").alias("b"), F.col("into").alias("to_b"))
        moved = edges.join(left, "a").join(right, "b").where(F.col("to_a") != F.col("to_b"))
        ends = moved.select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b"))
        edges = stage(ends.distinct(), "edges")
    for step in merged:
        follow = step.withColumnRenamed("node", "component")
        nodes = nodes.join(follow, "component", "left").select("node", F.coalesce("into", "component").alias("component"))
    return stage(nodes, "components")


def _open_pairs(rest: DataFrame) -> DataFrame:
    """a, b: pairs of one bucket and two components that the bounds do not rule out.

    Of such a pair one at least is a stray, that is not of the component that holds most of its bucket, so only strays
    are compared with the others. A large bucket is dealt to salts, and its strays go to each of them.
    """
    held = rest.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("held"))
    buckets = held.groupBy("bucket").agg(
        F.max_by("component", F.struct("held", "component")).alias("main"),
        F.ceil(F.sum("held") / SALT_ROWS).alias("salts"),
    )
    rest = rest.join(buckets, "bucket").withColumn("stray", F.col("component") != F.col("main"))
    strays = rest.where("stray").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("salts") - 1)))
    x, y = strays.alias("x"), rest.withColumn("salt", F.pmod(F.xxhash64("node"), F.col("salts"))).alias("y")
    together = (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.salt") == F.col("y.salt"))
    is_open = (F.col("x.component") != F.col("y.component")) & (~F.col("y.stray") | (F.col("x.node") < F.col("y.node")))
    pairs = x.join(y, together & is_open & _may_be_alike("x", "y"))
    return pairs.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()


def groups(documents: DataFrame) -> DataFrame:
    """node, component: the digests of texts that are near duplicates of another text, by their group."""
    sketched = documents.select(digest("text").alias("node"), _hashed_words().alias("words")).where(F.size("words") > 0)
    sketches = F.pandas_udf(_sketches, ArrayType(LongType()))
    sketched = sketched.select("node", sketches("words").alias("buckets")).groupBy("node").agg(F.first("buckets").alias("buckets"))
    members = stage(sketched.select("node", F.explode("buckets").alias("bucket")), "sketches")
    sizes = members.groupBy("bucket").agg(F.min("node").alias("low"), F.count(F.lit(1)).alias("size"))
    members = stage(members.join(sizes.where(F.col("size") > 1), "bucket"), "buckets")
    met = members.groupBy("node").agg(F.sum("size").alias("met"))
    central = members.join(met, "node").groupBy("bucket").agg(F.max_by("node", F.struct("met", "node")).alias("central"))
    members = stage(members.join(central, "bucket"), "representatives")

    def with_end(end: str) -> DataFrame:
        others = members.where(F.col("node") != F.col(end))
        return others.select(F.least("node", end).alias("a"), F.greatest("node", end).alias("b"))

    texts = _texts(members.select("node").distinct(), documents)
    verified = _verified(with_end("low").union(with_end("central")).distinct(), texts)
    links = verified.where("linked").select("a", "b")
    found = components(links)

    # What the representatives have not brought together.
    grouped = members.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    split = grouped.groupBy("bucket").agg(F.min("component").alias("c_low"), F.max("component").alias("c_high"))
    split = split.where(F.col("c_low") != F.col("c_high")).select("bucket")
    rest = grouped.join(split, "bucket").where((F.col("node") != F.col("low")) & (F.col("node") != F.col("central")))
    far = verified.select("a", "b", (1 - F.col("jaccard")).alias("far"))
    for end in ("low", "central"):
        rest = (
            rest.withColumns({"a": F.least("node", end), "b": F.greatest("node", end)})
            .join(far, ["a", "b"])
            .drop("a", "b")
            .withColumnRenamed("far", f"far_{end}")
        )
    rest = stage(rest.select("bucket", "node", "component", "far_low", "far_central"), "open-buckets")
    outlined = F.pandas_udf(_outlines, _OUTLINE)
    outlines = texts.join(rest.select("node").distinct(), "node").select("node", outlined("words").alias("outline"))
    rest = rest.join(outlines.select("node", "outline.*"), "node")
    open_pairs = _open_pairs(stage(rest, "outlined"))
    more = _verified(open_pairs.join(far, ["a", "b"], "left_anti"), texts)
    if more.where("linked").isEmpty():
        return found
    return components(links.union(more.where("linked").select("a", "b")))


def classes(documents: DataFrame) -> DataFrame:
    """doc_id, class_id, n_copies, kept; one row for each row of `documents`.

    class_id is the smallest doc_id of the rows whose texts are equal or linked, directly or through others; null
    if no row of the class has an id. n_copies counts the rows of the class. `kept` marks one row of each class,
    that of the smallest doc_id, or all rows that repeat it exactly. A null text counts as an empty one; texts
    without words are near duplicates of equal texts only. Other columns are not read.
    """
    rows = documents.select("doc_id", digest("text").alias("node"))
    found = groups(documents)
    of_class = F.coalesce("component", "node")
    rows = rows.join(found, "node", "left").select("doc_id", "node", of_class.alias("class"))
    best = rows.groupBy("class").agg(
        F.min("doc_id").alias("class_id"),
        F.count(F.lit(1)).alias("n_copies"),
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "node")).alias("best"),
    )
    # Written by itself, so that the join with a hot class's rows can be split.
    best = stage(best, "classes")
    kept = F.col("best") == F.struct(F.col("doc_id").isNull(), "doc_id", "node")
    return rows.join(best, "class").select("doc_id", "node", "class_id", "n_copies", kept.alias("kept"))


def deduplicated(documents: DataFrame) -> DataFrame:
    """One row of `documents` for each class, with all its columns."""
    decided = classes(documents).where("kept").groupBy("node", "doc_id").agg(F.count(F.lit(1)).alias("__times"))
    decided = stage(decided.withColumnsRenamed({"node": "__node", "doc_id": "__id"}), "kept-rows")
    same = (digest("text") == F.col("__node")) & documents["doc_id"].eqNullSafe(F.col("__id"))
    joined = documents.join(decided, same)
    columns = documents.columns
    once = joined.where(F.col("__times") == 1).select(*[documents[c] for c in columns])
    # Rows that repeat a kept row exactly, by id and text: any of them stands for all.
    repeated = joined.where(F.col("__times") > 1).dropDuplicates(["__node", "__id"])
    return once.unionByName(repeated.select(*[F.col(f"`{c}`") for c in columns]))

"""A Merkle manifest of a dataset, and its verification by a recursive query.

Each row is a leaf. The leaves of a source, by document id, are a tree: runs of three nodes become their parent until
one node, the subroot, remains. The subroots, by source, are the leaves of one more tree, whose last node is the root.

Built levels are stored as node rows. A row holds a node `PAGE_LEVELS` levels above its lowest descendants, these
levels themselves, and which node of which row is its parent: a page of a tree, of at most 3^6 lowest nodes. So a tree
of any size has few rows above another, and no row is ever large. A Spark recursive query then climbs from every leaf:
each step joins the row that a node stands in, appends the siblings of its levels and folds the leaf's present digest
with them, up to the root. What it arrives at shows whether the row has been changed.

Every leaf of a tree passes the same few rows near the root. Those rows stand in `LANES` copies, and leaves are dealt
to the copies by their first page, so that no key of the join gathers a whole source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from opine.llm.common import small_side
from opine.session import stage

RUN, PAGE_LEVELS, LANES = 3, 6, 243
PAGE = RUN**PAGE_LEVELS
# Number of the tree over the subroots; sources count from 1.
TOP = 0
# Runs of one source in one range up to which they are sent to every executor (about 50 bytes each).
BROADCAST_RUNS = 200_000
ROW_LIMIT = "spark.sql.cteRecursionRowLimit"


# --- digests -----------------------------------------------------------------------------------


def sha256(value: Column) -> Column:
    """As 32 bytes, of a text or of bytes."""
    return F.unhex(F.sha2(value, 256))


def leaf(text: Column) -> Column:
    """The digest of a document, with `text` for its text: each value with its length in bytes, nulls as "-"."""

    def sized(value: Column) -> Column:
        as_text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(as_text).cast("string"), F.lit(":"), as_text), F.lit("-"))

    return sha256(F.concat(*[sized(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")], sized(text)))


def tampered() -> Column:
    """The text as it is found: where crc32 of the id is even, its line breaks are gone."""
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return F.when(even & F.contains("text", F.lit("\n")), F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))


def _parents(level: Column) -> Column:
    """The parents of an array of nodes, 32 bytes each."""
    none = F.lit(b"")

    def parent(nth: Column) -> Column:
        three = [F.coalesce(F.get(level, nth * RUN + k), none) for k in range(RUN)]
        return sha256(F.lower(F.hex(F.concat(*three))))

    return F.transform(F.sequence(F.lit(0), F.floor((F.size(level) - 1) / RUN).cast("int")), parent)


# --- building --------------------------------------------------------------------------------------


def numbered(rows: DataFrame, within: list[str], order: list[str]) -> DataFrame:
    """`rows` with `nth` (from 0) and `of`: the place of a row among those of equal `within`, and their number.

    Rows are sorted by ranges, and each range starts from what lies before it, so that no task needs all rows of a group.
    """
    dealt = rows.repartitionByRange(*within, *order).sortWithinPartitions(*within, *order)
    inside = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    held = stage(dealt.withColumn("__part", F.spark_partition_id()).withColumn("__at", inside), "numbered")
    runs = held.groupBy("__part", *within).agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__held"))
    group = Window.partitionBy(*within)  # as many rows as there are ranges
    before = F.sum("__held").over(group.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.withColumn("__before", F.coalesce(before, F.lit(0))).withColumn("of", F.sum("__held").over(group))
    runs = stage(runs, "numbered-runs")
    joined = held.join(small_side(runs, runs.count(), BROADCAST_RUNS), ["__part", *within])
    nth = F.col("__at") - F.col("__first") + F.col("__before")
    return joined.withColumn("nth", nth).select(*rows.columns, "nth", "of")


def _pages(nodes: DataFrame, tier: int) -> DataFrame:
    """tree, tier, page, levels, of: node rows over nodes (tree, nth, digest, of)."""
    lowest = F.sort_array(F.collect_list(F.struct("nth", "digest")))  # PAGE at most
    held = nodes.groupBy("tree", F.floor(F.col("nth") / PAGE).alias("page")).agg(lowest.alias("lowest"), F.max("of").alias("of"))
    first = F.array(F.transform("lowest", lambda node: node["digest"])).cast("array<array<binary>>")

    def one_more(levels: Column, _: Column) -> Column:
        last = F.element_at(levels, -1)
        return F.when((F.size(last) > 1) | (F.col("of") > PAGE), F.concat(levels, F.array(_parents(last)))).otherwise(levels)

    levels = F.aggregate(F.sequence(F.lit(1), F.lit(PAGE_LEVELS)), first, one_more)
    return held.select("tree", F.lit(tier).alias("tier"), "page", levels.alias("levels"), "of")


def _top_node() -> Column:
    return F.element_at(F.element_at("levels", -1), 1)


def built(nodes: DataFrame, most: int, purpose: str) -> list[DataFrame]:
    """Node rows tier by tier, over leaves (tree, nth, digest, of); `most` is the largest `of`."""
    tiers = []
    while True:
        tiers.append(stage(_pages(nodes, len(tiers)), f"{purpose}-{len(tiers)}"))
        if most <= PAGE:
            return tiers
        most = -(-most // PAGE)
        above = F.ceil(F.col("of") / PAGE).cast("bigint")
        nodes = tiers[-1].where(F.col("of") > PAGE).select("tree", F.col("page").alias("nth"), _top_node().alias("digest"), above.alias("of"))


def _linked(tiers: list[DataFrame], parent: Column) -> DataFrame:
    """Node rows with next_tree, next_tier, next_nth; `parent` is where the last node of a tree goes."""
    rows = tiers[0]
    for tier in tiers[1:]:
        rows = rows.unionByName(tier)
    inside = F.col("of") > PAGE
    return rows.select(
        "tree",
        "tier",
        "page",
        "levels",
        F.when(inside, F.col("tree")).otherwise(parent).alias("next_tree"),
        F.when(inside, F.col("tier") + 1).otherwise(0).alias("next_tier"),
        F.when(inside, F.col("page")).otherwise(F.when(parent.isNotNull(), F.col("tree") - 1)).alias("next_nth"),
    )


def manifest(documents: DataFrame, lanes: int = LANES) -> tuple[DataFrame, DataFrame]:
    """The leaves (doc_id, leaf, found, tree, nth) and the parent-linked node rows of a dataset; both are staged."""
    source = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))
    own = documents.select("doc_id", source.alias("source"), leaf(F.col("text")).alias("leaf"), leaf(tampered()).alias("found"))
    rows = numbered(own, ["source"], ["doc_id", "leaf"])
    rows = stage(rows, "merkle-rows")
    # One row for each source, in their order: the number of its tree.
    sources = rows.where(F.col("nth") == 0).select("source")
    trees = stage(numbered(sources, [], ["source"]).select("source", (F.col("nth") + 1).alias("tree")), "merkle-trees")
    n_trees, most = trees.count(), rows.agg(F.max("of")).first()[0] or 0
    leaves = rows.join(small_side(trees, n_trees, BROADCAST_RUNS), "source")
    leaves = stage(leaves.select("doc_id", "leaf", "found", "tree", "nth", "of"), "merkle-leaves")

    tiers = built(leaves.select("tree", "nth", F.col("leaf").alias("digest"), "of"), most, "merkle-nodes")
    subroots = [t.where(F.col("of") <= PAGE).select("tree", _top_node().alias("digest")) for t in tiers]
    roots = subroots[0]
    for more in subroots[1:]:
        roots = roots.unionByName(more)
    over = roots.select(
        F.lit(TOP).cast("bigint").alias("tree"), (F.col("tree") - 1).alias("nth"), "digest", F.lit(n_trees).cast("bigint").alias("of")
    )
    top = built(over, n_trees, "merkle-top")
    nodes = _linked(tiers, F.lit(TOP).cast("bigint")).unionByName(_linked(top, F.lit(None).cast("bigint")))
    first_pages = (F.col("tree") != TOP) & (F.col("tier") == 0)
    copies = F.when(first_pages, F.array(F.lit(-1))).otherwise(F.sequence(F.lit(0), F.lit(lanes - 1)))
    return leaves, stage(nodes.withColumn("lane", F.explode(copies)), "merkle-manifest")


# --- climbing -------------------------------------------------------------------------------------

# A node's siblings in its run of three: those before it and those after it.
_BEFORE = "concat(if(s.nth % 3 > 0, get(level, s.nth - s.nth % 3), X''), if(s.nth % 3 = 2, get(level, s.nth - 1), X''))"
_AFTER = (
    "concat(if(s.nth % 3 = 0, coalesce(get(level, s.nth + 1), X''), X''), "
    "if(s.nth % 3 < 2, coalesce(get(level, s.nth - s.nth % 3 + 2), X''), X''))"
)
CLIMB = f"""
WITH RECURSIVE climb(doc_id, leaf, tree, tier, nth, lane, folded, proof, subroot, root) AS (
    SELECT doc_id, leaf, tree, 0, nth, -1, found, X'', CAST(NULL AS BINARY), CAST(NULL AS BINARY) FROM {{leaves}}
    UNION ALL
    SELECT doc_id, leaf, next_tree, next_tier, next_nth, lane, step.folded,
           if(next_tree IS NULL, unhex(sha2(lower(hex(step.proof)), 256)), step.proof),
           if(next_tree = {TOP} AND tree <> {TOP}, node, subroot), if(next_tree IS NULL, node, root)
    FROM (
        SELECT c.doc_id, c.leaf, c.tree, c.subroot, c.root, p.next_tree, p.next_tier, p.next_nth,
               if(c.lane < 0, CAST(pmod(xxhash64(c.tree, p.page), {{lanes}}) AS INT), c.lane) AS lane,
               element_at(element_at(p.levels, -1), 1) AS node,
               aggregate(
                   slice(p.levels, 1, size(p.levels) - 1),
                   named_struct('nth', CAST(c.nth % {PAGE} AS INT), 'folded', c.folded, 'proof', c.proof),
                   (s, level) -> named_struct(
                       'nth', CAST(s.nth DIV 3 AS INT),
                       'folded', unhex(sha2(lower(hex(concat({_BEFORE}, s.folded, {_AFTER}))), 256)),
                       'proof', concat(s.proof, {_BEFORE}, {_AFTER})
                   )
               ) AS step
        FROM climb c JOIN {{nodes}} p
        ON p.tree = c.tree AND p.tier = c.tier AND p.page = c.nth DIV {PAGE} AND p.lane = c.lane
    )
)
SELECT doc_id, leaf, subroot, root, proof, folded FROM climb WHERE tree IS NULL
"""


def climbed(spark: SparkSession, leaves: DataFrame, nodes: DataFrame, lanes: int = LANES) -> DataFrame:
    """doc_id, leaf, subroot, root, proof (its sha256), folded; written before the session's row limit, which is lifted
    for this query only, holds again."""
    before = spark.conf.get(ROW_LIMIT, None)
    spark.conf.set(ROW_LIMIT, "-1")
    try:
        return stage(spark.sql(CLIMB, leaves=leaves, nodes=nodes, lanes=lanes), "merkle-climb")
    finally:
        if before is None:
            spark.conf.unset(ROW_LIMIT)
        else:
            spark.conf.set(ROW_LIMIT, before)


def verified(documents: DataFrame, lanes: int = LANES) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified; a row for each row of `documents`.

    Any column may be null: a null is "-" in a leaf, a null source is a source of its own and the first, a null id is
    the first of its source and never tampered with. Rows of one id stand by their leaves; equal rows are leaves of
    their own. A single row is leaf, subroot and root, and its proof is empty. Other columns are not read. An empty
    table has no root and gives no row.
    """
    leaves, nodes = manifest(documents, lanes)

    def text(column: str) -> Column:
        return F.lower(F.hex(column))

    return climbed(documents.sparkSession, leaves, nodes, lanes).select(
        "doc_id",
        text("leaf").alias("leaf"),
        text("subroot").alias("subroot"),
        text("root").alias("root"),
        text("proof").alias("proof_sha256"),
        text("folded").alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"),
    )

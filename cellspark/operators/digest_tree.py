"""Stored digest trees of copies: found differences level by level, read only what differs.

A copy is written once, merged, with its leaf: the range of tokens that a partition falls into. Its depth follows
the number of rows. Beside it lies the tree: a digest and a row count for every node of every level that is kept.
Two trees are compared from the top: only children of nodes that differ are looked at, so equal copies cost one row
and a few changed partitions cost their paths. Then only the folders of differing leaves are read, and in them
only the rows of those leaves are compared.

A digest is the XOR of row digests, so a tree follows changed rows without the others: what a row was goes out,
what it is comes in.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellspark.operators import replica
from cellspark.session import fresh_path
from cellspark.spec import TableSpec

ROWS_PER_LEAF = 64
DEEPEST = 24
STEP = 4  # levels of a binary tree between two that are kept
FOLDERS = 8  # bits of a leaf that name its folder, so 256 folders at most


def depth_for(n_rows: int, per_leaf: int = ROWS_PER_LEAF) -> int:
    """A depth at which a leaf holds about ``per_leaf`` rows, in whole steps."""
    need = math.ceil(math.log2(max(n_rows / per_leaf, 1)))
    return min(DEEPEST, -(-need // STEP) * STEP)


@dataclass(frozen=True)
class Copy:
    """A written copy: its rows by leaf, its tree, and the tree's depth."""

    rows: DataFrame
    tree: DataFrame
    depth: int
    path: str


def tree_of(leaves: DataFrame, depth: int) -> DataFrame:
    """The kept levels above (leaf, digest, n_rows), leaves among them."""
    at = F.explode(F.sequence(F.lit(0), F.lit(depth), F.lit(STEP))).alias("level")
    spread = leaves.select("*", at).withColumn("node", F.expr(f"shiftright(leaf, {depth} - level)"))
    return spread.groupBy("level", "node").agg(F.bit_xor("digest").alias("digest"), F.sum("n_rows").alias("n_rows"))


def store(state: DataFrame, spec: TableSpec, depth: int, method: str = "xxhash64") -> Copy:
    """Write a copy's state with its leaves, and its tree. The state is computed once."""
    spark, path = state.sparkSession, fresh_path(state.sparkSession, "copy")
    top = F.expr(f"shiftright(leaf, {max(depth - FOLDERS, 0)})")
    laid = state.select("*", replica.leaf_of(spec, depth, method).alias("leaf"), replica.row_hash(state, method).alias("row_digest"))
    laid.withColumn("folder", top).repartitionByRange("folder", "leaf", *spec.ck).write.partitionBy("folder").parquet(f"{path}/rows")
    schema = laid.withColumn("folder", F.lit(0).cast("bigint")).schema
    rows = spark.read.schema(schema).parquet(f"{path}/rows")
    leaves = rows.groupBy("leaf").agg(F.bit_xor("row_digest").alias("digest"), F.count(F.lit(1)).alias("n_rows"))
    tree_of(leaves, depth).write.partitionBy("level").parquet(f"{path}/tree")
    return Copy(rows, _read_tree(spark, f"{path}/tree"), depth, path)


def _read_tree(spark, path: str) -> DataFrame:
    return spark.read.schema("node bigint, digest bigint, n_rows bigint, level int").parquet(path)


def update(copy: Copy, old: DataFrame, new: DataFrame, spec: TableSpec, method: str = "xxhash64") -> DataFrame:
    """The tree after the rows ``old`` have become ``new`` (states of changed keys only; a new row has no old one)."""
    def signed(df: DataFrame, sign: int) -> DataFrame:
        leaf, h = replica.leaf_of(spec, copy.depth, method), replica.row_hash(df, method)
        return df.select(leaf.alias("leaf"), h.alias("digest"), F.lit(sign).cast("bigint").alias("n_rows"))

    moved = tree_of(signed(old, -1).unionByName(signed(new, 1)), copy.depth)
    both = copy.tree.select("level", "node", "digest", "n_rows").unionByName(moved.select("level", "node", "digest", "n_rows"))
    return both.groupBy("level", "node").agg(F.bit_xor("digest").alias("digest"), F.sum("n_rows").alias("n_rows")).filter("n_rows > 0")


def descend(a: DataFrame, b: DataFrame, depth: int) -> DataFrame:
    """The leaves at which two trees differ, by looking only below nodes that do."""
    open_ = None
    for level in range(0, depth + 1, STEP):
        sides = []
        for tree, name in ((a, "a"), (b, "b")):
            nodes = tree.filter(F.col("level") == level).select("node", F.struct("digest", "n_rows").alias(name))
            if open_ is not None:
                nodes = nodes.withColumn("above", F.expr(f"shiftright(node, {STEP})")).join(open_, "above", "left_semi")
            sides.append(nodes.select("node", name))
        differing = sides[0].join(sides[1], "node", "full").filter(~F.col("a").eqNullSafe(F.col("b")))
        if level == 0 and differing.isEmpty():
            break
        open_ = differing.select(F.col("node").alias("above"))
    return differing.select(F.col("node").alias("leaf"))


def differing_rows(a: Copy, b: Copy) -> tuple[DataFrame, DataFrame]:
    """The rows of both copies in leaves that differ; only the folders that hold such leaves are read."""
    leaves = descend(a.tree, b.tree, a.depth)
    top = F.expr(f"shiftright(leaf, {max(a.depth - FOLDERS, 0)})")
    folders = [r[0] for r in leaves.select(top).distinct().collect()]  # 2 ** FOLDERS at most
    pick = lambda copy: copy.rows.filter(F.col("folder").isin(folders)).join(leaves, "leaf", "left_semi")
    return pick(a), pick(b)


def repair(a: Copy, b: Copy, spec: TableSpec) -> DataFrame:
    """State rows that each side has to apply (``target`` a or b) so that both end equal."""
    if a.depth != b.depth:
        raise ValueError("both copies need trees of one depth")
    pieces = ["_live", "_del", *spec.regular]
    left, right = (rows.select(*spec.key, *pieces) for rows in differing_rows(a, b))
    return replica.diff({"a": left, "b": right}, spec).select(F.col("source").alias("target"), *spec.key, *pieces)

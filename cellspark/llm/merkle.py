"""Merkle manifest of a dataset, and a recursive query that climbs it from every leaf.

Leaves are SHA-256 digests of the rows. Those of one language, in order of their ids, form a tree: each two
consecutive nodes become their hash until one is left, the language's subroot. The subroots, in order of
language, form the tree above them, whose last node is the root.

The built tree is stored as node rows linked to their parents. To keep the climb short, a node row
spans ``LEVELS`` levels: it holds the siblings between the node and its ancestor that many levels up, which
is the row that ``parent_*`` names. A run of ``2 ** LEVELS`` nodes, never more, is hashed in one group.
The climb is a Spark recursive query: from its leaf each document ascends from row to row, folds its digest
with the siblings found there and appends them, as one row a step, until a row has no parent. So a step
carries its own siblings only, and they are put together once. The last stored levels, at most
``FEW`` rows, are broadcast; a climb through larger ones is a join by a shuffle, where a node's key
is shared by the leaves below it only.

Rows are documents of their own, whatever ids they repeat: ties of a language and id are in order of the leaf
digest, and equal leaves in that of the stored rows. Null ids come first and are not tampered with. Null columns
hash as ``-``, an empty text as ``0:``. A text of any length is hashed whole. A table with one row has its leaf as
root and an empty proof; an empty table gives no rows. Extra columns are left out.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellspark.llm.ranks import ranked
from cellspark.session import materialize

LEVELS = 8
FEW = 4096
TOP = ""  # the tree of subroots; those of languages are named "-" (null) or "=" and the language, which sorts as they do

#: ``siblings``: 32 bytes each. ``sides``, a letter a level: < sibling before the node, > after it, - none.
NODE = "tree string, height int, idx long, digest binary, siblings binary, sides string, parent_tree string, parent_height int, parent_idx long, top binary, n long"
PARENT = ["parent_tree", "parent_height", "parent_idx"]


def field(value: Column) -> Column:
    shown = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(shown).cast("string"), F.lit(":"), shown), F.lit("-"))


def leaf_digest(n_chars: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*[field(c) for c in (F.col("doc_id"), F.col("source"), F.col("lang"), n_chars, F.col("text"))]), 256))


def tampered_with(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 7 == 0, F.lit(False))


def leaves(df: DataFrame) -> DataFrame:
    """(tree, doc_id, digest, start): the leaf, and the one that the climb starts from if that is another."""
    n = F.col("n_chars").cast("decimal(20,0)")
    rows = df.select("doc_id", "source", "lang", "n_chars", "text")
    tree = F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit("-"))
    start = F.when(tampered_with(F.col("doc_id")), leaf_digest(n + 1))
    return rows.select(tree.alias("tree"), F.col("doc_id").cast("long"), leaf_digest(n).alias("digest"), start.alias("start"))


def joined(nodes: list[bytes]) -> bytes:
    """Hash of the nodes' hexadecimal texts."""
    return hashlib.sha256("".join(x.hex() for x in nodes).encode()).digest()


def climb_run(digests: list[bytes], levels: int) -> tuple[list[bytes], list[str], bytes]:
    """Siblings and sides of each node of a run through the next ``levels`` levels, and the node they end in."""
    siblings: list[list[bytes]] = [[] for _ in digests]
    sides = [""] * len(digests)
    for level in range(levels):
        for at in range(len(sides)):
            own = at >> level
            other = own ^ 1
            if other < len(digests):
                siblings[at].append(digests[other])
                sides[at] += "<" if other < own else ">"
            else:
                sides[at] += "-"
        digests = [joined(digests[k : k + 2]) for k in range(0, len(digests), 2)]
    return [b"".join(x) for x in siblings], sides, digests[0]


def stored_level(nodes: DataFrame, height: int, levels: int, extra: str = "") -> DataFrame:
    """Node rows of (tree, idx, n, digest): one group of at most ``2 ** levels`` nodes each; ``top`` is set in a run's first row.

    A run that holds all nodes of its tree ends in the tree's last node.
    """
    carried = [c.split()[0] for c in extra.split(",") if c]
    names = [c.split()[0] for c in NODE.split(", ")]

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("idx")
        tree, n = table["tree"][0].as_py(), table["n"][0].as_py()
        size, whole = table.num_rows, n <= 1 << levels
        siblings, sides, top = climb_run(table["digest"].to_pylist(), (n - 1).bit_length() if whole else levels)
        parent = (None, None, None) if whole else (tree, height + levels, table["idx"][0].as_py() >> levels)
        columns = [
            table["tree"], pa.array([height] * size, pa.int32()), table["idx"], table["digest"], pa.array(siblings, pa.binary()),
            pa.array(sides, pa.string()), pa.array([parent[0]] * size, pa.string()), pa.array([parent[1]] * size, pa.int32()),
            pa.array([parent[2]] * size, pa.int64()), pa.array([top] + [None] * (size - 1), pa.binary()), table["n"]]
        return pa.table(columns + [table[c] for c in carried], names=names + carried)

    grouped = nodes.withColumn("run", F.shiftright("idx", levels)).groupBy("tree", "run")
    return grouped.applyInArrow(run, NODE + (f", {extra}" if extra else ""))


def build(leaf_rows: DataFrame, levels: int, extra: str = "") -> tuple[list[DataFrame], DataFrame]:
    """The written levels of every tree of (tree, idx, n, digest), and (tree, top): what remains of each."""
    stored, tops, nodes, height = [], [], leaf_rows, 0
    while True:
        level = materialize(stored_level(nodes, height, levels, "" if height else extra), "nodes")
        stored.append(level)
        firsts = level.filter("top is not null")
        tops.append(firsts.filter("parent_tree is null").select("tree", "top"))
        nodes = firsts.filter("parent_tree is not null").select(
            "tree", F.col("parent_idx").alias("idx"), F.ceil(F.col("n") / (1 << levels)).alias("n"), F.col("top").alias("digest"))
        if nodes.isEmpty():
            break
        height += levels
    return stored, reduce(DataFrame.union, tops)


def fold(digest: str, node: str) -> str:
    """SQL that hashes a digest with the siblings of a node row, level by level."""
    other = f"lower(hex(substring({node}.siblings, acc.at + 1, 32)))"
    step = f"""CASE substring({node}.sides, k, 1)
      WHEN '<' THEN struct(sha2(concat({other}, acc.own), 256) AS own, acc.at + 32 AS at)
      WHEN '>' THEN struct(sha2(concat(acc.own, {other}), 256) AS own, acc.at + 32 AS at)
      ELSE struct(sha2(acc.own, 256) AS own, acc.at AS at) END"""
    every = f"slice(sequence(1, length({node}.sides) + 1), 1, length({node}.sides))"
    return f"unhex(aggregate({every}, struct(lower(hex({digest})) AS own, 0 AS at), (acc, k) -> {step}, acc -> acc.own))"


def climb(start: str, nodes: str, hint: str) -> str:
    """The recursive query from ``start`` through ``nodes``: a row for each step of each leaf, and the rows of ``start``."""
    return f"""
    WITH RECURSIVE climb AS (
      SELECT tree, idx, step, folded, CAST(NULL AS BINARY) AS siblings, CAST(NULL AS BINARY) AS subroot, parent_tree, parent_height, parent_idx FROM {start}
      UNION ALL
      SELECT {hint} c.tree, c.idx, c.step + 1, {fold('c.folded', 'n')}, n.siblings,
        IF(n.tree = '{TOP}' AND n.height = 0, n.digest, NULL), n.parent_tree, n.parent_height, n.parent_idx
      FROM climb c JOIN {nodes} n
        ON n.tree = c.parent_tree AND n.height = c.parent_height AND n.idx = c.parent_idx)
    SELECT * FROM climb LIMIT ALL"""


def manifest(df: DataFrame, levels: int = LEVELS, few: int = FEW) -> DataFrame:
    """One row per row of ``df``: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified."""
    spark = df.sparkSession
    stored, subroots = build(ranked(leaves(df), "tree", ["doc_id", "digest"]), levels, "doc_id long, start binary")
    top_leaves = ranked(subroots.select(F.lit(TOP).alias("of"), "tree", F.col("top").alias("digest")), "of", ["tree"])
    top_leaves = materialize(top_leaves, "subroots")
    above, roots = build(top_leaves.select(F.col("of").alias("tree"), "idx", "n", "digest"), levels)
    root = roots.select(F.lower(F.hex("top"))).first()
    root = F.lit(root[0] if root else None)

    # What remains of a language's tree goes on in the tree of subroots.
    link = top_leaves.select("tree", F.lit(TOP).alias("up_tree"), F.lit(0).alias("up_height"), F.col("idx").alias("up_idx"))

    def linked(level: DataFrame) -> DataFrame:
        inner, last = level.filter("parent_tree is not null"), level.filter("parent_tree is null").drop(*PARENT)
        last = last.join(link, "tree").withColumnsRenamed({f"up_{c}": f"parent_{c}" for c in ("tree", "height", "idx")})
        return inner.unionByName(last).drop("top", "n")

    levels_above = [linked(level) for level in stored[1:]] + [level.drop("top", "n") for level in above]
    sizes = [level.count() for level in levels_above]
    # Stored levels from the top down while they are few rows together.
    kept = len(sizes)
    while kept and sum(sizes[kept - 1 :]) <= few:
        kept -= 1

    bottom = linked(stored[0]).alias("b").selectExpr(
        "tree", "idx", "0 AS step", f"{fold('coalesce(b.start, b.digest)', 'b')} AS folded", "siblings", "CAST(NULL AS BINARY) AS subroot",
        *PARENT, "doc_id", "digest AS leaf")
    steps, current = [bottom], bottom
    for part, hint in ((levels_above[:kept], ""), (levels_above[kept:], "/*+ BROADCAST(n) */")):
        if not part:
            continue
        nodes = materialize(reduce(DataFrame.unionByName, part), "above")
        reached = spark.sql(climb("{start}", "{nodes}", hint), start=current, nodes=nodes)
        if not hint:
            reached = materialize(reached, "climb")
        steps.append(reached.filter("siblings is not null"))
        at = nodes.select(F.col("tree").alias("parent_tree"), F.col("height").alias("parent_height"), F.col("idx").alias("parent_idx"))
        # Rows whose parent lies in the next part go on there.
        current = reached.join(at, PARENT, "left_anti").select(reached.columns)
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), steps)
    proof = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("step", "siblings"))), lambda s: F.lower(F.hex(s["siblings"]))), "")
    shown = lambda c: F.lower(F.hex(c))
    found = every.groupBy("tree", "idx").agg(
        F.max("doc_id").alias("doc_id"), shown(F.max("leaf")).alias("leaf"), shown(F.max("subroot")).alias("subroot"), root.alias("root"),
        F.sha2(proof, 256).alias("proof_sha256"), shown(F.max_by("folded", "step")).alias("folded_root"))
    return found.drop("tree", "idx").withColumn("verified", F.col("folded_root") == root)

"""Copies of a table: difference, digests, repair and read resolution."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellspark.operators import reconcile as rec
from cellspark.spec import TableSpec


def diff(copies: dict[str, DataFrame], spec: TableSpec) -> DataFrame:
    """Where each copy differs from the merge of all copies.

    Copies are states. One aggregate over the union gives the merged row and every copy's
    own row side by side; rows come out per copy that lacks something: ``missing`` (no row
    at all), ``stale`` (names of older or absent cells) and the merged state.
    """
    parts = [df.withColumn("_source", F.lit(name)) for name, df in copies.items()]
    union = reduce(lambda a, b: a.unionByName(b), parts)
    pieces = ["_live", "_del", *spec.regular]
    version = F.struct(*pieces)
    per_copy = [F.max(F.when(F.col("_source") == n, version)).alias(f"_of_{i}")
                for i, n in enumerate(copies)]
    grouped = union.groupBy(*spec.key).agg(*[F.max(p).alias(p) for p in pieces], *per_copy)

    def report(i: int, name: str) -> Column:
        own = F.col(f"_of_{i}")
        stale = F.array_compact(F.array(*[
            F.when(~F.col(p).eqNullSafe(own[p]), F.lit(p)) for p in pieces]))
        return F.struct(F.lit(name).alias("source"), own.isNull().alias("missing"), stale.alias("stale"))

    reports = F.array(*[report(i, n) for i, n in enumerate(copies)])
    return (grouped.withColumn("_r", F.explode(reports)).filter(F.size("_r.stale") > 0)
            .select(*spec.key, "_r.source", "_r.missing", "_r.stale", *pieces))


def row_hash(df: DataFrame, method: str = "xxhash64") -> Column:
    """A 64-bit (or 60-bit md5) digest of all columns in name order."""
    names = sorted(df.columns)
    if method == "xxhash64":
        # xxhash64 skips nulls, so a value that moves to a null neighbour needs the flags to show.
        return F.xxhash64(*[x for n in names for x in (F.col(n).isNull(), F.col(n))])
    text = F.concat_ws("|", *[F.coalesce(F.col(n).cast("string"), F.lit("\\N")) for n in names])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def leaf_of(spec: TableSpec, depth: int, method: str = "xxhash64") -> Column:
    """The token range (0 … 2^depth − 1) a partition falls into."""
    if depth == 0:
        return F.lit(0).cast("bigint")
    if method == "xxhash64":
        return F.shiftrightunsigned(F.xxhash64(*spec.pk), 64 - depth)
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in spec.pk])
    return F.shiftright(F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint"), 60 - depth)


def digest(df: DataFrame, spec: TableSpec, depth: int, method: str = "xxhash64",
           size: Column | None = None) -> DataFrame:
    """Hash tree leaves: combined row digest, row count and bytes per token range.

    XOR combines in any order, so leaves are aggregated map-side and never sorted. The
    count keeps pairs of equal rows visible.
    """
    h = row_hash(df, method)
    amount = size if size is not None else F.lit(0)
    return df.groupBy(leaf_of(spec, depth, method).alias("leaf")).agg(
        F.bit_xor(h).alias("digest"), F.count(F.lit(1)).alias("n_rows"), F.sum(amount).alias("n_bytes"))


def levels(leaves: DataFrame, depth: int) -> DataFrame:
    """Inner nodes of the hash tree, level 0 being the root."""
    at = F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("level")
    spread = leaves.select("*", at)
    node = F.expr(f"shiftright(leaf, {depth} - level)")
    return spread.groupBy("level", node.alias("node")).agg(
        F.bit_xor("digest").alias("digest"), F.sum("n_rows").alias("n_rows"), F.sum("n_bytes").alias("n_bytes"))


def differing_leaves(a: DataFrame, b: DataFrame) -> DataFrame:
    """Token ranges whose digests or counts differ (absent counts as different)."""
    left = a.select("leaf", F.struct("digest", "n_rows").alias("a"))
    right = b.select("leaf", F.struct("digest", "n_rows").alias("b"))
    return left.join(right, "leaf", "full").filter(~F.col("a").eqNullSafe(F.col("b"))).select("leaf")


def differing_ranges(leaves: DataFrame, depth: int, split: int = 4) -> DataFrame:
    """Runs of adjacent differing leaves, not crossing the 2^split top-level ranges."""
    top = F.shiftright("leaf", max(depth - split, 0)).alias("top")
    w = Window.partitionBy("top").orderBy("leaf")
    runs = leaves.select("leaf", top).withColumn("run", F.col("leaf") - F.row_number().over(w))
    return runs.groupBy("top", "run").agg(F.min("leaf").alias("first_leaf"),
                                          F.max("leaf").alias("last_leaf")).select("first_leaf", "last_leaf")


def repair(a: DataFrame, b: DataFrame, spec: TableSpec, depth: int = 15) -> DataFrame:
    """State rows each side has to apply (``target`` a or b) so that both end equal.

    Only token ranges whose digests differ are compared row by row.
    """
    # a row digest over the state structs; maps never occur there
    differing = differing_leaves(digest(a, spec, depth), digest(b, spec, depth))
    pick = lambda df: df.withColumn("leaf", leaf_of(spec, depth)).join(
        differing, "leaf", "left_semi").drop("leaf")
    return diff({"a": pick(a), "b": pick(b)}, spec).select(
        F.col("source").alias("target"), *spec.key, "_live", "_del", *spec.regular)


def resolve(copies: list[DataFrame], spec: TableSpec, where: Column | None = None,
            order: list[Column] | None = None, limit: int | None = None) -> DataFrame:
    """Read over several copies: merge first, then filter, then limit.

    Filtering a copy before the merge could let an outdated value match, so the predicate
    stays above the merge; predicates on key columns are pushed down by Spark itself.
    """
    live = rec.live_rows(rec.merge_copies(copies, spec), spec)
    if where is not None:
        live = live.filter(where)
    if limit is None:
        return live
    return (live.orderBy(*(order or [F.col(c) for c in spec.key]))).limit(limit)


def same_digest(copies: dict[str, DataFrame], spec: TableSpec) -> DataFrame:
    """One digest row per copy, and whether all copies agree."""
    parts = [digest(df, spec, 0).select(F.lit(name).alias("source"), "digest", "n_rows")
             for name, df in copies.items()]
    each = reduce(lambda x, y: x.unionByName(y), parts)
    # as many rows as copies
    every = Window.partitionBy()
    agree = [F.min(c).over(every) == F.max(c).over(every) for c in ("digest", "n_rows")]
    return each.withColumn("same", agree[0] & agree[1])

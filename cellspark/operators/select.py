"""Projection, ordering, limits and paging over live rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellspark.functions import jsonfn
from cellspark.functions.token import token as token_of
from cellspark.session import materialize, tasks_for
from cellspark.spec import TableSpec


def star(df: DataFrame, spec: TableSpec) -> DataFrame:
    """``SELECT *``: partition key, clustering, static, then regular columns."""
    return df.select(*[c for c in spec.columns if c in df.columns])


def constant(value, kind: str) -> Column:
    return F.lit(value).cast(kind)


def ttl_left(expires_at: Column, now: int) -> Column:
    """Seconds a cell has left, null if it does not expire or has expired."""
    return F.when(expires_at >= now, (expires_at - now).cast("int"))


def select_json(df: DataFrame, columns: list[str] | None = None, name: str = "json") -> DataFrame:
    return df.select(jsonfn.row_json(df, columns).alias(name))


def distinct_partitions(df: DataFrame, spec: TableSpec, statics: list[str] | None = None) -> DataFrame:
    """``SELECT DISTINCT``: partition keys (and statics) only."""
    return df.select(*spec.pk, *(statics or [])).distinct()


def with_statics(rows: DataFrame, statics: DataFrame, spec: TableSpec,
                 static_only: bool = True) -> DataFrame:
    """Show the statics of a partition on each of its rows.

    A partition with statics only gives one row with nulls, unless the query restricts
    clustering or regular columns (``static_only=False``). Written as a left join plus an
    anti join: a hot partition is then on the side Spark can split.
    """
    shown = [c for c in statics.columns if c not in spec.pk]
    joined = rows.join(statics, spec.pk, "left")
    order = spec.pk + [c for c in spec.ck if c in rows.columns] + shown + [
        c for c in rows.columns if c not in spec.key]
    joined = joined.select(*order)
    if not static_only:
        return joined
    alone = statics.join(rows.select(*spec.pk).distinct(), spec.pk, "left_anti")
    nulls = [F.lit(None).cast(rows.schema[c].dataType).alias(c)
             for c in rows.columns if c not in spec.pk]
    return joined.unionByName(alone.select(*spec.pk, *shown, *nulls))


def first_row(spec: TableSpec, columns: list[str], reverse: bool = False,
              group: list[str] | None = None) -> dict[str, Column]:
    """Aggregates giving each column's value in the first row of the group (clustering order)."""
    pick = pick_row(spec, columns, reverse, group)
    return {c: pick[c].alias(c) for c in columns}


def pick_row(spec: TableSpec, columns: list[str], reverse: bool = False,
             group: list[str] | None = None) -> Column:
    """One aggregate holding ``columns`` of the group's first row as a struct."""
    payload = F.struct(*[F.col(c).alias(c) for c in columns])
    directions = {(d == "asc") != reverse for _, d in spec.clustering}
    # columns of the group are the same in all its rows
    rest = [c for c in spec.key if c not in (group or spec.pk)]
    key = F.struct(*[F.col(c) for c in rest or spec.key])
    if len(directions) > 1:
        raise ValueError("first_row needs one clustering direction; use first_row_mixed")
    ascending = next(iter(directions), True)
    return F.min_by(payload, key) if ascending else F.max_by(payload, key)


def first_row_mixed(df: DataFrame, spec: TableSpec, group: list[str]) -> DataFrame:
    """First row of each group when clustering directions are mixed.

    The ranking keeps one row per group and task before the shuffle.
    """
    order = [F.col(c).asc() for c in spec.pk if c not in group] + spec.clustering_order()
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def order_rows(df: DataFrame, spec: TableSpec, reverse: bool = False,
               by_partition: bool = False) -> DataFrame:
    """Clustering order, or its reverse; over several partitions the result is sorted globally."""
    lead = [F.col(c) for c in spec.pk] if by_partition else []
    return df.orderBy(*lead, *spec.clustering_order(reverse))


def cluster_locally(df: DataFrame, spec: TableSpec, reverse: bool = False) -> DataFrame:
    """Partition-local clustering order: one shuffle by key, no global sort."""
    token = F.xxhash64(*spec.pk)
    order = [token, *[F.col(c) for c in spec.pk], *spec.clustering_order(reverse)]
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def limit_rows(df: DataFrame, n: int, order: list[Column] | None = None) -> DataFrame:
    return (df.orderBy(*order) if order else df).limit(n)


def per_partition_limit(df: DataFrame, spec: TableSpec, n: int, reverse: bool = False,
                        partition: list[str] | None = None,
                        order: list[Column] | None = None) -> DataFrame:
    """The first ``n`` rows of each partition in clustering order.

    Spark turns the rank filter into a group limit, which keeps at most ``n`` rows per
    partition in every task before anything is shuffled.
    """
    window = Window.partitionBy(*(partition or spec.pk)).orderBy(
        *(order or spec.clustering_order(reverse)))
    return df.withColumn("_rank", F.row_number().over(window)).filter(
        F.col("_rank") <= n).drop("_rank")


def latest_per_partition(df: DataFrame, spec: TableSpec, columns: list[str]) -> DataFrame:
    """The last row of each partition in clustering order, without a sort."""
    if spec.mixed_order:
        raise ValueError("use per_partition_limit for mixed clustering directions")
    ascending = all(d == "asc" for _, d in spec.clustering)
    key = F.struct(*[F.col(c) for c in spec.ck])
    payload = F.struct(*[F.col(c) for c in columns if c not in spec.pk])
    chosen = (F.max_by if ascending else F.min_by)(payload, key)
    return df.groupBy(*spec.pk).agg(chosen.alias("_last")).select(*spec.pk, "_last.*")


def page(df: DataFrame, spec: TableSpec, size: int, after: tuple | None = None,
         per_partition: int | None = None) -> DataFrame:
    """One page in (token, partition key, clustering) order.

    ``after`` is the (token, pk…, ck…) of the last row of the previous page. The filter is a
    keyset comparison, so a page never re-reads the pages before it into the sort. A table
    that stores its token (``bulk_write(keep_token=True)``) also skips their files.
    """
    names = ["_token", *spec.key]
    rows = df if "_token" in df.columns else df.withColumn("_token", token_of(spec.pk))
    if per_partition is not None:
        rows = per_partition_limit(rows, spec, per_partition)
    order = [F.col("_token"), *[F.col(c) for c in spec.pk], *spec.clustering_order()]
    if after is not None:
        rows = rows.filter(after_key(names, after, spec))
    return rows.orderBy(*order).limit(size)


def large_page(df: DataFrame, spec: TableSpec, size: int, after: tuple | None = None,
               per_partition: int | None = None) -> tuple[DataFrame, int]:
    """The rows of ``page`` in no order, and their number, for pages that are too large for one task.

    Ranges of the token are counted, and rows beyond the one that the page ends in are left out. The others are dealt to
    range partitions by token, key and clustering columns, so that a hot partition spreads. All before the
    last are whole; only the last is cut in one task.
    """
    rows = df if "_token" in df.columns else df.withColumn("_token", token_of(spec.pk))
    if per_partition is not None:
        rows = per_partition_limit(rows, spec, per_partition)
    if after is not None:
        rows = rows.filter(after_key(["_token", *spec.key], after, spec))
    top = F.shiftright("_token", 54)

    def until(counts: list[tuple[int, int]], size: int) -> tuple[int, int, int]:
        """(the place where the page ends, rows before it, rows with it)."""
        before = 0
        for at, n in sorted(counts):
            if before + n >= size:
                return at, before, before + n
            before += n
        return sorted(counts)[-1][0], before, before

    ranges = [(r["at"], r["n"]) for r in rows.groupBy(top.alias("at")).agg(F.count(F.lit(1)).alias("n")).collect()]  # <= 1024 rows
    if not ranges:
        return rows, 0
    end, _, total = until(ranges, size)
    tasks = tasks_for(df.sparkSession, total)
    order = [F.col("_token"), *[F.col(c) for c in spec.pk], *spec.clustering_order()]
    laid = rows.filter(top <= end).repartitionByRange(tasks, *order).withColumn("_piece", F.spark_partition_id())
    laid = materialize(laid, "page")
    if total <= size:
        return laid.drop("_piece"), total
    pieces = [(r["_piece"], r["count"]) for r in laid.groupBy("_piece").count().collect()]  # <= tasks rows
    cut, before, _ = until(pieces, size)
    last = laid.filter(F.col("_piece") == cut).orderBy(*order).limit(size - before)
    return laid.filter(F.col("_piece") < cut).unionByName(materialize(last, "page")).drop("_piece"), size


def after_key(names: list[str], last: tuple, spec: TableSpec) -> Column:
    down = {c for c, d in spec.clustering if d == "desc"}
    result = F.lit(False)
    for name, value in reversed(list(zip(names, last, strict=True))):
        v = F.lit(value)
        beyond = F.col(name) < v if name in down else F.col(name) > v
        result = beyond | ((F.col(name) == v) & result)
    return (F.col(names[0]) >= F.lit(last[0])) & result


def resume_state(page_rows: DataFrame, spec: TableSpec) -> DataFrame:
    """The one-row (token, pk…, ck…) that the next page starts after."""
    names = ["_token", *spec.key]
    order = [F.col("_token"), *[F.col(c) for c in spec.pk], *spec.clustering_order()]
    flipped = Window.orderBy(*order)
    # a page is as small as the caller's page size
    last = page_rows.select(*names, F.row_number().over(flipped).alias("_n"),
                            F.count(F.lit(1)).over(Window.partitionBy()).alias("_all"))
    return last.filter("_n = _all").select(*names)


def top_partitions(df: DataFrame, spec: TableSpec, k: int, weight: Column | None = None) -> DataFrame:
    """The ``k`` partitions with the most rows (or the most ``weight``), exactly."""
    amount = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return df.groupBy(*spec.pk).agg(amount.alias("n")).orderBy(
        F.col("n").desc(), *[F.col(c) for c in spec.pk]).limit(k)


def top_partitions_sketch(df: DataFrame, column: str, k: int, tracked: int = 10000) -> DataFrame:
    """Approximate top partitions and cardinality in one pass over a single key column."""
    return df.agg(
        F.call_function("approx_top_k", F.col(column), F.lit(k), F.lit(tracked)).alias("top"),
        F.approx_count_distinct(column).alias("cardinality"),
    ).select(F.explode("top").alias("t"), "cardinality").select(
        F.col("t.item").alias(column), F.col("t.count").alias("n"), "cardinality")

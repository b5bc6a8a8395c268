"""Ranks of rows within groups of any size, and lookups by keys that may be hot; no group meets in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellspark.session import materialize


def ranked(df: DataFrame, group: str, order: list[str], rank: str = "idx", size: str = "n") -> DataFrame:
    """Append each row's place within its ``group`` (from 0, by ``order``, nulls first) and the group's row count.

    A range shuffle sorts all rows, so a hot group lies in many partitions; each partition's count per group
    gives where its rows begin. Rows that tie in ``order`` are told apart by their place in the written input.
    """
    named = materialize(df.withColumn("__row", F.monotonically_increasing_id()), "unranked")
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [group, *order, "__row"]
    placed = named.repartitionByRange(partitions, *by).sortWithinPartitions(*by).withColumn("__at", F.monotonically_increasing_id())
    placed = materialize(placed.withColumn("__part", F.shiftright("__at", 33)), "sorted")
    # One row for each group of a partition: about as many as partitions and groups together.
    runs = placed.groupBy(group, "__part").agg(F.min("__at").alias("__first"), F.count("*").alias("__count"))
    before = Window.partitionBy(group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        group, "__part", "__first", F.coalesce(F.sum("__count").over(before), F.lit(0)).alias("__before"),
        F.sum("__count").over(Window.partitionBy(group)).alias(size))
    found = placed.join(runs, [group, "__part"]).withColumn(rank, F.col("__before") + F.col("__at") - F.col("__first"))
    return found.drop("__row", "__at", "__part", "__first", "__before")


def lookup(df: DataFrame, table: DataFrame, key: str, shares: int = 1000) -> DataFrame:
    """``df`` with the columns that ``table`` (one row a key, every key of ``df``) has for its ``key``.

    A key that holds over one part in ``shares`` of the rows is hot. There are fewer than ``shares`` such keys,
    so their rows of ``table`` are broadcast whatever the size of ``df``; the other rows are joined by a shuffle.
    """
    n = df.count()
    hot = materialize(df.groupBy(key).count().filter(F.col("count") * shares > n).select(key), "hot")
    few = F.broadcast(materialize(table.join(F.broadcast(hot), key, "left_semi"), "hot-rows"))
    rest = df.join(F.broadcast(hot), key, "left_anti").join(table, key)
    return df.join(few, key).unionByName(rest)

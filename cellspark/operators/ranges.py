"""Range deletions on any prefix of the clustering key, by a sweep over sorted rows and bounds.

A range begins and ends at a prefix of the clustering key: ``c1 = 5 AND c2 > 3`` begins after (5, 3) and ends
after (5). Rows and bounds get one position, a struct that sorts as they lie in the partition, and are sorted together.
Going through them in order, a row is covered by the newest of the ranges that are open.

Partitions are dealt to tasks by their key, each to one of them. Only those with more events than a task should sort
are sorted by a range shuffle instead, so that a hot partition, or values that lie close together but for one, spread
over pieces of equal size. What is open where a piece begins: a range that ends in a later piece than it begins in is sent to the piece where it
ends, once; pieces that it covers from end to end take its time from a tree over the pieces, in which
any run of pieces is at most two nodes a level. So neither rows times ranges nor pieces times ranges are made.
A task holds the ranges that are open at a time, not the piece.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellspark.session import TASK_ROWS, materialize, tasks_for
from cellspark.spec import TableSpec

BEFORE, AT, AFTER = -1, 0, 1
ROW, OPEN, CLOSE = 0, 1, 2


def _prefix(bound: Column, dtype: T.DataType, spec: TableSpec) -> list[Column]:
    """The values of a bound, one for each clustering column; null from where it ends."""
    if isinstance(dtype, T.StructType):
        return [bound[c] if c in dtype.fieldNames() else F.lit(None) for c in spec.ck]
    return [bound, *[F.lit(None)] * (len(spec.ck) - 1)]


def _position(values: list[Column], types: list[T.DataType], side: Column | None = None) -> Column:
    """Sorts as rows and bounds lie in a partition; ``side`` of a bound tells whether it lies before or after its prefix."""
    fields, ended = [], F.lit(False)
    for i, (value, dtype) in enumerate(zip([*values, None], [*types, None])):
        missing = value.isNull() if value is not None else F.lit(True)
        here = F.lit(AT) if side is None else F.when(~ended & missing, side).otherwise(AT)
        fields.append(here.cast("int").alias(f"r{i}"))
        if value is not None:
            ended = ended | missing
            fields.append(F.when(~ended, value).cast(dtype).alias(f"v{i}"))
    return F.struct(*fields)


def bounds(ranges: DataFrame, rows: DataFrame, spec: TableSpec) -> DataFrame:
    """The ranges that aren't empty: partition key, ``rid``, positions ``start`` and ``end``, ``ts`` and ``ldt``."""
    types = [rows.schema[c].dataType for c in spec.ck]
    lo, hi = (_prefix(F.col(c), ranges.schema[c].dataType, spec) for c in ("lo", "hi"))
    open_at = lambda values: values[0].isNull()
    start = _position(lo, types, F.when(open_at(lo) | F.col("lo_incl"), BEFORE).otherwise(AFTER))
    end = _position(hi, types, F.when(open_at(hi) | F.col("hi_incl"), AFTER).otherwise(BEFORE))
    placed = ranges.select(*spec.pk, start.alias("start"), end.alias("end"), F.col("_ts").cast("bigint").alias("ts"), F.col("_now").cast("bigint").alias("ldt"))
    return placed.filter(F.col("start") < F.col("end")).withColumn("rid", F.monotonically_increasing_id())


def _sweep(key: list[str]):
    """Goes through sorted events and gives out the rows that are covered, with the newest open range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, heap, closed = None, [], set()
        for batch in batches:
            if not batch.num_rows:
                continue
            column = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            piece, kinds = (column[n].to_numpy(zero_copy_only=False) for n in ("piece", "kind"))
            # only bounds, and where a piece begins, change what is open; rows take it over from there
            begins = np.diff(piece, prepend=piece[0] - 1) != 0
            turns = (kinds != ROW) | begins
            at = np.flatnonzero(turns)
            bound = [column[n].take(pa.array(at)).fill_null(0).to_numpy().tolist() for n in ("rid", "ts", "ldt")]
            newest = [heap[0] if heap else None]
            for here, kind, rid, ts, ldt in zip(piece[at].tolist(), kinds[at].tolist(), *bound):
                if here != place:
                    place, heap, closed = here, [], set()
                if kind == OPEN:
                    heapq.heappush(heap, (-ts, -ldt, rid))
                elif kind == CLOSE:
                    closed.add(rid)
                while heap and heap[0][2] in closed:
                    closed.discard(heapq.heappop(heap)[2])
                newest.append(heap[0] if heap else None)
            found = np.array([x is not None for x in newest])
            times, stamps = (np.array([0 if x is None else -x[i] for x in newest], dtype=np.int64) for i in (0, 1))
            since = np.cumsum(turns)
            keep = (kinds == ROW) & found[since]
            rows = batch.select(key).filter(pa.array(keep))
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(times[since[keep]]), pa.array(stamps[since[keep]])], names=[*key, "ts", "ldt"])

    return run


def covering(rows: DataFrame, ranges: DataFrame, spec: TableSpec, piece_rows: int | None = None) -> DataFrame:
    """For every row key that a range covers, the newest such deletion as ``_rdel``.

    ``ranges`` holds the partition key, ``lo`` and ``hi``, ``lo_incl`` and ``hi_incl``, ``_ts`` and ``_now``. A bound is a value of
    the first clustering column or a struct of the first ones, fields named as they are; null is an open
    end, and null fields end the prefix. Rows with a null in the clustering key are never covered.
    Partitions of more than ``piece_rows`` events are cut into pieces of about so many.
    """
    spark, pk, ck = rows.sparkSession, spec.pk, spec.ck
    piece_rows = piece_rows or TASK_ROWS
    types = [rows.schema[c].dataType for c in ck]
    spans = materialize(bounds(ranges, rows, spec), "ranges")
    sizes = materialize(rows.groupBy(*pk).agg(F.count(F.lit(1)).alias("_n")).join(
        spans.groupBy(*pk).agg((2 * F.count(F.lit(1))).alias("_b")), pk).select(*pk, (F.col("_n") + F.col("_b")).alias("_n")), "sizes")
    touched = rows.select(*spec.key).dropna(subset=ck).join(sizes, pk, "left_semi")
    none = lambda n: F.lit(None).cast("bigint").alias(n)
    row_events = touched.select(*pk, _position([F.col(c) for c in ck], types).alias("pos"), F.lit(ROW).alias("kind"), none("rid"), none("ts"), none("ldt"))

    def bound(kind: int, pos: str) -> DataFrame:
        return spans.select(*pk, F.col(pos).alias("pos"), F.lit(kind).alias("kind"), "rid", "ts", "ldt")

    events = row_events.unionByName(bound(OPEN, "start")).unionByName(bound(CLOSE, "end"))
    order = [*pk, "pos"]
    schema = T.StructType([*[rows.schema[c] for c in spec.key], T.StructField("ts", T.LongType()), T.StructField("ldt", T.LongType())])

    def sweep(laid: DataFrame) -> DataFrame:
        # a row's position holds its clustering key
        values = [F.col(f"pos.v{i}").alias(c) for i, c in enumerate(ck)]
        return laid.select(*pk, *values, "piece", "kind", "rid", "ts", "ldt").mapInArrow(_sweep(spec.key), schema)

    total, most = sizes.agg(F.sum("_n"), F.max("_n")).first()
    hot = sizes.filter(F.col("_n") > piece_rows).select(*pk)
    cut = (most or 0) > piece_rows
    whole = events.join(hot, pk, "left_anti") if cut else events
    found = sweep(whole.withColumn("piece", F.lit(0)).repartition(tasks_for(spark, total or 0), *pk).sortWithinPartitions(*order))
    if cut:
        large = events.join(hot, pk, "left_semi")
        pieces = -(-sizes.filter(F.col("_n") > piece_rows).agg(F.sum("_n")).first()[0] // piece_rows)
        laid = materialize(large.repartitionByRange(pieces, *order).withColumn("piece", F.spark_partition_id()), "events")
        found = found.unionByName(sweep(_with_open(laid, pieces, spec).repartition(pieces, "piece").sortWithinPartitions("piece", *order)))
    # rows of one key lie at one position, so all of them found the same deletion
    return found.groupBy(*spec.key).agg(F.max("ts").alias("_t"), F.max("ldt").alias("_l")).select(
        *spec.key, F.struct(F.col("_t").alias("ts"), F.col("_l").alias("ldt")).alias("_rdel"))


def _with_open(laid: DataFrame, pieces: int, spec: TableSpec) -> DataFrame:
    """The laid events, with one more opening event for each range that is open where a piece begins and ends in it,
    and one for all the ranges that cover a piece from end to end. A null position sorts first."""
    pk = spec.pk
    ends = laid.filter(F.col("kind") != ROW).groupBy(*pk, "rid", "ts", "ldt").agg(
        F.min("piece").cast("bigint").alias("_b0"), F.max("piece").cast("bigint").alias("_b1"))
    across = materialize(ends.filter("_b0 < _b1"), "across")
    nowhere = F.lit(None).cast(laid.schema["pos"].dataType).alias("pos")
    opening = [nowhere, F.lit(OPEN).alias("kind"), "rid", "ts", "ldt"]
    inner = across.select(*pk, *opening, F.col("_b1").cast("int").alias("piece"))
    held = laid.filter(F.col("kind") == ROW).select(*pk, F.col("piece").cast("bigint").alias("_bin")).distinct().join(
        across.select(*pk).distinct(), pk, "left_semi").withColumn("_bins", F.lit(pieces).cast("bigint"))
    covered = whole_pieces(across.withColumn("_bins", F.lit(pieces).cast("bigint")).withColumn("_rdel", F.struct("ts", "ldt")), held, pk)
    covered = covered.select(*pk, F.lit(-1).cast("bigint").alias("rid"), "_rdel.ts", "_rdel.ldt", F.col("_bin").cast("int").alias("piece"))
    return laid.unionByName(inner).unionByName(covered.select(*pk, *opening, "piece"))


def whole_pieces(placed: DataFrame, held: DataFrame, pk: list[str]) -> DataFrame:
    """For each piece that holds rows of a partition, the newest range that covers all of it.

    A range's inner pieces are written as nodes of a binary tree (a level ``j`` node holds ``2^j``
    pieces); a piece then looks up its own ancestors.
    """
    up = lambda x, j: F.call_function("shiftright", x, j)
    width = lambda j: F.call_function("shiftleft", F.lit(1).cast("bigint"), j)
    first, end = F.col("_b0") + 1, F.col("_b1")  # pieces first … end - 1

    def nodes_at(j: Column) -> Column:
        lo, hi = up(first + width(j) - 1, j), up(end, j)
        take = lambda node, odd: F.when((lo < hi) & (odd % 2 == 1), F.struct(j.alias("level"), node.alias("node")))
        return F.array(take(lo, lo), take(hi - 1, hi))

    levels = F.sequence(F.lit(0), F.ceil(F.log2(F.col("_bins").cast("double"))).cast("int"))
    nodes = (
        placed.filter(F.col("_b1") - F.col("_b0") > 1)
        .select(*pk, "_rdel", F.explode(F.array_compact(F.flatten(F.transform(levels, nodes_at)))).alias("_n"))
        .groupBy(*pk, F.col("_n.level").alias("level"), F.col("_n.node").alias("node"))
        .agg(F.max("_rdel").alias("_rdel"))
    )
    ancestors = held.select(*pk, "_bin", F.explode(levels).alias("level")).withColumn("node", up(F.col("_bin"), F.col("level")))
    return ancestors.join(nodes, [*pk, "level", "node"]).groupBy(*pk, "_bin").agg(F.max("_rdel").alias("_rdel"))

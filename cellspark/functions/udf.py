"""User-defined scalar functions and aggregates."""

from __future__ import annotations

import copy
import functools
import itertools
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

RETURNS_NULL = "returns null"
CALLED = "called"


def _any_null(args: list[Column]) -> Column:
    found = args[0].isNull()
    for a in args[1:]:
        found = found | a.isNull()
    return found


def column_function(body: Callable[..., Column], on_null: str = RETURNS_NULL) -> Callable[..., Column]:
    """A scalar function whose body is a Column expression; it stays in generated code."""

    def call(*args) -> Column:
        cols = [F.col(a) if isinstance(a, str) else a for a in args]
        value = body(*cols)
        return F.when(~_any_null(cols), value) if on_null == RETURNS_NULL and cols else value

    return call


def python_function(body: Callable, return_type, on_null: str = RETURNS_NULL) -> Callable[..., Column]:
    """A scalar function with a Python body, sent to workers in Arrow batches.

    ``body`` takes and returns plain values; a dict or tuple with a struct return type
    builds a user-defined type or tuple.
    """
    run = F.udf(body, return_type, useArrow=True)

    def call(*args) -> Column:
        cols = [F.col(a) if isinstance(a, str) else a for a in args]
        if on_null == RETURNS_NULL and cols:
            wrapped = F.udf(lambda *v: None if any(x is None for x in v) else body(*v),
                            return_type, useArrow=True)
            return wrapped(*cols)
        return run(*cols)

    return call


def vector_function(body: Callable, return_type, on_null: str = RETURNS_NULL) -> Callable[..., Column]:
    """A scalar function over pandas Series.

    The body is run on whole batches, rows with nulls included; unless it is to be called
    on null, what it gives for such rows is replaced by null.
    """
    run = F.pandas_udf(body, return_type)

    def call(*args) -> Column:
        cols = [F.col(a) if isinstance(a, str) else a for a in args]
        return F.when(~_any_null(cols), run(*cols)) if on_null == RETURNS_NULL and cols else run(*cols)

    return call


def register_function(spark: SparkSession, name: str, body: Callable, return_type,
                      on_null: str = RETURNS_NULL, replace: bool = False) -> None:
    """Make a Python function callable from SQL; an existing name needs ``replace``."""
    if not replace and spark.catalog.functionExists(name):
        raise ValueError(f"function {name} exists")
    fn = body if on_null == CALLED else (
        lambda *v: None if any(x is None for x in v) else body(*v))
    spark.udf.register(name, F.udf(fn, return_type, useArrow=True))


def register_expression(spark: SparkSession, name: str, args: str, return_type: str,
                        expression: str, replace: bool = False) -> None:
    """Make an SQL expression callable by name."""
    verb = "CREATE OR REPLACE TEMPORARY FUNCTION" if replace else "CREATE TEMPORARY FUNCTION"
    spark.sql(f"{verb} {name}({args}) RETURNS {return_type} RETURN {expression}")


def _rows(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple]:
    """Plain values of the named columns, row by row; null is None and nothing else is."""
    for batch in batches:
        yield from zip(*[batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names])


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    while block := list(itertools.islice(rows, size)):
        yield pa.RecordBatch.from_arrays(
            [pa.array(values, f.type) for values, f in zip(zip(*block), schema)], schema=schema)


def _by_key(rows: Iterator[tuple], width: int) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """Runs of sorted rows with one key; NaN equals itself, as it does in a Spark group."""
    same = lambda row: tuple("NaN" if v != v else v for v in row[:width])
    for _, run in itertools.groupby(rows, same):
        first = next(run)
        yield first[:width], itertools.chain([first], run)


def fold_groups(df: DataFrame, group: list[str], order: list[str], args: list[str], sfunc: Callable,
                state_type: str, initial=None, final: Callable | None = None, out: str = "value",
                result_type: str | None = None, skip_null: bool = True,
                merge: Callable | None = None) -> DataFrame:
    """A user-defined aggregate: a state function folded over each group in ``order``.

    With ``merge`` (combines the states of two adjacent runs of rows) the rows are range
    partitioned by group and order, so one hot group is spread over many tasks; each task
    sends one state per group it saw and these states are merged in order.

    Without ``merge`` the fold is sequential by nature: rows are brought together by group
    and streamed in order through one open state, so a group never has to fit in memory.

    Values reach ``sfunc`` through Arrow's own types: integers stay exact beside nulls, and
    only nulls are skipped by ``skip_null``, not NaN. Each group starts from its own copy of
    ``initial``.
    """
    width = len(group)
    keys = [df.schema[g] for g in group]
    rows = df.select(*group, *[c for c in order if c not in group],
                     *[c for c in args if c not in group and c not in order])
    finish = final or (lambda s: s)

    def schema_of(*fields: T.StructField) -> tuple[T.StructType, pa.Schema]:
        spark_schema = T.StructType([*keys, *fields])
        return spark_schema, to_arrow_schema(spark_schema)

    def typed(name: str, kind: str) -> T.StructField:
        return T.StructField(name, T.StructType.fromDDL(f"v {kind}")["v"].dataType)

    result, result_arrow = schema_of(typed(out, result_type or state_type))

    def fold(run: Iterator[tuple], begin: int):
        state = copy.deepcopy(initial)
        for row in run:
            values = row[begin:]
            if not (skip_null and any(v is None for v in values)):
                state = sfunc(state, *values)
        return state

    if merge is None:
        ordered = rows.repartition(*group).sortWithinPartitions(*group, *order)

        def whole(batches):
            found = _by_key(_rows(batches, group + args), width)
            return _batches(((*k, finish(fold(run, width))) for k, run in found), result_arrow)

        return ordered.mapInArrow(whole, result)

    ranged = rows.repartitionByRange(*group, *order).sortWithinPartitions(*group, *order)
    placed = ranged.withColumn("_part", F.spark_partition_id())
    partial, partial_arrow = schema_of(typed("_part", "int"), typed("_state", state_type))

    def pieces(batches):
        # the number of the task is part of the key: one state per task and group
        found = _by_key(_rows(batches, [*group, "_part", *args]), width + 1)
        return _batches(((*k, fold(run, width + 1)) for k, run in found), partial_arrow)

    gathered = placed.mapInArrow(pieces, partial).repartition(*group).sortWithinPartitions(*group, "_part")

    def combine(batches):
        found = _by_key(_rows(batches, [*group, "_state"]), width)
        return _batches(
            ((*k, finish(functools.reduce(merge, (row[-1] for row in run)))) for k, run in found), result_arrow)

    return gathered.mapInArrow(combine, result)

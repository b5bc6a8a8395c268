"""Building mutations, counters, batches and schema changes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellspark.functions import jsonfn
from cellspark.functions.aggregates import sum_of
from cellspark.spec import MAX_TTL, TableSpec


def _stamp(df: DataFrame, op: str, ts, ttl=None, now=None) -> DataFrame:
    if isinstance(ttl, int) and not 0 <= ttl <= MAX_TTL:
        raise ValueError(f"ttl must be between 0 and {MAX_TTL}")
    as_col = lambda x: x if isinstance(x, Column) else F.lit(x)
    ts_col = as_col(ts).cast("bigint")
    out = df.withColumn("_op", F.lit(op)).withColumn("_ts", ts_col)
    if ttl is not None:
        seconds = as_col(ttl).cast("int")
        if isinstance(ttl, Column):
            bad = F.raise_error(F.lit("ttl out of range")).cast("int")
            seconds = F.when(seconds.isNull() | seconds.between(0, MAX_TTL), seconds).otherwise(bad)
        out = out.withColumn("_ttl", seconds)
    wall = as_col(now) if now is not None else F.call_function("div", F.col("_ts"), F.lit(1000000))
    return out.withColumn("_now", wall.cast("bigint"))


def insert(rows: DataFrame, spec: TableSpec, ts, ttl=None, now=None) -> DataFrame:
    """Upsert with row liveness. A column that is present and null deletes the cell."""
    named = [c for c in spec.regular if c in rows.columns]
    if "_set" not in rows.columns:
        rows = rows.withColumn("_set", F.array(*[F.lit(c) for c in named]))
    return _stamp(rows, "insert", ts, ttl, now)


def update(rows: DataFrame, spec: TableSpec, ts, ttl=None, now=None) -> DataFrame:
    """Upsert of cells without row liveness: the row lives only as long as a cell does."""
    return insert(rows, spec, ts, ttl, now).withColumn("_op", F.lit("update"))


def insert_json(df: DataFrame, text: str, schema: T.StructType, spec: TableSpec, ts,
                ttl=None, now=None, missing: str = "null") -> DataFrame:
    """INSERT JSON; names absent from the text become nulls or are left untouched (``unset``)."""
    rows = jsonfn.row_from_json(df.select(text), text, schema)
    named = [f.name for f in schema.fields if f.name in spec.regular]
    if missing == "null":
        rows = rows.withColumn("_set", F.when(
            F.col("_set").isNotNull(), F.array(*[F.lit(c) for c in named])))
    elif missing != "unset":
        raise ValueError("missing must be null or unset")
    return _stamp(rows.drop(text), "insert", ts, ttl, now)


def delete_rows(keys: DataFrame, spec: TableSpec, ts, now=None) -> DataFrame:
    return _stamp(keys.select(*spec.key), "delete_row", ts, None, now)


def delete_partitions(keys: DataFrame, spec: TableSpec, ts, now=None) -> DataFrame:
    return _stamp(keys.select(*spec.pk), "delete_partition", ts, None, now)


def delete_cells(keys: DataFrame, spec: TableSpec, columns: list[str], ts, now=None) -> DataFrame:
    touched = F.array(*[F.lit(c) for c in columns])
    return _stamp(keys.select(*spec.key).withColumn("_set", touched), "delete_cells", ts, None, now)


def delete_ranges(partitions: DataFrame, spec: TableSpec, lo, hi, ts, now,
                  lo_inclusive: bool = True, hi_inclusive: bool = False) -> DataFrame:
    """Range tombstones on the first clustering column."""
    as_col = lambda x: x if isinstance(x, Column) else F.lit(x)
    return partitions.select(
        *spec.pk, as_col(lo).alias("lo"), as_col(hi).alias("hi"),
        F.lit(lo_inclusive).alias("lo_incl"), F.lit(hi_inclusive).alias("hi_incl"),
        as_col(ts).cast("bigint").alias("_ts"), as_col(now).cast("bigint").alias("_now"))


def delete_slices(partitions: DataFrame, spec: TableSpec, ts, now, equal: dict | None = None, lo=None, hi=None,
                  lo_inclusive: bool = True, hi_inclusive: bool = True) -> DataFrame:
    """Range tombstones on a prefix of the clustering key.

    ``equal`` fixes the first clustering columns; ``lo`` and ``hi`` bound the next one, or, given as lists, the
    next ones together: ``c1 = 5 AND (c2, c3) > (1, 2)``. Without a bound all rows of the prefix go.
    """
    as_col = lambda x: x if isinstance(x, Column) else F.lit(x)
    equal = equal or {}
    if list(equal) != spec.ck[: len(equal)]:
        raise ValueError(f"only the first clustering columns can be fixed, in order: {spec.ck}")

    def bound(value) -> Column:
        values = [] if value is None else list(value) if isinstance(value, (list, tuple)) else [value]
        if len(equal) + len(values) > len(spec.ck):
            raise ValueError("a bound has more values than clustering columns")
        fixed = [as_col(v).alias(c) for c, v in zip(spec.ck, [*equal.values(), *values])]
        return F.struct(*fixed) if fixed else F.lit(None)

    return partitions.select(
        *spec.pk, bound(lo).alias("lo"), bound(hi).alias("hi"), F.lit(lo is None or lo_inclusive).alias("lo_incl"),
        F.lit(hi is None or hi_inclusive).alias("hi_incl"), as_col(ts).cast("bigint").alias("_ts"), as_col(now).cast("bigint").alias("_now"))


def ranges_of(spec: TableSpec, rows: DataFrame, *slices: DataFrame) -> DataFrame:
    """One frame of range tombstones from several: bounds of any length as structs of the whole clustering key."""

    def whole(df: DataFrame, name: str) -> Column:
        dtype, bound = df.schema[name].dataType, F.col(name)
        held = dtype.fieldNames() if isinstance(dtype, T.StructType) else spec.ck[:1] if not isinstance(dtype, T.NullType) else []
        value = lambda c: F.lit(None) if c not in held else bound[c] if isinstance(dtype, T.StructType) else bound
        return F.struct(*[value(c).cast(rows.schema[c].dataType).alias(c) for c in spec.ck])

    return reduce(lambda a, b: a.unionByName(b), [s.withColumns({n: whole(s, n) for n in ("lo", "hi")}) for s in slices])


def log_of(*mutations: DataFrame) -> DataFrame:
    """One mutation log from several."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), mutations)


def batch(*mutations: DataFrame, ts, counters: tuple[bool, ...] = ()) -> DataFrame:
    """Mutations applied together at one timestamp; counter and regular ones do not mix."""
    if counters and len(set(counters)) > 1:
        raise ValueError("counter and non-counter mutations cannot share a batch")
    stamp = ts if isinstance(ts, Column) else F.lit(ts)
    return log_of(*mutations).withColumn("_ts", stamp.cast("bigint"))


def truncate(log: DataFrame, at_ts: int) -> DataFrame:
    """TRUNCATE at a time: only later writes remain."""
    return log.filter(F.col("_ts") > at_ts)


def counter_values(deltas: DataFrame, key: list[str], delta: Column, name: str = "value") -> DataFrame:
    """Counter values from ``c = c ± n`` deltas; a null delta is an error, sums wrap."""
    checked = F.when(delta.isNull(), F.raise_error(F.lit("null counter delta")).cast("bigint")).otherwise(delta)
    return deltas.groupBy(*key).agg(sum_of(checked, "counter").alias(name))


def counter_decrement(amount: Column) -> Column:
    """The delta of ``c = c - n``; the smallest bigint has no opposite and is an error."""
    lowest = F.lit(-(1 << 63)).cast("bigint")
    return F.when(amount == lowest, F.raise_error(F.lit("cannot negate")).cast("bigint")).otherwise(-amount)


def apply_counters(current: DataFrame, deltas: DataFrame, key: list[str], name: str = "value") -> DataFrame:
    """Add aggregated deltas to stored counters."""
    both = current.select(*key, name).unionByName(deltas.select(*key, name))
    return both.groupBy(*key).agg(sum_of(F.col(name), "counter").alias(name))


def first_update_per_key(updates: DataFrame, spec: TableSpec, order: Column) -> DataFrame:
    """One update per key for conditional writes: the earliest by ``order``."""
    rest = [c for c in updates.columns if c not in spec.key]
    picked = updates.groupBy(*spec.key).agg(F.min_by(F.struct(*rest), order).alias("_first"))
    return picked.select(*spec.key, "_first.*")


def apply_if(table: DataFrame, updates: DataFrame, spec: TableSpec, condition: Column,
             columns: list[str], order: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Conditional writes: (new table, result).

    ``updates`` has the key and one column per written cell. The condition may use the
    table's columns (null when there is no row), ``_exists`` and the written values as
    ``new_<column>``. The result shows ``applied`` and, where it is false, the current
    values. Of several updates of a key the first by ``order`` is taken; without ``order``
    they are an error.
    """
    values = [c for c in table.columns if c not in spec.key]
    if order is None:
        more = F.raise_error(F.lit("several conditional updates of one key")).cast("boolean")
        once = updates.groupBy(*spec.key).agg(
            F.any_value(F.struct(*columns)).alias("_new"), F.count(F.lit(1)).alias("_n"))
        updates = once.filter(F.when(F.col("_n") > 1, more).otherwise(True)).select(*spec.key, "_new.*")
    else:
        updates = first_update_per_key(updates, spec, order)
    new = updates.select(*spec.key, *[F.col(c).alias(f"new_{c}") for c in columns], F.lit(True).alias("_asked"))
    current = table.withColumn("_exists", F.lit(True))
    joined = current.join(new, spec.key, "full").withColumn("_exists", F.coalesce("_exists", F.lit(False)))
    decided = joined.withColumn(
        "applied", F.coalesce(F.col("_asked"), F.lit(False)) & F.coalesce(condition, F.lit(False)))
    written = [F.when(F.col("applied"), F.col(f"new_{c}")).otherwise(F.col(c)).alias(c)
               if c in columns else F.col(c) for c in values]
    table_after = decided.filter(F.col("_exists") | F.col("applied")).select(*spec.key, *written)
    result = decided.filter("_asked").select(
        *spec.key, "applied", *[F.when(~F.col("applied"), F.col(c)).alias(c) for c in values])
    return table_after, result


def with_trigger(mutations: DataFrame, fn) -> DataFrame:
    """Mutations together with those a trigger derives from them."""
    return mutations.unionByName(fn(mutations), allowMissingColumns=True)


def audit(mutations: DataFrame, spec: TableSpec, table: str) -> DataFrame:
    """A trigger body: one audit row per mutation."""
    return mutations.select(
        F.lit(table).alias("table_name"), F.concat_ws(":", *spec.key).alias("primary_key"),
        F.col("_op").alias("operation"), F.col("_ts").alias("at"))


def add_column(df: DataFrame, name: str, kind: str) -> DataFrame:
    """ALTER … ADD: old rows read null."""
    return df.withColumn(name, F.lit(None).cast(kind))


def drop_column(log: DataFrame, name: str, dropped_at: int, readded: bool = False) -> DataFrame:
    """ALTER … DROP: cells written up to the drop are ignored, also after re-adding the column."""
    if not readded:
        return log.drop(name)
    kept = log.withColumn(name, F.when(F.col("_ts") > dropped_at, F.col(name)))
    if "_set" in log.columns:
        trimmed = F.when(F.col("_ts") > dropped_at, F.col("_set")).otherwise(
            F.array_remove("_set", name))
        kept = kept.withColumn("_set", trimmed)
    return kept


def rename_key(df: DataFrame, old: str, new: str) -> DataFrame:
    return df.withColumnRenamed(old, new)


def add_field(df: DataFrame, column: str, field: str, kind: str) -> DataFrame:
    """ALTER TYPE … ADD: old values read null in the new field."""
    grown = F.col(column).withField(field, F.lit(None).cast(kind))
    return df.withColumn(column, F.when(F.col(column).isNotNull(), grown))


def rename_field(df: DataFrame, column: str, old: str, new: str) -> DataFrame:
    fields = df.schema[column].dataType.fieldNames()
    made = F.struct(*[F.col(f"{column}.{f}").alias(new if f == old else f) for f in fields])
    return df.withColumn(column, F.when(F.col(column).isNotNull(), made))

"""Reading and writing tables: scans, splits by token, clustered bulk writes and loads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellspark.functions.token import token as token_of
from cellspark.spec import TableSpec


def scan(df: DataFrame, columns: list[str] | None = None, where: Column | None = None) -> DataFrame:
    """A column list and a row filter over a whole table; both reach the file scan."""
    rows = df if where is None else df.filter(where)
    return rows.select(*columns) if columns else rows


def scan_token_ranges(df: DataFrame, spec: TableSpec, n_splits: int,
                      columns: list[str] | None = None, where: Column | None = None) -> DataFrame:
    """A scan whose tasks each hold one contiguous token range."""
    rows = scan(df, columns, where).withColumn("_token", token_of(spec.pk))
    return rows.repartitionByRange(n_splits, "_token", *[c for c in spec.key if c in rows.columns])


def split_counts(df: DataFrame, spec: TableSpec, n_splits: int, token: Column | None = None,
                 bits: int = 64) -> DataFrame:
    """Rows per equal-width token range: the split plan of a bulk read."""
    t = token_of(spec.pk) if token is None else token
    width = (1 << bits) // n_splits
    offset = (1 << (bits - 1)) if bits == 64 else 0
    shifted = t.cast("decimal(20,0)") + F.lit(str(offset)).cast("decimal(20,0)")
    split = F.least(F.call_function("div", shifted, F.lit(str(width)).cast("decimal(20,0)")), F.lit(n_splits - 1))
    return df.groupBy(split.alias("split")).agg(F.count(F.lit(1)).alias("n_rows"))


def clustered(df: DataFrame, spec: TableSpec, n_files: int | None = None) -> DataFrame:
    """Rows in (token, partition key, clustering) order, range partitioned.

    The range runs over the clustering columns too, so one hot partition spreads over files.
    """
    token = F.xxhash64(*spec.pk)
    keys = [F.col(c) for c in spec.pk] + spec.clustering_order()
    ranged = (df.repartitionByRange(n_files, token, *keys) if n_files
              else df.repartitionByRange(token, *keys))
    return ranged.sortWithinPartitions(token, *keys)


def bulk_write(df: DataFrame, spec: TableSpec, path: str, n_files: int | None = None,
               bloom: bool = False, keep_token: bool = False, mode: str = "overwrite") -> None:
    """Sorted Parquet files; with ``bloom`` point reads by partition key skip files.

    ``keep_token`` stores the token as ``_token``, so that token ranges and pages are
    pruned by the min/max values of the sorted files.
    """
    rows = clustered(df, spec, n_files)
    writer = (rows.withColumn("_token", token_of(spec.pk)) if keep_token else rows).write.mode(mode)
    if bloom:
        for c in spec.pk:
            writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
    writer.parquet(path)


def load(df: DataFrame, spec: TableSpec, rename: dict[str, str] | None = None,
         ignore_missing: bool = False, token_ranges: list[tuple[int, int]] | None = None,
         ts: Column | None = None) -> DataFrame:
    """Rows of another table as insert mutations of this one."""
    rename = rename or {}
    if len(set(rename.values())) != len(rename):
        raise ValueError("two columns are renamed to the same name")
    rows = df.withColumnsRenamed(rename)
    extra = [c for c in rows.columns if c not in spec.columns and not c.startswith("_")]
    if extra and not ignore_missing:
        raise ValueError(f"columns unknown to the target table: {extra}")
    rows = rows.drop(*extra)
    if token_ranges is not None:
        t = token_of(spec.pk)
        keep = F.lit(False)
        for lo, hi in token_ranges:
            keep = keep | ((t > lo) & (t <= hi))
        rows = rows.filter(keep)
    out = rows.withColumn("_op", F.lit("insert"))
    return out if ts is None else out.withColumn("_ts", ts.cast("bigint"))


def validate(actual: DataFrame, expected: DataFrame, key: list[str]) -> DataFrame:
    """Rows of two tables that do not agree: ``missing``, ``unexpected`` or ``different``."""
    values = [c for c in expected.columns if c not in key]
    a = actual.select(*key, F.struct(*values).alias("actual"))
    e = expected.select(*key, F.struct(*values).alias("expected"))
    status = (F.when(F.col("actual").isNull(), "missing")
              .when(F.col("expected").isNull(), "unexpected")
              .when(~F.col("actual").eqNullSafe(F.col("expected")), "different"))
    return (a.join(e, key, "full").withColumn("status", status)
            .filter(F.col("status").isNotNull()).select(*key, "status"))

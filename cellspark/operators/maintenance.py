"""Whole-table upkeep: time windows, expired sources, splitting, verify and scrub."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellspark.operators.replica import row_hash
from cellspark.spec import TableSpec

# Seconds of a window unit.
UNIT_SECONDS = {"minutes": 60, "hours": 3600, "days": 86400}


def window_start(seconds: Column, unit: str, size: int = 1) -> Column:
    """Start (s) of the tumbling window a time falls into."""
    width = UNIT_SECONDS[unit] * size
    return seconds - seconds % width


def window_of_sources(sources: DataFrame, unit: str, size: int = 1) -> DataFrame:
    """The window of each source by its largest write time (µs)."""
    seconds = F.call_function("div", F.col("max_ts"), F.lit(1000000))
    return sources.withColumn("window_start", window_start(seconds, unit, size))


def write_by_window(df: DataFrame, seconds: Column, path: str, unit: str, size: int = 1) -> None:
    """Rewrite rows into one folder per window; busy windows are split over several files."""
    placed = df.withColumn("window_start", window_start(seconds, unit, size))
    placed.repartitionByRange("window_start", F.xxhash64(*df.columns)).write.partitionBy(
        "window_start").mode("overwrite").parquet(path)


def expired_blockers(sources: DataFrame, gc_before: int) -> DataFrame:
    """Sources full of expired data and the sources that keep them from being dropped.

    ``sources``: one row per source with min_ts, max_ts, max_ldt. A blocker has data at
    least as old as the expired source's newest write. How many expired sources a source
    blocks is its rank among the sorted expired max_ts values, so no pairs are formed.
    """
    expired = sources.filter(F.col("max_ldt") < gc_before)
    blockers = sources.filter(F.col("max_ldt") > gc_before)
    marks = expired.select(F.col("max_ts").alias("t"), F.lit(1).alias("is_expired"),
                           F.lit(None).cast("string").alias("source")).unionByName(
        blockers.select(F.col("min_ts").alias("t"), F.lit(0).alias("is_expired"), "source"))
    # one row per source file, sorted from the newest: expired sources at or after t
    newest_first = Window.orderBy(F.col("t").desc(), F.col("is_expired").desc()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    ranked = marks.withColumn("blocked", F.sum("is_expired").over(newest_first))
    return ranked.filter((F.col("is_expired") == 0) & (F.col("blocked") > 0)).select("source", "blocked")


def split_write(df: DataFrame, spec: TableSpec, path: str, rows_per_file: int) -> None:
    """Split a table into clustered files of a target size."""
    token = F.xxhash64(*spec.pk)
    keys = [F.col(c) for c in spec.key]
    (df.repartitionByRange(token, *keys).sortWithinPartitions(token, *keys)
     .write.option("maxRecordsPerFile", rows_per_file).mode("overwrite").parquet(path))


def verify(df: DataFrame, spec: TableSpec) -> DataFrame:
    """One row: rows, duplicate keys, null keys and an order-free checksum that tells nulls and their places apart."""
    null_key = F.lit(False)
    for c in spec.key:
        null_key = null_key | F.col(c).isNull()
    per_key = df.groupBy(*spec.key).agg(
        F.count(F.lit(1)).alias("n"), F.max(null_key).alias("no_key"),
        F.bit_xor(row_hash(df)).alias("h"))
    return per_key.agg(
        F.sum("n").alias("n_rows"), F.sum(F.col("n") - 1).alias("duplicates"),
        F.sum(F.when(F.col("no_key"), F.col("n")).otherwise(0)).alias("null_keys"),
        F.bit_xor("h").alias("checksum"))


def verify_order(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Files of a clustered table whose token ranges overlap another file's.

    Works on one row per file.
    """
    token = F.xxhash64(*spec.pk)
    position = F.struct(token.alias("t"), *[F.col(c) for c in spec.key])
    files = df.select(F.col("_metadata.file_path").alias("file"), position.alias("p")).groupBy("file").agg(
        F.min("p").alias("lo"), F.max("p").alias("hi"))
    w = Window.orderBy("lo", "file")
    return files.withColumn("_before", F.max("hi").over(
        w.rowsBetween(Window.unboundedPreceding, -1))).filter(F.col("lo") < F.col("_before")).select("file")


def scrub(df: DataFrame, spec: TableSpec, good: Column, version: Column,
          ldt: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(clean, rejected): bad rows out, duplicate keys merged to the best version.

    ``good`` is the row test, ``version`` decides between duplicates (larger wins, must be
    total). A negative local deletion time is set to the largest one.
    """
    ok = F.coalesce(good, F.lit(False))
    for c in spec.key:
        ok = ok & F.col(c).isNotNull()
    rows = df
    if ldt:
        rows = rows.withColumn(ldt, F.when(F.col(ldt) < 0, F.lit(2147483647)).otherwise(F.col(ldt)))
    rest = [c for c in df.columns if c not in spec.key]
    best = rows.filter(ok).groupBy(*spec.key).agg(F.max_by(F.struct(*rest), version).alias("_r"))
    clean = best.select(*spec.key, "_r.*").select(*df.columns)
    return clean, df.filter(~ok)

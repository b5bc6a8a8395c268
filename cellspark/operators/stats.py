"""Table statistics: bucketed histograms, cardinality, tombstones and size estimates."""

from __future__ import annotations

import bisect
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellspark.spec import TableSpec

# Bucket counts of the histograms.
DEFAULT_BUCKETS = 90
SIZE_BUCKETS = 150
CELL_BUCKETS = 118
PERCENTILES = (0.5, 0.75, 0.95, 0.98, 0.99)


def bucket_offsets(n: int = DEFAULT_BUCKETS, zero: bool = False) -> list[int]:
    """Upper bounds of the buckets: each is 1.2 times the one before, rounded, growing by at least 1."""
    out = [1]
    while len(out) < n:
        out.append(max(out[-1] + 1, (out[-1] * 12 + 5) // 10))
    return ([0] + out) if zero else out


def _longs(values: list[int]) -> Column:
    """An array literal, made in one call whatever its length."""
    return F.expr(f"array({', '.join(f'{v}L' for v in values)})")


def _log_shift(offsets: list[int], start: int) -> float:
    """The largest shift with which ``log(v) / log(1.2) + shift`` never passes the true bucket."""
    step = math.log(1.2)
    return min(i - math.log(offsets[i]) / step for i in range(start, len(offsets))) - 0.01


def bucket_of(value: Column, offsets: list[int]) -> Column:
    """Index of the first bucket whose bound is not below the value; the last one is overflow.

    Small values are looked up in a table. From there on bounds grow by a steady factor, so
    a logarithm gives a bucket at or just below the right one and at most three comparisons
    with neighbouring bounds finish the job: no search per value.
    """
    start = min(24, len(offsets) - 1)
    small = offsets[start]
    table = _longs([bisect.bisect_left(offsets, v) for v in range(small + 1)])
    bounds = _longs(offsets)
    v = value.cast("bigint")
    at_small = F.get(table, F.greatest(v, F.lit(0)).cast("int")).cast("int")
    shift = _log_shift(offsets, start)
    guess = F.floor(F.log(v.cast("double")) / math.log(1.2) + shift).cast("int")
    guess = F.least(F.greatest(guess, F.lit(start)), F.lit(len(offsets)))
    above = lambda k: F.when(v > F.get(bounds, guess + k), 1).otherwise(0)
    at_large = guess + above(0) + above(1) + above(2)
    return F.when(v.isNull(), None).when(v <= small, at_small).otherwise(at_large)


def histogram(df: DataFrame, value: Column, offsets: list[int], by: list[str] = ()) -> DataFrame:
    """Bucket counts: ``bucket``, its upper bound ``upto`` (null for overflow) and ``n``."""
    bounds = _longs(offsets)
    counted = df.groupBy(*by, bucket_of(value, offsets).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    return counted.filter("bucket is not null").withColumn("upto", F.get(bounds, F.col("bucket")))


def histogram_summary(hist: DataFrame, offsets: list[int], percentiles=PERCENTILES,
                      by: list[str] = ()) -> DataFrame:
    """Percentiles, min, max, mean and count of a bucket histogram, one row per group.

    The input has at most one row per bucket, so everything after it is tiny. An overflown
    histogram has no percentiles or mean (null).
    """
    gathered = hist.groupBy(*by).agg(
        F.array_sort(F.collect_list(F.struct("bucket", "n", "upto"))).alias("b"),
        F.sum("n").alias("total"), F.max(F.col("upto").isNull()).alias("overflowed"),
        F.sum(F.col("n") * F.col("upto")).alias("weighted"))
    zero = F.lit(0).cast("bigint")

    def percentile(p: float) -> Column:
        need = F.ceil(F.col("total") * F.lit(p))
        step = lambda acc, x: F.struct(
            (acc["seen"] + x["n"]).alias("seen"),
            F.when(acc["at"].isNull() & (acc["seen"] + x["n"] >= need), x["upto"]).otherwise(acc["at"]).alias("at"))
        start = F.struct(zero.alias("seen"), F.lit(None).cast("bigint").alias("at"))
        found = F.aggregate("b", start, step, lambda acc: acc["at"])
        return F.when(~F.col("overflowed"), F.when(need == 0, zero).otherwise(F.coalesce(found, zero)))

    offs = _longs(offsets)
    first = F.element_at("b", 1)["bucket"]
    last = F.element_at("b", -1)
    return gathered.select(
        *by, "total",
        F.when(first == 0, zero).otherwise(F.get(offs, first - 1) + 1).alias("min"),
        F.coalesce(last["upto"], F.lit((1 << 63) - 1)).alias("max"),
        F.when(~F.col("overflowed"), F.ceil(F.col("weighted") / F.col("total"))).alias("mean"),
        *[percentile(p).alias(f"p{int(p * 100)}") for p in percentiles])


def row_bytes(columns: dict[str, str]) -> Column:
    """Approximate serialized size of a row: fixed widths, text by its bytes."""
    width = {"tinyint": 1, "boolean": 1, "smallint": 2, "int": 4, "float": 4, "date": 4}
    total = F.lit(0).cast("bigint")
    for name, kind in columns.items():
        size = F.octet_length(name) if kind in ("string", "binary") else F.lit(width.get(kind, 8))
        total = total + F.when(F.col(name).isNotNull(), size).otherwise(0)
    return total


def partition_sizes(df: DataFrame, spec: TableSpec, size: Column | None = None) -> DataFrame:
    """Rows, live cells and bytes of each partition."""
    cells = [c for c in spec.regular if c in df.columns]
    n_cells = sum((F.col(c).isNotNull().cast("int") for c in cells), F.lit(0))
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return df.groupBy(*spec.pk).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(n_cells).alias("n_cells"),
        F.sum(size if size is not None else row_bytes(kinds)).alias("n_bytes"))


def table_histograms(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Percentiles of partition size and of cells per partition."""
    per_partition = partition_sizes(df, spec)
    metrics = {"partition_size": ("n_bytes", SIZE_BUCKETS), "cell_count": ("n_cells", CELL_BUCKETS)}
    # one pass over the partitions; the shorter series of bounds is the start of the longer
    offsets = bucket_offsets(max(n for _, n in metrics.values()))
    placed = per_partition.select(F.explode(F.array(*[
        F.struct(F.lit(name).alias("metric"), bucket_of(F.col(c), offsets[:n]).alias("bucket"), F.lit(n).alias("size"))
        for name, (c, n) in metrics.items()])).alias("m")).select("m.*")
    counted = placed.groupBy("metric", "bucket", "size").agg(F.count(F.lit(1)).alias("n"))
    bounds = _longs(offsets)
    hist = counted.withColumn("upto", F.when(F.col("bucket") < F.col("size"), F.get(bounds, F.col("bucket"))))
    return histogram_summary(hist.drop("size"), offsets, by=["metric"])


def streaming_histogram(df: DataFrame, column: str, bins: int = 100) -> DataFrame:
    """A bounded histogram whose closest bins are merged: one row, array of (x, y)."""
    return df.agg(F.histogram_numeric(column, F.lit(bins)).alias("bins"))


def estimated_count_upto(hist: DataFrame, bound: float) -> DataFrame:
    """Estimated number of values at or below ``bound``, by trapezoids between bins."""
    b = F.lit(float(bound))
    # at most ``bins`` entries: the array is walked once
    step = lambda acc, x: F.struct(
        F.when(x["x"] <= b, acc["sum"] + F.coalesce(acc["py"], F.lit(0.0)) / 2 + x["y"] / 2)
        .when(acc["done"] | acc["px"].isNull(), acc["sum"])
        .otherwise(acc["sum"] + _trapezoid(acc, x, b)).alias("sum"),
        (acc["done"] | (x["x"] > b)).alias("done"),
        F.when(x["x"] <= b, x["x"]).otherwise(acc["px"]).alias("px"),
        F.when(x["x"] <= b, x["y"]).otherwise(acc["py"]).alias("py"))
    start = F.struct(F.lit(0.0).alias("sum"), F.lit(False).alias("done"),
                     F.lit(None).cast("double").alias("px"), F.lit(None).cast("double").alias("py"))
    sorted_bins = F.transform("bins", lambda x: F.struct(
        x["x"].cast("double").alias("x"), x["y"].cast("double").alias("y")))
    total = F.aggregate(sorted_bins, F.lit(0.0), lambda a, x: a + x["y"])
    top = F.element_at(sorted_bins, -1)["x"]
    return hist.select(F.when(top <= b, total).otherwise(
        F.aggregate(sorted_bins, start, step, lambda a: a["sum"])).alias("estimate"))


def _trapezoid(acc: Column, x: Column, b: Column) -> Column:
    share = (b - acc["px"]) / (x["x"] - acc["px"])
    at = acc["py"] + (x["y"] - acc["py"]) * share
    return (acc["py"] + at) * share / 2


def tombstone_drop_times(df: DataFrame, ldt: Column, dead: Column, round_to: int = 60) -> DataFrame:
    """Counts of tombstones by (rounded-up) local deletion time."""
    slot = F.ceil(ldt / round_to) * round_to
    return df.filter(dead).groupBy(slot.cast("bigint").alias("drop_time")).agg(F.count(F.lit(1)).alias("n"))


def droppable_ratio(df: DataFrame, ldt: Column, dead: Column, gc_before: int) -> DataFrame:
    """Share of cells that are tombstones older than ``gc_before``."""
    droppable = F.sum(F.when(dead & (ldt < gc_before), 1).otherwise(0))
    n = F.count(F.lit(1))
    return df.agg(droppable.alias("droppable"), n.alias("cells"),
                  F.when(n > 0, droppable / n).otherwise(0.0).alias("ratio"))


def key_cardinality(df: DataFrame, spec: TableSpec, rsd: float = 0.02) -> DataFrame:
    key = F.col(spec.pk[0]) if len(spec.pk) == 1 else F.struct(*spec.pk)
    return df.agg(F.approx_count_distinct(key, rsd).alias("keys"))


def cardinality_sketches(df: DataFrame, column: str, by: list[str]) -> DataFrame:
    """Mergeable per-source sketches of a key column."""
    return df.groupBy(*by).agg(F.hll_sketch_agg(column).alias("sketch"))


def merge_cardinality(sketches: DataFrame) -> DataFrame:
    return sketches.agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("keys"))


def source_metadata(df: DataFrame, source: Column, ts: Column, ldt: Column | None = None,
                    ttl: Column | None = None, clustering: list[str] = ()) -> DataFrame:
    """Per source (file): minimum and maximum of write time, deletion time, TTL and clustering."""
    aggs = [F.count(F.lit(1)).alias("n_rows"), F.min(ts).alias("min_ts"), F.max(ts).alias("max_ts")]
    for name, c in (("ldt", ldt), ("ttl", ttl)):
        if c is not None:
            aggs += [F.min(c).alias(f"min_{name}"), F.max(c).alias(f"max_{name}")]
    for c in clustering:
        aggs += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
    return df.groupBy(source.alias("source")).agg(*aggs)


def table_stats(df: DataFrame, spec: TableSpec, name: str) -> DataFrame:
    """One row of totals per table."""
    per = partition_sizes(df, spec)
    return per.agg(
        F.count(F.lit(1)).alias("n_partitions"), F.sum("n_rows").alias("n_rows"),
        F.sum("n_cells").alias("n_cells"), F.sum("n_bytes").alias("n_bytes"),
        F.max("n_bytes").alias("largest_partition")).select(F.lit(name).alias("table_name"), "*")


def size_estimates(df: DataFrame, spec: TableSpec, depth: int, leaf: Column) -> DataFrame:
    """Per token range: number of partitions and their mean size."""
    per = partition_sizes(df, spec)
    return per.groupBy(leaf.alias("token_range")).agg(
        F.count(F.lit(1)).alias("partitions"),
        F.call_function("div", F.sum("n_bytes"), F.count(F.lit(1))).alias("mean_size"))


def key_samples(df: DataFrame, spec: TableSpec, every: int) -> DataFrame:
    """About one partition key in ``every``, spread evenly over the token range."""
    keys = df.select(*spec.pk).distinct()
    return keys.filter(F.pmod(F.xxhash64(*spec.pk), F.lit(every)) == 0)


def sources_per_partition(df: DataFrame, spec: TableSpec, source: Column) -> DataFrame:
    """How many partitions are spread over how many sources."""
    spread = df.select(*spec.pk, source.alias("_s")).distinct().groupBy(*spec.pk).agg(
        F.count(F.lit(1)).alias("n_sources"))
    return spread.groupBy("n_sources").agg(F.count(F.lit(1)).alias("n_partitions"))

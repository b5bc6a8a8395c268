"""A third of all rows shares one key."""

from pyspark.sql import functions as F

from cellspark import TableSpec
from cellspark.operators import reconcile as rec
from cellspark.operators import select

SPEC = TableSpec(["k"], ["c"], (), ["v"])
N = 30000


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_many_versions_of_one_row(spark):
    hot = F.col("id") % 3 == 0
    log = spark.range(N).select(F.when(hot, -1).otherwise(F.col("id")).alias("k"), F.when(hot, 0).otherwise(F.col("id")).alias("c"),
                                F.col("id").alias("v"), F.col("id").alias("_ts"))
    rows = rec.live_rows(rec.reconcile(log, SPEC, 0), SPEC)
    assert rows.count() == N - N // 3 + 1
    assert rows.filter("k = -1").first().v == N - 3
    text = plan(rows)
    assert text.index("Exchange hashpartitioning") < text.index("partial_max")  # combined before the shuffle


def test_one_wide_partition(spark):
    hot = F.col("id") % 3 == 0
    df = spark.range(N).select(F.when(hot, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("c"), F.col("id").alias("v"))
    kept = select.per_partition_limit(df, SPEC, 2, reverse=True)
    assert sorted(r.c for r in kept.filter("k = -1").collect()) == [N - 6, N - 3]
    assert kept.count() == N - N // 3 + 2
    statics = df.select("k").distinct().withColumn("s", F.col("k") * 2)
    spec = TableSpec(["k"], ["c"], ["s"], ["v"])
    shown = select.with_statics(df, statics, spec)
    assert shown.count() == N and shown.filter("s = k * 2").count() == N
    assert "FullOuter" not in plan(shown)
    log = df.withColumn("_ts", F.lit(1).cast("bigint"))
    cut = spark.createDataFrame([(-1, 300, None, True, True, 5, 0), (-1, 0, 150, True, False, 5, 0)],
                                "k bigint, lo bigint, hi bigint, lo_incl boolean, hi_incl boolean, _ts bigint, _now bigint")
    left = rec.live_rows(rec.reconcile(log, SPEC, 0, ranges=cut), SPEC)
    assert sorted(r.c for r in left.filter("k = -1").collect()) == list(range(150, 300, 3))
    assert left.count() == N - N // 3 + 50

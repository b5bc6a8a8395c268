"""Pages that cut groups anywhere give the whole grouping."""

import pytest
from pyspark.sql import functions as F

from cellspark import TableSpec
from cellspark.operators import grouping

SPEC = TableSpec(["k"], [("a", "desc"), "b"], (), ["v"])


def partial():
    return {"n": (F.count(F.lit(1)), F.sum), "low": (F.min("v"), F.min), "high": (F.max("v"), F.max)}


@pytest.mark.parametrize("limit", [None, 5])
def test_pages_of_seven_rows(spark, rows, limit):
    df = spark.range(40).select((F.col("id") % 3).alias("k"), (F.col("id") / 8).cast("int").alias("a"), F.col("id").alias("b"), (F.col("id") * 37 % 11).alias("v"))
    found, state, pages = [], grouping.GroupState(), 0
    while state is not None:
        page, state = grouping.page_groups(df, SPEC, ["k", "a"], partial(), 7, state, limit)
        found += [tuple(r) for r in page.collect()]
        pages += 1
    from cellspark.operators import select
    kept = df if limit is None else select.per_partition_limit(df, SPEC, limit)
    whole = kept.groupBy("k", "a").agg(*[c.alias(n) for n, (c, _) in partial().items()])
    assert sorted(found) == rows(whole) and pages == (6 if limit is None else 3)

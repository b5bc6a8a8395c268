"""A large page is found without bringing it to one task, and is the page that a sort with a limit gives."""

import pytest
from pyspark.sql import functions as F

from cellspark import TableSpec
from cellspark import session
from cellspark.operators import grouping, select

SPEC = TableSpec(["k"], [("c", "desc"), "id"])


def table(spark, partitions):
    return spark.range(20000).select((F.col("id") % partitions).alias("k"), (F.col("id") * 7919 % 997).alias("c"), "id")


@pytest.mark.parametrize("partitions", [1, 500])
def test_pages_are_those_of_a_sort(spark, rows, monkeypatch, partitions):
    monkeypatch.setattr(session, "TASK_ROWS", 1000, raising=False)
    df, after, size = table(spark, partitions), None, 12000
    for n in (size, 20000 - size):
        page, read = select.large_page(df, SPEC, size, after)
        whole = select.page(df, SPEC, size, after)
        assert read == n and rows(page.select("k", "c", "id")) == rows(whole.select("k", "c", "id"))
        after = tuple(select.resume_state(whole, SPEC).first())


@pytest.mark.parametrize("partitions", [1, 500])
def test_no_task_gets_the_page(spark, monkeypatch, partitions):
    monkeypatch.setattr(session, "TASK_ROWS", 1000, raising=False)
    page, state = grouping.page_groups(table(spark, partitions), SPEC, ["k", "c", "id"], {"n": (F.count(F.lit(1)), F.sum)}, 12000)
    assert state.open is not None
    assert page.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] < 2500

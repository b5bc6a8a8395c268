"""Rows of a task stay bounded while a table grows, whatever the number of shuffle partitions."""

import pytest
from pyspark.sql import functions as F

from cellspark import session
from cellspark.operators import reconcile as rec
from cellspark.operators import replica
from cellspark.plans import replica_queries
from cellspark.plans.mutation_queries import ORDER
from cellspark.plans.registry import Tables

FOLDER = "/root/testdata/sf0.01"


def most_in_a_task(df):
    return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]


@pytest.mark.parametrize("bound", [300, 3000])
def test_copies_follow_the_rows(spark, monkeypatch, bound):
    monkeypatch.setattr(session, "TASK_ROWS", bound, raising=False)
    states = replica_queries.copies(Tables(spark, FOLDER))
    for state in states.values():
        assert most_in_a_task(state) < 1.4 * bound
    # both copies meet in the tasks that merged them
    assert most_in_a_task(replica.diff(states, ORDER)) < 0.1 * bound
    assert most_in_a_task(rec.merge_copies(list(states.values()), ORDER)) < 1.4 * bound
    plan = replica.diff(states, ORDER)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2

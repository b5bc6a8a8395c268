import random

import pytest
from pyspark.sql import functions as F

from cellspark import TableSpec, ViewSpec
from cellspark.operators import mutate, replica, views
from cellspark.operators import reconcile as rec
from tests.test_reconcile import NOW, SCHEMA, SPEC, random_log

VIEW = ViewSpec(SPEC, ["w"], ["k", "c"], ["v"])


def states(spark, seed):
    log = [r for r in random_log(seed) if r[2] != "delete_partition"]
    df = lambda part: spark.createDataFrame(part, SCHEMA)
    old = rec.merge_states(rec.to_state(df(log[:200]), SPEC, NOW), SPEC)
    return rec.shadow(old, SPEC), rec.to_state(df(log[200:]), SPEC, NOW), rec.reconcile(df(log), SPEC, NOW)


@pytest.mark.parametrize("seed", [1, 2])
def test_incremental_view_equals_full_build(spark, seed):
    old, change, new = states(spark, seed)
    for view in (VIEW, ViewSpec(SPEC, ["w"], ["k", "c"], ["v"], where=F.col("v") > 1), ViewSpec(SPEC, ["c"], ["k"], ["v"])):
        changes = views.incremental(old, change, view)
        after = views.apply_delta(views.rows(old, view), changes, view)
        assert sorted(map(str, after.collect())) == sorted(map(str, views.rows(new, view).collect()))


def test_view_actions(spark):
    df = lambda rows: rec.to_state(spark.createDataFrame(rows, "k int, c int, _ts bigint, v int, w string"), SPEC, NOW)
    old = df([(1, 1, 1, 1, "a"), (2, 1, 1, 1, "a"), (3, 1, 1, 1, "a"), (5, 1, 1, 1, "a")])
    new = df([(1, 1, 2, 2, "a"), (2, 1, 2, 1, "b"), (4, 1, 2, 1, "a"), (5, 1, 1, 1, "a")])
    gone = new.unionByName(df([(3, 1, 1, 1, "a")]).withColumn("w", F.lit(None).cast(new.schema["w"].dataType)))
    got = sorted((r.k, r.w, r.action, r._op) for r in views.delta(old, gone, VIEW).collect())
    assert got == [(1, "a", "UPDATE_EXISTING", "insert"), (2, "a", "SWITCH_ENTRY", "delete_row"),
                   (2, "b", "SWITCH_ENTRY", "insert"), (3, "a", "DELETE_OLD", "delete_row"), (4, "a", "NEW_ENTRY", "insert")]


def test_repair_makes_copies_equal(spark):
    log = [r for r in random_log(21) if r[2] != "delete_partition"]
    rng = random.Random(1)
    make = lambda rows: rec.reconcile(spark.createDataFrame(rows, SCHEMA), SPEC, NOW)
    a = make([r for r in log if rng.random() < 0.8])
    b = make([r for r in log if rng.random() < 0.8])
    fixes = replica.repair(a, b, SPEC, depth=6)
    fix = lambda t: fixes.filter(F.col("target") == t).drop("target")
    a2, b2 = rec.merge_copies([a, fix("a")], SPEC), rec.merge_copies([b, fix("b")], SPEC)
    assert replica.diff({"a": a2, "b": b2}, SPEC).count() == 0
    assert replica.same_digest({"a": a2, "b": b2}, SPEC).first().same
    assert not replica.same_digest({"a": a, "b": b}, SPEC).first().same
    assert replica.differing_leaves(replica.digest(a2, SPEC, 6), replica.digest(b2, SPEC, 6)).count() == 0


def test_digest_levels_agree(spark):
    df = spark.range(1000).select(F.col("id").alias("k"), F.lit(1).alias("c"))
    tree = replica.levels(replica.digest(df, SPEC, 5), 5)
    per_level = {r.level: (r.d, r.n) for r in tree.groupBy("level").agg(
        F.bit_xor("digest").alias("d"), F.sum("n_rows").alias("n")).collect()}
    assert len(per_level) == 6 and len(set(per_level.values())) == 1


def test_conditional_write(spark):
    table = spark.createDataFrame([(1, 1, 5, "a"), (2, 1, 6, None)], "k int, c int, v int, w string")
    updates = spark.createDataFrame([(1, 1, 50), (2, 1, 60), (3, 1, 70)], "k int, c int, v int")
    after, result = mutate.apply_if(table, updates, SPEC, F.col("w") == "a", ["v"])
    assert sorted(tuple(r) for r in after.collect()) == [(1, 1, 50, "a"), (2, 1, 6, None)]
    assert sorted((r.k, r.applied, r.v) for r in result.collect()) == [(1, True, None), (2, False, 6), (3, False, None)]


def test_batch_rules(spark):
    rows = spark.createDataFrame([(1, 1, 5, "a")], "k int, c int, v int, w string")
    with pytest.raises(ValueError):
        mutate.batch(mutate.insert(rows, SPEC, 1), ts=5, counters=(True, False))
    with pytest.raises(ValueError):
        mutate.insert(rows, SPEC, 1, ttl=630720001)


def test_counter_errors(spark):
    df = spark.createDataFrame([(1, None)], "k int, d bigint")
    with pytest.raises(Exception, match="null counter"):
        mutate.counter_values(df, ["k"], F.col("d")).collect()
    with pytest.raises(Exception, match="negate"):
        spark.range(1).select(mutate.counter_decrement(F.lit(-(1 << 63)).cast("bigint"))).collect()


def test_expiry_is_capped(spark):
    log = mutate.insert(spark.createDataFrame([(1, 1, 5, "a")], "k int, c int, v int, w string"), SPEC, 1, ttl=630720000, now=2000000000)
    assert rec.to_state(log, SPEC, 2000000001).first()._live.exp == 2147483646


def test_dropped_column(spark):
    log = spark.createDataFrame([(1, 1, 5, "a", 10), (1, 1, None, "b", 20), (2, 1, 6, None, 30)], "k int, c int, v int, w string, _ts bigint")
    got = rec.live_rows(rec.reconcile(mutate.drop_column(log, "v", 15, readded=True), SPEC, NOW), SPEC)
    assert sorted(tuple(r) for r in got.collect()) == [(1, 1, None, "b"), (2, 1, 6, None)]

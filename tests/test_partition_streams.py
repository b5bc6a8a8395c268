"""Stream state with timers, folds of batch folders and the counter ledger."""

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from cellspark import TableSpec, ViewSpec
from cellspark.operators import lasting, views
from cellspark.operators import reconcile as rec
from cellspark.session import fresh_path
from cellspark.streaming import mutations as S
from cellspark.streaming import partitions as P
from tests.test_reconcile import NOW, SCHEMA, SPEC, random_log


def staged(spark, parts, schema=SCHEMA):
    """Each part of a log as a file of its own, read one a batch."""
    path = fresh_path(spark, "log")
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(path)
    return S.source(spark, path, spark.createDataFrame([], schema).schema, 1)


@pytest.mark.parametrize("spread", [1, 3])
def test_any_order_of_batches_gives_the_batch_state(spark, rows, spread):
    # files in no order of time, partition deletions among them; nothing is old enough to be purged
    log = random_log(17, 150)
    out, check = fresh_path(spark, "changed"), fresh_path(spark, "ck")
    view = ViewSpec(SPEC, ["w"], ["k", "c"], ["v"])
    changed = P.changed_rows(staged(spark, [log[i::3] for i in range(3)]), SPEC, gc_grace=10**6, spread=spread)
    P.run(changed, out, check, SPEC.key, fold_every=2)
    df = spark.createDataFrame(log, SCHEMA)
    state = S.current(spark, out, SPEC.key)
    for now in (NOW, 10**7):
        want = lasting.live_rows(lasting.stored(df, SPEC), SPEC, now)
        assert rows(lasting.live_rows(state, SPEC, now)) == rows(want)
    # the clock stands at the newest write; what has expired by then is out of the view
    clock = max(r[5] for r in log)
    entries = views.entries(lasting.as_of(state, SPEC, lasting.BEFORE_ALL), view).filter("entry is not null").select("entry.*")
    assert rows(entries) == rows(views.rows(rec.reconcile(df, SPEC, clock), view).select("w", "k", "c", "v"))


def test_state_ends(spark):
    spec = TableSpec(["k"], ["c"], (), ["v"])
    schema = "k int, c int, _op string, _ts bigint, _ttl int, _now bigint, v int"
    write = lambda c, at, ttl=0, v=1: (1, c, "update", at, ttl, at, v)
    tick = lambda at: [(None, None, "tick", at, 0, at, None)]
    first = [write(1, 100), write(2, 100, ttl=50), write(3, 100, v=1), (1, 3, "delete_row", 101, 0, 101, None), (1, None, "delete_partition", 60, 0, 60, None)]
    def left(until):
        out, check = fresh_path(spark, "changed"), fresh_path(spark, "ck")
        P.run(P.changed_rows(staged(spark, [first, tick(until)], schema), spec, gc_grace=1000), out, check)
        return {r.c: "live" if r.v and not r.v.dead else "stone" for r in P.state_rows(spark, check).collect()}
    assert left(149) == {1: "live", 2: "live", 3: "stone"}
    assert left(150) == {1: "live", 2: "stone", 3: "stone"}  # expired
    assert left(1102) == {1: "live"}  # grace of the expired cell and of the deletion is over


def test_readers_go_through_one_base_and_few_batches(spark, rows):
    log = [[(k, b, b)] for b in range(7) for k in [b % 2]]
    out = fresh_path(spark, "state")
    stream = S.counters(staged(spark, log, "k int, n int, b int"), ["k"], F.col("n"))
    S.upsert_sink(stream, out, fresh_path(spark, "ck"), key=["k"], fold_every=3).awaitTermination()
    assert rows(S.current(spark, out, ["k"])) == [(0, 12), (1, 9)]
    base, upto = S.manifest(spark, out)
    assert upto == 5 and len(S.batches(spark, out).select(F.input_file_name()).distinct().collect()) <= 3
    # a fold that is run again changes nothing
    S.fold(spark, out, lambda r: r, 5)
    assert S.manifest(spark, out) == (base, upto)


def test_counters_add_once_when_a_batch_runs_again(spark, rows):
    log = [[("a", b), ("b", 10 * b)] for b in range(5)]
    for stop_at in (1, 2):  # before a fold, and after the fold that holds the batch
        out, check = fresh_path(spark, "counts"), fresh_path(spark, "ck")
        stream = staged(spark, log, "k string, n int")

        def stop(batch_id):
            if batch_id == stop_at:
                raise RuntimeError("stopped")

        with pytest.raises(StreamingQueryException):
            S.counter_sink(stream, ["k"], F.col("n"), out, check, fold_every=3, written=stop).awaitTermination()
        S.counter_sink(stream, ["k"], F.col("n"), out, check, fold_every=3).awaitTermination()
        assert rows(S.counter_values(spark, out, ["k"])) == [("a", 10), ("b", 100)]

"""State in folders: every batch gives and keeps what the processor in Python does, row by row."""

from types import SimpleNamespace

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import types as T

from cellspark.operators import lasting
from cellspark.session import fresh_path
from cellspark.streaming import mutations as S
from cellspark.streaming import partitions as P
from tests.test_partition_buckets import Store
from tests.test_partition_streams import staged
from tests.test_reconcile import NOW, SCHEMA, SPEC, random_log


def by_processor(spark, parts, schema, spec, grace, late_by=0):
    """What each batch, and the going on of the clock after the last, gives out; what is kept at the end."""
    pieces = lasting.pieces(spec)
    made = []
    for part in parts:
        log = P._timed(spark.createDataFrame(part, schema))
        made.append(lasting.version_rows(P._parts(log, spec, 1), spec, [*spec.key, "_row", "_op", "_now", "_pdel"]).collect())
    types = lasting.versions(log, spec).schema
    key_type, row_type = (T.StructType([types[c] for c in names]) for names in (spec.ck, pieces))
    held, given, clock = {}, [], 0
    for rows in [*made, []]:
        now, out, by_pk = max(clock, late_by), [], {}
        at = SimpleNamespace(getCurrentWatermarkInMs=lambda: (now - late_by) * 1000)
        for r in rows:
            clock = max(clock, r._now)
            if r._op != "tick":
                pk = tuple(r[c] for c in spec.pk)
                by_pk.setdefault(pk, []).append((*pk, "row" if r._row else "delete_partition", r._pdel, tuple(r[c] for c in spec.ck), *[r[p] for p in pieces]))
        for pk in {*by_pk, *held}:
            if pk not in held:
                held[pk] = p, store = P.PartitionState(spec, key_type, row_type, grace, late_by), Store()
                p.init(store)
            p, store = held[pk]
            if pk in by_pk:
                out += p.handleInputRows(pk, iter(by_pk[pk]), at)
            while due := sorted(t for t in store.timers if t <= (now - late_by) * 1000):
                store.timers.remove(due[0])
                out += p.handleExpiredTimer(pk, at, SimpleNamespace(getExpiryTimeInMs=lambda: due[0]))
        given.append(sorted((tuple(P.plain(r[c]) for c in (*spec.key, *pieces)) for r in out), key=repr))
    kept = [(*pk, *key, *row) for pk, (_, store) in held.items() for bucket, _ in store.vars["rows"].values() for key, *row, _ in map(P.plain, bucket)]
    return given, sorted(kept, key=repr)


def by_folders(spark, parts, schema, spec, grace, late_by=0, spread=2):
    out, check = fresh_path(spark, "changed"), fresh_path(spark, "ck")
    P.run(P.changed_rows(staged(spark, parts, schema), spec, gc_grace=grace, late_by=late_by, spread=spread), out, check)
    columns = (*spec.key, *lasting.pieces(spec))
    tuples = lambda df: sorted((tuple(P.plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    steps = [*range(0, 2 * len(parts), 2), 2 * len(parts) - 1]
    given = {r.b: [] for r in spark.read.parquet(out).select("b").distinct().collect()}
    for b in given:
        given[b] = tuples(spark.read.parquet(f"{out}/b={b}"))
    return [given.get(b, []) for b in steps], tuples(P.state_rows(spark, check))


@pytest.mark.parametrize("seed, grace, late_by, full", [(2, 20, 0, 4), (3, 5, 930, 4), (5, 5, 0, 0)])
def test_batches_are_those_of_the_processor(spark, monkeypatch, seed, grace, late_by, full):
    # no FULL: only the first step writes all rows, and each later one those it changes
    monkeypatch.setattr(P, "FULL", full)
    log = sorted(random_log(seed, 180), key=lambda r: r[5] + 37 * (r[3] % 3))  # times in some order, late ones among them
    log += [(None, 3, "update", 41, 0, 950, ["v"], 4, None), (None, None, "delete_partition", 40, 0, 990, None, None, None)]
    parts = [log[i:i + 61] for i in range(0, len(log), 61)] + [[(None, None, "tick", 0, 0, 1040, None, None, None)]]
    given, kept = by_processor(spark, parts, SCHEMA, SPEC, grace, late_by)
    got, left = by_folders(spark, parts, SCHEMA, SPEC, grace, late_by)
    assert [len(g) for g in got] == [len(g) for g in given]
    assert got == given and left == kept
    assert any(given) and any(kept)


def test_a_stopped_stream_goes_on(spark, rows, monkeypatch):
    # the second batch is stopped between the write of its rows and that of what was given out; a third comes later
    log = random_log(7, 90)
    path = fresh_path(spark, "log")
    add = lambda part: spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(path)
    out, check, put = fresh_path(spark, "changed"), fresh_path(spark, "ck"), S.put_batch

    def stopped(given, to, step, *more):
        if step == 2:
            raise RuntimeError("stopped")
        put(given, to, step, *more)

    go = lambda: P.run(P.changed_rows(S.source(spark, path, spark.createDataFrame([], SCHEMA).schema, 1), SPEC, gc_grace=10**6, spread=2), out, check)
    add(log[:30])
    add(log[30:60])
    monkeypatch.setattr(S, "put_batch", stopped)
    with pytest.raises(StreamingQueryException):
        go()
    monkeypatch.setattr(S, "put_batch", put)
    go()
    add(log[60:])
    go()
    want = lasting.live_rows(lasting.stored(spark.createDataFrame(log, SCHEMA), SPEC), SPEC, NOW)
    assert rows(lasting.live_rows(S.current(spark, out, SPEC.key), SPEC, NOW)) == rows(want)
    assert rows(lasting.live_rows(P.state_rows(spark, check), SPEC, NOW)) == rows(want)


def test_the_processor_as_a_streaming_dataframe(spark, rows):
    log = random_log(11, 60)
    out, check = fresh_path(spark, "changed"), fresh_path(spark, "ck")
    P.run(P.processed_rows(staged(spark, [log]), SPEC, gc_grace=10**6, spread=2), out, check, SPEC.key)
    want = rows(lasting.live_rows(lasting.stored(spark.createDataFrame(log, SCHEMA), SPEC), SPEC, NOW))
    assert rows(lasting.live_rows(S.current(spark, out, SPEC.key), SPEC, NOW)) == want
    assert rows(lasting.live_rows(P.state_rows(spark, check), SPEC, NOW)) == want

"""State that is read, merged and compacted at times other than the one it was built at."""

import random

import pytest
from pyspark.sql import functions as F

from cellspark import TableSpec
from cellspark.operators import lasting, mutate
from cellspark.operators import reconcile as rec
from tests.test_reconcile import SCHEMA, SPEC, random_log


def read(state, now):
    return {(r.k, r.c): (r.v, r.w) for r in lasting.live_rows(state, SPEC, now).collect()}


def direct(df, now):
    return {(r.k, r.c): (r.v, r.w) for r in rec.live_rows(rec.reconcile(df, SPEC, now), SPEC).collect()}


TIMES = (0, 960, 1000, 10**7)


@pytest.mark.parametrize("seed", [1])
def test_one_state_read_at_any_time(spark, seed):
    # few write times and short lives: many ties of cells that expire at different times
    rng = random.Random(seed)
    log = [(*r[:3], r[3] % 6, rng.choice([0, 20, 45, 70]) if r[2] in ("insert", "update") else 0, *r[5:]) for r in random_log(seed, 500)]
    df = spark.createDataFrame(log, SCHEMA)
    state = lasting.stored(df, SPEC).cache()
    for now in TIMES:
        assert read(state, now) == direct(df, now)


def test_expiry_long_after_the_build(spark):
    spec = TableSpec(["k"], (), (), ["v"])
    df = spark.createDataFrame([(1, 7, 5_000_000, 10), (2, 8, 5_000_000, 0)], "k int, v int, _ts bigint, _ttl int")
    state = lasting.stored(df, spec)
    keys = lambda now: sorted(r.k for r in lasting.live_rows(state, spec, now).collect())
    assert keys(5) == [1, 2] and keys(14) == [1, 2] and keys(15) == [2] and keys(10**7) == [2]
    assert lasting.compact(state, spec, 10**7, gc_grace=100).count() == 1
    # the state of one time, compacted at a later one
    assert rec.compact(rec.reconcile(df, spec, 5), spec, 10**7, gc_grace=100).count() == 1


def test_states_of_different_times_merge(spark):
    log = [r for r in random_log(9) if r[2] != "delete_partition"]
    parts = [lasting.merge(lasting.versions(spark.createDataFrame(log[i::3], SCHEMA), SPEC), SPEC) for i in range(3)]
    parts[1] = lasting.compact(parts[1], SPEC, 945, gc_grace=10**6)
    parts[2] = lasting.compact(parts[2], SPEC, 960, gc_grace=10**6)
    merged = lasting.shadow(lasting.merge(parts[0].unionByName(parts[1]).unionByName(parts[2]), SPEC), SPEC)
    for now in TIMES[1:]:
        assert read(merged, now) == direct(spark.createDataFrame(log, SCHEMA), now)


@pytest.mark.parametrize("grace", [0, 30])
def test_compaction_at_a_time_is_that_of_its_state(spark, grace):
    df = spark.createDataFrame(random_log(12), SCHEMA)
    for now in (960, 1100):
        kept = lasting.compact(lasting.stored(df, SPEC), SPEC, now, gc_grace=grace)
        want = rec.compact(rec.reconcile(df, SPEC, now), SPEC, now, gc_grace=grace)
        shown = lambda s: {tuple(r[:2]): (r._live, r._del, r.v, r.w) for r in s.collect()}
        assert shown(lasting.as_of(kept, SPEC, now)) == shown(want)


def test_tie_by_bytes_keeps_both(spark):
    spec = TableSpec(["k"], (), (), ["v"])
    df = spark.createDataFrame([(1, 3, 5, 900, 50), (1, 9, 5, 900, 0)], "k int, v int, _ts bigint, _now bigint, _ttl int")
    state = lasting.stored(df, spec, tie="bytes")
    shown = lambda now: [r.v for r in lasting.live_rows(state, spec, now).collect()]
    assert shown(949) == [9] and shown(950) == []


DEEP = TableSpec(["k"], ["a", "b", "c"], (), ["v"])


@pytest.mark.parametrize("piece_rows", [7, 60, None])
def test_slices_by_brute_force(spark, piece_rows):
    rng = random.Random(piece_rows or 0)
    rows = list({(0 if rng.random() < 0.6 else rng.randrange(1, 5), rng.randrange(4), rng.choice("xyz"), rng.randrange(6)): rng.randrange(100) for _ in range(500)}.items())
    slices, frames = [], []
    for _ in range(60):
        prefix = [rng.randrange(4), rng.choice("xyz"), rng.randrange(6)]
        lo, hi = prefix[: rng.randrange(4)], [rng.randrange(4), rng.choice("xyz"), rng.randrange(6)][: rng.randrange(4)]
        if rng.random() < 0.6:  # a slice below a fixed prefix
            n = rng.randrange(1, 3)
            lo, hi = prefix[:n] + lo[n:], prefix[:n] + hi[n:]
        slices.append((0 if rng.random() < 0.6 else rng.randrange(1, 6), lo, hi, rng.random() < 0.5, rng.random() < 0.5, rng.randrange(100)))
    def covers(s, key):
        _, lo, hi, lo_incl, hi_incl, _ = s
        low, high = key[: len(lo)], key[: len(hi)]
        return (not lo or low > tuple(lo) or (lo_incl and low == tuple(lo))) and (not hi or high < tuple(hi) or (hi_incl and high == tuple(hi)))
    want = {key for key, ts in rows if not any(s[0] == key[0] and covers(s, key[1:]) and s[5] >= ts for s in slices)}
    log = spark.createDataFrame([(*key, 1, ts) for key, ts in rows], "k int, a int, b string, c int, v int, _ts bigint")
    pad = lambda x: tuple(x) + (None,) * (3 - len(x)) if x else None
    bound = "struct<a: int, b: string, c: int>"
    cuts = spark.createDataFrame([(k, pad(lo), pad(hi), i, j, ts, 0) for k, lo, hi, i, j, ts in slices],
                                 f"k int, lo {bound}, hi {bound}, lo_incl boolean, hi_incl boolean, _ts bigint, _now bigint")
    state = rec.merge_states(rec.to_state(log, DEEP, 1000), DEEP)
    left = rec.live_rows(rec.shadow(rec.with_range_deletions(state, cuts, DEEP, piece_rows), DEEP), DEEP)
    assert {(r.k, r.a, r.b, r.c) for r in left.collect()} == want


def test_delete_slices(spark):
    rows = [(p, a, b, c) for p in range(2) for a in range(3) for b in "xy" for c in range(3)]
    log = spark.createDataFrame([(*r, 1, 1) for r in rows], "k int, a int, b string, c int, v int, _ts bigint")
    one = spark.createDataFrame([(0,)], "k int")
    def left(*slices):
        ranges = mutate.ranges_of(DEEP, log, *slices)
        state = rec.reconcile(log, DEEP, 1000, ranges=ranges)
        return {(r.k, r.a, r.b, r.c) for r in rec.live_rows(state, DEEP).collect()}
    cut = lambda **by: mutate.delete_slices(one, DEEP, 5, 5, **by)
    gone = lambda keep: {r for r in rows if r[0] == 1 or keep(r)}
    assert left(cut(equal={"a": 1}, lo="x", lo_inclusive=False)) == gone(lambda r: not (r[1] == 1 and r[2] > "x"))
    assert left(cut(equal={"a": 1, "b": "y"}, lo=0, hi=2, lo_inclusive=False, hi_inclusive=False)) == gone(lambda r: r[1:3] != (1, "y") or r[3] != 1)
    assert left(cut(equal={"a": 2}), cut(hi=0)) == gone(lambda r: r[1] == 1)
    assert left(cut(lo=[1, "x", 1], lo_inclusive=False)) == gone(lambda r: r[1:] <= (1, "x", 1))
    assert left(cut(equal={"a": 1}, lo="y", hi="x")) == set(rows)  # empty
    assert left(cut()) == gone(lambda r: False)
    with pytest.raises(ValueError):
        cut(equal={"b": "x"})


def test_an_outlier_does_not_fill_one_piece(spark, monkeypatch):
    # all values but one lie close together, in one partition
    log = spark.range(8000).select(F.lit(1).alias("k"), F.when(F.col("id") == 0, 10**15).otherwise(F.col("id")).alias("c"),
                                   F.lit(1).alias("v"), F.lit(1).cast("bigint").alias("_ts"))
    spec = TableSpec(["k"], ["c"], (), ["v"])
    cuts = spark.range(400).select(F.lit(1).alias("k"), (F.col("id") * 10).alias("lo"), (F.col("id") * 10 + 4000).alias("hi"),
                                   F.lit(True).alias("lo_incl"), F.lit(True).alias("hi_incl"), F.col("id").alias("_ts"), F.lit(0).alias("_now"))
    from cellspark.operators import ranges
    written, write = {}, ranges.materialize
    monkeypatch.setattr(ranges, "materialize", lambda df, label: written.setdefault(label, write(df, label)))
    found = ranges.covering(log, cuts, spec, 1000)
    assert {r.c: r._rdel.ts for r in found.collect()} == {c: min(399, c // 10) for c in range(1, 7991)}
    sizes = [r["count"] for r in written["events"].groupBy("piece").count().collect()]
    assert len(sizes) == 9 and max(sizes) < 2000


def test_only_large_partitions_are_cut(spark, monkeypatch):
    # one partition of 3000 rows among 100 of 30: the small ones are not laid out by a range shuffle
    log = spark.range(6000).select(F.when(F.col("id") < 3000, -1).otherwise(F.col("id") % 100).alias("k"), F.col("id").alias("c"),
                                   F.lit(1).alias("v"), F.lit(1).cast("bigint").alias("_ts"))
    log = log.unionByName(log.filter("c % 7 = 0"))  # rows written twice find the same deletion
    spec = TableSpec(["k"], ["c"], (), ["v"])
    cuts = spark.range(101).select((F.col("id") - 1).alias("k"), F.lit(1000).cast("bigint").alias("lo"), F.lit(4000).cast("bigint").alias("hi"),
                                   F.lit(True).alias("lo_incl"), F.lit(False).alias("hi_incl"), F.lit(9).cast("bigint").alias("_ts"), F.lit(0).alias("_now"))
    from cellspark.operators import ranges
    written, write = {}, ranges.materialize
    monkeypatch.setattr(ranges, "materialize", lambda df, label: written.setdefault(label, write(df, label)))
    found = ranges.covering(log, cuts, spec, 1000).collect()
    assert sorted(r.c for r in found) == list(range(1000, 4000)) and {r._rdel.ts for r in found} == {9}
    assert {r.k for r in written["events"].select("k").distinct().collect()} == {-1}
    written.clear()
    assert len(ranges.covering(log, cuts, spec).collect()) == 3000 and "events" not in written

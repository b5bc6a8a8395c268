import random

import pytest
from pyspark.sql import functions as F

from cellspark import TableSpec
from cellspark.operators import maintenance, mutate
from cellspark.operators import reconcile as rec

SPEC = TableSpec(["k"], ["c"], (), ["v", "w"])
NOW = 1000
SCHEMA = "k int, c int, _op string, _ts bigint, _ttl int, _now bigint, _set array<string>, v int, w string"


def random_log(seed, n=400):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        op = rng.choices(["insert", "update", "delete_row", "delete_cells", "delete_partition"], [4, 5, 1, 1, 0.3])[0]
        k, c, ts = rng.randrange(6), rng.randrange(5), rng.randrange(40)
        written = rng.randrange(900, 1000)
        ttl = rng.choice([0, 0, 50, 10**6]) if op in ("insert", "update") else 0
        names = rng.choice([["v"], ["w"], ["v", "w"]])
        value = lambda x: None if rng.random() < 0.2 else x
        out.append((k, None if op == "delete_partition" else c, op, ts, ttl, written,
                    names if op != "delete_row" and op != "delete_partition" else None,
                    value(rng.randrange(5)) if op in ("insert", "update") and "v" in names else None,
                    value(rng.choice("xyz")) if op in ("insert", "update") and "w" in names else None))
    return out


def model(log):
    """Cell by cell: the winning version, then deletions, then what is alive."""
    out = {}
    keys = {(r[0], r[1]) for r in log if r[1] is not None}
    for key in keys:
        mine = [r for r in log if (r[0], r[1]) == key]
        gone = max([r[3] for r in mine if r[2] == "delete_row"]
                   + [r[3] for r in log if r[0] == key[0] and r[2] == "delete_partition"], default=-1)
        values, alive = [], False
        for i, name in ((7, "v"), (8, "w")):
            versions = []
            for r in mine:
                if r[2] in ("insert", "update", "delete_cells") and name in r[6]:
                    expires = r[5] + r[4] if r[4] else 2147483647
                    dead = r[i] is None or expires <= NOW
                    ldt = r[5] if r[i] is None else expires
                    versions.append((r[3], dead, r[i] is not None, r[i] if r[i] is not None else 0 if i == 7 else "", ldt))
            best = max(versions, default=None)
            live = best is not None and not best[1] and best[0] > gone
            values.append(best[3] if live else None)
            alive = alive or live
        inserts = [(r[3], bool(r[4]) and r[5] + r[4] <= NOW, bool(r[4]), r[5] + r[4]) for r in mine if r[2] == "insert"]
        if inserts:
            best = max(inserts)
            alive = alive or (best[0] > gone and not best[1])
        if alive:
            out[key] = tuple(values)
    return out


def read(spark, log):
    df = spark.createDataFrame(log, SCHEMA)
    return {(r.k, r.c): (r.v, r.w) for r in rec.live_rows(rec.reconcile(df, SPEC, NOW), SPEC).collect()}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_matches_cell_by_cell_model(spark, seed):
    log = random_log(seed)
    assert read(spark, log) == model(log)


def test_order_and_repetition_do_not_matter(spark):
    log = random_log(7)
    shuffled = log + log[:150]
    random.Random(0).shuffle(shuffled)
    assert read(spark, log) == read(spark, shuffled)


def test_merge_is_associative(spark):
    log = [r for r in random_log(11) if r[2] != "delete_partition"]
    df = spark.createDataFrame(log, SCHEMA)
    whole = rec.reconcile(df, SPEC, NOW)
    parts = [rec.merge_states(rec.to_state(spark.createDataFrame(log[i::3], SCHEMA), SPEC, NOW), SPEC) for i in range(3)]
    left = rec.merge_states(rec.merge_states(parts[0].unionByName(parts[1]), SPEC).unionByName(parts[2]), SPEC)
    a = {tuple(r[:2]): r for r in whole.collect()}
    b = {tuple(r[:2]): r for r in rec.shadow(left, SPEC).collect()}
    assert a == b


def test_ties(spark):
    one = lambda *cells: [(1, 1, "insert", 5, ttl, now, ["v"], v, None) for v, ttl, now in cells]
    assert read(spark, one((3, 0, 900), (7, 0, 900)))[(1, 1)] == (7, None)  # larger value
    assert read(spark, one((3, 0, 900), (None, 0, 900)))[(1, 1)] == (None, None)  # a tombstone beats a value
    assert read(spark, one((9, 0, 900), (3, 50, 900))).get((1, 1)) is None  # so does an expired cell (and liveness)


def test_tie_by_signed_bytes(spark):
    spec = TableSpec(["k"], (), (), ["v"])
    df = spark.createDataFrame([(1, 127, 5), (1, 128, 5), (2, -1, 5), (2, 1, 5)], "k int, v int, _ts bigint")
    got = {r.k: r.v for r in rec.live_rows(rec.reconcile(df, spec, NOW, tie="bytes"), spec).collect()}
    # 0x0000007f > 0x00000080 as signed bytes, and 0xffffffff is below 0x00000001
    assert got == {1: 127, 2: 1}


def test_map_cells(spark):
    spec = TableSpec(["k"], (), (), ["m"])
    df = spark.createDataFrame([(1, {"a": 1}, 5), (1, {"b": 2, "a": 3}, 6)], "k int, m map<string,int>, _ts bigint")
    assert rec.live_rows(rec.reconcile(df, spec, NOW), spec).first().m == {"a": 3, "b": 2}


@pytest.mark.parametrize("bin_rows", [3, 50, 100000])
def test_range_deletes_by_brute_force(spark, bin_rows):
    rng = random.Random(bin_rows)
    # one partition holds most rows and most ranges
    rows = [(0 if rng.random() < 0.6 else rng.randrange(1, 8), c, rng.randrange(100), c) for c in range(600)]
    ranges = []
    for _ in range(80):
        lo, hi = sorted((rng.randrange(-20, 640), rng.randrange(-20, 640)))
        ranges.append((0 if rng.random() < 0.6 else rng.randrange(1, 10), rng.choice([lo, lo, None]), rng.choice([hi, hi, None]),
                       rng.random() < 0.5, rng.random() < 0.5, rng.randrange(100), 0))
    covers = lambda r, c: ((r[1] is None or c > r[1] or (r[3] and c == r[1]))
                           and (r[2] is None or c < r[2] or (r[4] and c == r[2])))
    want = {(k, c) for k, c, ts, _ in rows if not any(r[0] == k and covers(r, c) and r[5] >= ts for r in ranges)}
    log = spark.createDataFrame(rows, "k int, c int, _ts bigint, v int").withColumn("w", F.lit("x"))
    cuts = spark.createDataFrame(ranges, "k int, lo int, hi int, lo_incl boolean, hi_incl boolean, _ts bigint, _now bigint")
    state = rec.merge_states(rec.to_state(log, SPEC, NOW), SPEC)
    done = rec.shadow(rec.with_range_deletions(state, cuts, SPEC, bin_rows), SPEC)
    assert {(r.k, r.c) for r in rec.live_rows(done, SPEC).collect()} == want


def test_range_deletes_on_text(spark):
    spec = TableSpec(["k"], ["c"], (), ["v"])
    words = [f"{a}{b}" for a in "abcdxyzé" for b in ("", "a", "zzzzzzz", "zzzzzzza")]
    log = spark.createDataFrame([(1, w, 1, 1) for w in words], "k int, c string, v int, _ts bigint")
    cuts = spark.createDataFrame([(1, "azzzzzzz", "y", False, True, 5, 0)],
                                 "k int, lo string, hi string, lo_incl boolean, hi_incl boolean, _ts bigint, _now bigint")
    state = rec.with_range_deletions(rec.merge_states(rec.to_state(log, spec, NOW), spec), cuts, spec, 4)
    left = {r.c for r in rec.live_rows(rec.shadow(state, spec), spec).collect()}
    assert left == {w for w in words if not ("azzzzzzz" < w <= "y")}


def test_compaction_keeps_what_readers_see(spark):
    log = spark.createDataFrame(random_log(5), SCHEMA)
    state = rec.reconcile(log, SPEC, NOW)
    before = {tuple(r) for r in rec.live_rows(state, SPEC).collect()}
    for grace in (0, 50, 10**6):
        after = rec.compact(state, SPEC, NOW, gc_grace=grace)
        assert {tuple(r) for r in rec.live_rows(after, SPEC).collect()} == before
    assert rec.compact(state, SPEC, NOW, gc_grace=0).count() < state.count()


def test_tombstones_wait_for_older_data(spark):
    log = mutate.delete_rows(spark.createDataFrame([(1, 1)], "k int, c int"), SPEC, 500, now=10)
    log = log.withColumn("v", F.lit(None).cast("int")).withColumn("w", F.lit(None).cast("string"))
    state = rec.reconcile(log, SPEC, NOW, partition_deletes=False)
    assert rec.compact(state, SPEC, NOW, gc_grace=5).count() == 0
    assert rec.compact(state, SPEC, NOW, gc_grace=5, min_other_ts=400).count() == 1
    assert rec.compact(state, SPEC, NOW, gc_grace=NOW).count() == 1


def test_garbage_levels(spark):
    df = lambda rows: rec.to_state(spark.createDataFrame(rows, "k int, c int, _op string, _ts bigint, v int, w string"), SPEC, NOW)
    data = df([(1, 1, "insert", 5, 1, "a"), (2, 1, "insert", 5, 1, "a")])
    others = df([(1, 1, "update", 9, 7, None), (2, 1, "delete_row", 9, None, None)])
    count = lambda level: {(r.k, r.v is not None, r.w is not None) for r in rec.skip_garbage(data, others, SPEC, level).collect()}
    assert count("NONE") == {(1, True, True), (2, True, True)}
    assert count("ROW") == {(1, True, True)}
    assert count("CELL") == {(1, False, True)}


def test_collections(spark):
    log = spark.createDataFrame([
        (1, "a", 1, "put", 5, 0, 900), (1, "b", 2, "put", 5, 0, 900), (1, "a", 9, "put", 4, 0, 900), (1, "b", None, "remove", 6, 0, 900),
        (1, "c", 3, "put", 5, 50, 900), (2, "a", 1, "put", 5, 0, 900), (2, None, None, "overwrite", 5, 0, 900), (2, "z", 4, "put", 6, 0, 900),
        (3, "a", 1, "put", 5, 0, 900), (3, "a", None, "remove", 5, 0, 900)],
        "k int, path string, value int, _op string, _ts bigint, _ttl int, _now bigint")
    read = lambda kind: {r.k: r.v for r in rec.reconcile_collection(log, ["k"], NOW, kind).collect()}
    assert read("map") == {1: {"a": 1}, 2: {"z": 4}}
    assert read("set") == {1: ["a"], 2: ["z"]}
    assert read("list") == {1: [1], 2: [4]}


def test_counter_shards(spark):
    shards = spark.createDataFrame([
        (1, "x", "global", 1, 10, False), (1, "x", "global", 2, 7, False), (1, "x", "local", 9, 100, False),
        (1, "y", "local", 1, 3, False), (1, "y", "local", 2, 4, False), (1, "y", "remote", 99, 50, False),
        (1, "z", "remote", 5, 1, False), (1, "z", "remote", 4, 8, False), (2, "x", "remote", 1, 1, False), (2, "x", "remote", 0, 0, True)],
        "k int, shard string, kind string, clock bigint, count bigint, dead boolean")
    assert [tuple(r) for r in rec.merge_counters(shards, ["k"]).collect()] == [(1, 15)]


def test_statics(spark):
    spec = TableSpec(["k"], ["c"], ["s"], ["v"])
    log = spark.createDataFrame([(1, "update_static", 5, "a"), (1, "update_static", 6, "b"), (2, "insert", 9, "z")],
                                "k int, _op string, _ts bigint, s string")
    assert [tuple(r) for r in rec.reconcile_static(log, spec, NOW).collect()] == [(1, "b")]


def test_filter_below_the_merge_would_be_wrong(spark):
    log = spark.createDataFrame([(1, 1, "old", 1), (1, 1, "new", 2)], "k int, c int, w string, _ts bigint").withColumn("v", F.lit(1))
    above = rec.live_rows(rec.reconcile(log, SPEC, NOW), SPEC).filter("w = 'old'")
    below = rec.live_rows(rec.reconcile(log.filter("w = 'old'"), SPEC, NOW), SPEC)
    assert above.count() == 0 and below.count() == 1


def test_key_filters_reach_the_scan(spark, sf):
    from cellspark.plans.logs import LINE_LOG, LINE_NOW, line_log
    from cellspark.plans.registry import Tables

    rows = rec.live_rows(rec.reconcile(line_log(Tables(spark, sf)), LINE_LOG, LINE_NOW), LINE_LOG)
    plan = rows.filter("l_orderkey = 7 AND l_returnflag = 'A'")._jdf.queryExecution().executedPlan().toString()
    pushed = [line for line in plan.splitlines() if "PushedFilters" in line][0]
    assert "EqualTo(l_orderkey,7)" in pushed and "EqualTo(l_returnflag" not in pushed


def test_expired_blockers_by_brute_force(spark):
    rng = random.Random(3)
    files = [(f"f{i}", *sorted((rng.randrange(100), rng.randrange(100))), rng.randrange(100)) for i in range(60)]
    want = {}
    for b in files:
        n = sum(1 for e in files if e[3] < 50 and b[3] > 50 and b[1] <= e[2] and b[0] != e[0])
        if n:
            want[b[0]] = n
    df = spark.createDataFrame(files, "source string, min_ts int, max_ts int, max_ldt int")
    assert {r.source: r.blocked for r in maintenance.expired_blockers(df, 50).collect()} == want


def test_scrub_and_verify(spark):
    df = spark.createDataFrame([(1, 1, 5, 1), (1, 1, 6, 2), (2, None, 5, 3), (3, 1, -9, 4)], "k int, c int, v int, ldt int")
    clean, rejected = maintenance.scrub(df, SPEC, F.col("v") > -5, F.struct("v"))
    assert sorted((r.k, r.v) for r in clean.collect()) == [(1, 6)]
    assert sorted(r.k for r in rejected.collect()) == [2, 3]
    checked = maintenance.verify(df, SPEC).first()
    assert (checked.n_rows, checked.duplicates, checked.null_keys) == (4, 1, 1)

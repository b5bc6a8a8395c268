"""Rows of a part lie in buckets: few calls of the state store, and nothing is lost when buckets split or wait."""

from collections import Counter
from types import SimpleNamespace

from pyspark.sql import functions as F

from cellspark import TableSpec
from cellspark.operators import lasting
from cellspark.streaming import partitions as P

SPEC = TableSpec(["k"], ["c"], (), ["v"])


class Store:
    """A state store in memory that counts its calls."""

    def __init__(self):
        self.calls, self.timers, self.vars = Counter(), set(), {}

    def registerTimer(self, ms):
        self.calls["timer"] += 1
        self.timers.add(ms)

    def getValueState(self, name, _):
        data = self.vars.setdefault(name, {})
        return SimpleNamespace(
            exists=lambda: self.call("exists", data.get(0) is not None), get=lambda: self.call("get", data.get(0)),
            update=lambda v: self.call("update", data.__setitem__(0, v)), clear=lambda: self.call("clear", data.clear()))

    def getMapState(self, name, *_):
        data = self.vars.setdefault(name, {})
        return SimpleNamespace(
            getValue=lambda k: self.call("getValue", data.get(k)), updateValue=lambda k, v: self.call("updateValue", data.__setitem__(k, v)),
            removeKey=lambda k: self.call("removeKey", data.pop(k, None)), keys=lambda: self.call("keys", iter(list(data))))

    def call(self, name, value):
        self.calls[name] += 1
        return value


def processor(spark, grace=1000):
    log = spark.sql("SELECT 1L AS k, 1L AS c, 'x' AS v, 1L AS _ts, 0 AS _ttl, 'insert' AS _op, 1L AS _now")
    one = lasting.versions(log, SPEC).schema
    T = type(one)
    p = P.PartitionState(SPEC, T([one["c"]]), T([one[c] for c in lasting.pieces(SPEC)]), grace, 0)
    store = Store()
    p.init(store)

    def made(rows):
        log = spark.createDataFrame(rows, "k long, c long, v string, _ts long, _ttl int").withColumn("_op", F.lit("insert")).withColumn("_now", F.expr("_ts div 1000000"))
        found = lasting.version_rows(log, SPEC, ["k", "c"]).collect()
        return [((r.k,), ("row", None, (r.c,), *[r[x] for x in lasting.pieces(SPEC)])) for r in found]

    def clock(now):
        return SimpleNamespace(getCurrentWatermarkInMs=lambda: now * 1000)

    def feed(rows, now):
        return list(p.handleInputRows((1,), iter([(*k, *r) for k, r in made(rows)]), clock(now)))

    def fire(now):
        out = []
        while due := sorted(t for t in store.timers if t <= now * 1000):
            store.timers.remove(due[0])
            out += list(p.handleExpiredTimer((1,), clock(now), SimpleNamespace(getExpiryTimeInMs=lambda t=due[0]: t)))
        return out

    return p, store, feed, fire


def test_calls_grow_with_buckets_not_rows(spark):
    p, store, feed, fire = processor(spark)
    feed([(1, c, "a", 10**6 * (100 + c), 50) for c in range(60)], 0)
    assert sum(store.calls.values()) < 20


def test_splits_keep_every_row(spark):
    p, store, feed, fire = processor(spark, grace=10**6)
    for low in range(0, 600, 150):
        feed([(1, c, f"v{c}", 10**6 * 100, 50) for c in range(low, low + 150)], 0)
    out = feed([(1, c, "new", 10**6 * 101, 900) for c in range(0, 600, 7)], 120)
    assert {r.c for r in out} == set(range(0, 600, 7))
    assert len(store.vars["rows"]) > 4 and sum(len(held) for held, _ in store.vars["rows"].values()) == 600
    # the first writes expire, each row once, but for those that were written anew
    gone = fire(400)
    assert sorted(r.c for r in gone) == [c for c in range(600) if c % 7]
    assert sorted(r.c for r in fire(2000)) == list(range(0, 600, 7))


def test_a_bucket_waits_on_when_what_it_waited_for_was_overwritten(spark):
    p, store, feed, fire = processor(spark)
    feed([(1, 1, "a", 10**6 * 100, 50), (1, 2, "b", 10**6 * 100, 300)], 0)
    feed([(1, 1, "c", 10**6 * 110, 500)], 0)
    assert fire(200) == []
    assert [r.c for r in fire(450)] == [2] and [r.c for r in fire(700)] == [1]
    fire(5000)
    assert not store.vars["rows"] and not store.vars["meta"]

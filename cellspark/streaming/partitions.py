"""Stream state that ends: partitions with their rows and newest deletion, and times for expiry and grace.

The state of a partition is its rows' lasting state by clustering key, and the partition's newest deletion. A batch
merges its mutations into the rows that they touch; a partition deletion is applied to all rows of its partition at once
and stays, so that a write that arrives later but is older is covered as well. The clock is the newest of
the mutations' wall-clock times before the batch, together with ``tick`` rows that only advance it. As it goes on,

* a cell or a row that expires becomes a tombstone, and the row is given out as changed;
* a tombstone or a deletion that has outlived the grace period is removed, and a row without anything left too.

So the state holds what a compaction at the clock would keep. Late mutations are never dropped: the clock decides expiry
and grace only. As with any compaction, a write that arrives after its deletion's grace period is seen again.

Every changed row is given out with its new state, in update mode, which is what a view or a copy needs.

A partition is split into ``spread`` parts by a hash of the clustering key; deletions are sent to all of them. With it a
hot partition lies in many tasks.

:func:`changed_rows` keeps the state in folders of the checkpoint. A batch is one aggregate over the stored rows and its
mutations, dealt to tasks by part, so all rules are Catalyst expressions. A batch that is large against what is stored
writes all rows anew, a small one only those that it changes, over which the newest of a row counts.

:func:`processed_rows` is the same as a stateful processor in Python with Spark's state store, for sinks that need a
streaming DataFrame. It touches the rows of a batch only, but each costs far more. Every call
of the state store is a round trip out of Python, so rows lie together in buckets of some ``HELD`` rows, by a hash of
the key, that are read, written and waited for as one. A small part is one bucket; buckets of a growing part split in two.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from cellspark.operators import lasting, views
from cellspark.operators import reconcile as rec
from cellspark.session import tasks_for
from cellspark.spec import TableSpec, ViewSpec
from cellspark.streaming import mutations as S

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
PART = "_part"
HELD = 64  # rows of a bucket, on average at most
NO_BUCKET = -1  # what the timer of a partition's deletion waits for


def order(x):
    """Sort key that orders values as ``max`` does: null first, then by value, structs field by field."""
    if x is None:
        return (0,)
    if isinstance(x, (tuple, list)):
        return (1, tuple(map(order, x)))
    if isinstance(x, float):
        return (1, math.isnan(x), 0.0 if math.isnan(x) else x)
    return (1, x)


class Part:
    """What one call sees of a part: its deletion and the buckets that it has read, written back by ``close``."""

    def __init__(self, state: PartitionState, timers):
        self.state = state
        self.now = timers.getCurrentWatermarkInMs() // 1000 + state.late_by
        self.before = plain(state.meta.get())
        ts, ldt, self.level, self.n = self.before or (None, None, 0, 0)
        self.deletion = None if ts is None else (ts, ldt)
        self.read: dict[int, dict] = {}
        self.waits: dict[int, int | None] = {}
        self.touched: set[int] = set()

    def bucket_of(self, key: tuple) -> int:
        return zlib.crc32(repr(key).encode("utf-8", "surrogatepass")) & ((1 << self.level) - 1)

    def buckets(self) -> list[int]:
        if not self.n:
            return []
        return sorted(plain(b)[0] for b in self.state.rows.keys()) if self.level else [0]

    def rows(self, bucket: int) -> dict[tuple, tuple[tuple, int | None]]:
        """Rows of a bucket, with the second that each waits for."""
        if bucket not in self.read:
            held, self.waits[bucket] = plain(self.state.rows.getValue((bucket,)) if self.n else None) or ([], None)
            self.read[bucket] = {key: (tuple(row), due) for key, *row, due in held}
        return self.read[bucket]

    def put(self, key: tuple, row: tuple | None, due: int | None = None) -> None:
        bucket = self.bucket_of(key)
        rows = self.rows(bucket)
        if row is None and key not in rows:
            return
        self.n += (row is not None) - (key in rows)
        self.touched.add(bucket)
        if row is None:
            del rows[key]
        else:
            rows[key] = (row, due)

    def wake(self, at: int, bucket: int) -> None:
        """Look at the bucket again at the second ``at``."""
        state = self.state
        waiting = state.due.getValue((at,))
        state.due.updateValue((at,), ([*(plain(waiting)[0] if waiting else []), bucket],))
        if waiting is None:
            state.handle.registerTimer((at - state.late_by) * 1000)

    def split(self) -> None:
        """Twice as many buckets, until they are small enough."""
        stored = self.before[3] if self.before else 0
        old = (sorted(plain(b)[0] for b in self.state.rows.keys()) if self.level else [0]) if stored else []
        every = {k: v for b in {*old, *self.read} for k, v in self.rows(b).items()}
        while self.n > HELD << self.level:
            self.level += 1
        self.read = {b: {} for b in {*old, *map(self.bucket_of, every)}}
        self.waits = dict.fromkeys(self.read)
        self.touched = set(self.read)
        for key, held in every.items():
            self.read[self.bucket_of(key)][key] = held

    def close(self) -> None:
        state = self.state
        if self.n > HELD << self.level:
            self.split()
        for bucket in sorted(self.touched):
            rows, waits = self.read[bucket], self.waits[bucket]
            if not rows:
                if self.before and self.before[3]:
                    state.rows.removeKey((bucket,))
                continue
            at = min((due for _, due in rows.values() if due is not None), default=None)
            if at is not None and (waits is None or waits <= self.now or at < waits):
                self.wake(at, bucket)
                waits = at
            state.rows.updateValue((bucket,), ([(key, *row, due) for key, (row, due) in rows.items()], waits))
        meta = (*(self.deletion or (None, None)), self.level, self.n)
        if self.deletion is None and not self.n:
            if self.before is not None:
                state.meta.clear()
        elif meta != self.before:
            state.meta.update(meta)


class PartitionState(StatefulProcessor):
    """Rows of one partition (or part of it), its deletion, and when they are due."""

    def __init__(self, spec: TableSpec, key_type: T.StructType, row_type: T.StructType, gc_grace: int, late_by: int):
        self.spec, self.key_type, self.row_type = spec, key_type, row_type
        self.gc_grace, self.late_by = gc_grace, late_by
        self.names = row_type.fieldNames()
        self.fields = {f.name: f.dataType.fieldNames() for f in row_type}

    def init(self, handle) -> None:
        self.handle = handle
        # ``_due``: the one second that the row, or the bucket, waits for
        row = T.StructType([T.StructField("_key", self.key_type), *self.row_type.fields, T.StructField("_due", T.LongType())])
        self.meta = handle.getValueState("meta", "ts bigint, ldt bigint, level int, n bigint")
        self.rows = handle.getMapState("rows", T.StructType().add("bucket", T.LongType()), T.StructType().add("held", T.ArrayType(row)).add("_due", T.LongType()))
        self.due = handle.getMapState("due", T.StructType().add("at", T.LongType()), T.StructType().add("buckets", T.ArrayType(T.LongType())))

    # -- one row ------------------------------------------------------------------------------------------------

    def merged(self, a: tuple | None, b: tuple) -> tuple:
        return b if a is None else tuple(max(x, y, key=order) for x, y in zip(a, b))

    def shadowed(self, row: tuple, deletion: tuple | None) -> tuple:
        own = dict(zip(self.names, row))
        newest = max(own["_del"], deletion, key=order)
        if newest is not None:
            own = {c: None if c != "_del" and x is not None and x[0] <= newest[0] else x for c, x in own.items()}
            if deletion is not None and own["_del"] is not None and own["_del"][0] <= deletion[0]:
                own["_del"] = None  # the partition's deletion covers it
        return tuple(own.values())

    def expired(self, row: tuple, now: int) -> tuple:
        """What is dead by ``now`` as tombstones, as ``lasting.as_of`` decides it."""
        own = dict(zip(self.names, row))
        for c in ("_live", *self.spec.regular):
            if own[c] is None:
                continue
            best = dict(zip(self.fields[c], own[c]))
            early = dict(zip(self.fields[c + lasting.EARLY], own[c + lasting.EARLY] or ()))
            end = "exp" if c == "_live" else "ldt"
            gone = best["ttl"] is not None and best[end] <= now
            early_gone = early.get("ts") == best["ts"] and early[end] <= now
            if not gone and not early_gone:
                if early and early["ts"] != best["ts"]:
                    own[c + lasting.EARLY] = None
                continue
            own[c + lasting.EARLY] = None
            chosen = best if gone else early
            if c == "_live":
                own[c] = (best["ts"], True, True, chosen["exp"], chosen["ttl"])
            else:
                stone = {"ts": best["ts"], "dead": True, "ldt": chosen["ldt"] - chosen["ttl"]}
                own[c] = tuple(stone.get(n) for n in self.fields[c])
        return tuple(own.values())

    def purged(self, row: tuple, now: int) -> tuple | None:
        before = now - self.gc_grace
        own = dict(zip(self.names, row))
        for c in self.spec.regular:
            cell = dict(zip(self.fields[c], own[c] or ()))
            if cell and cell["dead"] and cell["ldt"] < before:
                own[c] = None
        if own["_live"] is not None and own["_live"][1] and own["_live"][3] < before:
            own["_live"] = None
        if own["_del"] is not None and own["_del"][1] < before:
            own["_del"] = None
        return tuple(own.values()) if any(x is not None for x in own.values()) else None

    def next_due(self, row: tuple, now: int) -> int | None:
        """The next second at which this row changes by itself."""
        own, times = dict(zip(self.names, row)), []
        for c in self.spec.regular:
            for x in (c, c + lasting.EARLY):
                cell = dict(zip(self.fields[x], own[x] or ()))
                if cell:
                    times.append(cell["ldt"] + self.gc_grace + 1 if cell.get("dead") else cell["ldt"] if cell["ttl"] is not None else None)
        if own["_live"] is not None and own["_live"][2]:
            times.append(own["_live"][3] + (self.gc_grace + 1 if own["_live"][1] else 0))
        if own["_live" + lasting.EARLY] is not None:
            times.append(own["_live" + lasting.EARLY][2])
        if own["_del"] is not None:
            times.append(own["_del"][1] + self.gc_grace + 1)
        return min((t for t in times if t is not None and t > now), default=None)

    # -- the partition ------------------------------------------------------------------------------------------

    def settle(self, pk: tuple, part: Part, key: tuple, row: tuple) -> Iterator[Row]:
        """Store what is to be kept of a row, and give it out."""
        row = self.expired(row, part.now)
        self.keep(part, key, row)
        shown = {f.name: dict(zip(f.dataType.fieldNames(), x)) if x is not None else None for f, x in zip(self.row_type, row)}
        yield Row(**dict(zip(self.spec.pk, pk)), **dict(zip(self.spec.ck, key)), **shown)

    def keep(self, part: Part, key: tuple, row: tuple) -> None:
        kept = self.purged(row, part.now)
        part.put(key, kept, None if kept is None else self.next_due(kept, part.now))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        part, pk = Part(self, timerValues), tuple(key)
        newest, changed = part.deletion, {}
        for row in rows:
            what, deletion, own, *pieces = tuple(row)[len(pk) :]
            if what == "delete_partition":
                newest = max(newest, plain(deletion), key=order)
            elif what == "row":
                own = plain(own)
                changed[own] = self.merged(changed.get(own), tuple(map(plain, pieces)))
        if newest != part.deletion:
            if newest[1] >= part.now - self.gc_grace:
                part.deletion = newest
                part.wake(newest[1] + self.gc_grace + 1, NO_BUCKET)
            for bucket in part.buckets():
                for k, (row, _) in list(part.rows(bucket).items()):
                    if k not in changed and (left := self.shadowed(row, newest)) != row:
                        yield from self.settle(pk, part, k, left)
        for k, row in changed.items():
            old, _ = part.rows(part.bucket_of(k)).get(k, (None, None))
            yield from self.settle(pk, part, k, self.shadowed(self.merged(old, row), newest))
        part.close()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        part, at = Part(self, timerValues), expiredTimerInfo.getExpiryTimeInMs() // 1000 + self.late_by
        waiting = plain(self.due.getValue((at,)))
        self.due.removeKey((at,))
        if part.deletion is not None and part.deletion[1] < part.now - self.gc_grace:
            part.deletion = None
        for bucket in dict.fromkeys(waiting[0] if waiting else []):
            if bucket == NO_BUCKET:
                continue
            for k, (row, due) in list(part.rows(bucket).items()):
                if due is None or due > part.now:
                    continue
                left = self.expired(row, part.now)
                if left == row:
                    self.keep(part, k, row)
                else:
                    yield from self.settle(tuple(key), part, k, left)
            # what it waited for may have been overwritten: wait for the next
            part.touched.add(bucket)
        part.close()


def plain(x):
    """Structs, which come as rows or as dicts, as tuples, all the way down."""
    if isinstance(x, dict):
        x = tuple(x.values())
    return tuple(map(plain, x)) if isinstance(x, tuple) else [plain(v) for v in x] if isinstance(x, list) else x


def ticks(times: DataFrame, seconds: str) -> DataFrame:
    """Rows of a log that only advance the clock to ``seconds``; union them with ``allowMissingColumns``."""
    return times.select(F.lit("tick").alias("_op"), F.col(seconds).cast("bigint").alias("_now"), (F.col(seconds) * 1000000).alias("_ts"))


def _timed(log: DataFrame) -> DataFrame:
    """The log's mutations and ticks, with their wall-clock seconds and operations filled in."""
    written_at = rec._meta(log, "_now", F.call_function("div", F.col("_ts"), F.lit(1000000))).cast("bigint")
    op = rec._meta(log, "_op", F.lit("insert"))
    return log.withColumns({"_now": written_at, "_op": op}).filter(F.col("_op").isin(*rec.ROW_OPS, "delete_partition", "tick"))


def _parts(timed: DataFrame, spec: TableSpec, spread: int) -> DataFrame:
    """One pass over the log: a row mutation goes to the part of its clustering key, a deletion or a tick to every part."""
    is_row = F.col("_op").isin(*rec.ROW_OPS)
    parts = F.when(is_row, F.array(F.pmod(F.xxhash64(*spec.ck), F.lit(spread)) if spec.ck else F.lit(0).cast("bigint"))).otherwise(
        F.sequence(F.lit(0).cast("bigint"), F.lit(spread - 1).cast("bigint")))
    sent = timed.withColumns({
        PART: F.explode(parts), "_row": is_row, **{c: F.when(is_row, F.col(c)) for c in spec.ck},
        "_pdel": F.when(F.col("_op") == "delete_partition", F.struct(F.col("_ts").cast("bigint").alias("ts"), F.col("_now").alias("ldt")))})
    meta = [c for c in ("_op", "_ts", "_ttl", "_now", "_set") if c in timed.columns]
    return sent.select(*spec.pk, PART, "_row", *spec.ck, "_pdel", *meta, *spec.regular)


def processed_rows(log: DataFrame, spec: TableSpec, gc_grace: int | None = None, late_by: int = 0, spread: int = 1) -> DataFrame:
    """:func:`changed_rows` as a streaming DataFrame, by a processor in Python. The state store must be RocksDB (:func:`run`).

    ``late_by`` seconds pass before the watermark believes in a time.
    """
    timed = _timed(log).withColumn("_at", F.timestamp_seconds("_now")).withWatermark("_at", f"{late_by} seconds")
    one_row = lasting.versions(timed.filter(F.col("_op").isin(*rec.ROW_OPS)), spec)
    cells = {f.name: f.dataType for f in one_row.schema}
    row_type = T.StructType([T.StructField(p, cells[p]) for p in lasting.pieces(spec)])
    key_type = T.StructType([T.StructField(c, cells[c]) for c in spec.ck]) if spec.ck else T.StructType().add("_only", T.IntegerType())
    out = T.StructType([T.StructField(c, cells[c]) for c in spec.key] + row_type.fields)
    processor = PartitionState(spec, key_type, row_type, spec.gc_grace if gc_grace is None else gc_grace, late_by)
    key = F.struct(*spec.ck) if spec.ck else F.struct(F.lit(0).alias("_only"))
    sent = _parts(timed, spec, spread).withColumns({"_what": F.when(F.col("_row"), "row").otherwise(F.col("_op")), "_key": F.when(F.col("_row"), key)})
    sent = lasting.version_rows(sent, spec, [*spec.pk, PART, "_what", "_pdel", "_key"])
    return sent.groupBy(*spec.pk, PART).transformWithState(processor, out, "Update", "EventTime")


# -- state in folders -------------------------------------------------------------------------------------------------

@dataclass(frozen=True)
class Changes:
    """The rows that each batch of ``log`` changes, for :func:`run`; ``transform`` works as that of a DataFrame."""

    log: DataFrame
    spec: TableSpec
    gc_grace: int
    late_by: int
    spread: int
    shown: tuple[Callable[[DataFrame], DataFrame], ...] = ()

    def transform(self, fn: Callable[[DataFrame], DataFrame]) -> Changes:
        return replace(self, shown=(*self.shown, fn))


def changed_rows(log: DataFrame, spec: TableSpec, gc_grace: int | None = None, late_by: int = 0, spread: int = 1) -> Changes:
    """The rows that a stream of mutations changes, with their new lasting state.

    The clock of a batch is ``late_by`` or the newest time of the batches before it, if that is larger.
    """
    return Changes(log, spec, spec.gc_grace if gc_grace is None else gc_grace, late_by, spread)


def _true(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def _true(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def _any(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def _settled(rows: DataFrame, spec: TableSpec, now: int, grace: int) -> DataFrame:
    """What a step makes of merged rows, with what was stored of them as ``_old``, whether they have mutations as ``_hit`` and
    the newest deletion of their partition as ``_pdel``.

    As :class:`PartitionState` does row by row: what a deletion covers goes, what is dead by ``now`` becomes a tombstone
    (that row is given out), and tombstones past their grace go. What is to be done is worked out first, as
    booleans, so that each piece is made once. ``_given`` is what to give out where that is not what is kept.
    """
    pieces, cells, before = lasting.pieces(spec), ("_live", *spec.regular), now - grace
    rows = rows.withColumn("_dts", F.greatest("_del", "_pdel")["ts"])
    above = lambda x: _true(F.col("_dts").isNull() | (x["ts"] > F.col("_dts")))
    flags, changed = {}, [F.col("_hit")]
    for c in cells:
        best, early, end = F.col(c), F.col(c + lasting.EARLY), "exp" if c == "_live" else "ldt"
        has = best.isNotNull() & above(best)
        tied = has & _true(early["ts"] == best["ts"])
        gone = has & _true(best["ttl"].isNotNull() & (best[end] <= now))
        dead = gone | (tied & _true(early[end] <= now))
        second = early.isNotNull() & above(early) & (~has | (tied & ~dead))
        of = lambda n: F.when(gone, best[n]).otherwise(early[n])
        died, was_dead = (of("exp"), best["expired"]) if c == "_live" else (of("ldt") - of("ttl"), best["dead"])
        purged = has & _true(F.when(dead, died < before).otherwise(was_dead & (best[end] < before)))
        flags |= {f"_has_{c}": has, f"_gone_{c}": gone, f"_dead_{c}": dead, f"_second_{c}": second, f"_purged_{c}": purged}
        changed += [(best.isNotNull() & ~F.col(f"_has_{c}")), (early.isNotNull() & ~F.col(f"_second_{c}")),
                    F.col(f"_gone_{c}") & ~_true(best["expired"]) if c == "_live" else F.col(f"_gone_{c}")]
    has = F.col("_del").isNotNull() & ~_true(F.col("_del.ts") <= F.col("_pdel.ts"))
    flags |= {"_has__del": has, "_purged__del": has & _true(F.col("_del.ldt") < before)}
    changed.append(F.col("_del").isNotNull() & ~F.col("_has__del"))

    young = lambda d: _true(d["ldt"] >= before)
    old = F.col("_old._pdel")
    deletion = F.when(~F.col("_row"), F.when(young(F.col("_pdel")), F.col("_pdel")).when(young(old), old))
    rows = rows.withColumns(flags | {"_kdel": deletion})
    purges = _any([F.col(f"_purged_{c}") for c in (*cells, "_del")])
    rows = rows.withColumns({"_changed": F.col("_row") & _any(changed), "_purges": purges})

    shown, kept = {"_del": F.when(F.col("_has__del"), F.col("_del"))}, {}
    for c in cells:
        best, early = F.col(c), F.col(c + lasting.EARLY)
        of = lambda n: F.when(F.col(f"_gone_{c}"), best[n]).otherwise(early[n])
        if c == "_live":
            stone = {"ts": best["ts"], "expired": F.lit(True), "expiring": F.lit(True), "exp": of("exp"), "ttl": of("ttl")}
        else:
            stone = {"ts": best["ts"], "dead": F.lit(True), "ldt": of("ldt") - of("ttl")}
        fields = rows.schema[c].dataType.fields
        tombstone = F.struct(*[stone.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in fields])
        shown[c] = F.when(F.col(f"_dead_{c}"), tombstone).when(F.col(f"_has_{c}"), best)
        shown[c + lasting.EARLY] = F.when(F.col(f"_second_{c}"), early)
    for p, x in shown.items():
        kept[p] = x if p.endswith(lasting.EARLY) else F.when(~F.col(f"_purged_{p}"), x)
    given = F.when(F.col("_changed") & F.col("_purges"), F.struct(*[shown[p].alias(p) for p in pieces]))
    other = F.col("_changed") | F.col("_purges") | ~F.col("_kdel").eqNullSafe(F.when(~F.col("_row"), old))
    rows = rows.select(*spec.pk, PART, "_row", *spec.ck, *[kept[p].alias(p) for p in pieces], F.col("_kdel").alias("_pdel"),
                       "_changed", given.alias("_given"), other.alias("_other"))

    # the next second at which the row, or the partition's deletion, changes by itself
    live, times = F.col("_live"), [F.col(f"{d}.ldt") + grace + 1 for d in ("_del", "_pdel")]
    for c in spec.regular:
        times.append(F.when(F.col(f"{c}.dead"), F.col(f"{c}.ldt") + grace + 1).when(F.col(f"{c}.ttl").isNotNull(), F.col(f"{c}.ldt")))
        times.append(F.col(f"{c}{lasting.EARLY}.ldt"))
    times.append(F.when(live["expiring"], live["exp"] + F.when(live["expired"], grace + 1).otherwise(0)))
    times.append(F.col(f"_live{lasting.EARLY}.exp"))
    return rows.withColumn("_due", F.least(*[F.when(t > now, t) for t in times]))


#: A step of the state: batch n is step 2 n, and 2 n + 1 the going on of the clock after it. ``clock`` is the newest time
#: up to it and ``now`` what it took for the time; the state is the newest of each row in the steps ``base`` and ``parts``.
STEP = "step bigint, clock bigint, now bigint, base bigint, parts array<bigint>, held bigint, since bigint"
FULL = 4  # a step writes all rows if what was written since the last that did is over a FULLth of them


def _step(spark: SparkSession, checkpoint: str, step: int | None = None) -> Row | None:
    """What is known of a step, or of the last one."""
    path = f"{checkpoint}/kept/steps"
    try:
        return spark.read.schema(STEP).parquet(path if step is None else f"{path}/s={step}").orderBy(F.desc("step")).first()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _stored(spark: SparkSession, checkpoint: str, of: Row) -> DataFrame:
    """What the steps that make up a state have written, with the step as ``s``. Where nothing is left of a row, its pieces are null."""
    at = f"{checkpoint}/kept/rows"
    stored = spark.read.option("basePath", at).parquet(*[f"{at}/s={s}" for s in (of.base, *of.parts)])
    return stored if of.parts else stored.filter(_left(_pieces_of(stored)))


def _left(pieces: list[str]) -> Column:
    return _any([F.col(p).isNotNull() for p in (*pieces, "_pdel")])


def _newest(stored: DataFrame, of: Row) -> DataFrame:
    """The newest of each row of a state."""
    if not of.parts:
        return stored
    pieces = _pieces_of(stored)
    rest = [*pieces, "_pdel", "_due"]
    key = [c for c in stored.columns if c not in (*rest, "_changed", "_given", "s")]
    return stored.groupBy(*key).agg(F.max(F.struct("s", *rest)).alias("_r")).select(*key, "_r.*").filter(_left(pieces))


def _pieces_of(stored: DataFrame) -> list[str]:
    names = stored.columns
    return [c for c in names if c == "_del" or c.endswith(lasting.EARLY) or c + lasting.EARLY in names]


def _write_step(changes: Changes, settled: DataFrame, whole: bool, checkpoint: str, path: str, before: Row | None, step: int,
                clock: int, now: int, key: list[str] | None = None, fold: bool = False) -> None:
    """Write the state and the changed rows of a step, and then that it is done. A step that is run again overwrites itself."""
    spec, spark, pieces = changes.spec, settled.sparkSession, lasting.pieces(changes.spec)
    at = f"{checkpoint}/kept/rows/s={step}"
    columns = [*spec.pk, PART, "_row", *spec.ck, *pieces, "_pdel", "_due", "_changed", "_given"]
    if whole:
        rows = settled.select(*columns)
    else:
        # as a generator, since a filter would be moved down and have all that it needs worked out twice
        rows = settled.select(F.inline(F.when(F.col("_other"), F.array(F.struct(*columns)))))
    rows.write.mode("overwrite").parquet(at)
    wrote = spark.read.parquet(at)
    given = wrote.filter("_row AND _changed").select(
        *spec.key, *[F.when(F.col("_given").isNull(), F.col(p)).otherwise(F.col(f"_given.{p}")).alias(p) for p in pieces])
    for fn in changes.shown:
        given = given.transform(fn)
    S.put_batch(given, path, step, key, fold)
    n = wrote.count()
    base, parts, held, since = (step, [], n, 0) if whole else (before.base, [*before.parts, step], before.held, before.since + n)
    of = {"step": step, "clock": clock, "now": now, "base": base, "parts": parts, "held": held, "since": since}
    fields = [F.lit(v).cast(f.dataType).alias(f.name) for f in T.StructType.fromDDL(STEP) for v in [of[f.name]]]
    spark.range(1).coalesce(1).select(*fields).write.mode("overwrite").parquet(f"{checkpoint}/kept/steps/s={step}")


def _batch_step(changes: Changes, batch: DataFrame, batch_id: int, checkpoint: str, path: str, key: list[str] | None, fold: bool) -> None:
    """Merge a batch into the state, with the clock of the batches before it."""
    spec, spark, pieces = changes.spec, batch.sparkSession, lasting.pieces(changes.spec)
    before = None
    if batch_id:
        before = _step(spark, checkpoint, 2 * batch_id - 1) or _step(spark, checkpoint, 2 * batch_id - 2)
        if before is None:
            raise ValueError(f"{checkpoint} has no state of the batch before {batch_id}")
    # Java compiles no method of more bytes; the session is the stream's own
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    timed = _timed(batch)
    n, latest = timed.agg(F.count(F.lit(1)), F.max("_now")).first()
    clock = before.clock if before else 0
    now = max(changes.late_by, clock)

    # mutations travel as they are, and are made into pieces where they are merged
    group = [*spec.pk, PART]
    merged = [*group, "_row", *spec.ck]
    sent = _parts(timed.filter("_op <> 'tick'"), spec, changes.spread)
    types = lasting.versions(sent, spec).schema
    rest = [c for c in sent.columns if c not in merged]
    mutation = F.struct(*rest)
    stored = sent.limit(0).select(*merged, F.lit(0).alias("s"), F.lit(None).cast(sent.schema["_pdel"].dataType).alias("_pdel"), *[
        F.lit(None).cast(types[p].dataType).alias(p) for p in pieces]) if before is None else _stored(spark, checkpoint, before)
    stored = stored.select(*merged, F.struct(F.col("s").cast("int").alias("s"), *pieces, "_pdel").alias("_old"))
    held = before.held + before.since if before else 0
    cores = spark.sparkContext.defaultParallelism
    tasks = -(-tasks_for(spark, held + n) // cores) * cores  # in full rounds, as they are alike
    union = sent.select(*merged, mutation.alias("_m")).unionByName(stored, allowMissingColumns=True).repartition(tasks, *group)
    rows = union.select(*merged, "_old", F.col("_m").isNotNull().alias("_hit"), "_m.*").withColumn("_op", F.coalesce("_op", F.lit("stored")))
    rows = lasting.version_rows(rows, spec, [*merged, "_old", "_hit", "_pdel"])
    rows = rows.groupBy(*merged).agg(*[F.max(c).alias(c) for c in ("_old", "_hit", "_pdel", *pieces)])
    newest = F.max(F.greatest("_pdel", "_old._pdel")).over(Window.partitionBy(*group))
    rows = rows.withColumns({"_pdel": newest, **{p: F.greatest(p, f"_old.{p}") for p in pieces}})
    whole = before is None or before.held <= FULL * (before.since + n)
    _write_step(changes, _settled(rows, spec, now, changes.gc_grace), whole, checkpoint, path, before, 2 * batch_id,
                max(clock, latest or 0), now, key, fold)


def _clock_step(changes: Changes, checkpoint: str, path: str) -> None:
    """Let the clock go on to the newest time of the last batch, as no batch may follow."""
    spec, spark, pieces = changes.spec, changes.log.sparkSession, lasting.pieces(changes.spec)
    before = _step(spark, checkpoint)
    if before is None or (now := max(changes.late_by, before.clock)) <= before.now:
        return
    due = _newest(_stored(spark, checkpoint, before), before).filter(F.col("_due") <= now)
    rows = due.withColumns({"_old": F.struct(*pieces, "_pdel"), "_hit": F.lit(False), "_pdel": F.when(~F.col("_row"), F.col("_pdel"))})
    _write_step(changes, _settled(rows, spec, now, changes.gc_grace), False, checkpoint, path, before, before.step + 1, before.clock, now)


def view_entries(changed: DataFrame | Changes, view: ViewSpec) -> DataFrame | Changes:
    """The view entry, or its absence, of every changed row, for ``mutations.view_rows``.

    Rows come with what has expired already turned into tombstones, so no reading time is needed.
    """
    return changed.transform(lambda rows: views.entries(lasting.as_of(rows, view.base, lasting.BEFORE_ALL), view))


def run(stream: DataFrame | Changes, path: str, checkpoint: str, key: list[str] | None = None, fold_every: int | None = None) -> StreamingQuery:
    """Write the changed rows of each batch to ``path`` until the source is read; see ``mutations.upsert_sink``."""
    if isinstance(stream, Changes):
        def write(batch: DataFrame, batch_id: int) -> None:
            fold = bool(fold_every) and (batch_id + 1) % fold_every == 0
            _batch_step(stream, batch, batch_id, checkpoint, path, key, fold)

        query = S.each_batch(stream.log, write, checkpoint)
        query.awaitTermination()
        _clock_step(stream, checkpoint, path)
        return query
    spark = stream.sparkSession
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKS)
    try:
        query = S.upsert_sink(stream, path, checkpoint, key=key, fold_every=fold_every)
        query.awaitTermination()
        return query
    finally:
        spark.conf.set(PROVIDER, before) if before else spark.conf.unset(PROVIDER)


def state_rows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The rows that the state holds, as the columns of the key, clustering key and pieces."""
    last = _step(spark, checkpoint)
    if last is not None:
        stored = _stored(spark, checkpoint, last)
        rest = (PART, "_row", "_pdel", "_due", "_changed", "_given", "s")
        return _newest(stored, last).filter(F.col("_row")).select(*[c for c in stored.columns if c not in rest])
    found = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "rows").load()
    held = found.select("key.*", F.explode("user_map_value.held").alias("_held")).drop(PART)
    return held.select("*", "_held._key.*", "_held.*").drop("_held", "_key", "_due")

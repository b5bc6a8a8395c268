"""Streaming queries: each runs to the end of the given table and shows the result."""

from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from cellspark.operators import lasting, views
from cellspark.operators import reconcile as rec
from cellspark.plans.logs import (EVENT_LOG, EVENT_LOG_SQL, LINE_LOG, LINE_NOW, NOW, event_log, line_cells_sql, line_log,
                                  micros)
from cellspark.plans.reconcile_queries import _GC, READ_AT, at_any_time
from cellspark.plans.registry import ORACLE, Tables, query
from cellspark.plans.view_queries import BY_KIND, filtered_view
from cellspark.session import fresh_path
from cellspark.streaming import mutations as S
from cellspark.streaming import partitions as P


class Streams(Tables):
    """The given tables as streams."""

    def __getattr__(self, name):
        schema = self.spark.read.parquet(self.path(name)).schema
        # a pattern, since a file source takes a folder or a pattern but not one file's name
        return S.source(self.spark, self.path(name)[:-1] + "[t]", schema)


def streams(t) -> Streams:
    return Streams(t.spark, t.folder)


def _finish(q):
    q.awaitTermination()


def _upserted(t, df, key):
    path, checkpoint = fresh_path(t.spark, "state"), fresh_path(t.spark, "ck")
    _finish(S.upsert_sink(df, path, checkpoint))
    return S.current(t.spark, path, key)


def _merged(t, log, make, merge, fold_every=None):
    path = fresh_path(t.spark, "state")
    _finish(S.merge_sink(log, make, merge, path, fresh_path(t.spark, "ck"), fold_every=fold_every))
    return S.merged(t.spark, path, merge)


def _merged_deletions(t, log, fold_every=None):
    newest = lambda rows: rows.groupBy(*EVENT_LOG.pk).agg(F.max("_pdel").alias("_pdel"))
    return _merged(t, log, lambda batch: rec.partition_deletions(batch, EVENT_LOG), newest, fold_every)


def streamed_event_state(t):
    """Event state from two streams over the log: row state, and the newest partition deletions."""
    log = event_log(streams(t))
    state = _merged(t, log, lambda batch: S.latest_state(batch, EVENT_LOG, NOW), lambda rows: rec.merge_states(rows, EVENT_LOG))
    deletions = _merged_deletions(t, log)
    return rec.shadow(rec.with_partition_deletions(state, deletions, EVENT_LOG), EVENT_LOG)


@query("t1_stream_source", "SELECT user_id, event_id, epoch_us(ts) AS at FROM events")
def stream_source(t):
    path, checkpoint = fresh_path(t.spark, "copy"), fresh_path(t.spark, "ck")
    log = event_log(streams(t)).select("user_id", "event_id", F.col("_ts").alias("at"))
    _finish(S.append_sink(log, path, checkpoint))
    return t.spark.read.parquet(path)


@query("t2_latest_state", f"WITH {EVENT_LOG_SQL} SELECT user_id, slot, value, kind FROM state")
def latest_state(t):
    return rec.live_rows(streamed_event_state(t), EVENT_LOG)


@query("t3_late_writes", f"WITH {line_cells_sql()} SELECT * FROM lines")
def late_writes(t):
    # ship dates come in no order, so most writes arrive late
    state = _merged(t, line_log(streams(t)), lambda batch: S.latest_state(batch, LINE_LOG, LINE_NOW), lambda rows: rec.merge_states(rows, LINE_LOG))
    return rec.live_rows(rec.shadow(state, LINE_LOG), LINE_LOG)


@query("t4_retention", ORACLE["m8_compact"])
def retention(t):
    kept = S.retained(streamed_event_state(t), EVENT_LOG, NOW, gc_grace=NOW - _GC)
    state = lambda c: F.when(F.col(f"{c}.dead"), "tombstone").when(~F.col(f"{c}.dead"), "live")
    return kept.select(*EVENT_LOG.key, F.col("_live").isNotNull().alias("has_live"), state("value").alias("value_is"),
                       state("kind").alias("kind_is"), F.col("_del.ts").alias("deleted_at"))


@query("t5_counters", "SELECT user_id, event_type, sum(event_id % 10)::BIGINT AS value FROM events GROUP BY user_id, event_type")
def counters(t):
    key = ["user_id", "event_type"]
    return _upserted(t, S.counters(streams(t).events, key, F.col("event_id") % 10), key)


@query("t6_windows", """
SELECT epoch_us(time_bucket(INTERVAL 6 HOUR, ts)) AS start, event_type, count(*) AS n, max(value) AS high FROM events GROUP BY 1, 2""")
def windows(t):
    events = streams(t).events.withColumn("ts", F.col("ts").cast("timestamp"))
    w = S.windowed(events, "ts", "6 hours", {"n": F.count(F.lit(1)), "high": F.max("value")}, ["event_type"])
    flat = w.select(F.unix_micros("window.start").alias("start"), "event_type", "n", "high")
    return _upserted(t, flat, ["start", "event_type"])


@query("t7_audit", """
SELECT user_id || ':' || (event_id % 16) AS primary_key, CASE WHEN event_id % 50 = 0 THEN 'delete_partition' WHEN event_type = 'signup' THEN 'insert'
  WHEN event_type = 'error' THEN 'delete_row' ELSE 'update' END AS operation, epoch_us(ts) AS at FROM events""")
def audit(t):
    data, trail, checkpoint = (fresh_path(t.spark, x) for x in ("data", "audit", "ck"))
    _finish(S.with_audit(event_log(streams(t)), EVENT_LOG, "user_state", data, trail, checkpoint))
    return t.spark.read.parquet(trail).select("primary_key", "operation", "at")


@query("t8_view_upkeep", f"""
WITH {EVENT_LOG_SQL.replace("max(ts) AS ts FROM log WHERE op = 'delete_partition'", "0 AS ts FROM log WHERE op = 'delete_partition'")}
SELECT kind, user_id, slot, value FROM state WHERE kind IS NOT NULL""")
def view_upkeep(t):
    # row-level mutations only: partition deletions reach views through v3_incremental
    path, checkpoint = fresh_path(t.spark, "view"), fresh_path(t.spark, "ck")
    log = event_log(streams(t)).filter("_op <> 'delete_partition'")
    _finish(S.maintain_view(log, BY_KIND, NOW, path, checkpoint))
    return S.view_rows(t.spark, path, BY_KIND)


@query("v5_consolidated_view", f"""
WITH {EVENT_LOG_SQL.replace("max(ts) AS ts FROM log WHERE op = 'delete_partition'", "0 AS ts FROM log WHERE op = 'delete_partition'")}
SELECT kind, user_id, slot, value FROM state WHERE kind IS NOT NULL AND value > 40""")
def consolidated_view(t):
    view = filtered_view()
    path, checkpoint = fresh_path(t.spark, "view"), fresh_path(t.spark, "ck")
    log = event_log(streams(t)).filter("_op <> 'delete_partition'")
    _finish(S.maintain_view(log, view, NOW, path, checkpoint))
    kept = fresh_path(t.spark, "view")
    S.consolidate(t.spark, path, EVENT_LOG.key, kept)
    return S.view_rows(t.spark, kept, view)


@query("t9_replay", f"WITH {EVENT_LOG_SQL} SELECT user_id, slot, value, kind FROM state")
def replay(t):
    # every mutation is delivered twice
    log = event_log(t)
    return rec.live_rows(rec.reconcile(log.unionByName(log), EVENT_LOG, NOW), EVENT_LOG)


@query("t10_interval_rates", """
SELECT epoch_us(time_bucket(INTERVAL 1 DAY, ts)) AS start, count(*) AS n, max(value) AS high,
  quantile_disc(value, 0.5) AS p50, quantile_disc(value, 0.95) AS p95 FROM events GROUP BY 1""")
def interval_rates(t):
    events = streams(t).events.withColumn("ts", F.col("ts").cast("timestamp"))
    rates = S.interval_rates(events, "ts", "1 day", F.col("value"))
    flat = rates.select(F.unix_micros("window.start").alias("start"), "n", F.col("max").alias("high"),
                        F.col("p")[0].alias("p50"), F.col("p")[1].alias("p95"))
    return _upserted(t, flat, ["start"])


@query("t10_decaying_rate", f"""
SELECT event_type, round(sum(exp((epoch_us(ts) // 1000000 - {NOW}) / 864000.0)), 4) AS weight FROM events GROUP BY event_type""")
def decaying_rate(t):
    seconds = F.call_function("div", micros("ts"), F.lit(1000000))
    w = S.decaying_count(t.events, seconds, NOW, 864000.0, [F.col("event_type")])
    return w.select("event_type", F.round("weight", 4).alias("weight"))


SPANS, FILES = 5, 4


def staged(t, log, ticks=None):
    """The log as a stream of five batches in order of time, and a last one that only advances the clock."""
    path = fresh_path(t.spark, "log")
    low, high = log.agg(F.min("_now"), F.max("_now")).first()
    width = (high - low) // SPANS + 1 if low is not None else 1
    for i in range(SPANS):
        span = F.call_function("div", F.col("_now") - F.lit(low), F.lit(width)) == i
        log.filter(span).repartition(FILES).write.mode("append").parquet(path)
    if ticks is not None:
        log.filter(F.lit(False)).unionByName(ticks, allowMissingColumns=True).write.mode("append").parquet(path)
    return S.source(t.spark, path, log.schema, FILES)


def _clock(t):
    return P.ticks(t.spark.range(1).select(F.lit(NOW).cast("bigint").alias("s")), "s")


def _kept_rows(t, spread=4):
    """Runs the event log through partition state; gives the folder of changed rows and the state's checkpoint."""
    path, checkpoint = fresh_path(t.spark, "changed"), fresh_path(t.spark, "ck")
    changed = P.changed_rows(staged(t, event_log(t), _clock(t)), EVENT_LOG, gc_grace=NOW - _GC, spread=spread)
    P.run(changed, path, checkpoint)
    return path, checkpoint


# a row deletion that the partition's deletion covers is not kept beside it
@query("t4_bounded_state", f"""
WITH {EVENT_LOG_SQL},
kept AS ({ORACLE["m8_compact"].split("x AS (", 1)[1].rsplit(")", 1)[0]}),
own AS (SELECT k.user_id, k.slot, has_live, value_is, kind_is, CASE WHEN r.ts > coalesce(p.ts, 0) THEN deleted_at END AS deleted_at
        FROM kept k LEFT JOIN row_dels r USING (user_id, slot) LEFT JOIN part_dels p USING (user_id))
SELECT * FROM own WHERE has_live OR value_is IS NOT NULL OR kind_is IS NOT NULL OR deleted_at IS NOT NULL""")
def bounded_state(t):
    # what the state itself holds at the end, not what was read from it
    _, checkpoint = _kept_rows(t)
    state = lambda c: F.when(F.col(f"{c}.dead"), "tombstone").when(~F.col(f"{c}.dead"), "live")
    return P.state_rows(t.spark, checkpoint).select(
        *EVENT_LOG.key, F.col("_live").isNotNull().alias("has_live"), state("value").alias("value_is"), state("kind").alias("kind_is"),
        F.col("_del.ts").alias("deleted_at"))


@query("t2_state_read_later", " UNION ALL ".join(
    f"SELECT * FROM (WITH {at_any_time(now)} SELECT {now}::BIGINT AS at, user_id, slot, value, kind FROM state)" for now in READ_AT))
def state_read_later(t):
    # lasting state kept by a stream of five batches, with a base after every two, read at three times
    stream = staged(t, event_log(t))
    state = _merged(t, stream, lambda batch: S.latest_state(batch, EVENT_LOG), lambda rows: lasting.merge(rows, EVENT_LOG), fold_every=2)
    state = lasting.shadow(rec.with_partition_deletions(state, _merged_deletions(t, stream, fold_every=2), EVENT_LOG), EVENT_LOG)
    return reduce(lambda a, b: a.unionByName(b), [
        lasting.live_rows(state, EVENT_LOG, now).select(F.lit(now).cast("bigint").alias("at"), *EVENT_LOG.key, "value", "kind") for now in READ_AT])


def _view_of_stream(t, view, fold_every=None):
    path = fresh_path(t.spark, "view")
    changed = P.changed_rows(staged(t, event_log(t), _clock(t)), EVENT_LOG, gc_grace=NOW - _GC, spread=4)
    P.run(P.view_entries(changed, view), path, fresh_path(t.spark, "ck"), EVENT_LOG.key, fold_every)
    return S.view_rows(t.spark, path, view)


@query("t8_view_of_partitions", f"WITH {EVENT_LOG_SQL} SELECT kind, user_id, slot, value FROM state WHERE kind IS NOT NULL")
def view_of_partitions(t):
    # the full log: partition deletions and expiry reach the view through the stream
    return _view_of_stream(t, BY_KIND)


@query("v5_view_with_base", f"WITH {EVENT_LOG_SQL} SELECT kind, user_id, slot, value FROM state WHERE kind IS NOT NULL AND value > 40")
def view_with_base(t):
    return _view_of_stream(t, filtered_view(), fold_every=2)


@query("t9_counter_replay", "SELECT user_id, event_type, sum(event_id % 10)::BIGINT AS value FROM events GROUP BY user_id, event_type")
def counter_replay(t):
    # the stream is stopped between the write and the commit of its third batch and started again
    key, path, checkpoint = ["user_id", "event_type"], fresh_path(t.spark, "counts"), fresh_path(t.spark, "ck")
    events = t.events.withColumn("_now", F.call_function("div", micros("ts"), F.lit(1000000)))
    deltas = staged(t, events)

    def stop(batch_id):
        if batch_id == 2:
            raise RuntimeError("stopped before the commit")

    options = dict(key=key, delta=F.col("event_id") % 10, path=path, checkpoint=checkpoint, fold_every=3)
    try:
        _finish(S.counter_sink(deltas, written=stop, **options))
    except StreamingQueryException:
        pass
    _finish(S.counter_sink(deltas, **options))
    return S.counter_values(t.spark, path, key)


@query("t9_stream_replay", f"WITH {EVENT_LOG_SQL} SELECT user_id, slot, value, kind FROM state")
def stream_replay(t):
    # every mutation is delivered twice, by two streams over the same batches
    log = staged(t, event_log(t))
    changed = P.changed_rows(log.unionByName(log), EVENT_LOG, gc_grace=10**9, spread=4)
    path = fresh_path(t.spark, "changed")
    P.run(changed, path, fresh_path(t.spark, "ck"))
    return lasting.live_rows(S.current(t.spark, path, EVENT_LOG.key), EVENT_LOG, NOW)


@query("t10_decaying_stream", ORACLE["t10_decaying_rate"])
def decaying_stream(t):
    # the state knows no reading time; five batches, folded as they come
    seconds = F.call_function("div", micros("ts"), F.lit(1000000))
    stream = staged(t, t.events.withColumn("_now", seconds))
    path, key = fresh_path(t.spark, "weights"), ["event_type", "span"]
    _finish(S.upsert_sink(S.decayed_weights(stream, F.col("_now"), 864000, [F.col("event_type")]), path, fresh_path(t.spark, "ck"), key=key, fold_every=2))
    w = S.decayed_at(S.current(t.spark, path, key), NOW, 864000, ["event_type"])
    return w.select("event_type", F.round("weight", 4).alias("weight"))

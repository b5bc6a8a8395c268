"""Reconciliation, compaction and upkeep queries."""

from functools import reduce

from pyspark.sql import functions as F

from cellspark.functions import aggregates as A

from cellspark.operators import grouping, lasting, maintenance, mutate, select
from cellspark.operators import reconcile as rec
from cellspark.plans.logs import (EVENT_LOG, EVENT_LOG_SQL, LINE_LOG, LINE_NOW, NOW, event_log, line_cells_sql,
                                  line_log, micros, split_copies)
from cellspark.plans.registry import LINES, ORACLE, ORDERS, query
from cellspark.session import fresh_path, materialize
from cellspark.sources import tables
from cellspark.spec import TableSpec


def event_state(t, tie="value"):
    return rec.reconcile(event_log(t), EVENT_LOG, NOW, tie)


@query("m1_reconcile_lines", f"WITH {line_cells_sql()} SELECT * FROM lines")
def reconcile_lines(t):
    return rec.live_rows(rec.reconcile(line_log(t), LINE_LOG, LINE_NOW), LINE_LOG)


@query("m1_reconcile_group", f"""
WITH {line_cells_sql()}
SELECT l_orderkey, count(*) AS n, sum(l_quantity) AS quantity, max(l_extendedprice) AS top_price,
       arg_min(l_returnflag, l_linenumber) AS first_flag, arg_min(l_quantity, l_linenumber) AS first_quantity
FROM lines GROUP BY l_orderkey""")
def reconcile_group(t):
    rows = reconcile_lines(t)
    spec = TableSpec(["l_orderkey"], ["l_linenumber"])
    renamed = rows.withColumnsRenamed({"l_returnflag": "first_flag", "l_quantity": "first_quantity"})
    return grouping.group_by(renamed, spec, ["l_orderkey"], {
        "n": A.count_rows(), "quantity": A.sum_of(F.col("first_quantity"), "double"),
        "top_price": A.max_of(F.col("l_extendedprice"))}, first=["first_flag", "first_quantity"])


@query("m1_tie_by_bytes", """
WITH k AS (SELECT l_orderkey, l_linenumber, l_shipdate, l_suppkey::BIGINT - 50 AS v FROM lineitem),
b AS (SELECT *, list_aggregate(list_transform(range(0, 16, 2), lambda i: printf('%02x',
        ((('0x' || substr(printf('%016x', v), (i + 1)::INTEGER, 2))::INTEGER) + 128) % 256)), 'string_agg', '') AS kb FROM k)
SELECT l_orderkey, l_linenumber, arg_max(v, (l_shipdate, kb)) AS v FROM b GROUP BY l_orderkey, l_linenumber""")
def tie_by_bytes(t):
    spec = TableSpec(["l_orderkey"], ["l_linenumber"], (), ["v"])
    log = t.lineitem.select("l_orderkey", "l_linenumber", (F.col("l_suppkey") - 50).alias("v"),
                            micros("l_shipdate").alias("_ts"))
    return rec.live_rows(rec.reconcile(log, spec, LINE_NOW, tie="bytes"), spec)


@query("m2_row_merge", f"WITH {EVENT_LOG_SQL} SELECT user_id, slot, live_ts, has_live FROM state")
def row_merge(t):
    state = event_state(t).filter(rec.is_live_row(EVENT_LOG))
    # the newest insert is shown even if a later deletion covers it: re-read it from the log
    newest = rec.merge_states(rec.to_state(event_log(t), EVENT_LOG, NOW), EVENT_LOG).select(
        *EVENT_LOG.key, F.col("_live.ts").alias("live_ts"))
    return state.join(newest, EVENT_LOG.key).select(*EVENT_LOG.key, "live_ts", F.col("_live").isNotNull().alias("has_live"))


@query("m3_live_rows", f"WITH {EVENT_LOG_SQL} SELECT user_id, slot, value, kind FROM state")
def live_rows(t):
    return rec.live_rows(event_state(t), EVENT_LOG)


@query("p11_live_cells", f"WITH {EVENT_LOG_SQL} SELECT user_id, count(value) AS n_values, count(kind) AS n_kinds FROM state GROUP BY user_id")
def live_cells(t):
    return rec.live_rows(event_state(t), EVENT_LOG).groupBy("user_id").agg(
        F.count("value").alias("n_values"), F.count("kind").alias("n_kinds"))


@query("p5_writetime", f"WITH {EVENT_LOG_SQL} SELECT user_id, slot, value_ts, kind_ts FROM state")
def writetime(t):
    rows = rec.live_rows(event_state(t), EVENT_LOG, meta=True)
    return rows.select(*EVENT_LOG.key, F.col("value__writetime").alias("value_ts"), F.col("kind__writetime").alias("kind_ts"))


@query("p6_ttl", f"""
WITH {EVENT_LOG_SQL}
SELECT user_id, slot, (value_exp - {NOW})::INTEGER AS value_ttl, (kind_exp - {NOW})::INTEGER AS kind_ttl FROM state""")
def ttl(t):
    rows = rec.live_rows(event_state(t), EVENT_LOG, meta=True)
    return rows.select(*EVENT_LOG.key, select.ttl_left(F.col("value__expires"), NOW).alias("value_ttl"),
                       select.ttl_left(F.col("kind__expires"), NOW).alias("kind_ttl"))


# every purchase deletes what older orders of the customer lie within 200 days before it
_RANGES_SQL = """
ranges AS (SELECT o_custkey, o_orderdate - INTERVAL 200 DAY AS lo, o_orderdate AS hi, epoch_us(o_orderdate) - 86400000000 * 30 AS ts
           FROM orders WHERE o_orderpriority = '1-URGENT')"""


@query("m4_range_deletes", f"""
WITH {_RANGES_SQL}
SELECT o_custkey, o_orderdate, o_orderkey, o_orderstatus FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM ranges r WHERE r.o_custkey = o.o_custkey AND o.o_orderdate >= r.lo AND o.o_orderdate < r.hi
                  AND r.ts >= epoch_us(o.o_orderdate))""")
def range_deletes(t):
    spec = TableSpec(["o_custkey"], ["o_orderdate", "o_orderkey"], (), ["o_orderstatus"])
    log = t.orders.select(*spec.key, "o_orderstatus", micros("o_orderdate").alias("_ts"))
    ranges = t.orders.filter("o_orderpriority = '1-URGENT'").select(
        "o_custkey", (F.col("o_orderdate") - F.expr("INTERVAL 200 DAYS")).alias("lo"), F.col("o_orderdate").alias("hi"),
        F.lit(True).alias("lo_incl"), F.lit(False).alias("hi_incl"),
        (micros("o_orderdate") - 86400000000 * 30).alias("_ts"), F.lit(LINE_NOW).alias("_now"))
    return rec.live_rows(rec.reconcile(log, spec, LINE_NOW, ranges=ranges), spec)


# a late line of a supplier deletes lines with the same flag shipped up to 40 days before it; an early one deletes
# what comes after it in the order of flag, date and order, up to the end of the flag
_SLICES_SQL = """
slices AS (SELECT l_suppkey, l_returnflag, l_shipdate, l_orderkey, l_linenumber, epoch_us(l_shipdate) AS ts FROM lineitem),
near AS (SELECT * FROM slices WHERE l_linenumber = 6), rest AS (SELECT * FROM slices WHERE l_linenumber = 7 AND l_orderkey % 5 = 0)"""
SUPPLIED = TableSpec(["l_suppkey"], ["l_returnflag", "l_shipdate", "l_orderkey", "l_linenumber"], (), ["l_quantity"])


@query("m4_prefix_ranges", f"""
WITH {_SLICES_SQL}
SELECT l_suppkey, l_returnflag, l_shipdate, l_orderkey, l_linenumber, max(l_quantity) AS l_quantity FROM lineitem l
WHERE NOT EXISTS (SELECT 1 FROM near n WHERE n.l_suppkey = l.l_suppkey AND n.l_returnflag = l.l_returnflag
                  AND l.l_shipdate > n.l_shipdate - INTERVAL 40 DAY AND l.l_shipdate < n.l_shipdate AND n.ts - 5 * 86400000000 >= epoch_us(l.l_shipdate))
  AND NOT EXISTS (SELECT 1 FROM rest r WHERE r.l_suppkey = l.l_suppkey AND r.l_returnflag = l.l_returnflag
                  AND (l.l_shipdate, l.l_orderkey) > (r.l_shipdate, r.l_orderkey) AND r.ts + 9 * 86400000000 >= epoch_us(l.l_shipdate))
GROUP BY ALL""")
def prefix_ranges(t):
    log = t.lineitem.select(*SUPPLIED.key, "l_quantity", micros("l_shipdate").alias("_ts"))
    flag = {"l_returnflag": F.col("l_returnflag")}
    near = mutate.delete_slices(
        t.lineitem.filter("l_linenumber = 6"), SUPPLIED, micros("l_shipdate") - 5 * 86400000000, LINE_NOW, flag,
        F.col("l_shipdate") - F.expr("INTERVAL 40 DAYS"), F.col("l_shipdate"), lo_inclusive=False, hi_inclusive=False)
    rest = mutate.delete_slices(
        t.lineitem.filter("l_linenumber = 7 AND l_orderkey % 5 = 0"), SUPPLIED, micros("l_shipdate") + 9 * 86400000000, LINE_NOW, flag,
        [F.col("l_shipdate"), F.col("l_orderkey")], lo_inclusive=False)
    return rec.live_rows(rec.reconcile(log, SUPPLIED, LINE_NOW, ranges=mutate.ranges_of(SUPPLIED, t.lineitem, near, rest)), SUPPLIED)


def at_any_time(now) -> str:
    """The SQL of the event state with another reading time."""
    return EVENT_LOG_SQL.replace(str(NOW), str(now))


READ_AT = (NOW - 12 * 86400, NOW, NOW + 12 * 86400)


def _at_each_time(select: str) -> str:
    return " UNION ALL ".join(f"SELECT * FROM (WITH {at_any_time(now)} SELECT {now}::BIGINT AS at, {select})" for now in READ_AT)


def stored_events(t):
    return materialize(lasting.stored(event_log(t), EVENT_LOG), "stored")


def _read_each_time(state):
    return reduce(lambda a, b: a.unionByName(b), [
        lasting.live_rows(state, EVENT_LOG, now).select(F.lit(now).cast("bigint").alias("at"), *EVENT_LOG.key, "value", "kind") for now in READ_AT])


@query("m3_read_times", _at_each_time("user_id, slot, value, kind FROM state"))
def read_times(t):
    # one stored state, read before, at and after the usual time
    return _read_each_time(stored_events(t))


@query("m7_merge_times", _at_each_time("user_id, slot, value, kind FROM state"))
def merge_times(t):
    # three states, the second compacted early and the third late, both within grace
    log = event_log(t)
    parts = [lasting.merge(lasting.versions(p, EVENT_LOG), EVENT_LOG) for p in split_copies(log, "event_id", 3)]
    # cells that a compaction finds expired are tombstones from then on, so it may not be later than the first reading
    early = lasting.compact(parts[1], EVENT_LOG, READ_AT[0] - 86400, gc_grace=10**9)
    late = lasting.compact(parts[2], EVENT_LOG, READ_AT[0], gc_grace=10**9)
    merged = lasting.merge(parts[0].unionByName(early).unionByName(late), EVENT_LOG)
    deleted = rec.with_partition_deletions(merged, rec.partition_deletions(log, EVENT_LOG), EVENT_LOG)
    return _read_each_time(materialize(lasting.shadow(deleted, EVENT_LOG), "merged"))


@query("m5_collection", f"""
WITH e AS (SELECT user_id, props, value, epoch_us(ts) AS ts, event_type, epoch_us(ts) // 1000000 + 864000 AS exp FROM events),
el AS (SELECT user_id, props, arg_max(value, (ts, event_type <> 'purchase' AND event_type <> 'click' OR (event_type = 'purchase' AND exp <= {NOW}), value)) AS value,
   arg_max(event_type = 'error' OR event_type = 'signup' OR event_type = 'view' OR (event_type = 'purchase' AND exp <= {NOW}), (ts, event_type = 'error' OR (event_type = 'purchase' AND exp <= {NOW}))) AS dead, max(ts) AS ts
   FROM e WHERE event_type IN ('click', 'purchase', 'error') GROUP BY user_id, props),
cl AS (SELECT user_id, max(ts) AS cleared FROM e WHERE event_type = 'signup' GROUP BY user_id)
SELECT user_id, count(*) AS n, string_agg(props, ';' ORDER BY props) AS paths, min(value) AS low FROM el LEFT JOIN cl USING (user_id)
WHERE NOT dead AND (cleared IS NULL OR ts > cleared) GROUP BY user_id""")
def collection(t):
    # a map cell per user: click and purchase put an entry, error removes it, signup overwrites the map
    kind = F.col("event_type")
    op = F.when(kind == "error", "remove").when(kind == "signup", "overwrite").otherwise("put")
    log = t.events.filter("event_type <> 'view'").select(
        "user_id", F.when(kind != "signup", F.col("props")).alias("path"), "value", op.alias("_op"),
        micros("ts").alias("_ts"), F.when(kind == "purchase", 864000).otherwise(0).alias("_ttl"))
    m = rec.reconcile_collection(log, ["user_id"], NOW, "map")
    return m.select("user_id", F.size("v").cast("bigint").alias("n"),
                    F.array_join(F.map_keys("v"), ";").alias("paths"), F.array_min(F.map_values("v")).alias("low"))


@query("m6_counter_shards", """
WITH s AS (SELECT user_id, event_id % 4 AS shard, CASE WHEN event_id % 4 = 0 THEN 'global' WHEN event_id % 4 = 1 THEN 'local' ELSE 'remote' END AS kind,
                  epoch_us(ts) AS clock, (event_id % 100)::BIGINT AS n FROM events),
p AS (SELECT user_id, shard, CASE WHEN shard = 1 THEN sum(n) ELSE arg_max(n, (clock, n)) END AS n FROM s GROUP BY user_id, shard)
SELECT user_id, sum(n)::BIGINT AS value FROM p GROUP BY user_id""")
def counter_shards(t):
    shard = F.col("event_id") % 4
    shards = t.events.select(
        "user_id", shard.alias("shard"), F.when(shard == 0, "global").when(shard == 1, "local").otherwise("remote").alias("kind"),
        micros("ts").alias("clock"), (F.col("event_id") % 100).alias("count"), F.lit(False).alias("dead"))
    return rec.merge_counters(shards, ["user_id"])


@query("m7_merge_copies", f"WITH {EVENT_LOG_SQL} SELECT user_id, slot, value, kind FROM state")
def merge_copies(t):
    log = event_log(t)
    parts = [rec.merge_states(rec.to_state(p, EVENT_LOG, NOW), EVENT_LOG) for p in split_copies(log, "event_id", 3)]
    union = rec.merge_copies(parts, EVENT_LOG)
    deleted = rec.with_partition_deletions(union, rec.partition_deletions(log, EVENT_LOG), EVENT_LOG)
    return rec.live_rows(rec.shadow(deleted, EVENT_LOG), EVENT_LOG)


_GC = NOW - 15 * 86400


@query("m8_compact", f"""
WITH {EVENT_LOG_SQL},
x AS (SELECT user_id, slot, has_live,
  CASE WHEN value_ts > del_ts AND NOT (value_dead AND (CASE WHEN value_ttl > 0 AND value IS NOT NULL THEN value_ldt - value_ttl ELSE value_ldt END) < {_GC}) THEN CASE WHEN value_dead THEN 'tombstone' ELSE 'live' END END AS value_is,
  CASE WHEN kind_ts > del_ts AND NOT (kind_dead AND (CASE WHEN kind_ttl > 0 THEN kind_ldt - kind_ttl ELSE kind_ldt END) < {_GC}) THEN CASE WHEN kind_dead THEN 'tombstone' ELSE 'live' END END AS kind_is,
  CASE WHEN del_ts > 0 AND del_ts // 1000000 >= {_GC} THEN del_ts END AS deleted_at FROM visible)
SELECT * FROM x WHERE has_live OR value_is IS NOT NULL OR kind_is IS NOT NULL OR deleted_at IS NOT NULL""")
def compact(t):
    kept = rec.compact(event_state(t), EVENT_LOG, NOW, gc_grace=15 * 86400)
    state = lambda c: F.when(F.col(f"{c}.dead"), "tombstone").when(~F.col(f"{c}.dead"), "live")
    return kept.select(*EVENT_LOG.key, F.col("_live").isNotNull().alias("has_live"), state("value").alias("value_is"),
                       state("kind").alias("kind_is"), F.col("_del.ts").alias("deleted_at"))


def compact_sql(now, grace: int) -> str:
    """What a compaction of the event state at ``now`` keeps."""
    return ORACLE["m8_compact"].replace(str(_GC), f"({now} - {grace})").replace(str(NOW), str(now))


def shown_state(kept):
    """What is left of each row: liveness, cells as live or tombstone, deletion."""
    state = lambda c: F.when(F.col(f"{c}.dead"), "tombstone").when(~F.col(f"{c}.dead"), "live")
    return kept.select(*EVENT_LOG.key, F.col("_live").isNotNull().alias("has_live"), state("value").alias("value_is"),
                       state("kind").alias("kind_is"), F.col("_del.ts").alias("deleted_at"))


@query("m8_compact_later", " UNION ALL ".join(
    f"SELECT {now}::BIGINT AS at, * FROM ({compact_sql(now, 15 * 86400)})" for now in READ_AT))
def compact_later(t):
    # one stored state, compacted at three times
    state = stored_events(t)
    return reduce(lambda a, b: a.unionByName(b), [
        shown_state(lasting.compact(state, EVENT_LOG, now, gc_grace=15 * 86400)).withColumn("at", F.lit(now).cast("bigint")) for now in READ_AT])


@query("m9_skip_garbage", """
WITH d AS (SELECT l_orderkey, l_linenumber, max(l_shipdate) AS ts FROM lineitem WHERE l_suppkey % 2 = 0 GROUP BY l_orderkey, l_linenumber),
o AS (SELECT l_orderkey, l_linenumber, max(l_shipdate) AS ots FROM lineitem WHERE l_suppkey % 2 = 1 GROUP BY l_orderkey, l_linenumber)
SELECT l_orderkey, l_linenumber, ots IS NULL OR ts >= ots AS kept FROM d LEFT JOIN o USING (l_orderkey, l_linenumber)""")
def skip_garbage(t):
    spec = TableSpec(["l_orderkey"], ["l_linenumber"], (), ["l_quantity"])
    log = t.lineitem.select(*spec.key, "l_quantity", "l_suppkey", micros("l_shipdate").alias("_ts"))
    inputs, others = [rec.merge_states(rec.to_state(p, spec, LINE_NOW), spec) for p in split_copies(log, "l_suppkey", 2)]
    out = rec.skip_garbage(inputs, others, spec, "CELL")
    return out.select(*spec.key, F.col("l_quantity").isNotNull().alias("kept"))


@query("m10_time_windows", """
SELECT (epoch_us(ts) // 1000000) - (epoch_us(ts) // 1000000) % 21600 AS window_start, count(*) AS n, min(event_id) AS first_id
FROM events GROUP BY 1""")
def time_windows(t):
    seconds = F.call_function("div", micros("ts"), F.lit(1000000))
    return t.events.groupBy(maintenance.window_start(seconds, "hours", 6).alias("window_start")).agg(
        F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_id"))


@query("m10_write_by_window", """
SELECT (epoch_us(ts) // 1000000) - (epoch_us(ts) // 1000000) % 86400 AS window_start, event_id, value FROM events""")
def write_by_window(t):
    path = fresh_path(t.spark, "windows")
    seconds = F.call_function("div", micros("ts"), F.lit(1000000))
    maintenance.write_by_window(t.events.select("event_id", "ts", "value"), seconds, path, "days")
    return t.spark.read.parquet(path).select(F.col("window_start").cast("bigint"), "event_id", "value")


_SOURCES_SQL = """
src AS (SELECT 's' || (user_id % 40) || CASE WHEN ts < TIMESTAMP '2024-01-10' AND event_id % 2 = 0 THEN '_early' ELSE '_late' END AS source,
  min(epoch_us(ts)) AS min_ts, max(epoch_us(ts)) AS max_ts, max(epoch_us(ts) // 1000000) AS max_ldt FROM events GROUP BY 1)"""


def event_sources(t):
    """Events as files: forty shards, and an early file of each that holds no new data."""
    early = (F.col("ts") < F.lit("2024-01-10").cast("timestamp_ntz")) & (F.col("event_id") % 2 == 0)
    name = F.concat(F.lit("s"), (F.col("user_id") % 40).cast("string"), F.when(early, "_early").otherwise("_late"))
    return t.events.withColumn("source", name)


@query("m13_expired_blockers", f"""
WITH {_SOURCES_SQL}
SELECT b.source, count(*) AS blocked FROM src b JOIN src e ON e.max_ldt < 1705200000 AND b.max_ldt > 1705200000 AND b.min_ts <= e.max_ts
GROUP BY b.source""")
def expired_blockers(t):
    per_source = event_sources(t).groupBy("source").agg(
        F.min(micros("ts")).alias("min_ts"), F.max(micros("ts")).alias("max_ts"),
        F.max(F.call_function("div", micros("ts"), F.lit(1000000))).alias("max_ldt"))
    return maintenance.expired_blockers(per_source, 1705200000)


@query("m14_split", "SELECT o_custkey, o_orderdate, o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders")
def split(t):
    path = fresh_path(t.spark, "split")
    maintenance.split_write(t.orders, ORDERS, path, 2000)
    return select.star(t.spark.read.parquet(path), ORDERS)


@query("m15_verify", """
WITH k AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)
SELECT sum(n)::BIGINT AS n_rows, sum(n - 1)::BIGINT AS duplicates, 0::BIGINT AS null_keys FROM k""")
def verify(t):
    return maintenance.verify(t.lineitem, LINES).drop("checksum")


@query("m15_verify_order", "SELECT 0::BIGINT AS overlapping")
def verify_order(t):
    path = fresh_path(t.spark, "verify")
    tables.bulk_write(t.orders, ORDERS, path)
    files = maintenance.verify_order(t.spark.read.parquet(path), ORDERS)
    return files.agg(F.count(F.lit(1)).alias("overlapping"))


@query("m16_scrub_clean", """
SELECT l_orderkey, l_linenumber, arg_max(l_partkey, (l_shipdate, l_partkey, l_suppkey)) AS l_partkey,
       arg_max(l_suppkey, (l_shipdate, l_partkey, l_suppkey)) AS l_suppkey, max(l_shipdate) AS l_shipdate
FROM lineitem WHERE l_discount < 0.1 GROUP BY l_orderkey, l_linenumber""")
def scrub_clean(t):
    clean, _ = _scrubbed(t)
    return clean.drop("l_discount")


@query("m16_scrub_rejected", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE NOT l_discount < 0.1")
def scrub_rejected(t):
    return _scrubbed(t)[1].select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def _scrubbed(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_discount")
    return maintenance.scrub(rows, LINES, F.col("l_discount") < 0.1, F.struct("l_shipdate", "l_partkey", "l_suppkey"))

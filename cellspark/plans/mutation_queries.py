"""Write queries: upserts, deletes, collections, counters, conditions and schema changes."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellspark.operators import collections as C
from cellspark.operators import mutate
from cellspark.operators import reconcile as rec
from cellspark.plans.logs import EVENT_LOG, EVENT_LOG_SQL, LINE_LOG, LINE_NOW, event_log, line_log, micros
from cellspark.plans.predicate_queries import _USERS_SQL, users
from cellspark.plans.registry import query
from cellspark.spec import TableSpec

ORDER = TableSpec(["o_custkey"], ["o_orderkey"], (), ["status", "price"], name="orders")
T0, NOW = 1_000_000_000_000_000, 1_000_001_000


def base_orders(t):
    return t.orders.select("o_custkey", "o_orderkey", F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"))


def read(log):
    return rec.live_rows(rec.reconcile(log, ORDER, NOW), ORDER)


@query("w1_upsert", """
SELECT o_custkey, o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'X' ELSE o_orderstatus END AS status,
       CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_totalprice END AS price FROM orders""")
def upsert(t):
    base = base_orders(t)
    log = mutate.log_of(
        mutate.insert(base, ORDER, T0),
        mutate.update(base.filter("o_orderkey % 7 = 0").select(*ORDER.key, F.lit("X").alias("status")), ORDER, T0 + 1),
        mutate.update(base.filter("o_orderkey % 7 = 0").select(*ORDER.key, F.lit("Y").alias("status")), ORDER, T0 - 1),
        mutate.insert(base.filter("o_orderkey % 5 = 0").select(*ORDER.key, F.lit(None).cast("double").alias("price")), ORDER, T0 + 2))
    return read(log)


@query("w1_update_without_row", """
SELECT o_custkey, o_orderkey, o_orderstatus AS status, NULL::DOUBLE AS price FROM orders WHERE o_orderkey % 3 <> 0""")
def update_without_row(t):
    spec = TableSpec(ORDER.pk, ORDER.ck, (), ["status"])
    base = base_orders(t).drop("price")
    log = mutate.log_of(
        mutate.update(base, spec, T0),
        mutate.update(base.filter("o_orderkey % 3 = 0").withColumn("status", F.lit(None).cast("string")), spec, T0 + 1))
    rows = rec.live_rows(rec.reconcile(log, spec, NOW), spec)
    return mutate.add_column(rows, "price", "double")


@query("w2_ttl", """
SELECT o_custkey, o_orderkey, o_orderstatus AS status, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_totalprice END AS price
FROM orders WHERE o_orderkey % 6 <> 1""")
def ttl(t):
    base, t0_s = base_orders(t), T0 // 1_000_000
    mortal = base.filter("o_orderkey % 6 = 1")
    log = mutate.log_of(
        mutate.insert(base.filter("o_orderkey % 6 <> 1"), ORDER, T0, ttl=0),
        mutate.insert(mortal, ORDER, T0, ttl=NOW - t0_s),
        mutate.update(base.filter("o_orderkey % 4 = 0 AND o_orderkey % 6 <> 1").select(*ORDER.key, "price"), ORDER, T0 + 1, ttl=10))
    return read(log)


@query("w3_insert_json", """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, NULL::VARCHAR AS note, true AS k_set, false AS note_set FROM events""")
def insert_json(t):
    spec = TableSpec(["event_id"], (), (), ["k", "note"])
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("k", T.LongType()),
                           T.StructField("note", T.StringType())])
    text = F.concat(F.lit('{"event_id": '), F.col("event_id").cast("string"), F.lit(', "K": "'),
                    F.get_json_object("props", "$.k"), F.lit('"}'))
    log = mutate.insert_json(t.events.select(text.alias("doc")), "doc", schema, spec, T0, missing="unset")
    rows = rec.live_rows(rec.reconcile(log, spec, NOW), spec)
    named = log.select("event_id", F.array_contains("_set", "k").alias("k_set"), F.array_contains("_set", "note").alias("note_set"))
    return rows.join(named, "event_id")


@query("w4_deletes", """
SELECT o_custkey, o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderstatus END AS status, o_totalprice AS price
FROM orders WHERE o_custkey % 10 <> 0 AND o_orderkey % 4 <> 0 AND NOT (o_custkey % 10 = 1 AND o_orderkey >= 1000 AND o_orderkey < 5000)""")
def deletes(t):
    base = base_orders(t)
    log = mutate.log_of(
        mutate.insert(base, ORDER, T0),
        mutate.delete_partitions(base.filter("o_custkey % 10 = 0"), ORDER, T0 + 5),
        mutate.delete_rows(base.filter("o_orderkey % 4 = 0"), ORDER, T0 + 5),
        mutate.delete_cells(base.filter("o_orderkey % 3 = 0"), ORDER, ["status"], T0 + 5))
    ranges = mutate.delete_ranges(base.filter("o_custkey % 10 = 1").select("o_custkey").distinct(), ORDER,
                                  F.lit(1000).cast("bigint"), F.lit(5000).cast("bigint"), T0 + 5, NOW)
    return rec.live_rows(rec.reconcile(log, ORDER, NOW, ranges=ranges), ORDER)


_KINDS = _USERS_SQL


def _joined(c):
    return F.coalesce(F.array_join(c, ","), F.lit("-"))


@query("w5_list", _KINDS + """
SELECT user_id, array_to_string(list_concat(kinds, ['a', 'b']), ',') AS appended,
  array_to_string(list_concat(['b', 'a'], kinds), ',') AS prepended,
  array_to_string(list_concat(['z'], kinds[2:]), ',') AS changed,
  array_to_string(list_filter(kinds, lambda x: x NOT IN ('click', 'view')), ',') AS discarded,
  array_to_string(kinds[2:], ',') AS removed FROM c""")
def lists(t):
    k = F.col("kinds")
    items = lambda *xs: F.array(*[F.lit(x) for x in xs])
    return users(t).select(
        "user_id", _joined(C.list_append(k, items("a", "b"))).alias("appended"),
        _joined(C.list_prepend(k, items("b", "a"))).alias("prepended"),
        _joined(C.list_set(k, 0, F.lit("z"), "array<string>")).alias("changed"),
        _joined(C.list_discard(k, items("click", "view"))).alias("discarded"),
        _joined(C.list_delete_at(k, 0, "array<string>")).alias("removed"))


@query("w6_set", _KINDS + """
SELECT user_id, array_to_string(list_sort(list_distinct(list_concat(kinds, ['aa', 'click']))), ',') AS added,
  array_to_string(list_filter(kinds, lambda x: x <> 'error'), ',') AS removed, true AS emptied FROM c""")
def sets(t):
    k = F.col("kinds")
    items = lambda *xs: F.array(*[F.lit(x) for x in xs])
    return users(t).select("user_id", _joined(C.set_add(k, items("click", "aa"))).alias("added"),
                           _joined(C.set_remove(k, items("error"))).alias("removed"),
                           C.set_remove(k, k).isNull().alias("emptied"))


@query("w7_map", """
WITH u AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY user_id, event_type),
p AS (SELECT user_id, event_type, CASE WHEN event_type = 'click' THEN -1 ELSE n END AS n FROM u WHERE event_type <> 'view'
      UNION ALL SELECT DISTINCT user_id, 'zz', 7 FROM u)
SELECT p.user_id, string_agg(event_type || '=' || n, ',' ORDER BY event_type) AS put,
  (SELECT string_agg(event_type || '=' || n, ',' ORDER BY event_type) FROM u WHERE u.user_id = p.user_id AND event_type NOT IN ('error', 'none')) AS removed
FROM p GROUP BY p.user_id""")
def maps(t):
    m = F.col("counts")
    shown = lambda c: F.array_join(F.transform(F.map_entries(c), lambda e: F.concat(
        e["key"], F.lit("="), e["value"].cast("string"))), ",")
    entries = F.create_map(F.lit("click"), F.lit(-1).cast("bigint"), F.lit("view"), F.lit(None).cast("bigint"),
                           F.lit("zz"), F.lit(7).cast("bigint"))
    return users(t).select("user_id", shown(C.map_put(m, entries)).alias("put"),
                           shown(C.map_remove(m, F.array(F.lit("error"), F.lit("none")))).alias("removed"))


@query("w8_user_type", "SELECT o_orderkey, 'new' AS a, NULL::VARCHAR AS b, o_totalprice AS c FROM orders")
def user_type(t):
    u = F.struct(F.col("o_orderstatus").alias("a"), F.col("o_orderpriority").alias("b"), F.col("o_totalprice").alias("c"))
    changed = C.field_delete(C.field_set(F.col("u"), "a", F.lit("new")), "b", "string")
    return t.orders.select("o_orderkey", u.alias("u")).select("o_orderkey", changed.alias("u")).select("o_orderkey", "u.*")


@query("w9_counters", """
SELECT user_id, event_type, sum(CASE WHEN event_type = 'error' THEN -(event_id % 10) ELSE event_id % 10 END)::BIGINT + 100 AS value
FROM events GROUP BY user_id, event_type""")
def counters(t):
    n = F.col("event_id") % 10
    delta = F.when(F.col("event_type") == "error", mutate.counter_decrement(n)).otherwise(n)
    key = ["user_id", "event_type"]
    deltas = mutate.counter_values(t.events, key, delta)
    start = t.events.select(*key).distinct().withColumn("value", F.lit(100).cast("bigint"))
    return mutate.apply_counters(start, deltas, key)


_COND = """
cur AS (SELECT o_custkey, o_orderkey, o_orderstatus AS status, o_totalprice AS price FROM orders WHERE o_orderkey % 3 <> 0),
upd AS (SELECT o_custkey, o_orderkey, 'N' AS status FROM orders WHERE o_orderkey % 2 = 0)"""


def _conditional(t, condition):
    base = base_orders(t)
    updates = base.filter("o_orderkey % 2 = 0").select(*ORDER.key, F.lit("N").alias("status"))
    return mutate.apply_if(base.filter("o_orderkey % 3 <> 0"), updates, ORDER, condition, ["status"])


@query("w10_if_value", f"""
WITH {_COND}
SELECT o_custkey, o_orderkey, coalesce(c.status = 'F' AND c.price > 100000, false) AS applied,
  CASE WHEN NOT coalesce(c.status = 'F' AND c.price > 100000, false) THEN c.status END AS status,
  CASE WHEN NOT coalesce(c.status = 'F' AND c.price > 100000, false) THEN c.price END AS price
FROM upd u LEFT JOIN cur c USING (o_custkey, o_orderkey)""")
def if_value(t):
    return _conditional(t, (F.col("status") == "F") & (F.col("price") > 100000))[1]


@query("w10_if_not_exists", f"""
WITH {_COND}
SELECT coalesce(u.o_custkey, c.o_custkey) AS o_custkey, coalesce(u.o_orderkey, c.o_orderkey) AS o_orderkey,
       coalesce(c.status, 'N') AS status, c.price
FROM upd u FULL JOIN cur c ON u.o_custkey = c.o_custkey AND u.o_orderkey = c.o_orderkey""")
def if_not_exists(t):
    return _conditional(t, ~F.col("_exists"))[0]


@query("w10_if_exists_in", f"""
WITH {_COND}
SELECT o_custkey, o_orderkey, CASE WHEN u.status IS NOT NULL AND c.status IN ('O', 'P') THEN 'N' ELSE c.status END AS status, c.price
FROM cur c LEFT JOIN upd u USING (o_custkey, o_orderkey)""")
def if_exists_in(t):
    return _conditional(t, F.col("_exists") & F.col("status").isin("O", "P"))[0]


@query("w10_first_update_wins", """
SELECT user_id, arg_min(event_type, (ts, event_id)) AS event_type, arg_min(value, (ts, event_id)) AS value FROM events GROUP BY user_id""")
def first_update_wins(t):
    spec = TableSpec(["user_id"], (), (), ["event_type", "value"])
    picked = mutate.first_update_per_key(t.events.select("user_id", "ts", "event_id", "event_type", "value"), spec,
                                         F.struct("ts", "event_id"))
    return picked.select("user_id", "event_type", "value")


@query("w11_batch", """
SELECT o_custkey, o_orderkey, CASE WHEN o_orderkey % 2 = 0 AND o_orderstatus < 'Z' THEN 'Z' ELSE o_orderstatus END AS status, o_totalprice AS price
FROM orders WHERE o_orderkey % 5 <> 0""")
def batch(t):
    base = base_orders(t)
    # one timestamp for all: the larger value wins between writes, a deletion over both
    log = mutate.batch(
        mutate.insert(base, ORDER, 0),
        mutate.update(base.filter("o_orderkey % 2 = 0").select(*ORDER.key, F.lit("Z").alias("status")), ORDER, 0),
        mutate.delete_rows(base.filter("o_orderkey % 5 = 0"), ORDER, 0), ts=T0, counters=(False, False, False))
    return read(log)


@query("w12_truncate", """
SELECT l_orderkey, l_linenumber, arg_max(l_quantity, (l_shipdate, l_quantity)) AS l_quantity,
  arg_max(l_extendedprice, (l_shipdate, l_extendedprice)) AS l_extendedprice,
  arg_max(l_returnflag, (l_shipdate, l_returnflag)) AS l_returnflag, arg_max(l_linestatus, (l_shipdate, l_linestatus)) AS l_linestatus
FROM lineitem WHERE l_shipdate > TIMESTAMP '1997-01-01' GROUP BY l_orderkey, l_linenumber""")
def truncate(t):
    log = mutate.truncate(line_log(t), 852076800 * 1_000_000)
    return rec.live_rows(rec.reconcile(log, LINE_LOG, LINE_NOW), LINE_LOG)


@query("w13_schema_change", """
WITH c AS (SELECT user_id AS account, event_id % 16 AS slot, epoch_us(ts) AS ts, value, event_type FROM events),
x AS (SELECT account, slot, arg_max(event_type, (ts, event_type)) AS kind,
   arg_max(value, (ts, value)) FILTER (WHERE ts > 1705276800000000) AS value FROM c GROUP BY account, slot)
SELECT account, slot, value, kind, NULL::INTEGER AS added FROM x""")
def schema_change(t):
    # value was dropped on 2024-01-15 and added again; user_id is called account now
    spec = TableSpec(["account"], ["slot"], (), ["value", "kind"])
    log = t.events.select("user_id", (F.col("event_id") % 16).alias("slot"), "value", F.col("event_type").alias("kind"),
                          micros("ts").alias("_ts"))
    changed = mutate.rename_key(mutate.drop_column(log, "value", 1705276800000000, readded=True), "user_id", "account")
    return mutate.add_column(rec.live_rows(rec.reconcile(changed, spec, LINE_NOW * 2), spec), "added", "int")


@query("w13_type_change", """
SELECT o_orderkey, o_orderstatus AS first, o_orderpriority AS level, NULL::BIGINT AS extra FROM orders""")
def type_change(t):
    u = F.struct(F.col("o_orderstatus").alias("first"), F.col("o_orderpriority").alias("second"))
    typed = mutate.rename_field(t.orders.select("o_orderkey", u.alias("u")), "u", "second", "level")
    return mutate.add_field(typed, "u", "extra", "bigint").select("o_orderkey", "u.*")


@query("u6_trigger", f"""
WITH {EVENT_LOG_SQL}
SELECT op AS operation, 'user_state' AS table_name, user_id || ':' || slot AS primary_key, ts AS at FROM log""")
def trigger(t):
    fired = mutate.with_trigger(event_log(t), lambda m: mutate.audit(m, EVENT_LOG, "user_state"))
    return fired.filter(F.col("table_name").isNotNull()).select("operation", "table_name", "primary_key", "at")

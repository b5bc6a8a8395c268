"""Write logs read from the given tables, and the same logs as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellspark.spec import TableSpec

NOW = 1706659200  # 2024-01-31 00:00:00 UTC, the reading time of the event log

EVENT_LOG = TableSpec(["user_id"], ["slot"], (), ["value", "kind"], name="user_state")
LINE_LOG = TableSpec(["l_orderkey"], ["l_linenumber"], (),
                     ["l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus"], name="lines")
LINE_NOW = 1100000000


def micros(c: str):
    return F.unix_micros(F.col(c).cast("timestamp"))


def event_log(t) -> DataFrame:
    """Events as writes to 16 rows per user.

    signup inserts, click and view update (view leaves ``value`` alone, a click below 5
    deletes it), purchase updates for ten days, error deletes the row, and every fiftieth
    event deletes the whole partition.
    """
    kind = F.col("event_type")
    op = (F.when(F.col("event_id") % 50 == 0, "delete_partition").when(kind == "signup", "insert")
          .when(kind == "error", "delete_row").otherwise("update"))
    value = F.when(~((kind == "click") & (F.col("value") < 5)), F.col("value"))
    return t.events.select(
        "user_id", (F.col("event_id") % 16).alias("slot"), "event_id", op.alias("_op"), micros("ts").alias("_ts"),
        F.when(kind == "purchase", 864000).otherwise(0).alias("_ttl"),
        F.when(kind == "view", F.array(F.lit("kind"))).otherwise(F.array(F.lit("value"), F.lit("kind"))).alias("_set"),
        value.alias("value"), kind.alias("kind")).withColumn("_now", F.call_function("div", F.col("_ts"), F.lit(1000000)))


EVENT_LOG_SQL = f"""
log AS (
  SELECT user_id, event_id % 16 AS slot, event_id, epoch_us(ts) AS ts, epoch_us(ts) // 1000000 AS now_s,
         CASE WHEN event_id % 50 = 0 THEN 'delete_partition' WHEN event_type = 'signup' THEN 'insert'
              WHEN event_type = 'error' THEN 'delete_row' ELSE 'update' END AS op,
         CASE WHEN event_type = 'purchase' THEN 864000 ELSE 0 END AS ttl,
         CASE WHEN event_type = 'click' AND value < 5 THEN NULL ELSE value END AS value, event_type AS kind
  FROM events),
writes AS (SELECT *, CASE WHEN ttl > 0 THEN now_s + ttl ELSE 2147483647 END AS exp FROM log WHERE op IN ('insert', 'update')),
value_cells AS (
  SELECT user_id, slot, ts, value AS v, value IS NULL OR exp <= {NOW} AS dead, ttl,
         CASE WHEN value IS NULL THEN now_s ELSE exp END AS ldt
  FROM writes WHERE kind <> 'view'
  QUALIFY row_number() OVER (PARTITION BY user_id, slot ORDER BY ts DESC, dead DESC, v DESC NULLS LAST, ldt DESC) = 1),
kind_cells AS (
  SELECT user_id, slot, ts, kind AS v, exp <= {NOW} AS dead, ttl, exp AS ldt FROM writes
  QUALIFY row_number() OVER (PARTITION BY user_id, slot ORDER BY ts DESC, dead DESC, v DESC, ldt DESC) = 1),
inserts AS (SELECT user_id, slot, max(ts) AS ts FROM log WHERE op = 'insert' GROUP BY user_id, slot),
row_dels AS (SELECT user_id, slot, max(ts) AS ts FROM log WHERE op = 'delete_row' GROUP BY user_id, slot),
part_dels AS (SELECT user_id, max(ts) AS ts FROM log WHERE op = 'delete_partition' GROUP BY user_id),
keys AS (SELECT DISTINCT user_id, slot FROM log WHERE op <> 'delete_partition'),
merged AS (
  SELECT k.user_id, k.slot, greatest(coalesce(r.ts, 0), coalesce(p.ts, 0)) AS del_ts, i.ts AS live_ts,
         v.v AS value, v.ts AS value_ts, v.dead AS value_dead, v.ttl AS value_ttl, v.ldt AS value_ldt,
         c.v AS kind, c.ts AS kind_ts, c.dead AS kind_dead, c.ttl AS kind_ttl, c.ldt AS kind_ldt
  FROM keys k LEFT JOIN value_cells v USING (user_id, slot) LEFT JOIN kind_cells c USING (user_id, slot)
  LEFT JOIN inserts i USING (user_id, slot) LEFT JOIN row_dels r USING (user_id, slot) LEFT JOIN part_dels p USING (user_id)),
visible AS (
  SELECT user_id, slot, live_ts, del_ts, coalesce(live_ts > del_ts, false) AS has_live,
         coalesce(value_ts > del_ts AND NOT value_dead, false) AS has_value,
         coalesce(kind_ts > del_ts AND NOT kind_dead, false) AS has_kind,
         value, value_ts, value_ttl, value_ldt, kind, kind_ts, kind_ttl, kind_ldt, value_dead, kind_dead FROM merged),
state AS (
  SELECT user_id, slot, CASE WHEN has_value THEN value END AS value, CASE WHEN has_kind THEN kind END AS kind,
         CASE WHEN has_value THEN value_ts END AS value_ts, CASE WHEN has_kind THEN kind_ts END AS kind_ts,
         CASE WHEN has_value AND value_ttl > 0 THEN value_ldt END AS value_exp,
         CASE WHEN has_kind AND kind_ttl > 0 THEN kind_ldt END AS kind_exp, live_ts, has_live
  FROM visible WHERE has_live OR has_value OR has_kind)
"""


def line_log(t) -> DataFrame:
    """Line items as full-row inserts; the ship date is the write time, so keys repeat."""
    return t.lineitem.select(*LINE_LOG.key, *LINE_LOG.regular, micros("l_shipdate").alias("_ts"))


def line_cells_sql() -> str:
    picks = ", ".join(f"arg_max({c}, (l_shipdate, {c})) AS {c}" for c in LINE_LOG.regular)
    return f"lines AS (SELECT l_orderkey, l_linenumber, {picks} FROM lineitem GROUP BY l_orderkey, l_linenumber)"


def split_copies(df: DataFrame, key: str, n: int) -> list[DataFrame]:
    """A log split into ``n`` disjoint sources by a hash of its event."""
    return [df.filter(F.pmod(F.col(key), F.lit(n)) == i) for i in range(n)]

"""Materialized view queries over the event log."""

from pyspark.sql import functions as F

from cellspark.operators import reconcile as rec
from cellspark.operators import views
from cellspark.plans.logs import EVENT_LOG, EVENT_LOG_SQL, NOW, event_log
from cellspark.plans.registry import query
from cellspark.plans.reconcile_queries import event_state
from cellspark.session import fresh_path, materialize
from cellspark.spec import ViewSpec

BY_KIND = ViewSpec(EVENT_LOG, ["kind"], ["user_id", "slot"], ["value"])
SAME_KEY = ViewSpec(EVENT_LOG, ["slot"], ["user_id"], ["value"])


def filtered_view():
    return ViewSpec(EVENT_LOG, ["kind"], ["user_id", "slot"], ["value"], where=F.col("value") > 40)


@query("v1_view_rows", f"WITH {EVENT_LOG_SQL} SELECT kind, user_id, slot, value FROM state WHERE kind IS NOT NULL")
def view_rows(t):
    return views.rows(event_state(t), BY_KIND)


@query("v1_filtered_view", f"WITH {EVENT_LOG_SQL} SELECT kind, user_id, slot, value FROM state WHERE kind IS NOT NULL AND value > 40")
def filtered(t):
    return views.rows(event_state(t), filtered_view())


@query("v2_full_build", f"WITH {EVENT_LOG_SQL} SELECT kind, user_id, slot, value FROM state WHERE kind IS NOT NULL")
def full_build(t):
    from cellspark.sources.tables import bulk_write

    path = fresh_path(t.spark, "view")
    bulk_write(views.rows(event_state(t), BY_KIND), BY_KIND.as_table(), path)
    return t.spark.read.parquet(path)


_CUT = 1705276800000000  # 2024-01-15: the log before is stored, the log after arrives as a change


def _old_new(t):
    log = event_log(t)
    old = rec.reconcile(log.filter(F.col("_ts") < _CUT), EVENT_LOG, NOW)
    return old, event_state(t)


def _side_sql(where: str, name: str) -> str:
    body = EVENT_LOG_SQL.replace("FROM events)", f"FROM events WHERE {where})")
    names = ("log", "writes", "value_cells", "kind_cells", "inserts", "row_dels", "part_dels", "keys", "merged", "visible", "state")
    for n in names:
        for before in ("\n", "FROM ", "JOIN "):
            body = body.replace(f"{before}{n} ", f"{before}{name}_{n} ")
        body = body.replace(f"FROM {n}\n", f"FROM {name}_{n}\n").replace(f"FROM {n})", f"FROM {name}_{n})")
    return body


_DELTA_SQL = f"""
WITH {_side_sql(f"epoch_us(ts) < {_CUT}", "o")}, {_side_sql("true", "n")},
j AS (SELECT coalesce(o.user_id, n.user_id) AS user_id, coalesce(o.slot, n.slot) AS slot, o.kind AS ok, n.kind AS nk, o.value AS ov, n.value AS nv,
   o.kind_ts AS okt, n.kind_ts AS nkt, o.value_ts AS ovt, n.value_ts AS nvt
   FROM o_state o FULL JOIN n_state n ON o.user_id = n.user_id AND o.slot = n.slot)
"""


@query("v3_delta", _DELTA_SQL + """
, a AS (SELECT *, CASE WHEN ok IS NOT NULL AND nk IS NOT NULL AND ok = nk THEN 'UPDATE_EXISTING' WHEN ok IS NOT NULL AND nk IS NOT NULL THEN 'SWITCH_ENTRY'
   WHEN nk IS NOT NULL THEN 'NEW_ENTRY' ELSE 'DELETE_OLD' END AS action FROM j WHERE (ok IS NOT NULL OR nk IS NOT NULL))
SELECT nk AS kind, user_id, slot, action, 'insert' AS op, nv AS value FROM a WHERE action IN ('NEW_ENTRY', 'SWITCH_ENTRY')
UNION ALL SELECT ok, user_id, slot, action, 'delete_row', NULL FROM a WHERE action IN ('DELETE_OLD', 'SWITCH_ENTRY')""")
def delta(t):
    old, new = _old_new(t)
    changes = views.delta(old, new, BY_KIND).filter("action <> 'UPDATE_EXISTING'")
    return changes.select("kind", "user_id", "slot", "action", F.col("_op").alias("op"), "value")


def _every_sql(name: str) -> str:
    return f"""SELECT user_id, slot, has_kind, CASE WHEN has_kind THEN kind END AS kind, kind_ts, CASE WHEN has_value THEN value END AS value, del_ts,
  (CASE WHEN live_ts > del_ts THEN live_ts END, del_ts, CASE WHEN value_ts > del_ts THEN (value, value_ts, value_dead, value_ttl, value_ldt) END,
   CASE WHEN kind_ts > del_ts THEN (kind, kind_ts, kind_dead, kind_ttl, kind_ldt) END) AS every FROM {name}_visible"""


@query("v3_delta_full", _DELTA_SQL + f"""
, oe AS ({_every_sql('o')}), ne AS ({_every_sql('n')}),
c AS (SELECT user_id, slot, coalesce(oe.has_kind, false) AS had, coalesce(ne.has_kind, false) AS has, oe.kind AS ok, ne.kind AS nk, ne.value AS nv,
   ne.kind_ts AS nts, nullif(greatest(ne.del_ts, oe.kind_ts), 0) AS gone FROM oe FULL JOIN ne USING (user_id, slot) WHERE oe.every IS DISTINCT FROM ne.every),
a AS (SELECT *, CASE WHEN had AND has AND ok = nk THEN 'UPDATE_EXISTING' WHEN had AND has THEN 'SWITCH_ENTRY' WHEN has THEN 'NEW_ENTRY' ELSE 'DELETE_OLD' END AS action
   FROM c WHERE had OR has)
SELECT nk AS kind, user_id, slot, action, 'insert' AS op, nts AS ts, nv AS value FROM a WHERE has
UNION ALL SELECT ok, user_id, slot, action, 'delete_row', gone, NULL FROM a WHERE action IN ('DELETE_OLD', 'SWITCH_ENTRY')""")
def delta_full(t):
    old, new = _old_new(t)
    return views.delta(old, new, BY_KIND).select("kind", "user_id", "slot", "action", F.col("_op").alias("op"), F.col("_ts").alias("ts"), "value")


@query("v3_apply_delta", f"WITH {EVENT_LOG_SQL} SELECT kind, user_id, slot, value FROM state WHERE kind IS NOT NULL AND value > 40")
def apply_delta(t):
    view = filtered_view()
    old, new = _old_new(t)
    before = views.rows(old, view)
    return views.apply_delta(before, views.delta(old, new, view), view)


@query("v3_incremental", f"WITH {EVENT_LOG_SQL} SELECT kind, user_id, slot, value FROM state WHERE kind IS NOT NULL")
def incremental(t):
    log = event_log(t)
    stored = materialize(rec.reconcile(log.filter(F.col("_ts") < _CUT), EVENT_LOG, NOW), "base")
    late = log.filter(F.col("_ts") >= _CUT)
    change = rec.to_state(late, EVENT_LOG, NOW)
    # a partition deletion in the change reaches every stored row of its partition
    deletions = rec.partition_deletions(late, EVENT_LOG)
    row = lambda df: df.join(deletions, "user_id").select(
        *EVENT_LOG.key, F.lit(None).cast(change.schema["_live"].dataType).alias("_live"), F.col("_pdel").alias("_del"),
        *[F.lit(None).cast(change.schema[c].dataType).alias(c) for c in EVENT_LOG.regular])
    keys = stored.select(*EVENT_LOG.key).unionByName(change.select(*EVENT_LOG.key)).distinct()
    full_change = change.unionByName(row(keys))
    changes = views.incremental(stored, full_change, BY_KIND)
    return views.apply_delta(views.rows(stored, BY_KIND), changes, BY_KIND)


@query("v4_liveness_of_key_cell", f"WITH {EVENT_LOG_SQL} SELECT kind, user_id, slot, kind_ts AS live_ts, kind_exp AS expires FROM state WHERE kind IS NOT NULL")
def liveness_of_key_cell(t):
    built = views.build(event_state(t), BY_KIND)
    return built.select("kind", "user_id", "slot", F.col("_live.ts").alias("live_ts"),
                        F.when(F.col("_live.expiring"), F.col("_live.exp")).alias("expires"))


@query("v4_liveness_of_hidden_cell", f"""
WITH {EVENT_LOG_SQL}
SELECT slot, user_id, greatest(CASE WHEN has_live THEN live_ts END, kind_ts) AS live_ts,
  CASE WHEN NOT has_live AND kind_exp IS NOT NULL THEN kind_exp END AS expires FROM state""")
def liveness_of_hidden_cell(t):
    built = views.build(event_state(t), SAME_KEY)
    return built.select("slot", "user_id", F.col("_live.ts").alias("live_ts"),
                        F.when(F.col("_live.expiring"), F.col("_live.exp")).alias("expires"))

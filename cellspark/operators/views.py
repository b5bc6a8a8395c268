"""Materialized views: definition, full build and incremental update."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellspark.operators import reconcile as rec
from cellspark.spec import ViewSpec

LIVE_TYPE = "struct<ts:bigint,expired:boolean,expiring:boolean,exp:bigint,ttl:int>"


def _open(state: DataFrame, view: ViewSpec, carry: tuple[str, ...] = ()) -> DataFrame:
    """State with live values as plain columns and the cells as ``_c_<name>``."""
    base = view.base
    live_value = lambda c: F.when(~F.col(f"{c}.dead"), rec._shown(c, state.schema[c].dataType))
    return state.select(
        *base.key, "_live", "_del", rec.is_live_row(base).alias("_alive"),
        *[F.col(c).alias(f"_c_{c}") for c in base.regular],
        *[live_value(c).alias(c) for c in base.regular], *carry)


def _liveness(view: ViewSpec) -> Column:
    """Liveness of the view row, by the three cases of key and column selection."""
    base = F.col("_live")
    make = lambda ts, expiring, exp, ttl: F.struct(
        ts.alias("ts"), F.lit(False).alias("expired"), expiring.alias("expiring"),
        exp.cast("bigint").alias("exp"), ttl.cast("int").alias("ttl"))
    if view.moved:
        cell = F.col(f"_c_{view.moved}")
        return make(cell["ts"], cell["ttl"].isNotNull(), cell["ldt"], cell["ttl"])
    hidden = [c for c in view.base.regular if c not in view.columns]
    if not hidden:
        return base
    cells = [F.col(f"_c_{c}") for c in hidden]
    live = [F.coalesce(~c["dead"], F.lit(False)) for c in cells]
    ts = F.greatest(base["ts"], *[F.when(ok, c["ts"]) for c, ok in zip(cells, live)])
    base_alive = F.coalesce(~base["expired"], F.lit(False))
    lasting = reduce(lambda a, b: a | b, [ok & c["ttl"].isNull() for c, ok in zip(cells, live)],
                     base_alive & ~F.coalesce(base["expiring"], F.lit(False)))
    longest = F.greatest(F.struct(F.lit(-1).cast("bigint").alias("ldt"), F.lit(None).cast("int").alias("ttl")), *[
        F.when(ok & c["ttl"].isNotNull(), F.struct(c["ldt"].alias("ldt"), c["ttl"].alias("ttl")))
        for c, ok in zip(cells, live)])
    extends = (longest["ldt"] > 0) & (~base_alive | (longest["ldt"] > base["exp"]))
    return (
        F.when(lasting, make(ts, F.lit(False), F.lit(rec.NEVER), F.lit(None)))
        .when(extends, make(ts, F.lit(True), longest["ldt"], longest["ttl"]))
        .otherwise(base)
    )


def _entry(view: ViewSpec) -> Column:
    """Whether a base row has an entry in the view."""
    present = F.col("_alive")
    for c in view.key:
        present = present & F.col(c).isNotNull()
    return F.coalesce(present & view.where if view.where is not None else present, F.lit(False))


def build(state: DataFrame, view: ViewSpec) -> DataFrame:
    """State of the view from the state of its base table."""
    rows = _open(state, view).filter(_entry(view))
    return rows.select(*view.key, _liveness(view).alias("_live"),
                       F.lit(None).cast("struct<ts:bigint,ldt:bigint>").alias("_del"),
                       *[F.col(f"_c_{c}").alias(c) for c in view.columns])


def entries(state: DataFrame, view: ViewSpec) -> DataFrame:
    """Base key and its view entry (null if it has none).

    A base row has at most one entry, so a view kept by base key needs no knowledge of the
    old row: the new entry, or its absence, replaces whatever was there.
    """
    entry = F.struct(*[F.col(c).alias(c) for c in (*view.key, *view.columns)])
    return _open(state, view).select(*view.base.key, F.when(_entry(view), entry).alias("entry"))


def rows(state: DataFrame, view: ViewSpec, meta: bool = False) -> DataFrame:
    """Live rows of the view."""
    return rec.live_rows(build(state, view), view.as_table(), meta)


def _side(state: DataFrame, view: ViewSpec, tag: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """Base key, the row's view entry (or null) as ``tag`` and its whole state as ``<tag>_all``."""
    base = view.base
    kept = F.struct(*carry).alias("_carry") if carry else F.lit(None).alias("_carry")
    opened = _open(state.withColumn("_carry", kept), view, ("_carry",))
    entry = F.struct(
        *[F.col(c).alias(c) for c in (*view.key, *view.columns)],
        _liveness(view)["ts"].alias("_lts"), _deletion_ts(view).alias("_dts"))
    whole = F.struct("_live", "_del", *[F.col(f"_c_{c}").alias(c) for c in base.regular])
    return opened.select(*base.key, F.when(_entry(view), entry).alias(tag), whole.alias(f"{tag}_all"),
                         *[F.col(f"_carry.{c}").alias(c) for c in carry])


def delta(old: DataFrame, new: DataFrame, view: ViewSpec) -> DataFrame:
    """View mutations for base rows whose state went from ``old`` to ``new``.

    Gives the view key, ``action``, ``_op`` (insert or delete_row), ``_ts`` and the view's
    cells. Base keys are unique on both sides, so the join has no hot key.
    """
    return _mutations(_side(old, view, "o").join(_side(new, view, "n"), view.base.key, "full"), view)


def _mutations(both: DataFrame, view: ViewSpec) -> DataFrame:
    changed = both.filter(~F.col("o_all").eqNullSafe(F.col("n_all")))
    same = F.lit(True)
    if view.moved:
        same = F.col(f"o.{view.moved}").eqNullSafe(F.col(f"n.{view.moved}"))
    had, has = F.col("o").isNotNull(), F.col("n").isNotNull()
    action = (
        F.when(had & has & same, "UPDATE_EXISTING").when(had & has, "SWITCH_ENTRY")
        .when(has, "NEW_ENTRY").when(had, "DELETE_OLD"))
    put = F.struct(F.lit("insert").alias("_op"), F.col("n").alias("e"), F.col("n._lts").alias("_ts"))
    removed_at = F.greatest(F.col("n_all._del.ts"), F.col("o._dts"))
    drop = F.struct(F.lit("delete_row").alias("_op"), F.col("o").alias("e"), removed_at.alias("_ts"))
    out = changed.withColumn("action", action).filter(F.col("action").isNotNull()).withColumn(
        "_m", F.explode(F.when(F.col("action") == "SWITCH_ENTRY", F.array(drop, put))
                        .when(F.col("action") == "DELETE_OLD", F.array(drop))
                        .otherwise(F.array(put))))
    cells = [F.when(F.col("_m._op") == "insert", F.col(f"_m.e.{c}")).alias(c) for c in view.columns]
    return out.select(*[F.col(f"_m.e.{c}").alias(c) for c in view.key], "action",
                      F.col("_m._op").alias("_op"), F.col("_m._ts").alias("_ts"), *cells)


def _deletion_ts(view: ViewSpec) -> Column:
    """Timestamp that removes an existing entry."""
    if view.moved:
        return F.col(f"_c_{view.moved}")["ts"]
    hidden = [F.col(f"_c_{c}")["ts"] for c in view.base.regular if c not in view.columns]
    lowest = F.lit(-(1 << 63)).cast("bigint")
    return F.greatest(F.coalesce(F.col("_live.ts"), lowest), lowest, *hidden)


def incremental(base_state: DataFrame, change_state: DataFrame, view: ViewSpec) -> DataFrame:
    """View mutations caused by newly arrived base mutations (given as state).

    One join from the changed keys to the stored rows: the new row is the larger of the two
    states cell by cell, so the base table is read once and untouched rows are not kept.
    """
    spec = view.base
    pieces = ["_live", "_del", *spec.regular]
    change = rec.merge_states(change_state, spec)
    stored = base_state.select(*spec.key, F.struct(*pieces).alias("_old"))
    met = change.join(stored, spec.key, "left").select(
        *spec.key, *[F.greatest(F.col(f"_old.{p}"), F.col(p)).alias(p) for p in pieces], "_old")
    new = _side(rec.shadow(met, spec, ("_old",)), view, "n", ("_old",))
    old = new.select(*spec.key, "_old.*", "n", "n_all")
    return _mutations(_side(old, view, "o", ("n", "n_all")), view)


def apply_delta(view_rows: DataFrame, changes: DataFrame, view: ViewSpec) -> DataFrame:
    """Current view rows after the given mutations (at most one insert per view key)."""
    puts = changes.filter("_op = 'insert'").select(*view.key, *view.columns)
    kept = view_rows.join(changes.select(*view.key).distinct(), view.key, "left_anti")
    return kept.unionByName(puts)

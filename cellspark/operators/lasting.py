"""State without a reading time: built and merged first, read at any time later.

A cell that expires decides differently between equal write times before and after its expiry: a dead
cell beats a live one, then the larger value wins. State that is merged at one time and read at another therefore
keeps two candidates of a tie: the winner if nothing expires (``<c>``), and the one that expires first
(``<c>__early``). Once that one has expired the cell is dead, whatever its value. The same holds for the liveness of a
row. Both candidates merge by ``max``, so states of any times merge in any order, combined before the shuffle.

:func:`as_of` turns such state into the state of one time, for the functions of ``reconcile`` and ``views``. What a reader
sees is exact. Among three and more dead cells of one write time the deletion time, which only decides when they
are purged, is that of one of the two kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellspark.operators import reconcile as rec
from cellspark.spec import TableSpec

EARLY = "__early"
BEFORE_ALL = -(1 << 62)  # a time at which nothing has expired


def pieces(spec: TableSpec) -> list[str]:
    """The columns of lasting state besides the key."""
    return ["_live", f"_live{EARLY}", "_del", *[x for c in spec.regular for x in (c, c + EARLY)]]


def _early_cell(cell: Column, fields: list[str]) -> Column:
    """The candidate that expires first: of one write time the largest has the smallest expiry."""
    return F.when(cell["ttl"].isNotNull(), F.struct(
        cell["ts"].alias("ts"), (-cell["ldt"]).alias("soon"), *[cell[n].alias(n) for n in fields],
        cell["ldt"].alias("ldt"), cell["ttl"].alias("ttl")))


def _early_live(live: Column) -> Column:
    return F.when(live["expiring"], F.struct(
        live["ts"].alias("ts"), (-live["exp"]).alias("soon"), live["exp"].alias("exp"), live["ttl"].alias("ttl")))


def version_rows(log: DataFrame, spec: TableSpec, keep: list[str], tie: str = "value") -> DataFrame:
    """The columns ``keep`` of a log and the pieces of lasting state that each mutation makes."""
    one = log.select(*keep, *rec._versions(log, spec, BEFORE_ALL, tie))
    fields = ["k", "v"] if tie == "bytes" else ["v"]
    early = {c + EARLY: _early_cell(F.col(c), fields) for c in spec.regular} | {f"_live{EARLY}": _early_live(F.col("_live"))}
    return one.withColumns(early).select(*keep, *pieces(spec))


def versions(log: DataFrame, spec: TableSpec, tie: str = "value") -> DataFrame:
    """Each row mutation as lasting state of one version (a projection, no shuffle)."""
    return version_rows(rec._row_mutations(log), spec, spec.key, tie)


def merge(states: DataFrame, spec: TableSpec) -> DataFrame:
    """One row per key from any number of lasting states, of whatever times."""
    return states.groupBy(*spec.key).agg(*[F.max(c).alias(c) for c in pieces(spec)])


def shadow(state: DataFrame, spec: TableSpec, carry: tuple[str, ...] = ()) -> DataFrame:
    """Drop what was written at or before the row's deletion."""
    gone = lambda c: F.when(F.col("_del").isNull() | (F.col(f"{c}.ts") > F.col("_del.ts")), F.col(c)).alias(c)
    return state.select(*spec.key, *[F.col(c) if c == "_del" else gone(c) for c in pieces(spec)], *carry)


def stored(log: DataFrame, spec: TableSpec, tie: str = "value", ranges: DataFrame | None = None) -> DataFrame:
    """Lasting state of a mutation log, with its partition (and range) deletions applied."""
    state = merge(versions(log, spec, tie), spec)
    if "_op" in log.columns:
        state = rec.with_partition_deletions(state, rec.partition_deletions(log, spec), spec)
    if ranges is not None:
        state = rec.with_range_deletions(state, ranges, spec, rows=rec._row_mutations(log))
    return shadow(state, spec)


def as_of(state: DataFrame, spec: TableSpec, now: int | Column, carry: tuple[str, ...] = ()) -> DataFrame:
    """The state of the time ``now``, as ``reconcile`` gives it."""
    now = now if isinstance(now, Column) else F.lit(now).cast("bigint")
    true = lambda c: F.coalesce(c, F.lit(False))

    def cell(c: str) -> Column:
        best, early = F.col(c), F.col(c + EARLY)
        fields = state.schema[c].dataType.fieldNames()
        gone = true(best["ttl"].isNotNull() & (best["ldt"] <= now))
        early_gone = true((early["ts"] == best["ts"]) & (early["ldt"] <= now))
        from_best = F.struct(*[(best["dead"] | gone if n == "dead" else best[n]).alias(n) for n in fields])
        from_early = F.struct(*[(F.lit(True) if n == "dead" else early[n]).alias(n) for n in fields])
        # an expired best cell has the largest value; a tombstone has none, an expired early one does
        return F.when(best.isNull(), None).when(gone | ~early_gone, from_best).otherwise(from_early).alias(c)

    live, early = F.col("_live"), F.col(f"_live{EARLY}")
    gone = true(live["expired"] | (live["expiring"] & (live["exp"] <= now)))
    early_gone = true((early["ts"] == live["ts"]) & (early["exp"] <= now))
    shown = lambda **by: F.struct(*[by.get(n, live[n]).alias(n) for n in state.schema["_live"].dataType.fieldNames()])
    liveness = (F.when(live.isNull(), None).when(gone, shown(expired=F.lit(True)))
                .when(early_gone, shown(expired=F.lit(True), expiring=F.lit(True), exp=early["exp"], ttl=early["ttl"])).otherwise(live))
    return state.select(*spec.key, liveness.alias("_live"), "_del", *[cell(c) for c in spec.regular], *carry)


def live_rows(state: DataFrame, spec: TableSpec, now: int | Column, meta: bool = False) -> DataFrame:
    """Rows that a reader sees at ``now``."""
    return rec.live_rows(as_of(state, spec, now), spec, meta)


def compact(state: DataFrame, spec: TableSpec, now: int, gc_grace: int | None = None, min_other_ts: int | None = None) -> DataFrame:
    """Lasting state without what can be purged at ``now``; expired cells become tombstones first."""
    early = [c for c in pieces(spec) if c.endswith(EARLY)]
    kept = rec.compact(as_of(state, spec, now, tuple(early)), spec, now, gc_grace, min_other_ts, tuple(early))
    # what is dead by now has no second candidate any more
    open_ = lambda c: ~F.col(f"{c}.expired") if c == "_live" else ~F.col(f"{c}.dead")
    second = [F.when(open_(c), F.col(c + EARLY)).alias(c + EARLY) for c in ("_live", *spec.regular)]
    return kept.select(*spec.key, "_live", "_del", *spec.regular, *second).select(*spec.key, *pieces(spec))

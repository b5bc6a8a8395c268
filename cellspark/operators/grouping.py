"""GROUP BY on primary-key prefixes with first-row columns."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from cellspark.operators import select
from cellspark.session import tasks_for
from cellspark.spec import TableSpec


def check_prefix(spec: TableSpec, group: list[str], fixed: tuple[str, ...] = ()) -> None:
    """The group must be a prefix of the primary key; skipped columns must be fixed by ``=``."""
    missing = [c for c in spec.pk if c not in group and c not in fixed]
    if missing:
        raise ValueError(f"GROUP BY must hold the whole partition key, missing {missing}")
    position = -1
    for c in group:
        if c not in spec.key:
            raise ValueError(f"GROUP BY column {c} is not a primary key column")
        here = spec.key.index(c)
        if here <= position:
            raise ValueError("GROUP BY columns must follow the primary key order")
        gap = [x for x in spec.key[position + 1:here] if x not in fixed]
        if gap:
            raise ValueError(f"GROUP BY skips {gap}")
        position = here


def group_by(df: DataFrame, spec: TableSpec, group: list[str], aggregates: dict[str, Column],
             first: list[str] = (), fixed: tuple[str, ...] = ()) -> DataFrame:
    """Group by a key prefix; ``first`` columns show the group's first row."""
    check_prefix(spec, group, fixed)
    aggs = [c.alias(name) for name, c in aggregates.items()]
    first = [c for c in first if c not in group]
    if not first:
        return df.groupBy(*group).agg(*aggs)
    payload = select.pick_row(spec, first, group=group).alias("_first")
    out = df.groupBy(*group).agg(payload, *aggs)
    return out.select(*group, *[F.col(f"_first.{c}").alias(c) for c in first], *aggregates)


def group_star(df: DataFrame, spec: TableSpec, group: list[str], aggregates: dict[str, Column]) -> DataFrame:
    """GROUP BY beside ``*``: every other column comes from the group's first row."""
    return group_by(df, spec, group, aggregates, [c for c in df.columns if c not in group])


def aggregate(df: DataFrame, aggregates: dict[str, Column]) -> DataFrame:
    """Aggregates without GROUP BY: always one row."""
    return df.agg(*[c.alias(name) for name, c in aggregates.items()])


def order_groups(df: DataFrame, spec: TableSpec, group: list[str]) -> DataFrame:
    """Groups in token order, then key order."""
    lead = F.xxhash64(*spec.pk)
    directions = dict(spec.clustering)
    rest = [F.col(c).desc() if directions.get(c) == "desc" else F.col(c) for c in group]
    return df.orderBy(lead, *rest)


@dataclass(frozen=True)
class GroupState:
    """Where paging over groups goes on: the last row read, and what is known of the group it belongs to."""

    after: tuple | None = None
    open: Row | None = None


def page_groups(df: DataFrame, spec: TableSpec, group: list[str], partial: dict[str, tuple[Column, Callable]], size: int,
                state: GroupState = GroupState(), limit: int | None = None) -> tuple[DataFrame, GroupState | None]:
    """The groups that the next ``size`` rows in token order finish, and the state to go on from (None at the end).

    A page ends wherever its rows do, so its last group stays open: its partial aggregate is in the state and is
    merged with what the next page reads. ``partial`` gives each aggregate over rows and the function that merges two of
    them. With ``limit`` only so many rows of each partition count, wherever pages are cut.
    """
    check_prefix(spec, group)
    rows, read = select.large_page(df, spec, size, state.after, limit)
    known = rows.groupBy(*group).agg(*[c.alias(name) for name, (c, _) in partial.items()])
    if state.open is not None:
        # one row: the group left open by the page before
        known = known.unionByName(df.sparkSession.createDataFrame([state.open], known.schema))
    # dealt by number, so that the groups of a large page are not put together in few tasks
    dealt = known.repartition(tasks_for(df.sparkSession, read), *group)
    merged = dealt.groupBy(*group).agg(*[merge(name).alias(name) for name, (_, merge) in partial.items()])
    if read < size:
        return merged, None
    last = rows.select("_token", *spec.key).orderBy(F.desc("_token"), *[F.desc(c) for c in spec.pk], *spec.clustering_order(reverse=True)).first()
    mine = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(last[c])) for c in group])
    return merged.filter(~mine), GroupState(tuple(last), merged.filter(mine).first())

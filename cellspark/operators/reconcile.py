"""Merging of mutations into table state: last write wins for every cell.

A mutation log is a DataFrame with the key columns, one column per regular cell and

``_op``   insert | update | delete_row | delete_cells | delete_partition (default insert)
``_ts``   write time in microseconds, decides who wins
``_ttl``  seconds to live, 0 or null for none (default 0)
``_now``  wall-clock seconds of the write (default ``_ts`` / 10^6)
``_set``  names of the cells the mutation touches; null means the non-null ones. A touched
          cell with a null value is a tombstone.

State is one row per primary key with a struct per cell. The struct fields are laid out in
comparison order, so reconciling any number of versions is ``max`` over the struct: it is
associative, commutative and idempotent, is combined map-side before the shuffle, and
already merged states can be merged again in the same way.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellspark.operators.ranges import covering
from cellspark.spec import MAX_EXPIRY, TableSpec

NEVER = 2147483647  # fixed value: "no local deletion time"
ROW_OPS = ("insert", "update", "delete_row", "delete_cells")


def _meta(log: DataFrame, name: str, default: Column) -> Column:
    return F.coalesce(F.col(name), default) if name in log.columns else default


def _tie_key(value: Column, dtype: T.DataType) -> Column:
    """Serialized bytes with each top bit flipped: unsigned order equals signed byte order."""
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        width = {"tinyint": 2, "smallint": 4, "int": 8, "bigint": 16}[dtype.simpleString()]
        digits = F.substring(F.lpad(F.hex(value.cast("bigint")), 16, "0"), -width, width)
    elif isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        digits = F.lpad(F.hex(F.unix_millis(value.cast("timestamp"))), 16, "0")
    elif isinstance(dtype, T.BooleanType):
        digits = F.when(value, "01").otherwise("00")
    elif isinstance(dtype, T.BinaryType):
        digits = F.hex(value)
    elif isinstance(dtype, (T.DoubleType, T.FloatType)):
        from cellspark.functions.blob import as_blob

        digits = F.hex(as_blob(value, dtype.simpleString()))
    else:
        digits = F.hex(F.encode(value.cast("string"), "UTF-8"))
    return _flip(digits)


def _flip(digits: Column) -> Column:
    pairs = F.regexp_extract_all(digits, F.lit("([0-9A-F][0-9A-F])"), F.lit(1))
    flipped = F.transform(pairs, lambda p: F.concat(
        F.translate(F.substring(p, 1, 1), "0123456789ABCDEF", "89ABCDEF01234567"),
        F.substring(p, 2, 1)))
    return F.array_join(flipped, "")


def _comparable(value: Column, dtype: T.DataType) -> Column:
    # maps have no order in Spark: keep them as sorted entries inside the state
    return F.array_sort(F.map_entries(value)) if isinstance(dtype, T.MapType) else value


def _versions(log: DataFrame, spec: TableSpec, now: int, tie: str) -> list[Column]:
    """Liveness, deletion and one struct per cell of a mutation, named as in the state."""
    op = _meta(log, "_op", F.lit("insert"))
    ts = F.col("_ts").cast("bigint")
    ttl = _meta(log, "_ttl", F.lit(spec.default_ttl)).cast("int")
    written_at = _meta(log, "_now", F.call_function("div", ts, F.lit(1000000)))
    expires = F.when(ttl > 0, F.least(written_at + ttl, F.lit(MAX_EXPIRY))).cast("bigint")
    expired = F.coalesce(expires <= now, F.lit(False))
    data = op.isin("insert", "update")

    cells = []
    for name in spec.regular:
        dtype = log.schema[name].dataType
        v = F.col(name)
        touched = v.isNotNull()
        if "_set" in log.columns:
            touched = F.coalesce(F.array_contains("_set", name), v.isNotNull())
        live = data & v.isNotNull()
        kept = F.when(data, _comparable(v, dtype))
        fields = [ts.alias("ts"), (~live | expired).alias("dead")]
        if tie == "bytes":
            fields.append(F.when(data, _tie_key(v, dtype)).alias("k"))
        elif tie != "value":
            raise ValueError("tie must be value or bytes")
        fields += [
            kept.alias("v"),
            F.when(~live, written_at).when(ttl > 0, expires).otherwise(NEVER).cast("bigint").alias("ldt"),
            F.when(live & (ttl > 0), ttl).alias("ttl"),
        ]
        cells.append(F.when(touched & (data | (op == "delete_cells")), F.struct(*fields)).alias(name))

    liveness = F.when(op == "insert", F.struct(
        ts.alias("ts"), expired.alias("expired"), (ttl > 0).alias("expiring"),
        F.coalesce(expires, F.lit(NEVER)).cast("bigint").alias("exp"),
        F.when(ttl > 0, ttl).alias("ttl"))).alias("_live")
    deletion = F.when(op == "delete_row", F.struct(
        ts.alias("ts"), written_at.cast("bigint").alias("ldt"))).alias("_del")
    return [liveness, deletion, *cells]


def _row_mutations(log: DataFrame) -> DataFrame:
    return log.filter(F.col("_op").isNull() | F.col("_op").isin(*ROW_OPS)) if "_op" in log.columns else log


def to_state(log: DataFrame, spec: TableSpec, now: int, tie: str = "value") -> DataFrame:
    """Each row mutation as a one-version state row (a projection, no shuffle)."""
    return _row_mutations(log).select(*spec.key, *_versions(log, spec, now, tie))


def merge_log(log: DataFrame, spec: TableSpec, now: int, tie: str = "value") -> DataFrame:
    """``merge_states(to_state(log))`` with the versions built inside the aggregate.

    The rows sorted for the map-side combine are then the narrow mutations, not the state.
    """
    names = ["_live", "_del", *spec.regular]
    versions = _versions(log, spec, now, tie)
    return _row_mutations(log).groupBy(*spec.key).agg(*[F.max(v).alias(n) for n, v in zip(names, versions)])


def by_key(log: DataFrame, spec: TableSpec, tasks: int) -> DataFrame:
    """The log (or states) dealt to ``tasks`` tasks by key, for merges of few versions of many keys.

    What follows needs no other shuffle: merges of it, and merges of several that are dealt alike. The rows of a task
    are bounded whatever the number of shuffle partitions. There is no map-side combine, so a log with hot keys
    is better left as it is.
    """
    return log.repartition(tasks, *spec.key)


def merge_states(states: DataFrame, spec: TableSpec) -> DataFrame:
    """One state row per key from any number of them: a single aggregate with map-side combine."""
    return states.groupBy(*spec.key).agg(
        *[F.max(c).alias(c) for c in ("_live", "_del", *spec.regular)])


def partition_deletions(log: DataFrame, spec: TableSpec) -> DataFrame:
    """The newest deletion of each deleted partition."""
    ts = F.col("_ts").cast("bigint")
    written_at = _meta(log, "_now", F.call_function("div", ts, F.lit(1000000)))
    return log.filter(F.col("_op") == "delete_partition").groupBy(*spec.pk).agg(
        F.max(F.struct(ts.alias("ts"), written_at.cast("bigint").alias("ldt"))).alias("_pdel"))


def with_partition_deletions(state: DataFrame, deletions: DataFrame, spec: TableSpec) -> DataFrame:
    joined = state.join(deletions, spec.pk, "left")
    return joined.withColumn("_del", F.greatest("_del", "_pdel")).drop("_pdel")


def with_range_deletions(state: DataFrame, ranges: DataFrame, spec: TableSpec,
                         bin_rows: int | None = None, rows: DataFrame | None = None) -> DataFrame:
    """Apply range tombstones (see ``ranges.covering``) to merged state, in pieces of ``bin_rows`` events.

    ``rows`` may give the keys from elsewhere (the log the state was merged from): only the
    key columns are read then, instead of merging the state a second time.

    Working on merged rows is exact: each cell's winner has the largest timestamp, so if the
    winner is covered every older version is too.
    """
    found = covering(state if rows is None else rows, ranges, spec, bin_rows)
    joined = state.join(found, spec.key, "left")
    return joined.withColumn("_del", F.greatest("_del", "_rdel")).drop("_rdel")


def shadow(state: DataFrame, spec: TableSpec, carry: tuple[str, ...] = ()) -> DataFrame:
    """Drop liveness and cells written at or before the row's deletion."""
    gone = lambda c: F.when(F.col("_del").isNull() | (F.col(f"{c}.ts") > F.col("_del.ts")), F.col(c))
    return state.select(*spec.key, gone("_live").alias("_live"), "_del",
                        *[gone(c).alias(c) for c in spec.regular], *carry)


def reconcile(log: DataFrame, spec: TableSpec, now: int, tie: str = "value",
              partition_deletes: bool = True, ranges: DataFrame | None = None) -> DataFrame:
    """Table state at ``now`` from a mutation log."""
    state = merge_log(log, spec, now, tie)
    if partition_deletes and "_op" in log.columns:
        state = with_partition_deletions(state, partition_deletions(log, spec), spec)
    if ranges is not None:
        state = with_range_deletions(state, ranges, spec, rows=_row_mutations(log))
    return shadow(state, spec)


def _shown(name: str, dtype: T.DataType) -> Column:
    v = F.col(f"{name}.v")
    inner = dtype["v"].dataType
    if isinstance(inner, T.ArrayType) and isinstance(inner.elementType, T.StructType) and \
            inner.elementType.fieldNames() == ["key", "value"]:
        return F.map_from_entries(v)
    return v


def is_live_row(spec: TableSpec) -> Column:
    alive = F.coalesce(~F.col("_live.expired"), F.lit(False))
    for c in spec.regular:
        alive = alive | F.coalesce(~F.col(f"{c}.dead"), F.lit(False))
    return alive


def live_rows(state: DataFrame, spec: TableSpec, meta: bool = False) -> DataFrame:
    """Rows a reader sees at the time of the state: live cells of live rows.

    Expiry is that of the time the state was reconciled for; ``lasting`` holds state that is read at any time.

    With ``meta`` each cell also shows ``<c>__writetime`` (µs) and ``<c>__expires`` (s).
    """
    out = []
    for c in spec.regular:
        alive = ~F.col(f"{c}.dead")
        out.append(F.when(alive, _shown(c, state.schema[c].dataType)).alias(c))
        if meta:
            out.append(F.when(alive, F.col(f"{c}.ts")).alias(f"{c}__writetime"))
            out.append(F.when(alive & F.col(f"{c}.ttl").isNotNull(), F.col(f"{c}.ldt")).alias(f"{c}__expires"))
    return state.filter(is_live_row(spec)).select(*spec.key, *out)


def merge_copies(copies: list[DataFrame], spec: TableSpec) -> DataFrame:
    """Merge several states of the same table (files, copies)."""
    union = copies[0]
    for other in copies[1:]:
        union = union.unionByName(other)
    return shadow(merge_states(union, spec), spec)


def reconcile_static(log: DataFrame, spec: TableSpec, now: int) -> DataFrame:
    """Live statics of each partition from ``update_static`` mutations."""
    per_partition = TableSpec(spec.pk, (), (), spec.static, spec.default_ttl, spec.gc_grace)
    rows = log.filter(F.col("_op") == "update_static").withColumn("_op", F.lit("update"))
    return live_rows(reconcile(rows, per_partition, now, partition_deletes=False), per_partition)


def reconcile_collection(log: DataFrame, key: list[str], now: int, kind: str) -> DataFrame:
    """A collection cell from element mutations: each element is reconciled on its own.

    ``log``: key, ``path`` (map key, set element or list position), ``value``, ``_op`` in
    put | remove | overwrite, ``_ts``, optional ``_ttl`` and ``_now``. ``overwrite`` deletes
    every element written at or before its time. Gives key and ``v``; no live element, no row.
    """
    ts = F.col("_ts").cast("bigint")
    ttl = _meta(log, "_ttl", F.lit(0))
    written_at = _meta(log, "_now", F.call_function("div", ts, F.lit(1000000)))
    put = F.col("_op") == "put"
    dead = ~put | F.coalesce((ttl > 0) & (written_at + ttl <= now), F.lit(False))
    cell = F.struct(ts.alias("ts"), dead.alias("dead"), F.when(put, F.col("value")).alias("value"))
    elements = log.groupBy(*key, "path").agg(
        F.max(F.when(F.col("_op") != "overwrite", cell)).alias("cell"),
        F.max(F.when(F.col("_op") == "overwrite", ts)).alias("cleared"))
    # elements are distinct by now: the list holds the final collection only
    gathered = elements.groupBy(*key).agg(
        F.max("cleared").alias("cleared"),
        F.array_sort(F.collect_list(F.when(~F.col("cell.dead"), F.struct(
            "path", F.col("cell.value").alias("value"), F.col("cell.ts").alias("ts"))))).alias("items"))
    alive = F.filter("items", lambda x: F.col("cleared").isNull() | (x["ts"] > F.col("cleared")))
    shape = {
        "map": lambda a: F.map_from_entries(F.transform(a, lambda x: F.struct(x["path"], x["value"]))),
        "set": lambda a: F.transform(a, lambda x: x["path"]),
        "list": lambda a: F.transform(a, lambda x: x["value"]),
    }[kind]
    return (gathered.withColumn("alive", alive).filter(F.size("alive") > 0)
            .select(*key, shape(F.col("alive")).alias("v")))


def merge_counters(shards: DataFrame, key: list[str]) -> DataFrame:
    """Counter values from shards (key, ``shard``, ``kind``, ``clock``, ``count``, ``dead``).

    Per shard id a global shard beats a local one and a local one a remote one; global and
    remote shards keep the largest clock, local shards add up. A tombstone wins over all.
    """
    newest = F.struct("clock", "count")
    per_shard = shards.groupBy(*key, "shard").agg(
        F.max(F.when(F.col("kind") == "global", newest)).alias("g"),
        F.sum(F.when(F.col("kind") == "local", F.col("count"))).alias("l"),
        F.max(F.when(F.col("kind") == "remote", newest)).alias("r"),
        F.max(F.coalesce(F.col("dead"), F.lit(False))).alias("dead"))
    return per_shard.groupBy(*key).agg(
        F.sum(F.coalesce(F.col("g.count"), F.col("l"), F.col("r.count"), F.lit(0))).alias("value"),
        F.max("dead").alias("dead")).filter(~F.col("dead")).drop("dead")


def skip_garbage(data: DataFrame, others: DataFrame, spec: TableSpec, level: str = "ROW") -> DataFrame:
    """Leave out data of the compacted inputs that newer data in other sources covers.

    ``data`` and ``others`` are states. ROW uses row deletions of the other sources, CELL
    also newer versions of single cells.
    """
    if level == "NONE":
        return data
    o = merge_states(others, spec).select(
        *spec.key, F.col("_del").alias("_odel"), *[F.col(c).alias(f"_o_{c}") for c in spec.regular])
    joined = data.join(o, spec.key, "left")

    def keep(c: str) -> Column:
        drop = F.coalesce(F.col(f"{c}.ts") <= F.col("_odel.ts"), F.lit(False))
        if level == "CELL" and c not in ("_live", "_del"):
            drop = drop | F.coalesce(F.col(f"{c}.ts") < F.col(f"_o_{c}.ts"), F.lit(False))
        return F.when(~drop, F.col(c)).alias(c)

    out = joined.select(*spec.key, *[keep(c) for c in ("_live", "_del", *spec.regular)])
    return out.filter(_anything(spec))


def _anything(spec: TableSpec) -> Column:
    return reduce(lambda a, b: a | b,
                  [F.col(c).isNotNull() for c in ("_live", "_del", *spec.regular)])


def compact(state: DataFrame, spec: TableSpec, now: int, gc_grace: int | None = None,
            min_other_ts: int | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """Purge tombstones past their grace period; cells expired by ``now`` become tombstones first.

    A tombstone stays while data outside this compaction may be as old as it
    (``min_other_ts`` is the smallest write time there).
    """
    gc_before = now - (spec.gc_grace if gc_grace is None else gc_grace)

    def purgeable(ts: Column, ldt: Column) -> Column:
        old = ldt < gc_before
        return old if min_other_ts is None else old & (ts < min_other_ts)

    def cell(c: str) -> Column:
        x = F.col(c)
        expired = x["ttl"].isNotNull() & (x["dead"] | (x["ldt"] <= now))
        dead = x["dead"] | expired
        ldt = F.when(expired, x["ldt"] - x["ttl"]).otherwise(x["ldt"])
        drop = dead & purgeable(x["ts"], ldt)
        names = state.schema[c].dataType.fieldNames()
        null = lambda n: F.lit(None).cast(state.schema[c].dataType[n].dataType)
        stone = F.struct(*[
            {"ts": x["ts"], "dead": F.lit(True), "ldt": ldt}.get(n, null(n)).alias(n) for n in names])
        return F.when(x.isNull() | drop, None).when(dead, stone).otherwise(x).alias(c)

    live = F.col("_live")
    expired = live["expired"] | F.coalesce(live["expiring"] & (live["exp"] <= now), F.lit(False))
    shown = F.struct(*[(expired if n == "expired" else live[n]).alias(n) for n in state.schema["_live"].dataType.fieldNames()])
    liveness = F.when(~(expired & purgeable(live["ts"], live["exp"])), shown).alias("_live")
    deletion = F.when(~purgeable(F.col("_del.ts"), F.col("_del.ldt")), F.col("_del")).alias("_del")
    out = state.select(*spec.key, liveness, deletion, *[cell(c) for c in spec.regular], *carry)
    return out.filter(_anything(spec))


def purge_deletions(deletions: DataFrame, ts: Column, ldt: Column, now: int, gc_grace: int,
                    min_other_ts: int | None = None) -> DataFrame:
    """Partition or range tombstones that a compaction has to keep."""
    old = ldt < now - gc_grace
    return deletions.filter(~(old if min_other_ts is None else old & (ts < min_other_ts)))

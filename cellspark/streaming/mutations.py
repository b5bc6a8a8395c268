"""Sources, state, counters, windows, audit and view upkeep over mutation streams.

Writes may arrive in any order and are never dropped: reconciliation compares write times,
so state carries no watermark. Every sink is idempotent per batch id, which makes a replay
after a failure harmless.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from cellspark.functions.aggregates import sum_of
from cellspark.operators import lasting, mutate, views
from cellspark.operators import reconcile as rec
from cellspark.spec import TableSpec, ViewSpec


def source(spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None = None) -> DataFrame:
    """A folder (or path pattern) of mutation files as a stream."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def latest_state(log: DataFrame, spec: TableSpec, now: int | None = None) -> DataFrame:
    """Merged state per key as a streaming aggregate (update or complete mode).

    Without ``now`` it is lasting state, which is read at any time: see ``lasting.as_of``.
    """
    return lasting.merge(lasting.versions(log, spec), spec) if now is None else rec.merge_log(log, spec, now)


def live_latest(spark: SparkSession, state_path: str, spec: TableSpec) -> DataFrame:
    """Live rows from state written by :func:`upsert_sink`."""
    newest = current(spark, state_path, spec.key)
    return rec.live_rows(rec.shadow(newest, spec), spec)


def retained(state: DataFrame, spec: TableSpec, now: int, gc_grace: int | None = None) -> DataFrame:
    """What has to be kept between batches: expired data and old tombstones go."""
    return rec.compact(state, spec, now, gc_grace)


def counters(deltas: DataFrame, key: list[str], delta: Column, name: str = "value") -> DataFrame:
    """Running counter per key (update mode)."""
    return deltas.groupBy(*key).agg(sum_of(delta, "counter").alias(name))


def windowed(df: DataFrame, ts: str, width: str, aggregates: dict[str, Column], keys: list[str] = (),
             late_by: str = "1 hour") -> DataFrame:
    """Tumbling event-time windows; a window is final once the watermark passes it."""
    return df.withWatermark(ts, late_by).groupBy(F.window(ts, width), *keys).agg(
        *[c.alias(n) for n, c in aggregates.items()])


def interval_rates(df: DataFrame, ts: str, width: str, latency: Column) -> DataFrame:
    """Rate and exact latency percentiles per interval (batch or stream), from counts of its distinct values, which merge."""
    exact = [F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY __latency)") for p in (0.5, 0.95, 0.99)]
    return df.withColumn("__latency", latency).groupBy(F.window(ts, width)).agg(
        F.count(F.lit(1)).alias("n"), F.max("__latency").alias("max"), F.avg("__latency").alias("mean"),
        F.array(*exact).alias("p"))


def decaying_count(df: DataFrame, seconds: Column, at: int, tau: float, by: list[Column]) -> DataFrame:
    """Exponentially decaying weight of the events up to ``at``."""
    weight = F.exp((seconds - at) / F.lit(tau))
    return df.filter(seconds <= at).groupBy(*by).agg(F.sum(weight).alias("weight"))


def decayed_weights(df: DataFrame, seconds: Column, tau: int, by: list[Column]) -> DataFrame:
    """State of exponentially decaying weights, as a streaming (or batch) aggregate: read by :func:`decayed_at`.

    An event counts relative to the begin of its span of ``tau`` seconds, between 1 and e, so sums neither overflow nor
    depend on when they are read, and merge by adding. A key holds one number a span.
    """
    span = F.call_function("div", seconds, F.lit(tau)).alias("span")
    weight = F.exp((seconds % tau) / F.lit(float(tau)))
    return df.groupBy(*by, span).agg(F.sum(weight).alias("weight"))


def decayed_at(state: DataFrame, at: int, tau: int, by: list[str]) -> DataFrame:
    """The weights at the time ``at``, which is not before any event."""
    shown = F.col("weight") * F.exp((F.col("span") * tau - at) / F.lit(float(tau)))
    return state.groupBy(*by).agg(F.sum(shown).alias("weight"))


def append_sink(df: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    writer = df.writeStream.format("parquet").option("path", path).option(
        "checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def upsert_sink(df: DataFrame, path: str, checkpoint: str, available_now: bool = True,
                mode: str = "update", key: list[str] | None = None, fold_every: int | None = None) -> StreamingQuery:
    """Write each batch's changed rows to its own folder; see :func:`current`.

    With ``fold_every`` the newest version of every ``key`` is written as a new base after so many batches, so
    that readers go through one base and fewer than ``fold_every`` batches.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        put_batch(batch, path, batch_id, key, bool(fold_every) and (batch_id + 1) % fold_every == 0)

    return each_batch(df, write, checkpoint, available_now, mode)


def put_batch(rows: DataFrame, path: str, batch_id: int, key: list[str] | None = None, folded: bool = False) -> None:
    """Write a batch's changed rows to its folder, and if ``folded`` a new base of the newest rows up to it."""
    # a batch that is run again overwrites its own folder
    rows.withColumn("_batch", F.lit(batch_id).cast("bigint")).write.mode("overwrite").parquet(f"{path}/b={batch_id}")
    if folded:
        fold(rows.sparkSession, path, lambda r: newest(r, key), batch_id)


def merge_sink(log: DataFrame, make: Callable[[DataFrame], DataFrame], merge: Callable[[DataFrame], DataFrame], path: str, checkpoint: str,
               available_now: bool = True, fold_every: int | None = None) -> StreamingQuery:
    """Write the state that ``make`` builds of each batch to the batch's own folder; see :func:`merged`.

    States merge in any order, so the stream itself keeps none and no batch reads an earlier one. With
    ``fold_every`` so many batches are merged into a new base.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        make(batch).withColumn("_batch", F.lit(batch_id).cast("bigint")).write.mode("overwrite").parquet(f"{path}/b={batch_id}")
        if fold_every and (batch_id + 1) % fold_every == 0:
            fold(batch.sparkSession, path, merge, batch_id)

    return each_batch(log, write, checkpoint, available_now)


def merged(spark: SparkSession, path: str, merge: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The state in a folder written by :func:`merge_sink`."""
    return merge(batches(spark, path))


def each_batch(df: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str,
               available_now: bool = True, mode: str = "append") -> StreamingQuery:
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(fn)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


MANIFEST = "version bigint, base string, upto bigint"
NO_BATCH = -2  # below the batch that ``consolidate`` writes


def manifest(spark: SparkSession, path: str) -> tuple[str | None, int]:
    """The base that readers of ``path`` start from, and the last batch in it."""
    try:
        entries = spark.read.schema(MANIFEST).parquet(f"{path}/_manifest")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None, NO_BATCH
    last = entries.orderBy(F.desc("version")).first()
    return (last.base, last.upto) if last else (None, NO_BATCH)


def batches(spark: SparkSession, path: str) -> DataFrame:
    """What readers go through: the base of the manifest and the batches after it."""
    base, upto = manifest(spark, path)
    rows = spark.read.parquet(path).filter(F.col("b") > upto).drop("b")
    return rows if base is None else rows.unionByName(spark.read.parquet(base))


def fold(spark: SparkSession, path: str, merge: Callable[[DataFrame], DataFrame], upto: int) -> None:
    """Make a new base of the old one and the batches up to ``upto``, and let the manifest name it.

    The base gets a folder of its own and the manifest one more row in one file, so readers see the old base or the
    new one. A fold that is run again after a failure finds its batches in the base and does nothing.
    """
    base, done = manifest(spark, path)
    if done >= upto:
        return
    rows = spark.read.parquet(path).filter((F.col("b") > done) & (F.col("b") <= upto)).drop("b")
    if base is not None:
        rows = rows.unionByName(spark.read.parquet(base))
    place = f"{path}/_bases/{uuid.uuid4().hex}"
    merge(rows).withColumn("_batch", F.lit(upto).cast("bigint")).write.parquet(place)
    entry = spark.range(1).select(F.lit(upto).cast("bigint").alias("version"), F.lit(place).alias("base"), F.lit(upto).cast("bigint").alias("upto"))
    entry.coalesce(1).write.mode("append").parquet(f"{path}/_manifest")


def newest(rows: DataFrame, key: list[str]) -> DataFrame:
    rest = [c for c in rows.columns if c not in key and c != "_batch"]
    return rows.groupBy(*key).agg(F.max_by(F.struct(*rest), "_batch").alias("_r")).select(*key, "_r.*")


def current(spark: SparkSession, path: str, key: list[str]) -> DataFrame:
    """The newest version of each key in a folder written by :func:`upsert_sink`."""
    return newest(batches(spark, path), key)


def counter_sink(deltas: DataFrame, key: list[str], delta: Column, path: str, checkpoint: str, name: str = "value",
                 fold_every: int = 16, written: Callable[[int], None] = lambda batch_id: None) -> StreamingQuery:
    """Keep counters outside of the stream's own state, each batch adding once however often it runs.

    A batch writes its sums under its own id, replacing what an earlier run of it left, and the manifest says up to
    which id sums are in the base: a batch that is delivered again after that is not read again. ``written`` is
    called between the write of a batch and its commit.
    """
    def total(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*key).agg(sum_of(F.col(name), "counter").alias(name))

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        sums = batch.groupBy(*key).agg(sum_of(delta, "counter").alias(name))
        sums.withColumn("_batch", F.lit(batch_id).cast("bigint")).write.mode("overwrite").parquet(f"{path}/b={batch_id}")
        if (batch_id + 1) % fold_every == 0:
            fold(spark, path, total, batch_id)
        written(batch_id)

    return each_batch(deltas, write, checkpoint)


def counter_values(spark: SparkSession, path: str, key: list[str], name: str = "value") -> DataFrame:
    """The counters kept by :func:`counter_sink`."""
    return batches(spark, path).groupBy(*key).agg(sum_of(F.col(name), "counter").alias(name))


def with_audit(log: DataFrame, spec: TableSpec, table: str, data_path: str, audit_path: str,
               checkpoint: str) -> StreamingQuery:
    """Write mutations and the audit rows a trigger derives from them."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{data_path}/b={batch_id}")
        # the trail is derived from what was written, so that the source runs once
        kept = batch.sparkSession.read.schema(batch.schema).parquet(f"{data_path}/b={batch_id}")
        mutate.audit(kept, spec, table).write.mode("overwrite").parquet(f"{audit_path}/b={batch_id}")

    return each_batch(log, write, checkpoint)


def maintain_view(log: DataFrame, view: ViewSpec, now: int, path: str, checkpoint: str) -> StreamingQuery:
    """Keep a view of a mutation stream up to date.

    The base state lives in the streaming aggregate. Each batch writes, for the base rows it
    changed, their new view entry or its absence; nothing stored earlier is read again.
    """
    state = rec.shadow(latest_state(log, view.base, now), view.base)
    return upsert_sink(views.entries(state, view), path, checkpoint)


def view_rows(spark: SparkSession, path: str, view: ViewSpec) -> DataFrame:
    """View contents: the newest entry of every base row."""
    newest = current(spark, path, view.base.key)
    return newest.filter(F.col("entry").isNotNull()).select(
        *[F.col(f"entry.{c}").alias(c) for c in (*view.key, *view.columns)])


def consolidate(spark: SparkSession, path: str, key: list[str], out: str) -> None:
    """Rewrite a folder of batches as one: only the newest version of every key is kept."""
    newest = current(spark, path, key).withColumn("_batch", F.lit(-1).cast("bigint"))
    newest.write.mode("overwrite").parquet(f"{out}/b=-1")

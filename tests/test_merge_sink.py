"""State merged from batches: the stream keeps none, and late writes lose as in one batch."""

import os

from pyspark.sql import functions as F

from cellspark import TableSpec
from cellspark.operators import reconcile as rec
from cellspark.streaming import mutations as S

SPEC = TableSpec(["k"], ["c"], (), ["v"])


def test_batches_merge_without_stream_state(spark, rows, tmp_path):
    log = spark.range(90).select((F.col("id") % 4).alias("k"), (F.col("id") % 5).alias("c"), F.col("id").alias("v"),
                                 (F.col("id") * 37 % 90 * 1000000 + 1000000).alias("_ts"))
    for i in range(3):
        log.filter(F.col("v") % 3 == i).coalesce(1).write.mode("append").parquet(str(tmp_path / "log"))
    merge = lambda states: rec.merge_states(states, SPEC)
    out, check = str(tmp_path / "out"), str(tmp_path / "ck")
    stream = S.source(spark, str(tmp_path / "log"), log.schema, 1)
    S.merge_sink(stream, lambda batch: S.latest_state(batch, SPEC, 10**6), merge, out, check, fold_every=2).awaitTermination()
    assert S.manifest(spark, out)[1] == 1 and not os.path.exists(f"{check}/state")
    found = rec.live_rows(rec.shadow(S.merged(spark, out, merge), SPEC), SPEC)
    assert rows(found) == rows(rec.live_rows(rec.reconcile(log, SPEC, 10**6), SPEC)) and found.count() == 20

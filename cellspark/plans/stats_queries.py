"""Table statistics queries."""

from pyspark.sql import functions as F

from cellspark.operators import replica, stats
from cellspark.plans import hash_sql
from cellspark.plans.logs import EVENT_LOG, EVENT_LOG_SQL, NOW, event_log, micros
from cellspark.plans.reconcile_queries import _SOURCES_SQL, event_sources
from cellspark.plans.registry import EVENTS, ORDERS, query
from cellspark.spec import TableSpec

_OFFSETS = "RECURSIVE offs(i, upto) AS (SELECT 0, 1::BIGINT UNION ALL SELECT i + 1, greatest(upto + 1, round(upto * 1.2)::BIGINT) FROM offs WHERE i < {n} - 1)"
_USER = TableSpec(["user_id"], ["ts", "event_id"], (), ["event_type", "value"])


@query("n1_histogram", f"""
WITH {_OFFSETS.format(n=90)},
b AS (SELECT (SELECT min(i) FROM offs WHERE upto >= v) AS bucket FROM (SELECT l_extendedprice::BIGINT AS v FROM lineitem))
SELECT bucket, count(*) AS n, any_value(upto) AS upto FROM b JOIN offs ON i = bucket GROUP BY bucket""")
def histogram(t):
    # whole prices; a half goes to the even one, as rounding halves up would shift prices on a bound upwards
    offsets = stats.bucket_offsets()
    return stats.histogram(t.lineitem, F.rint("l_extendedprice").cast("bigint"), offsets)


def _summary_sql(source: str, n: int, metric: str) -> str:
    pick = ", ".join(f"(SELECT min(upto) FROM c WHERE seen >= ceil(total * {p})) AS p{int(p * 100)}" for p in stats.PERCENTILES)
    return f"""
SELECT '{metric}' AS metric, total, least_upto AS "min", most_upto AS "max", mean, {{cols}} FROM (
  WITH {_OFFSETS.format(n=n)},
  b AS (SELECT (SELECT min(i) FROM offs WHERE upto >= v) AS bucket, count(*) AS n FROM ({source}) GROUP BY 1),
  c AS (SELECT i, upto, n, sum(n) OVER (ORDER BY i) AS seen, sum(n) OVER () AS total FROM b JOIN offs ON i = bucket)
  SELECT max(total)::BIGINT AS total, (SELECT CASE WHEN min(i) = 0 THEN 0 ELSE (SELECT o.upto FROM offs o WHERE o.i = min(c.i) - 1) + 1 END FROM c) AS least_upto,
    max(upto) AS most_upto, ceil(sum(n * upto) / max(total))::BIGINT AS mean, {pick} FROM c)""".format(
        cols=", ".join(f"p{int(p * 100)}" for p in stats.PERCENTILES))


_BYTES = "8 + 8 + 8 + strlen(event_type) + 8"


@query("n2_table_histograms",
       _summary_sql(f"SELECT sum({_BYTES}) AS v FROM events GROUP BY user_id", stats.SIZE_BUCKETS, "partition_size")
       + " UNION ALL " + _summary_sql("SELECT count(*) * 2 AS v FROM events GROUP BY user_id", stats.CELL_BUCKETS, "cell_count"))
def table_histograms(t):
    return stats.table_histograms(t.events.select(*_USER.columns), _USER)


@query("n3_streaming_histogram")
def streaming_histogram(t):
    hist = stats.streaming_histogram(t.lineitem, "l_extendedprice", 100)
    return stats.estimated_count_upto(hist, 50000.0)


@query("n3_exact_histogram", "SELECT count(*)::DOUBLE AS estimate FROM lineitem WHERE l_quantity <= 60")
def exact_histogram(t):
    # fewer distinct values than bins, and a bound above them: the estimate is exact
    return stats.estimated_count_upto(stats.streaming_histogram(t.lineitem, "l_quantity", 100), 60.0)


_CELLS = f"""
WITH {EVENT_LOG_SQL},
cells AS (SELECT value_ldt AS ldt, value_dead AS dead FROM visible WHERE value_ts > del_ts
          UNION ALL SELECT kind_ldt, kind_dead FROM visible WHERE kind_ts > del_ts)"""


def _cells(t):
    from cellspark.operators import reconcile as rec
    from cellspark.sources.changes import cells

    return cells(rec.reconcile(event_log(t), EVENT_LOG, NOW), EVENT_LOG)


@query("n4_drop_times", _CELLS + """
SELECT (ceil(ldt / 3600.0) * 3600)::BIGINT AS drop_time, count(*) AS n FROM cells WHERE dead GROUP BY 1""")
def drop_times(t):
    return stats.tombstone_drop_times(_cells(t), F.col("ldt"), F.col("dead"), 3600)


@query("n4_droppable_ratio", _CELLS + f"""
SELECT count(*) FILTER (WHERE dead AND ldt < {NOW - 5 * 86400}) AS droppable, count(*) AS cells,
       count(*) FILTER (WHERE dead AND ldt < {NOW - 5 * 86400}) / count(*)::DOUBLE AS ratio FROM cells""")
def droppable_ratio(t):
    return stats.droppable_ratio(_cells(t), F.col("ldt"), F.col("dead"), NOW - 5 * 86400)


@query("n5_key_cardinality")
def key_cardinality(t):
    exact = stats.key_cardinality(t.orders, ORDERS)
    sketches = stats.cardinality_sketches(t.orders, "o_custkey", ["o_orderpriority"])
    return exact.unionByName(stats.merge_cardinality(sketches))


@query("n6_source_metadata", f"""
WITH {_SOURCES_SQL}
SELECT s.source, count(*) AS n_rows, min(s.min_ts) AS min_ts, min(s.max_ts) AS max_ts, min(e.user_id) AS min_user_id, max(e.user_id) AS max_user_id
FROM src s JOIN events e ON s.source = 's' || (user_id % 40) || CASE WHEN ts < TIMESTAMP '2024-01-10' AND event_id % 2 = 0 THEN '_early' ELSE '_late' END
GROUP BY s.source""")
def source_metadata(t):
    return stats.source_metadata(event_sources(t), F.col("source"), micros("ts"), clustering=["user_id"])


@query("n6_file_metadata", "SELECT count(*) AS n_rows, min(event_id) AS min_event_id, max(event_id) AS max_event_id FROM events")
def file_metadata(t):
    per_file = stats.source_metadata(t.events, F.col("_metadata.file_path"), micros("ts"), clustering=["event_id"])
    return per_file.agg(F.sum("n_rows").alias("n_rows"), F.min("min_event_id").alias("min_event_id"),
                        F.max("max_event_id").alias("max_event_id"))


@query("n7_table_stats", f"""
SELECT 'events' AS table_name, count(*) AS n_partitions, sum(r)::BIGINT AS n_rows, sum(c)::BIGINT AS n_cells, sum(b)::BIGINT AS n_bytes, max(b)::BIGINT AS largest_partition
FROM (SELECT count(*) AS r, count(*) * 2 AS c, sum({_BYTES}) AS b FROM events GROUP BY user_id)""")
def table_stats(t):
    return stats.table_stats(t.events.select(*_USER.columns), _USER, "events")


@query("n8_size_estimates", f"""
WITH p AS (SELECT user_id, sum({_BYTES}) AS b FROM events GROUP BY user_id)
SELECT ('0x' || substr(md5(user_id::VARCHAR), 1, 15))::BIGINT >> 57 AS token_range, count(*) AS partitions, (sum(b) // count(*))::BIGINT AS mean_size
FROM p GROUP BY 1""")
def size_estimates(t):
    return stats.size_estimates(t.events.select(*_USER.columns), _USER, 3, replica.leaf_of(_USER, 3, "md5"))


@query("n9_key_samples", f"""
WITH {hash_sql.xxhash64("SELECT DISTINCT o_custkey FROM orders", "o_custkey")} SELECT o_custkey FROM tokens WHERE token % 10 = 0""")
def key_samples(t):
    return stats.key_samples(t.orders, ORDERS, 10)


@query("n10_top_by_size", f"""
SELECT user_id, sum({_BYTES})::BIGINT AS n FROM events GROUP BY user_id ORDER BY n DESC, user_id LIMIT 10""")
def top_by_size(t):
    from cellspark.operators.select import top_partitions

    size = stats.row_bytes({"user_id": "bigint", "ts": "timestamp", "event_id": "bigint", "event_type": "string", "value": "double"})
    return top_partitions(t.events, EVENTS, 10, size)


@query("n11_sources_per_partition", """
WITH s AS (SELECT l_orderkey, count(DISTINCT l_suppkey % 8) AS n_sources FROM lineitem GROUP BY l_orderkey)
SELECT n_sources, count(*) AS n_partitions FROM s GROUP BY n_sources""")
def sources_per_partition(t):
    return stats.sources_per_partition(t.lineitem, TableSpec(["l_orderkey"]), F.col("l_suppkey") % 8)

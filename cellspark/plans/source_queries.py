"""Reading, writing, loading, dumping and generating tables."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellspark.operators import mutate, replica
from cellspark.operators import reconcile as rec
from cellspark.plans.logs import EVENT_LOG, NOW, event_log, micros
from cellspark.plans.mutation_queries import ORDER, T0, base_orders
from cellspark.plans.reconcile_queries import event_state
from cellspark.plans.registry import EVENTS, ORDERS, query
from cellspark.session import fresh_path
from cellspark.sources import changes, csvio, tables
from cellspark.spec import TableSpec
from cellspark.streaming import mutations as stream


@query("src1_scan", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 200000 AND o_orderstatus = 'F'")
def scan(t):
    return tables.scan(t.orders, ["o_orderkey", "o_totalprice"], (F.col("o_totalprice") > 200000) & (F.col("o_orderstatus") == "F"))


@query("src2_token_ranges", "SELECT o_custkey, o_orderkey, o_orderstatus FROM orders WHERE o_totalprice < 300000")
def token_ranges(t):
    return tables.scan_token_ranges(t.orders, ORDERS, 16, ["o_custkey", "o_orderkey", "o_orderstatus"],
                                    F.col("o_totalprice") < 300000).drop("_token")


@query("src2_split_counts", """
SELECT least(('0x' || substr(md5(o_custkey::VARCHAR), 1, 15))::BIGINT // 96076792050570581, 11)::BIGINT AS split, count(*) AS n_rows
FROM orders GROUP BY 1""")
def split_counts(t):
    token = F.conv(F.substring(F.md5(F.col("o_custkey").cast("string")), 1, 15), 16, 10).cast("bigint")
    return tables.split_counts(t.orders, ORDERS, 12, token, bits=60)


@query("src4_row_writer", """
SELECT o_custkey, o_orderkey, o_orderstatus AS status, o_totalprice + 1 AS price FROM orders""")
def row_writer(t):
    # a log folder that two writers append to
    path = fresh_path(t.spark, "log")
    base = base_orders(t)
    mutate.insert(base, ORDER, T0).write.mode("append").parquet(path)
    raised = base.select(*ORDER.key, (F.col("price") + 1).alias("price"))
    mutate.update(raised.withColumn("status", F.lit(None).cast("string")).withColumn("_set", F.array(F.lit("price"))),
                  ORDER, T0 + 1).select(*t.spark.read.parquet(path).columns).write.mode("append").parquet(path)
    return rec.live_rows(rec.reconcile(t.spark.read.parquet(path), ORDER, NOW), ORDER)


@query("src5_bulk_write", "SELECT user_id, ts, event_id, event_type, value, props FROM events")
def bulk_write(t):
    path = fresh_path(t.spark, "bulk")
    tables.bulk_write(t.events, EVENTS, path, bloom=True)
    return t.spark.read.parquet(path).select(*EVENTS.columns)


@query("src6_load", """
SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance FROM customer""")
def load(t):
    spec = TableSpec(["id"], (), (), ["name", "balance"])
    log = tables.load(t.customer, spec, {"c_custkey": "id", "c_name": "name", "c_acctbal": "balance"}, ignore_missing=True,
                      token_ranges=[(-(1 << 63), 0), (0, (1 << 63) - 1)], ts=F.lit(T0))
    return rec.live_rows(rec.reconcile(log, spec, NOW), spec)


@query("src7_changes", """
SELECT o_custkey, o_orderkey, 'insert' AS kind, epoch_us(o_orderdate) AS ts,
  'INSERT INTO orders (o_custkey, o_orderkey, status, price) VALUES (' || o_custkey || ', ' || o_orderkey || ', ''' || o_orderstatus
  || ''', ''' || o_orderkey || ''') USING TIMESTAMP ' || epoch_us(o_orderdate) AS statement
FROM orders""")
def change_statements(t):
    log = t.orders.select("o_custkey", "o_orderkey", F.col("o_orderstatus").alias("status"), F.col("o_orderkey").alias("price"),
                          micros("o_orderdate").alias("_ts"))
    return changes.to_changes(rec.reconcile(log, ORDER, NOW), ORDER).select(*ORDER.key, "kind", "ts", "statement")


@query("src7_change_kinds", f"""
WITH {__import__("cellspark.plans.logs", fromlist=["x"]).EVENT_LOG_SQL},
c AS (SELECT user_id, slot, CASE WHEN value_dead THEN 'delete' WHEN has_live AND value_ts = live_ts AND value_ttl = 0 THEN 'insert' ELSE 'update' END AS kind,
        value_ts AS ts, CASE WHEN NOT value_dead AND value_ttl > 0 THEN value_ttl END AS ttl FROM visible WHERE value_ts > del_ts
      UNION SELECT user_id, slot, CASE WHEN kind_dead THEN 'delete' WHEN has_live AND kind_ts = live_ts AND kind_ttl = 0 THEN 'insert' ELSE 'update' END,
        kind_ts, CASE WHEN NOT kind_dead AND kind_ttl > 0 THEN kind_ttl END FROM visible WHERE kind_ts > del_ts
      UNION SELECT user_id, slot, 'insert', live_ts, NULL FROM visible WHERE has_live
      UNION SELECT user_id, slot, 'delete_row', del_ts, NULL FROM visible WHERE del_ts > 0)
SELECT user_id, slot, kind, ts, ttl FROM c""")
def change_kinds(t):
    return changes.to_changes(event_state(t), EVENT_LOG).select(*EVENT_LOG.key, "kind", "ts", "ttl")


@query("src7_range_changes", """
SELECT o_custkey, 'delete_range' AS kind, epoch_us(o_orderdate) AS ts,
  'DELETE FROM orders USING TIMESTAMP ' || epoch_us(o_orderdate) || ' WHERE o_custkey = ' || o_custkey || ' AND o_orderkey >= ' || o_orderkey || ' AND o_orderkey < ' || (o_orderkey + 10) AS statement
FROM orders""")
def range_changes(t):
    ranges = mutate.delete_ranges(t.orders, TableSpec(["o_custkey"], ["o_orderkey"]),
                                  F.col("o_orderkey"), F.col("o_orderkey") + 10, micros("o_orderdate"), NOW)
    return changes.range_changes(ranges, ORDER)


@query("src8_dump_json", """
SELECT o_custkey, o_orderkey, '{"partition":{"key":["' || o_custkey || '"]},"type":"row","clustering":["' || o_orderkey
  || '"],"liveness_info":{"tstamp":"' || epoch_us(o_orderdate) || '"},"cells":[{"name":"status","value":"' || o_orderstatus
  || '","tstamp":"' || epoch_us(o_orderdate) || '"},{"name":"price","value":"' || o_orderkey || '","tstamp":"' || epoch_us(o_orderdate) || '"}]}' AS json
FROM orders""")
def dump_json(t):
    log = t.orders.select("o_custkey", "o_orderkey", F.col("o_orderstatus").alias("status"), F.col("o_orderkey").alias("price"),
                          micros("o_orderdate").alias("_ts"))
    return changes.dump_json(rec.reconcile(log, ORDER, NOW), ORDER, NOW, raw_times=True)


@query("src8_dump_keys", """
SELECT DISTINCT '["' || o_custkey || '"]' AS json FROM orders""")
def dump_keys(t):
    log = t.orders.select("o_custkey", "o_orderkey", F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"),
                          micros("o_orderdate").alias("_ts"))
    return changes.dump_keys(rec.reconcile(log, ORDER, NOW), ORDER)


@query("src9_csv", """
SELECT p_partkey, p_name, p_brand, p_size, p_retailprice, p_size > 25 AS big FROM part""")
def csv_round_trip(t):
    spec = TableSpec(["p_partkey"], (), (), ["p_name", "p_brand", "p_size", "p_retailprice", "big"])
    rows = t.part.select("p_partkey", "p_name", "p_brand", "p_size", "p_retailprice", (F.col("p_size") > 25).alias("big"))
    path = fresh_path(t.spark, "csv")
    style = dict(null_value="NULL", decimal_sep=",", thousands_sep=".", bool_style=("yes", "no"))
    csvio.export_csv(csvio.export_rows(rows, spec, **style), path, header=True, delimiter="|", max_rows_per_file=500)
    good, _ = csvio.import_csv(t.spark, path, rows.schema, ["p_partkey"], header=True, delimiter="|", **style)
    return good


@query("src9_csv_errors", """
SELECT event_id || ',' || CASE WHEN event_id % 11 = 0 THEN 'oops' ELSE user_id::VARCHAR END || ',' || event_type AS line, 'user_id' AS reason
FROM events WHERE event_id % 11 = 0""")
def csv_errors(t):
    path = fresh_path(t.spark, "csv")
    text = t.events.select("event_id", F.when(F.col("event_id") % 11 == 0, "oops").otherwise(
        F.col("user_id").cast("string")).alias("user_id"), "event_type")
    csvio.export_csv(text, path)
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()),
                           T.StructField("event_type", T.StringType())])
    return csvio.import_csv(t.spark, path, schema, ["event_id"])[1]


@query("src10_change_stream", "SELECT event_id, user_id, event_type, value FROM events")
def change_stream(t):
    path, checkpoint = fresh_path(t.spark, "cdc"), fresh_path(t.spark, "ck")
    # a pattern, since a file source takes a folder or a pattern but not one file's name
    files = t.path("events")[:-1] + "[t]"
    rows = stream.source(t.spark, files, t.events.schema).select("event_id", "user_id", "event_type", "value")
    stream.append_sink(rows, path, checkpoint).awaitTermination()
    return t.spark.read.parquet(path)


@query("src12_validate", """
SELECT o_orderkey, CASE WHEN o_orderkey % 97 = 0 THEN 'missing' ELSE 'different' END AS status
FROM orders WHERE o_orderkey % 97 = 0 OR (o_orderkey % 89 = 0 AND o_orderkey % 97 <> 0)""")
def validate(t):
    expected = t.orders.select("o_orderkey", "o_orderstatus")
    actual = expected.filter("o_orderkey % 97 <> 0").withColumn(
        "o_orderstatus", F.when(F.col("o_orderkey") % 89 == 0, "Q").otherwise(F.col("o_orderstatus")))
    return tables.validate(actual, expected, ["o_orderkey"])

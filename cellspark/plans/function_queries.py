"""Scalar function queries."""

import time

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellspark.functions import blob, duration, jsonfn, literals, timeuuid, token
from cellspark.plans.registry import query

_TICKS = "((epoch_us(ts) // 1000) * 10000 + 122192928000000000)"


def _uuid_sql(ticks: str, low: str) -> str:
    return (f"printf('%08x-%04x-%04x-{low}', {ticks} & 4294967295, ({ticks} >> 32) & 65535, "
            f"(({ticks} >> 48) & 4095) | 4096)")


def _events(t):
    return t.events.withColumn("ts", F.col("ts").cast("timestamp"))


def _copies():
    """How many rows have the same id."""
    return F.count(F.lit(1)).over(Window.partitionBy("id"))


def _recent(ts):
    """Whether a time is within an hour of this call."""
    return F.abs(F.unix_seconds(ts) - int(time.time())) < 3600


@query("f1_now", "SELECT event_id, '1' AS version, '8' AS variant, true AS recent, 1::BIGINT AS copies FROM events")
def now(t):
    rows = t.events.select("event_id", timeuuid.now().alias("id"))
    return rows.select(
        "event_id", F.substring("id", 15, 1).alias("version"), F.substring("id", 20, 1).alias("variant"),
        _recent(timeuuid.to_timestamp(F.col("id"))).alias("recent"), _copies().alias("copies"))


@query("f2_min_timeuuid", f"SELECT event_id, {_uuid_sql(_TICKS, '8080-808080808080')} AS u FROM events")
def min_timeuuid(t):
    return _events(t).select("event_id", timeuuid.min_timeuuid(F.col("ts")).alias("u"))


@query("f3_max_timeuuid", f"SELECT event_id, {_uuid_sql(_TICKS.replace('(epoch_us(ts) // 1000)', '(epoch_us(ts) // 1000 + 1)') + ' - 1', '7f7f-7f7f7f7f7f7f').replace(') - 1 &', ' - 1) &')} AS u FROM events")
def max_timeuuid(t):
    return _events(t).select("event_id", timeuuid.max_timeuuid(F.col("ts")).alias("u"))


@query("f4_date_of", "SELECT event_id, epoch_us(ts) // 1000 AS ms, ts::DATE AS day FROM events")
def date_of(t):
    u = timeuuid.timeuuid_of(F.col("ts"), F.col("event_id").cast("string"))
    return _events(t).select("event_id", F.unix_millis(timeuuid.date_of(u)).alias("ms"),
                             timeuuid.to_date(u).alias("day"))


@query("f5_unix_timestamp_of", "SELECT event_id, epoch_us(ts) // 1000 AS ms FROM events")
def unix_timestamp_of(t):
    u = timeuuid.timeuuid_of(F.col("ts"), F.col("event_id").cast("string"))
    return _events(t).select("event_id", timeuuid.unix_timestamp_of(u).alias("ms"))


@query("f6_to_date", "SELECT event_id, ts::DATE AS from_ts, ts::DATE AS from_uuid FROM events")
def to_date(t):
    u = timeuuid.min_timeuuid(F.col("ts"))
    return _events(t).select("event_id", timeuuid.timestamp_to_date(F.col("ts")).alias("from_ts"),
                             timeuuid.to_date(u).alias("from_uuid"))


@query("f7_to_timestamp", """
SELECT event_id, date_trunc('millisecond', ts) AS from_uuid, (ts::DATE)::TIMESTAMP AS from_date FROM events""")
def to_timestamp(t):
    u = timeuuid.min_timeuuid(F.col("ts"))
    return _events(t).select(
        "event_id", timeuuid.to_timestamp(u).cast("timestamp_ntz").alias("from_uuid"),
        timeuuid.date_to_timestamp(F.col("ts").cast("date")).cast("timestamp_ntz").alias("from_date"))


@query("f8_date_to_unix", "SELECT event_id, epoch_ms((ts::DATE)::TIMESTAMP) AS ms FROM events")
def date_to_unix(t):
    return _events(t).select("event_id", timeuuid.unix_millis(F.col("ts").cast("date")).alias("ms"))


@query("f9_to_unix", "SELECT event_id, epoch_us(ts) // 1000 AS from_ts, epoch_us(ts) // 1000 AS from_uuid FROM events")
def to_unix(t):
    return _events(t).select("event_id", timeuuid.unix_millis(F.col("ts")).alias("from_ts"),
                             timeuuid.to_unix_millis(timeuuid.max_timeuuid(F.col("ts"))).alias("from_uuid"))


@query("f10_uuid", "SELECT event_id, '4' AS version, true AS variant, 1::BIGINT AS copies FROM events")
def random_uuid(t):
    rows = t.events.select("event_id", timeuuid.random_uuid().alias("id"))
    return rows.select("event_id", F.substring("id", 15, 1).alias("version"),
                       F.substring("id", 20, 1).isin("8", "9", "a", "b").alias("variant"), _copies().alias("copies"))


@query("f11_as_blob", """
SELECT l_orderkey, l_linenumber, printf('%016X', l_partkey) AS big, printf('%08X', l_linenumber) AS i32,
       hex(l_returnflag) AS txt, printf('%016X', epoch_ms(l_shipdate)) AS ts,
       printf('%08X', date_diff('day', DATE '1970-01-01', l_shipdate::DATE) + 2147483648) AS day
FROM lineitem""")
def as_blob(t):
    b = lambda c, kind: F.hex(blob.as_blob(c, kind))
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", b(F.col("l_partkey"), "bigint").alias("big"),
        b(F.col("l_linenumber"), "int").alias("i32"), b(F.col("l_returnflag"), "text").alias("txt"),
        b(F.col("l_shipdate"), "timestamp").alias("ts"), b(F.col("l_shipdate").cast("date"), "date").alias("day"))


@query("f12_blob_as", """
SELECT l_orderkey, -l_partkey AS big, l_linenumber AS i32, (-l_linenumber)::SMALLINT AS i16, l_extendedprice AS d,
       l_returnflag AS txt, l_shipdate::DATE AS day FROM lineitem""")
def blob_as(t):
    turn = lambda c, kind: blob.blob_as(blob.as_blob(c, kind), kind)
    return t.lineitem.select(
        "l_orderkey", turn(-F.col("l_partkey"), "bigint").alias("big"), turn(F.col("l_linenumber"), "int").alias("i32"),
        turn((-F.col("l_linenumber")).cast("smallint"), "smallint").alias("i16"),
        turn(F.col("l_extendedprice"), "double").alias("d"), turn(F.col("l_returnflag"), "text").alias("txt"),
        turn(F.col("l_shipdate").cast("date"), "date").alias("day"))


@query("f13_to_json", """
SELECT o_orderkey, o_orderkey::VARCHAR AS n, '"' || o_orderstatus || '"' AS s,
  '[' || o_orderkey || ',' || o_custkey || ']' AS l, '{"k":' || o_custkey || '}' AS m,
  '{"a":' || o_custkey || ',"b":"' || o_orderpriority || '"}' AS u,
  '[' || o_custkey || ', "' || o_orderpriority || '"]' AS t,
  CASE WHEN o_orderstatus = 'F' THEN 'null' ELSE o_custkey::VARCHAR END AS maybe,
  '"' || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || '.000Z"' AS ts
FROM orders""")
def to_json(t):
    schema = t.orders.schema
    long, text = T.LongType(), T.StringType()
    pair = T.StructType([T.StructField("a", long), T.StructField("b", text)])
    u = F.struct(F.col("o_custkey").alias("a"), F.col("o_orderpriority").alias("b"))
    maybe = F.when(F.col("o_orderstatus") != "F", F.col("o_custkey"))
    return t.orders.select(
        "o_orderkey", jsonfn.to_json(F.col("o_orderkey"), long).alias("n"),
        jsonfn.to_json(F.col("o_orderstatus"), text).alias("s"),
        jsonfn.to_json(F.array("o_orderkey", "o_custkey"), T.ArrayType(long)).alias("l"),
        jsonfn.to_json(F.create_map(F.lit("k"), "o_custkey"), T.MapType(text, long)).alias("m"),
        jsonfn.to_json(u, pair).alias("u"), jsonfn.tuple_json(u, pair).alias("t"),
        jsonfn.to_json(maybe, long).alias("maybe"),
        jsonfn.to_json(F.col("o_orderdate"), schema["o_orderdate"].dataType).alias("ts"))


@query("f14_from_json", """
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events""")
def from_json(t):
    schema = T.StructType([T.StructField("k", T.IntegerType())])
    return t.events.select("event_id", jsonfn.from_json(F.col("props"), schema)["k"].alias("k"))


@query("f15_duration", """
SELECT l_orderkey, l_linenumber, l_linenumber * 12 + 3 AS months, (l_quantity::INTEGER + 7) AS days,
       (l_linenumber::BIGINT * 3600 + 5) * 1000000000 AS nanos,
       l_linenumber || 'y3mo' || (l_quantity::INTEGER + 7) || 'd' || l_linenumber || 'h5s' AS txt, -14 AS iso_days
FROM lineitem""")
def parse_duration(t):
    n, q = F.col("l_linenumber").cast("string"), F.col("l_quantity").cast("int").cast("string")
    text = F.concat(n, F.lit("y3mo1w"), q, F.lit("d"), n, F.lit("h5s"))
    d = duration.parse_duration(text)
    iso = duration.parse_duration(F.lit("-P2W"))
    return t.lineitem.select("l_orderkey", "l_linenumber", d["months"].alias("months"), d["days"].alias("days"),
                             d["nanos"].alias("nanos"), duration.duration_text(d).alias("txt"),
                             iso["days"].alias("iso_days"))


@query("f16_add_duration", """
SELECT event_id, ts + to_months((event_id % 14)::INTEGER) + to_days((event_id % 40)::INTEGER) + to_seconds(event_id % 1000) AS later
FROM events""")
def add_duration(t):
    e = F.col("event_id")
    d = duration.duration(e % 14, e % 40, (e % 1000) * 10**9)
    return t.events.select("event_id", duration.add_duration(F.col("ts"), d).alias("later"))


@query("f17_current", "SELECT event_id, true AS recent, true AS same_day, true AS same_time FROM events")
def current(t):
    rows = t.events.select("event_id", timeuuid.current_timestamp().alias("ts"), timeuuid.current_date().alias("day"),
                           timeuuid.current_time_nanos().alias("time"))
    since_midnight = F.unix_micros("ts") - F.unix_micros(F.col("day").cast("timestamp"))
    return rows.select("event_id", _recent(F.col("ts")).alias("recent"), (F.to_date("ts") == F.col("day")).alias("same_day"),
                       (since_midnight * 1000 == F.col("time")).alias("same_time"))


@query("f18_literals", """
SELECT event_id, date_trunc('millisecond', ts) AS a, date_trunc('second', ts) - INTERVAL 2 HOUR AS b,
       date_trunc('minute', ts) AS c, ts::DATE AS d, ts::DATE AS e,
       ((extract(hour FROM ts) * 60 + extract(minute FROM ts)) * 60 * 1000000 + extract(microsecond FROM ts))::BIGINT * 1000 AS f
FROM events""")
def parse_literals(t):
    fmt = lambda pattern: F.date_format("ts", pattern)
    ntz = lambda text: literals.parse_timestamp(text).cast("timestamp_ntz")
    day_number = (F.unix_date(F.col("ts").cast("date")).cast("bigint") + (1 << 31)).cast("string")
    return _events(t).select(
        "event_id", ntz(fmt("yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")).alias("a"),
        ntz(fmt("yyyy-MM-dd HH:mm:ss'+0200'")).alias("b"), ntz(fmt("yyyy-MM-dd HH:mm")).alias("c"),
        literals.parse_date(fmt("yyyy-MM-dd")).alias("d"), literals.parse_date(day_number).alias("e"),
        literals.parse_time(fmt("HH:mm:ss.SSSSSS")).alias("f"))


@query("f19_uuid_order", """
SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY epoch_us(ts) DESC, event_id) AS place FROM events""")
def uuid_order(t):
    u = timeuuid.timeuuid_of(F.col("ts"), F.col("event_id").cast("string"))
    rows = _events(t).select("user_id", "event_id", timeuuid.order_key(u)["ticks"].alias("ticks"))
    place = F.row_number().over(Window.partitionBy("user_id").orderBy(F.desc("ticks"), "event_id"))
    return rows.select("user_id", "event_id", place.cast("bigint").alias("place"))


@query("f21_md5_token", """
WITH m AS (SELECT p_partkey, md5(p_name) AS h FROM part),
x AS (SELECT *, ('0x' || substr(h, 1, 16))::UBIGINT AS hi, ('0x' || substr(h, 17, 16))::UBIGINT AS lo FROM m)
SELECT p_partkey, CASE WHEN h < '8' THEN h ELSE
  printf('%016x', (18446744073709551615 - hi + CASE WHEN lo = 0 THEN 1 ELSE 0 END)::UBIGINT)
  || printf('%016x', CASE WHEN lo = 0 THEN 0::UBIGINT ELSE (18446744073709551615 - lo + 1)::UBIGINT END) END AS token
FROM x""")
def md5(t):
    return t.part.select("p_partkey", token.token(["p_name"], ["text"], "md5").alias("token"))


@query("f21_ordered_token", "SELECT p_partkey, p_name AS token FROM part")
def ordered(t):
    return t.part.select("p_partkey", token.token(["p_name"], method="ordered").alias("token"))

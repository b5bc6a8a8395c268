"""Cast queries."""

from pyspark.sql import functions as F

from cellspark.functions import numeric as N
from cellspark.functions import timeuuid
from cellspark.plans.aggregate_queries import wrap_sql
from cellspark.plans.registry import query

_INT = "least(greatest(trunc({0}), -2147483648), 2147483647)::BIGINT"


@query("c1_to_integer", f"""
SELECT l_orderkey, l_linenumber, l_partkey,
  {wrap_sql("l_partkey::HUGEINT * 1000", "tinyint")} AS t1, {wrap_sql("l_partkey::HUGEINT * 1000", "smallint")} AS t2,
  {wrap_sql("l_partkey::HUGEINT * 10000000", "int")} AS t3,
  {wrap_sql(_INT.format("l_extendedprice"), "tinyint")} AS f1, {wrap_sql(_INT.format("l_extendedprice"), "smallint")} AS f2,
  {_INT.format("l_extendedprice * 1e5")}::INTEGER AS f3, trunc(-l_extendedprice)::BIGINT AS f4, 0 AS nan
FROM lineitem""")
def to_integer(t):
    k, x = F.col("l_partkey"), F.col("l_extendedprice")
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", N.cast_to(k * 1000, "bigint", "tinyint").alias("t1"),
        N.cast_to(k * 1000, "bigint", "smallint").alias("t2"), N.cast_to(k * 10000000, "bigint", "int").alias("t3"),
        N.cast_to(x, "double", "tinyint").alias("f1"), N.cast_to(x, "double", "smallint").alias("f2"),
        N.cast_to(x * 1e5, "double", "int").alias("f3"), N.cast_to(-x, "double", "bigint").alias("f4"),
        N.cast_to(F.lit(float("nan")), "double", "int").alias("nan"))


@query("c2_to_float", """
SELECT l_orderkey, l_partkey::DOUBLE AS d, l_partkey::FLOAT AS f, l_extendedprice::FLOAT AS x FROM lineitem""")
def to_float(t):
    return t.lineitem.select(
        "l_orderkey", N.cast_to(F.col("l_partkey"), "bigint", "double").alias("d"),
        N.cast_to(F.col("l_partkey"), "bigint", "float").alias("f"),
        N.cast_to(F.col("l_extendedprice"), "double", "float").alias("x"))


@query("c3_to_decimal", """
SELECT o_orderkey, o_totalprice::VARCHAR::DECIMAL(38,4) AS d, o_orderkey::DECIMAL(38,4) AS k FROM orders""")
def to_decimal(t):
    return t.orders.select("o_orderkey", N.cast_to(F.col("o_totalprice"), "double", "decimal", 4).alias("d"),
                           N.cast_to(F.col("o_orderkey"), "bigint", "decimal", 4).alias("k"))


@query("c4_to_varint", """
SELECT o_orderkey, trunc(o_totalprice)::BIGINT::DECIMAL(38,0) AS d, trunc(-o_totalprice)::BIGINT::DECIMAL(38,0) AS n FROM orders""")
def to_varint(t):
    x = F.col("o_totalprice")
    return t.orders.select("o_orderkey", N.cast_to(x, "double", "varint").alias("d"),
                           N.cast_to(-x.cast("decimal(18,2)"), "decimal", "varint").alias("n"))


@query("c5_to_text", """
SELECT event_id, event_id::VARCHAR AS n, (event_id % 2 = 0)::VARCHAR AS b,
       strftime(ts, '%Y-%m-%d %H:%M:%S.%g') || 'Z' AS ts, (ts::DATE)::VARCHAR AS day FROM events""")
def to_text(t):
    e = t.events.withColumn("ts", F.col("ts").cast("timestamp"))
    return e.select(
        "event_id", N.cast_to(F.col("event_id"), "bigint", "text").alias("n"),
        N.cast_to(F.col("event_id") % 2 == 0, "boolean", "text").alias("b"),
        N.cast_to(F.col("ts"), "timestamp", "text").alias("ts"),
        N.cast_to(F.col("ts").cast("date"), "date", "ascii").alias("day"))


@query("c6_ascii_to_text", "SELECT p_partkey, p_name AS name FROM part")
def ascii_to_text(t):
    return t.part.select("p_partkey", N.cast_to(F.col("p_name"), "ascii", "text").alias("name"))


@query("c7_dates", """
SELECT event_id, ts::DATE AS uuid_day, date_trunc('millisecond', ts) AS uuid_ts, ts::DATE AS ts_day, (ts::DATE)::TIMESTAMP AS day_ts
FROM events""")
def dates(t):
    e = t.events.withColumn("ts", F.col("ts").cast("timestamp"))
    u = timeuuid.min_timeuuid(F.col("ts"))
    ntz = lambda c: c.cast("timestamp_ntz")
    return e.select(
        "event_id", N.cast_to(u, "timeuuid", "date").alias("uuid_day"),
        ntz(N.cast_to(u, "timeuuid", "timestamp")).alias("uuid_ts"),
        N.cast_to(F.col("ts"), "timestamp", "date").alias("ts_day"),
        ntz(N.cast_to(F.col("ts").cast("date"), "date", "timestamp")).alias("day_ts"))


@query("c8_counter_cast", f"""
SELECT user_id, {wrap_sql("count(*)", "tinyint")} AS tiny, count(*)::DOUBLE AS d, count(*)::VARCHAR AS txt FROM events GROUP BY user_id""")
def counter_cast(t):
    n = t.events.groupBy("user_id").agg(F.count(F.lit(1)).alias("c"))
    return n.select("user_id", N.cast_to(F.col("c"), "counter", "tinyint").alias("tiny"),
                    N.cast_to(F.col("c"), "counter", "double").alias("d"),
                    N.cast_to(F.col("c"), "counter", "text").alias("txt"))

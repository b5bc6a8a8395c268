"""Aggregation queries."""

from pyspark.sql import functions as F

from cellspark.functions import aggregates as A
from cellspark.operators import grouping, select
from cellspark.plans.registry import EVENTS, ORDERS, query
from cellspark.plans.select_queries import CUSTOMER_ORDERS, _orders, _statics
from cellspark.spec import TableSpec

_BITS = {"tinyint": 8, "smallint": 16, "int": 32, "bigint": 64}


def wrap_sql(value: str, kind: str) -> str:
    half, full = 1 << (_BITS[kind] - 1), 1 << _BITS[kind]
    return f"((((({value}) + {half}) % {full}::HUGEINT + {full}::HUGEINT) % {full}::HUGEINT) - {half})::{kind.upper()}"


@query("a1_count_rows", "SELECT count(*) AS n, count(1) AS n_const FROM lineitem")
def count_rows(t):
    return grouping.aggregate(t.lineitem, {"n": A.count_rows(), "n_const": A.count(F.lit(1))})


@query("a2_count_column", """
SELECT lang, count(quality) AS n, count(*) AS n_rows FROM documents LEFT JOIN labels USING (doc_id) GROUP BY lang""")
def count_column(t):
    rows = t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left")
    return rows.groupBy("lang").agg(A.count(F.col("quality")).alias("n"), A.count_rows().alias("n_rows"))


@query("a3_sum_wrap", f"""
SELECT l_suppkey, {wrap_sql("sum((l_linenumber * 18)::HUGEINT)", "tinyint")} AS s_tiny,
  {wrap_sql("sum((l_linenumber * 4000)::HUGEINT)", "smallint")} AS s_small,
  {wrap_sql("sum((l_linenumber * 300000000)::HUGEINT)", "int")} AS s_int,
  {wrap_sql("sum(l_linenumber::HUGEINT * 1000000000000000000)", "bigint")} AS s_big
FROM lineitem GROUP BY l_suppkey""")
def sum_wrap(t):
    n = F.col("l_linenumber")
    return t.lineitem.groupBy("l_suppkey").agg(
        A.sum_of((n * 18).cast("tinyint"), "tinyint").alias("s_tiny"),
        A.sum_of((n * 4000).cast("smallint"), "smallint").alias("s_small"),
        A.sum_of(n * 300000000, "int").alias("s_int"),
        A.sum_of(n.cast("bigint") * 10**18, "bigint").alias("s_big"))


@query("a4_sum_decimal", """
SELECT o_orderpriority, sum(o_totalprice::DECIMAL(18,2))::DECIMAL(38,2) AS total, sum(o_orderkey::DECIMAL(28,0))::DECIMAL(38,0) AS keys
FROM orders GROUP BY o_orderpriority""")
def sum_decimal(t):
    price = F.col("o_totalprice").cast("decimal(18,2)")
    return t.orders.groupBy("o_orderpriority").agg(
        A.sum_of(price, "decimal", 2).alias("total"), A.sum_of(F.col("o_orderkey"), "varint").alias("keys"))


@query("a5_sum_float", """
SELECT l_returnflag, sum(l_quantity) AS q, sum(l_quantity)::FLOAT AS q_float FROM lineitem GROUP BY l_returnflag""")
def sum_float(t):
    q = F.col("l_quantity")
    return t.lineitem.groupBy("l_returnflag").agg(
        A.sum_of(q, "double").alias("q"), A.sum_of(q.cast("float"), "float").alias("q_float"))


@query("a6_avg_integer", """
SELECT l_suppkey, (sum(l_linenumber) // count(*))::INTEGER AS a_int,
       (sum(l_linenumber::HUGEINT * 1000000000000000000) // count(*))::BIGINT AS a_big,
       (-(sum(l_linenumber) // count(*)))::INTEGER AS a_neg
FROM lineitem GROUP BY l_suppkey""")
def avg_integer(t):
    n = F.col("l_linenumber")
    return t.lineitem.groupBy("l_suppkey").agg(
        A.avg_of(n, "int").alias("a_int"), A.avg_of(n.cast("bigint") * 10**18, "bigint").alias("a_big"),
        A.avg_of(-n, "int").alias("a_neg"))


@query("a7_avg_decimal", """
WITH s AS (SELECT o_orderpriority, sum((o_totalprice::DECIMAL(18,2) * 100)::HUGEINT) AS c, count(*) AS n,
                  sum(o_orderkey::HUGEINT) AS k FROM orders GROUP BY o_orderpriority),
q AS (SELECT *, c // n AS q, c % n AS r FROM s)
SELECT o_orderpriority, ((CASE WHEN 2 * r > n OR (2 * r = n AND q % 2 = 1) THEN q + 1 ELSE q END)::DECIMAL(38,0)::DECIMAL(30,2) / 100)::DECIMAL(38,2) AS mean,
       (k // n)::DECIMAL(38,0) AS mean_key FROM q""")
def avg_decimal(t):
    price = F.col("o_totalprice").cast("decimal(18,2)")
    return t.orders.groupBy("o_orderpriority").agg(
        A.avg_of(price, "decimal", 2).alias("mean"), A.avg_of(F.col("o_orderkey"), "varint").alias("mean_key"))


@query("a8_avg_float", "SELECT l_returnflag, avg(l_quantity) AS mean FROM lineitem GROUP BY l_returnflag")
def avg_float(t):
    return t.lineitem.groupBy("l_returnflag").agg(A.avg_of(F.col("l_quantity"), "double").alias("mean"))


@query("a9_min_max", """
SELECT user_id, min(ts) AS first_ts, max(ts) AS last_ts, min(value) AS low, max(value) AS high,
       min(event_type) AS first_type, max(props) AS last_props FROM events GROUP BY user_id""")
def min_max(t):
    return t.events.groupBy("user_id").agg(
        A.min_of(F.col("ts")).alias("first_ts"), A.max_of(F.col("ts")).alias("last_ts"),
        A.min_of(F.col("value")).alias("low"), A.max_of(F.col("value")).alias("high"),
        A.min_of(F.col("event_type")).alias("first_type"), A.max_of(F.col("props")).alias("last_props"))


@query("a10_empty_input", """
SELECT count(*) AS n, coalesce(sum(l_linenumber), 0)::INTEGER AS s, coalesce(avg(l_quantity), 0.0) AS a, min(l_shipdate) AS m
FROM lineitem WHERE l_quantity < 0""")
def empty_input(t):
    return grouping.aggregate(t.lineitem.filter("l_quantity < 0"), {
        "n": A.count_rows(), "s": A.sum_of(F.col("l_linenumber"), "int"),
        "a": A.avg_of(F.col("l_quantity"), "double"), "m": A.min_of(F.col("l_shipdate"))})


@query("a11_group_prefix", """
SELECT o_custkey, o_orderdate, count(*) AS n, max(o_totalprice) AS top FROM orders GROUP BY o_custkey, o_orderdate""")
def group_prefix(t):
    return grouping.group_by(t.orders, ORDERS, ["o_custkey", "o_orderdate"],
                             {"n": A.count_rows(), "top": A.max_of(F.col("o_totalprice"))})


@query("a11_group_skipped_column", """
SELECT o_custkey, o_orderkey, count(*) AS n FROM orders WHERE o_orderdate = TIMESTAMP '1996-01-02' GROUP BY o_custkey, o_orderkey""")
def group_skipped(t):
    rows = t.orders.filter(F.col("o_orderdate") == F.lit("1996-01-02").cast("timestamp_ntz"))
    return grouping.group_by(rows, ORDERS, ["o_custkey", "o_orderkey"], {"n": A.count_rows()}, fixed=("o_orderdate",))


@query("a12_group_star", """
SELECT user_id, arg_min(ts, (ts, event_id)) AS ts, arg_min(event_id, (ts, event_id)) AS event_id,
       arg_min(event_type, (ts, event_id)) AS event_type, arg_min(value, (ts, event_id)) AS value,
       arg_min(props, (ts, event_id)) AS props, count(*) AS n, max(event_id) AS last_id
FROM events GROUP BY user_id""")
def group_star(t):
    return grouping.group_star(t.events, EVENTS, ["user_id"],
                               {"n": A.count_rows(), "last_id": A.max_of(F.col("event_id"))})


@query("a13_static_group", """
SELECT coalesce(o_custkey, c_custkey) AS o_custkey, min(c_mktsegment) AS segment, count(*) AS n, count(o_orderkey) AS n_orders
FROM orders FULL JOIN customer ON o_custkey = c_custkey GROUP BY coalesce(o_custkey, c_custkey)""")
def static_group(t):
    rows = select.with_statics(_orders(t), _statics(t), CUSTOMER_ORDERS)
    return grouping.group_by(rows, CUSTOMER_ORDERS, ["o_custkey"], {
        "segment": A.min_of(F.col("c_mktsegment")), "n": A.count_rows(), "n_orders": A.count(F.col("o_orderkey"))})


@query("a14_group_order", "SELECT conv_id, count(*) AS n, max(turn) AS last_turn FROM conversations GROUP BY conv_id")
def group_order(t):
    spec = TableSpec(["conv_id"], ["turn"], (), ["role", "text"])
    groups = grouping.group_by(t.conversations, spec, ["conv_id"],
                               {"n": A.count_rows(), "last_turn": A.max_of(F.col("turn"))})
    return grouping.order_groups(groups, spec, ["conv_id"])

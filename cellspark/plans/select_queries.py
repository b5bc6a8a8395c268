"""Projection, ordering and limit queries."""

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from cellspark.functions.token import token
from cellspark.operators import grouping, select
from cellspark.plans import hash_sql
from cellspark.plans.registry import EVENTS, ORDERS, TURNS, query
from cellspark.spec import TableSpec

# customers with orders: customer columns are the statics of an order partition
CUSTOMER_ORDERS = TableSpec(["o_custkey"], ["o_orderkey"], ["c_name", "c_mktsegment"],
                            ["o_orderstatus", "o_totalprice"])


def _orders(t):
    return t.orders.select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice")


def _statics(t):
    return t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")


@query("p1_star", "SELECT o_custkey, o_orderdate, o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders")
def star(t):
    return select.star(t.orders, ORDERS)


@query("p2_alias", "SELECT o_orderkey AS id, o_orderstatus AS status FROM orders")
def alias(t):
    return t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"))


@query("p3_constant", "SELECT o_orderkey, CAST(7 AS BIGINT) AS seven, 'x' AS tag FROM orders")
def constant(t):
    return t.orders.select("o_orderkey", select.constant(7, "bigint").alias("seven"),
                           select.constant("x", "string").alias("tag"))


@query("p4_field", "SELECT o_orderkey, o_orderstatus AS status, o_orderpriority AS level FROM orders")
def field(t):
    nested = t.orders.select("o_orderkey", F.struct(
        F.col("o_orderstatus").alias("status"),
        F.struct(F.col("o_orderpriority").alias("level")).alias("p")).alias("u"))
    return nested.select("o_orderkey", F.col("u.status"), F.col("u.p.level"))


@query("p7_select_json", """
SELECT to_json({'o_orderkey': o_orderkey, 'o_orderstatus': o_orderstatus,
                '"Level"': o_orderpriority})::VARCHAR AS json FROM orders""")
def select_json(t):
    renamed = t.orders.withColumnRenamed("o_orderpriority", "Level")
    return select.select_json(renamed, ["o_orderkey", "o_orderstatus", "Level"])


@query("p8_distinct", """
SELECT DISTINCT coalesce(o_custkey, c_custkey) AS o_custkey, c_mktsegment
FROM orders FULL JOIN customer ON o_custkey = c_custkey""")
def distinct(t):
    rows = select.with_statics(_orders(t), _statics(t), CUSTOMER_ORDERS)
    return select.distinct_partitions(rows, CUSTOMER_ORDERS, ["c_mktsegment"])


@query("p9_static_rows", """
SELECT coalesce(o_custkey, c_custkey) AS o_custkey, o_orderkey, c_name, c_mktsegment, o_orderstatus, o_totalprice
FROM orders FULL JOIN customer ON o_custkey = c_custkey""")
def static_rows(t):
    return select.with_statics(_orders(t), _statics(t), CUSTOMER_ORDERS)


@query("p9_static_restricted", """
SELECT o_custkey, o_orderkey, c_name, c_mktsegment, o_orderstatus, o_totalprice
FROM orders LEFT JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'F'""")
def static_restricted(t):
    rows = _orders(t).filter("o_orderstatus = 'F'")
    return select.with_statics(rows, _statics(t), CUSTOMER_ORDERS, static_only=False)


@query("q17_static_filter", """
SELECT coalesce(o_custkey, c_custkey) AS o_custkey, o_orderkey, c_name, c_mktsegment, o_orderstatus, o_totalprice
FROM orders FULL JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment = 'BUILDING'""")
def static_filter(t):
    return select.with_statics(_orders(t), _statics(t), CUSTOMER_ORDERS).filter("c_mktsegment = 'BUILDING'")


@query("p10_first_row", """
SELECT o_custkey, arg_min(o_orderstatus, (o_orderdate, o_orderkey)) AS o_orderstatus,
       arg_min(o_totalprice, (o_orderdate, o_orderkey)) AS o_totalprice, count(*) AS n
FROM orders GROUP BY o_custkey""")
def first_row(t):
    first = select.first_row(ORDERS, ["o_orderstatus", "o_totalprice"])
    return t.orders.groupBy("o_custkey").agg(*first.values(), F.count(F.lit(1)).alias("n"))


@query("l1_limit", """
SELECT o_custkey, o_orderdate, o_orderkey FROM orders
ORDER BY o_custkey, o_orderdate, o_orderkey LIMIT 100""")
def limit(t):
    rows = t.orders.select("o_custkey", "o_orderdate", "o_orderkey")
    return select.limit_rows(rows, 100, ["o_custkey", "o_orderdate", "o_orderkey"])


@query("l2_per_partition_limit", """
SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) <= 3""")
def per_partition_limit(t):
    rows = t.orders.select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")
    return select.per_partition_limit(rows, ORDERS, 3)


@query("l3_per_partition_groups", """
WITH g AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY user_id, event_type)
SELECT * FROM g QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_type) <= 2""")
def per_partition_groups(t):
    groups = t.events.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    return select.per_partition_limit(groups, EVENTS, 2, order=[F.col("event_type")])


@query("l4_order_reversed", """
SELECT conv_id, turn, role, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS place FROM conversations""")
def order_reversed(t):
    place = F.row_number().over(Window.partitionBy(*TURNS.pk).orderBy(*TURNS.clustering_order(reverse=True)))
    rows = t.conversations.select("conv_id", "turn", "role", place.cast("bigint").alias("place"))
    return select.order_rows(rows, TURNS, reverse=True, by_partition=True)


@query("l4_order_within_partitions", "SELECT conv_id, turn, role FROM conversations")
def order_within(t):
    return select.cluster_locally(t.conversations.select("conv_id", "turn", "role"), TURNS, reverse=True)


@query("l5_order_over_partitions", """
SELECT o_custkey, o_orderdate, o_orderkey FROM orders WHERE o_custkey IN (1, 2, 3, 5, 8, 13, 21)
ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 25""")
def order_over(t):
    rows = t.orders.filter(F.col("o_custkey").isin(1, 2, 3, 5, 8, 13, 21))
    return select.order_rows(rows.select("o_custkey", "o_orderdate", "o_orderkey"), ORDERS, reverse=True).limit(25)


@query("l6_latest", """
SELECT user_id, ts, event_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def latest(t):
    return select.latest_per_partition(t.events, EVENTS, ["ts", "event_id", "event_type", "value"])


@query("l7_page", """
SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice FROM orders
WHERE (o_custkey, o_orderdate, o_orderkey) > (100, TIMESTAMP '1996-01-01', 0)
ORDER BY o_custkey, o_orderdate, o_orderkey LIMIT 500""")
def page(t):
    # pages in key order: the token of this table is its partition key
    rows = t.orders.select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")
    after = select.after_key(ORDERS.key, (100, F.lit("1996-01-01").cast("timestamp_ntz"), 0), ORDERS)
    return rows.filter(after).orderBy(*ORDERS.key).limit(500)


@query("l7_page_by_token", f"""
WITH {hash_sql.xxhash64("SELECT o_custkey, o_orderdate, o_orderkey FROM orders", "o_custkey")},
first_two AS (SELECT * FROM tokens QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) <= 2)
SELECT token AS _token, o_custkey, o_orderdate, o_orderkey FROM first_two
WHERE (token, o_custkey, o_orderdate, o_orderkey) > (0, 0, TIMESTAMP '1990-01-01', 0) ORDER BY token, o_custkey, o_orderdate, o_orderkey LIMIT 500""")
def page_by_token(t):
    rows = t.orders.select("o_custkey", "o_orderdate", "o_orderkey")
    return select.page(rows, ORDERS, 500, (0, 0, F.lit("1990-01-01").cast("timestamp_ntz"), 0), per_partition=2)


@query("l7_group_pages", """
SELECT o_custkey, o_orderdate, count(*) AS n, sum(o_totalprice::DECIMAL(18, 2))::DECIMAL(28, 2) AS total, min(o_orderkey) AS first_key
FROM orders GROUP BY o_custkey, o_orderdate""")
def group_pages(t):
    # seven pages cut the rows anywhere; put together they are the whole grouping
    rows = t.orders.select(*ORDERS.key, F.col("o_totalprice").cast("decimal(18,2)").alias("price"))
    size = rows.count() // 7 + 1
    partial = {"n": (F.count(F.lit(1)), F.sum), "total": (F.sum("price"), F.sum), "first_key": (F.min("o_orderkey"), F.min)}
    pages, state = [], grouping.GroupState()
    while state is not None:
        page, state = grouping.page_groups(rows, ORDERS, ["o_custkey", "o_orderdate"], partial, size, state)
        pages.append(page)
    return reduce(lambda a, b: a.unionByName(b), pages).withColumn("total", F.col("total").cast("decimal(28,2)"))


@query("l8_top_partitions", """
SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey ORDER BY n DESC, o_custkey LIMIT 20""")
def top_partitions(t):
    return select.top_partitions(t.orders, ORDERS, 20)


@query("l8_top_partitions_sketch")
def top_sketch(t):
    return select.top_partitions_sketch(t.events, "user_id", 10)


@query("f20_token_xxhash64", f"""
WITH {hash_sql.xxhash64("SELECT o_orderkey, o_custkey FROM orders", "o_custkey")} SELECT o_orderkey, o_custkey, token FROM tokens""")
def token_default(t):
    return t.orders.select("o_orderkey", "o_custkey", token(["o_custkey"]).alias("token"))


@query("f20_token_murmur3", f"""
WITH {hash_sql.murmur3("SELECT l_orderkey, l_linenumber, l_partkey - 1000 AS id FROM lineitem", "id")} SELECT l_orderkey, l_linenumber, id, token FROM tokens""")
def token_murmur3(t):
    k = F.col("l_partkey") - 1000
    return t.lineitem.select("l_orderkey", "l_linenumber", k.alias("id"), token([k], ["bigint"], "murmur3").alias("token"))


@query("f20_token_murmur3_composite")
def token_murmur3_composite(t):
    return t.orders.select("o_orderkey", token(["o_custkey", "o_orderstatus"], ["bigint", "text"], "murmur3").alias("token"))

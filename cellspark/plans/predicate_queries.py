"""Filter queries."""

from pyspark.sql import functions as F

from cellspark.functions.token import md5_token
from cellspark.operators import predicates as P
from cellspark.plans.registry import query

_USERS_SQL = """
WITH u AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY user_id, event_type),
c AS (SELECT user_id, list_sort(list(event_type)) AS kinds, map_from_entries(list((event_type, n) ORDER BY event_type)) AS counts
      FROM u GROUP BY user_id)
"""


def users(t):
    """Per user: the set of event types and a map of event type to count."""
    n = t.events.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    return n.groupBy("user_id").agg(
        F.array_sort(F.collect_set("event_type")).alias("kinds"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("event_type", "n")))).alias("counts"))


@query("q1_compare", """
SELECT o_orderkey, o_totalprice FROM orders
WHERE o_totalprice >= 100000 AND o_totalprice < 250000.5 AND o_orderstatus = 'F' AND o_custkey > 10 AND o_custkey <= 900""")
def compare(t):
    where = P.all_of(P.compare("o_totalprice", ">=", 100000.0), P.compare("o_totalprice", "<", 250000.5),
                     P.compare("o_orderstatus", "=", "F"), P.compare("o_custkey", ">", 10),
                     P.compare("o_custkey", "<=", 900))
    return t.orders.filter(where).select("o_orderkey", "o_totalprice")


@query("q2_not_equal", "SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'O'")
def not_equal(t):
    return t.orders.filter(P.compare("o_orderstatus", "!=", "O")).select("o_orderkey")


@query("q3_in", "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (3, 14, 15, 92, 65, 35)")
def in_list(t):
    return t.orders.filter(P.is_in("o_custkey", [3, 14, 15, 92, 65, 35, 3])).select("o_orderkey", "o_custkey")


@query("q3_in_table", """
SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""")
def in_table(t):
    keys = t.customer.filter("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    return P.semi_in(t.orders.select("o_orderkey", "o_custkey"), ["o_custkey"], keys)


@query("q4_tuple_equal", "SELECT o_orderkey FROM orders WHERE (o_orderstatus, o_orderpriority) = ('F', '1-URGENT')")
def tuple_equal(t):
    return t.orders.filter(P.tuple_eq(["o_orderstatus", "o_orderpriority"], ("F", "1-URGENT"))).select("o_orderkey")


@query("q5_tuple_in", """
SELECT o_orderkey FROM orders WHERE (o_orderstatus = 'F' AND o_orderpriority = '1-URGENT')
   OR (o_orderstatus = 'O' AND o_orderpriority = '5-LOW')""")
def tuple_in(t):
    rows = [("F", "1-URGENT"), ("O", "5-LOW"), ("F", "1-URGENT")]
    return t.orders.filter(P.tuple_in(["o_orderstatus", "o_orderpriority"], rows)).select("o_orderkey")


@query("q6_tuple_slice", """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
WHERE (l_orderkey, l_linenumber, l_partkey) > (5000, 3, 100) AND (l_orderkey, l_linenumber) <= (9000, 2)""")
def tuple_slice(t):
    where = P.all_of(P.tuple_slice(["l_orderkey", "l_linenumber", "l_partkey"], ">", (5000, 3, 100)),
                     P.tuple_slice(["l_orderkey", "l_linenumber"], "<=", (9000, 2)))
    return t.lineitem.filter(where).select("l_orderkey", "l_linenumber", "l_partkey")


@query("q7_clustering_slice", """
SELECT conv_id, turn, role FROM conversations WHERE conv_id = 7 AND turn >= 1 AND turn < 6""")
def clustering_slice(t):
    where = P.clustering_slice({"conv_id": 7}, "turn", 1, 6, upper_inclusive=False)
    return t.conversations.filter(where).select("conv_id", "turn", "role")


@query("q7_clustering_range", """
SELECT o_custkey, o_orderdate, o_orderkey FROM orders
WHERE o_orderdate >= TIMESTAMP '1996-03-01' AND o_orderdate < TIMESTAMP '1996-06-01'""")
def clustering_range(t):
    day = lambda d: F.lit(d).cast("timestamp_ntz")
    where = P.clustering_slice({}, "o_orderdate", day("1996-03-01"), day("1996-06-01"), upper_inclusive=False)
    return t.orders.filter(where).select("o_custkey", "o_orderdate", "o_orderkey")


@query("q8_token_range", """
SELECT o_custkey, o_orderkey FROM orders
WHERE CASE WHEN substr(md5(o_custkey::VARCHAR), 1, 1) >= '8' THEN false
      ELSE md5(o_custkey::VARCHAR) > '20' AND md5(o_custkey::VARCHAR) <= '60' END""")
def token_range(t):
    # the MD5 token of the key's text; tokens with the sign bit set lie elsewhere
    text = F.encode(F.col("o_custkey").cast("string"), "UTF-8")
    token = md5_token(text)
    positive = F.substring(F.md5(text), 1, 1) < "8"
    return t.orders.filter(positive & (token > "20") & (token <= "60")).select("o_custkey", "o_orderkey")


@query("q8_token_range_halves", "SELECT o_custkey, o_orderkey FROM orders")
def token_range_halves(t):
    rows = t.orders.select("o_custkey", "o_orderkey")
    lower = rows.filter(P.token_range(["o_custkey"], None, 0))
    upper = rows.filter(P.token_range(["o_custkey"], 0, None))
    return lower.unionByName(upper)


@query("q9_contains", _USERS_SQL + """
SELECT user_id FROM c WHERE list_contains(kinds, 'error') AND list_contains(map_values(counts), 20)""")
def contains(t):
    where = P.contains("kinds", "error") & P.contains("counts", 20, is_map=True)
    return users(t).filter(where).select("user_id")


@query("q10_contains_key", _USERS_SQL + "SELECT user_id FROM c WHERE list_contains(map_keys(counts), 'signup')")
def contains_key(t):
    return users(t).filter(P.contains_key("counts", "signup")).select("user_id")


@query("q11_entry", """
SELECT user_id FROM events WHERE event_type = 'click' GROUP BY user_id HAVING count(*) = 21""")
def entry(t):
    return users(t).filter(P.entry_equals("counts", "click", 21)).select("user_id")


@query("q12_like", """
SELECT p_partkey, p_name FROM part
WHERE starts_with(p_name, 'blue') OR ends_with(p_name, 'ring') OR contains(p_name, 'dget')""")
def like(t):
    where = P.like("p_name", "blue%") | P.like("p_name", "%ring") | P.like("p_name", "%dget%")
    return t.part.filter(where).select("p_partkey", "p_name")


@query("q13_like_plain", """
SELECT p_partkey, p_name = 'red widget' AS by_index, contains(p_name, 'red') AS by_filter FROM part""")
def like_plain(t):
    return t.part.select("p_partkey", P.like("p_name", "red widget").alias("by_index"),
                         P.like("p_name", "red", mode="row_filter").alias("by_filter"))


@query("q14_not_null", """
SELECT d.doc_id, l.quality FROM documents d LEFT JOIN labels l USING (doc_id) WHERE l.quality IS NOT NULL""")
def not_null(t):
    rows = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    return rows.filter(P.not_null("quality")).select("doc_id", "quality")


@query("q15_expression", "SELECT p_partkey FROM part WHERE p_size > 25 AND p_type = 'ECONOMY'")
def expression(t):
    known = P.Expressions()
    known.register("big", lambda text: (F.col("p_size") > 25) & (F.col("p_type") == text))
    return t.part.filter(known.expr("big", "ECONOMY")).select("p_partkey")


@query("q16_whole_value", _USERS_SQL + """
SELECT user_id FROM c WHERE kinds = ['click', 'error', 'purchase', 'signup', 'view']""")
def whole_value(t):
    wanted = F.array(*[F.lit(x) for x in ("view", "click", "error", "signup", "purchase")])
    return users(t).filter(P.whole_equals("kinds", wanted, "set")).select("user_id")

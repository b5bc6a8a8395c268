"""Queries over two copies of the orders table that have drifted apart."""

from pyspark.sql import functions as F

from cellspark.operators import digest_tree, mutate, replica
from cellspark.operators import reconcile as rec
from cellspark.plans.mutation_queries import NOW, ORDER, T0, base_orders
from cellspark.plans.registry import query
from cellspark.session import tasks_for


def copies(t):
    """Copy ``b`` lacks every 97th order and holds an older status of every 89th.

    Both are dealt alike by key, to tasks that follow the rows, so they meet without another shuffle.
    """
    base = base_orders(t)
    tasks = tasks_for(t.spark, base.count())
    a = mutate.insert(base, ORDER, T0)
    here = base.filter("o_orderkey % 97 <> 0")
    old = here.filter("o_orderkey % 89 = 0")
    b = mutate.log_of(
        mutate.insert(here.filter("o_orderkey % 89 <> 0"), ORDER, T0),
        mutate.insert(old.withColumn("_set", F.array(F.lit("price"))), ORDER, T0),
        mutate.update(old.select(*ORDER.key, F.lit("Q").alias("status")), ORDER, T0 - 100))
    return {name: rec.reconcile(rec.by_key(log, ORDER, tasks), ORDER, NOW) for name, log in (("a", a), ("b", b))}


@query("d1_diff", """
SELECT o_custkey, o_orderkey, 'b' AS source, o_orderkey % 97 = 0 AS missing,
  CASE WHEN o_orderkey % 97 = 0 THEN '_live,status,price' ELSE 'status' END AS stale, o_orderstatus AS status
FROM orders WHERE o_orderkey % 97 = 0 OR o_orderkey % 89 = 0""")
def diff(t):
    return replica.diff(copies(t), ORDER).select(
        *ORDER.key, "source", "missing", F.array_join("stale", ",").alias("stale"), F.col("status.v").alias("status"))


def _plain(t):
    rows = t.orders.select("o_custkey", "o_orderkey", "o_orderstatus")
    other = rows.filter("o_orderkey % 97 <> 0").withColumn(
        "o_orderstatus", F.when(F.col("o_orderkey") % 89 == 0, "Q").otherwise(F.col("o_orderstatus")))
    return rows, other


_HASH = "('0x' || substr(md5(o_custkey || '|' || o_orderkey || '|' || o_orderstatus), 1, 15))::BIGINT"
_LEAF = "('0x' || substr(md5(o_custkey::VARCHAR), 1, 15))::BIGINT >> {shift}"
_B_ROWS = "(SELECT o_custkey, o_orderkey, CASE WHEN o_orderkey % 89 = 0 THEN 'Q' ELSE o_orderstatus END AS o_orderstatus FROM orders WHERE o_orderkey % 97 <> 0)"


@query("d2_digest", f"""
SELECT {_LEAF.format(shift=52)} AS leaf, bit_xor({_HASH}) AS digest, count(*) AS n_rows, sum(strlen(o_orderstatus) + 16)::BIGINT AS n_bytes
FROM orders GROUP BY 1""")
def digest(t):
    rows, _ = _plain(t)
    return replica.digest(rows, ORDER, 8, "md5", F.octet_length("o_orderstatus") + 16)


@query("d2_digest_levels", f"""
WITH l AS (SELECT {_LEAF.format(shift=54)} AS leaf, bit_xor({_HASH}) AS d, count(*) AS n FROM orders GROUP BY 1)
SELECT level, leaf >> (6 - level) AS node, bit_xor(d) AS digest, sum(n)::BIGINT AS n_rows
FROM l, (SELECT unnest(range(0, 7)) AS level) GROUP BY 1, 2""")
def digest_levels(t):
    rows, _ = _plain(t)
    tree = replica.levels(replica.digest(rows, ORDER, 6, "md5"), 6)
    return tree.select(F.col("level").cast("bigint"), "node", "digest", "n_rows")


@query("d3_differing_ranges", f"""
WITH a AS (SELECT {_LEAF.format(shift=48)} AS leaf, bit_xor({_HASH}) AS d, count(*) AS n FROM orders GROUP BY 1),
b AS (SELECT {_LEAF.format(shift=48)} AS leaf, bit_xor({_HASH}) AS d, count(*) AS n FROM {_B_ROWS} GROUP BY 1),
x AS (SELECT coalesce(a.leaf, b.leaf) AS leaf FROM a FULL JOIN b ON a.leaf = b.leaf WHERE (a.d, a.n) IS DISTINCT FROM (b.d, b.n)),
r AS (SELECT leaf, leaf >> 8 AS top, leaf - row_number() OVER (PARTITION BY leaf >> 8 ORDER BY leaf) AS run FROM x)
SELECT min(leaf) AS first_leaf, max(leaf) AS last_leaf FROM r GROUP BY top, run""")
def differing_ranges(t):
    a, b = [replica.digest(x, ORDER, 12, "md5") for x in _plain(t)]
    return replica.differing_ranges(replica.differing_leaves(a, b), 12, split=4)


@query("d4_repair", """
SELECT 'b' AS target, o_custkey, o_orderkey, o_orderstatus AS status, o_totalprice AS price FROM orders
WHERE o_orderkey % 97 = 0 OR o_orderkey % 89 = 0""")
def repair(t):
    c = copies(t)
    return replica.repair(c["a"], c["b"], ORDER, depth=10).select(
        "target", *ORDER.key, F.col("status.v").alias("status"), F.col("price.v").alias("price"))


@query("d4_repaired_copy", "SELECT o_custkey, o_orderkey, o_orderstatus AS status, o_totalprice AS price FROM orders")
def repaired_copy(t):
    c = copies(t)
    fixes = replica.repair(c["a"], c["b"], ORDER, depth=10).filter("target = 'b'").drop("target")
    return rec.live_rows(rec.merge_copies([c["b"], fixes], ORDER), ORDER)


_TREE_LEAF = "('0x' || substr(md5(o_custkey::VARCHAR), 1, 15))::BIGINT >> (60 - depth)"


@query("d3_tree_descent", f"""
WITH d AS (SELECT least(24, ceil(ceil(log2(greatest(count(*) / 64.0, 1))) / 4) * 4)::BIGINT AS depth FROM orders),
a AS (SELECT {_TREE_LEAF} AS leaf, bit_xor({_HASH}) AS d, count(*) AS n FROM orders, d GROUP BY 1),
b AS (SELECT {_TREE_LEAF} AS leaf, bit_xor({_HASH}) AS d, count(*) AS n FROM {_B_ROWS}, d GROUP BY 1)
SELECT coalesce(a.leaf, b.leaf) AS leaf FROM a FULL JOIN b ON a.leaf = b.leaf WHERE (a.d, a.n) IS DISTINCT FROM (b.d, b.n)""")
def tree_descent(t):
    # the depth follows the rows; only children of nodes that differ are looked at
    rows = _plain(t)
    depth = digest_tree.depth_for(rows[0].count())
    a, b = [digest_tree.store(x, ORDER, depth, "md5") for x in rows]
    return digest_tree.descend(a.tree, b.tree, depth)


@query("d4_tree_repair", """
SELECT 'b' AS target, o_custkey, o_orderkey, o_orderstatus AS status, o_totalprice AS price FROM orders
WHERE o_orderkey % 97 = 0 OR o_orderkey % 89 = 0""")
def tree_repair(t):
    # each copy is merged once, when it is written by leaf
    depth = digest_tree.depth_for(t.orders.count())
    stored = {name: digest_tree.store(state, ORDER, depth) for name, state in copies(t).items()}
    return digest_tree.repair(stored["a"], stored["b"], ORDER).select(
        "target", *ORDER.key, F.col("status.v").alias("status"), F.col("price.v").alias("price"))


@query("d5_resolve", "SELECT o_custkey, o_orderkey, o_orderstatus AS status, o_totalprice AS price FROM orders WHERE o_orderstatus = 'F'")
def resolve(t):
    return replica.resolve(list(copies(t).values()), ORDER, F.col("status") == "F")


@query("d5_resolve_stale_value", "SELECT o_custkey, o_orderkey FROM orders WHERE o_orderstatus = 'Q'"
       " UNION ALL SELECT -1, count(*) FROM orders WHERE o_orderkey % 89 = 0 AND o_orderkey % 97 <> 0")
def resolve_stale_value(t):
    # the outdated status must not match, though copy b alone would answer with it
    c = copies(t)
    merged = replica.resolve(list(c.values()), ORDER, F.col("status") == "Q").select(*ORDER.key)
    alone = replica.resolve([c["b"]], ORDER, F.col("status") == "Q").agg(F.count(F.lit(1)).alias("o_orderkey"))
    return merged.unionByName(alone.select(F.lit(-1).cast("bigint").alias("o_custkey"), "o_orderkey"))


@query("d6_digest_match", """
SELECT 'a' AS source, count(*) AS n_rows, false AS same FROM orders
UNION ALL SELECT 'b', count(*), false FROM orders WHERE o_orderkey % 97 <> 0""")
def digest_match(t):
    return replica.same_digest(copies(t), ORDER).select("source", "n_rows", "same")

"""Stored digest trees: descent, update, and how little is read."""

from pyspark.sql import functions as F

from cellspark import TableSpec
from cellspark.operators import digest_tree, maintenance, replica
from cellspark.operators import reconcile as rec

SPEC = TableSpec(["k"], ["c"], (), ["v"])


def states(spark, n=6000):
    log = spark.range(n).select((F.col("id") % 700).alias("k"), F.col("id").alias("c"), F.col("id").alias("v"), F.lit(5).cast("bigint").alias("_ts"))
    a = rec.reconcile(log, SPEC, 10)
    # one percent of the partitions hold an older or no value
    b = rec.reconcile(log.filter("not (k = 3 and c > 3000)").withColumn("v", F.when(F.col("k").isin(11, 12, 13, 14, 15), -1).otherwise(F.col("v")))
                      .withColumn("_ts", F.when(F.col("k").isin(11, 12, 13, 14, 15), 4).otherwise(5).cast("bigint")), SPEC, 10)
    return a, b


def test_descent_update_and_repair(spark, rows):
    a, b = states(spark)
    depth = digest_tree.depth_for(6000, per_leaf=4)
    assert depth == 12
    x, y = digest_tree.store(a, SPEC, depth), digest_tree.store(b, SPEC, depth)
    flat = replica.differing_leaves(replica.digest(a, SPEC, depth), replica.digest(b, SPEC, depth))
    leaves = digest_tree.descend(x.tree, y.tree, depth)
    assert rows(leaves) == rows(flat) and 1 <= leaves.count() <= 6
    # what is compared row by row is what lies in these leaves
    left, right = digest_tree.differing_rows(x, y)
    assert left.count() + right.count() < 400
    assert {r.k for r in left.collect()} >= {3, 11, 12, 13, 14, 15}
    fixes = digest_tree.repair(x, y, SPEC)
    assert rows(fixes) == rows(replica.repair(a, b, SPEC, depth))
    # the tree of the repaired copy follows from the changed rows alone
    new = fixes.filter("target = 'b'").drop("target")
    merged = rec.merge_copies([b.join(new.select("k", "c"), ["k", "c"], "left_semi"), new], SPEC)
    old = b.join(new.select("k", "c"), ["k", "c"], "left_semi")
    after = digest_tree.update(y, old, merged, SPEC)
    assert digest_tree.descend(x.tree, after, depth).isEmpty()
    assert rows(after.select("level", "node", "digest", "n_rows")) == rows(x.tree.select("level", "node", "digest", "n_rows"))


def test_equal_and_empty_copies(spark):
    a, _ = states(spark, 50)
    x = digest_tree.store(a, SPEC, 4)
    assert digest_tree.repair(x, digest_tree.store(a, SPEC, 4), SPEC).isEmpty()
    none = digest_tree.store(a.limit(0), SPEC, 4)
    assert digest_tree.repair(x, none, SPEC).filter("target = 'b'").count() == 50
    assert digest_tree.depth_for(0) == 0 and digest_tree.depth_for(10**9) == 24


def test_checksum_tells_places_of_nulls_apart(spark):
    spec = TableSpec(["k"], (), (), ["v", "w"])
    one = lambda row: maintenance.verify(spark.createDataFrame([row], "k int, v string, w string"), spec).first().checksum
    assert one((1, "v", None)) != one((1, None, "v"))

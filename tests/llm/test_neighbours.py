import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellspark.llm import neighbours
from cellspark.llm.common import table


def brute(rows, every=20, k=20):
    good = [(i, np.array(v, np.float32).astype(float)) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    ids, vectors = np.array([i for i, _ in good]), np.array([v for _, v in good])
    out = {}
    for i, q in good:
        if i % every == 0:
            s = (vectors * q).sum(axis=1)
            other = np.flatnonzero(ids != i)
            best = other[np.lexsort((ids[other], -s[other]))[:k]]
            out[i] = [(int(ids[b]), float(s[b])) for b in best]
    return out


def recall(rows, got, every=20):
    want = brute(rows, every)
    found = {}
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(found) == {q for q in want if want[q]}
    hits = total = 0
    exact = {(q, i): s for q, w in brute(rows, every, 10**9).items() for i, s in w}
    for q, own in found.items():
        assert len(own) == len(want[q])
        assert own == sorted(own, key=lambda x: (-x[1], x[0]))
        assert all(abs(s - exact[q, i]) < 1e-12 for i, s in own)
        hits += len({i for i, _ in own} & {i for i, _ in want[q]})
        total += len(own)
    return hits / total


def test_recall_on_table(spark):
    rows = [(r.vec_id, r.embedding) for r in table(spark, "/root/testdata/sf0.1", "embeddings").collect()]
    for block_rows in (4096, 200):
        got = neighbours.nearest(table(spark, "/root/testdata/sf0.1", "embeddings"), block_rows=block_rows).collect()
        assert recall(rows, got) >= 0.93


def test_clusters_copies_and_odd_rows(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(9, 12)) * 3
    rows = [(i, [float(x) for x in centres[i % 9] * (1 + i % 3) + rng.normal(size=12)]) for i in range(900)]
    rows += [(1000 + i, rows[7][1]) for i in range(300)]
    rows += [(2000, None), (2020, [0.0] * 12), (2040, [float("nan")] * 12), (2060, [None] + [1.0] * 11), (2080, [float("inf")] * 12), (None, [1.0] * 12)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("block", F.lit("clash")).repartition(3)
    got = neighbours.nearest(df, block_rows=150).collect()
    assert recall(rows, got) >= 0.93
    hot = [r.vec_id for r in sorted((r for r in got if r.query_id == 1000), key=lambda r: r.rank)]
    assert hot == [7, *range(1001, 1020)]


def test_few_and_none(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0, 0.0]), (20, [0.5, 0.5])], "vec_id long, embedding array<float>")
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in neighbours.nearest(df).collect())
    assert got == [(0, 1, 20, 1.5), (0, 2, 1, 1.0), (20, 1, 0, 1.5), (20, 2, 1, 0.5)]
    assert neighbours.nearest(df.limit(0)).count() == 0


def test_repeated_query_rows_each_get_all_neighbours(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(1, 60)]
    once = neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    got = neighbours.nearest(spark.createDataFrame(rows + [rows[19]] * 19, "vec_id long, embedding array<double>")).collect()
    want = [(r.rank, r.vec_id) for r in once if r.query_id == 20]
    assert len(want) == 20
    assert sorted((r.rank, r.vec_id) for r in got if r.query_id == 20) == sorted(want * 20)


@pytest.mark.parametrize("p", [0.5, 0.9, 0.98])
def test_chi_square(p):
    draws = (np.random.default_rng(1).normal(size=(200_000, 8)) ** 2).sum(axis=1)
    assert abs(np.mean(draws < neighbours.chi_square_at(p)) - p) < 0.005

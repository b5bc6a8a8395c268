import math
from fractions import Fraction

import numpy as np
import pytest

from cellspark.llm import whitening


def leverrier(a):
    """det(x I - a), lowest first, by traces of powers."""
    d = len(a)
    a = np.array(a, object)
    m, c = np.zeros((d, d), object), [1]
    for k in range(1, d + 1):
        m = a.dot(m) + c[-1] * np.eye(d, dtype=int).astype(object)
        c.append(-Fraction(int(np.trace(a.dot(m))), k))
    return [int(x) for x in c[::-1]]


def scatter(rng, d, rank, size):
    y = rng.integers(-size, size, (rank, d)).astype(object)
    return [[int(v) for v in row] for row in y.T.dot(y)]


def test_characteristic_polynomial(spark):
    rng = np.random.default_rng(1)
    for d, rank, size in [(1, 1, 9), (2, 2, 10**9), (6, 3, 50), (12, 40, 10**6), (5, 0, 2)]:
        a = scatter(rng, d, rank, size)
        assert whitening.characteristic(spark, a) == leverrier(a)


def test_roots_and_vectors(spark):
    rng = np.random.default_rng(2)
    twice = np.zeros((9, 9), int)  # eigenvalues 7 (four times), 5 (once), 2 (twice), 0 (twice), hidden by a rotation of whole numbers
    np.fill_diagonal(twice, [7, 7, 5, 2, 2, 0, 0, 7, 7])
    turn = np.eye(9, dtype=int)
    turn[:4, :4] = [[1, 1, 1, 1], [1, -1, 1, -1], [1, 1, -1, -1], [1, -1, -1, 1]]
    turn[4:, 4:] *= 2
    for a in [scatter(rng, 8, 20, 100), (turn @ twice @ turn.T).tolist(), [[1, 0], [0, 10**30]], [[10**9 + 1, 1], [1, 10**9 + 1]]]:
        values, vectors = whitening.eigen(spark, a, 6)
        m = np.array(a, float)
        want = np.linalg.eigvalsh(m)[::-1][:6]
        assert len(values) == sum(want > 1e-9) and np.allclose([float(v) for v in values], want[: len(values)], rtol=1e-12, atol=1e-9)
        assert np.allclose(vectors @ vectors.T, np.eye(len(values)), atol=1e-14)
        assert np.allclose(vectors @ m, vectors * np.array([float(v) for v in values])[:, None], rtol=1e-12, atol=1e-13 * m.max())


def made():
    rng = np.random.default_rng(3)
    base = rng.normal(size=(300, 4)) @ rng.normal(size=(4, 20)) + rng.normal(size=(300, 20)) * 0.3 + 5
    rows = [(k, v.tolist()) for k, v in enumerate(base)]
    rows += [(1000 + k, base[0].tolist()) for k in range(150)] + [(0, base[1].tolist()), (None, base[2].tolist())]
    odd = base[3].tolist()
    rows += [(2000, None), (2001, []), (2002, odd[:7]), (2003, odd[:-1] + [None]), (2004, odd[:-1] + [math.nan]), (2005, odd[:-1] + [-math.inf]), (2006, odd[:-1] + [1e300])]
    return rows


def test_whitening(spark):
    rows = made()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5).selectExpr("*", "1 AS component", "2 AS x", "'a' AS n")
    got = whitening.whiten(df).collect()
    kept = [(i, v) for i, v in rows if v and len(v) == 20 and all(c is not None and abs(c) < 1e17 for c in v)]
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for _, v in kept])
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    v = centred.T @ centred / n
    e, vectors = np.linalg.eigh(v)
    e, vectors = e[::-1][:16], vectors[:, ::-1][:, :16]
    assert len(got) == 16 * len(kept) and {r.n for r in got} == {n}
    deviation = [sum((n * int(c) - int(s)) ** 2 for c, s in zip(row, sums)) for row in x]
    want = sorted((i if i is not None else -1, d) for (i, _), d in zip(kept, deviation) for _ in range(16))
    assert sorted((r.vec_id if r.vec_id is not None else -1, int(r.deviation)) for r in got) == want
    assert all(abs(r.explained - e[r.component - 1] / np.trace(v)) < 1e-9 for r in got)
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-10
    # up to one sign a component
    for c in range(16):
        own = {}
        for r in got:
            if r.component == c + 1:
                own.setdefault((r.vec_id if r.vec_id is not None else -1, int(r.deviation)), []).append(r.whitened)
        flat = {k: z[0] for k, z in own.items()}
        exact = {(i if i is not None else -1, d): w for (i, _), d, w in zip(kept, deviation, (x - sums / n) @ vectors[:, c] / math.sqrt(e[c]))}
        sign = math.copysign(1, flat[7, deviation[7]] * exact[7, deviation[7]])
        assert flat.keys() == exact.keys() and all(abs(sign * flat[k] - exact[k]) < 1e-8 for k in flat)


def test_large_entries(spark):
    rng = np.random.default_rng(4)
    rows = [(k, (rng.normal(size=3) * 10.0 ** rng.integers(0, 16)).tolist()) for k in range(60)]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    x = [[math.floor(64 * c) for c in v] for _, v in rows]
    sums = [sum(c) for c in zip(*x)]
    want = {i: sum((60 * c - s) ** 2 for c, s in zip(row, sums)) for (i, _), row in zip(rows, x)}
    assert len(got) == 180 and got[0].identity_error < 1e-9
    assert {r.vec_id: r.deviation for r in got} == {i: v if v < 10**38 else None for i, v in want.items()}


@pytest.mark.parametrize("rows, count", [([], 0), ([(1, [1.0, 2.0])], 0), ([(1, [1.0, 2.0]), (2, [1.0, 2.0])], 0), ([(1, [1.0, 2.0]), (2, [3.0, 2.0])], 2), ([(1, None), (2, [])], 0)])
def test_few_vectors(spark, rows, count):
    assert whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).count() == count

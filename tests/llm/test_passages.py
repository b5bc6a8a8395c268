import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellspark.llm import passages, suffix
from cellspark.llm.common import table


def brute(docs, size=50):
    rank = lambda i: (i is None, i)
    first = {}
    for i, t in docs:
        b = (t or "").encode()
        for p in range(len(b) - size + 1):
            s = b[p : p + size]
            if s not in first or rank(i) < rank(first[s]):
                first[s] = i
    out = []
    for i, t in docs:
        b = (t or "").encode()
        gone = np.zeros(len(b) + 1, bool)
        for p in range(len(b) - size + 1):
            if rank(first[b[p : p + size]]) < rank(i):
                gone[p : p + size] = True
        spans = int(np.count_nonzero(gone[1:] & ~gone[:-1])) + int(gone[0])
        out.append((i, len(b), int(gone.sum()), spans, bytes(c for c, g in zip(b, gone) if not g)))
    return sorted(out, key=lambda r: (rank(r[0]), r[1:]))


@pytest.mark.parametrize("seed", range(5))
def test_deep_shallow_sort(seed):
    rng = random.Random(seed)
    part = bytes(rng.choice(b"ab\xff\0") for _ in range(30))
    data = b"".join(rng.choice([part, part[:20], bytes(rng.choice(b"ab") for _ in range(9)), b"a" * 60]) for _ in range(80))
    for length in (50, 17, 12):
        starts = np.array(rng.sample(range(len(data) - length), 500))
        order, head = suffix.sort_windows(data, starts, length)
        own = [data[p : p + length] for p in starts[order].tolist()]
        assert own == sorted(own) and sorted(order) == list(range(500))
        assert [own.index(w) for w in own] == head.tolist()


def made(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7)))
    passage = [" ".join(word() for _ in range(rng.choice([8, 20, 60]))) for _ in range(8)]
    docs = []
    for i in range(80):
        parts = [rng.choice([rng.choice(passage), " ".join(word() for _ in range(rng.randint(1, 60)))]) for _ in range(rng.randint(1, 5))]
        docs.append((i, rng.choice([" ", "\n", ""]).join(parts)))
    docs += [(200 + i, docs[i % 3][1]) for i in range(9)] + [(300 + i, "a" * (45 + 5 * i)) for i in range(6)]
    docs += [(400, None), (401, ""), (402, "x" * 49), (403, "x" * 50), (404, "x" * 51), (2, docs[0][1]), (None, docs[1][1]), (None, docs[1][1]), (5, docs[5][1])]
    docs += [(500 + i, f"{i:03d} " + "license line that is the same for all of them, more than fifty bytes" + f" {i * 7919:08d}" * 9) for i in range(40)]
    rng.shuffle(docs)
    return docs


@pytest.mark.parametrize("hot", [2000, 10])
def test_against_brute_force(spark, sf, hot):
    docs = made(hot) + [(1000 + r.doc_id, r.text) for r in table(spark, sf, "documents").filter("n_chars < 3000").collect()]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("chunk", F.lit("own")).repartition(3)
    got = passages.remove_repeats(df, carry=("chunk",), chunk_bytes=30_000, hot=hot)
    assert got.columns == ["doc_id", "chunk", "n_bytes", "n_removed", "n_spans", "kept"]
    rows = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got.collect()]
    assert sorted(rows, key=lambda r: ((r[0] is None, r[0]), r[1:])) == brute(docs)


def test_hot_units_in_bucket_code():
    """The split into windows gives the same units' windows as the runs."""
    rng = random.Random(4)
    block = [bytes(rng.choice(b"ab") for _ in range(200)) for _ in range(3)]
    runs = passages.Runs(block, np.arange(3))
    shared = np.unique(runs.marker)
    first, windows, *_ = runs.units(shared, np.zeros(len(shared), bool))
    cold = sorted(a + k for a, w in zip(first, windows) for k in range(w))
    first, windows, *_ = runs.units(shared, np.ones(len(shared), bool))
    assert sorted(first) == cold and set(windows) == {1} and len(cold) == 3 * 151


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert passages.remove_repeats(df).count() == 0
    df = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert [tuple(r)[1:4] for r in passages.remove_repeats(df).collect()] == [(0, 0, 0)] * 2

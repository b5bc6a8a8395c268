import random
import re

import numpy as np
import pytest
import xxhash

from cellspark.llm import simhash

UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))
    parts = [" ".join(w[k : k + 3]) for k in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_labels(fps):
    """The smallest signed fingerprint reachable, for each."""
    fps = np.array(sorted(fps), np.int64)
    apart = np.zeros((len(fps), len(fps)), np.int64)
    for b in range(64):
        bit = (fps >> b) & 1
        apart += bit[:, None] != bit[None, :]
    label = np.arange(len(fps))
    while True:
        low = np.array([label[row <= 3].min() for row in apart])
        if (low == label).all():
            return {int(f): int(fps[k]) for f, k in zip(fps, label)}
        label = low


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def made(seed, center_bits, n, spread):
    """Random fingerprints, chains, and dense groups around a few centers."""
    rng = random.Random(seed)
    out = {0, (1 << 64) - 1, 1 << 63, 7, 1 << 62 | 7}
    for _ in range(3):
        center = rng.getrandbits(64)
        free = rng.sample(range(64), center_bits)
        for _ in range(n):
            x = center
            for b in rng.sample(free, rng.randint(0, spread)):
                x ^= 1 << b
            out.add(x)
        for _ in range(10):  # at the edge of the group and beyond
            x = center
            for b in rng.sample(range(64), rng.randint(2, 9)):
                x ^= 1 << b
            out.add(x)
    x = rng.getrandbits(64)
    for _ in range(30):
        for b in rng.sample(range(64), rng.choice([3, 3, 4])):
            x ^= 1 << b
        out.add(x)
    return sorted({signed(v) for v in out} | {signed(rng.getrandbits(64)) for _ in range(300)})


@pytest.mark.parametrize("seed, center_bits, n, spread, crowd", [(1, 10, 150, 9, 64), (2, 30, 120, 5, 8), (3, 64, 200, 3, 10_000), (4, 40, 150, 4, 1)])
def test_links(spark, seed, center_bits, n, spread, crowd):
    fps = made(seed, center_bits, n, spread)
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    assert {r.fp: r.label for r in simhash.linked(df, crowd).collect()} == brute_labels(fps)


@pytest.mark.parametrize("m", simhash.PARTITIONS)
def test_thresholds_add_up_and_cost_least(m):
    rng = np.random.default_rng(m)
    bits = rng.integers(0, 2, (50, 64)).astype(np.uint8)
    bits[:, 1] = bits[:, 40]
    parts = simhash.dealt(np.corrcoef(bits.T) ** 2, m)
    assert sorted(b for own in parts for b in own) == list(range(64)) and any({1, 40} <= set(own) for own in parts)
    every = [b for own in parts for b in simhash.blocks(own)]
    histograms = np.array([np.bincount(simhash.packed(bits, b), minlength=256) for b in every])
    costs = simhash.Costs(parts, histograms, 50)
    least, thresholds = costs.best(bits)
    assert (thresholds.sum(axis=1) == 3 - m + 1).all() and (thresholds >= -1).all()
    table = costs.of(bits)
    for row in range(50):
        tried = [c for c in np.ndindex(*[table.shape[2]] * m) if sum(c) == 4]
        assert np.isclose(least[row], min(sum(table[row, p, t] for p, t in enumerate(c)) for c in tried))


def test_fingerprints():
    long = " ".join(str(k * k % 977) for k in range(150_000))
    for t in [None, "", " \t\n", "one", "Two W", "a b c", "A b C", "a\xa0b c d \x1c e", "É é x y", "x x x x x", long, "the cat sat on the mat\n" * 5]:
        assert simhash.fingerprint(t or "") == brute_fingerprint(t)


def test_documents(spark, rows):
    base = [f"w{k}" for k in range(400)]
    docs = [(k, " ".join([f"x{k}" if j == 37 * k % 400 else w for j, w in enumerate(base)])) for k in range(20, 50)]
    docs += [(3, None), (9, ""), (1, " \n"), (None, "no id"), (None, "NO ID"), (60, "no id"), (70, "twice"), (70, "other words here now"), (80, "Twice")]
    docs += [(200 + k, "the same text of many rows") for k in range(40)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(6).selectExpr("*", "1 AS fp", "'x' AS label", "2 AS fingerprint")
    fps = [(d, signed(brute_fingerprint(t))) for d, t in docs]
    label = brute_labels({f for _, f in fps})
    order = lambda x: (x is None, x)
    low = {}
    for d, f in fps:
        low[label[f]] = min(low.get(label[f], d), d, key=order)
    want = [(d, f"{f % (1 << 64):016x}", low[label[f]]) for d, f in fps]
    key = lambda r: [order(x) for x in r]
    assert sorted(rows(simhash.near_duplicates(df, crowd=4)), key=key) == sorted(want, key=key)
    assert rows(simhash.near_duplicates(df.limit(0))) == []

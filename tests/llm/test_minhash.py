import random
import re

from pyspark.sql import functions as F

from cellspark.llm import minhash
from cellspark.llm.common import table
from cellspark.llm.components import components

UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(docs, percent=85):
    sets = []
    for i, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(UPPER))
        sets.append({tuple(w[k : k + 3]) for k in range(len(w) - 2)} if len(w) >= 3 else {tuple(w)} if w else set())
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    holders = {}
    for i, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(i)
    seen = set()
    for group in holders.values():
        for k, i in enumerate(group):
            for j in group[k + 1 :]:
                if (i, j) not in seen:
                    seen.add((i, j))
                    both = len(sets[i] & sets[j])
                    if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                        root[find(i)] = find(j)
    order = lambda x: (x is None, x)
    low = {}
    for i in range(len(docs)):
        low[find(i)] = min(low.get(find(i), docs[i][0]), docs[i][0], key=order)
    return sorted(((d, len(s), low[find(i)], low[find(i)] == d) for i, ((d, _), s) in enumerate(zip(docs, sets))), key=lambda r: (order(r[0]), r[1]))


def made(seed=1):
    """Chains and groups around the limit, and odd rows."""
    rng = random.Random(seed)
    docs = []
    for group in range(12):
        base = [f"g{group}w{rng.randint(0, 10**6)}" for _ in range(rng.choice([3, 30, 120, 200]))]
        for _ in range(rng.randint(2, 30)):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3, 4, 5])):
                words[rng.randrange(len(words))] = f"x{rng.randint(0, 10**6)}"
            if rng.random() < 0.5:
                base = words
            docs.append(" ".join(words))
    docs += ["", None, " \n", "A b", "a B", "a b c", "É b c", "é b c", "one", "ONE", "a\xa0b c d", "same text here now"] + ["Same TEXT here now"] * 40
    rng.shuffle(docs)
    return [(i * 3, t) for i, t in enumerate(docs)] + [(0, "same text here now"), (None, None), (None, "null key once more"), (5, "null key once more")]


def test_against_brute_force(spark, sf):
    docs = [(r.doc_id + 10_000, r.text) for r in table(spark, sf, "documents").collect()] + made()
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("label", F.lit("clash")).repartition(3)
    got = minhash.near_duplicates(df).collect()
    order = lambda r: ((r[0] is None, r[0]), r[1])
    assert sorted((tuple(r) for r in got), key=order) == brute(docs)


def test_empty(spark):
    assert minhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert minhash.near_duplicates(spark.createDataFrame([(1, None), (2, "a")], "doc_id long, text string")).count() == 2


def test_components(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (103, 101)]
    got = {r.id: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 103: 100}


def test_group_around_its_first_document(spark):
    """Many copies a little beyond the limit from the first document; some link with each other."""
    rng = random.Random(5)
    base = [f"w{k}" for k in range(120)]
    docs = [(0, " ".join(base))]
    for i in range(1, 250):
        words = list(base)
        for at in rng.sample(range(0, 120, 10), rng.choice([2, 3, 4, 4, 5, 5])):
            words[at + 5] = rng.choice(["same", "other", f"x{i}"])
        docs.append((i, " ".join(words)))
    got = minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got)) == brute(docs)

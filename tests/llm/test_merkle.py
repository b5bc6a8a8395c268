import hashlib
import random
import zlib

import pytest

from cellspark.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, more=0):
    i, text, lang, source, n = row
    shown = [i, source, lang, None if n is None else n + more, text]
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in shown])


def tree(nodes):
    """The last node, and each leaf's siblings as (whether it stands before, digest)."""
    paths, level = [[] for _ in nodes], 0
    while len(nodes) > 1:
        for k, path in enumerate(paths):
            other = (k >> level) ^ 1
            path.append((other < k >> level, nodes[other] if other < len(nodes) else ""))
        nodes, level = [sha(*nodes[k : k + 2]) for k in range(0, len(nodes), 2)], level + 1
    return nodes[0], paths


def brute(docs):
    by_lang = {}
    for d in docs:
        by_lang.setdefault(d[2], []).append(d)
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = []
    for lang in langs:
        own = sorted(by_lang[lang], key=lambda d: (d[0] is not None, d[0] or 0, leaf(d)))
        trees.append((own, *tree([leaf(d) for d in own])))
    root, above = tree([t[1] for t in trees]) if trees else (None, [])
    out = []
    for (own, subroot, paths), up in zip(trees, above):
        for d, path in zip(own, paths):
            changed = d[0] is not None and zlib.crc32(str(d[0]).encode()) % 7 == 0
            at = leaf(d, int(changed))
            for before, other in path + up:
                at = sha(other, at) if before else sha(at, other)
            out.append((d[0], leaf(d), subroot, root, sha(*[o for _, o in path + up]), at, at == root))
    return out


def made():
    rng = random.Random(3)
    langs = [None, "", "en", "en", "en", "en", "é", "zz", "-", "="]
    docs = [(k, f"text {k}", rng.choice(langs), rng.choice([None, "s"]), rng.choice([None, 0, 7])) for k in range(400)]
    docs += [(5, "again", "en", "s", 5), (5, "again", "en", "s", 5), (None, "no id", "en", "s", 5), (None, None, None, None, None)]
    docs += [(900, "", "fr", "", 0), (901, "long € " * 200_000, "en", "s", 1), (-4, "negative", "en", "s", -1)]
    docs += [(1000 + k, "one", f"l{k}", "s", 3) for k in range(9)]
    rng.shuffle(docs)
    return docs


# small runs and bounds, so that a few hundred leaves climb through many stored levels both ways
@pytest.mark.parametrize("levels, few", [(8, 4096), (3, 30), (3, 0)])
def test_manifest(spark, rows, levels, few):
    docs = made()
    df = spark.createDataFrame(docs, SCHEMA).repartition(5).selectExpr("*", "1 AS leaf", "'x' AS tree", "2 AS idx")
    assert rows(merkle.manifest(df, levels, few)) == rows_of(brute(docs))


def rows_of(found):
    return sorted(found, key=lambda r: [(x is None, str(type(x)), x) for x in r])


@pytest.mark.parametrize("n", [0, 1, 3])
def test_few_rows(spark, rows, n):
    docs = [(k * 5, "t", "en", "s", 1) for k in range(n)]
    assert rows(merkle.manifest(spark.createDataFrame(docs, SCHEMA))) == rows_of(brute(docs))


def test_full_runs(spark, rows):
    docs = [(k, "t", "en", "s", 1) for k in range(64)] + [(100 + k, "t", "fr", "s", 1) for k in range(17)]
    assert rows(merkle.manifest(spark.createDataFrame(docs, SCHEMA), 4, 0)) == rows_of(brute(docs))


def test_sql(spark, sf, rows):
    import duckdb

    from cellspark.llm import queries

    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    assert rows(queries.op13_merkle_manifest(spark, sf)) == rows_of(con.execute(queries.ORACLE["op13_merkle_manifest"]).fetchall())

import random

from cellspark.llm import wordpiece
from cellspark.llm.common import table, tokenizer_file, words


def brute(word, starts, rest):
    at, n = 0, 0
    while at < len(word):
        pieces = rest if at else starts
        end = next((e for e in range(len(word), at, -1) if word[at:e] in pieces), None)
        if end is None:
            return -1
        at, n = end, n + 1
    return n


def test_random_vocabularies():
    rng = random.Random(7)
    make = lambda k: bytes(rng.choice(b"abc") for _ in range(rng.randint(1, k)))
    for _ in range(200):
        starts, rest = {make(5) for _ in range(rng.randint(1, 8))}, {make(6) for _ in range(rng.randint(1, 9))}
        a = wordpiece.Automaton(starts, rest)
        for _ in range(60):
            w = make(14)
            assert a.count(w) == brute(w, starts, rest), (starts, rest, w)


def test_documents(spark, sf):
    path = tokenizer_file("byte_bpe_50k.json")
    pieces = wordpiece.bpe.Vocabulary.read(path).ids
    alone = {bytes([b]) for b in range(256)}
    starts = {p[1:] for p in pieces if p[:1] == b" " and len(p) > 1} | alone
    rest = {p for p in pieces if p[:1] != b" "} | alone
    rows = [(r.doc_id, r.text) for r in table(spark, sf, "documents").limit(40).collect()]
    rows += [(None, None), (-1, ""), (-1, " \n"), (-2, "a\xa0b c"), (-3, "z" * 50_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, r.n_words, r.n_tokens, r.n_unknown) for r in wordpiece.count_tokens(df, path).collect()]
    want = []
    for i, t in rows:
        counts = [brute(w.encode(), starts, rest) for w in words(t or "")] if t is None or len(t) < 9000 else None
        if counts is not None:
            want.append((i, len(counts), sum(counts), 0))
    key = lambda r: (r[0] is None, r)
    assert [r for r in sorted(got, key=key) if r[1:] in {w[1:] for w in want}] and set(want) <= set(got)
    assert wordpiece.count_tokens(df.limit(0), path).count() == 0

import random

import pytest
from tokenizers import Tokenizer

from cellspark.llm import bpe
from cellspark.llm.common import table, tokenizer_file

PATH = tokenizer_file("byte_bpe_50k.json")
ODD = ["", " ", "a", "  a", "a  b", "\n\n a\t b ", "x<|endoftext|>y", "<|endoftext|>", "<|endoftext|><|endoftext|> z", "é" * 50,
       "日本語のテキスト 🎉🎉 ok", "don't we'll I'm", "a b   c", "a\x1cb \x1d c", "1234 5 6\n7", "ab" * 900, "=" * 3000,
       "a" * 4001, " the" * 600, "thethethe" * 300, " " * 500 + "x", "é é", "퟿�", "tab\tend\t"]


def library(texts):
    t = Tokenizer.from_file(PATH)
    ids = [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]
    return ids, [t.decode(i, skip_special_tokens=False) for i in ids]


def test_matches_library(spark, sf):
    docs = [r.text for r in table(spark, sf, "documents").limit(60).collect()] + ODD
    t = bpe.Transducer(PATH)
    import numpy as np

    ids, back = library(docs)
    for text, want, said in zip(docs, ids, back, strict=True):
        got = t.encode(text)
        assert np.frombuffer(got, "<u4").tolist() == want, text[:80]
        assert t.decode(got) == said


def test_lookahead_is_sufficient():
    v = bpe.Vocabulary.read(PATH)
    assert 0 < v.lookahead < 4096
    rng = random.Random(3)
    words = [w for w in v.ids if w.isalpha() and w.isascii()]
    for _ in range(60):
        data = b"".join(rng.choice(words)[: rng.randint(1, 9)] for _ in range(rng.randint(1, 900)))
        e = bpe.Encoder(v, block=rng.choice([1, 7, 64]))
        got = []
        at = 0
        while at < len(data):
            step = rng.randint(1, 400)
            got += e.feed(data[at : at + step])
            at += step
            assert len(e.buffer) <= 2 * e.window
        got += e.finish()
        assert got == v.merge(data)


@pytest.mark.parametrize("seed", range(6))
def test_lookahead_of_small_lists(seed):
    """On small random merge lists the bound holds for every text and continuation tried."""
    rng = random.Random(seed)
    tokens = [b"a", b"b", b"c"]
    merges = []
    while len(merges) < 14:
        a, b = rng.choice(tokens), rng.choice(tokens)
        if a + b not in tokens and len(a + b) < 9:
            merges.append((a, b))
            tokens.append(a + b)
    ids = {t: i for i, t in enumerate(dict.fromkeys(tokens + [bytes([x]) for x in range(256)]))}
    v = bpe.Vocabulary(merges, ids, {})
    for _ in range(3000):
        data = bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 60)))
        more = data + bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 30)))
        ends = []
        for part in (data, more):
            at, cut = 0, set()
            for t in v.merge(part):
                at += len(v.spelled[t])
                if at <= len(data) - v.lookahead:
                    cut.add(at)
            ends.append(cut)
        assert ends[0] == ends[1]
        e = bpe.Encoder(v, block=1)
        assert list(e.feed(more)) + list(e.finish()) == v.merge(more)


def test_decoder_keeps_state():
    v = bpe.Vocabulary.read(PATH)
    ids = [i for b in "aé🎉€".encode() + b"\xff\xe2\x82" for i in [v.ids[bytes([b])]]]
    d = bpe.Decoder(v)
    parts = [d.feed([i]) for i in ids] + [d.feed((), last=True)]
    assert "".join(parts) == ("aé🎉€".encode() + b"\xff\xe2\x82").decode("utf-8", "replace")


def test_frames(spark):
    df = spark.createDataFrame([(1, None, "x"), (1, "hello hello hello", "y"), (None, "", "z")], "doc_id long, text string, ids string")
    out = bpe.encode(df, PATH, decoded="decoded").collect()
    assert [(r.doc_id, len(r.ids), r.decoded) for r in out] == [(1, 0, ""), (1, 12, "hello hello hello"), (None, 0, "")]
    assert bpe.decode(bpe.encode(df, PATH), PATH).count() == 3
    assert bpe.encode(df.limit(0), PATH).count() == 0

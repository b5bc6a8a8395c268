import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cellspark.llm import packing
from cellspark.llm.common import table, tokenizer_file

PATH = tokenizer_file("word_bpe_49k.json")
ODD = ["", " ", "x\x1cy\x1dz", "Straße ΣΑΣ İ", "a<|endoftext|>b <|startoftext|>", "é ́x", "a b\x85c\xa0d", "it's I'LL", "日本 🎉", "​ zero", "K", "THE,, It.! é? <|ENDOFTEXT|> x", "İSTANBUL. ΑΣ.", "it's. don't!? ...", "a|b c| |"]


def expected(texts):
    t = Tokenizer.from_file(PATH)
    return [e.ids + [1] for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def check(rows, docs, size):
    """Whole: every id in one piece; sequences gapless and not too long. Returns the share of padding."""
    ids = defaultdict(list)
    for (i, _), own in zip(docs, expected([t for _, t in docs]), strict=True):
        ids[i].append(own)
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == set(ids)
    for i, own in ids.items():
        want = sorted((s, len(p), zlib.crc32(np.array(p, "<u4").tobytes()), len(x)) for x in own for s in range(0, len(x), size) for p in [x[s : s + size]])
        assert sorted((r.start, r.length, r.ids_crc32, r.doc_tokens) for r in pieces[i]) == want
    total = padded = 0
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert 0 < at <= size
        total += at
        padded += at if at & (at - 1) == 0 else size
    return 1 - total / padded


@pytest.mark.parametrize("size", [64, 2048])
def test_packs_documents(spark, sf, size):
    docs = [(r.doc_id, r.text) for r in table(spark, sf, "documents").limit(80).collect()]
    docs += [(9000 + i, t) for i, t in enumerate(ODD)] + [(7, None), (None, "null key"), (7, "again"), (7, "again"), (8000, "word " * 30_000)]
    docs += [(10_000 + i, "same text of a class") for i in range(300)]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("rank", F.lit("clash")).repartition(3)
    padding = check(packing.pack(df, PATH, size, grain=1 if size == 64 else 4).collect(), docs, size)
    assert padding < (0.05 if size == 2048 else 0.10)


def test_empty(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0


def test_patterns_are_whole_and_near_the_bound():
    rng = np.random.default_rng(1)
    for room, n in ((100, 3000), (512, 60_000), (512, 5)):
        lengths = rng.integers(1, room + 1, n)
        counts = {int(k): int(c) for k, c in zip(*np.unique(lengths, return_counts=True))}
        chosen = packing.patterns(counts, room)
        made = defaultdict(int)
        for times, own in chosen:
            assert sum(k * v for k, v in own.items()) <= room
            for k, v in own.items():
                made[k] += times * v
        assert made == counts
        bound = sum(k * v for k, v in counts.items()) / room
        assert sum(t for t, _ in chosen) <= max(bound * 1.02 + 60, bound + 3)

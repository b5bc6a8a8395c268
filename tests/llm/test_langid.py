from pyspark.sql import functions as F

import numpy as np
import zlib

from cellspark.llm import langid, queries
from cellspark.llm.common import table


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    truth = {r.doc_id: (r.lang, r.text) for r in table(spark, folder, "documents").collect()}
    rows = queries.op2_language_id(spark, folder).collect()
    assert len(rows) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r.held_out and len(truth[r.doc_id][1]) > 30]
    right = np.mean([r.lang_pred == truth[r.doc_id][0] for r in held])
    assert right >= 0.97, right
    assert all(0 <= r.score <= 1 for r in rows)


def test_gradients_are_right():
    shape = langid.Shape(window=12, embedding=3, widths=(2, 3), filters=4)
    net = langid.Network(shape, ["a", "b", "c"])
    net.weights = [w.astype(np.float64) for w in net.weights]
    rng = np.random.default_rng(0)
    data, labels = rng.integers(1, 256, (5, 12)).astype(np.uint8), rng.integers(0, 3, 5)
    _, grads = net.gradients(data, labels)
    for w, g in zip(net.weights, grads):
        for _ in range(6):
            at = tuple(rng.integers(0, s) for s in w.shape)
            if w is net.weights[0]:
                at = (data[rng.integers(0, 5), rng.integers(0, 12)], at[1])
            if w is net.weights[1] and not net.mask[at]:
                continue
            old, h = w[at], 1e-6
            w[at] = old + h
            up, _ = net.gradients(data, labels)
            w[at] = old - h
            down, _ = net.gradients(data, labels)
            w[at] = old
            assert abs((up - down) / (2 * h) - g[at]) < 1e-5


def test_windows_cover_everything():
    for n in (0, 1, 3, 4, 255, 256, 257, 509, 510, 2000):
        text = "".join(chr(97 + i % 26) for i in range(n))
        data, owners = langid.to_windows([text, "b"], 256, 4)
        own = data[owners == 0]
        raw = bytes(own[0]) + b"".join(bytes(w[3:]) for w in own[1:])
        assert raw.rstrip(b"\0") == text.encode() and (owners == 1).sum() == 1


def test_odd_rows(spark):
    rows = [(1, None, "en"), (2, "", "en"), (3, "123 !?", None), (4, "the and of " * 30_000, "en"), (4, "le la et", "fr"), (None, "x", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("SCORE", F.lit("clash"))
    net = langid.train(df)
    out = langid.predict(df, net)
    assert [r.lang_pred for r in out.collect()][:3] == ["und"] * 3
    assert [f.lower() for f in out.columns].count("score") == 1
    assert langid.train(df.filter("false")) is None
    assert {r.lang_pred for r in langid.predict(df, None).collect()} == {"und"}
    assert langid.predict(df.limit(0), net).count() == 0

"""Runs of windows with one marker: the same whatever the block, in memory of a small multiple of the text."""

import tracemalloc

import numpy as np
import pytest

from cellspark.llm import passages


def texts(n, size, seed=5):
    rng = np.random.default_rng(seed)
    return [rng.integers(97, 101, max(0, size + int(rng.integers(-40, 40))), dtype=np.uint8).tobytes() for _ in range(n)]


@pytest.mark.parametrize("block", [1, 7, 64, 1000])
def test_blocks_give_the_same_runs(monkeypatch, block):
    docs = [b"", *texts(20, 60), b"x" * 300, b"short", *texts(3, 900)]
    ids = np.arange(len(docs))
    whole = passages.Runs(docs, ids)
    monkeypatch.setattr(passages, "BLOCK", block)
    parts = passages.Runs(docs, ids)
    for name in ("first", "last", "marker", "doc", "ids"):
        assert np.array_equal(getattr(whole, name), getattr(parts, name)), name
    # every window inside of one text is in one run, and its marker is the smallest hash of its substrings
    inside = sorted(a + i for a, b in zip(whole.starts.tolist(), whole.ends.tolist()) for i in range(max(0, b - a - passages.LENGTH + 1)))
    assert inside == [w for a, b in zip(whole.first.tolist(), whole.last.tolist()) for w in range(a, b + 1)]
    for a, b, m in zip(whole.first.tolist(), whole.last.tolist(), whole.marker.tolist()):
        for w in (a, b):
            window = np.frombuffer(whole.data[w : w + passages.LENGTH], np.uint8)
            assert passages.window_markers(window).tolist() == [m]


def test_memory_of_a_chunk():
    docs = texts(800, 5000)
    size = sum(map(len, docs))
    tracemalloc.start()
    try:
        passages.Runs(docs, np.arange(len(docs)))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 10 * size

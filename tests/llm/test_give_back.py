"""Steps of the passages hand freed memory back after each group, and what another operator keeps goes."""

import pyarrow as pa

from cellspark.llm import common, passages


def test_a_group_gives_back(monkeypatch):
    calls = []
    monkeypatch.setattr(passages, "give_back", lambda: calls.append("back"))
    common.keep("another operator", lambda: calls.append("released"))
    one, two = pa.table({"a": [1]}), pa.table({"b": [2]})
    assert passages.of_one(lambda t: t)(one) is one
    assert passages.of_two(lambda t, told: told)(one, two) is two
    assert calls == ["released", "back", "back"]

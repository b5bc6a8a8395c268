import pytest

from cellspark import TableSpec, ViewSpec
from cellspark.operators.grouping import check_prefix

BASE = TableSpec(["k"], ["c", ("d", "desc")], ["s"], ["v", "w"])


def test_columns_and_order():
    assert BASE.columns == ["k", "c", "d", "s", "v", "w"]
    assert BASE.key == ["k", "c", "d"]
    assert BASE.mixed_order


@pytest.mark.parametrize("args", [
    ([], ["c"]), (["k"], ["k"]), (["k"], [("c", "up")]),
])
def test_bad_table(args):
    with pytest.raises(ValueError):
        TableSpec(*args)


def test_ttl_bounds():
    TableSpec(["k"], default_ttl=630720000)
    for ttl in (-1, 630720001):
        with pytest.raises(ValueError):
            TableSpec(["k"], default_ttl=ttl)


def test_view_key_rules():
    view = ViewSpec(BASE, ["v"], ["k", "c", "d"])
    assert view.moved == "v" and view.columns == ("w",)
    for key in (["v"], ["v", "w", "k", "c", "d"], ["s", "k", "c", "d"]):
        with pytest.raises(ValueError):
            ViewSpec(BASE, [key[0]], key[1:])


def test_group_prefix_rules():
    check_prefix(BASE, ["k", "c"])
    check_prefix(BASE, ["k", "d"], fixed=("c",))
    for group in (["c"], ["k", "d"], ["k", "v"], ["c", "k"]):
        with pytest.raises(ValueError):
            check_prefix(BASE, group)

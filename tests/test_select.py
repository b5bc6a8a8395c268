from pyspark.sql import functions as F
import pytest

from cellspark import TableSpec
from cellspark.functions import aggregates as A
from cellspark.operators import collections as C
from cellspark.operators import grouping, predicates, select

ABCD = TableSpec(["a"], ["b", "c", "d"], (), ["e"])
STATIC = TableSpec(["k"], ["p"], ["s"], ["v"])


@pytest.fixture(scope="module")
def golden(spark):
    data = [(1, 2, 1, 3, 6), (1, 2, 2, 6, 12), (1, 4, 2, 12, 24), (1, 4, 2, 6, 12), (2, 2, 3, 3, 6), (2, 4, 3, 6, 12),
            (4, 8, 2, 12, 24)]
    return spark.createDataFrame(data, "a int, b int, c int, d int, e int")


def test_group_by_partition(golden, rows):
    aggs = {"n": A.count(F.col("b")), "m": A.max_of(F.col("e"))}
    out = grouping.group_by(golden, ABCD, ["a"], aggs, first=["b", "e"])
    assert rows(out) == [(1, 2, 6, 4, 24), (2, 2, 6, 2, 12), (4, 8, 24, 1, 24)]


def test_group_by_prefix(golden, rows):
    aggs = {"n": A.count(F.col("b")), "m": A.max_of(F.col("e"))}
    out = grouping.group_by(golden, ABCD, ["a", "b"], aggs, first=["e"])
    assert rows(out) == [(1, 2, 6, 2, 12), (1, 4, 12, 2, 24), (2, 2, 6, 1, 6), (2, 4, 12, 1, 12), (4, 8, 24, 1, 24)]


def test_statics(spark, rows):
    data = spark.createDataFrame([(1, 1, 10), (1, 2, 11)], "k int, p int, v int")
    statics = spark.createDataFrame([(0, 42), (1, 7)], "k int, s int")
    assert rows(select.with_statics(data, statics, STATIC)) == [(0, None, 42, None), (1, 1, 7, 10), (1, 2, 7, 11)]
    restricted = select.with_statics(data.filter("p = 1"), statics, STATIC, static_only=False)
    assert rows(restricted) == [(1, 1, 7, 10)]
    assert rows(select.distinct_partitions(select.with_statics(data, statics, STATIC), STATIC, ["s"])) == [(0, 42), (1, 7)]


def test_per_partition_limit_and_reverse(golden, rows):
    kept = select.per_partition_limit(golden, ABCD, 1, reverse=True).select("a", "b", "c", "d")
    assert rows(kept) == [(1, 4, 2, 12), (2, 4, 3, 6), (4, 8, 2, 12)]
    assert rows(select.latest_per_partition(golden, ABCD, ["b", "c", "d"])) == rows(kept)


def test_group_limit_runs_before_the_shuffle(golden):
    plan = select.per_partition_limit(golden, ABCD, 1)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_pages_cover_everything_once(spark, rows):
    df = spark.range(200).select((F.col("id") % 7).alias("k"), (F.col("id") % 31).alias("c"), "id")
    spec = TableSpec(["k"], [("c", "desc"), "id"])
    seen, after = [], None
    while True:
        page = select.page(df, spec, 37, after)
        got = page.collect()
        seen += [r.id for r in got]
        if len(got) < 37:
            break
        after = tuple(select.resume_state(page, spec).first())
    assert sorted(seen) == list(range(200)) and len(seen) == 200


def test_tuple_slice_is_lexicographic(golden, rows):
    want = [r for r in rows(golden) if (r[1], r[2], r[3]) > (2, 2, 3)]
    assert rows(golden.filter(predicates.tuple_slice(["b", "c", "d"], ">", (2, 2, 3)))) == want


def test_in_of_nothing(golden):
    assert golden.filter(predicates.is_in("a", [])).count() == 0


@pytest.mark.parametrize("pattern, kind", [("a%", ("prefix", "a")), ("%a", ("suffix", "a")), ("%a%", ("contains", "a")),
                                           ("a", ("equals", "a"))])
def test_like_kind(pattern, kind):
    assert predicates.like_kind(pattern) == kind


@pytest.mark.parametrize("pattern", ["", "%", "%%", "a%b"])
def test_like_errors(pattern):
    with pytest.raises(ValueError):
        predicates.like_kind(pattern)


def test_collection_edits(spark):
    df = spark.createDataFrame([(["a", "b"], {"x": 1})], "l array<string>, m map<string,int>")
    l, m = F.col("l"), F.col("m")
    arr = lambda *x: F.array(*[F.lit(i) for i in x])
    got = df.select(
        C.list_append(l, arr("c")), C.list_prepend(l, arr("y", "z")), C.list_set(l, 1, F.lit("q"), "array<string>"),
        C.list_delete_at(l, 0, "array<string>"), C.list_discard(l, arr("a", "b")), C.set_add(l, arr("0", "a")),
        C.map_put(m, F.create_map(F.lit("a"), F.lit(2), F.lit("x"), F.lit(None).cast("int"))), C.map_remove(m, arr("x"))).first()
    assert tuple(got) == (["a", "b", "c"], ["y", "z", "a", "b"], ["a", "q"], ["b"], None, ["0", "a", "b"], {"a": 2}, None)
    with pytest.raises(Exception, match="out of bounds"):
        df.select(C.list_set(l, 2, F.lit("q"), "array<string>")).collect()


def test_edits_of_missing_collections(spark):
    df = spark.createDataFrame([(None, None)], "l array<string>, m map<string,int>")
    got = df.select(C.list_append(F.col("l"), F.array(F.lit("c"))), C.set_add(F.col("l"), F.array(F.lit("c"))),
                    C.map_put(F.col("m"), F.create_map(F.lit("a"), F.lit(2)))).first()
    assert tuple(got) == (["c"], ["c"], {"a": 2})

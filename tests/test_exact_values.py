"""Values that must not be rounded, merged, skipped or cut on the way."""

import pytest
from pyspark.sql import functions as F

from cellspark.functions import aggregates as A
from cellspark.functions import udf
from cellspark.operators import mutate, text
from cellspark.operators.text import Analyzer
from cellspark.sources import csvio
from cellspark.spec import TableSpec

BIG = 1 << 53


@pytest.mark.parametrize("merge", [None, lambda a, b: a + b])
def test_fold_keeps_large_integers_and_keys(spark, merge):
    df = spark.createDataFrame(
        [(BIG, 1, BIG + 1), (BIG + 1, 1, None), (BIG + 1, 2, 5), (None, 1, 7)], "g bigint, o int, x bigint")
    got = udf.fold_groups(df, ["g"], ["o"], ["x"], lambda s, x: s + x, "bigint", initial=0, merge=merge)
    assert {(r["g"], r["value"]) for r in got.collect()} == {(BIG, BIG + 1), (BIG + 1, 5), (None, 7)}


@pytest.mark.parametrize("merge", [None, lambda a, b: a + b])
def test_fold_counts_nan_and_copies_the_initial_state(spark, merge):
    nan = float("nan")
    df = spark.createDataFrame([(nan, 1, nan), (nan, 2, 1.0), (1.0, 1, None), (1.0, 2, 2.0)], "g double, o int, x double")

    def add(state, x):
        state.append(1)
        return state

    got = udf.fold_groups(df, ["g"], ["o"], ["x"], add, "array<int>", initial=[], merge=merge,
                          final=len, result_type="int")
    assert sorted(r["value"] for r in got.collect()) == [1, 2]


def test_vector_function_null_policy(spark):
    df = spark.createDataFrame([(1.0,), (None,)], "x double")
    strict = udf.vector_function(lambda s: s.fillna(0) + 1, "double")
    called = udf.vector_function(lambda s: s.fillna(0) + 1, "double", udf.CALLED)
    rows = df.select(strict("x").alias("a"), called("x").alias("b")).collect()
    assert {(r["a"], r["b"]) for r in rows} == {(2.0, 2.0), (None, 1.0)}


@pytest.mark.parametrize("values", [
    [10**37 * 9 + 7, 10**37 * 9 + 8, 10**37 * 9 + 8], [-(10**37) * 9, -5], [10**30, -1, -1], [-(10**30), 1, 1],
    [10**19, -3, 0], [-(10**19), 3, 0], [7, -8], [5]])
def test_mean_of_38_digits(spark, values):
    df = spark.createDataFrame([(str(v),) for v in values], "v string").select(F.col("v").cast("decimal(38,0)").alias("v"))
    total, n = sum(values), len(values)
    want = abs(total) // n * (1 if total >= 0 else -1)
    assert int(df.agg(A.avg_of(F.col("v"), "varint")).first()[0]) == want


def test_search_and_index_share_the_length_rule(spark):
    long = "x" * 300
    df = spark.createDataFrame([(1, f"{long} day"), (2, "day İx")], "id int, t string")
    plain, short = Analyzer("standard", case="lower"), Analyzer("standard", case="lower", max_length=2)
    indexed = {(r["id"], r["term"]) for r in text.term_rows(df, "t", plain, ["id"]).collect()}
    assert indexed == {(r["id"], r["term"]) for r in text.terms_table(df, "t", plain, ["id"]).collect()}
    assert (1, long) not in indexed and (1, "day") in indexed
    assert text.search(df, "t", long, plain).count() == 0
    for found in (text.term_rows(df, "t", short, ["id"]), text.terms_table(df, "t", short, ["id"])):
        assert [r["term"] for r in found.collect()] == ["i̇x"]


def test_query_text_with_combining_marks(spark):
    df = spark.createDataFrame([(1, "मैं हिन्दी बोलता हूँ"), (2, "यह ह और न है")], "id int, t string")
    got = text.search(df, "t", "हिन्दी", Analyzer("standard", case="lower")).select("id").collect()
    assert [r["id"] for r in got] == [1]


def test_conditional_updates_of_one_key(spark):
    spec = TableSpec(["k"], [], (), ["v"])
    table = spark.createDataFrame([(1, "a")], "k int, v string")
    updates = spark.createDataFrame([(1, "late", 2), (1, "early", 1), (2, "new", 1)], "k int, v string, at int")
    after, _ = mutate.apply_if(table, updates, spec, F.lit(True), ["v"], order=F.col("at"))
    assert {tuple(r) for r in after.collect()} == {(1, "early"), (2, "new")}
    with pytest.raises(Exception, match="several conditional updates"):
        mutate.apply_if(table, updates, spec, F.lit(True), ["v"])[0].collect()


def test_csv_cells_with_line_breaks(spark, tmp_path):
    spec = TableSpec(["k"], [], (), ["v"])
    df = spark.createDataFrame([(1, "one\ntwo"), (2, 'a "b",\n\nc')], "k int, v string")
    csvio.export_csv(csvio.export_rows(df, spec), str(tmp_path / "c"))
    good, bad = csvio.import_csv(spark, str(tmp_path / "c"), df.schema, ["k"])
    assert {tuple(r) for r in good.collect()} == {(1, "one\ntwo"), (2, 'a "b",\n\nc')} and bad.count() == 0


def test_interval_percentiles_are_exact_on_large_intervals(spark):
    from cellspark.streaming import mutations as S

    n = 400_000
    df = spark.range(1, n + 1, 1, 8).select(F.timestamp_seconds(F.lit(1000)).alias("ts"), F.pmod(F.col("id") * 7919, F.lit(n + 1)).cast("double").alias("value"))
    values = sorted(r[0] for r in df.select("value").collect())
    got = S.interval_rates(df, "ts", "1 day", F.col("value")).first()
    assert got.n == n and list(got.p) == [values[n * k // 100 - 1] for k in (50, 95, 99)]

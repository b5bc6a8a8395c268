import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellspark import TableSpec, ViewSpec
from cellspark.functions import udf
from cellspark.operators import index, mutate, select, text, views
from cellspark.operators import reconcile as rec
from cellspark.operators.text import Analyzer
from cellspark.session import fresh_path
from cellspark.sources import changes, csvio, generator, tables
from cellspark.streaming import mutations as S
from tests.test_reconcile import NOW, SCHEMA, SPEC, random_log


@pytest.fixture(scope="module")
def parts(spark):
    """A mutation log as five files, in an order that has nothing to do with write time."""
    log = [r for r in random_log(31) if r[2] != "delete_partition"]
    path = fresh_path(spark, "log")
    for i in range(5):
        spark.createDataFrame(log[i::5], SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return path, spark.createDataFrame(log, SCHEMA)


def test_stream_equals_batch_for_any_split(spark, parts, rows):
    path, log = parts
    want = rows(rec.live_rows(rec.reconcile(log, SPEC, NOW), SPEC))
    for files in (1, 2, 5):
        out, check = fresh_path(spark, "state"), fresh_path(spark, "ck")
        stream = S.source(spark, path, log.schema, files)
        S.upsert_sink(S.latest_state(stream, SPEC, NOW), out, check).awaitTermination()
        assert rows(S.live_latest(spark, out, SPEC)) == want


def test_view_stream_equals_batch_view(spark, parts, rows):
    path, log = parts
    view = ViewSpec(SPEC, ["w"], ["k", "c"], ["v"])
    out, check = fresh_path(spark, "view"), fresh_path(spark, "ck")
    S.maintain_view(S.source(spark, path, log.schema, 1), view, NOW, out, check).awaitTermination()
    want = rows(views.rows(rec.reconcile(log, SPEC, NOW), view))
    assert rows(S.view_rows(spark, out, view)) == want
    kept = fresh_path(spark, "view")
    S.consolidate(spark, out, SPEC.key, kept)
    assert rows(S.view_rows(spark, kept, view)) == want


def test_sink_is_idempotent(spark, parts, rows):
    path, log = parts
    out = fresh_path(spark, "counts")
    for _ in range(2):  # a new checkpoint delivers every batch again under the same ids
        stream = S.counters(S.source(spark, path, log.schema, 2), ["k"], F.lit(1))
        S.upsert_sink(stream, out, fresh_path(spark, "ck")).awaitTermination()
    want = rows(log.groupBy("k").agg(F.count(F.lit(1))))
    assert rows(S.current(spark, out, ["k"])) == want


def test_bulk_write_is_clustered_and_prunable(spark, rows):
    df = spark.range(5000).select((F.col("id") % 50).alias("k"), F.col("id").alias("c"), F.lit(1).alias("v"))
    spec = TableSpec(["k"], ["c"], (), ["v"])
    path = fresh_path(spark, "bulk")
    tables.bulk_write(df, spec, path, n_files=6, keep_token=True)
    back = spark.read.parquet(path)
    assert back.count() == 5000
    first = select.page(back, spec, 100)
    after = tuple(select.resume_state(first, spec).first())
    plan = select.page(back, spec, 100, after)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(_token" in plan
    from cellspark.operators.maintenance import verify_order

    assert verify_order(back.drop("_token"), spec).count() == 0


def test_hot_partition_is_spread_by_bulk_write(spark):
    # one key holds a third of the rows
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("c"))
    path = fresh_path(spark, "hot")
    tables.bulk_write(df, TableSpec(["k"], ["c"]), path, n_files=9)
    sizes = [r.n for r in spark.read.parquet(path).groupBy(F.col("_metadata.file_path")).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert max(sizes) < 2 * 9000 / 9


def test_load_rules(spark):
    spec = TableSpec(["k"], (), (), ["v"])
    df = spark.createDataFrame([(1, 2, 3)], "a int, v int, extra int")
    with pytest.raises(ValueError):
        tables.load(df, spec, {"a": "k"})
    with pytest.raises(ValueError):
        tables.load(df, spec, {"a": "k", "extra": "k"})
    assert tables.load(df, spec, {"a": "k"}, ignore_missing=True).columns == ["k", "v", "_op"]


def test_changes_rebuild_the_table(spark, rows):
    log = spark.createDataFrame([r for r in random_log(41) if r[2] != "delete_partition"], SCHEMA)
    state = rec.reconcile(log, SPEC, NOW)
    out = changes.to_changes(state, SPEC, "t")
    value = lambda c, kind: F.try_element_at("set", F.lit(c)).cast(kind).alias(c)
    again = out.select(
        "k", "c", F.when(F.col("kind") == "delete", "delete_cells").otherwise(F.col("kind")).alias("_op"), F.col("ts").alias("_ts"),
        F.map_keys("set").alias("_set"), value("v", "int"), value("w", "string"))
    # TTLs are relative to the write time, which a statement does not carry: compare live data without them
    lasting = state.filter(F.col("v.ttl").isNull() & F.col("w.ttl").isNull() & F.col("_live.ttl").isNull())
    keys = lasting.select("k", "c")
    rebuilt = rec.live_rows(rec.reconcile(again, SPEC, NOW, partition_deletes=False), SPEC).join(keys, ["k", "c"], "left_semi")
    assert rows(rebuilt) == rows(rec.live_rows(lasting, SPEC))


def test_statement_text(spark):
    log = mutate.log_of(
        mutate.insert(spark.createDataFrame([(1, 2, 5, "it's")], "k int, c int, v int, w string"), SPEC, 10, ttl=60, now=990),
        mutate.update(spark.createDataFrame([(1, 2, None)], "k int, c int, v int"), SPEC, 12))
    got = {r.kind: r.statement for r in changes.to_changes(rec.reconcile(log, SPEC, NOW, partition_deletes=False), SPEC, "t").collect()}
    assert got == {
        "insert": "INSERT INTO t (k, c, w) VALUES (1, 2, 'it''s') USING TIMESTAMP 10 AND TTL 60",
        "delete": "DELETE v FROM t USING TIMESTAMP 12 WHERE k = 1 AND c = 2"}


def test_csv_errors_and_styles(spark, rows):
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("x", T.DoubleType()), T.StructField("b", T.BooleanType()),
                           T.StructField("s", T.StringType())])
    df = spark.createDataFrame([(1, 1234567.5, True, 'a "q", b'), (2, None, False, None), (3, -0.25, None, "z")], schema)
    spec = TableSpec(["k"], (), (), ["x", "b", "s"])
    path = fresh_path(spark, "csv")
    style = dict(null_value="NULL", decimal_sep=",", thousands_sep=".", bool_style=("y", "n"))
    csvio.export_csv(csvio.export_rows(df, spec, **style), path, header=True, delimiter="|")
    assert "1|1.234.567,5|y" in "\n".join(r.value for r in spark.read.text(path).collect())
    good, bad = csvio.import_csv(spark, path, schema, ["k"], header=True, delimiter="|", **style)
    assert rows(good) == rows(df) and bad.count() == 0
    broken = fresh_path(spark, "csv")
    spark.createDataFrame([("1,2.5,True,a",), ("x,2.5,True,a",), (",1.0,True,b",), ("1,2",)], "t string").write.text(broken)
    good, bad = csvio.import_csv(spark, broken, schema, ["k"])
    assert good.count() == 1 and bad.count() == 3
    with pytest.raises(ValueError):
        csvio.check_errors(bad, 2)


def test_generator_is_deterministic_and_bounded(spark, rows):
    G = generator
    for text_form in ("uniform(5..9)", "gaussian(1..100)", "gaussian(1..100,20,5)", "exp(1..1000)", "extreme(1..1000,0.5)",
                      "qextreme(1..1000,0.5,10)", "seq(1..7)", "fixed(3)", "~exp(1..1000)", "norm(1..1k)"):
        profile = G.Profile([G.ColumnProfile("k", population=text_form)])
        got = [r.k for r in G.generate_range(spark, profile, 2000).collect()]
        d = G.Distribution.parse(text_form)
        assert min(got) >= d.low and max(got) <= d.high
        assert got == [r.k for r in G.generate(profile, spark.range(2000).repartition(5)).orderBy("k").collect()] or \
            sorted(got) == sorted(r.k for r in G.generate(profile, spark.range(2000).repartition(5)).collect())
    with pytest.raises(ValueError):
        G.Distribution.parse("zipf(1..2)")


def test_generator_shapes(spark):
    G = generator
    sample = lambda form: [r.k for r in G.generate_range(spark, G.Profile([G.ColumnProfile("k", population=form)]), 20000).collect()]
    g = sample("gaussian(0..1000)")
    assert abs(sum(g) / len(g) - 500) < 5
    e = sample("exp(0..1000)")
    assert sum(1 for x in e if x < 300) > sum(1 for x in e if x >= 300)
    inv = sample("~exp(0..1000)")
    assert sum(1 for x in inv if x > 700) > sum(1 for x in inv if x <= 700)
    s = sample("seq(1..10)")
    assert sorted(set(s)) == list(range(1, 11)) and s.count(1) == 2000


def test_search_and_index_agree(spark, rows):
    docs = [(1, "Stress testing: it's A TEST"), (2, "nothing here"), (3, None), (4, "contest of ΟΔΟΣ and İ"), (5, "e.g. 3.14 test's")]
    df = spark.createDataFrame(docs, "id int, t string")
    lower = Analyzer("standard", case="lower")
    find = lambda p: sorted(r.id for r in text.search(df, "t", p, lower).collect())
    assert find("test%") == [1, 5] and find("%test") == [1, 4] and find("%tes%") == [1, 4, 5] and find("Test") == [1]
    assert find("here testing") == [1, 2]
    assert sorted(r.id for r in text.search(df, "t", "test", lower, negate=True).collect()) == [2, 3, 4, 5]
    spec = TableSpec(["id"])
    for mode in ("prefix", "contains"):
        built = index.term_index(df, "t", lower, spec, mode)
        for p in ("test%", "%test", "%tes%", "test"):
            hit = index.lookup(built, index.like_predicate(p, mode), spec)
            assert sorted(r.id for r in hit.collect()) == find(p)


def test_term_paths_agree(spark):
    docs = [(1, "ΟΔΟΣ''Α ΟΔΟΣ İstanbul the THE x it's 12.5 日本 ab_c"), (2, "plain words The plain")]
    df = spark.createDataFrame(docs, "id int, t string")
    for a in (Analyzer("standard"), Analyzer("standard", case="lower"), Analyzer("standard", case="upper"),
              Analyzer("standard", case="lower", stop_words="en", min_length=2), Analyzer("standard", case="lower", min_length=4, max_length=6)):
        arrays = df.select("id", F.explode(a.terms(F.col("t"))).alias("term"))
        together = lambda x: sorted((r.id, r.term) for r in x.collect())
        assert together(arrays) == together(text.term_rows(df, "t", a, ["id"]))
        assert sorted(set(together(arrays))) == together(text.terms_table(df, "t", a, ["id"]))
    got = {r.term for r in text.term_rows(df, "t", Analyzer("standard", case="lower"), ["id"]).collect()}
    assert {"日", "本", "it's", "12.5", "ab_c", "οδος"} <= got


def test_stems_of_batches(spark):
    df = spark.createDataFrame([("motoring",), ("motoring",), ("ponies",), (None,)], "term string")
    assert sorted(str(r.term) for r in text.with_stems(df).collect()) == ["None", "motor", "motor", "poni"]


def test_fold_equals_python_fold(spark):
    rng = random.Random(2)
    data = [(0 if rng.random() < 0.4 else rng.randrange(9), i, rng.choice([None, rng.randrange(100)])) for i in range(3000)]
    df = spark.createDataFrame(data, "g int, o int, x int").repartition(7)
    want = {}
    for g, _, x in data:
        want[g] = (want.get(g, 1) * 31 + x) % 1009 if x is not None else want.get(g, 1)
    fold = udf.fold_groups(df, ["g"], ["o"], ["x"], lambda s, x: (s * 31 + int(x)) % 1009, "bigint", initial=1)
    assert {r.g: r.value for r in fold.collect()} == want
    # in-order concatenation merges associatively and shows any mistake in the order
    joined = udf.fold_groups(df, ["g"], ["o"], ["x"], lambda s, x: s + f"{int(x)},", "string", initial="", merge=lambda a, b: a + b)
    text_of = {}
    for g, _, x in data:
        text_of[g] = text_of.get(g, "") + (f"{x}," if x is not None else "")
    assert {r.g: r.value for r in joined.collect()} == text_of


def test_null_policies(spark):
    df = spark.createDataFrame([(1, 2), (1, None)], "a int, b int")
    strict = udf.python_function(lambda a, b: a + b, "int")
    lenient = udf.python_function(lambda a, b: a + (b or 0), "int", udf.CALLED)
    assert [tuple(r) for r in df.select(strict("a", "b"), lenient("a", "b")).collect()] == [(3, 3), (None, 1)]
    udf.register_function(spark, "plus_one_cs", lambda a: a + 1, "int", replace=True)
    assert spark.sql("select plus_one_cs(cast(null as int)) a, plus_one_cs(4) b").first() == (None, 5)
    with pytest.raises(ValueError):
        udf.register_function(spark, "plus_one_cs", lambda a: a, "int")


def test_load_generator_is_no_query():
    from cellspark.plans import QUERIES

    assert "src11_generate" not in QUERIES and "src12_validate" in QUERIES

"""Snowball stems, alone and in the analyzer, and searches through n-grams."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from cellspark import TableSpec
from cellspark.functions import snowball
from cellspark.operators import index, text
from cellspark.operators.text import Analyzer

# published examples
PAIRS = {
    "en": "skies sky dying die news news consigned consign consignment consign consistency consist consolingly consol knightly knight "
          "knives knive generously generous communication communic hopping hop hoping hope relational relat happy happi by by cries cri ties tie "
          "gas gas this this kiwis kiwi generalizations general proceed proceed agreed agre controlling control o'neill's o'neil",
    "de": "aufeinander aufeinand aufeinanderfolgenden aufeinanderfolg kategorien kategori kategorisch kategor häuser haus käufers kauf "
          "auffälligkeit auffall freundlichkeit freundlich ergebnisse ergebnis straße strass",
    "es": "chicas chic chicharrones chicharron torneos torne toreado tor corriendo corr contemplaciones contempl rápidamente rapid habilidades habil",
    "fr": "continuait continu continuation continu continuellement continuel contradictoirement contradictoir majestueusement majestu "
          "maintenant mainten chevaux cheval quantité quantit mâchoire mâchoir",
}


@pytest.mark.parametrize("language", sorted(PAIRS))
def test_published_stems(language):
    words = PAIRS[language].split()
    assert {w: snowball.stem(w, language) for w in words[::2]} == dict(zip(words[::2], words[1::2]))
    for odd in ("", "a", "1", "éé", "中文", "x" * 300, "y", "yy", "s", "ss", "e'"):
        assert isinstance(snowball.stem(odd, language), str)


def test_documents_and_query_text_are_stemmed_alike(spark, rows):
    df = spark.createDataFrame([(1, "Motoring through hills"), (2, "he MOTORED"), (3, "a motor"), (4, "motion"), (5, None)], "doc_id long, text string")
    stemmed = Analyzer(case="lower", stem="en")
    hits = lambda pattern, **by: sorted(r.doc_id for r in text.search(df, "text", pattern, stemmed, **by).collect())
    assert hits("motors") == [1, 2, 3] and hits("mot%") == [1, 2, 3, 4] and hits("motors", negate=True) == [4, 5]
    spec = TableSpec(["doc_id"])
    built = index.term_index(df, "text", stemmed, spec)
    assert sorted(r.doc_id for r in index.lookup(built, index.like_predicate("motor"), spec).collect()) == [1, 2, 3]
    terms = text.term_rows(df, "text", stemmed, ["doc_id"])
    assert rows(terms.filter("doc_id = 1")) == [(1, "hill"), (1, "motor"), (1, "through")]
    with pytest.raises(ValueError):
        text.search(df, "text", "x", Analyzer(stem="xx"))


@pytest.mark.parametrize("pattern", ["%an%", "%anan%", "ban%", "%na", "banana", "%a%", "b%", "%é%", "%xyz%", "%üße%"])
def test_grams_find_what_a_search_finds(spark, pattern):
    words = "banana bandana an ana nana cabana banan émeraude süße süßer x ban na".split()
    df = spark.createDataFrame([(i, f"{w} {words[i * 5 % len(words)]}") for i, w in enumerate(words)], "doc_id long, text string")
    spec = TableSpec(["doc_id"])
    terms = index.term_index(df, "text", Analyzer(), spec)
    grams = index.gram_index(terms)
    found = {r.doc_id for r in index.gram_lookup(grams, terms, pattern, spec).collect()}
    assert found == {r.doc_id for r in text.search(df, "text", pattern, Analyzer()).collect()}
    # linear: no more postings than characters
    assert grams.count() <= terms.select("term").distinct().agg(F.sum(F.length("term"))).first()[0] + 0


def _counted(df, spark):
    """``df`` and a counter of its rows that were made."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    return df.mapInArrow(count, df.schema), seen


def _sorted_files(path, columns):
    files = sorted(glob.glob(f"{path}/*.parquet"))
    for file in files:
        held = [tuple(r.values()) for r in pq.read_table(file, columns=columns).to_pylist()]
        assert held == sorted(held, key=lambda r: [x.encode() if isinstance(x, str) else x for x in r])
    return len(files)


def test_a_stored_index_is_made_once(spark, tmp_path):
    # "w" is in every text: its rows lie in several files
    df = spark.range(400).repartition(4).select(F.col("id").alias("doc_id"), F.concat(F.lit("W é"), F.col("id") % 50, F.lit(" ontic"), F.col("id") % 7).alias("text"))
    spec, path = TableSpec(["doc_id"]), str(tmp_path / "terms")
    made, seen = _counted(df, spark)
    index.write_index(index.term_index(made, "text", Analyzer(case="lower"), spec), path, "term")
    assert seen.value == 400
    assert _sorted_files(path, ["term", "doc_id"]) > 1
    stored = spark.read.parquet(path)
    assert stored.count() == 1200 and stored.filter("term = 'w'").count() == 400
    keys = lambda pattern: sorted(r.doc_id for r in index.lookup(stored, index.like_predicate(pattern), spec).collect())
    assert keys("ontic3%") == [i for i in range(400) if i % 7 == 3] and keys("é49") == list(range(49, 400, 50))


def test_stored_grams_are_made_once(spark, tmp_path):
    words = "banana bandana ananas nana cabana banan émeraude süße süßer ban".split()
    df = spark.createDataFrame([(i, words[i % 10], f"{words[i % 10]}{i}") for i in range(300)], "doc_id long, w string, term string")
    spec, path = TableSpec(["doc_id"]), str(tmp_path / "grams")
    terms = df.select("doc_id", "term")
    # the postings pass through the counter on their way to the files
    made, seen = _counted(index.gram_index(terms), spark)
    index.write_index(made, path, "gram")
    stored = spark.read.parquet(path)
    assert seen.value == stored.count() == index.gram_index(terms).count()
    assert _sorted_files(path, ["gram", "term"])
    for pattern, inside in (("%ana%", "ana"), ("%üße%", "üße"), ("%a2%", "a2")):
        found = {r.doc_id for r in index.gram_lookup(stored, terms, pattern, spec).collect()}
        assert found == {i for i in range(300) if inside in f"{words[i % 10]}{i}"}


def test_stored_grams_are_sorted_by_one_number(spark, tmp_path):
    words = "banana ana é süße süßer x 中 中文字 😀😀 𝐀b ﬀx ban a1 zz_9 ￮￮".split()
    terms = spark.createDataFrame([(i, words[i % 15]) for i in range(60)], "doc_id long, term string").repartition(3)
    spec, path = TableSpec(["doc_id"]), str(tmp_path / "grams")
    grams = index.gram_index(terms)
    index.write_index(grams, path, "gram", only_leading=True)
    stored = spark.read.parquet(path)
    assert _sorted_files(path, ["gram"]) and sorted(map(tuple, stored.collect())) == sorted(map(tuple, grams.collect()))
    for pattern, inside in (("%ana%", "ana"), ("%üße%", "üße"), ("%文字%", "文字"), ("%a%", "a")):
        found = {r.doc_id for r in index.gram_lookup(stored, terms, pattern, spec).collect()}
        assert found == {i for i in range(60) if inside in words[i % 15]}
    # the number has the order of the first three characters, also beyond 16 bits, and of missing ones
    texts = words + ["", "a", "ab", "abc", "abd", "abcz"]
    rows = spark.createDataFrame([(w,) for w in texts], "w string").select("w", index.leading(F.col("w")).alias("n")).collect()
    assert all((a.n < b.n) == (a.w[:3] < b.w[:3]) and (a.n == b.n) == (a.w[:3] == b.w[:3]) for a in rows for b in rows)

"""Text analysis, search and index queries."""

from pyspark.sql import functions as F

from cellspark.operators import index, text
from cellspark.operators.text import Analyzer
from cellspark.plans.predicate_queries import users
from cellspark.plans.registry import DOCS, query
from cellspark.session import fresh_path
from cellspark.spec import TableSpec

STANDARD = Analyzer("standard", case="lower")
ENGLISH = Analyzer("standard", case="lower", stop_words="en", min_length=2)

_WORD_SQL = text.WORD.replace("'", "''")
_TERMS = f"list_transform(regexp_extract_all(text, '{_WORD_SQL}'), lambda x: lower(x))"
_STOPS = ", ".join(f"'{w}'" for w in text.STOP_WORDS["en"].split())


@query("x1_standard_terms", f"""
WITH d AS (SELECT doc_id, unnest(regexp_extract_all(text, '{_WORD_SQL}')) AS term FROM documents)
SELECT doc_id, term, count(*) AS n FROM d WHERE length(term) BETWEEN 3 AND 20 GROUP BY doc_id, term""")
def standard_terms(t):
    rows = text.term_rows(t.documents, "text", Analyzer("standard", min_length=3, max_length=20), ["doc_id"])
    return rows.groupBy("doc_id", "term").agg(
        F.count(F.lit(1)).alias("n"))


@query("x2_whole_value", "SELECT p_partkey, lower(p_name) AS low, upper(p_name) AS up FROM part")
def whole_value(t):
    one = lambda case: F.element_at(Analyzer("whole", case=case).terms(F.col("p_name")), 1)
    return t.part.select("p_partkey", one("lower").alias("low"), one("upper").alias("up"))


@query("x3_delimiter", """
SELECT doc_id, term, count(*) AS n FROM (SELECT doc_id, unnest(string_split(text, '|')) AS term FROM documents)
WHERE term <> '' GROUP BY doc_id, term""")
def delimiter(t):
    terms = Analyzer("delimiter", delimiter="|").terms(F.col("text"))
    return t.documents.select("doc_id", F.explode(terms).alias("term")).groupBy("doc_id", "term").agg(
        F.count(F.lit(1)).alias("n"))


@query("x4_no_analysis", "SELECT p_partkey, p_name AS term FROM part")
def no_analysis(t):
    return text.terms_table(t.part, "p_name", Analyzer("none"), ["p_partkey"])


@query("x5_filters", f"""
WITH d AS (SELECT doc_id, unnest({_TERMS}) AS term FROM documents)
SELECT term, count(*) AS n, count(DISTINCT doc_id) AS docs FROM d WHERE length(term) >= 2 AND term NOT IN ({_STOPS}) GROUP BY term""")
def filters(t):
    d = text.term_rows(t.documents, "text", ENGLISH, ["doc_id"])
    # two steps of partial aggregation instead of a distinct count: a very common term stays spread
    per_doc = d.groupBy("term", "doc_id").agg(F.count(F.lit(1)).alias("c"))
    return per_doc.groupBy("term").agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("docs"))


@query("x5_stems")
def stems(t):
    # counted per term before stemming, so each distinct term reaches Python once
    counts = text.terms_table(t.documents, "text", ENGLISH, ["doc_id"]).groupBy("term").agg(
        F.count(F.lit(1)).alias("n"))
    return text.with_stems(counts).groupBy("term").agg(F.sum("n").alias("n"))


@query("x6_search_prefix", f"""
SELECT doc_id FROM documents WHERE len(list_filter({_TERMS}, lambda x: starts_with(x, 'onti'))) > 0""")
def search_prefix(t):
    return text.search(t.documents, "text", "Onti%", STANDARD).select("doc_id")


@query("x6_search_contains", f"""
SELECT doc_id FROM documents WHERE len(list_filter({_TERMS}, lambda x: contains(x, 'thenn') OR contains(x, 'ould'))) > 0""")
def search_contains(t):
    return text.search(t.documents, "text", "%thenn ould%", STANDARD).select("doc_id")


@query("x6_search_terms", f"""
SELECT doc_id FROM documents WHERE len(list_filter({_TERMS}, lambda x: x = 'that')) > 0
   AND len(list_filter({_TERMS}, lambda x: ends_with(x, 'ing'))) > 0
   AND NOT len(list_filter({_TERMS}, lambda x: x = 'worthless')) > 0""")
def search_terms(t):
    where = text.matches_all("text", [("that", False), ("%ing", False), ("worthless", True)], STANDARD)
    return t.documents.filter(where).select("doc_id")


@query("x6_search_pages", "SELECT page_id FROM pages WHERE contains(html, 'track(1')")
def search_pages(t):
    return text.search(t.pages, "html", "%track(1%", Analyzer("whole")).select("page_id")


@query("x7_numeric_range", "SELECT doc_id, n_chars FROM documents WHERE n_chars > 500 AND n_chars <= 4000")
def numeric_range(t):
    where = index.numeric_range("n_chars", 500, 4000, lower_inclusive=False)
    return t.documents.filter(where).select("doc_id", "n_chars")


@query("x8_term_index", f"""
SELECT DISTINCT doc_id, unnest({_TERMS}) AS term FROM documents""")
def term_index(t):
    return index.term_index(t.documents, "text", STANDARD, DOCS)


@query("x8_index_lookup", f"""
SELECT doc_id, n_chars FROM documents WHERE len(list_filter({_TERMS}, lambda x: starts_with(x, 'onti'))) > 0""")
def index_lookup(t):
    path = fresh_path(t.spark, "terms")
    index.write_index(index.term_index(t.documents, "text", STANDARD, DOCS), path, "term")
    keys = index.lookup(t.spark.read.parquet(path), index.like_predicate("onti%"), DOCS)
    return index.fetch(t.documents.select("doc_id", "n_chars"), keys, DOCS)


@query("x8_suffix_index", """
SELECT p_partkey, p_name FROM part WHERE contains(p_name, 'dge')""")
def suffix_index(t):
    spec = TableSpec(["p_partkey"])
    built = index.term_index(t.part, "p_name", Analyzer("standard"), spec, mode="contains")
    keys = index.lookup(built, index.like_predicate("%dge%", "contains"), spec)
    return index.fetch(t.part.select("p_partkey", "p_name"), keys, spec)


def _gram_search(t, table, column, spec, pattern, analyzer):
    terms, grams = (fresh_path(t.spark, x) for x in ("terms", "grams"))
    index.write_index(index.term_index(table, column, analyzer, spec), terms, "term")
    terms = t.spark.read.parquet(terms)
    index.write_index(index.gram_index(terms), grams, "gram", only_leading=True)
    return index.gram_lookup(t.spark.read.parquet(grams), terms, pattern, spec)


@query("x8_gram_index", """
SELECT p_partkey, p_name FROM part WHERE contains(p_name, 'dge')""")
def gram_index(t):
    spec = TableSpec(["p_partkey"])
    return index.fetch(t.part.select("p_partkey", "p_name"), _gram_search(t, t.part, "p_name", spec, "%dge%", Analyzer("standard")), spec)


@query("x8_gram_documents", f"""
SELECT doc_id, lang FROM documents WHERE len(list_filter({_TERMS}, lambda x: contains(x, 'ent'))) > 0""")
def gram_documents(t):
    # terms of four languages; postings grow with the distinct terms' characters
    return index.fetch(t.documents.select("doc_id", "lang"), _gram_search(t, t.documents, "text", DOCS, "%ent%", STANDARD), DOCS)


@query("x9_value_index", """
SELECT o_custkey, o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'""")
def value_index(t):
    spec = TableSpec(["o_custkey"], ["o_orderkey"])
    built = index.value_index(t.orders, "o_orderpriority", spec)
    keys = index.lookup(built, F.col("value") == "1-URGENT", spec)
    # the index says nothing about the status: the row itself is checked again
    return index.fetch(t.orders.select("o_custkey", "o_orderkey", "o_orderpriority", "o_orderstatus"), keys, spec,
                       recheck=F.col("o_orderstatus") == "F").drop("o_orderstatus")


@query("x9_collection_index", """
WITH u AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY user_id, event_type)
SELECT 'value' AS kind, user_id, event_type AS hit FROM u
UNION ALL SELECT 'key', user_id, event_type FROM u
UNION ALL SELECT 'entry', user_id, event_type || '=' || n FROM u""")
def collection_index(t):
    rows = users(t)
    spec = TableSpec(["user_id"])
    values = index.value_index(rows, "kinds", spec, "values").select(F.lit("value").alias("kind"), "user_id", F.col("value").alias("hit"))
    keys = index.value_index(rows, "counts", spec, "keys").select(F.lit("key").alias("kind"), "user_id", F.col("value").alias("hit"))
    entries = index.value_index(rows, "counts", spec, "entries").select(
        F.lit("entry").alias("kind"), "user_id",
        F.concat_ws("=", F.col("value.key"), F.col("value.value").cast("string")).alias("hit"))
    return values.unionByName(keys).unionByName(entries)


@query("src3_word_count", """
SELECT word, count(*) AS n FROM (SELECT unnest(regexp_split_to_array(text, '\\s+')) AS word FROM documents)
WHERE word <> '' GROUP BY word""")
def word_count(t):
    return text.word_count(t.documents, "text")


@query("src3_total_count", """
SELECT count(*)::BIGINT AS total FROM (SELECT unnest(regexp_split_to_array(text, '\\s+')) AS word FROM documents) WHERE word <> ''""")
def total_count(t):
    return text.total_count(text.word_count(t.documents, "text"))

"""The registered queries of this folder: each applies its operator, with production parameters, to a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellspark.llm import bpe, langid, merkle, minhash, neighbours, packing, passages, pii, quality, secrets, simhash, whitening, wordpiece
from cellspark.llm.common import count_kind, spans_text, table, tokenizer_file, whole


def op1_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), tokenizer_file("word_bpe_49k.json"))


def op2_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    network = langid.train(docs.filter(~langid.held_out(F.col("doc_id")) & F.col("doc_id").isNotNull()))
    out = langid.predict(docs.drop("lang"), network)
    return out.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op3_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = wordpiece.count_tokens(whole(table(spark, folder, "documents")), tokenizer_file("byte_bpe_50k.json"))
    return docs.select("doc_id", "n_words", "n_tokens", "n_unknown")


def op4_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find(table(spark, folder, "documents"), **pii.WHOLE)
    counts = [count_kind(F.col("base"), k).alias(f"n_{k}") for k in pii.KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(spans_text(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        spans_text(F.col("spans")).alias("spans"))


def op5_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest(table(spark, folder, "embeddings"))


def op6_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cut = passages.remove_repeats(table(spark, folder, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op7_line_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge(table(spark, folder, "documents"))


def op8_bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    docs = bpe.encode(whole(table(spark, folder, "documents")), tokenizer_file("byte_bpe_50k.json"), decoded="decoded")
    return docs.select(
        "doc_id", F.floor(F.length("ids") / 4).alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op9_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, folder, "documents"))


def op10_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.scan(whole(table(spark, folder, "documents"))).drop("text")
    base = F.filter("secrets", lambda s: s["place"] < len(secrets.BASE))
    counts = [count_kind(F.col("secrets"), r.kind).alias(f"n_{r.kind}") for r in secrets.BASE]
    return found.select(
        "doc_id", *counts, F.sha2(spans_text(base).cast("binary"), 256).alias("base_sha256"),
        spans_text(F.col("secrets")).alias("spans"))


def op11_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    found = whitening.whiten(table(spark, folder, "embeddings"))
    return found.withColumn("deviation", F.expr("try_cast(deviation AS BIGINT)"))


def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.manifest(table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_packing, op2_language_id, op3_token_counts, op4_pii, op5_neighbours, op6_suffix_dedup, op7_line_quality,
        op8_bpe_round_trip, op9_minhash, op10_secret_scan, op11_simhash, op12_whitening, op13_merkle_manifest)
}

def _field(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen({value}::VARCHAR) || ':' || {value} END"


def _leaf(n_chars: str) -> str:
    return f"sha256({' || '.join(map(_field, ('doc_id', 'source', 'lang', n_chars, 'text')))})"


_CRC32 = """xor(list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT), lambda crc, byte: list_reduce(
    [xor(crc, byte), 1, 2, 3, 4, 5, 6, 7, 8], lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END),
    4294967295::BIGINT), 4294967295)"""

_MERKLE_SQL = f"""
WITH RECURSIVE base AS (
  SELECT row_number() OVER () AS row, doc_id, CASE WHEN lang IS NULL THEN '-' ELSE '=' || lang END AS tree, {_leaf('n_chars')} AS leaf,
    CASE WHEN {_CRC32} % 7 = 0 THEN {_leaf('(n_chars + 1)')} ELSE {_leaf('n_chars')} END AS start FROM documents),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY tree) AS n FROM base),
nodes AS (
  SELECT tree, 0 AS level, idx, n, leaf AS h FROM placed
  UNION ALL
  SELECT tree, level + 1, idx // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY idx)) FROM nodes WHERE n > 1 GROUP BY tree, level, idx // 2, n),
tops AS (SELECT tree, h, row_number() OVER (ORDER BY tree) - 1 AS idx, count(*) OVER () AS n FROM nodes WHERE n = 1),
above AS (
  SELECT 0 AS level, idx, n, h FROM tops
  UNION ALL
  SELECT level + 1, idx // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY idx)) FROM above WHERE n > 1 GROUP BY level, idx // 2, n),
climb AS (
  SELECT row, doc_id, leaf, tree, 0 AS level, idx, n, start AS h, '' AS proof FROM placed
  UNION ALL
  SELECT row, doc_id, leaf, c.tree, c.level + 1, c.idx // 2, (c.n + 1) // 2,
    sha256(CASE WHEN c.idx % 2 = 1 THEN s.h || c.h ELSE c.h || coalesce(s.h, '') END), proof || coalesce(s.h, '')
  FROM climb c LEFT JOIN nodes s ON s.tree = c.tree AND s.level = c.level AND s.idx = xor(c.idx, 1) WHERE c.n > 1),
climb_above AS (
  SELECT row, doc_id, leaf, t.h AS subroot, 0 AS level, t.idx, t.n, c.h, proof FROM climb c JOIN tops t ON c.n = 1 AND c.tree = t.tree
  UNION ALL
  SELECT row, doc_id, leaf, subroot, c.level + 1, c.idx // 2, (c.n + 1) // 2,
    sha256(CASE WHEN c.idx % 2 = 1 THEN s.h || c.h ELSE c.h || coalesce(s.h, '') END), proof || coalesce(s.h, '')
  FROM climb_above c LEFT JOIN above s ON s.level = c.level AND s.idx = xor(c.idx, 1) WHERE c.n > 1)
SELECT doc_id, leaf, subroot, r.h AS root, sha256(proof) AS proof_sha256, c.h AS folded_root, c.h = r.h AS verified
FROM climb_above c, (SELECT h FROM above WHERE n = 1) r WHERE c.n = 1"""

#: SQL for the same rows, where SQL can give them over whole tables in reasonable time.
ORACLE: dict[str, str] = {"op13_merkle_manifest": _MERKLE_SQL}

"""Queries of the llm subpackage: one thin ``opN_*`` per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontaminate, html_extract, lang_id, parity_join, quality, secret_scan, sharding, topk, toxicity


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_text_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_pages(_read(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op2_parity_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parity_join.classes(_read(spark, sf_dir, "documents"), parity_join.Link(words=4, p=85, q=100))


def op3_weak_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(_read(spark, sf_dir, "documents"))


def op4_norm_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _read(spark, sf_dir, "embeddings")
    return topk.search(table, table.where(F.col("vec_id") % 100 == 0), k=10)


def op5_secret_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.scan(_read(spark, sf_dir, "documents")))


def op6_hash_tree_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_read(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard", "region", "rack"
    )


def op7_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str, vocabulary: str = "byte_bpe_50k.tiktoken") -> DataFrame:
    import public_tokenizers

    path, pattern = public_tokenizers.path(vocabulary), public_tokenizers.PATTERN
    return bpe.encode(_read(spark, sf_dir, "documents"), path, pattern, digests=True)


def op9_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lang_id.identify(_read(spark, sf_dir, "documents"))


def op10_weak_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_text_density,
        op2_parity_sketch,
        op3_weak_quality,
        op4_norm_buckets,
        op5_secret_automaton,
        op6_hash_tree_sharding,
        op7_templates,
        op8_byte_bpe,
        op9_byte_cnn,
        op10_weak_toxicity,
    )
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    """For the operators that SQL can express: all pairs, so only for small tables."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return {
        "op2_parity_sketch": rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
  ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * i >= 85 * (nx.n + ny.n - i)),
r(x, y) AS (SELECT x, y FROM l UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x),
m AS (SELECT x, min(y) AS y FROM r GROUP BY x)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(m.y, d.doc_id)) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN m ON m.x = d.doc_id""",
        "op4_norm_buckets": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 1024)) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id, list_dot_product(a.q, b.q)::BIGINT AS score FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0)
SELECT query_id, rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s) WHERE rank <= 10""",
    }

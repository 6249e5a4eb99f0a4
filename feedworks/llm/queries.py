"""One query per operator of this package over its whole table, and SQL where SQL can
express it.  Queries take (spark, folder of the tables)."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import balltree, bpe, chunks, embed_dedup, katz, mixing, pieces, prefix_trie, quality, secrets, simhash, spelling, suffix


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score_texts(_table(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op4_balltree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balltree.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(_table(spark, sf_dir, "documents"),
                                public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op6_embed_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_vectors(_table(spark, sf_dir, "embeddings"))


def op7_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.remove_repeats(_table(spark, sf_dir, "documents"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(_table(spark, sf_dir, "documents"))


def op9_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.dedup_chunks(_table(spark, sf_dir, "documents"), **chunks.PASSAGES)


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"), weights=mixing.WEIGHTS)


def op11_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_pieces(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(_table(spark, sf_dir, "conversations"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_quality, op2_katz, op3_simhash, op4_balltree, op5_bpe, op6_embed_dedup,
                                   op7_suffix, op8_secrets, op9_chunks, op10_mixing, op11_pieces, op12_prefix_trie,
                                   op13_spelling)}

# Vectors that are null or hold null or non-finite components take no part.
_WHOLE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"
OP4_SQL = f"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q FROM embeddings WHERE {_WHOLE}),
scores AS (SELECT a.vec_id AS query_id, b.vec_id, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
    FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scores)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5"""
OP6_SQL = f"""
WITH RECURSIVE v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS x FROM embeddings WHERE {_WHOLE}
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.x, b.x) >= 0.95),
reach AS (SELECT vec_id, vec_id AS root FROM embeddings UNION SELECT l.a, r.root FROM links l JOIN reach r ON l.b = r.vec_id),
least AS (SELECT vec_id, min(root) AS component_id FROM reach GROUP BY vec_id),
counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN least USING (vec_id) LEFT JOIN counts USING (vec_id)"""

ORACLE: dict[str, str] = {"op4_balltree": OP4_SQL, "op6_embed_dedup": OP6_SQL, "op10_mixing": mixing.oracle_sql()}

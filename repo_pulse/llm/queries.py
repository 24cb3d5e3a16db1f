"""The operators on their whole tables, with the columns their contracts name."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repo_pulse.llm import (
    bloom_lm,
    compact_windows,
    digest_runs,
    hilbert_zones,
    packing,
    pii,
    posting_lists,
    projection_forest,
    quality_knn,
    role_repair,
    simhash,
    token_files,
    transducer_bpe,
)
from repo_pulse.llm import oracles
from repo_pulse.llm.scratch import new_path, table

WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
QUALITY_FROM = 0.7
BYTE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, written as Parquet and read back."""
    path = new_path(spark, "token-files")
    token_files.write(table(spark, sf_dir, "documents"), path, WORD_TOKENIZER, end_id=1)
    return token_files.digests(spark, path)


def op1_pii_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data and disclosing terms in every document."""
    return pii.report(table(spark, sf_dir, "documents"))


def op2_projection_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector."""
    return projection_forest.near_duplicates(table(spark, sf_dir, "embeddings"), least=0.9)


def op3_compact_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated passages and component of every document."""
    return compact_windows.report(table(spark, sf_dir, "documents"))


def op4_quality_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    scored = quality_knn.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.withColumn("predicted", (F.col("score") >= QUALITY_FROM).cast("int"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle_words=3, max_bits=2)


def op7_transducer_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded with the corpus's own lexicon."""
    docs = table(spark, sf_dir, "documents")
    lexicon = transducer_bpe.build_lexicon(docs, WORD_TOKENIZER)
    return transducer_bpe.digests(docs, WORD_TOKENIZER, lexicon)


def op8_posting_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors of every hundredth one."""
    vectors = table(spark, sf_dir, "embeddings")
    return posting_lists.search(vectors, every=100, neighbours=10)


def op9_bloom_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram and model score of every document."""
    return bloom_lm.score(table(spark, sf_dir, "documents"))


def op10_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document packed into sequences of 1024 tokens."""
    docs = table(spark, sf_dir, "documents")
    return packing.pack(docs, BYTE_TOKENIZER, end_id=0, with_ids=False)


def op11_hilbert_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster and distance of every vector after five rounds over 40 centroids."""
    return hilbert_zones.report(table(spark, sf_dir, "embeddings"))


def op12_role_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every conversation, damaged as the contract says."""
    return role_repair.report(role_repair.damaged(table(spark, sf_dir, "conversations")))


def op13_digest_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The row that stays for every document."""
    return digest_runs.duplicates(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_pii_disclosure": op1_pii_disclosure,
    "op2_projection_forest": op2_projection_forest,
    "op3_compact_windows": op3_compact_windows,
    "op4_quality_knn": op4_quality_knn,
    "op5_simhash": op5_simhash,
    "op7_transducer_bpe": op7_transducer_bpe,
    "op6_token_files": op6_token_files,
    "op8_posting_lists": op8_posting_lists,
    "op9_bloom_lm": op9_bloom_lm,
    "op10_vector_packing": op10_vector_packing,
    "op11_hilbert_zones": op11_hilbert_zones,
    "op12_role_repair": op12_role_repair,
    "op13_digest_runs": op13_digest_runs,
}

# The other operators hash, tokenize, learn or approximate in ways SQL has no words for; tests
# compare them with brute force.
ORACLES: dict[str, str] = {
    "op11_hilbert_zones": oracles.CLUSTERS,
    "op12_role_repair": oracles.CONVERSATIONS,
    "op13_digest_runs": oracles.DUPLICATES,
    "op2_projection_forest": """WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.9
),
reach AS (
  SELECT vec_id AS a, vec_id AS b FROM v
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
)
SELECT r.vec_id, CAST(coalesce(n.n_links, 0) AS BIGINT) AS n_links, r.component_id,
       r.vec_id = r.component_id AS kept
FROM (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a) r
LEFT JOIN (SELECT a, count(*) AS n_links FROM links GROUP BY a) n ON n.a = r.vec_id""",
}

"""The operators over the given tables, one query each: (session, data directory) to DataFrame."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.llm import crf, ppm, quality
from eventlake.llm.alignment import align_documents
from eventlake.llm.bpe import token_digests
from eventlake.llm.decontaminate import leaked_documents
from eventlake.llm.minhash import similar_documents
from eventlake.llm.packing import pack_documents, resets
from eventlake.llm.paragraphs import without_repeats
from eventlake.llm.passages import without_passages
from eventlake.llm.secrets import BASE_KINDS, count_of, find_secrets, joined
from eventlake.llm.sharding import shard_documents, shard_sql
from eventlake.llm.tables import alone, in_fold, table, written
from eventlake.llm.topk import NEAREST_SQL, nearest
from eventlake.llm.whitening import fit as fit_whitening
from eventlake.llm.whitening import whiten

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
BYTE_LEVEL, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SHARDS = 24
TOXIC_FROM = 0.3


def op1_paragraph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the paragraphs and passages that come earlier in the table, and which were removed.

    removed: numbers of the lines taken out; passages: bytes cut out of what they left.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    lines = alone(lambda: written(without_repeats(docs, removed_column="removed"), "lines-once"))
    return without_passages(lines, "passages")


def op2_ppm_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of all documents, learnt from four fifths of them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = in_fold("doc_id", 5, 0)
    model = ppm.fit(ppm.training_rows(docs, ~held_out))
    return ppm.identify(docs.withColumn("held_out", held_out), model, keep=["doc_id", "held_out"])


def op3_crf_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of all documents, learnt from three quarters of the labelled ones."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = in_fold("doc_id", 4, 2)
    model = crf.fit(docs, table(spark, sf_dir, "labels"), ~held_out)
    scored = crf.score_toxicity(docs.withColumn("held_out", held_out), model, keep=["doc_id", "held_out"])
    return scored.select("doc_id", "held_out", "score", F.when(F.col("score") >= TOXIC_FROM, 1).otherwise(0).alias("predicted"), "spans")


def op4_rendezvous_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of equal weight."""
    return shard_documents(table(spark, sf_dir, "documents"), SHARDS)


def op5_spaced_seed_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a passage of a benchmark item, with the item and the place."""
    return leaked_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return similar_documents(table(spark, sf_dir, "documents"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' token ids in packed rows of 2,048, with segment lengths and position resets."""
    return pack_documents(table(spark, sf_dir, "documents"), RANKS, PATTERN).withColumn("resets", resets(F.col("cu_seqlens")))


def op8_branch_and_bound_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every fiftieth vector."""
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of all documents, encoded and decoded."""
    return token_digests(table(spark, sf_dir, "documents"), RANKS, PATTERN)


def op10_weak_label_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of all documents, learnt from heuristics alone."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.score_quality(docs, quality.fit(docs))
    return scored.withColumn("kept", F.col("score") >= 0.5)


def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' tokens of two tokenizers, aligned by bytes, and how common their links are in the corpus."""
    return align_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), BYTE_LEVEL, PIECES)


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings on the four leading whitened directions of the distinct ones."""
    embeddings = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return whiten(embeddings, fit_whitening(embeddings))


def op13_entropy_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The secrets of all documents: counts and digest of the known shapes, and all spans."""
    found = find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    return found.select("doc_id", *[count_of(base, kind).alias(f"n_{kind}") for kind in BASE_KINDS], F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


QUERIES = {
    "op1_paragraph_dedup": op1_paragraph_dedup,
    "op2_ppm_language_id": op2_ppm_language_id,
    "op3_crf_toxicity": op3_crf_toxicity,
    "op4_rendezvous_sharding": op4_rendezvous_sharding,
    "op5_spaced_seed_decontamination": op5_spaced_seed_decontamination,
    "op6_minhash_near_dedup": op6_minhash_near_dedup,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_branch_and_bound_top_k": op8_branch_and_bound_top_k,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_weak_label_quality": op10_weak_label_quality,
    "op11_tokenizer_alignment": op11_tokenizer_alignment,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_entropy_secrets": op13_entropy_secrets,
}
ORACLES: dict[str, str] = {
    "op4_rendezvous_sharding": shard_sql(SHARDS),
    "op8_branch_and_bound_top_k": NEAREST_SQL,
}

"""One registered query per operator: production parameters over the whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import host_reputation, merkle_audit, minhash_dedup, mixing, ngram_join, packing, periodic_runs, quality_rules, sanitise
from . import stream_dedup, suffix_dedup, toxicity, whitening
from .common import table


def op6_merkle_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as archive files, audited against a replica with deterministic damage."""
    records = merkle_audit.warc_records(table(spark, sf_dir, "pages"))
    replica = merkle_audit.damaged(records)
    height = merkle_audit.tree_height(records.select("ordinal"))
    return merkle_audit.audit(merkle_audit.build_tree(records, height), merkle_audit.build_tree(replica, height))


def op7_stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = stream_dedup.dedup_verdicts(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_verdicts(table(spark, sf_dir, "documents"))


def op10_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = host_reputation.judge_pages(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))
    return out.select("page_id", "host", "path", "rule", "verdict")


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link_components(table(spark, sf_dir, "documents"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("rank")


def op3_sanitise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sanitise.span_report(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_documents(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def tokenizer_path() -> str:
    """The production vocabulary file, as installed on every node."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.run_report(periodic_runs.planted(table(spark, sf_dir, "documents")))


def op12_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_ngram_join": op1_ngram_join,
    "op2_mixing": op2_mixing,
    "op3_sanitise": op3_sanitise,
    "op4_toxicity": op4_toxicity,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_merkle_audit": op6_merkle_audit,
    "op7_stream_dedup": op7_stream_dedup,
    "op8_quality_rules": op8_quality_rules,
    "op9_packing": op9_packing,
    "op10_host_reputation": op10_host_reputation,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_minhash_dedup": op12_minhash_dedup,
    "op13_embedding_whitening": op13_embedding_whitening,
}

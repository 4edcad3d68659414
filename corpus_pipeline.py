"""Corpus pipeline: quality rules, exact dedup, n-gram Jaccard join, mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on everything its predecessor kept; all but the
last return the columns of ``documents``, the last one row per packed piece. A stage joins its decisions back by the
row's place in the files it reads, and discards what its predecessor staged, so only one stage's data is on disk.
Nulls, empty texts, repeated rows and identifiers, clashing columns and empty tables follow the operators' definitions. Tokens, Newton steps
and multivariate estimates have no SQL form, so ORACLE_SQL is None and the tests hold every stage
against a brute-force version.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from paperweave.llm import mixing, ngram_join, packing, quality_rules, stream_dedup
from paperweave.llm.queries import tokenizer_path
from paperweave.session import discard, stage, staged_paths

ORACLE_SQL = None


# folders that the latest stage has staged, by application
_spent: dict[str, list[str]] = {}


def _stage_of(operator):
    """A stage that first discards what its predecessor staged: its documents have been written since."""

    @wraps(operator)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        app = spark.sparkContext.applicationId
        discard(spark, _spent.pop(app, []), docs)
        with staged_paths() as paths:
            out = operator(spark, docs, sf_dir)
        _spent[app] = paths
        return out

    return run_stage


@_stage_of
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.keep_good(docs)


@_stage_of
def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each set of equal texts."""
    return stream_dedup.drop_copies(docs)


@_stage_of
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of the n-gram Jaccard join."""
    return ngram_join.keep_one(docs)


@_stage_of
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.mixed_documents(docs)


@_stage_of
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as pieces of 2048-token sequences."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("quality_rules", quality),
    ("exact_dedup", exact_dedup),
    ("ngram_jaccard", near_duplicates),
    ("mixing", mix),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    written: list[str] = []
    for name, step in STAGES[:-1]:
        result = step(spark, docs, sf_dir)
        with staged_paths() as paths:
            docs = stage(result, name)
        discard(spark, written)  # the documents that this stage has read
        written = paths
    return STAGES[-1][1](spark, docs, sf_dir)

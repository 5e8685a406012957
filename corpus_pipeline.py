"""Corpus pipeline: quality rules, near copies, benchmark passages, secrets, token ids.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; it is
written as Parquet and read again as the next one's ``docs``. All but the last
return the columns of ``documents``. A stage called alone bounds the batches
that reach Python, too.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hopscope.llm import bpe, decontaminate, near_copies, rules, secrets
from hopscope.llm.queries import tokenizer_path
from hopscope.session import bound_batches
from hopscope.sources.staging import stage


def bounded(step):
    return functools.wraps(step)(lambda spark, docs, sf_dir: step(bound_batches(spark), docs, sf_dir))


@bounded
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the rules, or whose host does, go."""
    return rules.keep_good(docs)


@bounded
def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies the document of the least id stays."""
    return near_copies.keep_one(docs)


@bounded
def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@bounded
def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; every document stays."""
    return secrets.redact(docs)


@bounded
def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in place of the text, with a digest of the text that the ids decode to."""
    coded = bpe.round_trip(docs, tokenizer_path(), decoded="decoded_sha256", carry=["doc_id", "lang", "source"])
    return coded.select(
        "doc_id", "lang", "source", "ids", F.size("ids").cast("long").alias("n_tokens"), F.sha2("decoded_sha256", 256).alias("decoded_sha256")
    )


STAGES = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scans", secret_scans),
    ("bpe_encoding", bpe_encoding),
]

# Near-copy classes and token ids can't be told in SQL; the tests hold every
# stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

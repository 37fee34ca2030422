"""Corpus preparation in five stages; each stage's rows are written as Parquet and reread as the next stage's documents.

language: documents without a recognised language go. near_dedup: of documents with a Jaccard similarity of 0.8 or more over
five-word shingles the one with the smallest id stays; they meet by SimHash, first of all by the pigeonhole, and are then compared. decontaminate: documents with a benchmark window go. secrets: documents
with a secret go. tokens: what is left is encoded, and the decoded text's digest shows that nothing was lost.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from voltfleet.llm import bpe_codec, common, decontaminate, language, secrets, simhash


def recognise_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.recognised(docs, language.learn_profiles(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean_documents(docs, common.read(spark, sf_dir, "benchmark"))


def drop_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.clean_documents(docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe_codec.encode_documents(docs, public_tokenizers.path(bpe_codec.VOCABULARY), outputs=("ids", "decoded_sha256"))


STAGES = [
    ("language", recognise_language),
    ("near_dedup", drop_near_duplicates),
    ("decontaminate", drop_benchmark_leaks),
    ("secrets", drop_secrets),
    ("tokens", encode_tokens),
]

#: SimHash, language ranks and token ids have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what lies between two of them is written to the shared folder."""
    folder = f"{common.shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = common.read(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{k}")
            docs = spark.read.parquet(f"{folder}/{k}")
    return docs

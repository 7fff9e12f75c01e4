"""From raw documents to token ids: low quality, near copies, benchmark passages and secrets leave.

Each stage takes (spark, docs, sf_dir), works on all rows that the stage before it kept, and returns a
frame that is written as Parquet and read again. All but the last keep the columns of ``documents``.
SQL cannot express the stages, so there is no ``ORACLE_SQL``; tests compare them with plain versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from voltide.llm import bpe, decontaminate, jaccard, quality, secrets
from voltide.llm.common import table, written


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled ones, does not reject."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies (five-word shingles, similarity of 0.75 or more)."""
    return jaccard.one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mark."""
    return secrets.redact(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, and the digest of the text that the ids decode to."""
    import public_tokenizers

    return bpe.encode_ids(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", good_quality),
    ("n-gram Jaccard join", one_of_near_copies),
    ("benchmark decontamination", without_benchmark),
    ("secret scans", without_secrets),
    ("BPE encoding and decoding", token_ids),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "stage")
    return docs

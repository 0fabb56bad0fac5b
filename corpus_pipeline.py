"""From raw documents to token ids: each stage takes the documents that the one before it kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from matchbook.llm import mixing, pieces, pii, simhash, toxicity
from matchbook.llm.queries import token_digests
from matchbook.llm.store import stored
from matchbook.sources.tables import table


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the cut. The machine learns from the labelled ones among all documents."""
    return toxicity.clean_documents(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the one with the smallest id."""
    return simhash.one_of_each(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with personal data replaced by its kind."""
    return pii.without_pii(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as their source's target takes them."""
    return mixing.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per document of the mix: doc_id, n_tokens, and digests of the ids and of the decoded text."""
    coded = pieces.encode(docs.select("doc_id", "text"), public_tokenizers.path("piece_bpe_32k.model"))
    return coded.select("doc_id", *token_digests())


STAGES = [
    ("toxicity", toxic),
    ("simhash_near_dedup", near_duplicates),
    ("pii", personal_data),
    ("mixing", mix),
    ("sentencepiece", tokens),
]

#: SQL cannot express the trained classifier, the fingerprints or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs

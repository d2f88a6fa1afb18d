"""The corpus pipeline: quality, exact copies, near copies, personal data, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before kept; all but the last return the
columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from formsift.llm import base
from formsift.llm.exact_dedup import drop_exact_duplicates
from formsift.llm.ngram_join import one_of_each_group
from formsift.llm.packing import pack
from formsift.llm.pii import fit_pii, redact
from formsift.llm.quality import fit_quality, keep_good

TOKENIZER = "word_bpe_49k.json"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier does not reject."""
    return keep_good(docs, fit_quality(docs, base.table(spark, sf_dir, "labels")))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts, the one with the largest doc_id."""
    return drop_exact_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five words, similarity 0.8), the one with the smallest doc_id."""
    return one_of_each_group(docs, size=5, percent=80)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return redact(docs, fit_pii(docs), size="n_chars")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, packed into sequences of at most 2048 tokens."""
    return pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality", quality),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("personal_data", personal_data),
    ("packing", packing),
]
#: The classifier and the tokenizer cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = base.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = base.staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

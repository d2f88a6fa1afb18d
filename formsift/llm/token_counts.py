"""Token counts: heap-and-linked-list byte-pair merging, count = initial symbols minus merges."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formsift.llm import base
from formsift.llm.wordbpe import word_bpe


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 2048, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row, over its whole text; a map without any shuffle.

    tokenizer is the path of a byte-pair vocabulary with word ends, found at that path on every worker. A null text
    counts as empty (no bytes, no tokens); a null key stays null; repeated rows give repeated rows; an empty table
    gives an empty one; other columns are not read.
    """

    @base.tidy
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = word_bpe(tokenizer)
        for batch in batches:
            for part in base.slices(batch):
                ids, bytes_, texts = (part.column(c) for c in ("doc_id", "n_bytes", "text"))
                tokens = pa.array(bpe.counts_of(texts.to_pylist()), pa.int64())
                yield pa.RecordBatch.from_arrays([ids, bytes_, tokens], ["doc_id", "n_bytes", "n_tokens"])

    rows = base.texts_only(docs, key, text).withColumn("n_bytes", F.octet_length("text").cast("long"))
    counts = rows.mapInArrow(counted, "doc_id long, n_bytes long, n_tokens long")
    return counts.withColumn("over_limit", F.col("n_tokens") > limit)

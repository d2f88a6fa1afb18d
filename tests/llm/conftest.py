"""Rows that every operator must cope with."""

import random

import pytest
from pyspark.sql import types as T

WORDS = "the and of river stone light morning under quiet table seven walks across paper window green long".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "s", "ed", "ing", str(rng.randint(0, 9))]) for _ in range(n))


ODD = ["", None, " ", "\n\n", "a", "A", "\u0001x\u0002", "é" * 5, "<|endoftext|> it's", "▁ x", "x" * 3000]


@pytest.fixture(scope="session")
def odd_rows() -> list[tuple]:
    """(doc_id, text): odd texts, repeated rows, copies that differ in case, null keys, long texts."""
    rows = [(i, t) for i, t in enumerate(ODD)]
    rows += [(100, prose(1, 60)), (100, prose(1, 60)), (101, prose(1, 60).upper()), (102, prose(2, 9000))]
    rows += [(None, prose(1, 60)), (None, None), (103, prose(3, 3)), (104, prose(3, 3))]
    return rows


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    """The rows with further columns whose names clash with the operators' own."""
    more = "digest string, kept boolean, row long, bucket int, length int, host string, batch int, file string, t string, base string"
    schema = T.StructType.fromDDL(f"doc_id long, text string, {more}")
    return spark.createDataFrame([(i, t, "d", True, 7, 1, 2, "h", 3, "f", "t", "b") for i, t in odd_rows], schema).repartition(3)


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)


def table(df) -> list[dict]:
    return [r.asDict(recursive=True) for r in df.collect()]

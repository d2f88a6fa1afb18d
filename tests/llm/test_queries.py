"""The operators' queries as they are registered, over the small tables."""

import re

import pytest

import __spark_entry__ as entry
from compare import difference
from formsift.llm.queries import ORACLE, QUERIES

COLUMNS = {
    "op1": ["doc_id", "keep_id", "group_size", "kept", "text_sha256"],
    "op2": ["doc_id", "held_out", "score", "predicted"],
    "op3": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
    "op4": ["doc_id", "n_bytes", "n_tokens", "over_limit"],
    "op5": ["doc_id", "n_shingles", "component_id"],
    "op6": ["query_id", "rank", "vec_id", "score"],
    "op7": ["page_id", "url", "text", "n_chars"],
    "op8": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    "op9": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
    "op10": ["doc_id", "n_tokens", "ids_crc32", "round_trip"],
    "op11": ["doc_id", "n_lines", "n_dropped", "kept_sha256"],
    "op12": ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"],
    "op13": ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"],
}


def test_all_are_registered():
    assert {re.match(r"op\d+", name).group() for name in QUERIES} == set(COLUMNS)
    assert QUERIES.items() <= entry.queries().items() and "pipeline" in entry.queries()


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_agrees_with_sql(spark, duck, small, name):
    assert difference(spark, duck, small, name) == ""


@pytest.mark.parametrize("name", list(QUERIES))
def test_columns_and_a_row_for_every_input_row(spark, small, name):
    rows = QUERIES[name](spark, small)
    operator = name.split("_")[0]
    assert rows.columns == COLUMNS[operator]
    of = {"op6": None, "op7": "pages", "op12": None, "op13": "embeddings"}.get(operator, "documents")
    if of:
        wanted = spark.read.parquet(f"{small}/{of}.parquet").count()
        assert rows.select(rows.columns[0]).distinct().count() == wanted
    if operator == "op10":
        assert rows.where("NOT round_trip").count() == 0

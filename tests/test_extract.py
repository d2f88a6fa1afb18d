"""Extraction on hand-written documents, and what its plan must not contain."""

import random

import pytest
from pyspark.sql import functions as F

from formsift import constants as K
from formsift.operators import extract as X
from formsift.plans.documents import process_documents
from formsift.sources.forms import forms


def address(spark, *ahead):
    df = X.with_facts(spark.createDataFrame([("\n".join(["12 Elm Street", *ahead]),)], "raw_text string"))
    return df.select(F.inline(X.streets(F.col("facts")))).collect()[0]["address"]


@pytest.mark.parametrize("ahead, expected", [
    ((), "12 Elm Street"),
    (("Tarnwick NY 12345-6789",), "12 Elm Street Tarnwick NY 12345-6789"),
    (("Tarnwick", "NY 12345"), "12 Elm Street Tarnwick NY 12345"),
    (("NY 12345", "X", "Tarnwick"), "12 Elm Street Tarnwick NY 12345"),
    (("NY Tarnwick 12345", "Oakdale"), "12 Elm Street Oakdale 12345"),
    (("Tarnwick NY", "junk", "12345"), "12 Elm Street Tarnwick NY 12345"),
    (("Tarnwick", "NY", "12345"), "12 Elm Street Tarnwick NY 12345"),
    (("NY", "Tarnwick"), "12 Elm Street Tarnwick NY"),
    (("Tarnwick", "12345"), "12 Elm Street 12345"),
    # a 'city ST ZIP' line further down goes before a nearer 'city ST' line
    (("Tarnwick NY", "Oakdale TX 54321"), "12 Elm Street Oakdale TX 54321"),
    # 'city ST' before a bare state line
    (("NY", "Tarnwick TX", "12345"), "12 Elm Street Tarnwick TX 12345"),
    # labels and streets are no cities
    (("Wages", "99 Oak Road", "Tarnwick", "NY"), "12 Elm Street Tarnwick NY"),
    # the twelfth line is out of reach
    (tuple(["*"] * 11 + ["Tarnwick NY 12345"]), "12 Elm Street"),
    (tuple(["*"] * 10 + ["Tarnwick NY 12345"]), "12 Elm Street Tarnwick NY 12345"),
    (("Tarnwick NY 12345-678",), "12 Elm Street"),
])
def test_address_rules(spark, ahead, expected):
    assert address(spark, *ahead) == expected


def name(spark, *back):
    text = "\n".join([*back, "12 Elm Street", "Tarnwick NY 12345"])
    df = X.with_facts(spark.createDataFrame([(text,)], "raw_text string"))
    found = df.select(F.inline(X.candidates(F.col("facts"), F.col("low_text")))).collect()
    return found[0]["name"] if found else None


@pytest.mark.parametrize("back, expected", [
    (("James Cox",), "James Cox"),
    (("James Cox", "Maria Dalton"), "Maria Dalton"),
    (("James", "Cox"), "James Cox"),
    (("James", *["*"] * 5, "Cox"), "James Cox"),
    (("James", *["*"] * 6, "Cox"), None),
    (("James", "Cox", *["*"] * 13), "James Cox"),
    (("James Cox", *["*"] * 15), None),
    (("James", "Cox", "Maria Dalton", "Robert"), "Maria Dalton"),
    (("Last name", "Employee's first name", "Cox James"), "James Cox"),
    (("Kirsten Cox",), None),
    (("JAMES COX",), None),
])
def test_name_search(spark, back, expected):
    assert name(spark, *back) == expected


def test_better_address_of_the_same_street_is_taken(spark):
    text = "\n".join(["James Cox", "12 Elm Street", *["*"] * 12, "Maria Dalton", "12 Elm Street", "Tarnwick NY 12345"])
    df = X.extract_fields(spark.createDataFrame([(text,)], "raw_text string"))
    assert df.collect()[0]["employee_address"] == "12 Elm Street Tarnwick NY 12345"


def test_person_bonus(spark):
    text = "\n".join(["James Cox", "12 Elm Street", "Tarnwick NY 12345", *["*"] * 20, "Maria Dalton", "7 Oak Road", "Tarnwick NY 12345"])
    df = spark.createDataFrame([(text, {"Maria Dalton": 45})], "raw_text string, person map<string,int>")
    assert X.extract_fields(df).collect()[0]["employee_name"] == "James Cox"
    assert X.extract_fields(df, person="person").collect()[0]["employee_name"] == "Maria Dalton"


def test_documents_do_not_touch_each_other(spark, small):
    """A third of all rows under one name: every row keeps its own result."""
    df = forms(spark, small).select("k", "raw_text")
    hot = df.withColumn("file_name", F.when(F.col("k") % 3 == 0, F.lit("same.pdf")).otherwise(F.col("k").cast("string")))
    alone = {r.k: r[1:] for r in X.extract_fields(df).select("k", "employee_name", "employee_address").collect()}
    mixed = X.extract_fields(hot.orderBy(F.rand(7))).select("k", "employee_name", "employee_address").collect()
    assert {r.k: r[1:] for r in mixed} == alone


def test_long_document(spark):
    """Thousands of street lines in one text: whole text searched, best candidate still found."""
    random.seed(5)
    noise = [f"{random.randint(1, 9999)} {random.choice('ABCDEFG')}x Road" for _ in range(3000)]
    text = "\n".join([*noise, "Employee", "James Cox", "12 Elm Street", "Tarnwick NY 12345-6789"])
    row = X.extract_fields(spark.createDataFrame([(text,)], "raw_text string")).collect()[0]
    assert (row.employee_name, row.employee_address) == ("James Cox", "12 Elm Street Tarnwick NY 12345-6789")


def test_plan_is_a_map_without_python(spark, small, tmp_path):
    path = str(tmp_path / "forms")
    forms(spark, small).write.parquet(path)
    df = process_documents(spark.read.parquet(path))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Window" not in plan
    # the text is split once and the line facts are worked out once
    assert plan.count("split(coalesce(") == 1
    assert plan.count("employer_anchor, Contains(") <= 1


def test_filter_on_results_does_not_copy_the_chain(spark, small, tmp_path):
    path = str(tmp_path / "forms")
    forms(spark, small).write.parquet(path)
    df = process_documents(spark.read.parquet(path)).filter("status = 'NEEDS_REVIEW' AND employee_name IS NULL")
    assert df._jdf.queryExecution().optimizedPlan().toString().count("split(coalesce(") == 1
    assert df.count() > 0


def test_text_of_a_failed_document_is_not_searched(spark, small):
    """A failed document's fields are NULL whatever its text holds; before, its text was searched and the outcome dropped."""
    docs = forms(spark, small).select("file_name", "raw_text", "error", "processed_at", "processing_time_seconds")
    away = docs.withColumn("error", F.concat(F.lit("away "), "file_name"))
    unreadable = away.withColumn("raw_text", F.raise_error(F.concat(F.lit("searched "), F.col("file_name"))).cast("string"))
    rows = process_documents(unreadable).collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, process_documents(away).collect()))
    assert {r.status for r in rows} == {K.FAILED} and {r.employee_name for r in rows} == {None} and len(rows) == docs.count()

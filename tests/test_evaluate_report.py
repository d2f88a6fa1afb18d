"""Comparison branches, statistics and summaries on small tables."""

import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from formsift import constants as K
from formsift.functions import checks as V, compare as C
from formsift.operators import evaluate as E, report as R
from tests.test_text import apply


@pytest.mark.parametrize("field, expected, extracted, result", [
    ("employee_name", "NOT_VERIFIABLE", "x", "Not Verifiable"),
    ("employee_name", "not_verifiable", "x", "Fail"),
    ("employee_name", "", "None", "Pass"),
    ("employee_name", "a", "", "Fail"),
    ("employee_name", "James  Cox", "james cox.", "Pass"),
    ("employee_name", "James Cox", "James Coxs", "Fail"),
    ("employee_ssn", "000-11-2222", "000 11 2222", "Pass"),
    ("employee_address", "12 Elm St, Tarnwick, NY 12345", "12 Elm St Tarnwick NY 12345", "Pass"),
    ("employee_address", "12 Elm Street Tarnwick NY 12345", "12 Elm Streat Tarnwick NY 12345", "Pass"),
    ("employee_address", "12 Elm Street Tarnwick NY 12345", "12 Elm Street Tarnwick TX 12345", "Fail"),
    ("employee_address", "12 Elm Street Tarnwick NY 12345", "12 Elm Street Tarnwick NY 12346", "Fail"),
    ("employee_address", "12 Elm Street Tarnwick NY 12345", "99 Oak Road Tarnwick NY 12345", "Fail"),
    # inserted and dropped characters, on both sides of the bound
    ("employee_address", "12 Elm Street Tarnwick NY 12345", "12 Elm Streeet Tarnwick NY 12345", "Pass"),
    ("employee_address", "12 Elm Street Tarnwick NY 12345", "12 Elm Stret Tarnwick NY 12345", "Pass"),
    ("employee_address", "12 Elm Street Tarnwick NY 12345", "12 Elm Street Apt 4 Tarnwick NY 12345", "Pass"),
    ("employee_address", "12 Elm Street Tarnwick NY 12345", "12 E Str Tarnwick NY 12345", "Pass"),
    ("employee_address", "12 Elm Street Tarnwick NY 12345", "12 Elm Street Apartment 4 Tarnwick NY 12345", "Fail"),
    ("employee_address", "12 Elm Street Tarnwick NY 12345", "12 Elm Street Northend Tarnwick NY 12345", "Fail"),
    # the street number is taken for the ZIP
    ("employee_address", "10012 Elm Street Tarnwick NY 12345", "10012 Elm Street Tarnwick NY 12346", "Pass"),
])
def test_outcome(spark, field, expected, extracted, result):
    df = spark.createDataFrame([(field, expected, extracted)], "field_name string, expected_value string, extracted_value string")
    assert E.with_outcome(df).collect()[0]["result"] == result


def test_last_zip_on_request(spark):
    df = spark.createDataFrame(
        [("employee_address", "10012 Elm Street Tarnwick NY 12345", "10012 Elm Street Tarnwick NY 12346")],
        "field_name string, expected_value string, extracted_value string")
    assert E.with_outcome(df, zip_position="last").collect()[0]["result"] == "Fail"


def test_similarity_and_its_bound(spark):
    random.seed(4)
    pairs = [("".join(random.choices("abc 12", k=random.randint(0, 25))), "".join(random.choices("abc 12", k=random.randint(0, 25)))) for _ in range(300)]
    pairs += [("".join(random.choices("ab c", k=random.randint(150, 420))), "".join(random.choices("ab c", k=random.randint(150, 420)))) for _ in range(20)]
    pairs += [("", ""), ("x" * 250, "x" * 230), ("a", "")]
    df = spark.createDataFrame(pairs, "a string, b string")
    rows = df.select("a", "b", C.similarity(F.col("a"), F.col("b")).alias("r"), C.similarity_bound(F.col("a"), F.col("b")).alias("m")).collect()
    for row in rows:
        assert row.r == SequenceMatcher(None, row.a, row.b).ratio()
        assert row.r <= row.m + 1e-12


@pytest.mark.parametrize("name, valid", [
    ("James Cox", True), ("James A. Cox", True), ("James", False), ("A. Cox", False), ("James COX", False),
    ("James Cox Inc", False), ("James Co", True), ("Kuniam Cox", False), ("a b c d e", False), ("James Cox1", False),
    ("O'Brien Jo", True), ("Mary Ann Lee Cox", True), (None, False),
])
def test_valid_name(spark, name, valid):
    assert apply(spark, [name], V.is_valid_name) == [valid]


@pytest.mark.parametrize("address, valid", [
    ("12 Elm Street Tarnwick NY 12345", True), ("12 Elm Street NY 12345", False), ("Elm Street in Tarnwick NY 12345", False),
    ("12 Elm Street Tarnwick 12345 NY", False), ("12 Pine Tarnwick Grove NY 12345-678", True), ("12 Elm Grove Tarnwick NY 12345", False),
    (None, False),
])
def test_valid_address(spark, address, valid):
    assert apply(spark, [address], V.is_valid_address) == [valid]


def rows(spark, pairs):
    return spark.createDataFrame(pairs, "file_type string, status string").withColumn("processing_time_seconds", F.lit("1.5"))


def test_distribution_keeps_zeros_and_other_statuses(spark):
    df = rows(spark, [("clean", "AUTO_APPROVED"), ("clean", "AUTO_APPROVED"), ("clean", "ODD"), ("all", "FAILED")])
    found = {(r.file_type, r.status): (r.total, r.percentage) for r in R.status_distribution(df).collect()}
    assert found == {
        ("all", "AUTO_APPROVED"): (2, 50.0), ("all", "NEEDS_REVIEW"): (0, 0.0), ("all", "FAILED"): (1, 25.0),
        ("clean", "AUTO_APPROVED"): (2, 66.67), ("clean", "NEEDS_REVIEW"): (0, 0.0), ("clean", "FAILED"): (0, 0.0),
    }


def test_ratio_is_null_on_zero(spark):
    assert [r.ratio for r in R.status_ratios(rows(spark, [("clean", "NEEDS_REVIEW")])).orderBy("status").collect()] == [0.0, None]
    empty = rows(spark, []).limit(0)
    assert [r.ratio for r in R.status_ratios(empty).collect()] == [None, None]
    assert R.status_distribution(empty).count() == 0


def test_published_figures(spark):
    """258 approved and 223 in review out of 481."""
    counts = [("clean", "AUTO_APPROVED", 223), ("clean", "NEEDS_REVIEW", 178), ("noisy", "AUTO_APPROVED", 35), ("noisy", "NEEDS_REVIEW", 45)]
    df = rows(spark, [(kind, status) for kind, status, n in counts for _ in range(n)])
    found = {(r.section, r.file_type, r.status): r.percentage if r.ratio is None else r.ratio for r in R.status_statistics(df).collect()}
    assert found["status_distribution", "clean", "AUTO_APPROVED"] == 55.61
    assert found["status_distribution", "noisy", "NEEDS_REVIEW"] == 56.25
    assert found["ratio", "all", "NEEDS_REVIEW_to_AUTO_APPROVED"] == 0.8643
    assert found["ratio", "all", "AUTO_APPROVED_to_NEEDS_REVIEW"] == 1.157
    metrics = {r.metric: r.value for r in R.run_summary(df, found=481, batch_seconds=1.26, updated_at="now").collect()}
    assert metrics["auto_approved_percentage"] == "53.64" and metrics["failed_percentage"] == "0.0"
    assert metrics["total_processing_time_seconds"] == "721.5" and len(metrics) == 17


def test_empty_summary(spark):
    metrics = {r.metric: r.value for r in R.run_summary(rows(spark, []), found=4).collect()}
    assert metrics["remaining_pdfs"] == "4" and metrics["estimated_remaining_time_seconds"] == "0.0"
    assert metrics["needs_review_to_auto_approved_ratio"] == ""


def test_latest_by_key(spark):
    df = spark.createDataFrame([(" a ", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("", 9, "n"), (None, 9, "n")], "f string, n int, v string")
    assert [tuple(r) for r in R.latest_by_key(df, "f", ["n"]).collect()] == [("a", 2, "z")]


def test_shares_add_up(spark, small):
    orders = spark.read.parquet(f"{small}/orders.parquet")
    assert abs(R.share_of_total(orders, "o_orderstatus").agg(F.sum("percentage")).collect()[0][0] - 100) <= 0.02


def test_one_pass_for_the_statistics(spark, tmp_path):
    rows(spark, [("clean", s) for s in K.STATUSES]).write.parquet(str(tmp_path / "r"))
    plan = R.status_statistics(spark.read.parquet(str(tmp_path / "r")))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1


def test_repeated_results_of_a_file_give_one_row(spark):
    truth = spark.createDataFrame([("a.pdf", "clean", "James Cox", "", "", "")], "file_name string, file_type string, employee_name string, employee_address string, employee_ssn string, notes string")
    columns = "processed_at long, file_name string, employee_name string, employee_address string, employee_ssn string, status string, review_reason string"
    results = spark.createDataFrame([(1, "a.pdf", "James Fox", "", "", "FAILED", ""), (2, "a.pdf", "James Cox", "", "", "AUTO_APPROVED", "")], columns)
    rows = E.field_checks(truth, results).collect()
    assert len(rows) == 3 and {r.status for r in rows} == {"AUTO_APPROVED"}


def test_similarity_stays_in_the_jvm_and_its_bounds_hold(spark):
    random.seed(11)
    letters = ["ab", "abcde 12", "abcdefghijklmnop 0123456789", "aéß😀b"]
    pairs = [tuple("".join(random.choices(random.choice(letters), k=random.randint(0, 40))) for _ in range(2)) for _ in range(300)]
    for size in (199, 200, 201, 450):  # characters that are popular begin no piece, but lengthen one
        base_text = "".join(random.choices("abcdefghijklmnopqrstuvwxyz0123456789", k=size))
        pairs += [("".join(c for c in base_text if random.random() > 0.1), base_text), (base_text, "xyz" + base_text[5:] + "qq")]
        pairs += [("a" * size + base_text, base_text + "a" * size), ("b" + base_text, "c" * size + base_text[::-1])]
    pairs += [("same", "same"), ("", "abc"), ("ab", "ba")]
    df = spark.createDataFrame([*pairs, (None, "a"), ("a", None), (None, None)], "a string, b string")
    a, b = F.col("a"), F.col("b")
    ratios = df.select("a", "b", C.similarity(a, b).alias("r"), C.shared_bound(a, b).alias("m"), C.similarity_bound(a, b).alias("n"))
    assert "Python" not in ratios._jdf.queryExecution().toString()
    for row in ratios.collect():
        if row.a is None or row.b is None:
            assert row.r is None
        else:
            assert row.r == SequenceMatcher(None, row.a, row.b).ratio(), (row.a, row.b)
            assert row.r <= row.m + 1e-12 <= row.n + 2e-12


def test_outcome_needs_no_python(spark):
    df = spark.createDataFrame([("employee_address", "a", "b")], "field_name string, expected_value string, extracted_value string")
    plan = E.with_outcome(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan

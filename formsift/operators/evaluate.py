"""Evaluation against ground truth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from formsift import constants as K
from formsift.functions import compare as C, text as T
from formsift.operators.report import latest_by_key, metric_rows


def join_truth(truth: DataFrame, results: DataFrame, recency: list[str] | None = None) -> DataFrame:
    """Every truth row with its result, blanks where there is none.

    Of several results for one file the last by `recency` counts (by default by `processed_at` where there is
    one, then by the compared columns). Truth rows are kept as they are, repeated ones too.
    """
    if recency is None:
        recency = [c for c in ("processed_at", *K.CHECKED_FIELDS, "status", "review_reason") if c in results.columns]
    extracted = latest_by_key(results, "file_name", recency).select(
        F.col("file_name"),
        *[F.col(field).alias(f"got_{field}") for field in K.CHECKED_FIELDS],
        "status",
        "review_reason",
    )
    joined = truth.join(extracted, "file_name", "left")
    blanks = [f"got_{field}" for field in K.CHECKED_FIELDS] + ["status", "review_reason"]
    return joined.fillna("", subset=blanks)


def unpivot_fields(joined: DataFrame) -> DataFrame:
    """One row per truth row and field."""
    fields = F.array(
        *[
            F.struct(
                F.lit(field).alias("field_name"),
                F.coalesce(F.col(field), F.lit("")).alias("expected_value"),
                F.col(f"got_{field}").alias("extracted_value"),
            )
            for field in K.CHECKED_FIELDS
        ]
    )
    return joined.select("file_name", "file_type", F.inline(fields), "status", "review_reason")


def compared_values(zip_position: str) -> tuple[Column, Column, Column, Column]:
    """What decides a field row: field, both values without blanks around, and whether state and ZIP agree."""
    expected, extracted = T.strip(F.col("expected_value")), T.strip(F.col("extracted_value"))
    same_place = (C.state_for_compare(expected) == C.state_for_compare(extracted)) & (
        C.zip_for_compare(expected, zip_position) == C.zip_for_compare(extracted, zip_position)
    )
    return F.col("field_name"), expected, extracted, same_place


def undecided(checks: DataFrame, zip_position: str = "first") -> DataFrame:
    """The field rows whose outcome takes the similarity."""
    return checks.filter(C.outcome_without_similarity(*compared_values(zip_position)).isNull())


def with_outcome(checks: DataFrame, zip_position: str = "first") -> DataFrame:
    """E5: adds `result`."""
    return checks.withColumn("result", C.outcome(*compared_values(zip_position)))


def field_checks(truth: DataFrame, results: DataFrame, zip_position: str = "first") -> DataFrame:
    """The table of field checks, 8 columns."""
    checked = with_outcome(unpivot_fields(join_truth(truth, results)), zip_position)
    return checked.select(
        "file_name", "file_type", "field_name", "expected_value", "extracted_value", "result", "status",
        "review_reason",
    )


def failed_fields(checks: DataFrame) -> DataFrame:
    """E7."""
    return checks.filter(F.col("result") == C.FAIL)


def _count(condition: Column) -> Column:
    return F.count_if(condition)


def accuracy_counts(checks: DataFrame) -> DataFrame:
    """One row of counts behind E8-E10, in one pass."""
    passed = F.col("result") == C.PASS
    verifiable = F.col("result") != C.OPEN
    clean, noisy = F.col("file_type") == "clean", F.col("file_type") == "noisy"
    approved = F.col("status") == K.AUTO_APPROVED
    return checks.agg(
        F.count_distinct("file_name").alias("files"),
        F.count("*").alias("checks"),
        _count(passed).alias("passed"),
        _count(F.col("result") == C.FAIL).alias("failed"),
        _count(F.col("result") == C.OPEN).alias("open"),
        _count(clean & verifiable).alias("clean"),
        _count(clean & passed).alias("clean_passed"),
        _count(noisy & verifiable).alias("noisy"),
        _count(noisy & passed).alias("noisy_passed"),
        _count(approved & verifiable).alias("approved"),
        _count(approved & passed).alias("approved_passed"),
    )


def accuracy(checks: DataFrame) -> DataFrame:
    """Accuracy overall, for clean and noisy files, and the precision of approvals."""
    c = F.col
    return accuracy_counts(checks).select(
        C.share(c("passed"), c("passed") + c("failed")).alias("accuracy"),
        C.share(c("clean_passed"), c("clean")).alias("clean_accuracy"),
        C.share(c("noisy_passed"), c("noisy")).alias("noisy_accuracy"),
        C.share(c("approved_passed"), c("approved")).alias("approval_precision"),
    )


def accuracy_summary(checks: DataFrame) -> DataFrame:
    """Twelve metrics as (metric, value) text."""
    c = F.col

    def percent(part: Column, whole: Column) -> Column:
        return T.percent_text(C.share(part, whole))

    return metric_rows(
        accuracy_counts(checks),
        {
            "total_files_in_ground_truth": c("files").cast("string"),
            "total_field_checks": c("checks").cast("string"),
            "pass_fields": c("passed").cast("string"),
            "fail_fields": c("failed").cast("string"),
            "not_verifiable_fields": c("open").cast("string"),
            "verifiable_fields": (c("passed") + c("failed")).cast("string"),
            "field_level_accuracy_excluding_not_verifiable": percent(c("passed"), c("passed") + c("failed")),
            "clean_field_level_accuracy": percent(c("clean_passed"), c("clean")),
            "noisy_field_level_accuracy": percent(c("noisy_passed"), c("noisy")),
            "auto_approval_precision": percent(c("approved_passed"), c("approved")),
            "accuracy_formula": F.lit(K.ACCURACY_FORMULA),
            "precision_formula": F.lit(K.PRECISION_FORMULA),
        },
    )

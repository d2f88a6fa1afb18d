"""Dedupe, status statistics and run summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from formsift import constants as K
from formsift.functions import text as T


SECTIONS = ["all", *K.FILE_TYPES]


def latest_by_key(df: DataFrame, key: str, recency: list[str]) -> DataFrame:
    """G1: the last row of every key by the recency columns, which must tell its rows apart.

    An aggregate, not a window: rows are reduced before the shuffle, so a key that holds a large part
    of the table does not end in one task. Every column is an aggregate of its own, ordered by recency only:
    columns that nothing reads are neither shuffled nor compared, and maps may be among them. Blank keys are
    dropped and keys are stripped.
    """
    keyed = df.withColumn(key, T.strip(F.col(key))).filter(F.col(key) != "")
    order = F.struct(*recency)
    rest = [F.max_by(c, order).alias(c) for c in df.columns if c != key]
    return (keyed.groupBy(key).agg(*rest) if rest else keyed.select(key).distinct()).select(df.columns)


def counted_if(condition: Column, weight: Column | None) -> Column:
    """Rows of the condition, or their weights where a row stands for several."""
    if weight is None:
        return F.count_if(condition)
    return F.coalesce(F.sum(F.when(condition, weight)), F.lit(0)).cast("bigint")


def section_counts(results: DataFrame, weight: Column | None = None) -> DataFrame:
    """One row: rows per section and status, behind G2-G4. One pass, nothing but counts is shuffled."""
    counts = {}
    for section in SECTIONS:
        inside = F.lit(True) if section == "all" else F.col("file_type").eqNullSafe(section)
        counts[section] = counted_if(inside, weight)
        for status in K.STATUSES:
            counts[f"{section}_{status}"] = counted_if(inside & (F.col("status") == status), weight)
    return results.agg(*[value.alias(name) for name, value in counts.items()])


def _distribution_rows() -> Column:
    """G2 as an array: sections without rows are left out, statuses without rows are not."""
    rows = [
        F.struct(
            F.lit("status_distribution").alias("section"),
            F.lit(section).alias("file_type"),
            F.lit(status).alias("status"),
            F.col(f"{section}_{status}").alias("total"),
            T.round_exact(F.try_divide(F.col(f"{section}_{status}"), F.col(section)) * 100, 2).alias("percentage"),
            F.lit(None).cast("double").alias("ratio"),
        )
        for section in SECTIONS
        for status in K.STATUSES
    ]
    return F.filter(F.array(*rows), lambda row: row["percentage"].isNotNull())


def _ratio_rows() -> Column:
    """G3 as an array."""
    needs, auto = f"all_{K.NEEDS_REVIEW}", f"all_{K.AUTO_APPROVED}"
    return F.array(
        *[
            F.struct(
                F.lit("ratio").alias("section"),
                F.lit("all").alias("file_type"),
                F.lit(name).alias("status"),
                F.lit(None).cast("bigint").alias("total"),
                F.lit(None).cast("double").alias("percentage"),
                T.round_exact(F.try_divide(F.col(part), F.col(whole)), 4).alias("ratio"),
            )
            for name, part, whole in (
                (f"{K.NEEDS_REVIEW}_to_{K.AUTO_APPROVED}", needs, auto),
                (f"{K.AUTO_APPROVED}_to_{K.NEEDS_REVIEW}", auto, needs),
            )
        ]
    )


def status_distribution(results: DataFrame) -> DataFrame:
    """Count and percentage of the three statuses, for all files and per file type.

    A status without rows keeps its zero; a file type without rows is left out. Rows with any other
    status stay in the denominator.
    """
    return section_counts(results).select(F.inline(_distribution_rows()))


def status_ratios(results: DataFrame) -> DataFrame:
    """Review to approved and back, 4 places, NULL when the denominator is 0."""
    return section_counts(results).select(F.inline(_ratio_rows()))


def status_statistics(results: DataFrame) -> DataFrame:
    """G2 and G3 in one table, from one pass."""
    return statistics_of(section_counts(results))


def statistics_of(counts: DataFrame) -> DataFrame:
    """G4 from the row of section_counts."""
    both = F.concat(_distribution_rows(), _ratio_rows())
    return counts.select(F.inline(both)).select(K.STATISTICS_COLUMNS)


def number_text(value: Column, places: int) -> Column:
    """A rounded double as text without needless zeros: 53.64, 0.0, 9408.36."""
    return F.regexp_replace(T.fixed_point(value, places), r"(\.\d+?)0+\z", "$1")


def metric_rows(one_row: DataFrame, metrics: dict[str, Column]) -> DataFrame:
    """(metric, value) rows from a one-row table."""
    return one_row.select(
        F.inline(
            F.array(*[F.struct(F.lit(m).alias("metric"), v.alias("value")) for m, v in metrics.items()])
        )
    )


def seconds_taken(value: Column) -> Column:
    """A time as a decimal with six places, 0 for what is no finite number: sums do not depend on the order of rows."""
    return T.lenient_double(value.cast("string")).try_cast("decimal(30,6)")


def run_summary(
    results: DataFrame,
    listed: DataFrame | None = None,
    found: int | None = None,
    batch_seconds: float | None = None,
    updated_at: str | None = None,
) -> DataFrame:
    """The run in (metric, value) rows, in one pass over the results.

    `listed` is the table of documents found; a known number can be passed as `found` instead. The two
    clock metrics appear when their values are given. Times are summed as decimals with six places, so that the
    order of rows does not show; what is no finite number counts as nothing.
    """
    rows = results.select(
        F.lit(True).alias("stored"), "status", "file_type", seconds_taken(F.col("processing_time_seconds")).alias("took")
    )
    if listed is not None:
        # listed documents join in as rows of their own, so that one aggregate sees both
        rows = rows.unionByName(listed.select(F.lit(False).alias("stored")), allowMissingColumns=True)
    totals = rows.agg(F.count_if(~F.col("stored")).alias("found"), *_totals(None))
    if listed is None:
        totals = totals.withColumn("found", F.lit(found).cast("bigint"))
    return _summary(totals, batch_seconds, updated_at)


def summary_of_counts(
    counts: DataFrame,
    listed: DataFrame | None = None,
    found: int | None = None,
    batch_seconds: float | None = None,
    updated_at: str | None = None,
) -> DataFrame:
    """G5 from counts (file_type, status, n, seconds) in place of the results."""
    rows = counts.select(F.lit(True).alias("stored"), "status", "file_type", F.col("seconds").alias("took"), "n")
    totals = rows.agg(*_totals(F.col("n")))
    if listed is not None:
        totals = totals.withColumn("found", listed.agg(F.count(F.lit(1))).scalar())
    else:
        totals = totals.withColumn("found", F.lit(found).cast("bigint"))
    return _summary(totals, batch_seconds, updated_at)


def _totals(weight: Column | None) -> list[Column]:
    """The sums behind G5 over rows (stored, status, file_type, took)."""
    status, kind = F.col("status"), F.col("file_type")
    conditions = {
        "done": F.col("stored"),
        "auto": status == K.AUTO_APPROVED,
        "needs": status == K.NEEDS_REVIEW,
        "failed": status == K.FAILED,
        "clean": kind == "clean",
        "noisy": kind == "noisy",
    }
    return [
        *(counted_if(condition, weight).alias(name) for name, condition in conditions.items()),
        F.coalesce(F.sum("took").cast("double"), F.lit(0.0)).alias("seconds"),
    ]


def _summary(totals: DataFrame, batch_seconds: float | None, updated_at: str | None) -> DataFrame:
    """The metrics from one row of sums."""
    done, seconds = F.col("done"), F.col("seconds")

    def percent(part: str) -> Column:
        return F.coalesce(T.round_exact(F.try_divide(F.col(part), done) * 100, 2), F.lit(0.0))

    totals = totals.withColumns(
        {
            "average": F.coalesce(T.round_exact(F.try_divide(seconds, done), 2), F.lit(0.0)),
            "remaining": F.col("found") - done,
            "auto_share": percent("auto"),
            "needs_share": percent("needs"),
            "failed_share": percent("failed"),
            "ratio": T.round_exact(F.try_divide(F.col("needs"), F.col("auto")), 4),
        }
    )
    eta = F.when(F.col("remaining") > 0, F.col("remaining") * F.col("average")).otherwise(F.lit(0.0))

    def count(name: str) -> Column:
        return F.col(name).cast("string")

    metrics = {
        "total_pdfs_found_in_raw": count("found"),
        "total_pdfs_processed": count("done"),
        "remaining_pdfs": count("remaining"),
        "auto_approved": count("auto"),
        "auto_approved_percentage": number_text(F.col("auto_share"), 2),
        "needs_review": count("needs"),
        "needs_review_percentage": number_text(F.col("needs_share"), 2),
        "failed": count("failed"),
        "failed_percentage": number_text(F.col("failed_share"), 2),
        "needs_review_to_auto_approved_ratio": F.coalesce(number_text(F.col("ratio"), 4), F.lit("")),
        "clean_processed": count("clean"),
        "noisy_processed": count("noisy"),
        "total_processing_time_seconds": number_text(seconds, 2),
        "average_processing_time_seconds_per_pdf": number_text(F.col("average"), 2),
        "estimated_remaining_time_seconds": number_text(eta, 2),
    }
    if batch_seconds is not None:
        metrics["current_batch_runtime_seconds"] = F.lit(str(batch_seconds))
    if updated_at is not None:
        metrics["last_updated"] = F.lit(updated_at)
    return metric_rows(totals, metrics)


def status_summary(results: DataFrame) -> DataFrame:
    """Rows per status, in status order."""
    return results.groupBy("status").agg(F.count("*").alias("total")).orderBy("status")


def pipeline_summary(results: DataFrame) -> DataFrame:
    """Rows per file type (C9) and status, in that order."""
    return (
        results.groupBy(T.document_type_cased(F.col("file_name")).alias("file_type"), "status")
        .agg(F.count("*").alias("total"))
        .orderBy("file_type", "status")
    )


def detail_report(results: DataFrame) -> DataFrame:
    """16 columns with the C9 file type, in file order."""
    kind = T.document_type_cased(F.col("file_name")).alias("file_type")
    head, tail = K.REPORT_COLUMNS[:2], K.REPORT_COLUMNS[2:]
    return results.select(*head, kind, *tail).orderBy("file_name")


def share_of_total(df: DataFrame, column: str) -> DataFrame:
    """Rows per value with their percentage of all rows, most frequent first.

    The sum of all is a scalar subquery; a window over everything would put all values in one task. It
    reads `df` a second time, so `df` should be a stored table.
    """
    counted = df.groupBy(column).agg(F.count("*").alias("total"))
    everything = counted.agg(F.sum("total").alias("all")).scalar()
    return counted.withColumn(
        "percentage", F.round(F.col("total") * 100.0 / everything, 2).cast("double")
    ).orderBy(F.desc("total"))

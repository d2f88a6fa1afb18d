"""Run control: which documents to process, and merging new results in."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from formsift import constants as K
from formsift.functions import text as T
from formsift.operators.report import latest_by_key


def done_files(results: DataFrame, retry_failed: bool = True) -> DataFrame:
    """Files that need no further run; failed ones do, unless `retry_failed` is off."""
    kept = results
    if retry_failed:
        kept = results.filter(~F.col("status").eqNullSafe(K.FAILED))
    return kept.select("file_name")


def pending(listed: DataFrame, done: DataFrame) -> DataFrame:
    """Listed documents whose base name is not done."""
    return listed.withColumn("file_name", T.basename(F.col("path"))).join(done, "file_name", "left_anti")


def next_batch(waiting: DataFrame, size: int | None) -> DataFrame:
    """The first `size` pending documents by path, all of them without a size."""
    return waiting if size is None else waiting.orderBy("path").limit(size)


def allow_listed(listed: DataFrame, names: DataFrame) -> DataFrame:
    """C4: listed documents whose base name is on a list, in path order."""
    return (
        listed.withColumn("file_name", T.basename(F.col("path")))
        .join(names.select("file_name"), "file_name", "left_semi")
        .orderBy("path")
    )


def upsert(old: DataFrame, new: DataFrame, key: str = "file_name", order: list[str] | None = None) -> DataFrame:
    """New rows replace old rows of the same key; the result has one row for each key of `new`.

    Of new rows with one key the last by `order` stays (by default by all other columns, which must then be
    orderable). `new` is read twice, for its keys and for its rows, so rows that take work should be stored.
    """
    order = order or [c for c in new.columns if c != key]
    last = latest_by_key(new, key, order)
    return old.join(last.select(key), key, "left_anti").unionByName(last.select(old.columns))


def stored_table(spark: SparkSession, table: str) -> DataFrame | None:
    """A table by name, or by path if it holds a slash; None where there is no such table."""
    if "/" not in table:
        return spark.table(table) if spark.catalog.tableExists(table) else None
    try:
        return spark.read.parquet(table)
    except AnalysisException as error:
        if error.getCondition() not in {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}:
            raise
        return None


def already_processed(batch: DataFrame, table: DataFrame | str, key: str = "file_name") -> DataFrame:
    """S10 for a whole batch: its rows that the table already has; none where the table does not exist."""
    found = stored_table(batch.sparkSession, table) if isinstance(table, str) else table
    return batch.limit(0) if found is None else batch.join(found.select(key), key, "left_semi")


def fetch_results(table: DataFrame | str, limit: int = 1000, spark: SparkSession | None = None) -> DataFrame:
    """Report columns without the raw text, first `limit` rows by file name; no rows where there is no table.

    A table given by name or path needs the session.
    """
    found = stored_table(spark, table) if isinstance(table, str) else table
    if found is None:
        return spark.createDataFrame([], ", ".join(f"{c} {K.TABLE_TYPES[c]}" for c in K.REPORT_COLUMNS))
    return found.select(K.REPORT_COLUMNS).orderBy("file_name").limit(limit)


def manual_review(results: DataFrame) -> DataFrame:
    """Every row that is not approved, a missing status included."""
    return results.filter(~F.col("status").eqNullSafe(K.AUTO_APPROVED))

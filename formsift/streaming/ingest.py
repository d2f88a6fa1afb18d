"""Resumable, capped ingestion of OCR texts as a file stream."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from formsift import constants as K
from formsift.operators import report as R
from formsift.plans.documents import dealt_out, process_documents
from formsift.sources import tables


def ingest(
    spark: SparkSession,
    source: str,
    schema: StructType,
    results_path: str,
    checkpoint: str,
    prepare: Callable[[DataFrame], DataFrame] = lambda df: df,
    max_files: int = 50,
    glob: str | None = None,
) -> None:
    """Processes every new parquet file below `source`, at most `max_files` per micro-batch.

    The checkpoint remembers finished files. Each micro-batch overwrites its own partition of the
    result log, so a batch that is run again after a failure leaves no second copy. The partition also
    bears the id of the stream, which lives in the checkpoint: a stream that starts over with a new checkpoint
    counts its batches from 0 again and leaves the log of the old one as it is. Of two paths with one base name in one
    batch the later path's result is the last.
    """
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
    if glob:
        reader = reader.option("pathGlobFilter", glob)

    def store(batch: DataFrame, batch_id: int) -> None:
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        rows = prepare(batch)
        if "path" not in rows.columns:
            rows = rows.withColumn("path", F.col("file_name"))
        logged(process_documents(dealt_out(rows), keep=("path",)), f"{results_path}/run={stream}/batch_id={batch_id}")

    query = (
        reader.parquet(source)
        .writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def logged(results: DataFrame, path: str) -> None:
    """Writes one partition of the log; `stored_at` tells which of several results for a file is the last."""
    results.withColumn("stored_at", F.current_timestamp()).write.mode("overwrite").parquet(path)


def _log(spark: SparkSession, results_path: str) -> DataFrame:
    return spark.read.option("basePath", results_path).parquet(results_path)


def _latest(log: DataFrame) -> DataFrame:
    if "path" not in log.columns:
        log = log.withColumn("path", F.col("file_name"))
    return R.latest_by_key(log, "file_name", ["stored_at", "batch_id", "path", "processed_at"])


def current_results(spark: SparkSession, results_path: str) -> DataFrame:
    """The result log with the last result of every file winning."""
    return _latest(_log(spark, results_path)).select(K.RESULT_COLUMNS)


def failed_files(spark: SparkSession, results_path: str) -> DataFrame:
    """Files to hand in again: a file stream reads a file once, so failed ones go through `retry`."""
    return current_results(spark, results_path).filter(F.col("status") == K.FAILED).select("file_name")


def retry(spark: SparkSession, documents: DataFrame, results_path: str) -> None:
    """Processes documents that failed once more and adds their results to the log."""
    if "path" not in documents.columns:
        documents = documents.withColumn("path", F.col("file_name"))
    logged(process_documents(dealt_out(documents), keep=("path",)), f"{results_path}/run=retry-{uuid.uuid4().hex}/batch_id=0")


def close_run(spark: SparkSession, results_path: str, listed: DataFrame, folder: str, **clock: object) -> None:
    """The end of a run: the log becomes one partition of current rows, and the four outputs are written anew.

    The partitions it replaces are deleted after it is whole; readers see no file twice at any time, since the
    rows keep their `stored_at`. `clock` has the two clock metrics of `tables.write_all`.
    """
    before = sorted({path.rsplit("/", 2)[0] for path in _log(spark, results_path).inputFiles()})
    kept = [*K.RESULT_COLUMNS, "path", "stored_at"]
    _latest(_log(spark, results_path)).select(kept).write.parquet(f"{results_path}/run=current-{uuid.uuid4().hex}/batch_id=0")
    for folder_before in before:
        tables.remove(spark, folder_before)
    tables.write_all(current_results(spark, results_path), listed, folder, **clock)

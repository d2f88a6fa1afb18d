"""The document job: extract, validate, and one result row per document."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from formsift import constants as K
from formsift.operators import runs
from formsift.operators.extract import extract_fields
from formsift.operators.validate import assemble_results, validate_fields
from formsift.sources import tables
from formsift.sources.store import KeyedTable, ResultStore


def process_documents(df: DataFrame, columns: list[str] = K.RESULT_COLUMNS, keep: tuple[str, ...] = ()) -> DataFrame:
    """Result rows for documents (file_name, raw_text, error, processed_at, processing_time_seconds).

    A map over the input: no shuffle between the scan and the result. With fewer columns only the fields
    and verdicts behind them are worked out. A document with an error is FAILED without fields whatever its text is
    (V19), so its text is not searched.
    """
    if "error" in df.columns and "raw_text" not in keep:
        df = df.withColumn("raw_text", F.when(F.col("error").isNull(), F.col("raw_text")))
    verdict = [c for c in K.VERDICT if c in columns]
    fields = [c for c in K.FIELDS if c in columns or (verdict and c in K.CHECKED_FIELDS)]
    rows = extract_fields(df, fields=fields) if fields else df
    return assemble_results(validate_fields(rows, columns=verdict) if verdict else rows, columns, keep)


#: Tasks a core that `dealt_out` makes, so that one long task does not hold up the rest.
TASKS_PER_CORE = 4


def dealt_out(df: DataFrame) -> DataFrame:
    """Documents over all cores in equal numbers, whatever files they lie in and whatever names they bear.

    Extraction takes about a millisecond a document: a file that a reader takes as one split keeps one core busy for
    minutes, while the others wait. Moving the texts takes a hundredth of that.
    """
    return df.repartition(TASKS_PER_CORE * df.sparkSession.sparkContext.defaultParallelism)


def next_run(texts: DataFrame, listed: DataFrame, results: DataFrame, size: int | None = 50, retry_failed: bool = True) -> DataFrame:
    """One batch run: results after the next slice of pending documents is processed.

    Documents are the listed paths. Where two of them have one base name, both are processed and the later path's
    result stays, as the result's key is the base name. A listed document without a text keeps its old result.
    The new results are stored once, since the merge reads them twice.
    """
    batch = tables.stored(runs.next_batch(runs.pending(listed, runs.done_files(results, retry_failed)), size), "batch")
    todo = texts.join(batch.select("path"), "path", "left_semi")
    new = tables.stored(process_documents(todo, keep=("path",)), "new")
    return runs.upsert(results, new, order=["path"])


def run_batch(
    texts: KeyedTable, listed: DataFrame, store: ResultStore, size: int | None = 50, retry_failed: bool = True
) -> list[int]:
    """One batch run over stored tables: the next slice of pending documents goes into the store.

    Only the buckets of the batch's paths are read from the texts, and only those of its file names are read and
    written in the results; the store's counters follow. Returns the buckets of results that were written.
    """
    todo = runs.next_batch(runs.pending(listed, runs.done_files(store.read(), retry_failed)), size)
    batch = tables.stored(todo.select("path"), "batch")
    new = process_documents(texts.of_keys(batch), keep=("path",))
    touched = store.upsert(new, ["path"], "batch", store.next_number())
    tables.forget(batch)
    return touched

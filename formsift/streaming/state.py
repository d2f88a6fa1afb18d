"""The last result of every file as streaming state, written through to stored results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from formsift import constants as K
from formsift.functions import text as T
from formsift.plans.documents import dealt_out, process_documents
from formsift.sources.store import ResultStore

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
CONF = {
    "spark.sql.streaming.stateStore.providerClass": ROCKS,
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
#: What makes one result later than another: the file it came with, then the path, as a batch works in path order.
ORDER = ["arrived_at", "path", "processed_at"]


def latest_results(documents: DataFrame) -> DataFrame:
    """G1 over a stream of documents with `arrived_at` and `path`: the last result of every file name.

    Extraction and validation are a map, so they run on the stream itself. Results are reduced to one a key in each task
    before they reach the state; in update mode a batch gives the keys whose last result it changed.
    """
    rows = process_documents(dealt_out(documents), keep=("arrived_at", "path"))
    rows = rows.withColumn("file_name", T.strip(F.col("file_name"))).where("file_name <> ''")
    rest = [c for c in rows.columns if c != "file_name"]
    last = rows.groupBy("file_name").agg(F.max_by(F.struct(*rest), F.struct(*ORDER)).alias("last"))
    return last.select("file_name", "last.*")


def ingest_latest(
    spark: SparkSession,
    source: str,
    schema: StructType,
    store: ResultStore,
    checkpoint: str,
    max_files: int = 50,
    glob: str | None = None,
    prepare: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> None:
    """Takes every new parquet file of documents below `source` into the store, at most `max_files` a micro-batch.

    The state in the checkpoint holds the last result of every file name, so no log is read again: a micro-batch rewrites
    the store's buckets of the keys that it changed, and its counters follow. A batch that was interrupted is run again
    by the next call, with the same outcome. A document without a path goes by its file name. A document that failed is
    handed in again as a new file.
    """
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    arriving = prepare(reader.parquet(source).withColumn("arrived_at", F.col("_metadata.file_modification_time")))
    if "path" not in arriving.columns:
        arriving = arriving.withColumn("path", F.col("file_name"))

    def store_batch(changed: DataFrame, number: int) -> None:
        stream = changed.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        store.upsert(changed.select(*K.RESULT_COLUMNS, "arrived_at", "path"), ORDER, f"stream-{stream}", number)

    before = {k: spark.conf.get(k, None) for k in CONF}
    for k, v in CONF.items():
        spark.conf.set(k, v)
    try:
        query = (
            latest_results(arriving).writeStream.outputMode("update").foreachBatch(store_batch)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    query.awaitTermination()

"""Exact duplicates as a stream with keyed state on disk.

State is a streaming aggregation in RocksDB without a watermark, so nothing in it expires: digest, the row that stays
(its id, then its place as the tie-break), and the number of rows. Copies are aggregated before they are shuffled, so
a text that a third of all rows share reaches the state as one row of each task. Texts themselves are not part of the
state; where a digest has been hit again, whole texts are compared.
"""

from __future__ import annotations

from collections.abc import Callable
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from formsift.llm import base

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": ROCKS,
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "128",
    # no disk is taken in advance: there are many small stores
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
#: The set of digest prefixes that were hit again is broadcast; it has at most 16 ** PREFIX entries at any size.
PREFIX = 5


def sha256(normalised: Column) -> Column:
    return F.sha2(normalised.cast("binary"), 256)


def located(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(doc_id, text, file, place): the locator is the file and the row's place in it, so that a text can be read again.

    Rows that come from no file are written to the shared folder first.
    """
    def with_place(df: DataFrame, key: str, text: str) -> DataFrame:
        return df.select(
            F.col(f"`{key}`").cast("long").alias("doc_id"),
            F.col(f"`{text}`").cast("string").alias("text"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.row_index").alias("place"),
        )

    try:
        if "_metadata" not in docs.columns:
            return with_place(docs, key, text)
    except AnalysisException:
        pass
    return with_place(base.staged(docs.select(F.col(f"`{key}`"), F.col(f"`{text}`")), "located"), key, text)


def dedup_state(keyed: DataFrame, state_path: str, checkpoint: str) -> StreamingQuery:
    """Runs the stream over all files of a table of (digest, doc_id, file, place) that are new since the checkpoint.

    keyed is a streaming DataFrame. Each micro-batch writes the state rows it changed as its own folder, so a batch
    that is repeated after a failure overwrites what it wrote.
    """
    rows = keyed.groupBy("digest").agg(
        F.max(F.struct("doc_id", "file", "place")).alias("best"), F.count(F.lit(1)).alias("n")
    )

    def keep(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{state_path}/batch={batch}")

    spark = keyed.sparkSession
    before = {k: spark.conf.get(k, None) for k in STATE_CONF}
    for k, v in STATE_CONF.items():
        spark.conf.set(k, v)
    try:
        return (
            rows.writeStream.outputMode("update")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .foreachBatch(keep)
            .start()
        )
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def exact_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", digest: Callable[[Column], Column] = sha256
) -> DataFrame:
    """doc_id, keep_id, group_size, kept, digest, file, place for every row, dropped ones too.

    Texts are equal when their bytes are, after lower-casing A-Z only; null counts as empty. The row with the largest
    doc_id stays; of repeated rows with that id, one (the last by file and place). A null doc_id comes after all
    others; a group without any id has a null keep_id and one row that stays. An empty table gives an empty one.
    Columns other than the two are not read. digest must give a string of at least PREFIX characters; a digest that
    different texts share is told apart by the texts.
    """
    spark = docs.sparkSession
    rows = located(docs, key, text)
    keyed = base.staged(digests(rows, digest), "digests")
    source = keyed.inputFiles()
    if not source:
        return spark.createDataFrame([], RESULT)
    folder = base.shared_folder(spark, "dedup")
    stream = spark.readStream.schema(keyed.schema).parquet(source[0].rsplit("/", 1)[0])
    dedup_state(stream, f"{folder}/state", f"{folder}/checkpoint").awaitTermination()
    return judged(rows, keyed, last_state(spark, f"{folder}/state"), digest)


def digests(rows: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    return rows.select("doc_id", "file", "place", digest(base.ascii_lower(F.col("text"))).alias("digest"))


def last_state(spark: SparkSession, path: str) -> DataFrame:
    """(digest, best, n). A digest may be in several batches; state only grows, so its largest row is its last one."""
    changed = spark.read.parquet(path)
    batches = changed.select("batch").distinct().count()
    return changed.drop("batch") if batches < 2 else changed.groupBy("digest").agg(
        F.max("best").alias("best"), F.max("n").alias("n")
    )


def judged(rows: DataFrame, keyed: DataFrame, state: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    """The result for keyed rows by the state of their digests; rows has the whole texts of all that share a digest."""
    normal = base.ascii_lower(F.col("text"))
    # whole texts of digests that were hit again: equal digests must mean equal texts
    prefix = F.substring("digest", 1, PREFIX)
    hit = state.where("n > 1").select(prefix.alias("prefix")).distinct()
    texts = rows.select("doc_id", "file", "place", normal.alias("normal")).withColumn("digest", digest(F.col("normal")))
    texts = texts.withColumn("prefix", prefix).join(F.broadcast(hit), "prefix", "left_semi")
    classes = texts.groupBy("digest", "normal").agg(
        F.max(F.struct("doc_id", "file", "place")).alias("best"), F.count(F.lit(1)).alias("n")
    )
    classes = base.staged(classes.select("digest", "best", "n"), "classes")
    clash = classes.groupBy("digest").count().where("count > 1").select("digest")
    if clash.isEmpty():
        grouped = keyed.join(state, "digest")
    else:  # different texts under one digest: these rows are grouped by their texts
        clash = base.staged(clash, "clash")
        of_text = texts.join(clash, "digest", "left_semi")
        own = of_text.groupBy("digest", "normal").agg(
            F.max(F.struct("doc_id", "file", "place")).alias("best"), F.count(F.lit(1)).alias("n")
        )
        alone = keyed.join(clash, "digest", "left_anti").join(state, "digest")
        mine = of_text.join(keyed.select("file", "place"), ["file", "place"], "left_semi")
        apart = mine.join(own, ["digest", "normal"]).select(alone.columns)
        grouped = alone.unionByName(apart)
    here = F.struct("doc_id", "file", "place")
    return grouped.select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), F.col("n").alias("group_size"),
        here.eqNullSafe(F.col("best")).alias("kept"), "digest", "file", "place",
    )


def further_duplicates(
    docs: DataFrame, state: str, batch: str, key: str = "doc_id", text: str = "text",
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """exact_duplicates for a further table, against every table that the folder `state` has seen, and adds it there.

    keep_id and group_size tell of all tables so far: a copy that comes later with a larger id stays in place of the
    one before, which a later call for its table says too. The folder holds the stream's checkpoint with its state,
    the digests and their locators, and outlives sessions. `batch` names the table: one that was interrupted is given
    again under its name and counts once. Texts of earlier tables are read again where a digest is hit, by their
    locators, so their files (Parquet, with the same name for `text`) have to stay. Nulls, ties, repeated rows and empty
    tables are as in exact_duplicates. Calls on one folder follow each other; they do not run side by side.
    """
    spark = docs.sparkSession
    own = f"{state}/digests/{batch}"
    if not base.exists(spark, f"{own}/_SUCCESS"):
        digests(located(docs, key, text), digest).write.mode("overwrite").parquet(own)
    schema = "doc_id long, file string, place long, digest string"
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(f"{state}/digests")
    dedup_state(stream, f"{state}/state", f"{state}/checkpoint").awaitTermination()
    if not base.exists(spark, f"{state}/state"):
        return spark.createDataFrame([], RESULT)
    keyed = spark.read.schema(schema).parquet(own)
    seen = last_state(spark, f"{state}/state")
    every = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(f"{state}/digests")
    # the digests of this table that have more than one row, and the files where all their rows lie
    hit = seen.where("n > 1").join(keyed.select("digest").distinct(), "digest", "left_semi").select("digest")
    known = base.staged(every.join(hit, "digest", "left_semi").select("doc_id", "file", "place"), "hits")
    # locators are encoded as addresses, paths are not
    files = [unquote(r.file) for r in known.select("file").distinct().collect()]
    if not files:
        return judged(no_rows(spark), keyed, seen, digest)
    there = spark.read.parquet(*files).select(
        F.col(f"`{text}`").cast("string").alias("text"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("place"),
    )
    rows = known.join(there, ["file", "place"]).select("doc_id", "text", "file", "place")
    return judged(rows, keyed, seen, digest)


def no_rows(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "doc_id long, text string, file string, place long")


RESULT = "doc_id long, keep_id long, group_size long, kept boolean, digest string, file string, place long"


def drop_exact_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with all their columns, whatever their names.

    Of equal texts (A-Z lower-cased, null as empty) the row with the largest key stays, one row of repeated ones; a null
    key is less than any other. An empty table gives an empty one.
    """
    at = [f"{name}_{base.fresh()}" for name in ("file", "place")]
    try:
        whole = docs.select("*", F.col("_metadata.file_path").alias(at[0]), F.col("_metadata.row_index").alias(at[1]))
    except AnalysisException:
        return drop_exact_duplicates(base.staged(docs, "documents"), key, text)
    gone = base.staged(exact_duplicates(docs, key, text).where("not kept").select(
        F.col("file").alias(at[0]), F.col("place").alias(at[1])
    ), "gone")
    return base.without(whole, gone, at).drop(*at)

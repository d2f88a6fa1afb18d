"""What the operators share: reading tables, staged tables, block-wise work on Arrow batches."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Bytes of text that a worker handles at once; a longer text is handled alone.
SLICE_BYTES = 1 << 21


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is; null becomes empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())


def held_out(key: Column, parts: int) -> Column:
    """True where crc32 of the key as text is divisible by parts; false for a null key."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % parts == 0, F.lit(False))


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the one that spark.checkpoint.dir names.

    Where it is unset, as in tests on one machine, a temporary folder is made and set; on a cluster that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        import tempfile

        base = tempfile.mkdtemp(prefix="formsift-llm-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def fresh() -> str:
    """A name that nothing else has."""
    return uuid.uuid4().hex


def staged(df: DataFrame, name: str) -> DataFrame:
    """Writes a table to the shared folder and reads it back: cuts the lineage and survives a lost executor."""
    folder = shared_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def discard(df: DataFrame) -> None:
    """Deletes the folder of a table that staged() made, once nothing reads it any more."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        remove(df.sparkSession, folder)


def remove(spark: SparkSession, folder: str) -> None:
    """Deletes a folder on whatever file system it is."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is such a file or folder, on whatever file system it is."""
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


_HELD: list[tuple[object, object]] = []


def held(key: object, make: Callable[[], object] | None = None) -> object:
    """What a worker keeps between tasks: one thing only, so that operators after each other do not add up.

    Asking for another thing, or for none (no make), drops the one before and gives its memory back.
    """
    if not _HELD or _HELD[0][0] != key:
        had = bool(_HELD)
        _HELD.clear()
        if had:
            gc.collect()
            give_back()
        _HELD.append((key, make() if make else None))
    return _HELD[0][1]


def give_back() -> None:
    """Gives memory that this worker no longer uses back to the machine: a worker outlives its tasks, idle or not."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def tidy(work: Callable[..., Iterator[pa.RecordBatch]]) -> Callable[..., Iterator[pa.RecordBatch]]:
    """A task's function over batches that gives memory back when the task ends."""

    def worked(*batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(*batches)
        finally:
            give_back()

    return worked


def slices(batch: pa.RecordBatch, column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about `most` bytes of text each, so that memory follows the longest text only."""
    texts = batch.column(batch.schema.get_field_index(column))
    sizes = pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False)
    start = total = 0
    for i, n in enumerate(sizes.tolist()):
        if total and total + n > most:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if start < batch.num_rows:
        yield batch.slice(start)


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def short_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Sets the session's Arrow batches to fewer rows than Spark's 10,000: texts are long, and a batch is held several
    times on its way to a worker and back. A number of rows that the session was given itself is left as it is."""
    if spark.conf.get(BATCH_ROWS) == "10000":
        spark.conf.set(BATCH_ROWS, str(rows))


def texts_only(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, text) under fixed names, whatever else the table holds; a null text is empty."""
    short_batches(docs.sparkSession)
    return docs.select(
        F.col(f"`{key}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")
    )


#: Values of a key's hash that without() broadcasts at most, at any size of the tables.
BUCKETS = 1 << 20


def without(df: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of df whose keys (null is a value) are not in gone.

    The hash buckets of what goes are broadcast, BUCKETS rows at most; only rows in such a bucket are shuffled.
    """
    # names that no column of either table has
    mark = f"bucket_{fresh()}"

    def bucket(columns: list[Column]) -> Column:
        return F.pmod(F.xxhash64(*columns), F.lit(BUCKETS)).alias(mark)

    own = [F.col(f"`{k}`") for k in keys]
    gone = gone.select(*(c.alias(f"{mark}_{i}") for i, c in enumerate(own)))
    hits = gone.select(bucket([F.col(c) for c in gone.columns])).distinct()
    dealt = df.withColumn(mark, bucket(own))
    far = dealt.join(F.broadcast(hits), mark, "left_anti").drop(mark)
    near = dealt.join(F.broadcast(hits), mark, "left_semi").drop(mark)
    same = [c.eqNullSafe(F.col(f"{mark}_{i}")) for i, c in enumerate(own)]
    condition = same[0]
    for more in same[1:]:
        condition &= more
    return far.unionByName(near.join(gone, condition, "left_anti"))

"""Readers (S1-S4) and writers."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from formsift import constants as K
from formsift.operators import report as R, runs

RESULT_TYPES = {
    "processed_at": "timestamp",
    "processing_time_seconds": "double",
    **{name: "double" for name in K.CONFIDENCES},
}
TRUTH_COLUMNS = ["file_name", "file_type", *K.CHECKED_FIELDS, "notes"]


def list_documents(spark: SparkSession, root: str) -> DataFrame:
    """PDF paths under a folder, in order, empty files too; only names are read, never file contents."""
    from formsift.sources.files import list_files

    return list_files(spark, root, ".pdf").select("path").orderBy("path")


def select_documents(manifest: DataFrame, prefix: str) -> DataFrame:
    """S1 over a manifest table with a `path` column."""
    folder = prefix.rstrip("/") + "/"
    return manifest.filter(F.col("path").startswith(folder) & F.lower("path").endswith(".pdf")).orderBy("path")


def cached_text_name(file_name: Column) -> Column:
    """Name of the text file that belongs to a document."""
    return F.replace(file_name, F.lit(".pdf"), F.lit(".txt"))


def decode_text(content: Column) -> Column:
    """Bytes to text, invalid bytes replaced, NULL to ''."""
    return F.coalesce(F.make_valid_utf8(content.cast("string")), F.lit(""))


def document_name(text_name: Column) -> Column:
    """Name of the document that a cached text belongs to."""
    return F.regexp_replace(text_name, r"\.txt\z", ".pdf")


def read_ocr_texts(spark: SparkSession, root: str) -> DataFrame:
    """One row per file, (file_name, raw_text): the document's name, and the whole text as one value, '' if it is empty."""
    from formsift.sources.files import read_files

    return read_files(spark, root).select(
        document_name(F.substring_index("path", "/", -1)).alias("file_name"), decode_text(F.col("content")).alias("raw_text")
    )


def write_text_files(texts: DataFrame, root: str) -> None:
    """One file for each row (below, name, raw_text) in the folder `below` of root, written by the row's task."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = fs.FileSystem.from_uri(root)
        made = set()
        for batch in batches:
            for below, name, text in zip(*(batch.column(c).to_pylist() for c in ("below", "name", "raw_text")), strict=True):
                folder = f"{top}/{below}".rstrip("/")
                if folder not in made:
                    store.create_dir(folder, recursive=True)
                    made.add(folder)
                with store.open_output_stream(f"{folder}/{name}", compression=None) as file:
                    file.write((text or "").encode())
            yield batch.select(["name"])

    rows = texts.select("below", "name", "raw_text").mapInArrow(write, "name string")
    rows.write.format("noop").mode("overwrite").save()


def _csv(spark: SparkSession, path: str, columns: list[str], one_line: bool) -> tuple[DataFrame, list[Column]]:
    """A CSV table with the names of its header, and the wanted columns of it: text, '' where it has none."""
    rows = spark.read.csv(path, header=True, multiLine=not one_line, escape='"', encoding="UTF-8")
    there = {c.lstrip("\ufeff").strip(): c for c in rows.columns}
    return rows, [
        (F.coalesce(F.col(f"`{there[c]}`"), F.lit("")) if c in there else F.lit("")).alias(c) for c in columns
    ]


def read_results_csv(
    spark: SparkSession, path: str, columns: list[str] = K.RESULT_COLUMNS, one_line: bool = False
) -> DataFrame:
    """S3: results from CSV as text, by the names of the header, the last row of a repeated file winning.

    The order of columns does not matter; one that is not there is blank, further ones are left out.

    Row order is (file, offset of the split, position in the split). Values may hold line breaks, so a
    file is one split; pass `one_line` for large files without such values, which then split. For
    volume keep results as a table (`write_results`).
    """
    rows, wanted = _csv(spark, path, columns, one_line)
    rows = rows.select(
        *wanted,
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
    )
    return R.latest_by_key(rows, "file_name", ["_file", "_block", "_row"]).select(columns)


def read_truth_csv(spark: SparkSession, path: str, one_line: bool = False) -> DataFrame:
    """Ground truth from CSV by the names of the header, repeated rows kept."""
    rows, wanted = _csv(spark, path, TRUTH_COLUMNS, one_line)
    return rows.select(*wanted)


def typed(rows: DataFrame) -> DataFrame:
    """Text rows cast to the result schema; blanks and what cannot be cast become NULL."""
    return rows.select(
        *[
            F.nullif(F.col(c), F.lit("")).try_cast(RESULT_TYPES.get(c, "string")).alias(c)
            for c in rows.columns
        ]
    )


def as_text(rows: DataFrame) -> DataFrame:
    """CSV form: every value text, NULL as ''; NULL first becomes '' since CSV tells them apart."""
    return rows.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in rows.columns])


def write_csv(rows: DataFrame, path: str) -> None:
    as_text(rows).write.mode("overwrite").csv(path, header=True, escape='"', emptyValue="", quoteAll=False)


def remove(spark: SparkSession, folder: str) -> None:
    """Deletes a folder on whatever file system it is."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def staging(spark: SparkSession, path: str) -> Iterator[str]:
    """A folder beside an output, removed when the block ends, after a failure as well."""
    folder = f"{path.rstrip('/')}.staging-{uuid.uuid4().hex}"
    try:
        yield folder
    finally:
        remove(spark, folder)


def _write(rows: DataFrame, path: str, fmt: str) -> None:
    if fmt == "csv":
        write_csv(rows, path)
    else:
        rows.write.mode("overwrite").parquet(path)


def write_results(
    results: DataFrame, path: str, columns: list[str] = K.RESULT_COLUMNS, fmt: str = "parquet"
) -> None:
    """Results in fixed column order, sorted by file, replacing what was there.

    A global sort first samples its input and then reads it again. The rows are stored unsorted before,
    beside the output, so that the documents behind them are worked on once.
    """
    spark = results.sparkSession
    with staging(spark, path) as folder:
        results.select(columns).write.parquet(folder)
        _write(spark.read.parquet(folder).orderBy("file_name"), path, fmt)


def write_manual_review(results: DataFrame, path: str, columns: list[str] = K.RESULT_COLUMNS, fmt: str = "parquet") -> None:
    """The rows a person has to look at."""
    write_results(runs.manual_review(results), path, columns, fmt)


def write_all(
    results: DataFrame,
    listed: DataFrame,
    folder: str,
    batch_seconds: float | None = None,
    updated_at: str | None = None,
) -> None:
    """The four outputs of a run; the summary has its two clock metrics where their values are given.

    The results are worked out once: the other three are taken from the written table, which also cuts
    their lineage. What is written sorted is not sorted again.
    """
    spark = results.sparkSession
    write_results(results, f"{folder}/results")
    stored = spark.read.parquet(f"{folder}/results")
    _write(runs.manual_review(stored).select(K.RESULT_COLUMNS).orderBy("file_name"), f"{folder}/manual_review", "parquet")
    R.run_summary(stored, listed, batch_seconds=batch_seconds, updated_at=updated_at).write.mode("overwrite").parquet(f"{folder}/summary")
    R.status_statistics(stored).write.mode("overwrite").parquet(f"{folder}/status_statistics")


def load_table(rows: DataFrame, table: str, path: str) -> DataFrame:
    """Text rows cast to the result schema replace a table."""
    typed(rows).write.mode("overwrite").option("path", path).format("parquet").saveAsTable(table)
    return rows.sparkSession.table(table)


def cast_problems(rows: DataFrame) -> Column:
    """For text rows: the columns whose value is there but cannot be cast, with the value and the type it should have."""
    bad = [
        F.when(
            F.nullif(F.col(c), F.lit("")).isNotNull() & F.nullif(F.col(c), F.lit("")).try_cast(kind).isNull(),
            F.struct(F.lit(c).alias("problem"), F.col(c).alias("value"), F.lit(f"not a {kind}").alias("reason")),
        )
        for c, kind in RESULT_TYPES.items() if c in rows.columns
    ]
    return F.filter(F.array(*bad), lambda p: p.isNotNull())


def load_with_rejects(rows: DataFrame, table: str, path: str) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """S8 with a quarantine: (table, rejects, counts); text rows replace a table, those that fail a cast go aside.

    One pass writes both, as two partitions of one folder, and counts rows and rejects on the way. A reject keeps what
    could be cast and has in `problems` each column that could not, with its value and the reason. Blanks are NULL, no
    problem.
    """
    spark = rows.sparkSession
    seen = Observation()
    out = rows.select(
        *[F.nullif(F.col(c), F.lit("")).try_cast(RESULT_TYPES.get(c, "string")).alias(c) for c in rows.columns],
        cast_problems(rows).alias("problems"),
    )
    out = out.withColumn("rejected", F.size("problems") > 0)
    out = out.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if("rejected").alias("rejects"))
    out.write.mode("overwrite").partitionBy("rejected").parquet(path)
    columns = [f for f in out.schema.fields if f.name in rows.columns]
    for kept in ("false", "true"):  # a part without rows is an empty folder
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/rejected={kept}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)
    spark.sql(f"CREATE TABLE {table} ({names}) USING parquet LOCATION '{path}/rejected=false'")
    whole = StructType([f for f in out.schema.fields if f.name != "rejected"])
    return spark.table(table), spark.read.schema(whole).parquet(f"{path}/rejected=true"), seen.get


def append_results(rows: DataFrame, path: str) -> None:
    """Appends a batch of results in the columns and types of the warehouse table; absent ones are NULL."""
    rows.select(
        *[(F.col(c) if c in rows.columns else F.lit(None)).cast(kind).alias(c) for c, kind in K.TABLE_TYPES.items()]
    ).write.mode("append").parquet(path)


def write_reports(results: DataFrame, folder: str) -> None:
    """Detail, status and type-by-status reports."""
    R.detail_report(results).write.mode("overwrite").parquet(f"{folder}/detail")
    R.status_summary(results).write.mode("overwrite").parquet(f"{folder}/status_summary")
    R.pipeline_summary(results).write.mode("overwrite").parquet(f"{folder}/pipeline_summary")


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own below the shared folder the session names in spark.checkpoint.dir.

    Only where none is set, and only in local mode, a temporary folder is used.
    """
    import tempfile

    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="formsift-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Rows written to the shared folder and read back: worked out once, however often they are read."""
    folder = scratch_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def forget(df: DataFrame) -> None:
    """Deletes what `stored` wrote, once nothing reads it any more."""
    for folder in {path.rsplit("/", 1)[0] for path in df.inputFiles()}:
        remove(df.sparkSession, folder)

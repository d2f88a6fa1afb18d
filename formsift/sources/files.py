"""Many small files: a listing made by many tasks, and reading packed by bytes; empty files are files too.

Spark's own file readers pass over files of no bytes, and give a task few files where each counts for as much as a block.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from formsift.sources import tables

LISTED = "path string, length bigint"
CONTENT = "path string, content binary"
#: Folders that are listed by tasks of their own, at least, where there are so many.
FOLDERS = 64
#: Bytes a task reads, and what opening a file counts for; rows go on when so many bytes are read.
PACK_BYTES, OPEN_BYTES, BATCH_BYTES = 32 << 20, 64 << 10, 8 << 20


class Folder(InputPartition):
    def __init__(self, below: str, deep: bool):
        self.below, self.deep = below, deep


class FolderListing(DataSource):
    """`spark.read.format("folder_listing").option("suffix", ".pdf").load(root)`: (path, length) of all files below a folder."""

    @classmethod
    def name(cls) -> str:
        return "folder_listing"

    def schema(self) -> str:
        return LISTED

    def reader(self, schema: object) -> DataSourceReader:
        return FolderReader(self.options["path"].rstrip("/"), self.options.get("suffix", "").lower())


class FolderReader(DataSourceReader):
    def __init__(self, root: str, suffix: str):
        self.root, self.suffix = root, suffix

    def partitions(self) -> list[Folder]:
        """Folders with all that is below them, and the folders above those with their own files only."""
        store, top = fs.FileSystem.from_uri(self.root)
        whole, opened = deque([""]), []
        while whole and len(whole) < FOLDERS:
            below = whole.popleft()
            inner = [f.base_name for f in store.get_file_info(fs.FileSelector(f"{top}/{below}")) if f.type == fs.FileType.Directory]
            opened.append(Folder(below, deep=False))
            whole.extend(f"{below}{name}/" for name in inner)
        return opened + [Folder(below, deep=True) for below in whole]

    def read(self, partition: Folder) -> Iterator[tuple[str, int]]:
        store, top = fs.FileSystem.from_uri(self.root)
        for f in store.get_file_info(fs.FileSelector(f"{top}/{partition.below}", recursive=partition.deep)):
            if f.type == fs.FileType.File and f.path.lower().endswith(self.suffix):
                yield f"{self.root}/{f.path.removeprefix(top).lstrip('/')}", f.size


def list_files(spark: SparkSession, root: str, suffix: str = "") -> DataFrame:
    """(path, length) of the files below a folder whose names end in the suffix, upper or lower case; empty ones too.

    The store must be one that pyarrow opens by the folder's address (local, hdfs, s3, gs, abfs).
    """
    spark.dataSource.register(FolderListing)
    return spark.read.format("folder_listing").option("suffix", suffix).load(root)


def read_files(spark: SparkSession, root: str, suffix: str = "", pack_bytes: int = PACK_BYTES) -> DataFrame:
    """(path, content) of every file below a folder. Files are dealt to as many tasks as their bytes need."""
    listed = tables.stored(list_files(spark, root, suffix), "listing")
    cost = listed.agg(F.sum(F.greatest(F.col("length"), F.lit(OPEN_BYTES)))).first()[0] or 0

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = fs.FileSystem.from_uri(root)
        paths, contents, size = [], [], 0

        def given() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(contents, pa.binary())], ["path", "content"])

        for batch in batches:
            for path in batch.column("path").to_pylist():
                with store.open_input_file(f"{top}/{path.removeprefix(root.rstrip('/')).lstrip('/')}") as file:
                    contents.append(file.read())
                paths.append(path)
                size += len(contents[-1])
                if size >= BATCH_BYTES:
                    yield given()
                    paths, contents, size = [], [], 0
        if paths:
            yield given()

    tasks = max(1, -(-cost // pack_bytes))
    return listed.repartition(tasks, "path").select("path").mapInArrow(read, CONTENT)

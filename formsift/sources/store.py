"""Tables in hash buckets of their key, so that a batch reads and writes the buckets of its own keys only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from formsift import constants as K
from formsift.operators import report as R
from formsift.sources import tables

FACTS = "name string, value string"
BUCKET = "bucket"


def exists(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


class KeyedTable:
    """Rows by a key, in parquet partitions by the key's hash. The number of buckets is fixed when the table is made.

    A bucket is what one task rewrites when a key of it changes: with many rows, take many buckets.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        facts = dict(spark.read.schema(FACTS).parquet(f"{self.folder}/facts").collect())
        self.key, self.buckets = facts["key"], int(facts["buckets"])
        self.schema = StructType.fromDDL(facts["schema"])

    @classmethod
    def create(cls, spark: SparkSession, folder: str, key: str, schema: StructType, buckets: int = 1024) -> KeyedTable:
        """A new table without rows."""
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.createDataFrame([], schema).withColumn(BUCKET, F.lit(0)).write.partitionBy(BUCKET).parquet(f"{folder}/rows")
        facts = [("key", key), ("buckets", str(buckets)), ("schema", ddl)]
        spark.createDataFrame(facts, FACTS).coalesce(1).write.parquet(f"{folder}/facts")
        return cls(spark, folder)

    def bucket(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def rows(self) -> DataFrame:
        """All rows with their bucket."""
        schema = StructType([*self.schema.fields, StructField(BUCKET, IntegerType())])
        return self.spark.read.schema(schema).parquet(f"{self.folder}/rows")

    def read(self) -> DataFrame:
        return self.rows().drop(BUCKET)

    def only(self, touched: list[int]) -> DataFrame:
        """The rows of some buckets; the others are pruned when the plan is made."""
        return self.rows().where(F.col(BUCKET).isin(touched))

    def touched(self, keys: DataFrame) -> list[int]:
        """The buckets of some keys: numbers, no more than the table has buckets."""
        own = keys.select(self.bucket(F.col(self.key)).alias(BUCKET)).distinct()
        return sorted(r[0] for r in own.collect() if r[0] is not None)

    def of_keys(self, keys: DataFrame) -> DataFrame:
        """The rows of some keys (a stored table of them), from their buckets only."""
        return self.only(self.touched(keys)).drop(BUCKET).join(keys.select(self.key), self.key, "left_semi")

    def upsert(
        self, new: DataFrame, order: list[str], before: Callable[[DataFrame, DataFrame], None] | None = None
    ) -> list[int]:
        """New rows replace rows of the same key; of new rows with one key the last by `order` stays.

        `new` is worked out once. Only buckets that hold one of its keys are read and written; repeating a call changes
        nothing. `before` sees the new rows and those they replace while the table is still as it was. Returns the
        buckets written.
        """
        last = R.latest_by_key(new, self.key, order)
        columns = [F.col(f.name).cast(f.dataType) for f in self.schema.fields]
        fresh = tables.stored(last.select(*columns, self.bucket(F.col(self.key)).alias(BUCKET)), "upsert")
        touched = sorted(r[0] for r in fresh.select(BUCKET).distinct().collect())
        old = self.only(touched)
        keys = fresh.select(BUCKET, self.key)
        if before:
            before(fresh.drop(BUCKET), old.join(keys, [BUCKET, self.key], "left_semi").drop(BUCKET))
        if touched:
            kept = old.join(keys, [BUCKET, self.key], "left_anti").select(*self.schema.names, BUCKET)
            whole = kept.unionByName(fresh).repartition(BUCKET)
            whole.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(
                f"{self.folder}/rows"
            )
        tables.forget(fresh)
        return touched


#: kind "count": rows of a file type (a) and status (b) and their seconds; kind "done": the last batch (n) of a source (a).
COUNTERS = "kind string, a string, b string, n bigint, seconds decimal(38,6)"


class ResultStore:
    """Results by file name with running counters, so that statistics need no pass over the results.

    Each batch adds its rows to the counters and takes away those it replaces. The counters after a batch are written
    as a version of their own before the results change. A batch that was interrupted is told by its source and number:
    given again, it counts nothing twice and its rows are written again.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.table = KeyedTable(spark, f"{self.folder}/results")

    @classmethod
    def create(cls, spark: SparkSession, folder: str, buckets: int = 1024) -> ResultStore:
        fields = {c: tables.RESULT_TYPES.get(c, "string") for c in K.RESULT_COLUMNS}
        schema = StructType.fromDDL(", ".join(f"{c} {kind}" for c, kind in fields.items()))
        KeyedTable.create(spark, f"{folder.rstrip('/')}/results", "file_name", schema, buckets)
        spark.createDataFrame([], COUNTERS).coalesce(1).write.parquet(f"{folder.rstrip('/')}/counters/version=0")
        return cls(spark, folder)

    def read(self) -> DataFrame:
        return self.table.read().select(K.RESULT_COLUMNS)

    def _path(self, name: str) -> object:
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")

    def _fs(self, path: object) -> object:
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _versions(self, name: str) -> list[int]:
        path = self._path(name)
        files = self._fs(path).listStatus(path) if self._fs(path).exists(path) else []
        return sorted(int(f.getPath().getName().split("=")[1]) for f in files if "=" in f.getPath().getName())

    def version(self) -> int:
        """The last version of the counters that is whole."""
        whole = [v for v in self._versions("counters") if exists(self.spark, f"{self.folder}/counters/version={v}/_SUCCESS")]
        return whole[-1]

    def next_number(self) -> int:
        """A number for the next batch of a source that has none of its own: the same after a batch that was interrupted."""
        return max(self._versions("applied"), default=0) + 1

    def counters(self, version: int | None = None) -> DataFrame:
        """The counters as they are after the last batch: a few rows, whatever the results hold."""
        number = self.version() if version is None else version
        return self.spark.read.schema(COUNTERS).parquet(f"{self.folder}/counters/version={number}")

    def upsert(self, new: DataFrame, order: list[str], source: str, number: int) -> list[int]:
        """Batch `number` of `source`: batches of a source come in ascending order, the last one perhaps again."""
        version = self.version()
        done = self.counters(version).where((F.col("kind") == "done") & (F.col("a") == source)).agg(F.max("n")).first()[0]

        def count(fresh: DataFrame, replaced: DataFrame) -> None:
            mark = self.spark.createDataFrame([("done", source, None, number, None)], COUNTERS)
            parts = self.counters(version).unionByName(counted(fresh, 1)).unionByName(counted(replaced, -1)).unionByName(mark)
            total = parts.groupBy("kind", "a", "b").agg(
                F.when(F.col("kind") == "done", F.max("n")).otherwise(F.sum("n")).alias("n"),
                F.sum("seconds").cast("decimal(38,6)").alias("seconds"),
            )
            # what a crash left of this version is replaced
            total.coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/counters/version={version + 1}")

        touched = self.table.upsert(new, order, count if done is None or done < number else None)
        self._fs(self._path("applied")).mkdirs(self._path(f"applied/version={self.version()}"))
        if version > 1:
            tables.remove(self.spark, f"{self.folder}/counters/version={version - 2}")
        return touched

    def statistics(self) -> DataFrame:
        """G4 from the counters."""
        return R.statistics_of(R.section_counts(self.counters().where("kind = 'count'").select(
            F.col("a").alias("file_type"), F.col("b").alias("status"), "n"
        ), F.col("n")))

    def summary(self, listed: DataFrame | None = None, found: int | None = None, **clock: object) -> DataFrame:
        """G5 from the counters; the listing, if given, is counted."""
        return R.summary_of_counts(
            self.counters().where("kind = 'count'").select(F.col("a").alias("file_type"), F.col("b").alias("status"), "n", "seconds"),
            listed, found, **clock,
        )

    def write_reports(self, folder: str, listed: DataFrame, **clock: object) -> None:
        """S7 without a pass over the results for the statistics; the review list is a filter on them."""
        from formsift.operators import runs

        runs.manual_review(self.read()).select(K.RESULT_COLUMNS).write.mode("overwrite").parquet(f"{folder}/manual_review")
        self.summary(listed, **clock).write.mode("overwrite").parquet(f"{folder}/summary")
        self.statistics().write.mode("overwrite").parquet(f"{folder}/status_statistics")


def counted(rows: DataFrame, sign: int) -> DataFrame:
    """Signed counts and seconds by file type and status."""
    return rows.groupBy(F.col("file_type").alias("a"), F.col("status").alias("b")).agg(
        (F.count(F.lit(1)) * sign).alias("n"), (F.sum(R.seconds_taken(F.col("processing_time_seconds"))) * sign).alias("seconds")
    ).select(F.lit("count").alias("kind"), "a", "b", "n", F.col("seconds").cast("decimal(38,6)").alias("seconds"))

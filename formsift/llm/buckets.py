"""Tables that lie in hash buckets of their keys, sorted within, so that joins on the keys need no shuffle of theirs."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from formsift.llm import base


def bucket_count(spark: SparkSession) -> int:
    """As many buckets as the session has shuffle partitions: what an aggregation by the keys gives fits as it is."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


class Bucketed:
    """A parquet folder in buckets, known to the session under a name that nobody else uses."""

    def __init__(self, spark: SparkSession, folder: str, keys: list[str], buckets: int, columns: str):
        self.spark, self.folder, self.keys, self.buckets, self.columns = spark, folder, keys, buckets, columns
        self.name = f"formsift_{uuid.uuid4().hex}"

    @classmethod
    def written(cls, df: DataFrame, keys: list[str], folder: str, buckets: int | None = None) -> Bucketed:
        """Writes df, whose rows should already be dealt by the keys, into buckets."""
        spark = df.sparkSession
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)
        own = cls(spark, folder, keys, buckets or bucket_count(spark), columns)
        df.write.format("parquet").bucketBy(own.buckets, *keys).sortBy(*keys).option("path", folder).saveAsTable(own.name)
        return own

    @classmethod
    def found(cls, spark: SparkSession, folder: str, keys: list[str], buckets: int, columns: str) -> Bucketed:
        """Makes a folder that an earlier session wrote known again."""
        own = cls(spark, folder, keys, buckets, columns)
        by = ", ".join(keys)
        spark.sql(
            f"CREATE TABLE {own.name} ({columns}) USING parquet "
            f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{folder}'"
        )
        return own

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def plain(self) -> DataFrame:
        """The same rows without their buckets: for joins with skewed tables, which Spark then splits."""
        return self.spark.read.schema(self.columns).parquet(self.folder)

    def forget(self) -> None:
        """Takes the name away; the folder stays."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def discard(self) -> None:
        self.forget()
        base.remove(self.spark, self.folder)

"""Lines that many documents share, by levelled sorted runs of line hashes.

A run is a table (h1, h2, n, top) in hash buckets, sorted within each: the 128-bit hash of a line's key, how many
documents of the run's batches hold it, and the largest id among them. A new batch is reduced to one row a key,
merge-anti-joined with the runs, and what is left becomes a run of its own in level 0. The anti-join takes out keys
that a run already settles: enough documents hold them there, and one with a larger id. A level that is full is merged
into one run of the next, so a batch meets few runs, and a key is rewritten once a level.

Runs lie in the same buckets, so an anti-join does not shuffle them; a merge does, once a level. The list of runs is appended to a
manifest when a batch is done; a batch that was lost is run again, one that is done is not.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from formsift.llm import base
from formsift.llm.buckets import Bucketed, bucket_count
from formsift.llm.exact_dedup import located

WHITE = b" \t\n\v\f\r"
KEYS = ["h1", "h2"]
RUN = "h1 bigint, h2 bigint, n bigint, top bigint"
#: Runs of one level that are merged into one of the next.
FAN = 3
#: Batches into which one table is dealt.
BATCHES = 6
#: Keys with more than this share of a sample's lines are joined by broadcast, so there are fewer than 1,024 of them.
HEAVY = 1024
SAMPLED = 16


def line_keys(text: bytes, points: int) -> list[bytes | None]:
    """The key of every line: stripped and in lower case (A-Z); None where it has fewer than `points` code points."""
    def long(key: bytes) -> bool:
        return len(key) >= points and (len(key) >= 4 * points or key.isascii() or len(key.decode()) >= points)

    return [key if long(key) else None for key in (line.strip(WHITE) for line in text.lower().split(b"\n"))]


def line_hashes(docs: DataFrame, points: int, batches: int) -> DataFrame:
    """(file, place, id, h1, h2, batch): one row for each different key of a row, whose batch goes by its place."""

    @base.tidy
    def hashed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for rows in base.slices(part):
                texts = rows.column("text").cast(pa.large_binary()).to_pylist()
                own = [{xxhash.xxh3_128_digest(k) for k in line_keys(t, points) if k is not None} for t in texts]
                which = np.repeat(np.arange(len(own)), [len(d) for d in own])
                both = np.frombuffer(b"".join(d for of_row in own for d in of_row), dtype="<i8").reshape(-1, 2)
                kept = [rows.column(c).take(pa.array(which)) for c in ("file", "place", "id", "batch")]
                yield pa.RecordBatch.from_arrays(
                    [*kept[:3], pa.array(both[:, 0]), pa.array(both[:, 1]), kept[3]], ["file", "place", "id", *KEYS, "batch"]
                )

    rows = docs.withColumn("batch", F.pmod(F.xxhash64("file", "place"), F.lit(batches)).cast("int"))
    return rows.mapInArrow(hashed, "file long, place long, id long, h1 long, h2 long, batch int")


class LineRuns:
    """The runs below a folder, which outlives the session."""

    def __init__(self, spark: SparkSession, folder: str, least: int = 3, fan: int = FAN):
        self.spark, self.folder, self.least, self.fan = spark, folder.rstrip("/"), least, fan
        self.manifest = f"{self.folder}/manifest"
        self.levels: list[list[Bucketed]] = []
        self.done: list[str] = []
        self.buckets = bucket_count(spark)
        self.reopen()

    def reopen(self) -> None:
        """Takes up what the manifest's last entry lists."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.manifest)
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return
        entries = self.spark.read.schema("done array<string>, level int, run string, buckets int").parquet(self.manifest)
        last = entries.groupBy().agg(F.max(F.size("done"))).first()[0]
        for row in entries.where(F.size("done") == last).orderBy("level", "run").collect():
            self.done, self.buckets = row["done"], row["buckets"]
            while len(self.levels) <= row["level"]:
                self.levels.append([])
            if row["run"]:
                run = Bucketed.found(self.spark, f"{self.folder}/{row['run']}", KEYS, self.buckets, RUN)
                self.levels[row["level"]].append(run)

    def runs(self) -> list[Bucketed]:
        return [run for level in self.levels for run in level]

    def add(self, batch: str, lines: DataFrame) -> None:
        """Takes in a batch (id, h1, h2), one row for each document and different key; nothing if it is done already."""
        if batch in self.done:
            return
        own = lines.groupBy(KEYS).agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("top"))
        for run in self.runs():
            had = run.read().where(F.col("n") >= self.least).select(
                F.col("h1").alias("r1"), F.col("h2").alias("r2"), F.col("top").alias("r_top")
            )
            larger = F.coalesce(F.col("top") <= F.col("r_top"), F.col("top").isNull())
            own = own.join(had.hint("merge"), (F.col("h1") == F.col("r1")) & (F.col("h2") == F.col("r2")) & larger, "left_anti")
        self._put(0, own)
        level, gone = 0, []
        while len(self.levels[level]) >= self.fan:
            gone += self.levels[level]
            whole = self._merged(self.levels[level])
            self.levels[level] = []
            self._put(level + 1, whole)
            level += 1
        self.done.append(batch)
        self._list()
        for run in gone:
            run.discard()

    def keys(self) -> DataFrame:
        """(h1, h2, n, top) of the keys that enough documents hold. n counts no more than what settles a key."""
        if not self.runs():
            return self.spark.createDataFrame([], RUN)
        return self._merged(self.runs()).where(F.col("n") >= self.least)

    def discard(self) -> None:
        for run in self.runs():
            run.discard()
        base.remove(self.spark, self.folder)

    def _merged(self, runs: list[Bucketed]) -> DataFrame:
        # plain(): an aggregate over a union of bucketed scans would take each scan's buckets as the union's
        rows = runs[0].plain()
        for run in runs[1:]:
            rows = rows.unionByName(run.plain())
        return rows.groupBy(KEYS).agg(F.sum("n").alias("n"), F.max("top").alias("top"))

    def _put(self, level: int, rows: DataFrame) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        folder = f"{self.folder}/run-{len(self.done)}-{level}-{base.fresh()}"
        self.levels[level].append(Bucketed.written(rows, KEYS, folder, self.buckets))

    def _list(self) -> None:
        rows = [
            (self.done, level, run.folder.rsplit("/", 1)[1], self.buckets)
            for level, of_level in enumerate(self.levels) for run in of_level
        ]
        entry = self.spark.createDataFrame(rows, "done array<string>, level int, run string, buckets int")
        entry.coalesce(1).write.mode("append").parquet(self.manifest)


def dropped_hashes(lines: DataFrame, keys: DataFrame) -> DataFrame:
    """(file, place, gone): for rows that lose lines the hashes of their keys.

    Keys that a sample of the rows shows to be frequent, fewer than HEAVY, meet the lines by broadcast; the others are
    shuffled, and none of them is frequent.
    """
    sample = lines.where(F.pmod(F.xxhash64("place", "file"), F.lit(SAMPLED)) == 0)
    total = sample.count()
    heavy = sample.groupBy(KEYS).count().where(F.col("count") * HEAVY > total).select(KEYS)
    heavy = base.staged(heavy, "heavy")
    often = keys.join(F.broadcast(heavy), KEYS, "left_semi").select(*KEYS, "top")
    seldom = keys.join(F.broadcast(heavy), KEYS, "left_anti").select(*KEYS, "top")
    hit = lines.join(F.broadcast(often), KEYS).unionByName(
        lines.join(F.broadcast(heavy), KEYS, "left_anti").join(seldom, KEYS)
    )
    hit = hit.where(~F.col("id").eqNullSafe(F.col("top")))
    return hit.groupBy("file", "place").agg(F.collect_list(F.struct(*KEYS)).alias("gone"))


def without_lines(rows: DataFrame, points: int) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept) from (id, text, gone)."""

    @base.tidy
    def kept(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for batch in base.slices(part):
                gone = batch.column("gone")
                counts, dropped, out = [], [], []
                for text, of_row in zip(batch.column("text").cast(pa.large_binary()).to_pylist(), gone, strict=True):
                    lines = text.split(b"\n")
                    counts.append(len(lines))
                    if of_row.is_valid:
                        h = of_row.values
                        both = np.stack([h.field(0).to_numpy(), h.field(1).to_numpy()], axis=1).astype("<i8").tobytes()
                        mine = {both[i : i + 16] for i in range(0, len(both), 16)}
                        keys = line_keys(text, points)
                        lines = [x for x, k in zip(lines, keys, strict=True) if k is None or xxhash.xxh3_128_digest(k) not in mine]
                    dropped.append(counts[-1] - len(lines))
                    out.append(b"\n".join(lines).decode())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), pa.array(counts, pa.int64()), pa.array(dropped, pa.int64()), pa.array(out, pa.string())],
                    ["doc_id", "n_lines", "n_dropped", "kept"],
                )

    return rows.select("id", "text", "gone").mapInArrow(kept, "doc_id long, n_lines long, n_dropped long, kept string")


def dedup_lines(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    points: int = 20,
    least: int = 3,
    batches: int = BATCHES,
    runs: LineRuns | None = None,
) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept for every row: its text without the lines that other documents hold as well.

    A text is split at line feeds; a null or empty one is one empty line. A line's key is the line without ASCII white
    space at both ends, A-Z in lower case. A key of at least `points` code points in at least `least` rows loses all
    its lines but those of the rows with the largest key column holding it. What stays is joined by line feeds, "" if
    nothing does. Every row counts as a document, repeated ones too; rows that share the largest id all keep their
    lines; a null id is less than any other. Other columns are not read. An empty table gives an empty one.

    With `runs`, the table counts together with all batches those runs hold, and stays in them; the names of its
    batches are then its own, so call it with a new folder or a new table.
    """
    spark = docs.sparkSession
    base.short_batches(spark)
    rows = located(docs, key, text).select(
        F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("text"), F.xxhash64("file").alias("file"), "place"
    )
    folder = base.shared_folder(spark, "line-hashes")
    line_hashes(rows, points, batches).write.partitionBy("batch").parquet(folder)
    schema = "file long, place long, id long, h1 long, h2 long, batch int"
    lines = spark.read.schema(schema).parquet(folder)
    own = runs or LineRuns(spark, base.shared_folder(spark, "line-runs"), least)
    name = folder.rsplit("/", 1)[1]
    for batch in range(batches):
        own.add(f"{name}/{batch}", lines.where(F.col("batch") == batch))
    keys = base.staged(own.keys(), "line-keys")
    gone = dropped_hashes(lines, keys)
    whole = rows.join(gone, ["file", "place"], "left")
    if runs is None:
        own.discard()
    return without_lines(whole, points)

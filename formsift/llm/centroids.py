"""Lloyd's clustering with the columns of all vectors dealt out to shards.

A shard has a block of columns: of every vector those components, and of every centroid the same slice. Its tasks work out
exact partial squared distances; these are added over the shards (a reduce by key, the key being a chunk of vectors) and
give each vector its nearest centroid. The assignments go back to the shards, each adds up its own columns per cluster
and moves its own slice of the centroids. No task ever needs a whole vector or a whole centroid.

The shards' columns lie in hash buckets of (block, chunk), so they are never shuffled: what travels in a round are the
partial distances and the assignments. The slices of all centroids are k times the components, a parameter's size, and
are broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formsift.llm import base
from formsift.llm.buckets import Bucketed
from formsift.llm.whole import finite, matrix, product, scaled

#: Vectors of a chunk: partial distances of a chunk are one row.
CHUNK_ROWS = 2048
#: The block that holds a chunk's ids in place of columns.
IDS = -1
COLUMNS = "block int, chunk long, n int, data binary"
SIZES = {2: np.int16, 4: np.int32, 8: np.int64}


def packed(values: np.ndarray) -> bytes:
    """Whole numbers in as few bytes each (2, 4 or 8) as hold all of them."""
    most = int(np.abs(values).max(initial=0))
    kind = next(kind for size, kind in SIZES.items() if most < 1 << (8 * size - 1))
    return values.astype(kind).tobytes()


def unpacked(data: bytes, rows: int, width: int) -> np.ndarray:
    kind = SIZES[len(data) // max(1, rows * width)] if rows * width else np.int64
    return np.frombuffer(data, dtype=kind).astype(np.int64).reshape(rows, width)


def chunked(vectors: DataFrame, dims: int, width: int) -> DataFrame:
    """(block, chunk, n, data) from (id, v): vectors that a task reads after each other form its chunks, by columns."""

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for part in parts:
            for at in range(0, part.num_rows, CHUNK_ROWS):
                rows = part.slice(at, CHUNK_ROWS)
                v = matrix(rows.column("v"), dims)
                ids = rows.column("id")
                valid = ids.is_valid().to_numpy(zero_copy_only=False)
                data = [ids.fill_null(0).to_numpy().tobytes() + valid.tobytes()]
                data += [packed(v[:, a : a + width]) for a in range(0, dims, width)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(range(IDS, len(data) - 1), pa.int32()), pa.array([number] * len(data), pa.int64()),
                        pa.array([rows.num_rows] * len(data), pa.int32()), pa.array(data, pa.binary()),
                    ],
                    ["block", "chunk", "n", "data"],
                )
                number += 1

    return vectors.mapInArrow(cut, COLUMNS)


def partial_distances(columns: DataFrame, slices: object, k: int) -> DataFrame:
    """(block, chunk, n, data): a shard's part of every vector's squared distance to every centroid; ids as they are."""

    def worked(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for block, chunk, n, data in zip(*(part.column(c).to_pylist() for c in ("block", "chunk", "n", "data")), strict=True):
                if block != IDS:
                    own = slices.value[block]
                    v = unpacked(data, n, own.shape[1])
                    data = packed((v * v).sum(axis=1)[:, None] - 2 * product(v, own) + (own * own).sum(axis=1)[None, :])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block], pa.int32()), pa.array([chunk]), pa.array([n], pa.int32()), pa.array([data], pa.binary())],
                    ["block", "chunk", "n", "data"],
                )

    return columns.mapInArrow(worked, COLUMNS)


def assigned(partials: DataFrame, k: int) -> DataFrame:
    """(chunk, n, clusters, distances, ids) from the shards' parts, added over the shards of a chunk."""

    def added(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        total, ids = 0, None
        for block, n, data in zip(*(rows[c].to_pylist() for c in ("block", "n", "data")), strict=True):
            if block == IDS:
                ids = data
            else:
                total = total + unpacked(data, n, k)
        nearest = total.argmin(axis=1)  # the first of equals: the smaller number
        least = np.take_along_axis(total, nearest[:, None], axis=1)[:, 0]
        return pa.table({
            "chunk": pa.array([key[0].as_py()], pa.int64()), "n": pa.array([n], pa.int32()),
            "clusters": pa.array([nearest.astype(np.int32).tobytes()], pa.binary()),
            "distances": pa.array([least.astype(np.int64).tobytes()], pa.binary()), "ids": pa.array([ids], pa.binary()),
        })

    return partials.groupBy("chunk").applyInArrow(added, "chunk long, n int, clusters binary, distances binary, ids binary")


def cluster_sums(rows: DataFrame, widths: list[int], k: int) -> DataFrame:
    """(block, cluster, place, total, n): a task adds up its chunks' columns per cluster before anything is shuffled."""

    def summed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        counts: dict[int, np.ndarray] = {}

        def given() -> Iterator[pa.RecordBatch]:
            for block, total in totals.items():
                cluster, place = np.indices(total.shape).reshape(2, -1)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(total.size, block, dtype=np.int32)), pa.array(cluster.astype(np.int32)),
                        pa.array(place.astype(np.int32)), pa.array(total.ravel()), pa.array(counts[block][cluster]),
                    ],
                    ["block", "cluster", "place", "total", "n"],
                )

        for part in parts:
            for block, n, data, clusters in zip(*(part.column(c).to_pylist() for c in ("block", "n", "data", "clusters")), strict=True):
                v = unpacked(data, n, widths[block])
                which = np.frombuffer(clusters, dtype=np.int32)
                total = totals.setdefault(block, np.zeros((k, widths[block]), dtype=np.int64))
                np.add.at(total, which, v)
                counts.setdefault(block, np.zeros(k, dtype=np.int64))
                counts[block] += np.bincount(which, minlength=k)
                if np.abs(total).max(initial=0) > 1 << 61:
                    yield from given()
                    totals.clear()
                    counts.clear()
        yield from given()

    return rows.mapInArrow(summed, "block int, cluster int, place int, total long, n long")


def centroid_clusters(
    vectors: DataFrame,
    k: int = 40,
    rounds: int = 5,
    dims: int = 64,
    scale: int = 256,
    width: int = 32,
    key: str = "vec_id",
    vector: str = "embedding",
    seed: str = "2:",
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid (its components joined by ",") for every vector.

    Vectors with exactly `dims` components, none of them null or not finite, are kept; component x becomes
    floor(scale * x). The first centroids are the k vectors whose sha256 of seed and key is least. In each round every
    vector goes to the nearest centroid (squared distance, ties to the smaller number), and a centroid with vectors
    moves to floor(sum / count) of them; one without stays. Then vectors are assigned once more. With fewer than k
    vectors there are fewer centroids. Repeated rows count as often as they occur (a null key hashes as empty text, and
    among equal hashes the smaller components come first). A component of 2^27 or more after scaling is an error. Other
    columns are not read. An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    kept = vectors.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{vector}`").alias("x"))
    kept = kept.where(finite("x") & (F.size("x") == dims)).select("id", scaled("x", scale).alias("v"))
    order = F.sha2(F.concat(F.lit(seed), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    first = kept.orderBy(order, "v").limit(k).select("v").collect()
    if not first:
        return spark.createDataFrame([], RESULT)
    k = len(first)
    own = np.array([r["v"] for r in first], dtype=np.int64)
    cuts = list(range(0, dims, width))
    widths = [min(width, dims - a) for a in cuts]
    columns = Bucketed.written(
        chunked(kept, dims, width).repartition("block", "chunk"), ["block", "chunk"], base.shared_folder(spark, "columns")
    )

    def nearest(with_ids: bool) -> DataFrame:
        sent = spark.sparkContext.broadcast([own[:, a : a + width] for a in cuts])
        rows = columns.plain() if with_ids else columns.plain().where(F.col("block") != IDS)
        found = base.staged(assigned(partial_distances(rows, sent, k), k), "assigned")
        sent.destroy()
        return found

    for _ in range(rounds):
        found = nearest(False)
        back = found.select(F.explode(F.sequence(F.lit(0), F.lit(len(cuts) - 1))).alias("block"), "chunk", "clusters")
        shards = columns.read().where(F.col("block") != IDS).join(back.hint("merge"), ["block", "chunk"])
        sums = cluster_sums(shards.select("block", "n", "data", "clusters"), widths, k)
        total = F.sum(F.col("total").cast("decimal(38,0)"))
        sums = sums.groupBy("block", "cluster", "place").agg(total.alias("total"), F.sum("n").alias("n")).where("n > 0")
        for block, cluster, place, total, n in sums.collect():  # k times dims rows at most
            own[cluster, cuts[block] + place] = int(total) // n
        base.discard(found)

    found = nearest(True)
    rows = base.staged(found.mapInArrow(spread, "vec_id long, cluster int, distance long"), "clusters")
    base.discard(found)
    columns.discard()
    of_cluster = dict(rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)"))).collect())
    every = int(sum(of_cluster.values()))
    facts = spark.createDataFrame(
        [(c, int(s), every, ",".join(map(str, own[c].tolist()))) for c, s in of_cluster.items()],
        "cluster int, cluster_inertia long, inertia long, centroid string",
    )
    return rows.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"
    )


RESULT = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid string"


def spread(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for every vector of a chunk."""
    for part in parts:
        for ids, clusters, distances in zip(*(part.column(c).to_pylist() for c in ("ids", "clusters", "distances")), strict=True):
            nearest, least = np.frombuffer(clusters, dtype=np.int32), np.frombuffer(distances, dtype=np.int64)
            own = np.frombuffer(ids, dtype=np.int64, count=len(nearest))
            null = ~np.frombuffer(ids, dtype=bool, offset=8 * len(nearest))
            yield pa.RecordBatch.from_arrays(
                [pa.array(own, mask=null), pa.array(nearest), pa.array(least)], ["vec_id", "cluster", "distance"]
            )

"""Hard negatives by slots: every anchor's windows of scores overlap, the slots between their upper limits do not.

An anchor has one window for each positive, from a share of the positive's score up to that score. The different upper
limits, in descending order, cut the scores into disjoint slots; a window is the slots from its own upper limit
downwards, as far as its lower limit. A task keeps the k best rows of each anchor and slot that it has seen (a combiner),
tasks are merged to the k best of all, and then the slots are merged from the lowest one upwards: the k best of slot j
and below are the first k of slot j's followed by those of the slots below. Each window reads its answer off there, so
every score is worked out once however many windows hold it, and k rows a slot is all that travels.

Anchors are the stated query set. They are taken in waves of bounded size; a wave is broadcast, and the rows stream past
it in blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from formsift.llm import base
from formsift.llm.whole import finite, matrix, product, scaled

LOWEST = np.iinfo(np.int64).min
#: Bytes of anchors' vectors in one broadcast.
WAVE_BYTES = 32 << 20
#: Scores that a worker holds at once: rows of a block times anchors of a tile.
BLOCK_ROWS, TILE_ANCHORS = 1024, 1024

Kept = tuple[np.ndarray, np.ndarray, np.ndarray]  # key, score, id


class Best:
    """The k first (score descending, id ascending) of every key seen so far, keys being 0 to n - 1."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.kth = np.full(n, LOWEST)
        self.rows: Kept = tuple(np.empty(0, dtype=np.int64) for _ in range(3))
        self.waiting: list[Kept] = []
        self.size = 0

    def add(self, key: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        self.waiting.append((key, score, ids))
        self.size += len(key)
        if self.size > 1 << 20:
            self.settle()

    def settle(self) -> Kept:
        key, score, ids = (np.concatenate(parts) for parts in zip(self.rows, *self.waiting, strict=True))
        order = np.lexsort((ids, -score, key))
        key, score, ids = key[order], score[order], ids[order]
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]][: len(key)])
        rank = np.arange(len(key)) - np.repeat(first, np.diff(np.r_[first, len(key)]))
        kept = rank < self.k
        self.rows, self.waiting, self.size = (key[kept], score[kept], ids[kept]), [], 0
        last = rank == self.k - 1
        self.kth[key[last]] = score[last]
        return self.rows


def tile_best(scores: np.ndarray, allowed: np.ndarray, best: Best, key: np.ndarray, ids: np.ndarray) -> None:
    """Adds what may be among the k best of each column's key: no score below the tile's kth or the key's so far."""
    own = np.where(allowed, scores, LOWEST)
    least = np.maximum(best.kth[key], LOWEST + 1)
    if len(own) > best.k:
        least = np.maximum(least, np.partition(own, len(own) - best.k, axis=0)[len(own) - best.k])
    row, column = np.nonzero(own >= least)
    best.add(key[column], own[row, column], ids[row])


class Wave:
    """Some anchors as arrays; with their positives' scores once these are known."""

    def __init__(self, rows: list, width: int):
        self.row = np.array([r["row"] for r in rows], dtype=np.int64)
        self.id = np.array([r["id"] for r in rows], dtype=np.int64)
        self.label = np.array([r["label"] for r in rows], dtype=np.int64)
        self.v = np.array([r["v"] for r in rows], dtype=np.int64).reshape(len(rows), width)


def positives_of(wave: Wave, k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def found(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(wave.row), k)
        for ids, labels, scores, tile in tiles(parts, wave):
            allowed = (labels[:, None] == wave.label[None, tile]) & (ids[:, None] != wave.id[None, tile])
            tile_best(scores, allowed, best, np.arange(len(wave.row))[tile], ids)
        yield from given(wave, *best.settle(), np.zeros(0))

    return found


def slots_of(wave: Wave, limits: np.ndarray, k: int, share: tuple[int, int]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """limits: for each anchor its windows' upper limits in descending order, LOWEST where there are fewer."""
    low, high = share
    slots = limits.shape[1]

    def found(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(wave.row) * slots, k)
        for ids, labels, scores, tile in tiles(parts, wave):
            other = (labels[:, None] != wave.label[None, tile]) & (ids[:, None] != wave.id[None, tile])
            for j in range(slots):
                upper = limits[tile, j]
                under = limits[tile, j + 1] if j + 1 < slots else np.full(len(upper), LOWEST)
                # the lowest lower limit of all windows over this slot is that of the window that begins in it
                reached = upper > LOWEST
                floor = -(-low * np.where(reached, upper, 0) // high)
                allowed = other & reached & (scores <= upper) & (scores > under) & (scores >= floor)
                if allowed.any():
                    tile_best(scores, allowed, best, (np.arange(len(wave.row)) * slots + j)[tile], ids)
        key, score, found_ids = best.settle()
        yield from given(wave, key // slots, score, found_ids, key % slots)

    return found


def tiles(parts: Iterator[pa.RecordBatch], wave: Wave) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, slice]]:
    """Ids, labels and scores of some rows against some anchors."""
    for part in parts:
        for at in range(0, part.num_rows, BLOCK_ROWS):
            batch = part.slice(at, BLOCK_ROWS)
            ids, labels = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "label"))
            v = matrix(batch.column("v"), wave.v.shape[1])
            for a in range(0, len(wave.row), TILE_ANCHORS):
                tile = slice(a, min(a + TILE_ANCHORS, len(wave.row)))
                yield ids, labels, product(v, wave.v[tile]), tile


def given(wave: Wave, anchor: np.ndarray, score: np.ndarray, ids: np.ndarray, slot: np.ndarray) -> Iterator[pa.RecordBatch]:
    if not len(slot):
        slot = np.zeros(len(anchor))
    for at in range(0, len(anchor), 1 << 16):
        cut = slice(at, at + (1 << 16))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(wave.row[anchor[cut]]), pa.array(slot[cut].astype(np.int32)), pa.array(ids[cut]), pa.array(score[cut]),
            ],
            ["row", "slot", "id", "score"],
        )


FOUND = "row long, slot int, id long, score long"


def first_of_all(found: DataFrame, k: int) -> DataFrame:
    """The k best of every anchor and slot from those of all tasks; a task sends k rows a key at most."""
    best = Window.partitionBy("row", "slot").orderBy(F.desc("score"), "id")
    return found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k)


def merged_suffixes(slots: DataFrame, positives: DataFrame, k: int, share: tuple[int, int]) -> DataFrame:
    """Every positive's window from the slots of its anchor, which are at most as many as it has positives.

    Slots are merged from the lowest upwards: below[j] is the first k of slot j's rows followed by below[j + 1].
    """
    low, high = share
    lists = slots.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("slot", (-F.col("score")).alias("less"), "id"))).alias("found"))
    below = F.expr(
        f"""aggregate(
            sequence(size(limits) - 1, 0, -1),
            cast(array() AS array<array<struct<slot: int, less: bigint, id: bigint>>>),
            (done, j) -> concat(
                array(slice(concat(filter(found, r -> r.slot = j), coalesce(get(done, 0), array())), 1, {k})), done
            )
        )"""
    )
    limits = positives.groupBy("row").agg(F.sort_array(F.collect_set("score"), asc=False).alias("limits"))
    merged = lists.join(limits, "row").select("row", "limits", below.alias("below"))
    upper = F.col("score")
    own = F.expr("get(below, cast(array_position(limits, score) AS int) - 1)")
    inside = F.filter(own, lambda r: F.lit(low) * upper <= F.lit(high) * -r["less"])
    return positives.join(merged, "row").select(
        "row", F.col("id").alias("positive_id"), upper.alias("positive_score"), F.posexplode(inside).alias("at", "r")
    )


def hard_negatives(
    vectors: DataFrame,
    every: int = 100,
    scale: int = 256,
    n_positives: int = 5,
    k: int = 5,
    share: tuple[int, int] = (80, 100),
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    wave_bytes: int = WAVE_BYTES,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are rows whose key is divisible by `every`; scores are inner products of floor(scale * x), higher ones first,
    ties by the smaller key. An anchor's positives are its first n_positives rows of the same label, and for each of them
    the first k rows of another label whose score is at most the positive's and at least the given share of it.
    Rows with a null key, a null label, a null or empty vector, or a component that is null or not finite take no
    part; only vectors of the same length meet. An anchor's own key is neither its positive nor its negative. Repeated
    rows count as often as they occur, as anchors, positives and negatives. A negative positive score has an empty
    window. A component of 2^27 or more after scaling, or a score that may leave 64 bits, is an error. Other columns are
    not read. A table that is empty or has no anchors gives an empty result.
    """
    spark = vectors.sparkSession
    rows = vectors.select(
        F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{label}`").cast("long").alias("label"), F.col(f"`{vector}`").alias("x")
    ).where(F.col("id").isNotNull() & F.col("label").isNotNull() & finite("x"))
    rows = rows.select("id", "label", F.size("x").alias("dim"), scaled("x", scale).alias("v"))
    rows = base.staged(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")
    asked = rows.where(F.col("id") % every == 0)
    folder = base.shared_folder(spark, "hard-negatives")
    empty = True
    for dim, n in sorted(tuple(r) for r in asked.groupBy("dim").count().collect()):
        most = max(1, wave_bytes // (8 * dim))
        waves = -(-n // most)
        of_dim = rows.where(F.col("dim") == dim).select("id", "label", "v")
        for number in range(waves):
            # dealt by the row, so a wave holds about as many as any other; the last bytes are slack
            part = asked.where((F.col("dim") == dim) & (F.pmod(F.xxhash64("row"), F.lit(waves)) == number))
            wave = Wave(part.orderBy("row").collect(), dim)
            if len(wave.row):
                _mine(of_dim, wave, n_positives, k, share, folder)
                empty = False
    base.discard(rows)
    if empty:
        return spark.createDataFrame([], RESULT)
    return spark.read.schema(RESULT).parquet(folder)


RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def _mine(rows: DataFrame, wave: Wave, n_positives: int, k: int, share: tuple[int, int], folder: str) -> None:
    """Appends the result for the anchors of one wave to the folder."""
    spark = rows.sparkSession
    sent = spark.sparkContext.broadcast(wave)
    positives = rows.mapInArrow(lambda parts: positives_of(sent.value, n_positives)(parts), FOUND)
    positives = base.staged(first_of_all(positives, n_positives), "positives")
    at = {int(row): i for i, row in enumerate(wave.row)}
    limits = np.full((len(wave.row), n_positives), LOWEST)
    for row, scores in positives.groupBy("row").agg(F.sort_array(F.collect_set("score"), asc=False)).collect():
        limits[at[row], : len(scores)] = scores
    if (np.abs(limits[limits > LOWEST]) > (1 << 62) // max(share)).any():
        raise OverflowError("a positive's score times the share may leave 64 bits")
    upper = spark.sparkContext.broadcast(limits)
    slots = rows.mapInArrow(lambda parts: slots_of(sent.value, upper.value, k, share)(parts), FOUND)
    slots = base.staged(first_of_all(slots, k), "slots")
    anchors = spark.createDataFrame(list(zip(wave.row.tolist(), wave.id.tolist(), strict=True)), "row long, anchor_id long")
    merged_suffixes(slots, positives, k, share).join(anchors, "row").select(
        "anchor_id", "positive_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("r.id").alias("negative_id"),
        "positive_score", (-F.col("r.less")).alias("negative_score"),
    ).write.mode("append").parquet(folder)
    for df in (positives, slots):
        base.discard(df)
    for b in (sent, upper):
        b.destroy()

"""Exact top-k by inner product: a KD-tree for every shard, searched best-first for blocks of queries.

Rows are dealt into shards of bounded size; a shard's tree splits at the median of its widest dimension and keeps a
tight bounding box for every node. For a query the largest inner product in a box is known from its corners, so a node
is left out when that bound is below the query's kth score so far. Each block of queries searches one shard first; the
kth scores found there are handed to its searches of all other shards, so those return little beyond the real results.
"""

from __future__ import annotations

import heapq
import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from formsift.llm import base

SHARD_ROWS = 4096
BLOCK_QUERIES = 256
LEAF_ROWS = 64
LOWEST = np.iinfo(np.int64).min
#: Products and their differences stay within 64 bits below this.
MOST_SQUARE = 2.0**61


@dataclass
class Tree:
    ids: np.ndarray
    rows: np.ndarray  # in the order of the leaves
    low: np.ndarray
    high: np.ndarray
    span: list[tuple[int, int]]
    children: list[tuple[int, int] | None]


def build(ids: np.ndarray, rows: np.ndarray) -> Tree:
    """Median splits on the widest dimension down to LEAF_ROWS rows, or to rows that are all alike."""
    order = np.arange(len(ids))
    low, high, span, children = [], [], [], []

    def node(begin: int, end: int) -> int:
        own = rows[order[begin:end]]
        at = len(span)
        low.append(own.min(axis=0))
        high.append(own.max(axis=0))
        span.append((begin, end))
        children.append(None)
        width = high[at] - low[at]
        if end - begin > LEAF_ROWS and width.max() > 0:
            middle = (end - begin) // 2
            order[begin:end] = order[begin:end][np.argpartition(own[:, int(width.argmax())], middle)]
            children[at] = node(begin, begin + middle), node(begin + middle, end)
        return at

    node(0, len(ids))
    return Tree(ids[order], rows[order], np.array(low), np.array(high), span, children)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T in whole numbers; through doubles where every sum fits into them exactly."""
    largest = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    return (a.astype(float) @ b.astype(float).T).astype(np.int64) if largest < 1 << 53 else a @ b.T


def search(tree: Tree, ids: np.ndarray, queries: np.ndarray, k: int, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The k best (scores, ids) of the tree's rows for each query, from those that reach least; LOWEST where fewer.

    Nodes are taken in the order of how far their bound is above the kth score of any query, until none reaches it.
    """
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    bound = product(up, tree.high) + product(down, tree.low)
    scores = np.full((len(ids), k), LOWEST)
    found = np.zeros((len(ids), k), dtype=np.int64)
    kth = least.copy()

    def slack(node: int) -> int:
        reach = bound[:, node] >= kth
        return int((bound[reach, node] - np.maximum(kth[reach], -(1 << 62))).max()) if reach.any() else -1

    heap = [(-slack(0), 0)]
    while heap:
        before, at = heapq.heappop(heap)
        now = slack(at)
        if now < 0:
            continue
        if heap and -now > heap[0][0]:  # other queries' kth scores have risen since
            heapq.heappush(heap, (-now, at))
            continue
        if tree.children[at]:
            for child in tree.children[at]:
                if (own := slack(child)) >= 0:
                    heapq.heappush(heap, (-own, child))
            continue
        begin, end = tree.span[at]
        for part in range(begin, end, 1024):
            rest = slice(part, min(end, part + 1024))
            which = np.flatnonzero(bound[:, at] >= kth)
            own = product(queries[which], tree.rows[rest])
            own[(ids[which, None] == tree.ids[None, rest]) | (own < kth[which, None])] = LOWEST
            hit = (own > LOWEST).any(axis=1)
            which, own = which[hit], own[hit]
            if len(which):
                all_scores = np.concatenate([scores[which], own], axis=1)
                all_ids = np.concatenate([found[which], np.broadcast_to(tree.ids[rest], own.shape)], axis=1)
                best = np.lexsort((all_ids, -np.maximum(all_scores, LOWEST + 1)), axis=1)[:, :k]
                scores[which] = np.take_along_axis(all_scores, best, axis=1)
                found[which] = np.take_along_axis(all_ids, best, axis=1)
                kth[which] = np.maximum(least[which], scores[which, -1])
    return scores, found


def exact_topk(
    vectors: DataFrame, k: int = 10, every: int = 100, scale: int = 1024, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose key is divisible by `every` its k best of all other rows.

    Components are floor(scale * x); the score is their inner product; of equal scores the smaller key comes first.
    Rows with a null key, a null or empty vector, or a component that is null or not finite take no part; only vectors
    of the same length meet. Rows with the query's own key are no results of it. Repeated rows are queries, and
    results, as often as they occur. An empty table, or one without queries, gives an empty result. Components so large
    that a product could leave 64 bits are a ValueError: no row is left out for them.
    """
    whole = f"`{vector}`"
    rows = vectors.select(F.col(f"`{key}`").cast("long").alias("id"), F.expr(f"transform({whole}, x -> cast(x AS double))").alias("v"))
    rows = rows.where("id is not null and size(v) > 0").where(
        "forall(v, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
    )
    rows = rows.select("id", F.expr(f"transform(v, x -> floor({scale} * x))").alias("v"), F.size("v").alias("dim"))
    rows = base.staged(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")
    asked = rows.where(F.col("id") % every == 0)
    # of any two vectors, and of a vector and a box's corner, the product is within sqrt(dim) times the largest square
    square = F.expr("aggregate(v, 0d, (a, x) -> a + double(x) * x) * sqrt(dim)")
    n, n_asked, largest = rows.agg(
        F.count(F.lit(1)), F.count_if(F.col("id") % every == 0), F.coalesce(F.max(square), F.lit(0.0))
    ).first()
    if largest >= MOST_SQUARE:
        raise ValueError(f"scaled components are too large for products of 64 bits: squares reach {largest:.3g}")
    shards, blocks = -(-n // SHARD_ROWS), -(-n_asked // BLOCK_QUERIES)
    if not blocks:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")

    def matrix(rows: pa.Table) -> np.ndarray:
        return rows["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(rows.num_rows, -1)

    def planted(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        tree = build(rows["id"].to_numpy(), matrix(rows))
        return pa.table({"dim": pa.array([key[0].as_py()], pa.int32()), "shard": pa.array([key[1].as_py()], pa.int64()), "tree": pa.array([pickle.dumps(tree)], pa.binary())})

    def gathered(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        block = pickle.dumps((rows["id"].to_numpy(), rows["row"].to_numpy(), matrix(rows)))
        return pa.table({"dim": pa.array([key[0].as_py()], pa.int32()), "block": pa.array([key[1].as_py()], pa.int64()), "queries": pa.array([block], pa.binary())})

    deal = F.xxhash64("id", "row")
    trees = base.staged(
        rows.groupBy("dim", F.pmod(deal, F.lit(shards)).alias("shard")).applyInArrow(planted, "dim int, shard long, tree binary"), "trees"
    )
    queries = base.staged(
        asked.groupBy("dim", F.pmod(deal, F.lit(blocks)).alias("block")).applyInArrow(gathered, "dim int, block long, queries binary"), "queries"
    )

    def searched(batches):
        for batch in batches:
            for r in batch.to_pylist():
                ids, rows, asked = pickle.loads(r["queries"])
                least = np.frombuffer(r["least"], dtype=np.int64) if r["least"] else np.full(len(ids), LOWEST)
                scores, found = search(pickle.loads(r["tree"]), ids, asked, k, least)
                which, place = np.nonzero(scores > LOWEST)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(which), r["dim"], dtype=np.int32)), pa.array(np.full(len(which), r["block"])),
                        pa.array(which), pa.array(rows[which]), pa.array(ids[which]),
                        pa.array(found[which, place]), pa.array(scores[which, place]),
                    ],
                    ["dim", "block", "place", "row", "query_id", "vec_id", "score"],
                )

    result = "dim int, block long, place long, row long, query_id long, vec_id long, score long"
    home = F.pmod(F.col("block"), F.lit(shards))
    none = F.lit(None).cast("binary").alias("least")
    first = queries.withColumn("shard", home).join(trees, ["dim", "shard"]).select("dim", "block", "queries", "tree", none)
    first = base.staged(first.mapInArrow(searched, result), "first")

    def thresholds(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        """The kth score of every query of a block in its first shard, LOWEST where that had fewer than k."""
        n = [len(pickle.loads(b)[0]) for b in left["queries"].to_pylist()]
        least = np.full(n[0] if n else 0, LOWEST)
        place, score = right["place"].to_numpy(), right["score"].to_numpy()
        for q in np.flatnonzero(np.bincount(place, minlength=len(least)) >= k):
            least[q] = score[place == q].min()
        return pa.table({
            "dim": left["dim"].cast(pa.int32()), "block": left["block"], "queries": left["queries"],
            "least": pa.array([least.tobytes()] * left.num_rows, pa.binary()),
        })

    armed = queries.groupBy("dim", "block").cogroup(first.select("dim", "block", "place", "score").groupBy("dim", "block")).applyInArrow(
        thresholds, "dim int, block long, queries binary, least binary"
    )
    # every block meets every shard; a shard's row says which, so nothing but the two is multiplied
    others = armed.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))))
    second = others.where(F.col("shard") != home).join(trees, ["dim", "shard"]).select("dim", "block", "queries", "tree", "least")
    found = first.unionByName(second.mapInArrow(searched, result))
    best = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )

"""Connected components of a graph that is spread over executors: large-star and small-star rounds."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formsift.llm import base


def forest(pairs: Iterator[tuple[int, int]]) -> dict[int, int]:
    """The smallest node of each node's component, for nodes that are not the smallest themselves."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (up := parent.get(top, top)) != top:
            top = up
        while x != top:
            parent[x], x = top, parent.get(x, x)
        return top

    for a, b in pairs:
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in list(parent)}


def contracted(edges: DataFrame) -> DataFrame:
    """The edges (a, b) of each task as a forest of stars: never more than the task has nodes."""

    def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = (p for b in batches for p in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
        stars = forest(pairs)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(stars.keys()), pa.int64()), pa.array(list(stars.values()), pa.int64())], ["a", "b"]
        )

    return edges.select("a", "b").mapInArrow(contract, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a, b), both long; a component is named by its smallest node.

    Loops and repeated edges do no harm. Minima are aggregated before the shuffle, and the joins on a node split where
    a node has very many edges. Every round is a written table; rounds end when one changes nothing.
    """
    now = base.staged(contracted(edges), "edges")
    mark = None
    while True:
        both = now.select("a", "b").unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))
        ).distinct()
        after = base.staged(small, "edges")
        state = after.agg(F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 40)))).first()
        base.discard(now)
        now = after
        if state == mark:
            break
        mark = state
    named = now.groupBy("a").agg(F.min("b").alias("component")).select(F.col("a").alias("node"), "component")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return named.unionByName(roots)

"""Best-fit packing by linear grouping.

Tokens are counted and cut in one map. What is planned is only the histogram of piece lengths, at most `capacity`
rows at any size of the input: large lengths are rounded up within groups of equal cardinality, configurations of the
few rounded sizes are filled as well as can be, the real lengths replace the rounded ones, and small lengths go best-fit
into what is left. The plan says which ranks of a length go where; every piece finds its place from its own rank.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from formsift.llm import base
from formsift.llm.wordbpe import word_bpe

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
#: Pieces that one task places at once.
PLACED_TOGETHER = 4096
#: Numbers of groups and borders of "large" that are tried; the plan with the fewest sequences is taken.
GROUPS = (64, 256, 1024)
LARGE = (0.125, 0.25)
#: A plan this close to the least number that the tokens need is taken at once.
NEAR = 1.0002


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int = 0, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces of every document's ids and the closing id; only documents over the capacity are cut."""

    @base.tidy
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, end = word_bpe(tokenizer), end_id.to_bytes(4, "little")
        for batch in batches:
            for part in base.slices(batch):
                rows: list[list] = [[], [], [], [], []]
                texts = bpe.ids_of(part.column("text").to_pylist())
                for doc, own_ids in zip(part.column("doc_id").to_pylist(), texts, strict=True):
                    ids = memoryview(own_ids + end)
                    for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                        own = ids[at : at + 4 * capacity]
                        for column, value in zip(rows, (doc, piece, at // 4, len(own) // 4, zlib.crc32(own)), strict=True):
                            column.append(value)
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds, strict=True)], names)

    return base.texts_only(docs, key, text).mapInArrow(cut, PIECES)


class Sequences:
    """Runs of sequences that hold the same lengths: (lengths with their numbers, how many sequences)."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.by_gap: dict[int, list[tuple[list[tuple[int, int]], int]]] = {}
        self.gaps: list[int] = []

    def add(self, items: list[tuple[int, int]], times: int) -> None:
        gap = self.capacity - sum(length * n for length, n in items)
        if gap not in self.by_gap:
            self.by_gap[gap] = []
            insort(self.gaps, gap)
        self.by_gap[gap].append((items, times))

    def take(self, length: int) -> tuple[list[tuple[int, int]], int] | None:
        """A run with the smallest gap that holds the length."""
        at = bisect_left(self.gaps, length)
        if at == len(self.gaps):
            return None
        runs = self.by_gap[gap := self.gaps[at]]
        run = runs.pop()
        if not runs:
            del self.by_gap[gap]
            self.gaps.pop(at)
        return run

    def best_fit(self, length: int, count: int) -> None:
        while count:
            items, times = self.take(length) or ([], count)
            fit = (self.capacity - sum(n * k for n, k in items)) // length
            each = min(fit, count)
            full = min(times, count // each)
            self.add([*items, (length, each)], full)
            if times > full and items:
                self.add(items, times - full)
            count -= each * full

    def runs(self) -> list[tuple[list[tuple[int, int]], int]]:
        return [run for gap in self.gaps for run in self.by_gap[gap]]


def best_filling(sizes: list[int], left: list[int], room: int) -> list[int]:
    """How many of each size fill the room most, at most as many as are left (a bounded knapsack over the room)."""
    used: list[tuple[int, np.ndarray]] = []
    reach = np.zeros(room + 1, dtype=bool)
    reach[0] = True
    for g, size in enumerate(sizes):
        if size > room or not left[g]:
            continue
        taken = np.zeros(room + 1, dtype=np.int64)
        now = reach.copy()
        for k in range(1, min(left[g], room // size) + 1):
            fresh = np.zeros(room + 1, dtype=bool)
            fresh[k * size :] = reach[: room + 1 - k * size]
            fresh &= ~now
            taken[fresh] = k
            now |= fresh
        used.append((g, taken))
        reach = now
        if reach[room]:
            break
    at = int(np.flatnonzero(reach)[-1])
    chosen = [0] * len(sizes)
    for g, taken in reversed(used):
        chosen[g] = int(taken[at])
        at -= chosen[g] * sizes[g]
    return chosen


def grouped_plan(counts: dict[int, int], capacity: int, groups: int, large: float) -> list[tuple[list[tuple[int, int]], int]]:
    """Sequences by linear grouping with one number of groups and one border between large and small lengths."""
    border = max(1, int(capacity * large))
    big = sorted((n for n in counts if n > border), reverse=True)
    each = max(1, -(-sum(counts[n] for n in big) // groups))
    sizes: list[int] = []
    members: list[list[list[int]]] = []  # of each group: [length, count] from the longest
    room = 0
    for length in big:
        rest = counts[length]
        while rest:
            if not room:
                sizes.append(length)
                members.append([])
                room = each
            n = min(rest, room)
            members[-1].append([length, n])
            rest, room = rest - n, room - n
    left = [sum(n for _, n in group) for group in members]
    out = Sequences(capacity)
    for g, size in enumerate(sizes):
        while left[g]:
            own = [0] * len(sizes)
            own[g] = 1
            left[g] -= 1
            for i, n in enumerate(best_filling(sizes, left, capacity - size)):
                own[i] += n
            left[g] += 1
            times = min(left[i] // n for i, n in enumerate(own) if n)
            for i, n in enumerate(own):
                left[i] -= n * times
            slots = [i for i, n in enumerate(own) for _ in range(n)]
            streams = [take_lengths(members[i], times) for i in slots]
            for lengths, n in side_by_side(streams):
                items: dict[int, int] = {}
                for length in lengths:
                    items[length] = items.get(length, 0) + 1
                out.add(list(items.items()), n)
    for length in sorted((n for n in counts if n <= border), reverse=True):
        out.best_fit(length, counts[length])
    return out.runs()


def take_lengths(group: list[list[int]], times: int) -> list[list[int]]:
    """The next documents of a group: [length, count] that add up to times."""
    taken = []
    while times:
        n = min(group[0][1], times)
        taken.append([group[0][0], n])
        group[0][1] -= n
        if not group[0][1]:
            group.pop(0)
        times -= n
    return taken


def side_by_side(streams: list[list[list[int]]]) -> Iterator[tuple[list[int], int]]:
    """The lengths that stand in the same sequence, and in how many sequences on end."""
    heads = [0] * len(streams)
    spent = [0] * len(streams)
    while heads[0] < len(streams[0]):
        n = min(s[h][1] - d for s, h, d in zip(streams, heads, spent, strict=True))
        yield [s[h][0] for s, h in zip(streams, heads, strict=True)], n
        for i, s in enumerate(streams):
            spent[i] += n
            if spent[i] == s[heads[i]][1]:
                heads[i], spent[i] = heads[i] + 1, 0


def packing_plan(counts: dict[int, int], capacity: int) -> list[tuple[list[tuple[int, int]], int]]:
    """The plan with the fewest sequences; counts has the number of pieces of each length."""
    least = -(-sum(length * n for length, n in counts.items()) // capacity)
    best: list[tuple[list[tuple[int, int]], int]] = []
    fewest = None
    for groups in GROUPS:
        for large in LARGE:
            runs = grouped_plan(counts, capacity, groups, large)
            n = sum(times for _, times in runs)
            if fewest is None or n < fewest:
                best, fewest = runs, n
            if fewest <= max(least, int(least * NEAR)):
                return best
    return best


def places(runs: list[tuple[list[tuple[int, int]], int]]) -> np.ndarray:
    """Rows (length, first rank, first sequence, pieces of the length in each sequence, offset), sorted."""
    next_rank: dict[int, int] = {}
    rows, sequence = [], 0
    for items, times in runs:
        offset = 0
        for length, each in items:
            first = next_rank.get(length, 0)
            rows.append((length, first, sequence, each, offset))
            next_rank[length] = first + each * times
            offset += length * each
        sequence += times
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for every piece of every row.

    A null text has the closing id only; a null key stays null; repeated rows are packed as often as they occur, and
    pieces alike in every column may stand for each other; an empty table gives an empty one; other columns are not
    read. The plan collects the histogram of lengths (at most `capacity` rows); its places are at most a few for each
    length and configuration, whatever the number of documents.
    """
    pieces = base.staged(token_pieces(docs, tokenizer, capacity, end_id, key, text), "pieces")
    buckets = max(1, -(-pieces.count() // PLACED_TOGETHER))
    bucket = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets))
    dealt = pieces.withColumn("bucket", bucket)
    by_bucket = base.staged(dealt.groupBy("bucket", "length").count(), "lengths")
    counts = {r.length: r.n for r in by_bucket.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    plan = places(packing_plan(counts, capacity))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    ranks = by_bucket.select("bucket", "length", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))

    def place(pieces: pa.Table, ranks: pa.Table) -> pa.Table:
        pieces = pieces.select(["doc_id", "piece", "start", "length", "ids_crc32"]).sort_by(
            [("length", "ascending"), ("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")]
        )
        lengths = pieces["length"].to_numpy()
        own, first = np.unique(lengths, return_index=True)
        ranks = ranks.sort_by("length")
        base_rank = ranks["before"].to_numpy()[np.searchsorted(ranks["length"].to_numpy(), own)]
        which = np.searchsorted(own, lengths)
        rank = base_rank[which] + np.arange(len(lengths)) - first[which]
        # the last place of the length whose first rank is not after the rank
        row = np.empty(len(lengths), dtype=np.int64)
        for length, at, end in zip(own, first, [*first[1:], len(lengths)], strict=True):
            lo, hi = np.searchsorted(plan[:, 0], [length, length + 1])
            row[at:end] = lo + np.searchsorted(plan[lo:hi, 1], rank[at:end], side="right") - 1
        _, start, sequence, each, offset = plan[row].T
        sequence = sequence + (rank - start) // each
        offset = offset + (rank - start) % each * lengths
        return pieces.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    schema = f"{PIECES}, sequence_id long, offset long"
    return dealt.groupBy("bucket").cogroup(ranks.groupBy("bucket")).applyInArrow(place, schema)

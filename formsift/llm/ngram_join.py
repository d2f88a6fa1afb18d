"""Jaccard self-join on word n-grams by universe partition.

Sizes fall into bands. Two sets of a band that are similar enough differ in at most H shingles, so if the universe of
shingles is cut into units by a hash, H + 1 units cannot all differ. A segment of one unit is indexed by its subset
of the set; a segment of two units also by the subset less any one shingle, which finds one difference and so is worth
two units. Which kind a band uses is the cheaper one by expected signatures and expected false candidates.

A subset that is empty, or holds nothing but shingles which many texts have, says little: sets share it by chance, and
such pairs would chain unlike families into one cluster. These subsets are not indexed, and spare units make up for
them. A pair shares such a subset only in a segment that says as little in both sets; a set with more of these than the
spare units allow for indexes them all the same, so no pair is lost, whichever shingles are held to be common.

Signatures only say which sets must be compared. Where few sets share one, each pair of them is first held against a
bound: the parities of a set's shingles in as many cells as it has shingles, in which two sets differ at most as often
as in their shingles. Most chance meetings end there. Sets that remain, and all that share a signature with many, are
put into one cluster, and within a cluster
all pairs are settled exactly, rare shingles first. Equal sets are one class from the start. Hot signatures are stars
within each task before they are shuffled. A cluster beyond the bound of one task is first cut anew by the rarest
shingles of its sets, counted exactly among all sets of such clusters. What is still beyond it is written once and
settled in waves: a wave of bounded size is broadcast and the sets of its clusters stream past. Sets that a sample of
their cluster shows to be of one component take no wave among each other, so a large family of copies takes few.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formsift.llm import base
from formsift.llm.components import components, forest
from formsift.llm.words import U64, mix, shingle_sets

#: Sizes of a band differ by this factor at most.
BAND_RATIO = 1.25
#: Other sets that are half alike, as the cost model takes it.
HALF_ALIKE = 50
#: Signatures of a shuffle group, shingles of a block of a cluster, buckets of the broadcast prefilter.
GROUP_SIGNATURES = 400_000
BLOCK_SHINGLES = 1_000_000
BUCKETS = 1 << 20


@dataclass(frozen=True)
class Band:
    number: int
    low: int
    high: int
    units: int  # all units: H + 1 and spare ones
    double: int  # segments of two units
    spare: int


def bound(percent: int, size: int) -> int:
    """Most shingles in which two sets of at most this size differ at this similarity."""
    return (100 - percent) * 2 * size // (100 + percent)


@functools.cache
def bands(percent: int) -> list[Band]:
    out, low = [], 1
    while low < 1 << 40:
        high = max(low, int(low * BAND_RATIO))
        need = bound(percent, high) + 1

        def cost(double: int) -> float:
            per = low / need  # shingles of a unit; as many differ where sets are half alike
            single = need - 2 * double
            two = math.exp(-2 * per) * (1 + 2 * per + per * per)
            return single + double * (2 * per + 2) + HALF_ALIKE * (single * math.exp(-per) + double * two)

        double = min((0, need // 2), key=cost)
        spare = 0
        for _ in range(20):
            per = low / (need + spare)
            empty = (need + spare - 2 * double) * math.exp(-per) + 2 * double * math.exp(-2 * per) * (1 + 2 * per)
            more = math.ceil(empty + 3 * math.sqrt(empty)) if need >= 8 else 0
            if more <= spare:
                break
            spare = more
        out.append(Band(len(out), low, high, need + spare, double, spare))
        low = high + 1
    return out


#: How common a shingle is stands in a table of so many bytes, which is what is broadcast at any size. It has the
#: shingles that are in OFTEN different sets or more of a window of WINDOW shingles, COMMON_MOST at most, the most
#: frequent ones. A subset says something if it has a shingle of fewer than COMMON sets. Which shingles the table knows
#: and which of them share a byte decides about the work only, never about the links found.
LEVEL_SLOTS = 1 << 22
COMMON_MOST = 1 << 20
WINDOW, OFTEN, COMMON = 2_000_000, 3, 30


def level_slot(shingles: np.ndarray, slots: int = LEVEL_SLOTS) -> np.ndarray:
    return (mix(shingles) % U64(slots)).astype(np.int64)


def level_of(counts: np.ndarray) -> np.ndarray:
    return np.floor(4 * np.log2(counts)).clip(0, 255).astype(np.uint8)


def common_levels(texts: DataFrame, size: int) -> np.ndarray:
    """The table of levels: 0 for shingles that few sets have, then four for each doubling of their number."""

    def often(sets: list[np.ndarray], keys: list[np.ndarray]) -> pa.RecordBatch:
        _, first = np.unique(np.concatenate(keys), return_index=True)
        own = [s for k in sets for s in k]
        found, n = np.unique(np.concatenate([own[i] for i in first.tolist()]), return_counts=True)
        found, n = found[n >= OFTEN], n[n >= OFTEN]
        return pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n)], ["shingle", "n"])

    @base.tidy
    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base.held(None)
        sets, keys, n = [], [], 0
        for batch in batches:
            for part in base.slices(batch, most=SLICE):
                own, at = shingle_sets(part.column("text"), size)
                sets.append(np.split(own, at[1:-1]))
                keys.append(set_keys(own, at)[0])
                n += len(own)
                if n >= WINDOW:
                    yield often(sets, keys)
                    sets, keys, n = [], [], 0
        if n:
            yield often(sets, keys)

    parts = texts.select("text").mapInArrow(windows, "shingle long, n long")
    found = base.staged(parts.groupBy("shingle").agg(F.sum("n").alias("n")), "common")
    return tabled(found, LEVEL_SLOTS, COMMON_MOST, lambda shingles: level_slot(shingles.view(U64)))


def tabled(found: DataFrame, slots: int, most: int, slot_of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The table of levels of (shingle, n): of the most frequent shingles, `most` of them at most."""
    step = F.least(F.floor(4 * F.log2("n")), F.lit(255))
    steps = {r.step: r.n for r in found.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n")).collect()}
    least, room = None, most
    for own in sorted(steps, reverse=True):
        room -= steps[own]
        if room < 0:
            break
        least = own
    levels = np.zeros(slots, dtype=np.uint8)
    if least is not None:
        rows = found.where(step >= least).toArrow()
        np.maximum.at(levels, slot_of(rows["shingle"].to_numpy()), level_of(rows["n"].to_numpy()))
    return levels


def signatures(sets: np.ndarray, at: np.ndarray, percent: int, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All signatures of sets (shingles, begins) and the number of the set that has each; common is a mark for each shingle."""
    sizes = np.diff(at)
    if not len(sets):
        return np.empty(0, U64), np.empty(0, np.int64)
    found, owners = [], []
    smallest, largest = int(sizes[sizes > 0].min()), int(sizes.max())
    for band in bands(percent):
        if band.high < smallest:
            continue
        if band.low * percent > 100 * largest:
            break
        # own band, and every band above that holds a size similar enough
        which = np.flatnonzero((sizes > 0) & (sizes <= band.high) & (band.low * percent <= 100 * sizes))
        if len(which):
            own = sizes[which]
            rows = np.repeat(np.arange(len(which)), own)
            begin = np.cumsum(own) - own
            place = np.repeat(at[which] - begin, own) + np.arange(len(rows))
            for sign, row in _of_band(sets[place], ~common[place], rows, len(which), band):
                found.append(sign)
                owners.append(which[row])
    return np.concatenate(found), np.concatenate(owners)


def _of_band(shingles: np.ndarray, telling: np.ndarray, rows: np.ndarray, n: int, band: Band) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    singles = band.units - 2 * band.double
    segments = band.double + singles
    with np.errstate(over="ignore"):
        seed = U64((band.number + 1) * 0x9E3779B97F4A7C15 % 2**64)
        unit = (mix(shingles ^ seed) % U64(band.units)).astype(np.int64)
        segment = np.where(unit < 2 * band.double, unit // 2, unit - band.double)
        value = mix(shingles + seed)
        cell = rows * segments + segment
        sums = np.zeros(n * segments, dtype=U64)
        np.add.at(sums, cell, value)
        filled = np.bincount(cell[telling], minlength=n * segments)  # with shingles that are not common
        salt = mix(np.arange(segments, dtype=U64) + seed * U64(3))

        def sign(total: np.ndarray, own: np.ndarray) -> np.ndarray:
            return mix(total + salt[own % segments])

        number = np.arange(n * segments) % segments
        is_double = number < band.double
        # units that say too little: what a double segment shares may be one shingle less than what it has
        silent = np.where(is_double, 2 * (filled <= 1), filled == 0).reshape(n, segments).sum(axis=1)
        poor = silent > band.spare
        whole = np.flatnonzero((filled > 0) | poor[np.arange(n * segments) // segments])
        yield sign(sums[whole], whole), whole // segments
        if band.double:
            less = (segment < band.double) & ((filled[cell] - telling > 0) | poor[rows])
            yield sign(sums[cell[less]] - value[less], cell[less]), rows[less]


def set_keys(sets: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that stand for each set, as two signed numbers."""
    sums = []
    padded = np.append(sets, U64(0))
    for seed in (0x8CB92BA72F3D8DD7, 0xE7037ED1A0B428DB):
        with np.errstate(over="ignore"):
            values = mix(padded ^ U64(seed))
            values[-1] = 0
            own = np.add.reduceat(values, at[:-1]) if len(at) > 1 else np.empty(0, U64)
            own = np.where(np.diff(at) > 0, mix(own + U64(seed)), U64(0))
        sums.append(own.view(np.int64))
    return sums[0], sums[1]


def parities(sets: np.ndarray, at: np.ndarray) -> list[bytes]:
    """For each set the parity of its shingles in 2 ** k cells, as bits: about as many cells as shingles, 64 at least."""
    cells = mix(sets ^ U64(0x94D049BB133111EB))
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        size = max(64, 1 << max(0, b - a - 1).bit_length())
        odd = np.bincount((cells[a:b] & U64(size - 1)).astype(np.int64), minlength=size) & 1
        out.append(np.packbits(odd.astype(np.uint8)).tobytes())
    return out


def least_difference(one: bytes, other: bytes) -> int:
    """Two sets differ in at least so many shingles. The longer parities fold onto the shorter ones' cells."""
    a, b = np.frombuffer(one, dtype=np.uint8), np.frombuffer(other, dtype=np.uint8)
    n = min(len(a), len(b))
    a, b = np.bitwise_xor.reduce(a.reshape(-1, n)), np.bitwise_xor.reduce(b.reshape(-1, n))
    return int(np.bitwise_count(a ^ b).sum())


def class_rows(texts: DataFrame, size: int) -> DataFrame:
    """(doc_id, n_shingles, k1, k2, parity) of every text."""

    @base.tidy
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in base.slices(batch, most=SLICE):
                sets, at = shingle_sets(part.column("text"), size)
                k1, k2 = set_keys(sets, at)
                parity = pa.array(parities(sets, at), pa.binary())
                columns = [part.column("doc_id"), pa.array(np.diff(at)), pa.array(k1), pa.array(k2), parity]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "k1", "k2", "parity"])

    return texts.mapInArrow(rows, "doc_id long, n_shingles long, k1 long, k2 long, parity binary")


def possible(edges: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of keys that sizes and parities do not rule out, and all edges that are not to be tested."""
    own = classes.select((F.col("k1").bitwiseAND(KEY_MASK)).alias("key"), "n_shingles", "parity")
    pairs = edges.where("test").select("a", "b").distinct()
    for side in ("a", "b"):
        pairs = pairs.join(own.select(*(F.col(c).alias(f"{c}_{side}") for c in own.columns)), F.col(side) == F.col(f"key_{side}"))
    few, many = F.least("n_shingles_a", "n_shingles_b"), F.greatest("n_shingles_a", "n_shingles_b")
    pairs = pairs.where(100 * few >= percent * many)

    @base.tidy
    def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = batch.column("n_shingles_a").to_numpy() + batch.column("n_shingles_b").to_numpy()
            most = (100 - percent) * both // (100 + percent)
            least = [least_difference(a, b) for a, b in zip(batch.column("parity_a").to_pylist(), batch.column("parity_b").to_pylist(), strict=True)]
            kept = pa.array(np.array(least, dtype=np.int64) <= most, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(kept)

    tested = pairs.select("a", "b", "n_shingles_a", "n_shingles_b", "parity_a", "parity_b").mapInArrow(bounded, "a long, b long")
    return tested.unionByName(edges.where("NOT test").select("a", "b"))


def stars(signs: np.ndarray, keys: np.ndarray, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Signatures, keys and marks to pass on, and edges.

    A signature that more than FEW keys share, or one that is marked as such already, is passed on once, with its
    smallest key and the mark, and the edges join its other keys to that one. All others are passed on as they are.
    """
    order = np.lexsort((keys, signs))
    signs, keys, hot = signs[order], keys[order], hot[order]
    if not len(signs):
        return signs, keys, hot, np.empty((0, 2), np.int64)
    same = np.append(False, (signs[1:] == signs[:-1]) & (keys[1:] == keys[:-1]))
    first = np.append(True, signs[1:] != signs[:-1])
    number = np.cumsum(first) - 1
    many = (np.bincount(number, ~same) > FEW) | (np.bincount(number, hot) > 0)
    lead = keys[first][number]
    joined = many[number] & (keys != lead)
    edges = np.unique(np.stack([keys[joined], lead[joined]], axis=1), axis=0)
    on = np.where(many[number], first, ~same)
    return signs[on], keys[on], many[number][on], edges


def pairs_of(signs: np.ndarray, keys: np.ndarray, hot: np.ndarray) -> np.ndarray:
    """All pairs of keys that share a signature without the mark, FEW keys at most each; rows are in order of signature."""
    found = []
    for step in range(1, FEW):
        meet = (signs[step:] == signs[:-step]) & ~hot[step:]
        found.append(np.stack([keys[step:][meet], keys[:-step][meet]], axis=1))
    return np.unique(np.concatenate(found), axis=0) if found and len(signs) else np.empty((0, 2), np.int64)


#: Sets that share a signature are compared pair by pair up to this number, as one cluster beyond it.
FEW = 8
#: Bytes of text whose shingles are worked on at once.
SLICE = 1 << 20
#: Signatures that a task gathers before it passes them on.
DEALT = 1_000_000
#: Bytes of a signature and of a set's key that travel. Within a group of bounded size few signatures agree in so many
#: bits by chance; where they do, or where keys do, the sets concerned are compared, as all that share a signature are.
SIGN_BYTES, KEY_BYTES = 5, 6
KEY_MASK = (1 << 8 * KEY_BYTES) - 1


def packed(values: np.ndarray, size: int) -> np.ndarray:
    """The low bytes of 64-bit numbers, one row each."""
    return np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8)[:, :size]


def unpacked(raw: bytes, size: int) -> np.ndarray:
    out = np.zeros((len(raw) // size, 8), dtype=np.uint8)
    out[:, :size] = np.frombuffer(raw, dtype=np.uint8).reshape(-1, size)
    return out.view(U64).reshape(-1)


def shared_signatures(texts: DataFrame, size: int, percent: int, groups: int, levels: np.ndarray) -> DataFrame:
    """Edges (a, b) between keys of sets that share a signature; the key is k1 & KEY_MASK."""

    table, border = texts.sparkSession.sparkContext.broadcast(levels), level_of(np.array([COMMON]))[0]

    def signed(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        sets, at = shingle_sets(part.column("text"), size)
        own, row = signatures(sets, at, percent, table.value[level_slot(sets)] >= border)
        return own, (set_keys(sets, at)[0] & KEY_MASK)[row]

    return met_by_signature(texts.select("text"), signed, groups)


def rarest(sets: np.ndarray, at: np.ndarray, percent: int, levels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rarest shingles of each set, as many as two similar sets must share one of, and the number of the set."""
    sizes = np.diff(at)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    order = np.lexsort((sets, levels[level_slot(sets, len(levels))], owner))
    place = np.arange(len(sets)) - np.repeat(at[:-1], sizes)
    taken = place < np.repeat(sizes - -(-percent * sizes // 100) + 1, sizes)
    return sets[order][taken], owner[taken]


#: The table of levels of large clusters: its bytes and the shingles that it has at most.
RECUT_SLOTS, RECUT_MOST = 1 << 23, 1 << 21
#: Bytes of a shingle that travel to be counted; which shingles agree in them decides about the work only.
COUNT_BYTES = 5


def counted_levels(rows: DataFrame, own_sets, total: int) -> np.ndarray:
    """The table of levels of the shingles that more than FEW of these sets have, each counted over all of them.

    A window knows nothing of shingles that are rare in it and yet common among many sets, and these chain clusters.
    own_sets gives (shingles, begins) for a slice of rows; total is the number of shingles.
    """
    groups, mask = max(64, total // GROUP_SIGNATURES), U64((1 << 8 * COUNT_BYTES) - 1)

    @base.tidy
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base.held(None)
        gathered, n = [], 0
        for batch in batches:
            for part in base.slices(batch, most=SLICE):
                gathered.append(own_sets(part)[0])
                n += len(gathered[-1])
                if n >= DEALT:
                    yield dealt(np.concatenate(gathered))
                    gathered, n = [], 0
        if n:
            yield dealt(np.concatenate(gathered))

    def dealt(shingles: np.ndarray) -> pa.RecordBatch:
        values = mix(shingles) & mask
        group = (values % U64(groups)).astype(np.int64)
        order = np.argsort(group, kind="stable")
        group, values = group[order], packed(values[order], COUNT_BYTES)
        own, begin = np.unique(group, return_index=True)
        ends = [*begin[1:], len(group)]
        parts = [values[a:b].tobytes() for a, b in zip(begin, ends, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(own), pa.array(parts, pa.binary())], ["group", "shingles"])

    def count(rows: pa.Table) -> pa.Table:
        found, n = np.unique(unpacked(b"".join(rows["shingles"].to_pylist()), COUNT_BYTES), return_counts=True)
        return pa.table({"shingle": found[n > FEW].view(np.int64), "n": n[n > FEW]})

    parts = rows.mapInArrow(deal, "group long, shingles binary")
    found = base.staged(parts.groupBy("group").applyInArrow(count, "shingle long, n long"), "common")
    return tabled(found, RECUT_SLOTS, RECUT_MOST, lambda values: values % RECUT_SLOTS)


def recut(
    members: DataFrame, classes: DataFrame, texts: DataFrame, size: int, percent: int
) -> tuple[DataFrame, np.ndarray]:
    """The members of large clusters, cut anew: sets meet where they share one of their rarest shingles. And the table of
    levels that says which these are.

    Similar sets do, so no pair falls apart. Pairs that meet in few are held against the bound as before; sets that meet
    nothing are left out.
    """
    total = members.agg(F.coalesce(F.sum("n_shingles"), F.lit(0))).first()[0]
    rows = of_members(texts, members).select("text", "k1")

    def own_sets(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        """The sets of the rows whose text is the member's own."""
        sets, at = shingle_sets(part.column("text"), size)
        same = set_keys(sets, at)[0] == part.column("k1").to_numpy(zero_copy_only=False)
        sizes = np.diff(at)
        return sets[np.repeat(same, sizes)], np.concatenate([[0], np.cumsum(sizes[same])])

    levels = counted_levels(rows, own_sets, total)
    table = texts.sparkSession.sparkContext.broadcast(levels)

    def prefixes(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        sets, at = own_sets(part)
        own, row = rarest(sets, at, percent, table.value)
        return own, (set_keys(sets, at)[0] & KEY_MASK)[row]

    edges = met_by_signature(rows, prefixes, max(64, int(total * (100 - percent) / 100) // GROUP_SIGNATURES))
    edges = base.staged(edges, "meetings")
    table.destroy()
    edges = possible(edges, classes, percent)
    named = base.staged(components(edges), "recut")
    cut = members.drop("cluster").join(named, F.col("k1").bitwiseAND(KEY_MASK) == named["node"]).select(
        members["node"], "k1", "n_shingles", F.col("component").alias("cluster")
    )
    return cut, levels


def of_members(texts: DataFrame, members: DataFrame) -> DataFrame:
    """Texts joined to members by node; only rows whose id falls into a bucket of some member are shuffled."""
    bucket = F.pmod(F.xxhash64("doc_id"), F.lit(BUCKETS))
    near = members.select(F.pmod(F.xxhash64("node"), F.lit(BUCKETS)).alias("bucket")).distinct()  # at most BUCKETS rows
    rows = texts.withColumn("bucket", bucket).join(F.broadcast(near), "bucket", "left_semi").drop("bucket")
    return rows.join(members, F.col("doc_id") == F.col("node"))


def met_by_signature(rows: DataFrame, signed, groups: int) -> DataFrame:
    """Edges (a, b, test) between keys that share a signature; signed gives (signatures, keys) for a slice of rows.

    Where few share it, these are all pairs, which may be tested one by one. Each task makes stars of what it has of a
    hot signature, so that is shuffled a few times for each task at most; these edges must all be kept.
    """

    @base.tidy
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base.held(None)
        signs, keys, n = [], [], 0
        for batch in batches:
            for part in base.slices(batch, most=SLICE):
                own, row = signed(part)
                signs.append(own)
                keys.append(row)
                n += len(own)
                if n >= DEALT:
                    yield dealt(np.concatenate(signs), np.concatenate(keys))
                    signs, keys, n = [], [], 0
        if n:
            yield dealt(np.concatenate(signs), np.concatenate(keys))

    def dealt(signs: np.ndarray, keys: np.ndarray) -> pa.RecordBatch:
        signs, keys, hot, edges = stars(signs, keys, np.zeros(len(signs), dtype=bool))
        group = (signs % U64(groups)).astype(np.int64)
        order = np.argsort(group, kind="stable")
        # the mark of a hot signature is its last bit
        signs = (signs // U64(groups) << U64(1)) | hot.astype(U64)
        group, signs = group[order], packed(signs[order], SIGN_BYTES)
        keys = packed(keys[order], KEY_BYTES)
        own, begin = np.unique(group, return_index=True)
        ends = [*begin[1:], len(group)]
        # the edges found already travel along, spread over the groups
        along = np.array_split(edges, len(own))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(own),
                pa.array([signs[a:b].tobytes() for a, b in zip(begin, ends, strict=True)], pa.binary()),
                pa.array([keys[a:b].tobytes() for a, b in zip(begin, ends, strict=True)], pa.binary()),
                pa.array([np.ascontiguousarray(e).tobytes() for e in along], pa.binary()),
            ],
            ["group", "signs", "keys", "edges"],
        )

    def met(rows: pa.Table) -> pa.Table:
        signs, keys, before = (b"".join(rows[c].to_pylist()) for c in ("signs", "keys", "edges"))
        signs = unpacked(signs, SIGN_BYTES)
        found = stars(signs >> U64(1), unpacked(keys, KEY_BYTES).view(np.int64), signs & U64(1) == 1)
        edges = np.concatenate([found[3], np.frombuffer(before, dtype=np.int64).reshape(-1, 2)])
        links = forest(map(tuple, edges.tolist()))
        pairs = pairs_of(*found[:3])
        return pa.table({
            "a": np.concatenate([np.array(list(links.keys()), dtype=np.int64), pairs[:, 0]]),
            "b": np.concatenate([np.array(list(links.values()), dtype=np.int64), pairs[:, 1]]),
            "test": np.arange(len(links) + len(pairs)) >= len(links),
        })

    parts = rows.mapInArrow(deal, "group long, signs binary, keys binary, edges binary")
    return parts.groupBy("group").applyInArrow(met, "a long, b long, test boolean")


def linked(nodes: np.ndarray, sides: np.ndarray, sets: list[np.ndarray], percent: int, across: bool) -> list[tuple[int, int]]:
    """Links that join the nodes as all links between them do; with across, only links between the two sides count.

    Sets come in the order of size; each looks for smaller ones that share one of its rarest shingles, as many as a
    similar set must meet. Sets that are joined already are not compared again.
    """
    order = np.argsort([len(s) for s in sets], kind="stable")
    sizes = np.array([len(sets[i]) for i in order])
    begin = np.concatenate([[0], np.cumsum(sizes)])
    if not begin[-1]:
        return []
    _, token, count = np.unique(np.concatenate([sets[i] for i in order]), return_inverse=True, return_counts=True)
    sides = np.asarray(sides)[order]
    joined = np.arange(len(order))
    marked = np.zeros(len(count), dtype=bool)
    index: dict[int, list[int]] = {}
    links = []
    for x, size in enumerate(sizes.tolist()):
        own = token[begin[x] : begin[x + 1]]
        rare = own[np.lexsort((own, count[own]))][: size - -(-percent * size // 100) + 1]
        rare = rare[count[rare] > 1].tolist()
        lists = [index[t] for t in rare if t in index]
        if lists:
            others = np.unique(np.concatenate([np.array(v) for v in lists]))
            fit = (joined[others] != joined[x]) & (100 * sizes[others] >= percent * size)
            others = others[fit & (sides[others] != sides[x])] if across else others[fit]
            if len(others):
                marked[own] = True
                n = sizes[others]
                at = np.cumsum(n) - n
                where = np.repeat(begin[others] - at, n) + np.arange(int(n.sum()))
                both = np.add.reduceat(marked[token[where]], at, dtype=np.int64)
                marked[own] = False
                for y in others[100 * both >= percent * (size + n - both)].tolist():
                    if joined[y] != joined[x]:
                        links.append((int(nodes[order[x]]), int(nodes[order[y]])))
                        joined[joined == joined[y]] = joined[x]
        for t in rare:
            index.setdefault(t, []).append(x)
    return links


def sets_of(texts: DataFrame, members: DataFrame, size: int, percent: int, table: Broadcast | None = None) -> DataFrame:
    """(node, cluster, shingles, rare) of the members (node, k1, cluster): the sets as bytes, with a table of levels their
    rarest shingles as well."""

    @base.tidy
    def as_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base.held(None)
        for batch in batches:
            for part in base.slices(batch, most=SLICE):
                sets, at = shingle_sets(part.column("text"), size)
                same = np.flatnonzero(set_keys(sets, at)[0] == part.column("k1").to_numpy(zero_copy_only=False))
                own = [sets[at[i] : at[i + 1]].tobytes() for i in same.tolist()]
                rare = [b""] * len(own)
                if table:
                    found, row = rarest(sets, at, percent, table.value)
                    begin = np.searchsorted(row, np.arange(len(at)))
                    rare = [found[begin[i] : begin[i + 1]].tobytes() for i in same.tolist()]
                kept = part.take(pa.array(same))
                columns = [kept.column("node"), kept.column("cluster"), pa.array(own, pa.binary()), pa.array(rare, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["node", "cluster", "shingles", "rare"])

    rows = of_members(texts, members.select("node", "k1", "cluster")).select("node", "k1", "cluster", "text")
    return rows.mapInArrow(as_sets, "node long, cluster long, shingles binary, rare binary")


class Sets:
    """Rows (node, cluster, shingles, rare) as arrays."""

    def __init__(self, rows: pa.Table | pa.RecordBatch):
        self.nodes, self.clusters = (np.asarray(rows.column(c)) for c in ("node", "cluster"))
        self.sets = [np.frombuffer(b, dtype=U64) for b in rows.column("shingles").to_pylist()]
        rare = [np.frombuffer(b, dtype=U64) for b in rows.column("rare").to_pylist()]
        self.rare = np.concatenate([np.empty(0, U64), *rare])
        self.row = np.repeat(np.arange(len(rare)), [len(r) for r in rare])

    def within(self, percent: int) -> dict[int, list[tuple[int, int]]]:
        """By cluster, links that join these sets as all links between them do."""
        out = {}
        for cluster in np.unique(self.clusters).tolist():
            own = np.flatnonzero(self.clusters == cluster)
            out[cluster] = linked(self.nodes[own], np.zeros(len(own)), [self.sets[i] for i in own.tolist()], percent, False)
        return out

    def across(self, other: Sets, percent: int) -> dict[int, list[tuple[int, int]]]:
        """By cluster, links that join these sets and others as all links between the two do. Only sets that share one of
        their rarest shingles are compared."""
        ours = np.unique(self.row[np.isin(self.rare, other.rare)])
        theirs = np.unique(other.row[np.isin(other.rare, self.rare)])
        out = {}
        for cluster in np.intersect1d(self.clusters[ours], other.clusters[theirs]).tolist():
            x, y = ours[self.clusters[ours] == cluster], theirs[other.clusters[theirs] == cluster]
            both = [self.sets[i] for i in x.tolist()] + [other.sets[i] for i in y.tolist()]
            nodes, sides = np.concatenate([self.nodes[x], other.nodes[y]]), np.repeat([0, 1], [len(x), len(y)])
            out[cluster] = linked(nodes, sides, both, percent, True)
        return out


def in_parts(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Batches of sets with about `most` bytes of shingles each."""
    gathered, n = [], 0
    for batch in batches:
        for part in base.slices(batch, "shingles", most):
            own = pc.sum(pc.binary_length(part.column("shingles"))).as_py() or 0
            if gathered and n + own > most:
                yield pa.concat_batches(gathered)
                gathered, n = [], 0
            gathered.append(part)
            n += own
    if gathered:
        yield pa.concat_batches(gathered)


def flat(links: dict[int, list[tuple[int, int]]]) -> pa.RecordBatch:
    pairs = [pair for own in links.values() for pair in own]
    return pa.RecordBatch.from_arrays([pa.array([pair[i] for pair in pairs], pa.int64()) for i in (0, 1)], ["a", "b"])


def in_waves(members: DataFrame, texts: DataFrame, size: int, percent: int, levels: np.ndarray) -> DataFrame:
    """Links (a, b) between members (node, k1, cluster, total) of large clusters; total is the cluster's shingles.

    Every set is written once. All are held against a sample of their cluster, which is broadcast; what is then known to
    be of the sample's largest component needs no comparison among itself. All other sets are broadcast in waves, about
    BLOCK_SHINGLES at a time, and those that were not in an earlier wave stream past.
    """
    context = texts.sparkSession.sparkContext
    table = context.broadcast(levels)
    folder = base.shared_folder(texts.sparkSession, "links")

    def sent(sets: DataFrame) -> Broadcast:
        return context.broadcast((base.fresh(), sets.select("node", "cluster", "shingles", "rare").toArrow()))

    def received(wave: Broadcast, make: Callable[[Sets], object]) -> object:
        return base.held(wave.value[0], lambda: make(Sets(wave.value[1])))

    clusters = members.select("cluster").distinct().count()
    taken = F.pmod(F.xxhash64("node"), F.ceil(F.col("total") * clusters / BLOCK_SHINGLES)) == 0
    sample = sent(sets_of(texts, members.where(taken), size, percent, table))

    def families(own: Sets) -> tuple[Sets, dict[int, list[tuple[int, int]]], dict[int, int]]:
        links, leads = own.within(percent), {}
        for cluster, pairs in links.items():
            roots = forest(iter(pairs))
            named, n = np.unique([roots.get(x, x) for x in own.nodes[own.clusters == cluster].tolist()], return_counts=True)
            leads[cluster] = int(named[n.argmax()])
        return own, links, leads

    @base.tidy
    def led(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, inner, leads = received(sample, families)
        for part in in_parts(batches, 8 * BLOCK_SHINGLES):
            rows = Sets(part)
            links = rows.across(own, percent)
            lead = np.zeros(part.num_rows, dtype=bool)
            for cluster, pairs in links.items():
                roots = forest(iter(pairs + inner[cluster]))
                first = roots.get(leads[cluster], leads[cluster])
                which = np.flatnonzero(rows.clusters == cluster)
                lead[which] = [roots.get(x, x) == first for x in rows.nodes[which].tolist()]
            found = flat(links)
            along = [pa.array([found.column(c).to_pylist()] + [[]] * (part.num_rows - 1), pa.list_(pa.int64())) for c in ("a", "b")]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(lead), *along], [*part.schema.names, "lead", "a", "b"])

    every = sets_of(texts, members, size, percent, table)
    kind = "node long, cluster long, shingles binary, rare binary, lead boolean, a array<long>, b array<long>"
    sets = base.staged(every.mapInArrow(led, kind), "sets")
    sample.destroy()
    table.destroy()
    sets.where(F.size("a") > 0).select(F.inline(F.arrays_zip("a", "b"))).write.parquet(folder)

    left = sets.where("NOT lead").agg(F.coalesce(F.sum(F.length("shingles")), F.lit(0))).first()[0]
    waves = -(-left // (8 * BLOCK_SHINGLES))
    turn = F.pmod(F.xxhash64(F.lit(1), F.col("node")), F.lit(waves))
    for k in range(waves):
        wave = sent(sets.where(~F.col("lead") & (turn == k)))

        @base.tidy
        def met(batches: Iterator[pa.RecordBatch], wave: Broadcast = wave) -> Iterator[pa.RecordBatch]:
            own = received(wave, lambda own: own)
            for part in in_parts(batches, 8 * BLOCK_SHINGLES):
                yield flat(Sets(part).across(own, percent))

        others = sets.where(F.col("lead") | (turn >= k)).select("node", "cluster", "shingles", "rare")
        others.mapInArrow(met, "a long, b long").write.mode("append").parquet(folder)
        wave.destroy()
    base.discard(sets)
    return texts.sparkSession.read.schema("a long, b long").parquet(folder)


def verified(members: DataFrame, texts: DataFrame, size: int, percent: int, levels: np.ndarray) -> DataFrame:
    """Links (a, b) between class nodes: all pairs within a cluster are settled exactly.

    members: (node, k1, n_shingles, cluster). A cluster of at most BLOCK_SHINGLES is a group, larger ones go in waves;
    levels decides which sets are compared, never about the links found.
    """
    sizes = members.groupBy("cluster").agg(F.sum("n_shingles").alias("total"))
    small = members.join(sizes.where(F.col("total") <= BLOCK_SHINGLES), "cluster")
    large = base.staged(members.join(sizes.where(F.col("total") > BLOCK_SHINGLES), "cluster"), "large")

    def settle(rows: pa.Table) -> pa.Table:
        own = [np.frombuffer(b, dtype=U64) for b in rows["shingles"].to_pylist()]
        links = linked(rows["node"].to_numpy(), np.zeros(len(own)), own, percent, False)
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})

    links = sets_of(texts, small, size, percent).select("node", "cluster", "shingles")
    links = links.groupBy("cluster").applyInArrow(settle, "a long, b long")
    return links if large.isEmpty() else links.unionByName(in_waves(large, texts, size, percent, levels))


def ngram_components(docs: DataFrame, size: int = 4, percent: int = 85, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id for every row, over its whole text.

    A set holds a text's distinct shingles of `size` words after lower-casing A-Z (all words as one, if there are
    fewer). Two documents are linked when 100 * intersection >= percent * union; component_id is the smallest doc_id
    that links reach. A null or wordless text has no shingles and no links. A null key has no component and links
    nothing. Each row of a repeated key has the component of its own text. Equal sets are linked at any number of copies. An empty table gives
    an empty one; other columns are not read. Shingles are 64-bit hashes, equal sets are known by 128 bits.
    """
    texts = base.texts_only(docs, key, text)
    rows = base.staged(class_rows(texts, size), "classes")
    real = rows.where("n_shingles > 0 and doc_id is not null")
    classes = real.groupBy("k1", "k2").agg(
        F.min("doc_id").alias("node"), F.max("n_shingles").alias("n_shingles"), F.first("parity").alias("parity")
    )
    classes = base.staged(classes, "nodes")
    total = classes.agg(F.coalesce(F.sum("n_shingles"), F.lit(0))).first()[0]
    groups = max(64, int(total * 0.4) // GROUP_SIGNATURES)
    with_id = texts.where("doc_id is not null")
    levels = common_levels(with_id, size)
    edges = base.staged(shared_signatures(with_id, size, percent, groups, levels), "meetings")
    edges = possible(edges, classes, percent)
    clusters = base.staged(components(edges), "clusters")
    members = classes.join(clusters, F.col("k1").bitwiseAND(KEY_MASK) == clusters["node"]).select(
        classes["node"], "k1", "n_shingles", F.col("component").alias("cluster")
    )
    members = base.staged(members, "members")
    sizes = members.groupBy("cluster").agg(F.sum("n_shingles").alias("total"))
    large = base.staged(members.join(sizes.where(F.col("total") > BLOCK_SHINGLES), "cluster").select(*members.columns), "large")
    if not large.isEmpty():
        small = members.join(sizes.where(F.col("total") <= BLOCK_SHINGLES), "cluster").select(*members.columns)
        cut, levels = recut(large, classes, with_id, size, percent)
        members = base.staged(small.unionByName(cut), "members")
    links = verified(members, with_id, size, percent, levels)
    labels = base.staged(components(links), "labels")
    named = classes.join(labels, "node", "left").select("k1", "k2", F.coalesce("component", "node").alias("component_id"))
    return rows.join(named, ["k1", "k2"], "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("n_shingles") > 0, F.when(F.col("doc_id").isNotNull(), F.col("component_id")))
        .otherwise(F.col("doc_id")).alias("component_id"),
    )


def one_of_each_group(docs: DataFrame, size: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of documents that are the first of their component, with all columns; rows without a key stay."""
    found = ngram_components(docs, size, percent, key, text).where("doc_id is not null")
    first = F.max((F.col("component_id") == F.col("doc_id")).cast("int")).alias("first")
    gone = base.staged(found.groupBy("doc_id").agg(first).where("first = 0").select("doc_id"), "gone")
    return base.without(docs, gone.select(F.col("doc_id").alias(key)), [key])

"""Language-model scores from a log-frequency Bloom filter.

Every pair of neighbouring tokens of the training texts is counted over all of them. Its count is quantised to a level
on a logarithmic scale, and the filter holds the pair once for each level up to its own, so that probing level after
level until one is missing reads the count back. The filter consists of blocks of BLOCK_BITS; a pair's block follows
from its hash, so each block is built by one task. Single tokens are counted exactly, as sorted hashes.

Filter and token counts grow with the corpus. They are broadcast to the workers in passes of PASS_BYTES at most: each
pass covers a share of the blocks and a range of the token hashes and fills in what it knows about every token of
every text. Pairs are counted once, into stored blocks that the passes take their shares from. However large the corpus,
the number of passes grows, and with it how often texts are looked up, but not what a worker holds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formsift.llm import base
from formsift.llm.words import U64, mix, word_hashes

END = U64(0x9D8A2C4F6B1E3705)
BLOCK_BITS = 1 << 19
PASS_BYTES = 192 << 20
#: Bits of the filter for each training token. A pair's level is at most its count, so entries are fewer than tokens.
BITS_PER_TOKEN = 6
PROBES = 5
#: Level j stands for counts from RATIO ** (j - 1) on.
RATIO = 2.0
LEVELS = 40


def level(counts: np.ndarray) -> np.ndarray:
    return (np.floor(np.log(counts) / np.log(RATIO) + 1e-9) + 1).astype(np.int64).clip(1, LEVELS)


def count_at(levels: np.ndarray) -> np.ndarray:
    """The least count of a level, 0 for level 0: counts read back never exceed the true ones, but for false hits."""
    return np.where(levels > 0, RATIO ** (levels - 1.0), 0.0)


def block_of(pairs: np.ndarray, blocks: int) -> np.ndarray:
    return (pairs % U64(blocks)).astype(np.int64)


def probe_places(pairs: np.ndarray, at: int) -> Iterator[np.ndarray]:
    """Bits within the block that level `at` of the pairs sets, one array for each probe."""
    with np.errstate(over="ignore"):
        a = mix(pairs ^ U64(at * 0x9E3779B97F4A7C15 % 2**64))
        for k in range(PROBES):
            yield ((a + U64(k) * ((a >> U64(20)) | U64(1))) % U64(BLOCK_BITS)).astype(np.int64)


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's words and one end, and where each text begins."""
    hashes, at = word_hashes(texts)
    return np.insert(hashes, at[1:], END), at + np.arange(len(at))


def pair_hashes(hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For every token the hash of (token before, token); the first of a text follows END."""
    before = np.empty_like(hashes)
    before[1:] = hashes[:-1]
    before[at[:-1]] = END
    with np.errstate(over="ignore"):
        return mix(before * U64(0xC2B2AE3D27D4EB4F) + hashes)


class Counter:
    """Sums counts of many slices; hands them on when there are about `bound` entries."""

    def __init__(self, bound: int = 2_000_000):
        self.bound, self.parts, self.size = bound, [], 0

    def add(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        self.parts.append(np.unique(values, return_counts=True))
        self.size += len(self.parts[-1][0])
        return self.take() if self.size >= self.bound else None

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        values = np.concatenate([np.empty(0, U64), *(v for v, _ in self.parts)])
        counts = np.concatenate([np.empty(0, np.int64), *(c for _, c in self.parts)])
        self.parts, self.size = [], 0
        return summed(values, counts)


def summed(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(values, kind="stable")
    values, counts = values[order], counts[order].astype(np.int64)
    if not len(values):
        return values, counts
    first = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
    return values[first], np.add.reduceat(counts, first)


def blobs(group: np.ndarray, values: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    """(group, ones, many, counts): values as bytes, those that occur once without a count. Few large rows to shuffle."""
    order = np.argsort(group, kind="stable")
    group, values, counts = group[order], values[order], counts[order]
    own, first = np.unique(group, return_index=True)
    columns: list[list[bytes]] = [[], [], []]
    for a, b in zip(first, np.append(first[1:], len(group)), strict=True):
        once = counts[a:b] == 1
        columns[0].append(values[a:b][once].tobytes())
        columns[1].append(values[a:b][~once].tobytes())
        columns[2].append(counts[a:b][~once].astype(np.int64).tobytes())
    arrays = [pa.array(own.astype(np.int64)), *(pa.array(c, pa.binary()) for c in columns)]
    return pa.RecordBatch.from_arrays(arrays, ["group", "ones", "many", "counts"])


BLOBS = "group long, ones binary, many binary, counts binary"


def unblobbed(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    ones, many = (np.frombuffer(b"".join(rows[c].to_pylist()), dtype=U64) for c in ("ones", "many"))
    counts = np.frombuffer(b"".join(rows["counts"].to_pylist()), dtype=np.int64)
    return summed(np.concatenate([ones, many]), np.concatenate([np.ones(len(ones), np.int64), counts]))


def counted(texts: DataFrame, values, group) -> DataFrame:
    """Blobs of the counts of values(hashes, begins) of all texts, summed within each task; group deals them out."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base.held(None)
        counter = Counter()
        for batch in batches:
            for part in base.slices(batch):
                full = counter.add(values(*tokens(part.column("text"))))
                if full:
                    yield blobs(group(full[0]), *full)
        last = counter.take()
        if len(last[0]):
            yield blobs(group(last[0]), *last)

    return texts.select("text").mapInArrow(count, BLOBS)


#: Token counts are dealt out by the leading bits of the hash, so a group is a range of hashes.
WORD_GROUP_BITS = 10
#: Distinct tokens of a range that make one row.
ROW_WORDS = 1 << 18
#: Bytes of a distinct token in a lookup: hash and count.
WORD_BYTES = 16


def word_counts(train: DataFrame) -> DataFrame:
    """(least, words, counts, distinct, total): every training token once, as sorted hashes of a range from least on.

    A range of many tokens gives several rows of ROW_WORDS.
    """

    def add_up(rows: pa.Table) -> pa.Table:
        words, counts = unblobbed(rows)
        parts = [slice(i, i + ROW_WORDS) for i in range(0, len(words), ROW_WORDS)]
        return pa.table({
            # in the order of the hashes, as signed numbers
            "least": pa.array([int(words[p][0]) - (1 << 63) for p in parts], pa.int64()),
            "words": pa.array([words[p].tobytes() for p in parts], pa.binary()),
            "counts": pa.array([counts[p].astype(np.uint64).tobytes() for p in parts], pa.binary()),
            "distinct": pa.array([len(words[p]) for p in parts], pa.int64()),
            "total": pa.array([int(counts[p].sum()) for p in parts], pa.int64()),
        })

    parts = counted(train, lambda hashes, at: hashes, lambda words: words >> U64(64 - WORD_GROUP_BITS))
    return parts.groupBy("group").applyInArrow(add_up, "least long, words binary, counts binary, distinct long, total long")


#: Blocks that one task fills at once, at most.
GROUP_BLOCKS = 64


def filter_blocks(train: DataFrame, blocks: int) -> DataFrame:
    """(block, bits) of the filter's blocks, from one reading of the texts."""
    each = min(GROUP_BLOCKS, -(-blocks // 128))

    def fill(rows: pa.Table) -> pa.Table:
        pairs, counts = unblobbed(rows)
        levels, block = level(counts), block_of(pairs, blocks)
        own = np.unique(block)
        bits = np.zeros((len(own), BLOCK_BITS), dtype=bool)
        row = np.searchsorted(own, block)
        for at in range(1, int(levels.max(initial=0)) + 1):
            has = levels >= at
            for places in probe_places(pairs[has], at):
                bits[row[has], places] = True
        packed = np.packbits(bits, axis=1)
        return pa.table({"block": pa.array(own), "bits": pa.array([b.tobytes() for b in packed], pa.binary())})

    parts = counted(train, pair_hashes, lambda pairs: block_of(pairs, blocks) // each)
    return parts.groupBy("group").applyInArrow(fill, "block long, bits binary")


def read_levels(pairs: np.ndarray, row: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """The level of each pair, 0 if unknown: probes level after level until one is missing."""
    found = np.zeros(len(pairs), dtype=np.uint8)
    left = np.arange(len(pairs))
    for at in range(1, LEVELS + 1):
        for places in probe_places(pairs, at):
            if len(places) != len(left):
                places = places[left]
            hit = (bits[row[left], places >> 3] >> (7 - (places & 7)).astype(np.uint8)) & 1 == 1
            left = left[hit]
        if not len(left):
            break
        found[left] = at
    return found


class Lookup:
    """What one pass knows: a share of the filter's blocks and a range of the token hashes."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, blocks: int, first: int, bits: np.ndarray):
        self.words, self.counts, self.blocks, self.first, self.bits = words, counts, blocks, first, bits

    def count(self, words: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return np.zeros(len(words), dtype=U64)
        at = np.searchsorted(self.words, words).clip(max=len(self.words) - 1)
        return np.where(self.words[at] == words, self.counts[at], U64(0))

    def level(self, pairs: np.ndarray) -> np.ndarray:
        row = block_of(pairs, self.blocks) - self.first
        mine = (row >= 0) & (row < len(self.bits))
        out = np.zeros(len(pairs), dtype=np.uint8)
        out[mine] = read_levels(pairs[mine], row[mine], self.bits)
        return out

    def known(self, hashes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count of every token and level of the pair that it ends, 0 where this pass does not know."""
        words, which = np.unique(hashes, return_inverse=True)
        pairs, of = np.unique(pair_hashes(hashes, at), return_inverse=True)
        return self.count(words)[which], self.level(pairs)[of]


#: Bytes of text that are looked up at once, beside the lookup itself.
LOOKUP_SLICE = 1 << 20
FOUND = np.dtype([("count", "<u8"), ("level", "u1")])


def looked_up(part: pa.RecordBatch, lookup: Lookup) -> tuple[np.ndarray, np.ndarray]:
    """What is known about every token after a pass, and where each text begins."""
    hashes, at = tokens(part.column("text"))
    found = np.empty(len(hashes), dtype=FOUND)
    found["count"], found["level"] = lookup.known(hashes, at)
    before = np.frombuffer(b"".join(part.column("found").to_pylist()), dtype=FOUND)
    if len(before):
        for name in FOUND.names:
            found[name] = np.maximum(found[name], before[name])
    return found, at


def filled(texts: DataFrame, lookup: Broadcast[Lookup]) -> DataFrame:
    """Adds what a pass knows about the tokens of every text to the column found."""

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in base.slices(batch, most=LOOKUP_SLICE):
                found, at = looked_up(part, lookup.value)
                rows = [found[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]
                columns = [part.column("doc_id"), part.column("text"), pa.array(rows, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text", "found"])

    return texts.mapInArrow(fill, "doc_id long, text string, found binary")


def lm_scores(docs: DataFrame, key: str = "doc_id", text: str = "text", parts: int = 10, added: float = 0.1, prior: float = 200.0, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row, over its whole text.

    Tokens are a text's words, A-Z lower-cased, then one end. Training takes the rows whose key's crc32 is not
    divisible by parts (a null key trains). base_score adds log10((c + added) / (N + added (V + 1))) over the tokens.
    score takes P(w | v) = (c(v w) + prior * P(w)) / (c(v) + prior) with pair counts as the filter gives them back,
    at most c(w) and c(v), v the token before (the end, for the first), and P(w) as in base_score. A null text counts
    as empty: its one token is the end. Repeated rows give repeated rows and count as often as they occur; an empty
    table gives an empty one; other columns are not read.
    """
    spark = docs.sparkSession
    texts = base.texts_only(docs, key, text)
    train = texts.where(~base.held_out(F.col("doc_id"), parts))
    words = base.staged(word_counts(train), "word-counts")
    n, v = words.agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("distinct"), F.lit(0))).first()
    blocks = max(1, -(-n * BITS_PER_TOKEN // BLOCK_BITS))
    stored = base.staged(filter_blocks(train, blocks), "blocks")
    passes = max(1, -(-(blocks * BLOCK_BITS // 8 + WORD_BYTES * v) // pass_bytes))
    known = texts.withColumn("found", F.lit(b""))
    for i in range(passes - 1):
        lookup = spark.sparkContext.broadcast(lookup_of_pass(stored, words, blocks, i, passes))
        known = base.staged(filled(known, lookup), "found")
        lookup.destroy()
    lookup = spark.sparkContext.broadcast(lookup_of_pass(stored, words, blocks, passes - 1, passes))
    floor = np.log10(n + added * (v + 1)) if n else 0.0

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in base.slices(batch, most=LOOKUP_SLICE):
                found, at = looked_up(part, lookup.value)
                begin = at[:-1]
                c = found["count"].astype(np.float64)
                history = np.roll(c, 1)
                history[begin] = c[at[1:] - 1]  # the last token of every text is the end
                alone = np.log10(c + added) - floor
                pair = np.minimum(count_at(found["level"].astype(np.float64)), np.minimum(c, history))
                joint = np.log10(pair + prior * 10**alone) - np.log10(history + prior)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), pa.array(np.diff(at)),
                        pa.array(np.add.reduceat((c > 0).astype(np.int64), begin)),
                        pa.array(np.add.reduceat(alone, begin)), pa.array(np.add.reduceat(joint, begin)),
                    ],
                    ["doc_id", "n_tokens", "n_known", "base_score", "score"],
                )

    # stored, so that the broadcast can be given back now
    sums = known.mapInArrow(score, "doc_id long, n_tokens long, n_known long, base_score double, score double")
    sums = base.staged(sums, "scores")
    lookup.destroy()
    return sums.select(
        "doc_id", base.held_out(F.col("doc_id"), parts).alias("held_out"), "n_tokens", "n_known",
        F.lit(n).cast("long").alias("train_tokens"), "base_score", "score",
    )


def lookup_of_pass(stored: DataFrame, words: DataFrame, blocks: int, i: int, passes: int) -> Lookup:
    """Gathers a share of what is counted, about pass_bytes of lm_scores; the driver holds one share at a time.

    A share of the tokens is a range of their hashes, which are spread evenly.
    """
    low, high = ((1 << 64) * j // passes - (1 << 63) for j in (i, i + 1))
    own = words.where(F.col("least").between(low, high - 1))
    rows = sorted(own.select("least", "words", "counts").collect())
    hashes = np.frombuffer(b"".join(r.words for r in rows), dtype=U64)
    counts = np.frombuffer(b"".join(r.counts for r in rows), dtype=U64)
    del rows
    first, last = blocks * i // passes, blocks * (i + 1) // passes
    bits = np.zeros((last - first, BLOCK_BITS // 8), dtype=np.uint8)
    if last > first:
        for r in stored.where(F.col("block").between(first, last - 1)).toLocalIterator():
            bits[r.block - first] = np.frombuffer(r.bits, dtype=np.uint8)
    return Lookup(hashes, counts, blocks, first, bits)

"""Words of whole texts as 64-bit hashes, worked out over the bytes of many texts at once with numpy.

Words are `[^\\x20\\x09-\\x0D]+` after lower-casing A-Z. The separators are single bytes in UTF-8, so bytes do.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U64 = np.uint64
_BASE = U64(0x9E3779B97F4A7C15 | 1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
        return x ^ (x >> U64(31))


def _byte_values() -> np.ndarray:
    values = mix(np.arange(1, 257, dtype=U64) * U64(0xD1342543DE82EF95))
    values[65:91] = values[97:123]
    return values


_VALUES = _byte_values()
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_POWERS = np.ones(1, dtype=U64)


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        with np.errstate(over="ignore"):
            powers = np.full(max(n, 1 << 16), _BASE, dtype=U64)
            powers[0] = 1
            _POWERS = np.multiply.accumulate(powers)
    return _POWERS[:n]


def span_hashes(data: np.ndarray, starts: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and length of the spans that begin at starts and go on to the next start, bytes not inside left out.

    Bytes that are not inside must come after a span's others. The place within the span decides the weight of a byte,
    so equal spans hash alike anywhere.
    """
    if not len(starts):
        return np.empty(0, dtype=U64), np.empty(0, dtype=np.int64)
    data, inside, shifted = data[starts[0] :], inside[starts[0] :], starts - starts[0]
    lengths = np.add.reduceat(inside, shifted, dtype=np.int64)
    place = np.arange(len(data), dtype=np.int64) - np.repeat(shifted, np.diff(np.append(shifted, len(data))))
    with np.errstate(over="ignore"):
        parts = _VALUES[data]
        parts *= _powers(int(lengths.max()) + 1)[np.where(inside, place, 0)]
        parts[~inside] = 0
        return mix(np.add.reduceat(parts, shifted) + lengths.astype(U64) * U64(0xA0761D6478BD642F)), lengths


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word in order, and for each text the place of its first word (one more entry at the end)."""
    if pa.types.is_string(texts.type):
        texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if len(texts) == 0 or offsets[-1] == offsets[0]:
        return np.empty(0, dtype=U64), np.zeros(len(texts) + 1, dtype=np.int64)
    data = np.frombuffer(texts.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    inside = ~_SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    first[edges] = inside[edges]  # a word never runs from one text into the next
    starts = np.flatnonzero(first)
    return span_hashes(data, starts, inside)[0], np.searchsorted(starts, offsets)


def shingle_sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each text as sorted hashes, and where each text's set begins (one more entry at the end).

    A text with fewer words than size has its whole sequence as one shingle; one without words has none.
    """
    hashes, at = word_hashes(texts)
    counts = np.diff(at)
    n_shingles = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    owner = np.repeat(np.arange(len(texts)), n_shingles)
    begin = np.concatenate([[0], np.cumsum(n_shingles)])
    start = at[:-1][owner] + (np.arange(len(owner)) - begin[:-1][owner])
    short = counts[owner] < size
    value = np.zeros(len(owner), dtype=U64)
    padded = np.concatenate([hashes, np.zeros(size, dtype=U64)])
    with np.errstate(over="ignore"):
        for k in range(size):
            word = padded[start + k]
            if short.any():
                word = np.where(short & (k >= counts[owner]), U64(k + 1), word)
            value = mix(value * U64(0x2545F4914F6CDD1D) + word + U64(k))
    for a, b in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True):
        value[a:b].sort()
    keep = np.ones(len(value), dtype=bool)
    keep[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    value, owner = value[keep], owner[keep]
    return value, np.searchsorted(owner, np.arange(len(texts) + 1))
